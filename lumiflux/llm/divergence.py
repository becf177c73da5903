"""Source divergence audit: how far the word use of the sources of a language lies apart, by a baseline-correction
inverted index.

Terms are runs of letters and of characters beyond ASCII, with A-Z lower-cased. A language keeps the V terms that at
least SUPPORT of its documents hold. A group is a (lang, source) that occurs, with terms or without. For a count c of a
term in a group of N kept occurrences, p(c) = 1 + floor(SCALE (c + PRIOR) / (N + PRIOR V)); the divergence of two groups
is the sum of |p - p'| over all V terms.

Most counts are zero, so no pair of groups is compared term by term. With z and z' what p(0) is in the two groups:

* each pair starts at V |z - z'|, as if no term occurred in either;
* a term of count c in one group is corrected as if the other had none: by |p(c) - z'| - |z - z'|. That depends on c
  alone, so a group's terms are first counted by c, and there is one correction for each pair and different c;
* a term's postings, the groups that hold it, then emit for each pair among them what these two corrections together
  miss, |p - p'| + |z - z'| - |p - z'| - |p' - z|, unless that is zero.

The sums are those of the definition, whatever the order, in whole numbers. Terms of a group are ranked by a window
against p in the whole language.

One pass over the texts, in which each task adds up FLUSH (group, term) counts before it hands them on, and one shuffle
by (lang, term) give the postings of kept terms, a table in the shared folder; all else reads that. A posting list has
one entry a source; a result has one row a pair of sources, as asked. Divisions are exact beyond 64 bits.

Defined results: a null text, lang or source is ''; rows without a source are thus a group of their own; a language with
one source has no pairs, one without kept terms has pairs of value 0 and no terms; repeated documents count as often as
they stand there; an empty table has no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lumiflux.llm.common import materialise, sliced

SUPPORT, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: (group, term) counts that a task holds before it hands them on, some 200 bytes each.
FLUSH = 200_000
#: A language's groups are spread over so many keys where they are joined with each other.
SALT = 32
#: For bytes.translate(): letters (A-Z as a-z) and all from 0x80 stay, the rest becomes a space.
FOLD = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


COUNTS = "lang string, source string, term string, n long, d long"


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n occurrences in d documents: parts of these sums, some rows for each group and term."""

    def hand_on(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in held.items():
            k, terms = len(n), list(n)
            for a in range(0, k, 50_000):
                own = terms[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array([source] * len(own), pa.string()), pa.array(own, pa.binary()).cast(pa.string()), pa.array([n[t] for t in own], pa.int64()), pa.array([d[t] for t in own], pa.int64())], names=["lang", "source", "term", "n", "d"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for batch in sliced(batches):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                words = words_of(text)
                if words:
                    n, d = held[lang, source]
                    size -= len(n)
                    n.update(words)
                    d.update(set(words))
                    size += len(n)
            if size >= FLUSH:
                yield from hand_on(held)
                held.clear()
                size = 0
        yield from hand_on(held)

    return _read(docs, "text").mapInArrow(put, COUNTS)


def _read(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", *more)))


def postings(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """lang, term, n (in the whole language) and groups, array of (source, n), of every kept term."""
    dealt = counts(docs).repartition("lang", "term")
    own = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    listed = own.groupBy("lang", "term").agg(F.sum("d").alias("df"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("groups"))
    return listed.where(F.col("df") >= support).select("lang", "term", "n", "groups")


def p(count: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE (count + PRIOR) / (total + PRIOR vocabulary)); decimals, as the product can pass 64 bits."""
    over = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)")
    return F.call_function("div", over, (total + PRIOR * vocabulary).cast("decimal(20,0)")) + 1


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total (kept occurrences), vocabulary (V), q_total (the language's) and z (p of no occurrence) of every group."""
    every = _read(docs).distinct()
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("n").alias("q_total"))
    of_group = kept.select("lang", F.explode("groups").alias("g")).groupBy("lang", F.col("g.source").alias("source")).agg(F.sum("g.n").alias("total"))
    zero = F.lit(0).cast("long")
    joined = every.join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("vocabulary", zero).alias("vocabulary"), F.coalesce("q_total", zero).alias("q_total"))
    return joined.withColumn("z", F.when(F.col("vocabulary") > 0, p(zero, F.col("total"), F.col("vocabulary"))).otherwise(zero))


def held_terms(kept: DataFrame, every: DataFrame) -> DataFrame:
    """lang, term, source, n, p, z, q of each posting."""
    flat = kept.select("lang", "term", F.col("n").alias("q_n"), F.explode("groups").alias("g")).select("lang", "term", "q_n", "g.source", "g.n")
    # Groups are small beside postings; Spark broadcasts them where their size allows it.
    own = flat.join(every, ["lang", "source"])
    return own.select("lang", "term", "source", "n", p(F.col("n"), F.col("total"), F.col("vocabulary")).alias("p"), "z", p(F.col("q_n"), F.col("q_total"), F.col("vocabulary")).alias("q"))


def pair_sums(held: DataFrame, every: DataFrame) -> DataFrame:
    """lang, a, b (a before b) and value for every two groups of a language."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    others = every.select("lang", F.col("source").alias("other"), F.col("z").alias("other_z"), salts.alias("salt"))
    spread = lambda df, *by: df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALT)).cast("int"))
    base = spread(every, "source").join(others, ["lang", "salt"]).where(F.col("source") < F.col("other"))
    base = base.select("lang", F.col("source").alias("a"), F.col("other").alias("b"), (F.col("vocabulary") * F.abs(F.col("z") - F.col("other_z"))).alias("v"))
    by_count = held.groupBy("lang", "source", "n", "p", "z").agg(F.count("*").alias("times"))
    alone = spread(by_count, "source", "n").join(others, ["lang", "salt"]).where(F.col("source") != F.col("other"))
    alone = alone.select("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"), (F.col("times") * (F.abs(F.col("p") - F.col("other_z")) - F.abs(F.col("z") - F.col("other_z")))).alias("v"))
    listed = held.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "z")).alias("l"))
    two = listed.select("lang", "l", F.explode("l").alias("x")).select("lang", "x", F.explode("l").alias("y")).where(F.col("x.source") < F.col("y.source"))
    missed = F.abs(F.col("x.p") - F.col("y.p")) + F.abs(F.col("x.z") - F.col("y.z")) - F.abs(F.col("x.p") - F.col("y.z")) - F.abs(F.col("y.p") - F.col("x.z"))
    both = two.select("lang", F.col("x.source").alias("a"), F.col("y.source").alias("b"), missed.alias("v")).where("v != 0")
    return base.unionByName(alone).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("v").alias("value"))


def audit(docs: DataFrame, support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: the distances of each group to the others of its
    language, the farthest first, and the `top` terms that it uses more than its language does."""
    kept = materialise(postings(docs, support), "divergence-postings")
    every = materialise(groups(docs, kept), "divergence-groups")
    held = materialise(held_terms(kept, every), "divergence-terms")
    sums = pair_sums(held, every)
    pairs = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    terms = held.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    place = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = terms.withColumn("rank", place).where(F.col("rank") <= top)
    return pairs.withColumn("rank", place).unionByName(best)


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, term, count(*) AS tf FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(tf)::BIGINT AS n FROM t GROUP BY lang, term HAVING count(*) >= {SUPPORT}),
size AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, k.n AS q_n, coalesce(x.n, 0)::BIGINT AS n
  FROM g JOIN kept k USING (lang) LEFT JOIN (SELECT lang, source, term, sum(tf)::BIGINT AS n FROM t GROUP BY ALL) x USING (lang, source, term)),
s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS own FROM c),
p AS (SELECT lang, source, term, n, (1 + ({SCALE}::HUGEINT * (n + {PRIOR})) // (own + {PRIOR} * v)::HUGEINT)::BIGINT AS p,
    (1 + ({SCALE}::HUGEINT * (q_n + {PRIOR})) // (total + {PRIOR} * v)::HUGEINT)::BIGINT AS q
  FROM s JOIN size USING (lang)),
pair AS (SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b USING (lang) LEFT JOIN (
    SELECT x.lang, x.source AS source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  WHERE a.source <> b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
