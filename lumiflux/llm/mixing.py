"""Mixing sources to target weights along a time-varying curriculum, with DataFrame operations.

Targets. Sources in order of code point (null last) weigh WEIGHTS in turn and share SHARE of all words. A target stops
at CAP times its source's size; the excess is shared anew by weight until none is above. The fixed point is
target = min(CAP * size, level * weight), so the level is found from running sums over sources sorted by
CAP * size / weight: one row a source, after aggregation.

Each source is passed over as often as its target asks; in the last pass the running sum stops at the target, and the
document on that edge is cut there, so taken words meet the target to a word and no document exceeds CAP times its size.

Curriculum. Source number r demands its words over training time x in [0, 1] at the rate target * (1 + s - 2 s x), with
slope s from SLOPES in turn: sources with s > 0 come early, those with s < 0 late. The integral is
target * ((1 + s) x - s x^2). Within a source documents follow a hash of doc_id and text, pass after pass. A copy that
is taken in pass k has the words of all passes before it and of the documents before it in its own ahead of it; these,
and half of its own words, are the cumulative demand at its middle, and the inverse of the integral is its position.

Running sums never gather a source in one task: hash ranges are summed first, their number growing with the rows, then
each is numbered by itself. Rows that repeat both doc_id and text are counted as one in sums of sizes alone.

Defined results: null text has size 0 and takes 0; an empty table has an empty mix; repeated rows are taken as rows of
their own; a null doc_id hashes as the empty string; a document that is not taken has no position; other columns are
carried along only by curriculum().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lumiflux.llm.common import WORD

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2
SLOPES = (0.5, 0.0, -0.5)
#: Rows of a range of hashes, about; a source has a power of 16 ranges.
RANGE_ROWS = 20_000
P = "__lumiflux_"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sources(sized: DataFrame) -> DataFrame:
    """One row a source: src, source_size, target, slope. sized has src and n."""
    per = sized.groupBy("src").agg(F.sum("n").alias("source_size"))
    # Windows without partitions, but over one row a source.
    rank = F.row_number().over(W.orderBy(F.col("src").isNull(), F.col("src").cast("binary"))) - 1
    w = F.element_at(F.array(*(F.lit(float(x)) for x in WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    slope = F.element_at(F.array(*(F.lit(x) for x in SLOPES)), (rank % len(SLOPES) + 1).cast("int"))
    per = per.select("src", "source_size", w.alias("w"), slope.alias("slope"), rank.alias("k"))
    by_ratio = W.orderBy(F.col("source_size") * CAP / F.col("w"), "k")
    ahead = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    per = per.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum(F.col("source_size") * CAP).over(ahead), F.lit(0)).alias("capped"),
        F.coalesce(F.sum("w").over(ahead), F.lit(0.0)).alias("used"),
        F.sum("w").over(everything).alias("all_w"),
    )
    level = (F.col("total") * F.lit(SHARE) - F.col("capped")) / (F.col("all_w") - F.col("used"))
    # The first source, by ratio, that the level does not lift over its cap sets the level for all that follow.
    per = per.select("*", level.alias("level"), (level * F.col("w") <= F.col("source_size") * CAP).alias("below"))
    final = F.first(F.when(F.col("below"), F.col("level")), ignorenulls=True).over(by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.least((F.col("source_size") * CAP).cast("double"), F.coalesce(final * F.col("w"), F.lit(0.0)))
    return per.select("src", "source_size", target.alias("target"), "slope")


def _hash(text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def _sized(docs: DataFrame) -> DataFrame:
    """docs with n (words), h (place in the source) and src, a source as a key that is never null."""
    return docs.withColumns({P + "n": size_of(F.col("text")), P + "h": _hash(F.col("text")), P + "src": F.concat(F.col("source").isNull().cast("string"), F.coalesce("source", F.lit("")))})


def _digits(rows: int) -> int:
    n = 1
    while rows > RANGE_ROWS * 16**n:
        n += 1
    return n


def _ranges(counts: DataFrame, digits: int) -> DataFrame:
    """A row a source and range of hashes: words before it in the source, and the source's size, target and slope. counts
    has source, key, h, n (words of a row) and c (rows)."""
    slim = counts.select("source", F.col("key"), F.substring("h", 1, digits).alias("cut"), (F.col("n") * F.col("c")).alias("n"))
    ranges = slim.groupBy("source", "key", "cut").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("key").orderBy("cut").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    per = sources(ranges.select(F.col("source").alias("src"), "n")).withColumn("key", F.concat(F.col("src").isNull().cast("string"), F.coalesce("src", F.lit(""))))
    return ranges.select("key", "cut", before.alias("before")).join(per.drop("src"), "key")


def _taken(n: Column, at: Column, size: Column, target: Column) -> Column:
    """Words taken of a document of n words with so many words ahead of it in its source."""
    words = F.round(target).cast("long")
    passes = F.when(size > 0, F.floor(words / size)).otherwise(0)
    return F.when(n > 0, n * passes + F.greatest(F.lit(0), F.least(n, words - passes * size - at))).otherwise(0).cast("long")


def position(share: Column, s: Column) -> Column:
    """The time at which a source of slope s has had this share of its words."""
    a = 1 + s
    return F.when(s == 0, share).otherwise((a - F.sqrt(F.greatest(F.lit(0.0), a * a - 4 * s * share))) / (2 * s))


def _middle(k: Column, n: Column, at: Column, size: Column, target: Column, taken: Column) -> Column:
    """Share of the source's words that are out at the middle of copy k (from 0) of a document."""
    own = F.least(n, taken - k * n)
    return F.least(F.lit(1.0), (k * size + at + own / 2) / F.when(target > 0, target).otherwise(F.lit(1.0)))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the positions of the first and the last copy, for every row, in the
    order of the first copy."""
    slim = _sized(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"))
    rows = slim.groupBy("doc_id", "source", F.col(P + "src").alias("key"), F.col(P + "h").alias("h"), F.col(P + "n").alias("n")).agg(F.count("*").alias("c"))
    digits = _digits(docs.count())
    known = _ranges(rows, digits)
    order = W.partitionBy("key", "cut").orderBy("h", "doc_id", "n").rowsBetween(W.unboundedPreceding, -1)
    run = rows.withColumn("cut", F.substring("h", 1, digits)).withColumn("inside", F.coalesce(F.sum(F.col("n") * F.col("c")).over(order), F.lit(0)))
    run = run.join(known, ["key", "cut"]).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("c").cast("int") - 1)))
    n, size, target = F.col("n"), F.col("source_size"), F.col("target")
    at = F.col("before") + F.col("inside") + F.col("j") * n
    run = run.withColumn("taken", _taken(n, at, size, target))
    last = F.greatest(F.lit(0), F.ceil(F.col("taken") / F.when(n > 0, n).otherwise(1)) - 1)
    places = (F.when(F.col("taken") > 0, position(_middle(k, n, at, size, target, F.col("taken")), F.col("slope"))) for k in (F.lit(0), last))
    out = run.select("doc_id", n.alias("size"), "source_size", F.round("target", 6).alias("target"), "taken", *(F.round(p, 6).alias(c) for p, c in zip(places, ("position", "last_position"))))
    return out.repartitionByRange(F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


def curriculum(docs: DataFrame) -> DataFrame:
    """The training stream, with the columns of docs: a row each time that a document is taken, range-sorted by position;
    the cut one has its words up to the cut, a space apart. Texts are shuffled twice: by ranges of their source's hashes,
    for the running sums, and by position."""
    rows = _sized(docs)
    digits = _digits(docs.count())
    known = _ranges(rows.select("source", F.col(P + "src").alias("key"), F.col(P + "h").alias("h"), F.col(P + "n").alias("n"), F.lit(1).alias("c")), digits)
    known = known.select(*(F.col(c).alias(P + d) for c, d in (("key", "src"), ("cut", "cut"), ("before", "before"), ("source_size", "size"), ("target", "target"), ("slope", "slope"))))
    order = W.partitionBy(P + "src", P + "cut").orderBy(P + "h", P + "n").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn(P + "cut", F.substring(P + "h", 1, digits)).withColumn(P + "inside", F.coalesce(F.sum(P + "n").over(order), F.lit(0)))
    rows = rows.join(known, [P + "src", P + "cut"])
    n, size, target = F.col(P + "n"), F.col(P + "size"), F.col(P + "target")
    at = F.col(P + "before") + F.col(P + "inside")
    rows = rows.withColumn(P + "taken", _taken(n, at, size, target))
    taken, k = F.col(P + "taken"), F.col(P + "k")
    times = F.when(taken > 0, F.ceil(taken / n)).otherwise(0).cast("int")
    rows = rows.where(times > 0).withColumn(P + "x", F.explode(F.transform(F.sequence(F.lit(0), times - 1), lambda i: F.struct(i.alias("k"), position(_middle(i, n, at, size, target, taken), F.col(P + "slope")).alias("p")))))
    rows = rows.withColumns({P + "k": F.col(P + "x.k"), P + "p": F.col(P + "x.p")})
    left = taken - k * n
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)), F.lit(1), left.cast("int")), " ")
    rows = rows.withColumn("text", F.when(left >= n, F.col("text")).otherwise(cut))
    return rows.repartitionByRange(P + "p", "doc_id").sortWithinPartitions(P + "p", "doc_id").select(*docs.columns)


SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source AS src, coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0)::BIGINT AS n, md5(concat(coalesce(doc_id::VARCHAR, ''), ':', md5(coalesce(text, '')))) AS h FROM documents),
per AS (SELECT src, sum(n)::BIGINT AS size, (row_number() OVER (ORDER BY src IS NULL, encode(src)) - 1) % 3 AS k FROM d GROUP BY src),
w AS (SELECT src, size, CASE k WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, CASE k WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE -0.5::DOUBLE END AS s FROM per),
-- Water filling by rounds: what is above its cap is capped, and the rest shared anew.
fill AS (
  SELECT 0 AS i, src, size, w, s, false AS capped FROM w
  UNION ALL
  SELECT i + 1, src, size, w, s, capped OR (sum(size) OVER () * 1.5::DOUBLE - sum(CASE WHEN capped THEN 2 * size ELSE 0 END) OVER ()) * w / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () > 2 * size
  FROM fill WHERE i < (SELECT count(*) FROM w)),
done AS (SELECT * FROM fill WHERE i = (SELECT count(*) FROM w)),
t AS (SELECT src, size, s, CASE WHEN capped THEN (2 * size)::DOUBLE ELSE (sum(size) OVER () * 1.5::DOUBLE - sum(CASE WHEN capped THEN 2 * size ELSE 0 END) OVER ()) * w / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () END AS target FROM done),
p AS (SELECT r, doc_id, n, size, s, target, coalesce(sum(n) OVER (PARTITION BY d.src ORDER BY h, doc_id, n, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead FROM d JOIN t ON d.src IS NOT DISTINCT FROM t.src),
-- The source is laid out pass after pass up to its target; a copy is what of it lies before the target.
copies AS (SELECT r, k, size * k + ahead AS begins, least(n, round(target)::BIGINT - size * k - ahead) AS own FROM p, range(0, 3) AS x(k) WHERE n > 0 AND size * k + ahead < round(target)::BIGINT),
-- The integral of the schedule is inverted by halving.
half AS (
  SELECT 0 AS i, r, k, own, least(1.0::DOUBLE, (begins + own / 2::DOUBLE) / target) AS share, s, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi FROM copies JOIN p USING (r)
  UNION ALL
  SELECT i + 1, r, k, own, share, s, CASE WHEN (1 + s) * (lo + hi) / 2 - s * (lo + hi) * (lo + hi) / 4 < share THEN (lo + hi) / 2 ELSE lo END, CASE WHEN (1 + s) * (lo + hi) / 2 - s * (lo + hi) * (lo + hi) / 4 < share THEN hi ELSE (lo + hi) / 2 END
  FROM half WHERE i < 48),
x AS (SELECT r, sum(own)::BIGINT AS taken, arg_min(lo, k) AS first, arg_max(lo, k) AS last FROM half WHERE i = 48 GROUP BY r)
SELECT doc_id, n AS "size", size AS source_size, round(target, 6) AS target, coalesce(taken, 0)::BIGINT AS taken, round(first, 6) AS position, round(last, 6) AS last_position
FROM p LEFT JOIN x USING (r)
"""
