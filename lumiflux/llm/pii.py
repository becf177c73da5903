"""PII: base patterns, and information-theoretic sanitisation of the terms around them.

Base kinds (leftmost, non-overlapping; positions in code points): `email`, `ip`, `card`, `phone`.

The method adds `term`. Each base value is a protected entity e. The terms t are the words of LETTERS letters or more
within NEAR words of one of its occurrences (and REACH characters, so that a long run without words costs nothing). With document frequencies over the whole corpus of N documents, a term's
pointwise mutual information with the entity is PMI = log2(N n(t,e) / (n(t) n(e))), and what there is to disclose is
the entity's information IC = log2(N / n(e)). A term with PMI >= DISCLOSURE * IC exceeds the threshold; its occurrences
near the entity are added, to be generalised or removed. No number of shared documents is asked for: personal data stands
in one document as a rule. There the threshold bounds the term's own frequency, n(t) <= N^(1 - DISCLOSURE).

n(t,e) comes from the candidates, n(e) from the base spans of every document, with candidates or without, n(t) from all
documents; all are pre-summed before any shuffle.

Defined results: a null text is empty; a text without spans has counts 0 and the digest of the empty string; repeated
rows count as documents of their own and are reported alike; an empty table gives an empty table; other columns are
ignored. An entity that every document holds has nothing to disclose.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lumiflux.llm.common import materialise, sliced, with_text

KINDS = ("email", "ip", "card", "phone", "term")
NEAR, LETTERS, DISCLOSURE = 8, 4, 0.8
REACH = 64 * NEAR
FLUSH = 100_000

# The base patterns. The e-mail pattern's local part is read backwards from each @, which is the same
# match in linear time; the address pattern starts at the head of a run of digits alone for the same reason: what
# fails there fails at every later digit of the run.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DIGIT = re.compile(r"[0-9]")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TERM = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > end and text[a - 1] in LOCALS:
            a -= 1
        m = DOMAIN.match(text, at) if a < at else None
        if m:
            out.append((a, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):  # every other kind has a digit, though its digits may stand apart
        return out
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def entity(kind: str, value: str) -> str:
    """Equal entities, however written: case does not tell addresses apart, nor separators numbers."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else ''.join(c for c in value if c.isdigit())}"


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the terms within NEAR words of a span, on both sides and outside all spans. Words
    around the spans are found once, so a text full of spans takes no more than its length."""
    regions: list[list[int]] = []
    reach, far = [], 0
    for _, a, b in spans:  # by start, so what begins before a term's end reaches as far as the largest end so far
        if regions and a - REACH <= regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], b + REACH)
        else:
            regions.append([max(0, a - REACH), b + REACH])
        far = max(far, b)
        reach.append(far)
    words = [m.span() for a, b in regions for m in TERM.finditer(text, a, min(b, len(text)))]
    opens, begins, closes, out = [a for _, a, _ in spans], [x for x, _ in words], [y for _, y in words], []
    for kind, a, b in spans:
        name, i, j = entity(kind, text[a:b]), bisect_right(closes, a), bisect_left(begins, b)
        for x, y in words[max(0, i - NEAR) : i] + words[j : j + NEAR]:
            k = bisect_left(opens, y)
            if y - x < LETTERS or x < a - REACH or y > b + REACH or k and x < reach[k - 1]:
                continue
            # An edge of the reach that cuts a word leaves no word.
            if x == a - REACH > 0 and text[x - 1].isalpha() or y == b + REACH < len(text) and text[y].isalpha():
                continue
            out.append((name, text[x:y].lower(), x, y))
    return out


SPAN = "struct<kind:string,start:int,end:int>"
FOUND = f"rid long, doc_id long, base array<{SPAN}>, entities array<string>, near array<struct<entity:string,term:string,start:int,end:int>>"


def _found(docs: DataFrame) -> DataFrame:
    """Base spans, their distinct entities and candidates of every row; rid tells rows apart once this table is written."""
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    nears = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 36
        for batch in sliced(batches):
            own, names, near = [], [], []
            for t in batch.column("text"):
                text = t.as_py()
                found = base(text)
                own.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                names.append(sorted({entity(k, text[a:b]) for k, a, b in found}))
                near.append([{"entity": e, "term": w, "start": a, "end": b} for e, w, a, b in candidates(text, found)] if found else [])
            ids = pa.array(range(rid, rid + batch.num_rows), pa.int64())
            rid += batch.num_rows
            yield pa.RecordBatch.from_arrays([ids, batch.column("doc_id"), pa.array(own, spans), pa.array(names, pa.list_(pa.string())), pa.array(near, nears)], names=["rid", "doc_id", "base", "entities", "near"])

    return with_text(docs).mapInArrow(put, FOUND)


def term_frequencies(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """term and n_t, the documents that hold it, over all documents, for the terms of wanted; each task sums what it can
    before the shuffle. Wanted terms are marked in the same aggregation: a join would sort every term of the corpus."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

        for batch in sliced(batches):
            for t in batch.column("text"):
                counts.update({w for w in TERM.findall(t.as_py().lower()) if len(w) >= LETTERS})
                if len(counts) > FLUSH:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    counts = with_text(docs).mapInArrow(put, "term string, n long").withColumn("near", F.lit(False))
    # A part of a word that a span cuts is no word of any document: it has no frequency and drops out.
    marks = wanted.select("term", F.lit(0).cast("long").alias("n"), F.lit(True).alias("near"))
    return counts.unionByName(marks).groupBy("term").agg(F.sum("n").alias("n_t"), F.max("near").alias("near")).where("near AND n_t > 0").drop("near")


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """entity, term, disclosure (PMI / IC) for the pairs that exceed the threshold."""
    n = found.count()
    own = found.select(F.array_distinct(F.transform("near", lambda c: F.struct(c.entity.alias("entity"), c.term.alias("term")))).alias("p"), F.col("entities").alias("e"))
    pairs = own.select(F.explode("p").alias("p")).groupBy(F.col("p.entity").alias("entity"), F.col("p.term").alias("term")).agg(F.count("*").alias("n_te"))
    entities = own.select(F.explode("e").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    # Only terms of pairs need their frequency.
    wanted = materialise(pairs, "pii-pairs")
    terms = term_frequencies(docs, wanted)
    total = F.lit(float(max(n, 1)))
    pmi = F.log2(total * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    ic = F.log2(total / F.col("n_e"))
    scored = wanted.join(entities, "entity").join(terms, "term").select("entity", "term", F.when(ic > 0, pmi / ic).alias("disclosure"))
    return scored.where(F.col("disclosure") >= DISCLOSURE)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, spans (base ones and added terms, in order) for every row."""
    found = materialise(_found(docs), "pii")
    pairs = disclosing(docs, found)
    near = found.where(F.size("near") > 0).select("rid", F.explode("near").alias("c")).select("rid", F.col("c.entity").alias("entity"), F.col("c.term").alias("term"), F.struct(F.lit("term").alias("kind"), F.col("c.start").alias("start"), F.col("c.end").alias("end")).alias("s"))
    added = near.join(pairs.select("entity", "term"), ["entity", "term"]).groupBy("rid").agg(F.collect_set("s").alias("terms"))
    rank = {k: i for i, k in enumerate(KINDS)}
    order = F.create_map(*(x for k, i in rank.items() for x in (F.lit(k), F.lit(i))))
    every = F.concat("base", F.coalesce("terms", F.array().cast(f"array<{SPAN}>")))
    keyed = F.array_sort(F.transform(every, lambda s: F.struct(s.start.alias("start"), order[s.kind].alias("k"), s.end.alias("end"), s.kind.alias("kind"))))
    spans = F.transform(keyed, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    return found.select("rid", "doc_id", "base").join(added, "rid", "left").select("doc_id", "base", spans.alias("spans"))


def as_text(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def count_of(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    n = [count_of("spans", k).alias(f"n_{k}") for k in KINDS]
    return find(docs).select("doc_id", *n[:4], F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"), n[4])


def generalise(text: str, spans: list[tuple[str, int, int]], remove_terms: bool = False) -> str:
    """The text with each span replaced by its kind in brackets; terms are removed if so asked."""
    out, at = [], 0
    for kind, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], "" if kind == "term" and remove_terms else f"[{kind}]"]
        at = b
    return "".join([*out, text[at:]])
