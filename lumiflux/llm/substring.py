"""Substring dedup: content-defined chunks, deduplicated by digest.

A gear hash rolls over the UTF-8 bytes: h = (h << 1) + G[byte] in 32 bits, so it depends on the last 32 bytes alone and
cuts realign after an insertion. A chunk ends where the top MASK bits of h are zero, or at a character's end after
MAX bytes, and has MIN bytes at least. Chunks are compared by a 128-bit digest.

A chunk that occurs more than once in the corpus is repeated; its keeper is its first occurrence by doc_id (a null one
last), then by the row's place in the table, then by place in the text. Repeated chunks that follow each other make a run; runs of RUN or more characters count, shorter ones are
chance. Of each run the chunks that are not keepers are removed. The chunks that the ends of a passage cut never match,
so chunks are small: 32 bytes on average.

Chunks are counted with partial sums, then only repeated ones meet their counts again, so a passage in a third of all
documents is a skewed join that Spark may split, never a group in one task. Texts are cut twice, for the counts and for
the join, as a table of all chunks would take as much disk as a shuffle of them.

Rows are told apart by their partition and place in it, and texts are cut more than once, so docs is a table as it is
read, or written (materialise()) beforehand: a plan that may deal rows anew will not do.

Defined results: null and empty texts have no chunks; a text below RUN and WORDS is never touched; repeated rows repeat
each other in full; a null doc_id sorts last; an empty table has no repeats; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lumiflux.llm.common import with_text

MIN, MASK, MAX, RUN, WORDS, SEED = 16, 4, 1024, 100, 16, 11
#: First bytes of characters from U+3000 on, which count as words.
WIDE = 0xE3
#: Bytes between words.
SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
GEAR = np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)
LAST = (1 << 63) - 1
#: Keepers are compared as one number, doc_id and then the row: sums of it need no sorting. Rows are below 2^ROW.
ROW, PART = 59, 36


def cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks of some UTF-8 bytes."""
    h = GEAR[data]
    for k in (1, 2, 4, 8, 16):  # the sum over 32 places, by doubling
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    starts = (data & 0xC0) != 0x80  # a character begins here
    ends = np.flatnonzero(((h >> np.uint32(32 - MASK)) == 0)[:-1] & starts[1:]) + 1
    out, at, n = [], 0, len(data)
    for e in [*ends.tolist(), n]:
        while e - at > MAX:
            cut = at + MAX
            while not starts[cut]:
                cut += 1
            if cut >= e:
                break
            out.append(cut)
            at = cut
        if e - at >= MIN or e == n and e > at:
            out.append(e)
            at = e
    return out


def chunks_of(text: str) -> tuple[list[int], list[int], list[bytes], list[int]]:
    """Starts and ends in code points, digests and beginnings of words of a text's chunks."""
    raw = text.encode()
    if not raw:
        return [], [], [], []
    data = np.frombuffer(raw, np.uint8)
    ends = cuts(data)
    starts = [0, *ends[:-1]]
    digests = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(starts, ends)]
    gap = SPACES[data]
    begun = np.concatenate([[0], np.cumsum(~gap & np.concatenate([[True], gap[:-1]]) | (data >= WIDE))])
    words = np.diff(begun[[0, *ends]]).tolist()
    if len(text) != len(raw):
        places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        starts, ends = places[starts].tolist(), places[ends].tolist()
    return starts, ends, digests, words


#: reach: length in characters and words of a chunk in one number; both are below 2^BITS.
CHUNKS, BITS = "rid long, doc_id long, start int, reach int, h1 long, h2 long", 11


def chunks(docs: DataFrame) -> DataFrame:
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << PART
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                n, starts, reach, digests = [], [], [], []
                for t in batch.column("text"):
                    a, b, d, w = chunks_of(t.as_py())
                    n.append(len(a))
                    starts += a
                    reach += [(y - x) << BITS | z for x, y, z in zip(a, b, w)]
                    digests += d
                h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                rows = np.repeat(np.arange(len(n)), n)
                ids = batch.column("doc_id").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(rid + rows), ids, pa.array(starts, pa.int32()), pa.array(reach, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1])], names=["rid", "doc_id", "start", "reach", "h1", "h2"])
                rid += batch.num_rows

    return with_text(docs).mapInArrow(put, CHUNKS)


def occurrences(docs: DataFrame) -> DataFrame:
    """Every occurrence of a repeated chunk: rid, doc_id, start, end, words, h1, h2, copies, first (the keeper's doc_id and row in
    one number) and keep, whether it stands in the keeper's row."""
    order = F.coalesce("doc_id", F.lit(LAST)).cast("decimal(19,0)") * F.lit(1 << ROW).cast("decimal(18,0)")
    order = order.cast("decimal(38,0)") + F.col("rid").cast("decimal(18,0)")
    repeated = chunks(docs).groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min(order).alias("first")).where("copies > 1")
    end, words = F.col("start") + F.shiftright("reach", BITS), F.col("reach").bitwiseAND(F.lit((1 << BITS) - 1))
    return chunks(docs).join(repeated, ["h1", "h2"]).withColumns({"end": end, "words": words, "keep": F.col("first") == order}).drop("reach")


def runs(docs: DataFrame) -> DataFrame:
    """A row a run: rid, doc_id, start, end, copies (the most of a chunk), keepers (first documents), cut (ranges to remove)."""
    found = occurrences(docs)
    # A document's own chunks: as many as its length allows.
    kind = F.struct("start", "end", "words", "copies", "first", "keep", "h1", "h2")
    per = found.groupBy("rid", "doc_id").agg(F.array_sort(F.collect_list(kind)).alias("c"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                seen, run = set(), []
                for c in [*r["c"], None]:
                    if run and (c is None or c["start"] != run[-1]["end"]):
                        if run[-1]["end"] - run[0]["start"] >= RUN or sum(x["words"] for x in run) >= WORDS:
                            firsts = {int(x) >> ROW for x in {x["first"] for x in run}}
                            rows.append({"rid": r["rid"], "doc_id": r["doc_id"], "start": run[0]["start"], "end": run[-1]["end"], "copies": max(x["copies"] for x in run), "keepers": sorted(k for k in firsts if k != LAST), "cut": ranges([x for x in run if not x["keep"]])})
                        run = []
                    if c is not None:
                        run.append(c | {"keep": c["keep"] and (c["h1"], c["h2"]) not in seen})
                        seen.add((c["h1"], c["h2"]))
            if rows:
                yield from pa.Table.from_pylist(rows, schema=_RUN).to_batches()

    return per.mapInArrow(put, "rid long, doc_id long, start int, end int, copies long, keepers array<long>, cut array<struct<start:int,end:int>>")


_RUN = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("copies", pa.int64()), ("keepers", pa.list_(pa.int64())), ("cut", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def ranges(parts: list[dict]) -> list[dict]:
    """Adjacent chunks as one range."""
    out: list[dict] = []
    for c in parts:
        if out and out[-1]["end"] == c["start"]:
            out[-1]["end"] = c["end"]
        else:
            out.append({"start": c["start"], "end": c["end"]})
    return out


def report(docs: DataFrame) -> DataFrame:
    """A row for each document with repeated passages: how many, how long, what is removed, and the first documents."""
    as_text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda s: F.concat_ws(":", s.start.cast("string"), s.end.cast("string"))), ",")
    length = F.sum(F.col("end") - F.col("start"))
    cut = F.sum(F.aggregate("cut", F.lit(0), lambda a, c: a + c.end - c.start))
    found = runs(docs).groupBy("rid", "doc_id").agg(F.count("*").alias("n_passages"), length.alias("repeated_chars"), cut.alias("removed_chars"), F.max("copies").alias("most_copies"), as_text.alias("passages"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("keepers")))).alias("first_doc_ids"))
    return found.drop("rid")


def dedup(docs: DataFrame) -> DataFrame:
    """docs, all rows and columns, each repeated passage taken out of all texts but its keeper's. What is left of a text
    may be empty; a null text stays null."""
    rid = "__lumiflux_rid"
    cut = runs(docs).groupBy("rid").agg(F.array_sort(F.flatten(F.collect_list("cut"))).alias("__lumiflux_cut")).where(F.size("__lumiflux_cut") > 0)
    schema = StructType([*docs.schema.fields, StructField(rid, LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << PART
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(at, at + batch.num_rows))], names=[*batch.schema.names, rid])
            at += batch.num_rows

    rows = docs.mapInArrow(number, schema).join(cut.withColumnRenamed("rid", rid), rid, "left").drop(rid)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.names.index("text")
            texts = [t if c is None else without(t, [(x["start"], x["end"]) for x in c]) for t, c in zip(batch.column("text").to_pylist(), batch.column("__lumiflux_cut").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:i], pa.array(texts, batch.schema.field("text").type), *batch.columns[i + 1 : -1]], names=batch.schema.names[:-1])

    return rows.mapInArrow(take, docs.schema)


def without(text: str, cut: list[tuple[int, int]]) -> str:
    """The text without the given ranges (in order, apart)."""
    out, at = [], 0
    for a, b in cut:
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])
