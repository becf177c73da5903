"""Ranked lexical search: every document against every item of a query set, by sort-based accumulation.

Terms are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. A term's weight and a document's
score are whole numbers (see weight() and impacts()), so results are the same however rows are dealt.

1. The different terms of each item are a table. They are taken in blocks of about BLOCK (item, term) pairs, one block
   at a time; only a block's terms are sent to the workers.
2. One pass over the texts keeps, for each document, its length and the terms it shares with the block, with their
   numbers: a table in the shared folder, from which the statistics of terms and documents follow.
3. One pass over that table concatenates, for as many documents as make PAIRS matches, the arrays of matching items,
   documents and impacts; packs item and document into one key; sorts the keys by their 16-bit digits (a radix sort);
   and sums the impacts of equal keys with reduceat. What is over the item's present K-th best enters the item's heap.
4. The heaps of all tasks are put together in two rounds: K of each item and share of tasks, then, range-partitioned by
   item, K of each item. A task of either round reads K rows from each of the square root of as many tasks.

Memory of a worker: the block's terms, PAIRS matches, K rows an item. Nothing but a block's terms goes through the driver.

Defined results: a null text, of a document or an item, has no terms; a document without terms is not counted; repeated
documents are documents of their own, with ranks of their own; rows of one item_id are one item, of all their terms, and a
null item_id is an item_id; a null doc_id comes after all others of its score; an item none of whose terms occur, an empty
query set and an empty table have no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from lumiflux.llm.common import materialise, sliced
from lumiflux.llm.decontaminate import words_of

K = 10
#: (item, term) pairs of a block, some 100 bytes each in a worker. More items take more blocks, each a pass over the texts.
BLOCK = 400_000
#: Matches accumulated at a time, some 50 bytes each; one document's matches are never parted.
PAIRS = 1 << 20
NO_ID = np.iinfo(np.int64).max

_held: list[tuple[str, "Index"]] = []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norm(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """A document's m from its number of terms."""
    return 100 - 90 + (90 * n * n_docs) // max(total, 1)


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def radix_order(keys: np.ndarray, bits: int) -> np.ndarray:
    """The order of whole numbers of so many bits, least digit first; numpy's stable sort of 16-bit numbers is a radix sort."""
    order = np.arange(len(keys))
    for shift in range(0, bits, 16):
        digit = (keys[order] >> np.uint64(shift)).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]
    return order


def accumulate(items: np.ndarray, docs: np.ndarray, impact: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (item, doc) in ascending order and the sums of their impacts."""
    low = max(1, int(n_docs - 1).bit_length())
    keys = (items.astype(np.uint64) << np.uint64(low)) | docs.astype(np.uint64)
    order = radix_order(keys, low + max(1, int(items.max()).bit_length()))
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    keys = keys[first]
    return (keys >> np.uint64(low)).astype(np.int64), (keys & np.uint64((1 << low) - 1)).astype(np.int64), np.add.reduceat(impact[order], first)


class Heaps:
    """The K best (score, document) of each item: higher scores first, then smaller doc_ids."""

    def __init__(self, k: int):
        self.k = k
        self.heaps: dict[int, list[tuple[int, int]]] = {}

    def push(self, items: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Arrays ordered by item. Of each item's run, only what may be among the K best is looked at one by one."""
        ends = np.flatnonzero(np.r_[items[1:] != items[:-1], True]) + 1
        for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()):
            heap = self.heaps.setdefault(int(items[a]), [])
            s, d = scores[a:b], ids[a:b]
            least = int(np.partition(s, b - a - self.k)[b - a - self.k]) if b - a > self.k else 1
            near = s >= max(1, least)
            if len(heap) == self.k:
                worst, last = heap[0]
                near &= (s > worst) | ((s == worst) & (d < -last))
            for score, doc in zip(s[near].tolist(), d[near].tolist()):
                mine = (score, -doc)
                if len(heap) < self.k:
                    heapq.heappush(heap, mine)
                elif mine > heap[0]:
                    heapq.heapreplace(heap, mine)


class Index:
    """A block of items by number: the items of each term, as one array and where each term's part begins."""

    def __init__(self, rows: list[tuple[object, list[bytes]]]):
        self.names = [name for name, _ in rows]
        self.number: dict[bytes, int] = {}
        pairs = [(self.number.setdefault(t, len(self.number)), i) for i, (_, terms) in enumerate(rows) for t in terms]
        of = np.array(pairs, np.int64).reshape(-1, 2)
        order = np.argsort(of[:, 0], kind="stable")
        self.items = of[order, 1]
        self.starts = np.searchsorted(of[order, 0], np.arange(len(self.number) + 1))


def _index(name: str, sent) -> Index:
    """Built once a Python worker, which holds one block at a time."""
    if not _held or _held[0][0] != name:
        _held[:] = [(name, Index(sent.value))]
    return _held[0][1]


def query_terms(items: DataFrame) -> DataFrame:
    """item_id and its different terms, one row each."""
    kind = items.schema["item_id"].dataType.simpleString()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 64):
            found = [sorted(set(words_of(t))) for t in batch.column("text").to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(w) for w in found])
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(at)), pa.array([w for ws in found for w in ws], pa.binary())], names=["item_id", "term"])

    return items.select("item_id", "text").mapInArrow(put, f"item_id {kind}, term binary").distinct()


def postings(docs: DataFrame, name: str, sent) -> DataFrame:
    """doc_id, n (all terms), and the numbers and counts of the block's terms, of every document with a term."""
    parts = pa.list_(pa.int32())

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _index(name, sent).number
        known = number.keys()
        for batch in sliced(batches):
            keep, n, terms, counts = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                if words:
                    count = Counter(words)
                    shared = known & count.keys()
                    keep.append(i)
                    n.append(len(words))
                    terms.append([number[t] for t in shared])
                    counts.append([count[t] for t in shared])
            ids = batch.column("doc_id").take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(terms, parts), pa.array(counts, parts)], names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(put, "doc_id long, n long, terms array<int>, counts array<int>")


def best_of_tasks(found: DataFrame, kind: DataType, name: str, sent, weights, n_docs: int, total: int, k: int) -> DataFrame:
    """item_id, doc_id, score, task: the k best documents of each item among those of a task."""
    named = to_arrow_type(kind)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        index, heaps, w = _index(name, sent), Heaps(k), weights.value
        for batch in sliced(batches):
            terms, counts = batch.column("terms"), batch.column("counts")
            t, tf = terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64)
            at = np.repeat(np.arange(batch.num_rows), terms.value_lengths().to_numpy())
            m = norm(batch.column("n").to_numpy().astype(np.int64), n_docs, total)
            ids = batch.column("doc_id").fill_null(int(NO_ID)).to_numpy()
            impact, width = impacts(w[t], tf, m[at]), index.starts[t + 1] - index.starts[t]
            upto = np.r_[0, np.cumsum(width)]  # matches before each posting
            by_doc = np.r_[np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else [], len(at)].astype(int)
            a = 0
            while a < len(by_doc) - 1:
                b = max(a + 1, int(np.searchsorted(upto[by_doc], upto[by_doc[a]] + PAIRS, "right")) - 1)
                own = slice(by_doc[a], by_doc[b])
                times = width[own]
                place = np.repeat(index.starts[t[own]] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
                first = at[by_doc[a]]
                items, rows, scores = accumulate(index.items[place], np.repeat(at[own] - first, times), np.repeat(impact[own], times), int(at[by_doc[b] - 1] - first) + 1)
                heaps.push(items, ids[rows + first], scores)
                a = b
        out = [(index.names[i], None if -d == NO_ID else -d, s) for i, heap in heaps.heaps.items() for s, d in heap]
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], named), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array([TaskContext.get().partitionId()] * len(out), pa.int32())], names=["item_id", "doc_id", "score", "task"])

    return found.mapInArrow(put, f"item_id {kind.simpleString()}, doc_id long, score long, task int")


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item of a table (item_id, doc_id, score, task) and their ranks."""
    tasks = found.agg(F.max("task").alias("n")).first().n or 0
    share = F.pmod(F.col("task"), F.lit(math.isqrt(tasks) + 1))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    few = found.withColumn("share", share).withColumn("k", F.row_number().over(W.partitionBy("item_id", "share").orderBy(*order))).where(F.col("k") <= k)
    ranged = materialise(few.select("item_id", "doc_id", "score"), "search-shares").repartitionByRange("item_id")
    return ranged.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, of scores above 0."""
    spark = docs.sparkSession
    sc, kind = spark.sparkContext, items.schema["item_id"].dataType
    terms = materialise(query_terms(items), "search-terms")
    blocks = math.ceil(terms.count() / block)
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for i in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i).groupBy("item_id").agg(F.collect_list("term").alias("terms"))
        # About `block` pairs: the size of the query set was counted.
        rows, name = [(r.item_id, [bytes(t) for t in r.terms]) for r in own.collect()], uuid.uuid4().hex
        if not rows:
            continue
        sent = sc.broadcast(rows)
        found = materialise(postings(docs, name, sent), "search-postings")
        size = found.agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
        weights = np.zeros(len(Index(rows).number), np.int64)
        for r in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():  # the block's terms
            weights[r.term] = weight(size.n_docs, r.df)
        best = best_of_tasks(found, kind, name, sent, sc.broadcast(weights), size.n_docs, size.total, k)
        out = out.unionByName(top(materialise(best, "search-best"), k))
    return out


SQL = r"""
WITH abc AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents, abc),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark, abc),
size AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, size GROUP BY term, n_docs),
s AS (
  SELECT item_id, r, doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(d.w) * n_docs) // total))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (r), size GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
