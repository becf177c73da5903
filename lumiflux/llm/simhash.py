"""SimHash near-duplicates with an exact bit-sliced search.

Fingerprints: 64 bits over word shingles, each hashed by XXH64 with seed 42. Two fingerprints link when they differ in
at most RADIUS bits. The search is exact. The 64 bits are cut into BLOCKS blocks; two linked fingerprints agree on at
least BLOCKS - RADIUS of them, so they meet in the bucket of some choice of that many blocks. Within sorted buckets the
bit planes are stored vertically (lane i of plane b is bit b of the i-th fingerprint) and compared with themselves
shifted by d lanes: one XOR a plane updates 64 distances, carry-save adders count them, and 64-lane blocks in which
every lane is beyond the radius are dropped before the next planes are read. A bucket yields a spanning forest of its
links, not its pairs. Buckets over CHUNK fingerprints are compared chunk by chunk in separate groups.

Connected components come from alternating large-star and small-star rounds over tables in the shared folder.

Defined results: null and blank texts have fingerprint zero and link like any other; equal fingerprints share a
component; repeated rows give repeated rows; a null doc_id never names a component unless all of its documents lack
one, and then component_id is null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lumiflux.llm.common import discard, join_hot, materialise, sliced, with_text

SHINGLE, SEED, RADIUS, BLOCKS, CHUNK = 4, 42, 4, 6, 4096
ROUNDS = 100


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        joined, ends, digest = b" ".join(words), [], xxhash.xxh64_intdigest
        at = -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends)]
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :])]
    # Counted in slices, so that a very long text needs no more memory than a slice.
    votes, step = np.zeros(64, np.int64), 1 << 14
    for i in range(0, len(hashes), step):
        part = np.array(hashes[i : i + step], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    """All columns of docs and the fingerprint, as a signed long, in a column of the given (unused) name."""
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            fps = np.fromiter((fingerprint(t) for t in batch.column("text").to_pylist()), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], names=[*batch.schema.names, name])

    return docs.mapInArrow(add, schema)


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """For each choice of blocks that must agree, the mask of its bits, as a signed long."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    own = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(own, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def planes_of(fps: np.ndarray) -> np.ndarray:
    """64 x words: bit i of plane b is bit b of the i-th fingerprint."""
    n = -(-len(fps) // 64) * 64
    padded = np.zeros(n, "<u8")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def shifted(planes: np.ndarray, d: int, words: np.ndarray) -> np.ndarray:
    """The given words of the planes moved down by d lanes; lanes from beyond the end are zero."""
    q, r = divmod(d, 64)
    width = planes.shape[-1]

    def at(i: np.ndarray) -> np.ndarray:
        return np.where(i < width, planes[..., np.minimum(i, width - 1)], np.uint64(0))

    low = at(words + q)
    return low if not r else (low >> np.uint64(r)) | (at(words + q + 1) << np.uint64(64 - r))


def lanes_within(planes: np.ndarray, d: int, valid: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Mask words of the lanes i, among the valid ones, whose fingerprints i and i + d differ in at most radius (< 8) bits."""
    out = np.zeros_like(valid)
    words = np.flatnonzero(valid)
    alive = valid[words]
    ones = twos = fours = over = np.zeros(len(words), np.uint64)
    for b in range(0, 64, 4):
        x = planes[b : b + 4, words] ^ shifted(planes[b : b + 4], d, words)
        # Carry-save: two adders fold four planes into the ones, a third folds their carries into the twos.
        u = ones ^ x[0]
        t1, ones = (ones & x[0]) | (u & x[1]), u ^ x[1]
        u = ones ^ x[2]
        t2, ones = (ones & x[2]) | (u & x[3]), u ^ x[3]
        u = twos ^ t1
        f, twos = (twos & t1) | (u & t2), u ^ t2
        over, fours = over | (fours & f), fours ^ f
        if b >= 8:
            beyond = over.copy()
            for bit, plane in ((4, fours), (2, twos), (1, ones)):
                if not radius & bit:
                    higher = ~np.uint64(0)
                    for b2, p2 in ((4, fours), (2, twos), (1, ones)):
                        if b2 > bit:
                            higher = higher & (p2 if radius & b2 else ~p2)
                    beyond |= plane & higher
            alive = alive & ~beyond
            left = alive != 0
            if not left.all():
                words, alive, ones, twos, fours, over = (v[left] for v in (words, alive, ones, twos, fours, over))
                if not len(words):
                    return out
    out[words] = alive
    return out


def forest(keys: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ends of a spanning forest of the links within each run of equal keys (keys are sorted run numbers)."""
    n = len(fps)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    planes, left, right = planes_of(fps), [], []
    for d in range(1, n):
        same = keys[:-d] == keys[d:]
        if not same.any():
            break
        valid = np.zeros(planes.shape[1] * 64, np.uint8)
        valid[: n - d] = same
        hits = lanes_within(planes, d, np.packbits(valid, bitorder="little").view("<u8"), radius)
        for i in np.flatnonzero(np.unpackbits(hits.view(np.uint8), bitorder="little")).tolist():
            a, b = root(i), root(i + d)
            if a != b:
                parent[b] = a
                left.append(i)
                right.append(i + d)
    return np.array(left, np.int64), np.array(right, np.int64)


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (column fp) to links (u, v), u < v: in each bucket a spanning forest of it."""
    masks = F.array(*(F.struct(F.lit(i).alias("t"), F.lit(m).alias("m")) for i, m in enumerate(block_masks())))
    buckets = fps.select("fp", F.explode(masks).alias("b")).select("fp", F.col("b.t").alias("t"), F.col("fp").bitwiseAND(F.col("b.m")).alias("key"))
    buckets = materialise(buckets, "simhash-buckets")
    sizes = buckets.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    # A bucket of one needs no search. One beyond CHUNK is cut by the fingerprint's hash, and each pair of cuts is a group.
    cuts = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    parts = buckets.join(sizes.withColumn("cuts", cuts), ["t", "key"]).withColumn("c", own)
    parts = parts.withColumn("o", F.explode(F.when(F.col("cuts") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("cuts") - 1))))
    group: list[Column] = [F.col("t"), F.col("key"), F.least("c", "o").alias("lo"), F.greatest("c", "o").alias("hi")]
    parts = parts.select(*group, "fp")
    dealt = parts.repartition("t", "key", "lo", "hi").sortWithinPartitions("t", "key", "lo", "hi")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["t", "key", "lo", "hi"]

        def solve(table: pa.Table) -> pa.RecordBatch:
            cols = [table[c].to_numpy() for c in names]
            fp = table["fp"].to_numpy()
            new = np.zeros(len(fp), bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            a, b = forest(np.cumsum(new), fp.view(np.uint64))
            u, v = fp[a], fp[b]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

        held: pa.Table | None = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held.num_rows < 4096:
                continue
            # The last group may go on in the next batch: it waits.
            differs = np.zeros(held.num_rows, bool)
            for c in names:
                col = held[c].to_numpy()
                differs |= col != col[-1]
            whole = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
            if whole:
                yield solve(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield solve(held)

    return dealt.mapInArrow(search, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Undirected edges (u, v) to (node, component), the component being its smallest node. Nodes have any type with an
    order. A hub of many edges is joined by broadcast (join_hot), so no task holds them all."""
    edges = materialise(edges.where("u <> v"), "cc")
    mark = None
    for _ in range(ROUNDS):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = join_hot(both.where("v > u"), low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Every edge now runs from a larger to a smaller node.
        large = materialise(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_hot(large, low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        after = materialise(small, "cc")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("u").cast("decimal(38,0)"))).first()
        discard(edges)
        discard(large)
        edges = after
        if seen == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = seen
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")


def clusters(own: DataFrame) -> DataFrame:
    """Rows of different fp, each with a node (of any ordered type, one a fingerprint), to fp, node and component, which is
    the smallest node that links reach."""
    own = materialise(own.select("fp", "node"), "simhash-own")
    edges = materialise(links(own.select("fp")), "simhash-links")
    for end in ("u", "v"):
        edges = materialise(join_hot(edges, own.select(F.col("fp").alias(end), F.col("node").alias("n" + end)), end), "simhash-links")
    found = components(edges.select(F.col("nu").alias("u"), F.col("nv").alias("v")))
    return own.join(found, "node", "left").select("fp", "node", F.coalesce("component", "node").alias("component"))


def _node(least: Column) -> Column:
    """Fingerprints in order of their least doc_id (a null one last), so that the smallest node names its component."""
    return F.struct(least.isNull().alias("z"), F.coalesce(least, F.lit(0)).alias("id"), F.col("fp").alias("fp"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for every row."""
    prints = materialise(with_fingerprint(with_text(docs), "fp").select("doc_id", "fp"), "simhash")
    own = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).select("fp", _node(F.col("least")).alias("node"))
    ids = clusters(own).select("fp", F.when(~F.col("component.z"), F.col("component.id")).alias("component_id"))
    return join_hot(prints, materialise(ids, "simhash-ids"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The columns of docs; of each component the row of the smallest doc_id (a null one last), one row of repeated ones.
    Of one doc_id with different fingerprints that link, the row of the smaller one stays."""
    fp, n = "__lumiflux_fp", "__lumiflux_n"
    prints = materialise(with_fingerprint(with_text(docs), "fp").groupBy("doc_id", "fp").agg(F.count("*").alias("n")), "simhash")
    # Each fingerprint's own best comes first, so that copies, however many, are one row before anything is joined.
    own = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "n")).alias("o")).select("fp", _node(F.col("o.doc_id")).alias("node"), F.col("o.doc_id").alias("least"), F.col("o.n").alias("n"))
    own = materialise(own, "simhash-best")
    heads = clusters(own).where("component = node").select("fp")
    keep = own.join(heads, "fp").select(F.col("fp").alias(fp), F.col("least").alias("__lumiflux_id"), F.col("n").alias(n))
    rows = with_fingerprint(docs, fp).join(keep, fp).where(F.col("doc_id").cast("long").eqNullSafe(F.col("__lumiflux_id")))
    rows = rows.drop("__lumiflux_id")
    single, repeated = rows.where(F.col(n) == 1), rows.where(F.col(n) > 1).dropDuplicates([fp])
    return single.unionByName(repeated).select(*docs.columns)
