import re

import numpy as np
import xxhash

from lumiflux.llm import common, simhash


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_components(spark, docs, rows):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(prints):
        k = find(i)
        best[k] = min((x for x in (best.get(k), d) if x is not None), default=None)
    want = sorted((str(d), f"{f:016x}", str(best[find(i)])) for i, (d, f) in enumerate(prints))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_kernel_finds_exactly_the_near_lanes():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 9, dtype=np.uint64)
    fps = np.array([int(base[i % 9]) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for i in range(300)], np.uint64)
    planes = simhash.planes_of(fps)
    for radius in (1, 3, 4):
        for d in (1, 9, 63, 64, 65, 299):
            valid = np.zeros(planes.shape[1] * 64, np.uint8)
            valid[: 300 - d] = 1
            hit = simhash.lanes_within(planes, d, np.packbits(valid, bitorder="little").view("<u8"), radius)
            lanes = np.flatnonzero(np.unpackbits(hit.view(np.uint8), bitorder="little")).tolist()
            assert lanes == [i for i in range(300 - d) if (int(fps[i]) ^ int(fps[i + d])).bit_count() <= radius]


def test_buckets_beyond_a_chunk_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    rng = np.random.default_rng(5)
    prints = {0}
    while len(prints) < 60:  # a chain of one-bit steps
        prints.add(list(prints)[rng.integers(len(prints))] ^ 1 << int(rng.integers(60)))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    assert simhash.clusters(df.withColumn("node", df.fp)).select("component").distinct().count() == 1


def test_one_of_each_keeps_all_columns(docs, rows, empty):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    comps = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert len(got) == len({c for c in comps.values()})
    assert {r.doc_id for r in got} == set(comps.values())
    assert simhash.one_of_each(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


def test_hubs_and_chains_make_one_component(spark, monkeypatch):
    """A hub of a thousand edges, a long chain and a pair, over nodes of two fields."""
    monkeypatch.setattr(common, "HOT", 5)
    pairs = [(0, i) for i in range(1, 1000)] + [(5000 + i, 5001 + i) for i in range(60)] + [(9000, 9001)]
    edges = spark.createDataFrame([((a % 2 == 1, a), (b % 2 == 1, b)) for a, b in pairs], "u struct<z:boolean,id:long>, v struct<z:boolean,id:long>")
    got = {r.node.id: r.component.id for r in simhash.components(edges).collect()}
    want = {i: 0 for i in range(1, 1000)} | {i: 5000 for i in range(5001, 5061)} | {9001: 9000}
    assert {k: v for k, v in got.items() if k != v} == want


def test_joins_of_hot_keys_lose_no_row(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 3)
    rows = spark.createDataFrame([(k, i) for k, n in ((1, 500), (2, 300), (3, 2), (4, 1)) for i in range(n)], "k int, i int")
    keyed = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, s string")
    got = common.join_hot(rows, keyed, "k").groupBy("s").count().collect()
    assert {(r.s, r["count"]) for r in got} == {("a", 500), ("b", 300), ("c", 2)}
