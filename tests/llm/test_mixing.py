from collections import defaultdict

import duckdb
import pytest

from lumiflux.llm import mixing


def targets(sizes):
    """Water filling by rounds."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 2 * sizes[s]]
        if not above:
            return capped | share
        for s in above:
            capped[s] = 2 * sizes[s]
            left -= capped[s]


def test_targets_and_taken(docs, rows, empty):
    got = mixing.report(docs).collect()
    assert len(got) == len(rows)
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len((r[1] or "").encode().split())
    want = targets(size)
    taken, by_target = defaultdict(int), {round(t, 6): s for s, t in want.items()}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and (0 <= r.position <= r.last_position <= 1 if r.taken else r.position is None)
        s = by_target[round(r.target, 6)]
        assert r.source_size == size[s]
        taken[s] += r.taken
    assert {s: abs(taken[s] - want[s]) <= 0.5 for s in want} == {s: True for s in want}
    again = sorted(map(str, mixing.report(docs.repartition(2)).collect()))
    assert again == sorted(map(str, got))
    assert mixing.report(empty).count() == 0


def test_the_stream_holds_what_was_taken(docs, empty):
    stream = mixing.curriculum(docs)
    assert stream.columns == docs.columns
    words = sum(len((r.text or "").encode().split()) for r in stream.collect())
    assert words == sum(r.taken for r in mixing.report(docs).collect())
    assert mixing.curriculum(empty).count() == 0


@pytest.mark.parametrize("table", ["0.001", "0.01"])
def test_sql_states_the_same(spark, table):
    path = f"/root/testdata/sf{table}/documents.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    df = mixing.report(spark.read.parquet(path))
    want = sorted(con.sql(f"SELECT {', '.join(df.columns)} FROM ({mixing.SQL})").fetchall())
    got = sorted(tuple(r) for r in df.collect())
    assert [r[:2] + r[4:5] for r in got] == [r[:2] + r[4:5] for r in want]
    for a, b in zip(got, want):
        assert a == pytest.approx(b, abs=2e-6)


def quarters(slope):
    at = [(1 + slope) * x / 4 - slope * (x / 4) ** 2 for x in range(5)]
    return [b - a for a, b in zip(at, at[1:])]


def test_the_stream_follows_the_schedules(spark):
    """Of each source, the words in every quarter of time are the integral of its schedule over it."""
    rows = [(3 * i + k, "w " * 10, s) for k, (s, n) in enumerate((("a", 700), ("b", 500), ("c", 1500))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.report(docs).collect()
    place = [r.position for r in got if r.position is not None]
    assert place == sorted(place) and all(r.position is None for r in got[len(place) :])
    source = {d: s for d, _, s in rows}
    targets = {source[r.doc_id]: r.target for r in got}
    assert targets["a"] == 2 * 7000 and 1 < targets["c"] / 15000 < 2
    # The positions are not in the stream's columns: the order is, and each source is checked against its own schedule.
    stream = [source[r.doc_id] for r in mixing.curriculum(docs).collect()]
    total = len(stream)
    share = {s: targets[s] / sum(targets.values()) for s in targets}
    for s, slope in zip("abc", mixing.SLOPES):
        # Time runs with the words of all sources: invert the sum of their integrals.
        for q in range(1, 4):
            x = q / 4
            upto = sum(share[u] * ((1 + v) * x - v * x * x) for u, v in zip("abc", mixing.SLOPES))
            have = stream[: round(upto * total)].count(s) / stream.count(s)
            assert have == pytest.approx(sum(quarters(slope)[:q]), abs=0.02)


def test_many_ranges_and_repeated_rows(spark, docs, monkeypatch):
    rows = [(1, "same text of six words here", "a")] * 300 + [(None, f"w {i}", "a") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted(map(str, mixing.report(df).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    assert sorted(map(str, mixing.report(df).collect())) == want and len(want) == 500
    words = sum(len(r.text.split()) for r in mixing.curriculum(df).collect())
    assert words == sum(r.taken for r in mixing.report(df).collect())
