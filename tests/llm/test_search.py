import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from lumiflux.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, score long"


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """docs: (doc_id, text); every document scored for every item."""
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    for item, wanted in asked.items():
        scored = []
        for doc, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables(rows):
    rng = random.Random(5)
    words = ["the", "of", "Été", "x1", "42", "ÀB", "q", "測試", *(f"w{i}" for i in range(40))]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    docs = [(r[0], r[1]) for r in rows] + [(100 + i, text(rng.choice((0, 1, 3, 20, 60)))) for i in range(300)]
    docs += [(500 + i // 2, "the of w1 w2 w3") for i in range(40)] + [(-3, "w1 w1 w1"), (None, "w1 w2")]
    items = [(i, text(rng.randint(1, 12))) for i in range(15)] + [(3, "w1 of"), (3, "w1 of"), (90, None), (91, ""), (92, "nowhere"), (None, "w1 W2 w2"), (93, " ".join(words))]
    return docs, items


@pytest.mark.parametrize("pairs, block", [(search.PAIRS, search.BLOCK), (50, 40)])
def test_every_document_scored_for_every_item_gives_the_same(spark, tables, monkeypatch, pairs, block):
    monkeypatch.setattr(search, "PAIRS", pairs)
    docs, items = tables
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, rank int").repartition(5)
    q = spark.createDataFrame([(*r, 1) for r in items], ITEMS).repartition(3)
    got = search.search(d, q, block=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_sql_agrees(spark, tables):
    docs, items = tables
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(con.sql(search.SQL).fetchall(), key=str) == plain(docs, items)


def test_other_k_and_names_of_items(spark, tables):
    docs, items = tables
    named = [(None if i is None else f"item {i}", t) for i, t in items]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = search.search(d, spark.createDataFrame(named, "item_id string, text string"), k=3)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, named, 3)


def test_empty_tables(spark, tables, empty):
    q = spark.createDataFrame([(i, t, 0) for i, t in tables[1]], ITEMS)
    assert search.search(empty, q).count() == 0
    assert search.search(spark.createDataFrame(tables[0], "doc_id long, text string"), spark.createDataFrame([], ITEMS)).count() == 0


def test_radix_order_and_sums():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 37, 5000, dtype=np.uint64)
    assert (keys[search.radix_order(keys, 37)] == np.sort(keys)).all()
    items, docs, impact = rng.integers(0, 9, 4000), rng.integers(0, 70_000, 4000) // 1000 * 1000, rng.integers(1, 99, 4000)
    want = Counter()
    for i, d, s in zip(items.tolist(), docs.tolist(), impact.tolist()):
        want[i, d] += s
    i, d, s = search.accumulate(items, docs, impact, 70_000)
    assert list(zip(zip(i.tolist(), d.tolist()), s.tolist())) == sorted(want.items())


def test_heaps_keep_the_best_whatever_the_order():
    rng = random.Random(2)
    rows = [(rng.randrange(3), rng.randrange(50), rng.randrange(0, 8)) for _ in range(400)]
    heaps = search.Heaps(5)
    for a in range(0, 400, 37):
        part = np.array(sorted(rows[a : a + 37]), np.int64)
        heaps.push(part[:, 0], part[:, 1], part[:, 2])
    for item in range(3):
        want = sorted(((s, -d) for i, d, s in rows if i == item and s > 0), reverse=True)[:5]
        assert sorted(heaps.heaps[item], reverse=True) == want
