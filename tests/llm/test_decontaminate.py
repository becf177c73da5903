import hashlib
import random
import re

import pandas as pd
import pytest

from lumiflux.llm import decontaminate as dc

ITEMS = [(1, "The quick brown FOX jumps over the lazy dog near a river bank today"), (2, "short one"), (2, "short one"), (3, None), (4, "  ..."), (None, "short one"), (11, "Ünïcödé ß 測試 Ünïcödé")]


def plain(text, items, window=10):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, who = norm(text), set(), set()
    for i, t in items:
        iw = norm(t)
        if i is None or not iw:
            continue
        n = min(window, len(iw))
        for s in range(max(1, len(iw) - window + 1)):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == iw[s : s + n]:
                    hit.update(range(p, p + n))
                    who.add(i)
    return len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(map(str, who))).encode()).hexdigest(), bool(hit)


@pytest.fixture
def tables(spark, rows):
    texts = ["say the QUICK, brown fox jumps over the lazy dog near... a river", "a short one, a short-one", "Short", "quick brown fox jumps over"]
    docs = spark.createDataFrame([*((r[0], r[1]) for r in rows), *((100 + i, t) for i, t in enumerate(texts)), (101, texts[1])], "doc_id long, text string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_against_brute_force(tables):
    docs, items = tables
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in dc.report(docs, items).collect())
    assert got == sorted((str(r.doc_id), *plain(r.text, ITEMS)) for r in docs.collect())


def test_spans_lie_in_the_original(tables):
    docs, items = tables
    r = dc.scan(docs, items).where("doc_id = 100").first()
    text = docs.where("doc_id = 100").first().text
    assert [text[s.start : s.end] for s in r.spans] == ["the QUICK, brown fox jumps over the lazy dog near... a river"]


def test_clean_keeps_columns_and_clean_rows(spark, tables, empty):
    docs, items = tables
    kept = dc.clean(docs, items)
    assert kept.columns == docs.columns
    want = sorted(str(r.doc_id) for r in docs.collect() if not plain(r.text, ITEMS)[1])
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    nothing = items.limit(0)
    assert dc.clean(docs, nothing).count() == docs.count() and dc.report(empty, items).count() == 0


def test_random_items_against_brute_force():
    """Few words, so that windows, blocks and short items often agree in part."""
    rng = random.Random(4)
    for _ in range(150):
        text = lambda n: " ".join(rng.choices("ab", k=n)) if rng.random() < 0.5 else " ".join(rng.choices("abcdefg", k=n))
        items = [(k // 2, text(rng.randint(0, 25))) for k in range(8)]
        scanner = dc.Scanner(items)
        for _ in range(10):
            doc = text(rng.randint(0, 40))
            if rng.random() < 0.5:
                doc = f"{doc} {rng.choice(items)[1]} {doc}"
            n, ranges, who = scanner.scan(doc)
            assert (n, sum(b - a for a, b in ranges), len(who)) == plain(doc, items)[:3]
            assert hashlib.sha256(",".join(sorted(map(str, who))).encode()).hexdigest() == plain(doc, items)[3]


def test_a_large_benchmark_is_scanned_once(spark):
    """Two million words; their items come back whole from one pass, with little held a word."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(20_000)]
    items = [" ".join(rng.choices(words, k=100)) for _ in range(20_000)]
    pick = rng.sample(range(len(items)), 40)
    docs = [f"{' '.join(rng.choices(words, k=50))} {' '.join(items[i].split()[30:45])} {' '.join(rng.choices(words, k=50))}" for i in pick]
    bench = spark.createDataFrame(pd.DataFrame({"item_id": range(len(items)), "text": items}))
    got = dc.scan(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), bench)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: (r["items"], r.n_hit) for r in got.collect()} == {k: ([str(i)], 15) for k, i in enumerate(pick)}


def test_ids_may_be_strings(spark):
    got = dc.scan(spark.createDataFrame([(1, "x a short one y")], "doc_id long, text string"), spark.createDataFrame([("q-1", "Short ONE")], "item_id string, text string")).first()
    assert got["items"] == ["q-1"] and got.n_hit == 2
