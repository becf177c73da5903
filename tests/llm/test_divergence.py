import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from lumiflux.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "lang string, source string, text string, term string, value long"


def plain(rows, support=30, top=50):
    """Every pair of groups compared over every kept term."""
    docs = [(lang or "", source or "", TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for lang, source, text in rows]
    df, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        df[lang].update(set(words))
        count[lang, source].update(words)
    out = []
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= support]
        v = len(kept)
        sources = sorted({s for g, s in count if g == lang})
        n = {s: {t: count[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(n[s][t] for s in sources) for t in kept}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v) for t in kept}
        ps, q = {s: p(n[s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(q[t] - ps[s][t], t) for t in kept if n[s][t] and ps[s][t] > q[t]]
            out += [(lang, s, "pair", i, -x, k + 1) for k, (x, i) in enumerate(sorted(pairs, key=lambda r: (r[0], r[1].encode())))]
            out += [(lang, s, "term", i, -x, k + 1) for k, (x, i) in enumerate(sorted(terms, key=lambda r: (r[0], r[1].encode()))[:top])]
    return sorted(out, key=str)


def some_rows():
    rng = random.Random(4)
    words = ["the", "Of", "É", "測試", "\U0001f600", "￿x", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = []
    for i in range(900):
        lang, source = rng.choice(("en", "en", "fr", None)), rng.choice(("hot", "hot", "hot", "b", "c", "é", "", None))
        liked = words[:8] if source == "hot" else words[5:] if source == "b" else words
        rows.append((lang, source, " ".join(rng.choice(liked) + rng.choice(["", "1", "-A"]) for _ in range(rng.choice((0, 1, 5, 30))))))
    rows += [("xx", "one", "rare words"), ("yy", "a", None), ("yy", "b", "few"), ("en", "mute", None), ("en", "numbers", "1 2 3"), ("fr", "long", "Of " * 50_000 + "é " * 70), *rows[:40]]
    return rows


@pytest.mark.parametrize("flush, support, top", [(divergence.FLUSH, 30, 50), (10, 30, 3), (200, 1, 50), (50, 10**6, 50)])
def test_every_pair_over_every_term_gives_the_same(spark, monkeypatch, flush, support, top):
    monkeypatch.setattr(divergence, "FLUSH", flush)
    rows = some_rows()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    got = divergence.audit(df, support, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, support, top)


def test_sql_agrees():
    rows = some_rows()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert sorted(con.sql(divergence.SQL).fetchall(), key=str) == plain(rows)


def test_divisions_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = [(9 * 10**12, 10**13, 10**6), (4 * 10**17, 9 * 10**17, 77), (0, 3, 1)]
    got = spark.createDataFrame(big, "c long, n long, v long").select(divergence.p(F.col("c"), F.col("n"), F.col("v"))).collect()
    assert sorted(r[0] for r in got) == sorted(1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in big)


def test_no_rows_and_one_source(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([("en", "a", "x y", "", 0)] * 40, SCHEMA)
    assert divergence.audit(one).count() == 0  # no other source, and no term more frequent than in the language
