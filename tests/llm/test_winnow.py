import hashlib
import random
import re

import pytest
import xxhash

from lumiflux.llm import winnow

FULL = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(text):
    return xxhash.xxh64_intdigest(text.encode(), 42)


def rolling(text):
    """The hash rolled on by one code point at a time."""
    h, out, k = 0, [], min(winnow.K, len(text))
    for i, c in enumerate(text):
        h = (h << 1 ^ xx(c) ^ (xx(text[i - k]) << k if i >= k else 0)) & FULL
        if i >= k - 1:
            out.append(signed(h))
    return out


def plain(text):
    """(position, hash) of what is chosen."""
    h, w, out = rolling(text) if text else [], winnow.WINDOW, []
    for s in range(max(1, len(h) - w + 1) if h else 0):
        part = h[s : s + w]
        p = s + max(i for i, x in enumerate(part) if x == min(part))
        if not out or out[-1] != (p, h[p]):
            out.append((p, h[p]))
    return out


def alike(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def digest(found):
    return hashlib.sha256(f"{','.join(str(p) for p, _ in found)}|{','.join(str(h) for _, h in found)}".encode()).hexdigest()


def brute(rows):
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), -signed(xx(r[1])), r[1]))
    want = []
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = map(plain, (t, edited, after))
        want.append((str(d), len(t), hashlib.sha256(edited.encode()).hexdigest(), digest(a), digest(b), round(alike(a, b), 9), round(alike(a, c), 9)))
    return sorted(want)


def got(df):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in winnow.report(df).collect())


@pytest.mark.parametrize("rows_a_range", [512, 3])
def test_against_brute_force(spark, docs, rows, empty, monkeypatch, rows_a_range):
    monkeypatch.setattr(winnow, "RANGE_ROWS", rows_a_range)
    rng = random.Random(1)
    # Characters beyond the basic plane, few letters (ties), lengths about K and a window, repeated and missing ids.
    more = [(rng.choice([None, 50, 51, rng.randint(100, 200)]), "".join(rng.choices(letters, k=rng.choice([1, 11, 12, 13, 26, 27, 28, 29, 40, 55, 200])))) for letters in ("ab", "a", "😀😁é測x ", "abcdefghijklmnop ") for _ in range(25)]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    assert got(every) == brute([(r[0], r[1]) for r in rows] + more)
    assert winnow.report(empty).count() == 0


def test_a_text_equal_to_its_edit_has_its_fingerprint(spark):
    text = "smile 😀 and 測試 and 🎉 on " * 20
    r = winnow.report(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")).collect()
    assert len({x.fingerprint for x in r}) == 1 and all(x.near_next == 1 for x in r)
    whole = winnow.report(spark.createDataFrame([(1, "😀" * 300)], "doc_id long, text string")).first()
    assert whole.fingerprint == whole.edited_fingerprint and whole.near_edited == 1


def test_hot_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr(winnow, "RANGE_ROWS", 50)
    for hot in (None, 7):
        rows = [(hot, f"text number {i}") for i in range(1000)] + [(i, f"other {i}") for i in range(400)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        parts = [r["count"] for r in winnow.following(df).where("__guest = 0").groupBy("__part").count().collect()]
        assert len(parts) > 20 and max(parts) < 150 and sum(parts) == 1400
        assert got(df) == brute(rows)


def test_positions_guarantees_and_ties(spark):
    text = "abcdefgh" * 10 + "the quick brown fox jumps over the lazy dog again and again"
    found = winnow.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().fingerprint
    assert [(g.pos, g.hash) for g in found] == plain(text)
    n = len(text) - winnow.K + 1
    for i in range(n - winnow.WINDOW + 1):  # each window has a chosen hash
        assert any(i <= g.pos < i + winnow.WINDOW for g in found)


def test_native(docs):
    assert not re.search("Python|Pandas|ArrowEval|MapIn", winnow.report(docs)._jdf.queryExecution().toString())
