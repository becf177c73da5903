import random
from collections import defaultdict

import numpy as np

from lumiflux.llm import substring


SPACES = " \t\n\v\f\r"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvé") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_cuts_follow_the_rolling_hash():
    data = np.frombuffer(random.Random(0).randbytes(20_000), np.uint8) % 128
    ends, h, at, want = substring.cuts(data), 0, 0, []
    for i, b in enumerate(data.tolist()):
        h = ((h << 1) + int(substring.GEAR[b])) % (1 << 32)
        if h >> (32 - substring.MASK) == 0 and i + 1 - at >= substring.MIN or i == len(data) - 1:
            want.append(i + 1)
            at = i + 1
    assert ends == want


def test_an_insertion_moves_few_cuts():
    text = prose(random.Random(1), 3000)
    a = set(substring.chunks_of(text)[2])
    b = set(substring.chunks_of(text[:5000] + "inserted" + text[5000:])[2])
    assert len(a - b) <= 3 and len(b - a) <= 3


def test_planted_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(2)
    texts = {i: prose(rng, rng.randint(60, 400)) for i in range(400)}
    planted = set()
    for k in range(60):
        passage = prose(rng, 55)
        for i in rng.sample(range(200), 3):
            cut = rng.randint(0, len(texts[i]))
            texts[i] = texts[i][:cut] + " " + passage + " " + texts[i][cut:]
            planted.add(i)
    got = substring.report(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    found = {r.doc_id for r in got}
    assert found <= planted and len(planted - found) <= 0.02 * len(planted)


def test_no_passage_of_51_words_is_missed(spark):
    rng = random.Random(6)
    # Words of five letters on average, as in prose.
    words = ["".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.choice((2, 3, 4, 5, 5, 6, 7, 8)))) for _ in range(5000)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    texts = []
    for _ in range(600):
        passage = text(51)
        texts += [f"{text(rng.randint(10, 60))} {passage} {text(rng.randint(10, 60))}" for _ in range(2)]
    got = {r.doc_id for r in substring.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == set(range(len(texts)))


def share_found(spark, rng, passages, around):
    """Share of documents found, of pairs that share a passage."""
    texts = [f"{around(rng.randint(10, 60))}{p}{around(rng.randint(10, 60))}" for p in passages for _ in range(2)]
    return substring.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() / len(texts)


def test_passages_of_short_words_and_without_spaces(spark):
    rng = random.Random(12)
    short = ["".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(1, 4))) for _ in range(3000)]
    text = lambda n: " " + " ".join(rng.choices(short, k=n)) + " "
    assert share_found(spark, rng, [text(51) for _ in range(1500)], text) >= 0.94
    runes = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(n))
    assert share_found(spark, rng, [runes(90) for _ in range(500)], runes) >= 0.9


def plain_chunks(text):
    """Chunks by the rolling hash, byte by byte."""
    raw, out, h, at = text.encode(), [], 0, 0
    starts = [i for i in range(len(raw)) if raw[i] & 0xC0 != 0x80] + [len(raw)]
    heads = set(starts)
    for i, b in enumerate(raw):
        h = ((h << 1) + int(substring.GEAR[b])) % (1 << 32)
        n = i + 1 - at
        if i + 1 in heads and (h >> (32 - substring.MASK) == 0 and n >= substring.MIN or n >= substring.MAX or i + 1 == len(raw)):
            out.append((len(raw[:at].decode()), len(raw[: i + 1].decode()), raw[at : i + 1]))
            at = i + 1
    return out


def plain_runs(rows):
    """For each row of (doc_id, text) its runs as (start, end, copies, firsts, cut ranges)."""
    parts, seen = [plain_chunks(t or "") for _, t in rows], defaultdict(list)
    for k, (p, (d, _)) in enumerate(zip(parts, rows)):
        for a, b, x in p:
            seen[x].append(((d is None, d or 0), k, a))
    out = []
    for k, p in enumerate(parts):
        found, run = [], []
        for c in [*p, None]:
            if c is not None and len(seen[c[2]]) > 1:
                run.append(c)
                continue
            whole = rows[k][1][run[0][0] : run[-1][1]] if run else ""
            before = rows[k][1][run[0][0] - 1] if run and run[0][0] else " "
            begun = sum(c >= "\u3000" or c not in SPACES and b in SPACES for b, c in zip(before + whole, whole))
            if run and (len(whole) >= substring.RUN or begun >= substring.WORDS):
                gone = [(a, b) for a, b, x in run if min(seen[x])[1:] != (k, a)]
                cut = []
                for a, b in gone:
                    if cut and cut[-1][1] == a:
                        cut[-1] = (cut[-1][0], b)
                    else:
                        cut.append((a, b))
                firsts = sorted({min(seen[x])[0][1] for _, _, x in run if not min(seen[x])[0][0]})
                found.append((run[0][0], run[-1][1], max(len(seen[x]) for _, _, x in run), firsts, cut))
            run = []
        out.append(found)
    return out


def test_against_brute_force(spark, sf, docs, rows, empty):
    """Repeated rows, copies without doc_id, and whole documents of the smallest table."""
    one = prose(random.Random(9), 300)
    more = [(1, one), (1, one), (None, one), (None, one), (0, one[700:]), (5, one + one)]
    tables = [(docs, [(r.doc_id, r.text) for r in docs.collect()])]
    for rs in (more, [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]):
        df = spark.createDataFrame(rs, "doc_id long, text string").coalesce(1)
        tables.append((df, rs))
    for df, rs in tables:
        want = []
        for (d, _), found in zip(rs, plain_runs(rs)):
            if found:
                firsts = sorted({x for f in found for x in f[3]})
                want.append((str(d), len(found), sum(b - a for a, b, *_ in found), sum(b - a for f in found for a, b in f[4]), max(f[2] for f in found), ",".join(f"{a}:{b}" for a, b, *_ in found), firsts))
        got = [(str(r.doc_id), r.n_passages, r.repeated_chars, r.removed_chars, r.most_copies, r.passages, list(r.first_doc_ids)) for r in substring.report(df).collect()]
        assert sorted(got) == sorted(want) and want
        left = [(str(r.doc_id), r.text) for r in substring.dedup(df).collect()]
        cut = [substring.without(t, [c for f in found for c in f[4]]) if t is not None else None for (_, t), found in zip(rs, plain_runs(rs))]
        assert sorted(map(str, left)) == sorted(str((str(d), t)) for (d, _), t in zip(rs, cut))
    assert substring.report(empty).count() == 0 and substring.dedup(empty).count() == 0
    assert substring.dedup(docs).columns == docs.columns


def test_of_repeated_rows_one_stays_whole(spark):
    one = prose(random.Random(9), 300)
    for ids in ((1, 1), (None, None), (1, 2), (1, None)):
        df = spark.createDataFrame([(i, one) for i in ids], "doc_id long, text string").repartition(2)
        assert sorted(len(r.text) for r in substring.dedup(df.cache()).collect()) == [0, len(one)]


def test_removal_leaves_one_copy(spark):
    passage = prose(random.Random(4), 200)
    texts = {1: "first " + passage, 2: "second " + passage + " end", 3: passage}
    cut = {r.doc_id: [tuple(c) for c in r.cut] for r in substring.runs(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert cut[1] == [] and len(substring.without(texts[2], cut[2])) < 200 and len(substring.without(texts[3], cut[3])) < 200
    assert substring.without("abc", []) == "abc"
