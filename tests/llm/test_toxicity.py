import random
import zlib

import numpy as np
import pytest

from lumiflux.llm import toxicity as tx


def test_windows_cover_every_word():
    for n in (1, 31, 32, 33, 56, 57, 200):
        at, real, of = tx.windows(np.array([n, 5]))
        assert set(at[real & (of == 0)[:, None]].tolist()) == set(range(n))
        assert set(at[real & (of == 1)[:, None]].tolist()) == set(range(n, n + 5))


def test_gradients_match_finite_differences(monkeypatch):
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in tx.fresh().items()}
    h = tx.HIDDEN
    x, real = rng.standard_normal((6, 4, 3 * h)), np.ones((6, 4, 1))
    real[4:, 1] = 0
    weight = rng.standard_normal((6, 4, h))
    monkeypatch.setattr(np, "float32", np.float64)
    out, tape = tx.recur(x, real, p["Uf"], True)
    dx, du = tx.unroll(weight.copy(), real, p["Uf"], tape)
    for a, g in ((x, dx), (p["Uf"], du)):
        for _ in range(6):
            i = tuple(rng.integers(n) for n in a.shape)
            old = a[i]
            a[i] = old + 1e-5
            up = (tx.recur(x, real, p["Uf"], False)[0] * weight).sum()
            a[i] = old - 1e-5
            down = (tx.recur(x, real, p["Uf"], False)[0] * weight).sum()
            a[i] = old
            assert g[i] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_every_gradient_matches_finite_differences(monkeypatch):
    monkeypatch.setattr(np, "float32", np.float64)
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in tx.fresh().items()}
    d = tx.DIM_W + tx.DIM_C
    x, real = rng.standard_normal((6, 5, d)), np.ones((5, 6), bool)
    real[1, 4:] = False
    of, goal = np.array([0, 0, 1, 2, 2]), np.array([0.9, 0.1, 0.98])

    def loss():
        z = tx.forward(p, x, real)[0]
        total = 0.0
        for i, t in enumerate(goal):
            zi = z[of == i]
            q = np.exp(2 * (zi - zi.max()))
            s = float(q @ zi / q.sum())
            total += np.log1p(np.exp(-abs(s))) + max(s, 0) - t * s
        return total / len(goal)

    z, held = tx.forward(p, x, real, True)
    g, d_x = tx.backward(p, x, tx.pooled_loss(z, of, goal), held)
    assert set(g) == set(p) - {"Ew", "Ec"}
    for a, da in [*((p[k], g[k]) for k in g), (x, d_x)]:
        for _ in range(5):
            i = tuple(rng.integers(n) for n in a.shape)
            old = a[i]
            a[i] = old + 1e-5
            up = loss()
            a[i] = old - 1e-5
            down = loss()
            a[i] = old
            assert da[i] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_rows_are_summed_by_key():
    rng = np.random.default_rng(2)
    rows, keys = rng.standard_normal((50, 3)).astype(np.float32), rng.integers(0, 9, 50)
    want = np.zeros((12, 3), np.float32)
    np.add.at(want, keys, rows)
    assert np.allclose(tx.summed(rows, keys, 12), want, atol=1e-5)


def test_training_learns():
    texts, labels = ["alpha beta gamma " * 12, "delta idiot epsilon " * 12] * 8, [0, 1] * 8
    p = tx.train(texts, labels, steps=60)
    s = tx.Scorer(p).scores(texts[:2])
    assert s[0] < 0.2 < 0.8 < s[1]


def ordered(rng, n):
    """Texts of one window and their labels: the same two words, among others, in either order. Order alone tells."""
    texts, y = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randint(4, 16))]
        k = rng.randint(0, len(words))
        texts.append(" ".join([*words[:k], *(("never", "vile") if i % 2 else ("vile", "never")), *words[k:]]))
        y.append(1 - i % 2)
    return texts, np.array(y)


def test_order_alone_is_learned_by_the_recurrence():
    """A network without memory sees both orders alike and cannot pass; the trained one finds new texts."""
    rng = random.Random(11)
    p = tx.train(*(lambda t, y: (t, y.tolist()))(*ordered(rng, 600)))
    texts, y = ordered(rng, 300)
    right = lambda q: float(np.mean((tx.Scorer(q).scores(texts) >= 0.5) == y))
    assert right(p) >= 0.95
    assert right(tx.without(p, "memory")) <= 0.6
    swapped = [" ".join({"never": "vile", "vile": "never"}.get(w, w) for w in t.split()) for t in texts]
    scores = lambda t: tx.Scorer(tx.without(p, "memory")).scores(t)
    assert np.allclose(scores(texts), scores(swapped), atol=1e-4)


def test_cross_validation_measures_every_part(spark):
    """Folds that may be learned from, each found by a network fitted to the others, on given documents. Memory between
    words is what keeps clean documents clean; without attention or either input hardly anything is found."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = tx.cross_validate(docs, labels).collect()
    assert {(r.fold, r.network) for r in got} == {(f, n) for f in range(1, tx.FOLDS) for n in ("whole", *tx.PARTS)}
    total = lambda column, network: sum(r[column] for r in got if r.network == network)
    found, alarms, toxic, clean = (total(c, "whole") for c in ("found", "false_alarms", "toxic", "clean"))
    assert found >= 0.8 * toxic and alarms <= 0.05 * clean
    assert total("false_alarms", "memory") >= 4 * alarms
    assert all(total("found", part) <= 0.5 * found for part in ("attention", "words", "characters"))
    ids = {r.doc_id for r in tx.sample(docs, labels)[1].collect()}
    assert not any(zlib.crc32(str(i).encode()) % tx.FOLDS == 0 for i in ids) and toxic + clean == len(ids)


def test_measures_by_hand():
    m = tx.measures(np.array([1, 1, 0, 0, 0]), np.array([0.9, 0.4, 0.4, 0.6, 0.1]))
    assert (m["toxic"], m["found"], m["clean"], m["false_alarms"]) == (2, 1, 3, 1)
    assert m["auc"] == pytest.approx((3 + 1 + 0.5) / 6)


def test_fast_scores_equal_plain_forward():
    texts = ["good words here " * 30, "bad slur idiot", "x"] * 4
    p = tx.train(texts, [0, 1, 0] * 4, steps=5)
    got = tx.Scorer(p).scores([*texts[:3], "", None, " ,. "])
    for text, s in zip(texts[:3], got):
        ws = tx.words_of(text)
        wb, grams, n = tx.inputs(ws)
        mean = np.add.reduceat(p["Ec"][grams], np.cumsum(n) - n, axis=0) / n[:, None]
        vec = np.concatenate([p["Ew"][wb], mean], axis=1).astype(np.float32)
        at, real, _ = tx.windows(np.array([len(ws)]))
        z, _ = tx.forward(p, vec[at.T], real)
        assert s == pytest.approx(1 / (1 + np.exp(-z.max())), abs=1e-4)
    assert got[3:].tolist() == [0, 0, 0]


def test_held_out_accuracy_and_folds(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in tx.score(docs, labels).collect()}
    assert len(got) == docs.count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) >= 0.9
    assert sum(a for a, b in held if b) >= 0.5 * sum(b for _, b in held)


def test_edges(spark, docs, rows, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in tx.score(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1, 1), (1, None, 0), (2, 1, None), (None, 1, 1), (3, 0, 1)], "doc_id long, quality int, toxic int")
    got = tx.score(docs, one).collect()
    assert len(got) == len(rows) and {r.score for r in got} <= {0.0, 1.0}
    assert tx.keep(docs, none).columns == docs.columns and tx.keep(docs, none).count() == len(rows)
    assert tx.score(empty, one).count() == 0
    assert tx.cross_validate(docs, none).count() == tx.cross_validate(empty, one).count() == 0
