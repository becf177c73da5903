import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from lumiflux.llm import license


def shingles(text):
    w = re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def plain(text, templates=None):
    have, out = shingles(text), []
    for n, t in (templates or license.TEMPLATES).items():
        want = shingles(t)
        at = [i for i, s in enumerate(have) if s in set(want)]
        reach = 2 * len(want) + license.WINDOW
        starts = {a for i in at for a in range(max(0, i - license.WINDOW + 1), i + 1) if a % license.STRIDE == 0}
        most = max((len({have[i] for i in at if a - reach <= i < a + reach}) for a in starts), default=0)
        if most / len(set(want)) >= license.CONTAINMENT:
            out.append(n)
    return sorted(out)


def test_against_brute_force(spark, docs, rows, sf, empty):
    t = list(license.TEMPLATES.values())
    more = [("x y z " * k + "\n * ".join(v.split(". ")) + " q" * k) for k, v in enumerate(t * 3)]
    more += [t[0].replace("obtain", "get"), license.TEMPLATES["mit-permission"][:150], "Released under the MIT", " ".join(t)]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(more, 500)), "doc_id long, text string"))
    every = every.unionByName(spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id + 10000 AS doc_id", "text"))
    want = sorted((str(r.doc_id), ",".join(plain(r.text))) for r in every.collect())
    got = license.report(every).collect()
    assert sorted((str(r.doc_id), r.licenses) for r in got) == want
    assert sum(r.n_licenses for r in got) > 30
    assert license.report(docs).count() == len(rows) and license.report(empty).count() == 0


def test_sql_states_the_same(spark, sf):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(duckdb.sql(license.SQL).fetchall())
    got = license.report(spark.read.parquet(f"{sf}/documents.parquet"))
    assert sorted((r.doc_id, r.n_licenses, r.licenses) for r in got.collect()) == want


def test_scattered_shingles_are_no_notice(spark):
    notice = license.TEMPLATES["gpl-3.0-notice"].split()
    parts = [" ".join(notice[i : i + 9]) for i in range(0, len(notice) - 8, 5)]
    texts = [(" fill" * 400).join(parts), " and ".join(parts), " ".join(notice)]
    got = {r.doc_id: r.licenses for r in license.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: ",".join(plain(t)) for i, t in enumerate(texts)} and got[0] == "" and got[2] == "gpl-3.0-notice"


@pytest.mark.parametrize("at_a_time", [license.INDEX, 2000])
def test_templates_from_a_table(spark, docs, monkeypatch, at_a_time):
    monkeypatch.setattr(license, "INDEX", at_a_time)
    rng = random.Random(2)
    texts = {f"t{i}": " ".join(rng.choices("one two three four five six seven eight nine ten".split(), k=30)) for i in range(200)}
    known = spark.createDataFrame([*texts.items(), ("none", ""), ("none", None), (None, "a b c d e f")], "name string, text string")
    held = [(i, f"x y {t} z") for i, t in enumerate(texts.values())]
    got = license.report(spark.createDataFrame(held, "doc_id long, text string"), known).collect()
    assert {r.doc_id: r.licenses for r in got} == {i: ",".join(plain(t, texts)) for i, t in held}
    assert license.report(docs, known.limit(0)).where("n_licenses > 0").count() == 0


def test_bands_miss_as_rarely_as_min_hashes_do(spark):
    """Pairs of windows of likeness 1/5 and 1/3 that agree in no band."""
    n = 20_000
    h = lambda x: F.xxhash64(F.col("id"), F.lit(x))
    for shared, ours, chance in ((1, 2, 0.8), (1, 0, 2 / 3)):
        common = [h(i) for i in range(shared)]
        left = spark.range(n).select("id", F.array(*common, h(10), h(11)).alias("__h"))
        right = spark.range(n).select("id", F.array(*common, *(h(20 + i) for i in range(ours))).alias("__h"))
        bands = [license.with_bands(d, F.array(F.lit(0))).select("id", "value") for d in (left, right)]
        found = bands[0].join(bands[1], ["id", "value"]).select("id").distinct().count()
        want = n * chance**license.BANDS
        assert abs(n - found - want) <= 4 * max(1.5, want**0.5)


def test_native(docs):
    plan = license.report(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapIn", plan)
