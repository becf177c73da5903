import corpus_pipeline
from lumiflux.llm import decontaminate, simhash, toxicity
from lumiflux.llm.common import table


def test_stages_do_what_they_say(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    kept = [docs.collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if name != "token_files":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs.collect())
    start, clean, single, pure, mixed, files = kept
    labels, bench = table(spark, sf, "labels"), table(spark, sf, "benchmark")
    bad = {r.doc_id for r in toxicity.score(table(spark, sf, "documents"), labels).collect() if r.predicted}
    assert {r.doc_id for r in clean} == {r.doc_id for r in start} - bad
    remaining = spark.createDataFrame(clean, table(spark, sf, "documents").schema)
    groups = {r.component_id for r in simhash.near_duplicates(remaining).collect()}
    assert {r.doc_id for r in single} == groups and len(single) == len(groups)
    scanner = decontaminate.Scanner([(r.item_id, r.text) for r in bench.collect()])
    assert {r.doc_id for r in pure} == {r.doc_id for r in single if not scanner.scan(r.text)[1]}
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in pure}
    assert sorted(r.doc_id for r in files) == sorted(r.doc_id for r in mixed)
    assert sum(r.n_tokens for r in files) == max(r.start + r.n_tokens for r in files)


def test_stages_bear_odd_rows(spark, docs):
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() > 0 and (name == "token_files" or out.columns == docs.columns)
        assert stage(spark, docs.limit(0), sf).count() == 0
