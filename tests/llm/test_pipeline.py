"""The stages of the pipeline, each on its own input, against brute force."""

import corpus_pipeline
from massloom.llm import decontamination, queries, simhash_dedup


def test_stages_do_what_they_say(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == columns, name
        before, now = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in after.collect()}
        assert now and all(before[i] == r for i, r in now.items())
        if name == "quality classifier":
            scores = {r.doc_id: r.predicted for r in queries.op4_quality_classifier(spark, sf).collect()}
            assert set(now) == {i for i in before if scores[i]}
        if name == "exact dedup":
            assert len({"".join(r.text.split()) for r in now.values()}) == len(now) == len({"".join(r.text.split()) for r in before.values()})
        if name == "SimHash near-dedup":
            groups = {r.doc_id: r.component_id for r in simhash_dedup.simhash_groups(docs).collect()}
            assert set(now) == {i for i, component in groups.items() if i == component}
        if name == "benchmark decontamination":
            items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            gone = {r.doc_id for r in decontamination.find_leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
            assert set(before) - set(now) == gone
            assert not any(item in r.text for item in items for r in now.values())
        docs = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.decoded_text for r in last} == texts
    run = {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert run == {r.doc_id: r.token_ids for r in last}


def test_pipeline_of_odd_tables(spark, sf, tmp_path):
    """An empty table, and one with nulls, repeated rows and columns named like helpers."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{table}.parquet").write.parquet(f"{tmp_path}/odd/{table}.parquet")
        spark.read.parquet(f"{sf}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/none/{table}.parquet")
    docs.where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    more = docs.limit(3).selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars").unionAll(docs.limit(5))
    odd = docs.unionAll(more).unionAll(docs.limit(2).selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "n_chars"))
    odd.selectExpr("*", "1 as code", "2 as component_id", "3 as score", "4 as _row", "'x' as bytes").write.parquet(f"{tmp_path}/odd/documents.parquet")
    plain = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf).collect()}
    got = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    ids = [r.doc_id for r in got if r.doc_id is not None]
    # Labels of repeated ids teach the classifier something else, so that a few documents may stay or go.
    assert len(ids) == len(set(ids)) and len(set(ids) & set(plain)) > 0.9 * len(plain)
    assert all(r.n_tokens == plain[r.doc_id] for r in got if r.doc_id in plain)
