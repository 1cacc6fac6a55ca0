"""The pipeline's stages one by one on the small tables, and as a whole."""

import corpus_pipeline
from llm_helpers import SF_SMALL, make_docs, tokenizer  # noqa: F401
from test_corpus_operators import brute_classes
from test_text_operators import base_spans, brute_hits, check_pieces


def test_stages(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").toPandas().set_index("doc_id").toxic
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").toPandas()
    stages = dict(corpus_pipeline.STAGES)
    before = docs.toPandas()
    clean = stages["toxicity"](spark, docs, SF_SMALL)
    kept = clean.toPandas()
    assert list(kept.columns) == columns
    gone = set(before.doc_id) - set(kept.doc_id)
    assert all(labels.get(k, 1) == 1 for k in gone)
    clean = spark.createDataFrame(kept, docs.schema)
    one = stages["ngram_jaccard_join"](spark, clean, SF_SMALL).toPandas()
    want = brute_classes(zip(kept.doc_id, kept.text, strict=True), 5, 80)
    assert set(one.doc_id) == {k for k, (_, c) in want.items() if c == k} and list(one.columns) == columns
    apart = stages["benchmark_decontamination"](spark, spark.createDataFrame(one, docs.schema), SF_SMALL).toPandas()
    items = [(str(i), t) for i, t in zip(bench.item_id, bench.text, strict=True)]
    hits = dict(zip(one.doc_id, brute_hits(one.text, items, 10), strict=True))
    assert {k for k, (_, h, _) in hits.items() if not h} <= set(apart.doc_id)
    same = one.merge(apart, on="doc_id")
    assert all((a == b) == (hits[k][1] == 0) for k, a, b in zip(same.doc_id, same.text_x, same.text_y, strict=True))
    assert all(len(t) == n for t, n in zip(apart.text, apart.n_chars, strict=True))
    assert all(h == 0 for _, h, _ in brute_hits(apart.text, items, 10))
    safe = stages["pii"](spark, spark.createDataFrame(apart, docs.schema), SF_SMALL).toPandas()
    assert not any(base_spans(t) for t in safe.text)
    pieces = stages["packing"](spark, spark.createDataFrame(safe, docs.schema), SF_SMALL).toPandas()
    check_pieces(pieces, dict(zip(safe.doc_id, safe.text, strict=True)), tokenizer)
    whole = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    assert set(whole.doc_id) == set(pieces.doc_id) and whole.doc_tokens.sum() == pieces.doc_tokens.sum()


def test_near_duplicate_stage_keeps_rows_without_an_id(spark, make_docs):
    docs = make_docs([(1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, None), (3, None), (4, "")])
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF_SMALL).toPandas()
    assert sorted(got.doc_id.fillna(-1)) == [-1, 1, 3, 4]
