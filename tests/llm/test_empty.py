"""Empty tables give no rows, everywhere."""

from brieflight.llm import bpe, chat, decontaminate, pii, quality, urls


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert bpe.encode_digests(docs, bpe.default_path()).count() == 0
    assert bpe.encode_documents(docs, bpe.default_path()).count() == 0
    assert decontaminate.contamination(docs, benchmark).count() == 0
    assert decontaminate.drop_contaminated(docs, benchmark).count() == 0
    assert chat.parse(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert pii.redact(docs).count() == 0
    assert quality.score_documents(docs, quality.model(docs, labels)).count() == 0


def test_no_benchmark_leaves_all_clean(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, None)], "item_id long, text string")).count() == 2


def test_whole_pipeline_on_nothing(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_very_long_texts(spark):
    """Runs without spaces, endless numbers and one word again and again go through whole."""
    texts = ["a" * 200_000, "1" * 100_000, "word " * 60_000, "1.1.1." * 20_000, "x@" * 50_000]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert pii.redact(docs).count() == 5
    assert {r.doc_id: r.n_tokens for r in bpe.encode_digests(docs, bpe.default_path()).collect()}[2] == 60_000
    assert {r.doc_id: r.n_words for r in decontaminate.contamination(docs, spark.createDataFrame([(1, "word word")], "item_id long, text string")).collect()}[2] == 60_000
