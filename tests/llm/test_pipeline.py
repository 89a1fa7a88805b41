import corpus_pipeline


def test_stages_keep_columns_and_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_copies", "personal_data", "packing"]
    _, copies = corpus_pipeline.STAGES[2]
    doubled = docs.union(docs)
    kept = copies(spark, doubled, sf)
    assert kept.columns == docs.columns and kept.count() == copies(spark, docs, sf).count() <= docs.count()
    _, private = corpus_pipeline.STAGES[3]
    row = spark.createDataFrame([(1, "write to ann.b@mail.example.org or 10.0.0.1", "en", "s", 3)], docs.schema)
    assert private(spark, row, sf).first()["text"] == "write to [email] or [ip]"
    final = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(final.columns) and final.count() > 0
