from stratum.llm import kneser_ney as K


def test_training_keeps_no_row_checkpoints(spark, monkeypatch):
    """Checkpoints hold rows uncompressed, some three times as much as the same columns as parquet."""
    texts = spark.createDataFrame([("a b a b c",), ("b c",), (None,)], "text string")
    monkeypatch.setattr(type(texts), "checkpoint", lambda *a, **b: (_ for _ in ()).throw(AssertionError("checkpoint")))
    model = K.train(texts)
    assert (model.tokens, model.vocabulary) == (10, 4)
