"""The language model learns from every training document."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.llm import language_model


def test_sequences_of_every_document_are_learned(spark):
    """Documents that a draw of about 1,000 by a hash of the doc_id leaves out teach their order, too."""
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    left_out = draw >= 1000 / 3000 + 0.1
    docs = spark.range(3000).withColumnRenamed("id", "doc_id")
    docs = docs.withColumn("text", F.when(left_out & (F.col("doc_id") % 4 == 0), F.repeat(F.lit("pa qa ra sa "), 10)).otherwise(F.repeat(F.lit("aa ba ca da "), 10)))
    asked = spark.createDataFrame([(-1, "pa qa ra sa " * 10), (-2, "qa pa sa ra " * 10)], "doc_id long, text string")
    rows = language_model.language_model_scores(docs.union(asked).repartition(3), F.col("doc_id") >= 0).filter("doc_id < 0").collect()
    score = {r.doc_id: r.score for r in rows}
    assert score[-1] > score[-2] + 20


def test_every_training_token_counts_once_a_pass(spark):
    docs = spark.range(2500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("one two three "), 5).alias("text"), (F.col("id") % 10 != 0).alias("learn"))
    chunks = docs.repartition(3).mapInArrow(
        language_model._chunks, "chunk long, doc_ids array<long>, learn array<boolean>, sizes array<long>, n_words long, words binary, counts binary, places binary"
    ).localCheckpoint()
    known = language_model.np.unique(language_model.np.frombuffer(chunks.first()["words"], "<u8"))
    tokens = language_model.trained(chunks, known)[1]
    assert sum(tokens) == language_model.EPOCHS * 2250 * 16
