"""Columns with clashing names, rows without text or doc_id, and repeated labelled rows."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from tallymark.llm import language_id, line_dedup, quality_rules, toxicity
from tallymark.llm.columns import unused

COLUMNS = ["score", "rejected", "lang_pred", "n_lines", "n_removed", "n_runs", "kept_text", "_text", "_lines", "_doc", "_version", "_removed", "_runs", "a.b"]
RUN = "One line of words here.\nA second line of words.\nAnd a third line of words."


def test_unused_names():
    assert unused(["Score", "_score"], "score", "other", "other") == ["__score", "other", "_other"]


def test_stages_keep_columns_of_any_name(spark):
    rows = [(i, f"{RUN}\nNumber {i} alone" if i % 2 else f"Some {i} words\nof a text", "en") for i in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} "), "doc_id") for c in COLUMNS})
    for stage in (corpus_pipeline.known_language, corpus_pipeline.unrepeated_lines):
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns
        found = kept.collect()
        assert found
        for row in found:
            assert [row[c] for c in COLUMNS] == [f"{c} {row.doc_id}" for c in COLUMNS]
    assert {r.doc_id: r.text for r in found}[3] == "Number 3 alone"


def test_no_doc_id_is_not_held_out(spark, tmp_path):
    docs = [(1, RUN, "en"), (2, RUN, "fr"), (None, RUN, None), (3, None, "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for query in (language_id.op1_language_id, toxicity.op5_toxicity):
        held = {r.doc_id: r.held_out for r in query(spark, str(tmp_path)).collect()}
        assert len(held) == 4 and held[None] is False and None not in held.values()


def test_lines_of_null_text_as_in_sql(spark, tmp_path):
    docs = [(1, RUN), (2, None), (3, ""), (4, f"{RUN}\nx"), (5, " \n ")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = line_dedup.op9_line_dedup(spark, str(tmp_path))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({line_dedup.SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert dict((r[0], (r[1], r[4])) for r in want)[2] == (0, hashlib.sha256(b"").hexdigest())


def test_repeats_and_copies_are_one_draw(spark):
    words = [f"w{i}" for i in range(60)]
    good = [(i, " ".join([*words, f"d{i}"]), "en") for i in range(40)]
    rows = [*good, *[good[0]] * 9, *[(100 + i, good[1][1], "en") for i in range(9)], (200, good[1][1], "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    measured = quality_rules.measures(docs)
    assert {(r.lang, r["count"]) for r in quality_rules.distinct(measured).groupBy("lang").count().collect()} == {("en", 40), ("fr", 1)}


@pytest.mark.parametrize("copies", [1, 3])
def test_cutoffs_reject_and_repeats_prove_nothing(spark, copies):
    """With 40 good documents a risk of 0.5 can be proved; with 4, thrice each, it can't."""
    n = 40 if copies == 1 else 4
    text = lambda i, symbols: " ".join([*(f"w{i}x{j}" for j in range(60)), "#" * symbols])
    rows = [(i, text(i, 0), "en") for i in range(n) for _ in range(copies)] + [(900, text(900, 90), "en"), (901, text(901, 90), "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(n)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality_rules.quality(docs, labels, risk=0.5, error=0.05).collect()}
    assert kept[900] is (copies != 1) and kept[901] is True
    assert all(kept[i] for i in range(n))
