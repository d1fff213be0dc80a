"""Rows that share a doc_id, or have none, are judged by their own text."""

from __future__ import annotations

from tallymark.llm import decontamination, near_duplicates

PASSAGE = "one two three four five six seven eight nine ten"


def text(name: str, changed: int = 0) -> str:
    return " ".join([f"{name}{i}" for i in range(200)] + [f"other{changed}"] * changed)


def test_clean_texts_that_share_an_id_with_a_contaminated_one_stay(spark):
    rows = [(None, f"here {PASSAGE} there", "a"), (None, text("clean"), "b"), (7, text("plain"), "c"), (7, PASSAGE, "d"), (8, None, "e"), (None, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    benchmark = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    kept = decontamination.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.mark for r in kept.collect()) == ["b", "c", "e", "f"]


def test_texts_that_share_an_id_go_with_their_own_group(spark):
    rows = [(3, text("x"), "a"), (5, text("x", 1), "b"), (5, text("y"), "c"), (9, text("y", 1), "d"), (5, text("z"), "e"), (None, text("x"), "f"), (3, text("x"), "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    assert sorted(r.mark for r in near_duplicates.without_near_duplicates(docs).collect()) == ["a", "c", "e", "f", "g"]
    # two texts of one doc_id that are near each other: one stays
    rows = [(5, text("y"), "a"), (5, text("y", 1), "b"), (9, text("y", 2), "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    assert len({r.mark for r in near_duplicates.without_near_duplicates(docs).collect()} & {"a", "b"}) == 1
    assert near_duplicates.without_near_duplicates(docs).count() == 1
