"""Texts of languages that were not learned are rejected, nearly all held-out documents are not."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm import language_id
from tallymark.llm import texts as T

ITALIAN = "La vita nel piccolo paese scorreva tranquilla e gli abitanti si conoscevano tutti da molti anni. Ogni mattina il fornaio apriva la bottega prima dell'alba mentre le strade erano ancora vuote. "
POLISH = "Życie w małym miasteczku płynęło spokojnie, a wszyscy mieszkańcy znali się od wielu lat. Każdego ranka piekarz otwierał sklep przed świtem, kiedy ulice były jeszcze puste. "


def strange() -> dict[int, str]:
    draw = random.Random(2)
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9)))
    cjk = "".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(1000))
    return dict(enumerate([" ".join(word() for _ in range(200)), ITALIAN * 6, POLISH * 6, cjk, " ".join(word() for _ in range(1000))], start=-5))


@pytest.fixture(scope="module")
def docs(spark):
    return T.documents(spark, "/root/testdata/sf0.01")


def test_unlearned_languages_and_random_letters_are_rejected(spark, docs):
    texts = spark.createDataFrame(list(strange().items()), "doc_id long, text string")
    rows = language_id.identify(texts, language_id.train(docs, language_id.learnable())).collect()
    assert {r.doc_id: r.rejected for r in rows} == dict.fromkeys(strange(), True)
    # in the pipeline's stage such documents bear no language
    added = texts.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    kept = corpus_pipeline.known_language(spark, docs.select("doc_id", "text", "lang").union(added), "")
    assert kept.filter("doc_id < 0").count() == 0


def test_held_out_documents_pass(docs):
    found = language_id.identify(docs, language_id.train(docs, language_id.learnable())).filter(T.fold("doc_id", 3) == 1)
    assert found.agg(F.avg((~F.col("rejected")).cast("int"))).first()[0] > 0.96
