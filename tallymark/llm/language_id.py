"""Language by the nearest of several centroids per language.

A text becomes the vector of its character n-grams (1 to 3 characters, lower-cased, hashed
to 2 ** `BITS` places), with logarithmic counts weighted by inverse document frequency
and scaled to length 1. Document frequencies count every training document. Per
language, about `SAMPLE` training documents (drawn by a hash of the doc_id; at most `SHARE`
of them, all below `LEAST`) are clustered by cosine into `CLUSTERS` centroids. A text gets
the language of the nearest centroid; ties go to the language first in order.

A text is rejected where its similarity lies below the floor for its language and length
(powers of two of its n-grams): the similarity that `PASS` of the training documents
outside the draw reach, all of them counted. Where a language has fewer than `LEAST` such
documents of that length, up to two neighbouring lengths are taken in, then all languages,
then further lengths. Only with fewer than `LEAST` documents held back in all, the floor
is `FLOOR` times the similarity that 99 of 100 of the centroid's own documents reach.

A null text or one without a letter is `und`, score 0, rejected; so is every text where
nothing was learned. Rows with null lang, text or doc_id teach nothing. Repeated rows
get equal results; other columns pass through untouched. A row without doc_id isn't held out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.predicates import quoted
from tallymark.llm import texts as T
from tallymark.llm.columns import unused
from tallymark.llm.ngrams import ngram_indices
from tallymark.session import written_once

BITS, SIZES = 13, (1, 2, 3)
SAMPLE, CLUSTERS, ROUNDS, FLOOR = 600, 4, 12, 0.25
PASS, SHARE, LEAST = 0.99, 0.75, 100
LENGTHS, STEPS = 40, 1000  # lengths and similarities told apart in the floors
TOGETHER = 64  # texts whose vectors are in memory at a time
UNKNOWN = "und"
ADDED = ("lang_pred", "score", "rejected")


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # one row each
    floors: np.ndarray  # a row for each centroid, a column for each length


def counts(text: str) -> np.ndarray:
    out = np.zeros(1 << BITS, np.int64)
    for piece in ngram_indices(text, SIZES, BITS):
        out += np.bincount(piece, minlength=1 << BITS)
    return out


def unit_rows(counted: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(counted, dtype=np.float32) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, docs) over the texts of a partition; place -1 counts the documents."""
    found, docs = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found += counts(text) > 0
            docs += 1
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(found[at], docs))], names=["place", "docs"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, places, counts) of the n-grams of each text."""
    shape = pa.schema([("lang", pa.string()), ("doc_id", pa.int64()), ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
    for batch in batches:
        for lang, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "doc_id", "text")), strict=True):
            counted = counts(text)
            at = np.flatnonzero(counted)
            yield T.arrow(shape, [[lang], [doc_id], [at.astype(np.int32)], [counted[at]]])


def clusters(rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out first centroids: centroids and assignment."""
    first, nearest = [0], rows @ rows[0]
    while len(first) < min(most, len(rows)) and nearest.min() < 0.999:
        first.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, rows @ rows[first[-1]])
    centroids = rows[first]
    for _ in range(ROUNDS):
        chosen = (rows @ centroids.T).argmax(1)
        centroids = np.stack([rows[chosen == c].sum(0) if (chosen == c).any() else centroids[c] for c in range(len(centroids))])
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    return centroids, (rows @ centroids.T).argmax(1)


def _cluster(idf: np.ndarray):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        counted = np.zeros((len(rows), 1 << BITS), np.int64)
        for i, (at, n) in enumerate(zip(rows["places"], rows["counts"], strict=True)):
            counted[i, at] = n
        vectors = unit_rows(counted, idf)
        centroids, chosen = clusters(vectors, CLUSTERS)
        near = (vectors * centroids[chosen]).sum(1)
        floors = [FLOOR * float(np.quantile(near[chosen == c], 0.01)) if (chosen == c).any() else 1.0 for c in range(len(centroids))]
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "floor": floors, "centroid": [c.tolist() for c in centroids]})

    return run


def lengths(counted: np.ndarray) -> np.ndarray:
    """Length class of each row of counts: powers of two of the number of n-grams."""
    return np.minimum(np.log2(counted.sum(1) + 1).astype(np.int64), LENGTHS - 1)


def _held_back(shared):
    """(lang, length, step, docs): similarities of documents the centroids have not seen."""
    shape = pa.schema([("lang", pa.string()), ("length", pa.int64()), ("step", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, languages, centroids = shared.value
        found: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                texts = [t for t in batch.column("text")[at : at + TOGETHER].to_pylist() if any(map(str.isalpha, t))]
                if not texts:
                    continue
                counted = np.stack([counts(t) for t in texts])
                near = unit_rows(counted, idf) @ centroids.T
                steps = (near.max(1).clip(0, 1) * STEPS).astype(np.int64)
                found.update(zip((languages[c] for c in near.argmax(1)), lengths(counted).tolist(), steps.tolist(), strict=True))
        yield T.arrow(shape, [*([k[i] for k in found] for i in range(3)), list(found.values())])

    return run


def floors_of(found: pa.Table, languages: list[str]) -> np.ndarray | None:
    """Floor of each language and length; None with fewer than LEAST documents in all."""
    docs = np.zeros((len(languages), LENGTHS, STEPS + 1), np.int64)
    for row in found.to_pylist():
        docs[languages.index(row["lang"]), row["length"], row["step"]] += row["docs"]
    if docs.sum() < LEAST:
        return None
    around = lambda rows, at, k: rows[max(0, at - k) : at + k + 1].sum(0)
    floors = np.zeros((len(languages), LENGTHS))
    for i, own in enumerate(docs):
        for at in range(LENGTHS):
            tried = [(own, k) for k in range(3)] + [(docs.sum(0), k) for k in range(LENGTHS)]
            chosen = next(c for c in (around(rows, at, k) for rows, k in tried) if c.sum() >= LEAST)
            floors[i, at] = np.flatnonzero(np.cumsum(chosen) > (1 - PASS) * chosen.sum())[0] / STEPS
    return floors


def train(docs: DataFrame, learn: Column) -> Model:
    """Fit on the rows where `learn` holds; only vectors and tables of a fixed size reach the driver."""
    known = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    tallied = known.select("text").mapInArrow(_frequencies, "place long, docs long").groupBy("place").agg(F.sum("docs").alias("docs")).toArrow()
    by_place = dict(zip(tallied.column("place").to_pylist(), tallied.column("docs").to_pylist(), strict=True))
    docs_seen = by_place.pop(-1, 0)
    found = np.zeros(1 << BITS)
    found[list(by_place)] = list(by_place.values())
    idf = np.log((1 + docs_seen) / (1 + found)).astype(np.float32) + np.float32(1)
    rates = known.groupBy("lang").agg(F.when(F.count("*") < LEAST, 1.0).otherwise(F.least(F.lit(SHARE), SAMPLE / F.count("*"))).alias("rate"))
    rates = written_once(rates, "rates").withColumnRenamed("lang", "_lang")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.withColumn("draw", draw).join(rates, F.col("lang") == F.col("_lang"))
    sample = drawn.filter("draw < rate").select("lang", "doc_id", "text")
    sample = sample.mapInArrow(_sampled, "lang string, doc_id long, places array<int>, counts array<long>")
    fitted = sample.groupBy("lang").applyInPandas(_cluster(idf), "lang string, floor double, centroid array<float>").toArrow().to_pylist()
    fitted.sort(key=lambda r: r["lang"])
    languages = [r["lang"] for r in fitted]
    centroids = np.array([r["centroid"] for r in fitted], np.float32).reshape(len(fitted), 1 << BITS)
    floors = np.repeat(np.array([r["floor"] for r in fitted], float).reshape(-1, 1), LENGTHS, 1)
    if fitted:
        shared = docs.sparkSession.sparkContext.broadcast((idf, languages, centroids))
        seen = drawn.filter("draw >= rate").select("text").mapInArrow(_held_back(shared), "lang string, length long, step long, docs long")
        names = sorted(set(languages))
        own = floors_of(seen.groupBy("lang", "length", "step").agg(F.sum("docs").alias("docs")).toArrow(), names)
        if own is not None:
            floors = own[[names.index(g) for g in languages]]
    return Model(idf, languages, centroids, floors)


def _predict(model, text: int, extra: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                langs, scores, rejected = [], [], []
                texts = part.column(text).to_pylist()
                lettered = [bool(fitted.languages) and any(map(str.isalpha, t or "")) for t in texts]
                counted = [counts(t) for t, has in zip(texts, lettered, strict=True) if has]
                near = unit_rows(np.stack(counted), fitted.idf) @ fitted.centroids.T if counted else np.zeros((0, 1))
                rows = iter(zip(near, lengths(np.stack(counted)), strict=True) if counted else ())
                for has in lettered:
                    if not has:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        rejected.append(True)
                        continue
                    row, length = next(rows)
                    best = int(row.argmax())
                    langs.append(fitted.languages[best])
                    scores.append(float(min(1.0, max(0.0, row[best]))))
                    rejected.append(bool(row[best] < fitted.floors[best, length]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in extra), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=[*extra, *ADDED],
                )

    return run


def identify(docs: DataFrame, model: Model, added: Sequence[str] = ADDED) -> DataFrame:
    """All rows and columns with lang_pred, score and rejected added.

    Columns with those names are replaced; `added` gives other names.
    """
    docs = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # by number: names with a dot can't be handed to Python
    rows = docs.toDF(*map(str, range(len(docs.columns))))
    shape = rows.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")).schema
    found = rows.mapInArrow(_predict(shared, docs.columns.index("text"), rows.columns), shape)
    return found.toDF(*docs.columns, *added)


def learnable(folds: int = 3, held: int = 1) -> Column:
    return F.coalesce(T.fold("doc_id", folds) != held, F.lit(False))


def of_known_language(docs: DataFrame) -> DataFrame:
    """Documents with all their columns, without those the classifier rejects."""
    model = train(docs, learnable())
    added = unused(docs.columns, *ADDED)
    return identify(docs, model, added).filter(~F.col(added[-1])).select(*map(quoted, docs.columns))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.documents(spark, sf_dir)
    found = identify(docs.select("doc_id", "text"), train(docs, learnable()))
    return found.select("doc_id", F.coalesce(T.fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
