"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes ratios.

A text is the set of its character n-grams (3 to 5 characters, lower-cased, hashed to
2 ** `BITS` places). Over all labelled training rows each n-gram gets the logarithm of
the ratio of its smoothed shares among toxic and other documents. The `FEATURES`
n-grams that tell most (ratio times difference of the document rates) are features;
their value is that ratio. A logistic regression over them, with L2 penalty, is
trained on at most about `SAMPLE` labelled rows of either class, drawn by a hash of the
doc_id; rows are weighted back to the classes' true sizes, so scores are probabilities.

Labelled rows are found by a join; a fixed-size bit filter over the labelled ids first
drops most other documents inside the scan, before the shuffle. The classes' sizes come
from a join of ids alone, so one pass over the joined texts both counts n-grams and lets
the drawn rows through; no labelled text is stored.

Null and empty texts get the score of no features at all. With only one class in the
labels the score is that class's smoothed share. A doc_id labelled twice is toxic if any
of its labels says so; labels without doc_id or toxic are ignored. Repeated rows get
equal results; other columns are ignored. A text of any length is read whole, piece by
piece. An empty table gives an empty table. A row without doc_id isn't held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import texts as T
from tallymark.llm.filters import likely
from tallymark.llm.ngrams import ngram_indices
from tallymark.session import written_once

BITS, SIZES = 18, (3, 4, 5)
FEATURES, SAMPLE = 1 << 13, 4000
STEPS, RATE, PENALTY, CUT = 300, 0.05, 1e-4, 0.3


@dataclass
class Model:
    weights: np.ndarray  # float32 by place, 0 for n-grams that are no feature
    bias: float


def places(text: str, wanted: np.ndarray | None = None) -> np.ndarray:
    """Distinct places of the text's n-grams, those wanted only."""
    seen = np.zeros(0, np.uint32)
    for piece in ngram_indices(text, SIZES, BITS):
        seen = np.unique(np.concatenate([seen, piece if wanted is None else piece[wanted[piece]]]))
    return seen


def _counted(rates: tuple[float, float]):
    """A partition's documents by n-gram, and its drawn rows.

    A count is (place, toxic, other), place -1 for all documents; a drawn row is
    (doc_id, text) with toxic 1 or 0 and a null place.
    """
    shape = pa.schema([("place", pa.int64()), ("toxic", pa.int64()), ("other", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 1 << BITS), np.int64)
        docs = np.zeros(2, np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for text, label in zip(batch.column("text").to_pylist(), toxic, strict=True):
                found[label, places(text or "")] += 1
                docs[label] += 1
            drawn = pa.array(batch.column("draw").to_numpy() < np.array(rates)[toxic])
            rows = batch.filter(drawn)
            if rows.num_rows:
                none = pa.nulls(rows.num_rows, pa.int64())
                yield T.arrow(shape, [none, rows.column("toxic").cast(pa.int64()), none, rows.column("doc_id"), rows.column("text")])
        at = np.flatnonzero(found.sum(0))
        columns = [np.append(at, -1), np.append(found[1, at], docs[1]), np.append(found[0, at], docs[0])]
        yield T.arrow(shape, [*map(pa.array, columns), pa.nulls(len(at) + 1, pa.int64()), pa.nulls(len(at) + 1, pa.string())])

    return run


def _vectors(wanted):
    shape = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("places", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [places(t or "", wanted.value) for t in batch.column("text").to_pylist()]
            offsets = np.cumsum([0, *map(len, found)])
            flat = np.concatenate([np.zeros(0, np.uint32), *found]).astype(np.int32)
            yield T.arrow(shape, [batch.column("doc_id"), batch.column("toxic"), T.list_array(flat, offsets)])

    return run


def regression(rows: list[np.ndarray], values: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Adam over rows of active feature numbers."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
    share = (weights * labels).sum() / weights.sum()
    theta = np.zeros(len(values) + 1)
    theta[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    scale = weights / weights.sum()
    for i in range(1, STEPS + 1):
        margin = np.bincount(owner, (theta[:-1] * values)[flat], len(rows)) + theta[-1]
        off = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) * scale
        slope = np.append(np.bincount(flat, off[owner], len(values)) * values + PENALTY * theta[:-1], off.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta -= RATE * first / (1 - 0.9**i) / (np.sqrt(second / (1 - 0.999**i)) + 1e-9)
    return theta[:-1], float(theta[-1])


def _fit(at: np.ndarray, ratios: np.ndarray, sizes: np.ndarray):
    def run(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("doc_id", kind="stable")
        labels = sample["toxic"].to_numpy()
        number = np.full(1 << BITS, -1)
        number[at] = np.arange(len(at))
        drawn = np.maximum(1, np.bincount(labels, minlength=2))
        theta, bias = regression([number[p] for p in sample["places"]], ratios, labels, (sizes / drawn)[labels])
        return pd.DataFrame({"bias": [bias], "weights": [(theta * ratios).tolist()]})

    return run


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Fit on labelled rows where `learn` holds; the driver sees counts by place only."""
    context = docs.sparkSession.sparkContext
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn)
    marks = written_once(marks.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")), "marks")
    known = likely(docs.select("doc_id"), marks).join(marks, "doc_id").groupBy("toxic").count().collect()
    sizes = np.array([sum(r["count"] for r in known if r["toxic"] == label) for label in (0, 1)])
    rates = tuple(float(SAMPLE / max(1, n)) for n in sizes)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    rows = likely(docs.select("doc_id", "text"), marks).join(marks, "doc_id").withColumn("draw", draw)
    found = rows.mapInArrow(_counted(rates), "place long, toxic long, other long, doc_id long, text string")
    found = written_once(found, "counted")
    tallied = found.filter("place is not null").groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()
    place, toxic, other = (tallied.column(c).to_numpy() for c in ("place", "toxic", "other"))
    if sizes.min() == 0:
        share = (sizes[1] + 1) / (sizes.sum() + 2)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    toxic, other, place = toxic[place >= 0], other[place >= 0], place[place >= 0]
    ratio = np.log((toxic + 1) / (toxic.sum() + len(place))) - np.log((other + 1) / (other.sum() + len(place)))
    gain = ratio * (toxic / sizes[1] - other / sizes[0])
    best = np.lexsort((place, -gain))[:FEATURES]
    at, ratios = place[best], ratio[best]
    wanted = np.zeros(1 << BITS, bool)
    wanted[at] = True
    sample = found.filter("place is null").select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")
    vectors = sample.mapInArrow(_vectors(context.broadcast(wanted)), "doc_id long, toxic int, places array<int>")
    fitted = vectors.groupBy().applyInPandas(_fit(at, ratios, sizes), "bias double, weights array<double>").first()
    weights = np.zeros(1 << BITS, np.float32)
    if fitted is None:
        return Model(weights, float(np.log(sizes[1] / sizes[0])))
    weights[at] = fitted["weights"]
    return Model(weights, fitted["bias"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = shared.value
        wanted = fitted.weights != 0
        for batch in batches:
            margins = [fitted.bias + float(fitted.weights[places(t or "", wanted)].sum()) for t in batch.column("text").to_pylist()]
            scores = 1 / (1 + np.exp(-np.clip(margins, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return found.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.documents(spark, sf_dir)
    learn = T.fold("doc_id", 4) != 2
    found = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn))
    return found.select("doc_id", F.coalesce(T.fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")
