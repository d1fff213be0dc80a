"""Quality rules whose cutoffs are chosen with a guaranteed false rejection rate.

Each rule rejects a document whose value, in whole steps, lies above a cutoff. Labelled
documents are the holdout. For every stratum (language) and rule, cutoffs are tried
from the loosest to the strictest; a cutoff passes while the exact binomial probability
of seeing at most the observed number of rejected good documents, were the true rate
above the allowed one, stays below the error level. The first failure ends the
sequence (so trying many cutoffs costs nothing), and the error level is divided by
the number of strata and rules (Bonferroni). With probability 1 - `ERROR`, no stratum
loses more than `RISK` of its good documents to all rules together. A stratum with too
few labels to prove that gets no cutoff and rejects nothing. The promise is about good
documents that pass the base rule. A draw is a document: rows that repeat a doc_id, and
exact copies within a language, count once.

Texts without words are null-safe zeros and fail the base rule. A null language is a
stratum of its own. A doc_id labelled twice counts as good only if all its labels say so;
labels without doc_id or quality are ignored. Repeated rows get equal results; other
columns are ignored. Texts of any length are measured whole; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import texts as T
from tallymark.session import written_once

RISK, ERROR, STEPS = 0.01, 0.05, 200
MIN_WORDS, MAX_REPEATED = 50, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Values in steps of 1/1000 symbols per character, 1/200 repeated lines per word,
# 1/200 repeated words per word, 1/4 character of mean word length.
RULES = {
    "symbols": ("n_symbols", "word_chars", 1000),
    "repeated_lines": ("n_dup_lines", "n_words", 200),
    "repeated_words": ("n_repeat_words", "n_words", 200),
    "long_words": ("word_chars", "n_words", 4),
}


def _per_document(block: T.Block) -> list[np.ndarray]:
    data, offsets = block.data, block.offsets
    docs = len(block.ids)

    def within(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])

    inside = T.WORD[data]
    words = T.words(data, offsets)
    sums = T.prefix_sums(data)
    # the same hash in another document must differ
    apart = T.mix(np.arange(docs, dtype=np.uint64) + np.uint64(1))

    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    # a line ends before the next break, or where its document ends
    ends = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, starts)], offsets[1:][np.searchsorted(offsets, starts, "right") - 1])
    filled = np.concatenate([[0], np.cumsum(inside)])
    real = filled[ends] > filled[starts]
    starts, ends = starts[real], ends[real]
    owner = np.searchsorted(offsets, starts, "right") - 1
    first = np.unique(T.span_hashes(sums, starts, ends) ^ apart[owner], return_index=True)[1]
    dup_lines = np.bincount(owner, minlength=docs) - np.bincount(owner[first], minlength=docs)

    rolled, whole = T.shingles(T.span_hashes(sums, words.starts, words.ends), words.first, 3)
    at = np.flatnonzero(whole)
    keys = rolled[at] ^ apart[words.owners()[at]]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    marked = np.zeros(len(words.starts) + 2, bool)
    for i in range(3):
        marked[at[twice] + i] = True
    repeated = np.diff(np.concatenate([[0], np.cumsum(marked)])[words.first])
    return [words.counts, within(inside & (data & 0xC0 != 0x80)), within(SYMBOLS[data]), dup_lines, repeated]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in T.blocks(batch):
            rows = slice(block.rows.start, block.rows.stop)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c)[rows] for c in ("doc_id", "lang", "copy")), *(pa.array(c.astype(np.int64)) for c in _per_document(block))],
                names=["doc_id", "lang", "copy", *COUNTS],
            )


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, copy, counts, base_failed) of every row; exact copies share `copy`."""
    shape = "doc_id long, lang string, copy long, " + ", ".join(f"{c} long" for c in COUNTS)
    rows = docs.select("doc_id", "text", "lang", F.xxhash64("text").alias("copy")).mapInArrow(_measure, shape)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def step(rule: str) -> Column:
    """A rule's value in whole steps, rounded up, at most STEPS."""
    part, whole, scale = RULES[rule]
    return F.least(F.lit(STEPS), F.ceil(F.col(part) * scale / F.greatest(F.col(whole), F.lit(1)))).cast("int")


def binomial_at_most(k: int, n: int, p: float) -> np.ndarray:
    """P(X <= 0), ..., P(X <= k) for X binomial(n, p), exact but for rounding."""
    i = np.arange(k)
    logs = np.concatenate([[0.0], np.cumsum(np.log((n - i) / (i + 1)) + np.log(p / (1 - p)))]) + n * np.log1p(-p)
    return np.minimum(1.0, np.cumsum(np.exp(logs)))


def strictest(rejected: np.ndarray, n: int, risk: float, error: float) -> int | None:
    """Strictest cutoff in the passing start of the sequence, loosest first.

    rejected[c] counts good documents above cutoff c.
    """
    # counts far above n * risk fail anyway
    most = min(n, int(n * risk) + 1)
    chance = np.append(binomial_at_most(most, n, risk), 1.0) if n else np.ones(1)
    chosen = None
    for cutoff in range(len(rejected) - 1, -1, -1):
        if chance[min(int(rejected[cutoff]), len(chance) - 1)] > error:
            break
        chosen = cutoff
    return chosen


def distinct(good: DataFrame) -> DataFrame:
    """(lang, counts): a row per document, and one of each exact copy within a language."""
    rows = good.groupBy("doc_id").agg(F.min(F.struct("lang", "copy", *COUNTS)).alias("d"))
    return rows.groupBy("d.lang", "d.copy").agg(F.min(F.struct(*(F.col(f"d.{c}") for c in COUNTS))).alias("d")).select("lang", "d.*")


def cutoffs(good: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, one cutoff column per rule, null for none) from measured good documents."""
    steps = [F.struct(F.lit(r).alias("rule"), step(r).alias("step")) for r in RULES]
    table = good.select("lang", F.explode(F.array(*steps)).alias("s")).groupBy("lang", "s.rule", "s.step").agg(F.count("*").alias("docs"))
    table = written_once(table, "steps")
    tests = max(1, table.select("lang").distinct().count()) * len(RULES)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        docs = np.bincount(rows["step"], rows["docs"], STEPS + 1)
        above = docs.sum() - np.cumsum(docs)
        chosen = strictest(above, int(docs.sum()), risk / len(RULES), error / tests)
        return pd.DataFrame({"lang": rows["lang"][:1], "rule": rows["rule"][:1], "cutoff": pd.array([chosen], "Int32")})

    chosen = table.groupBy("lang", "rule").applyInPandas(choose, "lang string, rule string, cutoff int")
    return chosen.groupBy(F.col("lang").alias("stratum")).pivot("rule", list(RULES)).agg(F.first("cutoff"))


def quality(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(doc_id, counts, base_failed, kept) of every row."""
    rows = written_once(measures(docs), "measures")
    marks = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = rows.join(marks.filter("quality = 1"), "doc_id", "left_semi").filter("not base_failed")
    chosen = written_once(cutoffs(distinct(good), risk, error), "cutoffs")
    judged = rows.join(chosen, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(step(rule) > F.col(rule), F.lit(False))
    return judged.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
