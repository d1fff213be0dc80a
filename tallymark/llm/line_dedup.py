"""Repeated runs of lines, found by winnowing, with DataFrame functions only.

A document is the sequence of its lines (split at \\n) that hold a word; blank lines
stand between them and are never compared or removed. Each window of `lines`
consecutive lines selects its least line hash, the rightmost of equal ones. Two
documents that share a run of at least `lines` lines select the same fingerprint
there, so only positions whose fingerprint occurs elsewhere are looked at further.
Windows that selected such a fingerprint are grouped by 128 bits of all their
lines' hashes, in place of extending matches line by line: of windows of equal lines
the first by (doc_id, line) stays, and every line covered by a later one goes.
Overlapping windows of one document count, so of one line many times in a row the
first stays.

With `words`, a run of fewer lines counts too if it holds more words than that: windows
of 1 to `lines` - 1 lines with so many words go the same way, each compared with windows
of as many lines. The pipeline's stage asks for this with `WORDS`; the query keeps to the
windows of `LINES` lines that its SQL twin defines.

No group is gathered: grouping takes minima and counts, combined before the shuffle,
and windows of a frequent fingerprint are joined with its one row, which adaptive
execution can split.

Null texts and rows without a doc_id stay as they are. Rows that repeat a doc_id with
the same text are one document and are cut alike; with another text they are documents
of their own. An empty table gives an empty table; other columns pass through, whatever
their names. The query's n_lines of a null text is 0, its kept_sha256 that of empty text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.predicates import quoted
from tallymark.llm.columns import unused
from tallymark.session import written_once

LINES, WORDS = 3, 50
ADDED = ("kept_text", "n_lines", "n_removed", "n_runs")
HAS_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column, counted: bool) -> Column:
    """Lines with a word: place among all lines, two hashes, and the number of words if asked."""
    n_words = lambda x: [F.regexp_count(x, F.lit(HAS_WORD + "+")).alias("words")] if counted else []
    place = F.transform(
        F.split(text, "\n", -1),
        lambda x, i: F.when(x.rlike(HAS_WORD), F.struct(i.alias("i"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), *n_words(x))),
    )
    return F.filter(place, lambda x: x.isNotNull())


def _windows(docs: DataFrame, size: int, words: int | None) -> DataFrame:
    """A row per window: its first line, its fingerprint, its place and its lines' hashes."""
    fewest = size if words is None else 1
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"), _lines(F.col("text"), words is not None).alias("l")).filter(F.size("l") >= fewest)
    rows = lines.select("doc_id", "version", "l", F.explode(F.sequence(F.lit(0), F.size("l") - fewest)).alias("s"))
    rows = rows.withColumn("w", F.slice("l", F.col("s") + 1, size)).drop("l")
    if words is not None:
        held = lambda n: sum((F.get("w", F.lit(i))["words"] for i in range(1, n)), F.get("w", F.lit(0))["words"])
        shorter = [F.when(held(n) > words, F.slice("w", 1, n)) for n in range(1, size)]  # null past the end
        rows = rows.withColumn("w", F.explode(F.array_compact(F.array(*shorter, F.when(F.size("w") == size, F.col("w"))))))
    least = F.array_min(F.transform("w", lambda x, j: F.struct(x["a"].alias("hash"), (-j).alias("back"))))
    rows = rows.withColumn("least", least)
    return rows.select(
        F.struct("doc_id", "version", "s").alias("window"),
        F.col("least.hash").alias("fingerprint"),
        F.struct("doc_id", "version", (F.col("s") - F.col("least.back")).alias("at")).alias("place"),
        F.xxhash64(F.col("w.a"), F.col("w.b")).alias("k1"),
        F.xxhash64(F.col("w.b"), F.col("w.a")).alias("k2"),
        F.col("w.i").alias("lines"),
    )


def repeated_windows(docs: DataFrame, size: int = LINES, words: int | None = None) -> DataFrame:
    """(doc_id, version, removed, n_runs): lines of windows that occur earlier, and their maximal runs."""
    named = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    windows = written_once(_windows(named, size, words), "windows")
    fingerprints = windows.groupBy("fingerprint").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    shared = windows.drop("place").join(fingerprints.filter("low < high").select("fingerprint"), "fingerprint")
    shared = written_once(shared.select("window", "k1", "k2", "lines"), "shared")
    first = shared.groupBy("k1", "k2").agg(F.min("window").alias("first"), F.max("window").alias("last")).filter("first < last")
    later = shared.join(first.drop("last"), ["k1", "k2"]).filter("window > first")
    found = later.groupBy("window.doc_id", "window.version").agg(F.collect_set(F.struct("window.s", "lines")).alias("found"))
    # places among the lines with a word: a run begins after one that stays
    places = F.transform("found", lambda x: F.sequence(x["s"], x["s"] + F.size(x["lines"]) - 1))
    found = found.select("doc_id", "version", F.array_distinct(F.flatten(F.col("found.lines"))).alias("removed"), F.array_distinct(F.flatten(places)).alias("at"))
    inner = F.size(F.array_intersect("at", F.transform("at", lambda x: x + 1)))
    return found.select("doc_id", "version", "removed", (F.size("at") - inner).alias("n_runs"))


def cut_lines(docs: DataFrame, size: int = LINES, words: int | None = None, added: Sequence[str] = ADDED) -> DataFrame:
    """All rows and columns, with `kept_text`, `n_lines`, `n_removed` and `n_runs` added.

    n_lines counts lines with a word, n_removed those that go, n_runs the maximal
    runs of these. Columns with those names are replaced; `added` gives other names.
    """
    docs = docs.drop(*added)
    lines, version, doc, of, gone, runs = unused((*docs.columns, *added), "_lines", "_text", "_doc", "_version", "_removed", "_runs")
    found = repeated_windows(docs, size, words).withColumnsRenamed({"doc_id": doc, "version": of, "removed": gone, "n_runs": runs})
    # split before the join: a lambda after it then reads the array, not the split
    rows = docs.withColumn(lines, F.split("text", "\n", -1)).withColumn(version, F.xxhash64("text"))
    rows = rows.join(found, (F.col("doc_id") == F.col(doc)) & (F.col(version) == F.col(of)), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.array_join(F.transform(left, lambda i: F.col(lines)[i]), "\n")
    whole = F.col(gone).isNull()
    results = [
        F.when(whole, F.col("text")).otherwise(kept),
        F.coalesce(F.size(F.filter(lines, lambda x: x.rlike(HAS_WORD))), F.lit(0)).cast("long"),
        F.when(whole, 0).otherwise(F.size(gone)).cast("long"),
        F.when(whole, 0).otherwise(F.col(runs)).cast("long"),
    ]
    return rows.select(*(quoted(c) for c in docs.columns), *(r.alias(name) for r, name in zip(results, added, strict=True)))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """Documents with their own columns and the later runs, of LINES lines or of over WORDS words, cut out of their text.

    n_chars, where there is one, follows the text. A document that loses all its
    lines goes; one that had none before stays.
    """
    text, n_lines, n_removed, n_runs = unused(docs.columns, *ADDED)
    cut = cut_lines(docs, words=WORDS, added=(text, n_lines, n_removed, n_runs))
    cut = cut.filter((F.col(n_removed) == 0) | (F.col(n_removed) < F.col(n_lines))).withColumn("text", F.col(text))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col(n_removed) == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return cut.select(*map(quoted, docs.columns))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that go from every document, and the hash of what is left."""
    cut = cut_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x, i: {'i': i, 't': x}), lambda x: regexp_matches(x.t, '[^\x20\x09-\x0D]')) AS l FROM documents
), w AS (
  SELECT doc_id, s, list_transform(l[s:s+2], lambda x: x.t) AS k, list_transform(l[s:s+2], lambda x: x.i) AS i
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS s FROM l WHERE len(l) > 2)
), later AS (
  SELECT doc_id, s, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM w) WHERE r > 1
), gone AS (SELECT DISTINCT doc_id, unnest(i) AS i FROM later),
runs AS (
  SELECT doc_id, count(*) AS n_runs FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM later) WHERE p IS NULL OR s > p + 3 GROUP BY doc_id
), left_over AS (
  SELECT t.doc_id, string_agg(t.x, chr(10) ORDER BY t.i) AS kept
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) t
  LEFT JOIN gone g ON g.doc_id = t.doc_id AND g.i = t.i WHERE g.i IS NULL GROUP BY t.doc_id
)
SELECT l.doc_id, coalesce(len(l.l), 0)::BIGINT AS n_lines, (SELECT count(*) FROM gone g WHERE g.doc_id = l.doc_id)::BIGINT AS n_removed,
  coalesce(r.n_runs, 0)::BIGINT AS n_runs, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM l LEFT JOIN runs r USING (doc_id) LEFT JOIN left_over k USING (doc_id)
"""
