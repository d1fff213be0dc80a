"""Benchmark passages in documents, by a prefix-filtered set join.

A benchmark item's windows are its runs of `WINDOW` consecutive words; a shorter item
is one window. A window lies in a document only if all its shingles (of `SHINGLE` words,
or of the whole window if that is shorter) do, so any one of them is a necessary prefix.
Shingles are ordered by rarity over all documents, and the rarest of each window is
joined with the documents' positions that hold it. A match must leave room for the whole
window before and after it (positional and length bounds); then the window's words are
compared one by one with the document's at that place.

Documents are read twice: to count the benchmark's shingles, and to emit the positions
of the rarest ones with the words around them. A bit filter of fixed size, broadcast,
drops most other positions inside the tasks; the joins decide.

Words are compared by 64-bit hashes, all words of a window. Null texts have no words;
a null item_id marks words but is not listed. Rows that repeat a doc_id with the same text
get equal results, with another text their own. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import texts as T
from tallymark.llm.filters import bit_filter, passes
from tallymark.session import written_once

WINDOW, SHINGLE = 10, 3
BLOCK = 1 << 18  # bytes of documents in arrays at once


def _words(block: T.Block) -> tuple[T.Words, np.ndarray]:
    """Words and their hashes."""
    data = T.LOWER[block.data]
    words = T.words(data, block.offsets, T.ALNUM)
    sums = T.prefix_sums(data)
    return words, T.span_hashes(sums, words.starts, words.ends)


def _tokens(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Shingle hash at every word; 0 where the document ends first."""
    rolled, whole = T.shingles(hashes, first, size)
    return np.where(whole, T.mix(rolled + np.uint64(size)), np.uint64(0))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, words) of every window of a block of items."""
    for batch in batches:
        for block in T.blocks(batch, "item_id"):
            words, hashes = _words(block)
            at, rows = [], []
            for i, (a, n) in enumerate(zip(words.first[:-1], words.counts, strict=True)):
                size = min(n, WINDOW)
                for s in range(a, a + n - size + 1 if n else a):
                    at.append(i + block.rows.start)
                    rows.append(T.signed(hashes[s : s + size]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(at)), pa.array(rows, pa.list_(pa.int64()))], names=["item_id", "words"]
                )


def _window_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words, offset, token, size) of every shingle of every window."""
    schema = pa.schema([("words", pa.list_(pa.int64())), ("at", pa.int32()), ("token", pa.int64()), ("size", pa.int32())])
    for batch in batches:
        lists = batch.column("words")
        if not len(lists):
            continue
        first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        hashes = lists.flatten().to_numpy().view(np.uint64)
        out: list[list] = [[], [], [], []]
        for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            size = min(SHINGLE, b - a)
            tokens = _tokens(hashes[a:b], np.array([0, b - a]), size)[: b - a - size + 1]
            out[0] += [i] * len(tokens)
            out[1] += range(len(tokens))
            out[2] += T.signed(tokens).tolist()
            out[3] += [size] * len(tokens)
        yield T.arrow(schema, [lists.take(pa.array(out[0])), *out[1:]])


def _counts(bits: np.ndarray, sizes: list[int]):
    schema = pa.schema([("token", pa.int64()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in T.blocks(batch, most=BLOCK):
                words, hashes = _words(block)
                for size in sizes:
                    tokens = _tokens(hashes, words.first, size)
                    found, times = np.unique(tokens[passes(bits, tokens) & (tokens != 0)], return_counts=True)
                    yield T.arrow(schema, [T.signed(found), times])

    return run


def _places(bits: np.ndarray, sizes: list[int]):
    """A row per document with the places of wanted shingles and the words around them."""
    place = pa.struct([("at", pa.int32()), ("token", pa.int64()), ("back", pa.int32()), ("around", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in T.blocks(batch, most=BLOCK):
                words, hashes = _words(block)
                at, size_of, token_of = [], [], []
                for size in sizes:
                    tokens = _tokens(hashes, words.first, size)
                    hit = np.flatnonzero(passes(bits, tokens) & (tokens != 0))
                    at.append(hit)
                    size_of.append(np.full(len(hit), size))
                    token_of.append(tokens[hit])
                at, size_of, token_of = (np.concatenate(x) for x in ([*at, np.zeros(0, np.int64)], [*size_of, np.zeros(0, np.int64)], [*token_of, np.zeros(0, np.uint64)]))
                order = np.argsort(at, kind="stable")
                at, size_of, token_of = at[order], size_of[order], token_of[order]
                owner = np.searchsorted(words.first, at, "right") - 1
                low = np.maximum(words.first[owner], at - (WINDOW - size_of))
                high = np.minimum(words.first[owner + 1], at + WINDOW)
                n = high - low
                ends = np.cumsum(n)
                around = hashes[np.repeat(high - ends, n) + np.arange(n.sum())]
                places = pa.StructArray.from_arrays(
                    [
                        pa.array(at - words.first[owner], pa.int32()),
                        pa.array(T.signed(token_of)),
                        pa.array(at - low, pa.int32()),
                        T.list_array(T.signed(around), np.concatenate([[0], ends])),
                    ],
                    fields=list(place),
                )
                each = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(block.ids)))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[block.rows.start : block.rows.stop],
                        batch.column("version")[block.rows.start : block.rows.stop],
                        pa.array(words.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(each, pa.int32()), places),
                    ],
                    names=["doc_id", "version", "n_words", "places"],
                )

    return run


def covered(spans: str) -> F.Column:
    """Words covered by a sorted array of (start, size)."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(acc["end"], x["start"]))).cast("long").alias("n"),
            F.greatest(acc["end"], x["start"] + x["size"]).cast("long").alias("end"),
        ),
        lambda acc: acc["n"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, version, n_words, n_hit, n_items, items, contaminated) for every row.

    n_hit counts words inside any occurrence of a window, items lists the ids of
    the items with one, sorted as text.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    windows = benchmark.select("item_id", "text").mapInArrow(_windows, f"item_id {kind}, words array<long>")
    windows = written_once(windows.select(F.col("item_id").cast("string").alias("item_id"), "words").distinct(), "windows")
    distinct = windows.select("words").distinct()
    tokens = written_once(distinct.mapInArrow(_window_tokens, "words array<long>, at int, token long, size int"), "tokens")
    sizes = sorted(r["size"] for r in tokens.select("size").distinct().collect())  # 1 to SHINGLE
    every = spark.sparkContext.broadcast(bit_filter(tokens, "token"))
    times = docs.mapInArrow(lambda batches: _counts(every.value, sizes)(batches), "token long, times long")
    times = times.groupBy("token").agg(F.sum("times").alias("times"))
    # shingles no document has are the rarest: their windows occur nowhere
    ranked = tokens.join(times, "token", "left").groupBy("words").agg(
        F.min_by(F.struct("token", "at", "times"), F.struct(F.coalesce("times", F.lit(0)), "token", "at")).alias("rarest")
    )
    prefixes = written_once(ranked.filter("rarest.times > 0").select("words", "rarest.token", F.col("rarest.at").alias("offset")), "prefixes")
    wanted = spark.sparkContext.broadcast(bit_filter(prefixes, "token"))
    shape = "doc_id long, version long, n_words long, places array<struct<at int, token long, back int, around array<long>>>"
    rows = written_once(docs.mapInArrow(lambda batches: _places(wanted.value, sizes)(batches), shape), "places")
    found = rows.select("doc_id", "version", "n_words", F.explode("places").alias("p")).select("doc_id", "version", "n_words", "p.*")
    start, size = F.col("at") - F.col("offset"), F.size("words")
    found = found.join(prefixes, "token").filter((start >= 0) & (start + size <= F.col("n_words")))
    found = found.filter(F.slice("around", F.col("back") - F.col("offset") + 1, size) == F.col("words"))
    hits = written_once(found.select("doc_id", "version", start.alias("start"), size.alias("size"), "words").distinct(), "hits")
    key = ["doc_id", "version"]
    words = hits.groupBy(*key).agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"))
    words = words.select(*key, covered("spans").alias("n_hit"))
    items = hits.select(*key, "words").distinct().join(windows, "words").select(*key, "item_id").distinct()
    items = items.groupBy(*key).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    for part in (words, items):
        part = part.withColumnsRenamed({c: f"_{c}" for c in key})
        rows = rows.join(part, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("version") == F.col("_version")), "left").drop("_doc_id", "_version")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(*key, "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), (n_hit > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents with all their columns in which no window of the benchmark occurs.

    Rows go by doc_id and text, so clean texts stay that share the doc_id, or the
    want of one, with a contaminated text.
    """
    gone = contamination(docs, benchmark).filter("contaminated")
    gone = gone.select(F.col("doc_id").alias("_gone"), F.col("version").alias("_version")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_version"]), "left_anti")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, w[s:s+n-1] AS k FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, s, w[s:s+n-1] AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw ON bw.k = dw.k),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN i USING (doc_id)
"""
