"""Word strings that occur in an earlier document, by super-k-mers in minimiser buckets.

A word goes if a window of `WINDOW` words that covers it also starts in a document with a
smaller doc_id. Words end at ASCII white space; windows never cross documents and are
judged on the input.

1. The minimiser of a window is the first of its `GRAM`-word grams with the least hash;
   equal windows have equal minimisers. Tasks send each minimiser once a block with the
   number of its documents; those in one document only are done with.
2. A run of consecutive windows with the same minimiser is a super-k-mer and travels as one
   string of its words. Equal ones become one row with their least and greatest doc_id,
   combined before the shuffle, so thousands of copies arrive as one.
3. Super-k-mers are dealt by minimiser into buckets of about `BUCKET` bytes. In a bucket, words
   are numbered, the numbers of neighbouring strings sorted together until they stand for
   windows, and equal windows have one number: the least document of each is exact.
4. Each super-k-mer's rows compare their doc_id with the answers; spans are merged per document.

A gram in over `HOT` documents (or a 2 ** -23 share of all, if more) would fill one bucket: such
grams come last in the order of hashes, so windows around a frequent passage go to the
buckets of the rarer words beside it, and only windows within it stay, which are equal.
Which windows travel is decided before that, by the plain order. Hashes only select and
deal; a wrong "in several documents" costs work only.

A null text has no words. Rows without a doc_id are neither compared nor cut. Rows that
repeat a doc_id are one document: never earlier than each other, and cut alike if their text
is the same. A text of any length is one block at most. An empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import texts as T
from tallymark.llm.filters import bit_filter, passes
from tallymark.session import written_once

WINDOW, GRAM = 13, 5
HOT, BUCKET = 4096, 1 << 22
STRING = 128  # bytes a super-k-mer takes, about; only the number of buckets follows from it
KEY = ["doc_id", "version"]
Batches = Iterator[pa.RecordBatch]


class Windows:
    """Words, grams and windows of a block, with the plain minimiser of each window."""

    def __init__(self, block: T.Block, window: int, gram: int):
        self.words = T.words(block.data, block.offsets)
        n = len(self.words.starts)
        left = np.repeat(self.words.first[1:], self.words.counts) - np.arange(n)
        self.starts = np.flatnonzero(left >= window)
        if not len(self.starts):
            return
        self.owner = np.searchsorted(self.words.first, self.starts, "right") - 1
        hashes = T.span_hashes(T.prefix_sums(block.data), self.words.starts, self.words.ends)
        self.grams, _ = T.shingles(hashes, self.words.first, gram)
        self.span = window - gram + 1
        self.minimisers = self.grams[self.places(self.grams)]

    def places(self, order: np.ndarray) -> np.ndarray:
        """First place with the least value of `order`, among the grams of each window."""
        return self.starts + np.lib.stride_tricks.sliding_window_view(order, self.span)[self.starts].argmin(1)


def _turned(hashes: np.ndarray) -> np.ndarray:
    """The same bits in another order, for a second filter."""
    return hashes << np.uint64(26) | hashes >> np.uint64(38)


def _minimisers(window: int, gram: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for block in T.blocks(batch):
                w = Windows(block, window, gram)
                if not len(w.starts):
                    continue
                first = np.append(True, (w.minimisers[1:] != w.minimisers[:-1]) | (w.owner[1:] != w.owner[:-1]))
                found, owner = w.minimisers[first], block.ids[w.owner[first]]
                order = np.lexsort((owner, found))
                found, owner = found[order], owner[order]
                new = np.append(True, found[1:] != found[:-1])
                # rows that repeat a doc_id count once
                one = np.add.reduceat(np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])).astype(np.int64), np.flatnonzero(new))
                yield pa.RecordBatch.from_arrays([pa.array(T.signed(found[new])), pa.array(one)], names=["hash", "n"])

    return run


def _super_kmers(window: int, gram: int, shared, hot):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for block in T.blocks(batch):
                w = Windows(block, window, gram)
                if not len(w.starts):
                    continue
                travels = passes(shared.value[0], w.minimisers) & passes(shared.value[1], _turned(w.minimisers))
                if not travels.any():
                    continue
                order = w.grams >> np.uint64(1)
                if hot is not None:
                    order |= passes(hot.value, w.grams).astype(np.uint64) << np.uint64(63)
                places = w.places(order)
                at, places = w.starts[travels], places[travels]
                first = np.flatnonzero(np.append(True, (places[1:] != places[:-1]) | (at[1:] != at[:-1] + 1)))
                begin, end = at[first], at[np.append(first[1:], len(at)) - 1] + window
                low, high, raw = w.words.starts[begin], w.words.ends[end - 1], block.data.tobytes()
                owner = w.owner[travels][first]
                take = pa.array(owner + block.rows.start)
                packed = [b" ".join(raw[a:b].split()) for a, b in zip(low, high, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(take),
                        batch.column("version").take(take),
                        pa.array(begin - w.words.first[owner]),
                        pa.array(end - begin - window + 1),
                        pa.array((w.grams[places[first]] >> np.uint64(33)).astype(np.int32)),
                        pa.array(packed, pa.binary()),
                    ],
                    names=[*KEY, "at", "n", "minimiser", "packed"],
                )

    return run


def window_numbers(words: np.ndarray, window: int) -> np.ndarray:
    """Numbers of the strings of `window` words from each word on; equal strings, and only those, share one.

    Pairs of neighbouring strings are sorted and numbered, which doubles the length until
    two of them, overlapping, make a window.
    """
    size = 1
    while size < window:
        step = min(size, window - size)
        pairs = words[:-step] * (words.max() + 1) + words[step:]
        words = np.unique(pairs, return_inverse=True)[1]
        size += step
    return words


def _least_documents(window: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """For the super-k-mers of a bucket, the least document of each of their windows."""
        words = b" ".join(map(bytes, rows["packed"])).split(b" ")
        numbers = window_numbers(pd.factorize(np.array(words, object))[0].astype(np.int64), window)
        sizes = rows["packed"].map(lambda p: bytes(p).count(b" ")).to_numpy() - window + 2
        first = np.cumsum(sizes + window - 1) - (sizes + window - 1)
        row = np.repeat(np.arange(len(rows)), sizes)
        numbers = numbers[first[row] + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        docs = rows["least"].to_numpy()[row]
        order = np.argsort(numbers, kind="stable")
        begins = np.flatnonzero(np.append(True, np.diff(numbers[order]) > 0))
        least = np.empty(len(row), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(docs[order], begins), np.diff(np.append(begins, len(order))))
        found = np.split(least, np.cumsum(sizes)[:-1])
        late = [f.min() < m for f, m in zip(found, rows["most"], strict=True)]
        rows = rows.assign(leasts=[f if f.min() < f.max() else f[:1] for f in found])[late]
        return rows[["minimiser", "packed", "leasts"]]

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, version, spans) with spans of (start, stop) words to remove, unmerged."""
    docs = docs.filter("doc_id is not null and text is not null").select("doc_id", "text", F.xxhash64("text").alias("version"))
    context = docs.sparkSession.sparkContext
    counted = docs.select("doc_id", "text").mapInArrow(_minimisers(window, gram), "hash long, n long")
    counted = written_once(counted.groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 1"), "minimisers")
    total = counted.agg(F.sum("n"), F.max("n")).first()
    least_hot = max(HOT, (total[0] or 0) >> 23)
    turned = counted.select(F.expr("shiftleft(hash, 26) | shiftrightunsigned(hash, 38)").alias("hash"))
    shared = context.broadcast((bit_filter(counted, "hash"), bit_filter(turned, "hash")))
    hot = context.broadcast(bit_filter(counted.filter(F.col("n") > least_hot), "hash")) if (total[1] or 0) > least_hot else None
    # made twice, for the buckets and for the way back: that is cheaper than keeping the strings
    records = docs.mapInArrow(_super_kmers(window, gram, shared, hot), "doc_id long, version long, at long, n long, minimiser int, packed binary")
    unique = records.groupBy("minimiser", "packed").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    buckets = max(1, -(-(total[0] or 0) * STRING // BUCKET))
    dealt = unique.groupBy(F.pmod(F.xxhash64("minimiser"), F.lit(buckets)).alias("bucket"))
    answers = dealt.applyInPandas(_least_documents(window), "minimiser int, packed binary, leasts array<long>")
    name = F.xxhash64("packed").alias("name")  # with the minimiser's 31 bits
    answers = written_once(answers.select("minimiser", name, "leasts"), "answers")
    rows = records.select(*KEY, "at", "n", "minimiser", name).join(answers, ["minimiser", "name"])
    every = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    late = F.filter(F.transform("leasts", lambda x, i: F.when(x < F.col("doc_id"), i.cast("long"))), lambda x: x.isNotNull())
    rows = rows.withColumn("o", F.when(F.size("leasts") > 1, late).when(F.col("leasts")[0] < F.col("doc_id"), every)).filter(F.size("o") > 0)
    # windows in a row become one span
    begins = F.filter("o", lambda x, i: (i == 0) | (x != F.col("o")[i - 1] + 1))
    stops = F.filter("o", lambda x, i: (i == F.size("o") - 1) | (x != F.col("o")[i + 1] - 1))
    span = F.zip_with(begins, stops, lambda a, b: F.struct((F.col("at") + a).alias("start"), (F.col("at") + b + window).alias("stop")))
    return rows.select(*KEY, span.alias("s")).groupBy(*KEY).agg(F.flatten(F.collect_list("s")).alias("spans"))


def _kept(with_kept: bool, cut: bool, bits=None):
    """Digests of rows with their spans; without `cut`, of rows that surely have none, the others left out."""
    names = ["doc_id", "n_words", "n_removed", "n_runs", "kept_sha256"] + ["kept"] * with_kept
    kinds = [pa.int64()] * 4 + [pa.string()] * (1 + with_kept)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not cut:
                ids = batch.column("doc_id")
                known = passes(bits.value, T.hashes_of(ids.fill_null(-1).to_numpy(zero_copy_only=False)))
                batch = batch.filter(pa.array(~known | ids.is_null().to_numpy(zero_copy_only=False)))
            out = [[] for _ in names[1:]]
            for i, text in enumerate(batch.column("text")):
                words = (text.as_py() or "").encode().split()
                spans = batch.column("spans")[i].as_py() if cut else None
                stay = np.ones(len(words), bool)
                for span in spans or ():
                    stay[span["start"] : span["stop"]] = False
                kept = b" ".join(words if not spans else [words[j] for j in np.flatnonzero(stay)])
                runs = int((np.diff(np.append(True, stay).astype(np.int8)) == -1).sum())
                for column, value in zip(out, (len(words), len(words) - int(stay.sum()), runs, hashlib.sha256(kept).hexdigest(), kept.decode() if with_kept else None), strict=False):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds[1:], strict=True))], names=names)

    return run


def _id_hashes(batches: Batches) -> Batches:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(T.signed(T.hashes_of(batch.column("doc_id").to_numpy())))], names=["hash"])


def _likely(bits):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.filter(pa.array(passes(bits.value, T.hashes_of(batch.column("doc_id").to_numpy()))))

    return run


def cut_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_kept: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, n_runs, kept_sha256[, kept]) of every row; n_runs are maximal removed runs."""
    docs = docs.select("doc_id", "text")
    spans = written_once(repeated_spans(docs, window, gram), "spans")
    # texts that surely have no spans don't travel
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(spans.select("doc_id").mapInArrow(_id_hashes, "hash long"), "hash"))
    shape = "doc_id long, n_words long, n_removed long, n_runs long, kept_sha256 string" + ", kept string" * with_kept
    same = docs.mapInArrow(_kept(with_kept, False, bits), shape)
    rest = docs.filter("doc_id is not null").mapInArrow(_likely(bits), docs.schema).withColumn("_text", F.xxhash64("text"))
    named = spans.withColumnsRenamed({"doc_id": "_doc", "version": "_version"})
    rest = rest.join(named, (F.col("doc_id") == F.col("_doc")) & (F.col("_text") == F.col("_version")), "left").select("doc_id", "text", "spans")
    return same.unionByName(rest.mapInArrow(_kept(with_kept, True), shape))


def op11_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(T.documents(spark, sf_dir).select("doc_id", "text"), with_kept=False)


SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW}),
k AS (SELECT doc_id, i, list_slice(w, i, i + {WINDOW - 1}) AS k FROM s),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM k) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM late, (SELECT unnest(range({WINDOW})) AS j)),
g AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
r AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM gone) WHERE p IS NULL OR i > p + 1 GROUP BY doc_id),
t AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(len(g.gone), 0)::BIGINT AS n_removed, coalesce(r.n, 0)::BIGINT AS n_runs,
  sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
