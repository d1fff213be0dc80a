"""Byte strings that occur in an earlier document, by suffix sorting of candidate regions.

A byte goes if a string of `LENGTH` bytes that covers it also starts in a document with a
smaller doc_id. Strings never cross documents and are judged on the input.

1. Every string of LENGTH bytes selects one of its `GRAM`-byte grams, the last of those
   with the least hash, as its anchor; equal strings select equal anchors. Tasks send
   their anchors' hashes to hash ranges, which answer which of them occur more than once.
   Hashes travel as 4 bytes beside the range; a wrong "more than once" costs work only.
2. Around each anchor found more than once, the strings that selected it make a region
   of bytes. Equal regions become one row with their least doc_id, combined before the
   shuffle, so thousands of copies arrive as one. Steps 2 and 3 take the regions of one
   share of the anchors after the other.
3. Regions are dealt by anchor into shards of about `SHARD` bytes. A task sorts all suffixes
   of a shard by induced sorting with disk-backed queues (suffix_sort.py); neighbours that
   share LENGTH bytes or more are equal strings, and their least doc_id is the answer.
   Anchors with more than `CROWD` different regions would not fit a shard: their regions are
   cut into single strings, grouped by content.
4. Each region's rows compare their doc_id with the answers; spans are merged per document.

A null text is empty. Rows without a doc_id are neither compared nor cut. Rows that
repeat a doc_id are one document: equal to each other, never earlier than each other. An
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import texts as T
from tallymark.llm.filters import bit_filter, likely, passes
from tallymark.llm.suffix_sort import suffix_order
from tallymark.session import written_once

LENGTH, GRAM = 50, 20
CHUNK, RANGE, SHARD, CROWD, BLOCK = 1 << 24, 1 << 21, 1 << 22, 20_000, 1 << 18
TURNS = 2  # in which the regions are answered, each with its share of the anchors, so that less is on disk at once
KEY = ["doc_id", "version"]
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor places, their hashes, and the first and last start of the strings that selected each."""
    n, span = len(data), LENGTH - GRAM + 1
    if n < LENGTH:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    sums = T.prefix_sums(data)
    hashes = T.gram_hashes(sums, GRAM)
    # least hash of `span` grams from each start on, by doubling
    least, width = hashes, 1
    while 2 * width <= span:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    left = np.repeat(offsets[1:], np.diff(offsets))[: len(least)] - np.arange(len(least))
    starts = np.flatnonzero(left >= LENGTH)
    # the last gram of each string with that hash: walk back over the few candidates
    best = least[starts]
    highest = np.zeros(len(hashes) + span - 1, np.uint64)
    highest[starts + span - 1] = best
    width = 1
    while 2 * width <= span:
        highest, width = np.maximum(highest[:-width], highest[width:]), 2 * width
    highest = np.maximum(highest[: len(highest) - (span - width)], highest[span - width :])
    hit = highest == hashes
    candidates = np.flatnonzero(hit)
    chosen = np.cumsum(hit)[starts + span - 1] - 1
    wrong = np.flatnonzero(hashes[candidates[chosen]] != best)
    while len(wrong):
        chosen[wrong] -= 1
        wrong = wrong[hashes[candidates[chosen[wrong]]] != best[wrong]]
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    places = candidates[chosen[first]]
    return places, hashes[places], starts[first], starts[np.append(first[1:], len(starts)) - 1]


def distinct_anchors(places: np.ndarray, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First anchor of each hash in each document: which, how many per document, and the first for every anchor."""
    owner = np.searchsorted(offsets, places, "right") - 1
    keys = hashes ^ T.mix(owner.astype(np.uint64) + np.uint64(1))
    _, first, again = np.unique(keys, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    order = np.argsort(first, kind="stable")
    rank[order] = np.arange(len(first))
    first = first[order]
    return first, np.bincount(owner[first], minlength=len(offsets) - 1), rank[again]


def _chunks(ranges: int):
    """A row per chunk of documents: anchors per document, the range of each, and their hashes by range."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("versions", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("ranges", pa.binary())]
        + [("asked", pa.list_(pa.struct([("range", pa.int64()), ("hashes", pa.binary())])))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size = TaskContext.get().partitionId() << 32, 0, 0
        ids, versions, counts, hashes = [], [], [], []

        def row() -> pa.RecordBatch:
            found = np.concatenate(hashes)
            of = ((found >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype("<u4")
            order = np.argsort(of, kind="stable")
            low = (found[order] & np.uint64(0xFFFFFFFF)).astype("<u4")
            full, first = np.unique(of[order], return_index=True)
            asked = [{"range": int(r), "hashes": h.tobytes()} for r, h in zip(full, np.split(low, first[1:]), strict=False)]
            return T.arrow(schema, [[v] for v in (part + number, ids, versions, counts, of.tobytes(), asked)])

        for batch in batches:
            for block in T.blocks(batch, most=BLOCK):
                places, found, _, _ = anchors(block.data, block.offsets)
                rows = slice(block.rows.start, block.rows.stop)
                ids += batch.column("doc_id")[rows].to_pylist()
                versions += batch.column("version")[rows].to_pylist()
                firsts, each, _ = distinct_anchors(places, found, block.offsets)
                counts += each.tolist()
                hashes.append(found[firsts])
                size += len(block.data)
                if size >= CHUNK:
                    yield row()
                    number, size = number + 1, 0
                    ids, versions, counts, hashes = [], [], [], []
        if ids:
            yield row()

    return run


def _answers(rows: pd.DataFrame) -> pd.DataFrame:
    """For every chunk's hashes in a range, one bit each: whether it occurs more than once."""
    parts = [np.frombuffer(h, "<u4") for h in rows["hashes"]]
    hashes = np.concatenate(parts)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    bits = [np.packbits(p).tobytes() for p in np.split(twice, np.cumsum([len(p) for p in parts])[:-1])]
    return pd.DataFrame({"range": rows["range"], "chunk": rows["chunk"], "bits": bits})


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, version, bits) of documents with an anchor found more than once, a bit per anchor."""
    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("bits", pa.binary())])
    for batch in batches:
        for row in batch.to_pylist():
            of = np.frombuffer(row["ranges"], "<u4")
            order = np.argsort(of, kind="stable")
            sizes = np.unique(of, return_counts=True)[1]
            bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(row["bits"], sizes, strict=True)]
            twice = np.zeros(len(of), np.uint8)
            if bits:
                twice[order] = np.concatenate(bits)
            cut = np.split(twice, np.cumsum(row["counts"])[:-1])
            some = [i for i, c in enumerate(cut) if c.any()]
            yield T.arrow(
                schema,
                [[row["doc_ids"][i] for i in some], [row["versions"][i] for i in some], [np.packbits(cut[i]).tobytes() for i in some]],
            )


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, version, at, anchor, region) around every marked anchor."""
    for batch in batches:
        for block in T.blocks(batch, most=BLOCK):
            rows = slice(block.rows.start, block.rows.stop)
            places, hashes, first, last = anchors(block.data, block.offsets)
            _, counts, again = distinct_anchors(places, hashes, block.offsets)
            bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(batch.column("bits")[rows].to_pylist(), counts, strict=True)]
            wanted = np.flatnonzero(np.concatenate([np.zeros(0, np.uint8), *bits])[again])
            owner = np.searchsorted(block.offsets, first[wanted], "right") - 1
            raw = block.data.tobytes()
            regions = [raw[a : b + LENGTH] for a, b in zip(first[wanted], last[wanted], strict=True)]
            take = pa.array(owner + rows.start)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take),
                    batch.column("version").take(take),
                    pa.array(first[wanted] - block.offsets[owner]),
                    pa.array(T.signed(hashes[wanted])),
                    pa.array(regions, pa.binary()),
                ],
                names=[*KEY, "at", "anchor", "region"],
            )


def _least_documents(rows: pd.DataFrame) -> pd.DataFrame:
    """For the regions of a shard, the least document of each of their strings.

    An anchor's only region holds all that its strings can equal, so its own least
    document is the answer. Regions in which no document comes too late are left out.
    """
    variants = rows.groupby("anchor")["least"].transform("size").to_numpy()
    alone = rows[(variants == 1) & (rows["least"] < rows["most"]).to_numpy()]
    out = [pd.DataFrame({"anchor": alone["anchor"], "region": alone["region"], "leasts": [[x] for x in alone["least"]]})]
    rows = rows[variants > 1]
    if len(rows):
        regions = rows["region"].map(bytes).to_list()
        order, shared, row_end = suffix_order(regions)
        sizes = np.array([len(r) for r in regions])
        ends = np.cumsum(sizes + 1) - 1
        # a neighbour that shares LENGTH bytes is that long itself: groups are unbroken
        begins = np.flatnonzero(shared < LENGTH)
        docs = np.repeat(rows["least"].to_numpy(), sizes + 1)[order]
        least = np.repeat(np.minimum.reduceat(docs, begins), np.diff(np.append(begins, len(order))))
        answers = np.zeros(int(ends[-1]) + 1, np.int64)
        answers[order] = least
        spans = np.stack([ends - sizes, ends - LENGTH + 1], 1)
        low, high = (f.reduceat(answers, spans.ravel())[::2] for f in (np.minimum, np.maximum))
        late = low < rows["most"].to_numpy()
        spans[low == high, 1] = spans[low == high, 0] + 1
        rows = rows[late].assign(leasts=[answers[a:b] for a, b in spans[late]])
        out.append(rows[["anchor", "region", "leasts"]])
    return pd.concat(out)


def _answered(unique: DataFrame) -> DataFrame:
    """(anchor, region, leasts) of the regions in which some document comes late.

    leasts has a value per string, or one for all of them.
    """
    volume = unique.agg(F.sum(F.octet_length("region"))).first()[0] or 0
    shards = max(1, -(-volume // SHARD))
    crowded = written_once(unique.groupBy("anchor").count().filter(F.col("count") > CROWD).select("anchor"), "crowded")
    free_scratch()
    shape = "anchor long, region binary, leasts array<long>"
    dealt = unique.join(crowded, "anchor", "left_anti").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    sorted_out = dealt.groupBy("shard").applyInPandas(_least_documents, shape)
    strings = unique.join(crowded, "anchor", "left_semi").select("*", F.explode(F.sequence(F.lit(0), F.octet_length("region") - LENGTH)).alias("o"))
    strings = strings.withColumn("string", F.expr(f"substring(region, o + 1, {LENGTH})"))
    earliest = strings.groupBy("string").agg(F.min("least").alias("earliest"))
    cut = strings.join(earliest, "string").groupBy("anchor", "region").agg(F.max("most").alias("most"), F.sort_array(F.collect_list(F.struct("o", "earliest"))).alias("s"))
    cut = cut.select("anchor", "region", "most", F.col("s.earliest").alias("leasts")).filter(F.array_min("leasts") < F.col("most"))
    return sorted_out.unionByName(cut.drop("most"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, version, spans) with spans of (start, stop) bytes to remove, unmerged."""
    docs = docs.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("version"))
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-volume // (16 * RANGE)))
    shape = "chunk long, doc_ids array<long>, versions array<long>, counts array<long>, ranges binary, asked array<struct<range long, hashes binary>>"
    chunks = written_once(docs.mapInArrow(_chunks(ranges), shape), "chunks")
    asked = chunks.select("chunk", F.explode("asked").alias("a")).select(F.col("a.range").alias("range"), "chunk", F.col("a.hashes").alias("hashes"))
    answers = asked.groupBy("range").applyInPandas(_answers, "range long, chunk long, bits binary")
    answers = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("range", "bits"))).alias("b"))
    full = chunks.drop("asked").join(answers.select("chunk", F.col("b.bits").alias("bits")), "chunk")
    marks = written_once(full.mapInArrow(_marks, "doc_id long, version long, bits binary").dropDuplicates(KEY), "marks")
    del asked, answers, full
    free_scratch(chunks)
    texts = likely(docs, marks).join(marks, KEY)
    records = texts.mapInArrow(_regions, "doc_id long, version long, at long, anchor long, region binary")
    records = written_once(records, "regions", "zstd")  # neighbours overlap
    del texts
    free_scratch()
    name = [F.xxhash64("anchor", "region").alias("r1"), F.xxhash64(F.lit(1), "region", "anchor").alias("r2")]
    answered = []
    for turn in range(TURNS):
        some = records.filter(F.pmod("anchor", F.lit(TURNS)) == turn)
        unique = written_once(some.groupBy("anchor", "region").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")), "unique", "zstd")
        free_scratch()
        answered.append(written_once(_answered(unique).select(*name, "leasts"), "answers"))
        free_scratch(unique)
    useful = reduce(DataFrame.unionByName, answered)
    rows = records.select(*KEY, "at", (F.octet_length("region") - LENGTH + 1).alias("n"), *name).join(useful, ["r1", "r2"])
    every = F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)
    late = F.filter(F.transform("leasts", lambda x, i: F.when(x < F.col("doc_id"), i.cast("long"))), lambda x: x.isNotNull())
    found = F.when(F.size("leasts") > 1, late).when(F.col("leasts")[0] < F.col("doc_id"), every)
    rows = rows.withColumn("o", found).filter(F.size("o") > 0)
    # strings in a row become one span
    begins = F.filter("o", lambda x, i: (i == 0) | (x != F.col("o")[i - 1] + 1))
    stops = F.filter("o", lambda x, i: (i == F.size("o") - 1) | (x != F.col("o")[i + 1] - 1))
    span = F.zip_with(begins, stops, lambda a, b: F.struct((F.col("at") + a).alias("start"), (F.col("at") + b + LENGTH).alias("stop")))
    spans = written_once(rows.select(*KEY, span.alias("s")).groupBy(*KEY).agg(F.flatten(F.collect_list("s")).alias("spans")), "spans")
    del rows, useful
    free_scratch(records, *answered)
    return spans


def free_scratch(*tables: DataFrame) -> None:
    """Give back the shuffle files of frames that are gone, and the files of written tables.

    Spark removes shuffle files once the driver's garbage collector has found their
    frames unused, by default every half hour: too late for steps this large.
    """
    session = SparkSession.active()
    for table in tables:
        for file in table.inputFiles()[:1]:
            folder = session._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(session._jsc.hadoopConfiguration()).delete(folder, True)
    gc.collect()
    session._jvm.System.gc()


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.append(True, starts[1:] > stops[:-1])
    return starts[new], stops[np.append(new[1:], True)]


def _digest(with_kept: bool, touched: bool, bits):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not touched:
                ids = batch.column("doc_id")
                known = passes(bits.value, T.hashes_of(ids.fill_null(-1).to_numpy(zero_copy_only=False)))
                batch = batch.filter(pa.array(~known | ids.is_null().to_numpy(zero_copy_only=False)))
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            spans = batch.column("spans") if touched else pa.nulls(len(texts), SPANS)
            sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy()
            found = spans.flatten()
            starts, stops = (pc.struct_field(found, k).to_numpy() for k in ("start", "stop"))
            # one row of bytes for all texts, so that all spans are merged at once; a byte between keeps texts apart
            begins = np.cumsum([0] + [len(t) + 1 for t in texts])
            shift = np.repeat(begins[:-1], sizes)
            starts, stops = merged(starts + shift, stops + shift) if len(starts) else (starts, stops)
            cuts = np.searchsorted(starts, begins)
            removed = np.diff(np.append(0, np.cumsum(stops - starts))[cuts])
            out = []
            for text, begin, c, d, gone in zip(texts, begins.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), removed.tolist(), strict=False):
                kept = text
                if c < d:
                    a, b = (starts[c:d] - begin).tolist(), (stops[c:d] - begin).tolist()
                    kept = b"".join(text[i:j] for i, j in zip([0, *b], [*a, len(text)], strict=True))
                out.append((len(text), gone, d - c, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + with_kept]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=False))], names=names)

    return run


def cut_repeats(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row; kept is binary."""
    docs = docs.select("doc_id", "text")
    spans = repeated_spans(docs)
    # rows that surely have no spans don't travel
    hashes = spans.select("doc_id").mapInArrow(_hashes, "hash long")
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(hashes, "hash"))
    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    same = docs.mapInArrow(_digest(with_kept, False, bits), shape)
    named = spans.withColumnsRenamed({"doc_id": "_doc", "version": "_version"})
    rest = likely(docs.filter("doc_id is not null"), spans).withColumn("_text", F.xxhash64("text"))
    rest = rest.join(named, (F.col("doc_id") == F.col("_doc")) & (F.col("_text") == F.col("_version")), "left").select("doc_id", "text", "spans")
    return same.unionByName(rest.mapInArrow(_digest(with_kept, True, None), shape))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(T.signed(T.hashes_of(batch.column("doc_id").to_numpy())))], names=["hash"])


def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(T.documents(spark, sf_dir), with_kept=False)
