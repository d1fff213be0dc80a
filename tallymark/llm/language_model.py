"""Scores of whole documents by a recurrent language model over counted words.

Counting covers all training documents. Tasks hold documents in chunks of about
`CHUNK` tokens, as places in the chunk's own sorted list of distinct word hashes. The
lists are cut by hash range and sent to the ranges, which add up the training counts of
every word and send each chunk the counts of its words back, in their order. So a
frequent word travels once a chunk, and no range or chunk holds more than a set
number of words.

The network (recurrent.py) knows the `WORDS` most frequent training tokens; all others are
one class, in which a token's share is (c + 0.1) / (n + 0.1 * (v + 1)) with n tokens and v
distinct ones of the class in training and c the token's own count. All probabilities
of a place sum to 1. It is trained on all training documents, `EPOCHS` times: in each round
every task runs truncated backpropagation over a part of its own documents from the
shared weights, and the tasks' weights are averaged, each row by the number of tokens it
learned from. Rounds of a pass take the parts between `CUTS`, small ones first, while the
weights are still far from each other. Only weights, in rows of fixed size, leave a task.
It scores every document whole, its state going from window to window.

A null text is empty: the end token alone. With nothing to learn from, every token has
the base share of an unknown one. Rows without a doc_id teach nothing. Repeated rows get
equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import texts as T
from tallymark.llm.recurrent import EPOCHS, Memory, Network
from tallymark.session import written_once

CHUNK, RANGE, WORDS = 1 << 21, 1 << 21, 2048
CUTS = (0, 1 / 16, 1 / 4, 1 / 2, 1)
PART = 1 << 18  # tokens whose values are held at once
PIECE = 256  # rows of weights that travel together
WEIGHTS = "name string, at int, uses binary, values binary"
END = np.uint64(0x5EED0F0E4D)
ADD = 0.1


def tokens(block: T.Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's words and its end, and offsets."""
    data = T.LOWER[block.data]
    words = T.words(data, block.offsets)
    hashes = T.span_hashes(T.prefix_sums(data), words.starts, words.ends)
    return np.insert(hashes, words.first[1:], END), words.first + np.arange(len(words.first))


def _values(column: pa.Array, i: int, kind: str) -> np.ndarray:
    """A binary value of a batch, read where it lies."""
    return np.frombuffer(column[i].as_buffer(), kind)


def _value(values: np.ndarray) -> pa.Array:
    """A binary column of one row, over the values where they lie."""
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, values.nbytes], np.int32)), pa.py_buffer(values)])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per chunk: its documents, its distinct words with training counts, its tokens' places among them.

    A block's tokens are held as places among its own words; only words are merged for the chunk.
    """
    schema = pa.schema(
        [("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("learn", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("n_words", pa.int64())]
        + [(n, pa.binary()) for n in ("words", "counts", "places")]
    )
    part, number = TaskContext.get().partitionId() << 32, 0
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    doc_ids, learn, sizes = [], [], []

    def row() -> pa.RecordBatch:
        words = np.unique(np.concatenate([w for w, _, _ in found])).astype("<u8")
        counts, places, at = np.zeros(len(words), "<i8"), np.empty(sum(sizes), "<u4"), 0
        for own, learned, where in found:
            among = np.searchsorted(words, own)
            counts[among] += learned
            places[at : at + len(where)] = among[where]
            at += len(where)
        return T.arrow(schema, [[part + number], [doc_ids], [learn], [sizes], [len(words)], *map(_value, (words, counts, places))])

    for batch in batches:
        for block in T.blocks(batch):
            hashes, offsets = tokens(block)
            rows = slice(block.rows.start, block.rows.stop)
            teaches, own = batch.column("learn")[rows].to_pylist(), np.diff(offsets)
            words, places = np.unique(hashes, return_inverse=True)
            found.append((words, np.bincount(places, np.repeat(teaches, own), len(words)).astype(np.int64), places.astype(np.uint32)))
            doc_ids += batch.column("doc_id")[rows].to_pylist()
            learn += teaches
            sizes += own.tolist()
            if sum(len(where) for _, _, where in found) >= CHUNK:
                yield row()
                number += 1
                found, doc_ids, learn, sizes = [], [], [], []
                T.give_back()
    if sizes:
        yield row()
    found = []
    T.give_back()


def _requests(ranges: int):
    """Each chunk's words and counts by hash range."""
    schema = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])
    borders = np.array([i * (1 << 64) // ranges for i in range(1, ranges)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, words, counts = (batch.column(c)[i].as_py() for c in ("chunk", "words", "counts"))
                cuts = np.concatenate([[0], np.searchsorted(np.frombuffer(words, "<u8"), borders), [len(words) // 8]])
                full = np.flatnonzero(np.diff(cuts))
                spans = [slice(8 * a, 8 * b) for a, b in zip(cuts[full], cuts[full + 1], strict=True)]
                yield T.arrow(schema, [full, [chunk] * len(full), [words[s] for s in spans], [counts[s] for s in spans]])
                T.give_back()

    return run


def _replies(rows: pa.Table) -> pa.Table:
    """Total training counts for every chunk's words; one row more with the range's sums and its top words."""
    T.give_back()  # of the range before
    schema = pa.schema(
        [(n, pa.int64()) for n in ("range", "chunk")] + [("counts", pa.binary())] + [(n, pa.int64()) for n in ("n", "v")] + [(n, pa.list_(pa.int64())) for n in ("top_words", "top_counts")]
    )
    batches = [b for b in rows.to_batches() if b.num_rows]
    each = [(_values(b.column("words"), i, "<u8"), _values(b.column("counts"), i, "<i8")) for b in batches for i in range(b.num_rows)]
    distinct = np.unique(np.concatenate([words for words, _ in each]))
    total = np.zeros(len(distinct), np.int64)
    for words, counts in each:
        total[np.searchsorted(distinct, words)] += counts  # a chunk's words are distinct
    top = np.lexsort((distinct, -total))[:WORDS]
    top = top[total[top] > 0]
    of_range, n = rows.column("range")[0].as_py(), len(each)
    columns = [
        [of_range] * (n + 1),
        [*rows.column("chunk").to_pylist(), -1],
        [*(total[np.searchsorted(distinct, words)].astype("<i8").tobytes() for words, _ in each), None],
        [0] * n + [int(total.sum())],
        [0] * n + [int((total > 0).sum())],
        [None] * n + [distinct[top].view(np.int64)],
        [None] * n + [total[top]],
    ]
    return pa.Table.from_batches([T.arrow(schema, columns)])


def _weights(rows: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    schema = pa.schema([("name", pa.string()), ("at", pa.int32()), ("uses", pa.binary()), ("values", pa.binary())])
    columns = [[k[0] for k in rows], [k[1] for k in rows], [u.astype("<f8").tobytes() for u, _ in rows.values()], [v.astype("<f4").tobytes() for _, v in rows.values()]]
    return T.arrow(schema, columns)


def _trained(shared, low: float, high: float, epoch: int):
    """A task's weights after training on the documents of its chunks that lie between two cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, words = shared.value
        network = network.copy()
        memory, order = Memory(network), np.argsort(words)
        tokens = np.zeros(len(words) + 1, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c) for c in batch.schema.names}
                sizes, learn = (row[c][i].values.to_numpy(zero_copy_only=False) for c in ("sizes", "learn"))
                hashes, places = _values(row["words"], i, "<u8"), _values(row["places"], i, "<u4")
                share = T.hashes_of(row["chunk"][i].as_py() + np.arange(len(sizes)) * (1 << 40)) / 2.0**64
                known, ends = symbols(hashes, words, order).astype(np.int32), np.cumsum(sizes)
                chosen = np.flatnonzero(learn & (share >= low) & ((share < high) | (high == 1)))
                docs = [known[places[ends[d] - sizes[d] : ends[d]]] for d in chosen]
                network.train(docs, epoch, memory)
                for doc in docs:
                    tokens += np.bincount(doc, minlength=len(tokens))
                del docs, known, hashes, places
                T.give_back()
        if memory.rounds:
            uses = network.uses(tokens)
            yield _weights({(n, at): (uses[n][at : at + PIECE], w[at : at + PIECE]) for n, w in network.weights.items() for at in range(0, len(w), PIECE)})

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean of each row of weights over the tasks, by the tokens it learned from; as many rows as the network has pieces."""
    sums: dict[tuple[str, int], list[np.ndarray]] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            name, at, uses, values = (batch.column(c)[i].as_py() for c in ("name", "at", "uses", "values"))
            uses = np.frombuffer(uses, "<f8")
            values = np.frombuffer(values, "<f4").reshape(len(uses), -1) * uses[:, None]
            if (name, at) in sums:
                sums[name, at][0] += uses
                sums[name, at][1] += values
            else:
                sums[name, at] = [uses.copy(), values]
    if sums:
        yield _weights({k: (u, v / np.maximum(u, 1)[:, None]) for k, (u, v) in sums.items()})


def trained(chunks: DataFrame, words: np.ndarray) -> tuple[Network, list[int]]:
    """The network after EPOCHS passes over all training documents, and the tokens of each round."""
    context = chunks.sparkSession.sparkContext
    network, tokens = Network(len(words)), []
    for epoch in range(EPOCHS if len(words) else 0):
        for low, high in zip(CUTS[:-1], CUTS[1:], strict=True):
            shared = context.broadcast((network, words))
            found = chunks.select("chunk", "learn", "sizes", "words", "places").mapInArrow(_trained(shared, low, high, epoch), WEIGHTS)
            network = network.copy()
            tokens.append(0)
            for row in found.repartition("name", "at").mapInArrow(_averaged, WEIGHTS).collect():
                uses, old = np.frombuffer(row["uses"], "<f8"), network.weights[row["name"]]
                part = old[row["at"] : row["at"] + len(uses)]
                part[uses > 0] = np.frombuffer(row["values"], "<f4").reshape(part.shape)[uses > 0]
                if row["name"] == "state" and row["at"] == 0:
                    tokens[-1] = int(uses[0])
            shared.unpersist()
    return network, tokens


def symbols(hashes: np.ndarray, words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Network symbols: rank among the known words, or their number for others."""
    if not len(words):
        return np.zeros(len(hashes), np.int64)
    at = order[np.minimum(np.searchsorted(words, hashes, sorter=order), len(words) - 1)]
    return np.where(words[at] == hashes, at, len(words))


def _scores(shared):
    names = ["doc_id", "learn", "n_tokens", "n_known", "base_score", "score"]
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, words, n, v, n_other, v_other = shared.value
        order = np.argsort(words)
        for batch in batches:
            row = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                replies, sizes = row["counts"][i].values, row["sizes"][i].values.to_numpy()
                counts = np.concatenate([_values(replies, j, "<i8") for j in range(len(replies))])
                hashes, places = _values(row["words"], i, "<u8"), _values(row["places"], i, "<u4")
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                each = lambda values: _sums(values, places, offsets)  # noqa: B023, E731
                known = symbols(hashes, words, order).astype(np.int32)
                base = np.log10((counts + ADD) / (n + ADD * (v + 1)))
                if len(words):
                    within = np.where(known < len(words), 0.0, np.log10((counts + ADD) / (n_other + ADD * (v_other + 1))))
                    score = network.score(known[places], offsets) / np.log(10) + each(within)
                else:
                    score = each(base)
                columns = [row["doc_ids"][i].values, row["learn"][i].values, sizes, each((counts > 0).astype(np.int64)), each(base), score]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
                T.give_back()

    return run


def _sums(values: np.ndarray, places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the tokens' values of each document; documents of about PART tokens at once."""
    out = np.empty(len(offsets) - 1, values.dtype)
    cuts = np.unique(np.append(np.searchsorted(offsets[:-1], np.arange(0, offsets[-1], PART)), len(out)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = np.add.reduceat(values[places[offsets[a] : offsets[b]]], offsets[a:b] - offsets[a])
    return out


def language_model_scores(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, learn, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    T.small_batches(spark)
    docs = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    shape = "chunk long, doc_ids array<long>, learn array<boolean>, sizes array<long>, n_words long, words binary, counts binary, places binary"
    chunks = written_once(docs.mapInArrow(_chunks, shape), "chunks", "zstd")  # read in every round
    ranges = max(1, -(-(chunks.agg(F.sum("n_words")).first()[0] or 0) // RANGE))
    requests = chunks.select("chunk", "words", "counts").mapInArrow(_requests(ranges), "range long, chunk long, words binary, counts binary")
    shape = "range long, chunk long, counts binary, n long, v long, top_words array<long>, top_counts array<long>"
    replies = written_once(requests.groupBy("range").applyInArrow(_replies, shape), "replies")
    heads = replies.filter("chunk = -1")
    n, v = (int(x or 0) for x in heads.agg(F.sum("n"), F.sum("v")).first())
    top = heads.select(F.explode(F.arrays_zip("top_words", "top_counts")).alias("t")).select("t.*")
    top = top.orderBy(F.desc("top_counts"), "top_words").limit(WORDS).collect()
    words = np.array([r["top_words"] for r in top], np.int64).view(np.uint64)
    network, _ = trained(chunks, words)
    model = (network, words, n, v, n - sum(r["top_counts"] for r in top), v - len(top))
    back = replies.filter("chunk <> -1").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("range", "counts"))).alias("r"))
    back = back.select("chunk", F.col("r.counts").alias("counts"))
    full = chunks.drop("counts", "n_words").join(back, "chunk")
    shape = "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double"
    scored = full.mapInArrow(_scores(spark.sparkContext.broadcast(model)), shape)
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model_scores(T.documents(spark, sf_dir), T.fold("doc_id", 10) != 0)
    return found.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
