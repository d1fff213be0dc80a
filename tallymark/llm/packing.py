"""Packing token ids into full sequences: concatenate and cut.

First pass: each task encodes its documents, appends the end id, and writes them with
their place in the task and the task's number. The totals of the tasks, summed up in
order, give every document its place in one long row of ids. Second pass: the row is
cut every `LENGTH` ids; a document gives one piece per sequence it touches. All
sequences but the last are full, so nothing is padded before the end. The pieces of a
sequence, by offset, are its boundary records.

The order of documents is that of the written table, so a repeated task or query plan
changes nothing once the first pass is written. A null text is empty and has the end
id only. Repeated rows, and rows without a doc_id, are packed like any other; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import texts as T
from tallymark.llm.offsets import with_base
from tallymark.llm.tokens import WORD_BPE, ENCODED_BYTES, encoder, path, with_end
from tallymark.session import written_once

LENGTH, END = 2048, 1


def _encoded(tokenizer: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, placed = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer).encode
        for batch in batches:
            for block in T.blocks(batch, most=ENCODED_BYTES):
                ids, offsets = with_end(*encode([t.decode() for t in block.texts()]), end)
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[block.rows.start : block.rows.stop],
                        pa.array(np.full(len(block.ids), part, np.int64)),
                        pa.array(placed + offsets[:-1]),
                        pa.array(np.diff(offsets)),
                        narrow(ids, offsets) if len(ids) == 0 or ids.max() < 1 << 16 else pa.array([raw[4 * a : 4 * b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "part", "place", "n", "ids"],
                )
                placed += int(offsets[-1])

    return run


def narrow(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Ids below 65,536 in two bytes each, one binary value per document."""
    raw = ids.astype("<u2").tobytes()
    return pa.array([raw[2 * a : 2 * b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())


def _cut(length: int, with_ids: bool):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = batch.column("place").to_numpy() + batch.column("base").to_numpy()
            n = batch.column("n").to_numpy()
            first = begin // length
            pieces = (begin + n - 1) // length - first + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            sequence = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            low = np.maximum(sequence * length, begin[doc])
            high = np.minimum((sequence + 1) * length, begin[doc] + n[doc])
            ids = [np.frombuffer(raw, "<u2" if len(raw) == 2 * size else "<u4") for raw, size in zip(batch.column("ids").to_pylist(), n, strict=True)]
            cut = [ids[d][a:b] for d, a, b in zip(doc, low - begin[doc], high - begin[doc], strict=True)]
            columns = [
                batch.column("doc_id").take(pa.array(doc)),
                *(pa.array(c) for c in (low - begin[doc], high - low)),
                pa.array([T.crc32_of(c) for c in cut], pa.int64()),
                *(pa.array(c) for c in (n[doc], sequence, low - sequence * length)),
            ]
            if with_ids:
                columns.append(T.list_array(np.concatenate([np.zeros(0, np.int64), *cut]).astype(np.int32), np.concatenate([[0], np.cumsum(high - low)])))
            yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END, with_ids: bool = True) -> DataFrame:
    """A row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])."""
    encode = _encoded(tokenizer or path(WORD_BPE), end)
    rows = docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, part long, place long, n long, ids binary")
    rows = with_base(written_once(rows, "token-ids"), "part", "n", "base")
    shape = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(_cut(length, with_ids), shape + ", ids array<int>" * with_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, boundaries) from pieces with ids; a group has at most one sequence's ids."""
    piece = F.struct("offset", "length", "doc_id", "start", "ids")
    rows = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    boundary = F.transform("p", lambda x: F.struct(x["offset"].alias("offset"), x["length"].alias("length"), x["doc_id"].alias("doc_id"), x["start"].alias("start")))
    return rows.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"), boundary.alias("boundaries"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(T.documents(spark, sf_dir), with_ids=False)
