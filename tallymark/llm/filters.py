"""A fixed-size bit filter over 64-bit hashes, built by Spark and read inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import texts as T

# 8 MB whatever the number of hashes; a fuller filter only lets more through.
FILTER_BITS = 26
Batches = Iterator[pa.RecordBatch]


def bit_filter(hashes: DataFrame, column: str) -> np.ndarray:
    """Packed bits, at most 2 ** FILTER_BITS, with the bit of every hash set."""
    bit = F.shiftrightunsigned(column, 64 - FILTER_BITS)
    words = (
        hashes.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63L as int))")).alias("bits"))
    )
    found = words.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each unsigned 64-bit hash may have been put in."""
    bit = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _id_hashes(batches: Batches) -> Batches:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(T.signed(T.hashes_of(batch.column("doc_id").to_numpy())))], names=["hash"])


def likely(docs: DataFrame, ids: DataFrame, then: Callable[[Batches], Batches] | None = None, shape: str | None = None) -> DataFrame:
    """Documents whose doc_id may be among the non-null ones of `ids`.

    Few others pass, so a join that follows moves little more than its result.
    `then` and its output `shape` run on them in the same task and worker.
    """
    bits = bit_filter(ids.select("doc_id").mapInArrow(_id_hashes, "hash long"), "hash")
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def passing(batches: Batches) -> Batches:
        for batch in batches:
            known = passes(shared.value, T.hashes_of(batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)))
            yield batch.filter(pa.array(known))

    if then is None:
        return docs.mapInArrow(passing, docs.schema)
    return docs.mapInArrow(lambda batches: then(passing(batches)), shape)
