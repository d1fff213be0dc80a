"""Token ids in files, compressed by Re-Pair grammars.

Documents are range partitioned and sorted by doc_id; each task encodes its share,
appends the end id and writes shards of about `SHARD_IDS` ids, one row each:

    part, shard      the task's number and the shard's within it; together in doc_id order
    place            ids of the part before this shard
    n_ids            ids of the shard
    doc_ids, sizes   the documents and their ids, end id included
    first_rule       id of the first nonterminal; the next rules follow
    rules            two little-endian unsigned 32-bit symbols per rule, of earlier symbols
    lengths          expansion length per rule, little-endian unsigned 32-bit
    width, symbols   the compressed row, 2 or 4 bytes a symbol, little-endian

Re-Pair replaces frequent pairs of neighbouring symbols by nonterminals until no pair is
frequent. Here one round counts all pairs, makes rules of the most frequent ones and
replaces them at once, where neighbours compete the more frequent first; what lost
is counted again in the next round. It ends when no pair occurs `LEAST` times, or after
`ROUNDS` rounds of at most `RULES` rules. Pairs may cross documents: the lengths lead to
the symbols of any span of ids, so decoding one document expands its own symbols only.

A shard holds whole documents; memory follows SHARD_IDS or the longest document. A null
text is empty and has the end id only. Rows without a doc_id come first; rows that
repeat a doc_id stand together in the order of their texts. An empty table has no
shards; other columns are ignored.
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
from tallymark.llm.tokens import BYTE_BPE, ENCODED_BYTES, encoder, path, with_end
from tallymark.session import new_work_path

END = 2
SHARD_IDS, ROUNDS, RULES, LEAST = 1 << 20, 5, 2880, 6
SHAPE = (
    "part long, shard long, place long, n_ids long, doc_ids array<long>, sizes array<long>, "
    "first_rule long, rules binary, lengths binary, width int, symbols binary"
)


def compress(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """First nonterminal, rules (one row of two symbols each) and the compressed row."""
    row = ids.astype(np.uint32)
    first = nonterminal = int(row.max()) + 1 if len(row) else 0
    rules = [np.zeros((0, 2), np.uint32)]
    for _ in range(ROUNDS):
        if len(row) < 2:
            break
        pairs = row[:-1].astype(np.uint64) << np.uint64(32) | row[1:]
        if nonterminal <= 1 << 16:  # sorts faster
            pairs = row[:-1] << np.uint32(16) | row[1:]
        pairs.sort()
        distinct = np.unique(pairs[: 1 - LEAST][pairs[: 1 - LEAST] == pairs[LEAST - 1 :]])  # those that occur LEAST times
        times = np.searchsorted(pairs, distinct, "right") - np.searchsorted(pairs, distinct)
        frequent = np.lexsort((distinct, -times))[:RULES]
        if not len(frequent):
            break
        half = np.uint64(32) if pairs.dtype == np.uint64 else np.uint32(16)
        made = distinct[frequent]
        made = np.stack([made >> half, made & ((made.dtype.type(1) << half) - made.dtype.type(1))], 1).astype(np.uint32)
        # a table of the rules' ranks, by first and second symbol; 0 stands for symbols of no rule
        begins, ends = np.zeros((2, nonterminal), np.int32)
        firsts, seconds = np.unique(made[:, 0]), np.unique(made[:, 1])
        begins[firsts] = np.arange(1, len(firsts) + 1) * (len(seconds) + 1)
        ends[seconds] = np.arange(1, len(seconds) + 1)
        worst = np.int32(len(made))
        table = np.full((len(firsts) + 1) * (len(seconds) + 1), worst)
        table[begins[made[:, 0]] + ends[made[:, 1]]] = np.arange(len(made))
        at = row.astype(np.intp)
        around = np.full(len(row) + 1, worst)  # ranks, with one that loses on either side
        around[1:-1] = table.take(begins.take(at[:-1]) + ends.take(at[1:]))
        ranks = around[1:-1]
        take = np.flatnonzero((ranks < around[:-2]) & (ranks <= around[2:]) & (ranks < worst))
        rules.append(made)
        row[take] = nonterminal + ranks[take].astype(np.uint32)
        stay = np.ones(len(row), bool)
        stay[take + 1] = False
        row = row[stay]
        nonterminal += len(frequent)
    return first, np.concatenate(rules), row


def _levels(first: int, rules: np.ndarray) -> Iterator[slice]:
    """Stretches of rules that need only the symbols before them."""
    at = 0
    while at < len(rules):
        late = rules[at:].max(1) >= first + at
        stop = at + int(late.argmax()) if late.any() else len(rules)
        yield slice(at, stop)
        at = stop


def expansion_lengths(first: int, rules: np.ndarray) -> np.ndarray:
    """Ids that each rule stands for."""
    lengths = np.ones(first + len(rules), np.int64)
    for some in _levels(first, rules):
        lengths[first + some.start : first + some.stop] = lengths[rules[some]].sum(1)
    return lengths[first:]


class Shard:
    """A shard read back; any span of its ids can be decoded by itself.

    Its rules are expanded once, level by level; a span is then looked up in one step.
    """

    def __init__(self, row: dict):
        first, rules = row["first_rule"], np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
        self.symbols = np.frombuffer(row["symbols"], f"<u{row['width']}")
        self.sizes = np.append(np.ones(first, np.int64), np.frombuffer(row["lengths"], "<u4"))
        stops = np.cumsum(self.sizes)
        self.starts = stops - self.sizes
        self.expanded = np.arange(int(stops[-1]) if len(stops) else 0, dtype=np.uint32)
        for some in _levels(first, rules):
            low, high = self.starts[first + some.start], stops[first + some.stop - 1]
            self.expanded[low:high] = self._expanded(rules[some].ravel())
        self.ends = np.cumsum(self.sizes[self.symbols])

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.sizes[symbols]
        stops = np.cumsum(sizes)
        return self.expanded[np.repeat(self.starts[symbols] - (stops - sizes), sizes) + np.arange(stops[-1])]

    def decode(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the shard."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self.ends, start, "right"), np.searchsorted(self.ends, stop, "left") + 1
        skipped = start - (self.ends[a - 1] if a else 0)
        return self._expanded(self.symbols[a:b])[skipped : skipped + stop - start]


def _shards(tokenizer: str, end: int):
    schema = pa.schema(
        [(n, pa.int64()) for n in ("part", "shard", "place", "n_ids")]
        + [("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("first_rule", pa.int64())]
        + [("rules", pa.binary()), ("lengths", pa.binary()), ("width", pa.int32()), ("symbols", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, place = TaskContext.get().partitionId(), 0, 0
        encode = encoder(tokenizer).encode
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        sizes: list[int] = []

        def written() -> pa.RecordBatch:
            first, rules, row = compress(np.concatenate(ids))
            width = 2 if first + len(rules) <= 1 << 16 else 4
            lengths = expansion_lengths(first, rules).astype("<u4").tobytes()
            values = [part, shard, place, sum(sizes), doc_ids, sizes, first, rules.astype("<u4").tobytes(), lengths, width, row.astype(f"<u{width}").tobytes()]
            return T.arrow(schema, [[v] for v in values])

        for batch in batches:
            for block in T.blocks(batch, most=2 * ENCODED_BYTES):  # a block looks all kept pieces up anew
                found, offsets = with_end(*encode([t.decode() for t in block.texts()]), end)
                ids.append(found)
                doc_ids += batch.column("doc_id")[block.rows.start : block.rows.stop].to_pylist()
                sizes += np.diff(offsets).tolist()
                if sum(map(len, ids)) >= SHARD_IDS:
                    yield written()
                    shard, place = shard + 1, place + sum(sizes)
                    ids, doc_ids, sizes = [], [], []
        if ids:
            yield written()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = END) -> None:
    """Encode all documents and write the shards to a new folder."""
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_shards(tokenizer or path(BYTE_BPE), end), SHAPE).write.parquet(folder)


def _documents(with_ids: bool):
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, offsets = Shard(row), np.concatenate([[0], np.cumsum(row["sizes"])])
                ids = shard.decode(0, row["n_ids"])
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["base"] + row["place"] + offsets[:-1]),
                    pa.array(row["sizes"], pa.int64()),
                    pa.array([T.crc32_of(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.int64()),
                ]
                if with_ids:
                    columns.append(T.list_array(ids.astype(np.int32), offsets))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files."""
    rows = with_base(spark.read.schema(SHAPE).parquet(folder), "part", "n_ids", "base")
    shape = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return rows.mapInArrow(_documents(with_ids), shape + ", ids array<int>" * with_ids)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_path(spark, "token-files")
    write_token_files(T.documents(spark, sf_dir), folder)
    return read_token_files(spark, folder, with_ids=False)
