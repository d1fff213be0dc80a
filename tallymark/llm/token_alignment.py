"""Aligning the tokens of two tokenizers by the byte offsets at which tokens of both end.

Tokenizer A (byte-level, `tokenizers` library) encodes a space and the text, B
(`sentencepiece`, byte fallback) the text, to which it adds the space. Cumulative ends of each
side's tokens go into a dictionary from end to index; the intersection of the two sets of
keys, sorted, slices both id lists into groups, and each slice gives its links, every A token
with every B token in it. Special tokens' strings in a text are plain text.

Neither tokenizer joins characters across the border between a character that isn't white
space and a space, so both sides end there and a text is aligned piece by piece, a word with
the space before it; pieces seen again keep their alignment (up to `KEPT`). Text whose pieces'
tokens don't spell its bytes, on either side, has no tokens.

How many documents hold an id pair linked is counted over the corpus: a task writes a row per
`CHUNK` bytes of documents with the chunk's distinct pairs and their documents, these are summed
by pair, and each chunk gets back one answer per distinct pair. So a pair found in every
document costs one row a chunk, and no table of all pairs is sent anywhere.

Null and empty texts have no tokens. Every row is a document; rows that repeat a doc_id, or
have none, count each. Pairs tied for the highest count of their A id are all best. A longer
text makes a chunk of its own, so memory follows the longest text and its links. An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymark.llm import texts as T
from tallymark.llm.tokens import BYTE_BPE, BYTE_CHARACTERS, path
from tallymark.session import written_once

PIECE_BPE = "piece_bpe_32k.model"
CHUNK, KEPT, SHORT, RUN = 1 << 22, 200_000, 64, 100  # bytes, pieces, characters of a kept piece, pieces encoded together
BORDER = re.compile(r"(?<=\S)(?= )")
SPACE_RUN = re.compile(r"\s (?<=\s )")
RAW_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
B_BITS = 24  # an id pair is one number, B's id in the low bits
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
Batches = Iterator[pa.RecordBatch]


@dataclass
class Aligned:
    """Pieces aligned: whether tokens spell the piece, its group text, counts of A's and B's tokens, groups and links, and its linked pairs, a repeated pair again."""

    spelt: np.ndarray
    texts: list[bytes]
    counts: np.ndarray  # a row of four per piece
    first: np.ndarray  # len(texts) + 1, into pairs
    pairs: np.ndarray

    def and_then(self, other: Aligned) -> Aligned:
        return Aligned(
            np.concatenate([self.spelt, other.spelt]), self.texts + other.texts, np.concatenate([self.counts, other.counts]),
            np.concatenate([self.first, self.first[-1] + other.first[1:]]), np.concatenate([self.pairs, other.pairs]),
        )

    def only(self, chosen: np.ndarray) -> Aligned:
        sizes = np.diff(self.first)[chosen]
        at, _ = spread(self.first[:-1][chosen], sizes)
        return Aligned(self.spelt[chosen], [self.texts[i] for i in chosen.tolist()], self.counts[chosen], np.append(0, np.cumsum(sizes)), self.pairs[at])


def spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of runs of `sizes` from `starts`, and the run of each place."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(run)) + (starts - (np.cumsum(sizes) - sizes))[run], run


def linked(a: np.ndarray, b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token in one slice, and the slice of each."""
    at, of = spread(np.zeros(len(n_a), np.int64), n_a * n_b)
    return a[starts_a[of] + at // n_b[of]] << B_BITS | b[starts_b[of] + at % n_b[of]], of


class Aligner:
    """Aligns whole texts; one a process."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in BYTE_CHARACTERS.items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := RAW_BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.a_sizes, self.b_sizes = ([len(x) for x in side] for side in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = ([str(i) for i in range(len(side))] for side in (self.a_bytes, self.b_bytes))
        self.b_space = [self.b.piece_to_id("▁")]
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.kept = Aligned(np.zeros(0, bool), [], np.zeros((0, 4), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64))
        self.once: set[str] = set()

    @staticmethod
    def pieces(text: str) -> list[str]:
        """A space and the text, cut before every space that follows no white space."""
        if SPACE_RUN.search(" " + text):
            return BORDER.split(" " + text)
        return [" " + p for p in text.split(" ")]

    def _ids(self, texts: list[str]) -> list[tuple[list[int], list[int], bool]]:
        """Both sides' ids of texts that begin with a space, and whether both spell the text."""
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B adds the space; of nothing it would make nothing
        b = [ids or self.b_space for ids in self.b.encode([t[1:] for t in texts], num_threads=1)]
        spell = lambda ids, spelling: b"".join(map(spelling.__getitem__, ids))
        return [(x, y, spell(x, self.a_bytes) == t.encode() == spell(y, self.b_bytes)) for x, y, t in zip(a, b, texts, strict=True)]

    def _encoded(self, pieces: list[str]) -> Iterator[tuple[int, int, list[int], list[int]]]:
        """Runs of pieces that both sides spell, as first, last and both sides' ids.

        Pieces are encoded together, up to RUN or to one that ends with white space.
        """
        runs, at = [], 0
        while at < len(pieces):
            stop = at + 1
            while stop < min(at + RUN, len(pieces)) and not pieces[stop - 1][-1].isspace():
                stop += 1
            runs.append((at, stop))
            at = stop
        for (at, stop), (a, b, spelt) in zip(runs, self._ids(["".join(pieces[i:j]) for i, j in runs]), strict=True):
            if spelt:
                yield at, stop, a, b
            else:
                yield from ((i, i + 1, a, b) for i, (a, b, alone) in enumerate(self._ids(pieces[at:stop]), at) if alone)

    def aligned(self, pieces: list[str]) -> Aligned:
        """The pieces laid end to end and aligned; both sides end where a piece does."""
        sizes = np.array([len(p.encode()) for p in pieces], np.int64)
        spelt, offset = np.zeros(len(pieces), bool), 0
        all_a, all_b, to_a, to_b, groups, common = [], [], [], [], [], [np.zeros(0, np.int64)]
        for at, stop, a, b in self._encoded(pieces):
            ends_a = dict(zip(accumulate(map(self.a_sizes.__getitem__, a)), count(1), strict=False))
            ends_b = dict(zip(accumulate(map(self.b_sizes.__getitem__, b)), count(1), strict=False))
            ends = sorted(ends_a.keys() & ends_b.keys())
            cut_a, cut_b = (list(map(x.__getitem__, ends)) for x in (ends_a, ends_b))
            names_a, names_b = list(map(self.a_names.__getitem__, a)), list(map(self.b_names.__getitem__, b))
            groups += [f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}" for i, j, k, m in zip([0, *cut_a], cut_a, [0, *cut_b], cut_b, strict=False)]
            to_a.append(np.array(cut_a, np.int64) + len(all_a))
            to_b.append(np.array(cut_b, np.int64) + len(all_b))
            common.append(np.array(ends, np.int64) + offset)
            all_a += a
            all_b += b
            spelt[at:stop] = True
            offset += ends[-1]
        common = np.concatenate(common)
        a, b = np.array(all_a, np.int64), np.array(all_b, np.int64)
        stops_a, stops_b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (to_a, to_b))
        starts_a, starts_b = np.append(0, stops_a)[:-1], np.append(0, stops_b)[:-1]
        size_a, size_b = stops_a - starts_a, stops_b - starts_b
        pairs, of = linked(a, b, starts_a, starts_b, size_a, size_b)
        # groups up to each piece's end; a piece that isn't spelt has none
        last = np.searchsorted(common, np.cumsum(np.where(spelt, sizes, 0)), "right")
        n_groups = np.diff(last, prepend=0)
        n_a, n_b = (np.diff(np.append(0, x)[last], prepend=0) for x in (stops_a, stops_b))
        piece = np.repeat(np.arange(len(pieces)), n_groups)
        n_links = np.bincount(piece[of], minlength=len(pieces))
        ends = np.cumsum(n_groups).tolist()
        texts = [";".join(groups[i:j]).encode() for i, j in zip([0, *ends], ends, strict=False)]
        return Aligned(spelt, texts, np.stack([n_a, n_b, n_groups, n_links], 1), np.append(0, np.cumsum(n_links)), pairs)

    def align(self, texts: list[str]) -> tuple[Aligned, np.ndarray, np.ndarray]:
        """Different pieces aligned; the pieces of all texts end to end, by number, and where each text's end.

        A piece that occurs again, here or in a later call, is kept from then on.
        """
        rows = [self.pieces(t) if t else [] for t in texts]
        ends = np.append(0, np.cumsum([len(r) for r in rows], dtype=np.int64))
        rows = list(chain.from_iterable(rows))
        new = list(set(rows).difference(self.number))
        if len(self.number) > KEPT:
            self._forget()
            new = list(set(rows))
        n_kept = len(self.number)
        self.number.update(zip(new, count(n_kept), strict=False))
        at = np.fromiter(map(self.number.__getitem__, rows), np.int64, len(rows))
        found = self.aligned(new)
        every = self.kept.and_then(found)
        again = np.bincount(at, minlength=n_kept + len(new))[n_kept:] > 1
        stay = np.array([len(p) <= SHORT and (ok or p in self.once) for p, ok in zip(new, again.tolist(), strict=True)], bool)
        for p in new:
            del self.number[p]
        self.number.update(zip([p for p, ok in zip(new, stay.tolist(), strict=True) if ok], count(n_kept), strict=False))
        self.kept = self.kept.and_then(found.only(np.flatnonzero(stay)))
        self.once = (set() if len(self.once) > KEPT else self.once) | {p for p in new if len(p) <= SHORT}
        return every, at, ends


_open: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _open:
        _open[path_a, path_b] = Aligner(path_a, path_b)
    return _open[path_a, path_b]


def _packed(values: np.ndarray) -> bytes:
    """Unsigned integers in 1, 2 or 4 bytes each, after a byte that says which."""
    width = 1 if not len(values) or values.max() < 1 << 8 else 2 if values.max() < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def chunk_row(texts: list[str], side: Aligner) -> dict:
    """Counts and digests of a chunk's documents, its distinct pairs, and each document's pairs among them."""
    every, at, ends = side.align(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    whole = np.ones(len(texts), bool)
    whole[owner[~every.spelt[at]]] = False
    digests = []
    for i, j, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), whole.tolist(), strict=True):
        digests.append(hashlib.sha256(b";".join([every.texts[p] for p in at[i:j].tolist()])).hexdigest() if ok and i < j else "")
    at, owner = at[whole[owner]], owner[whole[owner]]
    sums = np.zeros((len(at) + 1, 4), np.int64)
    np.cumsum(every.counts[at], axis=0, out=sums[1:])
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    counts = sums[ends[1:]] - sums[ends[:-1]]
    # each document's pieces with their numbers, then its pairs
    pieces = max(1, len(every.texts))
    held, often = np.unique(owner * pieces + at, return_counts=True)
    owner, piece = held // pieces, held % pieces
    place, of = spread(every.first[piece], np.diff(every.first)[piece])
    distinct, number = np.unique(every.pairs[place], return_inverse=True)
    key = owner[of] * max(1, len(distinct)) + number
    order = np.argsort(key, kind="stable")
    key, weight = key[order], often[of][order]
    new = np.flatnonzero(np.append(True, np.diff(key) > 0)) if len(key) else np.zeros(0, np.int64)
    links = np.add.reduceat(weight, new) if len(key) else weight
    owner, pair = key[new] // max(1, len(distinct)), key[new] % max(1, len(distinct))
    return {
        **{n: counts[:, i].tolist() for i, n in enumerate(COUNTS)},
        "digests": digests,
        "pairs": distinct,
        "documents": np.bincount(pair, minlength=len(distinct)),
        "sizes": np.bincount(owner, minlength=len(texts)),
        "links": _packed(links),
        "places": _packed(pair),
    }


LISTS = ["doc_ids", *COUNTS]
CHUNK_SHAPE = "chunk long, " + ", ".join(f"{n} array<long>" for n in LISTS) + ", digests array<string>, pairs array<long>, documents array<long>, sizes array<long>, links binary, places binary"


def _chunks(path_a: str, path_b: str, most: int):
    names = ["chunk", *LISTS, "digests", "pairs", "documents", "sizes", "links", "places"]
    kinds = [pa.int64()] + [pa.list_(pa.int64())] * len(LISTS) + [pa.list_(pa.string())] + [pa.list_(pa.int64())] * 3 + [pa.binary()] * 2

    def run(batches: Batches) -> Batches:
        side, number = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in T.blocks(batch, most=most):
                row = chunk_row([t.decode() for t in block.texts()], side)
                row |= {"chunk": number, "doc_ids": batch.column("doc_id")[block.rows.start : block.rows.stop].to_pylist()}
                yield pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in zip(names, kinds, strict=True)], names=names)
                number += 1

    return run


def _answered(batches: Batches) -> Batches:
    """Chunk rows with their pairs' counts to rows of documents."""
    names = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in batch.schema.names}
            values = {n: row[n].values.to_numpy() for n in ("sizes", "place", "count", "best") if row[n].is_valid}
            links, places = _unpacked(row["links"].as_py()), _unpacked(row["places"].as_py())
            count, best = np.zeros((2, len(values.get("place", ()))), np.int64)
            if len(count):
                count[values["place"]], best[values["place"]] = values["count"], values["best"]
            ends = np.append(0, np.cumsum(values["sizes"]))
            sums = [np.append(0, np.cumsum(links * x[places])) for x in (best, count)]
            columns = [row[n].values for n in LISTS] + [pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums] + [row["digests"].values]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """A row per document, and (a, b, documents, best) per linked id pair."""
    chunks = docs.select("doc_id", "text").mapInArrow(_chunks(path_a or path(BYTE_BPE), path_b or path(PIECE_BPE), most), CHUNK_SHAPE)
    chunks = written_once(chunks, "chunks")
    held = chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "documents")).alias("place", "p")).select("chunk", "place", F.col("p.pairs").alias("pair"), F.col("p.documents").alias("n"))
    counts = held.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.shiftright("pair", B_BITS))
    # at most one row per id of B in a partition of the window
    counts = written_once(counts.withColumn("best", (F.col("count") == F.max("count").over(Window.partitionBy("a"))).cast("long")), "pair-counts")
    answers = held.select("chunk", "place", "pair").join(counts.select("pair", "count", "best"), "pair")
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "count", "best")).alias("s"))
    answers = answers.select("chunk", *(F.col(f"s.{n}").alias(n) for n in ("place", "count", "best")))
    rows = chunks.drop("pairs", "documents").join(answers, "chunk", "left")
    shape = "doc_id long, " + ", ".join(f"{n} long" for n in COUNTS) + ", n_best long, count_sum long, groups_sha256 string"
    known = counts.select("a", (F.col("pair") % (1 << B_BITS)).alias("b"), F.col("count").alias("documents"), (F.col("best") == 1).alias("best"))
    return rows.mapInArrow(_answered, shape), known


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    T.small_batches(spark)
    return alignments(T.documents(spark, sf_dir))[0]
