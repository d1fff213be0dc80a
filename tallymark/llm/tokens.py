"""Token ids of whole texts, by a given tokenizer, inside tasks."""

from __future__ import annotations

import os
import re
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from tokenizers import Tokenizer

# A tokenizer file's place on every machine; a parameter of the operators.
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
KEPT_BYTES, SHORT = 16 << 20, 64  # of kept pieces with their ids, and of one piece
ENCODED_BYTES = 2 << 20  # of texts encoded at once
TOGETHER = 64  # pieces joined into one text
AT_ONCE = 64  # texts whose tokens the tokenizer holds at once, with far more than their ids
BEFORE_SPACE = re.compile(r" (?<=\s )")  # looks back from spaces, which are quick to find
# In place of a first piece's missing space, and of a text that is not cut.
FIRST, WHOLE, NUL = "\1", "\2", "\0"
ASCII_LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)
OWN = re.compile(f"[{FIRST}{WHOLE}]")
# By byte: 3 the two marks, 2 the space, 1 other last bytes of white space, and of other characters beyond ASCII.
ENDS_SPACE = np.zeros(256, np.uint8)
ENDS_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x20), *range(0x80, 0xC0)]] = 1
ENDS_SPACE[[0x20, *map(ord, FIRST + WHOLE)]] = 2, 3, 3
# Byte-level vocabularies write each byte as one character: printable ones as they are,
# the others in order from 256 on.
_printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
_others = iter(range(256, 512))
BYTE_CHARACTERS = {b: chr(b) if b in _printable else chr(next(_others)) for b in range(256)}
_open: dict[str, Encoder] = {}


class Encoder:
    """Encodes texts piece by piece, each different piece once.

    The tokenizers used here never join characters on both sides of the border
    between a character that isn't white space and a following space. A text is cut
    there, and the pieces (a word with the space before it) are encoded by the
    tokenizer, many joined into one text: as they are where a word's first id shows its space,
    else with a NUL as a word of its own after each. Cut,
    told apart and looked up as Arrow strings, a piece costs no Python object unless it
    is new. A full stop or comma after an ASCII letter is cut off a new piece, and case is
    dropped, where a tokenizer shows that it allows it. Pieces of at most SHORT bytes are kept for later texts, up to KEPT_BYTES;
    beyond that those stay that were seen again. A text in which white space comes before
    a space, or which holds the two marks used here, is encoded as one piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core, and each thread holds memory of its own
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are text
        self.separator = self._full(" " + NUL)
        self.spaced = self._spaced()
        letters = " ".join(["", *ascii_uppercase, "'S", "A\u0301"])
        self.same_case = self._full(letters) == self._full(letters.translate(ASCII_LOWER))
        ends = [self._full(mark) for mark in ".,"]
        apart = all(len(ids) == 1 and self._full(" ab" + mark) == self._full(" ab") + ids for mark, ids in zip(".,", ends, strict=True))
        self.marks = [ids[0] for ids in ends] if apart else [0, 0]
        self.marked = "[a-z][.,]$" if apart else "[^\\s\\S]"  # nothing
        self._forget()

    def _full(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _spaced(self) -> np.ndarray | None:
        """Which ids begin with a space, of a byte-level vocabulary that keeps it in a word's first id."""
        vocabulary = self.tokenizer.get_vocab()
        found = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        found[[i for token, i in vocabulary.items() if token.startswith(BYTE_CHARACTERS[0x20])]] = True
        shown = [self._full(text) for text in (" ab", " ab ab", " ab .b")]
        return found if [int(found[ids].sum()) for ids in shown] == [1, 2, 2] and all(found[ids[0]] for ids in shown) else None

    def _forget(self) -> None:
        self.keys = pa.array([], pa.large_string())
        self.ids = np.zeros(0, np.uint32)
        self.first = np.zeros(1, np.int64)
        self.times = np.zeros(0, np.int64)

    def _keep(self, stay: np.ndarray) -> None:
        sizes = np.diff(self.first)
        self.keys = self.keys.filter(pa.array(stay))
        self.ids = self.ids[np.repeat(stay, sizes)]
        self.first = np.concatenate([[0], np.cumsum(sizes[stay])])
        self.times = self.times[stay]

    def _make_room(self) -> None:
        held = lambda: self.keys.nbytes + self.ids.nbytes + self.first.nbytes + self.times.nbytes
        if held() > KEPT_BYTES:
            self._keep(self.times > 1)
            self.times[:] = 0
            if held() > KEPT_BYTES // 2:
                self._forget()

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts end to end, and their sizes."""
        found = []
        for i in range(0, len(texts), AT_ONCE):
            found += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[i : i + AT_ONCE], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([np.zeros(0, np.uint32), *found]), sizes

    def _joined(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that follow a space, and their sizes; by one call for TOGETHER pieces."""
        mark, n = " " if self.spaced is not None else f" {NUL} ", len(pieces)
        cuts = pa.array(np.append(np.arange(0, n, TOGETHER), n), pa.int32())
        rows = pc.binary_join(pa.ListArray.from_arrays(cuts, pieces), pa.scalar(mark, pa.large_string())).to_pylist()
        if self.spaced is not None:
            ids, _ = self._each([" " + row for row in rows])
            begins = np.flatnonzero(self.spaced[ids])
            if len(begins) == n:
                return ids, np.diff(begins, append=len(ids))
            return self._each([" " + p for p in pieces.to_pylist()])
        ids, _ = self._each([" " + row + mark[:2] for row in rows])
        ends = np.flatnonzero(ids == self.separator[-1]) if self.separator else []
        if len(ends) != n:  # not a tokenizer that keeps a NUL apart
            return self._each([" " + p for p in pieces.to_pylist()])
        ends, width = ends + 1, len(self.separator)
        sizes = np.diff(ends, prepend=0) - width
        return np.delete(ids, (ends[:, None] - 1 - np.arange(width)).ravel()), sizes

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """Places among the kept pieces, -1 for a new one."""
        return pc.fill_null(pc.index_in(pieces, value_set=self.keys), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def _add(self, keys: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.keys = pa.concat_arrays([self.keys, keys])
        self.ids = np.concatenate([self.ids, ids])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.times = np.concatenate([self.times, np.zeros(len(sizes), np.int64)])

    def _ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of kept pieces end to end, and their sizes."""
        sizes = self.first[at + 1] - self.first[at]
        stops = np.cumsum(sizes)
        return self.ids[np.repeat(self.first[at + 1] - stops, sizes) + np.arange(stops[-1] if len(stops) else 0)], sizes

    def _places(self, pieces: pa.Array, texts: list[str]) -> np.ndarray:
        """Places of different pieces, after new ones are kept with their ids.

        Of a new word with a mark after it the word is encoded, or is kept already.
        """
        marked = np.flatnonzero(pc.match_substring_regex(pieces, self.marked).to_numpy(zero_copy_only=False))
        words = pc.utf8_slice_codeunits(pieces.take(pa.array(marked)), 0, -1)
        place = self._numbers(pa.concat_arrays([pieces, words]))  # one pass over all that is kept
        place, of_word = place[: len(pieces)], place[len(pieces) :]
        whole = place[marked] < 0
        marked, words, of_word = marked[whole], words.filter(pa.array(whole)), of_word[whole]
        plain = place < 0
        plain[marked] = False
        new, new_words = pieces.filter(pa.array(plain)), words.filter(pa.array(of_word < 0))
        kept = len(self.keys)
        self._learn_words(pa.concat_arrays([new, new_words]).unique(), texts)
        learned = self.keys.slice(kept)
        place[plain] = kept + pc.index_in(new, value_set=learned).to_numpy(zero_copy_only=False)
        of_word[of_word < 0] = kept + pc.index_in(new_words, value_set=learned).to_numpy(zero_copy_only=False)
        whole = pieces.take(pa.array(marked))
        ids, sizes = self._ids(of_word)
        ends = np.where(pc.ends_with(whole, ".").to_numpy(zero_copy_only=False), *self.marks)
        place[marked] = len(self.keys) + np.arange(len(marked))
        self._add(whole, np.insert(ids, np.cumsum(sizes), ends.astype(np.uint32)), sizes + 1)
        return place

    def _learn_words(self, new: pa.Array, texts: list[str]) -> None:
        alone = pc.or_(pc.match_substring_regex(new, "^$|[\\x00-\\x02]"), pc.not_equal(pc.utf8_rtrim_whitespace(new), new))
        joined, rest = new.filter(pc.invert(alone)), new.filter(alone)
        self._add(joined, *self._joined(joined))
        given = {FIRST: lambda p: p[1:], WHOLE: lambda p: texts[int(p[1:])]}
        self._add(rest, *self._each([given.get(p[:1], " {}".format)(p) for p in rest.to_pylist()]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and offsets."""
        self._make_room()
        doubtful = _doubtful(texts)
        marked = [f"{WHOLE}{i}" if doubtful[i] and (BEFORE_SPACE.search(t) or OWN.search(t)) else FIRST + t for i, t in enumerate(texts)]
        marked = pa.array(marked, pa.large_string())
        rows = pc.split_pattern(pc.ascii_lower(marked) if self.same_case else marked, " ")
        found, cuts = rows.flatten().dictionary_encode(), rows.offsets.to_numpy()
        del marked, rows  # before room is taken for the kept pieces
        at = self._places(found.dictionary, texts)[found.indices.to_numpy()]
        self.times += np.bincount(at, minlength=len(self.times))
        ids, sizes = self._ids(at)
        keys = self.keys
        stay = pc.less_equal(pc.binary_length(keys), SHORT).to_numpy(zero_copy_only=False) & ~pc.starts_with(keys, WHOLE).to_numpy(zero_copy_only=False)
        if not stay.all():
            self._keep(stay)
        offsets = np.concatenate([[0], np.cumsum(sizes)])[cuts]
        del found, keys
        pa.default_memory_pool().release_unused()  # some 60 MB a block, which a worker would hold on to
        return ids, offsets


def _doubtful(texts: list[str]) -> np.ndarray:
    """Texts that hold a byte of the two marks, or a space after a byte that may end white space; by one pass over all bytes."""
    given = pa.array(texts, pa.large_string())
    offsets = np.frombuffer(given.buffers()[1] or bytes(8), np.int64)[: len(texts) + 1]
    data = given.buffers()[2]
    kinds = np.frombuffer((data.to_pybytes() if data else b"").translate(ENDS_SPACE.tobytes()), np.uint8)
    found = kinds > 2
    found[1:] |= (kinds[1:] == 2) & (kinds[:-1] > 0)
    places = np.searchsorted(offsets, np.flatnonzero(found), "right") - 1
    return np.bincount(places, minlength=len(texts)) > 0


def encoder(path: str) -> Encoder:
    """The process's encoder for a tokenizer file."""
    if path not in _open:
        _open[path] = Encoder(path)
    return _open[path]


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with an end id after every document."""
    return np.insert(ids, offsets[1:], end), offsets + np.arange(len(offsets))


def path(name: str) -> str:
    return public_tokenizers.path(name)
