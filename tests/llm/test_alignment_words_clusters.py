"""Repeated words, token alignment and centroid clusters against brute force, with odd rows and empty tables."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymark.llm import centroid_clusters, repeated_words, token_alignment
from tallymark.llm import texts as T
from tallymark.llm.tokens import BYTE_BPE, BYTE_CHARACTERS, path


def words_cut_by_hand(rows, window):
    """(doc_id, n_words, n_removed, kept) of rows (doc_id, text), every window looked up."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in split:
        for p in range(len(words) - window + 1):
            if i is not None:
                key = tuple(words[p : p + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, words in split:
        gone = set()
        for p in range(len(words) - window + 1):
            if i is not None and least[tuple(words[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeated_words_by_hand(spark, monkeypatch, hot):
    """Few words in many texts: ties of grams, hot grams, windows that overlap themselves."""
    monkeypatch.setattr(repeated_words, "HOT", hot)
    random = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(120):
        text = " ".join(random.choice(["a", "b", "é", "c\x0b", "\x1fd"], random.integers(0, 60)))
        rows.append((i // 2 if i % 9 == 0 else i, text + "\n" + passage * (i % 3 == 0) + "  " + text[: int(random.integers(0, 90))]))
    rows += [(None, passage), (None, passage), (500, None), (501, ""), (502, " \t"), (503, "word " * 30_000), (504, "word " * 20), (505, passage), (505, passage), (505, passage + " end")]
    got = repeated_words.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=7, gram=3).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == words_cut_by_hand(rows, 7)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_window_numbers():
    words = np.random.default_rng(3).integers(0, 3, 400)
    for window in (1, 2, 3, 5, 13):
        numbers = repeated_words.window_numbers(words, window)[: 400 - window + 1]
        seen = {}
        for p, n in enumerate(numbers.tolist()):
            assert seen.setdefault(n, tuple(words[p : p + window])) == tuple(words[p : p + window])
        assert len(set(seen.values())) == len(seen)


def aligned_by_hand(rows):
    """Whole texts at once, every link spelt out."""
    a = Tokenizer.from_file(path(BYTE_BPE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path(token_alignment.PIECE_BPE))
    char = {c: x for x, c in BYTE_CHARACTERS.items()}
    held, found = defaultdict(set), []
    for n, (i, text) in enumerate(rows):
        e, groups, links = " " + (text or ""), [], []
        ids_a = a.encode(e, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(char[c] for c in a.id_to_token(x)) for x in ids_a]
        bytes_b = [bytes([x - 3]) if 3 <= x < 259 else b.id_to_piece(x).replace("▁", " ").encode() for x in ids_b]
        if not text or b"".join(bytes_a) != e.encode() or b"".join(bytes_b) != e.encode():
            ids_a = ids_b = bytes_a = bytes_b = []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        low = 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            in_a = [x for x, y in zip(ids_a, ends_a, strict=True) if low < y <= end]
            in_b = [x for x, y in zip(ids_b, ends_b, strict=True) if low < y <= end]
            groups.append(",".join(map(str, in_a)) + "|" + ",".join(map(str, in_b)))
            links += [(x, y) for x in in_a for y in in_b]
            low = end
        for link in links:
            held[link].add(n)
        found.append((i, len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (x, _), docs in held.items():
        best[x] = max(best[x], len(docs))
    out = []
    for i, n_a, n_b, groups, links in found:
        counts = [len(held[x]) for x in links]
        n_best = sum(c == best[x] for c, (x, _) in zip(counts, links, strict=True))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((i, n_a, n_b, len(groups), len(links), n_best, sum(counts), digest))
    return Counter(out)


SPELLINGS = [
    "plain words here", " leading", "trailing ", "two  spaces   three", "line\nline\n line \n", "\t\ttabs\x0b", "<|endoftext|> <s>x</s> <0x41> <unk>",
    "naïve Straße 中文字 ünïcödé🙂🙂", "▁marked", "it's they'll", " no break wide", "\x1c \x1d", " ", "  ", "\x00z", "a" * 3000, "中" * 500, "x\r\ny",
]


@pytest.mark.parametrize("most", [token_alignment.CHUNK, 200])
def test_alignment_by_hand(spark, sf_dir, most, monkeypatch):
    if most == 200:
        monkeypatch.setattr(token_alignment, "KEPT", 40)  # in this process only; workers keep theirs
    rows = [(r.doc_id, r.text) for r in T.documents(spark, sf_dir).orderBy(F.length("text")).limit(150).collect()[::12]]
    rows += [*enumerate(SPELLINGS, 1000), (None, "plain words here"), (1, "plain words"), (1, "plain words"), (2, None), (3, "")]
    got, known = token_alignment.alignments(spark.createDataFrame(rows, "doc_id long, text string"), most=most)
    assert Counter(map(tuple, got.collect())) == aligned_by_hand(rows)
    assert known.filter("best").select("a").distinct().count() == known.select("a").distinct().count()


def test_kept_pieces_change_nothing(monkeypatch):
    """Pieces forgotten and kept again give the rows of a fresh aligner."""
    monkeypatch.setattr(token_alignment, "KEPT", 5)
    files = path(BYTE_BPE), path(token_alignment.PIECE_BPE)
    side = token_alignment.Aligner(*files)
    for n in range(6):
        texts = [" ".join(f"w{i % (n + 3)} again" for i in range(30)), SPELLINGS[n]]
        got, want = token_alignment.chunk_row(texts, side), token_alignment.chunk_row(texts, token_alignment.Aligner(*files))
        assert all(np.array_equal(got[k], want[k]) for k in want)
        assert len(side.number) == len(side.kept.texts) <= 20


def clusters_by_hand(rows, k, rounds):
    kept = [(i, np.array([int(np.floor(np.float64(c) * 256)) for c in v])) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and np.isfinite(c) for c in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v.tolist()) for i, v in kept if i is not None)
    centroids = np.array([v for _, v in order[:k]])
    x = np.array([v for _, v in kept])

    def assign():
        d = ((x[:, None] - centroids) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        label = assign()[0]
        for j in range(len(centroids)):
            if (label == j).any():
                centroids[j] = x[label == j].sum(0) // (label == j).sum()
    label, distance = assign()
    return Counter(zip([i for i, _ in kept], label.tolist(), distance.tolist(), strict=True)), centroids


@pytest.mark.parametrize("leading", [1, 16, 64])
def test_clusters_by_hand(spark, leading):
    """Ties, copies, vectors that aren't kept, centroids that lose all vectors."""
    random = np.random.default_rng(7)
    rows = [(i, [float(c) for c in random.integers(-2, 3, 64) / 256]) for i in range(60)]
    rows += [(i, [float(c) for c in random.normal(size=64)]) for i in range(60, 200)]
    rows += [(200, rows[3][1]), (200, rows[3][1]), (None, rows[70][1]), (5, rows[3][1]), *((i, [0.5] * 64) for i in range(201, 260))]
    rows += [(300, None), (301, []), (302, [0.1] * 63), (303, [None] + [0.1] * 63), (304, [float("nan")] * 64), (305, [float("-inf")] + [0.0] * 63)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    labels, centroids, taken = centroid_clusters.cluster(frame, leading=leading)
    want, centers = clusters_by_hand(rows, 40, 5)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in labels.collect()) == want
    assert (centroids == centers).all() and all(t <= want.total() * 40 for t in taken)


def test_few_clustered_rows_are_ruled_out(spark):
    """Centroids far off are ruled out: fewer exact distances than all pairs."""
    random = np.random.default_rng(1)
    rows = [(i, [float(c) for c in random.normal(size=64) * 0.05 + np.eye(64)[i % 20] * 8]) for i in range(400)]
    taken = centroid_clusters.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), leading=20)[2]
    assert sum(taken) < 0.5 * len(taken) * 400 * 40


def test_components_too_large_fail(spark):
    wide = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        centroid_clusters.cluster(wide)


def test_odd_rows_and_empty_tables(spark, odd_docs):
    assert repeated_words.cut_repeats(odd_docs.withColumnRenamed("component_id", "version")).count() == 10
    assert token_alignment.alignments(odd_docs.withColumnRenamed("component_id", "chunk"))[0].count() == 10
    none = odd_docs.limit(0)
    assert repeated_words.cut_repeats(none).count() == 0
    assert [f.count() for f in token_alignment.alignments(none)] == [0, 0]
    assert centroid_clusters.cluster(spark.createDataFrame([], "vec_id long, embedding array<double>, v string, lead int"))[0].count() == 0
    few = spark.createDataFrame([(1, [0.25] * 64, "x"), (2, [0.5] * 64, "x")], "vec_id long, embedding array<double>, cluster string")
    assert {(r.cluster, r.distance) for r in centroid_clusters.cluster(few)[0].collect()} == {(0, 0), (1, 0)}
