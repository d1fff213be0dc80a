"""Operators for training data: SQL twins, brute force, round trips, held-out accuracy, odd rows."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from comparison import connect, spark_multiset, sql_multiset
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymark.llm import (
    decontamination,
    language_id,
    language_model,
    line_dedup,
    near_duplicates,
    packing,
    quality_rules,
    queries,
    repeated_bytes,
    suffix_sort,
    token_files,
    toxicity,
)
from tallymark.llm import texts as T
from tallymark.llm.tokens import BYTE_BPE, WORD_BPE, path

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in T.documents(spark, sf_dir).collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, sf_dir, name):
    assert spark_multiset(queries.QUERIES[name](spark, sf_dir)) == sql_multiset(connect(sf_dir), queries.ORACLES[name])


def ids_of(name, texts, end):
    tokenizer = Tokenizer.from_file(path(name))
    tokenizer.encode_special_tokens = True
    return {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, end], "<u4") for i, t in sorted(texts.items())}


def test_token_files_round_trip(spark, sf_dir, texts):
    want, start = ids_of(BYTE_BPE, texts, 2), 0
    got = {r.doc_id: r for r in token_files.op2_token_files(spark, sf_dir).collect()}
    for i, ids in want.items():
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_any_span_of_a_shard_decodes():
    ids = np.random.default_rng(1).integers(0, 9, 5000).astype(np.uint32)
    first, rules, row = token_files.compress(ids)
    shard = token_files.Shard(
        {"first_rule": first, "rules": rules.astype("<u4").tobytes(), "lengths": token_files.expansion_lengths(first, rules).astype("<u4").tobytes(), "width": 4, "symbols": row.astype("<u4").tobytes()}
    )
    assert len(row) < len(ids)  # random ids: only the round trip matters
    for a, b in [(0, 5000), (0, 0), (17, 18), (4990, 5000), (100, 3000)]:
        assert (shard.decode(a, b) == ids[a:b]).all()


def test_packing(spark, sf_dir, texts):
    want = ids_of(WORD_BPE, texts, 1)
    pieces = packing.op8_packing(spark, sf_dir).collect()
    places = {}
    for p in pieces:
        cut = want[p.doc_id][p.start : p.start + p.length]
        assert (len(cut), zlib.crc32(cut.tobytes()), p.doc_tokens) == (p.length, p.ids_crc32, len(want[p.doc_id]))
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sum(p.length for p in pieces) == sum(map(len, want.values()))
    filled = []
    for _, spans in sorted(places.items()):
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        filled.append(sum(n for _, n in spans))
    assert set(filled[:-1]) <= {2048}


def test_base_scores(spark, sf_dir, texts):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    words = {i: [*re.findall(WORD, t.translate(LOW)), "\n"] for i, t in texts.items()}
    c = Counter(w for i in words if not held[i] for w in words[i])
    n, v = sum(c.values()), len(c)
    rows = language_model.op7_language_model(spark, sf_dir).collect()
    for r in rows:
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words[r.doc_id])
        assert r.base_score == pytest.approx(base)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(words[r.doc_id]), sum(c[w] > 0 for w in words[r.doc_id]), n)
        assert r.score < 0


def test_quality_counts(spark, sf_dir, texts):
    for r in quality_rules.op3_quality_rules(spark, sf_dir).collect():
        text = texts[r.doc_id]
        words = re.findall(WORD, text)
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        hit = {i + j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(3)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
        assert not (r.base_failed and r.kept)


def test_binomial_bound():
    for k, n, p in [(0, 10, 0.3), (3, 20, 0.1), (9, 1000, 0.01)]:
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_rules.binomial_at_most(k, n, p)[-1] == pytest.approx(exact)
    # 5 of 2000 rejected above cutoff 1 can't show a rate below 0.25 %, none above cutoff 2 can
    assert quality_rules.strictest(np.array([900, 5, 0, 0]), 2000, 0.0025, 0.01) == 2
    assert quality_rules.strictest(np.array([0, 0]), 100, 0.0025, 0.01) is None


def cut_by_hand(texts):
    seen, out = {}, {}
    for i in sorted(texts):
        raw = texts[i].encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if seen.setdefault(raw[p : p + 50], i) != i:
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out[i] = (len(raw), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeated_bytes(spark, sf_dir, texts, monkeypatch, crowd):
    monkeypatch.setattr(repeated_bytes, "CROWD", crowd)
    got = {r.doc_id: tuple(r)[1:] for r in repeated_bytes.op6_repeated_bytes(spark, sf_dir).collect()}
    assert got == cut_by_hand(texts)


def test_suffix_order():
    random.seed(3)
    for _ in range(200):
        letters = random.choice([b"a", b"ab", bytes(range(256)), b"\x00\xff"])
        rows = [bytes(random.choices(letters, k=random.randint(1, 30))) for _ in range(random.randint(1, 8))]
        order, shared, row_end = suffix_sort.suffix_order(rows, memory=random.choice([1, 9, 1 << 20]))
        laid = b"".join(r + b"\0" for r in rows)
        got = [laid[p : row_end[p]] for p in order]
        assert got == sorted(r[i:] for r in rows for i in range(len(r)))
        for a, b, n in zip(got, got[1:], shared[1:], strict=False):
            assert n == len(os.path.commonprefix([a, b]))


def test_language_accuracy(spark, sf_dir):
    found = language_id.op1_language_id(spark, sf_dir).filter("held_out").join(T.documents(spark, sf_dir).select("doc_id", "lang"), "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.9 and 0 <= right[1] <= right[2] <= 1


def test_toxic_documents_score_higher(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = toxicity.op5_toxicity(spark, sf_dir).join(labels, "doc_id").groupBy("toxic").agg(F.avg("score")).collect()
    means = {r[0]: r[1] for r in rows}
    assert means[1] > means[0] + 0.3


def test_odd_rows(spark, odd_docs):
    learn = language_id.learnable()
    assert {r.doc_id: r.lang_pred for r in language_id.identify(odd_docs, language_id.train(odd_docs, learn)).collect()}[6] == "und"
    near = near_duplicates.near_duplicates(odd_docs).collect()
    assert len(near) == 10 and {r.component_id for r in near if r.doc_id in (4, 5)} == {4}
    assert all(r.kept for r in near if r.doc_id in (None, 1, 2, 3))
    lines = line_dedup.cut_lines(odd_docs).collect()
    assert len(lines) == 10 and [r.n_removed for r in lines if r.doc_id is None] == [0]
    marked = decontamination.contamination(odd_docs, spark.createDataFrame([(1, "word word"), (2, None), (None, "")], "item_id long, text string")).collect()
    assert {r.doc_id: r.n_hit for r in marked}[7] == 30_000 and len(marked) == 10
    assert len(repeated_bytes.cut_repeats(odd_docs).collect()) == 10
    assert language_model.language_model_scores(odd_docs, F.lit(True)).count() == 10
    assert packing.sequences(packing.pack(odd_docs)).select(F.sum(F.size("ids"))).first()[0] == packing.pack(odd_docs).agg(F.sum("length")).first()[0]
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 1), (5, 0, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    assert quality_rules.quality(odd_docs, labels).count() == 10
    assert toxicity.score(odd_docs, toxicity.train(odd_docs, labels, F.lit(True))).count() == 10


def test_empty_tables(spark, odd_docs):
    none = odd_docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    found = [
        language_id.of_known_language(none),
        near_duplicates.near_duplicates(none),
        line_dedup.cut_lines(none),
        decontamination.contamination(none, items),
        packing.pack(none),
        quality_rules.quality(none, labels),
        toxicity.score(none, toxicity.train(none, labels, F.lit(True))),
        repeated_bytes.cut_repeats(none),
        language_model.language_model_scores(none, F.lit(True)),
    ]
    assert [f.count() for f in found] == [0] * len(found)
