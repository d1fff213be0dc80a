"""What steps over large blocks cost: CPU time of token files, memory left in a worker, size of tables written."""

from __future__ import annotations

import os
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from tallymark import session
from tallymark.llm import repeated_bytes, token_files, tokens

LEFT = """
import pyarrow as pa, sys
sys.path.insert(0, sys.argv[1])
from tallymark.llm.tokens import WORD_BPE, encoder, path
def held():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 / 1e6
e = encoder(path(WORD_BPE))
for k in range(3):
    e.encode([" ".join(f"{(k * 1000 + i) * 7919 + j * 104729:x}" for i in range(300)) for j in range(900)])
before = held()
pa.default_memory_pool().release_unused()
print(before - held())
"""

SPENT = """
import sys, time
sys.path.insert(0, sys.argv[1])
from tallymark.llm.tokens import WORD_BPE, encoder, path
e = encoder(path(WORD_BPE))
whole, own = time.process_time(), time.thread_time()
e.encode([" ".join(f"{i * 7919 + j * 104729:x}" for i in range(300)) for j in range(900)])
print((time.thread_time() - own) / (time.process_time() - whole))
"""


def shard(ids):
    first, rules, row = token_files.compress(ids)
    lengths = token_files.expansion_lengths(first, rules).astype("<u4").tobytes()
    return {"first_rule": first, "rules": rules.astype("<u4").tobytes(), "lengths": lengths, "width": 4, "symbols": row.astype("<u4").tobytes()}


@pytest.mark.parametrize("most", [3, 900, 70_000])
def test_any_span_of_a_shard_is_decoded(most):
    rng = np.random.default_rng(most)
    ids = np.minimum(rng.integers(0, most, 40_000), rng.integers(0, most, 40_000))
    read = token_files.Shard(shard(ids))
    for a, b in [(0, len(ids)), (0, 0), (5, 6), *np.sort(rng.integers(0, len(ids) + 1, (30, 2)), 1)]:
        assert np.array_equal(read.decode(a, b), ids[a:b])


def test_only_frequent_pairs_are_counted(monkeypatch):
    """All different pairs of a shard were listed with their counts in every round."""
    listed, unique = [], np.unique

    def kept(values, *how, **named):
        listed.append(len(values))
        return unique(values, *how, **named)

    monkeypatch.setattr(token_files.np, "unique", kept)
    ids = np.concatenate([np.arange(30_000), np.tile([7, 8, 9], 400), [5, 5], np.tile([3, 4], 5)]).astype(np.uint32)
    row = shard(ids)
    assert max(listed) < 3000
    assert np.array_equal(token_files.Shard(row).decode(0, len(ids)), ids)
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    assert {(7, 8), (8, 9), (9, 7)} <= {tuple(r) for r in rules.tolist()} and (3, 4) in {tuple(r) for r in rules.tolist()}
    for few in ([], [1], [1, 1], [1] * 7):
        assert token_files.Shard(shard(np.array(few, np.uint32))).decode(0, len(few)).tolist() == few


def test_decoding_costs_less_than_compressing():
    """Level by level, decoding took over half as long; looked up, a fifth."""
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.3, 1 << 20) % 40_000).astype(np.uint32)
    spent = []
    for _ in range(3):
        begin = time.process_time()
        made = shard(ids)
        middle = time.process_time()
        assert len(token_files.Shard(made).decode(0, len(ids))) == len(ids)
        spent.append((time.process_time() - middle) / (middle - begin))
    assert min(spent) < 0.45


def test_an_encoder_gives_memory_back():
    root = str(Path(__file__).resolve().parents[2])
    assert float(subprocess.run([sys.executable, "-c", LEFT, root], capture_output=True, text=True, check=True).stdout) < 25


def test_an_encoder_works_in_its_task_alone():
    """Threads of the tokenizer's own, one a CPU, kept some 50 MB more in every worker."""
    root, env = str(Path(__file__).resolve().parents[2]), {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    assert float(subprocess.run([sys.executable, "-c", SPENT, root], capture_output=True, text=True, check=True, env=env).stdout) > 0.8


def test_an_encoder_holds_few_tokenized_texts(monkeypatch):
    """The tokenizer's own results, far larger than the ids, were held for a whole block."""

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.most = tokenizer, 0

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, texts, **how):
            self.most = max(self.most, len(texts))
            return self.tokenizer.encode_batch_fast(texts, **how)

    texts = [" ".join(f"{i * 7919 + j * 104729:x}" for i in range(300)) for j in range(60)] + ["two  spaces", "", "end "]
    monkeypatch.setattr(tokens, "TOGETHER", 2)
    made = tokens.Encoder(tokens.path(tokens.WORD_BPE))
    made.tokenizer = counted = Counted(made.tokenizer)
    ids, offsets = made.encode(texts)
    plain = [counted.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == plain
    assert 1 < counted.most <= 64


def test_overlapping_regions_are_written_small(spark, monkeypatch):
    written, once = {}, session.written_once

    def kept(df, name, *how):
        out = once(df, name, *how)
        written[name] = out.inputFiles()
        if name in ("regions", "unique"):
            written[name] = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in written[name]]
        return out

    monkeypatch.setattr(repeated_bytes, "written_once", kept)
    text = "these words stand in two documents and are long enough to be found there " * 3
    rows = spark.createDataFrame([(1, text), (2, "x " + text), (None, text), (3, None)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed > 0 for r in repeated_bytes.cut_repeats(rows).collect()} == {1: False, 2: True, None: False, 3: False}
    for name in ("regions", "unique"):
        codecs = {m.row_group(0).column(0).compression for m in written[name] if m.num_row_groups}
        assert codecs == {"ZSTD"}


def test_regions_are_answered_in_turns_and_given_back(spark, monkeypatch):
    """All regions were answered at once, and regions and answers stayed until the end."""
    written, left, once = [], [], session.written_once

    def kept(df, name, *how):
        left.append((name, [n for n, files in written if files and all(Path(f.removeprefix("file://")).exists() for f in files)]))
        out = once(df, name, *how)
        written.append((name, out.inputFiles()))
        return out

    monkeypatch.setattr(repeated_bytes, "written_once", kept)
    text = "".join(f"sentence {i * 7919 % 997} says {i * i} things; " for i in range(60))
    rows = spark.createDataFrame([(1, text), (2, "x" + text), (3, text[400:1200]), (4, "short")], "doc_id long, text string")
    removed = {r.doc_id: r.n_removed for r in repeated_bytes.cut_repeats(rows).collect()}
    assert removed == {1: 0, 2: len(text), 3: 800, 4: 0}
    assert [n for n, _ in written].count("unique") == repeated_bytes.TURNS > 1
    assert all(held.count("unique") <= (name in ("crowded", "answers")) for name, held in left)
    assert [n for n, files in written if any(Path(f.removeprefix("file://")).exists() for f in files)] == ["marks", "crowded", "crowded", "spans"]
