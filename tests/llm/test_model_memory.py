"""What the language model holds at once: batches, a chunk, a long document's training."""

from __future__ import annotations

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallymark import session
from tallymark.llm import language_model, recurrent
from tallymark.llm import texts as T
from tallymark.llm.recurrent import Memory, Network

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def as_task(monkeypatch):
    monkeypatch.setattr(language_model, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))


def given(texts):
    learn = [i % 3 > 0 for i in range(len(texts))]
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array(learn)], names=["doc_id", "text", "learn"])


def held(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_chunk_merges_words_and_not_tokens(as_task):
    """All hashes of a chunk's tokens were sorted together, 131 MB."""
    texts = [" ".join(f"{(i * 7 + j) % 40_000:x}" for j in range(2000)) for i in range(1000)]
    rows = language_model._chunks(iter([given(texts[a : a + 250]) for a in range(0, 1000, 250)]))
    assert held(lambda: [row.num_rows for row in rows]) < 80


def test_chunks_hold_all_tokens_and_counts(as_task, monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK", 300)
    texts = [" ".join(f"w{(i * j) % 17}" for j in range(i)) for i in range(60)] + [None, "", "w1"]
    batch, at = given(texts), 0
    plain = language_model.tokens(next(T.blocks(batch, most=1 << 30)))
    numbers = []
    for made in language_model._chunks(iter([batch.slice(a, 10) for a in range(0, 63, 10)])):
        row = made.to_pylist()[0]
        words, counts, places = (np.frombuffer(row[c], k) for c, k in (("words", "<u8"), ("counts", "<i8"), ("places", "<u4")))
        expected = plain[0][plain[1][at] : plain[1][at + len(row["sizes"])]]
        assert np.array_equal(words[places], expected) and np.array_equal(words, np.unique(expected)) and row["n_words"] == len(words)
        assert np.array_equal(counts, np.bincount(places, np.repeat(row["learn"], row["sizes"]), len(words)))
        assert row["sizes"] == np.diff(plain[1])[at : at + len(row["sizes"])].tolist() and row["doc_ids"] == list(range(at, at + len(row["sizes"])))
        at += len(row["sizes"])
        numbers.append(row["chunk"])
    assert at == 63 and numbers == [(3 << 32) + i for i in range(len(numbers))] and len(numbers) > 2


def test_ranges_answer_every_chunk():
    words = [np.array(w, "<u8") for w in ([1, 5, 9], [2, 5], [], [5, 9, 1 << 63])]
    counts = [np.array(c, "<i8") for c in ([1, 0, 4], [7, 2], [], [3, 0, 1])]
    rows = pa.table({"range": [4] * 4, "chunk": [10, 11, 12, 13], "words": [w.tobytes() for w in words], "counts": [c.tobytes() for c in counts]})
    found = language_model._replies(pa.concat_tables([rows.slice(0, 2), rows.slice(2)])).to_pylist()
    assert [np.frombuffer(r["counts"], "<i8").tolist() for r in found[:-1]] == [[1, 5, 4], [7, 5], [], [5, 4, 1]]
    assert [r["chunk"] for r in found] == [10, 11, 12, 13, -1] and {r["range"] for r in found} == {4}
    assert found[-1] | {"top_words": found[-1]["top_words"][:3]} == {
        "range": 4, "chunk": -1, "counts": None, "n": 18, "v": 5, "top_words": [2, 5, 9], "top_counts": [7, 5, 4, 1, 1]
    }


def test_sums_of_parts_are_those_of_the_whole(monkeypatch):
    monkeypatch.setattr(language_model, "PART", 50)
    rng = np.random.default_rng(2)
    sizes = np.concatenate([rng.integers(1, 40, 90), [400, 1, 50, 50]])
    offsets, values = np.concatenate([[0], np.cumsum(sizes)]), rng.standard_normal(70)
    places = rng.integers(0, 70, offsets[-1]).astype(np.uint32)
    assert np.array_equal(language_model._sums(values, places, offsets), np.add.reduceat(values[places], offsets[:-1]))
    assert language_model._sums(values, places[:0], offsets[:1]).tolist() == []


def test_a_long_document_is_laid_out_in_stretches(monkeypatch):
    """Every stream had room for the steps of the longest, 29 MB here."""
    monkeypatch.setattr(Network, "_window", lambda self, h, inputs, targets, real, memory: (h, memory.slopes))
    network = Network(150)
    memory = Memory(network)
    docs = [np.zeros(100_000, np.int32), *np.zeros((31, 1), np.int32)]
    assert held(lambda: network.train(docs, 0, memory)) < 6
    assert memory.rounds == 100_000 // recurrent.WINDOW


def test_windows_are_the_documents_in_order(monkeypatch):
    seen = []

    def kept(self, h, inputs, targets, real, memory):
        seen.append((inputs.copy(), targets.copy(), real.copy()))
        return h, memory.slopes

    monkeypatch.setattr(Network, "_window", kept)
    network, rng = Network(150), np.random.default_rng(4)
    docs = [rng.integers(0, 151, n).astype(np.int32) for n in [5000, 2048, 2048, 1, *rng.integers(1, 900, 80)]]
    network.train(docs, 0, Memory(network))
    streams: dict[int, list] = {}
    for inputs, targets, real in seen:
        assert inputs.shape == targets.shape == real.shape
        for s in range(real.shape[1]):
            streams.setdefault(s, []).extend(zip(inputs[:, s][real[:, s]].tolist(), targets[:, s][real[:, s]].tolist(), strict=True))
    found = []
    for pairs in streams.values():
        last = None
        for at, (fed, target) in enumerate(pairs):
            if fed == 151:
                found.append([])
            else:
                assert at and fed == last
            found[-1].append(target)
            last = target
    assert sorted(found) == sorted(d.tolist() for d in docs)


def test_texts_and_chunks_travel_in_small_batches(spark, monkeypatch):
    """Batches of the language model had Spark's own bound, and chunks were written without zstd."""
    written, once, had = {}, session.written_once, spark.conf.get(BATCH, None)

    def kept(df, name, *how):
        out = once(df, name, *how)
        written[name] = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in out.inputFiles()], int(spark.conf.get(BATCH))
        return out

    monkeypatch.setattr(language_model, "written_once", kept)
    spark.conf.set(BATCH, str(1 << 28))
    try:
        rows = spark.createDataFrame([(1, "a b"), (None, "b"), (2, None)], "doc_id long, text string")
        assert language_model.language_model_scores(rows, F.lit(True)).count() == 3
    finally:
        if had:
            spark.conf.set(BATCH, had)
        else:
            spark.conf.unset(BATCH)
    metadata, most = written["chunks"]
    assert most <= T.BATCH_BYTES
    assert {m.row_group(0).column(0).compression for m in metadata if m.num_row_groups} == {"ZSTD"}
