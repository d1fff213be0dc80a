"""The network against a plain one that takes a token at a time."""

from __future__ import annotations

import numpy as np
import pytest

from tallymark.llm import recurrent
from tallymark.llm.recurrent import CLASS_WORDS, HIDDEN, WINDOW, Memory, Network


def plain_score(network, doc):
    w = {k: v.astype(np.float64) for k, v in network.weights.items()}
    h, x, total = np.zeros(HIDDEN), network.words + 1, 0.0
    for target in doc:
        g, e = h @ w["state"], w["inputs"][x]
        z, r = (1 / (1 + np.exp(-(e[s] + g[s]))) for s in (slice(HIDDEN), slice(HIDDEN, 2 * HIDDEN)))
        n = np.tanh(e[2 * HIDDEN :] + r * g[2 * HIDDEN :])
        h, x = n + z * (h - n), target
        kind = target // CLASS_WORDS if target < network.words else network.classes - 1
        logits = h @ w["class"] + w["class_bias"]
        total += logits[kind] - np.log(np.exp(logits).sum())
        if kind < network.classes - 1:
            span = slice(kind * CLASS_WORDS, (kind + 1) * CLASS_WORDS)
            logits = w["word"][span] @ h + w["word_bias"][span]
            total += logits[target % CLASS_WORDS] - np.log(np.exp(logits).sum())
    return total


def sample(words, sizes, seed=3):
    rng = np.random.default_rng(seed)
    return [rng.integers(0, words + 1, n).astype(np.int32) for n in sizes]


@pytest.mark.parametrize("wide", [1, 400])
def test_scores_are_those_of_a_plain_network(wide, monkeypatch):
    monkeypatch.setattr(recurrent, "TOGETHER", 3)
    network, docs = Network(150), sample(150, [1, 70, 5, 33, 1, 12, 200])
    for k in ("word", "class", "state"):
        network.weights[k] *= wide if k == "word" else 1  # logits that need their largest taken away
    found = network.score(np.concatenate(docs), np.concatenate([[0], np.cumsum([len(d) for d in docs])]))
    with np.errstate(over="ignore"):
        assert found == pytest.approx([plain_score(network, d) for d in docs], rel=1e-3)


@pytest.mark.parametrize("safe", [80.0, -1.0])
def test_slopes_are_those_of_the_score(safe, monkeypatch):
    monkeypatch.setattr(recurrent, "SAFE", safe)
    network, docs = Network(150), sample(150, [9, 20])
    targets = np.concatenate(docs)[:, None]
    inputs = np.concatenate([[151], docs[0][:-1], [151], docs[1][:-1]])[:, None].astype(np.int32)
    zero = np.zeros((HIDDEN, 1), np.float32)
    slopes = network._window(zero, inputs, targets, np.ones(targets.shape, bool), Memory(network))[1]
    for name, slope in slopes.items():
        for at in np.argsort(-np.abs(slope).ravel())[:5]:
            held, ends = network.weights[name].flat[at], []
            for step in (1e-2, -1e-2):
                network.weights[name].flat[at] = held + step
                ends.append(-sum(plain_score(network, d) for d in docs) / len(targets))
            network.weights[name].flat[at] = held
            assert slope.flat[at] == pytest.approx((ends[0] - ends[1]) / 2e-2, rel=2e-2, abs=1e-6), name


def test_streams_that_ended_cost_nothing(monkeypatch):
    """All streams were carried on to the end of the longest."""
    widths, window = [], Network._window

    def kept(self, h, inputs, *rest):
        widths.append(inputs.shape[1])
        return window(self, h, inputs, *rest)

    monkeypatch.setattr(Network, "_window", kept)
    network = Network(150)
    memory = Memory(network)
    network.train(sample(150, [10] * 20 + [5 * WINDOW]), 0, memory)
    assert widths == [21, 1, 1, 1, 1] and memory.rounds == 5
    assert all(np.isfinite(v).all() for v in network.weights.values())
