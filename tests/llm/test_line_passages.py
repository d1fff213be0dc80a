"""Passages of over 50 words on one or two lines go in the pipeline's stage."""

from __future__ import annotations

import corpus_pipeline
from tallymark.llm import line_dedup


def line(name: str, n: int) -> str:
    return " ".join(f"{name}{i}" for i in range(n))


def test_long_passages_on_few_lines_go(spark):
    one, two, short = line("a", 51), f"{line('b', 26)}\n{line('c', 25)}", f"{line('d', 25)}\n{line('e', 25)}"
    rows = [
        (1, f"{one}\nfirst"),
        (2, f"second\n{one}\nend"),
        (3, one),
        (4, f"{two}\n\n{short}"),
        (5, f"x\n{two.replace(chr(10), chr(10) * 2)}\ny"),
        (6, f"{short}\nz"),
        (7, f"{line('b', 26)}\nalone"),
    ]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    kept = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.unrepeated_lines(spark, docs, "").collect()}
    want = {1: rows[0][1], 2: "second\nend", 4: rows[3][1], 5: "x\n\ny", 6: rows[5][1], 7: rows[6][1]}
    assert kept == {i: (t, len(t)) for i, t in want.items()}


def test_runs_of_lines_of_both_kinds_are_counted(spark):
    parts = [line("a", 60), "k l", "m n", "o p", line("b", 60), "q r"]
    text = "\n".join(parts)
    rows = [(1, text), (2, "\n".join(["s", parts[0], "t", *parts[1:4], "u", parts[4], "v"])), (3, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_removed, r.n_runs, r.kept_text) for r in line_dedup.cut_lines(docs, words=50).collect()}
    assert found == {1: (0, 0, text), 2: (5, 3, "s\nt\nu\nv"), 3: (6, 1, "")}
