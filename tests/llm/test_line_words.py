"""Repeated runs of few lines but many words, against every run of every length."""

import random

import pytest

from tallyloom.llm import line_dedup
from tests.llm.brute import _BREAK, _WORD

SCHEMA = "doc_id long, text string"
LICENSE = "This work is licensed under the GNU General Public License, version 3."


def removed(docs, min_lines, min_words):
    """{doc_id: numbers of the lines of all repeated runs}, by looking at every run."""
    seen, gone = set(), {d: set() for d, _ in docs}
    for d, t in sorted(docs):
        lines = _BREAK.split(t)
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                run = tuple(lines[i:j])
                if not all(_WORD.search(x) for x in run):
                    break
                if j - i >= min_lines or sum(len(x.split()) for x in run) >= min_words:
                    if run in seen:
                        gone[d].update(range(i, j))
                    seen.add(run)
    return gone


def test_one_long_line_is_a_run(spark):
    rows = [(d, f"own {d}\n{LICENSE}\nshort line\nend {d}") for d in range(5)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, SCHEMA), min_words=10).collect()}
    assert out[0] == rows[0][1]
    # the short line goes as well: with the long one it is a repeated run of two lines
    assert {out[d] for d in range(1, 5)} == {f"own {d}\nend {d}" for d in range(1, 5)}
    alone = [(0, LICENSE), (1, LICENSE), (2, "short line"), (3, "short line")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(spark.createDataFrame(alone, SCHEMA), min_words=10).collect()}
    assert out == {0: LICENSE, 1: "", 2: "short line", 3: "short line"}


@pytest.mark.parametrize(("min_lines", "min_words"), [(3, 10), (5, 6), (1, 4), (3, 1)])
def test_agrees_with_every_run(spark, min_lines, min_words):
    own = random.Random(min_lines * 100 + min_words)
    lines = [" ".join(f"{c}{i}" for i in range(n)) for c, n in zip("abcdefgh", (1, 1, 2, 3, 4, 5, 9, 12), strict=True)]
    rows = [(d, "\n".join(own.choice([*lines, f"only {d} {k}"]) for k in range(own.randrange(1, 9)))) for d in range(60)]
    docs = spark.createDataFrame([*rows, rows[0]], SCHEMA)  # a repeated row is one document
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(docs, min_lines=min_lines, min_words=min_words).collect()}
    for d, gone in removed(rows, min_lines, min_words).items():
        kept = [x for i, x in enumerate(dict(rows)[d].split("\n")) if i not in gone]
        assert (got[d]["n_removed"], got[d]["text"]) == (len(gone), "\n".join(kept))
