import random

import pytest

from estrato.llm import lines


def brute(rows, least):
    """Rows are (doc_id, text) in order; every window of `least` filled lines that occurs before goes."""
    filled = [[x for x in (t or "").split("\n") if x.strip(" \t\r\x0b\x0c")] if t is not None else [] for _, t in rows]
    seen, out = set(), []
    for (doc, text), own in zip(rows, filled):
        gone = set()
        for i in range(len(own) - least + 1):
            key = tuple(own[i : i + least])
            if key in seen:
                gone.update(range(i, i + least))
            seen.add(key)
        runs = [{"i": i, "k": 1} for i in gone]
        out.append((doc, None if text is None else lines.without(text, runs)[0], len(own), len(gone)))
    return sorted(out, key=str)


def found(docs, least):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.without_later_copies(docs, least).collect()), key=str)


@pytest.mark.parametrize("least", [1, 2, 4])
def test_against_brute_force(make_docs, least):
    rng = random.Random(least)
    runs = [[rng.choice("abcdefghijklmnop") * 3 for _ in range(rng.randint(1, 12))] for _ in range(8)]
    rows = []
    for k in range(60):
        own = [x for _ in range(rng.randint(0, 4)) for x in (rng.choice(runs) if rng.random() < 0.5 else [str(rng.random()), "", " \t"])]
        rows.append((k, "\n".join(own)))
    rows += [(100 + k, "\n".join(runs[0] + runs[1])) for k in range(30)] + [(200, "x\n" * 40)]
    assert found(make_docs(rows), least) == brute(rows, least)


def test_edges(make_docs):
    long_text = "\n".join(f"line {k}" for k in range(20_000))
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, long_text), (5, "new\n" + long_text + "\nend"), (6, "line 1\n\n \nline 2\nown")]
    assert found(make_docs(rows), 2) == brute(rows, 2)
    assert found(make_docs([]), 2) == []


def test_repeated_rows_are_one_document_and_null_ids_come_last(make_docs):
    rows = [(7, "a\nb\nc"), (7, "a\nb\nc"), (None, "a\nb\nd"), (None, None)]
    assert found(make_docs(rows), 2) == sorted([(7, "a\nb\nc", 3, 0), (7, "a\nb\nc", 3, 0), (None, "d", 3, 2), (None, None, 0, 0)], key=str)


def test_run_length_is_checked(make_docs):
    with pytest.raises(ValueError, match="power of two"):
        lines.without_later_copies(make_docs([(1, "a")]), 3)


def test_blank_lines_go_with_what_surrounds_them():
    assert lines.without("a\n\nb\n\nc", [{"i": 0, "k": 2}])[0] == "\nc"
    assert lines.without("\na\n\n", [{"i": 0, "k": 1}])[0] == ""
