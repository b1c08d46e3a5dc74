import pytest
from helpers import clashing, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from kbforge.llm.chunking import boundary_of, split_oversized, split_text

SENTENCE = "The old bridge crosses the river near the mill. "


def text_of(parts):
    return "".join(parts)


@pytest.mark.parametrize(
    "text,kind",
    [
        ("\n\n".join([SENTENCE * 10] * 6), "paragraph"),
        ("\r\n \t\r\n".join([SENTENCE * 10] * 6), "paragraph"),
        (SENTENCE * 60, "sentence"),
        ("line without end\n" * 200, "sentence"),
        ("旧桥在河边。" * 500, "sentence"),
        ("word, " * 500, "word"),
        ("x" * 3000, "none"),
        ("a" * 682 + " " + "b" * 682 + " " + "c" * 682 + " d", "word"),
        ("a" * 683 + " " + "b " * 900, "none"),
        ("\n\n".join(["x" * 682] * 4), "paragraph"),
        ('He said "yes." ' * 200, "sentence"),
    ],
)
def test_boundary(text, kind):
    assert boundary_of(text) == kind


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([SENTENCE, "short. ", "word ", "\n\n", "x" * 50, "y" * 300, "。", "é ", "\r\n"]), min_size=1, max_size=120), st.sampled_from([60, 200, 900]), st.integers(0, 1))
def test_pieces(parts, limit, overlap):
    text = text_of(parts)
    found = split_text(text, limit, overlap)
    assert found[0][0] == 0 and found[-1][2] == len(text)
    for (a, new, b), after in zip(found, [*found[1:], None]):
        assert a <= new <= b and b - a <= limit
        assert new - a <= limit // 3
        if after:
            assert after[1] == b and (after[0] < b or not overlap or b == 0)


def test_cuts_at_strongest_boundary():
    text = "\n\n".join([SENTENCE * 12] * 5)
    for _, new, _ in split_text(text)[1:]:
        assert text[:new].endswith("\n\n")
    text = SENTENCE * 60
    pieces = split_text(text)
    for a, new, _ in pieces[1:]:
        assert text[a:new] == SENTENCE
    assert len(pieces) == 2


def test_rows(spark):
    long = SENTENCE * 60
    data = [(1, 1, 0, long), (2, 1, 0, long), (3, 1, 1, "short"), (4, 1, 2, None), (5, 2, 0, ""), (6, None, 0, long), (7, 2, 1, "z" * 100_000), (8, 2, 2, "x" * 2048), (9, 2, 3, "x" * 2049)]
    df = spark.createDataFrame(data, "id long, source_id long, chunk_index long, chunk_text string")
    found = split_oversized(df)
    keys = rows(found.where("piece_index = 0"), "source_id", "chunk_index", "boundary")
    assert keys == {(1, 0, "sentence"): 1, (None, 0, "sentence"): 1, (2, 1, "none"): 1, (2, 3, "none"): 1}
    assert all(len(r["chunk_text"]) <= 2048 for r in found.collect())
    assert rows(split_oversized(clashing(df)).select(*found.columns)) == rows(found)
    assert split_oversized(df.limit(0)).count() == 0
