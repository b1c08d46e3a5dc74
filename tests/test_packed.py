import random
from dataclasses import replace

import pytest
from helpers import clashing, rows
from pyspark.sql import functions as F

from kbforge.operators.packed import CODES, NAMES, Packed, Splitter, infer_delimiters, split_packed

AUTHORS = [
    ("A. One; B. Two", ["A. One", "B. Two"]),
    ("One, A.|Two, B.|", ["One, A.", "Two, B."]),
    ("A One,, B Two , ", ["A One", "B Two"]),
    ("A One, and\n B Two and C Three & D Four", ["A One", "B Two", "C Three", "D Four"]),
    ("A One\r\nB Two\nC Three", ["A One", "B Two", "C Three"]),
    ("A\tOne, B\n Two", ["A One", "B Two"]),
    ('"One, A." and "Survey and Mapping Group"', ["One, A.", "Survey and Mapping Group"]),
    ('"A ""Nick"" One","Two, B."', ['A "Nick" One', "Two, B."]),
    ("A One (Dept of X, Y; Z) and B Two", ["A One (Dept of X, Y; Z)", "B Two"]),
    ('["One, A.", "Two, B."]', ["One, A.", "Two, B."]),
    ("['One']", ["One"]),
    ("A One", ["A One"]),
    ("Sandy Alexander", ["Sandy Alexander"]),
    ("A; B and C", ["A", "B", "C"]),
    ('A "One, B Two', ['A "One', "B Two"]),
    ("((((, a", ["((((", "a"]),
    (None, []), ("", []), ("  ", []), ("[]", []), (" ,; | ", []), ('""', []),
]
CATEGORIES = [
    ("a.B c.D", ["a.B", "c.D"]), ("a.B|c.D;e.F,g.H/i.J\tk", ["a.B", "c.D", "e.F", "g.H", "i.J", "k"]), ('"Maps, charts",a.B,"c.D"', ["Maps, charts", "a.B", "c.D"]), ("['a.B', 'c.D']", ["a.B", "c.D"]), (" a.B,,", ["a.B"]),
]


@pytest.mark.parametrize("text,expected", AUTHORS)
def test_authors(text, expected):
    assert Splitter(NAMES).split(text) == expected


@pytest.mark.parametrize("text,expected", CATEGORIES)
def test_categories(text, expected):
    assert Splitter(CODES).split(text) == expected


def test_long_text():
    text = ", ".join(f"A{i} B" for i in range(100_000))
    assert len(Splitter(NAMES).split(text)) == 100_000
    assert len(Splitter(NAMES).split("(" * 50_000)) == 1


def test_rows(spark):
    data = [(1, "A; B", "x y"), (1, "A; B", "x y"), (2, None, ""), (None, "C", "z")]
    df = spark.createDataFrame(data, "id long, authors string, categories string")
    expected = {(1, "authors", 1, "A"): 2, (1, "authors", 2, "B"): 2, (1, "categories", 1, "x"): 2, (1, "categories", 2, "y"): 2}
    assert rows(split_packed(df, "id", (NAMES, CODES)), "id", "field", "pos", "value") == expected
    assert rows(split_packed(clashing(df), "id", (NAMES, CODES)), "id", "field", "pos", "value") == expected
    assert split_packed(df.limit(0), "id", (NAMES, CODES)).count() == 0


def test_delimiter_by_source(spark):
    data = [("s", "A B; C D"), ("s", "E F"), ("c", "A B, C D"), ("c", "E, F"), (None, "A\nB")]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "id long, src string, authors string")
    found = {r["source"]: r["ranking"][0] for r in infer_delimiters(df, NAMES, F.col("src")).collect()}
    assert found == {"s": "semicolon_bar", "c": "comma_and", None: "line_break"}
    values = {(r["id"], r["pos"]): r["value"] for r in split_packed(df, "id", (NAMES,), F.col("src")).collect()}
    assert values == {(0, 1): "A B", (0, 2): "C D", (1, 1): "E F", (2, 1): "A B", (2, 2): "C D", (3, 1): "E", (3, 2): "F", (4, 1): "A", (4, 2): "B"}


def test_piece_counts_decide(spark):
    """Of two delimiters that divide every row, the one with the steadier piece count ranks first, here against its strength."""
    steady, unsteady = ("A,B;C", "A,B;C", "A,B;C"), ("A,B;C", "A,B;C;D;E;F;G", "A,B;C;D")
    rows_of = lambda texts: spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id long, authors string")
    loose = Packed("authors", (("semicolon", ";"), ("comma", ",")), "[^,;]+")
    assert infer_delimiters(rows_of(steady), loose, F.lit("s")).first()["ranking"][0] == "semicolon"
    assert infer_delimiters(rows_of(unsteady), replace(loose, families=loose.families[::-1]), F.lit("s")).first()["ranking"][0] == "comma"


def test_expressions_follow_python(spark):
    """Every string without nesting gives the same by column expressions as in Python."""
    rng = random.Random(5)
    parts = ["A One", "B. Two", "and", "&", ",", ";", "|", "\n", " ", "  ", "'x'", "Ä. Öz", "a.B", "/", "\t", "\r\n", "-", "O'C"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(400)] + [x for x, _ in AUTHORS + CATEGORIES]
    df = spark.createDataFrame([(i, x, x) for i, x in enumerate(texts)], "id long, authors string, categories string")
    got = rows(split_packed(df, "id", (NAMES, CODES)), "id", "field", "pos", "value")
    rankings = {f.column: infer_delimiters(df, f, F.lit(None)).first()["ranking"] for f in (NAMES, CODES)}
    want = {(i, f.column, n, v): 1 for f in (NAMES, CODES) for i, x in enumerate(texts) for n, v in enumerate(Splitter(f).split(x, rankings[f.column]), 1)}
    assert got == want
