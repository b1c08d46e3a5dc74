import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kbforge.functions import scalars, texts
from kbforge.functions import vectors as V
from kbforge.operators.export import csv_line, python_csv_line, shard_fold


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


def arr(*values):
    return F.array(*[F.lit(float(v)) for v in values])


def test_cosine(spark):
    assert one(spark, V.cosine(arr(1, 0), arr(0, 1))) == 0
    assert one(spark, V.cosine_distance(arr(1, 0), arr(-1, 0))) == 2
    assert one(spark, V.cosine(arr(0, 0), arr(1, 0))) is None
    assert one(spark, V.cosine(F.lit(None).cast("array<double>"), arr(1, 0))) is None
    assert one(spark, V.l2_distance(arr(3, 0), arr(0, 4))) == 5


def test_normalise(spark):
    assert one(spark, V.normalise(arr(3, 4))) == [0.6, 0.8]
    assert one(spark, V.normalise(arr(0, 0))) == [0, 0]
    assert len(one(spark, V.mrl(arr(*range(300)), 128))) == 128 and len(one(spark, V.mrl(arr(*range(300)), 999))) == 128
    assert one(spark, V.mrl(arr(3, 4), 256)) == [0.6, 0.8] and one(spark, V.mrl(arr(3, 4), None)) == [3, 4]


def test_quantise(spark):
    values = [-1, -0.3, 0, 0.3, 1, 0.1, -0.15, 0.123]
    want = np.rint(np.clip(0.3 + np.array(values), 0, 0.6) / (0.6 / 255)).astype(int).tolist()
    assert one(spark, V.quantise8(arr(*values))) == want
    c = np.rint(np.clip(0.18 + np.array(values), 0, 0.36) / (0.36 / 15)).astype(int)
    assert one(spark, V.quantise4(arr(*values))) == ((c[::2] << 4) | c[1::2]).tolist()
    with pytest.raises(Exception, match="even number"):
        one(spark, V.quantise4(arr(1, 2, 3)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab cdé", min_size=1, max_size=60), max_size=12), st.integers(12, 90), st.integers(0, 2))
def test_chunks_keep_every_word(parts, size, overlap):
    parts = [" ".join(p.split()) for p in parts if p.split()]
    chunks = texts.fold_chunks(parts, size, overlap)
    words = " ".join(parts).split()
    if overlap == 0:
        assert " ".join(chunks).split() == words
    at = 0
    for chunk in chunks:
        assert set(chunk.split()) <= set(words)
        at += 1
    assert bool(chunks) == bool(words)


def test_chunk_sizes_and_overlap():
    parts = [f"Sentence number {i} is here." for i in range(200)]
    chunks = texts.fold_chunks(parts, 300, 1)
    assert all(len(c) < 300 for c in chunks)
    for a, b in zip(chunks, chunks[1:]):
        assert b.startswith(a[a.rfind("Sentence") :])
    assert texts.fold_chunks([], 300, 1) == []
    long = texts.fold_chunks(["word " * 400], 300, 0)
    assert all(len(c) < 300 for c in long)


def brute_snippet(text, term, most=250, padding=70):
    if len(text) <= most:
        return text
    at = text.lower().find(term.lower()) if term else -1
    if at < 0:
        return text[: most - 3] + "..."
    a, b = max(0, at - padding), min(len(text), at + len(term) + padding)
    pre, post = "..." if a else "", "..." if b < len(text) else ""
    room, inside = most - len(pre) - len(post), text[a:b]
    if len(inside) > room:
        q = at - a
        if len(term) >= room:
            inside = inside[q : q + room]
        else:
            s = max(0, q - (room - len(term)) // 2)
            if s + room > len(inside):
                s = max(0, len(inside) - room)
            inside = inside[s : s + room]
    return pre + inside + post


def test_snippet(spark):
    rng = random.Random(1)
    cases = []
    for _ in range(200):
        text = "".join(rng.choice("abcdef ") for _ in range(rng.randrange(0, 700)))
        at, n = rng.randrange(0, max(1, len(text))), rng.choice([0, 1, 5, 60, 130, 260])
        cases.append((text, text[at : at + n] if rng.random() < 0.8 else "zzz"))
    df = spark.createDataFrame(cases, "text string, term string")
    for r in df.select("text", "term", texts.snippet(F.col("text"), F.col("term")).alias("s")).collect():
        assert r["s"] == brute_snippet(r["text"], r["term"])


def test_join_chunks(spark):
    data = [([(0, "A one. B two."), (1, "B two. C three. D four."), (3, "E five. F six. G seven.")],)]
    df = spark.createDataFrame(data, "chunks array<struct<chunk_index:long,chunk_text:string>>")
    assert df.select(texts.join_chunks(F.col("chunks")).alias("x")).first()["x"] == "A one. B two....C three....D four....E five. F six. G seven."


@pytest.mark.parametrize("name,slug", [("Hello World!.MP4", "hello-world-mp4"), ("", "file"), ("---", "file"), ("Ünï", "n"), ("a" * 50, "a" * 20 + "-" + "a" * 19), (None, None)])
def test_slug(spark, name, slug):
    assert one(spark, texts.file_slug(F.lit(name).cast("string"))) == slug


@pytest.mark.parametrize("raw,fixed", [("1:2,3", "00:01:02,300"), ("01:02.345", "00:01:02,345"), ("01:02:345", "00:01:02,345"), ("x", None), ("1,2", None), (None, None)])
def test_subtitle_time(spark, raw, fixed):
    assert one(spark, texts.subtitle_time(F.lit(raw).cast("string"))) == fixed


def test_millis_round_trip(spark):
    df = spark.range(0, 90_000_000, 777_777).select("id", texts.subtitle_millis(texts.millis_stamp(F.col("id"))).alias("x"))
    assert all(r["id"] == r["x"] for r in df.collect())


@pytest.mark.parametrize("fields", [["a", "b,c"], ['say "x"', ""], ["line\nbreak", "é"], ["1", "2"]])
def test_csv_line(spark, fields):
    assert one(spark, csv_line(*[F.lit(x) for x in fields])) == python_csv_line(fields)


def test_shard_fold():
    assert shard_fold([5, 5, 5, 50, 1], 0, 2, 12) == [0, 0, 1, 2, 3]


def test_og_images(spark):
    html = '<meta property="og:image" content="a"><meta property="og:image:width" content="10"><meta property="og:image:height" content="10"><meta property="og:image" content="b"><meta property="og:image" content="c"><meta property="og:image:width" content="9"><meta property="og:image:height" content="20">'
    best = one(spark, texts.largest_image(F.lit(html)))
    assert (best["url"], best["width"], best["height"]) == ("c", 9, 20)
    assert one(spark, texts.largest_image(F.lit("<html>"))) is None


def test_captions(spark):
    block = 'x\n  caption.long: "A long one."  \ncaption.short:"Short"\n'
    assert one(spark, texts.caption_part(F.lit(block), "long")) == "A long one."
    assert one(spark, texts.caption_part(F.lit(block), "short")) == "Short"
    assert one(spark, texts.caption_part(F.lit("none"), "short")) is None


def test_scalars(spark):
    assert one(spark, scalars.percent(F.lit(1), F.lit(2))) == "50.0%" and one(spark, scalars.percent(F.lit(1), F.lit(0))) == "0.0%"
    assert [one(spark, scalars.right_angle(F.lit(x))) for x in (0, 44, 45, 46, 134, 135, 136, 225, 315, 316, 359, -10)] == [0, 0, 0, 90, 90, 90, 180, 180, 270, 0, 0, 0]
    assert [s["end"] for s in one(spark, scalars.sections(F.lit(1300)))] == [600, 1200, 1300]
    assert [s["end"] for s in one(spark, scalars.sections(F.lit(5)))] == [5]
    assert one(spark, scalars.content_kind(F.lit(b"%PDF-1.4"))) == "PDF" and one(spark, scalars.content_kind(F.lit(b"ok"))) == "TEXT" and one(spark, scalars.content_kind(F.lit(b"\xff\xfe\xff"))) is None
    assert one(spark, scalars.paper_path(F.lit("math/0601001"), F.array(F.lit("v1"), F.lit("v2")), "r")) == "r/math/pdf/0601/0601001v2.pdf"
    assert one(spark, scalars.image_gate(F.lit(255), F.lit(900), F.lit("JPEG"))) == "reject" and one(spark, scalars.image_gate(F.lit(8000), F.lit(900), F.lit("JPEG"))) == "shrink"
    with pytest.raises(Exception, match="identity"):
        one(spark, scalars.identity(F.lit(""), F.lit(None).cast("string")))
