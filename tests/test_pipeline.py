import numpy as np
from pyspark.sql import functions as F

from kbforge import schema, service
from kbforge.functions import markup
from kbforge.operators import export, pipeline
from kbforge.providers import HashEmbedder
from kbforge.sources import objects


def getter(url):
    if "bad" in url:
        raise OSError("no such address")
    return b"%PDF-1.4 x" if "pdf" in url else b"plain text"


def test_fetch_and_validate(spark):
    df = spark.createDataFrame([(1, "h1", "http://x/pdf1"), (2, "h2", "http://x/bad"), (3, "h3", "http://x/text"), (4, "h4", "http://x/pdf4")], "id long, hash string, url string")
    stored = spark.createDataFrame([("papers/h4.pdf",)], "key string")
    got = {r["id"]: r for r in pipeline.fetch_changes(df, stored, getter, "b", "papers", "papers", "PDF").collect()}
    assert got[1]["origin_storage_id"] == "s3://b/papers/h1.pdf" and got[4]["origin_storage_id"] == "s3://b/papers/h4.pdf" and got[4]["content"] is None
    assert got[2]["origin_storage_id"] == "" and "no such" in got[2]["error"] and got[3]["error"] == "unexpected kind of file"
    rows = spark.createDataFrame([(1, False, "a"), (2, None, "b"), (3, True, "c")], "id long, validated boolean, origin_storage_id string")
    contents = spark.createDataFrame([(1, bytearray(b"%PDF")), (2, bytearray(b"x")), (3, bytearray(b"x"))], "id long, content binary")
    assert {(r["id"], r["validated"], r["origin_storage_id"]) for r in pipeline.validation_changes(rows, contents).collect()} == {(1, True, "a"), (2, False, "")}


def test_retry():
    seen, waits = [], []

    def flaky(x):
        seen.append(x)
        if len(seen) < 3:
            raise OSError
        return b"ok"

    assert objects.retrying(flaky, 3, 1.0, waits.append)("u") == b"ok" and waits == [1.0, 2.0]


def test_objects(spark, tmp_path):
    path = f"file://{tmp_path}/a/b.json"
    assert not objects.exists(spark, path)
    objects.put_json(spark, path, {"b": 1, "a": "é"})
    assert objects.exists(spark, path) and objects.get_json(spark, path) == {"a": "é", "b": 1}
    assert objects.files(spark, f"file://{tmp_path}", "*.json").count() == 1
    objects.write_objects(spark.range(10), f"file://{tmp_path}/rows", "id")
    assert spark.read.json(f"file://{tmp_path}/rows").count() == 10


def test_embed_documents(spark):
    docs = spark.createDataFrame([(1, "T", "u", "One sentence. Another one."), (2, "T2", "u2", "  "), (3, "T3", "u3", "Here already.")], "id long, title string, url string, text string")
    existing = spark.createDataFrame([(3, 0)], "source_id long, chunk_index long")
    got = pipeline.embed_documents(docs, existing, HashEmbedder(8)).collect()
    assert [(r["source_id"], r["chunk_index"], r["title"], len(r["vector"])) for r in got] == [(1, 0, "T", 8)]


def test_image_and_caption_changes(spark):
    images = spark.createDataFrame([(1, 300, 300, "JPEG"), (2, 10, 300, "JPEG"), (3, 300, 300, "PNG")], "id long, origin_width long, origin_height long, format string")
    contents = spark.createDataFrame([(1, bytearray(b"abc")), (2, bytearray(b"x")), (3, None)], "id long, content binary")
    got = {r["id"]: r for r in pipeline.image_changes(images, lambda xs: [[float(len(x))] for x in xs], contents).collect()}
    assert got[1]["vector"] == [3.0] and got[2]["action"] == "reject" and got[3]["error"] == "no content"
    todo = spark.createDataFrame([(1, "u", ""), (2, "v", "has one")], "id long, url string, caption_long string")
    made = pipeline.caption_changes(todo, lambda u: f'caption.long: "Long {u}"\ncaption.short: "Short"').collect()
    assert [(r["id"], r["caption_long"], r["caption"]) for r in made] == [(1, "Long u", "Short")]


def test_caption_subtitles(spark):
    df = spark.createDataFrame([("v", '[{"start":"0:02.5","end":"0:03:250","text":"B"},{"start":"0:01,0","end":"0:02,0","text":"A"},{"start":"x"}]')], "video string, json string")
    assert export.subtitles(pipeline.caption_subtitles(df), "video").first()["srt"] == "1\n00:00:01,000 --> 00:00:02,000\nA\n\n2\n00:00:02,500 --> 00:00:03,250\nB\n\n"


def test_enrich(spark):
    df = spark.createDataFrame([(1, {"a": "b"}, ""), (2, None, "{}")], "id long, exif map<string,string>, meta string")
    got = pipeline.enrich(df, ["exif", "meta", "none"]).orderBy("id").collect()
    assert got[0]["exif"] == '{"a":"b"}' and got[0]["meta"] is None and got[1]["exif"] is None and got[1]["updated_at"] is not None


def test_markup(spark):
    assert markup.links('<a class="wikilink" href="File:A b.jpg"><em>x</em></a>') == f'[*x*]({markup.COMMONS}File:A_b.jpg "*x*")'
    assert markup.links('<a href="http://u" title="t">y</a>') == '[y](http://u "y")' and markup.links("<a>z</a>") == "<a>z</a>"
    file, page = markup.picture_address("A b.jpg")
    assert markup.pictures('<img src="A b.jpg" alt="pic">') == f'[![pic]({file})]({page} "pic")' and markup.pictures("<img>") == "<img>"
    assert markup.markdown_pictures("![a [b]](A_b.jpg) ![c](http://u/x.png)") == f"![a [b]]({file}) http://u/x.png"
    assert markup.links('a < b &amp; <a href="x"><b>deep</b> <a>in</a></a> <!--c--> <br/> <a href="u">never ends') == 'a < b &amp; [<b>deep</b> <a>in</a>](x "<b>deep</b> <a>in</a>") <!--c--> <br/> <a href="u">never ends'
    assert markup.pictures("<IMG SRC='http://u/x.png' title=\"t\"><em>x</em>") == '[![t](http://u/x.png)](http://u/x.png "t")<em>x</em>'
    assert markup.markdown_pictures("![a](b (c).png t) ![open ![x](y") == f'![a]({markup.picture_address("b")[0]} (c).png t) ![open ![x](y'
    df = spark.createDataFrame([('<a href="http://u">y</a>',), (None,)], "t string")
    assert [r[0] for r in df.select(markup.clean_page(F.col("t"))).collect()] == ['[y](http://u "y")', None]
    for link in ("A b", "c:X", "commons:X", "Commons:Talk:X", "image:X y", "Category:X", "talk:X"):
        from kbforge.functions import texts

        got = spark.range(1).select(texts.link_target(F.lit(link), markup.BASE, markup.COMMONS)).first()[0]
        assert got == markup.page_address(link)


def test_sentence_spans():
    text = "One. v1.2 two! 三。End"
    tokens = ["[CLS]", "One", ".", "v1", ".", "2", "two", "!", "三", "。", "End", "[SEP]"]
    offsets = [(0, 0), (0, 3), (3, 4), (5, 7), (7, 8), (8, 9), (10, 13), (13, 14), (15, 16), (16, 17), (17, 20), (0, 0)]
    chunks, spans = markup.sentence_spans(offsets, tokens, text)
    assert chunks == ["One.", " v1.2 two!"] and spans == [(1, 2), (2, 7)]


def test_schema(spark, tmp_path):
    import pytest

    assert schema.table_name("alpha") == "ii_alpha"
    with pytest.raises(ValueError):
        schema.table_name("unknown")
    t = schema.open_table(spark, f"file://{tmp_path}", "workers")
    batch = spark.sql("select 1L as id, 'a' as uuid, 'W' as workflow, timestamp'2024-01-01' as last_heartbeat")
    assert t.insert(batch) == 1 and t.insert(batch) == 0


def test_service(spark):
    e = HashEmbedder(32)
    texts_ = ["old harbour bridge", "winter valley road", "market in the town"]
    rows = [(i, i, 0, f"T{i}", f"u{i}", t, [float(x) for x in e.embed_texts([t])[0]]) for i, t in enumerate(texts_)]
    chunks = spark.createDataFrame(rows, "id long, source_id long, chunk_index long, title string, url string, chunk_text string, vector array<float>")
    found = service.hybrid_search(chunks, "harbour bridge", e, 2).collect()
    assert found[0]["text"] == "old harbour bridge" and set(found[0].asDict()) == set(service.TEXT_ITEM)
    images = spark.createDataFrame([(1, "u", [1.0, 0.0]), (2, None, [0.0, 1.0])], "id long, url string, vector array<float>")
    near = service.image_search(images, [[1.0, 0.0], [0.9, 0.1]]).collect()
    assert near[0]["url"] == "u" and near[1]["url"] == "" and near[0]["score"] == 1.0
    terms = service.term_search(images, [[1.0, 0.0], [0.0, 1.0]], [[0.6, 0.8]]).collect()
    assert [r["id"] for r in terms] == [1, 2] and abs(terms[1]["distance"] - min(0.0, np.hypot(0.6, 0.2))) < 1e-6
