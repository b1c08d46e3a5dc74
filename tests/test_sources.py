import json

from pyspark.sql import functions as F

from kbforge.sources import mappers, readers


def test_tolerant_json_lines(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "wiki_00").write_text('{"id": "1", "title": "A"}\n{broken\n{"id": "2", "title": "B"}\n')
    (tmp_path / "x" / "other").write_text('{"id": "9", "title": "Z"}\n')
    good, bad = readers.tolerant_json_lines(spark, f"file://{tmp_path}", "id string, title string", folder=True)
    assert {r["id"] for r in good.collect()} == {"1", "2"} and bad.count() == 1


def test_query_inputs(spark, tmp_path):
    (tmp_path / "v.csv").write_text('"a, b","[1.0, 2]"\nc,oops\n')
    assert [(r["text"], r["vector"]) for r in readers.query_vectors(spark, f"file://{tmp_path}/v.csv").collect()] == [("a, b", [1.0, 2.0])]
    (tmp_path / "q.txt").write_text(" one \n\n  \ntwo\n")
    assert [r["query"] for r in readers.query_lines(spark, f"file://{tmp_path}/q.txt").collect()] == ["one", "two"]


def test_parquet_ids(spark, tmp_path):
    spark.range(5).select(F.col("id").alias("x")).coalesce(1).write.parquet(f"file://{tmp_path}/p")
    assert {r["id"] for r in readers.parquet_meta(spark, f"file://{tmp_path}/p").collect()} == set(range(5))
    many = readers.parquet_meta(spark, f"file://{tmp_path}/p").repartition(3)
    assert sorted((r["id"], r["x"]) for r in many.collect()) == [(i, i) for i in range(5)]  # the row's own place, however it is read


def test_xml_dump(spark, tmp_path):
    page = "<page><title> A b </title><ns>0</ns><id>{}</id>{}<revision><id>7</id><parentid>6</parentid><timestamp>2020-01-01T00:00:00Z</timestamp><contributor><username>u</username><id>3</id></contributor><model>m</model><text>hello</text></revision></page>"
    (tmp_path / "d.xml").write_text("<mediawiki>" + page.format(1, '<redirect title="C d"/>') + page.format(2, "") + "</mediawiki>")
    known = spark.createDataFrame([(2,)], "id long")
    r = readers.xml_dump(spark, f"file://{tmp_path}/d.xml", "https://w.example/", known).collect()
    assert len(r) == 1
    assert (r[0]["id"], r[0]["title"], r[0]["redirecturl"], r[0]["revisionid"], r[0]["contributor"]["username"], r[0]["namespace"], r[0]["text"]) == (1, "A b", "https://w.example/C_d", 7, "u", "Page", "hello")


def test_passages(spark):
    row = {"query_id": 1, "query": "q", "query_type": "t", "answers": [" a ", "b"], "wellFormedAnswers": [], "passages": {"passage_text": ["x", None], "is_selected": [1, 0], "url": ["u", "v"]}}
    schema = "query_id long, query string, query_type string, answers array<string>, wellFormedAnswers array<string>, passages struct<passage_text:array<string>,is_selected:array<int>,url:array<string>>"
    got = readers.passages(spark.createDataFrame([row], schema)).orderBy("passage_id").collect()
    assert [(r["passage_id"], r["passage_text"], r["is_selected"], r["answers"]) for r in got] == [(0, "x", 1, ["a", "b"]), (1, None, 0, ["a", "b"])]


def test_featured(spark):
    double = lambda o: json.dumps(json.dumps(o))
    text = spark.createDataFrame([("p", double({"id": 1}))], "page string, raw string")
    image = spark.createDataFrame([("p", double({"id": 2})), ("p", double({"id": 3})), ("z", double({"id": 4}))], "page string, raw string")
    assert {(r["text"]["id"], r["image"]["id"]) for r in readers.featured(text, image, "id int").collect()} == {(1, 2), (1, 3)}


def test_by_extension(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "url": "u"}\n')
    (tmp_path / ".hidden").write_text("x")
    paths = [f"file://{tmp_path}/a.jsonl", f"file://{tmp_path}/.hidden"]
    assert readers.by_extension(spark, paths, "id long, url string").count() == 1


def test_mappers(spark):
    df = spark.createDataFrame([("u1", "cap", "640", "480", None), ("", "x", "1", "1", None), ("u2", None, "wide", "10", "cc0")], "image_url string, long_caption string, width string, height string, license string")
    got = {r["url"]: r for r in mappers.images(df, "vintage", "long_caption").collect()}
    assert set(got) == {"u1", "u2"} and got["u1"]["caption"] == "cap" and abs(got["u1"]["aspect_ratio"] - 4 / 3) < 1e-9
    assert got["u2"]["origin_width"] == 0 and got["u2"]["license"] == "cc0" and got["u2"]["source"] == ["vintage"]
    low = spark.createDataFrame([("l", None, "s"), ("l2", "h2", "s")], "url string, url_highres string, url_source string")
    assert [r["url"] for r in mappers.high_or_low(low).orderBy("url").collect()] == ["h2", "l"]
    schema = "id string, submitter string, authors string, title string, comments string, `journal-ref` string, doi string, `report-no` string, license string, abstract string, abstract_md5 string"
    papers = mappers.papers(spark.createDataFrame([("1", "A", "B, C and D", "t", None, None, None, None, "l", "abs", None), ("2", "A", None, "t", "c", None, None, None, "l", "abs", "m5")], schema)).orderBy("paper_id").collect()
    assert papers[0]["authors"] == ["B", "C", "D"] and papers[0]["license"] == "" and papers[1]["hash"] == "m5" and papers[1]["authors"] == []
