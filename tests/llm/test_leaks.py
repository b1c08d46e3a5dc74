import random

from helpers import clashing, rows
from pyspark.sql import functions as F

from kbforge.llm import leaks

WORDS = [f"word{i}" for i in range(400)]


def readings(text):
    """Every reading of a text, one by one."""
    doc, out = leaks.Reading(text or ""), [[]]
    for i, word in enumerate(doc.words):
        out = [[*r, word] for r in out] + ([[*r[:-1], r[-1] + word] for r in out] if i - 1 in doc.breaks else [])
    return out


def brute(docs, items, span=13):
    out = set()
    for d, text in docs:
        for reading in readings(text):
            flat = " " + " ".join(reading) + " "
            for i, item in items:
                for ws in readings(item):
                    n = min(span, len(ws))
                    if n and any(" " + " ".join(ws[k : k + n]) + " " in flat for k in range(len(ws) - n + 1)):
                        out.add((d, i))
    return out


def test_readings():
    words = lambda t: readings(t)[-1]
    assert words("The&nbsp;<b>Old</b> br<i>id</i>ge, ca<wbr>f&eacute;!") == ["the", "old", "bridge", "café"]
    assert words("zero​width so­ft ﬁne") == ["zerowidth", "soft", "fine"]
    assert sorted(readings("his-\ntory of well-\r\n  known")) == sorted([["history", "of", "wellknown"], ["his", "tory", "of", "well", "known"], ["history", "of", "well", "known"], ["his", "tory", "of", "wellknown"]])
    assert words("> one set-\n> tlement") == words("one set­\ntlement") == words("one set-<br/>tlement") == ["one", "settlement"]
    assert words("[the link](https://a.example/x y) [[Target page|shown]] **bold** _it_") == ["the", "link", "https", "a", "example", "x", "y", "shown", "bold", "it"]
    assert words("[the link](https://a.example/x) ends") == ["the", "link", "ends"]
    assert words("a < b and c > d") == ["a", "b", "and", "c", "d"]


def test_breaks_of_both_kinds(spark):
    """A real hyphen and a soft one at line breaks of one window, in the document, in the item, and in both."""
    plain = "the well known keeper of the far lighthouse wrote a careful example in the winter".split()
    item = " ".join(plain)
    mixed = item.replace("well known", "well-\nknown").replace("example", "exam-\nple")
    short = "a well-\nknown exam-\nple"
    dense = "-\n".join(["a", "b", "c"] * 3000)
    docs = [(1, f"so {mixed} it is"), (2, item), (3, mixed.replace("the far", "the other")), (4, "such is a well known example of it"), (5, "a wellknown exam ple"), (6, dense), (7, "ab c " + dense)]
    items = [(1, item), (2, mixed), (3, short), (4, "abc ab cab")]
    df, idf = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 1): 1, (1, 2): 1, (2, 1): 1, (2, 2): 1, (4, 3): 1, (5, 3): 1, (6, 4): 1, (7, 4): 1}
    assert rows(leaks.leaks(df, idf), "doc_id", "item_id") == want
    few = df.where("doc_id < 6"), idf.where("item_id < 4")
    assert rows(leaks.leaks(*few, most_words=0), "doc_id", "item_id") == {k: n for k, n in want.items() if k[0] < 6}


def test_against_brute_force(spark):
    rng = random.Random(7)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.choice([1, 3, 5, 8, 12, 13, 14, 40])))) for i in range(40)] + [(90, None), (91, ""), (92, "!!"), (93, None)]
    docs = []
    for d in range(300):
        body = rng.choices(WORDS, k=rng.randrange(0, 200))
        if rng.random() < 0.6:
            source = (items[rng.randrange(40)][1]).split()
            n = min(len(source), rng.choice([4, 12, 13, 20]))
            at = rng.randrange(0, len(source) - n + 1)
            put = [rng.choice([w, w.upper(), f"<em>{w}</em>", w + ",", w[:3] + "-\n" + w[3:]] if k % 5 < 2 else [w]) for k, w in enumerate(source[at : at + n])]
            cut = rng.randrange(0, len(body) + 1)
            body[cut:cut] = put
        docs.append((d, rng.choice([" ", "\n", "  "]).join(body)))
    docs += [(1000, None), (1001, ""), (1002, "x"), (None, items[0][1]), (1003, "filler " * 100_000 + items[1][1])]
    df, idf = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {x: 1 for x in brute([x for x in docs if x[0] is not None], [x for x in items])}
    assert rows(leaks.leaks(df, idf), "doc_id", "item_id") == want
    assert rows(leaks.leaks(df, idf, most_words=0), "doc_id", "item_id") == want  # items of any number, by a join
    assert leaks.leaks(df.limit(0), idf, most_words=0).count() == 0
    assert rows(leaks.leaks(clashing(df), clashing(idf)), "doc_id", "item_id") == want
    assert leaks.leaks(df.limit(0), idf).count() == 0 and leaks.leaks(df, idf.limit(0)).count() == 0
    twice = leaks.leaks(df.withColumn("doc_id", F.lit(1).cast("long")), idf)
    assert {r["doc_id"] for r in twice.collect()} == {1}
