import random

import numpy as np
from helpers import clashing, rows

from kbforge.llm import quality

SENTENCES = ["The old bridge crosses the river near the mill.", "After the flood, a new road was built along the coast.", "It remains in use today, but the date is disputed."]


def make(kind, rng):
    n = rng.randrange(6, 25)
    if kind == "prose":
        return rng.choice(["", "Heading\n\n"]) + rng.choice([" ", "\n\n"]).join(rng.choices(SENTENCES, k=n))
    if kind == "list":
        return rng.choice(["", SENTENCES[0] + "\n"]) + "\n".join(f"- {rng.choice(['the mill', 'Old Harbour', 'a bridge'])}" for _ in range(n))
    if kind == "table":
        return rng.choice(["", SENTENCES[1] + "\n"]) + "\n".join("| " + " | ".join(str(rng.randrange(9999)) for _ in range(4)) + " |" for _ in range(n))
    return "".join(rng.choice("abcdefXYZ0123456789+/") for _ in range(60 * n)) if rng.random() < 0.5 else "\n".join(f"ERROR 2024-01-01 worker[{i}] status=500 key={rng.randrange(10**9):x}" for i in range(n))


def corpus(n, seed):
    rng = random.Random(seed)
    kinds = [rng.choice(quality.KINDS) for _ in range(n)]
    return [make(k, rng) for k in kinds], kinds


def test_held_out_accuracy():
    texts, kinds = corpus(300, 1)
    model = quality.train([t.encode() for t in texts], kinds)
    texts, kinds = corpus(300, 2)
    shares, lines = quality.label_shares(model, [t.encode() for t in texts])
    assert np.mean(np.array(quality.KINDS)[shares.argmax(1)] == np.array(kinds)) >= 0.97
    assert abs(shares.sum(1) - 1).max() < 1e-5 and (lines > 0).all()


def test_counts_don_t_hang_on_the_batch():
    texts = [t.encode() for t in corpus(40, 3)[0]] + ["日本。中文\nünï".encode(), b"", b"  \n ", b"\r\nx\r\n"]
    doc, bins, n = quality.measure(texts)
    for k, t in enumerate(texts):
        _, own, m = quality.measure([t])
        assert (own == bins[doc == k]).all() and all((m[c] == n[c][doc == k]).all() for c in m)


def test_long_line_counts(monkeypatch):
    text = (b"word, 12 | " * 5000)[:-1]
    usual = quality.measure([text])[2]
    monkeypatch.setattr(quality, "FIELD", 8)  # the line is too long for packed counts then
    assert all((usual[c] == v).all() for c, v in quality.measure([text])[2].items())


def test_rows(spark):
    texts, kinds = corpus(200, 4)
    data = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, " \n "), (None, "text"), (903, "The mill. " * 300_000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(kinds)] + [(None, "prose"), (1, None), (2, "unknown"), (5000, "list")], "doc_id long, label string")
    got = quality.document_labels(df, labels)
    found = {r["doc_id"]: r["kind"] for r in got.collect()}
    assert set(found) == {*range(200), 903} and found[903] == "prose"
    assert np.mean([found[i] == k for i, k in enumerate(kinds)]) >= 0.97
    assert rows(quality.document_labels(clashing(df), clashing(labels)), "doc_id", "kind") == rows(got, "doc_id", "kind")
    assert quality.document_labels(df, labels.limit(0)).count() == 0 and quality.document_labels(df.limit(0), labels).count() == 0
    stats = {r["doc_id"]: r for r in quality.statistics(df).collect()}
    assert stats[900]["n_words"] == stats[901]["n_lines"] == 0 and stats[903]["n_words"] == 600_000
