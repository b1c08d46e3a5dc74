import numpy as np
import pytest
from helpers import DATA, clashing, rows

from kbforge.llm import pairs

CASES = [
    ("how tall is the north tower", "45 metres", None),
    ("how tall is the north tower", "The north tower is 45 metres tall.", None),
    ("how tall is the north tower", "... 45 metres", None),
    ("how tall is the north tower", 'about 45 metres, "give or take"', None),
    ("who built the north tower", "A. L. Smith", None),
    ("who built the north tower", "Anna van der Berg", None),
    ("what is the local name", '"le vieux port" or "der alte Hafen"', None),
    ("why can ships not enter the bay", "Sorry sights of 1853 show that ships cannot enter the bay because of the sand bar.", None),
    ("wann wurde die Mühle gebaut", "im Jahr 1820", None),
    ("quand le moulin fut-il construit", "en 1820", None),
    ("how tall is the north tower", "The north tower is 45 met", "truncated"),
    ("how tall is the north tower", "The north tower is 45 metres tall and has...", "truncated"),
    ("how tall is the north tower", 'The north tower is 45 ("', "truncated"),
    ("how tall is the north tower", "The north tower is,", "truncated"),
    ("how tall is the north tower", "I'm sorry, but I can't help with that request.", "refusal"),
    ("how tall is the north tower", "as a language model, i must decline to respond at this time.", "refusal"),
    ("wann wurde die Mühle gebaut", "Leider kann ich diese Frage nicht beantworten.", "refusal"),
    ("quand le moulin fut-il construit", "Je ne peux pas répondre à cette question, veuillez consulter un spécialiste.", "refusal"),
    ("how tall is the north tower", "HOW TALL IS THE NORTH TOWER", "copy"),
    ("how tall is the north tower", "Q: how tall  is the north tower ??", "copy"),
    ("how tall is the north tower", "- **how tall is the north tower**", "copy"),
    ("how tall is the north tower", "La tour du nord garde le vieux port depuis le moyen âge.", "language"),
    ("how tall is the north tower", "Башня была построена после большого пожара.", "language"),
    ("how tall is the north tower", "北方的塔楼记录了漫长的冬天。", "language"),
    ("wann wurde die Mühle gebaut", "The mill was built by the town in 1820.", "language"),
]


@pytest.fixture(scope="module")
def small():
    """Learnt from nothing but the seeds."""
    return pairs.learn([], [])


@pytest.fixture(scope="module")
def learnt():
    """Learnt from a sample as in production, of the larger test table where it is there."""
    import os

    import duckdb

    folder = os.path.join(os.path.dirname(DATA), "sf0.1")
    marco = f"'{folder if os.path.isdir(folder) else DATA}/ts_ms_marco.parquet'"
    rows = duckdb.execute(f"SELECT query, list_concat(coalesce(answers, []), coalesce(well_formed_answers, [])) FROM {marco} WHERE query_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY item_id) = 1 ORDER BY query_id LIMIT 1500").fetchall()
    passages = [r[0] for r in duckdb.execute(f"SELECT passage_text FROM {marco} WHERE passage_text IS NOT NULL ORDER BY item_id LIMIT 6000").fetchall()]
    return pairs.learn(rows, passages)


def found(model, query, answer):
    evidence, field = model
    parts, x = pairs.features(query, answer, evidence)
    return pairs.defect_of(parts, field.tag([x])[0])


@pytest.mark.parametrize("query,answer,defect", CASES)
def test_cases(small, query, answer, defect):
    assert found(small, query, answer) == defect


@pytest.mark.parametrize("query,answer,defect", CASES)
def test_cases_learnt(learnt, query, answer, defect):
    assert found(learnt, query, answer) == defect


#: None of these wordings is among those that the examples are composed of.
UNSEEN_REFUSALS = [
    "I'd rather not discuss that topic.", "My guidelines prevent me from responding to this.", "I am not going to respond to that.", "That is not something I am willing to go into.", "We don't give out this kind of detail.",
    "I'm not sure about that.", "It would be wrong for me to give advice here.", "I lack the knowledge for a reply.", "Please ask someone else, I don't do this.", "No comment from my side.", "I choose not to engage with this question.",
    "This request goes against my rules.", "I would like to stay away from this subject.", "Such matters are outside my competence.", "I must not give out details about this.", "You will have to look elsewhere, I can offer nothing.",
    "As an assistant I keep out of such debates.", "That's not something we can talk about.", "My training doesn't cover this.", "I won't go there.", "Our terms forbid us to tell.", "I have nothing to say on this.", "I never reply to this kind of message.", "We refrain from statements of that sort.",
]
UNLISTED_LANGUAGES = {
    "Portuguese": ["A torre do norte foi construída pela cidade depois do grande incêndio.", "O mosteiro antigo foi fechado depois da grande tempestade.", "Os barcos não podem entrar no porto por causa da areia."],
    "Dutch": ["De noordelijke toren werd na de brand door de stad gebouwd.", "Het oude klooster werd gesloten na de grote storm.", "De boten kunnen de haven niet binnen door het zand."],
    "Polish": ["Wieża północna została zbudowana przez miasto po wielkim pożarze.", "Stary klasztor został zamknięty po wielkiej burzy.", "Łodzie nie mogą wpłynąć do portu z powodu piasku."],
    "Turkish": ["Kuzey kulesi büyük yangından sonra şehir tarafından yapıldı.", "Eski manastır büyük fırtınadan sonra kapatıldı.", "Tekneler kum yüzünden limana giremiyor ve geri dönüyor."],
    "Italian": ["La torre del nord fu costruita dalla città dopo il grande incendio.", "Il vecchio monastero fu chiuso dopo la grande tempesta.", "Le barche non possono entrare nel porto a causa della sabbia."],
    "Swedish": ["Det norra tornet byggdes av staden efter den stora branden.", "Det gamla klostret stängdes efter den stora stormen."],
    "Greek": ["Ο βόρειος πύργος χτίστηκε από την πόλη μετά τη φωτιά."], "Japanese": ["北の塔は町によって建てられました。"], "Hungarian": ["A régi kolostort a nagy vihar után bezárták."],
}
GOOD_ANSWERS = [
    "The north tower was built by the town after the great fire.", "wheat, barley, rye and oats", "Photosynthesis converts light energy into chemical energy stored in glucose.", "mitochondria and chloroplasts", "a mixture of vinegar, mustard and honey",
    "It isn't known who built the tower.", "There is no answer to the riddle of the north tower.", "My Fair Lady", "The king refused to answer the request of the town.", "Not before 1820", "Anna van der Berg", "The boats were kept out by sand, reeds and low water.",
    "grey granite with thin quartz veins", "Its builder remains unknown.", "about three hundred fishermen and their families", 'He said "non possiamo entrare nel porto" and left.', "Old records name two brothers, Piet van Dijk and Jan de Groot.", "Leo I", "I. Newton",
    "a guild of weavers that had not paid its debts", "no single builder", "The council would not say, but its records name a guild.",
]


def test_unseen_refusals(learnt):
    missed = [a for a in UNSEEN_REFUSALS if found(learnt, "who built the north tower", a) != "refusal"]
    assert len(missed) <= 0.1 * len(UNSEEN_REFUSALS), missed


def test_unlisted_languages(learnt):
    every = [a for texts in UNLISTED_LANGUAGES.values() for a in texts]
    assert sum(found(learnt, "who built the north tower", a) == "language" for a in every) >= 0.9 * len(every)


def test_good_answers(learnt):
    assert [a for a in GOOD_ANSWERS if found(learnt, "who built the north tower", a)] == []


def test_other_words_around_the_query_are_no_copy(learnt):
    assert found(learnt, "when was the mill by the river built", "When was the mill by the river built, the old one?") is None




@pytest.mark.parametrize("answer", [None, "", "  ", "\n", "-", "n/a", "N/A.", '""', "none", "No answer present."])
def test_no_text(answer):
    assert not pairs.has_text(answer)


def test_held_out():
    """Trained on one half of the made examples, the field tags the clauses of the other."""
    made = [(f"what is the depth of lake {c}{i}", f"The depth of lake {c}{i} is {i + 3} metres at its lowest point.") for i, c in enumerate("abcdefghij" * 8)]
    evidence, _ = pairs.learn([], [])
    xs, ys = pairs.examples(made[:40], evidence)
    tx, ty = pairs.examples(made[40:], evidence, seed=9)
    found = pairs.ClauseField.fit(xs, ys).tag(tx)
    right = sum(int((a == b).sum()) for a, b in zip(found, ty))
    assert right / sum(map(len, ty)) >= 0.95


def test_marginals(small):
    """Against sums over all ways of tagging three clauses."""
    evidence, field = small
    x = pairs.features("a query", "One. Two is here. Three, four", evidence)[1][:3].astype(float)
    score, k = x @ field.weights, len(pairs.TAGS)
    ways = {(i, j, m): np.exp(score[0, i] + score[1, j] + score[2, m] + field.moves[i, j] + field.moves[j, m]) for i in range(k) for j in range(k) for m in range(k)}
    total = sum(ways.values())
    want = [[sum(v for w, v in ways.items() if w[t] == i) / total for i in range(k)] for t in range(3)]
    assert np.allclose(field.marginals(x[None])[0], want)


SCHEMA = "item_id long, query_id long, query string, answers array<string>, well_formed_answers array<string>"


def test_rows(spark):
    q, good = "how tall is the north tower", "The north tower is 45 metres tall."
    data = [
        (1, 1, q, None, None), (2, 2, q, [], []), (3, 3, q, ["", None, " "], ["-"]), (4, 4, q, [good], [good]), (5, 4, q, [good], [good]), (6, 5, q, ["", good], None), (7, 6, None, [good], [q]), (8, None, q, [], []), (9, 7, q, [q, good], [q]), (10, 8, q, ["word " * 20_000 + "end."], None),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    expected = {(1, "answers", "empty"): 1, (2, "answers", "empty"): 1, (3, "answers", "empty"): 1, (3, "well_formed_answers", "empty"): 1, (7, "well_formed_answers", "copy"): 1}
    got = rows(pairs.pair_defects(df), "query_id", "field", "defect")
    assert {k: v for k, v in got.items() if k[0] != 8 and k[0] != 6} == expected
    assert rows(pairs.pair_defects(clashing(df)), "query_id", "field", "defect") == got
    assert rows(pairs.pair_defects(df.unionByName(df)), "query_id", "field", "defect") == got
    assert pairs.pair_defects(df.limit(0)).count() == 0 and pairs.tagged_clauses(df).count() > 0


def test_learns_from_every_row(spark):
    """Counts of words by language and the odds of words are those of the whole table, however many rows it has."""
    q = "how tall is the north tower of town"
    data = [(i, i, f"{q} {i}", [f"The tower of town {i} is {i} metres tall, zq{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x.", "I cannot answer this question." if i % 9 else "I won't say, zounds."], None, i, f"An old passage tells of the gqx{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} near the river.") for i in range(6_500)]
    df = spark.createDataFrame(data, SCHEMA + ", passage_id long, passage_text string")
    evidence = pairs._prepared(df)[-2]
    kept, refusals = pairs.complete_pairs([(r[2], r[3]) for r in data])
    texts = [(pairs.language(x), x) for x in {*(r[6] for r in data), *(q for q, _ in kept), *(a for _, a in kept)}] + pairs.own_texts()
    scale = len(kept) / pairs.OWN_SHARE
    expected = pairs.Evidence.of(texts, refusals, [a for _, a in kept] + pairs.OWN_ANSWERS, scale)
    assert len(kept) == len(refusals) == 6_500 and expected.grams["en"]["gqx"] >= 6_500
    assert evidence.grams == {k: v for k, v in expected.grams.items() if v}
    assert evidence.floor == {k: v for k, v in expected.floor.items() if k in evidence.grams}
    assert evidence.odds == expected.odds


def test_fit_by_tasks(spark, small):
    """The gradients of tasks give the field that the driver fits by itself."""
    evidence, _ = small
    held = [(f"what is the depth of lake {c}", f"The depth of lake {c} is {i + 3} metres, or nearly so.") for i, c in enumerate("abcdefgh")]
    made = spark.createDataFrame([(x, y, 1) for x, y in pairs.made_of(held, held, evidence, "1", {})], "x binary, y binary, n long")
    here, there = pairs.fitted(made, evidence, 2.0), pairs.fitted(made, evidence, 2.0, most=0)
    assert np.allclose(here.weights, there.weights) and np.allclose(here.moves, there.moves)


def test_parts_of_wordings():
    """What an ASCII text must hold of a wording leaves out no match."""
    wordings = [a for parts in pairs.REFUSALS.values() for part in parts for a in part] + UNSEEN_REFUSALS + GOOD_ANSWERS + [a for _, a, _ in CASES]
    wordings += ["I could n't say", "we dont know", "it can not be", "cantata", "do not have access", "i have to decline", "das darf ich nicht", "keine Auskunft", "no puedo", "je ne suis pas", "je n'ai pas acces, m'est impossible", "no me es posible", "como modelo", "en tant qu'assistant", "als KI", "as an AI", "AI model", "puedo_ver", "I'll", "J'y", "expertise"]
    for text in wordings:
        expected = {name for name, pattern in [*((n, p) for n, p, _ in pairs.WORDINGS), ("speaker", pairs.SPEAKER)] if pattern.search(text)}
        assert pairs.wordings_in(text, pairs.tokens(text)) == expected, text
