"""Broken prompt and response pairs: a conditional random field tags the clauses of each answer as answer, refusal,
echo, foreign or unfinished; the clauses' coverage gives the pair its defect.

The field is linear-chain and fitted at run time, since the tables carry no labels: the complete answers of all pairs
are kept as they are, cut off, replaced by the query, by a refusal composed from phrases, or by an answer in another
language. Features see the clause, its place and the query. Equal examples count as one with their number as weight,
so that the fit grows with the different ones: few are worked on by the driver, more by tasks, all of them always.
Counts, tags and defects cover every pair.

Two kinds of evidence are learnt from all pairs and all passages, each text once:

* what words of each language look like: character trigrams, and how unlikely a word may be before it counts as
  foreign (a quantile of the language's own words, each held against the counts without itself). It tells languages
  that no list here knows.
* which words speak of answering and not of the matter: the log-odds of each word in refusals against answers. Refusals
  are the composed ones and those of the table that the features of person, stance and talk mark and that hold
  nothing of the query.

The composed refusals and the pairs of our own keep their share in a large table: beyond OWN_SHARE pairs they count in
proportion to the pairs. For a share of the examples the features that rest on wordings and word lists are left out, so that the others carry
weight of their own.

Defined results: without any answer text a pair is ``empty`` (a null or empty array only in ``answers``); of several
answers one good answer is enough; a null query can't be copied and has no language; repeated deliveries of a query
count once, the row with the smallest item_id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbforge.staging import Stage

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
DEFECT = {"refusal": "refusal", "echo": "copy", "foreign": "language", "unfinished": "truncated"}
FIELDS = ("answers", "well_formed_answers")
#: Queries that one task works on, unless that would be more than 64 tasks a core; queries that exchange their answers.
ROWS_A_TASK, ROWS_A_BUCKET = 1000, 250
#: Pairs to which the composed refusals and the pairs of our own count once.
OWN_SHARE = 1800
#: Refusals of each language that the composed ones stand for in the odds of words.
COMPOSED = 200
#: Clauses of different examples that the driver fits by itself.
FIT_HERE = 200_000

#: Function words and question words by language, for telling languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in a is was that for it as with on by at from their its this these those be were are which or an not but had has have each one another after before under over between near along into during so because while if when where who what why how did does can could would there they them he she we you his her our all than also about above behind beyond beside within across through around against my me i do cannot definition name population depth long many much",
    "de": "der die das den dem des und ist war ein eine einen einem einer nicht mit von zu im am in an auf für aus nach bei bis seit trotz während zwischen unter über wie wann wo wer was warum noch aber obwohl weil davon keine wird wurde werden sich auch als so oder sie es ich kann ihrer seiner deren welche",
    "fr": "le la les l de des du d un une et est était que qui dans en sur pour par avec au aux ne pas ce cette ces se sa son ses mais parce comme depuis pendant après sous entre malgré jusqu à nos bien quand quelle quel où pourquoi comment fut elle il je ai sont été plus",
    "es": "el la los las de del un una y es era que en por para con no se su sus al como pero porque desde durante después bajo entre hasta aunque todavía más lo a ante sobre qué cuándo cuál dónde quién cómo fue tiene son está yo me",
    "ru": "и в во не на что с со он она они как это по к ко но из у за от до для при между после под над о об так же или который была был были хотя потому без несмотря когда где кто почему я",
}
WORDS = {k: set(v.split()) for k, v in FUNCTION_WORDS.items()}
LANGUAGES_OF = {w: tuple(k for k in WORDS if k != "ru" and w in WORDS[k]) for ws in WORDS.values() for w in ws}
LETTER_SIGNS = {"de": set("äöüß"), "fr": set("éèêëàâçîïôûùœ"), "es": set("áíóúñ¿¡")}

#: Wordings for no answer at all, without marks around.
NO_ANSWER = re.compile(r"(n ?/? ?a|none|null|nil|nan|no answer|no answer present|no answer (found|available|given)|not available|unanswered|empty|keine|aucune?|ninguno|ninguna)?", re.I)

#: Parts of refusals, by what they do. They are patterns of the feature extractor and, as phrases, the
#: material of the training examples.
APOLOGY = re.compile(r"\b(i'?m (so |very )?sorry|i am (so |very )?sorry|^sorry\b(?=,|\.|!| but| i )|i apologi[sz]e|apologies|unfortunately|regrettably|es tut mir leid|tut mir leid|leider|entschuldigung|je suis désolée?|désolée?|malheureusement|lo siento|lamentablemente|desafortunadamente|perdón|извините|к сожалению|抱歉|对不起|很遗憾)", re.I)
SELF = re.compile(r"\bas an? (large )?(ai|language|artificial)\b|\b(language|ai) (model|system|assistant)\b|\bals (ki|sprachmodell|sprachsystem)\b|\ben tant qu|\bcomo (modelo|sistema|asistente)\b|как языковая", re.I)
UNABLE = re.compile(
    r"\b(can ?not|can'?t|could ?n[o']t|unable|not able|won'?t be able|will not be able|must decline|have to decline|decline to|do(n'?t| not) have (access|information|enough)|do(n'?t| not) know|not possible|impossible|refuse to|not (allowed|permitted|comfortable)"
    r"|kann [^.]{0,40}nicht|nicht (möglich|beantworten|helfen)|darf [^.]{0,30}(keine|nicht)|keine auskunft|weiß (ich )?(es )?nicht"
    r"|ne (peux|puis|suis|sais|dispose)[^.]{0,20} pas|n'ai pas (accès|le droit)|m'est impossible|impossible d"
    r"|no (puedo|me es posible|tengo acceso|dispongo|sé|es posible|estoy autorizad)|no podría)|не могу|не имею|невозможно|无法|不能",
    re.I,
)
SPEAKER = re.compile(r"\b(i|i'm|i'll|me|my|ich|mir|mich|je|j'|m'|moi|puedo|me es|tengo|siento|dispongo)\b|я |мне |我", re.I)
REQUEST = re.compile(r"\b(please|bitte|veuillez|consulte|por favor|s'il vous plaît|try another|ask (a|another)|consult|specialist|expert|professional|sensitive|at this time|based on the (material|information)|fachperson|spécialiste|especialista|help with|answer this|this question|diese frage|cette question|esta pregunta|that (request|information))\b|пожалуйста|请", re.I)

#: Words by the part they play in a refusal. PERSON: the one who answers; STANCE: not being able or willing;
#: TALK: the question, the answering and its terms.
PERSON = set("i i'm i'd i'll i've me my mine myself we we're we'd our us ich mir mich mein meine meiner wir uns je j' j'ai m' moi mon ma mes nous notre yo me mi mis nosotros puedo tengo siento debo prefiero dispongo sé estoy я мне меня мой моя мы нам нас 我 我们".split())
STANCE = set(
    "not n't cannot can't won't don't wouldn't couldn't no never nor neither unable unwilling decline refuse prevent prevents prevented prohibit prohibits forbid forbids forbidden restrict restricts restricted rather avoid refrain beyond outside against sorry apologize apologise apologies unfortunately regret regrettably afraid unsure uncertain limited impossible inappropriate nothing elsewhere without"
    " nicht kein keine keinen nie lieber leider außerhalb unmöglich verweigere ablehnen untersagt ne n' pas jamais plutôt malheureusement désolé désolée impossible refuse éviter hors tampoco nunca lamentablemente desafortunadamente imposible niego evito fuera не нет нельзя никогда отказ отказываюсь невозможно 不 无法 不能 没有".split()
)
TALK = set(
    "question questions request requests query topic topics subject matter answer answers answering respond responding response reply replying discuss discussing comment commenting opinion help helping assist assisting assistance provide providing share sharing information guidelines guideline policy policies rules instructions permitted allowed trained training programmed designed assistant model knowledge know sure idea advice conversation engage speak say tell"
    " frage fragen anfrage thema antwort antworten beantworten auskunft helfen information informationen richtlinien weiß sagen question demande sujet réponse répondre aider information informations règles directives dire sais pregunta solicitud tema respuesta responder ayudar información normas decir вопрос запрос тема ответ ответить отвечать помочь информация правила знаю сказать 问题 回答 帮助 信息 话题".split()
)

#: An English refusal put together from who, how, and what.
UNWILLING = [("I", "will not"), ("I", "do not wish to"), ("I", "may not"), ("we", "cannot"), ("I", "would sooner not"), ("I", "see no way to"), ("it is not for me to", "ever"), ("nobody asked me to", "either, so I won't"), ("my makers don't want me to", "even"), ("there is nothing I can do to", "really"), ("I'm", "not ready to"), ("this is a thing I", "never"), ("as a program I", "don't")]
ACTS = ["speak about it", "go further", "take part in this", "give any details", "explain that", "look into this", "say more", "offer a view", "tell you this", "touch on such things"]

REFUSALS = {
    "en": (["I'm sorry, but ", "Sorry, ", "Unfortunately, ", "I apologize, but ", "I apologize, however ", "As a language model, ", "As an AI system, ", "I'm afraid ", "Regrettably, ", "", "", ""], ["I cannot answer this question", "I can't help with that request", "I am unable to provide that information", "I won't be able to answer", "I must decline to respond", "I do not have access to that information", "it's not possible for me to say", "I don't know the answer", "I would prefer not to talk about this", "my instructions do not allow me to discuss this", "we are not permitted to share such details", "I refuse to comment on this matter", "this is outside of what I know", "I have no information on this subject", "I'm not comfortable giving an opinion", "I was not trained to reply to such questions", "I have no idea", *(f"{who} {how} {what}" for who, how in UNWILLING for what in ACTS)], [".", ", please try another question.", " at this time.", ". Please consult a specialist.", " because the subject is too sensitive.", " based on the material given to me", ""]),
    "de": (["Es tut mir leid, ", "Leider ", "Entschuldigung, ", ""], ["ich kann diese Frage nicht beantworten", "kann ich diese Frage nicht beantworten", "darf ich dazu keine Auskunft geben", "dabei kann ich nicht helfen", "es ist mir nicht möglich zu antworten", "meine Richtlinien erlauben mir keine Antwort", "ich möchte mich zu diesem Thema nicht äußern"], [".", ", bitte fragen Sie eine Fachperson.", ". Bitte versuchen Sie es später.", ""]),
    "fr": (["Je suis désolé, mais ", "Malheureusement ", "Désolé, ", ""], ["je ne peux pas répondre à cette question", "il m'est impossible d'aider ici", "je n'ai pas accès à cette information", "je ne suis pas en mesure de répondre", "mes règles ne me permettent pas de répondre", "je préfère ne pas parler de ce sujet"], [".", ", veuillez consulter un spécialiste.", ". Veuillez essayer une autre question.", ""]),
    "es": (["Lo siento, pero ", "Lamentablemente ", "Desafortunadamente, ", ""], ["no puedo responder a esta pregunta", "no me es posible ayudar con eso", "no tengo acceso a esa información", "no estoy autorizado a responder", "mis normas no me permiten dar esa respuesta", "prefiero no hablar de este tema"], [".", ", consulte a un especialista.", ". Por favor, intente otra pregunta.", ""]),
}

#: A few pairs of our own in each language, so that there is something to learn from in a tiny table.
SEEDS = [
    ("en", "how tall is the north tower", "The north tower is 45 metres tall and has three floors.", "45 metres"),
    ("en", "who wrote the old chronicle", "The old chronicle was written by a monk after the fire.", "a monk of the valley"),
    ("en", "when was the mill built", "The mill was built in 1820 by the town.", "in 1820"),
    ("en", "why did the harbour close", "The harbour closed because the river changed its course.", "the river changed its course"),
    ("en", "what did the captain say", 'The captain said "I will not leave my ship" before the storm.', '"I will not leave my ship"'),
    ("en", "who made the treaty", "The treaty was made by Leo I and not by our first king.", "Leo I"),
    ("en", "why did the guild leave", "The council would not answer, and the guild left without a reply.", "the council would not answer"),
    ("en", "what did the old rules say", "The rules do not tell whether a guest may speak, but they never allow a weapon.", "no weapons"),
    ("en", "what is known of the builder", "Nothing is known of the builder, and no record gives a name.", "nothing"),
    ("en", "what is a reply card", "A reply card is not a letter but a form on which an answer is given.", "a form with no envelope"),
    ("en", "how deep is the old well", "The old well is 12 metres deep, so it is said.", 'some 12 metres, "or nearly so"'),
    ("en", "where does the grey heron nest", "The grey heron nests in reeds along the lower lake.", "in reeds by the lake"),
    ("de", "wie hoch ist der Turm", "Der Turm ist an seiner höchsten Stelle 45 Meter hoch.", "45 Meter"),
    ("de", "wann wurde die Mühle gebaut", "Die Mühle wurde im Jahr 1820 von der Stadt gebaut.", "im Jahr 1820"),
    ("fr", "quelle est la hauteur de la tour", "La tour a une hauteur de 45 mètres dans son ensemble.", "45 mètres"),
    ("fr", "quand le moulin fut-il construit", "Le moulin fut construit en 1820 par une famille de la ville.", "en 1820"),
    ("es", "qué altura tiene la torre", "La torre tiene una altura de 45 metros en el centro.", "45 metros"),
    ("es", "cuándo se construyó el molino", "El molino se construyó en el año 1820 por un gremio.", "en el año 1820"),
    ("ru", "когда была построена мельница", "Мельница была построена в 1820 году после большого пожара.", "в 1820 году"),
    ("zh", "磨坊是什么时候建的", "磨坊在1820年由当地的市民建成，至今仍在使用。", "1820年"),
]
#: Words that belong to names.
NAME_PARTICLES = {"de", "der", "den", "van", "von", "dos", "das", "da", "di", "du", "del", "la", "le", "el", "al", "y", "e"}
CUT_TAILS = ["", "", "", "", "...", "…", " ...", " [...]", ",", " and", " of the", " such as", " (about", " (see", ' ("', ", which was", " because", " by"]

#: Words of a language below whose likelihood a word counts as foreign: one in so many.
QUANTILE = 8
TOKEN = re.compile(r"[^\W_]+")
SPOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
NAME = re.compile(r"(?<=[^\W_] )[A-Z][^\W\d_]+")
INITIAL = re.compile(r"\b[A-Z]\.(?=\s*\w)|(?<=[a-z] )[IVX]+\b")
QUOTED = re.compile(r"\"[^\"]*\"|“[^”]*”|«[^»]*»|„[^“]*“")
CLAUSE_END = re.compile(r"(?<=[^\W\d_]{3}[.!?])[\"')\]]*\s+|(?<=\d[.!?])\s+(?=\D)|(?<=[。！？])|(?<=[^\d\s]),\s+(?=\S)")
LABEL = re.compile(r"^\W*(q|question|query|prompt|frage|pregunta|вопрос|问)\s*[:.)]\s*", re.I)
FIRST_WORD = re.compile(r"\W*(i|ich|je|it|it's|es|il|no|ne|kann|darf)\b", re.I)
MARKUP = re.compile(r"</?[a-z][^<>]*>|&(?:quot|amp|nbsp|lt|gt|#\d+);", re.I)
ELLIPSIS = re.compile(r"(\.\s?\.\s?\.|…|\[\s*(\.\.+|…)\s*\])[\"')\]]*$")
CLOSED = re.compile(r"[.!?。！？][\"'”’»)\]]*$")
ASCII_LETTER, ASCII_DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
BEYOND_LATIN = re.compile("[^\\x00-\u024f\u1e00-\u1eff]")
MARKS = "".join(c for c in map(chr, range(128)) if not c.isalnum())
QUOTE_SIGN, CLAUSE_SIGN = re.compile("[\"“«„]"), re.compile("[.!?,。！？]")
CYRILLIC, CJK = re.compile(r"[Ѐ-ӿ]"), re.compile(r"[぀-ヿ㐀-鿿가-힯]")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).casefold())


def unquoted(text: str) -> str:
    return QUOTED.sub(" ", text) if QUOTE_SIGN.search(text) else text


def has_letter(text: str) -> bool:
    return bool(ASCII_LETTER.search(text)) or not text.isascii() and any(map(str.isalpha, text))


def has_digit(text: str) -> bool:
    return bool(ASCII_DIGIT.search(text)) or not text.isascii() and any(map(str.isdigit, text))


def script(text: str) -> str:
    if text.isascii() or not BEYOND_LATIN.search(text):
        return "latin" if has_letter(text) else ""
    letters = sum(c.isalpha() for c in text)
    if not letters:
        return ""
    if 3 * len(CJK.findall(text)) > letters:
        return "zh"
    if 2 * len(CYRILLIC.findall(text)) > letters:
        return "ru"
    return "other" if 2 * sum(c.isalpha() and c > "\u024f" and not "\u1e00" <= c <= "\u1eff" for c in text) > letters else "latin"


def language_scores(text: str) -> dict[str, float]:
    """Evidence for each language outside of quotations: function words, and half a point for telling letters."""
    plain = unquoted(text)
    return scores_of(plain, tokens(plain))


def scores_of(plain: str, found: list[str]) -> dict[str, float]:
    """``language_scores`` of a text without quotations and its words."""
    kind = script(plain)
    if kind in ("zh", "ru", "other"):
        return {kind: 9.0}
    return latin_scores(found)


def latin_scores(found: list[str]) -> dict[str, float]:
    scores = {"en": 0.0, "de": 0.0, "fr": 0.0, "es": 0.0}
    for of in filter(None, map(LANGUAGES_OF.get, found)):
        for k in of:
            scores[k] += 1.0
    for t in found:
        if not t.isascii() and t.islower():
            for k, signs in LETTER_SIGNS.items():
                scores[k] += 0.5 * (not signs.isdisjoint(t))
    return scores


class Chunks(dict):
    """What stands between two blanks, with its ``latin_scores`` in half points as one number, which can be added up."""

    BITS, MOST = 40, 200_000

    def __missing__(self, chunk: str) -> int:
        if len(self) > self.MOST:
            self.clear()
        score = self[chunk] = sum(int(2 * v) << (self.BITS * i) for i, v in enumerate(latin_scores(tokens(chunk)).values()))
        return score

    def language(self, plain: str, chunks: list[str]) -> str:
        """``language`` of a text without quotations, given what stands between its blanks."""
        kind = "latin" if plain.isascii() else script(plain)
        if kind in ("zh", "ru", "other"):
            return kind
        total = sum(map(self.__getitem__, chunks))
        return best_language({k: total >> (self.BITS * i) & ((1 << self.BITS) - 1) for i, k in enumerate(("en", "de", "fr", "es"))})


@lru_cache(8192)
def query_language(query: str) -> str:
    return language(query)


def language(text: str) -> str:
    return best_language(language_scores(text))


def best_language(scores: dict[str, float]) -> str:
    best = max(scores.values(), default=0)
    return next((k for k in ("zh", "ru", "other", "en", "de", "fr", "es") if scores.get(k, 0) == best), "en") if best else "en"


def foreignness(text: str, lang: str) -> float:
    """How much more evidence there is for another language than for ``lang``."""
    return difference(language_scores(text), lang)


def difference(scores: dict[str, float], lang: str) -> float:
    return max((v for k, v in scores.items() if k != lang), default=0.0) - scores.get(lang, 0.0)


def clauses(answer: str) -> list[str]:
    if not CLAUSE_SIGN.search(answer, 0, len(answer) - 1) and answer[-1:] not in "。！？":
        return [answer]
    out = [c for c in CLAUSE_END.split(answer) if c and TOKEN.search(c)]
    return out or [answer]


def person_words(text: str) -> list[str]:
    """Words in lower case with their apostrophes, without those of quotations and without initials of names."""
    return [w.lower().replace("’", "'") for w in SPOKEN.findall(INITIAL.sub(" ", unquoted(text)))]


def marks(words: list[str]) -> tuple[bool, bool, bool]:
    """Whether a clause speaks in the first person, takes a stance, and talks of the answering."""
    parts = {p for w in words for p in ((w, *w.split("'"), w[-3:]) if "'" in w else (w,))}
    return not PERSON.isdisjoint(parts), not STANCE.isdisjoint(parts), not TALK.isdisjoint(parts)


class Evidence:
    """What was learnt of languages and of refusals: trigram counts by language with the least likelihood of a word, and
    log-odds of words."""

    def __init__(self, grams: dict[str, dict[str, int]], odds: dict[str, float], floor: dict[str, float] | None = None):
        self.grams = grams
        self.total = {lang: float(sum(own.values())) for lang, own in grams.items()}
        self.logs = {lang: {g: math.log((n + 0.5) / (self.total[lang] + 5000.0)) for g, n in own.items()} for lang, own in grams.items()}
        self.none = {lang: math.log(0.5 / (total + 5000.0)) for lang, total in self.total.items()}
        self.place = {lang: i for i, lang in enumerate(grams)}
        self.floor = floor or {}
        self.odds = {w: max(-2.0, min(3.0, x)) for w, x in odds.items()}
        self._seen: dict[str, tuple[tuple, tuple]] = {}

    @classmethod
    def of(cls, texts: list[tuple[str, str]], refusals: list[str], answers: list[str], scale: float = 1.0) -> Evidence:
        """From texts in memory; the composed refusals count ``scale`` times."""
        words: dict[str, Counter] = {}
        for lang, text in texts:
            words.setdefault(lang, Counter()).update(plain_words(text))
        grams: dict[str, Counter] = {}
        for lang in sorted(words):
            grams[lang] = Counter()
            for w, n in words[lang].items():
                for g in trigrams(w):
                    grams[lang][g] += n
        one, two = (Counter(w for t in ts for w in set(person_words(t))) for ts in (refusals, answers))
        evidence = cls(grams, log_odds(one, two, len(refusals), len(answers), scale))
        for lang, found in words.items():
            own = sorted(evidence.likelihood(w, lang, n) for w, n in found.items() if len(w) > 2)
            evidence.floor[lang] = own[len(own) // QUANTILE] if own else -math.inf
        return evidence

    def likelihood(self, word: str, lang: str, without: int = 0) -> float:
        """Mean log-likelihood of a word's trigrams in a language, ``without`` so many occurrences of the word."""
        found = trigrams(word)
        if not without:
            logs, none = self.logs[lang], self.none[lang]
            return sum([logs.get(g, none) for g in found]) / len(found)
        grams, total = self.grams[lang], self.total[lang]
        return sum(math.log((grams[g] - without + 0.5) / (total + 5000.0)) for g in found) / len(found)

    def unlike(self, found: list[str], lang: str) -> tuple[float, int, bool]:
        """(share, number) of the words of a text that are unlikely in a language and no function words of it, and
        whether there are five words or more of which hardly one is a function word of it."""
        if lang not in self.grams or lang not in WORDS:
            return 0.0, 0, False
        others = [w for w in found if w not in WORDS[lang]]
        at, floor = self.place[lang], self.floor[lang]
        strange = sum([self._likelihoods(w)[0][at] < floor for w in others])
        return (strange / len(found) if found else 0.0), strange, len(found) >= 5 and len(found) - len(others) < 0.15 * len(found)

    def likelier(self, found: list[str], lang: str) -> float:
        """How much likelier, per trigram, the words of a text are in the best other language than in ``lang``."""
        if lang not in self.grams or len(found) < 3 or not self.total[lang]:
            return 0.0
        n = sum(map(len, found))
        score = [x / n for x in map(sum, zip(*[self._likelihoods(w)[1] for w in found]))]
        at = self.place[lang]
        return max((x for k, x in zip(self.grams, score) if k != lang and self.total[k]), default=-math.inf) - score[at] if score[at] else 0.0

    def _likelihoods(self, word: str) -> tuple[tuple, tuple]:
        """The likelihoods of a word by language, and the same times its trigrams."""
        held = self._seen.get(word)
        if held is None:
            if len(self._seen) > 500_000:  # what it has forgotten is worked out again
                self._seen.clear()
            own = tuple([self.likelihood(word, lang) for lang in self.grams])
            held = self._seen[word] = own, tuple([x * len(word) for x in own])
        return held

    def stance(self, words: list[str]) -> float:
        """Sum of the words' log-odds, each bounded; a word that no refusal holds speaks against one."""
        return sum([self.odds.get(w, -1.0) for w in set(words)]) if self.odds else 0.0


def log_odds(one: dict[str, int], two: dict[str, int], refusals: int, answers: int, scale: float) -> dict[str, float]:
    """Log-odds of each word of a refusal, from the numbers of refusals (``one``) and answers (``two``) that hold it; the
    composed refusals count ``scale`` times."""
    made = composed_words()
    n1, n2 = refusals + scale * COMPOSED * len(REFUSALS), max(1, answers)
    return {w: math.log((one.get(w, 0) + scale * made.get(w, 0) + 0.5) / (n1 + 1)) - math.log((two.get(w, 0) + 0.5) / (n2 + 1)) for w in sorted({*one, *made})}


def trigrams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def plain_words(text: str) -> list[str]:
    """Words that aren't set with a capital (names among them) nor within quotations."""
    return words_of(text)[3]


def words_of(text: str) -> tuple[list[str], str, list[str], list[str]]:
    """The words of a text, the text without quotations, the words of this, and those of them that ``plain_words`` gives."""
    plain = unquoted(text)
    if plain.isascii():
        found = TOKEN.findall(plain)
        low = [w.lower() for w in found]
        kept = [l for w, l in zip(found, low) if w[0] > "Z" and l.isalpha()]
    else:
        low = tokens(plain)
        kept = [w.lower() for w in TOKEN.findall(unicodedata.normalize("NFKC", plain)) if w[0].islower() and w.isalpha()]
    return (low if plain == text else tokens(text)), plain, low, kept


FEATURES = (
    "bias", "first", "last", "words_1", "words_3", "words_6", "words_more", "closed", "ellipsis", "open", "comma", "hanging_word", "upper", "lower", "sentence", "open_sentence",
    "bare_phrase", "in_query_some", "in_query_most", "in_query_all", "covers_some", "covers_most", "covers_all", "echo", "apology", "self", "unable", "speaker", "unable_speaker", "request",
    "foreign_weak", "foreign", "foreign_strong", "answer_refuses", "digits", "letters_none",
    "person", "stance", "talk", "person_stance", "person_talk", "stance_talk", "all_marks", "marks_bare", "all_marks_bare", "person_bare", "odds_some", "odds_high", "unlike_some", "unlike_most", "few_own", "few_own_unlike", "other_likelier", "other_much_likelier", "other_script",
)
#: Features that rest on wordings and lists of words of a few languages, and the share of examples that leave them out.
LEFT_OUT = 0.35
LISTED = ("apology", "self", "unable", "speaker", "unable_speaker", "request", "answer_refuses", "foreign_weak", "foreign", "foreign_strong")
ANY_FUNCTION_WORD = set().union(*WORDS.values()) - {"long", "many", "name", "definition", "population", "depth", "much", "me", "es", "it", "them", "there", "so"}


SENTENCE_WORDS = {w for w in ANY_FUNCTION_WORD - NAME_PARTICLES if w.islower()}
#: Wordings of refusals with parts of which an ASCII text must hold one, in lower case, to match; SPEAKER matches whole words.
WORDINGS = (
    ("apology", APOLOGY, ("sorry", "apolog", "unfortunately", "regrettably", "leid", "entschuldigung", "malheureusement", "lo siento", "lamentablemente", "desafortunadamente")),
    ("self", SELF, ("as a", "model", "system", "assistant", "als ", "en tant qu", "como ")),
    ("unable", UNABLE, ("can", "could", "unable", "won", "not ", "decline", "don", "impossible", "refuse", "kann", "nicht", "darf", "keine", "ne ", "n'ai", "m'est", "no ")),
    ("request", REQUEST, ("please", "bitte", "veuillez", "consult", "por favor", "try another", "ask a", "specialist", "expert", "professional", "sensitive", "at this time", "based on the", "fachperson", "especialista", "help with", "answer this", "this question", "diese frage", "cette question", "esta pregunta", "that request", "that information")),
)
SPEAKERS = set("i me my ich mir mich je j m moi puedo tengo siento dispongo".split())


@lru_cache(8192)
def query_facts(query: str) -> tuple[list[str], set[str], set[str], str, str]:
    """Words of a query, the same as a set, those of its matter, its language and its script."""
    q = tokens(query)
    return q, set(q), set(q) - ANY_FUNCTION_WORD, query_language(query) if q else "", script(query)


def wordings_in(text: str, words: list[str]) -> set[str]:
    """Names of the wordings of refusals that a text with these ``words`` holds."""
    plain, low = text.isascii(), text.lower()
    found = {name for name, pattern, parts in WORDINGS if (not plain or any([p in low for p in parts])) and pattern.search(text)}
    return found | {"speaker"} if (not plain or not SPEAKERS.isdisjoint(words)) and SPEAKER.search(text) else found


#: The bit of each feature in a clause's BYTES bytes, the first feature in the highest bit.
BYTES = -(-len(FEATURES) // 8)
BIT = {f: 1 << (8 * BYTES - 1 - i) for i, f in enumerate(FEATURES)}
UNLISTED = ~sum(BIT[f] for f in LISTED)


def features(query: str, answer: str, evidence: Evidence) -> tuple[list[str], np.ndarray]:
    """The clauses of an answer and their features."""
    parts, bits = feature_bits(query, answer, evidence)
    return parts, unpacked(packed(bits), len(parts)).astype(np.float32)


def feature_bits(query: str, answer: str, evidence: Evidence) -> tuple[list[str], list[int]]:
    """The clauses of an answer and the bits of their features."""
    text = (MARKUP.sub(" ", answer) if "<" in answer or "&" in answer else answer).strip()
    parts = clauses(text)
    q, q_set, q_matter, lang, q_script = query_facts(query)
    words, unquoted_text, unquoted_words, found = words_of(text)
    own_text = LABEL.sub("", text)
    a = words if own_text == text else tokens(own_text)
    a_set, long_enough = set(a), len(a) >= 3
    echo = bool(q) and bool(a) and len(a) % len(q) == 0 and a == q * (len(a) // len(q))
    spoken, wordings = person_words(text), wordings_in(text, words)
    plain = text.replace("\\", "")
    unbalanced = plain.count("(") > plain.count(")") or plain.count("[") > plain.count("]") or plain.count('"') % 2 == 1 or plain.count("„") > plain.count("“") or plain.count("«") > plain.count("»")
    covered = len(q_set & a_set) / len(q_set) if q_set else 0.0
    bare = q_matter.isdisjoint(a_set) and not has_digit(text)  # nothing of the query's matter is taken up
    prose = long_enough and not SENTENCE_WORDS.isdisjoint(words if text.islower() and text.isascii() else TOKEN.findall(text))
    every, whole_lang = BIT["bias"], 0.0  # what holds for all clauses
    if covered:
        every |= BIT["covers_all" if covered == 1 else "covers_most" if covered > 0.6 else "covers_some"]
    if echo:
        every |= BIT["echo"]
    if "unable" in wordings and "speaker" in wordings and ("apology" in wordings or "request" in wordings or "self" in wordings or FIRST_WORD.match(text)):
        every |= BIT["answer_refuses"]
    if lang:
        whole_lang = difference(scores_of(unquoted_text, unquoted_words), lang)
        unlike, strange, few_own = evidence.unlike(found, lang)
        likelier = evidence.likelier(found, lang)
        if strange >= 3 and unlike >= 0.35:
            every |= BIT["unlike_some"] | (BIT["unlike_most"] if unlike >= 0.5 else 0)
        if likelier > 0.1:
            every |= BIT["other_likelier"] | (BIT["other_much_likelier"] if likelier > 0.6 else 0)
        if few_own:
            every |= BIT["few_own"] | (BIT["few_own_unlike"] if unlike >= 0.2 else 0)
        if script(unquoted_text) not in ("", q_script):
            every |= BIT["other_script"]
    out = []
    for i, part in enumerate(parts):
        bits, last, stripped = every, i == len(parts) - 1, part.strip()
        whole = stripped == text
        t = words if whole else tokens(part)
        if not whole:
            spoken, wordings = person_words(stripped), wordings_in(stripped, t)
        if i == 0:
            bits |= BIT["first"]
        bits |= BIT["words_1" if len(t) <= 1 else "words_3" if len(t) <= 3 else "words_6" if len(t) <= 6 else "words_more"]
        head = stripped[:1]
        upper = head.isupper() or (head in "\"'“«¿¡(" and stripped[1:2].isupper())
        shares = long_enough and not q_set.isdisjoint(t)
        sentence = (upper and prose) or (shares and len(a) >= 4)
        ellipsis = last and ("." in stripped or "…" in stripped) and bool(ELLIPSIS.search(stripped))
        closed = not ellipsis and bool(CLOSED.search(stripped))
        if closed:
            bits |= BIT["closed"]
        if last:
            bits |= BIT["last"]
            if ellipsis:
                bits |= BIT["ellipsis"]
            if unbalanced:
                bits |= BIT["open"]
            if stripped[-1:] in ",;:-–—(":
                bits |= BIT["comma"]
            if not closed:
                if t and t[-1] in ANY_FUNCTION_WORD:
                    bits |= BIT["hanging_word"]
                if sentence and not echo:
                    bits |= BIT["open_sentence"]
        if upper:
            bits |= BIT["upper"]
        if head.islower():
            bits |= BIT["lower"]
        if sentence:
            bits |= BIT["sentence"]
        if not shares and not upper:
            bits |= BIT["bare_phrase"]
        inside = sum(map(q_set.__contains__, t)) / len(t) if t else 0.0
        if inside:
            bits |= BIT["in_query_all" if inside == 1 else "in_query_most" if inside > 0.6 else "in_query_some"]
        for name in wordings:
            bits |= BIT[name]
        if "unable" in wordings and "speaker" in wordings:
            bits |= BIT["unable_speaker"]
        own = (whole_lang if whole else max(foreignness(stripped, lang), whole_lang)) if lang else 0.0
        if own >= 1:
            bits |= BIT["foreign_strong"] | BIT["foreign"] if own >= 3 else BIT["foreign"] if own >= 2 else BIT["foreign_weak"]
        person, stance, talk = marks(spoken)
        if person:
            bits |= BIT["person"] | (BIT["person_stance"] if stance else 0) | (BIT["person_talk"] if talk else 0) | (BIT["person_bare"] if bare else 0)
        if stance:
            bits |= BIT["stance"] | (BIT["stance_talk"] if talk else 0)
        if talk:
            bits |= BIT["talk"]
        if person + stance + talk >= 2 and bare:
            bits |= BIT["marks_bare"]
        if person and stance and talk:
            bits |= BIT["all_marks"] | (BIT["all_marks_bare"] if bare else 0)
        odds = evidence.stance(spoken)
        if odds > 2:
            bits |= BIT["odds_some"] | (BIT["odds_high"] if odds > 5 else 0)
        if has_digit(part):
            bits |= BIT["digits"]
        if not has_letter(part):
            bits |= BIT["letters_none"]
        out.append(bits)
    return parts, out


def packed(bits: list[int]) -> bytes:
    return b"".join([b.to_bytes(BYTES, "big") for b in bits])


def unpacked(x: bytes, clauses: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(x, dtype=np.uint8).reshape(clauses, BYTES), axis=1, count=len(FEATURES))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class ClauseField:
    """A linear-chain conditional random field over the clauses of one answer."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    @classmethod
    def fit(cls, sequences: list[np.ndarray], tags: list[np.ndarray], **how) -> ClauseField:
        """From examples in memory."""
        number = Counter((np.packbits(x != 0, axis=1).tobytes(), y.astype(np.uint8).tobytes()) for x, y in zip(sequences, tags))
        groups = grouped([(*example, w) for example, w in sorted(number.items())])
        return cls.climb(lambda field: field.gradient(groups), **how)

    @classmethod
    def climb(cls, gradient: Callable[[ClauseField], np.ndarray], rounds: int = 300, penalty: float = 0.0005, tolerance: float = 0.0003) -> ClauseField:
        """Maximum likelihood with an L2 penalty, by Adam, until no weight's gradient exceeds ``tolerance``."""
        k, d = len(TAGS), len(FEATURES)
        field = cls(np.zeros((d, k)), np.zeros((k, k)))
        state = [np.zeros((d, k)), np.zeros((d, k)), np.zeros((k, k)), np.zeros((k, k))]
        for step in range(1, rounds + 1):
            total = gradient(field)
            found = total[1:] / total[0]
            at_weights = found[: d * k].reshape(d, k) - penalty * field.weights
            at_moves = found[d * k :].reshape(k, k) - penalty * field.moves
            if max(np.abs(at_weights).max(), np.abs(at_moves).max()) < tolerance:
                break
            for i, (g, values) in enumerate(((at_weights, field.weights), (at_moves, field.moves))):
                state[2 * i] = 0.9 * state[2 * i] + 0.1 * g
                state[2 * i + 1] = 0.99 * state[2 * i + 1] + 0.01 * g * g
                values += 0.15 * (state[2 * i] / (1 - 0.9**step)) / (np.sqrt(state[2 * i + 1] / (1 - 0.99**step)) + 1e-8)
        return field

    def gradient(self, groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """The number of examples, and the gradient of their log-likelihood by weights and moves, as one row."""
        size, at_weights, at_moves = 0.0, np.zeros_like(self.weights), np.zeros_like(self.moves)
        for x, gold, w in groups:
            p, expected = self._inside(x @ self.weights, w)
            size += w.sum()
            at_weights += np.tensordot(x, (gold - p) * w[:, None, None], ((0, 1), (0, 1)))
            at_moves += np.einsum("nti,ntj,n->ij", gold[:, :-1], gold[:, 1:], w) - expected
        return np.concatenate([[size], at_weights.ravel(), at_moves.ravel()])

    def _inside(self, score: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(tag) of each clause of sequences of one length, and the expected moves, each sequence with its weight."""
        n, top, k = score.shape
        forward, backward = np.empty_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, top):
            forward[:, t] = _logsum(forward[:, t - 1, :, None] + self.moves[None], 1) + score[:, t]
        for t in range(top - 2, -1, -1):
            backward[:, t] = _logsum(self.moves[None] + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        total = _logsum(forward[:, -1], 1)
        expected = np.zeros((k, k))
        for t in range(1, top):
            joint = forward[:, t - 1, :, None] + self.moves[None] + (score[:, t] + backward[:, t])[:, None, :] - total[:, None, None]
            expected += np.tensordot(weight, np.exp(joint), 1)
        return np.exp(forward + backward - total[:, None, None]), expected

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """P(tag) of each clause of sequences of one length."""
        return self._inside(x @ self.weights, np.ones(len(x)))[0]

    def tag(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The most probable tag of each clause."""
        out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(sequences)
        by_length: dict[int, list[int]] = {}
        for i, s in enumerate(sequences):
            by_length.setdefault(len(s), []).append(i)
        for where in by_length.values():
            p = self.marginals(np.stack([sequences[i] for i in where]))
            for i, best in zip(where, p.argmax(2)):
                out[i] = best
        return out


def grouped(numbers: Iterable[tuple[bytes, bytes, float]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features, tags, weight) of counted examples, those of one length together."""
    by_length: dict[int, list] = {}
    for x, y, w in numbers:
        by_length.setdefault(len(y), []).append((unpacked(x, len(y)), np.frombuffer(y, dtype=np.uint8), w))
    every = np.eye(len(TAGS))
    return [(np.stack([x for x, _, _ in own]).astype(np.float64), every[np.stack([y for _, y, _ in own])], np.array([w for _, _, w in own], dtype=np.float64)) for _, own in sorted(by_length.items())]


def has_text(answer: str | None) -> bool:
    """False for a blank, a bare mark or a wording for no answer."""
    if answer is None:
        return False
    bare = answer.strip(MARKS)
    if not (bare[:1].isalnum() and bare[-1:].isalnum()):
        bare = re.sub(r"^[\W_]+|[\W_]+$", "", bare)
    return len(bare) > 40 or not NO_ANSWER.fullmatch(bare)  # none of these wordings is half as long


#: What is made of a complete answer; by their number, how often. "no echo" is an answer that isn't a copy.
KINDS = ("refusal", "refusal", "echo", "foreign", "unfinished", "unfinished", "no echo")


OWN_PAIRS = [(q, a) for _, q, full, short in SEEDS for a in (full, short)] * 12


def examples(pairs: list[tuple[str, str]], evidence: Evidence, seed: int = 3) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Training sequences from (query, complete answer) pairs and the seeds."""
    made = made_of([*pairs, *OWN_PAIRS], pairs, evidence, str(seed), {})
    return [unpacked(x, len(y)) for x, y in made], [np.frombuffer(y, dtype=np.uint8) for _, y in made]


def made_of(held: list[tuple[str, str]], pool: list[tuple[str, str]], evidence: Evidence, seed: str, known: dict[tuple[str, str], list[int]]) -> list[tuple[bytes, bytes]]:
    """Training sequences, features and tags in bytes, from ``held`` pairs, with the seeds and the answers of ``pool`` as answers to other queries;
    ``known`` features aren't worked out again."""
    rng = random.Random(seed)
    pick = rng.choice
    by_language: dict[str, list[str]] = {}
    for lang, _, full, _ in SEEDS:
        by_language.setdefault(lang, []).append(full)
    for q, a in pool:
        if len(tokens(a)) >= 6:
            by_language.setdefault(query_language(q), []).append(a)
    made: list[tuple[str, str, str]] = []
    for q, a in held:
        lang = query_language(q)
        made.append((q, a, "answer"))
        for kind in rng.sample(KINDS, 2):
            if kind == "refusal":
                r = refusal(lang, pick)
                made.append((q, pick([r, r[:1].upper() + r[1:], r.lower()]), kind))
            elif kind == "echo" and tokens(q):
                own = pick([q, q.upper(), q.capitalize(), f"  {q} "])
                made.append((q, pick(["{}", "{}?", '"{}"', "- {}", "Q: {}", "Question: {}?", "{} ??", "**{}**"]).format(own), kind))
            elif kind == "no echo" and len(tokens(q)) >= 3:  # the query's words with others, or in another order, are no copy
                words = q.split()
                other = words[::-1] if rng.random() < 0.5 else words[:2] + pick(SEEDS)[3].split()[:3] + words[2:]
                made.append((q, " ".join(other).capitalize() + ".", "answer"))
            elif kind == "foreign":
                text = pick(by_language[pick([k for k in sorted(by_language) if k != lang])])
                names = [w for w in TOKEN.findall(q) if w[0].isupper()]
                if names and rng.random() < 0.5:  # about the query's matter
                    text = NAME.sub(lambda m, own=pick(names): own, text)
                made.append((q, text, kind))
            elif kind == "unfinished" and len(tokens(a)) >= 6:
                keep = int(len(a) * rng.uniform(0.45, 0.92))
                cut = a[:keep] if rng.random() < 0.5 else a[: a.rfind(" ", 0, keep)]
                if len(tokens(cut)) >= 3:
                    made.append((q, cut.rstrip() + pick(CUT_TAILS), kind))
    out = []
    for q, a, kind in made:
        bits = known.get((q, a)) or feature_bits(q, a, evidence)[1]
        if rng.random() < LEFT_OUT:
            bits = [b & UNLISTED for b in bits]
        rest = "answer" if kind == "unfinished" else kind
        out.append((packed(bits), bytes([TAGS.index(rest)] * (len(bits) - 1) + [TAGS.index(kind)])))
    return out


def refusal(lang: str, pick) -> str:
    start, middle, end = REFUSALS.get(lang, REFUSALS["en"])
    return pick(start) + pick(middle) + pick(end)


def defect_of(parts: list[str], tags: np.ndarray) -> str | None:
    """The defect of one answer from the coverage of its clauses' tags."""
    return defect_by([len(p) for p in parts], tags)


def defect_by(sizes: list[int], tags: np.ndarray) -> str | None:
    size = np.array(sizes, dtype=float)
    share = {t: float(size[tags == i].sum() / size.sum()) for i, t in enumerate(TAGS)}
    for tag in ("refusal", "echo", "foreign"):
        if share[tag] > 0.5:
            return DEFECT[tag]
    return DEFECT["unfinished"] if TAGS[tags[-1]] == "unfinished" else None


def one_per_query(marco: DataFrame) -> DataFrame:
    """(query_id, query, answers, well_formed_answers), the row with the smallest item_id of each query."""
    held = F.struct("query", *FIELDS)
    one = marco.where("query_id is not null").groupBy("query_id").agg(F.min_by(held, "item_id").alias("x"))
    return one.select("query_id", "x.*")


def complete_pairs(rows: list[tuple[str | None, list[str]]]) -> tuple[list[tuple[str, str]], list[str]]:
    """(query, answer) of whole sentences and of short answers of a few words; and answers that refuse by their marks
    and hold nothing of the query."""
    out, refusals = [], []
    for query, answers in rows:
        q = (query or "").strip()
        q_words, _, matter, _, _ = query_facts(q)
        for a in answers:
            if not q or not has_text(a):
                continue
            words = tokens(a)
            if words == q_words:
                continue
            person, stance, talk = marks(person_words(a))
            if person and (stance or talk) or ((not a.isascii() or not SPEAKERS.isdisjoint(words)) and SPEAKER.search(a) and UNABLE.search(a)):
                if stance and talk and matter.isdisjoint(words):
                    refusals.append(a)
                continue
            whole = CLOSED.search(a.strip()) and not ELLIPSIS.search(a.strip())
            if (whole or len(words) <= 4) and foreignness(a, query_language(q)) < 2:
                out.append((q, a.strip()))
    return out, refusals


@lru_cache(1)
def composed_words() -> dict[str, float]:
    """In how many of COMPOSED refusals of each language a word is to be expected, of all that can be composed."""
    expected: Counter = Counter()
    for parts in REFUSALS.values():
        every = ["".join(x) for x in product(*parts)]
        for w, n in Counter(w for t in every for w in set(person_words(t))).items():
            expected[w] += COMPOSED * n / len(every)
    return dict(expected)


def own_texts() -> list[tuple[str, str]]:
    """Texts of our own by language."""
    texts = [(lang, x) for lang, *own in SEEDS for x in own] + [(lang, x) for lang, x in FUNCTION_WORDS.items()]
    return texts + [(lang, part) for lang, parts in REFUSALS.items() for part in parts[1]]


OWN_ANSWERS = [x for _, _, *own in SEEDS for x in own]


def learn(rows: list[tuple[str | None, list[str]]], passages: list[str]) -> tuple[Evidence, ClauseField]:
    """The evidence and the field from (query, answers) and passages in memory."""
    pairs, refusals = complete_pairs(rows)
    texts = [(language(x), x) for x in {*passages, *(a for _, a in pairs), *(q for q, _ in pairs)} if x and x.strip()] + own_texts()
    evidence = Evidence.of(texts, refusals, [a for _, a in pairs] + OWN_ANSWERS, max(1.0, len(pairs) / OWN_SHARE))
    return evidence, ClauseField.fit(*examples(pairs, evidence))


def _with_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Queries without outer blanks, with their complete answers and those that refuse."""
    for batch in batches:
        query = [(q or "").strip() for q in batch["query"]]
        found = [complete_pairs([(q, [a for given in (one, two) if given is not None for a in given])]) for q, one, two in zip(query, batch[FIELDS[0]], batch[FIELDS[1]])]
        yield batch.assign(query=query, complete=[[a for _, a in pairs] for pairs, _ in found], refusals=[refusals for _, refusals in found])


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, word, n) of each batch. Words never hold a blank, so they are cut once for each different chunk."""
    known = Chunks()
    for batch in batches:
        counts: dict[str, Counter] = {}
        for text in batch["text"]:
            plain = unquoted(text)
            chunks = plain.split()
            counts.setdefault(known.language(plain, chunks), Counter()).update(chunks)
        words: Counter = Counter()
        for lang, found in counts.items():
            for chunk, n in found.items():
                for w in words_of(chunk)[3]:
                    words[lang, w] += n
        yield pd.DataFrame([(*key, n) for key, n in words.items()], columns=["lang", "word", "n"])


def _spoken_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        one, two = (Counter(w for texts in batch[name] for t in texts for w in set(person_words(t))) for name in ("refusals", "complete"))
        yield pd.DataFrame([(w, one[w], two[w]) for w in {*one, *two}], columns=["word", "one", "two"])


def learnt_evidence(read: DataFrame, marco: DataFrame) -> tuple[Evidence, float]:
    """The evidence of all queries (with their pairs) and all passages, and how often what is our own counts. What comes
    to the driver are trigrams by language, histograms and the words of refusals."""
    spark = read.sparkSession
    texts = read.select(F.explode("complete").alias("text")).unionByName(read.where(F.size("complete") > 0).select(F.col("query").alias("text")))
    if "passage_text" in marco.columns:
        texts = texts.unionByName(marco.where("passage_text is not null").select(F.col("passage_text").alias("text")))
    own = Counter((lang, w) for lang, text in own_texts() for w in plain_words(text))
    every = texts.distinct().mapInPandas(_word_counts, "lang string, word string, n long").unionByName(spark.createDataFrame([(*key, n) for key, n in own.items()], "lang string, word string, n long"))
    words = Stage(every.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words").df
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    gram = F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substring(padded, i, F.lit(3))))
    grams: dict[str, Counter] = {}
    for r in words.select("lang", "n", gram.alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n")).orderBy("lang", "gram").collect():
        grams.setdefault(r["lang"], Counter())[r["gram"]] = r["n"]

    number = read.agg(F.sum(F.size("refusals")), F.sum(F.size("complete"))).first()
    refusals, answers = (n or 0 for n in number)
    scale = max(1.0, answers / OWN_SHARE)
    two = Counter(w for t in OWN_ANSWERS for w in set(person_words(t)))
    spoken = read.select("refusals", "complete").mapInPandas(_spoken_counts, "word string, one long, two long").groupBy("word").agg(F.sum("one").alias("one"), F.sum("two").alias("two"))
    one: dict[str, int] = {}
    for r in spoken.where((F.col("one") > 0) | F.col("word").isin(sorted(composed_words()))).collect():
        one[r["word"]] = r["one"]
        two[r["word"]] += r["two"]
    odds = log_odds({w: n for w, n in one.items() if n}, two, refusals, answers + len(OWN_ANSWERS), scale)
    evidence = Evidence(grams, odds)
    evidence.floor = _floors(words, evidence)
    return evidence, scale


def _floors(words: DataFrame, evidence: Evidence, bins: int = 4096) -> dict[str, float]:
    """For each language the likelihood that one in QUANTILE of its words stays below, exactly: by a histogram, then
    among the values of one bin."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "score": [evidence.likelihood(w, lang, n) for lang, w, n in zip(batch["lang"], batch["word"], batch["n"])]})

    scored = Stage(words.where("length(word) > 2").mapInPandas(run, "lang string, score double"), "likelihoods").df
    place = F.floor(F.col("score") * bins)
    histogram: dict[str, list] = {}
    for r in scored.groupBy("lang", place.alias("bin")).count().orderBy("lang", "bin").collect():
        histogram.setdefault(r["lang"], []).append((r["bin"], r["count"]))
    left, chosen = {}, F.lit(False)
    for lang, own in histogram.items():
        at = sum(n for _, n in own) // QUANTILE
        for b, n in own:
            if at < n:
                left[lang] = at
                chosen = chosen | ((F.col("lang") == lang) & (place == b))
                break
            at -= n
    floor = dict.fromkeys(evidence.grams, -math.inf)
    for r in scored.where(chosen).groupBy("lang", "score").count().orderBy("lang", "score").collect():
        if 0 <= left[r["lang"]] < r["count"]:
            floor[r["lang"]] = r["score"]
        left[r["lang"]] -= r["count"]
    return floor


WORKED = "query_id long, field string, sizes array<array<int>>, features array<binary>, x binary, y binary, n long"


def worked(read: DataFrame, evidence: Evidence, tasks: int, buckets: int) -> DataFrame:
    """The features of every answer with text, a row for each query and field that may be defective, and the counted
    examples of every pair (x, y, n). The pairs of one bucket of queries, by a hash of the id, exchange their answers."""

    def run(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        out, pairs, known = [], [], {}
        for row in batch.sort_values("query_id").itertuples(index=False):
            here: dict[str, tuple[list[str], list[int]]] = {}
            for name in FIELDS:
                given = getattr(row, name)
                texts = [] if given is None else [a.strip() for a in given if has_text(a)]
                for a in texts:
                    if a not in here:
                        here[a] = feature_bits(row.query, a, evidence)
                if texts or name == "answers" or (given is not None and len(given) > 0):
                    out.append((row.query_id, name, [[len(p) for p in here[a][0]] for a in texts], [packed(here[a][1]) for a in texts], None, None, None))
            for a in row.complete:
                pairs.append((row.query, a))
                known[row.query, a] = here[a][1]
        out += [(None, None, None, None, x, y, n) for (x, y), n in Counter(made_of(pairs, pairs, evidence, str(key[0]), known)).items()]
        return pd.DataFrame(out, columns=["query_id", "field", "sizes", "features", "x", "y", "n"]).astype({"query_id": "Int64", "n": "Int64"})

    bucket = F.pmod(F.xxhash64("query_id"), F.lit(buckets))
    return read.withColumn("bucket", bucket).repartition(tasks, "bucket").groupBy("bucket").applyInPandas(run, WORKED)


def fitted(made: DataFrame, evidence: Evidence, scale: float, most: int = FIT_HERE) -> ClauseField:
    """The field of all examples (x, y, n) and those of our own, which count ``scale`` times. Beyond ``most`` clauses of
    different examples tasks work out the gradient of each round."""
    own = [(*example, scale * n) for example, n in sorted(Counter(made_of(OWN_PAIRS, [], evidence, "own", {})).items())]
    different = Stage(made.groupBy("x", "y").agg(F.sum("n").alias("n")), "examples").df
    if (different.agg(F.sum(F.length("y"))).first()[0] or 0) <= most:
        groups = grouped([*own, *sorted((bytes(r["x"]), bytes(r["y"]), float(r["n"])) for r in different.collect())])
        return ClauseField.climb(lambda field: field.gradient(groups))
    ours = grouped(own)

    def gradient(field: ClauseField) -> np.ndarray:
        parts = (field.weights, field.moves)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            at = ClauseField(*parts)
            for batch in batches:
                yield pd.DataFrame({"g": [at.gradient(grouped(zip(batch["x"], batch["y"], batch["n"])))]})

        return sum((np.array(r["g"]) for r in different.mapInPandas(run, "g array<double>").collect()), field.gradient(ours))

    return ClauseField.climb(gradient)


def _prepared(marco: DataFrame) -> tuple[DataFrame, DataFrame, Evidence, ClauseField]:
    """One row per query with its pairs, the features of its answers, and what was learnt of all of them. The rows are
    few bytes but much work, so they are spread by their number and aren't left to be put together by size."""
    queries = Stage(one_per_query(marco), "queries").df
    number = queries.count()
    tasks = max(1, min(-(-number // ROWS_A_TASK), 64 * queries.sparkSession.sparkContext.defaultParallelism))
    schema = "query_id long, query string, answers array<string>, well_formed_answers array<string>, complete array<string>, refusals array<string>"
    read = Stage(queries.repartition(tasks, "query_id").mapInPandas(_with_pairs, schema), "read").df
    evidence, scale = learnt_evidence(read, marco)
    done = Stage(worked(read, evidence, tasks, max(1, -(-number // ROWS_A_BUCKET))), "worked").df
    field = fitted(done.where("x is not null").select("x", "y", "n"), evidence, scale)
    evidence._seen.clear()  # a cache, not to be sent along
    return read, done.where("field is not null").select("query_id", "field", "sizes", "features"), evidence, field


def pair_defects(marco: DataFrame) -> DataFrame:
    """(query_id, field, defect) of every defective pair. One shuffle brings each query to one row, others spread these
    rows over tasks; texts of passages are shuffled once, to count each only once."""
    _, answers, _, field = _prepared(marco)
    parts = (field.weights, field.moves)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = ClauseField(*parts)
        for batch in batches:
            sizes = [[list(s) for s in row] for row in batch["sizes"]]
            made = [unpacked(x, len(s)) for row, of in zip(batch["features"], sizes) for x, s in zip(row, of)]
            tags = iter(own.tag(made))
            out = []
            for query_id, name, of in zip(batch["query_id"], batch["field"], sizes):
                found = [defect_by(s, next(tags)) for s in of]
                if None not in found:
                    out.append((query_id, name, found[0] if found else "empty"))
            yield pd.DataFrame(out, columns=["query_id", "field", "defect"])

    return answers.mapInPandas(run, "query_id long, field string, defect string")


def tagged_clauses(marco: DataFrame) -> DataFrame:
    """(query_id, field, answer, clause, text, tag) of every clause of every answer that has text."""
    read, _, evidence, field = _prepared(marco)
    parts = (field.weights, field.moves)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = ClauseField(*parts)
        for batch in batches:
            where, made = [], []
            for row in batch.itertuples(index=False):
                for name in FIELDS:
                    for i, a in enumerate(getattr(row, name) if getattr(row, name) is not None else ()):
                        if has_text(a):
                            where.append((row.query_id, name, i))
                            made.append(features(row.query, a.strip(), evidence))
            tags = own.tag([x for _, x in made]) if made else []
            out = [(*at, k, text, TAGS[t]) for at, (texts, _), ts in zip(where, made, tags) for k, (text, t) in enumerate(zip(texts, ts))]
            yield pd.DataFrame(out, columns=["query_id", "field", "answer", "clause", "text", "tag"])

    return read.mapInPandas(run, "query_id long, field string, answer long, clause long, text string, tag string")
