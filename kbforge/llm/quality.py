"""Per-document text quality: statistics of words, symbols, lines and common words, and a hidden Markov model that
labels each line prose, list, table or junk.

Lines are measured over whole batches at once, on the bytes of the text: every count is a table look-up and one
reduction per line. The measures are cut into bins; a state emits bins independently, states follow each other with
sticky transitions, and the posterior of each line comes from the forward-backward recursion, run for all documents
of a batch together. A document's label shares, weighted by the lines' size, decide what it mostly is.

The model is fitted at run time on a bounded sample of labelled documents (SAMPLE of them, chosen by a hash of the id,
so at random and the same each time). First all lines take their document's label; then lines are decoded again under
the document's label and the model is refitted, a few times. Everything else covers all documents whole.

Defined results: null and blank texts have no line, zero statistics and no kind, and rows without an id no kind; without any usable label there is
no model and no kind is given; repeated documents are labelled each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbforge.staging import once

KINDS = ("prose", "list", "table", "junk")
SAMPLE = 4000
ROUNDS = 6
STICKY = 0.9
BATCH_BYTES = 500_000
#: The bin of a measure that says nothing about a line, and the measures that need words set apart by spaces.
MISSING = 15
MEASURES = 17
WORD_MEASURES = (1, 2, 10, 12, 14)

#: Common words of the languages of the corpus.
COMMON = {
    "en": "the of and to in a is was that for it as with on by at from their its this these those be were are which or an not but had has have each one another after before under over between near along until into during so because while if when where who they he she we you his her our all there than then also about above behind beyond beside within across through around against",
    "de": "der die das den dem des und ist war ein eine einen einem einer nicht mit von zu im in an auf für aus nach bei bis seit trotz während zwischen unter über wie noch aber obwohl weil davon keine wird wurde sich auch als so oder",
    "fr": "le la les l de des du d un une et est était que qui dans en sur pour par avec au aux ne pas ce cette ces se sa son ses mais parce comme depuis pendant après sous entre malgré jusqu à nos bien",
    "es": "el la los las de del un una y es era que en por para con no se su sus al como pero porque desde durante después bajo entre hasta aunque todavía más lo a ante sobre",
    "ru": "и в во не на что с со он она они как это по к ко но из у за от до для при между после под над о об так же или который была был были хотя потому без несмотря",
}
SENTENCE_END = b".!?"

_CODE = np.zeros(256, dtype=np.uint8)
LOWER, UPPER, DIGIT, SPACE, TAB, HIGH, MARK, SYMBOL, CONTROL = range(1, 10)
for _b in range(256):
    _c = chr(_b)
    if _b >= 0x80:
        _CODE[_b] = HIGH
    elif _c.islower():
        _CODE[_b] = LOWER
    elif _c.isupper():
        _CODE[_b] = UPPER
    elif _c.isdigit():
        _CODE[_b] = DIGIT
    elif _c == " ":
        _CODE[_b] = SPACE
    elif _c == "\t":
        _CODE[_b] = TAB
    elif _c in ".,;:!?'\"()-":
        _CODE[_b] = MARK
    elif _b >= 0x20 and _b != 0x7F:
        _CODE[_b] = SYMBOL
    else:
        _CODE[_b] = CONTROL
_WORDY = np.isin(_CODE, (LOWER, UPPER, DIGIT, HIGH))
_BYTE = np.arange(256)
_TABLES = [
    ("digit", _CODE == DIGIT), ("space", _CODE == SPACE), ("tab", _CODE == TAB), ("high", _CODE == HIGH), ("symbol", _CODE == SYMBOL), ("continued", (_BYTE & 0xC0) == 0x80),
    ("bar", _BYTE == ord("|")), ("semi", _BYTE == ord(";")), ("comma", _BYTE == ord(",")), ("cjk", (_BYTE >= 0xE3) & (_BYTE <= 0xE9)),
]
FIELD = 21
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_MIX = np.random.default_rng(11).integers(1, 2**63, size=(256,), dtype=np.uint64) | np.uint64(1)
_POWER = np.random.default_rng(12).integers(1, 2**63, size=(64,), dtype=np.uint64) | np.uint64(1)


def _word_hash(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each word [start, stop), ASCII case folded."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = stops - starts
    offsets = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(offsets, lengths)
    at = np.repeat(starts, lengths) + inside
    with np.errstate(over="ignore"):
        h = np.add.reduceat(_MIX[_FOLD[raw[at]]] * _POWER[inside & 63], offsets)
        return (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def _spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], _WORDY[raw].view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _known() -> np.ndarray:
    words = sorted({w for ws in COMMON.values() for w in ws.split()})
    raw = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return np.unique(_word_hash(raw, *_spans(raw)))


_COMMON_HASH = _known()


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def measure(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(document of each line, bins of each line, counts of each line) of all lines that aren't blank."""
    joined = b"\n".join(texts).replace(b"\r", b"\n") + b"\n"
    raw = np.frombuffer(joined, dtype=np.uint8)
    stops = np.flatnonzero(raw == 10)
    starts = np.concatenate(([0], stops[:-1] + 1))
    sizes = np.array([len(t) + 1 for t in texts])
    doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
    code = _CODE[raw]

    most = int((stops - starts).max()) if len(starts) else 0

    def per_line(packed: np.ndarray) -> np.ndarray:
        """Sums of packed counts by line; the fields can't overflow within a line of under 2**FIELD bytes."""
        total = np.zeros(len(packed) + 1, dtype=np.uint64)
        np.cumsum(packed, out=total[1:])
        return total[stops] - total[starts]

    def unpack(named: list[tuple[str, np.ndarray]], look_up: bool) -> None:
        """Counts of several look-up tables over bytes, or of several masks, as many at once as fit a 64-bit sum."""
        fit = 3 if most < 1 << FIELD else 1
        for i in range(0, len(named), fit):
            part = named[i : i + fit]
            packed = sum(m.astype(np.uint64) << np.uint64(FIELD * k) for k, (_, m) in enumerate(part))
            found = per_line(packed[raw] if look_up else packed)
            for k, (name, _) in enumerate(part):
                n[name] = (found >> np.uint64(FIELD * k) & np.uint64((1 << FIELD) - 1) if fit > 1 else found).astype(np.int64)

    n: dict[str, np.ndarray] = {"bytes": stops - starts}
    unpack(_TABLES, True)
    nxt, prev = np.append(code[1:], 0), np.append(0, code[:-1])
    two = (code == SPACE) & (prev == SPACE)
    two[2:] &= code[:-2] != SPACE
    inner = ((raw == 46) | (raw == 33) | (raw == 63)) & (nxt == SPACE)
    cjk, broken = np.zeros(len(raw), dtype=bool), np.zeros(len(raw), dtype=bool)
    cjk[:-2] = (raw[:-2] == 0xE3) & (raw[1:-1] == 0x80) & (raw[2:] == 0x82)
    lead = (raw == 0xC2) | (raw == 0xC3)
    broken[:-2] = lead[:-2] & lead[2:]
    broken[:-2] |= (raw[:-2] == 0xEF) & (raw[1:-1] == 0xBF) & (raw[2:] == 0xBD)
    letter, letter_before = (code == LOWER) | (code == UPPER), (prev == LOWER) | (prev == UPPER)
    rise = (code == UPPER) & (prev == LOWER)
    mixed = ((code == DIGIT) & letter_before) | ((prev == DIGIT) & letter)
    unpack([("gap", two), ("inner", inner), ("cjk_stop", cjk), ("broken", broken), ("rise", rise), ("mixed", mixed)], False)
    keep = n["bytes"] > n["space"] + n["tab"]
    a, z, line_of = starts[keep], stops[keep], np.flatnonzero(keep)
    if not len(a):
        return np.empty(0, dtype=np.int64), np.empty((0, MEASURES), dtype=np.int8), {}
    n = {k: v[keep] for k, v in n.items()}
    ws, wz = _spans(raw)
    h = _word_hash(raw, ws, wz)
    at = np.searchsorted(_COMMON_HASH, h)
    at[at == len(_COMMON_HASH)] = 0
    line = np.searchsorted(starts, ws, side="right") - 1
    lines = len(starts)
    n["words"] = np.bincount(line, minlength=lines)[keep]
    n["common"] = np.bincount(line, weights=_COMMON_HASH[at] == h if len(h) else None, minlength=lines)[keep].astype(np.int64)
    n["word_bytes"] = np.bincount(line, weights=wz - ws, minlength=lines)[keep].astype(np.int64)
    with np.errstate(over="ignore"):
        keyed = np.sort((h & np.uint64(0xFFFFFFFF)) | (line.astype(np.uint64) << np.uint64(32)))
    fresh = np.concatenate(([True], keyed[1:] != keyed[:-1])) if len(keyed) else np.empty(0, dtype=bool)
    n["distinct"] = np.bincount((keyed >> np.uint64(32)).astype(np.int64)[fresh], minlength=lines)[keep]

    sums = np.zeros(lines, dtype=np.uint64)
    if len(h):
        heads = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
        with np.errstate(over="ignore"):
            sums[line[heads]] = np.add.reduceat(h * (np.arange(len(h), dtype=np.uint64) - np.repeat(heads, np.diff(np.append(heads, len(h)))).astype(np.uint64) + np.uint64(1)), heads)
    with np.errstate(over="ignore"):
        same_line = (sums[keep] & np.uint64(0xFFFFFFFF)) | (doc[keep].astype(np.uint64) << np.uint64(32))
    _, which, times = np.unique(same_line, return_inverse=True, return_counts=True)
    n["repeated"] = times[which] - 1

    inked = np.flatnonzero((code != SPACE) & (code != TAB) & (raw != 10))
    first = inked[np.searchsorted(inked, a)]
    last = inked[np.searchsorted(inked, z) - 1]
    closing = np.isin(raw[last], np.frombuffer(b"\"')]", dtype=np.uint8)) & (last > a)
    inner_last = np.where(closing, last - 1, last)
    stop = np.isin(raw[inner_last], np.frombuffer(SENTENCE_END, dtype=np.uint8)) | ((raw[last] == 0x82) & (last >= 2) & (raw[np.maximum(last - 2, 0)] == 0xE3))
    n["stop"] = stop.astype(np.int64)

    begin = np.zeros(len(a), dtype=np.int8)
    fb = raw[first]
    for k, chars in enumerate((b"-*+#", b"[", b"|{!", b"<", b"\"'", b"("), 1):
        begin[np.isin(fb, np.frombuffer(chars, dtype=np.uint8))] = k
    fc = code[first]
    for k, c in enumerate((DIGIT, UPPER, LOWER, HIGH), 7):
        begin[fc == c] = k
    dash = (fb == 0xE2) & (raw[np.minimum(first + 1, len(raw) - 1)] == 0x80)
    begin[dash] = 1
    begin[(a < first) & (begin > 6)] = 11
    finish = np.zeros(len(a), dtype=np.int8)
    lb, lc = raw[last], code[last]
    for k, chars in enumerate((b",;", b":", b")", b"|", b">"), 1):
        finish[np.isin(lb, np.frombuffer(chars, dtype=np.uint8))] = k
    for k, c in enumerate((DIGIT, UPPER, LOWER, HIGH), 6):
        finish[lc == c] = k
    finish[stop] = 10

    chars = n["bytes"] - n["continued"]
    n["cjk"] -= n["cjk_stop"]
    unsegmented = 6 * n["cjk"] > n["bytes"]  # no spaces between words: measures of words say nothing there
    n["words"] = np.where(unsegmented, n["words"] + n["cjk"] // 2, n["words"])
    cut = lambda x, *edges: np.digitize(x, edges).astype(np.int8)
    fields = np.maximum.reduce([n["tab"], n["bar"], n["semi"], n["gap"], np.where(n["comma"] * 2 >= n["words"], n["comma"], 0)])
    before = np.concatenate(([-1], fields[:-1]))
    same = np.concatenate(([False], doc[line_of][1:] == doc[line_of][:-1]))
    like = np.where(~same, 0, np.where(fields == 0, 1, np.where(fields == before, 2, 3))).astype(np.int8)
    span = np.concatenate(([0], n["words"][:-1]))
    near = np.where(~same, 0, cut(np.abs(n["words"] - span), 1, 3, 8) + 1).astype(np.int8)
    bins = np.stack(
        [
            cut(n["words"], 1, 2, 3, 4, 6, 9, 15, 40),
            cut(_share(n["word_bytes"], n["words"]), 3, 4, 5, 6, 8, 12, 24),
            np.where(n["words"] < 4, 0, 1 + cut(_share(n["common"], n["words"]), 0.02, 0.12, 0.22, 0.34, 0.5)).astype(np.int8),
            begin,
            finish,
            cut(fields, 1, 2, 3, 6),
            cut(_share(n["digit"], chars), 0.001, 0.05, 0.15, 0.3, 0.5),
            cut(_share(n["symbol"], chars), 0.001, 0.03, 0.08, 0.2, 0.4),
            cut(_share(n["broken"], chars), 0.001, 0.05, 0.15),
            cut(n["inner"] + n["cjk_stop"], 1, 2, 4),
            np.where(n["words"] < 8, 0, 1 + cut(_share(n["distinct"], np.minimum(n["words"], 60)), 0.2, 0.35, 0.5, 0.65, 0.8)).astype(np.int8),
            cut(_share(n["rise"], chars), 0.001, 0.02, 0.08),
            cut(_share(n["mixed"], n["words"]), 0.05, 0.3, 0.8),
            like,
            near,
            cut(_share(n["high"], n["bytes"]), 0.01, 0.1, 0.5),
            cut(n["repeated"] / np.maximum(np.bincount(doc[line_of])[doc[line_of]], 6), 0.001, 0.03, 0.08),
        ],
        axis=1,
    )
    bins[np.ix_(unsegmented, WORD_MEASURES)] = MISSING
    n["chars"] = chars
    return doc[line_of], bins, n


class LineModel:
    """The hidden Markov model. Each kind has several hidden states, since junk in particular comes in many forms.

    Log emissions by state, measure and bin; log transitions; log start.
    """

    BINS = 16
    KIND_OF = np.repeat(np.arange(len(KINDS)), (4, 5, 6, 9))

    def __init__(self, emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.emit, self.move, self.start = emit, move, start

    @classmethod
    def fit(cls, doc: np.ndarray, bins: np.ndarray, states: np.ndarray, weight: np.ndarray) -> LineModel:
        k, m = len(cls.KIND_OF), bins.shape[1]
        emit = np.zeros((k, m, cls.BINS))
        for j in range(m):
            used = int(bins[bins[:, j] < MISSING, j].max(initial=0)) + 1
            c = np.bincount(states * cls.BINS + bins[:, j], weights=weight, minlength=k * cls.BINS).reshape(k, cls.BINS)
            c[:, :used] += 0.05
            c[:, MISSING] = 0
            emit[:, j, :] = np.log(np.maximum(c / c.sum(1, keepdims=True), 1e-9))
            emit[:, j, MISSING] = 0
        follow = doc[1:] == doc[:-1]
        pairs = np.bincount(states[:-1][follow] * k + states[1:][follow], weights=weight[1:][follow], minlength=k * k).reshape(k, k) + 0.1
        move = (1 - STICKY) / k + STICKY * pairs / pairs.sum(1, keepdims=True)
        head = np.concatenate(([True], ~follow))
        first = np.bincount(states[head], minlength=k) + 1.0
        return cls(emit, np.log(move), np.log(first / first.sum()))

    def score(self, bins: np.ndarray) -> np.ndarray:
        """Log emission of each line in each state. Measures overlap, so their joint weight is tempered."""
        total = np.zeros((len(bins), len(self.KIND_OF)), dtype=np.float32)
        for j in range(bins.shape[1]):
            total += self.emit[:, j, :].T.astype(np.float32)[bins[:, j]]
        return 0.7 * total

    def posterior(self, doc: np.ndarray, bins: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        """P(state | document) of each line. ``doc`` is sorted; ``allowed`` masks states by line."""
        score = self.score(bins)
        if allowed is not None:
            score = np.where(allowed, score, np.float32(-1e9))
        head = np.concatenate(([True], doc[1:] != doc[:-1]))
        begin = np.flatnonzero(head)
        length = np.diff(np.append(begin, len(doc)))
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        top = int(length[0])
        alive = np.searchsorted(-length, -np.arange(1, top + 1), side="right")  # documents with more than t lines
        move, tiny = np.exp(self.move).astype(np.float32), np.float32(1e-30)
        e = np.exp(score - score.max(1, keepdims=True)) + tiny * 1e-5
        if allowed is not None:
            e = np.where(allowed, e, 0).astype(np.float32)
        fwd = np.empty_like(e)
        f = np.exp(self.start).astype(np.float32) * e[begin]
        fwd[begin] = f / np.maximum(f.sum(1, keepdims=True), tiny)
        for t in range(1, top):
            at = begin[: alive[t]] + t
            f = (fwd[at - 1] @ move) * e[at]
            fwd[at] = f / np.maximum(f.sum(1, keepdims=True), tiny)
        back = np.ones_like(e)
        for t in range(top - 2, -1, -1):
            at = begin[: alive[t + 1]] + t
            b = (back[at + 1] * e[at + 1]) @ move.T
            back[at] = b / np.maximum(b.sum(1, keepdims=True), tiny)
        p = fwd * back
        return p / np.maximum(p.sum(1, keepdims=True), tiny)

    def kinds(self, doc: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """P(kind | document) of each line."""
        p = self.posterior(doc, bins)
        return np.stack([p[:, self.KIND_OF == k].sum(1) for k in range(len(KINDS))], axis=1)


def _spread(bins: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """A first state out of k for each line of one kind: distances to k lines that lie far apart."""
    if len(bins) == 0:
        return np.empty(0, dtype=np.int64)
    sample = bins[rng.choice(len(bins), min(len(bins), 3000), replace=False)]
    centres = [sample[0]]
    gap = (sample != centres[0]).sum(1)
    for _ in range(k - 1):
        p = gap.astype(float) ** 2
        centres.append(sample[rng.choice(len(sample), p=p / p.sum())] if p.sum() else sample[0])
        gap = np.minimum(gap, (sample != centres[-1]).sum(1))
    return np.stack([(bins != c).sum(1) for c in centres], axis=1).argmin(1)


def line_weight(n: dict[str, np.ndarray]) -> np.ndarray:
    """What a line counts for in its document's shares: between one each and its length."""
    return np.sqrt(n["chars"])


def train(texts: list[bytes], labels: list[str]) -> LineModel:
    """The model from labelled documents; the labels are those of whole documents."""
    doc, bins, n = measure(texts)
    y = np.array([KINDS.index(x) for x in labels])[doc]
    per_doc = np.bincount(doc, minlength=len(texts))
    weight, kind_of, rng = 1 / np.sqrt(per_doc[doc]), LineModel.KIND_OF, np.random.default_rng(5)
    states = np.zeros(len(doc), dtype=np.int64)
    sentence = (n["stop"] > 0) & (n["words"] >= 4)
    over = ((y == 1) | (y == 2)) & sentence  # a sentence over a list or table
    begin = np.where(over, 0, y)
    for k in range(len(KINDS)):
        own = np.flatnonzero(kind_of == k)
        states[begin == k] = own[_spread(bins[begin == k], len(own), rng)]
    allowed = kind_of[None, :] == begin[:, None]
    model = LineModel.fit(doc, bins, states, weight)
    for i in range(ROUNDS):
        if i == ROUNDS // 2:
            allowed = allowed | ((kind_of == 0)[None, :] & ((y == 1) | (y == 2))[:, None]) | ((kind_of == 1)[None, :] & ((y == 0) & ~sentence)[:, None])
        states = model.posterior(doc, bins, allowed).argmax(1)
        model = LineModel.fit(doc, bins, states, weight)
    return model


def label_shares(model: LineModel, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(share of each kind, number of lines) of each document."""
    doc, bins, n = measure(texts)
    shares = np.zeros((len(texts), len(KINDS)))
    if len(doc):
        p = model.kinds(doc, bins) * line_weight(n)[:, None]
        for s in range(len(KINDS)):
            shares[:, s] = np.bincount(doc, weights=p[:, s], minlength=len(texts))
        shares /= np.maximum(shares.sum(1, keepdims=True), 1e-300)
    return shares, np.bincount(doc, minlength=len(texts))


def sample_of(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[bytes], list[str]]:
    """Texts and labels of at most ``sample`` labelled documents, the same ones each time."""
    label = F.lower(F.trim("label"))
    some = labels.where(label.isin(list(KINDS)) & F.col("doc_id").isNotNull()).select("doc_id", label.alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    held = {}
    for row in some.collect():
        held.setdefault(row["doc_id"], []).append(row["label"])
    ids = documents.sparkSession.createDataFrame([(i,) for i in held], "doc_id long")  # at most ``sample`` rows
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where("trim(text) <> ''").collect() if held else []
    rows = sorted(((r["doc_id"], r["text"]) for r in rows), key=lambda r: (r[0], r[1]))
    return [t.encode() for i, t in rows for _ in held[i]], [x for i, _ in rows for x in held[i]]


def document_labels(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, kind, n_lines, prose, list, table, junk): what each document mostly is, and its label shares.

    One narrow pass over the texts; the model travels in the closure and is a few dozen kB.
    """
    schema = "doc_id long, kind string, n_lines long, prose double, list double, table double, junk double"
    texts, kinds = sample_of(documents, labels, sample)
    if not texts:
        return documents.sparkSession.createDataFrame([], schema)
    model = train(texts, kinds)
    parts = (model.emit, model.move, model.start)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = LineModel(*parts)
        for batch in batches:
            ids, encoded = batch["doc_id"].to_numpy(), [t.encode("utf-8", "replace") for t in batch["text"]]
            for i, j in blocks(encoded):
                shares, lines = label_shares(own, encoded[i:j])
                some = lines > 0
                best = np.array(KINDS)[shares[some].argmax(1)] if some.any() else np.empty(0, dtype=object)
                out = {"doc_id": ids[i:j][some], "kind": best, "n_lines": lines[some]}
                yield pd.DataFrame(out | {k: shares[some, s] for s, k in enumerate(KINDS)})

    return documents.where("trim(text) <> '' and doc_id is not null").select("doc_id", "text").mapInPandas(run, schema)


def blocks(texts: list[bytes], most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Slices of ``texts`` of at most ``most`` bytes, or of one text."""
    i = 0
    while i < len(texts):
        j, held = i + 1, len(texts[i])
        while j < len(texts) and held + len(texts[j]) <= most:
            held += len(texts[j])
            j += 1
        yield i, j
        i = j


def statistics(documents: DataFrame) -> DataFrame:
    """Per-document statistics as expressions: words, mean word length, symbol ratio, lines that end in punctuation,
    and common words. Words are runs of letters and digits; empty and null texts have zeros."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(F.lower(F.col("t")), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    lines = F.filter(F.split(F.col("t"), r"[\r\n]+"), lambda x: F.trim(x) != "")
    common = sorted({w for ws in COMMON.values() for w in ws.split()})
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 6)).otherwise(F.lit(0.0))
    held = once(documents.select("doc_id", text.alias("t")), ["doc_id", "t"], {"w": words, "l": lines})
    n_words, n_lines, n_chars = F.size("w"), F.size("l"), F.length("t")
    letters = F.length(F.array_join("w", ""))
    symbols = F.length(F.regexp_replace("t", r"[\p{L}\p{N}\s]", ""))
    ended = F.size(F.filter("l", lambda x: x.rlike(r"[.!?。！？][\"'”’)\]]*\s*$")))
    return held.select(
        "doc_id", n_words.cast("long").alias("n_words"), n_lines.cast("long").alias("n_lines"), ratio(letters, n_words).alias("mean_word_length"), ratio(symbols, n_chars).alias("symbol_ratio"),
        ratio(ended, n_lines).alias("ended_share"), ratio(F.size(F.filter("w", lambda x: x.isin(common))), n_words).alias("common_share"),
    )
