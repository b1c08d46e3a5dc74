"""Evaluation texts leaking into training text: size-partitioned MinHash containment search, verified exactly.

A test item leaks where a document holds SPAN successive words of it, or all of it if it has fewer. Items are cut
into windows of that length and partitioned by window size. A window is a set of five-word shingles, and its
signature is the least of their hashes; a document that contains the window contains the shingle with that hash, and
one of the document's own windows of the same size has the same signature. So equal signatures within a partition
find every containing document, and the candidates are verified by comparing the windows word by word.

Where a hyphen stands at a line break the word may go on or a new one begin. Within a window's reach of such a break a
document's shingles are hashed in every reading whose words occur in the items; one that has the signature of an item's window is verified
by walking on from it in both directions, where the item's next word says which reading holds. So breaks of either
kind may stand side by side, and the work doesn't grow with the number of readings of a window.

Items of up to MOST_WORDS words in all travel to the workers as one index. Beyond that nothing is collected: signatures
of both sides meet in a shuffle join, and only pairs with an equal signature bring their texts together.

Defined results: null and blank texts, rows without an id and items without a word match nothing; a document that leaks an item in many
places is reported once; repeated documents are reported each; an empty item table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN = 13
SHINGLE = 5
#: Words of all items together up to which their index is held by every worker (about 300 bytes a word).
MOST_WORDS = 500_000
#: Parts into which each signature is cut in the shuffle join, so that a common one is spread.
SALT = 16
#: The filter before the exact lookup has at most 2 ** BITS places.
BITS = 22

INVISIBLE = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff]")
COMMENT = re.compile(r"<!--.*?-->", re.S)
INLINE_TAG = re.compile(r"</?(?:a|abbr|b|bdi|big|cite|code|em|font|i|ins|kbd|mark|q|s|small|span|strong|sub|sup|tt|u|wbr)(?:\s[^<>]*)?/?>", re.I)
LINE_TAG = re.compile(r"<br\s*/?>", re.I)
TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
LINK_TARGET = re.compile(r"\]\([^()\s]*(?:\s+\"[^\"]*\")?\)|\[\[[^\[\]|]*\|")
SOFT_BREAK = re.compile(r"(?<=\w)\xad[^\S\r\n]*(?:\r\n|\n|\r)")
BROKEN_WORD = re.compile(r"(?<=\w)[-‐‑\xad]+[^\S\r\n]*(?:\r\n|\n|\r)[\s>|]*(?=\w)")
WORD = re.compile(r"[^\W_]+")
WORDS_AND_BREAKS = re.compile(r"[^\W_]+(?:\x1f[^\W_]+)*")
EMPHASIS = re.compile(r"(?:\*+|'{2,}|~{2,}|`+)")


def plain(text: str) -> str:
    """The text without entities, markup and invisible characters, in one case."""
    if "&" in text:
        text = html.unescape(text)
        if "&" in text:
            text = html.unescape(text)
    if not text.isascii():
        if "\xad" in text:
            text = SOFT_BREAK.sub("-\n", text)
        text = unicodedata.normalize("NFKC", INVISIBLE.sub("", text))
    if "<" in text:
        text = TAG.sub(" ", LINE_TAG.sub("\n", INLINE_TAG.sub("", COMMENT.sub("", text))))
    if "[" in text:
        text = LINK_TARGET.sub(" ", text)
    if "*" in text or "''" in text or "~~" in text or "`" in text:
        text = EMPHASIS.sub("", text)
    return text.casefold()


BREAK = "\x1f"


class Reading:
    """The words of a text, the shortest ones; ``breaks[i]``: word i may go on in word i + 1."""

    def __init__(self, text: str):
        flat = plain(text).replace(BREAK, " ")
        broken = BROKEN_WORD.sub(BREAK, flat) if "-" in flat or "\u2010" in flat or "\u2011" in flat else flat
        self.breaks: dict[int, bool] = {}
        if BREAK not in broken:
            self.words = WORD.findall(broken)
            return
        self.words = []
        for run in WORDS_AND_BREAKS.findall(broken):
            parts = run.split(BREAK)
            for i in range(len(self.words), len(self.words) + len(parts) - 1):
                self.breaks[i] = True
            self.words += parts

    def options(self, i: int, known=None, longest: float = math.inf) -> Iterator[tuple[str, int]]:
        """(word, place after it) of each word of up to ``longest`` characters that may begin at place i, of those in
        ``known`` if given."""
        word, at = self.words[i], i
        while len(word) <= longest:
            if known is None or word in known:
                yield word, at + 1
            if at not in self.breaks:
                return
            at += 1
            word += self.words[at]

    def paths(self, i: int, n: int, known=None, longest: float = math.inf) -> Iterator[tuple[tuple[str, ...], int]]:
        """(words, place after them) of each reading of ``n`` words from place i."""
        if n == 0:
            yield (), i
        elif i < len(self.words):
            for word, after in self.options(i, known, longest):
                for rest, end in self.paths(after, n - 1, known, longest):
                    yield (word, *rest), end

    def wholes(self, most: int) -> list[tuple[str, ...]]:
        """The readings of the whole text in fewer than ``most`` words."""
        least = len(self.words) - len(self.breaks)
        return [words for n in range(max(1, least), min(most - 1, len(self.words)) + 1) for words, end in self.paths(0, n) if end == len(self.words)] if least < most else []

    def windows(self) -> set[tuple[str, ...]]:
        """What a document must hold of this text: SPAN successive words, or all of them where there are fewer."""
        if not self.breaks:
            size = min(SPAN, len(self.words))
            return {tuple(self.words[i : i + size]) for i in range(len(self.words) - size + 1)} if size else set()
        return set(self.wholes(SPAN)) | {words for i in range(len(self.words)) for words, _ in self.paths(i, SPAN)}

    def forward(self, i: int, words: tuple[str, ...]) -> bool:
        """Whether ``words`` stand from place i on, in some reading."""
        for word in words:
            i = next((end for found, end in self.options(i, longest=len(word)) if found == word), -1) if 0 <= i < len(self.words) else -1
            if i < 0:
                return False
        return True

    def backward(self, i: int, words: tuple[str, ...]) -> bool:
        """Whether ``words`` stand before place i, in some reading."""
        for word in reversed(words):
            i -= 1
            if i < 0:
                return False
            found = self.words[i]
            while found != word and i - 1 in self.breaks and len(found) < len(word):
                i -= 1
                found = self.words[i] + found
            if found != word:
                return False
        return True

    def _walk(self, n: int, step: int) -> list[int]:
        """The places up to ``n`` words from a break, before it (step -1) or after it (step 1)."""
        seen: set[int] = set()
        for j in sorted(self.breaks, reverse=step > 0):
            i, left = j + (step > 0), n
            while 0 <= i < len(self.words) and i not in seen and left > 0:
                seen.add(i)
                left -= (i - 1 if step < 0 else i) not in self.breaks
                i += step
        return sorted(seen)

    def shingles_near_breaks(self, width: int, size: int, hashes: np.ndarray, hasher, known=None, longest: float = math.inf) -> tuple[np.ndarray, list]:
        """(hashes, [(place, words or None, place after)]) of every shingle of ``width`` words that a window of ``size``
        words which reaches over a break may hold: those with a joined word in every reading, the others as they stand
        (words None). ``hashes`` are those of the words."""
        joined = [(i, words, end) for i in self._walk(width, -1) for words, end in self.paths(i, width, known, longest) if end - i > width]
        own = _signatures([words for _, words, _ in joined], hasher) if joined else np.empty(0, dtype=np.uint64)
        flat = _window_signatures(hashes, width)
        places = np.array(sorted({*self._walk(size, -1), *self._walk(size, 1)}), dtype=np.int64)
        places = places[places < len(flat)]
        return np.concatenate((own, flat[places])), joined + [(i, None, i + width) for i in places.tolist()]


def _window_signatures(words: np.ndarray, size: int) -> np.ndarray:
    """The signature of each window of ``size`` words; position i is the window that begins at word i."""
    width = min(SHINGLE, size)
    n = len(words) - width + 1
    if n <= 0 or len(words) < size:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            h = (h ^ words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    least, have, want = h, 1, size - width + 1
    while have < want:
        step = min(have, want - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return least


def _hashes(words: list[str]) -> np.ndarray:
    """Hashes that hold within one process."""
    return np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)


def _stable_hashes(words: list[str]) -> np.ndarray:
    """Hashes that are the same everywhere."""
    return pd.util.hash_array(np.array(words, dtype=object), categorize=len(words) > 1000) if words else np.empty(0, dtype=np.uint64)


def _by_size(windows: set[tuple[str, ...]]) -> dict[int, list[tuple[str, ...]]]:
    out: dict[int, list] = defaultdict(list)
    for words in sorted(windows):
        out[len(words)].append(words)
    return out


def _signatures(windows: list[tuple[str, ...]], hashes=_hashes) -> np.ndarray:
    """The signature of each of some windows of one size."""
    size = len(windows[0])
    return _window_signatures(hashes([w for words in windows for w in words]), size)[::size]


class Part:
    """The windows of one size: their signatures, and the items that each belongs to."""

    def __init__(self, size: int, found: dict[tuple[str, ...], set[int]]):
        self.size, self.found = size, found
        self.windows = list(found)
        self.signature = _signatures(self.windows)
        self.known = np.unique(self.signature)
        self.shift = np.uint64(64 - min(BITS, (64 * len(self.known)).bit_length()))
        self.bits = np.zeros(1 << (64 - int(self.shift)), dtype=bool)
        self.bits[(self.known >> self.shift).astype(np.int64)] = True
        self._shingles: dict[int, list] | None = None

    def hits(self, signature: np.ndarray) -> np.ndarray:
        """Places in ``signature`` that hold a known one."""
        maybe = np.flatnonzero(self.bits[(signature >> self.shift).astype(np.int64)])
        at = np.searchsorted(self.known, signature[maybe])
        at[at == len(self.known)] = 0
        return maybe[self.known[at] == signature[maybe]]

    def by_shingle(self, signature: int) -> list[tuple[tuple[str, ...], int]]:
        """(window, place of the shingle that gives its signature) of the windows with a signature."""
        if self._shingles is None:
            self._shingles, width = defaultdict(list), min(SHINGLE, self.size)
            for words, own in zip(self.windows, self.signature.tolist()):
                self._shingles[own].append((words, int(_window_signatures(_hashes(list(words)), width).argmin())))
        return self._shingles.get(signature, [])


class Index:
    """The windows of all items, by size. Built in each worker, since string hashes hold within one process."""

    def __init__(self, items: list[tuple[int, str]]):
        sizes: dict[int, dict[tuple[str, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            for words in Reading(text or "").windows():
                sizes[len(words)][words].add(item)
        self.parts = [Part(size, found) for size, found in sorted(sizes.items())]
        self.vocabulary = {w for part in self.parts for words in part.windows for w in words}
        self.longest = max(map(len, self.vocabulary), default=0)

    def search(self, docs: list[tuple[int, Reading]]) -> set[tuple[int, int]]:
        """(position in ``docs``' numbering, item) of every verified leak."""
        words = [w for _, doc in docs for w in doc.words]
        if not words:
            return set()
        hashes = _hashes(words)
        ends = np.cumsum(np.array([len(doc.words) for _, doc in docs]))
        out = set()
        for part in self.parts:
            maybe = part.hits(_window_signatures(hashes, part.size))
            doc = np.searchsorted(ends, maybe, side="right")
            inside = maybe + part.size <= ends[doc]
            for i, d in zip(maybe[inside].tolist(), doc[inside].tolist()):
                out.update((docs[d][0], item) for item in part.found.get(tuple(words[i : i + part.size]), ()))
        for (at, doc), end in zip(docs, ends.tolist()):
            if doc.breaks:
                out.update((at, item) for item in self._around_breaks(doc, hashes[end - len(doc.words) : end]))
        return out

    def _around_breaks(self, doc: Reading, hashes: np.ndarray) -> set[int]:
        """The items of which a window reaches over a break of the document."""
        out: set[int] = set()
        for width in {min(SHINGLE, part.size) for part in self.parts}:
            parts = [part for part in self.parts if min(SHINGLE, part.size) == width]
            own, places = doc.shingles_near_breaks(width, max(part.size for part in parts), hashes, _hashes, self.vocabulary, self.longest)
            for part in parts:
                for k in part.hits(own).tolist():
                    i, shingle, end = places[k]
                    shingle = shingle or tuple(doc.words[i:end])
                    for window, place in part.by_shingle(int(own[k])):
                        if window[place : place + width] == shingle and doc.backward(i, window[:place]) and doc.forward(end, window[place + width :]):
                            out.update(part.found[window])
        return out


def leaks(documents: DataFrame, items: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """(doc_id, item_id) of every document that leaks an item."""
    texts = documents.where("text is not null and doc_id is not null").select("doc_id", "text")
    held = items.where("text is not null and item_id is not null").select("item_id", "text")
    # every other character at most begins a word
    if (held.agg(F.sum(F.length("text"))).first()[0] or 0) / 2 > most_words:
        return _joined(texts, held)
    known = [(r["item_id"], r["text"]) for r in held.collect()]  # bounded by ``most_words``

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(known)
        for batch in batches:
            ids = batch["doc_id"].tolist()
            found = sorted(index.search([(k, Reading(text)) for k, text in enumerate(batch["text"]) if text]))
            yield pd.DataFrame({"doc_id": [ids[k] for k, _ in found], "item_id": [item for _, item in found]}, dtype="int64")

    return texts.mapInPandas(run, "doc_id long, item_id long")


def _joined(texts: DataFrame, items: DataFrame) -> DataFrame:
    """The same for items of any number: signatures meet in a join, salted so that a common one is spread, and each pair
    with an equal one is verified as a whole. Of a document without breaks a signature is sent once for each partition
    of sizes; of one with breaks also those of its shingles around them."""
    signed = "id long, size int, signature long"

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [max((len(w) for ws in Reading(x).windows() for w in ws), default=0) for x in batch["text"]]})

    longest = items.mapInPandas(lengths, "n long").agg(F.max("n")).first()[0] or 0

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for item, text in zip(batch["item_id"], batch["text"]):
                for size, found in _by_size(Reading(text).windows()).items():
                    out += [(item, size, s) for s in np.unique(_signatures(found, _stable_hashes)).view(np.int64).tolist()]
            yield pd.DataFrame(out, columns=["id", "size", "signature"])

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                doc = Reading(text)
                hashes = _stable_hashes(doc.words)
                found = {size: _window_signatures(hashes, size) for size in range(1, SPAN + 1)}
                if doc.breaks:
                    for width in range(1, SHINGLE + 1):
                        own, _ = doc.shingles_near_breaks(width, width if width < SHINGLE else SPAN, hashes, _stable_hashes, longest=longest)
                        for size in [width] if width < SHINGLE else range(SHINGLE, SPAN + 1):
                            found[size] = np.concatenate((found[size], own))
                for size, signatures in found.items():
                    out.append(pd.DataFrame({"id": doc_id, "size": np.int32(size), "signature": np.unique(signatures).view(np.int64)}))
            yield pd.concat(out, ignore_index=True) if out else pd.DataFrame({"id": [], "size": [], "signature": []})

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [bool(Index([(0, item)]).search([(0, Reading(text))])) for item, text in zip(batch["item_text"], batch["text"])]
            yield batch.loc[ok, ["doc_id", "item_id"]]

    own = items.mapInPandas(windows, signed).select(F.col("id").alias("item_id"), "size", "signature", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    sent = texts.mapInPandas(parts, signed).withColumnRenamed("id", "doc_id").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int"))
    pairs = sent.join(own.hint("shuffle_hash"), ["size", "signature", "salt"]).select("doc_id", "item_id").distinct()
    met = pairs.join(items.withColumnRenamed("text", "item_text"), "item_id").join(texts, "doc_id")
    return met.select("doc_id", "item_id", "text", "item_text").mapInPandas(verify, "doc_id long, item_id long")
