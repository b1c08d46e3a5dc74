"""Splitting oversized texts at natural boundaries, with the last unit of each piece repeated in the next.

Balanced targets: the fewest pieces are computed, equal-length targets placed, and each target is snapped to the
strongest boundary near it (paragraph before sentence before word). Where any piece, its overlap included, is over
the limit, one more piece is tried. A stretch without any boundary is cut at the target itself.

Defined results: null and blank texts and texts within the limit give no piece; the same key stored more than once
counts once (the text of the smallest id); a null key is a key of its own; lengths are in characters (code points).
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2048
#: A unit is usable for cutting and overlap where three of them fit a piece.
UNIT_SHARE = 3
TOLERANCE = 0.25

PARAGRAPH_END = re.compile(r"(?:\r\n|\n|\r)(?:[^\S\r\n]*(?:\r\n|\n|\r))+\s*")
CLOSING = r"\"'”’»›)\]}」』）】》〉"
SENTENCE_END = re.compile(rf"(?:[.!?]+[{CLOSING}]*(?=\s|$)|[。！？]+[{CLOSING}]*|(?=[\r\n]))\s*")
WORD_END = re.compile(r"\s+")
LEVELS = (("paragraph", PARAGRAPH_END), ("sentence", SENTENCE_END), ("word", WORD_END))


def ends(pattern: re.Pattern, text: str) -> list[int]:
    """Offsets at which a new unit begins, without the start and the end of the text."""
    return [m.end() for m in pattern.finditer(text) if 0 < m.end() < len(text)]


def longest(text: str, starts: list[int]) -> int:
    edges = [0, *starts, len(text)]
    return max(len(text[a:b].strip()) for a, b in zip(edges, edges[1:]))


def boundary_of(text: str, limit: int = LIMIT) -> str:
    """The coarsest unit of which every instance has at most a third of ``limit`` characters, or ``none``."""
    return next((name for name, pattern in LEVELS if longest(text, ends(pattern, text)) <= limit // UNIT_SHARE), "none")


def _near(starts: list[int], target: float, reach: float, low: int) -> int | None:
    a, b = bisect_right(starts, max(low, target - reach)), bisect_right(starts, target + reach)
    return min(starts[a:b], key=lambda x: (abs(x - target), x)) if a < b else None


def _overlap_start(text: str, levels: list[list[int]], begin: int, cut: int, most: int) -> int:
    """Where the last unit before ``cut`` begins, in the coarsest of sentence and word that stays within ``most``."""
    for starts in levels:
        k = bisect_left(starts, cut)
        at = starts[k - 1] if k and starts[k - 1] > begin else begin
        if cut - at <= most:
            return at
    return max(begin, cut - most)


def split_text(text: str, limit: int = LIMIT, overlap: int = 1) -> list[tuple[int, int, int]]:
    """(start with overlap, start of what is new, end) of each piece; ``overlap`` 0 repeats nothing, 1 the last unit."""
    size, most = len(text), limit // UNIT_SHARE
    levels = [ends(pattern, text) for _, pattern in LEVELS]
    n = -(-size // limit)
    while True:
        cuts, reach = [0], size / n * TOLERANCE
        for i in range(1, n):
            target = size * i / n
            at = next((c for starts in levels if (c := _near(starts, target, reach, cuts[-1])) is not None), None)
            cuts.append(round(target) if at is None else at)
        cuts.append(size)
        out = [(a if i == 0 or not overlap else _overlap_start(text, levels[1:], cuts[i - 1], a, most), a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        if all(b - a <= limit for a, _, b in out):
            return out
        n += 1


def split_oversized(chunks: DataFrame, limit: int = LIMIT, overlap: int = 1) -> DataFrame:
    """(source_id, chunk_index, piece_index, n_pieces, boundary, overlap_chars, chunk_text) for each text over ``limit``.

    ``chunks`` needs id, source_id, chunk_index and chunk_text. Only the oversized rows are shuffled, once, to drop
    repeated deliveries; the split itself is narrow.
    """
    large = chunks.where(F.length("chunk_text") > limit).groupBy("source_id", "chunk_index").agg(F.min_by("chunk_text", "id").alias("chunk_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["source_id", "chunk_index", "piece_index", "n_pieces", "boundary", "overlap_chars", "chunk_text"]
        for batch in batches:
            rows = []
            for source, index, text in zip(batch["source_id"], batch["chunk_index"], batch["chunk_text"]):
                kind, parts = boundary_of(text, limit), split_text(text, limit, overlap)
                rows += [(source, index, i, len(parts), kind, new - a, text[a:b].strip()) for i, (a, new, b) in enumerate(parts)]
            yield pd.DataFrame(rows, columns=columns)

    schema = "source_id long, chunk_index long, piece_index long, n_pieces long, boundary string, overlap_chars long, chunk_text string"
    keys = [F.col(c).cast("string").alias(c) for c in ("source_id", "chunk_index")]  # a null would make them doubles
    named = large.select(*keys, "chunk_text").mapInPandas(run, schema.replace("source_id long, chunk_index long", "source_id string, chunk_index string"))
    return named.withColumns({c: F.col(c).cast("long") for c in ("source_id", "chunk_index")})
