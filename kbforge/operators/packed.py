"""Several values packed in one field: infer the delimiter, split, and give each value a row and a position.

The delimiter of a source is inferred by scoring candidate families over all of its rows: how consistent the piece
counts are of the strings that a family divides (one over one plus their coefficient of variation, times the share of
strings it divides), the share of pieces that hold no delimiter of a stronger family, and the share that looks like
the field's type. The scores are sums, so a source that holds most rows is added up before anything is shuffled, and
they give each source its ranking of the families. A string is then divided by the family that leaves no stronger
delimiter in a piece and divides at all; where several do, by the one whose pieces look most like the field's type, and
of these by the one that ranks first in its source.
What stands in double quotes or parentheses is never divided.

Strings without quotes, brackets or parentheses are scored, chosen and split by column expressions; the rest, where
nesting matters, go through Python in Arrow batches. Both follow the same rules.

Defined results: a null, blank or all-delimiter string gives no row, and neither does a row without a key; empty
pieces and pieces of bare delimiters are dropped and not counted; an unbalanced quote or parenthesis is an ordinary character; repeated input rows
give repeated output rows; a null source is a source of its own; other columns play no part.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbforge.staging import Stage, broadcast_if_small, once

#: Sources up to which their families are broadcast; beyond it the join shuffles.
MOST_SOURCES = 100_000

QUOTED = re.compile(r'"(?:[^"]|"")*"')
INNERMOST = re.compile(r"\([^()]*\)")
SPACES = re.compile(r"\s+")
#: A piece of nothing but delimiters is empty.
BARE = re.compile(r"[\s,;|&]*")
QUOTED_WITH_NOTE = re.compile(r'"((?:[^"]|"")*)"(\s*\(.*\))?', re.S)


@dataclass(frozen=True)
class Packed:
    """A packed field: its delimiter families from strong to weak, and the type its pieces should have."""

    column: str
    families: tuple[tuple[str, str], ...]
    piece: str = r".*\w.*"


NAMES = Packed(
    "authors",
    (
        ("semicolon_bar", r"\s*[;|](?:\s*(?:and\s|&))?|\s+and\s+|\s*&\s*"),
        ("comma_and", r"\s*,(?:\s*(?:and\s|&))?|\s+and\s+|\s*&\s*"),
        ("line_break", r"[\r\n]+"),
    ),
    r"[^;|]*\w[^;|]*",
)
CODES = Packed(
    "categories",
    (
        ("any", r"[\s,;|/]+"),
        ("marks", r"\s*[,;|/][\s,;|/]*"),
        ("blank", r"\s+"),
    ),
    r"[\w.-]+",
)

#: What makes a family count as present; for the first family of NAMES the words between names alone don't.
EVIDENCE = {"semicolon_bar": r"[;|]"}


def protect(text: str) -> str:
    """The text with every character in double quotes or parentheses blanked out, positions kept."""
    if '"' in text:
        text = QUOTED.sub(lambda m: "\0" * len(m[0]), text)
    while "(" in text:
        masked = INNERMOST.sub(lambda m: "\0" * len(m[0]), text)
        if masked == text:
            break
        text = masked
    return text


def clean(piece: str) -> str:
    """One value: white space collapsed, the quotes around it removed, a doubled quote inside made one."""
    piece = SPACES.sub(" ", piece).strip()
    if piece.startswith('"') and (m := QUOTED_WITH_NOTE.fullmatch(piece)):
        piece = m[1].replace('""', '"') + (m[2] or "")
    elif len(piece) > 1 and piece[0] == piece[-1] == "'":
        piece = piece[1:-1]
    return SPACES.sub(" ", piece).strip()


def bracketed(text: str) -> list[str] | None:
    """The items of a list literal around the whole string, else None."""
    if not (text.startswith("[") and text.endswith("]")):
        return None
    for load in (json.loads, ast.literal_eval):
        try:
            items = load(text)
        except (ValueError, SyntaxError, RecursionError, MemoryError):
            continue
        if isinstance(items, list):
            return [SPACES.sub(" ", str(x)).strip() for x in items if x is not None]
    return None


def pieces(text: str, mask: str, pattern: re.Pattern) -> list[str]:
    out, at = [], 0
    for m in pattern.finditer(mask):
        out.append(text[at : m.start()])
        at = m.end()
    out.append(text[at:])
    return out


class Splitter:
    """The compiled form of a Packed field, one per Python worker."""

    def __init__(self, packed: Packed):
        flags = re.I
        self.families = [(n, re.compile(p, flags), re.compile(EVIDENCE.get(n, p), flags)) for n, p in packed.families]
        self.piece = re.compile(packed.piece, re.S)

    def scores(self, text: str) -> list[tuple[str, float, float, float]]:
        """(family, divides, whole, typed) of each candidate on one string."""
        mask, out = protect(text), []
        for k, (name, pattern, evidence) in enumerate(self.families):
            divides = bool(evidence.search(mask)) and bool(pattern.search(mask))
            masked = [p for p in pieces(mask, mask, pattern) if p.strip()]
            whole = sum(not any(stronger.search(p) for _, _, stronger in self.families[:k]) for p in masked)
            typed = sum(bool(self.piece.fullmatch(p.replace("\0", "x"))) for p in masked)
            n = max(1, len(masked))
            out.append((name, float(divides), whole / n, typed / n))
        return out

    def choose(self, text: str, ranking: list[str] | None = None) -> str:
        """The family for a string: no stronger delimiter left in a piece, then one that divides, then pieces of the
        field's type, then the source's ranking, then the stronger one."""
        place = {name: k for k, name in enumerate(ranking or ())}
        best = max(enumerate(self.scores(text)), key=lambda x: (x[1][2] == 1.0, x[1][1], x[1][3], -place.get(x[1][0], len(place)), -x[0]))
        return best[1][0]

    def split(self, text: str | None, ranking: list[str] | None = None) -> list[str]:
        text = (text or "").strip()
        if not text:
            return []
        values = bracketed(text)
        if values is None:
            if text.startswith("[") and text.endswith("]"):
                text = text[1:-1]
            family = self.choose(text, ranking)
            pattern = next(p for n, p, _ in self.families if n == family)
            values = [clean(p) for p in pieces(text, protect(text), pattern)]
        return [v for v in values if not BARE.fullmatch(v)]


#: Characters by which a string is left to Python: quotes, brackets, parentheses, and white space or control characters
#: that the two regular expression engines take differently.
NESTED = "[\"()\\[\\]\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _simple(text: Column) -> Column:
    return ~F.coalesce(text.rlike(NESTED), F.lit(False))


def _evidence(name: str, pattern: str) -> str:
    return f"(?i:{EVIDENCE.get(name, pattern)})"


def _without(pattern: str) -> Callable[[Column], Column]:
    return lambda x: ~x.rlike(pattern)


def _divides(text: Column, packed: Packed) -> Column:
    """Array of whether each family divides a string without nesting."""
    return F.array(*[text.rlike(_evidence(*f)) & text.rlike("(?i)" + f[1]) for f in packed.families])


def _scored(text: Column, divides: Column, packed: Packed) -> Column:
    """Array of (name, divides, n, whole, typed), one entry per family, for a string without nesting: the number of
    pieces, and how many of them hold no stronger delimiter and look like the field's type. Pieces are looked at only
    where a family divides the string, and for stronger delimiters only where the string holds one."""
    out = []
    blank = lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) == ""
    for k, (name, pattern) in enumerate(packed.families):
        own = F.get(divides, F.lit(k))
        found = F.when(own, F.filter(F.split(text, "(?i)" + pattern), lambda x: ~blank(x))).when(~blank(text), F.array(text)).otherwise(F.array().cast("array<string>"))
        stronger = "|".join(_evidence(*f) for f in packed.families[:k])
        whole = F.size(found) if not stronger else F.when(text.rlike(stronger), F.size(F.filter(found, _without(stronger)))).otherwise(F.size(found))
        typed = F.size(F.filter(found, lambda x: x.rlike(f"(?Us)^(?:{packed.piece})$")))
        out.append(F.struct(F.lit(name).alias("name"), own.cast("double").alias("divides"), F.size(found).alias("n"), whole.alias("whole"), typed.alias("typed")))
    return F.when(text.isNotNull(), F.array(*out))


def _chosen(text: Column, divides: Column, ranking: Column, packed: Packed) -> Column:
    """The name of the family that ``Splitter.choose`` takes. Where one family alone divides a string its pieces hold no
    other delimiter, and where none does all give the string itself; only the rest is scored."""
    place = lambda x: F.coalesce(F.nullif(F.array_position(ranking, x["name"]), F.lit(0)), F.lit(len(packed.families) + 1))
    least = lambda x: F.greatest(x["n"], F.lit(1))
    order = F.transform(_scored(text, divides, packed), lambda x, i: F.struct((x["whole"] == least(x)).alias("whole"), x["divides"].alias("divides"), (x["typed"] / least(x)).alias("typed"), (-place(x)).alias("place"), (-i).alias("strength"), x["name"].alias("name")))
    names = F.array(*[F.lit(n) for n, _ in packed.families])
    alone = F.size(F.filter(divides, lambda d: d)) <= 1
    return F.when(alone, F.get(names, F.greatest(F.array_position(divides, F.lit(True)) - 1, F.lit(0)).cast("int"))).otherwise(F.array_max(order)["name"])


def _values(text: Column, family: Column, packed: Packed) -> Column:
    """The values of a string without nesting."""
    cut = reduce(lambda rest, f: F.when(family == f[0], F.split(text, "(?i)" + f[1])).otherwise(rest), packed.families, F.array().cast("array<string>"))
    one = lambda x: _strip(F.regexp_replace(_strip(F.regexp_replace(x, r"\s+", " ")), "^'(.*)'$", "$1"))
    return F.filter(F.transform(cut, one), lambda v: ~v.rlike(r"^[\s,;|&]*$"))


def infer_delimiters(df: DataFrame, packed: Packed, source: Column) -> DataFrame:
    """(source, ranking): the families of each source from the best score on. Lists in brackets have no delimiter and
    take no part; quotes and parentheses, to three levels, count as one letter here."""
    text = _strip(F.col(packed.column))
    quoted = F.regexp_replace(F.regexp_replace(text, r"^\[|\]$", ""), QUOTED.pattern, "x")
    noted = reduce(lambda m, _: F.regexp_replace(m, INNERMOST.pattern, "x"), range(3), quoted)
    mask = F.when(text.rlike(r'["()\[\]]'), noted).otherwise(text)
    listed = F.startswith(text, F.lit("[")) & F.endswith(text, F.lit("]"))
    rows = df.select(source.cast("string").alias("source"), F.when(~listed & (text != ""), mask).alias("mask")).where("mask is not null")
    rows = once(rows, ["source", "mask"], {"divides": _divides(F.col("mask"), packed)})
    rows = once(rows, ["source"], {"scored": _scored(F.col("mask"), F.col("divides"), packed)})
    sums = []
    for k in range(len(packed.families)):
        x = F.get("scored", F.lit(k))
        n = x["n"].cast("double")
        divided = F.when(x["divides"] == 1.0, n)
        least = F.greatest(n, F.lit(1.0))
        # sums of whole numbers and fractions of few digits: the order of adding them doesn't show in a ranking of rounded scores
        sums += [F.sum(x["divides"]).alias(f"d_{k}"), F.sum(divided).alias(f"n_{k}"), F.sum(divided * divided).alias(f"nn_{k}"), F.sum(x["whole"] / least).alias(f"w_{k}"), F.sum(x["typed"] / least).alias(f"t_{k}")]
    total = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), *sums)
    scores = []
    for k, (name, _) in enumerate(packed.families):
        d, mean = F.col(f"d_{k}"), F.try_divide(f"n_{k}", f"d_{k}")
        spread = F.sqrt(F.greatest(F.try_divide(f"nn_{k}", f"d_{k}") - mean * mean, F.lit(0.0)))
        consistency = F.coalesce(d / F.col("rows") / (1 + F.try_divide(spread, mean)), F.lit(0.0))
        score = F.round(consistency + (2 * F.col(f"w_{k}") + F.col(f"t_{k}")) / F.col("rows"), 9)
        scores.append(F.struct((-score).alias("s"), F.lit(k).alias("k"), F.lit(name).alias("name")))
    return total.select("source", F.transform(F.array_sort(F.array(*scores)), lambda x: x["name"]).alias("ranking"))


def split_packed(df: DataFrame, key: str, fields: tuple[Packed, ...], source: Column | None = None) -> DataFrame:
    """(key, field, pos, value): each value of each packed field on a row of its own, positions from 1.

    ``source``: what tells the sources apart; without it all rows are one source. The rankings are written down and
    joined back, by broadcast where the sources are counted to be few.
    """
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key_"), (F.lit(None) if source is None else source).cast("string").alias("source_"), *[F.col(p.column).alias(f"text_{i}") for i, p in enumerate(fields)])
    for i, packed in enumerate(fields):
        chosen = Stage(infer_delimiters(rows, replace(packed, column=f"text_{i}"), F.col("source_")), "families").df
        chosen = broadcast_if_small(chosen.select(F.col("source").alias("from_"), F.col("ranking").alias(f"ranking_{i}")), MOST_SOURCES)
        rows = rows.join(chosen, F.col("source_").eqNullSafe(F.col("from_")), "left").drop("from_")
    kind = df.schema[key].dataType

    each, none = range(len(fields)), F.array().cast("array<string>")
    ranks = [f"ranking_{i}" for i in each]
    held = once(rows, ["key_", *ranks], {f"t_{i}": F.when(_simple(F.col(f"text_{i}")), _strip(F.col(f"text_{i}"))) for i in each})
    held = once(held, ["key_", *ranks, *[f"t_{i}" for i in each]], {f"d_{i}": _divides(F.col(f"t_{i}"), p) for i, p in enumerate(fields)})
    held = once(held, ["key_", *[f"t_{i}" for i in each]], {f"f_{i}": _chosen(F.col(f"t_{i}"), F.col(f"d_{i}"), F.col(f"ranking_{i}"), p) for i, p in enumerate(fields)})
    found = F.array(*[F.struct(F.lit(p.column).alias("field"), F.coalesce(_values(F.col(f"t_{i}"), F.col(f"f_{i}"), p), none).alias("values")) for i, p in enumerate(fields)])
    flat = held.select("key_", F.explode(found).alias("v")).select("key_", "v.field", F.posexplode("v.values").alias("pos", "value")).select(F.col("key_").alias(key), "field", (F.col("pos") + 1).cast("long").alias("pos"), "value")
    nested = rows.where(reduce(lambda a, b: a | b, [~_simple(F.col(f"text_{i}")) for i in each]))
    columns = [c for i in each for c in (F.when(~_simple(F.col(f"text_{i}")), F.col(f"text_{i}")).alias(f"text_{i}"), f"ranking_{i}")]
    schema = T.StructType([T.StructField(key, kind), T.StructField("field", T.StringType()), T.StructField("pos", T.LongType()), T.StructField("value", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitters = [(i, p.column, Splitter(p)) for i, p in enumerate(fields)]
        for batch in batches:
            out = []
            for i, column, splitter in splitters:
                for k, text, ranking in zip(batch["key_"], batch[f"text_{i}"], batch[f"ranking_{i}"]):
                    if text is not None:
                        out += [(k, column, n, v) for n, v in enumerate(splitter.split(text, None if ranking is None else list(ranking)), 1)]
            yield pd.DataFrame(out, columns=[key, "field", "pos", "value"])

    return flat.unionByName(nested.select("key_", *columns).mapInPandas(run, schema))
