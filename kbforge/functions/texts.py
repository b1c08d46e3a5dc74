"""Text functions. Everything is a column expression but for the chunker, which is a sequential fold.

Null text gives null (the chunker: no chunk).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What ends a sentence for the splitter.
SENTENCE_BREAK = r"([.!?。！？][\"'”’)\]]*)\s+"
MARK = "\u0001"
CHUNK_SIZE, CHUNK_OVERLAP = 2048, 1
JOINT = "..."


def sentences(text: Column) -> Column:
    """Sentences in order; each keeps its punctuation. A blank text has none."""
    marked = F.regexp_replace(F.trim(text), SENTENCE_BREAK, "$1" + MARK)
    return F.filter(F.split(marked, MARK), lambda s: F.trim(s) != "")


_BREAK = re.compile(SENTENCE_BREAK)


def split_sentences(text: str) -> list[str]:
    return [s for s in _BREAK.sub(r"\1" + MARK, text.strip(" ")).split(MARK) if s.strip(" ")]


def fold_chunks(parts: list[str], size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """Sentences gathered into chunks of less than ``size`` characters, each beginning with the last ``overlap``
    pieces of the one before (0: none). Sentences over a third of ``size`` are first cut between words."""
    most = size // 3
    pieces: list[str] = []
    for part in parts:
        if len(part) <= most:
            pieces.append(part)
            continue
        line = None
        for word in part.split():
            if line is not None and len(line) + len(word) + 1 < most:
                line += " " + word
            else:
                if line is not None:
                    pieces.append(line)
                line = word
        if line is not None:
            pieces.append(line)
    chunks: list[list[str]] = []
    held = 0
    for piece in pieces:
        if chunks and held + len(piece) < size:
            chunks[-1].append(piece)
            held += 1 + len(piece)
        else:
            again = chunks[-1][-overlap:] if chunks and overlap else []
            chunks.append([*again, piece])
            held = sum(map(len, chunks[-1])) + len(chunks[-1]) - 1
    return [" ".join(c) for c in chunks]


def chunk_documents(df: DataFrame, key: str, text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """(key, chunk_index, chunk_text) of every text with content; one narrow pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, i, c) for k, t in zip(batch["key"], batch["text"]) for i, c in enumerate(fold_chunks(split_sentences(t), size, overlap))]
            yield pd.DataFrame(rows, columns=[key, "chunk_index", "chunk_text"])

    kind = df.schema[key].dataType.simpleString()
    return df.where(F.trim(text) != "").select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"{key} {kind}, chunk_index long, chunk_text string")


def join_chunks(chunks: Column) -> Column:
    """One text from ordered (chunk_index, chunk_text) structs. A chunk that follows its predecessor loses its first
    sentence (the overlap) when it has three or more; its sentences and all chunks are joined by dots."""

    def one(c: Column, i: Column) -> Column:
        follows = (i > 0) & (F.get(chunks, i - 1)["chunk_index"] == c["chunk_index"] - 1)
        own = sentences(c["chunk_text"])
        kept = F.when(F.size(own) >= 3, F.slice(own, F.lit(2), F.greatest(F.size(own) - 1, F.lit(1)))).otherwise(own)
        return F.when(follows, F.array_join(kept, JOINT)).otherwise(c["chunk_text"])

    return F.array_join(F.transform(chunks, one), JOINT)


def snippet(text: Column, term: Column, most: int = 250, padding: int = 70) -> Column:
    """A window of at most ``most`` characters around the first match of ``term``, case ignored, with dots where cut.
    Without a match, or for a blank term, the beginning of the text."""
    n, q = F.length(text), F.length(term)
    at = F.instr(F.lower(text), F.lower(term))  # from 1; 0 where absent
    start, stop = F.greatest(F.lit(0), at - 1 - padding), F.least(n, at - 1 + q + padding)
    before, after = F.when(start > 0, JOINT).otherwise(""), F.when(stop < n, JOINT).otherwise("")
    room = F.lit(most) - F.length(before) - F.length(after)
    inside = at - 1 - start
    shift = F.greatest(F.lit(0), inside - F.floor((room - q) / 2).cast("int"))
    shift = F.when(q >= room, inside).otherwise(F.when(shift + room > stop - start, F.greatest(F.lit(0), stop - start - room)).otherwise(shift))
    fits = (stop - start) <= room
    window = F.substring(text, start + F.when(fits, 0).otherwise(shift) + 1, F.when(fits, stop - start).otherwise(F.least(room, stop - start - shift)))
    head = F.when(n > most, F.concat(F.substring(text, 1, most - 3), F.lit(JOINT))).otherwise(text)
    return F.when((n <= most) | (F.coalesce(q, F.lit(0)) == 0) | (at == 0), head).otherwise(F.concat(before, window, after))


def shorten(text: Column, most: int = 50) -> Column:
    """Texts of ``most`` characters or more are cut to ``most`` with dots at the end."""
    return F.when(F.length(text) >= most, F.concat(F.substring(text, 1, most - 3), F.lit(JOINT))).otherwise(text)


def middle(text: Column, width: int = 80) -> Column:
    """The middle ``width`` - 6 characters of the text between dots, line breaks made blanks."""
    flat = F.regexp_replace(text, "\n", " ")
    start = F.greatest(F.floor((F.length(flat) - width) / 2), F.lit(0)).cast("int")
    return F.concat(F.lit(JOINT), F.substring(flat, start + 1, F.lit(width - 6)), F.lit(JOINT))


def author_list(authors: Column) -> Column:
    """Names divided at commas and the word ``and``, white space collapsed, empty ones left out; null gives none."""
    parts = F.split(F.coalesce(authors, F.lit("")), r",| and ")
    return F.filter(F.transform(parts, lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")


def file_slug(name: Column, most: int = 40) -> Column:
    """Lower-case letters, digits and single dashes; long names keep 20 characters from the front and 19 from the back."""
    flat = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9-]", "-"), "-+", "-"), "^-+|-+$", "")
    named = F.when(flat == "", F.lit("file")).otherwise(flat)
    strip = lambda x: F.regexp_replace(x, "-+$", "")
    return F.when(F.length(named) > most, F.concat(strip(F.substring(named, 1, 20)), F.lit("-"), strip(F.substring(named, -19, 19)))).otherwise(named)


def caption_part(text: Column, which: str) -> Column:
    """The ``long`` or ``short`` caption of a caption block, quotes around it removed; null where it is missing."""
    found = F.regexp_extract(text, rf"(?m)^.*caption\.{which}:[ \t]*(.*?)[ \t]*$", 1)
    return F.when(text.rlike(rf"(?m)^.*caption\.{which}:"), F.trim(F.regexp_replace(found, '^"+|"+$', "")))


# -- markup

INLINE_STYLES = (("em", "*"), ("strong", "**"), ("strike", "~~"), ("code", "`"))


def inline_style(html: Column) -> Column:
    """em, strong, strike and code elements as Markdown."""
    for tag, mark in INLINE_STYLES:
        html = F.regexp_replace(html, f"<{tag}>(.*?)</{tag}>", f"{mark}$1{mark}")
    return html


def page_name(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit("_"))


def is_url(text: Column) -> Column:
    return F.startswith(text, F.lit("http://")) | F.startswith(text, F.lit("https://"))


#: By the name space of a wiki link the site that its page is on, what stands before the page's name there,
#: and whether the link is that name as a whole. A whole link to the commons with a second name space loses the first.
PLACES = {
    "c": ("commons", "", False),
    "commons": ("commons", "", True),
    "file": ("commons", "File:", False),
    "image": ("commons", "File:", False),
    "media": ("commons", "File:", False),
    "timedtext": ("commons", "File:", False),
    "category": ("base", "Category:", False),
}


def link_target(link: Column, base: str, commons: str) -> Column:
    """The address of a wiki link: commons, media and category names have places of their own (``c`` in lower case only)."""
    space, rest = F.substring_index(link, ":", 1), F.substring(link, F.instr(link, ":") + 1, F.length(link))
    out = F.when(~link.contains(":"), F.concat(F.lit(base), page_name(link)))
    for name, (root, before, whole) in PLACES.items():
        own = space if name == "c" else F.lower(space)
        page = F.when(rest.contains(":"), rest).otherwise(link) if whole else rest
        out = out.when(own == name, F.concat(F.lit({"base": base, "commons": commons}[root] + before), page_name(page)))
    return out.otherwise(F.concat(F.lit(base), page_name(link)))


def image_path(name: Column, root: str) -> Column:
    """Hashed place of a media file: first digit and first two digits of the MD5 of its name; addresses stay."""
    file = page_name(name)
    digest = F.md5(file)
    return F.when(is_url(name), name).otherwise(F.concat(F.lit(root), F.substring(digest, 1, 1), F.lit("/"), F.substring(digest, 1, 2), F.lit("/"), file))


def anchors_to_markdown(html: Column) -> Column:
    """Plain anchors (an address, no title or class) as Markdown links."""
    return F.regexp_replace(html, r"<a[^>]*href=[\"']([^\"']+)[\"'][^>]*>(.+?)</a>", r'[$2]($1 "$2")')


def og_images(html: Column) -> Column:
    """(url, width, height) of every og:image that has a size before the next image, in order."""
    cut = F.split(html, r"<meta property=\"og:image\" content=")
    blocks = F.slice(cut, F.lit(2), F.size(cut))

    def one(b: Column) -> Column:
        size = lambda k: F.expr("null") if k is None else F.try_to_number(F.regexp_extract(b, rf"og:image:{k}\" content=\"(\d+)", 1), F.lit("999999999")).cast("long")
        return F.struct(F.regexp_extract(b, r"^[\"']([^\"']*)", 1).alias("url"), size("width").alias("width"), size("height").alias("height"))

    return F.filter(F.transform(blocks, one), lambda x: x["width"].isNotNull() & x["height"].isNotNull())


def largest_image(html: Column) -> Column:
    """The og:image with the largest area, its own width and height with it; the larger address at a tie."""
    return F.array_max(F.transform(og_images(html), lambda x: F.struct((x["width"] * x["height"]).alias("area"), x["url"].alias("url"), x["width"].alias("width"), x["height"].alias("height"))))


# -- subtitles


def subtitle_time(stamp: Column) -> Column:
    """MM:SS,mmm as HH:MM:SS,mmm; a dot or a second colon before the milliseconds is mended, missing digits filled.
    Null where it can't be read."""
    comma = F.replace(stamp, F.lit("."), F.lit(","))
    fixed = F.regexp_replace(comma, r"^([^:]*:[^:]*):([^:]*)$", "$1,$2")
    part = lambda i: F.regexp_extract(fixed, r"^\s*(\d+):(\d+),(\d+)\s*$", i)
    ok = fixed.rlike(r"^\s*\d+:\d+,\d+\s*$")
    pad = lambda x: F.when(F.length(x) < 2, F.lpad(x, 2, "0")).otherwise(x)
    ms = F.when(F.length(part(3)) < 3, F.rpad(part(3), 3, "0")).otherwise(part(3))
    return F.when(ok, F.concat(F.lit("00:"), pad(part(1)), F.lit(":"), pad(part(2)), F.lit(","), ms))


def subtitle_millis(stamp: Column) -> Column:
    """Milliseconds of HH:MM:SS,mmm."""
    p = lambda i: F.regexp_extract(stamp, r"^(\d+):(\d+):(\d+),(\d+)$", i).cast("long")
    return F.when(stamp.isNotNull(), ((p(1) * 60 + p(2)) * 60 + p(3)) * 1000 + p(4))


def millis_stamp(ms: Column) -> Column:
    """HH:MM:SS,mmm of milliseconds."""
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)
