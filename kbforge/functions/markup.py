"""Wiki and HTML markup that needs more than a replacement: elements with fallbacks, nested brackets, spans of sentences.

A page is read once by the standard HTML parser. Everything is put out as it came (end tags in lower case), but for anchors and pictures that
can be written as Markdown; what stands in an open anchor is gathered until it ends, and an anchor that never ends
stays as it was. Places of names come from the table in ``texts``. These functions run as Arrow-batched UDFs; the
simple forms are expressions in ``texts``. Null text stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from kbforge.functions.texts import INLINE_STYLES, PLACES

BASE, COMMONS, FILES = "https://wiki.example/wiki/", "https://commons.example/wiki/", "https://files.example/"
STYLE = dict(INLINE_STYLES)
#: What ends a sentence in a token stream.
ENDS = (".", "!", "?", "。", "！", "？")


def is_url(text: str) -> bool:
    return text.partition("://")[0] in ("http", "https") and "://" in text


def page_address(link: str) -> str:
    """Where a wiki link leads; the same table as ``texts.link_target``."""
    space, _, rest = link.partition(":") if ":" in link else ("", "", "")
    root, before, whole = PLACES.get(space) or PLACES.get(space.lower(), ("base", "", True))
    name = link if whole and ":" not in (rest if root == "commons" else "") else rest
    return {"base": BASE, "commons": COMMONS}[root] + before + name.replace(" ", "_")


def picture_address(source: str) -> tuple[str, str]:
    """(file, page) of a picture by its name; an address is both."""
    if is_url(source):
        return source, source
    name = source.replace(" ", "_")
    digest = hashlib.md5(name.encode()).hexdigest()
    return "/".join((FILES.rstrip("/"), digest[:1], digest[:2], name)), COMMONS + PLACES["file"][1] + name


class Elements(HTMLParser):
    """Puts a page out again with its anchors and pictures as Markdown."""

    def __init__(self, anchors: bool = True, pictures: bool = True):
        super().__init__(convert_charrefs=False)
        self.anchors, self.pictures = anchors, pictures
        self.out: list[str] = []
        self.open: list[tuple[int, dict]] = []  # where each open anchor begins in ``out``, and its attributes

    def handle_starttag(self, tag, attrs):
        given, raw = {k: v for k, v in attrs if v}, self.get_starttag_text()
        if tag == "a" and self.anchors:
            self.open.append((len(self.out), given))
            self.out.append(raw)
        elif tag == "img" and self.pictures and "src" in given:
            (file, page), text = picture_address(given["src"]), next(given[k] for k in ("title", "alt", "src") if k in given)
            self.out.append(f'[![{text}]({file})]({page} "{text}")')
        else:
            self.out.append(STYLE[tag] if self.open and tag in STYLE else raw)

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        raw = f"</{tag}>"
        if tag != "a" or not self.open:
            self.out.append(STYLE[tag] if self.open and tag in STYLE else raw)
            return
        at, given = self.open.pop()
        inside, href = "".join(self.out[at + 1 :]), given.get("href")
        if href is None or not inside:
            self.out.append(raw)
            return
        target = page_address(href) if given.get("class") == "wikilink" and not is_url(href) else href
        self.out[at:] = [f'[{inside}]({target} "{inside}")']

    def handle_data(self, data):
        self.out.append(data)

    def handle_entityref(self, name):
        self.out.append(f"&{name};")

    def handle_charref(self, name):
        self.out.append(f"&#{name};")

    def handle_comment(self, data):
        self.out.append(f"<!--{data}-->")

    def handle_decl(self, decl):
        self.out.append(f"<!{decl}>")

    def handle_pi(self, data):
        self.out.append(f"<?{data}>")

    def unknown_decl(self, data):
        self.out.append(f"<![{data}]>")


def _elements(html: str, **which: bool) -> str:
    if "<" not in html:
        return html
    reader = Elements(**which)
    reader.feed(html)
    reader.close()
    return "".join(reader.out)


def links(html: str) -> str:
    """Anchors with an address as Markdown."""
    return _elements(html, pictures=False)


def pictures(html: str) -> str:
    """img elements as linked Markdown pictures, named by title, alternative text or source; one without a source stays."""
    return _elements(html, anchors=False)


def closing(text: str, at: int, pair: str) -> int:
    """The place of the bracket that closes the one at ``at``; -1 if none does."""
    depth = 0
    for i in range(at, len(text)):
        depth += (text[i] == pair[0]) - (text[i] == pair[1])
        if depth == 0:
            return i
    return -1


def markdown_pictures(text: str) -> str:
    """Markdown pictures with their file's address; a picture that has an address already becomes that address."""
    out, at = [], 0
    while (start := text.find("![", at)) >= 0:
        middle = closing(text, start + 1, "[]")
        end = closing(text, middle + 1, "()") if middle > 0 and text[middle + 1 : middle + 2] == "(" else -1
        if end < 0:
            out.append(text[at : start + 2])
            at = start + 2
            continue
        path, blank, title = text[middle + 2 : end].partition(" ")
        out.append(text[at:start])
        out.append(path if is_url(path) else f"{text[start : middle + 2]}{picture_address(path)[0]}{blank}{title})")
        at = end + 1
    return "".join(out) + text[at:]


def post_process(text: str) -> str:
    """All three, each on its own: a step that fails leaves the text as it was."""
    for step in (links, pictures, markdown_pictures):
        try:
            text = step(text)
        except Exception:
            continue
    return text


def as_udf(step: Callable[[str], str]):
    """A function of texts as a column function, in Arrow batches."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else step(x))

    return run


def clean_page(text: Column) -> Column:
    return as_udf(post_process)(text)


def sentence_spans(offsets: list[tuple[int, int]], tokens: list[str], text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """(sentences, token spans) from a token stream: an end mark closes a sentence where a gap follows it or nothing
    does. Special tokens have the offset (0, 0); the first token of the stream is one. What follows the last mark is
    no sentence of its own."""
    ends, last = [], max((i for i, (a, b) in enumerate(offsets) if b > a), default=-1)
    for i, (a, b) in enumerate(offsets):
        if b > a and tokens[i] in ENDS and (i == last or offsets[i + 1][0] > b):
            ends.append((i, b))
    begin = [(1, 0), *ends[:-1]]
    return [text[p[1] : q[1]] for p, q in zip(begin, ends)], [(p[0], q[0]) for p, q in zip(begin, ends)]
