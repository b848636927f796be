"""Main text of web pages by the distribution of line blocks.

Markup is stripped to lines, one for each block of the page that holds text, or that
is empty. A line weighs its characters outside links; what stands in menus, forms,
adverts and the like is left out and makes no line, and where a page marks its
article, what stands outside weighs nothing. Sums over ``WINDOW`` consecutive lines
show where the text is: they surge where it begins and dive to nothing where it ends.
All stretches between a surge and a dive are the text, in the order of the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from blockloom.llm.shared import in_batches

#: Lines whose lengths are added up.
WINDOW = 3
#: Such a sum begins a text on pages that don't mark their article.
SURGE = 40

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is not text of the article.
LEFT_OUT = frozenset(
    "aside button canvas datalist dialog footer form head header iframe input label menu nav noscript "
    "object script select style svg template textarea title".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title template noscript iframe".split())
#: Words of a class, id or role that say the same.
NAMED_OUT = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent notice notices alert popup modal overlay newsletter subscribe "
    "subscription comment comments disqus respond replies sidebar complementary nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs pagination pager header masthead footer "
    "contentinfo share sharing social related recommended widget toolbar login signup search "
    "legal copyright disclaimer".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Za-z0-9]+")


def _out_by_name(rest: str) -> bool:
    for groups in _NAMES.findall(rest):
        if not NAMED_OUT.isdisjoint(p.lower() for p in _PART.findall("".join(groups))):
            return True
    return False


class _Page:
    """Reads markup into lines."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, bool]] = []  # text, weight, inside an article
        self.parts: list[str] = []
        self.linked = 0
        self.link = self.article = 0
        self.bare = False  # a block has begun, and nothing in it
        self.open: list[str] = []  # blocks that are open outside what is left out
        self.out: list[str] = []  # what is left out, and the same elements inside it

    def text(self, raw: str) -> None:
        if self.out:
            return
        self.parts.append(raw)
        if self.link:
            self.linked += len("".join(raw.split()))

    def flush(self, ends: bool = False) -> None:
        """Ends a line; one without text counts if it is a block of its own."""
        text = " ".join(html.unescape("".join(self.parts)).split())
        weight = 0
        if text:
            weight = max(0, len("".join(text.split())) - self.linked)
        if text or ends and self.bare:
            self.lines.append((text, weight, self.article > 0))
        self.parts, self.linked, self.bare = [], 0, False

    def start(self, name: str, rest: str) -> None:
        closed = name in VOID or rest.endswith("/") and name not in BLOCKS
        if self.out:
            if name in ("article", "main") and not _out_by_name(rest):
                self.out = []  # never closed
            else:
                if not closed:
                    self.out.append(name)
                return
        named = name not in ("html", "body", "main") and _out_by_name(rest)
        if name in BLOCKS:
            self.flush()
        elif name == "br":
            self.parts.append(" ")
        if name in LEFT_OUT or named:
            if not closed:
                self.flush()
                self.out = [name]
            return
        if name in ("article", "main"):
            self.article += 1
        if name == "a":
            self.link = 1
        if name in BLOCKS and not closed:
            self.open.append(name)
            self.bare = True

    def end(self, name: str) -> None:
        if self.out:
            if name in self.out:
                while self.out.pop() != name:
                    pass
                return
            if name not in self.open:
                return
            self.out = []  # the element around it ends: it was never closed
        if name == "a":
            self.link = 0
        if name in BLOCKS:
            self.flush(ends=True)
            if name in self.open:
                while self.open.pop() != name:
                    pass
        if name in ("article", "main"):
            self.article = max(0, self.article - 1)


def lines(page: str) -> list[tuple[str, int, bool]]:
    """The lines of a page in its order: text, weight, whether an article holds it."""
    reader, at = _Page(), 0
    while True:
        token = _TOKEN.search(page, at)
        reader.text(page[at : token.start() if token else len(page)])
        if token is None:
            break
        at = token.end()
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue
        if token["end"] or token["end2"]:
            reader.end(name)
            continue
        reader.start(name, token["rest"] or token["rest2"] or "")
        if name in RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            if stop:
                at = stop.start()
            elif name in ("script", "style"):
                break  # runs to the end of the page
    reader.flush()
    return reader.lines


def stretches(weights: list[int], surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Stretches [start, stop) of lines from a surge of the window sums to their dive."""
    n = len(weights)
    sums = [sum(weights[k : k + window]) for k in range(n)]
    found, k = [], 0
    while k < n:
        if sums[k] < max(1, surge):
            k += 1
            continue
        start = k
        while start < n and not weights[start]:
            start += 1
        stop, least = start, found[-1][1] if found else 0
        # short lines before the surge, as after it, until a dive
        while before := [j for j in range(max(least, start - window), start) if weights[j]]:
            start = before[0]
        while stop < n and sums[stop]:
            stop += 1
        last = max(j for j in range(start, stop) if weights[j])
        found.append((start, last + 1))
        k = stop
    return found


def main_text(page: str) -> str:
    """The text of the page's article: its blocks, two line breaks between them."""
    found = lines(page)
    marked = any(inside and text for text, _, inside in found)
    if marked:
        weights = [len(text) if inside else 0 for text, _, inside in found]
        chosen = stretches(weights, 1)
    else:
        weights = [weight for _, weight, _ in found]
        chosen = stretches(weights, SURGE) or stretches(weights, 1)
    kept = [
        text for start, stop in chosen for text, _, inside in found[start:stop] if text and (inside or not marked)
    ]
    return "\n\n".join(kept)


def extract(pages: DataFrame, carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per row of ``pages``: page_id, the ``carry`` columns and text.

    A NULL html is an empty one; a page without text gives an empty text. Repeated
    rows are all returned. A carried column named text gives way to the result; other
    columns are dropped.
    """
    carry = ["page_id", *(c for c in carry if c not in ("page_id", "text", "html"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [main_text(page.as_py() or "") for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, carry), pa.array(made, pa.string())], [*carry, "text"]
            )

    schema = T.StructType([pages.schema[c] for c in carry]).add("text", T.StringType())
    return pages.select(*carry, "html").transform(in_batches(run, schema))
