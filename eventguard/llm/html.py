"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one per block of the page, in page order. Lines of menus,
notices, adverts, forms, comments and the like weigh nothing, and so do lines made of links
outside of a marked article or main part. Weights, the lengths of the lines, are summed over
sliding windows of lines. Where the sum surges above a threshold a stretch of main text
begins, where it dives to nothing the stretch ends, and the lines between are kept. Lines of
a marked part weigh a number of times their length; they and the lines around them are summed
apart, so either is kept where it surges by itself.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventguard.llm.common import beside, fresh

# Element names of the markup language and words that pages use in classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|iframe|template|textarea|title|svg|select|xmp|noembed|noframes"
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE = frozenset("nav footer aside form button label dialog menu head fieldset object".split())
CLOSES_P = BLOCK - {"option"}
SAME = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th",
        "option": "option"}
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " cookie cookies consent gdpr notice notices notification alert toast popup modal overlay"
    " paywall sidebar aside rail comment comments commentlist disqus reply replies respond discussion"
    " menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar topbar masthead"
    " header footer copyright legal disclaimer share sharing social related recommended more"
    " newsletter subscribe subscription signup login search skip widget tags".split()
)
CONTENT = frozenset("article entry post content story main body text page".split())
NEGATED = frozenset("has with no without show hide open is".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar"
    " toolbar form".split()
)

# Groups do not give back what they took, so a token costs no more than its length: an element
# ends at its ">" outside of quotes or, if its quotes do not close, at the next one.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    rf"|<(?P<raw>{RAW})\b(?:(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^<>]*+)>.*?(?:</(?P=raw)\b[^<>]*+>?|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/<>]*+)(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^<>]*+)>",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.S)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass(frozen=True)
class HtmlConfig:
    # Lines summed in a window, and the characters that make a surge.
    window: int = 3
    surge: int = 86
    # Share of link text from which a line counts as links.
    links: float = 0.6
    # How many times its length a line of a marked part weighs.
    marked: int = 6
    # Shortest line that may open a stretch, unless it is a heading.
    opening: int = 25


@dataclass
class _Line:
    parts: list[str]
    boiler: bool
    main: bool
    heading: bool
    linked: int = 0
    text: str = ""


def _is_aside(name: str, attrs: str, inside_main: bool) -> bool:
    if name in ASIDE or (name == "header" and not inside_main):
        return True
    if not attrs or name in ("html", "body", "main"):
        return False
    values = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
    if values.get("role", "").lower() in ROLES or "hidden" in values:
        return True
    if values.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", values.get("style", ""), re.I):
        return True
    for one in f"{values.get('class', '')} {values.get('id', '')}".split():
        parts = [p.lower() for p in _NAME_PARTS.findall(one)]
        if not parts or parts[0] in NEGATED:
            continue
        found = HINTS.intersection(parts)
        if name == "article":
            found &= {"comment", "comments", "reply", "ad", "ads", "advert", "sponsored", "promo"}
            if len(parts) > 1:
                continue
        if found and not (found <= {"header", "banner", "body", "tags", "more"} and CONTENT.intersection(parts)):
            return True
    return False


def _is_main(name: str, attrs: str) -> bool:
    return name in ("article", "main") or bool(
        attrs and re.search(r"(role\s*=\s*[\"']?main\b|itemprop\s*=\s*[\"']?articleBody\b)", attrs, re.I)
    )


class _Open:
    """The open elements, with their places by name, so that none has to be searched."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool]] = []  # element, in boilerplate, in the main part
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.headings = self.links = 0

    def top(self, *names: str) -> int:
        """The innermost place of any of these elements, or -1."""
        return max((self.places[n][-1] for n in names if self.places[n]), default=-1)

    def push(self, name: str, boiler: bool, main: bool) -> None:
        self.places[name].append(len(self.stack))
        if name in BLOCK:
            self.blocks.append(len(self.stack))
        self.headings += name in HEADINGS
        self.links += name == "a"
        self.stack.append((name, boiler, main))

    def close_to(self, place: int) -> bool:
        """Closes elements down to a place; whether a block was among them."""
        block = bool(self.blocks) and self.blocks[-1] >= place
        while len(self.stack) > place:
            name, _, _ = self.stack.pop()
            self.places[name].pop()
            if name in BLOCK:
                self.blocks.pop()
            self.headings -= name in HEADINGS
            self.links -= name == "a"
        return block


def page_lines(html: str) -> list[_Line]:
    """The page's blocks of text, white space normalised, character references decoded."""
    opened, lines, at = _Open(), [], 0
    current: _Line | None = None

    def add(raw: str) -> None:
        nonlocal current
        if current is None:
            if not raw.strip():
                return
            boiler, main = opened.stack[-1][1:] if opened.stack else (False, False)
            current = _Line([], boiler, main, opened.headings > 0)
            lines.append(current)
        current.parts.append(raw)
        if opened.links:
            current.linked += len(raw.strip())

    for token in _TOKEN.finditer(html):
        if token.start() > at:
            add(html[at:token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if token["end"]:
            place = opened.top(name)
            if (opened.close_to(place) if place >= 0 else name in BLOCK):
                current = None
            continue
        if name in CLOSES_P:
            # A new block ends an open paragraph, and an item ends the one before it.
            place = opened.top("p", *SAME.get(name, "").split())
            if place >= 0 and place >= (opened.blocks[-1] if opened.blocks else -1):
                opened.close_to(place)
            current = None
        elif name in SAME:
            place = opened.top(*SAME[name].split())
            if place > opened.top("tr", "table") and opened.close_to(place):
                current = None
        if name in ("br", "td", "th", "img", "wbr") and current is not None:
            current.parts.append(" " if name != "wbr" else "")
        if name in VOID or token["attrs"].endswith("/"):
            continue
        outer, main = opened.stack[-1][1:] if opened.stack else (False, False)
        boiler = outer or _is_aside(name, token["attrs"], main)
        opened.push(name, boiler, main or (not boiler and _is_main(name, token["attrs"])))
        if boiler != outer:
            current = None
    if at < len(html):
        add(html[at:])
    for line in lines:
        line.text = " ".join(unescape("".join(line.parts)).split())
    return [line for line in lines if line.text]


def kept_lines(lines: list[_Line], cfg: HtmlConfig) -> list[str]:
    """The lines between surges and dives."""

    def weight(line: _Line) -> int:
        if line.boiler or (not line.main and line.linked > cfg.links * len(line.text)):
            return 0
        return len(line.text) * (cfg.marked if line.main else 1)

    # Of the lines outside of marked parts and of those inside.
    weights = [[weight(line) * (line.main == main) for line in lines] for main in (False, True)]
    sums = [[sum(own[i:i + cfg.window]) for i in range(len(lines))] for own in weights]
    # The best that a short page has is its main text.
    surge = min(cfg.surge, max(map(max, sums))) if lines else 0
    kept, inside = [], [False, False]
    for i, line in enumerate(lines):
        for main in (False, True):
            own, total = weights[main][i], sums[main][i]
            if not inside[main] and own and total >= surge:
                inside[main] = line.heading or own >= min(cfg.opening, surge)
            if inside[main] and own:
                kept.append(line.text)
            if not own and not total:
                inside[main] = False
    return kept


def main_text(html: str, cfg: HtmlConfig = HtmlConfig()) -> str:
    return "\n\n".join(kept_lines(page_lines(html), cfg)) if html else ""


def extract_text(
    df: DataFrame, keep: list[str], html: str = "html",
    names: tuple[str, str] = ("text", "n_chars"), cfg: HtmlConfig = HtmlConfig(),
) -> DataFrame:
    """The `keep` columns of each row with its page's main text and its length in characters.

    A null or empty page has an empty text. Markup may be broken or cut off anywhere. Rows
    that are repeated are kept each; a kept column that is called like a result gives way to it.
    """
    keep = beside(keep, *names)
    (raw,) = fresh(df.select(*keep), "raw")
    rows = df.select(*keep, F.col(html).alias(raw))
    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in keep]

    def extract(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(page.as_py() or "", cfg) for page in part.column(raw)]
            yield pa.RecordBatch.from_arrays([
                *[part.column(n) for n in keep], pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ], names=[*keep, *names])

    return rows.mapInArrow(extract, ", ".join([*fields, f"`{names[0]}` string", f"`{names[1]}` long"]))
