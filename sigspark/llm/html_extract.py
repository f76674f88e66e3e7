"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block of the page; menus, notices,
forms and other parts that are no article go with the markup. Text lengths are
summed over sliding windows of lines: the text begins where the sum surges over
a threshold and ends where it dives to nothing, and everything between is kept.
Link text does not count, and a surge needs as much text as a short paragraph.
The article or main elements of a page are a hint only: if they hold at least
half of the page's text, any text in them is a surge, and windows do not reach
over their edges. They never remove a line, so text outside them is kept or
dropped by its own sums, and elements that hold less are lines like any other.
"""

from __future__ import annotations

import html
import re
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3  # lines
SURGE = 60  # characters of text outside links, in a window
SHARE = 0.3  # of the page's highest sum, for text outside the elements that hold its article

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot
    th thead tr ul br""".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that are never article text.
_OTHER = set("""head nav footer aside form button select option menu dialog svg math canvas object applet audio video map search
    datalist fieldset input""".split())
_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist".split())
# Words of class and id names.
_NAMES = set("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner nav navbar navigation
    menu menus submenu breadcrumb breadcrumbs sidebar sidebars rail widget widgets footer foot masthead topbar header cookie cookies consent gdpr
    notice notices notification popup modal overlay lightbox newsletter subscribe subscription signup signin login register paywall share sharing
    social related recommended recommendations pagination pager toolbar copyright disclaimer skip hidden outbrain taboola""".split())
_COMMENTS = set("comment comments commentlist disqus respond reply replies discussion".split())
_NOT = set("no not has have with without is non main article content body page wrapper container layout".split())
# A start tag of the first kind ends an open element of the second, up to a container of the third.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select", "datalist"})}
_CONTAINERS = {"article", "main", "body", "section", "div", "td", "th", "aside", "figure"}
_SCOPE = {"article", "main", "body", "section", "div", "td", "th", "li", "table", "blockquote", "aside", "nav", "footer", "header", "form", "button", "figure"}


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(text)}


def _kind(name: str, attrs: str, inside: bool) -> str:
    """'' for possible text; 'other' for what is never article text; 'named' if
    only its class or id says so; 'comments' for reader comments."""
    if name in _OTHER or (name == "header" and not inside):
        return "other"
    if not attrs.strip(" /"):
        return "header" if name == "header" else ""
    a = _attributes(attrs)
    words = [{w.lower() for w in _WORDS.findall(part)} for part in f"{a.get('class', '')} {a.get('id', '')}".split()]
    if any(w & _COMMENTS and not w & (_NOT - {"content", "body", "container", "wrapper"}) for w in words):
        return "comments"
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return "other"
    if name in ("html", "body", "main", "article"):
        return ""
    names = _NAMES - {"header"} if inside else _NAMES
    if a.get("role", "").lower() in _ROLES or any(w & names and not w & _NOT for w in words):
        return "other" if name in ("p", "span", "a") else "named"
    return "header" if name == "header" else ""


class _Page:
    """Lines of a page: text, length of the text outside links, whether an
    article (2), a main (1) element or both (3) hold it, and the number of the
    innermost container around it."""

    def __init__(self, source: str):
        self.lines: list[tuple[str, int, int, int]] = []
        self._parts: list[str] = []
        self._plain = 0
        self._stack: list[list] = []  # [name, kind, number]
        self._place = self._box = self._opened = 0
        at, low = 0, None
        while m := _TAG.search(source, at):
            self._text(source[at:m.start()])
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:])
                continue
            if m["end"] or m["end2"]:
                self._close(name)
                continue
            if name in _RAW:
                if low is None:
                    low = source.lower()
                    if len(low) != len(source):  # lower-casing changed some length
                        low = re.sub("[A-Z]", lambda x: x[0].lower(), source)
                end = low.find(f"</{name}", at)
                at = len(source) if end < 0 else end
                continue
            self._open(name, m["attrs"] or m["attrs2"] or "")
        self._text(source[at:])
        self._line()

    def _line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.lines.append((text, self._plain, self._place, self._box))
        self._parts, self._plain = [], 0
        self._locate()

    def _locate(self) -> None:
        names = {s[0] for s in self._stack}
        self._place = 2 * ("article" in names) + ("main" in names)
        self._box = next((s[2] for s in reversed(self._stack) if s[0] in _CONTAINERS), 0)

    def _text(self, text: str) -> None:
        if not text or any(s[1] in ("other", "named", "comments") for s in self._stack):
            return
        names = [s[0] for s in self._stack]
        if any(s[1] == "header" for s in self._stack) and not _HEADINGS & set(names):
            return  # of an article's own header only the headings
        text = html.unescape(text)
        self._parts.append(text)
        if "a" not in names:
            self._plain += len(" ".join(text.split()))

    def _pop(self, i: int) -> None:
        del self._stack[i:]

    def _open(self, name: str, attrs: str) -> None:
        if name in _BLOCK:
            self._line()
            closes, within = _CLOSES.get(name, ((), ()))
            for i in range(len(self._stack) - 1, -1, -1):
                top = self._stack[i][0]
                if top in within:
                    break
                if top in closes:
                    self._pop(i)
                    break
            if name != "br":
                for i in range(len(self._stack) - 1, -1, -1):
                    top = self._stack[i][0]
                    if top == "p":
                        self._pop(i)
                        break
                    if top in _SCOPE:
                        break
        if name in _VOID or attrs.endswith("/") and name not in _BLOCK and name != "a":
            return
        inside = any(s[0] in ("article", "main") for s in self._stack)
        kind = _kind(name, attrs, inside)
        if name in ("article", "main") and not kind:
            for s in self._stack:  # what holds the article is no side part, whatever its name
                if s[1] == "named":
                    s[1] = ""
        self._opened += 1
        self._stack.append([name, kind, self._opened])
        if name in _BLOCK:
            self._locate()

    def _close(self, name: str) -> None:
        if name in _BLOCK:
            self._line()
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] == name:
                self._pop(i)
                break
            if self._stack[i][0] in ("article", "main", "nav", "aside", "footer", "table") and name not in ("article", "main", "body", "html", "nav", "aside", "footer", "table"):
                break  # a stray end tag does not close what holds the element
        if name in _BLOCK:
            self._locate()


def keep_between(lengths: list[int], threshold: int, window: int = WINDOW) -> list[bool]:
    """Which lines lie between a surge (the window that begins at a line sums to
    the threshold) and the next dive (it sums to nothing)."""
    sums, total = [0] * len(lengths), 0
    for i in range(len(lengths) - 1, -1, -1):
        total += lengths[i] - (lengths[i + window] if i + window < len(lengths) else 0)
        sums[i] = total
    keep, on = [], False
    for i, s in enumerate(sums):
        on = s > 0 if on else s >= max(1, threshold)
        keep.append(on)
    return keep


def trim(keep: list[bool], lengths: list[int], boxes: list[int]) -> list[bool]:
    """``keep`` without the lines before a run's first text that stand in another
    container: the window that surges reaches that text from them."""
    out = list(keep)
    for i, k in enumerate(keep):
        if k and not (i and keep[i - 1]):
            first = next((j for j in range(i, len(keep)) if lengths[j]), i)
            out[i:first] = [boxes[j] == boxes[first] for j in range(i, first)]
    return out


def bridge(keep: list[bool], boxes: list[int]) -> list[bool]:
    """``keep`` with the gaps between kept lines whose lines, and the kept ones
    on both sides, stand in one container."""
    out, last, same = list(keep), None, False  # the kept line before, and whether its container holds all lines since
    for i, k in enumerate(keep):
        same = same and boxes[i] == boxes[last]
        if k:
            if same and last is not None:
                out[last + 1:i] = [True] * (i - last - 1)
            last, same = i, True
    return out


def _hinted(lines: list[tuple[str, int, int, int]]) -> list[bool]:
    """Which lines the page's article elements hold, or else its main elements,
    if these have at least half of the page's text outside links."""
    total = sum(line[1] for line in lines)
    for bit in (2, 1):
        held = [bool(line[2] & bit) for line in lines]
        if any(held) and 2 * sum(line[1] for line, h in zip(lines, held) if h) >= total:
            return held
    return [False] * len(lines)


def main_text(source: str | None) -> str:
    """The main text of one page (null or empty: none)."""
    if not source:
        return ""
    lines = _Page(source).lines
    held = _hinted(lines)
    lengths = [len(text) if h else plain for (text, plain, _, _), h in zip(lines, held)]
    highest = max((sum(lengths[i:i + WINDOW]) for i in range(len(lengths))), default=0)
    threshold = max(SURGE, int(SHARE * highest)) if any(held) else min(SURGE, highest)
    keep: list[bool] = []
    for hint, run in groupby(zip(held, lengths), lambda x: x[0]):
        keep += keep_between([n for _, n in run], 1 if hint else threshold)
    boxes = [line[3] for line in lines]
    return " ".join(line[0] for line, k in zip(lines, bridge(trim(keep, lengths, boxes), boxes)) if k)


def extract(df: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``df`` with the main text of each page.

    A null or empty page, and one without text, gives the empty string. Tags
    that are never closed end with their container, broken references stay as
    they are. Rows, repeats and other columns stay; ``out_col`` must be free."""
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return df.withColumn(out_col, run(F.coalesce(F.col(html_col), F.lit(""))))
