"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one per block of the page. The length of text that is no link is summed over a sliding window of lines;
text between the point where the sum surges and the point where it dives to nothing is kept.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from shopgauge.llm.common import append

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|\]\]>"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|object|select|title|xmp|noembed|noframes)\b(?P<rest>[^>]*+)(?:>.*?(?:</(?P=raw)\s*+>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*?)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
# Fixed values of HTML.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time "
    "tt u var wbr ruby rb rt rp picture source nobr svg math".split()
)
#: Elements that end an svg or math that is still open.
_BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var".split()
)
#: Elements of svg and math that hold HTML.
_HOLDS_HTML = ("foreignobject", "desc", "annotation-xml", "mtext", "mi", "mo", "mn", "ms")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PLAIN = frozenset("p li dt dd option tr td th".split())
#: Elements that never hold the article.
_OUTSIDE = frozenset("head nav footer aside form button menu dialog fieldset svg".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
#: Words in class or id names of parts that are not the article.
_BAD = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription paywall signup login sidebar side menu nav navigation navbar breadcrumb "
    "breadcrumbs topbar toolbar masthead header footer foot comment comments commentlist disqus reply replies respond discussion reader readers feedback "
    "related recommended recommendations trending popular share sharing social follow widget pagination pager tags skip search copyright legal disclaimer "
    "dropdown hidden print byline".split()
)
_GOOD = frozenset("content article post entry story main body text page".split())
#: Bad words that count even beside a good one.
_STRONG = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo comment comments commentlist reply replies disqus respond related recommended "
    "share sharing social newsletter cookie cookies sidebar nav navigation menu footer tags".split()
)
#: Words that name the box and not what is in it.
_BOX = frozenset("area bar block box button buttons container form group icons inner link links list module outer panel post posts section stories unit widget wrap wrapper".split())
#: Inside an article a name has to say nothing but such things, and one of these words: "related-posts" goes, "related-work" stays.
_SURE = _STRONG - {"respond"} | frozenset("consent gdpr popup modal paywall subscription subscribe signup advertising promotion banner".split())
_ANSWER = frozenset("has with no".split())


def _is_outside(name: str, attributes: str, inside: bool, forms: bool) -> bool:
    if name in _OUTSIDE and not (forms and name in ("form", "fieldset")) or name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        if m[5]:
            return True
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role" and value.lower() in _ROLES:
            return True
        if key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key in ("class", "id"):
            for part in value.split():
                words = [w.lower() for w in _TOKEN.findall(part)]
                bad = {w for k, w in enumerate(words) if w in _BAD and not (k and words[k - 1] in _ANSWER)}
                if inside:
                    if bad & _SURE and all(w in _BAD or w in _BOX for w in words):
                        return True
                elif bad and (bad & _STRONG or not _GOOD.intersection(words)):
                    return True
    return False


def lines(page: str, forms: bool = False) -> list[tuple[str, int, bool]]:
    """(text, length of text that is no link, inside an article or main element) for every block of the page outside menus and the like.

    With `forms` the text of forms counts as that of the page.
    """
    out: list[tuple[str, int, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, outside, article, link
    opened: dict[str, int] = {}
    outside = article = links = 0
    text: list[str] = []
    plain = 0

    def flush() -> None:
        nonlocal plain
        if text:
            whole = "".join(text)
            if "&" in whole:
                whole = html.unescape(whole)
            whole = " ".join(whole.split())
            if whole:
                out.append((whole, min(plain, len(whole)), article > 0))
            text.clear()
            plain = 0

    def close() -> None:
        nonlocal outside, article, links
        name, bad, good, link = stack.pop()
        opened[name] -= 1
        outside -= bad
        article -= good
        links -= link

    def inner(name: str) -> bool:
        """Whether the innermost open element of that name, if any, lies in the innermost svg or math."""
        if not opened.get(name):
            return True
        for known, *_ in reversed(stack):
            if known == name:
                return True
            if known in ("svg", "math"):
                return False
        return False

    at = 0
    while m := _TAG.search(page, at):
        if m.start() > at and not outside:
            piece = page[at : m.start()]
            text.append(piece)
            if not links:
                plain += len(piece.strip())
        at = m.end()
        drawn = opened.get("svg") or opened.get("math")
        name = m["name"]
        if not name:
            if drawn and m["raw"] and m["rest"].endswith("/"):
                # Empty in svg and math, so what follows is not its content.
                at = m.end("rest") + 1
            continue
        name = name.lower()
        if drawn and not m["end"] and name in _BREAKOUT and not any(opened.get(x) for x in _HOLDS_HTML):
            while opened.get("svg") or opened.get("math"):
                close()
            drawn = 0
        block = name not in _INLINE and not (drawn and (not m["end"] or inner(name)))
        if block:
            flush()
        if m["end"]:
            if opened.get(name):
                while stack[-1][0] != name:
                    close()
                close()
            continue
        if block and opened.get("p"):
            # A block ends an open paragraph, if only inline elements lie between.
            k = len(stack) - 1
            while k >= 0 and stack[k][0] in _INLINE:
                k -= 1
            if k >= 0 and stack[k][0] == "p":
                while len(stack) > k:
                    close()
        if name in _PLAIN and stack and stack[-1][0] == name:
            close()
        if name in _VOID or (drawn or name in ("svg", "math")) and m["attributes"].endswith("/"):
            continue
        bad = _is_outside(name, m["attributes"], article > 0, forms)
        good = not bad and (name in ("article", "main") or 'role="main"' in m["attributes"])
        # An <a> that only names a place is no link.
        keys = {k[1].lower() for k in _ATTRIBUTE.finditer(m["attributes"]) if k[1]} if name == "a" else ()
        link = name == "a" and ("href" in keys or not keys & {"name", "id"})
        stack.append((name, bad, good, link))
        opened[name] = opened.get(name, 0) + 1
        outside += bad
        article += good
        links += link
    if at < len(page) and not outside:
        text.append(page[at:])
        plain += len(page[at:].strip())
    flush()
    return out


def between_surge_and_dive(lengths: list[int], window: int, surge: int) -> list[bool]:
    """Which lines lie in a run that starts where the sum over `window` lines exceeds `surge` and ends where it is 0."""
    kept = [False] * len(lengths)
    total = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    i = 0
    while i < len(lengths):
        if lengths[i] and total[i] > surge:
            while i < len(lengths) and total[i]:
                kept[i] = True
                i += 1
            # The last lines before the dive may hold nothing themselves.
            k = i - 1
            while not lengths[k]:
                kept[k] = False
                k -= 1
        else:
            i += 1
    return kept


def _kept(found: list[tuple[str, int, bool]], window: int, surge: int) -> list[tuple[str, int, bool]]:
    """The lines between surge and dive; a line that is mostly links counts as empty."""
    lengths = [n if 2 * n >= len(text) else 0 for text, n, _ in found]
    return [x for x, keep in zip(found, between_surge_and_dive(lengths, window, surge)) if keep]


def main_text(page: str | None, window: int = 3, surge: int = 80) -> str:
    """The article's blocks joined by newlines; empty for a page without text.

    If the page marks its article, and the marked text is no shorter than what surges outside it, all blocks in it are the article.
    Else the article is what surges on the page: the sum has to exceed `surge`, and if it nowhere does, any text counts. A page on which
    nothing surges outside forms, but something within them, stands in a form as a whole.
    """
    if not page:
        return ""
    found = lines(page)
    if "<form" in page.lower() and not any(x[2] for x in found) and not _kept(found, window, surge):
        within = lines(page, forms=True)
        found = within if any(x[2] for x in within) or _kept(within, window, surge) else found
    marked = [x for x in found if x[2]]
    rest = _kept([x for x in found if not x[2]], window, surge) if marked else []
    if marked and sum(len(x[0]) for x in marked) >= sum(len(x[0]) for x in rest):
        kept = marked
    else:
        kept = _kept(found, window, surge) or _kept(found, window, 0)
    return "\n".join(x[0] for x in kept)


def extract(pages: DataFrame, column: str = "html", window: int = 3, surge: int = 80) -> DataFrame:
    """All columns, but with the html replaced by text and n_chars (code points). A NULL page has an empty text.

    Columns named text or n_chars are replaced. Every page is a row, repeated ones too.
    """

    def compute(values: pa.Array) -> list[pa.Array]:
        texts = [main_text(v.as_py(), window, surge) for v in values]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return append(pages, column, "text string, n_chars long", compute).drop(column)
