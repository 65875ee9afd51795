"""Main text of web pages by composite text density.

For every element of a page the density is its characters per tag, scaled down
by how much of it is links.  An element's density sum adds up its children's
densities.  The element with the greatest sum is the heart of the article; the
least density on its way up to the body is the threshold.  From the body down,
an element whose own sum is the greatest within it is taken whole; otherwise
its children at or above the threshold are looked at in turn.

Elements that are by their tag, role or class name no article text (menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles)
take no part in the densities and never appear.  If that leaves nothing, names
are not looked at, only tags.

Blocks are the stretches of text between block-level tags; white space inside a
block becomes one space, blocks are joined by a newline.  A null or empty page
has an empty text.  Extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# The kinds of elements.
_SKIPPED = frozenset("nav header footer aside form button select option textarea input label fieldset dialog menu "
                     "noscript template svg math canvas iframe object embed applet audio video map head title".split())
_RAW = frozenset("script style xmp noembed noframes textarea title iframe noscript".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr "
                   "td th caption blockquote pre figure figcaption address center details summary hr hgroup "
                   "nav header footer aside form fieldset dialog menu".split())
_CLOSES_P = _BLOCK - frozenset(("html", "body", "td", "th", "tr", "caption"))
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}
_FENCE = frozenset("ul ol dl table body article section div main blockquote".split())
_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar "
                   "menu nav navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr "
                   "notice notices popup modal overlay newsletter subscribe signup login share sharing social related "
                   "recommended comment comments disqus reply replies discussion responses reactions feedback pager "
                   "pagination toolbar widget copyright alert disclaimer".split())
_STEMS = tuple("cookie comments commentlist commentbox advert adsby sidebar newsletter breadcrumb sponsor promobox "
               "subscri popup navbar footer".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                   "toolbar status note".split())
_KEPT = frozenset(("html", "body", "main", "article"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>\"']+)))?")
_UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
# What a name is made of beside the words above (share-buttons).
_FILLERS = frozenset("site page main top bottom left right box bar list item block section area wrapper container content "
                     "inner outer button buttons link links form text message msg slot unit widget js col column fixed sticky "
                     "global primary secondary first last new old thread form count icon icons posts articles stories".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def attributes_of(raw: str) -> dict[str, str]:
    """Names (lower case) and values of a tag's attributes; the first of a name counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape("".join(values)))
    return out


def _named_away(raw: str) -> bool:
    """Do class, id, role, style or being hidden say that this is no article text?

    A name of several words counts if all of them are known, or if it holds a
    word of ``_STEMS``: ``share-buttons`` does, ``social-science`` doesn't.
    """
    held = attributes_of(raw)
    if "hidden" in held or held.get("aria-hidden", "").strip().lower() == "true" or _UNSHOWN.search(held.get("style", "")):
        return True
    if set(held.get("role", "").lower().split()) & _ROLES:
        return True
    for name in (held.get("class", "") + " " + held.get("id", "")).split():
        parts = [p.lower() for p in _PART.findall(name)]
        for k, part in enumerate(parts):
            if part in ("with", "has", "no", "without"):
                parts = parts[:k]            # content-with-sidebar
                break
        known = [p in _NAMES or p.startswith(_STEMS) for p in parts]
        if any(p.startswith(_STEMS) for p in parts) or any(known) and all(
                k or p in _FILLERS or len(p) < 3 for p, k in zip(parts, known)):
            return True
    return False


class _Page:
    """Elements in page order (an element's descendants follow it directly),
    and the pieces of text with the element and block they are in."""

    def __init__(self, source: str, names: bool):
        self.parent, self.tag = [-1], [""]
        self.own = [0]                 # 1: left out for its tag, 2: for its name
        self.chars, self.tags, self.link_chars, self.link_tags = [0], [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []
        self._read(source, names)
        self.away = self._settle()

    def _open(self, tag: str, own: int) -> int:
        self.parent.append(self.stack[-1])
        self.tag.append(tag)
        self.own.append(own)
        for column in (self.chars, self.tags, self.link_chars, self.link_tags):
            column.append(0)
        self.stack.append(len(self.tag) - 1)
        return self.stack[-1]

    def _settle(self) -> list[bool]:
        """What is left out.  A name alone takes nothing away that holds an
        article, nor, where the page marks none, more text than it leaves; nor
        does a header take headings out of an article."""
        n, own = len(self.tag), self.own
        holds = [tag in ("article", "main") for tag in self.tag]
        marked = any(holds)
        skipped, within = [False] * n, [False] * n          # by tag; in an article
        for i in range(1, n):
            skipped[i] = skipped[self.parent[i]] or own[i] == 1
            within[i] = within[self.parent[i]] or self.tag[self.parent[i]] in ("article", "main")
        chars = [0 if skipped[i] else self.chars[i] for i in range(n)]
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            chars[up] += chars[i]
            holds[up] = holds[up] or holds[i] and not skipped[i]
        away = [False] * n
        for i in range(1, n):
            up = self.parent[i]
            named = own[i] == 2 and not holds[i] and (marked or 2 * chars[i] <= chars[0])
            away[i] = away[up] or named or own[i] == 1
            if self.tag[i] in _HEADINGS and within[i] and away[i] and own[i] == 0:
                # Up to the article, only headers may lie around a heading.
                while up and self.tag[up] not in ("article", "main") and (
                        not own[up] or self.tag[up] in ("header", "hgroup") or self._header(up)):
                    up = self.parent[up]
                away[i] = self.tag[up] not in ("article", "main") or away[up]
        return away

    def _header(self, i: int) -> bool:
        return self.own[i] == 2 and i in self.headers

    def _close(self, wanted: tuple[str, ...], fence: frozenset = frozenset()) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[k]] in wanted:
                del self.stack[k:]
                return
            if self.tag[self.stack[k]] in fence:
                return

    def _text(self, raw: str, block: int, linked: bool) -> None:
        if not raw:
            return
        at = self.stack[-1]
        text = html.unescape(raw)
        self.pieces.append((at, block, text))
        n = len("".join(text.split()))
        self.chars[at] += n
        if linked:
            self.link_chars[at] += n

    def _read(self, source: str, names: bool) -> None:
        self.stack, self.headers = [0], set()
        block, linked, at = 0, False, 0
        low = None
        last = source.rfind(">") + 1        # no tag ends behind it, so none is looked for
        while True:
            m = _TOKEN.search(source, at, last)
            if m is None:
                rest = source.find("<!--", max(at, last))
                self._text(source[at:] if rest < 0 else source[at:rest], block, linked)
                return
            self._text(source[at:m.start()], block, linked)
            at = m.end()
            if source.startswith("<!--", m.start()) and not source.endswith("-->", m.start() + 4, at):
                return                      # a comment that is never closed
            end, tag, attributes = (m.group(1), m.group(2), m.group(3)) if m.group(2) else m.group(4, 5, 6)
            if tag is None:
                continue
            tag = tag.lower()
            if not end and tag in _RAW:
                low = source.lower() if low is None else low
                stop = low.find("</" + tag, at) if len(low) == len(source) else source.find("</" + tag, at)
                at = len(source) if stop < 0 else stop
                continue
            if tag == "br":
                self._text(" ", block, linked)
            if tag in _BLOCK:
                block += 1
                linked = False
            if end:
                if tag == "a":
                    linked = False
                elif tag in _BLOCK or tag in _SKIPPED:
                    self._close((tag,))
                elif any(self.tag[s] == "~" + tag for s in self.stack):
                    self._close(("~" + tag,))
                continue
            self.tags[self.stack[-1]] += 1
            if tag == "a":
                linked = True
                self.link_tags[self.stack[-1]] += 1
            if tag in _VOID:
                continue
            if tag in _SAME:
                self._close(_SAME[tag], _FENCE - {tag})
            if tag in _CLOSES_P:
                self._close(("p",), _FENCE)
            named = names and tag not in _KEPT and tag != "blockquote" and bool(attributes) and _named_away(attributes)
            own = 1 if tag in _SKIPPED else 2 if named else 0
            if tag in _BLOCK or tag in _SKIPPED:
                at_ = self._open(tag, own)
                if named and "header" in attributes.lower():
                    self.headers.add(at_)
            elif named:
                self._open("~" + tag, own)

    def select(self) -> list[int]:
        """The elements that make up the article."""
        n = len(self.tag)
        totals = [[0 if self.away[i] else column[i] for i in range(n)]
                  for column in (self.chars, self.tags, self.link_chars, self.link_tags)]
        for i in range(n - 1, 0, -1):
            for t in totals:
                t[self.parent[i]] += t[i]
        chars, tags, link_chars, link_tags = totals
        body = next((i for i in range(n) if self.tag[i] == "body" and not self.away[i]), 0)
        ratio = link_chars[body] / max(chars[body], 1)
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n):
            if chars[i] and not self.away[i]:
                c, t, lc, lt = chars[i], max(tags[i], 1), link_chars[i], max(link_tags[i], 1)
                base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
                density[i] = c / t * max(math.log(c / max(lc, 1) * t / lt), 0.0) / base
        home = self.parent[:]                    # the next element around that stays
        for i in range(1, n):
            if self.away[home[i]]:
                home[i] = home[home[i]]
        for i in range(1, n):
            if not self.away[i]:
                sums[home[i]] += density[i]
        greatest = sums[:]                       # within each element
        for i in range(n - 1, 0, -1):
            greatest[home[i]] = max(greatest[home[i]], greatest[i])
        inside = [i >= body and (i == body or self.parent[i] >= body) for i in range(n)]
        heart = max((i for i in range(n) if inside[i] and not self.away[i]), key=lambda i: (sums[i], -i), default=body)
        least, i = density[heart], heart
        while i > body:
            i = self.parent[i]
            least = min(least, density[i])
        out, todo = [], [body]
        children: dict[int, list[int]] = {}
        for i in range(1, n):
            children.setdefault(home[i], []).append(i)
        while todo:
            i = todo.pop()
            if sums[i] >= greatest[i]:
                out.append(i)
            else:
                todo += [c for c in children.get(i, ()) if not self.away[c] and density[c] >= least]
        return out

    def text(self, chosen: list[int]) -> str:
        n = len(self.tag)
        take = [False] * n
        for i in chosen:
            take[i] = True
        for i in range(1, n):
            take[i] = take[i] or take[self.parent[i]]
        blocks: list[str] = []
        last, held = None, []
        for at, block, text in [*self.pieces, (0, -1, "")]:
            if block != last:
                line = " ".join("".join(held).split())
                if line:
                    blocks.append(line)
                last, held = block, []
            if take[at] and not self.away[at]:
                held.append(text)
        return "\n".join(blocks)


def main_text(source: str | None) -> str:
    """The article of one page."""
    if not source:
        return ""
    for names in (True, False):
        page = _Page(source, names)
        text = page.text(page.select())
        if text:
            return text
    return ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    def task(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return small_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(task, "page_id long, url string, text string, n_chars long")
