"""Main text of web pages by tree scoring.

A page is read into a tree in one pass (end tags that may be left out are put in, scripts and styles
are skipped whole). Parts that are never the article are cut: by element, role or the words of class
and id. Every paragraph then passes points for its length and its commas to the container it stands
in, half of them to the next one up and ever less further on; a container's score is its points,
with a start value for its element, times the share of its text that is not in links. The best
container is kept (the whole `article` it stands in, if any), with those siblings that score well
themselves or read like further paragraphs.

All loops follow the page's parts in order; nothing is recursive, so nesting has no limit, and the time
grows with the page's length: points go up `REACH` containers, lengths are added up from the last
element to the first.

Inside an article or main the words of an id may come from a title: there a class cuts by what it
names, an id only if it names nothing but a part (`comments`, `cookie-notice`); other parts that words
speak against stay if they hold enough text outside links.

Defined results: a null or empty page, or one without text, gives the empty text; text outside any
element counts as the page's own; broken or cut markup is read as far as it goes; repeated rows are
read alike; an empty table gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack.llm.common import batch_rows, col, fresh

# HTML's elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes template svg".split())
CUT = RAW | frozenset(
    "head nav footer aside form button select option optgroup input label fieldset legend object embed canvas audio "
    "video map dialog menu applet datalist output progress meter search".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Blocks that are text themselves: their container is what they stand in.
TEXT_BLOCKS = HEADINGS | frozenset("p pre blockquote li dd dt figcaption summary caption address td th".split())
#: An open element ends where one of these begins, unless a fence lies between.
CLOSED_BY = {
    "p": BLOCK, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot", "thead"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot", "thead"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot", "thead"}), "option": frozenset({"option", "optgroup"}),
    "thead": frozenset({"tbody", "tfoot"}), "tbody": frozenset({"tbody", "tfoot"}), "head": frozenset({"body"}),
}
FENCES = {
    "li": frozenset({"ul", "ol", "menu", "dir"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"}),
    "tr": frozenset({"table"}), "td": frozenset({"table"}), "th": frozenset({"table"}), "thead": frozenset({"table"}),
    "tbody": frozenset({"table"}), "p": frozenset({"button", "table", "td", "th", "caption"}), "option": frozenset({"select"}),
    "head": frozenset(),
}
#: Words of class and id, and roles, of parts that are never the article.
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner banners promo promos promotion sponsor "
    "sponsored sidebar sidebars aside nav navbar navigation menu menus topbar breadcrumb breadcrumbs footer foot masthead "
    "header comment comments commentlist disqus respond reply replies discussion cookie cookies consent gdpr notice "
    "notices disclaimer alert newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations pagination pager popup modal overlay widget widgets toolbar skip hidden tags taglist".split()
)
#: Those that no title holds: they cut anywhere, the second ones as words of a class only.
SURE_WORDS = frozenset(
    "adsense adslot sidebar sidebars navbar topbar breadcrumb breadcrumbs masthead commentlist disqus gdpr pagination pager "
    "toolbar taglist".split()
)
SURE_CLASS_WORDS = SURE_WORDS | frozenset("ad ads adv advert adverts advertisement banner banners promo promos sponsored newsletter".split())
#: Words of a class that may describe a part of the article itself; the others name what the part is for.
OPEN_CLASS_WORDS = frozenset("header discussion hidden skip tags aside".split())
#: An id that holds words for parts alone names a part, if one of the first words leads it or one of the second is in it.
LEADING_WORDS = frozenset("comment comments respond disqus".split())
PART_WORDS = frozenset("list section area box container wrapper wrap thread form bar block inner content item body".split())
PURPOSE_WORDS = frozenset("cookie cookies consent newsletter subscribe signup advertisement popup modal overlay".split())
#: Words before the class of one reader's comment (or advert) in an article of its own.
OWN_ARTICLE_WORDS = frozenset("comment comments reply replies pingback trackback disqus".split())
#: A part that other words speak against stays with this much text outside links, if it is at least half of its text.
ENOUGH = 80
CUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist "
    "tooltip status".split()
)
#: A cut word after one of the first, or before one of the second, tells of the element's surroundings.
ABOUT = frozenset("with has no without".split())
STATE = frozenset("open closed enabled disabled".split())
#: Containers that points reach, beginning with a paragraph's own.
REACH = 32
#: Elements that words of class and id do not cut.
KEPT = frozenset("html body main article".split())
#: Containers that may be an unmarked menu, the least share of their text outside links if they are none, and the
#: characters of a paragraph: what stands between two such of the article is no menu.
CONTAINERS = frozenset("div section ul ol dl table center details dir header".split())
MENU, PARAGRAPH = 0.2, 60
#: Parts of a table that hold no text of their own.
ROWS = frozenset("tr tbody thead tfoot".split())
START = {"article": 25.0, "main": 15.0, "section": 5.0, "div": 5.0, "td": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0}

TAG = re.compile(r"""<(?:!--(?:.*?-->|.*)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z))""", re.S)
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ENDING = frozenset().union(*CLOSED_BY.values())
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop|itemtype)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
COMMAS = re.compile("[,，、،]")


def _names_a_part(tag: str, attribute: str, words: list[str], against: set[str]) -> bool:
    """Whether the words of a class or id, where titles may have given them, can only name a part to be cut."""
    if tag in HEADINGS:
        return attribute == "class" and bool(against & SURE_CLASS_WORDS)
    if attribute == "class":
        return bool(against - OPEN_CLASS_WORDS)
    whole = all(w in CUT_WORDS or w in PART_WORDS for w in words)
    return bool(against & SURE_WORDS) or whole and (words[0] in LEADING_WORDS or len(words) > 1 and bool(against & PURPOSE_WORDS))


def _cut_by_attributes(tag: str, rest: str, titled: bool) -> str:
    """"cut", "doubt" (where words may come from a title, `titled`), "header" (doubt by this word only) or nothing."""
    doubts: set[str] = set()
    for name, value in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in CUT_ROLES:
            return "cut"
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "cut"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "cut"
        if name in ("itemprop", "itemtype") and value.lower().rpartition("/")[2] == "comment":
            return "cut"
        if name == "class" and tag == "article" and any(
            (w := WORDS.findall(token.lower())) and w[0] in OWN_ARTICLE_WORDS and not STATE.intersection(w[1:2]) for token in value.split()
        ):
            return "cut"
        if name in ("class", "id") and tag not in KEPT:
            words = [w.lower() for w in WORDS.findall(value)]
            against = {
                w for k, w in enumerate(words)
                if w in CUT_WORDS and (not k or words[k - 1] not in ABOUT) and not STATE.intersection(words[k + 1 : k + 2])
            }
            if against and (not titled or _names_a_part(tag, name, words, against)):
                return "cut"
            doubts |= against
    if not doubts or tag in HEADINGS:
        return ""
    return "header" if doubts == {"header"} else "doubt"


class Page:
    """A page's elements in order of their beginning (0 is the page itself) and its text between block borders."""

    def __init__(self, html: str):
        self.tag, self.parent, self.cut, self.link = ["#page"], [-1], [False], [False]
        #: (element, text), or None where a block begins or ends
        self.parts: list[tuple[int, str] | None] = []
        #: Elements to be cut unless their text speaks for them, and whether links alone speak against it
        self.doubts: list[tuple[int, bool]] = []
        self.open = [0]
        #: Places in `open` of each tag, and of the blocks over which no end is implied; of each element the
        #: block it is or stands in and whether an article or main is around.
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.barriers: list[int] = []
        self.block, self.inside = [0], [False]
        at, n = 0, len(html)
        while at < n:
            sign = html.find("<", at)
            if sign < 0:
                self._text(html[at:])
                break
            m = TAG.match(html, sign) or LOOSE_TAG.match(html, sign)
            if sign > at:
                self._text(html[at:sign])
            if m is None:
                self._text("<")
                at = sign + 1
                continue
            at = m.end()
            if m.group(2) is None:
                continue
            tag = m.group(2).lower()
            if m.group(1):
                self._end(tag)
                continue
            self._begin(tag, m.group(3))
            if tag in RAW and not m.group(3).endswith("/"):
                close = re.compile(f"</{re.escape(tag)}", re.I).search(html, at)
                at = close.start() if close else n

    def _text(self, text: str) -> None:
        self.parts.append((self.open[-1], text))

    def _begin(self, tag: str, rest: str) -> None:
        if tag in ENDING:
            low = self.barriers[-1] if self.barriers else 0
            at = [
                places[-1] for name, closers in CLOSED_BY.items()
                if tag in closers and (places := self.places[name]) and places[-1] > low
                and all(not self.places[x] or self.places[x][-1] < places[-1] for x in FENCES[name])
            ]
            if at:
                self._close(min(at))
                self.parts.append(None)
        own, parent = len(self.tag), self.open[-1]
        cut = self.cut[parent] or tag in CUT
        if rest and not cut:
            titled = tag == "section" or tag in HEADINGS or self.inside[parent]
            found = _cut_by_attributes(tag, rest, titled)
            cut = found == "cut"
            if found and not cut:
                self.doubts.append((own, found == "header"))
        if tag == "header" and not cut:
            # A page's header is cut, an article's own is not.
            cut = not self.inside[parent]
        self.tag.append(tag)
        self.block.append(own if tag in BLOCK else self.block[parent])
        self.inside.append(self.inside[parent] or tag in ("article", "main"))
        self.parent.append(parent)
        self.cut.append(cut)
        self.link.append(self.link[parent] or tag == "a")
        if tag in BLOCK:
            self.parts.append(None)
        elif tag == "br":
            self._text(" ")
        if tag not in VOID and not rest.endswith("/"):
            self.places[tag].append(len(self.open))
            if tag in BLOCK and tag not in CLOSED_BY:
                self.barriers.append(len(self.open))
            self.open.append(own)

    def _close(self, place: int) -> None:
        """End the open elements from `place` on."""
        for x in self.open[place:]:
            self.places[self.tag[x]].pop()
        del self.open[place:]
        while self.barriers and self.barriers[-1] >= place:
            self.barriers.pop()

    def _end(self, tag: str) -> None:
        if not self.places[tag]:
            return
        if tag in BLOCK:
            self.parts.append(None)
        self._close(self.places[tag][-1])

    def blocks(self, kept: list[bool]) -> Iterator[tuple[int, str, int]]:
        """Blocks of text of kept elements, in order: element of the first text, text, characters in links."""
        texts: list[str] = []
        first, linked, blank = 0, 0, True
        for part in (*self.parts, None):
            if part is None:
                if texts:
                    text = " ".join(unescape("".join(texts)).split())
                    if text:
                        yield first, text, linked
                texts, linked, blank = [], 0, True
            elif kept[part[0]]:
                if blank:
                    first, blank = part[0], not part[1].strip()
                texts.append(part[1])
                if self.link[part[0]]:
                    linked += len(part[1].strip())

    def shown(self) -> list[bool]:
        """Elements that are not cut, by themselves or by what they stand in."""
        shown = [not c for c in self.cut]
        if not self.doubts:
            return shown
        length, linked = [0] * len(shown), [0] * len(shown)
        for element, text in filter(None, self.parts):
            if shown[element]:
                length[element] += (size := len(" ".join(unescape(text).split())))
                linked[element] += size * self.link[element]
        for k in range(len(shown) - 1, 0, -1):
            length[self.parent[k]] += length[k]
            linked[self.parent[k]] += linked[k]
        for k, header in self.doubts:
            plain = length[k] - linked[k]
            shown[k] = shown[k] and plain >= linked[k] and (header or plain >= ENOUGH)
        for k in range(1, len(shown)):
            shown[k] = shown[k] and shown[self.parent[k]]
        return shown

    def main_text(self) -> str:
        n = len(self.tag)
        shown = self.shown()
        points, length, linked = [0.0] * n, [0] * n, [0] * n
        scored = [False] * n
        # Numbers of the first and last block of each element, and of its paragraphs.
        first, last, opening, closing = [0] * n, [0] * n, [1 << 62] * n, [-1] * n
        for number, (element, text, in_links) in enumerate(self.blocks(shown), 1):
            paragraph = len(text) >= PARAGRAPH and 2 * in_links <= len(text)
            element = self.block[element]
            length[element] += len(text)
            linked[element] += min(in_links, len(text))
            first[element], last[element] = first[element] or number, number
            if paragraph:
                opening[element], closing[element] = min(opening[element], number), number
            if self.tag[element] in HEADINGS:
                continue
            own = (1 + len(COMMAS.findall(text)) + min(len(text) / 100, 3)) * (1 - min(in_links / len(text), 1))
            up = self.block[self.parent[element]] if self.tag[element] in TEXT_BLOCKS and element else element
            scored[up] = scored[up] or own > 0
            for level in range(REACH):
                points[up] += own / (1 if not level else 2 if level == 1 else 3 * level)
                if not up:
                    break
                up = self.block[self.parent[up]]
        # What an element holds, its parent holds too; an element comes after its parent.
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            length[up] += length[k]
            linked[up] += linked[k]
            if first[k]:
                first[up], last[up] = min(first[up] or first[k], first[k]), max(last[up], last[k])
            opening[up], closing[up] = min(opening[up], opening[k]), max(closing[up], closing[k])
            if scored[k]:
                scored[self.block[up]] = True

        def plain(k: int) -> float:
            return 1 - linked[k] / length[k] if length[k] else 1.0

        score = [(points[k] + START.get(self.tag[k], 0.0)) * plain(k) if scored[k] else 0.0 for k in range(n)]
        best = max((k for k in range(n) if scored[k] and self.tag[k] not in ROWS), key=lambda k: (score[k], -k), default=0)
        up = best
        while up > 0:
            if self.tag[up] == "article":
                best = up
            up = self.parent[up]
        chosen = [False] * n
        chosen[best] = True
        least = max(10.0, 0.2 * score[best])
        inside = best and self.tag[self.parent[best]] in ("article", "main")
        if best and self.tag[best] != "article":
            for k in range(n):
                if self.parent[k] == self.parent[best] and k != best and length[k]:
                    text_block = self.tag[k] in TEXT_BLOCKS
                    chosen[k] = plain(k) > 0.75 and (
                        score[k] >= least or text_block and (inside or length[k] > 80 or self.tag[k] in HEADINGS)
                    )
        elif self.tag[best] == "article":
            for k in range(n):
                if self.parent[k] == self.parent[best] and k != best and self.tag[k] == "article":
                    chosen[k] = score[k] >= least and plain(k) > 0.75
        top = best if not best or self.tag[best] == "article" else self.parent[best]
        for k in range(1, n):
            at_edge = not opening[top] < first[k] <= last[k] < closing[top]
            menu = self.tag[k] in CONTAINERS and plain(k) < MENU and at_edge
            chosen[k] = (chosen[k] or chosen[self.parent[k]]) and shown[k] and not menu
        if not best:
            chosen[0] = True
        return "\n".join(text for _, text, _ in self.blocks(chosen))


def main_text(html: str | None) -> str:
    return Page(html).main_text() if html else ""


def extract(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """`pages` with the main text of the whole html in `into` (renamed if taken)."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for html in batches:
            yield pa.array([main_text(h) for h in html.to_pylist()], pa.string())

    batch_rows(pages.sparkSession)
    return pages.withColumn(fresh(pages, into), of(col(html_col)))


def op8(pages: DataFrame) -> DataFrame:
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
