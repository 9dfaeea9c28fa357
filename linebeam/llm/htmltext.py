"""Main text of web pages: nearest-URL page differencing over block lines.

Pages are paired with the page of the same host whose URL path is nearest: the
neighbour in path order that shares more leading segments. A page's text lines
(one per block) are aligned with its mate's by longest common subsequence, and
shared lines outside an article element are template lines and go. Lines inside
navigation, page headers, footers, sidebars, adverts, notices, forms and reader
comments go whether the mate shares them or not, since such lines may rotate.
Lines inside the article stay even where the mate is a copy of the page.

What remains is of three kinds: text of article elements, text of a main element
around them, and open text. An article in an article is another story or a comment
and goes. The marked text (articles with what main holds around them, or main) is
the main text unless the open text that differencing leaves is longer: then the
articles are teasers beside an unmarked text.

Furniture by element is sure; furniture by a word of class, id or role is a guess,
a weak one where the word is only a part of a name (``site-footer``). An article or
main element is never guessed to be furniture, and one inside a guessed element is
an article or main again, which counts where there is no other. Inside an article
or main element whole words only count, and a guessed line goes only where the
page's mate shares it or the page has no mate; outside, the line goes. Lines that
are weakly guessed stay where they are more than the other open text. Where a
page has no article or main element, all its open lines are compared; a mate
that shares all of them is a copy and shows nothing.

``differencing_only=True`` leaves the markup's roles out (shared lines go, all
others stay).

Cases: null or empty html, or no text: an empty text. A null or odd URL belongs
to one host without a name. Pages with equal id, url and html are one for
pairing; every row is returned. An empty table gives no rows. Extra columns are
not read. Unclosed elements, comments and tags end with their parent or the page.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linebeam.llm.common import ranked, staged
from linebeam.llm.lcs import shared

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>|[^>]*(?:>|\Z))"
    r"|(?P<text>[^<]+|<)", re.S)
ROLE = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
WORD = re.compile(r"[^\s\"']+")
NAME_PARTS = re.compile(r"[-_]+").split
IS_MAIN = re.compile(r"role\s*=\s*[\"']?main\b", re.I).search

# HTML's own element kinds
HIDDEN = frozenset("script style template noscript textarea iframe object svg math head title canvas select option datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search
section summary table tbody td tfoot th thead tr ul""".split())
CHROME = frozenset("nav footer aside form button menu dialog search fieldset".split())
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SAME_ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt", ("dl",)), "dd": ("dd", ("dl",)),
             "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table")), "tr": ("tr", ("table",))}
# Words of class, id and role attributes that name page furniture
FURNITURE = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted
banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
menu nav navbar navigation navigator breadcrumb breadcrumbs pagination pager sidebar complementary widget widgets
footer contentinfo masthead topbar toolbar share sharing social related recommended recommendations
comment comments reply replies respond disqus discussion search searchbox skip""".split())

# Parts of names that speak of a page's state, not of the element itself
STATES = frozenset("has with without no is not main page content".split())

OPEN, MAIN, ARTICLE = range(3)      # where a line lies
SURE, STRONG, WEAK = range(3)       # how it is known to be text: not guessed to be furniture, or guessed


class Place(NamedTuple):
    """Where the text of an element lies; ``doubt``: an article inside a guessed element."""
    zone: int = OPEN
    guess: int = SURE
    doubt: bool = False
    aside: bool = False


def _furniture(attrs: str, zone: int) -> int:
    """The guess that an element's class, id and role words allow."""
    found = [w for m in ROLE.findall(attrs) for w in WORD.findall(m.lower())]
    if any(w in FURNITURE for w in found):
        return STRONG
    if zone == OPEN and any(parts[0] not in STATES and FURNITURE.intersection(parts) for parts in map(NAME_PARTS, found)):
        return WEAK
    return SURE


def _inside(place: Place, tag: str, attrs: str) -> Place:
    """The place of an element's own text, given its parent's."""
    if place.aside:
        return place
    if tag in CHROME or tag == "header" and place.zone == OPEN:
        return place._replace(aside=True)
    if tag == "article":
        return place._replace(aside=True) if place.zone == ARTICLE else Place(ARTICLE, SURE, place.doubt or place.guess != SURE)
    if (tag == "main" or IS_MAIN(attrs)) and place.zone != ARTICLE:
        return Place(MAIN, SURE, place.doubt)
    if place.guess == SURE and tag not in ("html", "body"):
        return place._replace(guess=_furniture(attrs, place.zone))
    return place


def lines_of(html: str | None):
    """(texts, places): the page's block lines."""
    texts, places, parts = [], [], []
    stack: list[tuple[str, Place, bool]] = []   # tag, place of its text, hidden
    place, hidden = Place(), False

    def flush():
        if parts:
            line = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if line:
                texts.append(line)
                places.append(place)

    def pop_to(i):
        nonlocal place, hidden
        del stack[i:]
        place, hidden = (stack[-1][1], stack[-1][2]) if stack else (Place(), False)

    def pop_open(tag, fence):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                return pop_to(i)
            if stack[i][0] in fence:
                return None

    pos, html = 0, html or ""
    while pos < len(html):
        m = TOKEN.match(html, pos)
        pos = m.end()
        text = m["text"]
        if text is not None:
            if not hidden:
                parts.append(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            if tag in BLOCK:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag not in BLOCK and any(s[0] in BLOCK for s in stack[i + 1:]):
                        break   # an inline end tag doesn't close blocks
                    pop_to(i)
                    break
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in ENDS_P:
                pop_open("p", ("article", "main", "section", "div", "td", "th", "body", "button"))
            if tag in SAME_ENDS:
                pop_open(*SAME_ENDS[tag])
            if tag == "body":
                pop_open("head", ())
        if tag in VOID or m["attrs"].endswith("/>") and tag not in BLOCK:
            continue
        if tag in ("script", "style", "textarea", "title") and not hidden:   # raw text up to its end tag
            end = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(html, pos)
            pos = end.end() if end else len(html)
            continue
        place, hidden = _inside(place, tag, m["attrs"]), hidden or tag in HIDDEN
        stack.append((tag, place, hidden))
    flush()
    return texts, places


def line_hashes(texts) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts), np.uint64, len(texts)).view(np.int64)


def _differenced(at, common):
    """The lines ``at`` that the mate doesn't share; a mate that shares them all is a copy and shows nothing."""
    own = at & ~common
    return own if own.any() else at


def main_text(html: str | None, mate, differencing_only: bool = False) -> str:
    """The main text, given the line hashes of the page's mate (None: no mate)."""
    texts, places = lines_of(html)
    if not texts:
        return ""
    common = shared(line_hashes(texts), np.asarray(mate, np.int64)) if mate is not None else np.zeros(len(texts), bool)
    if differencing_only:
        return "\n".join(t for t, c in zip(texts, common) if not c)
    zone, guess, doubt, aside = np.array(places, np.int64).T
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    text = aside == 0
    guessed = (guess == STRONG) & (common if mate is not None else True)
    marked = text & (zone == ARTICLE) & ~guessed
    if (marked & (doubt == 0)).any():
        marked &= doubt == 0
    around = text & (zone == MAIN) & ~guessed
    if marked.any():
        around &= ~common | common[marked].all()
    marked |= around
    opened, weak = (_differenced(text & (zone == OPEN) & (guess == g), common) for g in (SURE, WEAK))
    if size[weak].sum() > size[opened].sum():
        opened |= weak
    chosen = opened if size[opened].sum() > size[marked].sum() else marked
    return "\n".join(texts[i] for i in np.flatnonzero(chosen))


def _line_pass(batches):
    for b in batches:
        for lo in range(0, b.num_rows, 500):
            part = b.slice(lo, 500)
            hashes = [line_hashes(lines_of(h)[0]).tolist() for h in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hashes, pa.list_(pa.int64()))], names=["mate", "lines"])


def _text_pass(differencing_only):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                texts = [main_text(h, m, differencing_only) for h, m in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])
    return run


def mates(keys: DataFrame) -> DataFrame:
    """(key, mate) from (key, host, path): the nearest path on the host, ties to the one before; none for a lone page."""
    order = staged(ranked(keys, "host", "path", "key"), "order")
    sides = [order.select((F.col("rank") + step).alias("rank"), F.col("key").alias(f"{n}_key"),
                          F.col("host").alias(f"{n}_host"), F.col("path").alias(f"{n}_path"))
             for n, step in (("prev", 1), ("next", -1))]
    both = order.join(sides[0], "rank", "left").join(sides[1], "rank", "left")

    def near(n):
        a, b = F.split("path", "/"), F.split(f"{n}_path", "/")
        differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
        steps = F.when(differs == 0, F.size(a)).otherwise(differs.cast("int") - 1)
        return F.when(F.col(f"{n}_host") == F.col("host"), steps).otherwise(-1)

    p, q = F.coalesce(near("prev"), F.lit(-1)), F.coalesce(near("next"), F.lit(-1))
    mate = F.when((p >= q) & (p >= 0), F.col("prev_key")).when(q >= 0, F.col("next_key"))
    return both.select("key", mate.alias("mate"))


def page_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
              differencing_only: bool = False) -> DataFrame:
    """(page_id, url, text) per row of ``pages``."""
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"),
                        F.xxhash64(page_id, url, html).alias("key"))
    address = F.coalesce(F.col("url"), F.lit(""))
    host = F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    pairs = mates(rows.select("key", host.alias("host"), path.alias("path")).distinct())
    lines = rows.select("key", "html").mapInArrow(_line_pass, "mate bigint, lines array<bigint>").dropDuplicates(["mate"])
    known = pairs.where("mate is not null").join(lines, "mate").select("key", "lines")
    return (rows.join(known, "key", "left").select("page_id", "url", "html", "lines")
            .mapInArrow(_text_pass(differencing_only), "page_id bigint, url string, text string"))
