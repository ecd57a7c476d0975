"""Main text of web pages by line-block distribution.

A page is read tag by tag: block-level tags end lines, other markup goes, and
character references are decoded.  Each line has a weight, its text's length
outside links, without white space, and the block distribution is the sum of
weights over a window of ``WINDOW`` lines.  A surge is a line with weight whose
window sum reaches the threshold, a share of the page's largest sum but
``ENOUGH`` characters at most; the dive behind it is the first line whose
window sum is zero.  The text from surge to dive is kept, together with lines
of weight right before the surge, such as a title.

Elements and names set weights, and the distribution decides on every page:

- Where an ``article`` or ``main`` element holds text outside links, its lines
  weigh ``ENOUGH`` at least, those of links too, and lines outside weigh nothing.
- Lines of menus, page headers, footers, sidebars, notices, adverts, forms and
  reader comments weigh nothing.  They are known by their element, or by their
  class, id or role (not headings; an ``article`` only where it is a reader's
  comment), if it is made up of words for such parts.  A dropped element whose
  end tag may be left out ends where HTML says.
- A name that only holds such a word beside others (``related-work``) or names
  a part that may be anything (``widget``) is no more than a hint: its element
  weighs nothing unless it has running text of its own (:func:`_is_text`).
- An ``article`` whose heading is all link weighs nothing beside one that holds over
  ``TEASER`` times its text: it only points to another page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
THRESHOLD = 0.1           # of the page's largest window sum
ENOUGH = 40               # a window sum that reaches the threshold on any page: about a sentence
RUNNING = 20              # characters outside links that make running text of a part in an article
MUCH = 200                # and of one on a page without an article
TEASER = 4
HINT_DEPTH = 4            # each level reads its text once more

# HTML element names and common names of page parts.
BLOCK_TAGS = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol optgroup option p pre section
    select summary table tbody td textarea tfoot th thead title tr ul video""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea title svg math iframe object".split())
DROPPED_TAGS = frozenset("nav footer aside form menu dialog button select head".split())
# Words that name such a part wherever they stand in a name, words that do so where the rest of the name says nothing else, and
# those that may also be around a page's text.
PART_WORDS = frozenset("""ad ads advert advertisement advertising adverts breadcrumb breadcrumbs consent cookie cookies disqus nav navbar pager
    pagination sponsor sponsored""".split())
DROPPED_WORDS = PART_WORDS | frozenset("""comment comments footer masthead menu navigation newsletter notice related reply replies share sharing
    sidebar signup social subscribe""".split())
LOOSE_WORDS = frozenset("banner modal popup promo toolbar widget widgets".split())
SAY_NOTHING = frozenset("""area article articles author bar block body bottom box button buttons close container content count date footer form header heading
    icon icons inline inner item items left link links list main message meta outer overlay panel post posts primary row section secondary
    slot small sticky stories story text thread title top unit view wrap wrapper""".split())
ONLY_SAY = frozenset("has no with without".split())   # first words of names that say whether a part exists
COMMENT = re.compile(r"(?:comments?|reply|replies)(?:[-_]?\d+)?")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED_NAMES = frozenset("header site-header page-header top-bar topbar complementary contentinfo search".split())

# Elements whose end tag may be left out, and the start tags that end them.
ENDED_BY = {"p": BLOCK_TAGS - set("br button iframe noscript textarea select option optgroup video legend body html head".split()),
            "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot", "thead"},
            **dict.fromkeys(("td", "th"), {"td", "th", "tr", "tbody", "tfoot", "thead"})}
NESTS = ("ul", "ol", "dl", "dir", "menu", "table", "select")  # what is in one of these ends with it

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^\"'<>]++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
                 r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
NAME = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


KEPT, HINT, LOOSE, DROPPED = range(4)


def _named(name: str) -> int:
    """What a class, id or role says of its element."""
    words = re.split(r"[-_]+", name)
    if words[0] in ONLY_SAY:
        return KEPT
    if name in DROPPED_NAMES or not PART_WORDS.isdisjoint(words):
        return DROPPED
    if DROPPED_WORDS.isdisjoint(words) and LOOSE_WORDS.isdisjoint(words):
        return KEPT
    if all(w in DROPPED_WORDS or w in LOOSE_WORDS or w in SAY_NOTHING or w.isdecimal() or not w for w in words):
        return DROPPED if not DROPPED_WORDS.isdisjoint(words) else LOOSE
    return HINT


def _dropped(tag: str, attributes: str, inside: bool) -> int:
    """Whether an element is a part of the page that is not its main text.  ``inside``: within article or main."""
    if tag in ("html", "body", "main", "h1", "h2", "h3", "h4", "h5", "h6"):
        return KEPT
    if tag in DROPPED_TAGS or (tag == "header" and not inside):
        return DROPPED
    names = [n for m in NAME.finditer(attributes) for n in next(g for g in m.groups() if g is not None).lower().split()]
    if tag == "article":              # only a reader's comment is an article that is not main text
        return DROPPED if any(COMMENT.fullmatch(n) for n in names) else KEPT
    return max(map(_named, names), default=KEPT)


class Line(NamedTuple):
    text: str
    weight: int
    inside: bool          # within article or main
    article: int          # the innermost open article, by number; 0 outside
    heading: bool
    part: tuple | None    # of a part that is hinted at: (what its name says, where it starts, where it ends in the page)


def _is_text(kind: int, part: list[Line], inside: bool, rest: int) -> bool:
    """Whether a part whose name only hints at something else has running text of its own, beside ``rest`` characters of the page."""
    weight, size = sum(x.weight for x in part), sum(len("".join(x.text.split())) for x in part)
    if kind == LOOSE:                 # it holds most of the page
        return weight >= MUCH and weight > rest
    return weight >= (RUNNING if inside else MUCH) and 2 * weight >= size


def lines(page: str, hints: bool = True) -> list[Line]:
    """The lines that are not dropped, and an empty line for each dropped part.  Without ``hints`` all parts of such names are dropped."""
    out: list[Line] = []
    parts: list[str] = []
    weight = inside = links = 0
    open_articles: list[int] = []
    articles, heading = 0, False
    drop, depth = "", 0               # the element that is being dropped, and how often its name is open
    around: Counter = Counter()       # open block elements outside of dropped parts
    within: Counter = Counter()       # and inside the one that is being dropped, if its end tag may be left out

    def line(text: str, chars: int, part: tuple | None = None) -> None:
        out.append(Line(text, chars, inside > 0, open_articles[-1] if open_articles else 0, heading, part))

    def dropped_to(stop: int) -> None:
        """The dropped part, if it is only hinted at, ends at ``stop``."""
        if out and out[-1].part and out[-1].part[2] is None:
            out[-1] = out[-1]._replace(part=(*out[-1].part[:2], stop))

    def goes_on() -> bool:
        """Whether the dropped element, whose end tag may be left out, is open behind this tag's start; counts what is in it."""
        nested = any(within[t] for t in NESTS)
        if not closing:
            if not nested and tag in ENDED_BY[drop]:
                return False
            if tag in BLOCK_TAGS and not alone:
                within[tag] += 1
            return True
        if tag in BLOCK_TAGS and within[tag]:
            within[tag] -= 1
            if tag in NESTS and not any(within[t] for t in NESTS):
                for t in ENDED_BY:
                    within[t] = 0
            return True
        return nested and tag not in NESTS or tag == "p" or tag not in BLOCK_TAGS or not around[tag]

    def end() -> None:
        nonlocal parts, weight
        text = " ".join("".join(parts).split())
        if text:
            line(text, weight)
        parts, weight = [], 0

    def add(raw: str) -> None:
        nonlocal weight
        text = html.unescape(raw)
        parts.append(text)
        if not links:
            weight += sum(map(len, text.split()))

    at = 0
    while True:
        m = TAG.search(page, at)
        if not drop and at < (m.start() if m else len(page)):
            add(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        alone = tag in VOID_TAGS or attributes.endswith("/")
        if tag in RAW_TAGS and not closing and not alone:
            close = re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            if tag in BLOCK_TAGS and not drop:
                end()
            continue
        if drop:
            if tag in ("article", "main") and not closing and drop != "article":
                drop = ""             # an unclosed part ends where the main text begins
                dropped_to(m.start())
            elif drop in ENDED_BY:
                if closing and tag == drop and not within[tag]:
                    drop = ""
                    dropped_to(m.start())
                    continue
                if goes_on():
                    continue
                drop = ""             # a start tag or the parent's end tag ends it and counts itself
                dropped_to(m.start())
            else:
                if tag == drop and not alone:
                    depth += -1 if closing else 1
                    if not depth:
                        drop = ""
                        dropped_to(m.start())
                continue
        if tag in BLOCK_TAGS:
            end()
        says = KEPT if closing or alone else _dropped(tag, attributes, inside > 0)
        if says != KEPT:
            end()
            line("", 0, (says, at, None) if hints and says != DROPPED else None)
            drop, depth = tag, 1
            within.clear()
        elif tag in ("article", "main"):
            inside = max(0, inside + (-1 if closing else 1))
            if tag == "article" and not closing:
                articles += 1
                open_articles.append(articles)
            elif tag == "article" and open_articles:
                open_articles.pop()
        elif tag in HEADINGS:
            heading = not closing
        elif tag == "a" and not alone:
            links = 0 if closing else 1
        if tag in BLOCK_TAGS and not alone and not drop:
            around[tag] = max(0, around[tag] + (-1 if closing else 1))
        if tag in BLOCK_TAGS and links and tag not in ("li", "br"):
            links = 0                 # an unclosed link ends with its block
    end()
    dropped_to(len(page))
    return out


def _opened(page: str, rows: list[Line], rest: int, depth: int, inside: bool = False) -> list[Line]:
    """The lines with those of hinted parts that are text in their places; parts within parts down to ``depth``, deeper ones are dropped."""
    out: list[Line] = []
    for x in rows:
        inner = page[x.part[1]:x.part[2]] if x.part else ""
        within = inside or x.inside
        part = _opened(inner, lines(inner, depth > 1), rest, depth - 1, within) if inner else []
        if part and _is_text(x.part[0], part, within, rest):
            out += [y._replace(inside=x.inside, article=x.article) for y in part]
        else:
            out.append(x)
    return out


def weighed(page: str) -> list[tuple[str, int]]:
    """(text, weight) of a page's lines, with what elements and names say put into the weights."""
    rows = lines(page)
    out = _opened(page, rows, sum(x.weight for x in rows), HINT_DEPTH)
    if not any(x.weight for x in out if x.inside):
        return [(x.text, x.weight) for x in out]
    mass, titles = Counter(), {}
    for x in out:
        mass[x.article] += x.weight
        if x.text:
            titles.setdefault(x.article, x.heading and not x.weight)
    most = max(mass.values())
    teasers = {a for a, only_link in titles.items() if a and only_link and TEASER * mass[a] < most}
    return [(x.text, max(x.weight, ENOUGH) if x.text else 0) if x.inside and x.article not in teasers else ("", 0) for x in out]


def block_sums(weights: list[int], window: int = WINDOW) -> list[int]:
    """The block distribution: each line's weight and those of the ``window - 1`` lines behind it."""
    ends = [0, *accumulate(weights)]
    return [ends[min(i + window, len(weights))] - ends[i] for i in range(len(weights))]


def main_text(page: str, window: int = WINDOW, threshold: float = THRESHOLD) -> str:
    """The blocks of a page's main text, joined by line ends; empty if there is none."""
    rows = weighed(page)
    weights = [w for _, w in rows]
    sums = block_sums(weights, window)
    if not any(sums):
        return ""
    least = max(1, min(threshold * max(sums), ENOUGH))
    kept, i = [], 0
    while i < len(rows):
        if not weights[i] or sums[i] < least:
            i += 1
            continue
        start = i                     # the surge, moved up over lines of weight
        while start and weights[start - 1]:
            start -= 1
        dive = i
        while dive < len(rows) and sums[dive]:
            dive += 1
        kept += [text for text, _ in rows[start:dive] if text]
        i = dive
    return "\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without ``html_col``, plus ``text`` and ``n_chars`` (its code points).

    Null or empty html, or a page without main text: empty text, 0.  Rows are
    taken one by one, so repeated rows give repeated results.  An empty table
    gives an empty result.  Columns named ``text`` or ``n_chars`` are replaced.
    """
    others = [c for c in pages.columns if c not in (html_col, text_col, "n_chars")]
    rows = pages.select(*others, F.col(html_col).cast("string").alias("_html"))
    names = [*others, text_col, "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names)

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.drop("_html").schema)
    return rows.mapInArrow(run, schema + f"`{text_col}` string, n_chars bigint")


def op3_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
