"""Main text of HTML pages by two passes over their blocks (operator 11).

A page is read once, tag by tag, into blocks: the text between two block-level tags, with its share of link text and
the containers around it. The first pass decides blocks by what they hold:

- blocks in containers that are never an article (``BAD_ELEMENTS``; classes, ids and roles with a word of ``BAD_WORDS``) go;
- blocks that are mostly links go; so do, outside an article element, those with a copyright sign;
- long blocks with many stop words stay, and so do, inside an article element, all long ones and headings.

What is left, short blocks without links above all, is ambiguous. The second pass gives them the label of the nearest decided
neighbour on either side; if both are as near and differ, stop words decide. Article elements (or else ``main``) bound
both the kept text and the neighbours, if they hold at least as much text as the good blocks around them.

Each page is a row of its own, so there is no shuffle and a task holds a slice of a few megabytes or one page. All steps
take time in proportion to the page, unclosed tags, quotes and comments included.

Defined cases. A null or empty page has the text "" and 0 characters; so has a page without any text to keep. Very long
pages are read whole. Equal rows give equal rows. An empty table gives an empty result. Further columns are carried along;
those named like a result are replaced.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import slices

SHORT = 70                 # characters below which a block alone says little
LONG = 200
STOP_SHARE = 0.3           # stop words among the words of running text
LINK_SHARE = 0.5           # link characters from which on a block of an article is a list of links
LINK_SHARE_OUTSIDE = 0.2

# Frequent words of running text in English, German, French and Spanish.
STOP_WORDS = frozenset("""
a about after all also an and any are as at be been but by can for from had has have he her his if in into is it its more
not of on one or our out she so some than that the their them there they this to up was we were what when which who will with you
aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich im ist
man mit nach nicht noch nur oder sich sie sind so über um und uns vom von vor war was wenn wie wir wird zu zum zur
au aux avec ce cette ces dans de des du elle en est et il ils je la le les leur mais ne nous on ont ou où par pas plus pour
qu que qui sa se ses son sont sur un une vous y
al como con del donde el ella ellos era es esta este fue hay las lo los más me mi muy no nos para pero por
porque que se ser si sin sobre su sus también te todo un una y ya
""".split())

# Elements whose text is no article, elements that hold none, elements that are read as raw text.
BAD_ELEMENTS = frozenset(
    "head nav footer aside form select option button textarea template noscript iframe object svg math menu dialog canvas audio video".split())
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_ELEMENTS = frozenset("script style title textarea iframe xmp noembed noframes".split())
BLOCK_ELEMENTS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td textarea tfoot th
thead tr ul head template noscript iframe object svg math button canvas audio video""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element of the left kind that is still open ends where one of the right begins directly inside it.
CLOSED_BY = {"p": BLOCK_ELEMENTS, **{h: HEADINGS for h in HEADINGS}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "option": frozenset(["option"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}

# Words of class, id and role that mark what is around an article, and words before them that take that back.
BAD_WORDS = frozenset("""
ad ads adbox adsbygoogle adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent
contentinfo cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay
pager pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup skip social sponsor sponsored
sponsors subscribe subscription toolbar tracking widget widgets complementary search alert""".split())
NEGATIONS = frozenset(["has", "with", "no", "without", "hide"])
# Words that say nothing; an id marks its element only if it has no others ("comments-list", but not "related-work").
NEUTRAL_WORDS = frozenset("""
area article bar block body bottom box container content form group header inner item items left list main outer page panel post posts primary right
secondary section site slot text thread top unit wrap wrapper x""".split())
#: An article element is marked by these alone: comments are often marked up as articles.
BAD_ARTICLES = frozenset(["comment", "comments", "reply", "ad", "advert", "promo", "sponsored", "related", "teaser"])

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)(?:>|\Z)|<(?:[!?]|/[^a-zA-Z])[^>]*+(?:>|\Z)", re.S)
_MARK = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VALUE = re.compile(r"=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]*+)")
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_LINK = re.compile(r"(?<![\w-])href(?![\w-])", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW_ELEMENTS}


class Block:
    """Text of a block with what is known of it; ``label`` is True (kept), False or None (ambiguous)."""

    __slots__ = ("text", "links", "bad", "inside", "element", "label")

    def __init__(self, text: str, links: int, bad: bool, inside: int, element: str):
        self.text, self.links, self.bad, self.inside, self.element, self.label = text, links, bad, inside, element, None

    @property
    def link_share(self) -> float:
        return self.links / len(self.text)

    def stop_share(self, stop_words: frozenset) -> float:
        words = _LETTERS.findall(self.text.lower())
        return sum(w in stop_words for w in words) / len(words) if words else 0.0


def _marked(name: str, attributes: str) -> bool:
    """Whether the attributes say that the element is none of an article."""
    if name in ("html", "body", "main") or name in HEADINGS or not attributes:
        return False
    if name != "article" and (_UNSEEN.search(attributes) or _HIDDEN.search(_VALUE.sub("", attributes))):
        return True
    for attribute, *values in _MARK.findall(attributes):
        for token in "".join(values).split():
            words = [w.lower() for w in _WORD.findall(token)]
            if name == "article":
                if len(words) == 1 and words[0] in BAD_ARTICLES:
                    return True
            elif any(w in BAD_WORDS for w in words) and not NEGATIONS.intersection(words):
                if attribute.lower() != "id" or all(w in BAD_WORDS or w in NEUTRAL_WORDS or w.isdigit() for w in words):
                    return True
    return False


def blocks(page: str) -> list[Block]:
    """The blocks of a page in page order, those without text left out. ``inside`` is 2 in an article, 1 in main, else 0."""
    found: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    open_elements: list[tuple[str, int]] = []      # (name, kind): 0 plain, 1 bad, 2 a form, 3 article, 4 main
    counts: dict[str, int] = {}
    bad = forms = articles = mains = 0
    lifted: list[tuple[int, int]] = []
    link_depth = -1                                # number of open elements where the open link began
    element = ""

    def text(raw: str) -> None:
        if raw:
            pieces.append((raw, link_depth >= 0))

    def flush() -> None:
        if not pieces:
            return
        whole = " ".join(references.unescape("".join(p for p, _ in pieces)).split())
        if whole:
            links = 0
            if any(linked for _, linked in pieces):
                linked = "".join(p if inside else " " for p, inside in pieces)
                links = len(" ".join(references.unescape(linked).split()))
            found.append(Block(whole, min(links, len(whole)), bad + forms > 0, 2 if articles else 1 if mains else 0, element))
        pieces.clear()

    def close() -> None:
        nonlocal bad, forms, articles, mains, link_depth
        name, kind = open_elements.pop()
        counts[name] -= 1
        if kind == 1:
            bad -= 1
        elif kind == 2:
            forms -= 1
        elif kind == 3:
            articles -= 1
        elif kind == 4:
            mains -= 1
            bad, forms = lifted.pop()
        if len(open_elements) < link_depth:
            link_depth = -1

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        if tag is None:
            text(page[at:])
            break
        text(page[at:tag.start()])
        at = tag.end()
        name = tag[2]
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            link_depth = len(open_elements) if not tag[1] and _LINK.search(tag[3]) else -1
        elif name in ("br", "img", "wbr"):
            text(" " if name == "br" else "")
        elif name in BLOCK_ELEMENTS or name in RAW_ELEMENTS:
            if name in BLOCK_ELEMENTS:
                flush()
            if tag[1]:
                if counts.get(name):
                    while open_elements[-1][0] != name:
                        close()
                    close()
                element = open_elements[-1][0] if open_elements else ""
                continue
            if name in RAW_ELEMENTS:
                stop = _RAW_ENDS[name].search(page, at)
                at = stop.start() if stop else end
                closing = _TAG.match(page, at) if stop else None
                at = closing.end() if closing else at
                continue
            if name in VOID_ELEMENTS:
                continue
            while open_elements and name in CLOSED_BY.get(open_elements[-1][0], ()):
                close()
            if name == "main":
                lifted.append((bad, forms))
                bad, forms, mains, kind = 0, 0, mains + 1, 4
            elif name == "form" or (name not in BAD_ELEMENTS and name != "header" and _marked(name, tag[3])):
                kind = 2 if name == "form" and not _marked(name, tag[3]) else 1
                bad, forms = bad + (kind == 1), forms + (kind == 2)
            elif name in BAD_ELEMENTS or name == "header" and (not (articles or mains) or _marked(name, tag[3])):
                bad, kind = bad + 1, 1
            elif name == "article":
                articles, kind = articles + 1, 3
                if forms and not bad:               # the whole page stands in a form
                    forms = 0
                    open_elements[:] = [(n, 0 if k == 2 else k) for n, k in open_elements]
            else:
                kind = 0
            open_elements.append((name, kind))
            counts[name] = counts.get(name, 0) + 1
            element = name
        # Other elements are inline: their tags are no white space.
    flush()
    return found


def _decide(block: Block, trusted: int, stop_words: frozenset) -> bool | None:
    """The label that a block earns by itself, or None."""
    if block.bad or block.inside < trusted:
        return False
    size = len(block.text)
    if trusted:
        if block.link_share > LINK_SHARE:
            return False if block.element in ("li", "dd", "dt", "td") else None
        return True if size >= SHORT or block.element in HEADINGS else None
    if block.link_share > LINK_SHARE_OUTSIDE or ("©" in block.text and size < LONG):
        return False
    if size < SHORT:
        return None
    if block.stop_share(stop_words) >= STOP_SHARE:
        return True if size >= LONG else None
    return None if size < LONG else False


def label(found: list[Block], stop_words: frozenset = STOP_WORDS) -> None:
    """Set the labels of the blocks of a page."""
    usable = [b for b in found if not b.bad]
    outside = {b: sum(len(x.text) for x in usable if x.inside < b and _decide(x, 0, stop_words)) for b in (1, 2)}
    trusted = next((b for b in (2, 1) if any(x.inside >= b for x in usable)
                    and sum(len(x.text) for x in usable if x.inside >= b) >= outside[b]), 0)
    for block in found:
        block.label = _decide(block, trusted, stop_words)
    scope = [b for b in usable if b.inside >= trusted]
    if not trusted and not any(b.label for b in scope):
        # No running text in a known language: length and links alone have to do.
        for block in scope:
            if len(block.text) >= LONG and block.link_share <= LINK_SHARE_OUTSIDE and "©" not in block.text:
                block.label = True
    before: list[tuple[int, bool] | None] = []
    last = None
    for n, block in enumerate(scope):
        last = (n, block.label) if block.label is not None else last
        before.append(last)
    after, next_ = [None] * len(scope), None
    for n in range(len(scope) - 1, -1, -1):
        next_ = (n, scope[n].label) if scope[n].label is not None else next_
        after[n] = next_
    for n, block in enumerate(scope):
        if block.label is not None:
            continue
        left, right = before[n], after[n]
        if left is None and right is None:
            block.label = bool(trusted)
        elif left is None or right is None or left[1] == right[1]:
            block.label = (left or right)[1]
        elif n - left[0] != right[0] - n:
            block.label = left[1] if n - left[0] < right[0] - n else right[1]
        else:
            block.label = block.stop_share(stop_words) >= STOP_SHARE


def main_text(page: str | None, stop_words: frozenset = STOP_WORDS) -> str:
    """The kept blocks of a page, joined by two line ends."""
    found = blocks(page or "")
    label(found, stop_words)
    return "\n\n".join(b.text for b in found if b.label)


def extract_text(df: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars",
                 stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """All rows of ``df`` with the main text of column ``html`` and its number of code points in place of ``html``."""
    known = frozenset(stop_words)
    df = df.drop(*[c for c in df.columns if c in (text, n_chars) and c != html])
    others = [c for c in df.columns if c != html]
    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in others) + f"`{text}` string, `{n_chars}` long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html):
                texts = [main_text(page) for page in part.column(html).to_pylist()]
                rest = [part.column(c) for c in others]
                fields = [part.schema.field(c) for c in others]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    schema=pa.schema([*fields, pa.field(text, pa.string()), pa.field(n_chars, pa.int64())]))

    return df.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{html}`")).mapInArrow(work, schema)


def page_rows(df: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    return extract_text(df.select("page_id", "url", "html"))
