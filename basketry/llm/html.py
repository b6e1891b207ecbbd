"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. Regions that hold no article (menus, page headers
and footers, sidebars, forms, adverts, notices, reader comments, by tag name or by their class, id
or role) are not content whatever they say. A class names such a region if its last word does
(``left-sidebar``), or its first before words that only name boxes (``comments-list``); what follows
``--`` is left out, and a word such as ``has`` or ``no`` before it undoes it. Classes of ``main`` and ``article``
say nothing unless all of them do. The first pass decides blocks by link
density, length and stop-word density; blocks inside ``article`` or ``main`` count as content
unless links fill them, and where a page has such a region the rest of it is not content, unless
the rest has more than twice as much text that the rules take for content (teasers). Stop words
decide only where the page shows that its language is in the lists, that is if they are a tenth of
the words of its longer blocks, and never a block whose letters are mostly of another script; all
other long blocks that links do not fill are content. Short blocks stay undecided. In the second pass these take the label of the nearest decided block of
their region, content at a tie; a region without any decided block is content unless the page has
its article elsewhere. If all this leaves nothing, forms and regions named for a page's layout
(search, sidebars, widgets) that hold at least half of the page's text count as wrappers of the article.

Null and empty pages give an empty text. Character references are decoded, white space inside a
block becomes one space, and the blocks are joined by line breaks in page order. Pages are taken
whole, also when they are cut off in mid-tag. Each row is worked on by itself.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.blocks import small_batches

MOST_LINKS = 1 / 3
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.15, 0.3
LISTED = 0.1

# Stop words, and the tags and words that mark regions without content.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can for from had has have he her his if in into is it "
    "its more no not of on one or our she so than that the their them then there they this to up was we were what "
    "when which who will with would you your "
    "au aux avec ce ces dans de des du elle en est et eux il je la le les leur lui mais ne nous on ou par pas pour "
    "que qui sa se ses son sur un une vous "
    "aber als am auch auf aus bei das dem den der des die durch ein eine einen einer er es für hat ich im in ist "
    "mit nach nicht oder sich sie sind und von vor war werden wie wir zu zum zur "
    "al como con de del el ella en es esta este la las lo los mas me mi muy no o para pero por que se si sin sobre "
    "su sus un una y ya".split()
)
RAW_TAGS = "script style textarea title noscript template svg iframe select button object canvas video audio"
CODE_TAGS = frozenset("script style".split())
SKIPPED_TAGS = frozenset("nav header footer aside form menu dialog head".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HINTS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus gdpr login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promos promotion related replies reply respond share sharing sidebar sidebars "
    "signup social sponsor sponsored sponsors subscribe toolbar widget widgets alert footer complementary "
    "contentinfo search".split()
)
QUALIFIERS = frozenset("has have no non not with without".split())
BOXES = frozenset(
    "area bar block body box col column container content form group holder inner item items left link links list "
    "main outer panel region right section slot space title top unit wrap wrapper zone".split()
)
# Marks that name a part of a page's layout, so that a careless page may give them to the whole of it.
LAYOUT = frozenset(
    "menu nav navbar navigation related search share sharing sidebar sidebars social toolbar widget widgets".split()
)
COMMENTS = frozenset("comment comments disqus replies reply respond".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>"""
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|([^<]+|<)",
    re.S,
)
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW_TAGS.split()}
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_OTHER_SCRIPT = re.compile(r"[^\W\d_\u0000-\u024f\u1e00-\u1eff]")
# signs of Chinese, Japanese and Korean, which say as much as two or three letters
_WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")


def _mark(token: str) -> str | None:
    """The hint that a class names, if it does."""
    words = [w for w in re.split(r"[_-]+", token.split("--")[0]) if w]
    if not words or QUALIFIERS & set(words):
        return None
    if words[-1] in HINTS:
        return words[-1]
    rest = (w in BOXES or w.isdigit() for w in words[1:])
    return words[0] if words[0] in HINTS and all(rest) else None


def _marks(name: str, attributes: str) -> set[str]:
    """Hints of a tag's class, id and role."""
    if "=" not in attributes:
        return set()
    tokens = " ".join("".join(m) for m in _MARKS.findall(attributes)).lower().split()
    found = [_mark(token) for token in tokens]
    if name in ("article", "main") and None in found:  # "post comments" is a post
        return set()
    return {mark for mark in found if mark is not None}


class _Block:
    __slots__ = ("text", "links", "inside", "skipped")

    def __init__(self, text: str, links: int, inside: bool, skipped: bool):
        self.text, self.links, self.inside, self.skipped = text, links, inside, skipped


def _cut(page: str, wrappers: frozenset[int] = frozenset()) -> tuple[list[_Block], frozenset[int]]:
    """Blocks with some text, in page order; and the numbers of the forms and layout regions with half of it.

    The regions with the given numbers are entered as if they had no name.
    """
    blocks: list[_Block] = []
    open_tags: list[tuple[str, bool, bool, bool, int]] = []  # name, skipped, by comments, inside an article, number
    count_open: dict[str, int] = {}
    layout: dict[int, tuple[int, int]] = {}  # region number: characters of text before it and up to its end
    endless: set[str] = set()  # raw tags that nothing closes any more
    skipped = comments = inside = False
    parts: list[str] = []
    links = link_depth = size = number = at = 0

    def flush() -> None:
        nonlocal links, size
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append(_Block(text, min(links, len(text)), inside, skipped))
                size += len(text)
            parts.clear()
        links = 0

    def close(k: int) -> None:
        for tag, *_, region in open_tags[k:]:
            count_open[tag] -= 1
            if region in layout:
                layout[region] = (layout[region][0], size)
        del open_tags[k:]

    while token := _TOKEN.match(page, at):
        at = token.end()
        closing, name, attributes, text = token.groups()
        if text is not None:
            parts.append(text)
            if link_depth:
                links += len(text.strip())
            continue
        if name is None:  # comments, broken ends
            continue
        name = name.lower()
        if name == "a":
            link_depth = max(0, link_depth + (-1 if closing else 1))
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in _RAW_ENDS and not closing and not (name == "svg" and attributes.endswith("/")):
            end = None if name in endless else _RAW_ENDS[name].search(page, at)
            if end is not None:
                at = end.end()
            elif name in CODE_TAGS:
                break
            else:
                endless.add(name)
            continue
        if name not in BLOCK_TAGS:
            continue
        flush()
        if name in VOID_TAGS:
            continue
        if name in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6"):
            link_depth = 0
        if closing:
            if count_open.get(name):  # else no search, so that stray ends cost nothing
                k = len(open_tags) - 1
                while open_tags[k][0] != name:
                    k -= 1
                close(k)
        elif name not in ("html", "body"):
            if name == "p" and open_tags and open_tags[-1][0] == "p":
                close(len(open_tags) - 1)
            number += 1
            _, was_skipped, was_comments, was_inside, _ = open_tags[-1] if open_tags else ("", False, False, False, 0)
            marks = _marks(name, attributes)
            soft = name == "form" or bool(marks & HINTS)
            if soft and marks <= LAYOUT and (name == "form" or name not in SKIPPED_TAGS):
                layout[number] = (size, size)
                if number in wrappers:
                    marks, soft = set(), False
            by_comments = was_comments or bool(marks & COMMENTS)
            opens = name in ("article", "main")
            skip = (
                by_comments
                or soft
                or (name in SKIPPED_TAGS and name != "form" and not (name == "header" and was_inside))
                or (was_skipped and not opens)
            )
            open_tags.append((name, skip, by_comments, was_inside or (opens and not skip), number))
            count_open[name] = count_open.get(name, 0) + 1
        _, skipped, comments, inside, _ = open_tags[-1] if open_tags else ("", False, False, False, 0)
    flush()
    close(0)
    return blocks, frozenset(n for n, (low, high) in layout.items() if high > low and 2 * (high - low) >= size)


def _stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def _other_script(text: str) -> bool:
    return 2 * len(_OTHER_SCRIPT.findall(text)) > sum(map(len, _WORD.findall(text)))


def _listed_language(blocks: list[_Block]) -> bool:
    """Whether the longer blocks have as many stop words as texts of the listed languages."""
    words = stops = 0
    for block in blocks:
        if not block.skipped and len(block.text) >= SHORT and block.links <= len(block.text) * MOST_LINKS:
            found = _WORD.findall(block.text.lower())
            words += len(found)
            stops += sum(w in STOP_WORDS for w in found)
    return stops > 0 and stops >= words * LISTED


def _first_pass(block: _Block, has_article: bool, listed: bool) -> bool | None:
    """True for content, False for other text, None if undecided."""
    if block.skipped or (has_article and not block.inside):
        return False
    size = len(block.text)
    if block.links > size * MOST_LINKS:
        return False
    if size < SHORT and not block.text.isascii():
        size += len(_WIDE.findall(block.text))
    if size < SHORT:
        return None
    if block.inside or not listed or _other_script(block.text):
        return True
    share = _stop_share(block.text)
    if share >= STOP_HIGH or (size >= LONG and share >= STOP_LOW):
        return True
    return None if share >= STOP_LOW else False


def _teasers_alone(blocks: list[_Block], listed: bool) -> bool:
    """Whether the text outside ``article`` and ``main`` is so much more that they hold teasers only."""
    held = sum(len(b.text) for b in blocks if b.inside and not b.skipped and b.links <= len(b.text) * MOST_LINKS)
    rest = [b for b in blocks if not b.inside and not b.skipped and _first_pass(b, False, listed)]
    return sum(len(b.text) for b in rest) > 2 * held


def _content(blocks: list[_Block]) -> list[_Block]:
    has_article = any(b.inside and not b.skipped for b in blocks)
    listed = False
    if not has_article or any(not b.inside and not b.skipped and len(b.text) >= SHORT for b in blocks):
        listed = _listed_language(blocks)
        has_article = has_article and not _teasers_alone(blocks, listed)
    labels = [_first_pass(b, has_article, listed) for b in blocks]
    region = [k for k, b in enumerate(blocks) if not b.skipped and (b.inside or not has_article)]
    decided = [k for k in region if labels[k] is not None]
    if not decided:
        return [blocks[k] for k in region]
    kept, at = [], 0
    for k in region:
        while at + 1 < len(decided) and decided[at + 1] <= k:
            at += 1
        near = decided[at : at + 2]
        distance = min(abs(d - k) for d in near)
        if any(labels[d] for d in near if abs(d - k) == distance):
            kept.append(blocks[k])
    return kept


def main_text(page: str | None) -> str:
    blocks, wrappers = _cut(page or "")
    kept = _content(blocks)
    if not kept and wrappers:
        kept = _content(_cut(page, wrappers)[0])
    return "\n".join(b.text for b in kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("_html")
        texts = [main_text(page) for page in batch.column(at).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:at], pa.array(texts, pa.string())], [*batch.schema.names[:at], "text"]
        )


def extract(pages: DataFrame, keep: list[str] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of every page with its main ``text``, which replaces one of that name."""
    small_batches(pages.sparkSession)
    names = [c for c in keep if c != "text"]
    # under names of their own, as a kept column may have the name of the page's
    own = [f"kept_{i}" for i in range(len(names))]
    rows = pages.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, own)), F.col("html").cast("string").alias("_html"))
    return rows.mapInArrow(_extract, rows.drop("_html").schema.add("text", "string")).toDF(*names, "text")
