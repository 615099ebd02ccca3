"""Main text of web pages by tag-path ratios.

Text lies at root-to-leaf tag paths. Of every path a page's text length and punctuation are added
up and fused into one score; a path takes over part of what lies next to it, in the same element
or right after it, and paths above a threshold hold content. Elements that are by themselves no
article text (scripts, navigation, footers, forms' fields, hidden ones) are not read at all; every
other part of a page has to win by its paths. A name such as ``sidebar`` only lowers the scores of
the paths through it, so it takes out no part that most of the text goes through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Elements whose text is never article text.
DROPPED = frozenset(
    "script style noscript template svg math iframe object embed canvas audio video map head title "
    "nav header footer aside button select option textarea input label fieldset dialog menu".split()
)
# Elements whose content is raw text up to their end tag.
RAW = frozenset("script style noscript template textarea title iframe".split())
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that begin and end a line of text.
BLOCK = frozenset(
    "html body address article aside blockquote br caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements that end an open <p>, and what an open element of a kind ends.
ENDS_P = BLOCK - {"br", "html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}
ENDED_BY_PEER = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ROOTS = ("article", "main")
# Elements that are text, so that their classes tell no paths apart.
TEXT_ELEMENTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption td th br hr".split())
# The parts that are no article text, as class, id or role name them; some go on,
# as in ``commentlist`` or ``advertising``.
PART_WORDS = frozenset("menu nav header footer notice ad ads form".split())
PART_BEGINNINGS = ("sidebar", "advert", "comment")
# What a path through such a name, or through a form, keeps of its score.
NAMED_SHARE = 0.05
# A path's score reaches others in the same element, less with each step between them.
STEP_SHARE = 0.7
STEPS = 5
# The share of the best score from which a block is content.
CONTENT_SHARE = 0.2
# What text right before content at a path below its own takes over from it.
LEAD_SHARE = 0.25
# A marked article is left only for so much more text, and so many characters, outside.
MORE_OUTSIDE = 3
LEAST_OUTSIDE = 200

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)>?",
    re.S,
)
NAMES = re.compile(
    r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
    re.I,
)
SPLIT_NAMES = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
DIGITS = re.compile(r"[0-9]+")
# White space of HTML, and the marks that running text has.
HTML_SPACE = re.compile(r"\s+")
MARKS = re.compile(r"[.,;:!?…。，、；：！？؟،]")


class Path:
    """A tag path, shared by all elements at it: its last element's label and the path before."""

    __slots__ = ("label", "outer", "inner", "share")

    def __init__(self, label: str, outer: Path | None, named: bool):
        self.label = label
        self.outer = outer
        self.inner: dict[str, Path] = {}
        self.share: float = (outer.share if outer else 1.0) * (NAMED_SHARE if named else 1.0)

    def below(self, label: str, named: bool) -> Path:
        if label not in self.inner:
            self.inner[label] = Path(label, self, named)
        return self.inner[label]

    def labels(self) -> tuple[str, ...]:
        path, out = self, []
        while path.outer is not None:
            out.append(path.label)
            path = path.outer
        return tuple(reversed(out))


@dataclass(eq=False, slots=True)
class Element:
    """An open element; phrases share path and block with the block element around them."""

    tag: str
    path: Path
    block: Element | None
    outer: Element | None = None
    left_out: bool = False
    links: int = 0
    roots: frozenset[str] = frozenset()


@dataclass(eq=False, slots=True)
class Block:
    """Text between two borders of block elements, in one of them."""

    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def attributes_of(text: str) -> tuple[bool, str, bool]:
    """Whether an element is hidden, its class, id and role, and whether these name a part."""
    label, named = "", False
    if not text or text.isspace():
        return False, label, named
    for name, value in NAMES.findall(text):
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, label, named
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True, label, named
        elif name != "aria-hidden":
            label += f" {name}={DIGITS.sub('', value)}"
            words = SPLIT_NAMES.split(CAMEL.sub(" ", value).lower())
            named = named or any(w in PART_WORDS or w.startswith(PART_BEGINNINGS) for w in words)
    return False, label, named


class Page:
    """Blocks of text in page order, read in one pass: every step looks at a few elements only."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        root = Element("", Path("", None, False), None)
        root.block = root
        self.open: list[Element] = [root]
        # Places in ``open`` of each tag's elements, and of all block elements.
        self.places: dict[str, list[int]] = {}
        self.block_places: list[int] = [0]
        self.left_out = 0
        self.block: Block | None = None
        self._read(html)

    def _say(self, raw: str) -> None:
        if self.left_out or not raw:
            return
        inner = self.open[-1]
        if self.block is None:
            self.block = Block(inner.block)
            self.blocks.append(self.block)
        self.block.parts.append(raw)
        if inner.links:
            self.block.linked += len(raw.strip())

    def _close_to(self, place: int) -> None:
        while len(self.open) > place:
            element = self.open.pop()
            self.places[element.tag].pop()
            self.left_out -= element.left_out
            if element.block is element:
                self.block_places.pop()
                self.block = None

    def _last(self, tags) -> int:
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=-1)

    def _end(self, tag: str) -> None:
        place = self._last((tag,))
        # An end tag of a phrase doesn't reach out of its block.
        if place > 0 and (tag in BLOCK or tag in DROPPED or place > self.block_places[-1]):
            self._close_to(place)
        if tag in BLOCK:
            self.block = None

    def _begin(self, tag: str, attributes: str) -> None:
        if tag in ENDS_P and self.open[self.block_places[-1]].tag == "p":
            self._close_to(self.block_places[-1])
        if tag in ENDED_BY_PEER:
            ended, borders = ENDED_BY_PEER[tag]
            place = self._last(ended)
            if place > self._last(borders):
                self._close_to(place)
        if tag in BLOCK:
            self.block = None
        if tag in VOID:
            return
        outer = self.open[-1]
        hidden, label, named = attributes_of(attributes)
        # The header of an article may hold its heading.
        left_out = tag in DROPPED and not (tag == "header" and outer.roots)
        left_out = left_out or hidden and tag not in ("html", "body", "main")
        element = Element(tag, outer.path, outer.block, outer.block, left_out, outer.links + (tag == "a"), outer.roots)
        if tag in BLOCK:
            named = (named or tag == "form") and tag not in ("html", "body", "main")
            element.path = outer.path.below(tag if tag in TEXT_ELEMENTS else tag + label, named)
            element.block = element
            if tag in ROOTS:
                element.roots = outer.roots | {tag}
            self.block_places.append(len(self.open))
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(element)
        self.left_out += left_out

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            found = TOKEN.search(html, at)
            if found is None:
                self._say(html[at:])
                break
            if found.start() > at:
                self._say(html[at : found.start()])
            at = found.end()
            closing, tag, attributes = found.group(1), found.group(2), found.group(3)
            if tag is None:
                if found.group().startswith("<![CDATA["):
                    self._say(found.group()[9:].removesuffix("]]>").replace("&", "&amp;"))
                continue
            tag = tag.lower()
            if closing:
                self._end(tag)
            elif tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = stop.end() if stop else end
            elif not (attributes.rstrip().endswith("/") and tag in ("svg", "path", "use")):
                self._begin(tag, attributes)


def said(block: Block) -> str:
    """Text of a block: references decoded, white space as one space, trimmed."""
    return HTML_SPACE.sub(" ", unescape("".join(block.parts))).strip()


Texts = list[tuple[Block, str]]


def path_scores(blocks: Texts) -> dict[Path, float]:
    """Score of every tag path: its unlinked text times the marks of punctuation in a block of it.

    Both are added up over the page, so a path needs text and sentences; a path through an
    element whose name says that it is beside the article keeps a share.
    """
    length: dict[Path, int] = {}
    marks: dict[Path, int] = {}
    count: dict[Path, int] = {}
    for block, text in blocks:
        path = block.element.path
        unlinked = max(0, len(text) - block.linked)
        length[path] = length.get(path, 0) + unlinked
        marks[path] = marks.get(path, 0) + (len(MARKS.findall(text)) if unlinked else 0)
        count[path] = count.get(path, 0) + 1
    return {path: path.share * n * (1.0 + marks[path] / count[path]) for path, n in length.items()}


def block_scores(blocks: Texts) -> list[float]:
    """Score of every block: that of its path, or what reaches it from paths around it.

    The best path with text in an element reaches, a step weaker for each level, what lies deeper
    in the same element: a heading among paragraphs, an item of a list between them. Text right
    before content that lies one level below its own path takes over a share: a lead.
    """
    scores = path_scores(blocks)
    best: dict[Element, float] = {}
    for block, _ in blocks:
        holder = block.element.outer
        if holder is not None:
            best[holder] = max(best.get(holder, 0.0), scores[block.element.path])
    out = []
    for i, (block, _) in enumerate(blocks):
        path = block.element.path
        score, reach, holder = scores[path], STEP_SHARE, block.element.outer
        for _ in range(STEPS):
            if holder is None:
                break
            if holder in best and holder.path.share:
                score = max(score, reach * best[holder] * path.share / holder.path.share)
            reach *= STEP_SHARE
            holder = holder.outer
        if i + 1 < len(blocks):
            after = blocks[i + 1][0].element.path
            if after.outer is path:
                score = max(score, LEAD_SHARE * scores[after])
        out.append(score)
    return out


def marked(blocks: Texts) -> Texts:
    """The blocks in what the page marks as its article, or all, if too much lies outside."""
    chars = [max(0, len(text) - block.linked) for block, text in blocks]
    for root in ROOTS:
        inside = sum(n for n, (block, _) in zip(chars, blocks, strict=True) if root in block.element.roots)
        outside = sum(
            n * block.element.path.share
            for n, (block, _) in zip(chars, blocks, strict=True)
            if root not in block.element.roots
        )
        if inside and (outside < LEAST_OUTSIDE or outside <= MORE_OUTSIDE * inside):
            return [(block, text) for block, text in blocks if root in block.element.roots]
    return blocks


def main_text(html: str) -> str:
    """The article of a page, blocks joined by line ends.

    What the page marks as its article (``article``, else ``main``) is looked at alone, unless it
    has little text beside the rest. Blocks whose score reaches ``CONTENT_SHARE`` of the best one
    are taken, without those that are mostly links.
    """
    blocks = marked([(block, text) for block in Page(html).blocks if (text := said(block))])
    scores = block_scores(blocks)
    limit = CONTENT_SHARE * max(scores, default=0.0)
    return "\n".join(
        text
        for (block, text), score in zip(blocks, scores, strict=True)
        if score >= limit and (block.linked * 2 < len(text) or not block.linked)
    )


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """id_col, url_col, text and n_chars (code points) of every page; a page per task and time.

    A null or empty page, and one without article text, has the empty text. Broken markup
    is read as far as it goes: unclosed elements end with what encloses them. Repeated
    rows, null ids and null addresses stay as they are; other columns are not looked at.
    No shuffle.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[id_col, url_col, "text", "n_chars"],
            )

    return pages.select(id_col, url_col, html_col).mapInArrow(
        run,
        f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long",
    )
