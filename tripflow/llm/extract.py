"""Main text of web pages by tag-path ratios.

Text nodes are gathered per root-to-leaf path of block elements. A path's text ratio is its unlinked characters per
node, its punctuation ratio the punctuation marks per node. Both are smoothed along the order in which
paths first occur, multiplied, and cut at a share of their spread: paths above it are content.

A page with one `article` (or one `main`, where that has no single article) has said what its main element is, and all
its blocks stay. On other pages the main element is the smallest one that holds nearly all content nodes; of its blocks,
those on content paths stay, and so do headings and runs of one path that are not mostly links; runs of links go.

Elements and roles that are never article text (navigation, forms, scripts) are left out. Names are a prior that never
drops an ancestor of the main element. Inside a marked article only a class that is a listed word (`ad`) counts, and
ids of comment threads: other ids are anchors. On other pages an element goes whose class or id begins with a listed
word (`comments-area`, `site-header`), unless it holds nearly all text; one with a listed word further on
(`content-search`) only where none of its paths is content.

Defined results: a null, empty or textless page gives the empty string; broken markup is read as far as it goes (an
unclosed element ends with its parent); repeated rows give equal results; an empty table gives an empty
table; the added column is `text`, all others come from `keep`.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Element kinds of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes iframe noembed".split())
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SECTIONS = frozenset("html body div section article main table tbody tr td center".split())
# What is never article text, by element, role and the words of class and id.
NEVER = frozenset(
    "head nav aside footer noscript template svg button select fieldset menu dialog canvas object video audio".split()
)
NEVER_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NEVER_NAME = re.compile(
    r"^(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alerts?|popup|modal|newsletter|subscri\w+"
    r"|share|sharing|social|sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|footer|comments?|commentlist|replies"
    r"|respond|disqus|related|recommended|widget|pagination|pager|login|signup|search|skip|gdpr)$"
)
OUTER_NAME = re.compile(r"^(?:header|masthead|topbar)$")
# Words that say where something is, before the word that says what it is; ids of comment threads.
PLACE_WORDS = frozenset("site page global reader user visitor top bottom left right main primary secondary wp js".split())
THREAD_ID = re.compile(r"^(?:comments?|commentlist|disqus\w*|respond|replies)$")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORDS = re.compile(r"[^A-Za-z0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？；：]")
_SPACE = re.compile(r"[ \t\n\r\f\v\x85\xa0  -     　]+")

SMOOTHING = np.array([0.25, 0.5, 0.25])
THRESHOLD = 0.2
MAIN_SHARE = 0.8
WHOLE, PART = 2, 1


def _suspect(value: str, outer: bool) -> int:
    """WHOLE where a token of a class or id begins with a listed word, PART where one has it further on."""
    listed = lambda w: bool(NEVER_NAME.match(w) or (outer and OUTER_NAME.match(w)))
    found = 0
    for token in value.split():
        words = [w for w in _WORDS.split(token) if w]
        while len(words) > 1 and words[0] in PLACE_WORDS:
            del words[0]
        if words and listed(words[0]):
            return WHOLE
        found = PART if any(map(listed, words)) else found
    return found


def _marked(kind: str, value: str) -> int:
    """The same inside a marked article: whole classes, and the ids of comment threads."""
    if kind == "id":
        return WHOLE if THREAD_ID.match(value) else 0
    return WHOLE if any(NEVER_NAME.match(t) for t in value.split()) else 0


class Page:
    """The block elements of a page and its text nodes, from one pass over the markup."""

    def __init__(self, source: str):
        self.tag, self.parent, self.dropped, self.path = ["#"], [-1], [False], [""]
        # Per text node: element, block number, decoded text, whether it is linked.
        self.nodes: list[tuple[int, int, str, bool]] = []
        # Elements with a listed name, and those inside of `article` or `main` by what holds there.
        self.named: dict[int, int] = {}
        self.inner: dict[int, int] = {}
        self._read(source)
        self.sole = self._sole_article()
        if self.named or self.inner:
            self._drop_named()
        self.content = self.content_paths()

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        up = stack[-1]
        inside_article = any(self.tag[e] in ("article", "main") for e in stack)
        drop = self.dropped[up] or tag in NEVER or (tag == "header" and not inside_article)
        # A form goes as a named element does: some pages are one form as a whole.
        label, named, inner = tag, WHOLE if tag == "form" else 0, WHOLE if tag == "form" else 0
        if attributes and not drop:
            for kind, *values in _NAMES.findall(attributes):
                value = next((v for v in values if v), "").lower()
                kind = kind.lower()
                if kind == "role":
                    drop = drop or value in NEVER_ROLE
                    continue
                found = 0
                # The id of a heading is an anchor.
                if tag not in ("html", "body", "article", "main") and not (kind == "id" and tag in HEADINGS):
                    found = _suspect(value, not inside_article)
                    found = 0 if found == PART and tag in HEADINGS else found
                if tag not in ("html", "body", "main"):
                    inner = max(inner, _marked(kind, value) if inside_article and tag not in HEADINGS else 0)
                named = max(named, found)
                if kind == "class":
                    label = f"{label}.{value}"
                elif kind == "id" and found:
                    label = f"{label}#{value}"
        if named and not drop:
            self.named[len(self.tag)] = named
        if inner and not drop:
            self.inner[len(self.tag)] = inner
        self.tag.append(tag)
        self.parent.append(up)
        self.dropped.append(drop)
        self.path.append(f"{self.path[up]}/{label}")
        stack.append(len(self.tag) - 1)

    def _read(self, source: str) -> None:
        stack, at, block, links = [0], 0, 0, 0
        end = len(source)
        while at < end:
            found = _TAG.search(source, at)
            until = found.start() if found else end
            if until > at:
                self.nodes.append((stack[-1], block, entities.unescape(source[at:until]), links > 0))
            if not found:
                break
            at = found.end()
            close, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
            if not tag:
                continue
            tag = tag.lower()
            if tag in RAW and not close:
                finish = re.compile(rf"</{re.escape(tag)}[^>]*>?", re.IGNORECASE).search(source, at)
                at = finish.end() if finish else end
                continue
            if tag in INLINE:
                links = max(0, links + (-1 if close else 1)) if tag == "a" else links
                if tag == "img":
                    continue
                continue
            if tag == "br":
                self.nodes.append((stack[-1], block, " ", False))
                continue
            block += 1
            links = 0
            if tag in VOID:
                continue
            if close:
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == tag:
                        del stack[k:]
                        break
                continue
            # A block element ends an open paragraph; list items and table parts end their neighbours.
            if self.tag[stack[-1]] == "p":
                stack.pop()
            ends = CLOSES.get(tag)
            while ends and len(stack) > 1 and self.tag[stack[-1]] in ends:
                stack.pop()
            if attributes.endswith("/"):
                continue
            self._open(stack, tag, attributes)

    def _drop_named(self) -> None:
        """Drop what its name marks, but no ancestor of the main element and no content under a merely similar name."""
        weight = [0] * len(self.tag)
        for element, _, text, linked in self.nodes:
            if not self.dropped[element] and not linked:
                weight[element] += len(text.strip())
        for e in range(len(self.tag) - 1, 0, -1):
            weight[self.parent[e]] += weight[e]
        if self.sole > 0:
            # What lies outside is not read; inside, only what holds there counts.
            self._drop({e for e in self.inner if self._within(e, self.sole)})
            return
        spared = set()
        at = next((e for e in range(1, len(self.tag)) if self.tag[e] in ("article", "main") and not self.dropped[e]), -1)
        if at < 0:
            spared = {e for e in self.named if weight[e] >= MAIN_SHARE * weight[0] > 0}
        while at > 0:
            spared.add(at)
            at = self.parent[at]
        self._drop({e for e, how in self.named.items() if how == WHOLE and e not in spared})
        partly = {e for e, how in self.named.items() if how == PART and e not in spared and not self.dropped[e]}
        if partly:
            content = self.content_paths()
            holds = [False] * len(self.tag)
            for element, _, text, _ in self.nodes:
                if not self.dropped[element] and text.strip() and self.path[element] in content:
                    holds[element] = True
            for e in range(len(self.tag) - 1, 0, -1):
                holds[self.parent[e]] |= holds[e]
            self._drop({e for e in partly if not holds[e]})

    def _within(self, element: int, top: int) -> bool:
        """Whether an element lies inside another one."""
        while element > top:
            element = self.parent[element]
            if element == top:
                return True
        return False

    def _sole_article(self) -> int:
        """The one article of a page, or its one `main` where that has no single article; -1 where there is neither."""
        filled = [False] * len(self.tag)
        for element, _, text, _ in self.nodes:
            if not self.dropped[element] and text.strip():
                filled[element] = True
        for e in range(len(self.tag) - 1, 0, -1):
            filled[self.parent[e]] |= filled[e]

        def outermost(tag: str, top: int) -> list[int]:
            found: list[int] = []
            for e in range(top + 1, len(self.tag)):
                if self.tag[e] == tag and filled[e] and not self.dropped[e] and (top == 0 or self._within(e, top)):
                    if not (found and self._within(e, found[-1])):
                        found.append(e)
            return found

        mains = outermost("main", 0)
        articles = outermost("article", mains[0] if len(mains) == 1 else 0)
        if len(articles) == 1:
            return articles[0]
        return mains[0] if len(mains) == 1 else -1

    def _drop(self, tops: set[int]) -> None:
        for e in range(1, len(self.tag)):
            self.dropped[e] = self.dropped[e] or e in tops or self.dropped[self.parent[e]]

    def content_paths(self) -> set[str]:
        """Paths whose smoothed, fused ratio reaches the threshold."""
        order: dict[str, list[float]] = {}
        for element, _, text, linked in self.nodes:
            if not self.dropped[element] and text.strip():
                row = order.setdefault(self.path[element], [0, 0, 0])
                row[0] += 1
                if not linked:
                    row[1] += len(text)
                    row[2] += len(_PUNCTUATION.findall(text))
        if not order:
            return set()
        table = np.array(list(order.values()), float)
        ratios = table[:, 1:] / table[:, :1]
        smooth = np.column_stack([np.convolve(np.pad(r, 1, mode="edge"), SMOOTHING, "valid") for r in ratios.T])
        fused = smooth[:, 0] * (1 + smooth[:, 1]) * (ratios[:, 0] > 0)
        cut = THRESHOLD * max(fused.std(), fused.max() / 2)
        return {p for p, score in zip(order, fused, strict=True) if score >= cut and score > 0}

    def main_element(self) -> int:
        """The smallest sectioning element that holds nearly all characters of content nodes."""
        if self.sole > 0:
            return self.sole
        content = self.content
        weight, titled = [0] * len(self.tag), [False] * len(self.tag)
        for element, _, text, _ in self.nodes:
            if not self.dropped[element] and self.path[element] in content:
                weight[element] += len(text)
        for e in range(len(self.tag) - 1, 0, -1):
            weight[self.parent[e]] += weight[e]
            titled[e] |= self.tag[e] == "h1" and not self.dropped[e]
            titled[self.parent[e]] |= titled[e]
        children: dict[int, list[int]] = {}
        for e in range(1, len(self.tag)):
            children.setdefault(self.parent[e], []).append(e)
        at = 0
        while self.tag[at] not in ("article", "main"):
            inner = [e for e in children.get(at, ()) if self.tag[e] in SECTIONS and weight[e] >= MAIN_SHARE * weight[at] > 0]
            if not inner or (titled[at] and not titled[inner[0]]):
                break
            at = inner[0]
        return at

    def main_text(self) -> str:
        top = self.main_element()
        inside = [False] * len(self.tag)
        for e in range(top, len(self.tag)):
            inside[e] = e == top or (self.parent[e] >= top and inside[self.parent[e]])
        # Per block: its text, whether it stays on its own, its path, and its linked and unlinked characters.
        blocks: list[tuple[str, bool, str, int, int]] = []
        current, parts, stays, path, size = -1, [], False, "", [0, 0]

        def close() -> None:
            text = _SPACE.sub(" ", "".join(parts)).strip(" ")
            if text:
                blocks.append((text, stays, path, size[1], size[0]))

        for element, block, text, linked in self.nodes:
            if not inside[element] or self.dropped[element]:
                continue
            if block != current:
                close()
                current, parts, stays, path, size = block, [], False, self.path[element], [0, 0]
            parts.append(text)
            stays = stays or self.path[element] in self.content or self.tag[element] in HEADINGS
            size[linked] += len(text.strip())
        close()
        if not self.content or self.sole > 0:
            return "\n".join(text for text, *_ in blocks)
        kept: list[str] = []
        for (own, _), run in groupby(blocks, key=lambda x: (x[1], "" if x[1] else x[2])):
            run = list(run)
            # What lies beside content stays with it, unless a run of one path is mostly links.
            if own or sum(x[3] for x in run) <= sum(x[4] for x in run):
                kept += [x[0] for x in run]
        return "\n".join(kept)


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns `keep` and `text`, one row per page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(x) for x in batch.column(html).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), text], [*keep, "text"])

    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField("text", T.StringType())])
    return pages.select(*dict.fromkeys((*keep, html))).mapInArrow(run, schema)
