"""Main text of web pages by union-free wrappers of their hosts.

A page is a stream of tokens: containers that open and close, and text slots. Neighbouring repeats are
folded into repeated groups. The streams of a host are aligned one after another with what was inferred so
far: equal tokens stay, a group meets further rounds of itself, and what only one side has becomes optional.
The result is a regular expression without unions, the host's wrapper. Each page is then matched against its
host's expression, which deals its blocks of text to the expression's text slots. Over all pages of the host a slot
gathers evidence: how much text it holds on a page, how much of it is linked, and which texts all of its pages have.
Wrappers are merged within tasks, then over shares of a host, then per host, and the evidence is summed before it
is shuffled, so that no task holds the pages of a host.

On each page the evidence of its slots then decides. Text that all of several different pages have in a slot is
left out. What the slots usually hold, linked text against it, is their weight, and the main text is the least
element that has most of the page's weight. Elements named article or main have one vote: together they are the main
text already with a smaller share. Menus, headers, footers and the like are left out by their elements and names.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate
from typing import Any

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.rows import map_arrow, map_rows, slices
from sluicegate.scratch import written

# Elements of HTML by how their text is treated.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("title script style textarea noscript iframe xmp noembed noframes template".split())
DROPPED = frozenset(
    "head title script style nav footer aside form noscript iframe select button menu svg template textarea object dialog"
    " canvas video audio map xmp noembed noframes".split()
)
MAIN = frozenset(("article", "main"))
CLOSES_ITSELF = frozenset("p li dt dd option tr td th".split())
# Names of boilerplate. The first are also found around whole pages, so that main text within them is kept; the
# others name parts beside it. A class, id or role counts when it consists of these and of PART_WORDS only.
LAYOUT_WORDS = frozenset(
    "banner header notice social share sharing cookie cookies popup modal subscribe newsletter toolbar masthead"
    " disclaimer".split()
)
REPLY_WORDS = frozenset(("comment", "comments", "disqus"))
BESIDE_WORDS = REPLY_WORDS | frozenset(
    "ad ads advert advertisement sidebar nav navbar topnav navigation menu footer promo sponsored sponsor related breadcrumb"
    " breadcrumbs widget".split()
)
BOILERPLATE_WORDS = LAYOUT_WORDS | BESIDE_WORDS
PART_WORDS = frozenset(
    "the top bottom left right main primary secondary global site page mobile desktop sticky fixed inner outer small"
    " list lists area section box block bar item items link links button buttons icon icons form group panel row"
    " container wrapper wrap holder slot unit posts post articles stories media user reader thread body title text"
    " div id js consent v x px".split()
)
# What stands beside main text may also be named after it.
OWNER_WORDS = frozenset("article blog content entry story".split())
# How strongly text is dropped: by layout names, by names of what stands beside, by elements that never hold any.
KEPT, LAYOUT, BESIDE, NEVER = range(4)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*+>?|<\?[^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|href)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.I)
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_WORDS = re.compile(r"[a-z]+")
# Streams whose alignment would need more cells than this are taken as optional wholes between the tokens that both
# have just once.
CELLS = 1 << 20
# Different pages that show that a text stays the same.
SEVERAL = 3
# The share of a page's weight that its main text has at least, and the one that suffices where it is named so.
MOST, NAMED_SO = 0.65, 0.3


@dataclass
class Element:
    name: str
    label: str
    dropped: int
    main: bool
    reply: bool
    first: int = 0  # the first of its blocks


@dataclass
class Page:
    """Tokens of a page's structure; its blocks of text: dropped, main, characters in links, text; and the ranges of
    blocks that its elements hold, if two or more."""

    tokens: list[str] = field(default_factory=list)
    blocks: list[tuple[bool, bool, int, str]] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)

    def has_main(self) -> bool:
        return any(main and not dropped for dropped, main, _, _ in self.blocks)

    def dumps(self) -> str:
        return json.dumps([self.tokens, self.blocks, self.spans], ensure_ascii=False)

    @classmethod
    def loads(cls, text: str) -> Page:
        return cls(*json.loads(text))


def _named(values: str) -> frozenset[str]:
    """The words of boilerplate among the names, each taken as a whole."""
    found: set[str] = set()
    for value in values.split():
        words = set(_WORDS.findall(value))
        own = words & BOILERPLATE_WORDS
        if words <= BOILERPLATE_WORDS | PART_WORDS or own and own <= BESIDE_WORDS and words <= own | PART_WORDS | OWNER_WORDS:
            found |= own
    return frozenset(found)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in _NAMED.finditer(text)}


def _names(attributes: dict[str, str]) -> str:
    return " ".join(attributes.get(key, "") for key in ("class", "id", "role"))


def _hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or _HIDING.search(attributes.get("style", "")) is not None


def _element(name: str, attributes: str, above: Element | None) -> Element:
    named = _attributes(attributes)
    values = _names(named)
    main = name in MAIN or named.get("role") == "main"
    boilerplate = _named(values) if values.strip() else frozenset()
    dropped, inherited = KEPT, above.dropped if above else KEPT
    if _hidden(named) or name in DROPPED and name != "form":
        dropped = NEVER
    elif name == "form":
        dropped = LAYOUT
    elif main:
        # Main text stays main within layout, and the one main element of a page also within anything so called.
        if inherited == LAYOUT or inherited == BESIDE and not name == "article":
            inherited = KEPT
    elif name not in ("html", "body"):
        if not boilerplate.isdisjoint(BESIDE_WORDS):
            dropped = BESIDE
        elif boilerplate or name == "header" and not (above and above.main):
            dropped = LAYOUT
    reply = name == "article" and not boilerplate.isdisjoint(REPLY_WORDS)
    label = name + "".join(f".{word}" for word in _WORDS.findall(values))
    if above is None:
        return Element(name, label, dropped, main, reply)
    return Element(name, label, max(dropped, inherited), main or above.main, reply or above.reply)


def read_page(html: str | None) -> Page:
    """Broken markup is read as browsers do: unclosed elements end with what holds them.

    Articles that are named comments are dropped, unless the page has no other main text. Inline elements that are
    hidden or named as boilerplate are dropped with what they hold, at most to the end of the element around them.
    """
    html, page, stack, held, at = html or "", Page(), [], [], 0
    replies: list[int] = []
    linked = 0  # characters in links since the last block
    link: int | None = None  # depth of the element that holds an open link
    silent: list[str] = []  # open inline elements from a dropped one on
    silent_at = 0

    def say(text: str) -> None:
        nonlocal linked
        if not silent:
            held.append(text)
            if link is not None:
                linked += len(" ".join(text.split()))

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            top = stack[-1] if stack else Element("", "", KEPT, False, False)
            page.tokens.append("#")
            if top.reply and not top.dropped:
                replies.append(len(page.blocks))
            page.blocks.append((top.dropped > KEPT or top.reply, top.main, min(linked, len(text)), text))
        linked = 0

    def close(count: int) -> None:
        nonlocal link
        for _ in range(count):
            element = stack.pop()
            page.tokens.append("/" + element.label)
            span = (element.first, len(page.blocks))
            if span[1] - span[0] > 1 and (not page.spans or page.spans[-1] != span):
                page.spans.append(span)
        if link is not None and len(stack) < link:
            link = None
        if len(stack) < silent_at:
            silent.clear()

    while at < len(html):
        token = _TOKEN.search(html, at)
        say(entities.unescape(html[at : token.start() if token else len(html)]))
        if token is None:
            break
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        closing, attributes = token[1] or token[4], token[3] if token[2] else token[6]
        if name in INLINE:
            if closing:
                if name in silent:
                    del silent[len(silent) - 1 - silent[::-1].index(name) :]
                elif name == "a":
                    link = None
            elif silent:
                silent.append(name)
            elif attributes:
                named = _attributes(attributes)
                if named and name not in VOID and (_hidden(named) or _named(_names(named))):
                    silent.append(name)
                    silent_at = len(stack)
                elif name == "a" and "href" in named:
                    link = len(stack)
            continue
        if name == "br":
            say(" ")
            continue
        flush()
        if closing:
            depth = next((i for i, e in enumerate(reversed(stack), 1) if e.name == name), 0)
            close(depth)
            continue
        if name in VOID:
            continue
        if stack and stack[-1].name in CLOSES_ITSELF and (stack[-1].name == name or stack[-1].name == "p"):
            close(1)
        element = _element(name, attributes, stack[-1] if stack else None)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        element.first = len(page.blocks)
        stack.append(element)
        page.tokens.append(element.label)
    flush()
    close(len(stack))
    if replies and not page.has_main():
        for place in replies:
            _, *rest = page.blocks[place]
            page.blocks[place] = (False, *rest)
    return page


# Expressions: a token is a string, a group is ["+", [...]] (once or more) or ["?", [...]] (once or not).
Expression = list[Any]


def _key(item: Any) -> str:
    return item if isinstance(item, str) else json.dumps(item)


def folded(items: Sequence[Any]) -> Expression:
    """Neighbouring repeats as repeated groups: the shortest repeat that ends at each place, from the left."""
    out: Expression = []
    keys: list[str] = []
    for item in items:
        out.append(item)
        keys.append(_key(item))
        for size in range(1, min(8, len(out)) + 1):
            body = out[-size:]
            if len(out) > size and out[-size - 1] == ["+", body]:
                del out[-size:], keys[-size:]
                break
            if len(out) >= 2 * size and keys[-size:] == keys[-2 * size : -size] and not (size == 1 and body[0] == "#"):
                del out[-2 * size :], keys[-2 * size :]
                out.append(["+", body])
                keys.append(_key(out[-1]))
                break
    return out


def _optional(items: Expression) -> Expression:
    if not items:
        return []
    if len(items) == 1 and not isinstance(items[0], str) and items[0][0] == "?":
        return list(items)
    return [["?", list(items)]]


def _anchors(one: list[str], other: list[str]) -> list[tuple[int, int]]:
    """Places of tokens that both have exactly once, in common order."""
    counts = Counter(one), Counter(other)
    places = {key: i for i, key in enumerate(one) if counts[0][key] == counts[1][key] == 1}
    chosen: list[tuple[int, int]] = []
    for j, key in enumerate(other):
        if key in places and (not chosen or places[key] > chosen[-1][0]):
            chosen.append((places[key], j))
    return chosen


def aligned(one: Expression, other: Expression) -> Expression:
    """One expression that covers both."""
    if one == other:
        return list(one)
    if (len(one) + 1) * (len(other) + 1) <= CELLS:
        return _aligned(one, other)
    out, i, j = [], 0, 0
    for a, b in [*_anchors([*map(_key, one)], [*map(_key, other)]), (len(one), len(other))]:
        left, right = one[i:a], other[j:b]
        small = (len(left) + 1) * (len(right) + 1) <= CELLS
        out += _aligned(left, right) if small else _optional(left) + _optional(right)
        if a < len(one):
            out.append(one[a])
        i, j = a + 1, b + 1
    return out


def _bare(item: Any) -> Any:
    while not isinstance(item, str) and item[0] == "?":
        if len(item[1]) != 1:
            break
        item = item[1][0]
    return item


def _aligned(one: Expression, other: Expression) -> Expression:
    """Least cost: what only one side has costs its length, rounds of a group cost nothing."""
    n, m = len(one), len(other)
    a, b = [_key(_bare(x)) for x in one], [_key(_bare(x)) for x in other]
    whole = [_key(x) for x in one], [_key(x) for x in other]

    def rounds(bare: list[str], whole: list[str], at: int, group: Any) -> int:
        """How many items from ``at`` on are one round of the group; 0 if they are none. Only a lone item may be optional."""
        if isinstance(group, str) or group[0] != "+":
            return 0
        body = [_key(x) for x in group[1]]
        items = bare if len(body) == 1 else whole
        return len(body) if items[at : at + len(body)] == body else 0

    cost = [[0] * (m + 1) for _ in range(n + 1)]
    # How far both sides go, and 1 where the other side's item is kept.
    step = [[(0, 0, 0)] * (m + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        for j in range(m, -1, -1):
            if i == n and j == m:
                continue
            options = []
            if i < n and j < m:
                if a[i] == b[j]:
                    options.append((cost[i + 1][j + 1], (1, 1, 0)))
                more = rounds(b, whole[1], j, _bare(one[i]))
                if more:
                    options.append((cost[i + 1][j + more], (1, more, 0)))
                more = rounds(a, whole[0], i, _bare(other[j]))
                if more:
                    options.append((cost[i + more][j + 1], (more, 1, 1)))
            if i < n:
                options.append((cost[i + 1][j] + 1, (1, 0, 0)))
            if j < m:
                options.append((cost[i][j + 1] + 1, (0, 1, 0)))
            cost[i][j], step[i][j] = min(options)
    out: Expression = []
    i = j = 0
    lone: list[Expression] = [[], []]

    def settle() -> None:
        out.extend(_optional(lone[0]) + _optional(lone[1]))
        lone[0], lone[1] = [], []

    while i < n or j < m:
        di, dj, which = step[i][j]
        if di and dj:
            settle()
            held = other[j] if which else one[i]
            optional = any(not isinstance(x, str) and x[0] == "?" for x in (*one[i : i + di], *other[j : j + dj]))
            bare = _bare(held)
            out += _optional([bare]) if optional else [bare]
        elif di:
            lone[0].append(one[i])
        else:
            lone[1].append(other[j])
        i, j = i + di, j + dj
    settle()
    return folded(out)


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


@dataclass
class Wrapper:
    """The expression of a host's pages, how many these are and how many of them have main text of their own."""

    pages: int
    mains: int
    expression: Expression

    @classmethod
    def of_page(cls, page: Page) -> Wrapper:
        return cls(1, int(page.has_main()), folded(page.tokens))

    def merge(self, other: Wrapper) -> Wrapper:
        return Wrapper(self.pages + other.pages, self.mains + other.mains, aligned(self.expression, other.expression))

    def dumps(self) -> str:
        return json.dumps([self.pages, self.mains, self.expression], ensure_ascii=False)

    @classmethod
    def loads(cls, text: str) -> Wrapper:
        return cls(*json.loads(text))

    def pattern(self) -> str:
        """The expression as text, for people."""

        def shown(items: Expression) -> str:
            parts = [x if isinstance(x, str) else f"({shown(x[1])}){x[0]}" for x in items]
            return " ".join("#text" if x == "#" else x if x[0] in "/(" else f"<{x}>" for x in parts)

        return shown(self.expression)

    def has_main(self) -> bool:
        return self.mains > 0


class Matcher:
    """An expression as an automaton that deals the blocks of a page to text slots.

    Groups are entered and repeated first where the page allows it, so that each page has one reading. Slots are
    numbers of states. State 0 is the end; those without label only lead on.
    """

    def __init__(self, expression: Expression):
        self._labels: list[str | None] = [None]
        self._after: list[tuple[int, ...]] = [()]
        self._start = self._built(expression, 0)
        self._reach: dict[int, dict[str | None, list[int]]] = {}

    def _state(self, label: str | None, after: tuple[int, ...]) -> int:
        self._labels.append(label)
        self._after.append(after)
        return len(self._labels) - 1

    def _built(self, items: Expression, then: int) -> int:
        for item in reversed(items):
            if isinstance(item, str):
                then = self._state(item, (then,))
            elif item[0] == "?":
                then = self._state(None, (self._built(item[1], then), then))
            else:
                again = self._state(None, ())
                first = self._built(item[1], again)
                self._after[again] = (first, then)
                then = first
        return then

    def _reached(self, state: int) -> dict[str | None, list[int]]:
        """States with a label, and the end, that come next from a state on; by label, the preferred ones first."""
        if state not in self._reach:
            found: dict[str | None, list[int]] = {}
            seen, stack = set(), [state]
            while stack:
                at = stack.pop()
                if at in seen:
                    continue
                seen.add(at)
                if at and self._labels[at] is None:
                    stack.extend(reversed(self._after[at]))
                else:
                    found.setdefault(self._labels[at], []).append(at)
            self._reach[state] = found
        return self._reach[state]

    def slots(self, tokens: Sequence[str]) -> list[int] | None:
        """The slot of each text of a page; None for a page that the expression doesn't cover."""
        threads: dict[int, Any] = {self._start: None}
        for token in tokens:
            further: dict[int, Any] = {}
            for state, passed in threads.items():
                for taken in self._reached(state).get(token, ()):
                    further.setdefault(self._after[taken][0], (passed, taken) if token == "#" else passed)
            threads = further
        for state, passed in threads.items():
            if None in self._reached(state):
                slots = []
                while passed is not None:
                    passed, slot = passed
                    slots.append(slot)
                return slots[::-1]
        return None


@dataclass
class Evidence:
    """What the slots of an expression hold over the pages of a host: the weight of each, which is the mean number of
    its characters on pages that have it, linked ones against them; and digests of texts that all of several have."""

    weights: dict[int, float]
    fixed: dict[int, set[int]]


def _spread(page: Page, slots: Sequence[int], evidence: Evidence | None, fixed: set[int]) -> list[float]:
    """The weight of each block: its slot's, shared among the slot's blocks on the page; none for what is left out."""
    left_out = [place in fixed or block[0] for place, block in enumerate(page.blocks)]
    many = Counter(slot for slot, out in zip(slots, left_out) if not out)

    def weight(place: int, slot: int) -> float:
        _, _, linked, text = page.blocks[place]
        return max(0, len(text) - 2 * linked) if evidence is None else evidence.weights.get(slot, 0.0) / many[slot]

    return [0.0 if out else weight(place, slot) for place, (slot, out) in enumerate(zip(slots, left_out))]


def decide(page: Page, slots: Sequence[int] | None = None, evidence: Evidence | None = None) -> str:
    """The main text, by the evidence of the page's slots; a page without a wrapper has only its own."""
    fixed: set[int] = set()
    if slots is None or evidence is None:
        slots, evidence = range(len(page.blocks)), None
    else:
        fixed = {n for n, slot in enumerate(slots) if _digest(page.blocks[n][3]) in evidence.fixed.get(slot, ())}
    weights = _spread(page, slots, evidence, fixed)
    total = sum(weights)
    if page.has_main() and sum(w for w, block in zip(weights, page.blocks) if block[1]) >= NAMED_SO * total:
        return main_text(page, True, set())
    before = [0.0, *accumulate(weights)]
    most = [(end - start, start, end) for start, end in page.spans if before[end] - before[start] >= MOST * total]
    _, start, end = min(most) if most and total else (0, 0, len(page.blocks))
    return main_text(page, False, {n for n in range(len(page.blocks)) if n in fixed or not start <= n < end})


def main_text(page: Page, has_main: bool, fixed: set[int]) -> str:
    texts = []
    for place, (dropped, main, _, text) in enumerate(page.blocks):
        if not dropped and (main if has_main else place not in fixed):
            texts.append(text)
    return " ".join(texts)


def host_of(url: Column) -> Column:
    """The lower-case host of a URL; empty where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


READ = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("page", T.StringType()),
    ]
)
INFERRED = T.StructType([T.StructField("host", T.StringType()), T.StructField("wrapper", T.StringType())])
# A block of text in its slot; ``first`` is 1 for the first of the slot on its page, ``body`` stands for the page's whole text.
SLOTTED = T.StructType(
    [
        T.StructField("host", T.StringType()),
        *(T.StructField(name, T.LongType()) for name in ("slot", "size", "linked", "first", "digest", "body")),
    ]
)
# Shares of a host whose wrappers are merged apart before they meet.
SHARES = 64


def _merge_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge neighbouring wrappers of a host. Holds one at a time; equal expressions align at once."""
    made = pa.schema([(name, pa.string()) for name in INFERRED.names])
    host, merged = None, None
    for batch in batches:
        for piece in slices(batch):
            done = []
            for own, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                found = Wrapper.loads(text)
                if merged is not None and own == host:
                    merged = merged.merge(found)
                else:
                    if merged is not None:
                        done.append(dict(zip(INFERRED.names, (host, merged.dumps()))))
                    host, merged = own, found
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=made)
    if merged is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(INFERRED.names, (host, merged.dumps())))], schema=made)


def read_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host (empty where the URL has none) and the page as read, once."""

    def rule(keys: list, urls: list, hosts: list, documents: list) -> Iterator[tuple]:
        for key, url, host, document in zip(keys, urls, hosts, documents):
            yield key, url, host, read_page(document).dumps()

    hosted = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    return map_rows(hosted, ("page_id", "url", "host", "html"), rule, READ)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """One wrapper per host from all its pages. Pages without host have nothing in common and get none."""
    return wrappers_of(read_pages(pages))


def wrappers_of(read: DataFrame) -> DataFrame:
    """One row per host: merged within tasks, over shares of a host, then per host."""

    def rule(hosts: list, held: list) -> Iterator[tuple]:
        wrappers: dict[str, Wrapper] = {}
        for host, page in zip(hosts, held):
            wrapper = Wrapper.of_page(Page.loads(page))
            wrappers[host] = wrappers[host].merge(wrapper) if host in wrappers else wrapper
        return ((host, wrapper.dumps()) for host, wrapper in wrappers.items())

    found = map_rows(read.where("host <> ''"), ("host", "page"), rule, INFERRED)
    partitions = int(read.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("wrapper"), F.lit(SHARES))
    shares = found.repartition(partitions, "host", share).sortWithinPartitions("host", "wrapper")
    merged = map_arrow(shares, _merge_stream, INFERRED)
    whole = merged.repartition(partitions, "host").sortWithinPartitions("host", "wrapper")
    return map_arrow(whole, _merge_stream, INFERRED)


def _matcher(held: dict[str, Matcher], wrapper: str) -> Matcher:
    if wrapper not in held:
        held[wrapper] = Matcher(Wrapper.loads(wrapper).expression)
    return held[wrapper]


def slotted(read: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Every block that isn't dropped, in the slot that its host's wrapper deals it to."""

    def rule(hosts: list, held: list, texts: list) -> Iterator[tuple]:
        matchers: dict[str, Matcher] = {}
        for host, own, wrapper in zip(hosts, held, texts):
            page = Page.loads(own)
            slots = _matcher(matchers, wrapper).slots(page.tokens)
            kept = [(slot, block) for slot, block in zip(slots or (), page.blocks) if not block[0]]
            body, met = _signed(_digest("\n".join(text for _, (*_, text) in kept))), set()
            for slot, (_, _, linked, text) in kept:
                yield host, slot, len(text), linked, int(slot not in met), _signed(_digest(text)), body
                met.add(slot)

    return map_rows(read.join(wrappers, "host"), ("host", "page", "wrapper"), rule, SLOTTED)


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def evidence_of(blocks: DataFrame) -> DataFrame:
    """host, weights (slot, weight) and fixed (slot, digest): sums, and two counts of different pages.

    A host's row is as long as its wrapper has slots, and as any page of it has blocks.
    """
    own = F.greatest(F.col("size") - 2 * F.col("linked"), F.lit(0))
    weights = blocks.groupBy("host", "slot").agg((F.sum(own) / F.sum("first")).alias("weight"))
    weights = weights.groupBy("host").agg(F.collect_list(F.struct("slot", "weight")).alias("weights"))
    texts = blocks.select("host", "slot", "digest", "body").distinct().groupBy("host", "slot", "digest").agg(F.count("*").alias("having"))
    pages = blocks.select("host", "slot", "body").distinct().groupBy("host", "slot").agg(F.count("*").alias("pages"))
    same = texts.where(F.col("having") >= SEVERAL).join(pages, ["host", "slot"]).where("having = pages")
    fixed = same.groupBy("host").agg(F.collect_list(F.struct("slot", "digest")).alias("fixed"))
    return weights.join(fixed, "host", "left")


TEXTS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its number of characters.

    A null or empty page has the empty text; a page whose URL has no host stands alone. Repeated rows are extracted
    each. Pages are read once and written as read; wrappers and evidence are written too, so that the joins know
    their size: these send them to the tasks when they are small and otherwise split hosts with many pages.
    """
    read = written(read_pages(pages))
    wrappers = written(wrappers_of(read))
    evidence = evidence_of(written(slotted(read, wrappers)))
    known = written(wrappers.join(evidence.select("host", F.to_json(F.struct("weights", "fixed")).alias("evidence")), "host", "left"))
    joined = read.join(known, "host", "left")

    def rule(keys: list, urls: list, held: list, texts: list, told: list) -> Iterator[tuple]:
        matchers: dict[str, Matcher] = {}
        evidences: dict[str, Evidence] = {}
        for key, url, own, wrapper, evidence in zip(keys, urls, held, texts, told):
            page = Page.loads(own)
            if wrapper is None or evidence is None:
                found = decide(page)
            else:
                if evidence not in evidences:
                    evidences[evidence] = _evidence(evidence)
                found = decide(page, _matcher(matchers, wrapper).slots(page.tokens), evidences[evidence])
            yield key, url, found, len(found)

    return map_rows(joined, ("page_id", "url", "page", "wrapper", "evidence"), rule, TEXTS)


def _evidence(text: str) -> Evidence:
    told, fixed = json.loads(text), {}
    for same in told.get("fixed") or ():
        fixed.setdefault(same["slot"], set()).add(same["digest"] % (1 << 64))
    return Evidence({w["slot"]: w["weight"] for w in told["weights"]}, fixed)
