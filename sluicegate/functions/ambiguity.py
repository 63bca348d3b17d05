"""Whether a backtracking matcher can need time that doubles with every character of a text.

That is so where a part of an expression can go round from some point to the same point in two ways over the same
characters, as in ``(a|a)*$`` or ``(\\w+\\s?)*$``, and the text must still satisfy something behind it. The test builds
the automaton of the expression's positions (one per character or class), with the number of ways from one to the
next, and looks for two different walks over equal characters between the same positions, on pairs of positions.
Counted repeats stand for at most two required and two optional rounds.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

# Characters that stand for all others of their kind.
SAMPLES = [chr(c) for c in range(128)] + list("ÉéǅªµßЖжΩαא漢あ٣²½ⅷ¿—«»€×^¨\u0301\u00a0\u2028\x85\u200b\ue000\U0010ffff🙂")
# Positions from which on the test would take too long; longer expressions pass.
MOST_POSITIONS = 600

_POSIX = re.compile(r"\[:(\^?)(\w+):\]")
_PROPERTY = re.compile(r"\\([pP])(?:\{(\^?)([^}]+)\}|(\w))")
_CODE = re.compile(r"\\(?:[xuU]\{([0-9A-Fa-f]+)\}|x([0-9A-Fa-f]{2})|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8}))")
_COUNT = re.compile(r"\{(\d+)(,(\d*))?\}")
_OPEN = re.compile(r"\((?:\?(?:P?<\w+>|([imsxuUR-]*)([:)])))?")

_KINDS: dict[str, Callable[[str], bool]] = {
    "d": str.isdecimal,
    "w": lambda c: c.isalnum() or c == "_" or unicodedata.category(c).startswith("M"),
    "s": str.isspace,
    "alnum": lambda c: c.isascii() and c.isalnum(),
    "alpha": lambda c: c.isascii() and c.isalpha(),
    "ascii": str.isascii,
    "blank": lambda c: c in "\t ",
    "cntrl": lambda c: c < " " or c == "\x7f",
    "digit": lambda c: c.isascii() and c.isdigit(),
    "graph": lambda c: "!" <= c <= "~",
    "lower": lambda c: "a" <= c <= "z",
    "print": lambda c: " " <= c <= "~",
    "punct": lambda c: "!" <= c <= "~" and not c.isalnum(),
    "space": lambda c: c in "\t\n\x0b\f\r ",
    "upper": lambda c: "A" <= c <= "Z",
    "word": lambda c: c.isascii() and (c.isalnum() or c == "_"),
    "xdigit": lambda c: c in "0123456789abcdefABCDEF",
    "alphabetic": str.isalpha,
    "white_space": str.isspace,
    "letter": str.isalpha,
}
_CONTROLS = {"a": "\a", "f": "\f", "t": "\t", "n": "\n", "r": "\r", "v": "\v"}


class _Alphabet:
    """The samples and the characters that an expression names; a class of characters is a bit for each."""

    def __init__(self, pattern: str):
        codes = (chr(int(next(filter(None, found.groups())), 16)) for found in _CODE.finditer(pattern))
        self.chars = list(dict.fromkeys([*SAMPLES, *pattern, *codes]))
        flags = "".join(found[1] for found in re.finditer(r"\(\?([imsxuUR]*)(?:-[imsxuUR]*)?[:)]", pattern))
        self.folded, self.all = "i" in flags, (1 << len(self.chars)) - 1

    def where(self, holds: Callable[[str], bool]) -> int:
        return sum(1 << n for n, c in enumerate(self.chars) if holds(c))

    def span(self, low: str, high: str) -> int:
        if not self.folded:
            return self.where(lambda c: low <= c <= high)
        return self.where(lambda c: any(len(f) == 1 and low <= f <= high for f in (c, c.lower(), c.upper())))

    def one(self, char: str) -> int:
        return self.span(char, char)

    def named(self, name: str) -> int:
        """The characters with a property: a kind from the table, a general category, or a script."""
        kind = _KINDS.get(name.lower())
        if kind is not None:
            return self.where(kind)
        if len(name) <= 2:
            return self.where(lambda c: unicodedata.category(c).startswith(name))
        return self.where(lambda c: unicodedata.name(c, "").startswith(name.upper().removeprefix("IS")))


# What an expression is made of: ("set", mask), ("mark",), ("cat" | "alt", parts), ("rep", part, least, most).
class _Reader:
    def __init__(self, pattern: str):
        self.pattern, self.at, self.alphabet = pattern, 0, _Alphabet(pattern)

    def alternatives(self) -> tuple:
        parts = [self.sequence()]
        while self.pattern.startswith("|", self.at):
            self.at += 1
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self) -> tuple:
        parts = []
        while self.at < len(self.pattern) and self.pattern[self.at] not in "|)":
            parts.append(self.repeated(self.item()))
        return ("cat", parts)

    def repeated(self, part: tuple) -> tuple:
        while self.at < len(self.pattern):
            char, count = self.pattern[self.at], _COUNT.match(self.pattern, self.at)
            if char in "*+?":
                least, most = {"*": (0, None), "+": (1, None), "?": (0, 1)}[char]
                self.at += 1
            elif count:
                least = int(count[1])
                most = least if count[2] is None else int(count[3]) if count[3] else None
                self.at = count.end()
            else:
                break
            if self.pattern.startswith("?", self.at):  # lazy: the same ways in another order
                self.at += 1
            part = ("rep", part, least, most)
        return part

    def item(self) -> tuple:
        char = self.pattern[self.at]
        if char == "(":
            opened = _OPEN.match(self.pattern, self.at)
            self.at = opened.end()
            if opened[2] == ")":
                return ("cat", [])
            inner = self.alternatives()
            self.at += 1
            return inner
        if char == "[":
            return ("set", self.bracket())
        if char == "\\":
            return self.escape()
        self.at += 1
        if char in "^$":
            return ("mark",)
        return ("set", self.alphabet.all & ~self.alphabet.one("\n") if char == "." else self.alphabet.one(char))

    def escape(self) -> tuple:
        for form, mask in ((_PROPERTY, self.property), (_CODE, self.code)):
            found = form.match(self.pattern, self.at)
            if found:
                self.at = found.end()
                return ("set", mask(found))
        char = self.pattern[self.at + 1 : self.at + 2]
        self.at += 2
        if char in ("d", "w", "s"):
            return ("set", self.alphabet.where(_KINDS[char]))
        if char in ("D", "W", "S"):
            return ("set", self.alphabet.all & ~self.alphabet.where(_KINDS[char.lower()]))
        if char in ("b", "B", "A", "z"):
            return ("mark",)
        return ("set", self.alphabet.one(_CONTROLS.get(char, char)))

    def property(self, found: re.Match) -> int:
        letter, turned, name, short = found.groups()
        held = self.alphabet.named(name or short)
        return self.alphabet.all & ~held if (letter == "P") != (turned == "^") else held

    def code(self, found: re.Match) -> int:
        return self.alphabet.one(chr(int(next(filter(None, found.groups())), 16)))

    def bracket(self) -> int:
        self.at += 1
        turned = self.pattern.startswith("^", self.at)
        self.at += turned
        held, both, first = 0, self.alphabet.all, True
        while self.at < len(self.pattern) and (first or self.pattern[self.at] != "]"):
            first, posix = False, _POSIX.match(self.pattern, self.at)
            if posix:
                named = self.alphabet.named(posix[2])
                held |= self.alphabet.all & ~named if posix[1] else named
                self.at = posix.end()
            elif self.pattern[self.at] == "[":
                held |= self.bracket()
            elif self.pattern.startswith("&&", self.at):
                self.at += 2
                both, held = both & held, 0
            else:
                held |= self.member()
        self.at += 1
        held &= both
        return self.alphabet.all & ~held if turned else held

    def member(self) -> int:
        low = self.single()
        if isinstance(low, int) or not re.match(r"-[^\]\[]", self.pattern[self.at : self.at + 2]):
            return low if isinstance(low, int) else self.alphabet.one(low)
        self.at += 1
        high = self.single()
        return self.alphabet.one(low) | self.alphabet.one("-") | high if isinstance(high, int) else self.alphabet.span(low, high)

    def single(self) -> str | int:
        """One character, or the mask of a class."""
        char = self.pattern[self.at]
        if char != "\\":
            self.at += 1
            return char
        code = _CODE.match(self.pattern, self.at)
        if code:
            self.at = code.end()
            return chr(int(next(filter(None, code.groups())), 16))
        following = self.pattern[self.at + 1 : self.at + 2]
        if following in ("p", "P", "d", "D", "w", "W", "s", "S"):
            return self.escape()[1]
        self.at += 2
        return _CONTROLS.get(following, following)


@dataclass
class _Part:
    """Ways to match nothing, and the positions a match can begin and end with, with the number of ways."""

    empty: int = 0
    first: Counter = field(default_factory=Counter)
    last: Counter = field(default_factory=Counter)


class _Positions:
    def __init__(self) -> None:
        self.masks: list[int | None] = []  # None: a mark between characters
        self.next: defaultdict[int, Counter] = defaultdict(Counter)

    def build(self, node: tuple) -> _Part:
        kind = node[0]
        if kind in ("set", "mark"):
            self.masks.append(node[1] if kind == "set" else None)
            one = Counter({len(self.masks) - 1: 1})
            return _Part(0, one, one.copy())
        if kind == "cat":
            return self._joined([self.build(part) for part in node[1]])
        if kind == "alt":
            parts = [self.build(part) for part in node[1]]
            return _Part(sum(p.empty for p in parts), sum((p.first for p in parts), Counter()), sum((p.last for p in parts), Counter()))
        _, part, least, most = node
        if most is not None:
            inner = _Part(1)
            for _ in range(min(2, most - least)):
                inner = self._joined([self.build(part), inner])
                inner.empty += 1
            return self._joined([*(self.build(part) for _ in range(min(2, least))), inner])
        before = [self.build(part) for _ in range(min(2, least) - 1)]
        loop = self.build(part)
        self._follow(loop.last, loop.first)
        loop.empty = 1 if least == 0 else min(1, loop.empty)
        return self._joined([*before, loop])

    def _joined(self, parts: Iterable[_Part]) -> _Part:
        whole = _Part(1)
        for part in parts:
            self._follow(whole.last, part.first)
            first = whole.first + Counter({p: n * whole.empty for p, n in part.first.items()})
            last = part.last + Counter({p: n * part.empty for p, n in whole.last.items()})
            whole = _Part(whole.empty * part.empty, first, last)
        return whole

    def _follow(self, last: Counter, first: Counter) -> None:
        for p, ways in last.items():
            for q, more in first.items():
                self.next[p][q] += ways * more


def _components(nodes: Iterable, following: Callable) -> dict:
    """The strongly connected component of every node reachable from the given ones."""
    index, low, component, stack = {}, {}, {}, []
    for start in nodes:
        if start in index:
            continue
        index[start] = low[start] = len(index)
        stack.append(start)
        work = [(start, iter(following(start)))]
        while work:
            node, rest = work[-1]
            for other in rest:
                if other not in index:
                    index[other] = low[other] = len(index)
                    stack.append(other)
                    work.append((other, iter(following(other))))
                    break
                if other not in component:
                    low[node] = min(low[node], index[other])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == index[node]:
                    while True:
                        member = stack.pop()
                        component[member] = node
                        if member == node:
                            break
    return component


def exponential(pattern: str) -> bool:
    """Whether matching can take time that doubles with every character; for expressions that are otherwise sound."""
    positions = _Positions()
    reader = _Reader(pattern)
    whole = positions.build(reader.alternatives())
    if len(positions.masks) > MOST_POSITIONS:
        return False
    ring = _components(range(len(positions.masks)), lambda p: positions.next[p])
    # Where a round may end the match, the matcher never has to try the others.
    ends = {ring[p] for p in whole.last}
    inside = {
        p: [q for q in positions.next[p] if ring[q] == ring[p]] for p in range(len(positions.masks)) if ring[p] not in ends
    }
    if any(positions.next[p][q] > 1 for p, following in inside.items() for q in following):
        return True

    def together(pair: tuple[int, int]) -> list[tuple[int, int]]:
        return [
            (a, b)
            for a in inside[pair[0]]
            for b in inside[pair[1]]
            if a == b or ((positions.masks[a] or 0) & (positions.masks[b] or 0))
        ]

    pairs = _components([(p, p) for p in inside if inside[p]], together)
    same = {pairs[p, p] for p in inside if (p, p) in pairs}
    return any(a != b and component in same for (a, b), component in pairs.items())
