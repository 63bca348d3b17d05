"""Expressions that a backtracking matcher may need hours for are refused, others pass."""

import random
import re
import time

import pytest

from sluicegate.errors import ContractError
from sluicegate.functions.ambiguity import exponential
from sluicegate.functions.patterns import java_regex

SLOW = [
    r"(a|a)*$", r"(a+)+$", r"(\w+\s?)*$", r"^(a|ab|b)*c", r"(a?b?)*$", r"(x+x+)+y", r"^(\d+|\w+)*!", r"(.*)*z",
    r"^(([a-z])+.)+[A-Z]([a-z])+$", r"(a|aa)+$", r"([a-zA-Z]+)*$", r"(\p{L}|\w)*;", r"([^,]*,?)*$", r"(?i)(a|A)*$",
    r"(a{1,9})*b", r"^(.*?,){3}(x|x)+$", r"(é|\p{Ll})+$", r"(a|b|[ab])*c", r"(a+){2,}$", r"(\s*\s*)*b", r"(ж|[^a])*$",
    r"(\x{436}|[^a])*$", r"([[:alpha:]]|[a-c])+\b;", r"([\w&&[^\d]]|x)+$", r"(\.|[.])*x", r"(?P<n>(?:a|b|ab)+)-",
]
FAST = [
    r"^\d+$", r"^(\d{1,3}\.){3}\d{1,3}$", r"^(a|b)*$", r"^[A-Z]{2}\d{4}$", r"(a+b)+$", r"^\w+@\w+(\.\w+)+$", r"^(\w+\s)*\w+$",
    r"a*a*$", r"(ab|cd)+$", r"(a|b)*(a|c)*$", r"^[^@]+@[^@]+\.[a-z]{2,}$", r"(\w+\s?)*", r"(a{2})+$", r"(a+){3}$",
    r"^(?:[^\",]*|\"[^\"]*\")(?:,(?:[^\",]*|\"[^\"]*\"))*$", r"(\p{Greek}|\p{Latin})+$", r"(\p{Lu}\p{Ll}*)+$",
    r"^\d{5}(-\d{3})?$", r"(ab+)*$", r"^(0|[1-9]\d*)(\.\d+)?$", "", r"()*$", r"[[:digit:]&&[13579]]+|[]a]+x$",
    r"(?P<n>[a-z]+)-(?<m>\d+)$", r"^\s*\S+\s*$", r"(ж|[^ж])*$", r"([[:upper:]]|[[:lower:]])+$", r"(a|b\b)+$",
    "|".join(f"w{i}" for i in range(200)), "(" + "|".join(f"w{i:03}" for i in range(150)) + ")+$", r"\d{1,4000}$",
]


@pytest.mark.parametrize("pattern", SLOW)
def test_slow_expressions_are_refused(pattern):
    assert exponential(pattern)
    with pytest.raises(ContractError):
        java_regex(pattern)


@pytest.mark.parametrize("pattern", FAST)
def test_others_pass_quickly(pattern):
    started = time.perf_counter()
    assert not exponential(pattern)
    assert time.perf_counter() - started < 2


def ways(pattern, text):
    """Seconds that a backtracking matcher takes to fail."""
    started = time.perf_counter()
    re.search(pattern, text)
    return time.perf_counter() - started


def test_chance_expressions_that_pass_do_not_blow_up():
    """Python's matcher backtracks as Java's does; expressions that pass must not double with each character."""
    chance = random.Random(11)

    def part(depth):
        kind = chance.randrange(6 if depth else 2)
        if kind < 2:
            return chance.choice(["a", "b", "[ab]", "c", "a", "."])
        if kind == 2:
            return part(depth - 1) + part(depth - 1)
        if kind == 3:
            return f"(?:{part(depth - 1)}|{part(depth - 1)})"
        return f"(?:{part(depth - 1)}){chance.choice(['*', '+', '?', '{2}', '{1,3}'])}"

    tested = 0
    while tested < 400:
        pattern = f"^{part(3)}(?:{part(2)})*{part(1)}!$"
        if exponential(pattern):
            continue
        tested += 1
        for text in ("a" * 24, "ab" * 12, "abc" * 8):
            assert ways(pattern, text) < 0.5, pattern
