"""Contract patterns in Java form: regular expressions, replacements and date formats.

Contract expressions follow the syntax of linear-time engines: Unicode classes by
default, ``$`` only at the very end, no look-around and no back-references.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from sluicegate.errors import ContractError
from sluicegate.functions.ambiguity import exponential

# d: only \n ends a line; U: \d \w \s \b cover Unicode.
JAVA_FLAGS = "(?dU)"

# Bracket class names (ASCII only) and long names of general categories.
POSIX_CLASSES = {
    "alnum": "0-9A-Za-z",
    "alpha": "A-Za-z",
    "ascii": r"\x00-\x7F",
    "blank": r"\t ",
    "cntrl": r"\x00-\x1F\x7F",
    "digit": "0-9",
    "graph": "!-~",
    "lower": "a-z",
    "print": " -~",
    "punct": r"!-/:-@\[-`{-~",
    "space": r"\t\n\x0B\f\r ",
    "upper": "A-Z",
    "word": "0-9A-Za-z_",
    "xdigit": "0-9A-Fa-f",
}
CATEGORY_NAMES = {
    "letter": "L",
    "uppercase_letter": "Lu",
    "lowercase_letter": "Ll",
    "titlecase_letter": "Lt",
    "modifier_letter": "Lm",
    "other_letter": "Lo",
    "mark": "M",
    "nonspacing_mark": "Mn",
    "number": "N",
    "decimal_number": "Nd",
    "letter_number": "Nl",
    "punctuation": "P",
    "symbol": "S",
    "currency_symbol": "Sc",
    "math_symbol": "Sm",
    "separator": "Z",
    "space_separator": "Zs",
    "other": "C",
    "control": "Cc",
}

_PROPERTY = re.compile(r"\\([pP])\{(\^?)([^}]+)\}")
_CODE_POINT = re.compile(r"\\(?:[xuU]\{([0-9A-Fa-f]+)\}|U([0-9A-Fa-f]{8}))")
_POSSESSIVE = re.compile(r"(?:[*+?]|\{\d+(?:,\d*)?\})\+")
_POSIX = re.compile(r"\[:(\^?)([a-z]+):\]")
_GROUP = re.compile(r"\(\?(?:P?<([A-Za-z_]\w*)>|([imsxUuR-]+)([:)])|(<?[=!]))")
_REFERENCE = re.compile(r"\$(?:\$|\{([^}]*)\}|(\w+))", re.ASCII)

# Letters that mean something after a backslash.
ESCAPED_LETTERS = frozenset("aftnrvxupPdDsSwWbBAz")

# Date directives and their Java letters.
DATE_DIRECTIVES = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%j": "DDD",
    "%b": "MMM",
    "%h": "MMM",
    "%B": "MMMM",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%p": "a",
    "%F": "yyyy-MM-dd",
    "%T": "HH:mm:ss",
    "%R": "HH:mm",
    "%D": "MM/dd/yy",
    "%.f": "[.SSSSSSSSS]",
    "%.3f": ".SSS",
    "%.6f": ".SSSSSS",
    "%.9f": ".SSSSSSSSS",
    "%%": "%",
}
_DIRECTIVE = re.compile(r"%(?:\.[369]?f|.)", re.DOTALL)

# Directives for numbers of one width, and those that stand for several.
NUMBER_WIDTHS = {"%Y": 4, "%m": 2, "%d": 2, "%H": 2, "%M": 2, "%S": 2}
COMBINED_DIRECTIVES = {"%F": "%Y-%m-%d", "%T": "%H:%M:%S", "%R": "%H:%M"}


# A group that is nothing but one unbounded repeat, itself repeated without bound: (a+)+, (?:\d*)*.
_NESTED_REPEAT = re.compile(
    r"\((?:\?:|\?P?<\w+>)?(?:\\.|\[(?:\\.|[^\]\\])+\]|[^\\()\[\]|])(?:[*+]|\{\d+,\})\??\)(?:[*+]|\{\d+,\})"
)


def java_regex(pattern: str) -> str:
    """Translate a contract expression; raise on what linear-time engines reject, and on expressions that those take
    in their stride but Java may need hours for: a repeat directly over a repeat, and whatever can match the same
    characters in a number of ways that grows exponentially before something that may fail."""
    if _NESTED_REPEAT.search(pattern):
        raise ContractError(f"regular expression {pattern!r}: an unbounded repeat of an unbounded repeat")
    out: list[str] = []
    in_class = 0
    multi_line = False
    at = 0
    while at < len(pattern):
        char = pattern[at]
        if char == "\\":
            token, at = _escape(pattern, at)
            out.append(token)
            continue
        if in_class:
            posix = _POSIX.match(pattern, at)
            if posix:
                out.append(_posix(posix))
                at = posix.end()
                continue
            in_class += (char == "[") - (char == "]")
        elif char == "[":
            in_class = 1
            out.append("[")
            at += 1
            # A bracket right after the opening (or its negation) stands for itself.
            if pattern[at : at + 1] == "^":
                out.append("^")
                at += 1
            if pattern[at : at + 1] == "]":
                out.append(r"\]")
                at += 1
            continue
        elif _POSSESSIVE.match(pattern, at):
            raise ContractError(f"regular expression {pattern!r}: a quantifier follows a quantifier")
        elif char == "$" and not multi_line:
            out.append(r"\z")
            at += 1
            continue
        elif char == "(" and pattern.startswith("(?", at):
            group = _GROUP.match(pattern, at)
            if not group or group[4]:
                raise ContractError(f"regular expression {pattern!r}: group is not supported")
            if group[2]:
                multi_line = "m" in group[2].split("-")[0]
            out.append(_open_group(pattern, group))
            at = group.end()
            continue
        out.append(char)
        at += 1
    if exponential(pattern):
        raise ContractError(f"regular expression {pattern!r}: a repeat can match the same text in many ways")
    return JAVA_FLAGS + "".join(out)


def _escape(pattern: str, at: int) -> tuple[str, int]:
    for form, render in ((_PROPERTY, _property), (_CODE_POINT, _code_point)):
        found = form.match(pattern, at)
        if found:
            return render(found), found.end()
    if at + 1 == len(pattern):
        raise ContractError(f"regular expression {pattern!r} ends in a backslash")
    escaped = pattern[at + 1]
    if (escaped.isalpha() and escaped not in ESCAPED_LETTERS) or escaped.isdigit():
        raise ContractError(f"regular expression {pattern!r}: \\{escaped} is not supported")
    # In Java \v is a class of line ends, not the vertical tab.
    return r"\x0B" if escaped == "v" else "\\" + escaped, at + 2


def _property(found: re.Match) -> str:
    letter, negated, name = found.groups()
    if negated:
        letter = "P" if letter == "p" else "p"
    category = CATEGORY_NAMES.get(name.strip().lower().replace(" ", "_"))
    if category is None:
        category = name if len(name) <= 2 else "Is" + name
    return f"\\{letter}{{{category}}}"


def _code_point(found: re.Match) -> str:
    return f"\\x{{{found[1] or found[2]}}}"


def _posix(found: re.Match) -> str:
    negated, name = found.groups()
    if name not in POSIX_CLASSES:
        raise ContractError(f"unknown character class [:{name}:]")
    return f"[{negated}{POSIX_CLASSES[name]}]"


def _open_group(pattern: str, group: re.Match) -> str:
    name, flags, tail, _ = group.groups()
    if name:
        return f"(?<{_java_name(name)}>"
    if "U" in flags or "R" in flags:
        raise ContractError(f"regular expression {pattern!r}: flags U and R are not supported")
    return "(?" + flags.replace("u", "U") + tail


def _java_name(name: str) -> str:
    """Java group names hold letters and digits only."""
    return re.sub(r"_", "U95", name) if not name.startswith("_") else "g" + name.replace("_", "U95")


def java_replacement(text: str, pattern: str) -> str:
    """Translate a replacement: ``$1``, ``${name}``, ``$$``; an unknown group is empty."""
    names, count = _groups(pattern)
    out: list[str] = []
    at = 0
    for found in _REFERENCE.finditer(text):
        out.append(_literal_replacement(text[at : found.start()]))
        at = found.end()
        group = found[1] if found[1] is not None else found[2]
        if group is None:
            out.append(r"\$")
        elif group.isdigit():
            # Java reads further digits as part of the number only while such a group exists.
            out.append(f"${int(group)}" if int(group) <= count else "")
        elif group in names:
            out.append(f"${{{_java_name(group)}}}")
    out.append(_literal_replacement(text[at:]))
    return _separate_digits(out)


def _groups(pattern: str) -> tuple[set[str], int]:
    names = {name for name in re.findall(r"\(\?P?<([A-Za-z_]\w*)>", pattern)}
    bare = re.sub(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]", "", pattern, flags=re.DOTALL)
    return names, len(re.findall(r"\((?!\?)", bare)) + len(re.findall(r"\(\?P?<(?![=!])", bare))


def _literal_replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", r"\$")


def _separate_digits(parts: list[str]) -> str:
    joined = ""
    for part in parts:
        if part[:1].isdigit() and re.search(r"(?<!\\)\$\d+\Z", joined):
            part = "\\" + part
        joined += part
    return joined


def java_date_format(directives: str) -> str:
    """Translate ``%Y-%m-%d`` style formats; every field takes its full width."""
    out: list[str] = []
    at = 0
    for found in _DIRECTIVE.finditer(directives):
        out.append(_quoted(directives[at : found.start()]))
        at = found.end()
        if found[0] not in DATE_DIRECTIVES:
            raise ContractError(f"date format {directives!r}: {found[0]} is not supported")
        out.append(DATE_DIRECTIVES[found[0]])
    out.append(_quoted(directives[at:]))
    return "".join(out)


@dataclass(frozen=True)
class NumberLayout:
    """A date format of full-width numbers and fixed text: its shape, and where each number starts."""

    shape: str
    starts: dict[str, int]
    is_iso: bool  # already in the form a cast reads

    @property
    def has_time(self) -> bool:
        return "%H" in self.starts


def number_layout(directives: str) -> NumberLayout | None:
    """The layout of a format that needs no general date parser, or None."""
    for short, full in COMBINED_DIRECTIVES.items():
        directives = directives.replace(short, full)
    shape, starts, at, place = "^", {}, 0, 1
    for found in _DIRECTIVE.finditer(directives):
        width = NUMBER_WIDTHS.get(found[0])
        if width is None or found[0] in starts:
            return None
        literal = directives[at : found.start()]
        shape += re.escape(literal) + rf"\d{{{width}}}"
        place += len(literal)
        starts[found[0]] = place
        place, at = place + width, found.end()
    day, time = {"%Y", "%m", "%d"}, starts.keys() & {"%H", "%M", "%S"}
    if not day <= starts.keys() or (time and not {"%H", "%M"} <= time):
        return None
    is_iso = re.fullmatch("%Y-%m-%d([ T]%H:%M(:%S)?)?", directives) is not None
    return NumberLayout(shape + re.escape(directives[at:]) + r"\z", starts, is_iso)


def has_short_year(directives: str) -> bool:
    return any(found[0] in ("%y", "%D") for found in _DIRECTIVE.finditer(directives))


def _quoted(text: str) -> str:
    text = text.replace("'", "''")
    return re.sub(r"[^\W\d_]+|[\[\]#{}]+", lambda found: f"'{found[0]}'", text)
