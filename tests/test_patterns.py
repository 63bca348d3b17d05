import pytest
from frames import broken, clean_with

from sluicegate.errors import ContractError
from sluicegate.functions.patterns import java_date_format, java_regex, java_replacement, number_layout


def matches(spark, pattern, given):
    return [not bad for bad in broken(spark, "string", given, {"rule": "regex", "pattern": pattern})]


def test_dollar_is_the_very_end(spark):
    assert matches(spark, r"^\d+$", ["12", "12\n", "12x"]) == [True, False, False]


def test_dollar_in_a_class_or_escaped_stays(spark):
    assert matches(spark, r"^[$]\$x$", ["$$x", "x"]) == [True, False]


def test_line_mode(spark):
    assert matches(spark, r"(?m)^b$", ["a\nb\nc", "ab"]) == [True, False]


def test_dot_excludes_only_newline(spark):
    assert matches(spark, "^a.b$", ["a\rb", "a b", "a\nb"]) == [True, True, False]


def test_unicode_classes(spark):
    assert matches(spark, r"^\d+$", ["١٢", "12"]) == [True, True]
    assert matches(spark, r"^\w+$", ["ação", "a b"]) == [True, False]
    assert matches(spark, r"(?i)^É$", ["é"]) == [True]


def test_ascii_bracket_classes(spark):
    assert matches(spark, "^[[:digit:]_]+$", ["1_2", "١"]) == [True, False]
    assert matches(spark, "^[^[:^alpha:]]$", ["a", "1"]) == [True, False]
    assert matches(spark, r"^[]a]+$", ["]a", "b"]) == [True, False]


def test_properties_and_code_points(spark):
    assert matches(spark, r"^\p{Alphabetic}\p{Greek}\p{Lu}\pL$", ["aβÇx", "1βÇx"]) == [True, False]
    assert matches(spark, r"^\p{^Letter}\u{1F600}$", ["1😀", "a😀"]) == [True, False]


def test_named_groups(spark):
    assert matches(spark, r"^(?P<first_part>a)(?<b>b)$", ["ab"]) == [True]


def test_escapes(spark):
    assert matches(spark, r"^\x41\u0042\U00000043\.\-\/$", ["ABC.-/"]) == [True]
    assert matches(spark, r"^\v$", ["\x0b", "\n"]) == [True, False]
    assert matches(spark, r"^a+?b*?c??[+]+\++$", ["abc++"]) == [True]


@pytest.mark.parametrize("pattern", ["a++", "a*+", "a?+", "a{2}+", "a{1,}+", r"\Za", r"\Qa\E", r"\h", r"\R", r"\0"])
def test_refused_where_java_means_something_else(pattern):
    with pytest.raises(ContractError):
        java_regex(pattern)


@pytest.mark.parametrize("pattern", [r"(a)\1", "(?=a)", "(?!a)", "(?<=a)b", "(?<!a)b", "(?U)a+", "[[:nope:]]", "a\\"])
def test_rejected(pattern):
    with pytest.raises(ContractError):
        java_regex(pattern)


def test_replacements(spark):
    def replaced(old, new, text):
        return clean_with(spark, "string", [text], {"op": "replace", "old": old, "new": new})[0]

    assert replaced("(a)(b)", "$2$1", "abab") == "baba"
    assert replaced("(?P<x_y>a)b", "${x_y}-$$", "ab") == "a-$"
    assert replaced("a", r"\n", "a") == r"\n"
    assert replaced("(a)", "${1}0", "a") == "a0"
    assert replaced("(a)", "$1a|$9|$", "a") == "|" + "|$"


def test_replacement_leaves_group_counts_to_real_groups():
    assert java_replacement("$1", r"\(a\)[(]") == ""
    assert java_replacement("$1", r"(?:x)(a)") == "$1"


def test_number_layouts():
    layout = number_layout("%d/%m/%YT%T")
    assert layout.starts == {"%d": 1, "%m": 4, "%Y": 7, "%H": 12, "%M": 15, "%S": 18} and layout.has_time
    assert not number_layout("%Y%m%d").has_time
    for general in ("%d/%m/%y", "%d %B %Y", "%Y-%m", "%Y-%m-%d %H", "%Y-%m-%d%d", "%Y-%m-%d %S", "%Y-%m-%d %H:%M%.f"):
        assert number_layout(general) is None


def test_date_formats():
    assert java_date_format("%Y-%m-%dT%H:%M:%S%.3f") == "yyyy-MM-dd'T'HH:mm:ss.SSS"
    assert java_date_format("%d de %B") == "dd 'de' MMMM"
    with pytest.raises(ContractError):
        java_date_format("%Q")


@pytest.mark.parametrize("pattern", ["(a+)+$", r"^(?:\d*)*x", "([ab]+){2,}", r"(?P<n>\w+)*"])
def test_repeats_of_repeats_are_refused(pattern):
    with pytest.raises(ContractError):
        java_regex(pattern)


@pytest.mark.parametrize("pattern", ["(a+b)+", "(a{2})+", "(a+)?", "(a+){3}", r"\(a+\)+", "(ab+)*"])
def test_other_repeats_stay(pattern):
    assert java_regex(pattern)
