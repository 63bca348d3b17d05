"""Cuts of a text at which a tokenizer that splits words before merging always has a boundary too."""

from __future__ import annotations

import re

# A blank between two characters that are no white space; where each blank of a text is one, or stands at an
# end of the text, plain splitting does. Python's idea of white space includes
# Unicode's, so a cut is never made next to something that a tokenizer would join to the blank.
_CUT = re.compile(r" (?<=\S )(?=\S)")
_ODD = re.compile(r" (?:\s|(?<=\s ))")
_TAIL = "".join(sorted("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))


# Patterns begin with the character they look for, which is found far quicker than what must stand before it.
# A line end between two characters that are no white space is a token of its own, or none.
_LINE_END = re.compile(r"\n(?<=\S\n)(?=\S)")


def lines(text: str) -> list[str]:
    """The text cut at single line ends; what follows one has no blank before it."""
    return _LINE_END.split(text) if "\n" in text else [text]


def cut(text: str) -> list[str]:
    """The text cut at single blanks; every piece but the first has lost the blank before it."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def word_and_tail(chunk: str) -> tuple[str, str]:
    """A word of Latin letters and the ASCII marks after it, or the whole chunk and nothing.

    Letters and marks never share a token, so the two parts can be encoded apart. Apostrophes stay with
    the word, since they may open a contraction. So does a letter whose lower case brings a mark of its own (İ).
    """
    word = chunk.rstrip(_TAIL)
    if 0 < len(word) < len(chunk) and word.lstrip(" ").lower().isalpha() and word[-1] < "ɐ":
        return word, chunk[len(word) :]
    return chunk, ""
