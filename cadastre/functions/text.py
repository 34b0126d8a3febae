"""Text cleaning columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters.  Spark's trim() strips only
# blanks, so the set is passed explicitly; btrim() keeps the work in codegen.
WHITE_SPACE = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters after which a word starts, besides white space.
WORD_DELIMITERS = "[](){}/\\|<>!?@\"^#$&~_,.:;*%+-"

# Known spellings of city names and the name each stands for.
CITY_NAMES = {
    "BOGOTA": "Bogota",
    "Bogota": "Bogota",
    "Bogota D.C.": "Bogota",
    "Bogotá": "Bogota",
    "MEDELLIN": "Medellin",
    "Medellin": "Medellin",
    "Medellín": "Medellin",
    "Cali": "Cali",
    "Santiago de Cali": "Cali",
    "Barranquilla": "Barranquilla",
    "B/quilla": "Barranquilla",
}

_DELIMITER_CLASS = "[\\s" + "".join("\\" + c for c in WORD_DELIMITERS) + "]"
_PUNCTUATED = "[\\t\\n\\r" + "".join("\\" + c for c in WORD_DELIMITERS) + "]"
_NOT_LETTER_CLASS = "[^\\p{L}]"


def trim_ws(text: Column) -> Column:
    """Strip all Unicode white space at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for NULL, empty and all-white-space text."""
    return trim_ws(F.coalesce(text, F.lit(""))) == ""


def _capitalise_after(text: Column, boundary_class: str) -> Column:
    # split behind each boundary so that every piece keeps its own delimiter
    pieces = F.split(F.lower(text), f"(?<={boundary_class})")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                               p.substr(F.lit(2), F.length(p)))), "")


def title_words(text: Column) -> Column:
    """Upper-case the first letter of each word, lower-case the rest.

    Words end at white space and at the punctuation of ``WORD_DELIMITERS``.
    Spark's initcap() knows blanks only; it serves the common case and the
    split is evaluated just for values that hold other delimiters.
    """
    return F.when(text.rlike(_PUNCTUATED), _capitalise_after(text, _DELIMITER_CLASS)).otherwise(
        F.initcap(text))


def title_letters(text: Column) -> Column:
    """Title case where any non-letter starts a new word (data-frame library style)."""
    return F.when(text.rlike("[^\\p{L} ]"), _capitalise_after(text, _NOT_LETTER_CLASS)).otherwise(
        F.initcap(text))


def _lookup(text: Column, names: dict[str, str]) -> Column:
    # a literal map is planned as a constant; no join, no shuffle
    flat = [F.lit(x) for pair in names.items() for x in pair]
    return F.try_element_at(F.create_map(*flat), text)


def canonical_city(city: Column, names: dict[str, str] = CITY_NAMES,
                   trim_first: bool = False) -> Column:
    """Map known spellings to one name, title-case everything else.

    By default the raw value is looked up as it stands; ``trim_first`` looks up
    the trimmed value and falls back to letter-wise title case.
    """
    trimmed = trim_ws(city)
    if trim_first:
        return F.coalesce(_lookup(trimmed, names), title_letters(trimmed))
    return F.coalesce(_lookup(city, names), title_words(trimmed))


def canonical_type(kind: Column) -> Column:
    return title_words(trim_ws(kind))


def canonical_status(status: Column) -> Column:
    return F.lower(trim_ws(status))


def fold(text: Column) -> Column:
    """Lower-case, drop combining marks, trim: the form names are compared in."""
    return trim_ws(_strip_accents(F.lower(text)))


def _accent_table() -> tuple[str, str]:
    """Lower-case letters that are one base letter plus combining marks, and that base."""
    accented, base = [], []
    for code in range(0xC0, 0x2000):
        letter = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFD", letter)
                        if not "\u0300" <= c <= "\u036f")
        if letter == letter.lower() and len(plain) == 1 and plain != letter:
            accented.append(letter)
            base.append(plain)
    return "".join(accented), "".join(base)


_ACCENTED, _BASE = _accent_table()


def _strip_accents(text: Column) -> Column:
    # precomposed letters by translate, then any free-standing combining mark
    return F.regexp_replace(F.translate(text, _ACCENTED, _BASE), "[\\u0300-\\u036f]", "")


def display_name(name: Column) -> Column:
    """``random_forest`` -> ``Random Forest``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))
