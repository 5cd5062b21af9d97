"""Line expressions that follow Python's notion of lines and blanks, evaluated in the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# Line breaks besides "\n" and "\r\n", and the blanks, that Python recognises.
OTHER_BREAKS = "\r\x0b\f\x1c\x1d\x1e\x85\u2028\u2029"
BLANK = r"[\s\x1C-\x1F\x85\p{Z}]"

# First characters that decide a line without a pattern: printable ASCII.
_PLAIN = (33, 126)
_MAGIC = (ord("%"), ord("!"))


def unify_breaks(text: Column) -> Column:
    """``text`` with "\n" for every kind of line break."""
    odd = reduce(or_, [F.contains(text, F.lit(mark)) for mark in OTHER_BREAKS])
    flat = F.translate(
        F.replace(text, F.lit("\r\n"), F.lit("\n")), OTHER_BREAKS, "\n" * len(OTHER_BREAKS))
    return F.when(odd, flat).otherwise(text)


def without_last_break(text: Column) -> Column:
    """A final "\n" opens no further line."""
    return F.when(F.endswith(text, F.lit("\n")), F.left(text, F.char_length(text) - 1)).otherwise(
        text)


def split_lines(closed: Column, text: Column) -> Column:
    """Lines of ``closed`` (see above); the empty ``text`` has none."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(closed, "\n", -1))


def _by_first_character(line: Column, plain, pattern: str) -> Column:
    first = F.ascii(F.ltrim(line))
    decided = plain(first) if callable(plain) else F.lit(plain)
    return F.when(first.between(*_PLAIN), decided).otherwise(line.rlike(pattern))


def is_blank(line: Column) -> Column:
    return _by_first_character(line, False, rf"^{BLANK}*\z")


def is_magic(line: Column) -> Column:
    """True for ``%`` magics and ``!`` shell lines."""
    return _by_first_character(
        line, lambda first: first.isin(*_MAGIC), rf"^{BLANK}*[%!]")


def strip_blanks(text: Column) -> Column:
    """Cut blanks from both ends (all Unicode blanks, unlike ``trim``)."""
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+\z", "")
