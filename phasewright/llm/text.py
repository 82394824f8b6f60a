"""Column expressions on text that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that separates words, as characters and as a class.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[ \t\n\x0B\f\r]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


_NO_ID = -(2**63)


def id_key(doc_id: Column) -> Column:
    """An id that Python workers get as a plain number: null becomes the least one."""
    return F.coalesce(doc_id.cast("long"), F.lit(_NO_ID))


def id_of(key: Column) -> Column:
    return F.when(key != _NO_ID, key)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Maximal runs without white space, in order; an empty array for a text without any."""
    return F.filter(F.split(whole(text), f"{SPACE_CLASS}+", -1), lambda w: w != "")


def lines(text: Column) -> Column:
    """The text split at each newline; one empty line for a null or empty text."""
    return F.split(whole(text), "\n", -1)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once for each row, also where lambdas inside refer to it."""
    return F.get(F.transform(F.array(value), use), 0)
