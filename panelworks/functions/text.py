"""Text and lookup expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: the characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def is_blank(x: Column) -> Column:
    """True if only Unicode white space is left (plain ``trim`` drops spaces only).

    The first character decides for nearly all texts, so it is looked at first.
    """
    opens_white = F.ascii(x).isin(*[ord(c) for c in WHITE_SPACE])
    return (x == "") | (opens_white & (F.trim(x, F.lit(WHITE_SPACE)) == ""))


def error_category(x: Column) -> Column:
    """Text before the first colon."""
    return F.substring_index(x, ":", 1)


def lookup(x: Column, table: Mapping[str, object]) -> Column:
    """Value for ``x`` in a small literal table, null if there is none.

    The table is part of the program, so its size is known and it becomes a
    constant of the plan rather than a join.
    """
    if not table:
        return F.lit(None)
    pairs = [F.lit(item) for entry in table.items() for item in entry]
    return F.create_map(*pairs)[x]


def label_of(code: Column, labels: Mapping[str, str]) -> Column:
    """Label for a code; unknown codes pass through unchanged."""
    return F.coalesce(lookup(code, labels), code) if labels else code
