"""Column helpers with the string semantics that evaluation parsers assume.

Patterns written for Unicode-aware engines need flags in Java: ``d`` (only a line feed ends a
line), ``U`` (Unicode classes), ``iu`` (Unicode case folding), ``s`` (dot matches line feeds).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def regex(pattern: str, flags: str = "") -> str:
    """``pattern`` with Unicode semantics; ``flags`` among i, s, m."""
    return f"(?dU{flags}{'u' if 'i' in flags else ''}){pattern}"


def strip(c: Column) -> Column:
    """Trim all Unicode white space, not only spaces."""
    return F.regexp_replace(c, regex(r"^\s+|\s+\z"), "")


def rstrip(c: Column) -> Column:
    """Trim all Unicode white space at the end."""
    return F.regexp_replace(c, regex(r"\s+\z"), "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def found(c: Column, pattern: str, group: int = 1, flags: str = "") -> Column:
    """The first match's group; NULL without a match."""
    p = regex(pattern, flags)
    return F.when(c.rlike(p), F.regexp_extract(c, p, group))


def all_found(c: Column, pattern: str, group: int = 1, flags: str = "") -> Column:
    return F.regexp_extract_all(c, F.lit(regex(pattern, flags)), F.lit(group))


def last_found(c: Column, pattern: str, group: int = 1, flags: str = "") -> Column:
    """The last match's group; NULL without a match."""
    return F.try_element_at(all_found(c, pattern, group, flags), F.lit(-1))


def after_last(c: Column, marker: str) -> Column:
    """What follows the last literal marker; all of it without one."""
    return F.when(F.contains(c, F.lit(marker)), F.substring_index(c, marker, -1)).otherwise(c)


def digit_to_letter(c: Column) -> Column:
    """1 to 5 become A to E; other symbols are upper-cased."""
    up = F.upper(strip(c))
    return F.when(up.isin("1", "2", "3", "4", "5"), F.translate(up, "12345", "ABCDE")).otherwise(up)


def path_pattern(glob: str) -> str:
    """A pattern that matches whole paths as ``glob`` does: * and ? stay within a name, ** spans folders, [!x] negates; hidden names need a dot of their own."""
    import glob as _glob

    return _glob.translate(glob, recursive=True, include_hidden=False, seps="/").removesuffix("\\Z").removesuffix("\\z") + "\\z"


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def quoted(c: Column) -> Column:
    """A Java pattern that matches the column's text literally."""
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
