"""Text, JSON and lookup expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def like_any(c: Column, patterns: Iterable[str]) -> Column:
    """Case-insensitive match of any pattern; NULL text matches nothing."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | c.ilike(p)
    return F.coalesce(hit, F.lit(False))


def first_label(c: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Label of the first LIKE rule that matches, else the text itself."""
    out = None
    for pattern, label in rules:
        out = F.when(c.like(pattern), label) if out is None else out.when(c.like(pattern), label)
    return c if out is None else out.otherwise(c)


def code_label(c: Column, labels: Mapping[int, str]) -> Column:
    """Text for a code, NULL for an unknown one."""
    out = None
    for code, label in labels.items():
        out = F.when(c == code, label) if out is None else out.when(c == code, label)
    return F.lit(None).cast("string") if out is None else out


def parsed_json(c: Column) -> Column:
    """JSON text parsed once, for any number of fields; NULL when malformed."""
    return F.try_parse_json(c)


def field_text(parsed: Column, path: str) -> Column:
    """Field of parsed JSON as text, '' when missing or malformed."""
    return F.coalesce(F.try_variant_get(parsed, path, "string"), F.lit(""))


def split_number(c: Column, separator: str, part: int) -> Column:
    """The n-th part as a number; NULL when there is none or it is no number."""
    return F.try_element_at(F.split(c, separator), F.lit(part)).try_cast("bigint")


def strip_plus(c: Column) -> Column:
    return F.regexp_replace(c, r"^\++|\++$", "")


def phone_plus7(c: Column, drop_spaces: bool = False) -> Column:
    """``+7…`` form: a leading 7 gets '+', anything else gets '+7' in front.

    ``drop_spaces`` also removes spaces inside numbers that start with 7.
    """
    bare = strip_plus(c)
    trimmed = F.trim(bare)
    with_seven = F.replace(bare, F.lit(" "), F.lit("")) if drop_spaces else trimmed
    return F.when(F.left(trimmed, F.lit(1)) != "7", F.concat(F.lit("+7"), trimmed)).otherwise(
        F.concat(F.lit("+"), with_seven)
    )
