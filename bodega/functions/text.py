"""Text cleaning used when rows move from the raw to the clean layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bodega.functions.base import as_col


def clean_text(c: Column | str) -> Column:
    return F.upper(F.trim(as_col(c)))


def clean_email(c: Column | str) -> Column:
    return F.lower(F.trim(as_col(c)))


def clean_phone(c: Column | str) -> Column:
    return F.trim(as_col(c))


def full_name(first: Column | str, surname: Column | str, second: Column | str | None = None) -> Column:
    """Names joined by blanks: NULL when first or surname is NULL, a missing second surname is skipped."""
    parts = [as_col(first), F.lit(" "), as_col(surname)]
    if second is not None:
        parts.append(F.coalesce(F.concat(F.lit(" "), as_col(second)), F.lit("")))
    return F.concat(*parts)


def clean_postal_code(c: Column | str, width: int = 10) -> Column:
    return F.left(F.replace(F.coalesce(as_col(c), F.lit("")), F.lit(" "), F.lit("")), F.lit(width))


def substitute(c: Column | str, old: str, new: str) -> Column:
    return F.replace(clean_text(c), F.lit(old), F.lit(new))


def trimmed_length(c: Column | str) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(as_col(c)))


def sequence_code(prefix: str, number: Column | str, width: int) -> Column:
    """`prefix` plus the last `width` digits of a zero-padded number."""
    padded = F.concat(F.lit("0" * width), as_col(number).cast("string"))
    return F.concat(F.lit(prefix), F.right(padded, F.lit(width)))


def position_of(needle: str, c: Column | str) -> Column:
    return F.locate(needle, as_col(c))


def replace_span(c: Column | str, start: int, length: int, new: str) -> Column:
    return F.overlay(as_col(c), F.lit(new), F.lit(start), F.lit(length))


def same_text(a: Column | str, b: Column | str, case_insensitive: bool = False) -> Column:
    """Equality that ignores trailing blanks and, on request, case."""
    left, right = F.rtrim(as_col(a)), F.rtrim(as_col(b))
    if case_insensitive:
        left, right = F.collate(left, "UTF8_LCASE"), F.collate(right, "UTF8_LCASE")
    return left == right


def like_any(c: Column | str, *patterns: str) -> Column:
    """True when any LIKE pattern matches."""
    matches = [as_col(c).like(p) for p in patterns]
    out = matches[0]
    for m in matches[1:]:
        out = out | m
    return out
