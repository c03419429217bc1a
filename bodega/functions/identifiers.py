"""Shapes and check digits of the values the profiler looks for (native expressions, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bodega.functions.base import as_col
from bodega.functions.text import trimmed_length

# The control letter of a national id is LETTERS[number mod 23]; an IBAN is checked with
# E=14, S=28 moved behind the account digits and a remainder of 1 modulo 97.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
IBAN_COUNTRY_DIGITS = "1428"

# Texts that mean yes or no.
YES_NO_TEXTS = ("SI", "NO", "S", "N", "Y", "TRUE", "FALSE")
YES_NO_TEXTS_AND_BITS = ("0", "1") + YES_NO_TEXTS
NOT_A_CATEGORY = ("0", "1", "S", "N", "Y", "TRUE", "FALSE")

NUMBER_SHAPE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"
DATE_SHAPE = r"^\s*([0-9]{4}|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?)\s*$"
COMPACT_DATE_SHAPE = r"^\s*[0-9]{8}\s*$"


# The tests below look at length or first character before they match a pattern: a pattern match decodes
# the whole text, which is dear for long texts that cannot match anyway.


def _may_start_number(v: Column) -> Column:
    first = F.ascii(F.ltrim(v))
    return first.between(48, 57) | first.isin(43, 45, 46) | first.between(9, 13)


def looks_numeric(c: Column | str) -> Column:
    """A plain decimal number that fits decimal(18,4); exponents are not accepted."""
    v = as_col(c)
    return _may_start_number(v) & v.rlike(NUMBER_SHAPE) & F.trim(v).try_cast("decimal(18,4)").isNotNull()


def text_to_date(c: Column | str) -> Column:
    v = F.trim(as_col(c))
    compact = F.concat_ws("-", F.substring(v, 1, 4), F.substring(v, 5, 2), F.substring(v, 7, 2))
    return F.when(~_may_start_number(v), F.lit(None)).when(v.rlike(DATE_SHAPE), v.try_cast("date")).when(
        v.rlike(COMPACT_DATE_SHAPE), compact.try_cast("date")
    )


def in_calendar(d: Column) -> Column:
    return d.between(F.lit("1900-01-01").cast("date"), F.lit("2100-12-31").cast("date"))


def looks_email(c: Column | str) -> Column:
    v = as_col(c)
    return trimmed_length(v).between(6, 254) & F.contains(v, F.lit("@")) & F.contains(v, F.lit("."))


def looks_dni(c: Column | str) -> Column:
    v = as_col(c)
    return (F.length(v) == 9) & v.rlike(r"^[0-9]{8}[A-Za-z]\z")


def strict_dni(c: Column | str) -> Column:
    """Upper-case shape after trimming: the base of the conformity share."""
    v = F.trim(as_col(c))
    return (F.length(v) == 9) & v.rlike(r"^[0-9]{8}[A-Z]\z")


def valid_dni(c: Column | str) -> Column:
    v = F.trim(as_col(c))
    number = F.left(v, F.lit(8)).try_cast("bigint")
    letter = F.substring(F.lit(DNI_LETTERS), (number % 23 + 1).cast("int"), F.lit(1))
    return strict_dni(v) & (letter == F.right(v, F.lit(1)))


def looks_postal_code(c: Column | str) -> Column:
    v = as_col(c)
    return (F.length(v) == 5) & v.rlike(r"^[0-5][0-9]{4}\z")


def looks_phone(c: Column | str) -> Column:
    v = as_col(c)
    return (F.length(v) == 9) & v.rlike(r"^[6-9][0-9]{8}\z")


def looks_iban(c: Column | str) -> Column:
    v = as_col(c)
    return (trimmed_length(v) == 24) & v.rlike(r"^ES[0-9]{2}")


def valid_iban(c: Column | str) -> Column:
    """Spanish IBAN with a correct mod-97 remainder; any other text is False, NULL stays NULL."""
    v = as_col(c)
    digits = F.concat(F.substring(v, 5, 20), F.lit(IBAN_COUNTRY_DIGITS), F.substring(v, 3, 2))
    remainder = digits.try_cast("decimal(26,0)") % F.lit(97).cast("decimal(26,0)")
    return F.when(v.isNull(), F.lit(None)).otherwise(
        (F.length(v) == 24) & v.rlike(r"^ES[0-9]{22}\z") & F.coalesce(remainder == 1, F.lit(False))
    )


def iban_check_digits(account: Column | str) -> Column:
    """The two control digits of a 20-digit account number."""
    digits = F.concat(as_col(account), F.lit(IBAN_COUNTRY_DIGITS), F.lit("00")).try_cast("decimal(26,0)")
    return F.lpad((F.lit(98) - digits % F.lit(97).cast("decimal(26,0)")).cast("int").cast("string"), 2, "0")


def yes_no_among(c: Column | str, texts: tuple[str, ...]) -> Column:
    v = F.trim(as_col(c))
    return (F.length(v) <= max(map(len, texts))) & F.upper(v).isin(*texts)
