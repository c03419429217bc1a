from datetime import date

import pytest
from pyspark.sql import functions as F

from bodega.functions import identifiers as ident
from bodega.functions.amounts import line_amounts, split_by_flag
from bodega.functions.dates import age_in_years, borders_crossed, date_key, is_month_end, moment, period
from bodega.functions.text import (
    clean_email, clean_phone, clean_postal_code, clean_text, full_name, replace_span, same_text, sequence_code, substitute, trimmed_length,
)
from bodega.operators.risk import growth_factor


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def text(v):
    return F.lit(v).cast("string")


def test_text_cleaning(spark):
    assert one(spark, clean_text(text("  aña ")), clean_email(text(" A@B.es ")), clean_phone(text(" 600 ")), clean_text(text(None))) == ("AÑA", "a@b.es", "600", None)
    assert one(spark, clean_postal_code(text(" 28 0 01 ")), clean_postal_code(text(None)), clean_postal_code(text("123456789012"))) == ("28001", "", "1234567890")
    assert one(spark, substitute(text(" check "), "CHECK", "CHEQUE"), trimmed_length(text("ab  "))) == ("CHEQUE", 2)
    assert one(spark, sequence_code("SUC-", F.lit(7), 3), sequence_code("SUC-", F.lit(1234), 3)) == ("SUC-007", "SUC-234")
    assert one(spark, replace_span(text(",a,b"), 1, 1, ""), same_text(text("a"), text("A  ")), same_text(text("a"), text("A  "), True)) == ("a,b", False, True)


def test_full_name_propagates_null_except_for_the_second_surname(spark):
    assert one(spark, full_name(text("A"), text("B"), text("C")), full_name(text("A"), text("B"), text(None)), full_name(text(None), text("B"), text("C"))) == ("A B C", "A B", None)


def test_dates(spark):
    d = F.lit("2024-02-29").cast("date")
    assert one(spark, date_key(d), date_key(F.lit(None).cast("date")), is_month_end(d), period(d)) == (20240229, 0, True, "2024-02")
    born = F.lit("2000-12-31").cast("date")
    assert one(spark, age_in_years(born, F.lit("2001-01-01").cast("date"))) == (1,)
    assert one(spark, borders_crossed("MINUTE", moment("2024-01-01 00:00:59"), moment("2024-01-01 00:01:00")),
               borders_crossed("SECOND", moment("2024-01-01 00:00:59"), moment("2024-01-01 00:01:00"))) == (1, 1)
    assert [str(v) for v in one(spark, growth_factor(F.lit("2020-05-05").cast("date")), growth_factor(F.lit("2030-05-05").cast("date")))] == ["1.20", "1.45"]


def test_line_amounts_round_each_total(spark):
    parts = line_amounts(F.lit(3), F.lit("0.35").cast("decimal(18,2)"), F.lit("15.000").cast("decimal(18,3)"))
    assert [str(v) for v in one(spark, *parts.values())] == ["1.05", "0.16", "1.21"]
    dry, cold = split_by_flag(F.lit("9.50").cast("decimal(18,2)"), F.lit(True))
    assert [str(v) for v in one(spark, dry, cold)] == ["0.00", "9.50"]


@pytest.mark.parametrize("value, shape, valid", [
    ("ES9121000418450200051332", True, True), ("ES0021000418450200051332", True, False), ("ES91210004184502000513", False, False),
    ("ES91ABCD0418450200051332", True, False), ("DE9121000418450200051332", False, False), ("ES9121000418450200051332 ", True, False),
])
def test_iban(spark, value, shape, valid):
    assert one(spark, ident.looks_iban(text(value)), ident.valid_iban(text(value))) == (shape, valid)


def test_iban_check_digits_and_null(spark):
    assert one(spark, ident.iban_check_digits(text("21000418450200051332")), ident.valid_iban(text(None))) == ("91", None)


@pytest.mark.parametrize("value, shape, strict, valid", [
    ("12345678Z", True, True, True), ("12345678A", True, True, False), ("12345678z", True, False, False), (" 12345678Z", False, True, True), ("1234567Z", False, False, False),
])
def test_dni(spark, value, shape, strict, valid):
    assert one(spark, ident.looks_dni(text(value)), ident.strict_dni(text(value)), ident.valid_dni(text(value))) == (shape, strict, valid)


@pytest.mark.parametrize("value, expected", [
    ("12.5", True), (" -3 ", True), (".5", True), ("5.", True), ("\t7", True), ("1e3", False), ("", False), ("abc", False), ("99999999999999999", False), ("1,5", False),
])
def test_numeric_shape(spark, value, expected):
    assert one(spark, F.coalesce(ident.looks_numeric(text(value)), F.lit(False))) == (expected,)


@pytest.mark.parametrize("value, expected", [
    ("2024-01-31", date(2024, 1, 31)), ("2024-02-30", None), ("20240131", date(2024, 1, 31)), ("", None), ("hola", None), ("2024-01-31 10:00:00", date(2024, 1, 31)),
])
def test_text_dates(spark, value, expected):
    assert one(spark, ident.text_to_date(text(value))) == (expected,)


def test_other_shapes(spark):
    assert one(spark, ident.looks_email(text("a@b.es")), ident.looks_email(text("a@b")), ident.looks_postal_code(text("28001")), ident.looks_postal_code(text("68001")),
               ident.looks_phone(text("612345678")), ident.looks_phone(text("512345678"))) == (True, False, True, False, True, False)
