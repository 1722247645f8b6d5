import datetime
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentrank.functions import dates, numbers, text

SLOW = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
letters = st.text(st.characters(blacklist_categories=("Cs", "Co", "Cn")), max_size=12)


@pytest.mark.parametrize(
    "invert, expected",
    [
        (True, [1.25, 1, 0.75, 0.5, 0.25, 0, -0.25]),
        (False, [-0.25, 0, 0.25, 0.5, 0.75, 1, 1.25]),
    ],
)
def test_normalise(evaluate, invert, expected):
    values = [10, 20, 30, 40, 50, 60, 70]
    assert evaluate(lambda c: numbers.normalise(c, 20, 60, invert), values, "int") == expected


def test_normalise_equal_bounds(evaluate):
    assert evaluate(lambda c: numbers.normalise(c, 5, 5), [1, 5], "int") == [0.0, 0.0]


def test_string_to_number(evaluate):
    cases = {
        "£1,250 pcm": 1250, "192.50": 192, ",": None, "none": None, "": None, "6+": 6,
        "32 mins": 32, "N/A": None, "a,b 7": None, "٣,٤ x": 34, None: None,
    }
    assert evaluate(text.string_to_number, list(cases)) == list(cases.values())


@SLOW
@given(st.lists(st.text("0123456789,. £pcw٣५", max_size=10), min_size=50, max_size=80))
def test_string_to_number_is_the_rule(evaluate, values):
    def rule(s):
        match = re.search(r"[\d,]+", s)
        digits = match.group().replace(",", "") if match else ""
        return int(digits) if digits else None

    assert evaluate(text.string_to_number, values) == [rule(v) for v in values]


@SLOW
@given(st.lists(st.text("ab=&1", max_size=9), min_size=50, max_size=80))
def test_id_from_url(evaluate, values):
    def rule(url):
        parts = url.split("=")
        return (parts[1].split("&")[0] or None) if len(parts) > 1 else None

    assert evaluate(text.id_from_url, values) == [rule(v) for v in values]


def test_id_from_url_compiles_no_pattern_for_each_url(spark):
    found = spark.createDataFrame([("a=1&b=2",)], "url string").select(text.id_from_url(F.col("url")))
    assert "split" not in found._jdf.queryExecution().optimizedPlan().toString().lower()


def test_clean_string(evaluate):
    values = ["  Bond Street ", "ＡＢＣ", "ﬁve x²", "\x1cYes\x85", "plain", ""]
    expected = ["bond street", "abc", "five x2", "yes", "plain", ""]
    assert evaluate(text.clean_string, values) == expected


@SLOW
@given(st.lists(letters, min_size=50, max_size=80))
def test_nfkc_and_strip_are_the_rule(evaluate, values):
    expected = [unicodedata.normalize("NFKC", v).strip() for v in values]
    assert evaluate(lambda c: text.strip(text.nfkc(c)), values) == expected


@SLOW
@given(st.lists(st.floats(-1e6, 1e6), min_size=50, max_size=80))
def test_round_exact(evaluate, values):
    for digits in (1, 6):
        found = evaluate(lambda c: numbers.round_exact(c, digits), values, "double")
        assert found == [round(v, digits) for v in values]


def test_round_exact_at_ties(evaluate):
    values = [n / 20 for n in range(-2000, 2000)] + [0.35, 0.25, 2.675, 1.005, 51.1234565]
    for digits in (1, 2, 6):
        found = evaluate(lambda c: numbers.round_exact(c, digits), values, "double")
        assert found == [round(v, digits) for v in values]


def test_float_text(evaluate):
    values = [51.5, -0.1278, 0.0, 0.0005, -0.00123, 0.000123, 0.00005, -0.000012, 12.0]
    values += [1e7, -1.66666667e7, 12345678.5, 123456789.0, 9.007199254740993e15, 1e16, -2.5e17, 1.7976931348623157e308]
    assert evaluate(text.float_text, values, "double") == [str(v) for v in values]


def test_integer_text(evaluate):
    values = ["6", " +7 ", "-2", "1_000", "6+", "a few", "", "5.0", " 8", "٣", None]
    expected = [6, 7, -2, 1000, None, None, None, None, 8, 3, None]
    assert evaluate(text.integer_text, values) == expected


def test_lines(evaluate):
    assert evaluate(text.join_lines, ["Double\n  room\r\n\n x ", "one"]) == ["Double room x", "one"]
    words = ["London E14", "SE1 Bank", "x² y", "a  b"]
    assert evaluate(text.drop_words_with_digits, words) == ["London", "Bank", "y", "a b"]


def test_count_words(evaluate):
    values = ["we share our home", "We our, we  we", "", None]
    assert evaluate(lambda c: text.count_words(c, ("we", "our", "home")), values) == [3, 2, 0, 0]


def test_weekly_to_monthly(evaluate):
    assert evaluate(numbers.weekly_to_monthly, [100, 150], "bigint") == [100 * 52 / 12, 150 * 52 / 12]


def test_last_tuesday(evaluate):
    days = [datetime.date(2001, 7, 30) + datetime.timedelta(n) for n in range(9)]
    tuesdays = ["2001-07-24"] + ["2001-07-31"] * 7 + ["2001-08-07"]
    expected = [f"{day}T09:00:00Z" for day in tuesdays]
    assert evaluate(dates.last_tuesday_9am, days, "date") == expected


def test_day_month(evaluate):
    assert evaluate(dates.day_month, [datetime.date(2026, 12, 1)], "date") == ["01-Dec"]


def test_scalars_need_no_python_worker(spark):
    column = text.clean_string(F.col("s"))
    plan = spark.createDataFrame([("a",)], "s string").select(column)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_numbers_without_exponent_are_written_without_a_cast_that_fails(evaluate, monkeypatch):
    """A failing ``try_cast`` throws and catches an exception a row; as a plain cast it fails the query."""
    kind = type(F.lit(1))
    monkeypatch.setattr(kind, "try_cast", kind.cast)
    values = [0.0, -0.5, 51.3, 0.001, 1234.5, 1e16, -0.0, None]
    assert evaluate(text.float_text, values, "double") == ["0.0", "-0.5", "51.3", "0.001", "1234.5", "1e+16", "-0.0", None]
