"""Edge values of the column functions."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from lotwise.functions import scalars as S
from lotwise.functions.words import STOP_LISTS, STOP_WORDS, tokens


@pytest.mark.parametrize(
    ("price", "want"),
    [(19999.99, "basso"), (20000.0, "medio"), (50000.0, "medio"), (50000.01, "alto"), (None, None)],
)
def test_band_edges(one, price, want):
    assert one(S.price_band, price, "double") == want


@pytest.mark.parametrize(
    ("price", "want"), [(14999.99, "basso"), (15000.0, "medio"), (34999.99, "medio"), (35000.0, "alto")]
)
def test_alt_band_edges(one, price, want):
    assert one(lambda c: S.price_band(c, S.ALT_BAND_CUTS, closed="left"), price, "double") == want


def test_band_arguments(one):
    with pytest.raises(ValueError):
        S.price_band(F.lit(1.0), cuts=(1.0,), labels=("a",))
    with pytest.raises(ValueError):
        S.price_band(F.lit(1.0), closed="both")


@pytest.mark.parametrize(
    ("text", "want"),
    [("2015.0", 2015), ("2015.9", 2015), (" 2015 ", 2015), ("abc", None), ("", None), ("1e99", None)],
)
def test_whole(one, text, want):
    assert one(S.whole, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("5d", None), ("1e3", 1000.0), ("NaN", None), ("inf", None), ("-.5", -0.5), ("1,5", None), (None, None)],
)
def test_num(one, text, want):
    assert one(S.num, text) == want


@pytest.mark.parametrize(
    ("text", "want"), [("  BMW ", "bmw"), ("   ", None), (" Kia　", "kia"), (None, None)]
)
def test_norm_key(one, text, want):
    assert one(S.norm_key, text) == want


@pytest.mark.parametrize(
    ("text", "want"), [("177 hp @ 5,750 RPM", 5750.0), ("177 hp", None), ("@9 RPM", 9.0), (None, None)]
)
def test_rpm(one, text, want):
    assert one(S.rpm, text) == want


@pytest.mark.parametrize(("text", "want"), [("1,234 hp", 1.0), ("V6", 6.0), ("", None), (None, None)])
def test_first_number(one, text, want):
    assert one(S.first_number, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("['A', \"B's\"]", ["A", "B's"]), ("oops", []), ("", []), (None, []), ("['A']", ["A"])],
)
def test_parse_list(one, text, want):
    assert one(S.parse_list, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("a [!@@x@@!] b [!@@y@@!]", "a  b"), (None, ""), ("[!@@x\ny@@!]", "[!@@x\ny@@!]")],
)
def test_strip_tags(one, text, want):
    assert one(S.strip_tags, text) == want


@pytest.mark.parametrize(("text", "want"), [("True", True), ("False", False), (None, False), ("", False)])
def test_to_bool(one, text, want):
    assert one(S.to_bool, text) is want


@pytest.mark.parametrize(
    ("text", "want"), [("35.1 in", 35.1), ("--", None), ("14.5 gal", None), ("x in", None), (None, None)]
)
def test_strip_unit(one, text, want):
    assert one(lambda c: S.strip_unit(c, " in"), text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("2024-01-01", datetime.date(2024, 1, 1)), ("2024-02-30", None), ("bad", None), (None, None)],
)
def test_to_date_lenient(one, text, want):
    assert one(S.to_date_lenient, text) == want


def test_monday_is_zero(one):
    assert one(lambda c: F.weekday(S.to_date_lenient(c)), "2024-01-01") == 0


@pytest.mark.parametrize(
    ("value", "want"),
    [(0.125, "0.12"), (0.375, "0.38"), (1.005, "1.00"), (2.675, "2.67"), (1234567.891, "1234567.89")],
)
def test_two_decimals_round_like_c(one, value, want):
    assert one(S.two_decimals, value, "double") == want == f"{value:.2f}"


def test_days_default(one):
    assert one(lambda c: S.days_or_default(c, 0), "") == 0
    assert one(lambda c: S.days_or_default(c, 0), None) == 0
    assert one(lambda c: S.days_or_default(c, 0), "x") is None
    assert one(S.days_or_default, "") is None
    assert one(S.days_or_default, "30.0") == 30


def test_quoting_follows_the_content(one):
    make = lambda c: S.bracketed(F.array(F.lit("a"), c), quote=True)
    assert one(make, "b") == "['a', 'b']"
    assert one(make, "o'b") == "['a', \"o'b\"]"


def test_tokens(one):
    assert one(tokens, "Don't BUY naïve_car, it's A-1!") == ["dont", "buy", "naïve_car"]
    assert one(tokens, None) == []
    assert one(lambda c: tokens(c, stop=[], min_len=1, punct=" "), "A-1 b!") == ["a", "1", "b"]
    assert one(tokens, "aaa bbb　ccc") == ["aaa", "bbb", "ccc"]


def test_stop_lists():
    assert {k: len(set(v)) for k, v in STOP_LISTS.items()} == {
        "default": 177, "domain": 194, "short": 116, "minimal": 15, "none": 0,
    }
    assert len(STOP_WORDS) == len(set(STOP_WORDS))


@pytest.mark.parametrize(
    "text, items",
    [
        ("['A', None]", ["A", None]),
        ("[None]", [None]),
        ("['a, None, b', 'None']", ["a, None, b", "None"]),
        ("[]", []),
    ],
)
def test_bare_none_is_a_null_element(one, text, items):
    from lotwise.functions.scalars import parse_list

    assert one(parse_list, text) == items


def test_long_lists_parse(one):
    items = [None if i % 7 == 3 else f"item {i}, None" if i % 2 else "it's" for i in range(20_000)]
    text = "[" + ", ".join("None" if x is None else f'"{x}"' if "'" in x else f"'{x}'" for x in items) + "]"
    assert one(S.parse_list, text) == items


@pytest.mark.parametrize(
    ("text", "want"),
    [("[None]", [None]), ("['None', None]", ["None", None]), ("['a', None", []), ("[\"it's None\", None]", ["it's None", None]), ("'", []), ("[NoneSuch]", [])],
)
def test_bare_none_is_a_null_element(one, text, want):
    assert one(S.parse_list, text) == want
