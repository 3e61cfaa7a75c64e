"""Scalar functions on hand-written cases."""

import datetime

import pytest

from siteconcord.functions import display, geo, hours, tags, text
from siteconcord.operators.runlog import clamped_limit
from siteconcord.params import MatchParams
from siteconcord.sources.registry import registry_by_guid

P = MatchParams()


@pytest.fixture(scope="module")
def check(spark):
    """check(function of a column name, [(input, expected), ...], type)"""

    def run(expression, cases, kind="string"):
        rows = [(i, value) for i, (value, _) in enumerate(cases)]
        df = spark.createDataFrame(rows, f"i int, v {kind}").selectExpr("i", f"{expression('v')} AS r")
        got = {r["i"]: r["r"] for r in df.collect()}
        for i, (value, expected) in enumerate(cases):
            actual = got[i]
            assert (list(actual) if isinstance(actual, list) else actual) == expected, (value, actual, expected)

    return run


def test_trim(check):
    check(text.trimmed, [(" ﻿ a b \n", "a b"), ("   ", ""), (None, None)])


def test_clean_tag_value(check):
    check(
        text.clean_tag_value,
        [
            (None, None),
            ("", None),
            (" \t ", None),
            (" x y", "x y"),
            ("a\nb", "a. b"),
            ("a\r\n\r\nb", "a. b"),
            ("a .", "a."),
            ("a...", "a."),
            ("a" * 254, "a" * 254),
            ("a" * 255, None),
            ("a" * 256, None),
            ("a" * 252 + "😀", "a" * 252 + "😀"),
            ("a" * 253 + "😀", None),
        ],
    )


def test_emails(check):
    check(
        text.extract_emails,
        [
            ("none here", None),
            ("a@b.no, a@b.no", ["a@b.no"]),
            ("Write to A.B@c.no. Now", ["A.B@c.no."]),
            ("x@y z@w.no@v.no", ["z@w.no"]),
            (None, None),
        ],
    )


def test_phones(check):
    shown = ["+47 12 34 56 78"]
    check(
        text.extract_phones,
        [
            ("12345678", shown),
            ("12 34 56 78", shown),
            ("123 45 678", shown),
            ("+47 12 34 56 78", None),
            ("1234567812345678", shown),
            ("1234567887654321", ["+47 12 34 56 78", "+47 87 65 43 21"]),
            ("1234567", None),
            ("12 34 56 78", shown),
        ],
    )


def test_cabinet(check):
    check(text.cabinet_kind, [("i ROTAID skap", "twist"), ("skap", None)])
    check(
        text.cabinet_colour,
        [
            ("grønt skap", "green"),
            ("GRØNT rundt varme skap", "green"),
            ("et grøntskap.", "green"),
            ("grønt skapet", None),
            ("xgrønt skap", None),
            ("å grønt skap", "green"),
        ],
    )


def test_number_text(check):
    cases = [(10.0, "10"), (0.00001, "0.00001"), (61.757, "61.757"), (-0.0, "0"), (-2.0, "-2"), (12345678.25, "12345678.25")]
    check(text.number_text, [*cases, (None, None)], "double")


def test_xml_escape(check):
    check(text.xml_escape, [("""<a b='c' d="e&f">""", "&lt;a b=&apos;c&apos; d=&quot;e&amp;f&quot;&gt;")])


def test_hhmm(check):
    nan = float("nan")
    cases = [(None, None), (-1.0, None), (-0.5, "00:00"), (0.0, "00:00"), (59.0, "00:59"), (60.0, None), (1275.0, None)]
    check(hours.format_hhmm, [*cases, (2359.9, "23:59"), (2400.0, "24:00"), (2401.0, None), (nan, None)], "double")


@pytest.mark.parametrize(
    "week, holidays, expected",
    [
        ({d: (800, 1600) for d in hours.REGISTRY_DAYS}, None, "Mo-Su 08:00-16:00"),
        ({d: (800, 1600) for d in ("MON", "TUE", "THU", "FRI")}, "Y", "Mo-Tu 08:00-16:00; Th-Fr 08:00-16:00; PH off"),
        ({"MON": (800, 1275), "SUN": (0, 2400)}, "N", "Su 00:00-24:00; PH open"),
        ({}, "Y", None),
        ({"MON": (700, 900), "TUE": (800, 900)}, None, "Mo 07:00-09:00; Tu 08:00-09:00"),
    ],
)
def test_opening_hours(spark, week, holidays, expected):
    columns = []
    for day in hours.REGISTRY_DAYS:
        for end, value in zip(("FROM", "TO"), week.get(day, (None, None)), strict=True):
            columns.append(f"cast({'NULL' if value is None else value} AS double) AS OPENING_HOURS_{day}_{end}")
    columns.append(f"cast({'NULL' if holidays is None else repr(holidays)} AS string) AS OPENING_HOURS_CLOSED_HOLIDAYS")
    row = spark.range(1).selectExpr(*columns).selectExpr(f"{hours.opening_hours()} AS r").first()
    assert row["r"] == expected


def test_easter(check):
    dates = [datetime.date(2023, 4, 9), datetime.date(2024, 3, 31), datetime.date(2025, 4, 20), datetime.date(2038, 4, 25)]
    check(hours.easter_sunday, [(d.year, d) for d in [*dates, datetime.date(1954, 4, 18), datetime.date(2000, 4, 23)]], "int")


@pytest.mark.parametrize(
    "value, at, expected",
    [
        (None, "2024-01-09 12:00", "unspecified"),
        ("  ", "2024-01-09 12:00", "unspecified"),
        ("by appointment", "2024-01-09 12:00", "unknown"),
        ("Mo-Fr 08:00-16:00", "2024-01-09 06:59", "closed"),
        ("Mo-Fr 08:00-16:00", "2024-01-09 07:00", "open"),
        ("Mo-Fr 08:00-16:00", "2024-01-09 15:00", "closed"),
        ("Mo-Fr 08:00-16:00", "2024-07-09 06:00", "open"),
        ("Mo-Fr 08:00-16:00; PH off", "2024-05-01 09:00", "closed"),
        ("Mo-Fr 08:00-16:00; PH open", "2024-05-01 20:00", "open"),
        ("Mo-Fr 08:00-16:00; PH open", "2024-04-29 20:00", "closed"),
        ("24/7", "2024-01-09 03:00", "open"),
        ("off", "2024-01-09 12:00", "closed"),
        ("Fr 20:00-02:00", "2024-01-12 23:30", "open"),
        ("Fr 20:00-02:00", "2024-01-13 00:30", "open"),
        ("Fr 20:00-02:00", "2024-01-13 01:30", "closed"),
        ("Mo-Fr 08:00-16:00; We 10:00-11:00", "2024-01-10 08:00", "closed"),
        ("Sa-Mo 10:00-12:00", "2024-01-07 10:00", "open"),
    ],
)
def test_opening_state(spark, value, at, expected):
    df = spark.createDataFrame([(value, at)], "v string, at string")
    state = hours.opening_state("v", "cast(at AS timestamp_ntz)")
    assert df.selectExpr(f"{state} AS r").first()["r"] == expected


def test_haversine(spark):
    cases = [((60, 10, 60, 10), 0.0), ((60, 10, 60.001, 10), 111.195), ((0, 179.9995, 0, -179.9995), 111.195), ((90, 0, 90, 50), 0.0)]
    for args, expected in cases:
        value = spark.range(1).selectExpr(f"{geo.haversine_m(*(geo.number(a) for a in args))} AS r").first()["r"]
        assert value == pytest.approx(expected, abs=1e-3)


SQUARE = (((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)),)
WITH_HOLE = (SQUARE[0], ((0.4, 0.4), (0.6, 0.4), (0.6, 0.6), (0.4, 0.6), (0.4, 0.4)))


@pytest.mark.parametrize(
    "polygon, lat, lon, expected",
    [
        (SQUARE, 0.5, 0.5, True),
        (SQUARE, 0.0, 0.0, True),
        (SQUARE, 1.0, 0.3, True),
        (SQUARE, -0.000005, -0.000005, True),
        (SQUARE, -0.00002, 0.0, False),
        (SQUARE, 1.5, 0.5, False),
        (WITH_HOLE, 0.5, 0.5, False),
        (WITH_HOLE, 0.4, 0.5, False),
        (WITH_HOLE, 0.3, 0.5, True),
        (SQUARE, float("nan"), 0.5, False),
        (SQUARE, None, 0.5, False),
    ],
)
def test_in_polygons(spark, polygon, lat, lon, expected):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert df.selectExpr(f"{geo.in_polygons('lat', 'lon', (polygon,))} AS r").first()["r"] is expected


def test_tag_predicates(spark):
    rows = [
        ({"emergency": "defibrillator"}, True, False, False, None),
        ({"emergency": "aed", "shop": ""}, False, True, False, None),
        ({"emergency": "yes", "note": "", "fixme": "x"}, False, False, True, None),
        ({"emergency": "defibrillator", P.ref_key: "  k "}, True, False, False, "k"),
        ({P.ref_key: "  "}, False, False, False, None),
        (None, False, False, False, None),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, tags map<string,string>")
    tests = (tags.is_aed_only, tags.has_conflict_tags, tags.is_opted_out, tags.managed_ref)
    got = df.selectExpr("i", *[f"{f('tags', P)} AS {f.__name__}" for f in tests]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [r[1:] for r in rows]


def test_tag_algebra(spark):
    df = spark.createDataFrame([({"a": "1", "b": ""}, {"a": "2", "c": "3"}), (None, {"a": "2"})], "x map<string,string>, y map<string,string>")
    got = df.selectExpr(f"{tags.tag_updates('x', 'y')} AS u", f"{tags.merge_tags('x', 'y')} AS m").collect()
    assert [(r["u"], r["m"]) for r in got] == [({"a": "2", "c": "3"}, {"a": "2", "b": "", "c": "3"}), ({"a": "2"}, {"a": "2"})]


@pytest.mark.parametrize(
    "seconds, label",
    [(None, "-"), (-5, "-"), (0, "0s"), (59, "59s"), (60, "1m 0s"), (3599, "59m 59s"), (3600, "1h 0m"), (9000, "2h 30m")],
)
def test_duration(spark, seconds, label):
    end = "NULL" if seconds is None else f"a + INTERVAL '{seconds}' SECOND"
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS a").selectExpr("a", f"{end} AS b")
    assert df.selectExpr(f"{display.duration_label('a', 'cast(b AS timestamp_ntz)')} AS r").first()["r"] == label


@pytest.mark.parametrize(
    "minutes, phrase",
    [
        (0, "this minute"),
        (-1, "1 minute ago"),
        (59, "in 59 minutes"),
        (-60, "1 hour ago"),
        (90, "in 2 hours"),
        (-90, "1 hour ago"),
        (23 * 60 + 30, "tomorrow"),
        (-24 * 60, "yesterday"),
        (-72 * 60, "3 days ago"),
    ],
)
def test_relative_time(spark, minutes, phrase):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-10 12:00:00' AS now").selectExpr("now", f"now + INTERVAL '{minutes}' MINUTE AS at")
    assert df.selectExpr(f"{display.relative_time('at', 'now')} AS r").first()["r"] == phrase


def test_limits():
    assert [clamped_limit(x, 30, 200) for x in (None, 0, -5, 2.9, 10_000)] == [30, 1, 1, 2, 200]


def test_guid_must_not_be_empty(spark):
    with pytest.raises(ValueError):
        registry_by_guid(spark.range(1), "  ")
