from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import numbers, text, times


def evaluate(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "function, cases",
    [
        (numbers.statement_number, {
            "1,234": 1234.0, "△1,234": -1234.0, "▲ 5": -5.0, "(42)": -42.0, "△(5)": -5.0, "△-5": 5.0, "12%": 12.0,
            "　7　": 7.0, "1.5e3": 1500.0, "-": None, "－": None, "△": None, "": None, "+": None, "-.": None,
            "１２": None, "e5": None, "abc": None, None: None, "(8": 8.0, "1，000": 1000.0, "-0.5": -0.5,
        }),
        (numbers.ratio_number, {
            "5.25%": 0.0525, "5.25％": 0.0525, "1,234": 1234.0, "１２": 12.0, "△5": None, "1d": None, "inf": None,
            "nan": None, "": None, ".5": 0.5, "5.": 5.0, "1e2": 100.0, "-3": -3.0, None: None, "%": None,
        }),
        (numbers.looks_numeric, {"△5": True, "5.25%": True, "x": False, None: False, "1,000": True, "": False, "１": True}),
        (text.security_code, {
            "72030.0": "7203", "7203": "7203", "130A0": "130A", "130a": "130A", "unexpected": None, "12345": None,
            "123.0": None, "12.0": None, "  72030 ": "7203", "": None, None: None, "12.0.0": "12.0",
        }),
        (text.disclosure_ticker, {
            "72030": "7203", "72030.0": "7203", "7203.0": "7203", "72031": "72031", "abc": "abc", "123.0": "123",
            "": None, None: None, "12.00": "12.0", "130a0": "130a",
        }),
        (text.local_name, {"ns:Name": "Name", "a:b:c": "c", "Name": "Name", None: "", "x:": ""}),
        (text.clean, {" a　": "a", "　": None, "\t\n": None, " x ": "x", None: None}),
        (text.clean_code, {" 12.0": "12", ".0": None, "12.00": "12.00"}),
        (text.is_consolidated, {
            "連結": True, "Consolidated": True, "NonConsolidated": False, "non-consolidated": True, "個別": False, None: False,
        }),
        (text.is_current_year, {"CurrentYear": True, "当期": True, "0": True, "Prior1Year": False, None: False}),
        (times.jst_text, {
            "2024-01-05 10:00": datetime(2024, 1, 5, 1), "2024-01-05T10:00:00+09:00": datetime(2024, 1, 5, 1),
            "2024-01-05T10:00:00Z": datetime(2024, 1, 5, 10), "2024-01-05": datetime(2024, 1, 4, 15),
            "10:00": None, "2024": None, "null": None, "": None, None: None,
        }),
        (times.known_from_update, {"20240105": datetime(2024, 1, 5, 14, 59, 59), "": None, "2024-01": None, None: None}),
        (times.to_utc, {"2024-01-05T00:00:00Z": datetime(2024, 1, 5), "12:00": None, "soon": None, None: None}),
    ],
)
def test_scalar(spark, function, cases):
    assert evaluate(spark, function, list(cases)) == list(cases.values())


def test_disclosure_times(spark):
    def known(c):
        return times.known_from_disclosure(F.lit("2024-01-05"), c, F.lit("2024-02-01"))

    cases = {
        "15:30:00": (6, 30, 0), "15:30": (6, 30, 0), "1530": (6, 30, 0), "153001": (6, 30, 1), "930": (14, 59, 59),
        "25:00": (14, 59, 59), "nan": (14, 59, 59), None: (14, 59, 59), " 9:05 ": None,
    }
    values = evaluate(spark, known, list(cases))
    for value, want in zip(values, cases.values()):
        day = 5 if want else 5
        assert value == datetime(2024, 1, day, *(want or (0, 5, 0)))
    late = evaluate(spark, lambda c: times.known_from_disclosure(c, F.lit("1000"), F.lit("2024-02-01")), ["", None])
    assert late == [datetime(2024, 2, 1, 14, 59, 59)] * 2


def test_filing_takes_the_later_time(spark):
    row = spark.sql("SELECT '2024-01-05 10:00' s, '2024-01-05 11:00' o, TIMESTAMP '2024-01-09' seen, '2024-01-06 09:00' p")
    both = times.known_from_filing(F.col("s"), F.col("o"), F.col("seen"))
    processed = times.known_from_filing(F.lit(None), F.lit("x"), F.col("seen"), F.col("p"))
    neither = times.known_from_filing(F.lit(None), F.lit(None), F.col("seen"))
    assert list(row.select(both, processed, neither).first()) == [
        datetime(2024, 1, 5, 2), datetime(2024, 1, 6, 0), datetime(2024, 1, 9),
    ]


def test_iso_text_and_finite(spark):
    rows = spark.sql("SELECT TIMESTAMP '2024-01-05 01:02:03' a, TIMESTAMP '2024-01-05 01:02:03.000004' b")
    assert list(rows.select(times.iso_z(F.col("a")), times.iso_z(F.col("b"))).first()) == [
        "2024-01-05T01:02:03Z", "2024-01-05T01:02:03.000004Z",
    ]
    assert evaluate(spark, numbers.finite, [1.0, float("nan"), float("inf"), None], "double") == [1.0, None, None, None]
    assert evaluate(spark, lambda c: numbers.safe_ratio(F.lit(1.0), c), [4.0, 0.0, None], "double") == [0.25, None, None]
