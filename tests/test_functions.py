"""Scalars, rules and layout on values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from formloom.functions import geometry as G
from formloom.functions import rules as R
from formloom.functions import text as T
from formloom.operators import layout as L


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"n int, {schema}").orderBy("n").select(*columns).collect()]


def one(spark, rows, schema, column):
    return [r[0] for r in values(spark, rows, schema, column)]


def test_types_in_the_order_of_the_rules(spark):
    given = ["001/2025", "15.10.2025", "10", "100", "1.5", "100±0.1", "Д001", "Иванов И.И.", " 10 ", "годен", "", None]
    want = ["act_number", "date", "revision", "quantity", "measurement", "measurement_with_tolerance", "defect_code", "inspector", "revision", "text", "text", "text"]
    assert one(spark, [(g,) for g in given], "t string", R.infer_type(F.col("t"))) == want


def test_confidence(spark):
    got = one(spark, [(0.29,), (0.30,), (0.49,), (0.50,)], "c double", R.confidence_check(F.col("c")))
    assert [(g.acceptable, g.message) for g in got] == [
        (False, "Low confidence for field: 0.29 (threshold: 0.30)"), (True, "Below recommended confidence for field: 0.30"),
        (True, "Below recommended confidence for field: 0.49"), (True, ""),
    ]


def test_blank_numbers(spark):
    given = ["057I25", "057l25", "1I2", "5/7", "O57/2S", "abc", "0571/25", None, "1I2I3"]
    got = one(spark, [(g,) for g in given], "t string", T.blank_number(F.col("t")))
    assert [g and (g.value, g.corrected) for g in got] == [("057/25", True), ("057/25", True), ("001/02", True), ("005/07", False), ("057/25", True), None, None, None, None]


def test_dates(spark):
    given = [["15", "10", "2025"], ["1", "2", "25"], ["1", "2", "20", "25"], ["1", "2"], ["1"], [], ["40", "1", "2025"], ["1", "2", "1"]]
    got = values(spark, [(g,) for g in given], "p array<string>", T.date_of_parts(F.col("p")), T.date_of_cells(F.col("p")))
    assert got == [
        ("15/10/2025", "15/10/2025"), ("01/02/2025", "01/02/2025"), ("01/02/2025", "01/02/2020"), (None, "01/02/2025"), (None, None), (None, None),
        ("40/01/2025", None), ("01/02/1", "01/02/2025"),
    ]


def test_checked_dates(spark):
    got = one(spark, [("31.02.2025",), ("28.2.2025",), ("1.13.2025",), ("32.1.2025",), ("x",), (None,)], "t string", T.check_dotted_date(F.col("t")))
    assert [g.valid for g in got] == [False, True, False, False, False, False]
    assert got[2].message == "Invalid month: 13" and got[3].message == "Invalid day: 32"


def test_half_even_pixels(spark):
    got = one(spark, [(0.05,), (0.15,), (0.25,), (99.0,)], "share double", G.denormalise(F.col("share"), F.lit(0.0), F.lit(10)))
    assert [(g.start, g.end) for g in got] == [(0, 0), (2, 2), (2, 2), (10, 10)]


def test_exact_rounding(spark):
    assert one(spark, [(0.1235,), (0.5,), (None,)], "c double", G.round3(F.col("c"))) == [round(0.1235, 3), 0.5, None]


def test_merged_positions(spark):
    given = [[100, 105, 200, 205, 300], [100, 101, 102, 103, 104], [100, 150, 200], []]
    assert one(spark, [(g,) for g in given], "p array<int>", L.merge_positions(F.col("p"), F.lit(10))) == [[102, 202, 300], [103], [100, 150, 200], []]


def test_cell_bounds(spark):
    assert one(spark, [([0, 100, 200],), ([5],)], "p array<int>", L.cell_bounds(F.col("p"), F.lit(200))) == [[0, 50, 150, 200], [0, 200]]


@pytest.mark.parametrize("name, drop, suffix, want", [("a-cor.jpg", "-cor", "-texts.json", "a-texts.json"), ("a.b.png", "-cor", "-texts.json", "a.b-texts.json"), ("a-texts.json", "-texts", "-corrected.json", "a-corrected.json")])
def test_file_names(spark, name, drop, suffix, want):
    assert one(spark, [(name,)], "t string", T.next_file_name(F.col("t"), drop, suffix)) == [want]


def test_rounding_is_that_of_the_binary_value(spark):
    import random

    r = random.Random(3)
    values = [k / 2000 for k in range(2001)] + [r.random() for _ in range(2000)] + [0.0625, 0.1875, 0.0005, 0.9995, 2.0005, 123456.0005, -0.0015, -0.0625]
    got = [x.v for x in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c double").orderBy("i").select(G.round3(F.col("c")).alias("v")).collect()]
    assert got == [round(v, 3) for v in values]
