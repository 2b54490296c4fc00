import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import parse, stats, text


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("x"))).collect()]


def test_options(spark):
    got = column(spark, ["1. 1. Increases my interest", "1. label", "2. 2.5 hours", "2. 2. PC (Steam, GOG) | 4. 4. Console", "Other text", " | ", "", None], parse.options)
    assert [[tuple(o) for o in r] for r in got] == [
        [(1, "Increases my interest")], [(1, "label")], [(2, "2.5 hours")], [(2, "PC (Steam, GOG)"), (4, "Console")], [(None, "Other text")], [], [], [],
    ]


def test_primary_code_skips_sentinels(spark):
    got = column(spark, ["99. None of the above", "3. a | 98. b", "5. e|2. b", "x", None], lambda c: parse.primary_code(parse.options(c)))
    assert got == [None, 3, 2, None, None]


def test_age(spark):
    raw = ["13", "17", "18", "24", "25-29", "13-16", "21 (17-24)", "17-24", "18-24", "65", "", "unknown", None]
    assert column(spark, raw, parse.age_band) == ["13-17", "13-17", "18-24", "18-24", "25-34", "13-17", "18-24", "18-24", "18-24", "55-64", None, None, None]
    assert column(spark, raw, parse.age_imputed) == [v == "17-24" if v is not None else None for v in raw]
    assert column(spark, raw, parse.age_exact) == [13, 17, 18, 24, None, None, 21, None, None, 65, None, None, None]


def test_income(spark):
    raw = ["$95,000 ", "$65,000 - $75,000", "", None]
    assert column(spark, raw, parse.income_low) == [95000, 65000, None, None]
    assert column(spark, raw, parse.income_high) == [95000, 75000, None, None]


def test_nps(spark):
    band = lambda c: parse.nps_band(text.to_long(c))
    assert column(spark, ["3", "7", "9", "10", "", "x", None], band) == ["Detractor", "Passive", "Promoter", "Promoter", None, None, None]
    literal = lambda c: parse.nps_band(text.to_long(c), null_is_detractor=True)
    assert column(spark, ["", None], literal) == ["Detractor", "Detractor"]


def test_quadrant(spark):
    rows = spark.createDataFrame([(True, True), (True, False), (False, True), (None, True)], "m boolean, y boolean")
    assert [r[0] for r in rows.select(parse.quadrant(F.col("m"), F.col("y"))).collect()] == ["Men <35", "Men 35+", "Women <35", None]


def test_gender_and_quotes(spark):
    assert column(spark, ["Male", "MALE", " female "], text.proper) == ["Male", "Male", "Female"]
    assert column(spark, ["‘a’ “b”"], text.straighten) == ["'a' \"b\""]
    assert column(spark, ["\t a \n", "  ", None], text.filled) == ["\t a \n", None, None]


@pytest.mark.parametrize(
    ("name", "run", "section", "combined"),
    [("7-STUDY-G-gr1-2.1X — Results-c.csv", "read_g_gr1_2_1x", "2.1", True), ("7-STUDY-S-gr2-2.3 — Results-c.csv", "read_s_gr2_2_3", "2.3", False)],
)
def test_slug(spark, name, run, section, combined):
    assert text.slug(name) == run
    assert column(spark, ["/data/in/" + name], text.slug_column) == [run]
    assert column(spark, [run], text.section) == [section]
    assert column(spark, [run], text.combined) == [combined]


def test_cohort(spark):
    assert column(spark, ["A-G-gr.2", "A-S-x.1", "A-S-x", "none"], text.cohort) == ["G.2", "S.1", None, None]


def test_erf_and_z(spark):
    got = column(spark, [-2.0, -0.5, 0.0, 0.3, 1.7], stats.erf, "double")
    assert got == pytest.approx([math.erf(x) for x in (-2.0, -0.5, 0.0, 0.3, 1.7)], abs=2e-7)
    rows = spark.createDataFrame([(30, 100, 20, 100), (0, 0, 1, 2), (0, 5, 0, 5)], "a bigint, n bigint, b bigint, m bigint")
    z = [r[0] for r in rows.select(stats.two_proportion_z(F.col("a"), F.col("n"), F.col("b"), F.col("m"))).collect()]
    assert z[0] == pytest.approx(0.1 / math.sqrt(0.25 * 0.75 * 0.02))
    assert z[1:] == [None, None]
