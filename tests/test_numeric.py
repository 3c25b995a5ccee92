import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.numeric import (
    DECIMAL_TEXT, DOUBLE_TEXT, WHOLE_TEXT, money_sum, round2, safe_number, whole_number,
)


@pytest.mark.parametrize("value, expected", [
    (0.125, 0.12), (0.375, 0.38), (-0.125, -0.12), (1.005, 1.0), (2.675, 2.68), (7.0, 7.0), (None, None),
])
def test_round2_is_half_even_after_scaling(spark, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(round2(F.col("x"))).first()[0] == expected


def test_money_sum_does_not_depend_on_partitioning(spark):
    rows = spark.range(200_000).select((F.rint((F.col("id") * 7919 % 1_000_003) * 1.0) / 100).alias("x"))
    expected = sum(i * 7919 % 1_000_003 for i in range(200_000)) / 100
    for parts in (1, 8, 13):
        assert rows.repartition(parts).agg(money_sum(F.col("x"))).first()[0] == expected


def test_money_sum_passes_the_range_of_long_cents(spark):
    rows = spark.range(2000).select(F.lit(9e13).alias("x"))
    assert rows.agg(money_sum(F.col("x"))).first()[0] == 1.8e17


def test_money_sum_without_rows_is_null(spark):
    assert spark.range(0).select(F.lit(1.0).alias("x")).agg(money_sum(F.col("x"))).first()[0] is None


def test_money_sum_of_single_amounts_beyond_long_cents(spark):
    rows = spark.createDataFrame([(3e17,), (-1e17,), (0.25,)], "x double")
    assert rows.agg(money_sum(F.col("x"))).first()[0] == 2e17
    rows = spark.createDataFrame([(0.1,)] * 3 + [(None,)], "x double")
    assert rows.agg(money_sum(F.col("x"))).first()[0] == 0.3


ODD_NUMBERS = [
    "7", " 7", "7 ", "\t7\n", "+7", "-7", "007", "7.0", "7.", "-7.00", ".5", "0.5", "-.0", "1e3", "1E+2", "100e-2", "1e-2", "7.0\x1f",
    "9223372036854775807", "9223372036854775808", "9223372036854775807.0", "1" * 39, "0" * 50 + "7", "7." + "0" * 40, "1e400", "1e38",
    "\u0663", "\u0663.0", "7\x7f", "\u00a07", "inf", "-Infinity", " nan ", "NaN", "0x1p3", "0x1.8P+1", "5d", "5F", "5d\t",
    "", " ", "abc", "X1", "12a3", "1abc", "1_0", "1,0", "--1", "1+", "1e", "1.2.3", ".", "-", "- 1", "7 7", "1 e3", None,
]


def test_guarded_casts_give_what_plain_casts_give(spark):
    """Every text is taken or refused as by the casts alone, which throw and catch an exception for each refusal."""
    rows = spark.createDataFrame([(t,) for t in ODD_NUMBERS], "v string")
    text, number = F.col("v"), F.col("v").try_cast("decimal(38,18)")
    whole = F.coalesce(text.try_cast("long"), F.when(F.floor(number) == number, number.try_cast("long")))
    suffixed = F.lower(F.right(F.rtrim(text), F.lit(1))).isin("d", "f")
    safe = F.coalesce(text.try_cast("long").cast("double"), F.when(~suffixed, text.try_cast("double")))
    got = rows.select("v", whole.alias("a"), whole_number("v").alias("b"), safe.alias("c"), safe_number("v", T.StringType()).alias("d"))
    assert got.where("not (a <=> b) or not (c <=> d)").collect() == []
    assert got.where("b is not null").count() >= 18 and got.where("d is not null").count() >= 28


def test_no_cast_meets_a_text_it_would_refuse(spark):
    """A cast that fails throws, which costs far more than parsing a number, so keys like ``7.0`` and ``12abc`` must not reach one."""
    rows = spark.createDataFrame([("7.0",), ("7",), ("12abc",), ("X1",), ("",), ("7.5",)], "v string")
    for kind, form in (("long", WHOLE_TEXT), ("decimal(38,18)", DECIMAL_TEXT), ("double", DOUBLE_TEXT)):
        taken = rows.where(F.col("v").rlike(form)).select("v").collect()
        # A plain cast raises on the first text it refuses.
        assert taken and rows.where(F.col("v").rlike(form)).select(F.col("v").cast(kind)).collect()
    parsed = rows.select(whole_number("v").alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert parsed.count("RLIKE") >= 2
