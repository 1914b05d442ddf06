from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tenure.functions import scalars as S


def values(spark, expression, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, c STRING")
    return [r["x"] for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_strip_removes_every_kind_of_padding(spark):
    texts = ["a", " a ", "\ta\n", " a　", "\x1ca\x1f", "a b", " a b ", "", " ", None, "é ", " é"]
    expected = [t if t is None else t.strip() for t in texts]
    assert values(spark, S.strip("c"), *texts) == expected


def test_dates(spark):
    texts = ["2024-02-29", " 2024-10-14 ", "\t2024-10-14", "2024-02-30", "2024-13-05", "2024", "2024-1-5", "2024-01-5T", "2024-01-05T10:00", "not-a-date", "", None]
    expected = [date(2024, 2, 29), date(2024, 10, 14), date(2024, 10, 14)] + [None] * 9
    assert values(spark, S.parse_date("c", ["yyyy-MM-dd"]), *texts) == expected


def test_further_date_formats_are_tried_in_order(spark):
    formats = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyy-M-d"]
    assert values(spark, S.parse_date("c", formats), "2024-01-02", " 03/02/2024 ", "2024-1-5", "x") == [
        date(2024, 1, 2),
        date(2024, 2, 3),
        date(2024, 1, 5),
        None,
    ]


def test_prices(spark):
    texts = ["30", " 50.0 ", " 12.5", "1e3", "-5", ".5", "+7", "30d", "nan", "inf", "thirty", " thirty ", "N/A", "", None]
    expected = [30, 50, 12.5, 1000, -5, 0.5, 7, None, None, None, 30, 30, None, None, None]
    got = values(spark, S.parse_price("c", [("thirty", "30")]), *texts)
    assert got == [None if e is None else Decimal(str(e)) for e in expected]


def test_price_corrections_may_also_replace_numbers(spark):
    assert values(spark, S.parse_price("c", [("30", "25")]), "30", "31") == [Decimal(25), Decimal(31)]


def test_text_fields(spark):
    assert values(spark, S.country_code("c"), " us ", "Uk  ", "  cA", " ", None) == ["US", "UK", "CA", None, None]
    assert values(spark, S.plan_name("c"), " Pro ", "BASIC") == ["pro", "basic"]
    assert values(spark, S.correct("c", [("baisc", "basic")]), "baisc", "baiscs", "pro") == ["basic", "baiscs", "pro"]
    assert values(spark, S.correct("c", []), "baisc") == ["baisc"]
    assert values(spark, S.is_blank("c"), "", None, "x") == [True, True, False]


def test_calendar(spark):
    d = F.to_date("c")
    texts = ["2023-11-30", "2024-11-30", "2023-02-28", "2024-10-31", "2024-12-15"]
    assert values(spark, S.months_later(d, 3), *texts) == [
        date(2024, 2, 29),
        date(2025, 2, 28),
        date(2023, 5, 28),
        date(2025, 1, 31),
        date(2025, 3, 15),
    ]
    assert values(spark, S.month_key(d), "2024-02-10") == ["2024-02"]
    assert values(spark, S.month_end(d), "2024-02-10") == [date(2024, 2, 29)]
    assert values(spark, S.month_start(d), "2024-02-10") == [date(2024, 2, 1)]
    assert values(spark, S.shown_end(d), "2024-02-10", None) == ["2024-02-10", "active"]


def test_rate_of_an_empty_group_is_null(spark):
    row = spark.range(1).select(S.rate(F.lit(1), F.lit(3)).alias("a"), S.rate(F.lit(1), F.lit(0)).alias("b")).first()
    assert row["a"] == 0.3333 and row["b"] is None
