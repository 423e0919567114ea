"""Literal inputs and outputs of the column expressions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import dates, numbers, parse, text
from tallyhouse.plans import generated, silver
from tallyhouse.schemas import ENTITIES

DAY = dt.date(2024, 3, 15)


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize("fn, pairs", [
    (text.clean_email, [("user@example.com", "user@example.com"), ("USER@EXAMPLE.COM", "user@example.com"),
                        ("not-an-email", None), ("", None), (None, None), ("missing@", None), ("\t a@b.co\n", "a@b.co"),
                        ("a b@c.de", None), ("a@b@c.de", None), ("a@b.c d", None)]),
    (parse.clean_numeric, [("123.45", 123.45), ("1,234.56", 1234.56), ("99.99", 99.99), ("not_a_number", 0.0), (None, 0.0),
                           ("1_000", 1000.0), ("1.5d", 0.0), ("nan", 0.0), ("inf", 0.0), (" 7 ", 7.0), ("1e3", 1000.0), ("", 0.0),
                           (".5", 0.5), ("5.", 5.0), ("-2", -2.0), ("1__0", 0.0), ("_1", 0.0)]),
    (lambda c: parse.clean_numeric(c, 99.0), [("not_a_number", 99.0), ("1", 1.0)]),
    (parse.clean_date, [("2024-03-15", DAY), ("03/15/2024", DAY), ("15-03-2024", DAY), ("2024/03/15", DAY),
                        ("2024-3-5", dt.date(2024, 3, 5)), ("", None), (None, None), ("not-a-date", None), ("2023-02-30", None),
                        (" 2024-03-15 ", DAY), ("12024-01-01", None), ("2024-03-15T00", None), ("13/13/2024", None)]),
    (parse.standardize_status, [("complete", "completed"), ("CANCEL", "cancelled"), ("shipped", "shipped"), ("pending", "processing"),
                                ("unknown_status", "unknown_status"), (" Done", "completed"), ("in_transit", "shipped"),
                                ("canceled", "cancelled"), ("return", "returned"), ("Weird ", "weird"), ("processing", "processing")]),
    (parse.clean_percent, [("150", Decimal("100.00")), ("-5", Decimal("0.00")), ("nan", Decimal("0.00")), ("12.5", Decimal("12.50")), ("1e30", Decimal("100.00")), ("-1e30", Decimal("0.00"))]),
    (parse.clean_quantity, [("0", 1), ("2.9", 2), ("x", 1), ("-3", 1), ("7", 7), ("99999999999", None)]),
    (parse.clean_int, [("12.9", 12), ("-12.9", -12), ("1,000", 1000), ("", 0), ("99999999999", None)]),
    (parse.clean_money, [("2.675", Decimal("2.68")), ("1,234.5", Decimal("1234.50")), ("-0.005", Decimal("-0.01")), ("n/a", Decimal("0.00")), ("99999999999.00", None), ("1e30", None)]),
    (text.title_case, [(" o'neil ", "O'Neil"), ("mc-donald", "Mc-Donald"), ("WOMEN'S wear", "Women'S Wear"), ("x1y", "X1Y"), ("", ""), (None, None)]),
    (text.upper_code, [(" ca\t", "CA"), (None, None)]),
    (text.blank_to_null, [("  ", None), ("", None), (" A ", "A"), (None, None)]),
])
def test_text_rules(spark, fn, pairs):
    assert apply(spark, fn, [p[0] for p in pairs]) == [p[1] for p in pairs]


def test_sql_functions_agree_with_column_functions(spark):
    from tallyhouse.functions.sql_names import register

    register(spark)
    values = ["1,234.5", "nan", "1_0", " 2024-3-5", "03/15/2024", "Done ", "A@B.co", "x@", "", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for name, fn in (("clean_numeric", parse.clean_numeric), ("clean_date", parse.clean_date),
                     ("standardize_status", parse.standardize_status), ("clean_email", text.clean_email)):
        both = df.select(F.expr(f"{name}(v)").alias("a"), fn(F.col("v")).alias("b")).collect()
        assert [r.a for r in both] == [r.b for r in both], name


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_generated_columns(spark):
    dec = lambda v, t="decimal(10,2)": F.lit(v).cast(t)
    row = one(
        spark,
        generated.margin_pct(dec("30.00"), dec("20.00")), generated.margin_pct(dec("0"), dec("0")),
        generated.line_total(F.lit(3), dec("9.99"), dec("12.50", "decimal(5,2)")),
        generated.days_to_ship(F.lit(DAY), F.lit(dt.date(2024, 3, 18))), generated.days_to_ship(F.lit(DAY), F.lit(None).cast("date")),
        generated.full_name(F.lit("A"), F.lit(None).cast("string")), generated.full_name(F.lit("A"), F.lit("B")))
    assert tuple(row) == (Decimal("33.33"), Decimal("0.00"), Decimal("26.22"), 3, None, None, "A B")


def test_ratio_rounds_half_away_from_zero_and_guards_zero(spark):
    dec = lambda v: F.lit(v).cast("decimal(12,2)")
    row = one(spark, numbers.ratio(dec("0.01"), dec("2.00")), numbers.ratio(dec("-0.01"), dec("2.00")), numbers.ratio(dec("1.00"), dec("0.00")))
    assert tuple(row) == (Decimal("0.01"), Decimal("-0.01"), None)


def test_dates(spark):
    sunday, new_year = F.lit(dt.date(2024, 3, 17)), F.lit(dt.date(2024, 12, 30))
    row = one(spark, dates.day_number(sunday), dates.week_start(sunday), F.weekofyear(new_year), dates.is_weekend(sunday),
              dates.months_between_starts(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2025, 4, 1))),
              dates.months_between_starts(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2025, 4, 1)), "as_written"),
              dates.months_between_starts(F.lit(dt.date(2025, 1, 1)), F.lit(dt.date(2024, 1, 1)), "as_written"))
    assert tuple(row) == (0, dt.date(2024, 3, 11), 1, True, -15, -3, 0)
    with pytest.raises(ValueError):
        dates.months_between_starts(sunday, sunday, "other")


def test_bands_order_and_null(spark):
    from tallyhouse.plans.staging import MARGIN_REST, MARGIN_TIERS, STOCK_REST, STOCK_STATES

    df = spark.createDataFrame([(0, None), (9, 19), (49, 20), (50, 59), (None, 60)], "stock int, margin int")
    got = df.select(numbers.bands(F.col("stock"), STOCK_STATES, STOCK_REST), numbers.bands(F.col("margin"), MARGIN_TIERS, MARGIN_REST)).collect()
    assert [tuple(r) for r in got] == [
        ("Out of Stock", "Negative Margin"), ("Low Stock", "Negative Margin"), ("Normal Stock", "Low Margin"),
        ("Well Stocked", "Medium Margin"), ("Well Stocked", "High Margin")]


def test_lines_are_parsed_once(spark):
    """A regular expression costs more than all else of a line: each number is looked for once, however many rules and filters name it."""
    rows = spark.createDataFrame([("I1", "O1", "P1", "2.9", "1,000.50", "nan")], ", ".join(f"{c} string" for c in ENTITIES["order_items"].columns))
    cleaned = silver.clean_order_items(rows)
    plan = cleaned._sc._jvm.PythonSQLUtils.explainString(cleaned._jdf.queryExecution(), "simple")
    physical = plan[plan.index("Physical Plan"):]
    assert 3 <= physical.count("regexp_extract(") <= 4 and physical.count("RLIKE(") <= 2
    row = cleaned.first()
    assert (row.quantity, row.unit_price, row.discount_pct, row.line_total) == (2, Decimal("1000.50"), Decimal("0.00"), Decimal("2001.00"))


def test_short_numbers_are_read_as_all_others(spark):
    """Digits with or without a point take a cheaper way: each text gives what it gives with a blank before it."""
    texts = ["0", "7", "2.675", "0.005", "99.995", "99.994", "100.004", "99999999", "99999999.99", "99999999.995", "9999999.995", "999999999.999",
             "1.2.3", ".", "5.", ".5", "", "x", "12\n", "123456789.123456789", "0000000001", "1e5", "+5", "-5", "--5", "5-"]
    for fn in (parse.parse_decimal, parse.clean_money, lambda c: parse.clean_money(c, silver.PRICE, 7), parse.clean_int, lambda c: parse.clean_int(c, 7),
               parse.clean_quantity, parse.clean_percent, lambda c: parse.does_not_fit(c, "int"), lambda c: parse.does_not_fit(c, silver.PRICE)):
        assert apply(spark, fn, texts) == apply(spark, fn, [f" {t}" for t in texts])


def test_line_totals_in_cents_round_as_decimals_do(spark):
    rows = [(q, Decimal(p), Decimal(d)) for q in (0, 1, 3, 99_999, 100_001, 2_000_000_000) for p in ("0.01", "-0.01", "10.05", "-10.05", "999999.99", "-1000000.01", "99999999.99")
            for d in ("0.00", "0.50", "50.00", "99.99", "100.00", "33.33")]
    df = spark.createDataFrame(rows, "q int, p decimal(10,2), d decimal(5,2)")
    exact = F.expr("try_cast(round(q * p * ((100 - d) / cast(100 as decimal(3,0))), 2) as decimal(12,2))")
    got = df.select(generated.line_total(F.col("q"), F.col("p"), F.col("d")).alias("got"), exact.alias("exact"))
    assert got.filter("NOT (got <=> exact)").collect() == [] and got.filter("got IS NULL").count() > 0


def test_rejects_parse_suspect_texts_only(spark):
    """Texts that are plainly short, or hold no digit, are left out before any number is parsed."""
    rows = spark.createDataFrame([("a", "3", "9.5", "0"), ("b", "x", "n/a", ""), ("c", "99999999999", "1", "0"), ("d", "2000000", "99999999.00", "0"), ("e", "1,000", "1e30", "0")],
                                 "item_id string, quantity string, unit_price string, discount_pct string").repartition(1)
    found = silver.oversize_values(rows, "order_items")
    assert sorted((r.key, r.column) for r in found.collect()) == [("c", "quantity"), ("d", "line_total"), ("e", "unit_price")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "regexp_extract" not in plan[plan.index("Filter"):]
