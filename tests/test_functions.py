import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline import functions as LF


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_parse_amount(spark):
    got = one_col(spark, ["1,234.50", " -5 ", "£5", "(5)", "12d", "", None, "1e5", "0.00"], LF.parse_amount)
    assert got == [Decimal("1234.50"), Decimal("-5.00"), None, None, None, None, None,
                   Decimal("100000.00"), Decimal("0.00")]


def test_parse_uk_date(spark):
    got = one_col(spark, ["03/04/2015", "3/4/2015", "31/02/2015", "abc", None, "2015-04-03",
                          "03-Apr-2015", "3/4/2015 10:30"], LF.parse_uk_date)
    d = dt.date(2015, 4, 3)
    assert got == [d, d, None, None, None, d, d, d]
    assert one_col(spark, ["1/4/95", "1/4/15", "03-Apr-99"], LF.parse_uk_date) == [
        dt.date(1995, 4, 1), dt.date(2015, 4, 1), dt.date(1999, 4, 3)]


def test_wide_and_rounded_amounts(spark):
    cells = ["1e20", "99999999999999999.99", "1.005", "1.50", "2.500", "x", None, "1e300"]
    assert one_col(spark, cells, LF.parse_amount) == [
        Decimal("1e20"), Decimal("99999999999999999.99"), Decimal("1.01"), Decimal("1.50"), Decimal("2.50"),
        None, None, None]
    assert one_col(spark, cells, LF.is_rounded) == [False, False, True, False, False, False, False, False]


def test_more_date_layouts(spark):
    cells = ["2015-04-03T00:00:00", "2015-04-03T10:30", "2015-04-03 00:00", "2015/04/03", "20150403", "3-April-2015",
             "3-4-15", "3.4.15", "20151303"]
    d = dt.date(2015, 4, 3)
    assert one_col(spark, cells, LF.parse_uk_date) == [d] * 8 + [None]
    assert one_col(spark, ["1/1/68", "1/1/69"], LF.parse_uk_date) == [dt.date(2068, 1, 1), dt.date(1969, 1, 1)]


def test_usual_dates_and_texts_like_them(spark):
    cells = ["03/04/2015", "3/4/2015", " 3/4/2015 ", "3/4/2015\n", "\xa03/4/2015", "29/02/2015", "00/04/2015", "3/4/02015", "٣/٤/٢٠١٥"]
    d = dt.date(2015, 4, 3)
    assert one_col(spark, cells, LF.parse_uk_date) == [d] * 5 + [None] * 4


def test_fiscal_calendar(spark):
    dates = [dt.date(2015, 4, 1), dt.date(2015, 12, 31), dt.date(2016, 3, 31), dt.date(1999, 7, 1), None]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    d = F.col("d")
    rows = df.select(LF.fiscal_year(d), LF.fiscal_quarter(d), LF.half_year(F.month(d)), LF.quarter_name(d),
                     LF.date_key(d)).collect()
    assert [tuple(r) for r in rows] == [
        ("FY2015/16", "Q1", "H1", "Q2", 20150401),
        ("FY2015/16", "Q3", "H2", "Q4", 20151231),
        ("FY2015/16", "Q4", "H2", "Q1", 20160331),
        ("FY1999/00", "Q2", "H1", "Q3", 19990701),
        (None, None, "H2", None, None),
    ]


def test_refund_flag(spark):
    got = one_col(spark, [Decimal("-0.01"), Decimal("0"), None], LF.refund_flag, "decimal(18,2)")
    assert got == [True, False, False]


def test_normalize_supplier(spark):
    got = one_col(spark, [" Acme  Limited ", "Unlimited Co", "foo plc", " x ", None, "a\tlimited\x1cb"],
                  LF.normalize_supplier)
    assert got == ["ACME LTD", "UNLIMITED CO", "FOO PLC", "X", None, "A LTD B"]


def test_title_case_matches_python(spark):
    values = ["it's non-pay 3rd R&D", " école normale ", "MIXED-case words", "", "a1b2c"]
    got = one_col(spark, values, LF.title_case)
    assert got == [v.strip().title() for v in values]
    assert got[0] == "It'S Non-Pay 3Rd R&D"


def test_split_group(spark):
    df = spark.createDataFrame([("A - B - C",), ("A",), ("A-B",), (None,)], "x string")
    g, s = LF.split_group(F.col("x"))
    assert [tuple(r) for r in df.select(g, s).collect()] == [("A", "B - C"), ("A", None), ("A-B", None),
                                                             (None, None)]


def test_null_tokens(spark):
    got = one_col(spark, ["NA", "N/A", "NULL", "nan", "", " NA", "value", None], LF.null_tokens)
    assert got == [None, None, None, None, None, " NA", "value", None]


def test_strip_is_python_strip(spark):
    values = ["\xa0x\xa0", "\t y \n", "　z ", "\x1cw\x1f"]
    assert one_col(spark, values, LF.strip_ws) == [v.strip() for v in values]
