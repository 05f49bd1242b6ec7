"""Cleaning rules applied over text variants derived from the benchmark tables.

Each function builds raw cell texts from every row of a table (so the work
grows with the data), in several layouts chosen by a row attribute, and
applies one cleaning rule. The expected value of each layout is known by
construction, which is what the SQL oracle checks against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions import cleaning as cl
from ledgerline.operators.staging import drop_blank_rows
from ledgerline.schema import CORE_COLS
from ledgerline.sources.tables import raw_file_counts, raw_payments

c = F.col


def _li(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    # dealt by its keys at every size: a file may be one row group, which only one task can read
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*cols).repartition("l_orderkey", "l_linenumber")


def amount_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 thousands separators, 1 padded, 2 currency sign, 3 parentheses, 4 trailing letter,
    5 negative with separators, 6 plain."""
    li = _li(spark, sf_dir, "l_orderkey", "l_linenumber", "l_extendedprice")
    x = c("l_extendedprice").cast(cl.MONEY)
    v = c("l_linenumber") % 7
    plain = x.cast("string")
    text = (F.when(v == 0, F.format_number(x, 2)).when(v == 1, F.concat(F.lit(" "), plain, F.lit(" ")))
             .when(v == 2, F.concat(F.lit("£"), plain)).when(v == 3, F.concat(F.lit("("), plain, F.lit(")")))
             .when(v == 4, F.concat(plain, F.lit("d")))
             .when(v == 5, F.concat(F.lit("-"), F.format_number(x, 2))).otherwise(plain))
    return li.select("l_orderkey", "l_linenumber", v.alias("variant"),
                     cl.parse_amount(cl.null_tokens(text)).alias("amount"))


def date_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 dd/MM/yyyy, 1 d/M/yyyy, 2 yyyy-MM-dd, 3 impossible day, 4 dd-MMM-yyyy, 5 with a time."""
    li = _li(spark, sf_dir, "l_orderkey", "l_linenumber", "l_shipdate")
    d = F.to_date("l_shipdate")
    v = c("l_linenumber") % 6
    text = (F.when(v == 0, F.date_format(d, "dd/MM/yyyy")).when(v == 1, F.date_format(d, "d/M/yyyy"))
             .when(v == 2, F.date_format(d, "yyyy-MM-dd"))
             .when(v == 3, F.concat(F.lit("31/02/"), F.year(d).cast("string")))
             .when(v == 4, F.date_format(d, "dd-MMM-yyyy"))
             .otherwise(F.concat(F.date_format(d, "d/M/yyyy"), F.lit(" 14:05"))))
    return li.select("l_orderkey", "l_linenumber", v.alias("variant"),
                     cl.parse_uk_date(text).alias("payment_date"))


def amount_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 three decimals (rounded half-up), 1 twenty digits, 2 exponent form, 3 trailing zeros, with the rounding flag."""
    li = _li(spark, sf_dir, "l_orderkey", "l_linenumber", "l_extendedprice")
    x = c("l_extendedprice").cast("decimal(28,2)")
    v = c("l_linenumber") % 4
    wide = (x + F.lit("90000000000000000000").cast("decimal(28,2)")).cast("decimal(28,2)")
    text = (F.when(v == 0, F.concat(x.cast("string"), F.lit("5"))).when(v == 1, F.format_number(wide, 2))
             .when(v == 2, F.concat(c("l_linenumber").cast("string"), F.lit("e3")))
             .otherwise(F.concat(x.cast("string"), F.lit("00"))))
    return li.select("l_orderkey", "l_linenumber", v.alias("variant"), cl.parse_amount(text).alias("amount"),
                     cl.is_rounded(text).alias("rounded"))


def date_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rarer layouts: ISO with T, seconds, decimals or zone, slashes, eight digits, month names, two-digit years, each
    with and without a time of day; the last one has an hour that does not exist."""
    li = _li(spark, sf_dir, "l_orderkey", "l_linenumber", "l_shipdate")
    d = F.to_date("l_shipdate")
    layouts = ("yyyy-MM-dd'T'00:00:00", "yyyy-MM-dd'T'09:30", "yyyy-MM-dd 23:59", "yyyy/MM/dd", "yyyyMMdd",
               "d-MMMM-yyyy", "d-M-yy", "d.M.yy", "d MMMM yyyy", "dd-MM-yyyy 10:00", "dd/MM/yy 10:00",
               "yyyy-MM-dd'T'09:30:00'Z'", "yyyy-MM-dd 09:30:00.000", "d MMMM yy", "d MMM yy 7:05", "d-MMM-yy", "dd/MM/yyyy 24:10")
    v = ((c("l_orderkey") + c("l_linenumber")) % len(layouts)).cast("int")
    text = F.element_at(F.array(*[F.date_format(d, f) for f in layouts]), v + 1)
    return li.select("l_orderkey", "l_linenumber", v.alias("variant"), cl.parse_uk_date(text).alias("payment_date"))


def blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank-row filter per source file: line numbers 1 (mod 4) lose all core cells, 2 all but the amount."""
    raw = raw_payments(spark, sf_dir)
    kind = F.element_at(F.split("transaction_number", "-"), -1).cast("int") % 4
    emptied = raw.withColumns({name: F.when(~kind.isin(1, 2), c(name)) for name in CORE_COLS if name != "amount"} | {
        "amount": F.when(kind != 1, c("amount"))})
    kept = drop_blank_rows(emptied).groupBy("_source_file").agg(F.count(F.lit(1)).alias("clean_rows"))
    return raw_file_counts(spark, sf_dir).join(kept, "_source_file", "left").fillna(0, ["clean_rows"]).select(
        c("_source_file").alias("file"), "raw_rows", "clean_rows", (c("raw_rows") - c("clean_rows")).alias("dropped"))


def calendar_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar and fiscal attributes of every distinct order date."""
    d = c("d")
    dates = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("d")).distinct()
    return dates.select(
        d.alias("full_date"), cal.date_key(d).alias("date_key"), F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"), cal.month_name(d).alias("month_name"),
        cal.quarter_name(d).alias("quarter_name"), F.year(d).alias("year"),
        cal.fiscal_year(d).alias("uk_fiscal_year"), cal.fiscal_quarter(d).alias("uk_fiscal_quarter"),
        cal.half_year(F.month(d)).alias("half_year"))


def refund_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refund flag of signed amounts, with zero and missing amounts."""
    li = _li(spark, sf_dir, "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_tax",
             "l_discount")
    x = c("l_extendedprice").cast(cl.MONEY)
    amount = (F.when(c("l_tax") == 0, F.lit(None).cast(cl.MONEY))
               .when(c("l_returnflag") == "R", -x).when(c("l_discount") == 0, F.lit(0).cast(cl.MONEY))
               .otherwise(x))
    return li.select("l_orderkey", "l_linenumber", cl.refund_flag(amount).cast("int").alias("is_refund"))


def supplier_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 padded 'Limited', 1 lower case, 2 NBSP-wrapped 'LIMITED', 3 'unlimited co', 4 tab + 'plc'."""
    li = _li(spark, sf_dir, "l_orderkey", "l_linenumber", "l_suppkey")
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")
    x = li.join(sup, li.l_suppkey == sup.s_suppkey, "left")  # planner sizes the supplier side
    v = c("l_linenumber") % 5
    nb = " "
    text = (F.when(v == 0, F.concat(F.lit("  "), c("s_name"), F.lit("  Limited ")))
             .when(v == 1, F.concat(F.lower("s_name"), F.lit(" limited")))
             .when(v == 2, F.concat(F.lit(nb), c("s_name"), F.lit(f"{nb}LIMITED{nb}")))
             .when(v == 3, F.concat(c("s_name"), F.lit(" unlimited co")))
             .otherwise(F.concat(c("s_name"), F.lit("\t plc"))))
    return x.select("l_orderkey", "l_linenumber", v.alias("variant"),
                    cl.normalize_supplier(text).alias("supplier_name_clean"))


def title_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title case of part descriptions with hyphens, apostrophes, digits and padding."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_type", "p_brand")
    text = F.concat(F.lit(" "), F.lower("p_type"), F.lit("-"), c("p_name"), F.lit(" it's "),
                    (c("p_partkey") % 9).cast("string"), F.lit("rd "), F.upper("p_brand"), F.lit("  "))
    return part.select("p_partkey", cl.title_case(text).alias("expense_type"))


def group_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group / subgroup split of cost-centre names with one, two or no ' - ' separators."""
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    x = sup.join(F.broadcast(nation), sup.s_nationkey == nation.n_nationkey, "left")  # 25 rows
    v = c("s_suppkey") % 3
    area = (F.when(v == 0, F.concat(c("n_name"), F.lit(" - "), c("s_name")))
             .when(v == 1, F.concat(c("n_name"), F.lit(" - "), c("s_name"), F.lit(" - Unit")))
             .otherwise(F.concat(c("n_name"), F.lit("-"), c("s_name"))))
    group, sub = cl.split_group(area)
    return x.select("s_suppkey", group.alias("entity_group"), sub.alias("entity_subgroup"))


def null_token_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every missing-value marker becomes NULL; markers with a blank before them, in other case or inside text stay."""
    li = _li(spark, sf_dir, "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    marks = F.array(*[F.lit(t) for t in cl.NA_TOKENS])
    which = (c("l_orderkey") % len(cl.NA_TOKENS)).cast("int")
    mark, v = F.get(marks, which), c("l_linenumber") % 5
    text = (F.when(v < 2, mark).when(v == 2, F.concat(F.lit(" "), mark)).when(v == 3, F.concat(mark, c("l_returnflag")))
             .otherwise(F.concat(c("l_returnflag"), c("l_linestatus"))))
    return li.select("l_orderkey", "l_linenumber", which.alias("marker"), cl.null_tokens(text).alias("value"))


VARIANTS = {
    "c_amount": amount_variants, "c_amount_wide": amount_extremes, "c_date_layouts": date_layouts,
    "p_blank_rows": blank_rows, "c_date": date_variants, "c_calendar": calendar_attributes,
    "c_refund_flag": refund_flags, "c_supplier_name": supplier_variants, "c_title_case": title_variants,
    "c_group_split": group_variants, "s_null_tokens": null_token_variants,
}
