"""Payment rows derived from the TPC-H-style benchmark tables.

The original inputs (monthly government payment files) are not available, so
benchmark data is mapped onto the same raw layout: one line item = one payment.
The rows come out as *raw text* in the canonical columns, so the full cleaning
path (amount and date parsing, null markers, name normalisation, title case,
schema reconciliation) runs over every row at every scale.

Mapping (fixed, mirrored by the SQL oracle in ``__spark_entry__``):

* monthly source file      ``<month name>_<year>.csv`` of the ship date
* row position in file     ``(l_orderkey * 8 + l_linenumber) * 64`` plus the number, from 0, among the line items
                           that repeat both keys
* department / entity      region name / nation name of the supplier
* payment date             ship date as ``dd/MM/yyyy`` (``d/M/yyyy`` on line 3),
                           ``n/a`` when quantity is 13 and line status is O
* expense type             ``lower(p_type) || ' ' || lower(p_brand)`` padded with
                           spaces; missing when ``p_size = 1``
* expense area             ``<region> - <nation>``  (the cost centre)
* expenditure type         ``p_type``
* supplier                 ``s_name || ' Limited'`` on even lines, else
                           ``'  ' || upper(s_name) || '  LTD '``; missing when
                           ``l_partkey % 97 = 0``
* supplier post code       missing when ``l_orderkey % 5 < 3``, else
                           ``'N' || s_nationkey || ' ' || s_suppkey % 9 || 'QZ'``
* supplier type            ``'TYPE_' || s_nationkey % 4``
* transaction number       ``l_orderkey || '-' || l_linenumber`` (not unique)
* amount                   extended price with thousands separators, negative
                           for refunds (return flag R and quantity <= suppkey %
                           20), ``NA`` when discount and tax are both zero
* description              ``p_name``

Contract number and project code are absent, as in files that lack them.
"""

from __future__ import annotations

import calendar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators.staging import apply_null_tokens
from ledgerline.plans.materialize import sent_whole
from ledgerline.schema import load_key

#: Bits of a load-order key that hold the position: order keys go far beyond a file's rows.
POSITION_BITS = 49
#: What is known of a payment from its line item alone, a sum of these bits.
_UNDATED, _UNPRICED, _REFUND, _UNNAMED = 1, 2, 4, 8


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def payment_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the payment rows are made of: a row a line item, with its number among those that repeat both keys, and the
    columns of its part and supplier. No text is made yet, so that rows which are shuffled or stored in this form stay small.
    """
    keys, others = ("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                                                    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    col = F.col
    # line items that repeat both keys are told apart by their other columns
    li = _read(spark, sf_dir, "lineitem", *keys, *others).withColumn(
        "_copy", F.row_number().over(Window.partitionBy(*keys).orderBy(*others)) - 1)
    marks = {_UNDATED: (col("l_quantity") == 13) & (col("l_linestatus") == "O"),
             _UNPRICED: (col("l_discount") == 0) & (col("l_tax") == 0),
             _REFUND: (col("l_returnflag") == "R") & (col("l_quantity") <= col("l_suppkey") % 20),
             _UNNAMED: col("l_partkey") % 97 == 0}
    li = li.select(*keys, "_copy", "l_partkey", "l_suppkey", "l_extendedprice", F.to_date("l_shipdate").alias("_ship"),
                   sum((F.when(on, F.lit(bit)).otherwise(0) for bit, on in marks.items()), F.lit(0)).alias("_marks"))
    # line items are not shuffled for the suppliers, of which there are few beside them
    sup = sent_whole(_read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey"))
    # parts grow with the data: no hint, the planner and adaptive execution choose
    part = _read(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    nation = _read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region", "r_regionkey", "r_name")
    # nation and region have a fixed size (25 and 5 rows) at every scale factor.
    x = (li.join(part, li.l_partkey == part.p_partkey, "left")
           .join(sup, li.l_suppkey == sup.s_suppkey, "left")
           .join(F.broadcast(nation), sup.s_nationkey == nation.n_nationkey, "left")
           .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left"))
    return x.select(*keys, "_copy", "l_extendedprice", "_ship", "_marks", "p_name", "p_brand", "p_type",
                    (col("p_size") != 1).alias("_typed"), "s_name", "s_nationkey",
                    (col("s_suppkey") % 9).cast("int").alias("_district"), "n_name", "r_name")


def position() -> Column:
    """The row position in its file of a row of :func:`payment_items`."""
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 64 + F.col("_copy")


def source_file() -> Column:
    """The name of the monthly source file of a row of :func:`payment_items`."""
    return _source_file(F.col("_ship"))


def raw_payments(spark: SparkSession, sf_dir: str, null_markers: bool = False) -> DataFrame:
    """Raw payment rows (text columns + ``_source_file`` + ``_row_idx`` + ``_row_key``).

    Missing-value markers (``NA``, ``n/a``) become NULL as a CSV reader would
    treat them, unless ``null_markers`` keeps them as text (for writing files).
    """
    return payment_rows(payment_items(spark, sf_dir), null_markers)


def payment_rows(items: DataFrame, null_markers: bool = False, *others: str) -> DataFrame:
    """The raw payment rows of :func:`raw_payments`, made of :func:`payment_items` by a projection, which keeps their order;
    ``others`` names columns to keep beside them.
    """
    ship = F.col("_ship")
    price = F.format_number(F.col("l_extendedprice"), 2)
    col = F.col

    def marked(bit: int) -> Column:
        return col("_marks").bitwiseAND(bit) != 0

    out = items.select(
        *others, source_file().alias("_source_file"),
        position().alias("_row_idx"), load_key(_file_number(ship), position(), POSITION_BITS).alias("_row_key"),
        col("r_name").alias("department"),
        col("n_name").alias("entity"),
        F.when(marked(_UNDATED), F.lit("n/a"))
         .when(col("l_linenumber") == 3, F.date_format(ship, "d/M/yyyy"))
         .otherwise(F.date_format(ship, "dd/MM/yyyy")).alias("payment_date"),
        F.when(col("_typed"),
               F.concat(F.lit("  "), F.lower("p_type"), F.lit(" "), F.lower("p_brand"), F.lit(" ")))
         .alias("expense_type"),
        F.concat(col("r_name"), F.lit(" - "), col("n_name")).alias("expense_area"),
        col("p_type").alias("expenditure_type"),
        F.when(marked(_UNNAMED), F.lit(None).cast("string"))
         .when(col("l_linenumber") % 2 == 0, F.concat(col("s_name"), F.lit(" Limited")))
         .otherwise(F.concat(F.lit("  "), F.upper("s_name"), F.lit("  LTD "))).alias("supplier_name"),
        F.when(col("l_orderkey") % 5 >= 3,
               F.concat(F.lit("N"), col("s_nationkey").cast("string"), F.lit(" "),
                        col("_district").cast("string"), F.lit("QZ"))).alias("supplier_postcode"),
        F.concat(F.lit("TYPE_"), (col("s_nationkey") % 4).cast("string")).alias("supplier_type"),
        F.concat(col("l_orderkey").cast("string"), F.lit("-"),
                 col("l_linenumber").cast("string")).alias("transaction_number"),
        F.when(marked(_UNPRICED), F.lit("NA"))
         .when(marked(_REFUND), F.concat(F.lit("-"), price)).otherwise(price).alias("amount"),
        col("p_name").alias("description"),
    )
    return out.withColumns({"contract_number": F.lit("NA"), "project_code": F.lit(None).cast("string")}) \
        if null_markers else apply_null_tokens(out)


def _file_number(ship):
    """Numbers that order the source files by name: by the month's name, then the year (1900 to 2299)."""
    names = [calendar.month_name[m] for m in range(1, 13)]
    rank = F.array(*[F.lit(sorted(names).index(n)) for n in names])
    return F.get(rank, F.month(ship) - 1) * 400 + F.year(ship) - 1900


def _source_file(ship):
    return F.concat(F.lower(F.date_format(ship, "MMMM")), F.lit("_"), F.year(ship).cast("string"), F.lit(".csv"))


def raw_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows per source file: one payment per line item, counted from line items alone."""
    li = _read(spark, sf_dir, "lineitem", "l_shipdate")
    return li.groupBy(_source_file(F.to_date("l_shipdate")).alias("_source_file")).agg(
        F.count(F.lit(1)).alias("raw_rows"))
