"""Star schema build: four dimensions and one fact from the staging rows.

"Keep first" picks, per dimension grain, the row that comes first in load order. The order is one number a row
(``_row_key``: file, then position), so the first row of a grain value is a plain minimum in a hash aggregate, which
combines map-side and needs no sort; the attributes are then looked up by that number.

Surrogate keys are dense: members are numbered from 1 in the order in which they were first seen. The numbers
come from sums per range of the order, never from one sorted task. A key map (grain to key) is stored beside the
tables; a later load that is given it leaves every known member its key, members that have gone keep theirs in
the map, and only new members are numbered, after the largest key.

Fact rows resolve their keys with left joins; the supplier and expense joins are NULL-safe (NULL post code matches
NULL post code), so no row is dropped and none fans out (each dimension is unique on its join key).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import (date_key, fiscal_quarter, fiscal_year, half_year, month_name,
                                  quarter_name, split_group)
from ledgerline.operators.ranking import before
from ledgerline.plans.materialize import new_location, sent_whole, write_table


@dataclass(frozen=True)
class Tables:
    fact: DataFrame
    dim_date: DataFrame
    dim_supplier: DataFrame
    dim_expense: DataFrame
    dim_entity: DataFrame
    staging: DataFrame | None = None
    #: Key maps: by dimension, the key of every grain value that was ever loaded.
    keys: dict[str, DataFrame] = field(default_factory=dict)

    def register(self, prefix: str = "") -> None:
        """Expose the five tables as temp views (``fact_transactions``, ``dim_*``)."""
        self.fact.createOrReplaceTempView(f"{prefix}fact_transactions")
        for name in ("dim_date", "dim_supplier", "dim_expense", "dim_entity"):
            getattr(self, name).createOrReplaceTempView(f"{prefix}{name}")


@dataclass(frozen=True)
class Grain:
    """What a dimension has one row of, which rows it is built from and which attributes its first row gives."""

    key: str
    columns: tuple[str, ...]
    attributes: tuple[str, ...]

    def rows(self, stg: DataFrame) -> DataFrame:
        """Staging rows with a member: suppliers need a name, the others any grain column."""
        needed = self.columns[:1] if self.key == "supplier_key" else self.columns
        return stg.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in needed]))


GRAINS = {
    "dim_supplier": Grain("supplier_key", ("supplier_name", "supplier_postcode"), ("supplier_name_clean", "supplier_type")),
    "dim_expense": Grain("expense_key", ("expense_type", "expense_area"), ("expenditure_type",)),
    "dim_entity": Grain("entity_key", ("expense_area",), ("department",)),
}


def _same(one: DataFrame, two: DataFrame, columns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [one[c].eqNullSafe(two[c]) for c in columns])


def members(stg: DataFrame, grain: Grain) -> DataFrame:
    """The grain's values with ``_first``, the load-order number of the first row that has it."""
    return grain.rows(stg).groupBy(*grain.columns).agg(F.min("_row_key").alias("_first"))


def number_members(found: DataFrame, grain: Grain, known: DataFrame | None = None) -> DataFrame:
    """``found`` with keys: those of the key map ``known``, and new ones in first-seen order after its largest."""
    if known is None:
        return before(found, "_first").withColumn(grain.key, F.col("_before") + 1).drop("_before")
    old = known.select(*grain.columns, F.col(grain.key))
    largest = F.coalesce(known.agg(F.max(grain.key)).scalar(), F.lit(0))
    new = before(found.join(old, _same(found, old, grain.columns), "left_anti"), "_first")
    kept = found.join(old, _same(found, old, grain.columns)).select(*[found[c] for c in found.columns], old[grain.key])
    return kept.unionByName(new.withColumn(grain.key, largest + F.col("_before") + 1).drop("_before"))


def key_map(numbered: DataFrame, grain: Grain, known: DataFrame | None = None) -> DataFrame:
    """Keys of all members of this load, and of earlier ones that it lacks."""
    now = numbered.select(*grain.columns, grain.key)
    if known is None:
        return now
    old = known.select(*grain.columns, grain.key)
    return now.unionByName(old.join(now, _same(old, now, grain.columns), "left_anti"))


def _with_attributes(stg: DataFrame, numbered: DataFrame, grain: Grain) -> DataFrame:
    """Members with the attributes of their first row."""
    first = grain.rows(stg).select(F.col("_row_key").alias("_first"), *[F.col(a) for a in grain.attributes])
    return first.join(numbered, "_first").drop("_first")


def build_dim_date(stg: DataFrame) -> DataFrame:
    d = F.col("full_date")
    dates = stg.where(F.col("payment_date").isNotNull()).select(
        F.col("payment_date").alias("full_date")).distinct()
    return dates.select(
        date_key(d).alias("date_key"), d,
        F.dayofmonth(d).alias("day"), F.month(d).alias("month"), month_name(d).alias("month_name"),
        quarter_name(d).alias("quarter_name"), F.year(d).alias("year"),
        fiscal_year(d).alias("uk_fiscal_year"), fiscal_quarter(d).alias("uk_fiscal_quarter"),
        half_year(F.month(d)).alias("half_year"),
    )


def build_dimension(name: str, stg: DataFrame, numbered: DataFrame) -> DataFrame:
    """A dimension's columns from its numbered members."""
    df = _with_attributes(stg, numbered, GRAINS[name])
    if name == "dim_supplier":
        return df.select("supplier_key", F.col("supplier_name").alias("supplier_name_raw"), "supplier_name_clean",
                         "supplier_postcode", "supplier_type")
    if name == "dim_expense":
        return df.select("expense_key", "expense_type", "expense_area", "expenditure_type")
    group, subgroup = split_group(F.col("expense_area"))
    return df.select("entity_key", "department", F.col("expense_area").alias("entity_name"),
                     group.alias("entity_group"), subgroup.alias("entity_subgroup"))


def build_fact(stg: DataFrame, dim_supplier: DataFrame, dim_expense: DataFrame,
               dim_entity: DataFrame) -> DataFrame:
    """Fact rows with their keys; rows that cannot match a dimension carry a salt, so that they share no shuffle key."""
    sup = dim_supplier.select(
        F.lit(0).alias("_s_salt"), "supplier_key", F.col("supplier_name_raw").alias("_s_raw"),
        F.col("supplier_postcode").alias("_s_pc"))
    exp = dim_expense.select(
        F.lit(0).alias("_e_salt"), "expense_key", F.col("expense_type").alias("_e_type"), F.col("expense_area").alias("_e_area"))
    ent = dim_entity.select(F.lit(0).alias("_n_salt"), "entity_key", F.col("entity_name").alias("_n_area"))
    s = F.col

    def salt(*names: str):
        unmatched = reduce(lambda a, b: a & b, [s(n).isNull() for n in names])
        return F.when(unmatched, F.hash("_row_key")).otherwise(F.lit(0))

    f = (stg.join(sup, (salt("supplier_name") == s("_s_salt")) & s("supplier_name").eqNullSafe(s("_s_raw"))
                  & s("supplier_postcode").eqNullSafe(s("_s_pc")), "left")
            .join(exp, (salt("expense_type", "expense_area") == s("_e_salt")) & s("expense_type").eqNullSafe(s("_e_type"))
                  & s("expense_area").eqNullSafe(s("_e_area")), "left")
            .join(ent, (salt("expense_area") == s("_n_salt")) & (s("expense_area") == s("_n_area")), "left"))
    return f.select(
        s("_row_key").alias("transaction_key"), "row_id",
        date_key(s("payment_date")).alias("date_key"),
        "supplier_key", "expense_key", "entity_key", "transaction_number", "amount",
        s("is_refund").cast("int").alias("is_refund"), "description",
        s("_source_file").alias("source_file"), s("_load_timestamp").alias("load_timestamp"),
    )


def build_warehouse(stg: DataFrame, keys: dict[str, DataFrame] | None = None) -> Tables:
    """Lazy star schema over a staging DataFrame that carries ``_row_key``.

    The staging input must be stable under recomputation (a stored table, or
    a small local relation); use :func:`materialize_warehouse` for real loads.
    """
    known = keys or {}
    numbered = {n: number_members(members(stg, g), g, known.get(n)) for n, g in GRAINS.items()}
    dims = {n: build_dimension(n, stg, x) for n, x in numbered.items()}
    maps = {n: key_map(x, GRAINS[n], known.get(n)) for n, x in numbered.items()}
    return Tables(build_fact(stg, *dims.values()), build_dim_date(stg), *dims.values(), stg, maps)


def _narrow(name: str, dim: DataFrame) -> DataFrame:
    """What the fact needs of a dimension."""
    grain = {"dim_supplier": ("supplier_name_raw", "supplier_postcode"), "dim_expense": ("expense_type", "expense_area"),
             "dim_entity": ("entity_name",)}[name]
    return dim.select(GRAINS[name].key, *grain)


def materialize_warehouse(spark: SparkSession, staging: DataFrame, location: str | None = None,
                          keys: dict[str, DataFrame] | None = None) -> Tables:
    """Full refresh: write staging, then keys and dimensions, then the fact; read all back.

    ``keys`` are the key maps of an earlier load (``Tables.keys``): members known there keep their keys. The staging
    write fixes the rows once. Dimensions are read back before the
    fact is built, which gives the fact joins real (file-based) size estimates.
    """
    base, known = location or new_location(spark, "warehouse"), keys or {}
    stg = write_table(staging, f"{base}/stg_transactions", compression="zstd")

    def dimension(name: str) -> tuple[DataFrame, DataFrame]:
        grain = GRAINS[name]
        found = write_table(members(stg, grain), f"{base}/members_{name}")
        numbered = write_table(number_members(found, grain, known.get(name)), f"{base}/numbered_{name}")
        own = numbered if name not in known else write_table(key_map(numbered, grain, known[name]), f"{base}/keys_{name}")
        return write_table(build_dimension(name, stg, sent_whole(numbered)), f"{base}/{name}"), own

    # the dimensions are independent: submit them together so their
    # scans and aggregations share the cluster instead of running back to back
    with ThreadPoolExecutor(max_workers=len(GRAINS) + 1) as pool:
        dates = pool.submit(write_table, build_dim_date(stg), f"{base}/dim_date")
        futures = {n: pool.submit(dimension, n) for n in GRAINS}
        built = {n: f.result() for n, f in futures.items()}
        ddate = dates.result()
    dims = [d for d, _ in built.values()]
    fact = write_table(build_fact(stg, *[sent_whole(_narrow(n, d)) for n, d in zip(GRAINS, dims)]), f"{base}/fact_transactions",
                       compression="zstd")
    return Tables(fact, ddate, *dims, stg, {n: m for n, (_, m) in built.items()})


def dense_keys(t: Tables) -> DataFrame:
    """(dimension, name1, name2, member_key): the key of every member of every dimension."""
    parts = [_named(name, t.keys[name], grain) for name, grain in GRAINS.items()]
    return reduce(DataFrame.unionByName, parts)


def _named(name: str, keyed: DataFrame, grain: Grain, *others: str) -> DataFrame:
    names = [F.col(c) for c in grain.columns] + [F.lit(None).cast("string")]
    return keyed.select(F.lit(name).alias("dimension"), names[0].alias("name1"), names[1].alias("name2"), *others,
                        F.col(grain.key).alias("member_key"))


def keys_after_reload(t: Tables, before_file: str = "m") -> DataFrame:
    """Keys when the files named before ``before_file`` were loaded first and all files after them, with the first load's
    key maps: (dimension, name1, name2, is_new, member_key)."""
    parts = []
    spark = t.staging.sparkSession
    for name, grain in GRAINS.items():
        # the rows are read once a dimension; both loads' members follow from the first rows of all files and of the early ones
        early = F.col("_source_file") < before_file
        found = write_table(grain.rows(t.staging).groupBy(*grain.columns).agg(
            F.min("_row_key").alias("_first"), F.min(F.when(early, F.col("_row_key"))).alias("_early"), F.max(early).alias("_known")),
            new_location(spark, "reload-members"))
        first = found.where("_known").select(*grain.columns, F.col("_early").alias("_first"))
        known = write_table(key_map(number_members(first, grain), grain), new_location(spark, "reload-keys"))
        numbered = number_members(found.drop("_early", "_known"), grain, known)
        largest = known.agg(F.max(grain.key)).scalar()
        parts.append(_named(name, numbered.withColumn("is_new", F.col(grain.key) > F.coalesce(largest, F.lit(0))), grain, "is_new"))
    return reduce(DataFrame.unionByName, parts)


def fact_with_natural_keys(t: Tables) -> DataFrame:
    """Fact rows with each surrogate key replaced by the natural key it resolved to."""
    sup = t.dim_supplier.select("supplier_key", "supplier_name_raw", "supplier_postcode")
    exp = t.dim_expense.select("expense_key", "expense_type", "expense_area")
    ent = t.dim_entity.select("entity_key", "entity_name")
    f = (t.fact.join(sup, "supplier_key", "left").join(exp, "expense_key", "left")
               .join(ent, "entity_key", "left"))
    return f.select("row_id", "date_key", "supplier_name_raw", "supplier_postcode", "expense_type",
                    "expense_area", "entity_name", "transaction_number",
                    F.col("amount").cast("double").alias("amount"), "is_refund", "description", "source_file")
