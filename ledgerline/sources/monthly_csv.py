"""Monthly payment CSV files -> raw rows -> staging.

Files are latin-1 text with a header row; headers vary (12-14 of the 14 canonical columns, stray spaces, mixed
case, blank header cells, different order). All files are cut into records together (:mod:`csv_records`), large ones by
several tasks, quoted newlines included. The first record of each file is its header: one small table says for every
file which field holds which canonical column, and every record picks its fields by it. The number of jobs does not
depend on the number of files or of different headers.

A file that cannot be read (nothing in it, or two headers that mean the same column) is set aside with a status, and
the others are loaded. Rows whose core fields are all missing (blank and footer rows) are dropped; every remaining row
gets its 0-based position in the file, from counts per run of rows (one number a run), and a load-order key: files in
the order of their names, then positions.
"""

from __future__ import annotations

import posixpath
import re
from collections import Counter
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.cleaning import null_tokens, strip_ws
from ledgerline.operators.staging import clean, drop_blank_rows
from ledgerline.plans.materialize import new_location, write_table
from ledgerline.schema import CANONICAL_COLS, COLUMN_MAP, load_key
from ledgerline.sources.csv_records import file_id, joined_records, land, whole_records

#: What the audit says of a file.
OK, EMPTY, REPEATED = "ok", "empty", "repeated header"


_PLACES = [f"at_{c}" for c in CANONICAL_COLS]
#: Files that one load may have: their numbers take the upper bits of a load-order key.
MOST_FILES = 1 << 23


@dataclass(frozen=True)
class Ingest:
    raw: DataFrame          # canonical text columns, ``_source_file``, ``_row_idx``, ``_row_key``
    raw_counts: DataFrame   # (``_source_file``, ``raw_rows``, ``blank_rows``) of the files that were loaded
    headers: DataFrame      # (``file``, ``ordinal``, ``column``, ``canonical``)
    audit: DataFrame        # (``file``, ``path``, ``status``, ``columns``, ``columns_added``, ``detail``), one row a file
    files: list[str]

    def staging(self) -> DataFrame:
        return clean(self.raw)


def _scan(spark: SparkSession, src: str | list[str], names: str) -> DataFrame:
    return spark.read.option("pathGlobFilter", names).text(src)


def labels(paths: list[str]) -> list[tuple[str, str, int]]:
    """(path, label, number) in load order: by file name, then path. The label is the name, or where names
    repeat the path below the folder that all files share."""
    def parts(p: str) -> list[str]:
        return unquote(urlparse(p).path).strip("/").split("/")
    split = {p: parts(p) for p in paths}
    many = {n for n, k in Counter(x[-1] for x in split.values()).items() if k > 1}
    shared = len(posixpath.commonprefix([x[:-1] for x in split.values()])) if many else 0
    ordered = sorted(paths, key=lambda p: (split[p][-1], p))
    return [(p, "/".join(split[p][shared:]) if split[p][-1] in many else split[p][-1], i) for i, p in enumerate(ordered)]


def list_csv_files(df: DataFrame) -> list[str]:
    """The files of a scan, empty ones included, as the scan's rows name them."""
    return [re.sub(r"^([\w+.-]+):///", r"\1:/", p) for p in df.inputFiles()]


def _normal(header: Column) -> Column:
    """strip + lower-case."""
    return F.lower(strip_ws(header))


def _canonical(header: Column) -> Column:
    """The canonical column that a header means, or null."""
    known = F.create_map(*[F.lit(x) for pair in COLUMN_MAP.items() for x in pair])
    return F.try_element_at(known, _normal(header))


def _file_table(spark: SparkSession, files: list[str], header: DataFrame) -> DataFrame:
    """One row a file: id, path, label, number, status, its header and where each canonical column is in it."""
    named = spark.createDataFrame(labels(files), "path string, label string, number long").withColumn("file", file_id(F.col("path")))
    own = header.select("file", F.col("fields").alias("header"),
                        F.transform("fields", _canonical).alias("canon"),
                        F.filter(F.transform("fields", _normal), lambda n: n != "").alias("names"))
    repeated = F.array_sort(F.filter(F.array_distinct("names"), lambda n: F.size(
        F.filter(F.col("names"), lambda m: m == n)) > 1))
    places = [(F.array_position("canon", c) - 1).cast("int").alias(f"at_{c}") for c in CANONICAL_COLS]
    out = named.join(own.select("file", "header", repeated.alias("repeated"), *places), "file", "left")
    status = F.when(F.col("header").isNull(), EMPTY).when(F.size("repeated") > 0, REPEATED).otherwise(OK)
    return out.withColumn("status", status).withColumn("layout", F.xxhash64(*_PLACES))


def read_monthly(spark: SparkSession, src_dir: str, names: str = "*.csv") -> Ingest:
    """Raw rows of every file with such a name (``*.csv``; case-sensitive) under ``src_dir``, quoted newlines included.

    Files may be compressed (``names="*.csv.gz"``); each of these is read by one task.
    """
    return _read(spark, src_dir, f"no {names} files under {src_dir}", names)


def read_files(spark: SparkSession, files: list[str]) -> Ingest:
    """Raw rows of the given CSV files (any order; load order is by file name)."""
    return _read(spark, files, "no files")


def _read(spark: SparkSession, src: str | list[str], nothing: str, names: str = "*.csv") -> Ingest:
    scan = _scan(spark, src, names)
    paths = list_csv_files(scan)
    if not paths:
        raise FileNotFoundError(nothing)
    if len(paths) >= MOST_FILES:
        raise ValueError(f"{len(paths)} files: load fewer than {MOST_FILES} at once")
    landed = land(scan)
    whole, joined = whole_records(landed), joined_records(landed)
    first = (F.col("block") == 0) & (F.col("pos") == 0)
    header = whole.where(first).unionByName(joined.where(first))
    files = write_table(_file_table(spark, paths, header), new_location(spark, "csv-files"))
    good = files.where(F.col("status") == OK)
    # rows stay in file order: both sides that they are joined with are broadcast, three numbers a file of at most
    # MOST_FILES, and the places of the columns once for every different header
    of_file, layouts = good.select("file", "number", "layout"), good.select("layout", *_PLACES).distinct()

    def rows(records: DataFrame) -> DataFrame:
        """Records of good files with their canonical columns, missing values as null."""
        field = {c: F.when(F.col(f"at_{c}") >= 0, F.get("fields", F.col(f"at_{c}"))) for c in CANONICAL_COLS}
        return records.where(~first).join(F.broadcast(of_file), "file").join(F.broadcast(layouts), "layout").select(
            "number", "block", "pos", *[null_tokens(x).alias(c) for c, x in field.items()])

    def kept(records: DataFrame, place: Column) -> DataFrame:
        """Rows that are not blank; ``place`` numbers them in order within a partition."""
        return drop_blank_rows(rows(records)).withColumn("place", place).withColumn("run", F.shiftright("place", 33))

    order = F.monotonically_increasing_id()
    both = kept(whole, order).unionByName(kept(joined, F.lit(-1).cast("long")))
    # rows of one split in one partition are a run of consecutive positions
    runs = both.groupBy("number", "block", "run").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place0"),
                                                      F.min("pos").alias("pos0"))
    earlier = Window.partitionBy("number").orderBy("block", "pos0").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    runs = write_table(runs.select("number", "block", "run", "place0", "before", "n"), new_location(spark, "csv-runs"))
    position = F.col("before") + F.col("place") - F.col("place0")
    names = good.select("number", F.col("label").alias("_source_file"))
    raw = both.join(runs.drop("n"), ["number", "block", "run"]).withColumn("_row_idx", position).join(names, "number") \
        .withColumn("_row_key", load_key(F.col("number"), F.col("_row_idx"))) \
        .select(*CANONICAL_COLS, "_source_file", "_row_idx", "_row_key")

    counted = whole.select("file", "block", "pos").unionByName(joined.select("file", "block", "pos")).where(~first) \
        .groupBy("file").agg(F.count(F.lit(1)).alias("raw_rows"))
    clean_rows = runs.groupBy("number").agg(F.sum("n").alias("clean_rows"))
    raw_counts = good.select("file", "number", F.col("label").alias("_source_file")).join(counted, "file", "left") \
        .join(clean_rows, "number", "left").fillna(0, ["raw_rows", "clean_rows"]).select(
            "_source_file", "raw_rows", (F.col("raw_rows") - F.col("clean_rows")).alias("blank_rows"))

    headers = files.select(F.col("label").alias("file"), F.posexplode("header").alias("ordinal", "column")).withColumn(
        "canonical", _canonical(F.col("column")))
    present = sum(((F.col(at) >= 0).cast("int") for at in _PLACES), F.lit(0))
    audit = files.select(F.col("label").alias("file"), "path", "status", F.coalesce(F.size("header"), F.lit(0)).alias("columns"),
                         F.when(F.col("status") == OK, F.lit(len(CANONICAL_COLS)) - present).alias("columns_added"),
                         F.when(F.col("status") == REPEATED, F.array_join("repeated", ", ")).alias("detail"))
    return Ingest(raw, raw_counts, headers, audit, [p for p, _, _ in labels(paths)])


def header_audit(ingest: Ingest) -> DataFrame:
    """Distinct normalised header names over all files, with how many files carry each."""
    return (ingest.headers.groupBy(_normal(F.col("column")).alias("column"))
                  .agg(F.count_distinct("file").alias("files")).orderBy("column"))


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """Per-file load summary as one CSV with a header (one row per file: tiny)."""
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_staging(staging: DataFrame, path: str, replace_files_only: bool = True) -> None:
    """Write staging partitioned by source file.

    With ``replace_files_only`` a load replaces just the files it contains
    (dynamic partition overwrite), so re-delivering one month rewrites only it.
    """
    mode = "dynamic" if replace_files_only else "static"
    (staging.write.mode("overwrite").option("partitionOverwriteMode", mode)
            .partitionBy("_source_file").parquet(path))


def columns_added(ingest: Ingest) -> DataFrame:
    """Per loaded file: canonical columns its header lacks (added as NULL by reconciliation)."""
    return ingest.audit.where(F.col("status") == OK).select("file", F.col("columns_added").cast("long").alias("columns_added"))
