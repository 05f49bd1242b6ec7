"""CSV ingest on hand-made monthly files (latin-1, ragged headers, quoting, footers)."""

import csv
import datetime as dt
import gzip
import io
import os
import random
from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from ledgerline import catalog
from ledgerline.operators import checks
from ledgerline.operators.warehouse import materialize_warehouse
from ledgerline.sources.csv_records import ends_inside, parsed
from ledgerline.sources.monthly_csv import columns_added, header_audit, read_files, read_monthly

APRIL = (
    b' Department ,ENTITY,Date of Payment,Expense Type,Expense Area,Supplier,Transaction Number,'
    b'Amount,Description,Supplier Post Code,Supplier Type,Contract Number,Project Code,Expenditure Type\r\n'
    b'DEPT,Core,03/04/2015,it\'s non-pay,Growth - Regional,\xa0Acme  Limited\xa0,T1,"1,234.50",'
    b'"Desk, chairs",AB1 2CD,Private,,,Capital\r\n'
    b'DEPT,Core,3/4/2015,staff,Growth,"Caf\xe9 ""Bar"" Ltd",T2,-5,"line one\nline two",,Public,,,Resource\r\n'
    b'DEPT,Core,31/02/2015,staff,,Acme Limited,T3,NA,x,AB1 2CD,Private,,,Capital\r\n'
)
AUGUST = (
    b'Supplier,Amount,Date of Payment,Department,Entity,Expense Type,Expense Area,Transaction Number,'
    b'Description,Supplier Post Code,Supplier Type,Expenditure Type\n'
    b'Acme Limited,100,01/08/2015,DEPT,Core,staff,Growth - Regional,T9,y,AB1 2CD,Other,Capital\n'
)
MAY = (
    b'Department,Entity,Date of Payment,Expense Type,Expense Area,Supplier,Transaction Number,Amount,'
    b'Description,Supplier Post Code,Supplier Type,Contract Number,Project Code,Expenditure Type,\n'
    b'DEPT,Core,05/05/2015,staff,Growth,Beta plc,T5,10,a,N/A,Private,NULL,nan,Capital,\n'
    b',,,,,,,,,,,,,,\n'
    b'DEPT,Core,06/05/2015,staff,Growth,Beta plc,T5,20,b,,Private,,,Capital,\n'
    b'DEPT,Core,06/05/2015,staff,Growth,Beta plc,T5,20,b,,Private,,,Capital,\n'
    b',,,,,,,,,,,,,,\n'
    b',,,,,,,,,,,,,,\n'
)


def write_fixtures(d):
    for name, data in (("april_2015.csv", APRIL), ("august_2015.csv", AUGUST), ("may_2015.csv", MAY),
                       ("notes.CSV", b"a,b\n1,2\n"), ("readme.txt", b"x")):
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    return d


def write(folder, **files):
    for name, data in files.items():
        path = os.path.join(folder, *name.split("__")) + ".csv"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)


def test_bad_files_are_set_aside(spark, tmpdir_path):
    write(tmpdir_path, good=AUGUST, nothing=b"", blank=b"\n \n\r\n", twice=b"Amount, amount ,Supplier\n1,2,x\n",
          headers=b"Department,Supplier,Amount,Date of Payment\n")
    ing = read_monthly(spark, tmpdir_path)
    audit = {r.file: (r.status, r.columns, r.columns_added, r.detail) for r in ing.audit.collect()}
    assert audit == {"good.csv": ("ok", 12, 2, None), "nothing.csv": ("empty", 0, None, None), "blank.csv": ("empty", 0, None, None),
                     "twice.csv": ("repeated header", 3, None, "amount"), "headers.csv": ("ok", 4, 10, None)}
    assert len(ing.files) == 5
    assert [r.row_id for r in ing.staging().collect()] == ["good_0"]
    counts = {r._source_file: (r.raw_rows, r.blank_rows) for r in ing.raw_counts.collect()}
    assert counts == {"good.csv": (1, 0), "headers.csv": (0, 0)}
    only_bad = os.path.join(tmpdir_path, "bad")
    write(only_bad, twice=b"Amount,amount\n1,2\n")
    assert read_monthly(spark, only_bad).staging().count() == 0
    with pytest.raises(FileNotFoundError):
        os.mkdir(os.path.join(tmpdir_path, "none"))
        read_monthly(spark, os.path.join(tmpdir_path, "none"))


def test_files_of_one_name_stay_apart(spark, tmpdir_path):
    body = b"Department,Supplier,Amount,Date of Payment\nD,S,1,01/04/2015\nD,S,2,01/04/2015\n"
    files = [os.path.join(tmpdir_path, d, "a_2015.csv") for d in ("north", "south")]
    write(tmpdir_path, north__a_2015=body, south__a_2015=body)
    ing = read_files(spark, files)
    stg = ing.staging()
    rows = sorted((r._source_file, r.row_id, r._row_idx) for r in stg.collect())
    assert rows == [(f"{d}/a_2015.csv", f"{d}/a_2015_{i}", i) for d in ("north", "south") for i in (0, 1)]
    quality = {r.file: (r.raw_rows, r.clean_rows) for r in checks.k6_load_quality(stg, ing.raw_counts).collect()}
    assert quality == {f"{d}/a_2015.csv": (2, 2) for d in ("north", "south")}


def test_the_number_of_jobs_does_not_follow_the_files(spark, tmpdir_path):
    tracker, jobs = spark.sparkContext.statusTracker(), {}
    for n in (2, 12):
        folder = os.path.join(tmpdir_path, str(n))
        write(folder, **{f"f{i}": b"Department,Supplier,Amount,Date of Payment%s\nD,S,%d,01/04/2015\n" % (b",Extra%d" % i, i)
                         for i in range(n)})
        spark.sparkContext.setJobGroup(f"files-{n}", "")
        assert read_monthly(spark, folder).staging().count() == n
        jobs[n] = len(tracker.getJobIdsForGroup(f"files-{n}"))
    spark.sparkContext.setJobGroup("other", "")
    assert jobs[2] == jobs[12]


def test_counters_of_the_load(spark, tmpdir_path):
    write(tmpdir_path, m=b"Department,Supplier,Amount,Date of Payment\nD,S,1.005,01/04/2015\n,,,\nD,S,0.00000000001,31/02/2015\n"
          b"D,S,1.500,n/a\nD,S,\xa35,01/04/2015\nD,S,NA,01/04/2015\nD,S,12345e-3,01/04/2015\nD,S,100e-4,01/04/2015\n")
    ing = read_monthly(spark, tmpdir_path)
    r = checks.k6_load_quality(ing.staging(), ing.raw_counts, columns_added(ing)).first()
    assert (r.raw_rows, r.clean_rows, r.dropped, r.columns_added) == (8, 7, 1, 10)
    assert (r.null_amounts, r.unparsed_amounts, r.rounded_amounts, r.bad_dates, r.unparsed_dates) == (2, 1, 3, 2, 1)


def test_ingest_fixtures(spark, tmpdir_path):
    ing = read_monthly(spark, write_fixtures(tmpdir_path))
    assert [os.path.basename(f) for f in ing.files] == ["april_2015.csv", "august_2015.csv", "may_2015.csv"]
    stg = ing.staging()
    rows = {r.row_id: r for r in stg.collect()}
    assert sorted(rows) == ["april_2015_0", "april_2015_1", "april_2015_2", "august_2015_0",
                            "may_2015_0", "may_2015_1", "may_2015_2"]
    a0, a1, a2 = rows["april_2015_0"], rows["april_2015_1"], rows["april_2015_2"]
    assert a0.department == "DEPT" and a0.entity == "Core"
    assert a0.amount == Decimal("1234.50") and a0.description == "Desk, chairs"
    assert a0.supplier_name == "\xa0Acme  Limited\xa0" and a0.supplier_name_clean == "ACME LTD"
    assert a0.expense_type == "It'S Non-Pay" and a0.expense_area == "Growth - Regional"
    assert a0.payment_date == dt.date(2015, 4, 3) and a0.uk_fiscal_year == "FY2015/16"
    assert a0.uk_fiscal_quarter == "Q1" and a0.payment_month_name == "April"
    assert a1.supplier_name == 'Café "Bar" Ltd' and a1.description == "line one\nline two"
    assert a1.amount == Decimal("-5.00") and a1.is_refund is True
    assert a2.amount is None and a2.is_refund is False and a2.payment_date is None
    aug = rows["august_2015_0"]
    assert aug.contract_number is None and aug.project_code is None and aug.amount == Decimal("100.00")
    m0 = rows["may_2015_0"]
    assert m0.supplier_postcode is None and m0.contract_number is None and m0.project_code is None

    quality = {r.file: r for r in checks.k6_load_quality(stg, ing.raw_counts).collect()}
    assert quality["may_2015.csv"].raw_rows == 6 and quality["may_2015.csv"].dropped == 3
    assert quality["april_2015.csv"].null_amounts == 1 and quality["april_2015.csv"].bad_dates == 1
    added = {r.file: r.columns_added for r in columns_added(ing).collect()}
    assert added == {"april_2015.csv": 0, "august_2015.csv": 2, "may_2015.csv": 0}
    audit = {r.column: r.files for r in header_audit(ing).collect()}
    assert audit["contract number"] == 2 and audit["amount"] == 3


def test_csv_to_warehouse_keep_first(spark, tmpdir_path):
    ing = read_monthly(spark, write_fixtures(tmpdir_path))
    t = materialize_warehouse(spark, ing.staging())
    sup = {(r.supplier_name_raw, r.supplier_postcode): r.supplier_type for r in t.dim_supplier.collect()}
    # (Acme Limited, AB1 2CD) is Private in april and Other in august: april comes first
    assert sup[("Acme Limited", "AB1 2CD")] == "Private"
    assert t.fact.count() == 7
    keys = t.fact.where("supplier_key IS NULL").count()
    assert keys == 0  # NULL post codes resolve NULL-safely
    ent = {r.entity_name: (r.entity_group, r.entity_subgroup) for r in t.dim_entity.collect()}
    assert ent == {"Growth - Regional": ("Growth", "Regional"), "Growth": ("Growth", None)}


HEADER = b"Department,Supplier,Amount,Date of Payment,Description\n"


def read_in_pieces(spark, folder, size):
    """Rows of the folder's files, read in splits of about ``size`` bytes, and the number of splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        splits = spark.read.text(folder).rdd.getNumPartitions()
        return read_monthly(spark, folder).raw.collect(), splits
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quoted_newlines_across_splits(spark, tmpdir_path):
    """Splits that start, end or lie inside quoted fields: every record and position as by one reader."""
    r = random.Random(5)
    long = '"' + "\n".join("one, two \"\"three" for _ in range(400)) + '"'
    cells = ['"a\nb"', '"x, ""y"", z"', "plain", '5" pipe', '"two\r\nlines"', '""', long, '"end"s', "", '"\n"', '"a ""\n"" b"']
    for name, ending in (("first", "\n"), ("second", "\r\n")):
        body = []
        for i in range(3000):
            body.append(f"DEPT,S{i},{i},01/04/2015,{r.choice(cells)}")
            if i % 97 == 0:
                body.append(",,,,")
            if i % 113 == 0:
                body.append("")
        write(tmpdir_path, **{name: (HEADER.decode() + ending.join(body) + (ending if name == "first" else "")).encode("latin-1")})
    rows, splits = read_in_pieces(spark, tmpdir_path, 20_000)
    assert splits > 8
    for name in ("first", "second"):
        text = open(os.path.join(tmpdir_path, f"{name}.csv"), newline="").read().replace("\r\n", "\n")
        want = [x for x in csv.reader(io.StringIO(text, newline="")) if x and any(x[:4])][1:]
        own = sorted((x for x in rows if x._source_file == f"{name}.csv"), key=lambda x: x._row_idx)
        assert [x._row_idx for x in own] == list(range(3000))
        assert [(x.supplier_name, x.amount, x.description) for x in own] == [(x[1], x[2], x[4] or None) for x in want]
    # the same rows as Spark's own reader, which gives a file to one task
    usual, folder = ['"a\nb"', '"x, ""y"", z"', "plain", long, ""], os.path.join(tmpdir_path, "usual")
    body = [f"DEPT,S{i},{i},01/04/2015,{r.choice(usual)}" for i in range(2000)]
    write(folder, a=HEADER + "\n".join(body[:1500]).encode(), b=HEADER + "\n".join(body[1500:]).encode())
    rows, splits = read_in_pieces(spark, folder, 20_000)
    own = spark.read.options(header=True, multiLine=True, escape='"', encoding="ISO-8859-1").csv(folder)
    got = sorted((x.supplier_name, x.amount, x.description or "") for x in rows)
    assert splits > 8 and got == sorted((x.Supplier, x.Amount, x.Description or "") for x in own.collect())


def test_a_field_that_is_never_closed_ends_with_its_file(spark, tmpdir_path):
    write(tmpdir_path, a=HEADER + b'D,S1,1,01/04/2015,x\nD,S2,2,01/04/2015,"open\nD,S3,3,01/04/2015,y\n' * 1, b=HEADER + b"D,T,4,01/04/2015,z")
    for size in (1 << 20, 30):
        rows, _ = read_in_pieces(spark, tmpdir_path, size)
        assert sorted((x.supplier_name, x._row_idx) for x in rows) == [("S1", 0), ("S2", 1), ("T", 0)]


@given(st.lists(st.sampled_from(['"', ",", "\n", "a", '""', '","', "b c"]), max_size=30))
@settings(max_examples=400, deadline=None)
def test_lines_end_inside_as_the_usual_reader_says(parts):
    """A text is one record exactly if no line before its last leaves a quoted field open."""
    text = "".join(parts)
    inside, records, now = False, [], []
    for line in text.split("\n"):
        now.append(line)
        inside = ends_inside(line, inside)
        if not inside:
            records.append("\n".join(now))
            now = []
    if now:
        records.append("\n".join(now))
    want = [x for x in csv.reader(io.StringIO(text, newline="")) if x]
    assert [parsed(x) for x in records if x] == want


def test_split_files_keep_exact_positions(spark, tmpdir_path):
    """A file split across several tasks keeps exact per-file positions."""
    header = b"Department,Supplier,Amount,Date of Payment\n"
    body = b"".join(b"DEPT,S%d,%d,01/04/2015\n" % (i, i) for i in range(30000))
    with open(os.path.join(tmpdir_path, "big_2015.csv"), "wb") as f:
        f.write(header + body)
    rows, splits = read_in_pieces(spark, tmpdir_path, 65536)
    got = {r.supplier_name: r._row_idx for r in rows}
    assert splits > 4 and len(got) == 30000 and all(got[f"S{i}"] == i for i in range(30000))
    assert len({r._row_key for r in rows}) == 30000


def test_compressed_files_are_read_where_named(spark, tmpdir_path):
    write_fixtures(tmpdir_path)
    packed = os.path.join(tmpdir_path, "packed")
    os.mkdir(packed)
    for name, data in (("april_2015.csv.gz", APRIL), ("may_2015.csv.gz", MAY)):
        with gzip.open(os.path.join(packed, name), "wb") as f:
            f.write(data)
    with pytest.raises(FileNotFoundError):
        read_monthly(spark, packed)

    def rows(ingest, names):
        got = ingest.raw.where(F.col("_source_file").isin(*names)).drop("_source_file", "_row_key")
        return sorted(map(repr, got.collect()))

    plain, zipped = read_monthly(spark, tmpdir_path), read_monthly(spark, packed, "*.csv.gz")
    assert rows(zipped, ["april_2015.csv.gz", "may_2015.csv.gz"]) == rows(plain, ["april_2015.csv", "may_2015.csv"])
    assert zipped.raw_counts.count() == 2
    assert all(".zstd." in f for f in zipped.raw.inputFiles() if "/csv-records-" in f)


def payment_tables(spark, folder):
    """Benchmark tables with 40 line items of 8 orders; some repeat both keys."""
    li = [(o, (o * 7 + n) % 5, o % 3, n % 4 + 1, float(n), 1000.5 + n, n % 2 / 10, o % 2 / 10, "R" if n % 3 else "N", "O" if n % 2 else "F",
           dt.datetime(1996 + o % 2, 3, 1 + n)) for o in range(8, 16) for n in range(5)]
    tables = {"lineitem": (li, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                               " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
              "supplier": ([(s, f"Supplier#{s}", s) for s in range(3)], "s_suppkey long, s_name string, s_nationkey int"),
              "part": ([(p, f"part {p}", f"Brand#{p}", "LARGE", p) for p in range(5)],
                       "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
              "nation": ([(n, f"NATION_{n}", 0) for n in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
              "region": ([(0, "REGION")], "r_regionkey int, r_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return li


def test_monthly_files_are_dealt_before_their_texts_are_made(spark, tmpdir_path, monkeypatch):
    li, plans = payment_tables(spark, tmpdir_path), []
    export = catalog.export_months

    def noted(raw, *args, **kwargs):
        plans.append(raw._jdf.queryExecution().optimizedPlan().toString())
        return export(raw, *args, **kwargs)

    monkeypatch.setattr(catalog, "export_months", noted)
    got = catalog.landed(spark, tmpdir_path)
    # line items are numbered once, for both headers; they are shuffled to their files without texts
    (plan,) = plans
    above, below = plan.split("RepartitionByExpression")
    assert "Window" not in plan and "Join" not in plan
    assert "format_number" in above and "format_number" not in below and "Sort" in above
    assert all(f.endswith(".csv.gz") for f in got.ingest.files)
    # places in a file follow the orders, then the lines, then the copies
    want, place = [], Counter()
    for o, *rest, ship in sorted(li, key=lambda r: (r[0], r[3], r[1], r[2], r[4:])):
        month = f"march_{ship.year}-0"
        want.append((month, place[month], f"{o}-{rest[2]}"))
        place[month] += 1
    rows = catalog.row_positions(spark, tmpdir_path).collect()
    assert sorted((r.file, r.position, r.transaction_number) for r in rows) == sorted(want)
    assert {r.file: r.rows for r in catalog.file_audit(spark, tmpdir_path).collect()} == {**place, "unreadable": 0}
    # order 10 has two first lines, each with a blank row after it
    assert {r.file: r.dropped for r in catalog.load_quality(spark, tmpdir_path).collect()} == {"march_1996-0": 2, "march_1997-0": 0}
    assert catalog.csv_roundtrip(spark, tmpdir_path).count() == len(li)
