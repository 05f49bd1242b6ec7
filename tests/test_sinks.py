"""Summary CSV sink, unresolved-key warnings, report runner isolation, display formatting."""

import glob
import os

from conftest import raw_rows

from ledgerline.operators import checks, reports
from ledgerline.operators.common import formatted
from ledgerline.operators.staging import clean
from ledgerline.operators.warehouse import build_warehouse
from ledgerline.sources.monthly_csv import write_summary_csv


def small_tables(spark):
    rows = [dict(department="D", supplier_name="S", amount="1,000.50", payment_date="01/04/2015",
                 expense_area="G - A", expense_type="x"),
            dict(department="D", supplier_name=None, amount="-2", payment_date="bad", expense_area=None)]
    return build_warehouse(clean(raw_rows(spark, rows)))


def test_summary_csv_sink(spark, tmpdir_path):
    t = small_tables(spark)
    out = os.path.join(tmpdir_path, "etl_summary")
    write_summary_csv(checks.k6_load_quality(t.staging), out)
    files = glob.glob(os.path.join(out, "*.csv"))
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert lines[0].startswith("file,raw_rows,clean_rows,dropped") and len(lines) == 2


def test_warnings_for_unresolved_keys(spark):
    msgs = checks.warnings(small_tables(spark))
    assert "1 rows with NULL date_key" in msgs and "1 rows with NULL supplier_key" in msgs
    assert any("entity_key" in m for m in msgs)


def test_report_runner_isolates_failures(spark):
    t = small_tables(spark)
    out = reports.run_all(t, ["q5_executive_quarter", "q1a_top_suppliers"],
                          q1a_top_suppliers={"no_such_param": 1})
    assert isinstance(out["q1a_top_suppliers"], Exception)
    assert out["q5_executive_quarter"].count() == 1


def test_report_runner_isolates_execution_errors(spark):
    t = small_tables(spark)

    def act(df):
        if "spend_rank" in df.columns:
            return df.selectExpr("raise_error('broken')").collect()
        return df.count()
    out = reports.run_all(t, ["q1a_top_suppliers", "q5_executive_quarter"], action=act)
    assert isinstance(out["q1a_top_suppliers"], Exception) and out["q5_executive_quarter"] == 1


def test_describe_spread_of_close_amounts(spark):
    from ledgerline.operators.profile import describe
    for rows, want in (([("900000000.00",), ("900000000.01",)] * 500, 0.005), ([("0.10",)] * 11, 0.0)):
        df = spark.createDataFrame(rows, "t string").selectExpr("CAST(t AS DECIMAL(18,2)) AS amount")
        assert describe(df).first().std == want


def test_display_formatting(spark):
    df = reports.q1a_top_suppliers(small_tables(spark))
    row = formatted(df, ["gross_spend"]).first()
    assert row.gross_spend == "1,000.50"


def test_profile_dtypes(spark):
    from ledgerline.operators.profile import dtypes
    t = small_tables(spark)
    got = {r.column_name: r.data_type for r in dtypes(t.fact).collect()}
    assert got["amount"] == "decimal(28,2)" and got["date_key"] == "int" and len(got) == 12
