"""Report and key-resolution edge cases on hand-made staging rows."""

from conftest import raw_rows

from ledgerline.operators import reports, views
from ledgerline.operators.staging import clean
from ledgerline.operators.warehouse import build_warehouse


def tables(spark, rows):
    return build_warehouse(clean(raw_rows(spark, rows)))


def pay(supplier, amount, date="03/04/2015", area="G - S", etype="staff", postcode=None, stype="T", **kw):
    r = dict(department="D", supplier_name=supplier, amount=amount, payment_date=date, expense_area=area,
             expense_type=etype, supplier_postcode=postcode, supplier_type=stype)
    r.update(kw)
    return r


def test_key_resolution(spark):
    t = tables(spark, [
        pay("X", "1"), pay("X", "2", postcode="AB1"), pay(None, "3"),
        pay("Y", "4", etype=None, area="A - B"), pay("Y", "5", etype=None, area=None),
        pay("Y", "6", date="bad"),
    ])
    f = {r.amount: r for r in t.fact.collect()}
    assert t.dim_supplier.count() == 2 + 1            # (X, NULL), (X, AB1), (Y, NULL)
    assert f[1].supplier_key is not None and f[2].supplier_key is not None
    assert f[1].supplier_key != f[2].supplier_key
    assert f[3].supplier_key is None                  # NULL supplier kept, unresolved
    assert f[4].expense_key is not None               # (NULL type, 'A - B') has a dim row
    assert f[5].expense_key is None and f[5].entity_key is None
    assert f[6].date_key is None
    assert t.fact.count() == 6                        # no row dropped, none duplicated


def test_concentration_ties(spark):
    rows = [pay("A", "50"), pay("B", "30"), pay("C", "30"), pay("D", "10")]
    got = [tuple(r) for r in reports.q1b_concentration(tables(spark, rows)).collect()]
    assert [(g[0], g[1], g[3], g[4]) for g in got] == [
        (1, "A", 41.67, 41.67), (2, "B", 25.0, 91.67), (2, "C", 25.0, 91.67), (4, "D", 8.33, 100.0)]


def test_half_year_pattern(spark):
    pairs = [(100, 160), (100, 150), (100, 120), (100, 80), (100, 79), (0, 10), (0, 0)]
    rows = []
    for i, (h1, h2) in enumerate(pairs):
        rows += [pay("S", str(h1), date="01/05/2015", etype=f"t{i}"),
                 pay("S", str(h2), date="01/11/2015", etype=f"t{i}")]
    got = {r.expense_type: (r.h2_growth_pct, r.budget_pattern)
           for r in reports.q2b_half_year_pattern(tables(spark, rows), limit=None).collect()}
    labels = reports.PATTERN_LABELS
    assert got == {"T0": (60.0, labels[0]), "T1": (50.0, labels[1]), "T2": (20.0, labels[3]),
                   "T3": (-20.0, labels[3]), "T4": (-21.0, labels[2]), "T5": (None, labels[0])}


def test_monthly_trend(spark):
    rows = [pay("S", "100", date="01/04/2015"), pay("S", "0", date="01/05/2015"),
            pay("S", "50", date="01/06/2015")]
    got = [(r.mom_delta, r.mom_change_pct) for r in reports.q3a_monthly_trend(tables(spark, rows)).collect()]
    assert got == [(None, None), (-100.0, -100.0), (50.0, None)]


def test_rank_movement_after_filter(spark):
    rows = []
    # entity E ranks 2 in April, 11 in May, 5 in June among twelve cost centres
    for month, rank in (("04", 2), ("05", 11), ("06", 5)):
        for k in range(12):
            spend = 1000 - k * 10
            rows.append(pay("S", str(spend), date=f"01/{month}/2015", area=f"G - other{k}"))
        rows.append(pay("S", str(1000 - (rank - 1) * 10 + 5), date=f"01/{month}/2015", area="G - E"))
    got = [(r.month, r.monthly_rank, r.rank_movement)
           for r in reports.q3b_entity_rank_movement(tables(spark, rows)).collect() if r.entity_name == "G - E"]
    assert got == [(4, 2, None), (6, 5, 3)]


def test_refund_risk_bands(spark):
    cases = [(100, 10), (1000, 100.04), (100, 3), (100, 3.01), (0, 5), (100, None)]
    rows = []
    for i, (gross, refunded) in enumerate(cases):
        if gross:
            rows.append(pay(f"S{i}", str(gross)))
        if refunded:
            rows.append(pay(f"S{i}", f"-{refunded}"))
    got = {r.supplier_name_clean: (r.refund_rate_pct, r.risk_flag)
           for r in reports.q4a_refund_risk(tables(spark, rows), limit=None).collect()}
    assert got == {"S0": (10.0, "MODERATE"), "S1": (10.0, "HIGH RISK"), "S2": (3.0, "NORMAL"),
                   "S3": (3.01, "MODERATE")}


def test_monthly_anomaly(spark):
    rows = [pay("S", str(v), date=f"01/0{m}/2015") for m, v in zip(range(4, 9), (100, 100, 100, 300, 20))]
    got = [(r.avg_spend, r.pct_vs_avg, r.flag) for r in reports.q4b_monthly_anomaly(tables(spark, rows)).collect()]
    assert got == [(124.0, -19.4, "Normal")] * 3 + [(124.0, 141.9, "SPIKE"), (124.0, -83.9, "LOW")]


def test_views_null_keys(spark):
    rows = [pay("S", "10"), pay("S", "5", area=None), pay(None, "7")]
    t = tables(spark, rows)
    ex = views.v6_executive_summary(t).collect()
    assert ex[0].total_transactions == 1               # NULL entity key: not in the view
    q5 = reports.q5_executive_quarter(t).collect()
    assert q5[0].total_transactions == 2               # ...but counted by the quarterly report
    sup = views.v2_supplier_summary(t).collect()
    assert len(sup) == 1 and sup[0].pct_of_total == round(100 * 15 / 22, 4)
