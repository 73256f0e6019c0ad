import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintora.operators.quantiles import percentiles
from vintora.operators.reconcile import differences, unequal_buckets
from vintora.params import STAGE_STEPS, Terms
from vintora.plans import build, consumers, contest, credit, measures, risk
from vintora.plans.book import Book
from vintora.plans.explore import closed_window
from vintora.plans.lineage import Lineage
from vintora.plans.snapshots import StoredSnapshot, changes, digests, month_ends
from vintora.sources.load import VersionedTable

TERMS = Terms(as_of=dt.date(2024, 6, 15), now=dt.datetime(2024, 6, 15, 12))


def t(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def two_loans(spark):
    """Delivered Friday 1 March; due Saturday 16 March, moved to Monday 18 March."""
    orders = spark.createDataFrame(
        [("1", "S1", "O1", "COMPLETED", t("2024-02-28 10:00:00"), t("2024-03-01 23:00:00"), 1),
         ("1", "S2", "O2", "COMPLETED", t("2024-04-28 10:00:00"), t("2024-03-01 01:00:00"), 2),
         ("2", "S3", "O3", "COMPLETED", t("2024-06-01 10:00:00"), t("2024-06-05 01:00:00"), 1),
         ("2", "S4", "O4", "COMPLETED", t("2024-06-01 10:00:00"), None, 2)],
        """customer_id STRING, sales_order_id STRING, order_id STRING, order_status STRING,
           created_at TIMESTAMP_NTZ, delivery_at TIMESTAMP_NTZ, completed_index INT""")
    nulls = {c: F.lit(None).cast(k) for c, k in {
        "order_gross_sales": "double", "quantity": "double", "credit_limit": "double",
        "enrolled_at": "timestamp_ntz", "enrollment_cohort": "string", "enrolled_customers": "bigint",
        "cohort_credit_limit": "double", "months_since_enrollment": "int", "route": "string",
        "supervisor": "string", "office": "string", "region": "string", "customer_type": "string",
        "route_inferred": "boolean"}.items()}
    pay = spark.createDataFrame(
        [("S1", "O1", t("2024-03-02 00:00:00"), t("2024-03-31 00:00:01"), 100.0, 110.0, 5.0),
         ("x", "O2", t("2024-03-02 00:00:00"), t("2024-03-31 00:00:00"), 200.0, 220.0, 5.0)],
        """transaction_id STRING, marketplace_order_id STRING, movement_at TIMESTAMP_NTZ,
           paid_at TIMESTAMP_NTZ, total_amount DOUBLE, total_to_pay DOUBLE, interests DOUBLE""")
    pay = pay.withColumns({
        "payment_at": F.lit(None).cast("timestamp_ntz"), "total_default": F.lit(None).cast("double"),
        "commission_due": F.lit(1.0), "transaction_status": F.lit("paid")})
    mirrors = spark.createDataFrame(
        [("m", "S1", 100.0, 111.0, 0.0, 0.0, "OPEN", None, None, None, t("2024-03-02 00:00:00")),
         ("n", "S3", 50.0, 55.0, 3.0, 0.0, "OPEN", None, None, None, None)],
        """mirror_id STRING, sales_order_id STRING, total_amount DOUBLE, total_to_pay DOUBLE,
           interests DOUBLE, amount_paid DOUBLE, status STRING, movement_at TIMESTAMP_NTZ,
           payment_at TIMESTAMP_NTZ, paid_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""")
    keys = orders.select("sales_order_id", "order_id")
    return credit.loans(orders.withColumns(nulls), pay, mirrors, keys, TERMS)


def test_due_date_and_month_end(two_loans):
    rows = {r["sales_order_id"]: r for r in two_loans.collect()}
    assert str(rows["S1"]["due_on"]) == "2024-03-18"
    # One second into the last day is late, midnight is not.
    assert (rows["S1"]["paid_on_month"], rows["S1"]["days_past_due_month_end"]) == (0, 13)
    assert (rows["S2"]["paid_on_month"], rows["S2"]["days_past_due_month_end"]) == (1, 0)
    assert rows["S1"]["days_past_due"] == 13 and rows["S1"]["penalty_interest"] == 200


def test_precedence_waiver_and_status(two_loans):
    rows = {r["sales_order_id"]: r for r in two_loans.collect()}
    assert rows["S1"]["interests"] == 0 and rows["S1"]["interests_reported"] == 5
    assert rows["S2"]["interests"] == 5 and rows["S2"]["transaction_id"] == "x"
    assert rows["S3"]["total_amount"] == 50 and rows["S3"]["par"] == "Ongoing"
    # The first completed order after the waiver date pays no interest.
    assert rows["S3"]["interests"] == 0 and rows["S3"]["interests_reported"] == 3
    assert rows["S1"]["par"] == "Paid" and rows["S1"]["total_revenue"] == pytest.approx(10)
    assert rows["S4"]["due_on"] is None and rows["S4"]["par"] is None
    assert rows["S3"]["total_revenue"] == 0


def test_snapshot_states(two_loans):
    rows = {(r["sales_order_id"], str(r["cutoff"])): r
            for r in credit.month_end_snapshot(two_loans).collect()}
    assert set(rows) == {("S1", "2024-03-31"), ("S1", "2024-06-30"), ("S2", "2024-03-31"),
                         ("S2", "2024-06-30"), ("S3", "2024-06-30")}
    assert rows[("S1", "2024-03-31")]["par"] == "DQ 7-14"
    assert rows[("S2", "2024-03-31")]["par"] == "Paid"
    late = rows[("S1", "2024-06-30")]
    assert (late["par"], late["total_amount"], late["original_amount"]) == ("PaidPrev", 0, 100)


def test_unknown_cohort_has_no_delinquency(two_loans):
    # All loans lack a cohort: their balance shows, their delinquency does not.
    snapshot = credit.month_end_snapshot(two_loans)
    row = credit.vintage(snapshot, TERMS.at(as_of=dt.date(2030, 1, 1))).first()
    assert row["enrollment_cohort"] is None and row["par30"] == 0 and row["outstanding_balance"] > 0


# -- invariants on the supplied tables

def total(df, expr):
    return df.agg(F.expr(expr).alias("v")).first()["v"]


def test_snapshot_invariants(book):
    snapshot = book.snapshot
    assert total(snapshot.filter("par = 'PaidPrev'"), "coalesce(sum(total_amount), 0)") == 0
    buckets = snapshot.groupBy("par").agg(F.sum("total_amount").alias("b"))
    assert total(buckets, "sum(b)") == pytest.approx(total(snapshot, "sum(total_amount)"))
    assert snapshot.filter("cutoff < due_on").count() == 0


def test_grain_of_orders_and_loans(book):
    from vintora.operators.relational import assert_unique
    assert_unique(book.orders, credit.ORDER_GRAIN, "orders")
    assert_unique(book.loans, ["customer_id", "sales_order_id"], "loans")
    assert_unique(book.grid, ["customer_id"], "grid")
    assert_unique(book.unique_grid, ["customer_key"], "unique grid")


def test_each_loan_walks_seven_stages(book):
    walk = measures.stage_walk(book.loans, book.terms)
    per = walk.groupBy("sales_order_id", "customer_id").agg(F.count_distinct("step").alias("n"))
    assert per.filter(f"n <> {len(STAGE_STEPS) + 1}").count() == 0


def test_evidence_totals(book):
    odds = book.odds
    per = odds.groupBy("loan_range", "flag").agg(
        F.sum("pct_good").alias("g"), F.sum("pct_bad").alias("b"))
    assert per.filter("abs(g - 1) > 1e-9 or abs(b - 1) > 1e-9").count() == 0
    assert total(odds.filter("flag = 'flag@15DaysLate'"), "sum(events)") == risk.matured(
        book.loans, book.terms).count()


def test_panel_is_zero_filled(book):
    panel = book.panel
    cohorts = panel.select("first_month", "credit_flag", "first_credit").distinct().count()
    assert panel.filter("period = 0").count() == cohorts
    assert panel.filter("period = 0 and gross <> gross_base").count() == 0


def test_calendar_has_no_gaps(book):
    row = book.daily.agg(F.count("*").alias("n"), F.countDistinct("date").alias("d"),
                         F.datediff(F.max("date"), F.min("date")).alias("span")).first()
    assert row["n"] == row["d"] == row["span"] + 1


def test_orders_do_not_depend_on_the_ranges(spark, book, ranges):
    from vintora.plans.book import Book
    columns = ["customer_id", "sales_order_id", "order_status", "attempt_index",
               "completed_index", "activated_at", "route"]
    got = sorted(map(str, Book(book.source, book.terms).orders.select(*columns).collect()))
    spark.conf.set("spark.vintora.ranges", "7")
    assert got == sorted(map(str, Book(book.source, book.terms).orders.select(*columns).collect()))


def test_contest_windows_have_equal_length(book):
    start, end = contest.previous_window(book.terms)
    assert (end - start) == (book.terms.contest_to - book.terms.contest_from)
    days = book.contest.agg(F.min("day_in_window"), F.max("day_in_window")).first()
    assert days[0] >= 1 and days[1] <= 13


def test_published_names(book):
    assert "%good" in consumers.published_odds(book.odds).columns
    assert "periodo." in consumers.published_panel(book.panel).columns
    assert "Gross Sales" in consumers.published_lifecycle(book.lifecycle).columns


def test_closed_window():
    assert closed_window(dt.date(2024, 3, 1)) == (dt.date(2023, 8, 1), dt.date(2024, 2, 1))
    assert closed_window(dt.date(2024, 3, 2)) == (dt.date(2023, 9, 1), dt.date(2024, 3, 1))


def test_series(spark):
    assert [r[0] for r in measures.series(0, 20, 5, spark).collect()] == [0, 5, 10, 15, 20]


# -- stored snapshot -------------------------------------------------------

def paths(folder):
    return {p.parent.name: p.name for p in folder.rglob("*.parquet")}


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_late_payments_open_only_later_month_ends(spark, book, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "loans"))
    stored.replace(book.loans)
    loans = stored.read()
    snapshot = StoredSnapshot(spark, str(tmp_path / "s"), book.snapshot.schema)
    ends = month_ends(loans)
    assert snapshot.refresh(loans) == ends
    assert rows_of(snapshot.read()) == rows_of(book.snapshot)
    before = paths(tmp_path / "s" / "rows")
    assert snapshot.refresh(loans) == [] and paths(tmp_path / "s" / "rows") == before

    # A payment of a loan due in the middle arrives; another loan is gone, one is paid differently.
    middle = ends[len(ends) // 2]
    one = loans.filter(F.col("due_month_end") == middle).orderBy("sales_order_id").first()
    mine = F.col("sales_order_id") == one["sales_order_id"]
    late = loans.withColumn("paid_at", F.when(mine, F.lit(dt.datetime(2003, 1, 5)).cast(
        "timestamp_ntz")).otherwise(F.col("paid_at")))
    found = {r["change"]: r["sales_order_id"] for r in changes(digests(loans), digests(late)).collect()}
    assert found == {"changed": one["sales_order_id"]}
    assert snapshot.refresh(late) == [e for e in ends if e >= middle]
    assert rows_of(snapshot.read()) == rows_of(credit.month_end_snapshot(late))
    after = paths(tmp_path / "s" / "rows")
    assert {n for n in before if before[n] != after.get(n)} == {
        f"part_={y}" for y in {e.year for e in ends if e >= middle}}

    # All loans of the last month end go, and with them the month end; later they come back.
    fewer = late.filter(F.col("due_month_end") < ends[-1])
    snapshot.refresh(fewer)
    assert rows_of(snapshot.read()) == rows_of(credit.month_end_snapshot(fewer))
    assert snapshot.refresh(late) == [ends[-1]]
    assert rows_of(snapshot.read()) == rows_of(credit.month_end_snapshot(late))


def test_a_null_is_a_change(spark, book):
    one = book.loans.limit(1)
    other = one.withColumn("route", F.lit(None).cast("string"))
    empty = one.withColumn("route", F.lit(""))
    assert changes(digests(other), digests(empty)).count() == 1


def test_one_month_end_is_read_from_its_year(spark, book, tmp_path):
    snapshot = StoredSnapshot(spark, str(tmp_path), book.snapshot.schema)
    snapshot.refresh(book.loans)
    end = month_ends(book.loans)[-1]
    one = snapshot.rows.read([str(end.year)]).filter(F.col("cutoff") == F.lit(end))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert {f.split("part_=")[1][:4] for f in one.inputFiles()} == {str(end.year)}
    assert "isnotnull(cutoff" in plan and "cutoff" in plan.split("PushedFilters: ")[1][:60]
    assert one.count() == book.snapshot.filter(F.col("cutoff") == F.lit(end)).count()


# -- rebuild of what changed -----------------------------------------------

def test_lineage_follows_the_book(book):
    lineage = Lineage(book)
    assert lineage.uses("loans") == ({"orders", "payments", "mirrors", "loan_keys"}, set(), True)
    assert lineage.uses("sales") == (set(), {"orders_old", "orders_new"}, True)
    tables = list(build.TABLES)
    assert lineage.behind("vintage", tables) == []
    assert lineage.uses("orders")[0] == {"indexed", "approvals", "payments", "deliveries", "spans"}
    assert set(lineage.behind("loans", tables)) == {"snapshot", "vintage", "revenue", "daily"}


def test_digest_covers_rules_terms_and_sources(book, monkeypatch):
    before = {n: Lineage(book).digest(n) for n in build.TABLES}

    def changed(other):
        after = Lineage(other)
        return {n for n in build.TABLES if after.digest(n) != before[n]}

    assert changed(Book(book.source, book.terms)) == set()
    monkeypatch.setattr(credit, "PAR30", ("x",))
    assert changed(book) == {"vintage"}
    monkeypatch.undo()
    # A rule deep down: the delinquency bucket is used by loans and by the snapshot.
    monkeypatch.setattr(credit, "delinquency_bucket", lambda days: F.lit("x"))
    assert changed(book) == {"loans", "snapshot", "vintage", "revenue", "daily"}
    monkeypatch.undo()
    assert "routes" not in changed(Book(book.source, book.terms.at(weekly_penalty=9.0)))
    version = type(book.source).version
    monkeypatch.setattr(type(book.source), "version", lambda self, name: (
        "new" if name == "orders_new" else version(self, name)))
    assert changed(book) == {"history", "panel", "season"}


def test_only_what_changed_is_written(spark, book, tmp_path, monkeypatch):
    first = build.rebuild(Book(book.source, book.terms), str(tmp_path))
    assert len(first) == len(build.TABLES)
    assert build.rebuild(Book(book.source, book.terms), str(tmp_path), changed=True) == []
    monkeypatch.setattr(credit, "PAR30", credit.PAR90)
    again = Book(book.source, book.terms)
    assert [e["table_name"] for e in build.rebuild(again, str(tmp_path), changed=True)] == ["vintage"]
    assert again.vintage.filter("par30 <> par90").count() == 0
    assert again.snapshot.count() == book.snapshot.count()
    monkeypatch.undo()
    # Another rule of the snapshot with the same loans: all its month ends are made anew.
    monkeypatch.setattr(credit, "_FROM_LOAN_LAST", tuple(reversed(credit._FROM_LOAN_LAST)))
    names = [e["table_name"] for e in build.rebuild(Book(book.source, book.terms), str(tmp_path),
                                                    changed=True)]
    assert names == ["snapshot", "vintage"]


# -- percentiles and comparison --------------------------------------------

@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_percentiles_equal_interpolated_ranks(spark, ranges, size):
    rng = np.random.default_rng(size)
    values = {"a": rng.integers(-5, 5, size), "b": rng.integers(0, 10 ** 12, size), None: np.full(size, 3)}
    rows = [(g, int(v)) for g, some in values.items() for v in some] + [("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "g STRING, v BIGINT")
    shares = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p9999": 0.9999, "p100": 1.0}
    got = {r["g"]: r for r in percentiles(df, "g", "v", shares).collect()}
    assert set(got) == set(values)
    for g, some in values.items():
        assert got[g]["rows"] == size and got[g]["maximum"] == some.max()
        for name, p in shares.items():
            assert got[g][name] == pytest.approx(np.quantile(some, p), abs=1e-3)


def test_only_unequal_buckets_are_opened(spark):
    left = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 7).alias("v"),
                                    F.lit(None).cast("string").alias("w"))
    right = left.filter("k <> 'k17'").withColumn("v", F.when(F.col("k") == "k400", 99).otherwise(
        F.col("v"))).withColumn("w", F.when(F.col("k") == "k401", ""))
    extra = spark.createDataFrame([("k5", 5, None), (None, 1, None)], "k STRING, v BIGINT, w STRING")
    right = right.unionByName(extra)
    opened = unequal_buckets(left, right, ["k"], ["v", "w"]).count()
    assert 1 <= opened <= 5
    got = {r["k"]: (r["kind"], r["changed"], r["left_rows"], r["right_rows"])
           for r in differences(left, right, ["k"], ["v", "w"]).collect()}
    assert got == {"k17": ("only_left", None, 1, 0), "k400": ("changed", ["v"], 1, 1),
                   "k401": ("changed", ["w"], 1, 1), "k5": ("changed", None, 1, 2),
                   None: ("only_right", None, 0, 1)}
    assert differences(left, left.repartition(3), ["k"], ["v", "w"]).isEmpty()
    assert differences(left.limit(0), left.limit(0), ["k"], ["v", "w"]).isEmpty()


def test_charge_off_counts_orders_and_customers_once(spark):
    """An order of two customers, rows without an order or a customer, an order paid in one row."""
    shape = "customer_id string, sales_order_id string, stage string, lead_stage string, total_amount double"
    leads = spark.createDataFrame(
        [("1", "A", "Ongoing", "DQ 1-6", 10.0), ("1", "A", "Paid", None, 10.0),
         ("2", "A", "Ongoing", "Paid", 20.0), ("2", "B", "Ongoing", None, 40.0),
         ("3", None, "Ongoing", "Paid", 80.0), ("3", None, "Paid", None, 80.0),
         (None, "C", "Paid", None, 160.0), (None, "C", "Paid", None, 160.0),
         (None, None, None, "Paid", 320.0), ("4", "D", None, None, None)], shape)
    row = measures.charge_off(leads).first().asDict()
    assert row == {"customers": 4, "disbursed": 4, "paid": 2, "amount_disbursed": 150.0,
                   "amount_leading": 420.0, "amount_paid": 410.0, "by_count": 0.5,
                   "by_amount": 1 - 420 / 150, "by_amount_same_loans": 1 - 410 / 150}
    none = measures.charge_off(leads.limit(0)).select("customers", "disbursed", "paid", "amount_paid")
    assert tuple(none.first()) == (0, 0, 0, None)
