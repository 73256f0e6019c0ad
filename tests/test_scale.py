"""Steps that must not do their work once per loan and month end."""

import datetime as dt
import glob
import threading
import time

import pytest
from pyspark.sql import functions as F

from vintora.params import SAMPLE as TERMS
from vintora.operators.skew import in_ranges
from vintora.plans import credit, sales
from vintora.plans.book import Book
from vintora.plans.snapshots import StoredSnapshot
from vintora.registry.core import Query, SnapshotQuery
from vintora.session import _CLEANUP, freeing_shuffles
from vintora.sources import load
from vintora.sources.load import EmptyLoad, VersionedTable
from vintora.sources.parts import PartedTable

LOAN = """customer_id STRING, enrollment_cohort STRING, enrolled_at TIMESTAMP_NTZ,
    enrolled_customers BIGINT, due_on DATE, paid_at TIMESTAMP_NTZ, total_amount DOUBLE,
    sales_order_id STRING"""


@pytest.fixture(scope="module")
def loans(spark):
    """Customers without enrolment or name, loans twice, without amount, paid at and after midnight."""
    rows = []
    for c in range(12):
        name = None if c == 5 else f"c{c}"
        enrolled = None if c % 4 == 3 else dt.datetime(2023, 1 + c % 3, 5 + c, 10)
        cohort = None if enrolled is None else f"{enrolled:%Y-%m}"
        for i in range(4):
            due = dt.date(2023, 2 + i + c % 3, 1 + 2 * c)
            paid = [None, dt.datetime(2023, 2 + i + c % 3 + 2, 28, c), dt.datetime(2023, 3, 31),
                    dt.datetime(2023, 3, 31, 0, 0, 1)][(c + i) % 4]
            amount = None if (c, i) == (2, 1) else 10.0 * c + i
            rows += [(name, cohort, enrolled, 7, due, paid, amount, f"s{c}-{i}")] * (2 if c == 7 else 1)
    out = spark.createDataFrame(rows, LOAN).withColumn("due_month_end", F.last_day("due_on"))
    known = set(out.columns) | {"total_amount"}
    rest = [c for c in credit.FROM_LOAN if c not in known]
    kinds = {"created_at": "timestamp_ntz", "delivery_at": "timestamp_ntz"}
    return out.select("*", *[F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in rest])


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_vintage_of_groups_equals_vintage_of_rows(loans):
    terms = TERMS.at(as_of=dt.date(2023, 7, 31))
    by_rows = credit.vintage(credit.month_end_snapshot(loans), terms)
    assert by_rows.count() > 10 and by_rows.filter("par90_n > 0").count() > 0
    assert rows_of(credit.loan_vintage(loans, loans, terms)) == rows_of(by_rows)


def test_book_vintage_opens_groups_and_not_loans(loans):
    book = Book(None, TERMS.at(as_of=dt.date(2023, 7, 31)))
    book.__dict__.update(loans=loans, due_months=loans.select("due_month_end"))
    plan = book.vintage._jdf.queryExecution().optimizedPlan().toString()
    opened = plan[plan.index("slice("):]
    assert "Aggregate" in opened and "n#" in opened


def test_snapshot_columns_are_published_once_per_loan(spark, loans, monkeypatch):
    book = Book(None, TERMS)
    book.__dict__.update(loans=loans, due_months=loans.select("due_month_end"))
    monkeypatch.setattr(Book, "open", classmethod(lambda cls, *_: _fresh(book)))
    fields = ("customer_id sales_order_id enrolled_at:t paid_at:t total_amount:m cutoff:t month"
              " days_past_due:i par previous_month_end:t")
    made = SnapshotQuery("q", lambda b: b.snapshot, fields).run(spark, "")
    assert rows_of(made) == rows_of(Query("q", lambda b: b.snapshot, fields).run(spark, ""))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Generate")]
    assert "cast(enrolled_at" not in above and "cast(cutoff" not in above


def _fresh(book):
    out = Book(None, book.terms)
    out.__dict__.update(loans=book.loans, due_months=book.due_months)
    return out


def test_lines_are_placed_by_order_once(spark):
    rows = [("c", "s", "o", "COMPLETED", None if i % 2 else "MARKETPLACE", float(i), None, None,
             f"p{i % 3}", 1.0, 5.0, 6.0) for i in range(9)]
    lines = spark.createDataFrame(
        rows, """customer_id STRING, sales_order_id STRING, order_id STRING, order_status STRING,
        sales_channel STRING, created_ms DOUBLE, created_at TIMESTAMP_NTZ, delivery_at TIMESTAMP_NTZ,
        product_id STRING, quantity DOUBLE, order_gross_sales DOUBLE, total_price DOUBLE""")
    orders = credit.collapse_lines(lines)
    row = orders.collect()
    assert [(r["skus"], r["quantity"], r["created_ms"]) for r in row] == [(3, 9.0, 8.0)]
    text = orders._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert text.count("Exchange hashpartitioning") == 1


def test_window_reads_its_source_once(spark):
    source = spark.createDataFrame([("a", 1), ("a", 9), ("b", 2), (None, 3), (None, 8), ("c", None),
                                    ("a", 1)], "k STRING, at INT")
    refresh = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "k STRING")
    out = load.window_or_keys(source, "at", F.lit(8), "k", refresh)
    assert sorted(out.collect(), key=str) == sorted(
        [("a", 1), ("a", 1), ("a", 9), ("c", None), (None, 8)], key=str)
    assert out.columns == ["k", "at"]
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_replacing_all_parts_is_one_pass(spark, tmp_path, monkeypatch):
    table = PartedTable(spark, str(tmp_path / "t"), "id INT, at TIMESTAMP_NTZ", F.col("at"))
    # The parts of the rows are not asked for, which would make the rows once more.
    monkeypatch.setattr(PartedTable, "touched", lambda *_: pytest.fail("a second pass"))
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (2, dt.datetime(2024, 2, 5)),
                                  (3, None)], table.schema)
    assert table.replace(rows) == 3 and table.parts() == ["2024-01", "2024-02", "none"]
    with pytest.raises(EmptyLoad):
        table.replace(rows.filter("id > 9"), required=True)
    assert table.read().count() == 3
    assert table.replace(rows.filter("id = 2")) == 1 and table.parts() == ["2024-02"]
    assert table.replace(rows.filter("id > 9")) == 0 and table.parts() == []


def test_rows_of_a_loan_are_stored_together(spark, loans, tmp_path):
    """They go from the loan to the file, so what a loan repeats costs little; nothing is shuffled."""
    later = loans.limit(3).withColumns({
        "due_on": F.lit(dt.date(2025, 5, 5)), "due_month_end": F.lit(dt.date(2025, 5, 31)),
        "sales_order_id": F.concat(F.lit("later-"), "sales_order_id")})
    never = loans.limit(2).withColumns({
        "due_on": F.lit(None).cast("date"), "due_month_end": F.lit(None).cast("date")})
    stored = VersionedTable(spark, str(tmp_path / "loans"))
    # Loans due twice with the same key are next to each other in the table: number them apart.
    stored.replace(loans.unionByName(later).unionByName(never).withColumn(
        "sales_order_id", F.concat("sales_order_id", F.lit("/"), F.monotonically_increasing_id())))
    mine = stored.read()
    snapshot = StoredSnapshot(spark, str(tmp_path / "s"), credit.month_end_snapshot(mine).schema)
    snapshot.refresh(mine)
    assert snapshot.rows.parts() == ["2023", "2025"]
    assert rows_of(snapshot.read()) == rows_of(credit.month_end_snapshot(mine))
    files = glob.glob(str(tmp_path / "s/rows/part_=2023/*.parquet"))
    for file in files:
        ids = [r[0] for r in spark.read.parquet(file).select("sales_order_id").collect()]
        assert len(ids) > len(set(ids)) == 1 + sum(a != b for a, b in zip(ids, ids[1:]))
    one = credit.month_end_snapshot(mine, mine, year=2023)
    assert {r[0].year for r in one.select("cutoff").collect()} == {2023}
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


@pytest.mark.parametrize("kind", ["version", "parts", "ranges", "panel"])
def test_a_write_leaves_no_shuffle_files(spark, tmp_path, kind):
    rows = spark.range(0, 4000, 1, 4).selectExpr(
        "id % 900 AS k", "DATE'2024-01-01' + CAST(id % 60 AS INT) AS at")
    summed = rows.groupBy("k").agg(F.max("at").cast("timestamp_ntz").alias("at"))
    before = shuffle_files(spark)
    if kind == "version":
        assert VersionedTable(spark, str(tmp_path / "t")).replace(summed) == 900
    elif kind == "parts":
        table = PartedTable(spark, str(tmp_path / "t"), summed.schema, F.col("at"))
        assert table.replace(summed) == 900
    elif kind == "ranges":
        in_ranges(summed, ["k"])
    else:
        months = rows.selectExpr("CAST(k AS STRING) AS customer_id", "CAST(k AS STRING) AS sales_order_id",
                                 "trunc(at, 'month') AS month", "1.0D AS amount", "1.0D AS pieces").distinct()
        first = months.limit(0).selectExpr("customer_id", "month AS first_credit")
        before = shuffle_files(spark)
        sales.cohort_panel(months, first)
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(_CLEANUP, None) is None


def test_shuffle_setting_comes_back_after_a_failure(spark):
    with pytest.raises(ZeroDivisionError):
        freeing_shuffles(spark, lambda: 1 / 0)
    assert spark.conf.get(_CLEANUP, None) is None


def test_shuffle_setting_comes_back_after_overlapping_jobs(spark):
    """Two streams write at the same time; the one that began first ends first."""
    first_began, second_began, first_ended = (threading.Event() for _ in range(3))

    def first():
        first_began.set()
        second_began.wait(20)

    def second():
        second_began.set()
        first_ended.wait(20)
        return spark.conf.get(_CLEANUP)

    def later():
        first_began.wait(20)
        seen.append(freeing_shuffles(spark, second))
    seen = []
    thread = threading.Thread(target=later)
    thread.start()
    freeing_shuffles(spark, first)
    first_ended.set()
    thread.join()
    assert seen == ["true"] and spark.conf.get(_CLEANUP, None) is None
