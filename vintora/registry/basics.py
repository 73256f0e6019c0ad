"""Queries of the single operators: loads, keys, joins, aggregates, windows, checks, streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.functions import (
    clean_text, coordinate, delinquency_bucket, digits_key, epoch_ms_to_local, int_key,
    last_thursday, local_to_epoch_ms, penalty, stamp, text_to_date, to_monday,
)
from vintora.operators.relational import (
    duplicates, first_per_key, interval_lookup, islands, match_with_fallback,
)
from vintora.operators.skew import keyed_window, number_rows
from vintora.params import FINAL_STATES, SAMPLE, STAGE_ORDER
from vintora.plans import (
    build, consumers, contest, credit, explore, measures, nightly, quality, risk,
)
from vintora.plans.book import Book
from vintora.registry.core import Query
from vintora.registry.views import ACTIVE, AS_OF, bucket, monday
from vintora.sources import contracts, intake, load, normalise, rejects
from vintora.streaming import jobs

_EVENT_CUT = dt.datetime(2024, 1, 21)
_MODES_AT = dt.datetime(2024, 2, 29, 12)
# The spoiled file of _spoiled: its line, its two columns.
_SPOILED = """SELECT *, '{"id_cliente":' || coalesce('"' || id || '"', 'null') ||
    ',"transactional_profile":' || coalesce('"' || profile || '"', 'null') || '}' AS line
    FROM (SELECT CASE c_custkey % 10 WHEN 1 THEN 'no ' || c_custkey WHEN 3 THEN NULL
        ELSE CAST(c_custkey AS VARCHAR) END AS id,
    CASE WHEN c_custkey % 7 <> 0 THEN CASE c_custkey % 3 WHEN 0 THEN '01-Healthy'
        WHEN 1 THEN '02-Mixed' ELSE '03-Mostly Fraud' END END AS profile
    FROM customer WHERE c_custkey % 2 = 1)"""


def _events(book: Book) -> DataFrame:
    return book.source.table("events")


def _runs(book: Book) -> DataFrame:
    """Load runs, read from the events: type as table, value as seconds."""
    return _events(book).select(
        F.col("event_type").alias("table_name"), F.col("ts").alias("started_at"),
        F.get_json_object("props", "$.k").cast("bigint").alias("rows"),
        F.col("value").alias("seconds"),
        F.when(F.col("event_id") % 7 == 0, "full").otherwise("window").alias("mode"), "event_id")


def _flatten(book: Book) -> DataFrame:
    nested = _events(book).select(
        "event_id", F.from_json("props", "k BIGINT").alias("props"),
        F.struct(F.col("user_id").alias("id"), F.struct("event_type", "user_id").alias("detail"))
        .alias("who"), F.array("event_type").alias("tags"))
    return load.flatten(nested)


def _window_or_keys(book: Book) -> DataFrame:
    cutoff = F.lit(book.terms.as_of - dt.timedelta(days=book.terms.mutable_days)).cast(
        "timestamp_ntz")
    old = load.refresh_keys(book.lines, "sales_order_id", "order_status", FINAL_STATES,
                            "created_at", cutoff)
    return load.window_or_keys(book.lines, "created_at", cutoff, "sales_order_id", old)


def _event_window(book: Book) -> DataFrame:
    """Even events are the stored table, odd ones the new extract."""
    events = _events(book).withColumn("user", F.col("user_id").cast("string"))
    cutoff = F.lit(_EVENT_CUT).cast("timestamp_ntz")
    current = events.filter("event_id % 2 = 0")
    refresh = load.refresh_keys(current.filter("user_id % 3 = 0"), "user", "event_type",
                                ("click", "purchase", "signup", "view"), "ts", cutoff)
    incoming = load.window_or_keys(events.filter("event_id % 2 = 1"), "ts", cutoff, "user", refresh)
    table = load.VersionedTable(book.source.spark, load.scratch(book.source.spark, "window"))
    table.replace(current)
    table.replace(load.window_replace(table.read(), incoming, "ts", cutoff, "user", refresh))
    return table.read()


def _full_replace(book: Book) -> DataFrame:
    table = load.VersionedTable(book.source.spark, load.scratch(book.source.spark, "full"))
    table.replace(book.source.cohort_cac)
    table.replace(book.source.service_profile)
    return table.read()


def _csv_contract(book: Book) -> DataFrame:
    spark = book.source.spark
    path = load.scratch(spark, "profile.csv")
    load.export_csv(book.source.service_profile.select(
        F.col("id_cliente").alias("Id cliente"),
        F.concat(F.lit(" "), "transactional_profile", F.lit(" ")).alias("transactionalProfile"),
        F.lit(1).alias("Unnamed: 0")), path)
    return load.read_contract(spark, path, {
        "Id cliente": "customer", "transactionalProfile": "profile"}, {"customer": "bigint"})


def _header_contract(book: Book) -> DataFrame:
    spark = book.source.spark
    path = load.scratch(spark, "contest.csv")
    header = ["id", "linea", "clase", "ruta preventa"]
    load.export_csv(book.source.contest_customers.select(
        F.col("netsuite_id").alias("id"),
        F.when(F.col("netsuite_id_num") % 5 == 0, 0).otherwise(F.col("linea_nueva")).alias("linea"),
        F.when(F.col("netsuite_id_num") % 7 == 0, "nan").otherwise(F.col("clasificacion"))
        .alias("clase"), F.col("ruta_preventa").alias("ruta preventa")), path)
    return load.read_ordered(spark, path, header, ["customer_id", "line", "class", "route"],
                             "customer_id", ["line"])


def _file_contract(book: Book) -> DataFrame:
    """The recomputed pairs as the file people hand in, read back under its contract."""
    spark = book.source.spark
    path = load.scratch(spark, "pair_odds.csv")
    load.export_csv(consumers.published_pair_odds(book.pairs).withColumn(
        "br", F.col("bad_rate")), path)
    rows = contracts.read_file(spark, "pair_odds", path)
    raw = F.concat(F.lit("['"), "atr1", F.lit("'&'"), "atr2", F.lit("']"))
    return rows.withColumn("combo_id", contracts.combination_id(
        "loan_disbursement_index_range", "flag", contracts.clean_combination(raw)))


def _spoiled(book: Book) -> contracts.Checked:
    """The service profile as a file with unreadable numbers and missing names."""
    spark = book.source.spark
    path = load.scratch(spark, "spoiled.csv")
    key = F.col("id_cliente")
    load.export_csv(book.source.service_profile.select(
        F.when(key % 10 == 1, F.concat(F.lit("no "), key.cast("string"))).when(key % 10 == 3, "")
        .otherwise(key.cast("string")).alias("Id cliente"),
        F.when(key % 7 != 0, F.col("transactional_profile")).alias("transactionalProfile"),
        key.alias("Unnamed: 0")), path)
    return contracts.check(spark, "service_profile", path)


def _rejected_values(book: Book) -> DataFrame:
    """Documents with text in number columns: loaded, with counts of what became NULL."""
    spark = book.source.spark
    staging = intake.Staging(spark, load.scratch(spark, "staging"))
    profile = book.source.service_profile
    text = F.when(F.col("id_cliente") % 10 == 1, "no number").otherwise(
        F.col("id_cliente").cast("string"))
    intake.load_all(staging, {"service_profile": profile.withColumn("id_cliente", text),
                              "cohort_cac": book.source.cohort_cac}, book.terms)
    return staging.rejected()


def _intake(book: Book) -> DataFrame:
    """A first load without the open orders' last state, then a windowed load a day later."""
    spark, source = book.source.spark, book.source
    staging = intake.Staging(spark, load.scratch(spark, "staging"))
    terms = book.terms.at(now=dt.datetime(2001, 7, 1))
    stale = source.credit_order.withColumn("orderStatus", F.when(
        F.col("orderStatus") == "IN_DELIVERY", "CREATED").otherwise(F.col("orderStatus")))
    intake.load_all(staging, {"credit_order": stale, "customers": source.customers}, terms)
    intake.load_all(staging, {"credit_order": source.credit_order}, terms.at(
        now=terms.now + dt.timedelta(days=1)))
    return staging.credit_order


def _csv_export(book: Book) -> DataFrame:
    spark = book.source.spark
    path = load.scratch(spark, "detail.csv")
    recent = explore.recent_orders(book.sales, book.terms)
    base = explore.detail_base(recent, explore.approved_limits(book.approvals),
                               explore.owned_orders(book.lines))
    load.export_csv(base.filter("is_enrolled = 1"), path)
    return spark.read.schema(base.schema).csv(path, header=True)


def _csv_detail(book: Book) -> DataFrame:
    """The whole detail base as CSV, read back under its schema."""
    spark = book.source.spark
    path = load.scratch(spark, "base.csv")
    base = explore.detail_base(_recent(book), *_lines_and(book))
    load.export_csv(base, path)
    return spark.read.schema(base.schema).csv(path, header=True)


def _fallback(book: Book) -> DataFrame:
    return match_with_fallback(book.payments, book.order_keys,
                               ("transaction_id", "sales_order_id"),
                               ("marketplace_order_id", "order_id"))


def _scd(book: Book) -> DataFrame:
    sold = book.source.table("orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderkey").alias("order_key"), F.to_date("o_orderdate").alias("day"))
    return interval_lookup(sold, book.spans, "customer_id", F.col("day"), "valid_from", "valid_to",
                           ["route", "tranche"])


def _null_safe(book: Book) -> DataFrame:
    def by_channel(table, suffix):
        rows = normalise.yearly_sales([], [table], book.terms) if suffix == "new" else \
            normalise.yearly_sales([table], [], book.terms)
        return rows.groupBy("channel").agg(F.sum("amount").alias(suffix))
    left = by_channel(book.source.orders_old, "old")
    right = by_channel(book.source.orders_new, "new").withColumnRenamed("channel", "_c")
    return left.join(right, F.col("channel").eqNullSafe(F.col("_c")))


def _orphans(book: Book) -> DataFrame:
    known = book.lines.select(F.col("sales_order_id").alias("transaction_id")).distinct()
    done = book.lines.filter(F.col("order_status") == "COMPLETED")
    people = book.source.customers.select(F.col("netsuiteId").alias("customer_id"))

    def count(df, name):
        return df.agg(F.lit(name).alias("orphan"), F.count(F.lit(1)).alias("rows"))

    return load.union_all([
        count(book.payments.join(known, "transaction_id", "left_anti"), "payment"),
        count(done.join(book.deliveries.select("sales_order_id").distinct(),
                        "sales_order_id", "left_anti"), "line"),
        count(book.approvals.join(people.distinct(), "customer_id", "left_anti"), "approval")])


def _havings(book: Book) -> DataFrame:
    owners = book.valid_lines.groupBy("sales_order_id").agg(
        F.count_distinct("order_status").alias("n")).filter("n > 1")
    repeated = duplicates(book.approvals, ["customer_id"])
    big = book.order_months.groupBy("customer_id", "month").agg(
        F.sum("amount").alias("a")).filter("a > 1000000")

    def count(df, name):
        return df.agg(F.lit(name).alias("having"), F.count(F.lit(1)).alias("groups"))

    return load.union_all([count(owners, "many statuses"), count(repeated, "repeated approval"),
                           count(big, "large month"), count(book.history, "not empty")])


def _checks(book: Book, drop: tuple[str, ...] = ()) -> DataFrame:
    terms = book.terms.at(as_of=dt.date(2024, 5, 10))
    tables = {
        "order_lines": book.lines, "approvals": book.approvals, "payments": book.payments,
        "deliveries": book.deliveries, "run_log": _runs(book),
        "customers": book.source.customers.select(F.col("netsuiteId").alias("customer_id")),
        "manual_loads": _events(book).select(F.col("event_type").alias("table_name")).distinct()}
    kept = {n: t for n, t in tables.items() if n not in drop}
    return quality.run_checks(quality.row_checks(terms), kept, book.source.spark)


def _freshness(book: Book) -> DataFrame:
    people = book.source.customers
    sources = [("credit_order", book.lines, "created_at"),
               ("payment_report", book.payments, "movement_at"),
               ("state_of_delivery", book.deliveries, "delivered_at"),
               ("credit_approval", book.approvals, "approved_at"), ("customers", people, None)]
    staged = [("credit_order", book.valid_lines, "created_at"),
              ("payment_report", book.payments.filter(~F.col("transaction_id").startswith("uuid-")),
               "movement_at"),
              ("state_of_delivery", book.deliveries, "delivered_at"),
              ("customers", people.filter(F.col("netsuiteId") == F.trim("netsuiteId")), None)]
    status = quality.freshness(sources, staged, book.terms)
    return quality.by_severity(status, "lamp", "source")


def _alert_history(book: Book) -> DataFrame:
    """One run per day: a check alerts when a user has an error event that day."""
    return _events(book).groupBy(
        F.to_date("ts").alias("run_at"), F.concat(F.lit("user-"), "user_id").alias("check_name")
    ).agg(F.count_if(F.col("event_type") == "error").alias("rows")).withColumns({
        "severity": F.when(F.col("rows") > 1, "CRIT").otherwise("WARN"),
        "result": F.when(F.col("rows") == 0, "OK").otherwise("ALERT")})


def _stored(book: Book) -> list[dict]:
    return build.rebuild(book, load.scratch(book.source.spark, "book"))


def _nightly(book: Book) -> DataFrame:
    log = _stored(book)
    return book.source.spark.createDataFrame(
        [(r["table_name"], r["rows"]) for r in log], "table_name STRING, rows BIGINT")


# Tables that are stored in _changed_build, and those of them that are made of the route catalogue.
_SOME_TABLES = ["routes", "history", "panel", "season", "cut_lines", "cut_orders"]
_BEHIND_ROUTES = ("routes", "cut_lines", "cut_orders")


def _changed_build(book: Book) -> DataFrame:
    """Stored tables over loaded ones, of which the route catalogue and the cohort costs come anew:
    only what is made of them is written again."""
    spark = book.source.spark
    staging = intake.Staging(spark, load.scratch(spark, "staging"))
    sources = {n: getattr(book.source, n) for n in (
        "credit_order", "credit_approval", "commercial_structure", "route_mapping", "orders_old",
        "orders_new", "cohort_cac")}
    intake.load_all(staging, sources, book.terms)
    folder = load.scratch(spark, "book")
    build.rebuild(Book(staging, book.terms), folder, _SOME_TABLES)
    intake.load_all(staging, sources, book.terms, only=["route_mapping", "cohort_cac"])
    log = build.rebuild(Book(staging, book.terms), folder, _SOME_TABLES, changed=True)
    return spark.createDataFrame([(r["table_name"], r["rows"]) for r in log],
                                 "table_name STRING, rows BIGINT")


def _identities(book: Book) -> DataFrame:
    _stored(book)
    return quality.identities(build.identity_pairs(book))


def _audit(book: Book) -> DataFrame:
    build.rebuild(book, load.scratch(book.source.spark, "book"), ["routes", "panel", "season"])
    shown = {n: build.VIEWS[n] for n in ("cohort_panel", "seasonality", "service_profile")}
    names = build.publish(book, shown)
    return quality.catalog_audit(book.source.spark, [*names, "pub_not_built"]).filter(
        F.col("view").isin(*names, "pub_not_built"))


def _isolated_views(book: Book) -> DataFrame:
    """Three views are published; the one that cannot be made does not stop those behind it."""
    spark = book.source.spark
    views = {"service_profile": build.VIEWS["service_profile"],
             "broken": lambda b: b.no_such_table, "vintage": build.VIEWS["vintage"]}
    try:
        build.publish(book, views)
    except RuntimeError:
        pass
    shown = [spark.table(f"pub_{n}").agg(F.count(F.lit(1)).alias("rows")) if n != "broken"
             or spark.catalog.tableExists("pub_broken") else
             spark.range(1).select(F.lit(None).cast("bigint").alias("rows")) for n in views]
    return load.union_all([df.select(F.lit(f"pub_{n}").alias("view"), "rows")
                           for n, df in zip(views, shown)])


def _footer_probe(book: Book) -> DataFrame:
    """Rows and newest time of loaded tables, in epoch milliseconds, without reading a row."""
    spark, source = book.source.spark, book.source
    staging = intake.Staging(spark, load.scratch(spark, "staging"))
    marks = {"credit_order": "createdAt", "payment_report": "movementDate", "service_profile": None}
    intake.load_all(staging, {n: getattr(source, n) for n in marks}, book.terms)
    return load.union_all([staging.probe(n, at) for n, at in marks.items()])


def _empty_guard(book: Book) -> DataFrame:
    """A second load in which two sources answer with no rows: what they had stays."""
    spark, source = book.source.spark, book.source
    staging = intake.Staging(spark, load.scratch(spark, "staging"))
    tables = {n: getattr(source, n) for n in ("credit_order", "service_profile", "cohort_cac")}
    intake.load_all(staging, tables, book.terms)
    out = []
    for name, df in tables.items():
        try:
            intake.load_all(staging, {name: df if name == "cohort_cac" else df.limit(0)}, book.terms)
            outcome = "loaded"
        except load.EmptyLoad:
            outcome = "kept"
        out.append(getattr(staging, name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(outcome).alias("outcome"), "rows"))
    return load.union_all(out)


_CHANGES = "id STRING, ts TIMESTAMP_NTZ, changed_at TIMESTAMP_NTZ, status STRING, value DOUBLE"


def _changes(book: Book) -> DataFrame:
    """Events as documents: each opens at ``ts``, and two of three change 1 to 20 days later."""
    later = F.expr("make_dt_interval(CAST(event_id % 20 + 1 AS INT))")
    opened = _events(book).select(
        F.concat(F.lit("E"), "event_id").alias("id"), "ts", F.col("ts").alias("changed_at"),
        F.lit("open").alias("status"), "value", "event_id")
    changed = opened.filter("event_id % 3 <> 0").withColumns({
        "changed_at": F.col("ts") + later, "status": F.lit("done"), "value": F.col("value") * 2})
    return opened.unionByName(changed).drop("event_id")


def _stream_upsert(book: Book) -> DataFrame:
    """Two runs of one stream over small files in which some changes are sent twice: the second run
    only sees the files written after the first."""
    spark = book.source.spark
    folder, log = load.scratch(spark, "changes-in"), load.scratch(spark, "changes-log")
    rule = jobs.Mutable("id", "ts", "changed_at", "status", ("done",), days=5)
    table = jobs.changing_table(spark, load.scratch(spark, "changes-out"), _CHANGES, rule)
    # Files in the order of time, one per batch.
    edges = [dt.datetime(2023, 1, 1), *(dt.datetime(2024, 1, d) for d in (6, 11, 16, 21, 26)),
             dt.datetime(2025, 1, 1)]
    at = F.col("changed_at")
    for n, (first, end) in enumerate(zip(edges, edges[1:])):
        some = _changes(book).filter((at >= stamp(first)) & (at < stamp(end)))
        again = some.filter(F.col("id").endswith("7"))
        some.unionByName(again).coalesce(1).write.mode("append").parquet(folder)
        if n in (2, 5):
            jobs.upsert_stream(jobs.read_stream(spark, folder, _CHANGES, files_per_batch=1), table,
                               rule, log).awaitTermination()
    return table.read().drop("first_batch")


def _stream_lag(book: Book) -> DataFrame:
    """Every fifth event arrives in a second run; its rows of hours that are closed by then are
    late."""
    spark = book.source.spark
    folder, log = load.scratch(spark, "lag-in"), load.scratch(spark, "lag-log")
    tables = jobs.LagTables.at(spark, load.scratch(spark, "lag-out"))
    late = F.col("event_id") % 5 == 0
    for part in (~late, late):
        (_events(book).filter(part).select("event_type", "ts").coalesce(1)
         .write.mode("append").parquet(folder))
        events = jobs.read_stream(spark, folder, "event_type STRING, ts TIMESTAMP_NTZ")
        for query in jobs.lag_streams(events, tables, log, "event_type", "ts", "48 hours"):
            query.awaitTermination()
    return jobs.lag_status(tables, dt.datetime(2024, 1, 31, 23, 30))


def _around(book: Book) -> DataFrame:
    return risk.sales_around(book.history, risk.last_due_orders(book.orders, book.terms),
                             risk.eligible_days(book.grid), book.terms)


def _recent(book: Book) -> DataFrame:
    return explore.recent_orders(book.sales, book.terms)


def _lines_and(book: Book):
    return explore.approved_limits(book.approvals), explore.owned_orders(book.lines)


def _percentile_sql(label: str, expr: str, table: str, extra: str = "") -> str:
    v = f"date_diff('second', {expr})"
    p = ", ".join(f"round(quantile_cont(v, {q}) / 86400, 1) AS {n}" for q, n in (
        (0.5, "p50"), (0.95, "p95"), (0.99, "p99"), (0.9999, "p9999")))
    return (f"SELECT '{label}' AS measure, count(*) AS rows, {p}, round(max(v) / 86400, 1) AS maximum"
            f" FROM (SELECT {v} AS v FROM {table}) t WHERE v IS NOT NULL {extra}")


def _cents(x: str) -> str:
    return f"round(CAST(round({x}, 6) AS DECIMAL(18, 6)), 2)"


_DETAIL_SQL = """SELECT r.*, credit_line, CASE WHEN o.sales_order_id IS NULL THEN 0 ELSE 1 END
                 AS is_credit_order, CASE WHEN credit_line IS NULL THEN 0 ELSE 1 END AS is_enrolled
             FROM recent r LEFT JOIN lims USING (customer_id)
             LEFT JOIN (SELECT sales_order_id FROM owned) o USING (sales_order_id)"""

_CHECK_SQL = """
    SELECT *, CASE WHEN rows = 0 THEN 'OK' ELSE 'ALERT' END AS result FROM (
    SELECT 'blank_sales_order' AS check_name, 'order_lines' AS table_name, 'CRIT' AS severity,
        (SELECT count(*) FROM lines WHERE trim(sales_order_id) = '') AS rows
    UNION ALL SELECT 'completed_without_delivery_date', 'order_lines', 'CRIT',
        (SELECT count(*) FROM lines WHERE order_status = 'COMPLETED' AND delivery_at IS NULL)
    UNION ALL SELECT 'sales_order_with_many_customers', 'order_lines', 'WARN',
        (SELECT count(*) FROM (SELECT sales_order_id FROM vlines GROUP BY 1
            HAVING count(DISTINCT customer_id) > 1) t)
    UNION ALL SELECT 'repeated_approval', 'approvals', 'WARN',
        (SELECT count(*) FROM (SELECT customer_id FROM appr GROUP BY 1 HAVING count(*) > 1) t)
    UNION ALL SELECT 'approval_without_customer', 'approvals', 'WARN',
        (SELECT count(*) FROM appr WHERE customer_id NOT IN (SELECT customer_id FROM cust))
    UNION ALL SELECT 'repeated_transaction', 'payments', 'WARN',
        (SELECT count(*) FROM (SELECT transaction_id FROM pay GROUP BY 1 HAVING count(*) > 1) t)
    UNION ALL SELECT 'completed_without_delivery', 'deliveries', 'WARN',
        (SELECT count(DISTINCT sales_order_id) FROM lines WHERE order_status = 'COMPLETED'
            AND sales_order_id NOT IN (SELECT sales_order_id FROM deliv))
    UNION ALL SELECT 'payment_without_order', 'payments', 'WARN',
        (SELECT count(*) FROM pay WHERE transaction_id NOT IN (SELECT sales_order_id FROM lines))
    UNION ALL SELECT 'stale_manual_load', 'run_log', 'WARN',
        (SELECT count(*) FROM (SELECT event_type FROM events GROUP BY 1
            HAVING max(ts) < DATE '2024-05-10' - 90) t)) c"""
_COUNTS = (("routes", "routes"), ("tranches", "tranches"), ("spans", "spans"),
           ("orders", "gorders"), ("loans", "loans"), ("snapshot", "snap"), ("vintage", "vint"),
           ("revenue", "loans"), ("grid", "grid"), ("daily", "daily"), ("history", "hist"),
           ("panel", "panel"), ("season", "season"), 
           # The Thursday before the business day of the book, less eight days.
           ("cut_lines", """(SELECT * FROM vlines
               WHERE CAST(created_at AS DATE) >= DATE '2001-08-09' - 8) c"""),
           ("cut_orders", """(SELECT DISTINCT customer_id, sales_order_id, order_id, order_status,
               coalesce(sales_channel, 'MARKETPLACE') FROM vlines
               WHERE CAST(created_at AS DATE) >= DATE '2001-08-09' - 8) c"""))
_IDENTITIES = (
    ("orders", "CRIT", "gorders", 1, "0"), ("loans", "CRIT", "loans", 1, "0"),
    ("revenue", "CRIT", "loans", 1, "0"), ("par", "CRIT", "snap", 1, "0"),
    ("month_closes", "CRIT", "snap", 1, "0"), ("vintage", "CRIT", "vint", 1, "0"),
    ("grid", "WARN", "grid", 1, "-(SELECT count(*) FROM cust WHERE customer_id <> trim(customer_id))"),
    ("routes", "CRIT", "routes", 1, "0"), ("spans", "CRIT", "tranches", 1, "0"),
    ("cohort_panel", "CRIT", "panel", 1, "0"), ("seasonality", "CRIT", "season", 11, "0"),
    ("pair_odds", "WARN", "pairs", 1, "0"), ("odds", "WARN", "odds", 1, "0"),
    ("service_profile", "WARN", "(SELECT * FROM customer WHERE c_custkey % 2 = 1)", 1, "0"),
    ("cohort_cac", "WARN", "(SELECT DISTINCT strftime(o_orderdate, '%Y-%m') FROM orders)", 1, "0"))
_KEY = """SELECT '{t}' AS table_name, '{k}' AS key, count(*) AS rows,
    count(*) FILTER (WHERE {e}) AS empty_keys,
    (SELECT count(*) FROM (SELECT {k} FROM {v} WHERE NOT ({e}) GROUP BY {k} HAVING count(*) > 1) d)
        AS repeated_keys FROM {v}"""
_KEYS = (("lines", "lines", ["sales_order_id", "product_id"]),
         ("payments", "pay", ["transaction_id"]), ("approvals", "appr", ["approval_id"]),
         ("approvals", "appr", ["customer_id"]), ("mirrors", "mir", ["mirror_id"]),
         ("deliveries", "deliv", ["sales_order_id"]))
_LAG = "date_sub('second', last_write, TIMESTAMP '2001-08-15 12:00:00') / 3600"

_FRESH_SQL = f"""WITH a AS (
                  SELECT 'credit_order' AS source, count(*) AS source_rows,
                      max(created_at) AS last_write FROM lines UNION ALL
                  SELECT 'payment_report', count(*), max(movement_at) FROM pay UNION ALL
                  SELECT 'state_of_delivery', count(*), max(delivered_at) FROM deliv UNION ALL
                  SELECT 'credit_approval', count(*), max(approved_at) FROM appr UNION ALL
                  SELECT 'customers', count(*), NULL FROM cust),
              z AS (
                  SELECT 'credit_order' AS source, count(*) AS staged_rows,
                      max(created_at) AS last_staged FROM vlines UNION ALL
                  SELECT 'payment_report', count(*), max(movement_at) FROM pay
                      WHERE NOT starts_with(transaction_id, 'uuid-') UNION ALL
                  SELECT 'state_of_delivery', count(*), max(delivered_at) FROM deliv UNION ALL
                  SELECT 'customers', count(*), NULL FROM cust
                      WHERE customer_id = trim(customer_id)),
              l AS (SELECT *, source_rows - staged_rows AS gap, {_LAG} AS lag_hours
                  FROM a LEFT JOIN z USING (source)),
              m AS (SELECT *, greatest(gap, 0) AS missing_rows,
                  CASE WHEN source_rows = 0 THEN 'CRIT' WHEN last_write IS NULL THEN 'SIN_DATOS'
                      WHEN lag_hours >= 48 THEN 'CRIT' WHEN lag_hours >= 24 THEN 'WARN'
                      ELSE 'OK' END AS source_lamp,
                  CASE WHEN staged_rows IS NULL THEN 'FALTA' WHEN source_rows = 0 THEN 'CRIT'
                      WHEN gap <= 0 THEN 'OK' WHEN gap / source_rows <= 0.01 THEN 'WARN'
                      ELSE 'CRIT' END AS staging_lamp FROM l)
              SELECT *, CASE WHEN source_lamp = 'CRIT' OR staging_lamp IN ('CRIT', 'FALTA')
                      THEN 'CRIT' WHEN source_lamp = 'WARN' OR staging_lamp = 'WARN' THEN 'WARN'
                      ELSE 'OK' END AS lamp FROM m"""
QUERIES = [
    # -- loads
    Query("scan_project", lambda b: load.project(b.source.customers, {
        "customer_id": "netsuiteId", "name": "shopName", "category": "business_category"}),
          "customer_id name category",
          """SELECT customer_id, shop_name AS name, business_category AS category FROM cust"""),
    Query("window_or_keys", _window_or_keys,
          "sales_order_id product_id order_status created_at:t",
          f"""SELECT sales_order_id, product_id, order_status, created_at FROM lines
              WHERE created_at >= {AS_OF} - 60 OR sales_order_id IN (
                  SELECT sales_order_id FROM lines WHERE created_at < {AS_OF} - 60
                  AND trim(sales_order_id) <> '' AND (order_status IS NULL OR order_status NOT IN
                  ('COMPLETED', 'REJECTED', 'CANCELLED', 'NO_VISITED')))"""),
    Query("flatten_json", _flatten, "event_id:i props_k:i who_id:i who_detail tags",
          """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k,
             user_id AS who_id,
             CAST(to_json({'event_type': event_type, 'user_id': user_id}) AS VARCHAR) AS who_detail,
             CAST(to_json([event_type]) AS VARCHAR) AS tags FROM events"""),
    Query("yearly_union", lambda b: b.sales.groupBy(F.year("created_on").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("pieces").alias("pieces"),
        F.sum("amount").alias("amount")), "year:i rows:i pieces:m amount:m",
          """SELECT year(created_on) AS year, count(*) AS rows, sum(pieces) AS pieces,
             sum(amount) AS amount FROM slines GROUP BY 1"""),
    Query("full_replace", _full_replace, "id_cliente:i transactional_profile",
          """SELECT c_custkey AS id_cliente, CASE c_custkey % 3 WHEN 0 THEN '01-Healthy'
             WHEN 1 THEN '02-Mixed' ELSE '03-Mostly Fraud' END AS transactional_profile
             FROM customer WHERE c_custkey % 2 = 1"""),
    Query("window_replace", _event_window, "event_id:i user_id:i event_type ts:t",
          """WITH r AS (SELECT DISTINCT user_id FROM events WHERE event_id % 2 = 0
                 AND user_id % 3 = 0 AND event_type = 'error' AND ts < TIMESTAMP '2024-01-21')
             SELECT * FROM events WHERE (event_id % 2 = 0 AND ts < TIMESTAMP '2024-01-21'
                 AND user_id NOT IN (SELECT user_id FROM r))
             OR (event_id % 2 = 1 AND (ts >= TIMESTAMP '2024-01-21'
                 OR user_id IN (SELECT user_id FROM r)))"""),
    Query("run_log_upsert", lambda b: load.append_new(
        _runs(b).filter("event_id % 3 = 0"), _runs(b), ["started_at", "table_name"]),
          "table_name started_at:t rows:i mode",
          "SELECT DISTINCT table_name, started_at, rows, mode FROM runs"),
    Query("load_modes", lambda b: load.load_modes(
        _runs(b).filter("table_name <> 'view' OR mode = 'window'"),
        ["click", "error", "purchase", "view"], _MODES_AT, 30),
          "table_name last_full:t mode",
          f"""SELECT table_name, last_full, CASE WHEN table_name = 'signup' OR last_full IS NULL
                 OR last_full <= TIMESTAMP '{_MODES_AT}' - INTERVAL 30 DAY THEN 'full'
                 ELSE 'window' END AS mode FROM (
             SELECT table_name, max(started_at) FILTER (WHERE mode = 'full' AND table_name <> 'view')
                 AS last_full FROM runs GROUP BY 1)"""),
    Query("csv_contract", _csv_contract, "customer:i profile",
          """SELECT c_custkey AS customer, CASE c_custkey % 3 WHEN 0 THEN '01-Healthy'
             WHEN 1 THEN '02-Mixed' ELSE '03-Mostly Fraud' END AS profile
             FROM customer WHERE c_custkey % 2 = 1"""),
    Query("header_contract", _header_contract, "customer_id line:m class route",
          """SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
             CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_acctbal + 2000 END AS line,
             CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS class,
             'R' || c_custkey % 9 AS route FROM customer WHERE c_custkey % 3 = 1"""),
    Query("file_contract", _file_contract,
          "combo_id atr1_rank atr2_rank events:i good:i bad:i br:r woe:r iv:r",
          """SELECT loan_range || '_' || flag || '_' || atr1 || ' & ' || atr2 AS combo_id,
             atr1_rank, atr2_rank, events, good, bad, bad_rate AS br, woe, iv FROM pairs"""),
    Query("csv_rejects", lambda b: _spoiled(b).problems, "line column value reason",
          f"""WITH s AS ({_SPOILED}) SELECT line, 'id_cliente' AS "column", id AS value,
                 'is no bigint' AS reason FROM s WHERE id LIKE 'no%'
             UNION ALL SELECT line, 'id_cliente', NULL, 'is missing' FROM s WHERE id IS NULL
             UNION ALL SELECT line, 'transactional_profile', NULL, 'is missing' FROM s
             WHERE profile IS NULL"""),
    Query("csv_dry_run", lambda b: rejects.dry_run(_spoiled(b)),
          "column type rejected:i filled:i distinct:i",
          f"""WITH s AS ({_SPOILED}),
             g AS (SELECT * FROM s WHERE id NOT LIKE 'no%' AND profile IS NOT NULL)
             SELECT 'id_cliente' AS "column", 'bigint' AS type, (SELECT count(*) FROM s
                 WHERE id LIKE 'no%' OR id IS NULL) AS rejected, count(*) AS filled,
                 count(DISTINCT id) AS "distinct" FROM g
             UNION ALL SELECT 'transactional_profile', 'string', (SELECT count(*) FROM s
                 WHERE profile IS NULL), count(*), count(DISTINCT profile) FROM g"""),
    Query("rejected_values", _rejected_values, "started_at:t table_name column_name values:i",
          f"""SELECT TIMESTAMP '{SAMPLE.now}' AS started_at, 'service_profile' AS table_name,
             'id_cliente' AS column_name, count(*) AS values FROM customer
             WHERE c_custkey % 2 = 1 AND c_custkey % 10 = 1"""),
    Query("windowed_intake", _intake,
          "salesOrderId orderId productId orderStatus quantity:m",
          """SELECT sales_order_id AS "salesOrderId", order_id AS "orderId",
             product_id AS "productId", CASE WHEN trim(sales_order_id) = ''
                 AND order_status = 'IN_DELIVERY' AND created_at < DATE '2001-05-03'
                 THEN 'CREATED' ELSE order_status END AS "orderStatus", quantity FROM lines"""),
    Query("csv_export", _csv_export,
          "customer_id sales_order_id created_on:t amount:m credit_line:m is_credit_order:i",
          """SELECT r.customer_id, r.sales_order_id, created_on, amount, credit_line,
             CASE WHEN o.sales_order_id IS NULL THEN 0 ELSE 1 END AS is_credit_order
             FROM recent r JOIN lims l USING (customer_id)
             LEFT JOIN owned o ON o.sales_order_id = r.sales_order_id
             WHERE credit_line IS NOT NULL"""),
    Query("csv_detail", _csv_detail,
          "customer_id sales_order_id created_on:t amount:m is_credit_order:i is_enrolled:i"
          " credit_line:m", _DETAIL_SQL),
    Query("load_profile", lambda b: load.profile(
        b.payments.select("transaction_id", "total_amount", "paid_at", "total_default"),
        "transaction_id", ["total_amount"]),
          "rows:i keys:i transaction_id_nulls:i total_amount_nulls:i paid_at_nulls:i"
          " total_default_nulls:i total_amount_min:m total_amount_max:m total_amount_sum:m",
          """SELECT count(*) AS rows, count(DISTINCT transaction_id) AS keys,
             count(*) - count(transaction_id) AS transaction_id_nulls,
             count(*) - count(total_amount) AS total_amount_nulls,
             count(*) - count(paid_at) AS paid_at_nulls,
             count(*) - count(total_default) AS total_default_nulls,
             min(total_amount) AS total_amount_min, max(total_amount) AS total_amount_max,
             sum(total_amount) AS total_amount_sum FROM pay"""),
    Query("value_counts", lambda b: load.value_counts(b.lines, "sales_channel"), "value rows:i",
          "SELECT sales_channel AS value, count(*) AS rows FROM lines GROUP BY 1"),
    Query("universe", lambda b: b.universe, "customer_id", "univ"),
    Query("nightly_build", _nightly, "table_name rows:i",
          " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {v}"
                             for n, v in _COUNTS)),
    Query("changed_build", _changed_build, "table_name rows:i",
          " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {v}"
                             for n, v in _COUNTS if n in _BEHIND_ROUTES)),

    # -- scalar functions
    Query("time_functions", lambda b: b.source.table("orders").select(
        "o_orderkey", to_monday(F.to_date("o_orderdate")).alias("monday"),
        last_thursday(F.to_date("o_orderdate")).alias("thursday"),
        epoch_ms_to_local(F.when(F.col("o_orderkey") % 10 == 0, 0.0).otherwise(
            F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("double"))).alias("local"),
        local_to_epoch_ms(F.col("o_orderdate")).alias("epoch")),
          "o_orderkey:i monday:t thursday:t local:t epoch:i",
          f"""SELECT o_orderkey, {monday('CAST(o_orderdate AS DATE)')} AS monday,
              CAST(o_orderdate AS DATE) - CAST((isodow(o_orderdate) - 4 + 7) % 7 AS INTEGER)
                  AS thursday,
              CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate - INTERVAL 6 HOUR END AS local,
              epoch_ms(o_orderdate) + 21600000 AS epoch FROM orders"""),
    Query("text_functions", lambda b: b.source.customers.select(
        "netsuiteId", int_key("netsuiteId").alias("key"),
        digits_key("address_zipCode").alias("zip"),
        coordinate("address_latitude", 90).alias("latitude")).join(
        b.source.credit_request.select(
            F.expr("substring(customerId, 2)").alias("netsuiteId"),
            text_to_date("birthdate").alias("birth"),
            clean_text("latitude").alias("raw_latitude")), "netsuiteId", "left"),
          "netsuiteId key:i zip:i latitude:r birth:t",
          """SELECT customer_id AS "netsuiteId", CAST(trim(customer_id) AS BIGINT) AS key,
             CAST(substr(shop_zip, 4) AS BIGINT) AS zip, shop_latitude AS latitude,
             birthdate AS birth FROM cust LEFT JOIN req ON req.document_id = 'C' || customer_id"""),
    Query("delinquency_rules", lambda b: b.loans.select(
        "days_past_due", delinquency_bucket("days_past_due").alias("bucket"),
        penalty("days_past_due", 200).alias("penalty")).groupBy("bucket", "penalty").agg(
        F.count(F.lit(1)).alias("loans")), "bucket penalty:i loans:i",
          f"""SELECT {bucket('days_past_due')} AS bucket, CASE WHEN days_past_due <= 0 THEN 0
              ELSE 200 * floor(days_past_due / 7) END AS penalty, count(*) AS loans
              FROM loans GROUP BY 1, 2"""),

    # -- keys and joins
    Query("clean_keys", lambda b: explore.id_quality(b.source.customers, "netsuiteId"),
          "rows:i blank:i numeric:i",
          """SELECT count(*) AS rows, count(*) FILTER (WHERE trim(customer_id) = '') AS blank,
             count(*) FILTER (WHERE regexp_full_match(trim(customer_id), '[0-9]+')) AS numeric
             FROM cust"""),
    Query("fallback_join", _fallback, "transaction_id marketplace_order_id matched_key movement_at:t",
          """SELECT transaction_id, marketplace_order_id, sales_order_id AS matched_key, movement_at
             FROM pmatch"""),
    Query("scd_join", _scd, "customer_id order_key:i day:t route tranche:i",
          """SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderkey AS order_key,
             CAST(o_orderdate AS DATE) AS day, route, tranche FROM orders LEFT JOIN spans
             ON customer_id = CAST(o_custkey AS VARCHAR)
             AND CAST(o_orderdate AS DATE) BETWEEN valid_from AND valid_to"""),
    Query("orphan_counts", _orphans, "orphan rows:i",
          """SELECT 'payment' AS orphan, count(*) AS rows FROM pay
                 WHERE transaction_id NOT IN (SELECT sales_order_id FROM lines)
             UNION ALL SELECT 'line', count(*) FROM lines WHERE order_status = 'COMPLETED'
                 AND sales_order_id NOT IN (SELECT sales_order_id FROM deliv)
             UNION ALL SELECT 'approval', count(*) FROM appr
                 WHERE customer_id NOT IN (SELECT customer_id FROM cust)"""),
    Query("null_safe_join", _null_safe, "channel old:m new:m",
          """SELECT channel, sum(amount) FILTER (WHERE year(created_on) < 1999) AS old,
             sum(amount) FILTER (WHERE year(created_on) >= 1999) AS new FROM slines GROUP BY 1"""),
    Query("post_event_sales", lambda b: _around(b).filter(
        "orders_field_after + orders_other_after > 0"),
          "customer_id gross_field_after:m orders_field_after:i gross_other_after:m"
          " orders_other_after:i",
          "SELECT * FROM after WHERE orders_field_after + orders_other_after > 0"),
    Query("lookback_windows", lambda b: _around(b).filter("orders_6m > 0"),
          "customer_id gross_3m:m orders_3m:i gross_6m:m orders_6m:i",
          "SELECT * FROM before WHERE orders_6m > 0"),
    Query("reach_share", lambda b: explore.reach_share(b.snapshot, risk.matured(b.loan_core, b.terms)),
          "rows:i orders:i reached_orders:i pct_rows:r balance:m reached_balance:m",
          """SELECT count(*) AS rows, count(DISTINCT s.sales_order_id) AS orders,
             count(DISTINCT l.sales_order_id) AS reached_orders,
             count(l.sales_order_id) * 100 / count(*) AS pct_rows, sum(total_amount) AS balance,
             sum(total_amount) FILTER (WHERE l.sales_order_id IS NOT NULL) AS reached_balance
             FROM snap s LEFT JOIN (SELECT sales_order_id FROM loans
                 WHERE due_on < TIMESTAMP '2001-08-15 12:00:00') l USING (sales_order_id)"""),

    # -- aggregates
    Query("collapse_lines", lambda b: credit.collapse_lines(b.lines),
          "customer_id sales_order_id order_id order_status sales_channel created_at:t"
          " delivery_at:t order_gross_sales:m skus:i quantity:m", "corders"),
    Query("status_pick", lambda b: contest.order_state(b.orders),
          "customer_id sales_order_id order_status is_delivered is_active is_cancelled is_rejected"
          " skus:i quantity:m", "cstate"),
    Query("ordered_having", _havings, "having groups:i",
          """SELECT 'many statuses' AS having, (SELECT count(*) FROM (SELECT sales_order_id
                 FROM vlines GROUP BY 1 HAVING count(DISTINCT order_status) > 1) t) AS groups
             UNION ALL SELECT 'repeated approval', (SELECT count(*) FROM (SELECT customer_id
                 FROM appr GROUP BY 1 HAVING count(*) > 1) t)
             UNION ALL SELECT 'large month', (SELECT count(*) FROM (SELECT customer_id, month
                 FROM omon GROUP BY 1, 2 HAVING sum(amount) > 1000000) t)
             UNION ALL SELECT 'not empty', (SELECT count(*) FROM hist)"""),
    Query("percentile_profile", lambda b: explore.mutability(b.lines, b.payments, b.mirrors),
          "measure rows:i p50:r p95:r p99:r p9999:r maximum:r",
          _percentile_sql("order to delivery", "created_at, delivery_at", "lines", "AND v >= 0")
          + " UNION ALL " + _percentile_sql("movement to payment", "movement_at, paid_at", "pay")
          + " UNION ALL " + _percentile_sql("movement to update", "movement_at, updated_at", "mir")),
    Query("bucket_share", lambda b: explore.bucket_share(b.snapshot),
          "par rows:i balance:m pct_rows:r",
          """SELECT par, count(*) AS rows, sum(total_amount) AS balance,
             count(*) * 100 / sum(count(*)) OVER () AS pct_rows FROM snap GROUP BY 1"""),
    Query("key_uniqueness", lambda b: load.union_all([
        explore.key_report(getattr(b, t), t, k) for t, _, k in _KEYS]),
          "table_name key rows:i empty_keys:i repeated_keys:i verdict",
          "SELECT *, CASE WHEN empty_keys = 0 AND repeated_keys = 0 THEN 'PK' ELSE 'index' END"
          " AS verdict FROM (" + " UNION ALL ".join(
              _KEY.format(t=t, v=v, k=",".join(k), e=" OR ".join(f"{c} IS NULL" for c in k))
              for t, v, k in _KEYS) + ") k"),

    # -- windows
    Query("order_indices", lambda b: credit.order_indices(
        credit.collapse_lines(b.lines)),
          "customer_id sales_order_id order_status attempt_index:i completed_index:i"
          " activated_at:t", "indexed"),
    Query("latest_payment", lambda b: credit.payment_per_order(b.payments, b.order_keys).join(
        b.order_keys.select("sales_order_id"), "sales_order_id", "left_semi"),
          "sales_order_id transaction_id movement_at:t paid_at:t", "plast"),
    Query("first_approval", lambda b: credit.first_approvals(b.approvals),
          "customer_id enrolled_at:t enrollment_cohort enrolled_limit:m", "enrolled"),
    Query("state_islands", lambda b: islands(
        _events(b).groupBy("user_id", F.to_date("ts").alias("day")).agg(
            F.max_by("event_type", "event_id").alias("state"), F.count(F.lit(1)).alias("n")),
        "user_id", "day", "state", ["n"]),
          "user_id:i state n:i valid_from:t valid_to:t days:i",
          """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day,
                 max_by(event_type, event_id) AS state, count(*) AS n FROM events GROUP BY 1, 2),
             c AS (SELECT *, CASE WHEN lag(state) OVER w IS DISTINCT FROM state THEN 1 ELSE 0 END
                 AS changed FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day)),
             g AS (SELECT *, sum(changed) OVER (PARTITION BY user_id ORDER BY day) AS run FROM c)
             SELECT user_id, state, max(n) AS n, min(day) AS valid_from, max(day) AS valid_to,
             count(*) AS days FROM g GROUP BY user_id, state, run"""),
    Query("global_rownum", lambda b: number_rows(
        b.source.order_heads, ["netsuiteId", "salesOrderId"], "n"), "n:i netsuiteId salesOrderId",
          """SELECT row_number() OVER (ORDER BY customer_id, sales_order_id) AS n,
             customer_id AS "netsuiteId", sales_order_id AS "salesOrderId" FROM heads"""),
    Query("event_sequence", lambda b: keyed_window(
        _events(b), ["event_type"], ["ts", "event_id"],
        {"n": F.lit(1), "clicks": F.when(F.col("value") > 50, 1)},
        {"top": ("max", F.col("value"))}), "event_id:i n:i clicks:i top:m",
          """SELECT event_id, row_number() OVER w AS n,
             coalesce(sum(CASE WHEN value > 50 THEN 1 END) OVER w, 0) AS clicks,
             max(value) OVER (PARTITION BY event_type) AS top FROM events
             WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    Query("cumulative_distinct", lambda b: measures.cumulative_enrolled(b.members),
          "day:t enrolled:i cumulative_enrolled:i",
          """WITH d AS (SELECT CAST(enrolled_at AS DATE) AS day, count(DISTINCT customer_id)
                 AS enrolled FROM enrolled JOIN cust USING (customer_id) GROUP BY 1)
             SELECT *, sum(enrolled) OVER (ORDER BY day) AS cumulative_enrolled FROM d"""),
    Query("threshold_month", lambda b: measures.threshold_month(b.panel), "month:t customers:i",
          """WITH s AS (SELECT first_credit, sum(cohort_customers) AS c FROM panel
                 WHERE credit_flag = 'Y' GROUP BY 1),
             r AS (SELECT *, sum(c) OVER (ORDER BY first_credit) AS run, sum(c) OVER () AS tot
                 FROM s)
             SELECT min(first_credit) FILTER (WHERE run >= tot * 0.1) AS month,
             max(tot) AS customers FROM r"""),
    Query("running_by_month", lambda b: measures.running_by_month(
        b.orders, "created_month", "order_gross_sales"),
          "created_month order_gross_sales:m running:m",
          """SELECT created_month, sum(order_gross_sales) AS order_gross_sales,
             sum(sum(order_gross_sales)) OVER (ORDER BY created_month) AS running
             FROM gorders GROUP BY 1"""),

    # -- quality
    Query("freshness", _freshness,
          "source source_rows:i staged_rows:i last_write:t last_staged:t missing_rows:i lag_hours:r"
          " source_lamp staging_lamp lamp",
          _FRESH_SQL),
    Query("row_checks", _checks, "check_name table_name severity rows:i result", _CHECK_SQL),
    Query("check_runner", lambda b: _checks(b, ("deliveries", "manual_loads")),
          "check_name table_name severity rows:i result",
          f"""SELECT check_name, table_name, severity, CASE WHEN usable THEN rows END AS rows,
                 CASE WHEN usable THEN result ELSE 'NOT_APPLICABLE' END AS result FROM (SELECT *,
                 check_name NOT IN ('completed_without_delivery', 'stale_manual_load') AS usable
                 FROM ({_CHECK_SQL}) r)"""),
    Query("gate", lambda b: quality.blocking(_freshness(b), list(nightly.CRITICAL_SOURCES)),
          "source source_lamp",
          f"""SELECT source, source_lamp FROM ({_FRESH_SQL}) f WHERE source_lamp = 'CRIT'
              AND source IN ('credit_order', 'payment_report', 'state_of_delivery')"""),
    Query("identities", _identities, "identity severity source_rows:i target_rows:i gap:i",
          " UNION ALL ".join(
              f"SELECT '{n}' AS identity, '{s}' AS severity, count(*) AS source_rows,"
              f" count(*) * {f} + ({d}) AS target_rows, 0 AS gap FROM {v} x"
              for n, s, v, f, d in _IDENTITIES)),
    Query("new_alerts", lambda b: quality.new_alerts(_alert_history(b)),
          "check_name severity rows:i",
          """WITH h AS (SELECT CAST(ts AS DATE) AS d, user_id,
                 count(*) FILTER (WHERE event_type = 'error') AS n FROM events GROUP BY 1, 2),
             k AS (SELECT d, row_number() OVER (ORDER BY d DESC) AS a
                 FROM (SELECT DISTINCT d FROM h) t)
             SELECT 'user-' || user_id AS check_name, CASE WHEN n > 1 THEN 'CRIT' ELSE 'WARN' END
                 AS severity, n AS rows FROM h JOIN k USING (d) WHERE a = 1 AND n > 0
             AND user_id NOT IN (SELECT user_id FROM h JOIN k USING (d) WHERE a = 2 AND n > 0)"""),
    Query("catalog_audit", _audit, "view status rows:i empty",
          """SELECT 'pub_cohort_panel' AS view, 'present' AS status, count(*) AS rows, false AS empty
             FROM panel UNION ALL SELECT 'pub_seasonality', 'present', count(*), false FROM spairs
             UNION ALL SELECT 'pub_service_profile', 'present', count(*), false FROM customer
             WHERE c_custkey % 2 = 1 UNION ALL SELECT 'pub_not_built', 'missing', 0, false"""),
    Query("isolated_views", _isolated_views, "view rows:i",
          """SELECT 'pub_service_profile' AS view, count(*) AS rows FROM customer
             WHERE c_custkey % 2 = 1 UNION ALL SELECT 'pub_vintage', count(*) FROM vint
             UNION ALL SELECT 'pub_broken', NULL"""),
    Query("footer_probe", _footer_probe, "table_name rows:i last:i",
          """SELECT 'credit_order' AS table_name, count(*) AS rows,
                 max(epoch_ms(created_at)) + 21600000 AS last FROM lines
             UNION ALL SELECT 'payment_report', count(*), max(epoch_ms(movement_at)) + 21600000 FROM pay
             UNION ALL SELECT 'service_profile', count(*), NULL FROM customer
             WHERE c_custkey % 2 = 1"""),
    Query("empty_guard", _empty_guard, "table_name outcome rows:i",
          """SELECT 'credit_order' AS table_name, 'kept' AS outcome, count(*) AS rows FROM lines
             UNION ALL SELECT 'service_profile', 'kept', count(*) FROM customer
             WHERE c_custkey % 2 = 1 UNION ALL SELECT 'cohort_cac', 'loaded', count(*) FROM (
             SELECT DISTINCT strftime(o_orderdate, '%Y-%m') FROM orders)"""),
    Query("volume_report", lambda b: quality.latest_volume(_runs(b).withColumn(
        "table_name", F.expr("IF(table_name = 'signup' AND event_id % 100 = 2, 'run_start',"
                             " table_name)")), "run_start"),
          "table_name loads:i rows:i seconds:m last_at:t",
          """WITH r AS (SELECT * REPLACE (CASE WHEN table_name = 'signup' AND event_id % 100 = 2
                 THEN 'run_start' ELSE table_name END AS table_name) FROM runs),
             s AS (SELECT max(started_at) AS begun FROM r WHERE table_name = 'run_start')
             SELECT table_name, count(*) AS loads, sum(rows) AS rows, sum(seconds) AS seconds,
             max(started_at) AS last_at FROM r, s WHERE started_at >= begun
             AND table_name <> 'run_start' GROUP BY 1"""),

    # -- exploration
    Query("x02_not_final_by_age", lambda b: explore.not_final_by_age(b.lines, b.terms),
          "order_status rows:i oldest:t newest:t beyond_window:i",
          f"""SELECT order_status, count(*) AS rows, min(CAST(created_at AS DATE)) AS oldest,
              max(CAST(created_at AS DATE)) AS newest, count(*) FILTER (
                  WHERE CAST(created_at AS DATE) < {AS_OF} - 60) AS beyond_window
              FROM lines GROUP BY 1"""),
    Query("x02_volume_by_year", lambda b: explore.volume_by_year(b.lines),
          "year:i lines:i orders:i",
          """SELECT year(created_at) AS year, count(*) AS lines,
             count(DISTINCT sales_order_id) AS orders FROM lines GROUP BY 1"""),
    Query("x03_window_sizes", lambda b: explore.window_sizes(b.lines, b.terms),
          "days:i rows:i pct:r",
          f"""SELECT n AS days, count(*) FILTER (WHERE CAST(created_at AS DATE)
                  >= {AS_OF} - CAST(n AS INTEGER)) AS rows,
              count(*) FILTER (WHERE CAST(created_at AS DATE) >= {AS_OF} - CAST(n AS INTEGER))
                  * 100 / count(*) AS pct
              FROM lines CROSS JOIN (VALUES (15), (30), (45), (60), (90)) d(n) GROUP BY 1"""),
    Query("x04_overlap", lambda b: explore.overlap(
        b.payments, b.mirrors.withColumnRenamed("sales_order_id", "transaction_id"),
        "transaction_id"), "in_both:i only_left:i only_right:i",
          """WITH p AS (SELECT DISTINCT transaction_id AS t FROM pay),
             m AS (SELECT DISTINCT sales_order_id AS t FROM mir)
             SELECT (SELECT count(*) FROM p WHERE t IN (SELECT t FROM m)) AS in_both,
             (SELECT count(*) FROM p WHERE t NOT IN (SELECT t FROM m)) AS only_left,
             (SELECT count(*) FROM m WHERE t NOT IN (SELECT t FROM p)) AS only_right"""),
    Query("x04_agreement", lambda b: explore.agreement(b.payments, b.mirrors),
          "field keys:i equal:i share:r",
          f"""WITH p AS (SELECT * FROM pay QUALIFY row_number() OVER (PARTITION BY transaction_id
                 ORDER BY movement_at, total_amount) = 1),
             m AS (SELECT * FROM mir QUALIFY row_number() OVER (PARTITION BY sales_order_id
                 ORDER BY mirror_id) = 1),
             j AS (SELECT {_cents('p.total_amount')} = {_cents('m.total_amount')} AS a,
                 {_cents('p.total_to_pay')} = {_cents('m.total_to_pay')} AS b,
                 {_cents('p.interests')} = {_cents('m.interests')} AS c
                 FROM p JOIN m ON p.transaction_id = m.sales_order_id),
             t AS (SELECT count(*) AS n, count(*) FILTER (WHERE a) AS a,
                 count(*) FILTER (WHERE b) AS b, count(*) FILTER (WHERE c) AS c FROM j)
             SELECT 'total_amount' AS field, n AS keys, a AS equal, a / n AS share FROM t
             UNION ALL SELECT 'total_to_pay', n, b, b / n FROM t
             UNION ALL SELECT 'interests', n, c, c / n FROM t"""),
    Query("x04_differences", lambda b: explore.source_differences(b.payments, b.mirrors),
          "order_id kind changed left_rows:i right_rows:i",
          f"""WITH a AS (SELECT transaction_id AS k, {_cents('total_amount')} AS x,
                 {_cents('total_to_pay')} AS y FROM pay WHERE transaction_id IS NOT NULL),
             b AS (SELECT sales_order_id AS k, {_cents('total_amount')} AS x,
                 {_cents('total_to_pay')} AS y FROM mir WHERE sales_order_id IS NOT NULL),
             n AS (SELECT k, x, y, count(*) FILTER (WHERE s = 'l') AS l,
                 count(*) FILTER (WHERE s = 'r') AS r FROM (
                 SELECT *, 'l' AS s FROM a UNION ALL SELECT *, 'r' FROM b) GROUP BY ALL),
             g AS (SELECT k, sum(l) AS left_rows, sum(r) AS right_rows,
                 count(*) FILTER (WHERE l <> r) AS odd,
                 min(x) IS DISTINCT FROM max(x) OR count(x) = 1 AS dx,
                 min(y) IS DISTINCT FROM max(y) OR count(y) = 1 AS dy FROM n GROUP BY k)
             SELECT k AS order_id, CASE WHEN right_rows = 0 THEN 'only_left' WHEN left_rows = 0
                 THEN 'only_right' ELSE 'changed' END AS kind,
             CASE WHEN left_rows = 1 AND right_rows = 1 THEN concat_ws(' ',
                 CASE WHEN dx THEN 'total_amount' END, CASE WHEN dy THEN 'total_to_pay' END) END
                 AS changed, left_rows, right_rows FROM g WHERE odd > 0"""),
    Query("x04_payment_orphans", lambda b: explore.payment_orphans(b.payments, b.order_keys),
          "orphans:i ids:i rescued:i lost:i",
          """WITH l AS (SELECT * FROM pay WHERE transaction_id NOT IN
                 (SELECT sales_order_id FROM okeys))
             SELECT count(*) AS orphans, count(DISTINCT transaction_id) AS ids,
             count(*) FILTER (WHERE marketplace_order_id IN (SELECT order_id FROM okeys))
                 AS rescued,
             count(*) FILTER (WHERE marketplace_order_id NOT IN (SELECT order_id FROM okeys))
                 AS lost FROM l"""),
    Query("x04_orphan_years", lambda b: explore.orphan_years(b.payments, b.order_keys),
          "year:i transaction_status payments:i amount:m",
          """SELECT year(movement_at) AS year, transaction_status, count(*) AS payments,
             sum(total_amount) AS amount FROM pay WHERE transaction_id NOT IN
             (SELECT sales_order_id FROM okeys) GROUP BY 1, 2"""),
    Query("x04_latest_orphans", lambda b: explore.latest_orphans(b.payments, b.order_keys),
          "transaction_id customer_id transaction_status movement_at:t total_amount:m",
          """SELECT transaction_id, customer_id, transaction_status, movement_at, total_amount
             FROM pay WHERE transaction_id NOT IN (SELECT sales_order_id FROM okeys)
             ORDER BY movement_at DESC, transaction_id LIMIT 8"""),
    Query("x05_amount_hypotheses", lambda b: explore.amount_hypotheses(b.payments, b.terms),
          "hypothesis rows:i hits:i share:r",
          f"""WITH t AS (SELECT count(*) AS n,
                 count(*) FILTER (WHERE {_cents('commission_due')} = {_cents('interests * 1.16')}) AS a,
                 count(*) FILTER (WHERE {_cents('total_to_pay - total_amount')}
                     = {_cents('commission_due')}) AS b,
                 count(*) FILTER (WHERE {_cents('total_to_pay - total_amount')}
                     = {_cents('interests')}) AS c FROM pay WHERE interests > 0)
             SELECT 'commission = interest with tax' AS hypothesis, n AS rows, a AS hits,
                 a / n AS share FROM t
             UNION ALL SELECT 'spread = commission', n, b, b / n FROM t
             UNION ALL SELECT 'spread = interest', n, c, c / n FROM t"""),
    Query("x05_revenue_by_year", lambda b: explore.revenue_by_year(b.payments, b.terms),
          "year:i transactions:i financed:m interest:m share_of_interest:m share_of_spread:m",
          """SELECT year(movement_at) AS year, count(*) AS transactions,
             sum(total_amount) AS financed, sum(interests) AS interest,
             sum(interests * 0.142) AS share_of_interest,
             sum((total_to_pay - total_amount) * 0.142) AS share_of_spread
             FROM pay WHERE transaction_status = 'paid' GROUP BY 1"""),
    Query("x06_route_coverage", lambda b: explore.route_coverage(
        normalise.route_days(b.source.route_days), b.universe),
          "customers:i with_route:i route_days:i from_day:t to_day:t",
          """WITH r AS (SELECT customer_id, min(day) AS a, max(day) AS z, count(*) AS n FROM rdays
                 WHERE route IS NOT NULL GROUP BY 1)
             SELECT count(*) AS customers, count(n) AS with_route, sum(n) AS route_days,
             min(a) AS from_day, max(z) AS to_day FROM univ LEFT JOIN r USING (customer_id)"""),
    Query("x06_type_profile", lambda b: explore.type_profile(
        b.payments.select("transaction_id", "paid_at", "total_amount"), "payments"),
          "table_name column type filled:i",
          """SELECT 'payments' AS table_name, 'transaction_id' AS "column", 'string' AS type,
                 count(transaction_id) AS filled FROM pay
             UNION ALL SELECT 'payments', 'paid_at', 'timestamp_ntz', count(paid_at) FROM pay
             UNION ALL SELECT 'payments', 'total_amount', 'double', count(total_amount) FROM pay"""),
    Query("x07_recent_orders", _recent, "customer_id sales_order_id created_on:t amount:m",
          "recent"),
    Query("x08_segment_summary", lambda b: explore.segment_summary(_recent(b), *_lines_and(b)),
          "segment customers:i orders:i amount:m pct_customers:r drop_size:m",
          """WITH a AS (SELECT customer_id, count(DISTINCT sales_order_id) AS orders,
                 sum(amount) AS amount FROM recent GROUP BY 1),
             t AS (SELECT a.*, CASE WHEN customer_id IN (SELECT customer_id FROM owned)
                 THEN 'with use' WHEN customer_id IN (SELECT customer_id FROM lims)
                 THEN 'enrolled, no use' ELSE 'no credit' END AS segment FROM a),
             s AS (SELECT segment, count(*) AS customers, sum(orders) AS orders,
                 sum(amount) AS amount FROM t GROUP BY 1),
             u AS (SELECT *, customers * 100 / sum(customers) OVER () AS pct_customers FROM s
                 UNION ALL SELECT 'TOTAL', sum(customers), sum(orders), sum(amount), 100 FROM s)
             SELECT *, amount / orders AS drop_size FROM u"""),
    Query("x09_line_drop_size", lambda b: explore.line_against_drop_size(
        explore.approved_limits(b.approvals), _recent(b)),
          "customer_id credit_line:m drop_size:m amount:m orders:i",
          """SELECT l.*, amount, orders, amount / orders AS drop_size FROM lims l LEFT JOIN (
             SELECT customer_id, count(DISTINCT sales_order_id) AS orders, sum(amount) AS amount
             FROM recent GROUP BY 1) a USING (customer_id)"""),
    Query("x10_detail_base", lambda b: explore.detail_base(_recent(b), *_lines_and(b)),
          "customer_id sales_order_id created_on:t amount:m is_credit_order:i is_enrolled:i"
          " credit_line:m",
          _DETAIL_SQL),
    Query("x11_line_histogram", lambda b: explore.line_histogram(
        explore.approved_limits(b.approvals)), "bin_from:i customers:i",
          """SELECT floor(credit_line / 1000) * 1000 AS bin_from, count(*) AS customers FROM lims
             WHERE credit_line >= 0 GROUP BY 1"""),
    Query("x12_enrolled_limits", lambda b: explore.approved_limits(b.approvals),
          "customer_id credit_line:m", "lims"),
    Query("x12_proposed_limits", lambda b: explore.proposed_limits(b.source.contest_customers),
          "customer_id credit_line:m classification", "prop"),
    Query("x12_owned_orders", lambda b: explore.owned_orders(b.lines),
          "sales_order_id customer_id", "owned"),
    Query("x13_compare_lines", lambda b: explore.compare_lines(
        explore.approved_limits(b.approvals), explore.proposed_limits(b.source.contest_customers)),
          "customer_id approved_line:m proposed_line:m difference:m classification origin",
          """SELECT coalesce(a.customer_id, p.customer_id) AS customer_id,
             a.credit_line AS approved_line, p.credit_line AS proposed_line,
             p.credit_line - a.credit_line AS difference, classification,
             CASE WHEN a.customer_id IS NULL THEN 'only proposed'
                  WHEN p.customer_id IS NULL THEN 'only approved' ELSE 'both' END AS origin
             FROM lims a FULL JOIN prop p ON a.customer_id = p.customer_id"""),
    Query("x14_last_cutoffs", lambda b: explore.last_cutoffs(b.snapshot), "cutoff:t rows:i balance:m",
          """SELECT cutoff, count(*) AS rows, sum(total_amount) AS balance FROM snap GROUP BY 1
             ORDER BY 1 DESC LIMIT 4"""),
    Query("x14_two_rates", lambda b: explore.two_rates(b.vintage),
          "par30:m balance:m capital:m pct_of_balance:r pct_of_capital:r",
          """SELECT sum(par30) AS par30, sum(outstanding_balance) AS balance,
             sum(deployed_capital) AS capital,
             round(sum(par30) * 100 / sum(outstanding_balance), 6) AS pct_of_balance,
             round(sum(par30) * 100 / sum(deployed_capital), 6) AS pct_of_capital FROM vint"""),
    Query("stage_orders", lambda b: measures.stage_walk(b.loan_core, b.terms).groupBy("stage", "step")
          .agg(F.count(F.lit(1)).alias("loans")).withColumn(
        "position", measures.ordinal("stage", STAGE_ORDER)), "stage step:i loans:i position:i",
          """SELECT stage, step, count(*) AS loans, CASE stage WHEN 'Paid' THEN 8 ELSE step END
             AS position FROM walk GROUP BY 1, 2"""),
    Query("first_purchase", lambda b: first_per_key(
        b.history, ["customer_id"], [F.col("created_on"), F.col("sales_order_id")]),
          "customer_id sales_order_id created_on:t channel amount:m",
          """SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY customer_id
             ORDER BY created_on, sales_order_id) = 1"""),
    Query("active_credit", lambda b: b.valid_lines.filter(
        F.col("order_status").isin("COMPLETED", "CREATED", "IN_DELIVERY")).groupBy(
        "customer_id").agg(F.count_distinct("sales_order_id").alias("orders")),
          "customer_id orders:i",
          f"""SELECT customer_id, count(DISTINCT sales_order_id) AS orders FROM vlines
              WHERE order_status IN {ACTIVE} GROUP BY 1"""),

    # -- streams
    Query("stream_upsert", _stream_upsert, "id ts:t changed_at:t status value:m",
          """SELECT 'E' || event_id AS id, ts, CASE WHEN event_id % 3 = 0 THEN ts
                 ELSE ts + to_days(CAST(event_id % 20 + 1 AS INTEGER)) END AS changed_at,
             CASE WHEN event_id % 3 = 0 THEN 'open' ELSE 'done' END AS status,
             CASE WHEN event_id % 3 = 0 THEN value ELSE value * 2 END AS value FROM events"""),
    Query("stream_lag", _stream_lag,
          "source hour:t rows:i last_at:t lag_hours:r lamp late_rows:i",
          """WITH edge AS (SELECT max(ts) - INTERVAL 48 HOUR AS mark FROM events WHERE event_id % 5 <> 0),
             e AS (SELECT event_type AS source, ts, date_trunc('hour', ts) AS hour,
                 event_id % 5 = 0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark AS late
                 FROM events, edge),
             s AS (SELECT source, count(*) FILTER (WHERE late) AS late_rows,
                 date_sub('second', max(ts), TIMESTAMP '2024-01-31 23:30:00') / 3600 AS lag
                 FROM e GROUP BY 1),
             h AS (SELECT source, hour, count(*) AS rows, max(ts) AS last_at FROM e WHERE NOT late
                 GROUP BY 1, 2)
             SELECT source, hour, rows, last_at,
             date_sub('second', last_at, TIMESTAMP '2024-01-31 23:30:00') / 3600 AS lag_hours,
             CASE WHEN lag >= 48 THEN 'CRIT' WHEN lag >= 24 THEN 'WARN' ELSE 'OK' END AS lamp, late_rows
             FROM h JOIN s USING (source)"""),
]
