"""Exploratory reports over the staging tables and the full sales."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintora.functions import cents, clean_text, has_text, rate, safe_div
from vintora.operators.quantiles import percentiles
from vintora.operators.reconcile import differences
from vintora.operators.relational import duplicates, first_per_key
from vintora.params import ACTIVE_STATES, Terms
from vintora.plans.measures import with_total
from vintora.sources.load import union_all


def key_report(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Can the columns be a primary key? Rows, rows with an empty key part, repeated keys."""
    empty = F.lit(False)
    for k in keys:
        empty = empty | F.col(k).isNull()
    # Counted per key first: the hot key is one partial row per task.
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    out = sizes.agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0))
        .alias("empty_keys"), F.count_if(~empty & (F.col("n") > 1)).alias("repeated_keys"))
    good = (F.col("empty_keys") == 0) & (F.col("repeated_keys") == 0)
    return out.select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key"), "*",
                      F.when(good, "PK").otherwise("index").alias("verdict"))


SHARES = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p9999": 0.9999}


def mutability(lines: DataFrame, payments: DataFrame, mirrors: DataFrame) -> DataFrame:
    """How long after creation rows still change, in days; durations are whole seconds."""
    def seconds(df: DataFrame, measure: str, start: str, end: str) -> DataFrame:
        return df.select(F.lit(measure).alias("measure"), F.timestamp_diff(
            "SECOND", F.col(start), F.col(end)).alias("v"))

    durations = union_all([
        seconds(lines, "order to delivery", "created_at", "delivery_at").filter("v >= 0"),
        seconds(payments, "movement to payment", "movement_at", "paid_at"),
        seconds(mirrors, "movement to update", "movement_at", "updated_at")])
    found = percentiles(durations, "measure", "v", SHARES)
    return found.select("measure", "rows", *[
        F.round(F.col(c) / 86400, 1).alias(c) for c in (*SHARES, "maximum")])


def not_final_by_age(lines: DataFrame, terms: Terms) -> DataFrame:
    """Rows per status, and those older than the window."""
    old = F.to_date("created_at") < F.date_sub(F.lit(terms.as_of), terms.mutable_days)
    return lines.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.to_date("created_at")).alias("oldest"),
        F.max(F.to_date("created_at")).alias("newest"), F.count_if(old).alias("beyond_window"))


def volume_by_year(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.year("created_at").alias("year")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("sales_order_id").alias("orders"))


def window_sizes(lines: DataFrame, terms: Terms, days=(15, 30, 45, 60, 90)) -> DataFrame:
    """Rows inside windows of several lengths, counted in one pass over the table."""
    day = F.to_date("created_at")
    counted = lines.agg(F.count(F.lit(1)).alias("total"), *[
        F.count_if(day >= F.date_sub(F.lit(terms.as_of), n)).alias(f"w{n}") for n in days])
    cells = [F.struct(F.lit(n).alias("days"), F.col(f"w{n}").alias("rows")) for n in days]
    return counted.select("total", F.explode(F.array(*cells)).alias("c")).select(
        "c.days", "c.rows", (F.col("c.rows") * 100 / F.col("total")).alias("pct"))


# -- two sources -----------------------------------------------------------

def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys in both, only left, only right."""
    both = left.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("l", F.lit(1)).join(
        right.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("r", F.lit(1)),
        key, "full")
    return both.agg(
        F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("in_both"),
        F.count_if(F.col("r").isNull()).alias("only_left"),
        F.count_if(F.col("l").isNull()).alias("only_right"))


def agreement(payments: DataFrame, mirrors: DataFrame) -> DataFrame:
    """Share of orders with equal values in both sources, to the cent."""
    m = mirrors.filter(F.col("sales_order_id").isNotNull())
    a = first_per_key(payments.filter(F.col("transaction_id").isNotNull()), ["transaction_id"],
                      [F.col("movement_at"), F.col("total_amount")])
    b = first_per_key(m, ["sales_order_id"], [F.col("mirror_id")])
    fields = ("total_amount", "total_to_pay", "interests")
    both = a.select(F.col("transaction_id").alias("key"), *[
        F.col(f).alias(f"a_{f}") for f in fields]).join(
        b.select(F.col("sales_order_id").alias("key"), *[F.col(f).alias(f"b_{f}") for f in fields]),
        "key")
    same = {f: F.coalesce(cents(f"a_{f}") == cents(f"b_{f}"), F.lit(False))
            for f in fields}
    counted = both.agg(F.count(F.lit(1)).alias("keys"), *[
        F.count_if(same[f]).alias(f) for f in fields])
    cells = [F.struct(F.lit(f).alias("field"), F.col(f).alias("equal")) for f in fields]
    return counted.select("keys", F.explode(F.array(*cells)).alias("c")).select(
        "c.field", "keys", "c.equal", safe_div("c.equal", "keys").alias("share"))


def source_differences(payments: DataFrame, mirrors: DataFrame) -> DataFrame:
    """Orders whose amounts differ between the payments and their mirror, or that only one has."""
    fields = ("total_amount", "total_to_pay")
    a = payments.filter(F.col("transaction_id").isNotNull()).select(
        F.col("transaction_id").alias("order_id"), *[cents(f).alias(f) for f in fields])
    b = mirrors.filter(F.col("sales_order_id").isNotNull()).select(
        F.col("sales_order_id").alias("order_id"), *[cents(f).alias(f) for f in fields])
    return differences(a, b, ["order_id"], list(fields)).withColumn(
        "changed", F.array_join("changed", " "))


def payment_orphans(payments: DataFrame, order_keys: DataFrame) -> DataFrame:
    """Payments whose transaction is no sales order, and how many the order id rescues."""
    known = order_keys.select(F.col("sales_order_id").alias("transaction_id")).distinct()
    lost = payments.join(known, "transaction_id", "left_anti")
    ids = order_keys.select(F.col("order_id").alias("marketplace_order_id")).distinct().withColumn(
        "found", F.lit(1))
    return lost.join(ids, "marketplace_order_id", "left").agg(
        F.count(F.lit(1)).alias("orphans"), F.count_distinct("transaction_id").alias("ids"),
        F.count("found").alias("rescued"), F.count_if(F.col("found").isNull()).alias("lost"))


def orphan_years(payments: DataFrame, order_keys: DataFrame) -> DataFrame:
    known = order_keys.select(F.col("sales_order_id").alias("transaction_id")).distinct()
    return payments.join(known, "transaction_id", "left_anti").groupBy(
        F.year("movement_at").alias("year"), "transaction_status").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("total_amount").alias("amount"))


def amount_hypotheses(payments: DataFrame, terms: Terms) -> DataFrame:
    """Which relation between the amounts holds, and on how many payments with interest."""
    spread = cents(F.col("total_to_pay") - F.col("total_amount"))
    tests = {
        "commission = interest with tax":
            cents("commission_due") == cents(F.col("interests") * terms.tax),
        "spread = commission": spread == cents("commission_due"),
        "spread = interest": spread == cents("interests")}
    base = payments.filter(F.col("interests") > 0)
    counted = base.agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(c).alias(f"t{i}") for i, c in enumerate(tests.values())])
    cells = [F.struct(F.lit(n).alias("hypothesis"), F.col(f"t{i}").alias("hits"))
             for i, n in enumerate(tests)]
    return counted.select("rows", F.explode(F.array(*cells)).alias("c")).select(
        "c.hypothesis", "rows", "c.hits", safe_div("c.hits", "rows").alias("share"))


def revenue_by_year(payments: DataFrame, terms: Terms) -> DataFrame:
    return (payments.filter(F.col("transaction_status") == "paid")
            .groupBy(F.year("movement_at").alias("year")).agg(
            F.count("transaction_id").alias("transactions"),
            F.sum("total_amount").alias("financed"), F.sum("interests").alias("interest"),
            F.sum(F.col("interests") * terms.revenue_share).alias("share_of_interest"),
            F.sum((F.col("total_to_pay") - F.col("total_amount")) * terms.revenue_share)
            .alias("share_of_spread")))


def route_coverage(days: DataFrame, universe: DataFrame) -> DataFrame:
    """Customers of the universe with a known route, and the period it covers."""
    seen = days.filter(F.col("route").isNotNull()).groupBy("customer_id").agg(
        F.min("day").alias("first"), F.max("day").alias("last"), F.count(F.lit(1)).alias("n"))
    return universe.join(seen, "customer_id", "left").agg(
        F.count(F.lit(1)).alias("customers"), F.count("n").alias("with_route"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("route_days"), F.min("first").alias("from_day"),
        F.max("last").alias("to_day"))


def type_profile(df: DataFrame, table: str) -> DataFrame:
    """Declared type of each column, and how many rows fill it."""
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    cells = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                      F.col(f"`{f.name}`").alias("filled")) for f in df.schema.fields]
    return filled.select(F.lit(table).alias("table_name"),
                         F.explode(F.array(*cells)).alias("c")).select("table_name", "c.*")


# -- six closed months -----------------------------------------------------

def closed_window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First day of the six closed months, and of the month that is still open yesterday."""
    end = (as_of - dt.timedelta(days=1)).replace(day=1)
    months = end.year * 12 + end.month - 1 - 6
    return dt.date(months // 12, months % 12 + 1, 1), end


def recent_orders(sales: DataFrame, terms: Terms) -> DataFrame:
    """Orders of the last six closed months; of a repeated order the largest amount stays."""
    start, end = closed_window(terms.as_of)
    rows = (sales.filter((F.col("created_on") >= F.lit(start)) & (F.col("created_on") < F.lit(end))
                         & ((F.col("pieces") != 0) | (F.col("amount") != 0)))
            .groupBy(F.trim("customer_id").alias("customer_id"),
                     F.trim("sales_order_id").alias("sales_order_id"), "created_on")
            .agg(F.sum("amount").alias("amount")).filter(F.col("amount") > terms.min_order_amount))
    return first_per_key(rows, ["customer_id", "sales_order_id"],
                         [-F.col("amount"), F.col("created_on")])


def approved_limits(approvals: DataFrame) -> DataFrame:
    """Largest limit per customer; ids that are not digits are no customers."""
    key = F.trim("customer_id")
    return approvals.filter(key.rlike(r"^\d+$")).groupBy(key.alias("customer_id")).agg(
        F.max("credit_limit").alias("credit_line"))


def proposed_limits(proposals: DataFrame) -> DataFrame:
    key = F.trim("netsuite_id")
    return (proposals.filter(key.rlike(r"^\d+$") & F.col("linea_nueva").isNotNull())
            .groupBy(key.alias("customer_id"))
            .agg(F.max("linea_nueva").alias("credit_line"),
                 F.min("clasificacion").alias("classification")))


def owned_orders(lines: DataFrame) -> DataFrame:
    """Active credit orders; one claimed by several customers goes to the busiest of them."""
    active = lines.filter(F.col("order_status").isin(*ACTIVE_STATES) & has_text("sales_order_id"))
    pairs = active.groupBy(F.trim("customer_id").alias("customer_id"),
                           F.trim("sales_order_id").alias("sales_order_id")).agg(
        F.count(F.lit(1)).alias("_n"))
    busy = pairs.groupBy("customer_id").agg(F.sum("_n").alias("_rows"))
    return first_per_key(pairs.drop("_n").join(busy, "customer_id", "left"), ["sales_order_id"],
                         [-F.col("_rows"), F.col("customer_id")]).drop("_rows")


def active_customers(recent: DataFrame) -> DataFrame:
    return recent.groupBy("customer_id").agg(
        F.count_distinct("sales_order_id").alias("orders"), F.sum("amount").alias("amount"))


def segment_summary(recent: DataFrame, limits: DataFrame, credit_orders: DataFrame) -> DataFrame:
    """Active customers by use of credit, with a total row."""
    users = credit_orders.select("customer_id").distinct().withColumn("uses", F.lit(1))
    tagged = (active_customers(recent).join(users, "customer_id", "left")
              .join(limits.select("customer_id", F.lit(1).alias("enrolled")), "customer_id", "left"))
    segment = (F.when(F.col("uses").isNotNull(), "with use")
               .when(F.col("enrolled").isNotNull(), "enrolled, no use").otherwise("no credit"))
    rows = tagged.groupBy(segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("orders"),
        F.sum("amount").alias("amount"))
    summed = with_total(rows, "segment", "TOTAL").groupBy("segment").agg(
        *[F.sum(c).alias(c) for c in ("customers", "orders", "amount")])
    # Three segments and the total.
    whole = F.max("customers").over(Window.partitionBy())
    return summed.withColumns({"pct_customers": F.col("customers") * 100 / whole,
                               "drop_size": safe_div("amount", "orders")})


def line_against_drop_size(limits: DataFrame, recent: DataFrame) -> DataFrame:
    """Credit line of each enrolled customer beside the recent drop size."""
    if duplicates(limits, ["customer_id"]).take(1):
        raise ValueError("a customer has more than one credit line")
    return limits.join(active_customers(recent), "customer_id", "left").withColumn(
        "drop_size", safe_div("amount", "orders"))


def detail_base(recent: DataFrame, limits: DataFrame, credit_orders: DataFrame) -> DataFrame:
    """Recent orders with credit flags."""
    on_credit = credit_orders.select("sales_order_id").distinct().withColumn("_c", F.lit(1))
    return (recent.join(on_credit, "sales_order_id", "left").join(limits, "customer_id", "left")
            .withColumns({"is_credit_order": F.col("_c").isNotNull().cast("int"),
                          "is_enrolled": F.col("credit_line").isNotNull().cast("int")}).drop("_c"))


def line_histogram(lines: DataFrame, width: int = 1000) -> DataFrame:
    """Customers by credit line, bins closed on the left from zero on."""
    known = lines.filter(F.col("credit_line") >= 0)
    return known.groupBy((F.floor(F.col("credit_line") / width) * width).alias("bin_from")).agg(
        F.count(F.lit(1)).alias("customers"))


def compare_lines(approved: DataFrame, proposed: DataFrame) -> DataFrame:
    """Credit lines of both sources side by side, with where each customer was found."""
    a = approved.select("customer_id", F.col("credit_line").alias("approved_line"),
                        F.lit(1).alias("_a"))
    b = proposed.select("customer_id", F.col("credit_line").alias("proposed_line"),
                        "classification", F.lit(1).alias("_b"))
    return a.join(b, "customer_id", "full").withColumns({
        "difference": F.col("proposed_line") - F.col("approved_line"),
        "origin": F.when(F.col("_a").isNull(), "only proposed")
        .when(F.col("_b").isNull(), "only approved").otherwise("both")}).drop("_a", "_b")


# -- reach and shares ------------------------------------------------------

def reach_share(snapshot: DataFrame, profile_ids: DataFrame) -> DataFrame:
    """Rows and balance of the month ends that a filter through the matured loans reaches."""
    seen = profile_ids.select("sales_order_id").distinct().withColumn("_s", F.lit(1))
    # Orders first: the join then runs on one row per order.
    orders = snapshot.groupBy("sales_order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("balance"))
    hit = F.col("_s").isNotNull()
    return orders.join(seen, "sales_order_id", "left").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("orders"),
        F.count_if(hit).alias("reached_orders"),
        (F.sum(F.when(hit, F.col("n")).otherwise(0)) * 100 / F.sum("n")).alias("pct_rows"),
        F.sum("balance").alias("balance"),
        F.sum(F.when(hit, F.col("balance")).otherwise(0.0)).alias("reached_balance"))


def bucket_share(snapshot: DataFrame) -> DataFrame:
    """Rows and balance per bucket; nine buckets, so the total is a small window."""
    rows = snapshot.groupBy("par").agg(F.count(F.lit(1)).alias("rows"),
                                       F.sum("total_amount").alias("balance"))
    return rows.withColumn(
        "pct_rows", F.col("rows") * 100 / F.sum("rows").over(Window.partitionBy()))


def last_cutoffs(snapshot: DataFrame, n: int = 4) -> DataFrame:
    return snapshot.groupBy("cutoff").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("balance")
    ).orderBy(F.desc("cutoff")).limit(n)


def two_rates(vintage: DataFrame) -> DataFrame:
    """The 30-day rate over live balance and over deployed capital."""
    return vintage.agg(
        F.sum("par30").alias("par30"), F.sum("outstanding_balance").alias("balance"),
        F.sum("deployed_capital").alias("capital"),
        rate(safe_div(F.sum("par30") * 100, F.sum("outstanding_balance"))).alias("pct_of_balance"),
        rate(safe_div(F.sum("par30") * 100, F.sum("deployed_capital"))).alias("pct_of_capital"))


def latest_orphans(payments: DataFrame, order_keys: DataFrame, n: int = 8) -> DataFrame:
    """The newest payments without an order."""
    known = order_keys.select(F.col("sales_order_id").alias("transaction_id")).distinct()
    return (payments.join(known, "transaction_id", "left_anti")
            .orderBy(F.desc_nulls_last("movement_at"), "transaction_id").limit(n)
            .select("transaction_id", "customer_id", "transaction_status", "movement_at",
                    "total_amount"))


def id_quality(df: DataFrame, key: str) -> DataFrame:
    """Blank, non-numeric and clean ids of a table."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(clean_text(key).isNull()).alias("blank"),
                  F.count_if(F.trim(key).rlike(r"^\d+$")).alias("numeric"))
