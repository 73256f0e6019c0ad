"""Plans over all sales of the customers, on credit or not."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintora.functions import has_text, month_start, months_between, safe_div
from vintora.operators.relational import months, tail_from
from vintora.operators.skew import keyed_window
from vintora.params import ACTIVE_STATES, Terms
from vintora.session import checkpoint_dir, freeing_shuffles


def universe(approvals: DataFrame, orders: DataFrame | None) -> DataFrame:
    """Trimmed ids of customers with an order or an approval; approvals alone on a first run."""
    ids = approvals.select(F.trim("customer_id").alias("customer_id"))
    if orders is not None:
        ids = ids.unionByName(orders.select(F.trim("customer_id").alias("customer_id")))
    return ids.filter(has_text("customer_id")).distinct()


def sales_history(sales: DataFrame, members: DataFrame, terms: Terms) -> DataFrame:
    """Customer x sales order in every channel, since a fixed date; empty orders dropped."""
    kept = sales.filter(F.col("sales_order_id").isNotNull()
                        & (F.col("created_on") >= F.lit(terms.history_from)))
    return (kept.join(members, "customer_id", "left_semi")
            .groupBy("customer_id", "sales_order_id")
            .agg(F.min("created_on").alias("created_on"), F.max("channel").alias("channel"),
                 F.max("order_status").alias("order_status"),
                 F.count_distinct("item_id").alias("skus"), F.sum("pieces").alias("pieces"),
                 F.sum("amount").alias("amount"))
            .filter((F.col("pieces") != 0) | (F.col("amount") != 0)))


def order_months(sales: DataFrame) -> DataFrame:
    """Customer x sales order x month, without the empty ones."""
    return (sales.filter(F.col("customer_id").isNotNull() & F.col("sales_order_id").isNotNull())
            .groupBy("customer_id", "sales_order_id", month_start("created_on").alias("month"))
            .agg(F.sum("amount").alias("amount"), F.sum("pieces").alias("pieces"))
            .filter((F.col("pieces") != 0) | (F.col("amount") != 0)))


def first_credit_months(orders: DataFrame) -> DataFrame:
    return (orders.filter(F.col("order_status").isin(*ACTIVE_STATES) & has_text("customer_id"))
            .groupBy(F.trim("customer_id").alias("customer_id"))
            .agg(F.trunc(F.min("created_at"), "month").alias("first_credit")))


def cohort_panel(order_months: DataFrame, first_credit: DataFrame) -> DataFrame:
    """Month x first-purchase cohort x first-credit month, zero-filled, with its period 0.

    Only the customer-month step touches the facts. Its result, at most months^3 rows, is used
    three times, so it is checkpointed. (customer, order, month) is unique, so orders per month
    are a count.
    """
    cohort = ["first_month", "credit_flag", "first_credit"]
    activity = order_months.groupBy("customer_id", "month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("gross"))
    # At most one row per month and customer.
    starts = activity.withColumn(
        "first_month", F.min("month").over(Window.partitionBy("customer_id")))
    tagged = (starts.join(first_credit, "customer_id", "left")
              .withColumn("credit_flag", F.when(F.col("first_credit").isNotNull(), "Y")
                          .otherwise("N")))
    spark = tagged.sparkSession
    checkpoint_dir(spark)
    cells = freeing_shuffles(spark, lambda: tagged.groupBy(*cohort, "month").agg(
        F.count(F.lit(1)).alias("active"), F.sum("orders").alias("orders"),
        F.sum("gross").alias("gross")).checkpoint())
    # Every customer buys in the first month, so cohort sizes are the cells of that month.
    sizes = cells.filter(F.col("month") == F.col("first_month")).select(
        *cohort, F.col("active").alias("cohort_customers"), F.col("orders").alias("orders_base"),
        F.col("gross").alias("gross_base"))
    all_months = cells.agg(F.sort_array(F.collect_set("month"))).scalar()
    panel = sizes.withColumn("month", F.explode(tail_from(all_months, "first_month")))
    right = cells.select(*[F.col(c).alias(f"_{c}") for c in (*cohort, "month")],
                         "active", "orders", "gross")
    on = F.col("month") == F.col("_month")
    for c in cohort:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = panel.join(right, on, "left")
    return joined.select(
        "month", *cohort, months_between("first_month", "month").alias("period"),
        "cohort_customers", F.coalesce("active", F.lit(0)).alias("active"),
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("gross", F.lit(0.0)).alias("gross"), "orders_base", "gross_base")


def month_seasonality(order_months: DataFrame) -> DataFrame:
    """Average ticket and average monthly volume per calendar month: 12 rows.

    Each distinct count has an aggregate of its own, which reduces before it shuffles; two of them in
    one aggregate would copy every row of the facts per count.
    """
    orders = (order_months.select(F.month("month").alias("calendar_month"), "sales_order_id").distinct()
              .groupBy("calendar_month").agg(F.count("sales_order_id").alias("orders")))
    volumes = (order_months.groupBy("customer_id", "month").agg(F.sum("amount").alias("amount"))
               .groupBy(F.month("month").alias("calendar_month"))
               .agg(F.sum("amount").alias("amount"), F.count("customer_id").alias("customer_months")))
    return volumes.join(orders, "calendar_month").select(
        "calendar_month", safe_div("amount", "orders").alias("avg_ticket"),
        safe_div("amount", "customer_months").alias("avg_volume"))


def seasonality_pairs(season: DataFrame) -> DataFrame:
    """Every ordered pair of calendar months. The twelve months fit one array per row."""
    every = season.agg(F.collect_list(F.struct("calendar_month", "avg_ticket", "avg_volume"))
                       .alias("all"))
    pair = (every.withColumn("from", F.explode("all")).withColumn("to", F.explode("all"))
            .filter(F.col("from.calendar_month") != F.col("to.calendar_month")))
    ticket = F.col("to.avg_ticket") / F.col("from.avg_ticket")
    volume = F.col("to.avg_volume") / F.col("from.avg_volume")
    return pair.select(
        F.col("from.calendar_month").alias("from_month"),
        F.col("to.calendar_month").alias("to_month"),
        F.col("from.avg_ticket").alias("from_ticket"), F.col("from.avg_volume").alias("from_volume"),
        F.col("to.avg_ticket").alias("to_ticket"), F.col("to.avg_volume").alias("to_volume"),
        ticket.alias("ticket_ratio"), (ticket - 1).alias("ticket_delta"),
        volume.alias("volume_ratio"), (volume - 1).alias("volume_delta"))


def lifecycle(orders: DataFrame, terms: Terms) -> DataFrame:
    """Customers, sales and orders per month and life-cycle state.

    A customer's months run from the first purchase to the current month, so the activity of
    the five months before is a lag. The window holds one row per customer and month.
    """
    per_order = (orders.filter(F.col("created_at").isNotNull()
                               & F.col("order_status").isin(*ACTIVE_STATES))
                 .groupBy("customer_id", "sales_order_id", month_start("created_at").alias("month"))
                 .agg(F.max("order_gross_sales").alias("amount"))
                 .filter(F.col("amount") > terms.min_order_amount))
    active = per_order.groupBy("customer_id", "month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("gross"))
    spans = active.groupBy("customer_id").agg(F.min("month").alias("first_month"))
    panel = spans.withColumn("month", F.explode(
        months(F.col("first_month"), F.lit(terms.as_of))))
    timeline = Window.partitionBy("customer_id").orderBy("month")
    flags = (panel.join(active, ["customer_id", "month"], "left")
             .withColumn("a0", F.col("orders").isNotNull())
             .withColumns({f"a{k}": F.lag("a0", k, False).over(timeline) for k in range(1, 6)}))
    a0, a1, a2, a3, a4, a5 = (F.col(f"a{k}") for k in range(6))
    old = F.col("first_month") < F.add_months("month", -6)
    # Names of the states.
    state = (F.when(a0 & (F.col("first_month") == F.col("month")), "Nuevo")
             .when(a0 & a1 & a2, "Recurrente")
             .when(a0 & ~a1 & ~a2 & (a3 | a4 | a5 | old), "Reactivado")
             .when(a0 & (a1 != a2), "Intermitente")
             .when(~a0 & (a1 | a2), "Dormant")
             .when(~a0 & (a3 | a4), "Inactivo")
             .when(~a0 & (a5 | old), "Dropped"))
    return (flags.withColumn("state", state).filter(F.col("state").isNotNull())
            .groupBy("month", "state")
            .agg(F.coalesce(F.sum("gross"), F.lit(0.0)).alias("gross_sales"),
                 F.count("customer_id").alias("customers"),
                 F.coalesce(F.sum("orders"), F.lit(0)).alias("orders")))


def pre_post(history: DataFrame, grid: DataFrame, orders: DataFrame, terms: Terms
             ) -> DataFrame:
    """Sales of enrolled customers, split by the exact enrolment date."""
    members = grid.filter(F.col("enrolled_at").isNotNull()).select(
        "customer_id", "enrolled_at", "enrollment_cohort", "route", "supervisor", "office",
        "customer_type")
    on_credit = (orders.filter(F.col("order_status").isin(*ACTIVE_STATES))
                 .select("sales_order_id").distinct().withColumn("on_credit", F.lit(True)))
    base = (history.join(members, "customer_id").join(on_credit, "sales_order_id", "left")
            .withColumns({
                "months": months_between("enrolled_at", "created_on"),
                "is_post": F.col("created_on") >= F.to_date("enrolled_at")}))
    ranked = keyed_window(
        base, ["customer_id"], ["-created_on", "sales_order_id"],
        running={"recency": F.lit(1)},
        overall={"max_month_post": ("max", F.when(F.col("is_post"), F.col("months")))})
    return ranked.select(
        "customer_id", "sales_order_id", "order_status", "created_on", "months",
        F.col("amount").alias("gross_sales"), F.col("amount").alias("final_price"), "skus",
        "pieces", "recency",
        F.when(F.col("is_post"), "post credit").otherwise("prev credit").alias("stage"),
        F.when(F.col("on_credit"), "credit")
        .when(F.col("channel") == terms.field_channel, "pre-sales")
        .otherwise("marketplace").alias("type"),
        "enrolled_at", "enrollment_cohort", "max_month_post", "route", "supervisor", "office",
        "customer_type")


def by_customer_month_channel(sales: DataFrame) -> DataFrame:
    """Customer x month x channel, collapsed to the order first."""
    per_order = (sales.filter(F.col("customer_id").isNotNull())
                 .groupBy("customer_id", "sales_order_id", month_start("created_on").alias("month"),
                          "channel")
                 .agg(F.sum("amount").alias("amount"), F.sum("pieces").alias("pieces"))
                 .filter((F.col("pieces") != 0) | (F.col("amount") != 0)))
    return per_order.groupBy("customer_id", "month", "channel").agg(
        F.count("sales_order_id").alias("orders"), F.sum("amount").alias("gross_sales"),
        F.sum("pieces").alias("pieces"))
