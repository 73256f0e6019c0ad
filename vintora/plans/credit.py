"""Order, loan, month-end and customer tables of the credit book."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintora.functions import (
    age_years, clean_text, coordinate, delinquency_bucket, has_text, last_thursday,
    month_text, month_text_to_date, months_between, penalty, recognised, safe_div, stamp,
    text_to_date, to_monday,
)
from vintora.operators.relational import (
    dates, descending, first_per_key, interval_lookup, islands, unpivot_steps,
)
from vintora.operators.skew import keyed_window
from vintora.params import (
    ACTIVE_STATES, CANCELLED_STATES, KEYWORD_REASONS, PAR30, PAR60, PAR90, Terms,
)

ORDER_GRAIN = ["customer_id", "sales_order_id", "order_id", "order_status", "sales_channel"]


# -- routes ----------------------------------------------------------------

def current_routes(structure: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per customer; gaps of the structure filled from the route catalog."""
    c = catalog.select(F.col("ruta").alias("_route"), "equipo", F.col("oficina").alias("_office"),
                       F.col("region").alias("_region"))
    joined = structure.join(c, F.col("ruta") == F.col("_route"), "left")
    return joined.select(
        F.col("netsuite_id").alias("customer_id"), F.col("ruta").alias("route"),
        F.coalesce("supervisor", "equipo").alias("supervisor"),
        F.coalesce("oficina", "_office").alias("office"),
        F.coalesce("region", "_region").alias("region"),
        F.col("tipo_cliente").alias("customer_type"), "status")


def route_tranches(days: DataFrame) -> DataFrame:
    """Daily routes compressed to runs of the same route."""
    return islands(days, "customer_id", "day", "route",
                   ["supervisor", "office", "region", "customer_type", "status"])


def route_spans(tranches: DataFrame) -> DataFrame:
    """Tranches with the first opened to the past and the last to the future.

    A customer has at most one tranche per day, so the window is bounded by the calendar.
    """
    up = Window.partitionBy("customer_id").orderBy("valid_from")
    down = Window.partitionBy("customer_id").orderBy(F.col("valid_from").desc())
    numbered = tranches.withColumns({"tranche": F.row_number().over(up),
                                     "_last": F.row_number().over(down)})
    return numbered.select(
        "customer_id", "route", "supervisor", "office", "region", "customer_type", "status",
        F.when(F.col("tranche") == 1, F.lit("1900-01-01").cast("date"))
        .otherwise(F.col("valid_from")).alias("valid_from"),
        F.when(F.col("_last") == 1, F.lit("9999-12-31").cast("date"))
        .otherwise(F.col("valid_to")).alias("valid_to"),
        F.col("valid_from").alias("seen_from"), F.col("valid_to").alias("seen_to"),
        "days", "tranche")


# -- orders ----------------------------------------------------------------

def collapse_lines(lines: DataFrame) -> DataFrame:
    """Lines to orders. Order amounts repeat on every line: maximum, never sum.

    The lines are placed by order once; counting distinct products would place them by order and
    product first, and then their counts by order.
    """
    return (valid_lines(lines)
            .withColumn("sales_channel", F.coalesce("sales_channel", F.lit("MARKETPLACE")))
            .select(*ORDER_GRAIN, "created_ms", "created_at", "delivery_at", "order_gross_sales",
                    "total_price", "product_id", "quantity")
            .repartition(*ORDER_GRAIN)
            .groupBy(*ORDER_GRAIN)
            .agg(F.max("created_ms").alias("created_ms"), F.max("created_at").alias("created_at"),
                 F.max("delivery_at").alias("delivery_at"),
                 F.max("order_gross_sales").alias("order_gross_sales"),
                 F.max("total_price").alias("total_price"),
                 F.count_distinct("product_id").alias("skus"),
                 F.sum("quantity").alias("quantity")))


def valid_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(has_text("sales_order_id"))


def order_keys(lines: DataFrame) -> DataFrame:
    return valid_lines(lines).select("sales_order_id", "order_id").distinct()


def due_date(delivery_at, terms: Terms):
    """Credit days after the day of delivery, moved off the weekend."""
    return to_monday(F.date_add(F.to_date(delivery_at), terms.credit_days))


def due_months(orders: DataFrame, terms: Terms) -> DataFrame:
    """Month ends with a due loan, from the delivery dates of the completed orders alone."""
    return orders.filter(F.col("order_status") == "COMPLETED").select(
        F.last_day(due_date("delivery_at", terms)).alias("due_month_end"))


def first_approvals(approvals: DataFrame) -> DataFrame:
    """The first approval of each customer: when the customer entered the product."""
    granted = approvals.filter((F.col("status") == "APPROVED") & F.col("customer_id").isNotNull())
    first = first_per_key(granted, ["customer_id"], [F.col("approved_at"), F.col("approval_id")])
    return first.select("customer_id", F.col("approved_at").alias("enrolled_at"),
                        month_text("approved_at").alias("enrollment_cohort"),
                        F.col("credit_limit").alias("enrolled_limit"),
                        F.col("origin").alias("enrollment_channel"))


def cohort_sizes(enrolled: DataFrame) -> DataFrame:
    return enrolled.groupBy("enrollment_cohort").agg(
        F.count(F.lit(1)).alias("enrolled_customers"),
        F.sum("enrolled_limit").alias("cohort_credit_limit"))


def order_indices(orders: DataFrame) -> DataFrame:
    """Attempt number, completed number and first activation of each customer."""
    order = ["created_at", "sales_order_id", "order_id", "order_status", "sales_channel"]
    done = F.col("order_status") == "COMPLETED"
    active = F.col("order_status").isin(*ACTIVE_STATES)
    indexed = keyed_window(
        orders, ["customer_id"], order,
        running={"attempt_index": F.lit(1), "completed_index": F.when(done, 1)},
        overall={"activated_at": ("min", F.when(active, F.col("created_at")))})
    return indexed.withColumn("completed_index", F.when(done, F.col("completed_index")))


def indexed_orders(lines: DataFrame) -> DataFrame:
    """Orders with their indices and nothing looked up: what a loan is made of."""
    return order_indices(collapse_lines(lines))


def grouped_orders(indexed: DataFrame, approvals: DataFrame, payments: DataFrame,
                   deliveries: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per (customer, sales order, order, status, channel), not per sales order.

    The joins on the customer share one shuffle, the two on the sales order one more.
    """
    enrolled = first_approvals(approvals)
    # One row per month of the product's life.
    sizes = F.broadcast(cohort_sizes(enrolled))
    entry = enrolled.join(sizes, "enrollment_cohort", "left").drop("enrolled_limit")
    routed = interval_lookup(
        indexed.join(entry, "customer_id", "left"), spans, "customer_id", F.to_date("created_at"), "valid_from", "valid_to",
        ["route", "supervisor", "office", "region", "customer_type", "seen_from"])
    limit = (payments.filter(F.col("transaction_id").isNotNull())
             .groupBy(F.col("transaction_id").alias("sales_order_id"))
             .agg(F.max("credit_limit").alias("credit_limit")))
    delivered = deliveries.select("sales_order_id", "delivery_status", "delivered_at")
    return (routed.join(limit, "sales_order_id", "left").join(delivered, "sales_order_id", "left")
            .withColumns({
                "activated_cohort": month_text("activated_at"),
                "months_since_enrollment": months_between("enrolled_at", "created_at"),
                "months_since_activation": months_between("activated_at", "created_at"),
                "created_month": month_text("created_at"),
                # Not knowing the route is the most inferred case of all.
                "route_inferred": F.coalesce(
                    F.to_date("created_at") < F.col("seen_from"), F.lit(True))})
            .drop("seen_from"))


# -- loans -----------------------------------------------------------------

def payment_per_order(payments: DataFrame, order_keys: DataFrame) -> DataFrame:
    """The latest payment of each sales order, found by transaction or else by order id.

    The transaction id of a payment is the sales order itself in the normal case, so it needs no
    lookup: a row whose transaction is no sales order finds no loan later. Only payments outside
    the order keys take the second way, reduced to one per order id before the join.
    """
    latest = [descending("movement_at"), descending("paid_at"), F.col("transaction_id")]
    direct = payments.filter(has_text("transaction_id")).withColumn(
        "sales_order_id", F.col("transaction_id"))
    known = order_keys.select(F.col("sales_order_id").alias("transaction_id"))
    lost = (payments.filter(has_text("marketplace_order_id"))
            .join(known, "transaction_id", "left_anti"))
    rescued = first_per_key(lost, ["marketplace_order_id"], latest).join(
        order_keys.withColumnRenamed("order_id", "marketplace_order_id"), "marketplace_order_id")
    return first_per_key(direct.unionByName(rescued), ["sales_order_id"], latest)


def mirror_per_order(mirrors: DataFrame) -> DataFrame:
    return first_per_key(mirrors.filter(F.col("sales_order_id").isNotNull()), ["sales_order_id"],
                         [descending("updated_at"), F.col("mirror_id")])


LOAN_CORE = (
    "customer_id", "sales_order_id", "order_id", "order_status", "created_at", "delivery_at", "rank",
    "transaction_id", "transaction_status", "total_amount", "total_to_pay", "total_default",
    "interests", "interests_reported", "commission_due", "movement_at", "payment_at", "paid_at",
    "mirror_amount_paid", "mirror_status", "due_on", "due_month_end", "month", "paid_on_month",
    "days_past_due", "days_past_due_month_end", "penalty_interest", "total_revenue", "revenue_share",
    "par")


def loan_core(indexed: DataFrame, payments: DataFrame, mirrors: DataFrame, order_keys: DataFrame,
              terms: Terms) -> DataFrame:
    """The loans by themselves: no route, cohort, limit or delivery is joined to them."""
    return with_loan(indexed, payments, mirrors, order_keys, terms).select(*LOAN_CORE)


def with_loan(orders: DataFrame, payments: DataFrame, mirrors: DataFrame, order_keys: DataFrame,
              terms: Terms) -> DataFrame:
    """Completed orders with due date, days past due, revenue and delinquency bucket."""
    pay = payment_per_order(payments, order_keys)
    mirror = mirror_per_order(mirrors)
    p = pay.select("sales_order_id", "transaction_id", "transaction_status", "commission_due",
                   *[F.col(c).alias(f"p_{c}") for c in
                     ("total_amount", "total_to_pay", "total_default", "interests",
                      "movement_at", "payment_at", "paid_at")])
    m = mirror.select("sales_order_id", F.col("amount_paid").alias("mirror_amount_paid"),
                      F.col("status").alias("mirror_status"),
                      *[F.col(c).alias(f"m_{c}") for c in
                        ("total_amount", "total_to_pay", "interests", "movement_at",
                         "payment_at", "paid_at")])
    base = (orders.filter(F.col("order_status") == "COMPLETED")
            .join(p, "sales_order_id", "left").join(m, "sales_order_id", "left"))
    # The payment report rules; the mirror fills its gaps.
    filled = base.withColumns({
        **{c: F.coalesce(f"p_{c}", f"m_{c}") for c in
           ("total_amount", "total_to_pay", "movement_at", "payment_at", "paid_at")},
        "interests_reported": F.coalesce("p_interests", "m_interests"),
        "total_default": F.coalesce("p_total_default", F.lit(0.0)),
        "transaction_id": F.coalesce("transaction_id", "sales_order_id"),
        "rank": F.col("completed_index")})
    due = filled.withColumn("due_on", due_date("delivery_at", terms))
    due = due.withColumn("due_month_end", F.last_day("due_on"))
    # A payment during the last day of the month counts as late: the limit is its midnight.
    in_month = F.col("paid_at") <= F.col("due_month_end").cast("timestamp_ntz")
    waived = ((F.col("rank") == 1)
              & (F.col("created_at") >= F.lit(terms.waiver_from).cast("timestamp_ntz")))
    gain = F.coalesce("total_to_pay", F.lit(0.0)) - F.coalesce("total_amount", F.lit(0.0))
    days = F.datediff(F.coalesce(F.to_date("paid_at"), F.lit(terms.as_of)), F.col("due_on"))
    return due.withColumns({
        "interests": F.when(F.col("m_interests") == 0, F.lit(0.0)).when(waived, F.lit(0.0))
        .otherwise(F.col("interests_reported")),
        "month": month_text("due_on"),
        "paid_on_month": F.when(in_month, 1).otherwise(0),
        "days_past_due": days,
        "days_past_due_month_end": F.when(in_month, 0).otherwise(
            F.datediff("due_month_end", "due_on")),
        "penalty_interest": penalty(days, terms.weekly_penalty),
        "total_revenue": recognised("paid_at", gain),
        "revenue_share": recognised("paid_at", gain * terms.revenue_share),
        "par": F.when(F.col("paid_at").isNotNull(), "Paid")
        .when(F.col("due_on").cast("timestamp_ntz") >= stamp(terms.now), "Ongoing")
        .otherwise(delinquency_bucket(days))})


def loans(orders: DataFrame, payments: DataFrame, mirrors: DataFrame, order_keys: DataFrame,
          terms: Terms) -> DataFrame:
    """The loans with what is known about their orders."""
    return with_loan(orders, payments, mirrors, order_keys, terms).select(
        "customer_id", "sales_order_id", "order_id", "order_status", "created_at", "delivery_at",
        "order_gross_sales", "quantity", "credit_limit", "enrolled_at", "enrollment_cohort",
        "enrolled_customers", "cohort_credit_limit", "months_since_enrollment", "route",
        "supervisor", "office", "region", "customer_type", "route_inferred", "rank",
        "transaction_id", "transaction_status", "total_amount", "total_to_pay", "total_default",
        "interests", "interests_reported", "commission_due", "movement_at", "payment_at",
        "paid_at", "mirror_amount_paid", "mirror_status", "due_on", "due_month_end", "month",
        "paid_on_month", "days_past_due", "days_past_due_month_end", "penalty_interest",
        "total_revenue", "revenue_share", "par")


# What a row of the snapshot takes from its loan as it is.
_FROM_LOAN = ("customer_id", "sales_order_id", "order_status", "created_at", "delivery_at",
              "order_gross_sales", "quantity", "enrolled_at", "enrollment_cohort",
              "enrolled_customers", "cohort_credit_limit", "transaction_id", "total_to_pay",
              "interests", "total_default", "movement_at", "payment_at", "paid_at", "due_on",
              "due_month_end")
_FROM_LOAN_LAST = ("months_since_enrollment", "rank", "route", "supervisor", "office", "customer_type")
FROM_LOAN = _FROM_LOAN + _FROM_LOAN_LAST
# What it takes from its month end alone.
FROM_CUTOFF = ("cutoff", "previous_month_end", "month")


def snapshot_columns(loans: DataFrame) -> list[Column]:
    """All columns of a loan that the snapshot depends on."""
    return [loans[c] for c in (*_FROM_LOAN, "total_amount", *_FROM_LOAN_LAST)]


def at_month_ends(loans: DataFrame, cutoffs: DataFrame, of_cutoff: dict[str, Column] | None = None,
                  year: int | None = None) -> DataFrame:
    """Each loan at every month end on or after its due date, with its state there; with ``year`` at
    those of one year.

    The month ends are a scalar array (one entry per month with a due loan) that also holds what
    depends on the month end alone: ``of_cutoff``, made of ``FROM_CUTOFF``. Each loan explodes the
    part from its own month end on, so there is no inequality join and no wasted row. Needs of a loan
    its due date and month end, ``paid_at``, ``enrolled_at`` and ``total_amount``.
    """
    found = cutoffs.select(F.col("due_month_end").alias("cutoff")).filter("cutoff IS NOT NULL")
    if year is not None:
        found = found.filter(F.year("cutoff") == year)
        loans = loans.filter(F.col("due_month_end") <= F.make_date(F.lit(year), F.lit(12), F.lit(31)))
    marks = (found.distinct().withColumns({
                 "previous_month_end": F.date_sub(F.trunc("cutoff", "month"), 1),
                 "month": month_text("cutoff"), "_index": _month_index("cutoff")})
             .withColumns(of_cutoff or {}))
    ends = marks.agg(F.sort_array(F.collect_list(F.struct(*marks.columns))).alias("ends")).scalar()
    start = F.array_position(ends["cutoff"], F.col("due_month_end")).cast("int")
    if year is not None:
        # A loan of an earlier year stands at all month ends of this one.
        start = F.greatest(start, F.lit(1))
    opened = (loans.filter(F.col("due_month_end").isNotNull())
              .withColumn("_enrolled", _month_index("enrolled_at"))
              .withColumn("_at", F.explode(F.slice(ends, start, F.size(ends)))))
    opened = opened.select(*[F.col(c) for c in opened.columns if c not in {"_at", *marks.columns}],
                           *[F.col("_at")[c].alias(c) for c in marks.columns])
    settled = F.col("paid_at").isNotNull() & (
        F.col("paid_at") <= F.col("cutoff").cast("timestamp_ntz"))
    earlier = F.col("due_on") <= F.col("previous_month_end")
    late = F.datediff("cutoff", "due_on")
    return opened.withColumns({
        "original_amount": F.col("total_amount"),
        # Settled in an earlier month: no live balance, the capital stays visible.
        "total_amount": F.when(settled & earlier, F.lit(0.0)).otherwise(F.col("total_amount")),
        "days_past_due": F.when(settled, 0).otherwise(late),
        "par": F.when(settled & earlier, "PaidPrev").when(settled, "Paid")
        .otherwise(delinquency_bucket(late)),
        "months_on_book": F.col("_index") - F.col("_enrolled")}).drop("_index", "_enrolled")


def _month_index(d) -> Column:
    return F.year(d) * 12 + F.month(d)


def month_end_snapshot(loans: DataFrame, cutoffs: DataFrame | None = None,
                       of_loan: dict[str, Column] | None = None,
                       of_cutoff: dict[str, Column] | None = None, year: int | None = None) -> DataFrame:
    """Every loan at every month end on or after its due date, or at those of one ``year``. The rows
    of a loan follow each other.

    ``of_loan`` and ``of_cutoff`` are further columns that depend on the loan's own columns or on the
    month end alone; they are made once per loan or month end instead of in every row.
    """
    of_loan, of_cutoff = of_loan or {}, of_cutoff or {}
    opened = at_month_ends(loans.withColumns(of_loan), loans if cutoffs is None else cutoffs, of_cutoff,
                           year)
    return opened.select(
        *_FROM_LOAN, "cutoff", "previous_month_end", "original_amount", "total_amount",
        "days_past_due", "par", "months_on_book", "month", *_FROM_LOAN_LAST, *of_loan, *of_cutoff)


def vintage(snapshot: DataFrame, terms: Terms) -> DataFrame:
    """Cohort x months on book, closed month ends only.

    Customers are counted by first reducing to one row per cohort, month and customer; five
    distinct counts in one aggregate would copy every row five times.
    """
    keys = ["enrollment_cohort", "months_on_book"]
    closed = snapshot.filter(F.col("cutoff") < F.lit(terms.as_of))
    marks = {"30": PAR30, "60": PAR60, "90": PAR90}
    per_customer = closed.groupBy(*keys, "customer_id").agg(
        F.max("enrolled_customers").alias("enrolled_customers"),
        F.count(F.lit(1)).alias("n"), F.sum("original_amount").alias("deployed"),
        F.sum("total_amount").alias("balance"),
        *[F.sum(F.when(F.col("par").isin(*names), F.col("total_amount"))).alias(f"amount{d}")
          for d, names in marks.items()],
        *[F.max(F.col("par").isin(*names).cast("int")).alias(f"late{d}")
          for d, names in marks.items()])
    cells = per_customer.groupBy(*keys).agg(
        F.count("customer_id").alias("ever_activated"),
        F.max("enrolled_customers").alias("enrolled_customers"), F.sum("n").alias("orders"),
        F.sum("deployed").alias("deployed_capital"), F.sum("balance").alias("outstanding_balance"),
        *[F.sum(f"amount{d}").alias(f"_par{d}") for d in marks],
        *[F.sum(F.when(F.col("customer_id").isNotNull(), F.col(f"late{d}"))).alias(f"_par{d}_n")
          for d in marks])
    return _vintage_rates(cells)


def loan_vintage(loans: DataFrame, cutoffs: DataFrame, terms: Terms) -> DataFrame:
    """``vintage`` of the loans' snapshot, made of groups of loans that are alike at every month end.

    What a loan adds to a cell depends on its cohort, its due date and the month end from which it is
    settled, so amounts are added up per such group first. Customers are counted from their earliest
    due month on, and as late from their loans that were open at a month end, one row per cell and
    customer. The three kinds of groups come from one pass over the loans, and only they are opened
    at month ends: far fewer rows than loans times months. A cohort is the month of enrolment.
    """
    paid_on = F.to_date("paid_at")
    # The first month end at whose midnight the payment has arrived.
    settled_end = F.last_day(F.when(F.col("paid_at") <= paid_on.cast("timestamp_ntz"), paid_on)
                             .otherwise(F.date_add(paid_on, 1)))
    due = loans.filter(F.col("due_month_end").isNotNull()).select(
        "customer_id", "enrollment_cohort", F.trunc("enrolled_at", "month").alias("enrolled_at"),
        "enrolled_customers", "total_amount", "due_on", settled_end.alias("settled_end"))
    named = F.col("customer_id").isNotNull()
    was_open = F.col("settled_end").isNull() | (F.col("settled_end") > F.last_day("due_on"))
    nobody, never = F.lit(None).cast("string"), F.lit(None).cast("date")
    groups = unpivot_steps(due, [
        (F.lit("amount"), nobody, F.col("due_on"), F.col("settled_end"), F.lit(True)),
        (F.lit("active"), F.col("customer_id"), never, never, named),
        (F.lit("late"), F.col("customer_id"), F.col("due_on"), F.col("settled_end"),
         named & was_open)], ("kind", "who", "due_key", "settled_key", "counts")).filter(
        "counts").groupBy(
        "kind", "who", "enrollment_cohort", "enrolled_at", "due_key", "settled_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("total_amount"),
        F.max("enrolled_customers").alias("enrolled_customers"), F.min("due_on").alias("due_on"))
    opened = at_month_ends(groups.withColumns({
        "due_month_end": F.last_day("due_on"), "paid_at": F.col("settled_key").cast("timestamp_ntz")
    }), cutoffs).filter(F.col("cutoff") < F.lit(terms.as_of))
    keys = ["enrollment_cohort", "months_on_book"]
    marks = {"30": PAR30, "60": PAR60, "90": PAR90}
    amount, active = F.col("kind") == "amount", F.col("kind") == "active"
    # All month ends of a customer without enrolment are one cell: one row of it is enough.
    first = F.col("months_on_book").isNotNull() | (F.col("cutoff") == F.col("due_month_end"))
    kept = opened.filter(amount | (active & first)
                         | ((F.col("kind") == "late") & F.col("par").isin(*PAR30)))
    per_customer = kept.groupBy(*keys, "kind", F.when(~active, F.col("who")).alias("who")).agg(
        F.max("enrolled_customers").alias("enrolled_customers"), F.count(F.lit(1)).alias("rows"),
        F.sum("n").alias("n"), F.sum("original_amount").alias("deployed"),
        F.sum("total_amount").alias("balance"),
        *[F.sum(F.when(F.col("par").isin(*names), F.col("total_amount"))).alias(f"amount{d}")
          for d, names in marks.items()],
        *[F.max(F.col("par").isin(*names).cast("int")).alias(f"late{d}")
          for d, names in marks.items()])
    cells = per_customer.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(active, F.col("rows"))), F.lit(0)).alias("ever_activated"),
        F.max("enrolled_customers").alias("enrolled_customers"),
        F.sum(F.when(amount, F.col("n"))).alias("orders"),
        F.sum(F.when(amount, F.col("deployed"))).alias("deployed_capital"),
        F.sum(F.when(amount, F.col("balance"))).alias("outstanding_balance"),
        *[F.sum(F.when(amount, F.col(f"amount{d}"))).alias(f"_par{d}") for d in marks],
        *[F.sum(F.when(F.col("kind") == "late", F.col(f"late{d}"))).alias(f"_par{d}_n")
          for d in marks])
    return _vintage_rates(cells)


def _vintage_rates(cells: DataFrame) -> DataFrame:
    marks = ("30", "60", "90")
    # The delinquent part joins on equality, so a cell without cohort has none.
    known = F.col("enrollment_cohort").isNotNull() & F.col("months_on_book").isNotNull()
    zeroed = cells.withColumns({
        **{f"par{d}": F.when(known, F.coalesce(f"_par{d}", F.lit(0.0))).otherwise(0.0)
           for d in marks},
        **{f"par{d}_n": F.when(known, F.coalesce(f"_par{d}_n", F.lit(0))).otherwise(F.lit(0))
           for d in marks}})
    start = month_text_to_date("enrollment_cohort")
    return zeroed.select(
        "enrollment_cohort", F.substring("enrollment_cohort", 1, 4).alias("cohort_year"),
        "months_on_book", month_text(F.add_months(start, F.col("months_on_book"))).alias("label"),
        "ever_activated", "enrolled_customers", "orders", "deployed_capital",
        "outstanding_balance", *[f"par{d}" for d in marks], *[f"par{d}_n" for d in marks],
        *[F.when(F.col("outstanding_balance") > 0,
                 F.col(f"par{d}") / F.col("outstanding_balance")).alias(f"par{d}_rate")
          for d in marks],
        *[F.when(F.col("ever_activated") > 0,
                 F.col(f"par{d}_n") / F.col("ever_activated")).alias(f"par{d}_customers_rate")
          for d in marks])


def revenue(loans: DataFrame, terms: Terms) -> DataFrame:
    """Income per order, with both commission definitions side by side."""
    gain = F.coalesce("total_to_pay", F.lit(0.0)) - F.coalesce("total_amount", F.lit(0.0))
    return loans.select(
        "customer_id", "sales_order_id", "transaction_id", "created_at", "delivery_at", "due_on",
        "paid_at", "movement_at", month_text(F.coalesce(
            "paid_at", F.col("due_on").cast("timestamp_ntz"))).alias("month"),
        "transaction_status", "par", "enrollment_cohort",
        F.col("total_amount").alias("financed"), F.col("total_to_pay").alias("to_pay"),
        "interests", "interests_reported", "commission_due", gain.alias("spread"),
        "penalty_interest", "total_default",
        F.col("paid_at").isNotNull().cast("int").alias("collected"), "total_revenue",
        "revenue_share",
        recognised("paid_at", F.coalesce("interests_reported", F.lit(0.0)) * terms.revenue_share)
        .alias("revenue_share_untaxed"),
        recognised("paid_at", F.coalesce("total_amount", F.lit(0.0)) * terms.amount_commission)
        .alias("amount_commission"))


# -- customers -------------------------------------------------------------

def order_use(orders: DataFrame, terms: Terms) -> DataFrame:
    """Order counts and amounts per customer, all statuses in one pass."""
    status = F.col("order_status")
    active = status.isin(*ACTIVE_STATES)
    done = status == "COMPLETED"
    due = F.col("delivery_at") + F.expr(f"INTERVAL {terms.credit_days} DAYS") <= stamp(terms.now)
    gross = F.col("order_gross_sales")
    return orders.groupBy("customer_id").agg(
        F.min(F.when(active, F.col("created_at"))).alias("first_order_at"),
        F.max(F.when(active, F.col("created_at"))).alias("last_order_at"),
        F.count_if(active).alias("orders_count"),
        F.avg(F.when(active, gross)).alias("avg_order_volume"),
        F.sum(F.when(active, gross)).alias("total_order_volume"),
        F.sum(F.when(active & (F.col("attempt_index") == 1), gross)).alias("first_order_gross"),
        F.count_if(done).alias("completed_orders"),
        F.sum(F.when(done, gross)).alias("completed_volume"),
        F.count_if(done & due).alias("due_orders"),
        F.count_if(status == "REJECTED").alias("rejected_orders"),
        F.count_if(status.isin(*CANCELLED_STATES)).alias("cancelled_orders"))


def customer_grid(customers: DataFrame, requests: DataFrame, routes: DataFrame,
                  pre_approvals: DataFrame, limits: DataFrame, approvals: DataFrame,
                  orders: DataFrame, payments: DataFrame, terms: Terms) -> DataFrame:
    """One row per customer: the whole funnel from eligible to active."""
    c = customers.filter(F.col("netsuiteId").isNotNull()).select(
        F.col("netsuiteId").alias("customer_id"), F.col("customerId").alias("document_id"),
        F.col("shopkeeperId").alias("shopkeeper_id"), F.col("shopName").alias("shop_name"),
        "business_category", F.col("address_neighborhood").alias("shop_neighborhood"),
        F.col("address_zipCode").alias("shop_zip"), F.col("address_town").alias("shop_town"),
        F.col("address_state").alias("shop_state"),
        coordinate("address_latitude", 90).alias("shop_latitude"),
        coordinate("address_longitude", 180).alias("shop_longitude"),
        F.col("gender").alias("_gender"), F.col("phoneNumber").alias("phone"),
        F.col("hasMarketplace").alias("has_marketplace"),
        F.col("hasPresales").alias("has_presales"))
    r = requests.select(
        F.col("customerId").alias("document_id"), F.col("name").alias("customer_name"),
        F.col("lastNames").alias("customer_last_names"), F.col("gender").alias("_asked_gender"),
        text_to_date("birthdate").alias("birthdate"),
        coordinate("latitude", 90).alias("customer_latitude"),
        coordinate("longitude", 180).alias("customer_longitude"))
    eligible = first_per_key(pre_approvals.filter(F.col("customer_id").isNotNull()),
                             ["customer_id"], [F.col("eligible_at"), F.col("pre_approval_id")]
                             ).drop("pre_approval_id")
    line = first_per_key(limits.filter(F.col("customer_id").isNotNull()), ["customer_id"],
                         [-F.col("updated_ms"), F.col("document_id")]
                         ).drop("updated_ms", "document_id")
    enrolled = first_approvals(approvals).withColumnRenamed("enrolled_limit", "credit_limit")
    paid = (payments.filter(F.col("transaction_status") == "paid").groupBy("customer_id").agg(
        F.count("transaction_id").alias("payments_count"),
        F.avg("interests").alias("avg_revenue"), F.sum("interests").alias("revenue")))
    route = routes.withColumnRenamed("status", "structure_status")
    wide = c.join(r, "document_id", "left")
    for side in (route, eligible, line, enrolled, order_use(orders, terms), paid):
        wide = wide.join(side, "customer_id", "left")
    on = F.col("first_order_at").isNotNull()
    zero = {n: F.coalesce(n, F.lit(0)) for n in (
        "orders_count", "completed_orders", "rejected_orders", "cancelled_orders", "due_orders",
        "payments_count")}
    zero |= {n: F.coalesce(n, F.lit(0.0)) for n in (
        "total_order_volume", "completed_volume", "first_order_gross", "revenue")}
    last_day, first_day = F.to_date("last_order_at"), F.to_date("first_order_at")
    return wide.withColumns({
        "gender": F.coalesce(F.nullif("_asked_gender", F.lit("NOT_DEFINED")),
                             F.nullif("_gender", F.lit("NOT_DEFINED"))),
        "age": age_years("birthdate", F.lit(terms.as_of)),
        "age_at_eligibility": age_years("birthdate", F.to_date("eligible_at")),
        "age_at_enrollment": age_years("birthdate", F.to_date("enrolled_at")),
        "is_enrolled": F.col("enrolled_at").isNotNull().cast("int"),
        "activated_at": F.col("first_order_at"),
        "is_activated": on.cast("int"),
        "activated_cohort": month_text("first_order_at"),
        "activated_limit": F.when(on, F.col("original_limit")).otherwise(0.0),
        "order_frequency": F.when(F.col("orders_count") > 0,
                                  F.datediff(last_day, first_day) / F.col("orders_count")),
        "avg_revenue_share": F.col("avg_revenue") * terms.revenue_share,
        "revenue_share": F.coalesce(F.col("revenue") * terms.revenue_share, F.lit(0.0)),
        "is_active": F.coalesce(
            F.datediff(F.lit(terms.as_of), last_day) <= terms.inactive_days, F.lit(False)
        ).cast("int"),
        **zero}).drop("_gender", "_asked_gender")


def members(customers: DataFrame, approvals: DataFrame, routes: DataFrame) -> DataFrame:
    """Enrolment and current route of every customer: the narrow part of the customer grid."""
    ids = customers.filter(F.col("netsuiteId").isNotNull()).select(
        F.col("netsuiteId").alias("customer_id"))
    return (ids.join(first_approvals(approvals), "customer_id", "left")
            .join(routes.drop("status"), "customer_id", "left"))


def unique_grid(grid: DataFrame) -> DataFrame:
    """One row per trimmed numeric customer id: the enrolled, busier, unpadded twin wins."""
    keyed = grid.withColumn("customer_key", clean_text("customer_id").try_cast("bigint")).filter(
        clean_text("customer_id").isNotNull())
    return first_per_key(keyed, ["customer_key"], [
        -F.col("is_enrolled"), -F.col("orders_count"),
        F.col("customer_id") != F.trim("customer_id"), F.col("document_id")])


# -- daily and weekly ------------------------------------------------------

DAILY_COUNTS = (
    "created_orders", "completed_by_created", "completed_by_delivered", "expected_deliveries",
    "rejected_orders", "keyword_rejections", "payments", "enrollments", "activations")
DAILY_AMOUNTS = (
    "completed_volume_by_created", "completed_volume_by_delivered", "payments_volume",
    "interest_collected", "revenue_share")


def daily_kpis(orders: DataFrame, deliveries: DataFrame, loans: DataFrame, approvals: DataFrame,
               customers: DataFrame, terms: Terms) -> DataFrame:
    """One row per day without gaps, with running totals and cumulative ratios.

    Each source is reduced to days first; the daily rows are then added up in one aggregate.
    Orders count by day of creation and by day of delivery from one pass.
    """
    done = F.col("delivery_status") == "COMPLETED"
    failed = F.col("delivery_status") == "REJECTED"
    # Only customers of the customer table count as activated.
    activated = (orders.filter(F.col("order_status").isin(*ACTIVE_STATES))
                 .groupBy("customer_id").agg(F.min("created_at").alias("at"))
                 .join(customers.select(F.col("netsuiteId").alias("customer_id")), "customer_id"))
    marks = unpivot_steps(
        orders.select("created_at", "delivered_at", "sales_order_id", "order_gross_sales",
                      done.alias("done")),
        [(F.to_date("created_at"), F.lit(True)), (F.to_date("delivered_at"), F.lit(False))],
        ("date", "by_creation"))
    created, gross = F.col("by_creation"), F.col("order_gross_sales")
    daily = [
        marks.groupBy("date").agg(
            F.count(F.when(created, F.col("sales_order_id"))).alias("created_orders"),
            F.count_if(created & F.col("done")).alias("completed_by_created"),
            F.sum(F.when(created & F.col("done"), gross)).alias("completed_volume_by_created"),
            F.count_if(~created & F.col("done")).alias("completed_by_delivered"),
            F.sum(F.when(~created & F.col("done"), gross)).alias("completed_volume_by_delivered"),
            F.max(created).alias("has_order")),
        deliveries.groupBy(F.to_date("delivered_at").alias("date")).agg(
            F.count_if(done | failed).alias("expected_deliveries"),
            F.count_if(failed).alias("rejected_orders"),
            F.count_if(failed & F.col("reason").isin(*KEYWORD_REASONS)).alias("keyword_rejections")),
        loans.groupBy(F.to_date("paid_at").alias("date")).agg(
            F.count(F.lit(1)).alias("payments"), F.sum("total_amount").alias("payments_volume"),
            F.sum("total_revenue").alias("interest_collected"),
            F.sum("revenue_share").alias("revenue_share")),
        approvals.filter(F.col("status") == "APPROVED").groupBy(
            F.to_date("approved_at").alias("date")).agg(F.count(F.lit(1)).alias("enrollments")),
        activated.groupBy(F.to_date("at").alias("date")).agg(
            F.count(F.lit(1)).alias("activations")),
    ]
    rows = daily[0]
    for part in daily[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    found = rows.filter(F.col("date").isNotNull()).groupBy("date").agg(
        F.max("has_order").alias("has_order"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in DAILY_COUNTS],
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in DAILY_AMOUNTS])
    # From here on one row per calendar day: single-partition windows are bounded.
    whole, in_order = Window.partitionBy(), Window.orderBy("date")
    last = F.lit(terms.as_of)
    ranged = (found.withColumn("first", F.min(F.when(F.col("has_order"), F.col("date"))).over(whole))
              .filter((F.col("date") >= F.col("first")) & (F.col("date") <= last)))
    # Each day also stands for the empty days up to the next one.
    until = F.coalesce(F.date_sub(F.lead("date").over(in_order), 1), last)
    filled = ranged.withColumn("until", until).withColumn(
        "day", F.explode(dates(F.col("date"), F.col("until"))))
    own = F.col("day") == F.col("date")
    days = filled.select(
        F.col("day").alias("date"),
        *[F.when(own, F.col(c)).otherwise(0).alias(c) for c in DAILY_COUNTS],
        *[F.when(own, F.col(c)).otherwise(0.0).alias(c) for c in DAILY_AMOUNTS])
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    totals = ("created_orders", "completed_by_created", "completed_by_delivered",
              "completed_volume_by_created", "completed_volume_by_delivered",
              "expected_deliveries", "rejected_orders", "keyword_rejections", "revenue_share")
    day = F.col("date")
    out = days.withColumns({
        "week_start": F.trunc(day, "week"), "week_end": F.date_add(F.trunc(day, "week"), 6),
        "month_end": F.last_day(day), "year_end": F.make_date(F.year(day), F.lit(12), F.lit(31)),
        **{f"cumulative_{c}": F.sum(c).over(so_far) for c in totals}})
    return out.withColumns({
        "rejected_rate": safe_div("rejected_orders", "expected_deliveries"),
        "keyword_rate": safe_div("keyword_rejections", "expected_deliveries"),
        "cumulative_rejected_rate": safe_div(
            "cumulative_rejected_orders", "cumulative_expected_deliveries"),
        "cumulative_keyword_rate": safe_div(
            "cumulative_keyword_rejections", "cumulative_expected_deliveries")})


def weekly_lines(lines: DataFrame, routes: DataFrame, terms: Terms) -> DataFrame:
    """Lines of the weekly cut, with the route that serves the customer today."""
    anchor = last_thursday(F.lit(terms.as_of))
    start = F.date_sub(anchor, terms.cut_days)
    recent = lines.filter(has_text("sales_order_id") & (F.to_date("created_at") >= start))
    return (recent.join(routes.drop("status"), "customer_id", "left")
            .withColumns({"cut_on": anchor, "window_from": start,
                          "sales_channel": F.coalesce("sales_channel", F.lit("MARKETPLACE"))}))


def weekly_orders(cut_lines: DataFrame) -> DataFrame:
    return cut_lines.groupBy(
        "cut_on", "window_from", "customer_id", "route", "supervisor", "office", "region",
        "customer_type", "sales_order_id", "order_id", "order_status", "sales_channel").agg(
        F.max("created_at").alias("created_at"), F.max("delivery_at").alias("delivery_at"),
        F.max("order_gross_sales").alias("order_gross_sales"),
        F.max("total_price").alias("total_price"),
        F.count_distinct("product_id").alias("skus"), F.sum("quantity").alias("quantity"))
