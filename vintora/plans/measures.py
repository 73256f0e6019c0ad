"""Measures over the published tables. Cells are aggregated first, margins on top of them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintora.functions import (
    age_band, loan_index_label, month_start, month_text, months_between, safe_div,
)
from vintora.operators.distinct import bitmap_cells, dense_numbers, margins
from vintora.operators.relational import dates, months, unpivot_steps
from vintora.params import (
    BUCKET_ORDER, FUNNEL_STEPS, LEAD_STAGE_ORDER, STAGE_ORDER, STAGE_STEPS, Terms,
)


def ordinal(c, table) -> Column:
    """Display order of a bucket or stage name."""
    out = F.when(F.col(c) == table[0][0], table[0][1])
    for name, position in table[1:]:
        out = out.when(F.col(c) == name, position)
    return out


def with_total(cells: DataFrame, column: str, label: str) -> DataFrame:
    """Every cell twice, under its own member and under the total member.

    The margin is then one more group of the same aggregate, and the cells are computed once.
    """
    return cells.withColumn(column, F.explode(F.array(F.col(column), F.lit(label))))


# -- orders ----------------------------------------------------------------

def enrolled_by_cohort(people: DataFrame) -> DataFrame:
    """Enrolled customers per cohort month."""
    return people.filter(F.col("enrolled_at").isNotNull()).groupBy("enrollment_cohort").agg(
        F.count_distinct("customer_id").alias("enrolled"))


def survival(orders: DataFrame, people: DataFrame) -> DataFrame:
    """Active over enrolled customers by cohort, months since enrolment and delivery status."""
    cells = (orders.filter(F.col("enrollment_cohort").isNotNull())
             .groupBy("enrollment_cohort", "months_since_enrollment", "delivery_status")
             .agg(F.count_distinct("customer_id").alias("active")))
    sized = cells.join(F.broadcast(enrolled_by_cohort(people)), "enrollment_cohort", "left")
    return sized.withColumn("survival", safe_div("active", "enrolled"))


def active_margins(orders: DataFrame) -> DataFrame:
    """Active customers by cohort, months since enrolment and delivery status, and by every margin of
    the three that is published, all from one set of cells."""
    cells = ["enrollment_cohort", "months_since_enrollment", "delivery_status"]
    known = orders.filter(F.col("enrollment_cohort").isNotNull())
    # Customers of a cohort are numbered next to each other.
    numbers = dense_numbers(known, "customer_id", ["enrollment_cohort"])
    seen = known.select("customer_id", *cells).distinct().join(numbers, "customer_id")
    # At most as many rows as cells times buckets; read once per level.
    bitmaps = bitmap_cells(seen, cells, "number").persist()
    cohort, month, status = cells
    return margins(bitmaps, cells, {
        "cell": cells, "cohort and month": [cohort, month], "cohort and status": [cohort, status],
        "cohort": [cohort], "month": [month], "status": [status], "total": []})


def weighted_survival(orders: DataFrame, people: DataFrame) -> DataFrame:
    """Survival per cohort and month, with a member that weights cohorts by their size."""
    cells = (orders.filter(F.col("enrollment_cohort").isNotNull())
             .groupBy("enrollment_cohort", "months_since_enrollment")
             .agg(F.count_distinct("customer_id").alias("active"))
             .join(F.broadcast(enrolled_by_cohort(people)), "enrollment_cohort", "left")
             .withColumn("survival", safe_div("active", "enrolled")))
    return with_total(cells, "enrollment_cohort", "WAVG").groupBy(
        "enrollment_cohort", "months_since_enrollment").agg(
        F.sum("active").alias("active"), F.sum("enrolled").alias("enrolled"),
        safe_div(F.sum(F.col("survival") * F.col("enrolled")), F.sum("enrolled"))
        .alias("survival"))


def cohort_frequency(orders: DataFrame) -> DataFrame:
    """Orders per customer and amount per order by cohort, and over all cohorts."""
    cells = (orders.filter(F.col("enrollment_cohort").isNotNull()).groupBy("enrollment_cohort")
             .agg(F.count_distinct("sales_order_id").alias("orders"),
                  F.count_distinct("customer_id").alias("customers"),
                  F.sum("total_price").alias("amount")))
    summed = with_total(cells, "enrollment_cohort", "WAVG").groupBy("enrollment_cohort").agg(
        *[F.sum(c).alias(c) for c in ("orders", "customers", "amount")])
    return summed.withColumns({
        "frequency": safe_div("orders", "customers"), "drop_size": safe_div("amount", "orders")})


def order_basics(orders: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Average ticket, items and orders per customer, and use of the credit line."""
    amount = F.sum("order_gross_sales")
    base = orders.groupBy(*(by or [])).agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("sales_order_id").alias("orders"),
        F.count("customer_id").alias("transactions"), amount.alias("gross_sales"),
        F.sum("credit_limit").alias("_limit"), F.sum("skus").alias("_skus"),
        F.sum("quantity").alias("_items"), F.count("sales_order_id").alias("_rows"))
    return base.withColumns({
        "avg_ticket": safe_div("gross_sales", "orders"), "avg_skus": safe_div("_skus", "orders"),
        "avg_items": safe_div("_items", "orders"), "frequency": safe_div("_rows", "customers"),
        "avg_monthly_sale": safe_div("gross_sales", "customers"),
        "limit_penetration": safe_div("gross_sales", "_limit")}
    ).drop("_limit", "_skus", "_items", "_rows")


def margin_average(orders: DataFrame) -> DataFrame:
    """Cohort x month cells, with the average of the cells at each margin and in total."""
    cell_keys = ["enrollment_cohort", "months_since_enrollment"]
    values = ["active", "transactions", "gross_sales", "orders_per_customer", "gross_per_customer"]
    cells = orders.groupBy(*cell_keys).agg(
        F.count_distinct("customer_id").alias("active"),
        F.count("customer_id").alias("transactions"),
        F.sum("order_gross_sales").alias("gross_sales"),
        safe_div(F.count("sales_order_id"), F.count_distinct("customer_id"))
        .alias("orders_per_customer"),
        safe_div(F.sum("order_gross_sales"), F.count_distinct("customer_id"))
        .alias("gross_per_customer"))
    cohort, month = (F.col(k) for k in cell_keys)
    no_cohort, no_month = F.lit(None).cast("string"), F.lit(None).cast("int")
    levels = [("cell", cohort, month), ("cohort", cohort, no_month),
              ("month", no_cohort, month), ("total", no_cohort, no_month)]
    spread = unpivot_steps(cells.withColumnsRenamed({k: f"_{k}" for k in cell_keys}), [
        (F.lit(level), F.col(f"_{cell_keys[0]}") if a is cohort else a,
         F.col(f"_{cell_keys[1]}") if b is month else b) for level, a, b in levels],
        ("level", *cell_keys))
    return spread.groupBy("level", *cell_keys).agg(*[F.avg(v).alias(v) for v in values])


def cumulative_enrolled(people: DataFrame) -> DataFrame:
    """Customers enrolled up to each enrolment day. The window holds one row per day."""
    per_day = (people.filter(F.col("enrolled_at").isNotNull())
               .groupBy(F.to_date("enrolled_at").alias("day"))
               .agg(F.count_distinct("customer_id").alias("enrolled")))
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.withColumn("cumulative_enrolled", F.sum("enrolled").over(so_far))


def active_over_enrolled(orders: DataFrame, people: DataFrame) -> DataFrame:
    """Active customers of a month over those enrolled up to its last order day."""
    blank = F.col("created_at").isNull() & (F.col("delivery_status") == "COMPLETED")
    marks = orders.filter(~F.coalesce(blank, F.lit(False))).groupBy(
        F.col("created_month").alias("month")).agg(
        F.count_distinct("customer_id").alias("active"),
        F.max(F.to_date("created_at")).alias("day"))
    steps = cumulative_enrolled(people).select("day", "enrolled").unionByName(
        marks, allowMissingColumns=True)
    # Enrolment days and one mark per month: bounded by the calendar. Days come before marks.
    so_far = Window.orderBy("day", F.col("month").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0)
    return (steps.withColumn("cumulative_enrolled", F.coalesce(
        F.sum("enrolled").over(so_far), F.lit(0)))
        .filter(F.col("active").isNotNull())
        .select("month", "active", "cumulative_enrolled",
                safe_div("active", "cumulative_enrolled").alias("active_rate")))


def customer_months(orders: DataFrame, terms: Terms) -> DataFrame:
    """Every customer and month since the first order, with the amount bought or zero."""
    bought = orders.filter(F.col("created_at").isNotNull()).groupBy(
        "customer_id", month_start("created_at").alias("month")).agg(
        F.sum("order_gross_sales").alias("amount"))
    spine = (bought.groupBy("customer_id").agg(F.min("month").alias("first"))
             .select("customer_id", F.explode(months(F.col("first"), F.lit(terms.as_of)))
                     .alias("month")))
    return spine.join(bought, ["customer_id", "month"], "left").withColumn(
        "amount", F.coalesce("amount", F.lit(0.0)))


def monthly_histogram(orders: DataFrame, width: int = 1000, bins: int = 12) -> DataFrame:
    """Customer-months by sales volume in left-closed bins; the last one includes its edge.

    The percentage is over all customer-months, also those beyond the last bin.
    """
    volume = orders.groupBy("customer_id", "created_month").agg(
        F.sum("order_gross_sales").alias("volume"))
    top = width * bins
    slot = F.when(F.col("volume") == top, bins - 1).when(
        (F.col("volume") >= 0) & (F.col("volume") < top), F.floor(F.col("volume") / width))
    counted = volume.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("customer_months"))
    # At most bins + 1 rows.
    whole = F.sum("customer_months").over(Window.partitionBy())
    return (counted.withColumn("pct", F.col("customer_months") / whole * 100)
            .filter(F.col("bin").isNotNull())
            .select((F.col("bin") * width).alias("bin_from"), "customer_months", "pct"))


def order_search(grid: DataFrame, orders: DataFrame, text: str) -> DataFrame:
    """Orders of the customers whose phone or id contains a text."""
    hit = grid.filter(F.col("phone").contains(text) | F.col("customer_id").contains(text))
    return orders.join(hit.select("customer_id", "shop_name", "phone"), "customer_id")


def top_inactive(grid: DataFrame, n: int = 100) -> DataFrame:
    """The inactive customers with the most volume; ties with the last one stay in.

    The cut-off value comes from a top-n, which keeps n rows per task; no global window.
    """
    idle = grid.filter(F.col("is_active") == 0)
    edge = (idle.select("total_order_volume").orderBy(F.desc("total_order_volume")).limit(n)
            .agg(F.min("total_order_volume")).scalar())
    return idle.filter(F.col("total_order_volume") >= edge)


# -- loans -----------------------------------------------------------------

def revenue_by_month(loans: DataFrame, terms: Terms) -> DataFrame:
    return loans.groupBy("month").agg(
        F.sum("revenue_share").alias("share_before_tax"),
        (F.sum("revenue_share") / terms.tax).alias("share_after_tax"),
        F.sum("total_revenue").alias("total_before_tax"),
        (F.sum("total_revenue") / terms.tax).alias("total_after_tax"))


def loan_details(loans: DataFrame, grid: DataFrame, cac: DataFrame, pairs: DataFrame,
                 terms: Terms) -> DataFrame:
    """Derived columns per loan; the seasonality is looked up by month numbers."""
    people = grid.select("customer_id", age_band("age_at_eligibility").alias("age_band"))
    first = (loans.filter(F.col("rank") == 1).groupBy("customer_id")
             .agg(F.max("order_gross_sales").alias("first_order_gross")))
    season = pairs.select(F.col("from_month").alias("enrollment_month"),
                          F.col("to_month").alias("months_since_enrollment"), "volume_ratio")
    par = F.col("par")
    return (loans.withColumn("enrollment_month", F.substring("enrollment_cohort", 6, 2).cast("int"))
            .join(people, "customer_id", "left").join(first, "customer_id", "left")
            .join(cac, "enrollment_cohort", "left")
            # 132 pairs of calendar months.
            .join(F.broadcast(season), ["enrollment_month", "months_since_enrollment"], "left")
            .withColumns({
                "share_of_interest": F.col("interests") * terms.revenue_share,
                "bucket_order": ordinal("par", BUCKET_ORDER),
                "matured_amount": F.when(par == "Ongoing", 0.0).otherwise(F.col("total_amount")),
                "loan_index": loan_index_label("rank"),
                "months_text": F.lpad(F.col("months_since_enrollment").cast("string"), 2, "0"),
                "clean_interest": F.col("total_to_pay") - F.col("total_amount"),
                "paid_amount": F.when(par == "Paid", F.col("total_amount")).otherwise(0.0),
                "loss_amount": F.when(
                    par.isin("DQ 15-29", "DQ 30-59", "DQ 60-89", "DQ 90+"),
                    F.col("total_amount")).otherwise(0.0)}))


def stage_walk(loans: DataFrame, terms: Terms) -> DataFrame:
    """Mature loans through seven stages: the bucket when reached, else 'Paid'."""
    mature = loans.filter(
        F.to_date("delivery_at") <= F.date_sub(F.lit(terms.as_of), terms.mature_days))
    reached = F.coalesce(F.col("days_past_due"), F.lit(0))
    steps = [(F.lit(1), F.lit("Ongoing"))] + [
        (F.lit(step), F.when(reached >= days, name).otherwise("Paid"))
        for step, days, name in STAGE_STEPS]
    return unpivot_steps(mature.select(
        "customer_id", "sales_order_id", loan_index_label("rank").alias("loan_index"),
        F.to_date("delivery_at").alias("delivery_on"), "total_amount", "days_past_due"),
        steps, ("step", "stage")).drop("days_past_due")


def stage_leads(walk: DataFrame) -> DataFrame:
    """One row per loan and stage with the stage found one step later, by an equi-join."""
    stages = walk.groupBy("customer_id", "sales_order_id", "stage").agg(
        F.max("loan_index").alias("loan_index"), F.max("delivery_on").alias("delivery_on"),
        F.max("total_amount").alias("total_amount"), F.min("step").alias("step"))
    later = stages.groupBy("sales_order_id", (F.col("step") - 1).alias("step")).agg(
        F.max("stage").alias("lead_stage"))
    return stages.join(later, ["sales_order_id", "step"], "left")


def roll_rates(leads: DataFrame) -> DataFrame:
    return leads.groupBy("stage", "lead_stage").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("total_amount").alias("amount")).withColumns({
            "stage_order": ordinal("stage", STAGE_ORDER),
            "lead_order": ordinal("lead_stage", LEAD_STAGE_ORDER)})


def charge_off(leads: DataFrame) -> DataFrame:
    """Share not paid, by count and by amount. The amount is given over both populations.

    ``by_amount`` compares rows leading to 'Paid' with all disbursed loans, as published;
    ``by_amount_same_loans`` uses the loans that reached 'Paid' instead.
    """
    amount = F.col("total_amount")
    paid = F.col("stage") == "Paid"
    amounts = {"amount_disbursed": F.col("stage") == "Ongoing",
               "amount_leading": F.col("lead_stage") == "Paid", "amount_paid": paid}
    # One row of each order stands for it, a paid one if there is one, and one row per customer is
    # left: neither a copy of every row per distinct count nor a second pass. Rows without an order
    # stand for none and are spread over customers.
    order = F.col("sales_order_id")
    each = Window.partitionBy(order, F.when(order.isNull(), F.col("customer_id"))).orderBy(
        paid.desc_nulls_last())
    stands = order.isNotNull() & (F.row_number().over(each) == 1)
    people = leads.withColumn("_stands", stands).groupBy("customer_id").agg(
        F.count(F.when(F.col("_stands"), 1)).alias("disbursed"),
        F.count(F.when(F.col("_stands") & paid, 1)).alias("paid"),
        *[F.sum(F.when(rows, amount)).alias(name) for name, rows in amounts.items()])
    base = people.agg(
        F.count("customer_id").alias("customers"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("disbursed", "paid")],
        *[F.sum(c).alias(c) for c in amounts])
    return base.withColumns({
        "by_count": 1 - F.col("paid") / F.col("disbursed"),
        "by_amount": 1 - F.col("amount_leading") / F.col("amount_disbursed"),
        "by_amount_same_loans": 1 - F.col("amount_paid") / F.col("amount_disbursed")})


def vintage_rates(vintage: DataFrame) -> DataFrame:
    """PAR over deployed capital and over activated customers, by months on book and in total."""
    month = F.col("_month")
    spread = unpivot_steps(vintage.withColumnRenamed("months_on_book", "_month"), [
        (F.lit("month"), month), (F.lit("total"), F.lit(None).cast("int"))],
        ("level", "months_on_book"))
    return spread.groupBy("level", "months_on_book").agg(*[
        safe_div(F.sum(f"par{d}"), F.sum("deployed_capital")).alias(f"par{d}_by_capital")
        for d in (30, 60, 90)], *[
        safe_div(F.sum(f"par{d}_n"), F.sum("ever_activated")).alias(f"par{d}_by_customers")
        for d in (30, 60, 90)],
        safe_div(F.sum("par30"), F.sum("outstanding_balance")).alias("par30_by_balance"))


def close_shares(snapshot: DataFrame) -> DataFrame:
    """Balance by bucket over the whole balance of the cutoff; 120 days and more are written off."""
    bucket = F.when(F.col("days_past_due") >= 120, "Written Off").otherwise(F.col("par"))
    cells = snapshot.groupBy("cutoff", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("balance"))
    # Ten buckets per cutoff.
    whole = Window.partitionBy("cutoff")
    return cells.withColumns({
        "cutoff_balance": F.sum("balance").over(whole),
        "share": safe_div(F.col("balance"), F.sum("balance").over(whole)),
        "bucket_order": F.when(F.col("bucket") == "Written Off", 9).otherwise(
            ordinal("bucket", BUCKET_ORDER))})


# -- before and after enrolment --------------------------------------------

def pre_post_measures(pre_post: DataFrame) -> DataFrame:
    """Frequency and sales per customer before and after; months beyond the last post month."""
    # Rows by stage and month first, one row per stage next: the last month is a window over those.
    by_month = Window.partitionBy()
    months = pre_post.groupBy("stage", "months").agg(
        F.count(F.lit(1)).alias("_rows")).withColumn(
        "max_month_post", F.max(F.when(F.col("stage") == "post credit", F.col("months"))).over(by_month))
    valid = months.groupBy(F.col("stage").alias("_stage")).agg(
        F.max("max_month_post").alias("max_month_post"),
        F.coalesce(F.sum(F.when(F.col("months") <= F.col("max_month_post"), F.col("_rows"))),
                   F.lit(0)).alias("valid_rows"))
    base = pre_post.groupBy("stage").agg(
        F.count_distinct("sales_order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("months").alias("months"), F.sum("gross_sales").alias("gross_sales"),
        F.count("sales_order_id").alias("sales")).join(
        valid, F.col("stage").eqNullSafe(F.col("_stage"))).drop("_stage")
    return base.withColumns({
        "frequency": safe_div("orders", "customers"),
        "historical_frequency": safe_div("sales", "customers"),
        "monthly_gross_per_customer": safe_div(
            safe_div("gross_sales", "months"), "customers"),
        "gross_per_customer": safe_div("gross_sales", "customers")})


def pre_post_series(pre_post: DataFrame, since: str) -> DataFrame:
    """Volume, drop size, frequency and customers by cohort, month and stage.

    The month of enrolment counts as after.
    """
    period = month_text("created_on")
    tagged = pre_post.withColumn("period", period).filter(F.col("period") >= since)
    stage = F.when(F.col("period") == F.col("enrollment_cohort"), "post credit").otherwise(
        F.col("stage"))
    return tagged.groupBy("enrollment_cohort", "period", stage.alias("stage")).agg(
        F.sum("final_price").alias("volume"), F.count_distinct("sales_order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers")).withColumns({
            "drop_size": safe_div("volume", "orders"),
            "frequency": safe_div("orders", "customers")})


# -- cohort panel ----------------------------------------------------------

def month_cells(panel: DataFrame) -> DataFrame:
    """The panel by month and credit flag, with a dense month index and the marks of the trend.

    Two rows per month: the windows without a key run over the calendar only.
    """
    cells = panel.groupBy("month", "credit_flag").agg(
        F.min("first_credit").alias("_first_credit"), F.sum("gross").alias("gross"),
        F.sum("gross_base").alias("gross_base"), F.sum("orders").alias("orders"),
        F.sum("active").alias("active"), F.sum("cohort_customers").alias("cohort_customers"))
    whole = Window.partitionBy()
    yes = F.col("credit_flag") == "Y"
    marked = cells.withColumn("cut", F.min("_first_credit").over(whole)).withColumn(
        "month_index", F.dense_rank().over(Window.orderBy("month")))
    marked = marked.withColumn("ref", F.max(F.when(
        (F.col("month") < F.col("cut")) & yes, F.col("month"))).over(whole))
    return marked.withColumn("ref_index", F.max(F.when(
        F.col("month") == F.col("ref"), F.col("month_index"))).over(whole)).drop("_first_credit")


def cohort_rates(panel: DataFrame) -> DataFrame:
    """Variation against the base, drop size, frequency and survival per month and flag."""
    return month_cells(panel).select(
        "month", "credit_flag", "month_index",
        safe_div(F.col("gross") - F.col("gross_base"), "gross_base").alias("gross_variation"),
        safe_div("gross", "orders").alias("drop_size"),
        safe_div("orders", "active").alias("frequency"),
        safe_div("active", "cohort_customers").alias("survival"))


def trend(panel: DataFrame) -> DataFrame:
    """Trend before the first credit, projected to every month, for both groups.

    Slope: variation of the three months up to the reference month over the index steps since
    the first month. The drop size follows the line through its first and its reference value.
    """
    cells = month_cells(panel)
    group = Window.partitionBy("credit_flag")
    near = F.col("month").between(F.add_months("ref", -2), F.col("ref"))

    def over_near(c):
        return F.sum(F.when(near, F.col(c))).over(group)

    drop = safe_div("gross", "orders")
    steps = F.col("ref_index") - 1
    first = F.max(F.when(F.col("month_index") == 1, drop)).over(group)
    at_ref = F.max(F.when(F.col("month") == F.col("ref"), drop)).over(group)
    position = F.col("month_index") - 1
    slope = safe_div(safe_div(over_near("gross") - over_near("gross_base"),
                              over_near("gross_base")), steps)
    return cells.withColumns({
        "slope": slope, "projected_variation": slope * position,
        "variation": safe_div(F.col("gross") - F.col("gross_base"), "gross_base"),
        "drop_size": drop,
        "projected_drop_size": first + safe_div(at_ref - first, steps) * position})


def excess_over_trend(trend: DataFrame) -> DataFrame:
    """Variation of the credit group since the cut against its projection."""
    after = (F.col("month") >= F.col("cut")) & (F.col("credit_flag") == "Y")
    every = trend.filter(F.col("month") >= F.col("cut")).groupBy("month").agg(
        F.max(F.when(after, F.col("variation"))).alias("variation"),
        F.max("month_index").alias("month_index"))
    slope = trend.filter(F.col("credit_flag") == "Y").agg(F.max("slope")).scalar()
    sums = every.agg(
        F.sum("variation").alias("excess"),
        F.sum(slope * (F.col("month_index") - 1)).alias("base"))
    return sums.withColumn("relative", safe_div(F.col("excess") - F.col("base"), "base"))


def uplift(panel: DataFrame) -> DataFrame:
    """After over before, credit over no credit, for drop size, frequency and survival."""
    cells = month_cells(panel).withColumn("after", F.col("month") >= F.col("cut"))
    total = cells.groupBy("credit_flag", "after").agg(*[
        F.sum(c).alias(c) for c in ("gross", "orders", "active", "cohort_customers")])
    ratios = {"drop_size": ("gross", "orders"), "frequency": ("orders", "active"),
              "survival": ("active", "cohort_customers")}

    def value(name, flag, after):
        a, b = ratios[name]
        here = (F.col("credit_flag") == flag) & (F.col("after") == after)
        return F.max(F.when(here, safe_div(a, b)))

    return total.agg(*[
        (safe_div(safe_div(value(n, "Y", True), value(n, "N", True)),
                  safe_div(value(n, "Y", False), value(n, "N", False))) - 1).alias(f"{n}_uplift")
        for n in ratios])


def coverage(panel: DataFrame, since: dt.date) -> DataFrame:
    """Credit customers whose first purchase falls in the selection, over all of them."""
    base = panel.filter((F.col("credit_flag") == "Y") & (F.col("period") == 0))
    return base.agg(
        F.sum(F.when(F.col("first_month") >= F.lit(since), F.col("active"))).alias("selected"),
        F.sum("active").alias("customers")).withColumn(
        "coverage", safe_div("selected", "customers"))


def threshold_month(panel: DataFrame, share: float = 0.1) -> DataFrame:
    """First credit month at which the cumulated cohort customers reach a share of the total."""
    per_month = panel.filter(F.col("credit_flag") == "Y").groupBy("first_credit").agg(
        F.sum("cohort_customers").alias("customers"))
    so_far = Window.orderBy("first_credit").rowsBetween(Window.unboundedPreceding, 0)
    run = per_month.withColumns({
        "running": F.sum("customers").over(so_far),
        "total": F.sum("customers").over(Window.partitionBy())})
    return run.agg(F.min(F.when(F.col("running") >= F.col("total") * share, F.col("first_credit")))
                   .alias("month"), F.max("total").alias("customers"))


def audience(lifecycle: DataFrame, measure: int) -> DataFrame:
    """Customers (0) or gross sales (1) by month and state."""
    value = {0: "customers", 1: "gross_sales"}[measure]
    return lifecycle.select("month", "state", F.col(value).alias("value"))


# -- customers and calendars -----------------------------------------------

def order_funnel(grid: DataFrame) -> DataFrame:
    return grid.agg(*[F.count_if(F.col("orders_count") >= n).alias(f"at_least_{n}")
                      for n in FUNNEL_STEPS])


def tenure_and_age(grid: DataFrame, terms: Terms) -> DataFrame:
    tenure = F.coalesce(months_between("enrolled_at", F.lit(terms.as_of)) > 4, F.lit(False))
    return grid.groupBy(age_band("age_at_eligibility").alias("age_band"),
                        tenure.cast("int").alias("long_tenure")).agg(
        F.count(F.lit(1)).alias("customers"))


def calendar(days: DataFrame, column: str) -> DataFrame:
    """Every day of the range at four granularities; weeks start on Monday."""
    span = days.agg(F.min(F.to_date(column)).alias("a"), F.max(F.to_date(column)).alias("b"))
    spine = span.select(F.explode(dates(F.col("a"), F.col("b"))).alias("date"))
    day = F.col("date")
    return unpivot_steps(spine, [
        (day, F.lit("Daily"), F.lit(1)), (F.trunc(day, "week"), F.lit("Weekly"), F.lit(2)),
        (F.trunc(day, "month"), F.lit("Monthly"), F.lit(3)),
        (F.trunc(day, "year"), F.lit("Yearly"), F.lit(4))], ("visual_date", "type", "order"))


def calendar_parts(days: DataFrame, column: str) -> DataFrame:
    """Year, month and quarter parts of every day of whole years around the data."""
    span = days.agg(F.min(F.to_date(column)).alias("a"), F.max(F.to_date(column)).alias("b"))
    start = F.trunc("a", "year")
    stop = F.make_date(F.year("b"), F.lit(12), F.lit(31))
    day = F.col("date")
    return span.select(F.explode(dates(start, stop)).alias("date")).withColumns({
        "year": F.year(day), "month_no": F.month(day), "month": F.date_format(day, "MMMM"),
        "quarter_no": F.quarter(day), "quarter": F.concat(F.lit("Qtr "), F.quarter(day)),
        "day": F.day(day)})


def series(start: int, stop: int, step: int, spark) -> DataFrame:
    """Parameter values, both ends included."""
    return spark.range(start, stop + 1, step).toDF("value")


def running_by_month(df: DataFrame, month: str, value: str) -> DataFrame:
    """Running sum of a monthly chart series."""
    per_month = df.groupBy(month).agg(F.sum(value).alias(value))
    so_far = Window.orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    return per_month.withColumn("running", F.sum(value).over(so_far))


