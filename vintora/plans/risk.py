"""Matured loans, weight of evidence and recovery."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintora.functions import (
    age_band, digits_key, haversine, int_key, iv, loan_range, rounded_long, safe_div,
    stamp, woe,
)
from vintora.operators.relational import unpivot_steps
from vintora.operators.skew import number_rows
from vintora.params import DISTANCE_CUTS, Terms


def matured(loans: DataFrame, terms: Terms) -> DataFrame:
    return loans.filter(F.col("due_on").cast("timestamp_ntz") < stamp(terms.now))


def last_due_orders(orders: DataFrame, terms: Terms) -> DataFrame:
    """Creation day of each customer's last matured order."""
    due = F.col("delivery_at") + F.expr(f"INTERVAL {terms.credit_days} DAYS") < stamp(terms.now)
    return (orders.filter((F.col("order_status") == "COMPLETED") & due).groupBy("customer_id")
            .agg(F.max(F.to_date("created_at")).alias("last_on")))


def eligible_days(grid: DataFrame) -> DataFrame:
    return grid.filter(F.col("eligible_at").isNotNull()).select(
        "customer_id", F.to_date("eligible_at").alias("eligible_on"))


def sales_around(history: DataFrame, last: DataFrame, eligible: DataFrame, terms: Terms
                 ) -> DataFrame:
    """Sales after the last matured order, and in the 3 and 6 months before eligibility.

    Both anchors are one date per customer, so no pairs of sales and orders arise, and the
    history is read once. (customer, sales order) is unique in it: orders are counted as rows.
    NULL channels count for neither side of the later sales.
    """
    anchors = last.join(eligible, "customer_id", "full")
    on, amount = F.col("created_on"), F.col("amount")
    after = on > F.col("last_on")
    field = after & (F.col("channel") == terms.field_channel)
    other = after & (F.col("channel") != terms.field_channel)
    six = (on >= F.add_months("eligible_on", -6)) & (on < F.col("eligible_on"))
    three = six & (on >= F.add_months("eligible_on", -3))
    parts = {"field_after": field, "other_after": other, "3m": three, "6m": six}
    near = history.join(anchors, "customer_id").filter(after | six)
    return near.groupBy("customer_id").agg(
        *[F.coalesce(F.sum(F.when(c, amount)), F.lit(0.0)).alias(f"gross_{n}")
          for n, c in parts.items()],
        *[F.count_if(c).alias(f"orders_{n}") for n, c in parts.items()])


def distance() -> Column:
    return haversine("customer_latitude", "customer_longitude", "shop_latitude", "shop_longitude")


def matured_profile(loans: DataFrame, grid: DataFrame, orders: DataFrame, history: DataFrame,
                    terms: Terms) -> DataFrame:
    """One row per matured loan with the customer's surroundings."""
    person = grid.select(
        "customer_id", "eligible_at", "business_category", "shop_neighborhood", "shop_zip",
        "shop_town", "shop_state", "shop_latitude", "shop_longitude", "customer_name",
        "customer_last_names", "gender", "birthdate", "age", "age_at_eligibility",
        "customer_latitude", "customer_longitude")
    zero = ("gross_field_after", "gross_other_after", "gross_3m", "gross_6m")
    none = ("orders_field_after", "orders_other_after", "orders_3m", "orders_6m")
    base = matured(loans, terms).join(person, "customer_id", "left")
    around = sales_around(history, last_due_orders(orders, terms), eligible_days(grid), terms)
    base = base.join(around, "customer_id", "left")
    return base.withColumns({
        **{c: F.coalesce(c, F.lit(0.0)) for c in zero}, **{c: F.coalesce(c, F.lit(0)) for c in none},
        "avg_ticket_3m": F.when(F.col("orders_3m") > 0, rounded_long(
            F.col("gross_3m") / F.col("orders_3m"))).otherwise(F.lit(0).cast("bigint")),
        "customer_key": int_key("customer_id"), "loan_range": loan_range("rank"),
        "flag_15": F.when(F.col("days_past_due") >= 15, 1).otherwise(0),
        "flag_30": F.when(F.col("days_past_due") >= 30, 1).otherwise(0),
        "zip_code": digits_key("shop_zip"), "distance": distance()})


def numbered(profile: DataFrame) -> DataFrame:
    return number_rows(profile, ["customer_id", "sales_order_id"], "row_id")


# -- weight of evidence ----------------------------------------------------

def flagged(df: DataFrame) -> DataFrame:
    """Each loan once per default flag."""
    return unpivot_steps(df, [
        (F.lit(f"flag@{days}DaysLate"), F.when(F.col("days_past_due") >= days, 1).otherwise(0))
        for days in (15, 30)], ("flag", "is_bad"))


def with_evidence(cells: DataFrame, group: list[str]) -> DataFrame:
    """Shares, WOE and IV of cells with ``events`` and ``bad``; the NULL bin is part of totals."""
    whole = Window.partitionBy(*group)
    totals = cells.withColumn("good", F.col("events") - F.col("bad")).withColumns({
        "total_good": F.sum(F.col("events") - F.col("bad")).over(whole),
        "total_bad": F.sum("bad").over(whole)})
    parts = ("good", "bad", "total_good", "total_bad")
    return totals.withColumns({
        "bad_rate": safe_div("bad", "events"), "pct_good": safe_div("good", "total_good"),
        "pct_bad": safe_div("bad", "total_bad"), "woe": woe(*parts), "iv": iv(*parts)}
    ).drop("total_good", "total_bad")


def distance_odds(loans: DataFrame, grid: DataFrame, terms: Terms) -> DataFrame:
    """WOE of the distance between onboarding and shop, with a frozen cut per loan range."""
    place = grid.select("customer_id", "customer_latitude", "customer_longitude", "shop_latitude",
                        "shop_longitude")
    cut = reduce(lambda e, c: e.when(F.col("loan_range") == c[0], c[1]),
                 DISTANCE_CUTS[1:], F.when(F.col("loan_range") == DISTANCE_CUTS[0][0],
                                           DISTANCE_CUTS[0][1]))
    base = (matured(loans, terms).select("customer_id", "rank", "days_past_due")
            .join(place, "customer_id", "left")
            .select(loan_range("rank").alias("loan_range"), "days_past_due",
                    distance().alias("distance")))
    marked = flagged(base.withColumn("bin", F.when(F.col("distance") <= cut, 0).when(
        F.col("distance").isNotNull(), 1)))
    cells = marked.groupBy("loan_range", "flag", "bin").agg(
        F.min("distance").alias("min_value"), F.max("distance").alias("max_value"),
        F.count(F.lit(1)).alias("events"), F.sum("is_bad").alias("bad"))
    return with_evidence(cells, ["loan_range", "flag"])


def information_value(odds: DataFrame, keys: list[str]) -> DataFrame:
    return odds.groupBy(*keys).agg(F.sum("iv").alias("iv"))


def pair_odds(loans: DataFrame, grid: DataFrame, terms: Terms) -> DataFrame:
    """WOE of every pair of binned attributes.

    Counted on the distinct attribute combinations first: the pairs then expand a table whose
    size depends on the number of bins and not on the number of loans.
    """
    person = grid.select(
        "customer_id", "business_category", "age_at_eligibility", "gender", "customer_latitude",
        "customer_longitude", "shop_latitude", "shop_longitude")
    base = matured(loans, terms).select("customer_id", "rank", "days_past_due").join(
        person, "customer_id", "left")
    attributes = {
        "age_band": age_band("age_at_eligibility"),
        "business_category": F.coalesce("business_category", F.lit("Unknown")),
        "distance": F.when(distance() <= 8, "near").when(distance() > 8, "far")
        .otherwise("Unknown"),
        "gender": F.coalesce("gender", F.lit("Unknown"))}
    combos = (flagged(base.select(loan_range("rank").alias("loan_range"), "days_past_due",
                                  *[c.alias(n) for n, c in attributes.items()]))
              .groupBy("loan_range", "flag", *attributes)
              .agg(F.count(F.lit(1)).alias("events"), F.sum("is_bad").alias("bad")))
    pairs = unpivot_steps(combos, [
        (F.lit(a), F.lit(b), F.col(a), F.col(b)) for a, b in combinations(attributes, 2)],
        ("atr1", "atr2", "atr1_rank", "atr2_rank"))
    cells = pairs.groupBy("loan_range", "flag", "atr1", "atr2", "atr1_rank", "atr2_rank").agg(
        F.sum("events").alias("events"), F.sum("bad").alias("bad"))
    return with_evidence(cells, ["loan_range", "flag", "atr1", "atr2"])


def pair_iv(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(
        "loan_range", "flag", F.concat_ws("_", "atr1", "atr2").alias("combination")).agg(
        F.count(F.lit(1)).alias("number_of_combinations"), F.sum("iv").alias("iv"))


def recovery_curve(loans: DataFrame, terms: Terms) -> DataFrame:
    """Loans that ever reached 90 days past due, by the age of their due date."""
    bad = loans.filter(F.col("days_past_due") >= 90)
    age = F.floor(F.datediff(F.lit(terms.as_of), F.col("due_on")) / 30)
    # Lower month of each age band.
    band = (F.when(age < 4, "03-04").when(age < 6, "04-06").when(age < 9, "06-09")
            .when(age < 12, "09-12").when(age < 18, "12-18").otherwise("18+"))
    paid = F.col("paid_at").isNotNull()
    return bad.groupBy(band.alias("age_months")).agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(paid).alias("recovered"),
        F.sum("total_amount").alias("amount"),
        (F.sum(F.when(paid, F.col("total_amount")).otherwise(0.0)) / F.sum("total_amount"))
        .alias("recovered_share"))


def fraud_segments(profile: DataFrame, service: DataFrame) -> DataFrame:
    """Default outcome per loan and its crossing with the service profile."""
    later = (F.col("orders_field_after") + F.col("orders_other_after")) >= 1
    # Names of the outcomes.
    outcome = (F.when(F.col("flag_15") == 0, "Not Defaulted")
               .when(F.col("paid_at").isNotNull(), "Defaulted & Recovered")
               .when(later, "Defaulted & Still Active with Other Payment Methods")
               .otherwise("Potential Fraud"))
    side = service.select(F.col("id_cliente").alias("customer_key"),
                          F.col("transactional_profile").alias("service_profile"))
    out = profile.withColumns({"fraud_flag": outcome, "bought_later": later.cast("int")})
    cross = ((F.col("service_profile") == "03-Mostly Fraud")
             & (F.col("fraud_flag") == "Potential Fraud"))
    return out.join(side, "customer_key", "left").withColumn(
        "cross_fraud", F.coalesce(cross, F.lit(False)).cast("int"))


