"""Contest window against the window of equal length just before it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.functions import int_key
from vintora.operators.skew import keyed_window
from vintora.params import ACTIVE_STATES, CANCELLED_STATES, Terms


def previous_window(terms: Terms) -> tuple[dt.date, dt.date]:
    length = terms.contest_to - terms.contest_from + dt.timedelta(days=1)
    return terms.contest_from - length, terms.contest_from - dt.timedelta(days=1)


def order_state(orders: DataFrame) -> DataFrame:
    """Order rows collapsed to (customer, sales order); the most advanced status wins."""
    status = F.col("order_status")
    rank = (F.when(status == "COMPLETED", 1).when(status == "IN_DELIVERY", 2)
            .when(status == "CREATED", 3).otherwise(4))

    def ever(condition):
        return F.coalesce(F.bool_or(condition), F.lit(False))

    return orders.filter(F.col("created_at").isNotNull()).groupBy(
        "customer_id", "sales_order_id").agg(
        F.min("created_at").alias("created_at"), F.max("delivered_at").alias("delivered_at"),
        *[F.min(c).alias(c) for c in ("route", "supervisor", "office", "region", "customer_type")],
        ever(F.col("route_inferred")).alias("route_inferred"),
        *[F.max(c).alias(c) for c in ("order_gross_sales", "total_price", "credit_limit", "skus",
                                      "quantity")],
        F.min("attempt_index").alias("attempt_index"),
        F.max("delivery_status").alias("delivery_status"),
        # The status breaks ties between the states that rank last.
        F.min_by(status, F.struct(rank, status)).alias("order_status"),
        ever(F.col("delivery_status") == "COMPLETED").alias("is_delivered"),
        ever(status.isin(*ACTIVE_STATES)).alias("is_active"),
        ever(status.isin(*CANCELLED_STATES)).alias("is_cancelled"),
        ever(status == "REJECTED").alias("is_rejected"))


def contest(orders: DataFrame, grid: DataFrame, routes: DataFrame, terms: Terms
            ) -> DataFrame:
    start, stop = terms.contest_from, terms.contest_to
    prior, _ = previous_window(terms)
    state = order_state(orders)
    day = F.to_date("created_at")
    earlier = F.col("is_delivered") & (day < F.lit(start))
    history = state.groupBy("customer_id").agg(
        F.min(F.when(F.col("is_delivered"), day)).alias("first_delivered_on"),
        F.count_if(earlier).alias("delivered_before"),
        F.max(F.when(earlier, day)).alias("last_delivered_before"))
    inside = state.filter(day.between(F.lit(prior), F.lit(stop))).withColumns({
        "in_contest": day >= F.lit(start),
        "period": F.when(day >= F.lit(start), "Concurso").otherwise("Previo"),
        "day_in_window": F.datediff(day, F.when(day >= F.lit(start), F.lit(start))
                                    .otherwise(F.lit(prior))) + 1})
    marked = keyed_window(
        inside, ["customer_id", "in_contest", "is_delivered"], ["created_at", "sales_order_id"],
        running={"delivered_index": F.lit(1)})
    person = grid.select("customer_id", "shop_name", "shop_town", "shop_state", "enrolled_at",
                         "enrollment_cohort", "enrollment_channel")
    now = routes.select("customer_id", *[F.col(c).alias(f"current_{c}") for c in
                                         ("route", "supervisor", "office", "region",
                                          "customer_type")])
    out = (marked.join(now, "customer_id", "left").join(person, "customer_id", "left")
           .join(history, "customer_id", "left"))
    # Labels of missing structure.
    missing = {"route": "SIN RUTA", "supervisor": "SIN SUPERVISOR", "office": "SIN OFICINA",
               "region": "SIN REGION"}
    return out.withColumns({
        **{c: F.coalesce(c, F.lit(label)) for c, label in missing.items()},
        **{f"current_{c}": F.coalesce(f"current_{c}", F.lit(label))
           for c, label in missing.items()},
        "customer_key": int_key("customer_id"),
        "is_first_order": F.col("attempt_index") == 1,
        "delivered_before": F.coalesce("delivered_before", F.lit(0)),
        "is_new": F.coalesce("delivered_before", F.lit(0)) == 0,
        "is_first_delivered": F.coalesce(
            F.col("is_delivered") & (F.col("delivered_index") == 1), F.lit(False))}
    ).drop("delivered_index")


def settled(contest_orders: DataFrame, loans: DataFrame) -> DataFrame:
    paid = loans.select("sales_order_id", "paid_at")
    return contest_orders.join(paid, "sales_order_id", "left").withColumn(
        "is_settled", F.col("paid_at").isNotNull()).withColumnRenamed("paid_at", "settled_at")


def contest_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("netsuite_id").alias("netsuiteId"), F.col("netsuite_id_num").alias("netsuiteIdNum"),
        F.col("clasificacion"), F.col("linea_nueva").cast("double").alias("lineaNueva"),
        F.col("ruta_preventa").alias("aliado"), F.col("supervisor"),
        F.col("oficina_venta").alias("oficina"))
