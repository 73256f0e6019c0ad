"""Consumer tables: exact published names, light casts, one row per input row.

Column names of a brand are published under neutral ones (``credit…``, ``shareRevenue``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.functions import (
    int_key, local_to_epoch_ms, month_start, month_text_to_date, rounded_long,
)

Cast = Callable[[str], Column]


def _same(c: str) -> Column:
    return F.col(c)


def _date(c: str) -> Column:
    return F.to_date(c)


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _project(df: DataFrame, fields) -> DataFrame:
    """Fields are (published name, column, cast)."""
    return df.select(*[cast(c).alias(name) for name, c, cast in fields])


def published_orders(orders: DataFrame, routes: DataFrame) -> DataFrame:
    now = routes.select("customer_id", F.col("customer_type").alias("current_type"))
    return _project(orders.join(now, "customer_id", "left"), [
        ("netsuiteId", "customer_id", _same), ("salesOrderId", "sales_order_id", _same),
        ("orderId", "order_id", _same), ("orderStatus", "order_status", _same),
        ("deliveryStatus", "delivery_status", _same), ("salesChannel", "sales_channel", _same),
        ("createdAtTimestamp", "created_ms", _same), ("createdAt", "created_at", _date),
        ("orderGrossSales", "order_gross_sales", _same), ("totalPrice", "total_price", _same),
        ("creditLimit", "credit_limit", _same), ("skus", "skus", _same),
        ("quantity", "quantity", rounded_long), ("deliveryAt", "delivery_at", _date),
        ("deliveryDate", "delivered_at", _date), ("customerOrderTryIndex", "attempt_index", _same),
        ("customerCompletedOrderIndex", "completed_index", _same),
        ("creditEnrolledAt", "enrolled_at", _date), ("enrollment_cohort", "enrollment_cohort", _same),
        ("EnrolledCustomers", "enrolled_customers", _same),
        ("enrolledCreditLimit", "cohort_credit_limit", _same),
        ("creditActivatedAt", "activated_at", _date), ("activatedCohort", "activated_cohort", _same),
        ("monthsSinceEnrollment", "months_since_enrollment", _same),
        ("monthsSinceActivation", "months_since_activation", _same),
        ("monthCreatedAt", "created_month", _same), ("ruta", "route", _same),
        ("supervisor", "supervisor", _same), ("oficina", "office", _same),
        ("tipo", "customer_type", _same), ("tipoActual", "current_type", _same)])


def published_loans(loans: DataFrame, grid: DataFrame) -> DataFrame:
    activated = (grid.filter((F.col("is_activated") == 1) & F.col("enrollment_cohort").isNotNull())
                 .groupBy("enrollment_cohort").agg(F.count(F.lit(1)).alias("ever_activated")))
    # One row per month.
    joined = loans.join(F.broadcast(activated), "enrollment_cohort", "left").withColumn(
        "ever_activated", F.coalesce("ever_activated", F.lit(0)))
    return _project(joined, [
        ("netsuiteId", "customer_id", int_key), ("salesOrderId", "sales_order_id", _same),
        ("orderStatus", "order_status", _same), ("createdAt", "created_at", _date),
        ("orderGrossSales", "order_gross_sales", _same), ("creditLimit", "credit_limit", _same),
        ("quantity", "quantity", rounded_long), ("deliveryAt", "delivery_at", _date),
        ("creditEnrolledAt", "enrolled_at", _date), ("enrollment_cohort", "enrollment_cohort", _same),
        ("EnrolledCustomers", "enrolled_customers", _same),
        ("everActivatedCustomers", "ever_activated", _same),
        ("enrolledCreditLimit", "cohort_credit_limit", rounded_long),
        ("monthsSinceEnrollment", "months_since_enrollment", _same), ("ruta", "route", _same),
        ("supervisor", "supervisor", _same), ("oficina", "office", _same),
        ("tipo", "customer_type", _same), ("rank", "rank", _same),
        ("transaction_id", "transaction_id", _same), ("totalAmountToPay", "total_to_pay", _same),
        ("totalAmount", "total_amount", _same), ("interests", "interests", _same),
        ("totalAmountDefault", "total_default", rounded_long),
        ("movementDate", "movement_at", _text), ("paymentDate", "payment_at", _text),
        ("paidDate", "paid_at", _same), ("expectedPaymentDate", "due_on", _same),
        ("endOfTheMonthexpectedPaymentDate", "due_month_end", _same), ("month", "month", _same),
        ("paidOnMonth", "paid_on_month", _same), ("daysPastDue", "days_past_due", _same),
        ("daysPastDueEndOfTheMonth", "days_past_due_month_end", _same),
        ("defaultInterest", "penalty_interest", lambda c: F.col(c).cast("double")),
        ("totalRevenue", "total_revenue", _same), ("shareRevenue", "revenue_share", _same),
        ("PAR", "par", _same)])


_SNAPSHOT = [
    ("netsuiteId", "customer_id", int_key), ("salesOrderId", "sales_order_id", _same),
    ("orderStatus", "order_status", _same), ("createdAt", "created_at", _date),
    ("orderGrossSales", "order_gross_sales", _same), ("quantity", "quantity", rounded_long),
    ("deliveryAt", "delivery_at", _date), ("creditEnrolledAt", "enrolled_at", _date),
    ("enrollment_cohort", "enrollment_cohort", month_text_to_date),
    ("EnrolledCustomers", "enrolled_customers", _same),
    ("enrolledCreditLimit", "cohort_credit_limit", rounded_long),
    ("monthsSinceEnrollment", "months_since_enrollment", _same), ("rank", "rank", _same),
    ("transaction_id", "transaction_id", _same), ("totalAmountToPay", "total_to_pay", _same),
    ("totalAmount", "total_amount", _same), ("interests", "interests", _same),
    ("totalAmountDefault", "total_default", _same), ("movementDate", "movement_at", _text),
    ("paymentDate", "payment_at", _same), ("paidDate", "paid_at", _date),
    ("expectedPaymentDate", "due_on", _same),
    ("endOfTheMonthexpectedPaymentDate", "due_month_end", _same), ("corte", "cutoff", _same),
    ("daysPastDue", "days_past_due", _same), ("ruta", "route", _same),
    ("supervisor", "supervisor", _same), ("oficina", "office", _same),
    ("tipo", "customer_type", _same)]


PAR = [*_SNAPSHOT, ("limitToReceiveOrdersInMont", "previous_month_end", _same),
       ("PAR", "par", _same), ("month", "month", _same)]
CLOSES = [*_SNAPSHOT, ("dqBucket", "par", _same), ("month", "cutoff", month_start)]
# Columns that carry this name are published as they are: made once per loan or month end.
READY = "_ready_{}"


def _snapshot(snapshot: DataFrame, fields) -> DataFrame:
    ready = {name: READY.format(name) for name, _, _ in fields}
    return _project(snapshot, [
        (name, ready[name], _same) if ready[name] in snapshot.columns else (name, c, cast)
        for name, c, cast in fields])


def published_snapshot(snapshot: DataFrame) -> DataFrame:
    """The snapshot already carries the loan's route and rank, so no join back is needed."""
    return _snapshot(snapshot, PAR)


def published_closes(snapshot: DataFrame) -> DataFrame:
    return _snapshot(snapshot, CLOSES)


def published_vintage(vintage: DataFrame) -> DataFrame:
    return _project(vintage, [
        ("enrollment_cohort", "enrollment_cohort", _same),
        ("cohortYear", "cohort_year", lambda c: F.col(c).cast("double")),
        ("monthsFromEnrollmentToMonth", "months_on_book", _same), ("corte", "label", _same),
        ("n", "orders", _same), ("everActivated", "ever_activated", _same),
        ("enrolled_customers", "enrolled_customers", _same),
        ("deployedCapital", "deployed_capital", _same),
        ("outstandingBalance", "outstanding_balance", _same),
        *[(f"PAR{d}", f"par{d}", _same) for d in (30, 60, 90)],
        *[(f"PAR{d}N", f"par{d}_n", _same) for d in (30, 60, 90)],
        *[(f"par{d}Rate", f"par{d}_rate", _same) for d in (30, 60, 90)],
        *[(f"par{d}CustomersRate", f"par{d}_customers_rate", _same) for d in (30, 60, 90)]])


def published_grid(unique_grid: DataFrame) -> DataFrame:
    return _project(unique_grid, [
        ("netsuiteId", "customer_key", _same), ("customerId", "document_id", _same),
        ("shopkeeperId", "shopkeeper_id", _same), ("shopName", "shop_name", _same),
        ("ruta", "route", _same), ("supervisor", "supervisor", _same), ("oficina", "office", _same),
        ("tipo", "customer_type", _same), ("business_category", "business_category", _same),
        ("shopNeighborhood", "shop_neighborhood", _same), ("shopZipCode", "shop_zip", _same),
        ("shopTown", "shop_town", _same), ("shopState", "shop_state", _same),
        ("shopLatitude", "shop_latitude", _same), ("shopLongitude", "shop_longitude", _same),
        ("customerName", "customer_name", _same),
        ("customerLastNames", "customer_last_names", _same), ("inferredGender", "gender", _same),
        ("customerBirthdate", "birthdate", _same), ("customerAge", "age", _same),
        ("customerAgeAtEligibility", "age_at_eligibility", _same),
        ("customerAgeAtEnrollment", "age_at_enrollment", _same),
        ("customerPhoneNumber", "phone", _same), ("customerLatitude", "customer_latitude", _same),
        ("customerLongitude", "customer_longitude", _same),
        ("creditEligibleAt", "eligible_at", _date),
        ("originalCreditLimit", "original_limit", rounded_long),
        ("creditLimit", "credit_limit", rounded_long),
        ("creditEnrolledAtTimestamp", "enrolled_at", local_to_epoch_ms),
        ("creditEnrolledAt", "enrolled_at", _date), ("creditIsEnrolled", "is_enrolled", _same),
        ("enrollment_cohort", "enrollment_cohort", _same),
        ("enrollmentChannel", "enrollment_channel", _same),
        ("creditActivatedAt", "activated_at", _date), ("creditIsActivated", "is_activated", _same),
        ("creditActivatedCohortMonth", "activated_cohort", _same),
        ("creditActivatedLineOfCredit", "activated_limit", _same),
        ("creditFirstOrderdAt", "first_order_at", _date),
        ("creditLastOrderAt", "last_order_at", _date), ("creditOrdersCount", "orders_count", _same),
        ("creditCompletedOrdersCount", "completed_orders", _same),
        ("creditRejectedOrdersCount", "rejected_orders", _same),
        ("creditCancelledOrdersCount", "cancelled_orders", _same),
        ("creditAvgOrderVolume", "avg_order_volume", _same),
        ("creditTotalOrderVolume", "total_order_volume", _same),
        ("creditCompletedOrderVolume", "completed_volume", _same),
        ("creditFirstOrderGrossSales", "first_order_gross", _text),
        ("creditOrderFrequency", "order_frequency", _same),
        ("creditDueForPaymentOrdersCount", "due_orders", _same),
        ("creditPaymentsCount", "payments_count", _same), ("creditAvgRevenue", "avg_revenue", _same),
        ("creditAvgRevenueShare", "avg_revenue_share", _same), ("creditRevenue", "revenue", _same),
        ("creditRevenueShare", "revenue_share", _same), ("creditIsActive", "is_active", _same)])


def published_lifecycle(lifecycle: DataFrame) -> DataFrame:
    return _project(lifecycle, [
        ("createdAtMonth", "month", lambda c: F.col(c).cast("timestamp_ntz")),
        ("tipoActual", "state", _same), ("Gross Sales", "gross_sales", _same),
        ("Clientes", "customers", _same), ("ordenes", "orders", _same)])


def published_profile(profile: DataFrame) -> DataFrame:
    blank, zero = (lambda _: F.lit(None).cast("string")), (lambda _: F.lit(0).cast("bigint"))
    return _project(profile, [
        ("Column1", "row_id", _same), ("netsuiteId", "customer_key", _same),
        ("salesOrderId", "sales_order_id", _same), ("orderId", "order_id", _same),
        ("orderStatus", "order_status", _same), ("createdAt", "created_at", _date),
        ("expectedPaymentDate", "due_on", _same), ("paidDate", "paid_at", _date),
        ("totalAmount", "total_amount", _same), ("totalAmountToPay", "total_to_pay", _same),
        ("daysPastDue", "days_past_due", _same), ("loanDisbursementIndex", "rank", _same),
        ("loanDisbursementIndexRange", "loan_range", _same),
        ("flag@15DaysLate", "flag_15", _same), ("flag@30DaysLate", "flag_30", _same),
        ("creditEligibleAt", "eligible_at", _date), ("ruta", "route", _same),
        ("supervisor", "supervisor", _same), ("oficina", "office", _same),
        ("tipo", "customer_type", _same), ("business_category", "business_category", _same),
        ("shopNeighborhood", "shop_neighborhood", _same), ("shopZipCode", "zip_code", _same),
        ("shopTown", "shop_town", _same), ("shopState", "shop_state", _same),
        ("shopLatitude", "shop_latitude", _same), ("shopLongitude", "shop_longitude", _same),
        ("customerName", "customer_name", _same),
        ("customerLastNames", "customer_last_names", _same), ("inferredGender", "gender", _same),
        ("customerBirthdate", "birthdate", _same), ("customerAge", "age", _same),
        ("customerAgeAtEligibility", "age_at_eligibility", _same),
        ("customerLatitude", "customer_latitude", _same),
        ("customerLongitude", "customer_longitude", _same),
        ("distanceBetweenOnboardingAndShopLocation", "distance", _same),
        ("PSOnboardedAt", "", blank), ("TPVOnboardedAt", "", blank),
        ("psrtaPreviousToCredit", "", zero), ("tpvPreviousToCredit", "", zero),
        ("previousFintechProductToCredit", "", zero),
        ("grossSalesVolume3Months", "gross_3m", _same), ("ordersCount3Months", "orders_3m", _same),
        ("avgTicket3Months", "avg_ticket_3m", _same),
        ("grossSalesVolume6Months", "gross_6m", _same), ("ordersCount6Months", "orders_6m", _same),
        ("grossSalesAliadoPostLastCreditOrder", "gross_field_after", _same),
        ("ordersCountAliadoPostLastCreditOrder", "orders_field_after", _same),
        ("grossSalesMarketPlacePostLastCreditOrder", "gross_other_after", _same),
        ("ordersCountMarketPlacePostLastCreditOrder", "orders_other_after", _same)])


def published_panel(panel: DataFrame) -> DataFrame:
    stamp = (lambda c: F.col(c).cast("timestamp"))
    return _project(panel, [
        ("mes_tx", "month", _same), ("mes_ft_tx", "first_month", stamp),
        ("mes_ft_tx_credit", "first_credit", stamp), ("flg_cte_credit", "credit_flag", _same),
        ("periodo.", "period", _same), ("clientes_cosecha", "cohort_customers", _same),
        ("cliente_activo", "active", _same), ("ordenes", "orders", _same),
        ("gross_sales", "gross", _same), ("ordenes_ft", "orders_base", _same),
        ("gross_sales_ft", "gross_base", _same)])


def published_pre_post(pre_post: DataFrame) -> DataFrame:
    blank = (lambda _: F.lit(None).cast("string"))
    stamp = (lambda c: F.col(c).cast("timestamp_ntz"))
    return _project(pre_post, [
        ("netsuiteId", "customer_id", int_key), ("salesOrderId", "sales_order_id", _same),
        ("orderStatus", "order_status", _same), ("createdAt", "created_on", stamp),
        ("monthsToOrSinceEnrollment", "months", _same), ("grossSales", "gross_sales", _same),
        ("finalPrice", "final_price", _same), ("skus", "skus", _same),
        ("quantity", "pieces", rounded_long), ("rank", "recency", _same),
        ("treshold", "stage", _same), ("comparable", "", blank), ("type", "type", _same),
        ("creditEnrolledAt", "enrolled_at", stamp),
        ("enrollment_cohort", "enrollment_cohort", _same),
        ("maxMonthPostCredit", "max_month_post", _same),
        ("validMonth", "", lambda _: F.lit(1).cast("bigint")), ("externalId", "", blank),
        ("ruta", "route", _same), ("supervisor", "supervisor", _same), ("oficina", "office", _same),
        ("tipo", "customer_type", _same)])


def published_seasonality(pairs: DataFrame) -> DataFrame:
    return _project(pairs, [
        ("fromMonth", "from_month", _text), ("toMonth", "to_month", _text),
        ("fromMonthAvgGrossSales", "from_ticket", _same),
        ("fromcAvgMonthlyVolume", "from_volume", _same),
        ("toMonthAvgGrossSales", "to_ticket", _same), ("toAvgMonthlyVolume", "to_volume", _same),
        ("seasonalityDeltaTicket", "ticket_ratio", _same),
        ("seasonalityDeltaTicketRate", "ticket_delta", _same),
        ("seasonalityDeltaVolume", "volume_ratio", _same),
        ("seasonalityDeltaVolumeRate", "volume_delta", _same)])


def published_odds(odds: DataFrame) -> DataFrame:
    # Fixed value: the name of the attribute.
    attribute = (lambda _: F.lit("distanceBetweenOnboardingAndShopLocation"))
    return _project(odds, [
        ("loanDisbursementIndexRange", "loan_range", _same), ("flag", "flag", _same),
        ("attribute", "", attribute), ("bin", "bin", _text), ("min_value", "min_value", _text),
        ("max_value", "max_value", _text), ("events", "events", _same), ("good", "good", _same),
        ("bad", "bad", _same), ("bad_rate", "bad_rate", _same), ("%good", "pct_good", _same),
        ("%bad", "pct_bad", _same), ("woe", "woe", _same), ("iv", "iv", _same)])


def published_pair_odds(pairs: DataFrame) -> DataFrame:
    """Works on the recomputed pairs; the loaded file has the same columns."""
    return _project(pairs, [
        ("loanDisbursementIndexRange", "loan_range", _same), ("flag", "flag", _same),
        ("atr1", "atr1", _same), ("atr2", "atr2", _same), ("atr1Rank", "atr1_rank", _same),
        ("atr2Rank", "atr2_rank", _same), ("events", "events", _same), ("good", "good", _same),
        ("bad", "bad", _same), ("bad_rate", "bad_rate", _same), ("%good", "pct_good", _same),
        ("%bad", "pct_bad", _same), ("woe", "woe", _same), ("iv", "iv", _same)])


def published_service_profile(df: DataFrame) -> DataFrame:
    return df.select(F.col("id_cliente").alias("Id cliente"),
                     F.col("transactional_profile").alias("transactionalProfile"))


def published_cac(df: DataFrame) -> DataFrame:
    return df.select(F.col("enrollment_cohort").alias("enrollmentCohort"), "cac")


def published_contest(contest: DataFrame) -> DataFrame:
    return _project(contest, [
        ("netsuiteId", "customer_id", _same), ("netsuiteIdNum", "customer_key", _same),
        ("salesOrderId", "sales_order_id", _same), ("tienda", "shop_name", _same),
        ("municipio", "shop_town", _same), ("estado", "shop_state", _same),
        ("fechaAprobacionCredito", "enrolled_at", _date),
        ("cohorteEnrolamiento", "enrollment_cohort", _same),
        ("canalEnrolamiento", "enrollment_channel", _same),
        ("fechaCreacion", "created_at", _date), ("createdAt", "created_at", _same),
        ("fechaEntrega", "delivered_at", _date), ("periodo", "period", _same),
        ("enVigencia", "in_contest", _same), ("diaVentana", "day_in_window", _same),
        ("aliado", "route", _same), ("supervisor", "supervisor", _same),
        ("oficina", "office", _same), ("region", "region", _same), ("tipo", "customer_type", _same),
        ("rutaInferida", "route_inferred", _same), ("aliadoActual", "current_route", _same),
        ("supervisorActual", "current_supervisor", _same),
        ("oficinaActual", "current_office", _same), ("regionActual", "current_region", _same),
        ("tipoActual", "current_customer_type", _same), ("estatusOrden", "order_status", _same),
        ("estatusEntrega", "delivery_status", _same), ("esEntregada", "is_delivered", _same),
        ("esVigente", "is_active", _same), ("esCancelada", "is_cancelled", _same),
        ("esRechazada", "is_rejected", _same), ("montoOrden", "order_gross_sales", _same),
        ("precioTotal", "total_price", _same), ("limiteCredito", "credit_limit", _same),
        ("skus", "skus", _same), ("piezas", "quantity", _same),
        ("indiceOrdenCliente", "attempt_index", _same),
        ("esPrimeraOrdenDelCliente", "is_first_order", _same),
        ("fechaPrimerCreditoUsado", "first_delivered_on", _same),
        ("ordenesEntregadasPrevias", "delivered_before", _same),
        ("ultimaOrdenEntregadaPrevia", "last_delivered_before", _same),
        ("esNuevoEnCredito", "is_new", _same),
        ("esPrimeraOrdenEntregadaEnVentana", "is_first_delivered", _same)])


