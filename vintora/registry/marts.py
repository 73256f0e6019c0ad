"""Queries of the plans: routes, credit, sales, risk, contest and their published forms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.plans import consumers, contest, credit, measures, risk, sales
from vintora.plans.book import Book
from vintora.plans.snapshots import StoredSnapshot
from vintora.registry.core import Query, SnapshotQuery
from vintora.registry.views import AS_OF, DISTANCE, band
from vintora.sources import intake, load

_WEEK = dt.date(2001, 7, 20)


def _week(book: Book) -> Book:
    return Book(book.source, book.terms.at(as_of=_WEEK))


def _staged(book: Book) -> Book:
    """The same book over tables that were loaded into a scratch staging area first."""
    spark = book.source.spark
    staging = intake.Staging(spark, load.scratch(spark, "staging"))
    sources = {r.table: getattr(book.source, r.table) for r in intake.RULES
               if hasattr(book.source, r.table)}
    intake.load_all(staging, sources, book.terms, full=True)
    return Book(staging, book.terms)


def _late_payments(book: Book) -> DataFrame:
    """The stored snapshot of a day on which one payment in eleven of loans due from 1997 on, and
    one such loan in thirteen, had not arrived; then brought up to date."""
    spark = book.source.spark
    stored = load.VersionedTable(spark, load.scratch(spark, "loans"))
    stored.replace(book.loans)
    loans = stored.read()
    recent = F.col("due_month_end") >= dt.date(1997, 1, 1)
    chance = F.crc32(F.col("sales_order_id").cast("binary"))
    missing = recent & (chance % 13 == 0)
    before = loans.filter(~F.coalesce(missing, F.lit(False))).withColumns({
        c: F.when(~(recent & (chance % 11 == 0)), F.col(c))
        for c in ("paid_at", "payment_at", "movement_at")})
    snapshot = StoredSnapshot(spark, load.scratch(spark, "snapshot"), book.snapshot.schema)
    snapshot.refresh(before)
    snapshot.refresh(loans)
    return snapshot.read()


ORDER = """customer_id sales_order_id order_id order_status delivery_status sales_channel
    created_ms:i created_at:t order_gross_sales:m total_price:m credit_limit:m skus:i quantity:m
    delivery_at:t delivered_at:t attempt_index:i completed_index:i enrolled_at:t enrollment_cohort
    enrollment_channel enrolled_customers:i cohort_credit_limit:m activated_at:t activated_cohort
    months_since_enrollment:i months_since_activation:i created_month route supervisor office
    region customer_type route_inferred"""
LOAN = """customer_id sales_order_id order_id order_status created_at:t delivery_at:t
    order_gross_sales:m quantity:m credit_limit:m enrolled_at:t enrollment_cohort
    enrolled_customers:i cohort_credit_limit:m months_since_enrollment:i route supervisor office
    region customer_type route_inferred rank:i transaction_id transaction_status total_amount:m
    total_to_pay:m total_default:m interests:m interests_reported:m commission_due:m movement_at:t
    payment_at:t paid_at:t mirror_amount_paid:m mirror_status due_on:t due_month_end:t month
    paid_on_month:i days_past_due:i days_past_due_month_end:i penalty_interest:m total_revenue:m
    revenue_share:m par"""
SNAPSHOT = """customer_id sales_order_id order_status created_at:t delivery_at:t
    order_gross_sales:m enrolled_at:t enrollment_cohort enrolled_customers:i transaction_id
    total_to_pay:m interests:m total_default:m movement_at:t payment_at:t paid_at:t due_on:t
    due_month_end:t cutoff:t previous_month_end:t original_amount:m total_amount:m days_past_due:i
    par months_on_book:i month"""
VINTAGE = """enrollment_cohort cohort_year months_on_book:i label ever_activated:i
    enrolled_customers:i orders:i deployed_capital:m outstanding_balance:m par30:m par60:m par90:m
    par30_n:i par60_n:i par90_n:i par30_rate:r par60_rate:r par90_rate:r par30_customers_rate:r
    par60_customers_rate:r par90_customers_rate:r"""
GRID = """document_id shopkeeper_id shop_name route supervisor office region customer_type
    structure_status business_category shop_neighborhood shop_zip shop_town shop_state
    shop_latitude:r shop_longitude:r customer_name customer_last_names gender birthdate:t age:i
    age_at_eligibility:i age_at_enrollment:i phone customer_latitude:r customer_longitude:r
    has_marketplace has_presales eligible_at:t pre_authorized_by original_limit:m current_limit:m
    available_limit:m customer_status credit_limit:m enrolled_at:t is_enrolled:i enrollment_cohort
    enrollment_channel activated_at:t is_activated:i activated_cohort activated_limit:m
    first_order_at:t last_order_at:t orders_count:i completed_orders:i rejected_orders:i
    cancelled_orders:i avg_order_volume:m total_order_volume:m completed_volume:m
    first_order_gross:m order_frequency:r due_orders:i payments_count:i avg_revenue:m
    avg_revenue_share:m revenue:m revenue_share:m is_active:i"""
DAILY = """date:t week_start:t week_end:t month_end:t year_end:t created_orders:i
    completed_by_created:i completed_volume_by_created:m completed_by_delivered:i
    completed_volume_by_delivered:m expected_deliveries:i rejected_orders:i keyword_rejections:i
    payments:i payments_volume:m interest_collected:m revenue_share:m enrollments:i activations:i
    cumulative_created_orders:i cumulative_completed_by_created:i
    cumulative_completed_by_delivered:i cumulative_completed_volume_by_created:m
    cumulative_completed_volume_by_delivered:m cumulative_expected_deliveries:i
    cumulative_rejected_orders:i cumulative_keyword_rejections:i cumulative_revenue_share:m
    rejected_rate:r keyword_rate:r cumulative_rejected_rate:r cumulative_keyword_rate:r"""
PROFILE = """row_id:i customer_key:i sales_order_id order_id created_at:t due_on:t paid_at:t
    total_amount:m total_to_pay:m days_past_due:i rank:i loan_range flag_15:i flag_30:i
    eligible_at:t route business_category zip_code:i shop_town shop_state shop_latitude:r
    shop_longitude:r customer_name gender birthdate:t age:i age_at_eligibility:i
    customer_latitude:r customer_longitude:r distance:r gross_3m:m orders_3m:i avg_ticket_3m:i
    gross_6m:m orders_6m:i gross_field_after:m orders_field_after:i gross_other_after:m
    orders_other_after:i"""
CONTEST = """customer_id customer_key:i sales_order_id shop_name shop_town shop_state enrolled_at:t
    enrollment_cohort enrollment_channel created_at:t delivered_at:t period in_contest
    day_in_window:i route supervisor office region customer_type route_inferred current_route
    current_supervisor current_office current_region current_customer_type order_status
    delivery_status is_delivered is_active is_cancelled is_rejected order_gross_sales:m
    total_price:m credit_limit:m skus:i quantity:m attempt_index:i is_first_order
    first_delivered_on:t delivered_before:i last_delivered_before:t is_new is_first_delivered"""
PRE_POST = """customer_id sales_order_id order_status created_on:t months:i gross_sales:m
    final_price:m skus:i pieces:m recency:i stage type enrolled_at:t enrollment_cohort
    max_month_post:i route supervisor office customer_type"""
PANEL = """month:t first_month:t credit_flag first_credit:t period:i cohort_customers:i active:i
    orders:i gross:m orders_base:i gross_base:m"""
EVIDENCE = "events:i good:i bad:i bad_rate:r pct_good:r pct_bad:r woe:r iv:r"
SPAN = """customer_id route supervisor office region customer_type status valid_from:t valid_to:t
    seen_from:t seen_to:t days:i tranche:i"""
CUT = """cut_on:t window_from:t customer_id route supervisor office region customer_type
    sales_order_id order_id created_at:t delivery_at:t order_status sales_channel"""

# Published snapshot columns, as (published, source) for the check.
_SNAP_SQL = """SELECT CAST(trim(customer_id) AS BIGINT) AS "netsuiteId",
    sales_order_id AS "salesOrderId", order_status AS "orderStatus",
    CAST(created_at AS DATE) AS "createdAt", order_gross_sales AS "orderGrossSales",
    quantity AS "quantity", CAST(enrolled_at AS DATE) AS "creditEnrolledAt",
    CAST(enrollment_cohort || '-01' AS DATE) AS "enrollment_cohort",
    enrolled_customers AS "EnrolledCustomers", months_since_enrollment AS "monthsSinceEnrollment",
    rank AS "rank", total_amount AS "totalAmount", CAST(paid_at AS DATE) AS "paidDate",
    due_on AS "expectedPaymentDate", cutoff AS "corte", days_past_due AS "daysPastDue",
    par AS "{par}", {month} AS "month", route AS "ruta", customer_type AS "tipo" FROM snap"""
_SNAP = """netsuiteId:i salesOrderId orderStatus createdAt:t orderGrossSales:m quantity:i
    creditEnrolledAt:t enrollment_cohort:t EnrolledCustomers:i monthsSinceEnrollment:i rank:i
    totalAmount:m paidDate:t expectedPaymentDate:t corte:t daysPastDue:i {par} {month} ruta tipo"""

QUERIES = [
    Query("m01_dim_route_current", lambda b: b.routes,
          "customer_id route supervisor office region customer_type status", "routes"),
    Query("m02_dim_route_scd", lambda b: b.spans, SPAN, "spans"),
    Query("m03_route_scd", lambda b: b.tranches,
          "customer_id route supervisor office region customer_type status valid_from:t valid_to:t"
          " days:i", "tranches"),
    Query("m04_grouped_orders", lambda b: b.orders, ORDER, "gorders"),
    Query("m05_loss_rates", lambda b: b.loans, LOAN, "loans"),
    SnapshotQuery("m06_par_snapshot", lambda b: b.snapshot, SNAPSHOT, "snap"),
    Query("m06_late_payments", _late_payments, SNAPSHOT, "snap"),
    Query("m07_vintage_analysis", lambda b: b.vintage, VINTAGE, "vint"),
    Query("staged_vintage", lambda b: _staged(b).vintage, VINTAGE, "vint"),
    Query("staged_history", lambda b: _staged(b).history,
          "customer_id sales_order_id created_on:t amount:m", "hist"),
    Query("m08_customer_grid", lambda b: b.grid, "customer_id " + GRID, "grid"),
    Query("m09_kpis_daily", lambda b: b.daily, DAILY, "daily"),
    Query("m10_revenue_commission", lambda b: b.revenue,
          "customer_id sales_order_id transaction_id created_at:t due_on:t paid_at:t month par"
          " enrollment_cohort financed:m to_pay:m interests:m interests_reported:m"
          " commission_due:m spread:m penalty_interest:m total_default:m collected:i"
          " total_revenue:m revenue_share:m revenue_share_untaxed:m amount_commission:m",
          """SELECT * EXCLUDE (month), rmonth AS month, total_amount AS financed,
             total_to_pay AS to_pay FROM rev"""),
    Query("m11_weekly_cut_lines", lambda b: _week(b).cut_lines,
          CUT + " product_id category brand quantity:m total_price:m order_gross_sales:m", "cut"),
    Query("m12_weekly_cut_orders", lambda b: _week(b).cut_orders,
          CUT + " order_gross_sales:m total_price:m skus:i quantity:m",
          """SELECT cut_on, window_from, customer_id, route, supervisor, office, region,
             customer_type, sales_order_id, order_id, order_status, sales_channel,
             max(created_at) AS created_at, max(delivery_at) AS delivery_at,
             max(order_gross_sales) AS order_gross_sales, max(total_price) AS total_price,
             count(DISTINCT product_id) AS skus, sum(quantity) AS quantity FROM cut
             GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12"""),
    Query("m13_customer_sales_history", lambda b: b.history,
          "customer_id sales_order_id created_on:t channel order_status skus:i pieces:m amount:m",
          "hist"),
    Query("m14_cohort_panel", lambda b: b.panel, PANEL, "panel"),
    Query("m15_seasonality_month", lambda b: b.season,
          "calendar_month:i avg_ticket:m avg_volume:m", "season"),
    Query("m15_seasonality_pairs", lambda b: sales.seasonality_pairs(b.season),
          "from_month:i to_month:i from_ticket:m from_volume:m to_ticket:m to_volume:m"
          " ticket_ratio:r ticket_delta:r volume_ratio:r volume_delta:r", "spairs"),
    Query("m16_lifecycle_audience", lambda b: b.lifecycle,
          "month:t state gross_sales:m customers:i orders:i", "life"),
    Query("m17_matured_loans_profile", lambda b: b.profile, PROFILE, "profile"),
    Query("m18_pre_post_sales", lambda b: b.pre_post, PRE_POST, "pp"),
    Query("m19_woe_table", lambda b: b.odds,
          "loan_range flag bin:i min_value:r max_value:r " + EVIDENCE, "odds"),
    Query("m20_information_value", lambda b: risk.information_value(b.odds, ["loan_range", "flag"]),
          "loan_range flag iv:r",
          "SELECT loan_range, flag, sum(iv) AS iv FROM odds GROUP BY 1, 2"),
    Query("m21_pair_odds", lambda b: b.pairs,
          "loan_range flag atr1 atr2 atr1_rank atr2_rank " + EVIDENCE, "pairs"),
    Query("m21_pair_iv", lambda b: risk.pair_iv(b.pairs),
          "loan_range flag combination number_of_combinations:i iv:r",
          """SELECT loan_range, flag, atr1 || '_' || atr2 AS combination,
             count(*) AS number_of_combinations, sum(iv) AS iv FROM pairs GROUP BY 1, 2, 3"""),
    Query("m22_service_profile", lambda b: consumers.published_service_profile(
        b.source.service_profile).withColumnsRenamed(
        {"Id cliente": "customer", "transactionalProfile": "profile"}),
          "customer:i profile",
          """SELECT c_custkey AS customer, CASE c_custkey % 3 WHEN 0 THEN '01-Healthy'
             WHEN 1 THEN '02-Mixed' ELSE '03-Mostly Fraud' END AS profile
             FROM customer WHERE c_custkey % 2 = 1"""),
    Query("m22_cohort_cac", lambda b: consumers.published_cac(b.source.cohort_cac),
          "enrollmentCohort cac:m",
          """SELECT strftime(o_orderdate, '%Y-%m') AS "enrollmentCohort",
             count(DISTINCT o_custkey) / 2 AS cac FROM orders GROUP BY 1"""),
    Query("m23_contest_base", lambda b: b.contest, CONTEST, "contest"),
    Query("m24_contest_settled", lambda b: contest.settled(b.contest, b.loan_core),
          "customer_id sales_order_id period is_settled settled_at:t",
          """SELECT c.customer_id, c.sales_order_id, period, l.paid_at IS NOT NULL AS is_settled,
             l.paid_at AS settled_at FROM contest c LEFT JOIN loans l USING (sales_order_id)"""),
    Query("m25_contest_customers", lambda b: contest.contest_customers(b.source.contest_customers),
          "netsuiteId netsuiteIdNum:i clasificacion lineaNueva:m aliado supervisor oficina",
          """SELECT CAST(c_custkey AS VARCHAR) AS "netsuiteId", c_custkey AS "netsuiteIdNum",
             c_mktsegment AS clasificacion, c_acctbal + 2000 AS "lineaNueva",
             'R' || c_custkey % 9 AS aliado, 'S' || c_custkey % 9 AS supervisor,
             'O' || c_custkey % 3 AS oficina FROM customer WHERE c_custkey % 3 = 1"""),
    Query("m26_sales_by_customer_month_channel", lambda b: b.monthly_channels,
          "customer_id month:t channel orders:i gross_sales:m pieces:m",
          """WITH o AS (SELECT customer_id, sales_order_id,
                 CAST(date_trunc('month', created_on) AS DATE) AS month, channel,
                 sum(amount) AS amount, sum(pieces) AS pieces FROM slines
                 WHERE created_on >= DATE '1999-01-01' GROUP BY 1, 2, 3, 4
                 HAVING sum(pieces) <> 0 OR sum(amount) <> 0)
             SELECT customer_id, month, channel, count(DISTINCT sales_order_id) AS orders,
             sum(amount) AS gross_sales, sum(pieces) AS pieces FROM o GROUP BY 1, 2, 3"""),

    # -- published forms
    Query("m27_orders", lambda b: consumers.published_orders(b.orders, b.routes),
          "netsuiteId salesOrderId orderId orderStatus deliveryStatus salesChannel"
          " createdAtTimestamp:i createdAt:t orderGrossSales:m totalPrice:m creditLimit:m skus:i"
          " quantity:i deliveryAt:t deliveryDate:t customerOrderTryIndex:i"
          " customerCompletedOrderIndex:i creditEnrolledAt:t enrollment_cohort EnrolledCustomers:i"
          " enrolledCreditLimit:m creditActivatedAt:t activatedCohort monthsSinceEnrollment:i"
          " monthsSinceActivation:i monthCreatedAt ruta supervisor oficina tipo tipoActual",
          """SELECT o.customer_id AS "netsuiteId", sales_order_id AS "salesOrderId",
             order_id AS "orderId", order_status AS "orderStatus",
             delivery_status AS "deliveryStatus", sales_channel AS "salesChannel",
             created_ms AS "createdAtTimestamp", CAST(created_at AS DATE) AS "createdAt",
             order_gross_sales AS "orderGrossSales", total_price AS "totalPrice",
             credit_limit AS "creditLimit", skus, quantity, CAST(delivery_at AS DATE) AS
             "deliveryAt", CAST(delivered_at AS DATE) AS "deliveryDate",
             attempt_index AS "customerOrderTryIndex", completed_index AS
             "customerCompletedOrderIndex", CAST(enrolled_at AS DATE) AS "creditEnrolledAt",
             enrollment_cohort, enrolled_customers AS "EnrolledCustomers",
             cohort_credit_limit AS "enrolledCreditLimit", CAST(activated_at AS DATE) AS
             "creditActivatedAt", activated_cohort AS "activatedCohort", months_since_enrollment AS
             "monthsSinceEnrollment", months_since_activation AS "monthsSinceActivation",
             created_month AS "monthCreatedAt", o.route AS ruta, o.supervisor, o.office AS oficina,
             o.customer_type AS tipo, r.customer_type AS "tipoActual"
             FROM gorders o LEFT JOIN routes r ON o.customer_id = r.customer_id"""),
    SnapshotQuery("m27_par", lambda b: consumers.published_snapshot(b.snapshot),
                  _SNAP.format(par="PAR", month="month"),
                  _SNAP_SQL.format(par="PAR", month="month"), consumers.PAR),
    SnapshotQuery("m27_month_closes", lambda b: consumers.published_closes(b.snapshot),
                  _SNAP.format(par="dqBucket", month="month:t"),
                  _SNAP_SQL.format(par="dqBucket",
                                   month="CAST(date_trunc('month', cutoff) AS DATE)"),
                  consumers.CLOSES),
    Query("m27_lifecycle", lambda b: consumers.published_lifecycle(b.lifecycle).withColumnRenamed(
        "Gross Sales", "Gross_Sales"),
          "createdAtMonth:t tipoActual Gross_Sales:m Clientes:i ordenes:i",
          """SELECT CAST(month AS TIMESTAMP) AS "createdAtMonth", state AS "tipoActual",
             gross_sales AS "Gross_Sales", customers AS "Clientes", orders AS ordenes FROM life"""),
    Query("m27_cohort_panel", lambda b: consumers.published_panel(b.panel).withColumnRenamed(
        "periodo.", "periodo"),
          "mes_tx:t mes_ft_tx:t mes_ft_tx_credit:t flg_cte_credit periodo:i clientes_cosecha:i"
          " cliente_activo:i ordenes:i gross_sales:m ordenes_ft:i gross_sales_ft:m",
          """SELECT month AS mes_tx, CAST(first_month AS TIMESTAMP) AS mes_ft_tx,
             CAST(first_credit AS TIMESTAMP) AS mes_ft_tx_credit, credit_flag AS flg_cte_credit,
             period AS periodo, cohort_customers AS clientes_cosecha, active AS cliente_activo,
             orders AS ordenes, gross AS gross_sales, orders_base AS ordenes_ft,
             gross_base AS gross_sales_ft FROM panel"""),
    Query("m27_pair_odds", lambda b: consumers.published_pair_odds(b.pairs).withColumnsRenamed(
        {"%good": "pct_good", "%bad": "pct_bad"}),
          "loanDisbursementIndexRange flag atr1 atr2 atr1Rank atr2Rank events:i good:i bad:i"
          " bad_rate:r pct_good:r pct_bad:r woe:r iv:r",
          """SELECT loan_range AS "loanDisbursementIndexRange", flag, atr1, atr2,
             atr1_rank AS "atr1Rank", atr2_rank AS "atr2Rank", events, good, bad, bad_rate,
             pct_good, pct_bad, woe, iv FROM pairs"""),
]

# -- measures --------------------------------------------------------------

_ENROLLED = """(SELECT enrollment_cohort, count(DISTINCT customer_id) AS enrolled
    FROM enrolled JOIN cust USING (customer_id) GROUP BY 1)"""


def _pairs(book: Book):
    return sales.seasonality_pairs(book.season)


def _leads(book: Book):
    return measures.stage_leads(measures.stage_walk(book.loan_core, book.terms))


_MARGIN = """SELECT {level} AS level, {keys}, avg(active) AS active,
    avg(transactions) AS transactions, avg(gross_sales) AS gross_sales,
    avg(orders_per_customer) AS orders_per_customer,
    avg(gross_per_customer) AS gross_per_customer FROM c {group}"""
_C, _M = "enrollment_cohort", "months_since_enrollment"
_NO_C, _NO_M = f"CAST(NULL AS VARCHAR) AS {_C}", f"CAST(NULL AS BIGINT) AS {_M}"
_FUNNEL = ", ".join(f"count(*) FILTER (WHERE orders_count >= {n}) AS at_least_{n}"
                    for n in measures.FUNNEL_STEPS)
_RATES = ", ".join(
    [f"sum(par{d}) / nullif(sum(deployed_capital), 0) AS par{d}_by_capital" for d in (30, 60, 90)]
    + [f"sum(par{d}_n) / nullif(sum(ever_activated), 0) AS par{d}_by_customers"
       for d in (30, 60, 90)]
    + ["sum(par30) / nullif(sum(outstanding_balance), 0) AS par30_by_balance"])
_UP = ", ".join(
    f"""(sum({a}) FILTER (WHERE credit_flag = 'Y' AND month >= cut)
        / sum({b}) FILTER (WHERE credit_flag = 'Y' AND month >= cut))
     / (sum({a}) FILTER (WHERE credit_flag = 'N' AND month >= cut)
        / sum({b}) FILTER (WHERE credit_flag = 'N' AND month >= cut))
     / ((sum({a}) FILTER (WHERE credit_flag = 'Y' AND month < cut)
        / sum({b}) FILTER (WHERE credit_flag = 'Y' AND month < cut))
     / (sum({a}) FILTER (WHERE credit_flag = 'N' AND month < cut)
        / sum({b}) FILTER (WHERE credit_flag = 'N' AND month < cut))) - 1 AS {n}_uplift"""
    for n, a, b in (("drop_size", "gross", "orders"), ("frequency", "orders", "active"),
                    ("survival", "active", "cohort_customers")))

QUERIES += [
    Query("d01_cohort_survival", lambda b: measures.survival(b.orders, b.members),
          f"{_C} {_M}:i delivery_status active:i enrolled:i survival:r",
          f"""SELECT c.*, enrolled, active / enrolled AS survival FROM (
              SELECT {_C}, {_M}, delivery_status, count(DISTINCT customer_id) AS active
              FROM gorders WHERE {_C} IS NOT NULL GROUP BY 1, 2, 3) c
              LEFT JOIN {_ENROLLED} e USING ({_C})"""),
    Query("d01_active_margins", lambda b: measures.active_margins(b.orders),
          "level enrollment_cohort months_since_enrollment:i delivery_status distinct:i",
          """WITH o AS (SELECT * FROM gorders WHERE enrollment_cohort IS NOT NULL
                 AND customer_id IS NOT NULL),
             g AS (SELECT enrollment_cohort, months_since_enrollment, delivery_status,
                 grouping(enrollment_cohort, months_since_enrollment, delivery_status) AS kind,
                 count(DISTINCT customer_id) AS "distinct" FROM o
                 GROUP BY GROUPING SETS ((enrollment_cohort, months_since_enrollment, delivery_status),
                     (enrollment_cohort, months_since_enrollment), (enrollment_cohort, delivery_status),
                     (enrollment_cohort), (months_since_enrollment), (delivery_status), ()))
             SELECT CASE kind WHEN 0 THEN 'cell' WHEN 1 THEN 'cohort and month'
                 WHEN 2 THEN 'cohort and status' WHEN 3 THEN 'cohort' WHEN 5 THEN 'month'
                 WHEN 6 THEN 'status' ELSE 'total' END AS level, enrollment_cohort,
             months_since_enrollment, delivery_status, "distinct" FROM g"""),
    Query("d02_weighted_survival", lambda b: measures.weighted_survival(b.orders, b.members),
          f"{_C} {_M}:i active:i enrolled:i survival:r",
          f"""WITH c AS (SELECT c.*, enrolled, active / enrolled AS survival FROM (
                  SELECT {_C}, {_M}, count(DISTINCT customer_id) AS active
                  FROM gorders WHERE {_C} IS NOT NULL GROUP BY 1, 2) c
                  LEFT JOIN {_ENROLLED} e USING ({_C}))
              SELECT {_C}, {_M}, active, enrolled, survival FROM c
              UNION ALL SELECT 'WAVG', {_M}, sum(active), sum(enrolled),
              sum(survival * enrolled) / sum(enrolled) FROM c GROUP BY 2"""),
    Query("d03_cohort_frequency", lambda b: measures.cohort_frequency(b.orders),
          f"{_C} orders:i customers:i amount:m frequency:r drop_size:m",
          f"""WITH c AS (SELECT {_C}, count(DISTINCT sales_order_id) AS orders,
                  count(DISTINCT customer_id) AS customers, sum(total_price) AS amount
                  FROM gorders WHERE {_C} IS NOT NULL GROUP BY 1),
              u AS (SELECT * FROM c UNION ALL SELECT 'WAVG', sum(orders), sum(customers),
                  sum(amount) FROM c)
              SELECT *, orders / customers AS frequency, amount / orders AS drop_size FROM u"""),
    Query("d04_order_basics", lambda b: measures.order_basics(b.orders, ["created_month"]),
          "created_month customers:i orders:i transactions:i gross_sales:m avg_ticket:r avg_skus:r"
          " avg_items:r frequency:r avg_monthly_sale:r limit_penetration:r",
          """SELECT created_month, count(DISTINCT customer_id) AS customers,
             count(DISTINCT sales_order_id) AS orders, count(customer_id) AS transactions,
             sum(order_gross_sales) AS gross_sales,
             sum(order_gross_sales) / count(DISTINCT sales_order_id) AS avg_ticket,
             sum(skus) / count(DISTINCT sales_order_id) AS avg_skus,
             sum(quantity) / count(DISTINCT sales_order_id) AS avg_items,
             count(sales_order_id) / count(DISTINCT customer_id) AS frequency,
             sum(order_gross_sales) / count(DISTINCT customer_id) AS avg_monthly_sale,
             sum(order_gross_sales) / sum(credit_limit) AS limit_penetration
             FROM gorders GROUP BY 1"""),
    Query("d05_active_over_enrolled", lambda b: measures.active_over_enrolled(b.orders, b.members),
          "month active:i cumulative_enrolled:i active_rate:r",
          """WITH m AS (SELECT created_month AS month, count(DISTINCT customer_id) AS active,
                 max(CAST(created_at AS DATE)) AS day FROM gorders GROUP BY 1)
             SELECT month, active, n AS cumulative_enrolled, active / nullif(n, 0) AS active_rate
             FROM (SELECT m.*, (SELECT count(DISTINCT customer_id) FROM enrolled
                       JOIN cust USING (customer_id)
                       WHERE CAST(enrolled_at AS DATE) <= m.day) AS n FROM m)"""),
    Query("d06_revenue", lambda b: measures.revenue_by_month(b.loan_core, b.terms),
          "month share_before_tax:m share_after_tax:m total_before_tax:m total_after_tax:m",
          """SELECT month, sum(revenue_share) AS share_before_tax,
             sum(revenue_share) / 1.16 AS share_after_tax, sum(total_revenue) AS total_before_tax,
             sum(total_revenue) / 1.16 AS total_after_tax FROM loans GROUP BY 1"""),
    Query("d07_loan_details", lambda b: measures.loan_details(
        b.loans, b.grid, b.source.cohort_cac, _pairs(b), b.terms),
          "customer_id sales_order_id enrollment_month:i share_of_interest:m bucket_order:i"
          " matured_amount:m loan_index age_band first_order_gross:m months_text volume_ratio:r"
          " cac:m clean_interest:m paid_amount:m loss_amount:m",
          f"""SELECT l.customer_id, l.sales_order_id,
              CAST(substr(l.enrollment_cohort, 6, 2) AS INTEGER) AS enrollment_month,
              interests * 0.142 AS share_of_interest,
              CASE par WHEN 'Paid' THEN 1 WHEN 'Ongoing' THEN 2 WHEN 'DQ 1-6' THEN 3
                  WHEN 'DQ 7-14' THEN 4 WHEN 'DQ 15-29' THEN 5 WHEN 'DQ 30-59' THEN 6
                  WHEN 'DQ 60-89' THEN 7 WHEN 'DQ 90+' THEN 8 END AS bucket_order,
              CASE WHEN par = 'Ongoing' THEN 0 ELSE total_amount END AS matured_amount,
              CASE WHEN rank <= 3 THEN CAST(rank AS VARCHAR) WHEN rank >= 4 THEN '4+' END
                  AS loan_index,
              {band('g.age_at_eligibility')} AS age_band, f.g1 AS first_order_gross,
              lpad(CAST(months_since_enrollment AS VARCHAR), 2, '0') AS months_text, volume_ratio,
              cac, total_to_pay - total_amount AS clean_interest,
              CASE WHEN par = 'Paid' THEN total_amount ELSE 0 END AS paid_amount,
              CASE WHEN par IN ('DQ 15-29', 'DQ 30-59', 'DQ 60-89', 'DQ 90+') THEN total_amount
                  ELSE 0 END AS loss_amount
              FROM loans l LEFT JOIN grid g ON l.customer_id = g.customer_id
              LEFT JOIN (SELECT customer_id, max(order_gross_sales) AS g1 FROM loans
                         WHERE rank = 1 GROUP BY 1) f ON l.customer_id = f.customer_id
              LEFT JOIN (SELECT strftime(o_orderdate, '%Y-%m') AS cohort,
                         count(DISTINCT o_custkey) / 2 AS cac FROM orders GROUP BY 1) k
                  ON k.cohort = l.enrollment_cohort
              LEFT JOIN spairs s ON s.to_month = l.months_since_enrollment
                  AND s.from_month = CAST(substr(l.enrollment_cohort, 6, 2) AS INTEGER)"""),
    Query("d08_stage_walk", lambda b: measures.stage_walk(b.loan_core, b.terms),
          "customer_id sales_order_id loan_index delivery_on:t total_amount:m step:i stage",
          "walk"),
    Query("d09_roll_rates", lambda b: measures.roll_rates(_leads(b)),
          "stage lead_stage loans:i amount:m stage_order:i lead_order:i",
          """SELECT stage, lead_stage, count(*) AS loans, sum(total_amount) AS amount,
             CASE stage WHEN 'Ongoing' THEN 1 WHEN 'DQ 1-6' THEN 2 WHEN 'DQ 7-14' THEN 3
                 WHEN 'DQ 15-29' THEN 4 WHEN 'DQ 30-59' THEN 5 WHEN 'DQ 60-89' THEN 6
                 WHEN 'DQ 90+' THEN 7 WHEN 'Paid' THEN 8 END AS stage_order,
             CASE lead_stage WHEN 'DQ 1-6' THEN 1 WHEN 'DQ 7-14' THEN 2 WHEN 'DQ 15-29' THEN 3
                 WHEN 'DQ 30-59' THEN 4 WHEN 'DQ 60-89' THEN 5 WHEN 'DQ 90+' THEN 6
                 WHEN 'Paid' THEN 7 END AS lead_order
             FROM leads GROUP BY 1, 2"""),
    Query("d10_charge_off", lambda b: measures.charge_off(_leads(b)),
          "customers:i disbursed:i paid:i amount_disbursed:m amount_leading:m amount_paid:m"
          " by_count:r by_amount:r by_amount_same_loans:r",
          """SELECT *, 1 - paid / disbursed AS by_count,
             1 - amount_leading / amount_disbursed AS by_amount,
             1 - amount_paid / amount_disbursed AS by_amount_same_loans FROM (
             SELECT count(DISTINCT customer_id) AS customers,
             count(DISTINCT sales_order_id) AS disbursed,
             count(DISTINCT sales_order_id) FILTER (WHERE stage = 'Paid') AS paid,
             sum(total_amount) FILTER (WHERE stage = 'Ongoing') AS amount_disbursed,
             sum(total_amount) FILTER (WHERE lead_stage = 'Paid') AS amount_leading,
             sum(total_amount) FILTER (WHERE stage = 'Paid') AS amount_paid FROM leads)"""),
    Query("d11_vintage_rates", lambda b: measures.vintage_rates(b.vintage),
          "level months_on_book:i par30_by_capital:r par60_by_capital:r par90_by_capital:r"
          " par30_by_customers:r par60_by_customers:r par90_by_customers:r par30_by_balance:r",
          f"""SELECT 'month' AS level, months_on_book, {_RATES} FROM vint GROUP BY 2
              UNION ALL SELECT 'total', NULL, {_RATES} FROM vint"""),
    Query("d12_close_shares", lambda b: measures.close_shares(b.snapshot),
          "cutoff:t bucket rows:i balance:m cutoff_balance:m share:r bucket_order:i",
          """WITH c AS (SELECT cutoff, CASE WHEN days_past_due >= 120 THEN 'Written Off' ELSE par
                 END AS bucket, count(*) AS rows, sum(total_amount) AS balance
                 FROM snap GROUP BY 1, 2)
             SELECT *, sum(balance) OVER (PARTITION BY cutoff) AS cutoff_balance,
             balance / nullif(sum(balance) OVER (PARTITION BY cutoff), 0) AS share,
             CASE bucket WHEN 'PaidPrev' THEN 0 WHEN 'Paid' THEN 1 WHEN 'Ongoing' THEN 2
                 WHEN 'DQ 1-6' THEN 3 WHEN 'DQ 7-14' THEN 4 WHEN 'DQ 15-29' THEN 5
                 WHEN 'DQ 30-59' THEN 6 WHEN 'DQ 60-89' THEN 7 WHEN 'DQ 90+' THEN 8
                 WHEN 'Written Off' THEN 9 END AS bucket_order FROM c"""),
    Query("d13_pre_post_measures", lambda b: measures.pre_post_measures(b.pre_post),
          "stage orders:i customers:i months:i gross_sales:m sales:i max_month_post:i valid_rows:i"
          " frequency:r historical_frequency:r monthly_gross_per_customer:r gross_per_customer:r",
          """WITH x AS (SELECT max(months) AS mx FROM pp WHERE stage = 'post credit')
             SELECT *, orders / customers AS frequency, sales / customers AS historical_frequency,
             gross_sales / months / customers AS monthly_gross_per_customer,
             gross_sales / customers AS gross_per_customer FROM (
             SELECT stage, count(DISTINCT sales_order_id) AS orders,
             count(DISTINCT customer_id) AS customers, count(DISTINCT months) AS months,
             sum(gross_sales) AS gross_sales, count(sales_order_id) AS sales,
             max(mx) AS max_month_post, count(*) FILTER (WHERE months <= mx) AS valid_rows
             FROM pp, x GROUP BY 1)"""),
    Query("d14_pre_post_series", lambda b: measures.pre_post_series(b.pre_post, "1996-01"),
          "enrollment_cohort period stage volume:m orders:i customers:i drop_size:m frequency:r",
          """SELECT *, volume / orders AS drop_size, orders / customers AS frequency FROM (
             SELECT enrollment_cohort, strftime(created_on, '%Y-%m') AS period,
             CASE WHEN strftime(created_on, '%Y-%m') = enrollment_cohort THEN 'post credit'
                 ELSE stage END AS stage, sum(final_price) AS volume,
             count(DISTINCT sales_order_id) AS orders, count(DISTINCT customer_id) AS customers
             FROM pp WHERE strftime(created_on, '%Y-%m') >= '1996-01' GROUP BY 1, 2, 3)"""),
    Query("d15_cohort_rates", lambda b: measures.cohort_rates(b.panel),
          "month:t credit_flag month_index:i gross_variation:r drop_size:r frequency:r survival:r",
          """SELECT month, credit_flag, month_index,
             (gross - gross_base) / nullif(gross_base, 0) AS gross_variation,
             gross / nullif(orders, 0) AS drop_size, orders / nullif(active, 0) AS frequency,
             active / nullif(cohort_customers, 0) AS survival FROM mcells"""),
    Query("d16_trend", lambda b: measures.trend(b.panel),
          "month:t credit_flag month_index:i cut:t ref:t slope:r projected_variation:r variation:r"
          " drop_size:r projected_drop_size:r", "trend"),
    Query("d17_excess_over_trend", lambda b: measures.excess_over_trend(measures.trend(b.panel)),
          "excess:r base:r relative:r",
          """WITH e AS (SELECT month, month_index,
                 max(variation) FILTER (WHERE credit_flag = 'Y') AS v FROM trend
                 WHERE month >= cut GROUP BY 1, 2),
             s AS (SELECT max(slope) AS slope FROM trend WHERE credit_flag = 'Y')
             SELECT *, (excess - base) / base AS relative FROM (
             SELECT sum(v) AS excess, sum(slope * (month_index - 1)) AS base FROM e, s)"""),
    Query("d18_uplift", lambda b: measures.uplift(b.panel),
          "drop_size_uplift:r frequency_uplift:r survival_uplift:r", f"SELECT {_UP} FROM mcells"),
    Query("d19_coverage", lambda b: measures.coverage(b.panel, dt.date(1996, 1, 1)),
          "selected:i customers:i coverage:r",
          """SELECT *, selected / customers AS coverage FROM (SELECT
             sum(active) FILTER (WHERE first_month >= DATE '1996-01-01') AS selected,
             sum(active) AS customers FROM panel WHERE credit_flag = 'Y' AND period = 0)"""),
    Query("d20_fraud_segments", lambda b: risk.fraud_segments(b.matured, b.source.service_profile),
          "customer_key:i sales_order_id flag_15:i bought_later:i fraud_flag service_profile"
          " cross_fraud:i",
          """WITH s AS (SELECT c_custkey AS customer_key, CASE c_custkey % 3 WHEN 0 THEN
                 '01-Healthy' WHEN 1 THEN '02-Mixed' ELSE '03-Mostly Fraud' END AS service_profile
                 FROM customer WHERE c_custkey % 2 = 1),
             f AS (SELECT *, CASE WHEN orders_field_after + orders_other_after >= 1 THEN 1 ELSE 0
                 END AS bought_later FROM profile),
             g AS (SELECT *, CASE WHEN flag_15 = 0 THEN 'Not Defaulted'
                 WHEN paid_at IS NOT NULL THEN 'Defaulted & Recovered'
                 WHEN bought_later = 1 THEN 'Defaulted & Still Active with Other Payment Methods'
                 ELSE 'Potential Fraud' END AS fraud_flag FROM f)
             SELECT g.*, service_profile, CASE WHEN service_profile = '03-Mostly Fraud'
                 AND fraud_flag = 'Potential Fraud' THEN 1 ELSE 0 END AS cross_fraud
             FROM g LEFT JOIN s USING (customer_key)"""),
    Query("d21_customer_months", lambda b: measures.customer_months(b.orders, b.terms),
          "customer_id month:t amount:m",
          f"""WITH a AS (SELECT customer_id, CAST(date_trunc('month', created_at) AS DATE) AS month,
                  sum(order_gross_sales) AS amount FROM gorders GROUP BY 1, 2),
              s AS (SELECT customer_id, CAST(unnest(generate_series(min(month),
                  CAST(date_trunc('month', {AS_OF}) AS DATE), INTERVAL 1 MONTH)) AS DATE) AS month
                  FROM a GROUP BY customer_id)
              SELECT customer_id, month, coalesce(amount, 0) AS amount
              FROM s LEFT JOIN a USING (customer_id, month)"""),
    Query("d22_order_funnel", lambda b: measures.order_funnel(b.unique_grid),
          " ".join(f"at_least_{n}:i" for n in measures.FUNNEL_STEPS),
          f"SELECT {_FUNNEL} FROM ugrid"),
    Query("d23_tenure_and_age", lambda b: measures.tenure_and_age(b.grid, b.terms),
          "age_band long_tenure:i customers:i",
          f"""SELECT {band('age_at_eligibility')} AS age_band, CASE WHEN (2001 -
              year(enrolled_at)) * 12 + 8 - month(enrolled_at) > 4 THEN 1 ELSE 0 END AS long_tenure,
              count(*) AS customers FROM grid GROUP BY 1, 2"""),
    Query("d24_audience_value", lambda b: measures.audience(b.lifecycle, 1),
          "month:t state value:m", "SELECT month, state, gross_sales AS value FROM life"),
    Query("d25_calendar", lambda b: measures.calendar(b.members, "enrolled_at"),
          "date:t visual_date:t type order:i",
          """WITH d AS (SELECT CAST(unnest(generate_series(min(CAST(enrolled_at AS DATE)),
                 max(CAST(enrolled_at AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date
                 FROM enrolled JOIN cust USING (customer_id))
             SELECT date, date AS visual_date, 'Daily' AS type, 1 AS "order" FROM d UNION ALL
             SELECT date, CAST(date_trunc('week', date) AS DATE), 'Weekly', 2 FROM d UNION ALL
             SELECT date, CAST(date_trunc('month', date) AS DATE), 'Monthly', 3 FROM d UNION ALL
             SELECT date, CAST(date_trunc('year', date) AS DATE), 'Yearly', 4 FROM d"""),
    Query("d25_calendar_parts", lambda b: measures.calendar_parts(
        b.source.table("orders"), "o_orderdate"),
          "date:t year:i month_no:i month quarter_no:i quarter day:i",
          """WITH d AS (SELECT CAST(unnest(generate_series(
                 CAST(date_trunc('year', min(o_orderdate)) AS DATE),
                 make_date(year(max(o_orderdate)), 12, 31), INTERVAL 1 DAY)) AS DATE) AS date
                 FROM orders)
             SELECT date, year(date) AS year, month(date) AS month_no, monthname(date) AS month,
             quarter(date) AS quarter_no, 'Qtr ' || quarter(date) AS quarter, day(date) AS day
             FROM d"""),
    Query("d26_monthly_histogram", lambda b: measures.monthly_histogram(b.orders, 40000, 12),
          "bin_from:i customer_months:i pct:r",
          """WITH v AS (SELECT customer_id, created_month, sum(order_gross_sales) AS volume
                 FROM gorders GROUP BY 1, 2),
             t AS (SELECT count(*) AS n FROM v)
             SELECT least(floor(volume / 40000), 11) * 40000 AS bin_from,
             count(*) AS customer_months, count(*) * 100 / max(n) AS pct FROM v, t
             WHERE volume >= 0 AND volume <= 480000 GROUP BY 1"""),
    Query("d27_bucket_order", lambda b: b.loan_core.groupBy("par").agg(
        F.count(F.lit(1)).alias("loans")).withColumn(
        "bucket_order", measures.ordinal("par", measures.BUCKET_ORDER)),
          "par loans:i bucket_order:i",
          """SELECT par, loans, o AS bucket_order FROM (
             SELECT par, count(*) AS loans FROM loans GROUP BY 1)
             LEFT JOIN (VALUES ('PaidPrev', 0), ('Paid', 1), ('Ongoing', 2), ('DQ 1-6', 3),
             ('DQ 7-14', 4), ('DQ 15-29', 5), ('DQ 30-59', 6), ('DQ 60-89', 7), ('DQ 90+', 8))
             t(name, o) ON name = par"""),
    Query("d28_order_search", lambda b: measures.order_search(b.grid, b.orders, "12"),
          "customer_id shop_name phone sales_order_id order_status created_at:t"
          " order_gross_sales:m",
          """SELECT o.customer_id, shop_name, phone, sales_order_id, order_status, created_at,
             order_gross_sales FROM gorders o JOIN grid g ON o.customer_id = g.customer_id
             WHERE contains(phone, '12') OR contains(g.customer_id, '12')"""),
    Query("t3_top_inactive", lambda b: measures.top_inactive(b.grid),
          "customer_id shop_name total_order_volume:m last_order_at:t",
          """SELECT customer_id, shop_name, total_order_volume, last_order_at FROM (
             SELECT *, rank() OVER (ORDER BY total_order_volume DESC) AS r FROM grid
             WHERE is_active = 0) WHERE r <= 100"""),
    Query("margin_average", lambda b: measures.margin_average(b.orders),
          f"level {_C} {_M}:i active:r transactions:r gross_sales:m orders_per_customer:r"
          " gross_per_customer:m",
          f"""WITH c AS (SELECT {_C}, {_M}, count(DISTINCT customer_id) AS active,
                  count(customer_id) AS transactions, sum(order_gross_sales) AS gross_sales,
                  count(sales_order_id) / count(DISTINCT customer_id) AS orders_per_customer,
                  sum(order_gross_sales) / count(DISTINCT customer_id) AS gross_per_customer
                  FROM gorders GROUP BY 1, 2)
              SELECT 'cell' AS level, * FROM c
              UNION ALL {_MARGIN.format(level="'cohort'", keys=f"{_C}, {_NO_M}", group=f"GROUP BY {_C}")}
              UNION ALL {_MARGIN.format(level="'month'", keys=f"{_NO_C}, {_M}", group=f"GROUP BY {_M}")}
              UNION ALL {_MARGIN.format(level="'total'", keys=f"{_NO_C}, {_NO_M}", group="")}"""),
    Query("x15_recovery_curve", lambda b: risk.recovery_curve(b.loan_core, b.terms),
          "age_months orders:i recovered:i amount:m recovered_share:r",
          f"""WITH b AS (SELECT *, floor(date_diff('day', due_on, {AS_OF}) / 30) AS a FROM loans
                  WHERE days_past_due >= 90)
              SELECT CASE WHEN a < 4 THEN '03-04' WHEN a < 6 THEN '04-06' WHEN a < 9 THEN '06-09'
                  WHEN a < 12 THEN '09-12' WHEN a < 18 THEN '12-18' ELSE '18+' END AS age_months,
              count(*) AS orders, count(paid_at) AS recovered, sum(total_amount) AS amount,
              coalesce(sum(total_amount) FILTER (WHERE paid_at IS NOT NULL), 0)
                  / sum(total_amount) AS recovered_share FROM b GROUP BY 1"""),
    Query("f16_distance", lambda b: b.grid.select("customer_id", risk.distance().alias("metres")),
          "customer_id metres:r", f"SELECT customer_id, {DISTANCE} AS metres FROM grid"),
]
