"""The consumer tables of which every published column is compared.

A line of a declaration is the published column with its mark, and the SQL it must equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from vintora.plans import consumers, sales
from vintora.plans.book import Book
from vintora.registry.core import Query


def _declared(name: str, build: Callable[[Book], DataFrame], lines: str, source: str,
              renamed: dict[str, str] | None = None) -> Query:
    """``renamed`` gives published names that are awkward to compare another one."""
    fields = [tuple(part.strip() for part in line.split(" = ", 1))
              for line in lines.strip().splitlines()]
    sql = ", ".join(f'{expr} AS "{column.split(":")[0]}"' for column, expr in fields)

    def made(book: Book) -> DataFrame:
        df = build(book).withColumnsRenamed(renamed or {})
        undeclared = set(df.columns) ^ {c.split(":")[0] for c, _ in fields}
        if undeclared:
            raise ValueError(f"{name}: declared and published columns differ: {sorted(undeclared)}")
        return df

    return Query(name, made, " ".join(c for c, _ in fields), f"SELECT {sql} FROM {source}")


QUERIES = [
    _declared("m27_loans", lambda b: consumers.published_loans(b.loans, b.grid), """
        netsuiteId:i = CAST(trim(customer_id) AS BIGINT)
        salesOrderId = sales_order_id
        orderStatus = order_status
        createdAt:t = CAST(created_at AS DATE)
        orderGrossSales:m = order_gross_sales
        creditLimit:m = credit_limit
        quantity:i = quantity
        deliveryAt:t = CAST(delivery_at AS DATE)
        creditEnrolledAt:t = CAST(enrolled_at AS DATE)
        enrollment_cohort = l.enrollment_cohort
        EnrolledCustomers:i = enrolled_customers
        everActivatedCustomers:i = coalesce(n, 0)
        enrolledCreditLimit:i = round_even(round(cohort_credit_limit, 6), 0)
        monthsSinceEnrollment:i = months_since_enrollment
        ruta = route
        supervisor = supervisor
        oficina = office
        tipo = customer_type
        rank:i = rank
        transaction_id = transaction_id
        totalAmountToPay:m = total_to_pay
        totalAmount:m = total_amount
        interests:m = interests
        totalAmountDefault:i = round_even(total_default, 0)
        movementDate = CAST(movement_at AS VARCHAR)
        paymentDate = CAST(payment_at AS VARCHAR)
        paidDate:t = paid_at
        expectedPaymentDate:t = due_on
        endOfTheMonthexpectedPaymentDate:t = due_month_end
        month = month
        paidOnMonth:i = paid_on_month
        daysPastDue:i = days_past_due
        daysPastDueEndOfTheMonth:i = days_past_due_month_end
        defaultInterest:m = penalty_interest
        totalRevenue:m = total_revenue
        shareRevenue:m = revenue_share
        PAR = par""",
              """loans l LEFT JOIN (SELECT enrollment_cohort, count(*) AS n FROM grid
              WHERE is_activated = 1 AND enrollment_cohort IS NOT NULL GROUP BY 1) a
              ON l.enrollment_cohort = a.enrollment_cohort"""),
    _declared("m27_vintage", lambda b: consumers.published_vintage(b.vintage), """
        enrollment_cohort = enrollment_cohort
        cohortYear:m = CAST(cohort_year AS DOUBLE)
        monthsFromEnrollmentToMonth:i = months_on_book
        corte = label
        n:i = orders
        everActivated:i = ever_activated
        enrolled_customers:i = enrolled_customers
        deployedCapital:m = deployed_capital
        outstandingBalance:m = outstanding_balance
        PAR30:m = par30
        PAR60:m = par60
        PAR90:m = par90
        PAR30N:i = par30_n
        PAR60N:i = par60_n
        PAR90N:i = par90_n
        par30Rate:r = par30_rate
        par60Rate:r = par60_rate
        par90Rate:r = par90_rate
        par30CustomersRate:r = par30_customers_rate
        par60CustomersRate:r = par60_customers_rate
        par90CustomersRate:r = par90_customers_rate""", "vint"),
    _declared("m27_grid", lambda b: consumers.published_grid(b.unique_grid), """
        netsuiteId:i = customer_key
        customerId = document_id
        shopkeeperId = shopkeeper_id
        shopName = shop_name
        ruta = route
        supervisor = supervisor
        oficina = office
        tipo = customer_type
        business_category = business_category
        shopNeighborhood = shop_neighborhood
        shopZipCode = shop_zip
        shopTown = shop_town
        shopState = shop_state
        shopLatitude:r = shop_latitude
        shopLongitude:r = shop_longitude
        customerName = customer_name
        customerLastNames = customer_last_names
        inferredGender = gender
        customerBirthdate:t = birthdate
        customerAge:i = age
        customerAgeAtEligibility:i = age_at_eligibility
        customerAgeAtEnrollment:i = age_at_enrollment
        customerPhoneNumber = phone
        customerLatitude:r = customer_latitude
        customerLongitude:r = customer_longitude
        creditEligibleAt:t = CAST(eligible_at AS DATE)
        originalCreditLimit:i = round_even(original_limit, 0)
        creditLimit:i = round_even(credit_limit, 0)
        creditEnrolledAtTimestamp:i = epoch_ms(enrolled_at) + 21600000
        creditEnrolledAt:t = CAST(enrolled_at AS DATE)
        creditIsEnrolled:i = is_enrolled
        enrollment_cohort = enrollment_cohort
        enrollmentChannel = enrollment_channel
        creditActivatedAt:t = CAST(activated_at AS DATE)
        creditIsActivated:i = is_activated
        creditActivatedCohortMonth = activated_cohort
        creditActivatedLineOfCredit:m = activated_limit
        creditFirstOrderdAt:t = CAST(first_order_at AS DATE)
        creditLastOrderAt:t = CAST(last_order_at AS DATE)
        creditOrdersCount:i = orders_count
        creditCompletedOrdersCount:i = completed_orders
        creditRejectedOrdersCount:i = rejected_orders
        creditCancelledOrdersCount:i = cancelled_orders
        creditAvgOrderVolume:r = avg_order_volume
        creditTotalOrderVolume:m = total_order_volume
        creditCompletedOrderVolume:m = completed_volume
        creditFirstOrderGrossSales:m = first_order_gross
        creditOrderFrequency:r = order_frequency
        creditDueForPaymentOrdersCount:i = due_orders
        creditPaymentsCount:i = payments_count
        creditAvgRevenue:r = avg_revenue
        creditAvgRevenueShare:r = avg_revenue_share
        creditRevenue:m = revenue
        creditRevenueShare:m = revenue_share
        creditIsActive:i = is_active""", "ugrid"),
    _declared("m27_pre_post", lambda b: consumers.published_pre_post(b.pre_post), """
        netsuiteId:i = CAST(trim(customer_id) AS BIGINT)
        salesOrderId = sales_order_id
        orderStatus = order_status
        createdAt:t = CAST(created_on AS TIMESTAMP)
        monthsToOrSinceEnrollment:i = months
        grossSales:m = amount
        finalPrice:m = final_price
        skus:i = skus
        quantity:i = round_even(pieces, 0)
        rank:i = recency
        treshold = stage
        comparable = CAST(NULL AS VARCHAR)
        type = type
        creditEnrolledAt:t = enrolled_at
        enrollment_cohort = enrollment_cohort
        maxMonthPostCredit:i = max_month_post
        validMonth:i = 1
        externalId = CAST(NULL AS VARCHAR)
        ruta = route
        supervisor = supervisor
        oficina = office
        tipo = customer_type""", "pp"),
    _declared("m27_profile", lambda b: consumers.published_profile(b.profile), """
        Column1:i = row_id
        netsuiteId:i = customer_key
        salesOrderId = sales_order_id
        orderId = order_id
        orderStatus = order_status
        createdAt:t = CAST(created_at AS DATE)
        expectedPaymentDate:t = due_on
        paidDate:t = CAST(paid_at AS DATE)
        totalAmount:m = total_amount
        totalAmountToPay:m = total_to_pay
        daysPastDue:i = days_past_due
        loanDisbursementIndex:i = rank
        loanDisbursementIndexRange = loan_range
        flag@15DaysLate:i = flag_15
        flag@30DaysLate:i = flag_30
        creditEligibleAt:t = CAST(eligible_at AS DATE)
        ruta = route
        supervisor = supervisor
        oficina = office
        tipo = customer_type
        business_category = business_category
        shopNeighborhood = shop_neighborhood
        shopZipCode:i = zip_code
        shopTown = shop_town
        shopState = shop_state
        shopLatitude:r = shop_latitude
        shopLongitude:r = shop_longitude
        customerName = customer_name
        customerLastNames = customer_last_names
        inferredGender = gender
        customerBirthdate:t = birthdate
        customerAge:i = age
        customerAgeAtEligibility:i = age_at_eligibility
        customerLatitude:r = customer_latitude
        customerLongitude:r = customer_longitude
        distanceBetweenOnboardingAndShopLocation:r = distance
        PSOnboardedAt = CAST(NULL AS VARCHAR)
        TPVOnboardedAt = CAST(NULL AS VARCHAR)
        psrtaPreviousToCredit:i = 0
        tpvPreviousToCredit:i = 0
        previousFintechProductToCredit:i = 0
        grossSalesVolume3Months:m = gross_3m
        ordersCount3Months:i = orders_3m
        avgTicket3Months:i = avg_ticket_3m
        grossSalesVolume6Months:m = gross_6m
        ordersCount6Months:i = orders_6m
        grossSalesAliadoPostLastCreditOrder:m = gross_field_after
        ordersCountAliadoPostLastCreditOrder:i = orders_field_after
        grossSalesMarketPlacePostLastCreditOrder:m = gross_other_after
        ordersCountMarketPlacePostLastCreditOrder:i = orders_other_after""", "profile"),
    _declared("m27_seasonality", lambda b: consumers.published_seasonality(
        sales.seasonality_pairs(b.season)), """
        fromMonth = CAST(from_month AS VARCHAR)
        toMonth = CAST(to_month AS VARCHAR)
        fromMonthAvgGrossSales:m = from_ticket
        fromcAvgMonthlyVolume:m = from_volume
        toMonthAvgGrossSales:m = to_ticket
        toAvgMonthlyVolume:m = to_volume
        seasonalityDeltaTicket:r = ticket_ratio
        seasonalityDeltaTicketRate:r = ticket_delta
        seasonalityDeltaVolume:r = volume_ratio
        seasonalityDeltaVolumeRate:r = volume_delta""", "spairs"),
    _declared("m27_odds", lambda b: consumers.published_odds(b.odds), """
        loanDisbursementIndexRange = loan_range
        flag = flag
        attribute = 'distanceBetweenOnboardingAndShopLocation'
        bin = CAST(bin AS VARCHAR)
        min_value:r = min_value
        max_value:r = max_value
        events:i = events
        good:i = good
        bad:i = bad
        bad_rate:r = bad_rate
        pct_good:r = pct_good
        pct_bad:r = pct_bad
        woe:r = woe
        iv:r = iv""", "odds", {"%good": "pct_good", "%bad": "pct_bad"}),
    _declared("m27_contest", lambda b: consumers.published_contest(b.contest), """
        netsuiteId = customer_id
        netsuiteIdNum:i = customer_key
        salesOrderId = sales_order_id
        tienda = shop_name
        municipio = shop_town
        estado = shop_state
        fechaAprobacionCredito:t = CAST(enrolled_at AS DATE)
        cohorteEnrolamiento = enrollment_cohort
        canalEnrolamiento = enrollment_channel
        fechaCreacion:t = CAST(created_at AS DATE)
        createdAt:t = created_at
        fechaEntrega:t = CAST(delivered_at AS DATE)
        periodo = period
        enVigencia = in_contest
        diaVentana:i = day_in_window
        aliado = route
        supervisor = supervisor
        oficina = office
        region = region
        tipo = customer_type
        rutaInferida = route_inferred
        aliadoActual = current_route
        supervisorActual = current_supervisor
        oficinaActual = current_office
        regionActual = current_region
        tipoActual = current_customer_type
        estatusOrden = order_status
        estatusEntrega = delivery_status
        esEntregada = is_delivered
        esVigente = is_active
        esCancelada = is_cancelled
        esRechazada = is_rejected
        montoOrden:m = order_gross_sales
        precioTotal:m = total_price
        limiteCredito:m = credit_limit
        skus:i = skus
        piezas:m = quantity
        indiceOrdenCliente:i = attempt_index
        esPrimeraOrdenDelCliente = is_first_order
        fechaPrimerCreditoUsado:t = first_delivered_on
        ordenesEntregadasPrevias:i = delivered_before
        ultimaOrdenEntregadaPrevia:t = last_delivered_before
        esNuevoEnCredito = is_new
        esPrimeraOrdenEntregadaEnVentana = is_first_delivered""", "contest"),
]
