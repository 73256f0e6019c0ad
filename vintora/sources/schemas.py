"""Column types of the staging tables. The schema decides, never inference."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Staging formats in source order. Whole numbers of documents are DOUBLE.
STAGING = {
    "credit_order": """createdAt DOUBLE, deliveryAt DOUBLE, netsuiteId STRING, salesOrderId STRING,
        orderId STRING, shortId STRING, productId STRING, productDescription STRING,
        category STRING, brand STRING, subcategory STRING, vendor STRING, quantity DOUBLE,
        orderGrossSales DOUBLE, totalPrice DOUBLE, totalPriceFinal DOUBLE, iva DOUBLE,
        ieps DOUBLE, couponValue DOUBLE, couponCode STRING, orderStatus STRING,
        salesChannel STRING""",
    "payment_report": """clientId STRING, creditId STRING, transactionId STRING,
        marketplaceOrderId STRING, movementDate DOUBLE, paymentDateFromToPay STRING,
        paymentDateFromPaid STRING, totalAmount DOUBLE, totalAmountToPay DOUBLE,
        totalAmountDefault DOUBLE, interests DOUBLE, comisionPorCobrar DOUBLE,
        creditLimit DOUBLE, state STRING, transactionStatus STRING""",
    "state_of_delivery": """netsuiteId STRING, salesOrderId STRING, marketplaceOrderId STRING,
        deliveryStatus STRING, deliveryDate DOUBLE, orderAmount DOUBLE, salesChannel STRING,
        reason STRING""",
    "customers": """netsuiteId STRING, customerId STRING, shopkeeperId STRING, shopName STRING,
        phoneNumber STRING, gender STRING, business_category STRING, address_street STRING,
        address_exteriorNumber STRING, address_interiorNumber STRING,
        address_neighborhood STRING, address_zipCode STRING, address_town STRING,
        address_state STRING, address_country STRING, address_latitude STRING,
        address_longitude STRING, hasMarketplace BOOLEAN, hasPresales BOOLEAN,
        updatedAt DOUBLE""",
    "credit_request": """customerId STRING, requestId STRING, createdAt DOUBLE, name STRING,
        lastNames STRING, birthdate STRING, phoneNumber STRING, gender STRING, latitude STRING,
        longitude STRING, origin STRING, requestType STRING, requestResult STRING""",
    "credit_approval": """netsuiteId STRING, customerId STRING, approvalId STRING,
        createdAt STRING, creditLimit DOUBLE, creditLimitAvailable DOUBLE, origin STRING,
        approvalType STRING, status STRING""",
    "pre_authorization": """netsuiteId STRING, customerId STRING, preAuthorizationId STRING,
        preAuthorized STRING, authorizationDate STRING, authorizationExpirationDate STRING,
        clientOfferDate STRING""",
    "revenue_orders": """transactionId STRING, salesOrderId STRING, clientId STRING,
        creditId STRING, mirrorTransactionId STRING, fintechStatus STRING, state STRING""",
    "mirror_transaction": """id STRING, netsuiteId STRING, customerId STRING, salesOrderId STRING,
        wholesalerTransactionId STRING, verificationId STRING, totalAmount DOUBLE,
        totalAmountWithInterests DOUBLE, interests DOUBLE, iVAAmount DOUBLE, amountPaid DOUBLE,
        status STRING, currentState STRING, movementDate STRING, paymentDate STRING,
        paidDate STRING, deliveryDate STRING, createdAt STRING, updatedAt STRING""",
    "credit_limit_history": """netsuiteId STRING, customerId STRING, originalCreditLimit DOUBLE,
        currentCreditLimit DOUBLE, creditLimitAvailable DOUBLE, creditLimitUpdateDate DOUBLE,
        customerStatus STRING, creditHistory STRING""",
    "commercial_structure": """netsuite_id STRING, tipo_cliente STRING, status STRING,
        ruta STRING, ruta_canon STRING, supervisor STRING, oficina STRING, oficina_canon STRING,
        region STRING, region_canon STRING, pais STRING, dia STRING, frecuencia STRING,
        fecha_inicio DATE, data_source STRING""",
    "route_mapping": "ruta STRING, equipo STRING, oficina STRING, region STRING, pais STRING",
    "route_days": """netsuite_id STRING, fecha DATE, ruta STRING, supervisor STRING,
        oficina STRING, region STRING, tipo_cliente STRING, status STRING""",
    "orders_old": """ns_id STRING, so_id STRING, fecha_creacion_mx DATE, clase_canal STRING,
        status_pedido STRING, item_itemid STRING, cantidad_piezas DOUBLE, monto_venta DOUBLE""",
    "orders_new": """ns_id STRING, so_id STRING, fecha_creacion_mx DATE, clase_canal STRING,
        status_pedido STRING, item_itemid STRING, quantity_completed DOUBLE,
        quantity_in_progress DOUBLE, amount_completed DOUBLE, amount_in_progress DOUBLE""",
    "pair_odds": """loan_disbursement_index_range STRING, flag STRING, atr1 STRING, atr2 STRING,
        atr1_rank STRING, atr2_rank STRING, events BIGINT, good BIGINT, bad BIGINT, br DOUBLE,
        bad_rate DOUBLE, pct_good DOUBLE, pct_bad DOUBLE, woe DOUBLE, iv DOUBLE""",
    "pair_iv": """loan_disbursement_index_range STRING, flag STRING, combination STRING,
        number_of_combinations BIGINT, iv DOUBLE""",
    "service_profile": "id_cliente BIGINT, transactional_profile STRING",
    "cohort_cac": "enrollment_cohort STRING, cac DOUBLE",
    "contest_customers": """netsuite_id STRING, netsuite_id_num BIGINT, linea_nueva DOUBLE,
        clasificacion STRING, ruta_preventa STRING, oficina_venta STRING, supervisor STRING""",
}


@cache
def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(STAGING[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Exactly the columns of the table: missing ones NULL, types cast, others dropped.

    Text that does not parse becomes NULL; any other type that does not fit is an error.
    """
    schema = schema_of(table)
    parsed = {
        f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema
        if f.name in df.columns and isinstance(df.schema[f.name].dataType, T.StringType)
        and not isinstance(f.dataType, T.StringType)}
    return (df.withColumns(parsed) if parsed else df).to(schema)
