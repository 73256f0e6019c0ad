"""Staging formats to the clean inputs of the plans: local times, trimmed text, short names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.functions import epoch_ms_to_local, iso_to_local
from vintora.params import Terms


def order_lines(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("netsuiteId").alias("customer_id"), F.col("salesOrderId").alias("sales_order_id"),
        F.col("orderId").alias("order_id"), F.col("orderStatus").alias("order_status"),
        F.col("salesChannel").alias("sales_channel"), F.col("createdAt").alias("created_ms"),
        epoch_ms_to_local("createdAt").alias("created_at"),
        epoch_ms_to_local("deliveryAt").alias("delivery_at"),
        F.col("productId").alias("product_id"), "category", "brand", "quantity",
        F.col("orderGrossSales").alias("order_gross_sales"),
        F.col("totalPrice").alias("total_price"))


def payments(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("clientId").alias("customer_id"), F.col("transactionId").alias("transaction_id"),
        F.col("marketplaceOrderId").alias("marketplace_order_id"),
        epoch_ms_to_local("movementDate").alias("movement_at"),
        iso_to_local("paymentDateFromToPay").alias("payment_at"),
        iso_to_local("paymentDateFromPaid").alias("paid_at"),
        F.col("totalAmount").alias("total_amount"),
        F.col("totalAmountToPay").alias("total_to_pay"),
        F.col("totalAmountDefault").alias("total_default"), "interests",
        F.col("comisionPorCobrar").alias("commission_due"),
        F.col("creditLimit").alias("credit_limit"),
        F.col("transactionStatus").alias("transaction_status"))


def mirrors(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").alias("mirror_id"), F.col("salesOrderId").alias("sales_order_id"),
        F.col("totalAmount").alias("total_amount"),
        F.col("totalAmountWithInterests").alias("total_to_pay"), "interests",
        F.col("amountPaid").alias("amount_paid"), "status",
        iso_to_local("movementDate").alias("movement_at"),
        iso_to_local("paymentDate").alias("payment_at"),
        iso_to_local("paidDate").alias("paid_at"),
        iso_to_local("updatedAt").alias("updated_at"))


def deliveries(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("salesOrderId").alias("sales_order_id"),
        F.col("deliveryStatus").alias("delivery_status"),
        epoch_ms_to_local("deliveryDate").alias("delivered_at"), "reason")


def approvals(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("netsuiteId").alias("customer_id"), F.col("approvalId").alias("approval_id"),
        iso_to_local("createdAt").alias("approved_at"),
        F.col("creditLimit").alias("credit_limit"), "origin", "status")


def pre_approvals(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("netsuiteId").alias("customer_id"),
        F.col("preAuthorizationId").alias("pre_approval_id"),
        iso_to_local("authorizationDate").alias("eligible_at"),
        F.col("preAuthorized").alias("pre_authorized_by"))


def limits(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("netsuiteId").alias("customer_id"), F.col("customerId").alias("document_id"),
        F.col("originalCreditLimit").alias("original_limit"),
        F.col("currentCreditLimit").alias("current_limit"),
        F.col("creditLimitAvailable").alias("available_limit"),
        F.col("creditLimitUpdateDate").alias("updated_ms"),
        F.col("customerStatus").alias("customer_status"))


def route_days(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("netsuite_id").alias("customer_id"), F.col("fecha").alias("day"),
        F.col("ruta").alias("route"), "supervisor", F.col("oficina").alias("office"), "region",
        F.col("tipo_cliente").alias("customer_type"), "status")


def known(df: DataFrame, key: str) -> DataFrame:
    """Rows of a warehouse table that have their key."""
    return df.filter(F.col(key).isNotNull())


def yearly_sales(old: list[DataFrame], new: list[DataFrame], terms: Terms) -> DataFrame:
    """Union of the yearly tables with one amount definition per generation.

    One month of the old tables is inflated: its amount, not its pieces, is divided.
    """
    keys = [F.col("ns_id").alias("customer_id"), F.col("so_id").alias("sales_order_id"),
            F.col("fecha_creacion_mx").alias("created_on"), F.col("clase_canal").alias("channel"),
            F.col("status_pedido").alias("order_status"), F.col("item_itemid").alias("item_id")]
    corrupt = F.trunc("fecha_creacion_mx", "month") == F.lit(terms.corrupt_month)
    parts = [t.select(*keys, F.col("cantidad_piezas").alias("pieces"),
                      F.when(corrupt, F.col("monto_venta") / terms.corrupt_divisor)
                      .otherwise(F.col("monto_venta")).alias("amount")) for t in old]
    parts += [t.select(*keys, *[
        (F.coalesce(f"{field}_completed", F.lit(0.0))
         + F.coalesce(f"{field}_in_progress", F.lit(0.0))).alias(name)
        for field, name in (("quantity", "pieces"), ("amount", "amount"))]) for t in new]
    return reduce(DataFrame.unionByName, parts)
