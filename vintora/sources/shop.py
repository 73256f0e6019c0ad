"""The supplied star tables, reshaped into the staging formats.

Everything is a projection or an equi-join of the given tables, so its size grows with them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintora.sources.schemas import conform

_STATUS = """CASE WHEN o_orderkey % 20 = 0 THEN 'REJECTED' WHEN o_orderkey % 31 = 0 THEN 'CANCELLED'
    WHEN o_orderkey % 47 = 0 THEN 'CREATED' WHEN o_orderkey % 53 = 0 THEN 'IN_DELIVERY'
    ELSE 'COMPLETED' END"""
_CHANNEL = """CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'PRESALES'
    ELSE 'MARKETPLACE' END"""


def _ms(day: str, hour: str) -> str:
    """Local day and hour as epoch milliseconds UTC."""
    return f"CAST((unix_date({day}) * 86400L + ({hour}) * 3600 + 21600) * 1000 AS DOUBLE)"


def _iso(day: str, hour: str) -> str:
    """Local day and hour as ISO text in UTC."""
    moment = f"timestamp_seconds(unix_date({day}) * 86400L + ({hour}) * 3600 + 21600)"
    return f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


# Formats of the supplied tables. Given, so that opening one reads no file footer.
_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": """c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,
        c_mktsegment STRING""",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
}
_CREDIT = "o_orderkey % 3 <> 0"
# Half of the customers take up credit some time after their first order, so that there are sales
# before and after it.
_LAG = "CAST(IF(o_custkey % 2 = 0, (o_custkey * 7) % 720, 0) AS INT)"


class Shop:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._opened: dict[str, DataFrame] = {}

    def version(self, name: str) -> str:
        """A mark that changes when the files do. A staging table may be made of any of them."""
        files = self.spark._jvm.org.apache.hadoop.fs
        root = files.Path(self.dir)
        found = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)
        return ";".join(sorted(f"{s.getPath().getName()},{s.getLen()},{s.getModificationTime()}"
                               for s in found))

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.schema(_TABLES[name]).parquet(
                f"{self.dir}/{name}.parquet")
        return self._opened[name]

    @cached_property
    def order_heads(self) -> DataFrame:
        """One row per order bought on credit: two of three orders."""
        return self.table("orders").filter(_CREDIT).selectExpr(
            "o_orderkey AS k", "CAST(o_custkey AS STRING) AS netsuiteId",
            "concat('SO', o_orderkey) AS salesOrderId", "concat('M', o_orderkey) AS orderId",
            f"{_STATUS} AS orderStatus", f"{_CHANNEL} AS salesChannel",
            "CAST(o_orderdate AS DATE) AS created_on",
            "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 18 AS INT)) AS delivered_on",
            "o_totalprice AS gross")

    @cached_property
    def credit_order(self) -> DataFrame:
        heads, lines = self.order_heads, self.table("lineitem").join(
            self.table("part"), F.expr("l_partkey = p_partkey"))
        df = heads.join(lines, F.expr("l_orderkey = k")).selectExpr(
            _ms("created_on", "k % 24") + " AS createdAt",
            "CASE WHEN k % 211 <> 0 THEN " + _ms("delivered_on", "k % 7") + " END AS deliveryAt",
            "netsuiteId",
            "CASE WHEN k % 101 = 0 AND l_linenumber = 2 THEN '  ' ELSE salesOrderId END"
            " AS salesOrderId",
            "orderId", "CAST(l_partkey AS STRING) AS productId", "p_name AS productDescription",
            "p_type AS category", "p_brand AS brand", "CAST(l_suppkey AS STRING) AS vendor",
            "l_quantity AS quantity", "gross AS orderGrossSales", "gross AS totalPrice",
            "CASE WHEN k % 37 = 0 AND l_linenumber = 1 THEN 'CREATED' ELSE orderStatus END"
            " AS orderStatus", "salesChannel")
        return conform(df, "credit_order")

    @cached_property
    def payment_report(self) -> DataFrame:
        paid_on = ("date_add(delivered_on, CAST(CASE WHEN k % 4 = 0 THEN (k * 7) % 130"
                   " ELSE k % 17 END AS INT))")
        df = (self.order_heads.filter("orderStatus = 'COMPLETED'")
              .withColumn("seq", F.explode(F.expr("IF(k % 40 = 1, array(0, 1), array(0))")))
              .withColumn("paid_on", F.expr(
                  f"CASE WHEN k % 13 = 0 OR (seq = 0 AND k % 40 = 1) THEN NULL"
                  f" WHEN {paid_on} <= DATE'2001-08-15' THEN {paid_on} END"))
              .selectExpr(
                  "netsuiteId AS clientId", "concat('K', k) AS creditId",
                  "CASE WHEN k % 50 = 1 THEN concat('uuid-', k) ELSE salesOrderId END"
                  " AS transactionId",
                  "orderId AS marketplaceOrderId",
                  _ms("date_add(created_on, seq)", "12") + " AS movementDate",
                  _iso("date_add(delivered_on, 15)", "0") + " AS paymentDateFromToPay",
                  "CASE WHEN paid_on IS NULL THEN 'No Information' ELSE "
                  + _iso("paid_on", "k % 24") + " END AS paymentDateFromPaid",
                  "gross AS totalAmount", "gross * 1.058 AS totalAmountToPay",
                  "CASE WHEN k % 13 = 0 THEN gross END AS totalAmountDefault",
                  "gross * 0.05 AS interests", "gross * 0.058 AS comisionPorCobrar",
                  "gross * 2 + 1000 AS creditLimit",
                  "CASE WHEN paid_on IS NULL THEN 'ACTIVE' ELSE 'SETTLED' END AS state",
                  "CASE WHEN paid_on IS NULL THEN 'pending' ELSE 'paid' END AS transactionStatus"))
        return conform(df, "payment_report")

    @cached_property
    def mirror_transaction(self) -> DataFrame:
        df = (self.order_heads.filter("orderStatus = 'COMPLETED' AND k % 4 = 1")
              .withColumn("seq", F.explode(F.expr("IF(k % 60 = 1, array(0, 1), array(0))")))
              .selectExpr(
                  "concat('X', k, '-', seq) AS id", "netsuiteId", "salesOrderId",
                  "gross AS totalAmount", "gross * 1.06 AS totalAmountWithInterests",
                  "CASE WHEN k % 8 = 1 THEN 0.0 ELSE gross * 0.05 END AS interests",
                  "gross * seq AS amountPaid",
                  "CASE WHEN seq = 1 THEN 'PAID' ELSE 'OPEN' END AS status",
                  _iso("created_on", "9") + " AS movementDate",
                  _iso("date_add(delivered_on, 15)", "0") + " AS paymentDate",
                  "CASE WHEN k % 26 = 13 AND date_add(delivered_on, 40) <= DATE'2001-08-15' THEN "
                  + _iso("date_add(delivered_on, 40)", "8") + " ELSE 'No Information' END AS paidDate",
                  _iso("date_add(created_on, 30 * seq)", "10") + " AS updatedAt",
                  _iso("created_on", "9") + " AS createdAt"))
        return conform(df, "mirror_transaction")

    @cached_property
    def state_of_delivery(self) -> DataFrame:
        df = self.order_heads.filter("k % 17 <> 0").selectExpr(
            "netsuiteId", "salesOrderId", "orderId AS marketplaceOrderId",
            "CASE WHEN orderStatus IN ('COMPLETED', 'REJECTED') THEN orderStatus ELSE 'PENDING' END"
            " AS deliveryStatus",
            _ms("delivered_on", "k % 7") + " AS deliveryDate", "gross AS orderAmount",
            "salesChannel",
            "CASE WHEN orderStatus = 'REJECTED' THEN CASE k % 3 WHEN 1 THEN"
            " 'No tiene palabra clave' ELSE 'Otro' END END AS reason")
        return conform(df, "state_of_delivery")

    @cached_property
    def first_orders(self) -> DataFrame:
        """Where approvals and eligibility start: the first order, or some time after it."""
        first = F.expr(f"date_add(CAST(min(o_orderdate) AS DATE), any_value({_LAG}))")
        return self.table("orders").groupBy("o_custkey").agg(first.alias("first_on")) \
            .withColumnRenamed("o_custkey", "n")

    @cached_property
    def credit_approval(self) -> DataFrame:
        df = (self.first_orders.join(self.table("customer"), F.expr("c_custkey = n"))
              .withColumn("seq", F.explode(F.expr("IF(n % 25 = 0, array(0, 1), array(0))")))
              .selectExpr(
                  "CAST(n AS STRING) AS netsuiteId", "concat('C', n) AS customerId",
                  "concat('A', n, '-', seq) AS approvalId",
                  _iso("date_add(first_on, CAST(seq * 200 - n % 90 AS INT))", "9") + " AS createdAt",
                  "c_acctbal + 1000 AS creditLimit", "c_acctbal AS creditLimitAvailable",
                  "CASE n % 3 WHEN 0 THEN 'APP' WHEN 1 THEN 'FIELD' ELSE 'WEB' END AS origin",
                  "CASE WHEN n % 11 = 0 THEN 'REJECTED' ELSE 'APPROVED' END AS status"))
        return conform(df, "credit_approval")

    @cached_property
    def pre_authorization(self) -> DataFrame:
        df = (self.first_orders.filter("n % 2 = 0")
              .withColumn("seq", F.explode(F.expr("IF(n % 50 = 0, array(0, 1), array(0))")))
              .selectExpr(
                  "CAST(n AS STRING) AS netsuiteId", "concat('C', n) AS customerId",
                  "concat('P', n, '-', seq) AS preAuthorizationId",
                  "CASE WHEN n % 4 = 0 THEN 'MODEL' ELSE 'MANUAL' END AS preAuthorized",
                  _iso("date_add(first_on, CAST(seq * 60 + n % 700 AS INT))", "9")
                  + " AS authorizationDate"))
        return conform(df, "pre_authorization")

    @cached_property
    def credit_limit_history(self) -> DataFrame:
        df = (self.table("customer").filter("c_custkey % 5 <> 0")
              .withColumn("seq", F.explode(F.expr("IF(c_custkey % 30 = 1, array(0, 1), array(0))")))
              .selectExpr(
                  "CAST(c_custkey AS STRING) AS netsuiteId", "concat('C', c_custkey) AS customerId",
                  "c_acctbal + 1000 AS originalCreditLimit",
                  "c_acctbal + 1500 + 100 * seq AS currentCreditLimit",
                  "c_acctbal + 500 AS creditLimitAvailable",
                  _ms("date_add(DATE'2000-01-01', seq)", "0") + " AS creditLimitUpdateDate",
                  "'ACTIVE' AS customerStatus",
                  "concat('[{\"limit\":', c_custkey, '}]') AS creditHistory"))
        return conform(df, "credit_limit_history")

    @cached_property
    def customers(self) -> DataFrame:
        """Shops, with a blank-padded twin of the id for some of them."""
        df = (self.table("customer").join(self.table("nation"), F.expr("c_nationkey = n_nationkey"))
              .withColumn("pad", F.explode(F.expr("IF(c_custkey % 97 = 0, array('', ' '), array(''))")))
              .selectExpr(
                  "concat(pad, c_custkey) AS netsuiteId",
                  "concat('C', c_custkey, IF(pad = ' ', 'b', '')) AS customerId",
                  "concat('K', c_custkey) AS shopkeeperId", "c_name AS shopName",
                  "concat('55', lpad(CAST(c_custkey AS STRING), 8, '0')) AS phoneNumber",
                  "CASE c_custkey % 3 WHEN 0 THEN 'NOT_DEFINED' WHEN 1 THEN 'F' ELSE 'M' END AS gender",
                  "c_mktsegment AS business_category",
                  "concat('N', c_custkey % 12) AS address_neighborhood",
                  "concat('CP-', 10000 + c_custkey % 500) AS address_zipCode",
                  "concat('T', c_custkey % 20) AS address_town", "n_name AS address_state",
                  "CASE WHEN c_custkey % 23 = 0 THEN '0' ELSE"
                  " CAST(19 + (c_custkey % 50) * 0.01 + (c_custkey % 13) * 0.00002 AS STRING) END"
                  " AS address_latitude",
                  "CAST(-99 - (c_custkey % 40) * 0.01 AS STRING) AS address_longitude",
                  "c_custkey % 2 = 0 AS hasMarketplace", "c_custkey % 3 = 0 AS hasPresales"))
        return conform(df, "customers")

    @cached_property
    def credit_request(self) -> DataFrame:
        df = self.table("customer").filter("c_custkey % 8 <> 0").selectExpr(
            "concat('C', c_custkey) AS customerId", "concat('Q', c_custkey) AS requestId",
            "concat('N', c_custkey) AS name", "concat('L', c_custkey % 100) AS lastNames",
            "CASE WHEN c_custkey % 29 = 0 THEN '00/00/0000' WHEN c_custkey % 31 = 0 THEN '2024-13-45'"
            " ELSE CAST(date_add(DATE'1940-01-01', CAST(c_custkey * 37 % 14000 AS INT)) AS STRING) END"
            " AS birthdate",
            "CASE WHEN c_custkey % 4 = 0 THEN 'NOT_DEFINED' WHEN c_custkey % 4 = 1 THEN 'F' END"
            " AS gender",
            "CASE WHEN c_custkey % 19 = 0 THEN '' ELSE"
            " CAST(19 + (c_custkey % 50) * 0.01 AS STRING) END AS latitude",
            "CAST(-99 - (c_custkey % 40) * 0.01 AS STRING) AS longitude")
        return conform(df, "credit_request")

    @cached_property
    def revenue_orders(self) -> DataFrame:
        df = self.order_heads.filter("orderStatus = 'COMPLETED' AND k % 6 <> 5").selectExpr(
            "concat('uuid-', k) AS transactionId",
            "IF(k % 90 = 1, NULL, salesOrderId) AS salesOrderId", "netsuiteId AS clientId",
            "concat('K', k) AS creditId", "'ACTIVE' AS state")
        return conform(df, "revenue_orders")

    @cached_property
    def route_days(self) -> DataFrame:
        """Route observed on each order day; it changes every other year."""
        number = "(o_custkey + CAST(FLOOR(year(o_orderdate) / 2) AS INT)) % 9"
        df = self.table("orders").selectExpr(
            "CAST(o_custkey AS STRING) AS netsuite_id", "CAST(o_orderdate AS DATE) AS fecha",
            f"CASE WHEN day(o_orderdate) <> 13 THEN concat('R', {number}) END AS ruta",
            f"concat('S', {number}) AS supervisor", f"concat('O', {number} % 3) AS oficina",
            f"concat('G', {number} % 2) AS region", "concat('T', o_custkey % 4) AS tipo_cliente",
            "'ACTIVE' AS status").distinct()
        return conform(df, "route_days")

    @cached_property
    def commercial_structure(self) -> DataFrame:
        df = self.table("customer").filter("c_custkey % 43 <> 0").selectExpr(
            "CAST(c_custkey AS STRING) AS netsuite_id", "concat('T', c_custkey % 4) AS tipo_cliente",
            "'ACTIVE' AS status", "concat('R', c_custkey % 9) AS ruta",
            "concat('R', c_custkey % 9) AS ruta_canon",
            "CASE WHEN c_custkey % 10 <> 0 THEN concat('S', c_custkey % 9) END AS supervisor",
            "CASE WHEN c_custkey % 7 <> 0 THEN concat('O', c_custkey % 3) END AS oficina",
            "CASE WHEN c_custkey % 6 <> 0 THEN concat('G', c_custkey % 2) END AS region",
            "DATE'1995-01-01' AS fecha_inicio", "'shop' AS data_source")
        return conform(df, "commercial_structure")

    @cached_property
    def route_mapping(self) -> DataFrame:
        df = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        return conform(df.selectExpr(
            "concat('R', n_nationkey) AS ruta", "concat('TEAM ', n_name) AS equipo",
            "concat('OFFICE ', r_name) AS oficina", "r_name AS region", "'MX' AS pais"),
            "route_mapping")

    @cached_property
    def _sale_lines(self) -> DataFrame:
        channel = ("CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Fuerza de Ventas'"
                   " WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'Marketplace' END")
        zero = "IF(o_orderkey % 43 = 0, 0.0, {})"
        return self.table("orders").join(
            self.table("lineitem"), F.expr("l_orderkey = o_orderkey")).selectExpr(
            "CAST(o_custkey AS STRING) AS ns_id", "concat('SO', o_orderkey) AS so_id",
            "CAST(o_orderdate AS DATE) AS fecha_creacion_mx", f"{channel} AS clase_canal",
            "o_orderstatus AS status_pedido", "CAST(l_partkey AS STRING) AS item_itemid",
            "l_linestatus", zero.format("l_quantity") + " AS q",
            zero.format("l_extendedprice") + " AS a", "year(o_orderdate) AS y")

    @cached_property
    def orders_old(self) -> DataFrame:
        df = self._sale_lines.filter("y < 1999").selectExpr(
            "*", "q AS cantidad_piezas", "a AS monto_venta")
        return conform(df, "orders_old")

    @cached_property
    def orders_new(self) -> DataFrame:
        df = self._sale_lines.filter("y >= 1999").selectExpr(
            "*", "IF(l_linestatus = 'F', q, NULL) AS quantity_completed",
            "IF(l_linestatus = 'F', NULL, q) AS quantity_in_progress",
            "IF(l_linestatus = 'F', a, NULL) AS amount_completed",
            "IF(l_linestatus = 'F', NULL, a) AS amount_in_progress")
        return conform(df, "orders_new")

    @cached_property
    def service_profile(self) -> DataFrame:
        df = self.table("customer").filter("c_custkey % 2 = 1").selectExpr(
            "c_custkey AS id_cliente",
            "CASE c_custkey % 3 WHEN 0 THEN '01-Healthy' WHEN 1 THEN '02-Mixed'"
            " ELSE '03-Mostly Fraud' END AS transactional_profile")
        return conform(df, "service_profile")

    @cached_property
    def cohort_cac(self) -> DataFrame:
        """Acquisition cost by order month, made of the number of customers of the month."""
        df = self.table("orders").groupBy(
            F.date_format("o_orderdate", "yyyy-MM").alias("enrollment_cohort")).agg(
            (F.count_distinct("o_custkey") / 2).alias("cac"))
        return conform(df, "cohort_cac")

    @cached_property
    def contest_customers(self) -> DataFrame:
        df = self.table("customer").filter("c_custkey % 3 = 1").selectExpr(
            "CAST(c_custkey AS STRING) AS netsuite_id", "c_custkey AS netsuite_id_num",
            "c_acctbal + 2000 AS linea_nueva", "c_mktsegment AS clasificacion",
            "concat('R', c_custkey % 9) AS ruta_preventa", "concat('O', c_custkey % 3) AS oficina_venta",
            "concat('S', c_custkey % 9) AS supervisor")
        return conform(df, "contest_customers")
