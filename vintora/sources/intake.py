"""Loads of the staging tables: full, or the window of recent and still open rows.

With all tables loaded a ``Book`` over the ``Staging`` computes what it does over the sources.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vintora.functions import OFFSET_MS
from vintora.params import FINAL_STATES, Terms
from vintora.sources import load
from vintora.sources.parts import PartedTable
from vintora.sources.rejects import counted
from vintora.sources.schemas import conform, schema_of

KEEP = 3
LOG_SCHEMA = """started_at TIMESTAMP_NTZ, table_name STRING, mode STRING, rows BIGINT,
    seconds DOUBLE, definition STRING"""


@dataclass(frozen=True)
class Rule:
    """How a table changes. Without ``at`` it is always loaded in full."""

    table: str
    at: str | None = None
    key: str | None = None
    status: str | None = None
    final: tuple[str, ...] = ()


# The order lines are the only table with a window.
RULES = (
    Rule("credit_order", "createdAt", "salesOrderId", "orderStatus", FINAL_STATES),
    Rule("payment_report"), Rule("state_of_delivery"), Rule("customers"), Rule("credit_request"),
    Rule("credit_approval"), Rule("pre_authorization"), Rule("revenue_orders"),
    Rule("mirror_transaction"), Rule("credit_limit_history"),
    # From the warehouse.
    Rule("commercial_structure"), Rule("route_mapping"), Rule("route_days"), Rule("orders_old"),
    Rule("orders_new"),
    # From files.
    Rule("service_profile"), Rule("cohort_cac"), Rule("contest_customers"),
)


REJECTED_SCHEMA = "started_at TIMESTAMP_NTZ, table_name STRING, column_name STRING, values BIGINT"


class Staging:
    """The stored staging tables and the log of their loads, below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._log = load.VersionedTable(spark, f"{self.folder}/_runs")
        self._rejected = load.VersionedTable(spark, f"{self.folder}/_rejected")

    def table(self, name: str) -> load.VersionedTable | PartedTable:
        """Tables with a window are kept by the month of creation, the others in versions."""
        rule = next((r for r in RULES if r.table == name), Rule(name))
        if rule.at is None:
            return load.VersionedTable(self.spark, f"{self.folder}/{name}")
        created = F.to_timestamp_ntz(F.timestamp_millis(F.col(rule.at).cast("bigint")))
        return PartedTable(self.spark, f"{self.folder}/{name}", schema_of(name), created)

    def __getattr__(self, name: str) -> DataFrame:
        """A staging table as an attribute, so that a Book can read from here."""
        if name.startswith("_"):
            raise AttributeError(name)
        stored = self.table(name)
        if not stored.exists():
            raise AttributeError(f"{name} has not been loaded")
        return stored.read()

    def version(self, name: str) -> str:
        """A mark that changes with every load that changes the table."""
        stored = self.table(name)
        return stored.state() if isinstance(stored, PartedTable) else str(stored.versions())

    def probe(self, name: str, at: str | None = None) -> DataFrame:
        """(table_name, rows, last): the rows of a stored table and the greatest value of a number or
        date column, from the footers of its files."""
        df = load.from_footers(self.spark, self.table(name).files(), schema_of(name))
        marks = [F.count(F.lit(1)).alias("rows")] + ([F.max(at).alias("last")] if at else [])
        found = df.agg(*marks)
        return found.select(F.lit(name).alias("table_name"), "rows", (
            F.col("last").cast("double") if at else F.lit(None).cast("double")).alias("last"))

    def log(self) -> DataFrame:
        if self._log.exists():
            return self._log.read()
        return self.spark.createDataFrame([], LOG_SCHEMA)

    def record(self, entries: list[tuple]) -> None:
        rows = self.spark.createDataFrame(entries, LOG_SCHEMA)
        self._log.replace(load.append_new(self.log(), rows, ["started_at", "table_name"]),
                          keep=KEEP)

    def rejected(self) -> DataFrame:
        """Per load, table and column: the values that became NULL because they do not parse."""
        if self._rejected.exists():
            return self._rejected.read()
        return self.spark.createDataFrame([], REJECTED_SCHEMA)

    def record_rejected(self, started: dt.datetime, table: str, counts: dict[str, int]) -> None:
        found = [(started, table, c, n) for c, n in sorted(counts.items()) if n]
        if found:
            rows = self.spark.createDataFrame(found, REJECTED_SCHEMA)
            self._rejected.replace(load.append_new(
                self.rejected(), rows, ["started_at", "table_name", "column_name"]), keep=KEEP)

    def last_full(self, table: str) -> dt.datetime | None:
        """One value per table of a short log."""
        return self.log().filter((F.col("table_name") == table) & (F.col("mode") == "full")).agg(
            F.max("started_at")).first()[0]


def load_table(staging: Staging, source: DataFrame, rule: Rule, terms: Terms, full: bool = False
               ) -> tuple:
    """Load one table and return its log entry. A source without rows leaves the table as is."""
    begun = time.time()
    stored = staging.table(rule.table)
    mode = load.load_mode(full, rule.at is not None and stored.exists(),
                          staging.last_full(rule.table), terms.now, terms.full_reload_days)
    flat = load.flatten(source)
    if rule.at is None:
        checked, seen = counted(flat, schema_of(rule.table))
        rows = stored.replace(conform(checked, rule.table), keep=KEEP)
    else:
        rows, seen = _load_parts(staging, stored, flat, rule, terms, mode)
    if seen is not None:
        staging.record_rejected(terms.now, rule.table, seen.get)
    return (terms.now, rule.table, mode, rows, time.time() - begun,
            load.definition_hash(repr(rule)))


def _load_parts(staging: Staging, stored: PartedTable, flat: DataFrame, rule: Rule, terms: Terms,
                mode: str) -> tuple[int, Observation | None]:
    """Load all months, or the window and the older rows that can still change; returns the number
    of rows that came in. Of the stored months only those are read and written that the load touches."""
    if mode == "full":
        # Every part is replaced, so nothing has to be known of the rows before they are written.
        checked, seen = counted(flat, schema_of(rule.table))
        return stored.replace(conform(checked, rule.table), required=True), seen
    extract = load.VersionedTable(staging.spark, load.scratch(staging.spark, rule.table))
    edge = terms.now - dt.timedelta(days=terms.mutable_days)
    # The documents hold UTC.
    since = (edge - dt.datetime(1970, 1, 1)).total_seconds() * 1000 + OFFSET_MS
    cutoff = F.lit(since)
    current = stored.read()
    refresh = load.refresh_keys(current, rule.key, rule.status, rule.final, rule.at, cutoff)
    # The source is read once: what is counted is what is merged.
    checked, seen = counted(load.window_or_keys(flat, rule.at, cutoff, rule.key, refresh),
                            schema_of(rule.table))
    rows = extract.replace(conform(checked, rule.table))
    incoming = extract.read()
    first = (dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=since)).strftime("%Y-%m")
    # Rows without a time sort behind all months.
    window = {p for p in stored.parts() if p >= first}
    older = stored.touched(current.filter((F.col(rule.at) < cutoff) | F.col(rule.at).isNull()).join(
        refresh, rule.key, "left_semi"))
    months = window | older | stored.touched(incoming)
    stored.write(load.window_replace(stored.read(months), incoming, rule.at, cutoff, rule.key,
                                     refresh), months)
    return rows, seen


def load_all(staging: Staging, sources: Mapping[str, DataFrame], terms: Terms, full: bool = False,
             only: list[str] | None = None) -> list[tuple]:
    """Load the tables in order; unknown names are an error.

    Each load is logged when it is done, so one that fails later does not hide it.
    """
    known = {r.table: r for r in RULES}
    unknown = [n for n in only or [] if n not in known]
    if unknown:
        raise KeyError(f"unknown tables {unknown}; known are {list(known)}")
    entries = []
    for name, rule in known.items():
        if name in sources and (not only or name in only):
            entries.append(load_table(staging, sources[name], rule, terms, full))
            staging.record(entries[-1:])
    return entries
