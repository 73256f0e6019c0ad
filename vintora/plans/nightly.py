"""One night: loads, freshness gate, rebuild, views, checks and their history, the verdict."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.functions import stamp
from vintora.plans import build, quality
from vintora.plans.book import Book
from vintora.sources import intake
from vintora.sources.load import VersionedTable

# Without these sources the results would be wrong.
CRITICAL_SOURCES = ("credit_order", "payment_report", "state_of_delivery")


@dataclass
class Night:
    stopped_by: list[str] = field(default_factory=list)
    log: list[dict] = field(default_factory=list)
    views: list[str] = field(default_factory=list)
    broken: list[str] = field(default_factory=list)
    loads: list[tuple] = field(default_factory=list)
    alerts: list[str] = field(default_factory=list)
    closing: list[tuple[str, str]] = field(default_factory=list)

    @property
    def exit_code(self) -> int:
        return 1 if self.stopped_by or self.broken else 0


def run(book: Book, folder: str, status: DataFrame | None = None,
        critical: tuple[str, ...] = CRITICAL_SOURCES, *,
        load_into: intake.Staging | None = None, sources: Mapping[str, DataFrame] | None = None,
        checked: dict[str, DataFrame] | None = None,
        probe: Callable[[], DataFrame] | None = None, at: dt.datetime | None = None) -> Night:
    """Load, rebuild what has changed, and publish, unless a critical source is stale.

    ``sources`` are loaded into ``load_into`` first. ``checked`` are the tables of the row checks,
    whose results join the history below ``folder``; alerts the last run did not have are
    reported. ``probe`` measures freshness again at the end. The run goes on to its end when a
    check or an identity breaks, and says so in its exit code.
    """
    night = Night()
    at = at or book.terms.now
    if load_into is not None and sources:
        night.loads = intake.load_all(load_into, sources, book.terms)
    if status is not None:
        night.stopped_by = quality.blocked(status, list(critical))
        if night.stopped_by:
            return night
    night.log = build.rebuild(book, folder, changed=True)
    spark = book.source.spark
    _append(folder, "_build_log", spark.createDataFrame(
        [(e["table_name"], e["rows"], e["seconds"], e["definition"]) for e in night.log],
        "table_name STRING, rows BIGINT, seconds DOUBLE, definition STRING"), at)
    night.views = build.publish(book)
    if checked is not None:
        results = quality.run_checks(quality.row_checks(book.terms), checked, spark)
        history = _append(folder, "_checks", results.select(
            "check_name", "severity", "rows", "result"), at)
        # One row per check at most.
        night.alerts = sorted(r["check_name"] for r in quality.new_alerts(history).collect())
    night.broken = quality.broken(quality.identities(build.identity_pairs(book)))
    if probe is not None:
        night.closing = [(r["source"], r["lamp"]) for r in probe().select("source", "lamp").collect()]
    return night


def _append(folder: str, name: str, rows: DataFrame, at: dt.datetime) -> DataFrame:
    """Add a run's rows to a log; the same run again replaces its own."""
    table = VersionedTable(rows.sparkSession, f"{folder}/{name}")
    new = rows.select(stamp(at).alias("run_at"), "*")
    if table.exists():
        new = table.read().filter(F.col("run_at") != stamp(at)).unionByName(new)
    table.replace(new, keep=build.KEEP)
    return table.read()
