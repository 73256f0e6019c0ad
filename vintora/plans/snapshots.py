"""The stored month-end snapshot, brought up to date after late payments.

Payments arrive up to a year and a half late and change months that were closed. A loan stands in the
snapshot at every month end from its due month on, so a changed loan can change nothing before that:
only month ends from the earliest changed due date on are opened again. What the snapshot was made of
is kept as one digest per loan; the change set is the difference between those and the loans of now.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintora.plans import credit
from vintora.sources.load import VersionedTable
from vintora.sources.parts import YEAR, PartedTable

KEY = ["customer_id", "sales_order_id"]
_DUE = "due_month_end"


def digests(loans: DataFrame) -> DataFrame:
    """(key, due month end, digest of all that the snapshot takes from a loan)."""
    used = credit.snapshot_columns(loans)
    # JSON tells a null from an empty text, and one column from the next.
    return loans.filter(F.col(_DUE).isNotNull()).select(
        *KEY, _DUE, F.xxhash64(F.to_json(F.struct(*used), {"ignoreNullFields": "false"})).alias("digest"))


def changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(key, due_before, due_now, change): loans that are new, changed or gone."""
    a, b = before.alias("a"), now.alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEY]
    both = a.join(b, on=same[0] & same[1], how="full")
    return (both.filter(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
            .select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in KEY],
                    F.col(f"a.{_DUE}").alias("due_before"), F.col(f"b.{_DUE}").alias("due_now"),
                    F.when(F.col("a.digest").isNull(), "new").when(F.col("b.digest").isNull(), "gone")
                    .otherwise("changed").alias("change")))


def month_ends(loans: DataFrame) -> list:
    """The month ends with a due loan: as many as months."""
    return sorted(r[0] for r in loans.select(_DUE).filter(F.col(_DUE).isNotNull()).distinct().collect())


class StoredSnapshot:
    """Rows by the year of the month end, and the digests they were made of.

    Inside a year the rows of a loan follow each other, so that what a loan repeats at every month end
    is stored about once a year. The digests become current when the rows are written: a run that broke off between the two is
    repeated by the next one.
    """

    def __init__(self, spark: SparkSession, folder: str, schema=None):
        self.rows = PartedTable(spark, f"{folder}/rows", schema,
                                F.col("cutoff").cast("timestamp_ntz"), YEAR)
        self.made_of = VersionedTable(spark, f"{folder}/made_of")

    def exists(self) -> bool:
        return self.made_of.exists()

    def read(self) -> DataFrame:
        return self.rows.read()

    def opened_from(self, now: DataFrame):
        """The earliest due month end of a changed loan, or None."""
        found = changes(self.made_of.read(), now).agg(
            F.min(F.least("due_before", "due_now"))).first()
        return found[0]

    def refresh(self, loans: DataFrame, rule: str = "") -> list:
        """Bring the rows up to date; returns the month ends that were written.

        ``loans`` are read once for every year to be written, so they should be stored: the rows, many
        times as many as loans, then go from a task straight to its file, without shuffle or sort.
        ``rule`` is a mark of how rows are made; if it is another than before, all are made anew.
        """
        now = digests(loans).withColumn("rule", F.lit(rule))
        ends = month_ends(loans)
        opened = ends
        if self.exists():
            before = self.made_of.read()
            gone = {r[0] for r in before.select(_DUE).distinct().collect()}
            opened = sorted({*ends, *gone})
            if before.first()["rule"] == rule:
                first = self.opened_from(now)
                # A month end that came or went has its loan in the change set: none is earlier.
                opened = [e for e in opened if first is not None and e >= first]
        if not opened:
            return []
        cutoffs = self.rows.spark.createDataFrame([(e,) for e in ends], f"{_DUE} DATE")
        for year in sorted({e.year for e in opened}):
            self.rows.write_part(credit.month_end_snapshot(loans, cutoffs, year=year), str(year))
        self.made_of.replace(now, keep=2)
        return opened
