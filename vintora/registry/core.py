"""How a registered query is declared and published.

A query is a builder over a ``Book``, the columns it publishes, and the SQL that checks it. The
column list drives both sides, so names and roundings cannot drift apart. Marks: ``:m`` amount
(rounded to 5 places, the finest that products of cents and rates have; from ten million on to
cents, as a double holds no more of a long sum), ``:r`` ratio (6 places), ``:t`` date or time as
text, ``:i`` whole number.

Rounding is half up; what lies within a ten-thousandth of a last place below a half counts as the
half, since sums added up in another order may fall on either side of it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintora.plans import credit
from vintora.plans.book import Book
from vintora.plans.consumers import READY
from vintora.registry.views import with_views


_AMOUNT_SQL = ("CASE WHEN abs(CAST({0} AS DOUBLE)) >= 1e7"
               " THEN floor(CAST({0} AS DOUBLE) * 1e2 + 0.5005) / 1e2"
               " ELSE floor(CAST({0} AS DOUBLE) * 1e5 + 0.5001) / 1e5 END")


def _amount(c: Column) -> Column:
    x = c.cast("double")
    return F.when(F.abs(x) >= 1e7, F.floor(x * 1e2 + 0.5005) / 1e2).otherwise(
        F.floor(x * 1e5 + 0.5001) / 1e5)


_SHAPE = {"m": _amount,
          "r": lambda c: F.floor(c.cast("double") * 1e6 + 0.5001) / 1e6,
          "t": lambda c: c.cast("string"), "i": lambda c: c.cast("bigint"),
          "": lambda c: c}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Book], DataFrame]
    columns: str
    sql: str | None = None

    def _fields(self) -> list[tuple[str, str]]:
        return [tuple((f + ":").split(":")[:2]) for f in self.columns.split()]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Book.open(spark, sf_dir))
        return df.select(*[_SHAPE[mark](F.col(f"`{name}`")).alias(name)
                           for name, mark in self._fields()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        shape = {"m": _AMOUNT_SQL,
                 "r": "floor(CAST({} AS DOUBLE) * 1e6 + 0.5001) / 1e6", "t": "CAST({} AS VARCHAR)", "i": "CAST({} AS BIGINT)", "": "{}"}
        fields = ", ".join(f'{shape[mark].format(f"{chr(34)}{name}{chr(34)}")} AS "{name}"'
                           for name, mark in self._fields())
        body = self.sql if self.sql.lstrip().upper().startswith(("SELECT", "WITH")) \
            else f"SELECT * FROM {self.sql}"
        return with_views_around(fields, body)


@dataclass(frozen=True)
class SnapshotQuery(Query):
    """Rows of the month-end snapshot. ``shown`` lists (published name, column, cast); what hangs on the
    loan alone or on the month end alone is published once per loan or month end, before a loan is
    opened at its month ends."""

    shown: list | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        book = Book.open(spark, sf_dir)
        marks = dict(self._fields())
        shown = self.shown or [(name, name, F.col) for name in marks]
        ready = {origin: {READY.format(n): _SHAPE[marks[n]](cast(c)) for n, c, cast in shown
                          if n in marks and c in origin}
                 for origin in (credit.FROM_LOAN, credit.FROM_CUTOFF)}
        book.__dict__["snapshot"] = credit.month_end_snapshot(
            book.loans, book.due_months, ready[credit.FROM_LOAN], ready[credit.FROM_CUTOFF])
        made = {n for columns in ready.values() for n in columns}
        df = self.build(book)
        return df.select(*[
            F.col(READY.format(n) if READY.format(n) in df.columns else f"`{n}`").alias(n)
            if READY.format(n) in made else _SHAPE[mark](F.col(f"`{n}`")).alias(n)
            for n, mark in self._fields()])


def with_views_around(fields: str, body: str) -> str:
    return with_views(f"SELECT {fields} FROM ({body}) published")
