"""Tables kept as one Parquet folder per year, month or day of a time that never changes for a row.

A load rewrites the parts it touches and leaves the files of all others alone: Spark's dynamic
partition overwrite replaces exactly the parts that the written rows belong to. A part whose last row
goes is removed. Writing the same rows again gives the same table, so a load that broke off is simply
run once more.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintora.session import freeing_shuffles
from vintora.sources.load import EmptyLoad

PART = "part_"
#: Rows without a time.
NO_TIME = "none"
YEAR, MONTH, DAY = "yyyy", "yyyy-MM", "yyyy-MM-dd"


class PartedTable:
    """``at`` is the time that decides about the part, a column or an expression over the row.
    Without a schema the files say what they hold: enough to read, not to write."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str | None,
                 at: Column, unit: str = MONTH):
        self.spark, self.path, self.at, self.unit = spark, path.rstrip("/"), at, unit
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._files = spark._jvm.org.apache.hadoop.fs
        self._fs = self._files.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def part(self, at: Column) -> Column:
        return F.coalesce(F.date_format(at, self.unit), F.lit(NO_TIME))

    def parts(self) -> list[str]:
        """The stored parts, as many as months or days; names only, no file is opened."""
        root = self._files.Path(self.path)
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(n[len(PART) + 1:] for n in names if n.startswith(f"{PART}="))

    def exists(self) -> bool:
        return bool(self.parts())

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows, or those of some parts; other folders are not listed."""
        folders = self.files(parts)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(*folders)

    def files(self, parts: Iterable[str] | None = None) -> list[str]:
        """The folders of all or of some parts."""
        names = self.parts() if parts is None else [p for p in self.parts() if p in set(parts)]
        return [f"{self.path}/{PART}={n}" for n in names]

    def touched(self, df: DataFrame) -> set[str]:
        """The parts that rows belong to: one value per month or day."""
        return {r[0] for r in df.select(self.part(self.at)).distinct().collect()}

    def write(self, df: DataFrame, parts: set[str], required: bool = False) -> bool:
        """Replace these parts by the rows of ``df``, all of which belong to them or to new parts;
        returns whether there were rows. If some are ``required``, none mean no change and an error.

        ``df`` may read the parts that it replaces: they change when all rows are written.
        """
        placed = df.select(*self.schema.names).withColumn(PART, self.part(self.at))
        # A hint and no fixed number: a large month gets as many files as its size asks for.
        return self._overwrite(placed.hint("rebalance", PART).sortWithinPartitions(PART), parts, required)

    def write_part(self, df: DataFrame, part: str) -> bool:
        """Replace one part by the rows of ``df``, all of which belong to it, as they come: nothing is
        shuffled or sorted, and each task of ``df`` writes one file."""
        return self._overwrite(df.select(*self.schema.names).withColumn(PART, F.lit(part)), {part})

    def _overwrite(self, placed: DataFrame, parts: set[str], required: bool = False) -> bool:
        before = self._files_of(set(self.parts()))
        writer = placed.write.partitionBy(PART).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic")
        freeing_shuffles(placed.sparkSession, lambda: writer.parquet(self.path))
        after = self._files_of(set(self.parts()))
        some = any(files != before.get(n) for n, files in after.items())
        if required and not some:
            raise EmptyLoad(f"{self.path}: the load has no rows")
        # A part that still has its files got no row: all of its rows have gone.
        for gone in (n for n in before if n in parts and before[n] == after.get(n)):
            self._fs.delete(self._folder(gone), True)
        return some

    def _folder(self, part: str):
        return self._files.Path(f"{self.path}/{PART}={part}")

    def _files_of(self, parts: set[str]) -> dict[str, list[str]]:
        return {n: sorted(s.getPath().getName() for s in self._fs.listStatus(self._folder(n)))
                for n in self.parts() if n in parts}

    def state(self) -> str:
        """The names of all files: they change with every write."""
        return str(self._files_of(set(self.parts())))

    def replace(self, df: DataFrame, required: bool = False) -> int:
        """All rows anew, in one pass; returns their number."""
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        # A plan without rows may be dropped before it has counted them.
        return seen.get["rows"] if self.write(counted, set(self.parts()), required) else 0

    def merge(self, rows: DataFrame, key: list[str]) -> None:
        """Rows of equal key are replaced, others added; ``key`` decides the part."""
        parts = self.touched(rows)
        if parts:
            kept = self.read(parts).join(rows.select(*key), key, "left_anti")
            self.write(kept.unionByName(rows.select(*self.schema.names)), parts)
