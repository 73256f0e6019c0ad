"""What does not fit when text becomes typed values: rejected rows of files, counts of documents."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintora.functions import has_text
from vintora.operators.relational import unpivot_steps
from vintora.sources.load import BrokenContract, scratch

_BROKEN = "_broken_line"


class Checked(NamedTuple):
    """The rows that fit, the problems of the others, and how many there are of each.

    ``problems`` has one row per problem: the line as JSON, its column, the value and the reason.
    """

    rows: DataFrame
    problems: DataFrame
    counts: dict[str, int]


def unread(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """Per column that has to be read from text: the text is there and is no such value."""
    return {
        f.name: has_text(F.col(f"`{f.name}`")) & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()
        for f in schema if f.name in df.columns and not isinstance(f.dataType, T.StringType)
        and isinstance(df.schema[f.name].dataType, T.StringType)}


def read_lines(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A CSV file as text under its staging names, and lines with too few or too many fields
    beside it in ``_broken_line``."""
    found = spark.read.csv(path, header=True).columns
    missing = [c for c in columns if c not in found]
    if missing:
        raise BrokenContract(f"{path}: missing columns {missing}, found {found}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*found, _BROKEN]])
    # Without pruning the parser sees all fields of a line, also those that nobody selects.
    raw = spark.read.option("columnPruning", "false").csv(
        path, header=True, schema=schema, columnNameOfCorruptRecord=_BROKEN, mode="PERMISSIVE")
    return raw.select(*[F.trim(f"`{source}`").alias(name) for source, name in columns.items()], _BROKEN)


def check_file(spark: SparkSession, path: str, columns: dict[str, str], schema: T.StructType,
               required: tuple[str, ...] = ()) -> Checked:
    """Read a file once: rows that fit in the types of ``schema``, all others with their reasons.

    The lines are written once with their problems, counted on the way, and both results read that.
    """
    lines = read_lines(spark, path, columns)
    kinds = {f.name: f.dataType for f in schema}

    def problem(column: str, value: Column, reason: str, holds: Column) -> Column:
        return F.when(holds, F.struct(F.lit(column).alias("column"), value.alias("value"),
                                      F.lit(reason).alias("reason")))

    whole = F.col(_BROKEN).isNull()
    found = [problem("", F.col(_BROKEN), "wrong number of fields", ~whole)]
    found += [problem(n, F.col(f"`{n}`"), f"is no {kinds[n].simpleString()}", whole & bad)
              for n, bad in unread(lines, schema).items()]
    found += [problem(n, F.lit(None).cast("string"), "is missing",
                      whole & ~F.coalesce(has_text(F.col(f"`{n}`")), F.lit(False)))
              for n in required]
    names = list(columns.values())
    marked = lines.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("line"),
        F.array_compact(F.array(*found)).alias("problems"))
    seen = Observation()
    where = scratch(spark, "checked")
    bad = F.size("problems") > 0
    columns_of = F.col("problems.column")
    marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected"), *[
        F.count_if(F.array_contains(columns_of, n)).alias(f"in {n}") for n in names]
    ).write.parquet(where)
    stored = spark.read.schema(marked.schema).parquet(where)
    rows = stored.filter(~bad).select(*[
        F.col(f"line.`{n}`").try_cast(kinds.get(n, T.StringType())).alias(n) for n in names])
    problems = stored.filter(bad).select(
        F.to_json("line", {"ignoreNullFields": "false"}).alias("line"), F.inline("problems"))
    return Checked(rows, problems, dict(seen.get))


def dry_run(checked: Checked) -> DataFrame:
    """What a load would do: per column its type, the filled and distinct values of the rows that
    fit, and the rejected ones."""
    rows = checked.rows
    cells = unpivot_steps(rows, [
        (F.lit(name), F.lit(kind), F.col(f"`{name}`").cast("string"),
         F.lit(checked.counts[f"in {name}"])) for name, kind in rows.dtypes],
        ("_column", "_type", "_value", "_rejected"))
    return cells.groupBy(F.col("_column").alias("column"), F.col("_type").alias("type"),
                         F.col("_rejected").alias("rejected")).agg(
        F.count("_value").alias("filled"), F.count_distinct("_value").alias("distinct"))


def counted(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Observation | None]:
    """The frame, and the counts of values per column that will be NULL because they do not parse,
    to be had when it has been written."""
    found = unread(df, schema)
    if not found:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.count_if(bad).alias(n) for n, bad in found.items()]), seen
