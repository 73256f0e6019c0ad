"""Contracts of the files that people hand in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintora.functions import int_key
from vintora.sources.load import read_contract, read_ordered
from vintora.sources.rejects import Checked, check_file
from vintora.sources.schemas import conform, schema_of

# Columns each file must have, and their staging names.
FILES = {
    "pair_odds": {
        "loanDisbursementIndexRange": "loan_disbursement_index_range", "flag": "flag",
        "atr1": "atr1", "atr2": "atr2", "atr1Rank": "atr1_rank", "atr2Rank": "atr2_rank",
        "events": "events", "good": "good", "bad": "bad", "br": "br", "bad_rate": "bad_rate",
        "%good": "pct_good", "%bad": "pct_bad", "woe": "woe", "iv": "iv"},
    "pair_iv": {
        "loanDisbursementIndexRange": "loan_disbursement_index_range", "flag": "flag",
        "combination": "combination", "number_of_combinations": "number_of_combinations",
        "iv": "iv"},
    "service_profile": {"Id cliente": "id_cliente", "transactionalProfile": "transactional_profile"},
    "cohort_cac": {"enrollmentCohort": "enrollment_cohort", "cac": "cac"},
}
# Ordered header of the contest file. The last one is not a route: it holds the
# supervisor, and differs from the fourth in one capital letter only.
CONTEST_HEADER = ["Netsuite", "Línea Nueva", "Clasificación", "Ruta Preventa", "Oficina Venta",
                  "Ruta preventa"]
CONTEST_COLUMNS = ["netsuite_id", "linea_nueva", "clasificacion", "ruta_preventa", "oficina_venta",
                   "supervisor"]


def read_file(spark: SparkSession, table: str, path: str) -> DataFrame:
    """One of the contract files in its staging format."""
    types = {f.name: f.dataType.simpleString() for f in schema_of(table)
             if f.dataType.simpleString() != "string"}
    return conform(read_contract(spark, path, FILES[table], types), table)


# Columns without which a line of a file says nothing.
REQUIRED = {
    "pair_odds": ("loan_disbursement_index_range", "flag", "atr1", "atr2"),
    "pair_iv": ("loan_disbursement_index_range", "flag", "combination"),
    "service_profile": ("id_cliente", "transactional_profile"),
    "cohort_cac": ("enrollment_cohort",),
}


def check(spark: SparkSession, table: str, path: str) -> Checked:
    """One of the contract files, with the lines that do not keep the contract set aside."""
    return check_file(spark, path, FILES[table], schema_of(table), REQUIRED[table])


def read_contest(spark: SparkSession, path: str) -> DataFrame:
    """The contest customers; columns are taken by position."""
    rows = read_ordered(spark, path, CONTEST_HEADER, CONTEST_COLUMNS, "netsuite_id",
                        ["linea_nueva"])
    return conform(rows.withColumn("netsuite_id_num", int_key("netsuite_id")), "contest_customers")


def clean_combination(column) -> Column:
    """An attribute pair as text: quotes, blanks and brackets out, blanks around the ampersand."""
    return F.replace(F.translate(column, "' []", ""), F.lit("&"), F.lit(" & "))


def combination_id(*parts) -> Column:
    return F.concat_ws("_", *parts)
