"""Table scan and sink with an explicit schema and one notion of missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import field
from .records import csv_records

# Text that a CSV reader with default settings takes as missing.
# "?" is not among them: it stays an ordinary category.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The encounter table's columns in file order, numeric ones typed.
ENCOUNTER_COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight", "admission_type_id", "discharge_disposition_id",
    "admission_source_id", "time_in_hospital", "payer_code", "medical_specialty", "num_lab_procedures",
    "num_procedures", "num_medications", "number_outpatient", "number_emergency", "number_inpatient", "diag_1",
    "diag_2", "diag_3", "number_diagnoses", "max_glu_serum", "A1Cresult", "metformin", "repaglinide", "nateglinide",
    "chlorpropamide", "glimepiride", "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide", "examide", "citoglipton", "insulin",
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone", "metformin-rosiglitazone",
    "metformin-pioglitazone", "change", "diabetesMed", "readmitted",
]
ENCOUNTER_NUMERIC = frozenset([
    "encounter_id", "patient_nbr", "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient",
    "number_emergency", "number_inpatient", "number_diagnoses",
])


def encounter_schema() -> T.StructType:
    return T.StructType(
        [T.StructField(c, T.LongType() if c in ENCOUNTER_NUMERIC else T.StringType()) for c in ENCOUNTER_COLUMNS]
    )


# Standard quoting: quotes inside a cell are doubled, white space and line breaks belong to the cell.
_CSV = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def normalise_missing(df: DataFrame) -> DataFrame:
    """Null tokens in text and NaN in floating columns become NULL; a projection."""
    out = {}
    for f in df.schema.fields:
        col = field(f.name)
        if isinstance(f.dataType, T.StringType):
            out[f.name] = F.when(~col.isin(*NULL_TOKENS), col)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.when(~F.isnan(col), col)
    return df.withColumns(out) if out else df


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. No inference: both sides of a comparison must agree.

    Numbers are read as text and cast leniently, so that a null token or a bad
    cell in a numeric column gives NULL rather than an error. A cell may hold
    line breaks; files are split all the same. A header with other names is an
    error, at the first row that is read of its file.
    """
    schema = schema or encounter_schema()
    cells = ", ".join(f"c{i} STRING" for i in range(len(schema.fields)))
    options = {k: str(v) for k, v in _CSV.items() if k != "header"} | {"multiLine": "true"}
    rows = csv_records(spark, path).select("is_header", F.from_csv("record", cells, options).alias("row"))
    names = F.array(*[F.col(f"row.c{i}") for i in range(len(schema.fields))])
    wrong = F.raise_error(F.concat(F.lit("the header does not name the columns of the schema: "), F.to_json(names)))
    expected = names == F.array(*[F.lit(f.name) for f in schema.fields])
    data = ~F.col("is_header") | F.when(expected, False).otherwise(wrong.cast("boolean"))
    named = [F.col(f"row.c{i}").alias(f.name) for i, f in enumerate(schema.fields)]
    clean = normalise_missing(rows.where(data).select(*named))
    return clean.select(
        *[
            field(f.name) if isinstance(f.dataType, T.StringType)
            else field(f.name).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_table_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_CSV).csv(path)


def write_snapshot(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scored rows kept as the baseline or current input of a later check."""
    df.write.mode(mode).parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
