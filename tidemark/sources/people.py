"""A small JSON list with stand-in rows, and one message per entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows used when the source cannot be read, with their count.
FALLBACK_PEOPLE = (
    ("ISS", "Oleg Kononenko"), ("ISS", "Nikolai Chub"), ("ISS", "Tracy Caldwell Dyson"),
    ("ISS", "Matthew Dominick"), ("ISS", "Michael Barratt"), ("ISS", "Jeanette Epps"),
    ("ISS", "Alexander Grebenkin"), ("ISS", "Butch Wilmore"), ("ISS", "Sunita Williams"),
    ("Tiangong", "Li Guangsu"), ("Tiangong", "Li Cong"), ("Tiangong", "Ye Guangfu"),
)
LIST_SCHEMA = "number int, people array<struct<craft:string,name:string>>"
# Fixed value.
GREETING = "Hello! :)"


def read_people(spark: SparkSession, path: str | None = None) -> DataFrame:
    """One row (number, people); the stand-in list when ``path`` cannot be read."""
    if path is not None:
        try:
            rows = spark.read.schema(LIST_SCHEMA).option("multiLine", True).json(path)
            if rows.where("people is not null").limit(1).count():
                return rows
        except Exception as missing:  # noqa: BLE001 - any unreadable source falls back
            print(f"people list not readable, using the stand-in rows: {type(missing).__name__}")
    return spark.createDataFrame([(len(FALLBACK_PEOPLE), list(FALLBACK_PEOPLE))], LIST_SCHEMA)


def people_messages(lists: DataFrame, greeting: str = GREETING) -> DataFrame:
    """(name, craft, message): the per-entry step, one row per list element."""
    rows = lists.select(F.explode("people").alias("p")).select("p.name", "p.craft")
    return rows.withColumn("message", greeting_line(F.col("name"), F.col("craft"), greeting))


def greeting_line(name: Column, craft: Column, greeting: str = GREETING) -> Column:
    return F.format_string("%s is currently in space flying on the %s! %s", name, craft, F.lit(greeting))
