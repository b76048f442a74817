"""Keyed dimensions (Plate -> Name, Parameter -> Unit).

Dimensions are dictionaries of bounded size (hundreds to thousands of
keys); they are read with the built-in JSON/CSV sources and joined with a
size-checked broadcast (see ``operators.joins.enrich``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dim_from_json_map(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A JSON object ``{key: value, ...}`` -> two-column table.

    Values are kept as text (the unit dictionary has the literal ``"None"``).
    """
    doc = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), "map<string,string>")
    return doc.select(F.explode(m).alias(key, value))


def dim_from_csv(spark: SparkSession, path: str, rename: dict | None = None) -> DataFrame:
    """A CSV with header -> keyed lookup table (all columns text)."""
    df = spark.read.option("header", True).option("multiLine", True).csv(path)
    for a, b in (rename or {}).items():
        df = df.withColumnRenamed(a, b)
    return df


def dim_from_catalog(spark: SparkSession, path: str, list_field: str, id_field: str,
                     value_field: str, key: str | None = None, value: str | None = None,
                     keep: str = "distinct") -> DataFrame:
    """Flatten a saved catalogue payload ``{list_field: [{id, value}, ...]}``.

    ``keep='distinct'`` keeps every distinct (id, value) pair; ``keep='last'``
    keeps, per id, the value listed last in its document (of several
    documents, the last by path; one document per file).
    """
    key, value = key or id_field, value or value_field
    doc = spark.read.option("multiLine", True).json(path)
    doc = doc.withColumn("__doc", F.col("_metadata.file_path"))
    items = doc.select("__doc", F.posexplode(list_field).alias("__pos", "__it"))
    pairs = items.select("__doc", "__pos", F.col(f"__it.{id_field}").cast("string").alias(key),
                         F.col(f"__it.{value_field}").cast("string").alias(value))
    if keep == "distinct":
        return pairs.select(key, value).distinct()
    if keep == "last":
        return pairs.groupBy(key).agg(F.max_by(value, F.struct("__doc", "__pos")).alias(value))
    raise ValueError("keep must be 'distinct' or 'last'")


__all__ = ["dim_from_json_map", "dim_from_csv", "dim_from_catalog"]
