"""Event catalogs: CSV scan with strict missing-value rules, union, versioned write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that a catalog CSV uses for a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_CSV = {"header": "true", "multiLine": "true", "escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CORRUPT = "_corrupt_row"


class NoCatalog(ValueError):
    """The file has no header, or rows longer than its header: there is nothing to measure."""


def known(column: Column) -> Column:
    """``column`` with every missing token as null; white space and ``-`` are values."""
    return F.when(column.isin(*MISSING_TOKENS), None).otherwise(column)


def recognise_missing(df: DataFrame) -> DataFrame:
    """Missing tokens of all string columns as null; other columns as they are."""
    return df.select(*[known(df[f.name]).alias(f.name) if isinstance(f.dataType, T.StringType) else df[f.name] for f in df.schema])


def scan_csv(spark: SparkSession, path: str, with_corrupt: bool = False) -> DataFrame:
    """A catalog CSV as strings, missing tokens as null.

    Short rows are padded with nulls. Rows longer than the header are corrupt: they are
    left out, or kept in ``_corrupt_row`` if asked for. A file without a header raises
    ``NoCatalog``; one with a header only is an empty table. Of equal header names the first counts.
    """
    header = spark.read.options(**_CSV).option("inferSchema", "false").csv(path)
    names = header.columns
    if not names:
        raise NoCatalog(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.options(**_CSV, columnNameOfCorruptRecord=CORRUPT, enforceSchema="true").schema(schema).csv(path)
    # Short rows are marked too. A marked row is long if its last named field is there, or by its
    # number of fields (commas outside of quotes), as empty fields are read like absent ones.
    bare = F.regexp_replace(CORRUPT, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    bad = F.col(CORRUPT).isNotNull() & (F.col(f"`{names[-1]}`").isNotNull() | (fields > len(names)))
    values = [known(F.col(f"`{n}`")).alias(n) for n in names]
    kept = rows.select(*values, F.when(bad, F.col(CORRUPT)).alias(CORRUPT), bad.alias("_bad"))
    if with_corrupt:
        return kept.drop("_bad")
    return kept.where(~F.col("_bad")).drop("_bad", CORRUPT)


def write_csv(df: DataFrame, root: str, version: int) -> str:
    """Write a catalog as ``root/version=N``; a version is never overwritten while it is read."""
    path = f"{root.rstrip('/')}/version={version}"
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("errorifexists").options(header="true", escape='"', emptyValue="", **spaces).csv(path)
    return path


def union_catalogs(*catalogs: DataFrame) -> DataFrame:
    """All rows of all catalogs; columns in first-seen order, absent ones null. Nothing is deduplicated."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), catalogs)


def preview(catalog: DataFrame, order: str, rows: int = 19) -> DataFrame:
    """The first rows of a catalog (a report of fixed length)."""
    return catalog.orderBy(order).limit(rows)
