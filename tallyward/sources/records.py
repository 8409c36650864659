"""Record tables as landed CSV exports."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyward.operators.columns import rename_all


def read_records(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Read an export: header row, empty fields null, the text ``NA`` kept.

    Rows that are too short are filled up with nulls, unless ``mode="FAILFAST"``.
    Columns are text unless ``schema`` is given; header names are checked against
    it in every file. Fields may hold quoted line breaks, so a file is one task
    and an export is spread by landing it as many files. Where fields are known to
    hold none, ``multi_line=False`` lets Spark split single files too.
    """
    reader = spark.read.options(
        header=True,
        multiLine=multi_line,
        quote='"',
        escape='"',
        nullValue="",
        enforceSchema=False,
        mode=mode,
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def normalize_names(df: DataFrame) -> DataFrame:
    """Turn each run of underscores in the column names into one.

    Fails if two names become the same, instead of leaving an ambiguous column.
    """
    return rename_all(df, lambda name: re.sub("_+", "_", name))


def load_inputs(
    spark: SparkSession,
    paths: Mapping[str, str | list[str]],
    *,
    schemas: Mapping[str, T.StructType] | None = None,
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Read several exports the same way, with clean column names."""
    schemas = schemas or {}
    return {
        name: normalize_names(
            read_records(spark, path, schema=schemas.get(name), multi_line=multi_line)
        )
        for name, path in paths.items()
    }
