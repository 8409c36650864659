"""Writing derived tables, one folder per reference date."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(path: str, as_of: dt.date) -> str:
    return f"{path}/as_of={as_of.isoformat()}"


def _replaced(path: str, as_of: dt.date) -> str:
    """Where the former rows of a date are while the new ones take their place."""
    return f"{path}/_replaced/as_of={as_of.isoformat()}"


def _paths(spark: SparkSession, *names: str):
    """The file system of some paths, and the paths in its own form."""
    made = [spark._jvm.org.apache.hadoop.fs.Path(n) for n in names]
    return made[0].getFileSystem(spark._jsc.hadoopConfiguration()), *made


def write_product(df: DataFrame, path: str, as_of: dt.date, *, fmt: str = "parquet") -> None:
    """Write a table as partition ``as_of=<date>`` of the table at ``path``.

    A re-run for the same date replaces that partition, also with an empty table, and
    leaves other dates alone, so a periodic job can be repeated after a failure. The new
    rows are written beside the old ones and change places with them when all are there;
    a run that fails before leaves the old rows, and ``df`` may be made from them. Empty
    CSV fields stand for nulls.
    """
    options = {"header": True, "nullValue": "", "escape": '"'} if fmt == "csv" else {}
    written = f"{path}/_written/{as_of.isoformat()}-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(written)
    files, new, now, old = _paths(
        df.sparkSession, written, _folder(path, as_of), _replaced(path, as_of)
    )
    files.mkdirs(old.getParent())
    if files.exists(now):
        files.delete(old, True)
        _rename(files, now, old)
    _rename(files, new, now)
    files.delete(old, True)


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def read_product(spark: SparkSession, path: str, as_of: dt.date) -> DataFrame:
    """Read one reference date of a table written as Parquet.

    The former rows are read if a run failed just between taking them away and putting
    the new ones in their place.
    """
    files, now, old = _paths(spark, _folder(path, as_of), _replaced(path, as_of))
    at = now if files.exists(now) or not files.exists(old) else old
    return spark.read.parquet(at.toString())
