"""CSV output, the fallback when a table write is off or fails."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException, PySparkException, PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.ingest import RejectedBatch


def write_csv(df: DataFrame, path: str) -> None:
    """Files with a header and no row index; each task writes its own part."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def store_or_csv(
    df: DataFrame,
    store: Callable[[DataFrame], object],
    csv_path: str,
    save: bool = True,
    flat: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> str | None:
    """Store a batch in its table, or as CSV when storing is off or fails.

    Returns None when the table took the batch, else why the CSV was written. Only a refused
    batch and an error of the storage lead to CSV; a wrong plan and a failing Python function
    are errors of the program and rise. ``flat`` gives
    the batch a form that CSV can hold. Each backup is a folder of its own, so a second
    failure does not overwrite the first.
    """
    reason = "saving to the table is off"
    if save:
        try:
            store(df)
            return None
        except (RejectedBatch, OSError) as error:
            reason = str(error)
        except PySparkException as error:
            if isinstance(error, (AnalysisException, PythonException)):
                raise
            reason = str(error)
    write_csv(flat(df), f"{csv_path}/{uuid.uuid4().hex}")
    return reason
