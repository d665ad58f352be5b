"""The layer tables (bronze, silver, gold): full refresh and idempotent append."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ingest import (
    Constraints,
    first_write_wins,
    judged,
    not_yet_stored,
    refuse_broken,
    split_judged,
)

MONTH = "load_month"
BUILD = "build-"


@dataclass(frozen=True)
class BronzeTable:
    """How a bronze table is keyed, checked and partitioned."""

    name: str
    date: str
    constraints: Constraints
    key: str = "hash"

    def month(self) -> Column:
        return F.coalesce(F.date_format(F.col(self.date), "yyyy-MM"), F.lit("undated"))


@dataclass(frozen=True)
class Layers:
    """Layer tables as Parquet under a root folder that all executors share."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        try:
            self.read(layer, table)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True

    def _folder(self, path: str):
        """The file system of a path, and the path as that file system's object."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _builds(self, layer: str, table: str) -> list[str]:
        """Finished builds of a refreshed table, oldest first; a failed one has no success mark."""
        fs, at = self._folder(self.path(layer, table))
        if not fs.exists(at):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(at))
        built = [f"{self.path(layer, table)}/{n}" for n in names if n.startswith(BUILD)]
        return [b for b in built if fs.exists(self._folder(f"{b}/_SUCCESS")[1])]

    def location(self, layer: str, table: str) -> str:
        """Where the table's rows are: its newest finished build, or the folder that appends go to."""
        built = self._builds(layer, table)
        return built[-1] if built else self.path(layer, table)

    def remove(self, path: str) -> None:
        fs, at = self._folder(path)
        fs.delete(at, True)

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.location(layer, table))

    def rebuild(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        """Full refresh. The rows are written as the last stage holds them: no extra shuffle.

        They go to a folder of their own beside the table in use. Readers change over once it is
        finished, so a build that fails leaves the old rows. The build before the last stays
        for readers that have begun; older ones go.
        """
        build = f"{self.path(layer, table)}/{BUILD}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(build)
        for old in self._builds(layer, table)[:-2]:
            self.remove(old)
        return self.read(layer, table)

    def register(self, layer: str, table: str) -> None:
        """Name a written table in the catalog, in a database per layer, at its present place."""
        name, place = f"{layer}.{table}", self.location(layer, table)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")
        if self.spark.catalog.tableExists(name):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
            self.spark.catalog.refreshTable(name)
        else:
            self.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{place}'")

    def stage(self, name: str, df: DataFrame) -> tuple[DataFrame, str]:
        """Rows written to a folder of this run alone, and that folder, to be removed at its end."""
        path = f"{self.root}/_staging/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.parquet(path), path

    def new_rows(
        self, table: BronzeTable, batch: DataFrame, arrival: Sequence[str | Column], drop: Sequence[str] = ()
    ) -> DataFrame:
        """The batch's first row of each key that the table does not hold."""
        first = first_write_wins(batch, arrival, table.key).drop(*drop).withColumn(MONTH, table.month())
        return self._unstored(table, first).drop(MONTH)

    def _unstored(self, table: BronzeTable, rows: DataFrame) -> DataFrame:
        """Rows whose key is not stored. The stored side is read for the rows' months only: a key
        contains its date, so a duplicate has the same month."""
        if not self.exists("bronze", table.name):
            return rows
        # At most one value per calendar month of the batch.
        months = [r[0] for r in rows.select(MONTH).distinct().collect()]
        stored = self.read("bronze", table.name).filter(F.col(MONTH).isin(months))
        return not_yet_stored(rows, stored, table.key)

    def append_new(
        self,
        table: BronzeTable,
        batch: DataFrame,
        arrival: Sequence[str | Column] = (),
        *,
        strict: bool = True,
        label: Callable[[DataFrame], DataFrame] | None = None,
        drop: Sequence[str] = (),
        metrics: Observation | None = None,
    ) -> DataFrame | None:
        """Add the batch's new keys to a bronze table; a repeated batch adds nothing.

        The batch is de-duplicated, judged and written to a staging table first, so its plan
        runs once: the checks, the month list and the append read the staged columns they need.
        ``strict`` refuses the whole batch when a row breaks a constraint; otherwise such rows
        go to ``bronze/<name>_rejected``, which is returned. The staging folders are the run's own
        and go when it ends. ``label`` runs once, on the new good rows only, so a model is never
        asked about a stored row; what it answers is staged and judged like the rest. ``drop``
        names columns that only order the batch; a batch without ``arrival`` is unique by key
        already. The rebalance hint lets AQE split a hot month and merge small ones before the files
        are written. ``metrics`` observes the write: ``stored``, the number of rows, and ``earliest`` and
        ``latest``, their dates, without another pass over them.

        Runs on one table must follow each other: two at a time can both append a key.
        """
        first = first_write_wins(batch, arrival, table.key) if arrival else batch
        rows = judged(first.drop(*drop), table.constraints).withColumn(MONTH, table.month())
        staged, place = self.stage(table.name, rows)
        try:
            self._append_staged(table, staged, strict, label, metrics)
        finally:
            self.remove(place)
        return None if strict else self.read("bronze", f"{table.name}_rejected")

    def _append_staged(
        self,
        table: BronzeTable,
        staged: DataFrame,
        strict: bool,
        label: Callable[[DataFrame], DataFrame] | None,
        metrics: Observation | None,
    ) -> None:
        if strict:
            refuse_broken(staged)
        fresh, rejected = split_judged(staged, table.constraints)
        fresh = self._unstored(table, fresh)
        if label is None:
            self._append(table, fresh, rejected, strict, metrics)
            return
        answered, place = self.stage(table.name, judged(label(fresh), table.constraints))
        try:
            if strict:
                refuse_broken(answered)
            fresh, refused = split_judged(answered, table.constraints)
            self._append(table, fresh, rejected.unionByName(refused), strict, metrics)
        finally:
            self.remove(place)

    def _append(
        self, table: BronzeTable, fresh: DataFrame, rejected: DataFrame, strict: bool, metrics: Observation | None
    ) -> None:
        if not strict:
            self.append_missing(f"{table.name}_rejected", rejected, table.key)
        if metrics is not None:
            day = F.to_date(table.date)
            fresh = fresh.observe(
                metrics, F.count("*").alias("stored"), F.min(day).alias("earliest"), F.max(day).alias("latest")
            )
        (
            fresh.withColumn("created_at", F.current_timestamp())
            .hint("rebalance", MONTH)
            .write.mode("append")
            .partitionBy(MONTH)
            .parquet(self.path("bronze", table.name))
        )

    def append_missing(self, name: str, rows: DataFrame, key: str) -> None:
        """Add the rows, unique by key, that a bronze side table does not hold yet."""
        if self.exists("bronze", name):
            rows = not_yet_stored(rows, self.read("bronze", name), key)
        rows.write.mode("append").parquet(self.path("bronze", name))
