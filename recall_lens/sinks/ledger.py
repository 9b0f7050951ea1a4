"""Loads with names: each counts once, whatever is repeated, and every attempt leaves a line in the ledger."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import astuple, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from recall_lens.sinks.manifest import Commit, Store

LEDGER = "_ledger"
SCHEMA = "table string, load_id string, attempt string, status string, rows long, error string, at timestamp_ntz"
LOADED, REPLAYED, FAILED = "loaded", "replayed", "failed"


@dataclass(frozen=True)
class Attempt:
    table: str
    load_id: str
    attempt: str
    status: str
    rows: int | None
    error: str | None
    at: dt.datetime


class Ledger:
    """Tables that grow by named loads. A commit maps `table/load_id` to the folder of the attempt that counts."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.store = Store(spark, root)

    def load(self, table: str, load_id: str, build: Callable[[], DataFrame], at: dt.datetime) -> Attempt:
        """Write what `build` returns as load `load_id` of `table`, unless that load is there already.

        Rows are written aside and count from the commit on: a failed attempt adds nothing, is entered with its error and
        raised again. A load that is repeated, or made by two at once, is entered as replayed and adds nothing either.
        """
        name, attempt = f"{table}/{load_id}", uuid.uuid4().hex
        enter = lambda status, rows=None, error=None: self._enter(Attempt(table, load_id, attempt, status, rows, error, at))
        if name in self.store.current().folders:
            return enter(REPLAYED)
        try:
            df = build()
            folder = self.store.write(df, name)
            rows = self.store.spark.read.schema(df.schema).parquet(f"{self.store.root}/{folder}").count()
            mine = self.store.update(lambda last: self._with(last, name, folder, df))
        except Exception as error:
            enter(FAILED, error=f"{type(error).__name__}: {error}"[:2000])
            raise
        return enter(LOADED, rows) if mine.folders[name] == [folder] else enter(REPLAYED)

    @staticmethod
    def _with(last: Commit, name: str, folder: str, df: DataFrame):
        if name in last.folders:
            return None
        return {**last.folders, name: [folder]}, {**last.schemas, name: df.schema.jsonValue()}, {}

    def _enter(self, attempt: Attempt) -> Attempt:
        line = self.store.spark.createDataFrame([astuple(attempt)], SCHEMA)
        line.coalesce(1).write.mode("append").json(f"{self.store.root}/{LEDGER}")
        return attempt

    def attempts(self) -> DataFrame:
        """Every attempt ever made."""
        spark = self.store.spark
        try:
            return spark.read.schema(SCHEMA).json(f"{self.store.root}/{LEDGER}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], SCHEMA)

    def read(self, table: str) -> DataFrame:
        """The rows of all loads of a table that count; loads may differ in columns."""
        commit = self.store.current()
        loads = sorted(name for name in commit.folders if name.startswith(f"{table}/"))
        if not loads:
            raise KeyError(f"no load of {table} under {self.store.root}")
        by_schema: dict[str, list[str]] = {}
        for name in loads:
            by_schema.setdefault(str(commit.schemas[name]), []).append(name)
        parts = []
        for names in by_schema.values():
            folders = [f for n in names for f in commit.folders[n]]
            parts.append(self.store.table("rows", Commit(commit.number, {"rows": folders}, {"rows": commit.schemas[names[0]]})))
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        return rows
