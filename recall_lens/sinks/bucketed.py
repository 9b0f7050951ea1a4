"""A keyed table in hash buckets, of which a merge rewrites only those that hold one of its keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.sinks.manifest import Commit, Store

BUCKETS = 256
_BUCKET = "bucket_of_the_key"


class BucketedTable:
    """Rows by buckets of their key, one column or several; a commit names the folders of each bucket that has rows."""

    def __init__(self, spark: SparkSession, root: str, key: str | Sequence[str], buckets: int = BUCKETS) -> None:
        self.store, self.buckets = Store(spark, root), buckets
        self.key = (key,) if isinstance(key, str) else tuple(key)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _bucketed(self, folders: dict[str, list[str]], commit: Commit) -> DataFrame | None:
        named = Commit(commit.number, {"rows": sorted(f for of_bucket in folders.values() for f in of_bucket)}, commit.schemas)
        return self.store.table("rows", named) if "rows" in commit.schemas else None

    def read(self, commit: Commit | None = None) -> DataFrame:
        """All rows of a commit, the last one if none is given."""
        commit = commit or self.store.current()
        rows = self._bucketed(dict(commit.folders), commit)
        if rows is None:
            raise KeyError(f"nothing was merged into {self.store.root} yet")
        return rows

    def lookup(self, keys: list) -> DataFrame:
        """The rows of a few keys of a table with one key column, from their buckets alone."""
        (key,) = self.key
        commit = self.store.current()
        asked = self.store.spark.createDataFrame([(k,) for k in keys], f"`{key}` {self.read(commit).schema[key].dataType.simpleString()}")
        rows = self._bucketed({b: commit.folders.get(b, []) for b in self._buckets_of(asked)}, commit)
        return rows.filter(F.col(key).isin(keys))

    def _buckets_of(self, rows: DataFrame) -> list[str]:
        return [str(r[0]) for r in rows.select(self.bucket()).distinct().collect()]

    def unseen(self, rows: DataFrame, commit: Commit | None = None) -> DataFrame:
        """Those of `rows` whose key the table does not hold, nulls being equal to each other; it is looked for in their
        buckets only."""
        commit = commit or self.store.current()
        held = self._bucketed({b: commit.folders.get(b, []) for b in self._buckets_of(rows)}, commit)
        if held is None:
            return rows
        held = held.select(*[F.col(c).alias(f"held_{c}") for c in self.key])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"held_{c}")) for c in self.key])
        return rows.join(held.hint("merge"), same, "left_anti")

    def _write(self, rows: DataFrame) -> dict[str, list[str]]:
        folder = self.store.new_folder("buckets")
        rows.withColumn(_BUCKET, self.bucket()).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.store.root}/{folder}")
        names = [p for p in self.store.children(folder) if p.startswith(f"{_BUCKET}=")]
        return {p.partition("=")[2]: [f"{folder}/{p}"] for p in names}

    def append(self, rows: DataFrame, after: Commit | None = None) -> Commit:
        """Add rows to their buckets; what is there already is neither read nor rewritten. With `after`, raises Conflict if
        that is no longer the last commit."""
        written = self._write(rows)

        def change(last: Commit):
            folders = {b: last.folders.get(b, []) + written.get(b, []) for b in {*last.folders, *written}}
            return folders, last.schemas or {"rows": rows.schema.jsonValue()}, {"appended": sorted(written, key=int)}

        if after is None:
            return self.store.update(change)
        folders, schemas, notes = change(after)
        return self.store.commit(after, folders, schemas, **notes)

    def merge(self, source: DataFrame, combine: Callable[[DataFrame | None], DataFrame]) -> Commit:
        """Replace the buckets that a key of `source` falls in by what `combine` makes of their rows (None before the first
        merge), all other buckets staying as they are. If another merge is committed meanwhile, this one starts again.

        `combine` must not give rows of other buckets. The commit's notes name the buckets that were rewritten.
        """
        touched = self._buckets_of(source)

        def change(last: Commit):
            old = self._bucketed({b: last.folders.get(b, []) for b in touched}, last)
            merged = combine(old)
            written = self._write(merged)
            folders = {b: f for b, f in last.folders.items() if b not in touched} | written
            if stray := sorted(set(written) - set(touched)):
                raise ValueError(f"the merge made rows of buckets that its source has no key of: {stray}")
            return folders, {"rows": merged.schema.jsonValue()}, {"rewritten": sorted(touched, key=int)}

        return self.store.update(change)
