"""Helpers that keep hot keys from landing in one task, and tables that cut lineage."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Most tasks one join key is spread over, which is also the copies made of the other, smaller side.
MAX_SPREAD = 32

# Values treated as hot: at least one row in HOT_SHARE, so at most MAX_HOT of them.
HOT_SHARE = 100
MAX_HOT = 100

# Spark's setting that has the shuffle files of a query removed when it ends.
REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Buckets per group for distributed ranking; the bucket counts, not the rows, are ordered in one task.
RANK_BUCKETS = 4096


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only in local mode where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="recall-lens-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def folder_state(spark: SparkSession, folder: str) -> str:
    """A digest of the names, sizes and times of the files of a folder, two levels deep: it changes when they do."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return "absent"
    found = []
    for status in files.listStatus(path):
        inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [(str(s.getPath()), s.getLen(), s.getModificationTime()) for s in inside]
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()


_staged: list[str] = []


def stage(df: DataFrame, label: str, reader: SparkSession | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here and lost executors cost nothing.

    It is read by `reader`, or by the session of df.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _staged.append(path)
    return (reader or spark).read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files. Otherwise they stay until the driver happens to collect its garbage, and
    those of all steps add up."""
    before = spark.conf.get(REMOVED, None)
    spark.conf.set(REMOVED, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVED, before) if before is not None else spark.conf.unset(REMOVED)


def stage_small(parts: Iterable[DataFrame], label: str, reader: SparkSession) -> DataFrame:
    """`stage` for large tables, written part after part, that holds little disk: each part's shuffle files are removed
    before the next is made, and the table is compressed further."""
    path = ""
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        if not path:
            path = f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
            _staged.append(path)
        with shuffles_removed(spark):
            df.write.mode("append").parquet(path, compression="zstd")
    return reader.read.schema(schema).parquet(path)


def co_partitioned(spark: SparkSession) -> SparkSession:
    """A session with the settings of `spark`, in which a join on more columns than both sides are partitioned by is made
    where the rows lie. By default Spark shuffles both sides again; `spark` itself is left as it is."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and session.conf.isModifiable(name) and session.conf.get(name, None) != value:
            session.conf.set(name, value)
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return session


def staged_so_far() -> int:
    return len(_staged)


def drop_staged(spark: SparkSession, since: int, until: int | None = None) -> None:
    """Delete the tables staged after `since` (and not after `until`), once the result that reads them has been written."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    until = len(_staged) if until is None else until
    while until > since:
        until -= 1
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop(until))
        path.getFileSystem(conf).delete(path, True)


def spread_width(spark: SparkSession) -> int:
    """Tasks to deal one key over: grows with the shuffle width; a narrow session has nothing to gain from copies."""
    return max(1, min(MAX_SPREAD, int(spark.conf.get("spark.sql.shuffle.partitions")) // 64))


def unbroadcast(df: DataFrame) -> DataFrame:
    """Mark a side of a join that grows with the data: it is sorted and merged, never collected for a broadcast.

    Spark would compare the size of its compressed, pruned files with the broadcast threshold; the rows made of them are
    many times as large, and the driver holds those of all joins of a plan at once.
    """
    return df.hint("merge")


def salted_join(
    many: DataFrame,
    few: DataFrame,
    on: list[str],
    salt_by: list[str],
    how: str = "inner",
    spread: int | None = None,
    bounded: bool = False,
    hashed: bool = False,
) -> DataFrame:
    """Join a side that may hold a hot key (`many`) with a smaller one (`few`).

    Rows of one key are dealt over `spread` tasks by a hash of `salt_by`, so a retried task deals them the same way;
    the small side is copied once per salt. Exact for inner, left, left_semi and left_anti joins. Only a small side of
    `bounded` size may be broadcast; any other is merged (`unbroadcast`). With `hashed`, for a side with few rows a key
    and far fewer in all, each task holds its part in a hash table, and the large side is shuffled but not sorted.
    """
    spread = spread or spread_width(many.sparkSession)
    side = (lambda df: df) if bounded else (lambda df: df.hint("shuffle_hash")) if hashed else unbroadcast
    if spread == 1:
        return many.join(side(few), on, how)
    left = many.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(spread)).cast("int"))
    right = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return left.join(side(right), [*on, "_salt"], how).drop("_salt")


def hot_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column that hold at least one row in HOT_SHARE; never more than MAX_HOT.

    A sketch of fixed size finds them in one pass. Missing one costs time only: results never depend on the list.
    """
    found = df.agg(
        F.expr(f"approx_top_k({column}, {MAX_HOT}, {100 * MAX_HOT})").alias("top"), F.count(column).alias("rows")
    )
    return (
        found.select("rows", F.inline("top"))
        .filter((F.col("count") * HOT_SHARE >= F.col("rows")) & F.col("item").isNotNull())
        .select(F.col("item").alias(column))
    )


def hot_salted_join(
    many: DataFrame,
    few: DataFrame,
    on: list[str],
    hot: DataFrame,
    salt_by: list[str],
    spread: int | None = None,
) -> DataFrame:
    """Inner join of two large sides whose key holds a value that may be hot, listed in the one-column table `hot`.

    Only rows of hot values are dealt over tasks, and only their partners copied, so the copies stay few.
    """
    spread = spread or spread_width(many.sparkSession)
    if spread == 1:
        return many.join(unbroadcast(few), on)
    (column,) = hot.columns
    listed = hot.withColumn("_hot", F.lit(True))
    dealt = F.pmod(F.xxhash64(*salt_by), F.lit(spread)).cast("int")
    every = F.sequence(F.lit(0), F.lit(spread - 1))
    left = many.join(listed, column, "left").withColumn("_salt", F.when(F.col("_hot"), dealt).otherwise(F.lit(0)))
    right = few.join(listed, column, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
    )
    return left.drop("_hot").join(unbroadcast(right.drop("_hot")), [*on, "_salt"]).drop("_salt")


def spread_rank(df: DataFrame, key: Column, name: str, within: list[str] | None = None) -> DataFrame:
    """Exact rank 1..n of each row within `within` (all rows if None), ordered by md5 of a key.

    The hash range is cut into buckets: their counts give each bucket its starting rank, and rows are only ordered
    inside one bucket, so no group is ever sorted as a whole. Rows of one key are ordered by all their columns, rows
    without a key come last. Also adds `<name>_total`, the number of rows ranked.
    """
    groups = within or []
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    hashed = df.withColumn("_h", F.md5(key.cast("string"))).withColumn("_row", whole)
    hashed = hashed.withColumn(
        "_bucket",
        F.when(F.col("_h").isNull(), RANK_BUCKETS + F.pmod("_row", F.lit(RANK_BUCKETS)))
        .otherwise(F.pmod(F.conv(F.substring("_h", 1, 3), 16, 10).cast("long"), F.lit(RANK_BUCKETS)))
        .cast("int"),
    )
    counts = hashed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    anchor = [F.col(g) for g in groups] or [F.lit(1)]
    before = Window.partitionBy(*anchor).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_in_{g}") for g in groups],
        F.col("_bucket").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*anchor)).alias(f"{name}_total"),
    )
    inside = Window.partitionBy(*groups, "_bucket").orderBy("_h", "_row")
    ranked = hashed.withColumn("_pos", F.row_number().over(inside))
    same = F.col("_bucket") == F.col("_of")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_in_{g}"))
    return (
        ranked.join(offsets, same)
        .withColumn(name, F.col("_pos") + F.col("_before"))
        .drop("_h", "_row", "_bucket", "_pos", "_before", "_of", *[f"_in_{g}" for g in groups])
    )
