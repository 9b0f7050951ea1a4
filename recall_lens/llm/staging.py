"""Tables written to the folder that all executors share.

The folder is spark.checkpoint.dir of the session. Only where that is unset, as in tests on one machine, is a temporary
folder of this machine used.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch; texts are far wider than the rows Spark's own default has in mind.
BATCH_ROWS = "1000"
#: Bytes of an Arrow batch, for batches of very long texts.
BATCH_BYTES = str(32 << 20)


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Staging:
    """A folder of its own for the tables of one run; a written table cuts the lineage and outlives lost executors."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the memory that one Arrow batch of texts takes in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


class Carried:
    """Columns that an operator takes along, inside it under names of their own, so that they can have any name.

    They come back under their names; one that has the name of an output column comes back as `<name>_carried`. A carried
    `text` is the text that the operator reads, and is handed on once.
    """

    def __init__(self, names: Sequence[str], own: Sequence[str]) -> None:
        self.text = "text" in names
        self.names = [n for n in names if n != "text"]
        self._inner = [f"carried_{i}" for i in range(len(self.names))]
        inside = dict(zip(self.names, self._inner, strict=True)) | {"text": "carried_text"}
        self._back = [(inside[n], f"{n}_carried" if n in own else n) for n in names]

    def held(self) -> list[Column]:
        """To select from the operator's input, besides what it reads."""
        return [F.col(f"`{n}`").alias(i) for n, i in zip(self.names, self._inner, strict=True)]

    def inner(self) -> list[str]:
        """The names inside, that of the text first if it is carried."""
        return ["carried_text"] * self.text + self._inner

    def back(self) -> list[Column]:
        """To select from the operator's output, behind its own columns."""
        return [F.col(i).alias(n) for i, n in self._back]
