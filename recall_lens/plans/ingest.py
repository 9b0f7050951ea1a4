"""Raw feeds to cleaned tables, each load replacing its table, so that loading twice does not double the rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from recall_lens.sinks.manifest import Commit, Store
from recall_lens.sinks.tables import full_refresh
from recall_lens.sources.delimited import DelimitedFeed, path_exists, read_feeds, surplus_rows
from recall_lens.sources.recall_feed import clean_recalls, read_documents, read_lines
from recall_lens.sources.testdata import Feeds


def _loaded(
    spark: SparkSession, delimited: Iterable[DelimitedFeed], recall_path: str | None, recall_lines: bool
) -> Iterator[tuple[str, DataFrame]]:
    """The cleaned tables of all feeds that are present, and the raw text of rows that fit no column of their file."""
    present = [feed for feed in delimited if path_exists(spark, feed.path)]
    for name, table in read_feeds(spark, present).items():
        yield name, table
        bad = reduce(DataFrame.unionByName, [surplus_rows(spark, feed) for feed in present if feed.table == name])
        if not bad.isEmpty():
            yield f"quarantine/{name}", bad
    if recall_path and path_exists(spark, recall_path):
        raw = read_lines(spark, recall_path) if recall_lines else read_documents(spark, recall_path)
        yield "recall", clean_recalls(raw)


def ingest(
    spark: SparkSession,
    delimited: Iterable[DelimitedFeed],
    recall_path: str | None,
    target: str,
    recall_lines: bool = False,
) -> list[str]:
    """Load every feed that is present, each table by itself; returns the tables written.

    Rows that fit no column of their file go, as raw text, to `quarantine/<table>`, which is named too if it has any.
    """
    written = []
    for name, table in _loaded(spark, delimited, recall_path, recall_lines):
        full_refresh(table, f"{target}/{name}")
        written.append(name)
    return written


def ingest_together(
    spark: SparkSession,
    delimited: Iterable[DelimitedFeed],
    recall_path: str | None,
    target: str,
    recall_lines: bool = False,
) -> Commit:
    """Load every feed that is present and make all their tables current in one commit.

    Until then, and for good if a feed fails, `cleaned_feeds` reads the tables of the commit before. A table whose feed is
    absent this time stays as it was; the quarantine is this run's.
    """
    store = Store(spark, target)
    made = [(name, store.write(table, name), table.schema.jsonValue()) for name, table in _loaded(spark, delimited, recall_path, recall_lines)]

    def change(last: Commit):
        stays = {n: f for n, f in last.folders.items() if not n.startswith("quarantine/")}
        schemas = {n: last.schemas[n] for n in stays}
        return stays | {n: [f] for n, f, _ in made}, schemas | {n: s for n, _, s in made}, {"written": [n for n, _, _ in made]}

    return store.update(change)


def cleaned_feeds(spark: SparkSession, target: str) -> Feeds:
    """The tables an ingest wrote, ready for the integration; those of one commit, if there is any."""
    store = Store(spark, target)
    commit = store.current()

    def table(name: str) -> DataFrame:
        return store.table(name, commit) if commit.number else spark.read.parquet(f"{target}/{name}")

    return Feeds(
        pma=table("pma"),
        premarket_510k=table("premarket_510k"),
        product_code=table("product_code"),
        maude=table("maude"),
        recall=table("recall"),
    )
