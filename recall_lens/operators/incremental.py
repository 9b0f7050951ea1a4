"""Device figures kept up to date load by load, without reading earlier loads again.

What the rollup needs of events are distinct reports and makers per device number, and the first and last day. A load adds
the ones that are new, found by an anti-join with those held in the same hash buckets, and for each number a row of facts: how many
were new, and the load's days. So held rows are never rewritten, a number's counts are sums over loads, and its days minima
and maxima. Buckets go by number and value together, so that a device with a third of all events has them in all buckets.
A load is one commit; one that meets another's is refused with Conflict and can be tried again.

Recalls are held in the same way, as distinct pairs of number and recall.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.operators.integration import observed_sets, recall_tuples
from recall_lens.operators.rollup import rollup_exact_of, rollup_of
from recall_lens.operators.skew import stage, unbroadcast
from recall_lens.sinks.bucketed import BucketedTable
from recall_lens.sinks.manifest import Commit
from recall_lens.sources.testdata import Feeds

#: Kind of the rows that hold a load's facts about a number.
FACTS = "facts"


class RollupState:
    """The state under `root`. Loads may come in any order and may overlap; a load added twice changes nothing."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 256) -> None:
        self.sets = BucketedTable(spark, f"{root}/sets", ("number", "kind", "x"), buckets)
        self.recalls = BucketedTable(spark, f"{root}/recalls", ("number", "recall"), buckets)

    def add_events(self, load: DataFrame) -> Commit:
        """Take in a load of adverse events (cleaned, with the feed's columns)."""
        last = self.sets.store.current()
        found = stage(observed_sets(load), "load-sets")
        values = found.filter(F.col("x").isNotNull()).select("number", "kind", "x")
        new = self.sets.unseen(values, last)
        new = new if new is values else stage(new, "new-values")
        days = found.groupBy("number").agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
        count = lambda kind: F.count(F.when(F.col("kind") == kind, 1)).alias(f"n_{kind}")
        counts = new.groupBy("number").agg(count("report"), count("maker"))
        facts = days.join(unbroadcast(counts), "number", "left").fillna(0, ["n_report", "n_maker"])
        facts = facts.withColumns({"kind": F.lit(FACTS), "x": F.lit(None).cast("string")})
        rows = facts.unionByName(new, allowMissingColumns=True)
        return self.sets.append(rows.select("number", "kind", "x", "first_day", "last_day", "n_report", "n_maker"), last)

    def add_recalls(self, load: DataFrame) -> Commit:
        """Take in a load of recalls."""
        last = self.recalls.store.current()
        found = stage(recall_tuples(load), "load-recalls")
        return self.recalls.append(self.recalls.unseen(found, last), last)

    def event_facts(self) -> DataFrame:
        """Per device number: distinct reports and makers, first and last event; from one short row a number and load."""
        return self.sets.read().filter(F.col("kind") == FACTS).groupBy("number").agg(
            F.sum("n_report").alias("n_report"), F.sum("n_maker").alias("n_maker"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
        )

    def rollup(self, feeds: Feeds) -> DataFrame:
        """`rollup.device_rollup` over all loads; of `feeds` only approvals, clearances and product codes are read."""
        return rollup_of(feeds, self.sets.read().filter(F.col("kind") != FACTS), self.recalls.read(), self.event_facts())

    def rollup_exact(self, feeds: Feeds) -> DataFrame:
        """`rollup.device_rollup_exact` over all loads, from the facts alone."""
        return rollup_exact_of(feeds, self.event_facts(), self.recalls.read())
