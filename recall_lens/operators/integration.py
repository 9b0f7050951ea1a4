"""The integrated device view: approvals x clearances, their events, product codes and recalls.

The match "event number equals the approval OR the clearance number" would plan as a nested loop. Everything that
depends on one number is aggregated per number first, with equality joins, and a pair of numbers is then described as
left + right - both; `both` is computed only for pairs that really share a report, a maker or a distributor.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.operators.skew import co_partitioned, drop_staged, salted_join, stage_small, staged_so_far, unbroadcast
from recall_lens.sources.testdata import Feeds

# The recall columns of the view; one value of this struct is one recall as the view shows it.
RECALL_COLUMNS = (
    "res_event_number",
    "recall_status",
    "event_date_initiated",
    "reason_for_recall",
    "root_cause_description",
)

SET_KINDS = {"report": "MDR_REPORT_KEY", "maker": "MANUFACTURER_NAME", "distributor": "DISTRIBUTOR_NAME"}

# A cell of the pairs of a code: the code's id, a slice of its approvals and one of its clearances.
CELL = ["_code", "_i", "_j"]
# Rows of a slice, and rows of the view made by a task, about.
SLICE = 1024
MADE = 1 << 20
# Values of numbers that are looked through at a time for those that both sides of a code have, about; and the most rounds
# of a kind: with more, making the sets takes more disk than a round.
ROUND = 1 << 21
MOST_ROUNDS = 4

FLAGS = {"adverse": "ADVERSE_EVENT_FLAG", "problem": "PRODUCT_PROBLEM_FLAG"}

VIEW_COLUMNS = (
    "PMA_PMN_NUM", "pma_number", "pma_product_code", "pma_applicant", "GENERICNAME", "TRADENAME",
    "k_number", "k_product_code", "k_applicant", "k_devicename", "k_type",
    "adverse_event_count", "total_adverse_flag", "total_product_problem_flag", "first_event_date", "last_event_date",
    "unique_manufacturers", "unique_distributors",
    "pc_devicename", "DEVICECLASS", "MEDICALSPECIALTY",
    "cfres_id", "recall_status", "event_date_initiated", "reason_for_recall", "root_cause_description",
)


def observed_sets(
    maude: DataFrame, kinds: tuple[str, ...] = ("report", "maker"), flags: dict[str, str] | None = None
) -> DataFrame:
    """Distinct (number, kind, value); shuffled by number and value, so no hot number skews it.

    Event dates, and counts of the `flags` that say Y, ride on the maker rows: every event has exactly one, even if
    its name is missing.
    """
    numbered = maude.filter(F.col("PMA_PMN_NUM").isNotNull()).withColumnRenamed("PMA_PMN_NUM", "number")
    flags = flags or {}

    def distinct(kind: str) -> DataFrame:
        values = numbered.withColumnRenamed(SET_KINDS[kind], "x")
        if kind != "maker":
            return values.select("number", "x").distinct().withColumn("kind", F.lit(kind))
        return (
            values.groupBy("number", "x")
            .agg(
                F.min("DATE_OF_EVENT").alias("first_day"),
                F.max("DATE_OF_EVENT").alias("last_day"),
                *[F.count(F.when(F.col(c) == "Y", 1)).alias(name) for name, c in flags.items()],
            )
            .withColumn("kind", F.lit(kind))
        )

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [distinct(k) for k in kinds])


def _count_kind(kind: str) -> Column:
    return F.count(F.when(F.col("kind") == kind, F.col("x")))


def event_facts(
    sets: DataFrame, kinds: tuple[str, ...] = ("report", "maker"), flags: tuple[str, ...] = ()
) -> DataFrame:
    """Per device number: distinct values of each kind, flag counts, first and last event."""
    return sets.groupBy("number").agg(
        *[_count_kind(k).alias(f"n_{k}") for k in kinds],
        *[F.sum(f).alias(f) for f in flags],
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )


def recall_tuples(recall: DataFrame) -> DataFrame:
    """Distinct (number, recall as shown) pairs."""
    return (
        recall.select(
            F.explode(F.array_distinct("k_numbers")).alias("number"), F.struct(*RECALL_COLUMNS).alias("recall")
        )
        .filter(F.col("number").isNotNull())
        .distinct()
    )


def _renamed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else f"{prefix}{c}") for c in df.columns])



def _sum_of(*cols: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])


def _staged(df: DataFrame, label: str, reader: SparkSession | None = None) -> DataFrame:
    """A step of the view: staged without leaving its shuffle files, and read by `reader` or the session of df."""
    return stage_small([df], label, reader or df.sparkSession)


def integrated_view(feeds: Feeds) -> DataFrame:
    """One row per approval x clearance x product code x recall, with the events of either number.

    The pairs of a code are cut into cells, a grid of slices of its approvals and of its clearances. What a pair needs is
    sent to its cell before the pair is made, so pairs are made, completed and handed on inside a task: what is shuffled,
    sorted and written grows with the feeds, not with the pairs. Steps follow each other, each without what the last one
    shuffled, so disk holds the largest of them and not their sum.
    """
    cells = co_partitioned(feeds.maude.sparkSession)
    rows = feeds.recall.groupBy("k_numbers", F.struct(*RECALL_COLUMNS).alias("recall")).agg(
        F.count("*").alias("recall_copies")
    )
    named = rows.withColumn("number", F.explode(F.array_distinct("k_numbers"))).filter(F.col("number").isNotNull())
    named = _staged(named, "recalls-named", cells)
    own = named.groupBy("number", "recall").agg(F.sum("recall_copies").alias("recall_copies"))
    own = _staged(own, "recalls-own")
    counts = own.groupBy("number").agg(F.count("*").alias("n_recall"))
    counts = _staged(counts, "recall-counts", feeds.maude.sparkSession)

    p = feeds.pma.groupBy(
        F.col("PMANUMBER").alias("pma_number"),
        F.col("PRODUCTCODE").alias("pma_product_code"),
        F.col("APPLICANT").alias("pma_applicant"),
        "GENERICNAME",
        "TRADENAME",
    ).agg(F.count("*").alias("p_copies"))
    k = feeds.premarket_510k.groupBy(
        F.col("KNUMBER").alias("k_number"),
        F.col("PRODUCTCODE").alias("k_product_code"),
        F.col("APPLICANT").alias("k_applicant"),
        F.col("DEVICENAME").alias("k_devicename"),
        F.col("TYPE").alias("k_type"),
    ).agg(F.count("*").alias("k_copies"))
    p = _staged(_known(p, counts, "p", "pma_number").withColumn("code", F.col("pma_product_code")), "approvals", cells)
    k = _staged(_known(k, counts, "k", "k_number").withColumn("code", F.col("k_product_code")), "clearances", cells)

    grid = _staged(_grid(p, k), "grid")
    tasks = _tasks(grid)
    codes = feeds.product_code.groupBy(
        F.col("PRODUCTCODE").alias("code"),
        F.col("DEVICENAME").alias("pc_devicename"),
        "DEVICECLASS",
        "MEDICALSPECIALTY",
    ).agg(F.count("*").alias("code_copies"))
    codes = _staged(codes, "codes", cells)
    coded = lambda df, number: salted_join(df, codes, ["code"], [number], "left")

    # Full outer join on the code: pairs in cells, then the rows of either side without a partner.
    p = _placed(p, grid, "pma_number", ("pma_applicant", "GENERICNAME", "TRADENAME"), "_i")
    k = _placed(k, grid, "k_number", ("k_applicant", "k_devicename", "k_type"), "_j")
    sides = _sides_of(p, k)
    facts, values = _events(feeds.maude, sides, cells)
    p = _staged(_known(p, facts, "p", "pma_number"), "approvals-known")
    k = _staged(_known(k, facts, "k", "k_number"), "clearances-known")
    in_cells = lambda df: df.repartition(tasks, *CELL)
    p_cells = in_cells(_copied(coded(p.filter("_code IS NOT NULL"), "pma_number").drop("code"), "_i"))
    k_cells = in_cells(_copied(k.filter("_code IS NOT NULL").drop("code"), "_j"))

    pairs = p_cells.join(unbroadcast(k_cells), CELL)
    both = _shared_counts(values, in_cells)
    pairs = _completed(pairs.join(both.hint("shuffle_hash"), [*CELL, "pma_number", "k_number"], "left"))

    # A recall row counts once for a pair: one that names both numbers is kept under the approval's.
    listed = salted_join(own, sides, ["number"], ["recall"])
    held = in_cells(
        _of_side(listed, 0).withColumn("side", F.lit("p")).unionByName(_of_side(listed, 1).withColumn("side", F.lit("k")))
    )
    again = _shared_recalls(named, sides, in_cells)
    pairs = pairs.withColumn("side", F.explode(_sides())).withColumn("number", _side_number())
    pairs = (
        pairs.join(held.hint("shuffle_hash"), [*CELL, "side", "number"], "left")
        .join(again.hint("shuffle_hash"), [*CELL, "pma_number", "k_number", "recall"], "left")
        .filter((F.col("side") != "k") | F.col("more_copies").isNull())
        .withColumn("recall_copies", F.col("recall_copies") + F.coalesce("more_copies", F.lit(0)))
    )

    p_alone = p.filter("_code IS NULL").drop("_code", "_i", "_across")
    k_alone = k.filter("_code IS NULL").drop("_code", "_j", "_across")
    alone = _completed(coded(p_alone, "pma_number").unionByName(coded(k_alone, "k_number"), allowMissingColumns=True))
    alone = alone.withColumn("number", F.coalesce("pma_number", "k_number"))
    listed = alone.filter("p_recalls + k_recalls > 0")
    listed = salted_join(own, listed, ["number"], ["recall"]).unionByName(
        alone.filter("p_recalls + k_recalls = 0"), allowMissingColumns=True
    )
    keep = [c for c in pairs.columns if c in listed.columns]
    view = pairs.select(*keep).unionByName(listed.select(*keep))

    factor = F.col("copies") * F.coalesce("code_copies", F.lit(1)) * F.coalesce("recall_copies", F.lit(1))
    return view.select(
        F.coalesce("pma_number", "k_number").alias("PMA_PMN_NUM"),
        *[c for c in keep if c != "recall"],
        "recall.*",
        (F.col("adverse") * factor).alias("total_adverse_flag"),
        (F.col("problem") * factor).alias("total_product_problem_flag"),
        F.col("recall.res_event_number").alias("cfres_id"),
    ).select(*VIEW_COLUMNS)


def _grid(p: DataFrame, k: DataFrame) -> DataFrame:
    """Per code of both sides: an id, the slices its approvals (`_rows`) and its clearances (`_columns`) are dealt to, and
    its rows of the view, about. A row weighs as many as its number has recalls."""

    def weighed(df: DataFrame, side: str) -> DataFrame:
        weight = F.greatest(F.col(f"{side}_n_recall"), F.lit(1))
        return df.groupBy("code").agg(F.count("*").alias(f"{side}_rows"), F.sum(weight).alias(f"{side}_weight"))

    slices = lambda side: F.least(f"{side}_rows", F.ceil(F.col(f"{side}_weight") / SLICE)).cast("int")
    sizes = weighed(p, "p").join(unbroadcast(weighed(k, "k")), "code")
    return sizes.select(
        "code",
        F.monotonically_increasing_id().alias("_code"),
        slices("p").alias("_rows"),
        slices("k").alias("_columns"),
        (F.col("p_weight") * F.col("k_rows") + F.col("k_weight") * F.col("p_rows")).cast("double").alias("made"),
    )


def _tasks(grid: DataFrame) -> int:
    """Tasks the cells are dealt to: they grow with the rows of the view, so that none holds too many."""
    made = grid.agg(F.sum("made")).first()[0] or 0
    return max(int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(made / MADE))


def _placed(df: DataFrame, grid: DataFrame, number: str, others: tuple[str, ...], axis: str) -> DataFrame:
    """Rows with their slice and the number of slices they are copied to; both null where the other side has not the code.

    Rows of one number share a slice; rows without one are dealt by their other columns.
    """
    mine, across = ("_rows", "_columns") if axis == "_i" else ("_columns", "_rows")
    key = F.when(F.col(number).isNotNull(), F.xxhash64(number)).otherwise(F.xxhash64(*others))
    found = salted_join(df, grid.drop("made"), ["code"], [number, *others], "left")
    found = found.withColumn(axis, F.pmod(key, F.col(mine)).cast("int")).withColumn("_across", F.col(across))
    return _staged(found.drop("_rows", "_columns"), "placed")


def _known(df: DataFrame, facts: DataFrame, side: str, number: str) -> DataFrame:
    """Rows of a side with what is known of their numbers."""
    return df.join(unbroadcast(_renamed(facts, f"{side}_").withColumnRenamed(f"{side}_number", number)), number, "left")


def _copied(df: DataFrame, axis: str) -> DataFrame:
    """Rows of a slice in each cell that the slice meets."""
    other = "_j" if axis == "_i" else "_i"
    return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_across") - 1))).drop("_across")


def _sides_of(p: DataFrame, k: DataFrame) -> DataFrame:
    """Distinct numbers by code and side (0 an approval's, 1 a clearance's), with the slice they are in (`_own`)."""

    def numbers(placed: DataFrame, number: str, axis: str, side: int) -> DataFrame:
        found = placed.select("_code", F.col(axis).alias("_own"), "_across", F.col(number).alias("number"))
        return found.dropna().distinct().withColumn("side", F.lit(side))

    return _staged(numbers(p, "pma_number", "_i", 0).unionByName(numbers(k, "k_number", "_j", 1)), "sides")


def _of_side(held: DataFrame, side: int) -> DataFrame:
    """What is known of the numbers of a side, in each cell that holds the number."""
    axis = "_j" if side else "_i"
    return _copied(held.filter(F.col("side") == side).drop("side").withColumnRenamed("_own", axis), axis)


def _shared(held: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `held` whose key numbers of both sides have."""
    known = held.groupBy(*key).agg(F.min("side").alias("least"), F.max("side").alias("most")).filter("least < most")
    return salted_join(held, known.select(*key), key, ["number"], "left_semi")


def _completed(pairs: DataFrame) -> DataFrame:
    """Pairs, or rows without a partner, with the figures of both numbers."""
    have = set(pairs.columns)
    both = lambda kind: F.coalesce(F.col(f"both_{kind}"), F.lit(0)) if f"both_{kind}" in have else F.lit(0)
    either = lambda c: _sum_of(F.col(f"p_{c}"), F.col(f"k_{c}"))
    distinct = lambda kind: either(f"n_{kind}") - both(kind)
    flags = lambda c: F.when(
        F.col("pma_number") == F.col("k_number"), F.coalesce(F.col(f"p_{c}"), F.lit(0))
    ).otherwise(either(c))
    copies = F.coalesce("p_copies", F.lit(1)) * F.coalesce("k_copies", F.lit(1))
    return pairs.select(
        *[c for c in CELL if c in have],
        "pma_number", "pma_product_code", "pma_applicant", "GENERICNAME", "TRADENAME",
        "k_number", "k_product_code", "k_applicant", "k_devicename", "k_type",
        "pc_devicename", "DEVICECLASS", "MEDICALSPECIALTY", "code_copies",
        copies.alias("copies"),
        distinct("report").alias("adverse_event_count"),
        flags("adverse").alias("adverse"),
        flags("problem").alias("problem"),
        F.least("p_first_day", "k_first_day").alias("first_event_date"),
        F.greatest("p_last_day", "k_last_day").alias("last_event_date"),
        distinct("maker").alias("unique_manufacturers"),
        distinct("distributor").alias("unique_distributors"),
        F.coalesce("p_n_recall", F.lit(0)).alias("p_recalls"),
        F.coalesce("k_n_recall", F.lit(0)).alias("k_recalls"),
    )


def _sides() -> Column:
    """The sides of a pair that have recalls; `n` if none has."""
    p, k = F.col("p_recalls") > 0, F.col("k_recalls") > 0
    return F.array_compact(F.array(F.when(p, "p"), F.when(k, "k"), F.when(~p & ~k, "n")))


def _side_number() -> Column:
    return F.when(F.col("side") == "p", F.col("pma_number")).when(F.col("side") == "k", F.col("k_number"))


def _events(maude: DataFrame, sides: DataFrame, reader: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The event facts of each number, and the values that numbers of both sides of a code have, by number.

    The observed sets are made one kind after another, and those of a kind are deleted once they have been read.
    """
    facts, values = [], []
    for at, kind in enumerate(SET_KINDS):
        first = staged_so_far()
        sets = _staged(observed_sets(maude, (kind,), FLAGS), "observed-sets", reader)
        last = staged_so_far()
        if kind == "maker":  # its rows have the days and flags
            found = event_facts(sets, (kind,), tuple(FLAGS))
        else:
            found = sets.groupBy("number").agg(_count_kind(kind).alias(f"n_{kind}"))
        facts.append(_staged(found, "number-facts"))
        values.append(_shared_values(sets, sides).withColumn("kind", F.lit(at)))
        drop_staged(reader, first, last)
    # every number has rows of every kind, if only with a null
    joined = reduce(lambda a, b: a.join(unbroadcast(b), "number"), facts)
    return joined, reduce(DataFrame.unionByName, values)


def _shared_values(sets: DataFrame, sides: DataFrame) -> DataFrame:
    """The values of one kind that numbers of both sides of a code have, by number; only these go to the cells.

    They are found in rounds over a hash of the value, so disk holds the shuffled values of a round and not of all.
    """
    rounds = min(MOST_ROUNDS, max(1, math.ceil(sets.count() / ROUND)))
    sets = sets.filter(F.col("x").isNotNull()).select("number", "x")

    def found(turn: int) -> DataFrame:
        some = sets.filter(F.pmod(F.xxhash64("x"), F.lit(rounds)) == turn) if rounds > 1 else sets
        return _shared(salted_join(some, sides, ["number"], ["x"], hashed=True), ["_code", "x"])

    return stage_small(map(found, range(rounds)), "shared-values", sets.sparkSession)


def _shared_counts(values: DataFrame, in_cells: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Values that both numbers of a pair have, by kind, for the pairs that share any; made inside the cells."""
    left = in_cells(_of_side(values, 0)).withColumnRenamed("number", "pma_number")
    right = in_cells(_of_side(values, 1)).withColumnRenamed("number", "k_number")
    return (
        left.join(unbroadcast(right), [*CELL, "kind", "x"])
        .groupBy(*CELL, "pma_number", "k_number")
        .agg(*[F.count(F.when(F.col("kind") == i, 1)).alias(f"both_{kind}") for i, kind in enumerate(SET_KINDS)])
    )


def _shared_recalls(named: DataFrame, sides: DataFrame, in_cells: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Recalls, as shown, that both numbers of a pair have, with the copies of rows that name the clearance alone.

    Only recalls that numbers of both sides of a code have are sent to the cells.
    """
    shared = _staged(_shared(salted_join(named, sides, ["number"], ["recall"]), ["_code", "recall"]), "shared-recalls")
    left = shared.select("_code", "_own", "_across", "side", "number", "recall").distinct()
    left = in_cells(_of_side(left, 0)).withColumnRenamed("number", "pma_number")
    right = in_cells(_of_side(shared, 1)).withColumnRenamed("number", "k_number")
    other = ~F.coalesce(F.array_contains("k_numbers", F.col("pma_number")), F.lit(False))
    return (
        left.join(unbroadcast(right), [*CELL, "recall"])
        .groupBy(*CELL, "pma_number", "k_number", "recall")
        .agg(F.sum(F.when(other, F.col("recall_copies")).otherwise(0)).alias("more_copies"))
    )


def rollup_from_view(view: DataFrame) -> DataFrame:
    """The device rollup read off the view; `rollup.device_rollup` gives the same without building the view."""
    far = F.to_date(F.lit("9999-12-31"))
    order = F.struct(
        F.coalesce("event_date_initiated", far), F.coalesce("cfres_id", F.lit("")), "root_cause_description"
    )
    return (
        view.filter(F.col("PMA_PMN_NUM").isNotNull())
        .groupBy("PMA_PMN_NUM")
        .agg(
            F.countDistinct("cfres_id").alias("recall_count"),
            F.coalesce(F.sum("adverse_event_count"), F.lit(0)).alias("total_adverse_events"),
            F.coalesce(F.sum("unique_manufacturers"), F.lit(0)).alias("unique_manufacturers"),
            F.max(F.col("DEVICECLASS").try_cast("double")).alias("device_class"),
            F.min("first_event_date").alias("first_event_date"),
            F.max("last_event_date").alias("last_event_date"),
            F.coalesce(
                F.min_by(
                    "root_cause_description", F.when(F.col("root_cause_description").isNotNull(), order)
                ),
                F.lit("Other"),
            ).alias("root_cause_description"),
        )
    )
