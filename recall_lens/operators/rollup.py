"""One row per device from the feeds, equal to summing the integrated view, without building its rows.

The view holds a row for each approval x clearance pair of a product code, so a code with a third of all devices would
make it quadratic. Its per-device sums do not need the pairs. With, for a number d, e(d) events (or makers) and r(d)
recalls, the pair (p, k) adds

    events(p, k) * max(1, recalls(p, k)),   events = e(p) + e(k) - both,   recalls = r(p) + r(k) - both

Summed over all k of p's code this is a polynomial in p's own figures and the code's totals (`_code_totals`), less what
the pairs have in common. The common part is summed by shared value instead of by pair (`_shared_terms`): each step
groups by (code, value), so the work stays linear in the feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recall_lens.operators.integration import event_facts, observed_sets, recall_tuples
from recall_lens.operators.skew import hot_salted_join, hot_values, salted_join, stage, unbroadcast
from recall_lens.sources.testdata import Feeds

APPROVAL, CLEARANCE = "P", "K"
UNKNOWN_CAUSE = "Other"


def _cause_order(recall: str = "recall") -> Column:
    """Earliest recall first, by date, then event number; recalls without a cause are left out."""
    cause = F.col(f"{recall}.root_cause_description")
    far = F.to_date(F.lit("9999-12-31"))
    return F.when(
        cause.isNotNull(),
        F.struct(
            F.coalesce(F.col(f"{recall}.event_date_initiated"), far).alias("day"),
            F.coalesce(F.col(f"{recall}.res_event_number"), F.lit("")).alias("event"),
            cause.alias("cause"),
        ),
    )


def recall_facts(tuples: DataFrame) -> DataFrame:
    """Per device number: recalls as shown in the view, distinct recall events, first stated cause."""
    return tuples.groupBy("number").agg(
        F.count("*").alias("n_recall"),
        F.countDistinct("recall.res_event_number").alias("n_recall_event"),
        F.min(_cause_order()).alias("first_cause"),
    )


def _roles(feeds: Feeds) -> DataFrame:
    """(role, number, code) with `copies`, the number of distinct view keys it stands for."""
    approvals = feeds.pma.select(
        F.col("PMANUMBER").alias("number"), F.col("PRODUCTCODE").alias("code"), "APPLICANT", "GENERICNAME", "TRADENAME"
    )
    clearances = feeds.premarket_510k.select(
        F.col("KNUMBER").alias("number"), F.col("PRODUCTCODE").alias("code"), "APPLICANT", "DEVICENAME", "TYPE"
    )
    return (
        approvals.distinct()
        .select(F.lit(APPROVAL).alias("role"), "number", "code")
        .unionByName(clearances.distinct().select(F.lit(CLEARANCE).alias("role"), "number", "code"))
        .groupBy("role", "number", "code")
        .agg(F.count("*").alias("copies"))
    )


def device_facts(feeds: Feeds, events: DataFrame, tuples: DataFrame) -> DataFrame:
    """Every (role, number, code) with the figures of its number (`events` are its event facts); `paired` marks codes that
    both roles carry."""
    roles = stage(_roles(feeds), "roles")
    sides = roles.groupBy("code").agg((F.min("role") != F.max("role")).alias("paired"))
    return (
        salted_join(roles, sides, ["code"], ["number"], "left")
        .join(unbroadcast(events), "number", "left")
        .join(unbroadcast(recall_facts(tuples)), "number", "left")
        .fillna(0, ["n_report", "n_maker", "n_recall", "n_recall_event"])
    )


def code_classes(product_code: DataFrame) -> DataFrame:
    """Per product code: distinct view rows and highest class."""
    return (
        product_code.filter(F.col("PRODUCTCODE").isNotNull())
        .select(F.col("PRODUCTCODE").alias("code"), "DEVICENAME", "DEVICECLASS", "MEDICALSPECIALTY")
        .distinct()
        .groupBy("code")
        .agg(F.count("*").alias("code_rows"), F.max(F.col("DEVICECLASS").try_cast("double")).alias("device_class"))
    )


def _at_least_one(recalls: Column) -> Column:
    return F.greatest(recalls, F.lit(1))


def _code_totals(devices: DataFrame, product_code: DataFrame) -> DataFrame:
    """Per product code: totals over its clearances, and how many approvals pair with each clearance."""
    clearance, approval = F.col("role") == CLEARANCE, F.col("role") == APPROVAL
    n, r = F.col("copies"), F.col("n_recall")
    total = lambda value, name: F.sum(F.when(clearance, value).otherwise(0)).alias(name)
    figures = [total(n, "k"), total(n * r, "k_recall")]
    for kind in ("report", "maker"):
        e = F.col(f"n_{kind}")
        figures += [
            total(n * e, f"k_{kind}"),
            total(n * e * r, f"k_{kind}_recall"),
            total(n * e * _at_least_one(r), f"k_{kind}_rows"),
        ]
    return (
        devices.filter(F.col("code").isNotNull())
        .groupBy("code")
        .agg(
            *figures,
            total(n * _at_least_one(r), "k_rows"),
            F.sum(F.when(approval, n).otherwise(0)).alias("p"),
            F.sum(F.when(approval & F.col("number").isNull(), n).otherwise(0)).alias("p_unnumbered"),
            F.min(F.when(clearance, F.col("first_day"))).alias("k_first_day"),
            F.max(F.when(clearance, F.col("last_day"))).alias("k_last_day"),
            F.min(F.when(clearance, F.col("first_cause"))).alias("k_first_cause"),
        )
        .join(unbroadcast(code_classes(product_code)), "code", "left")
    )


def _sum_over_pairs(kind: str) -> Column:
    """Sum over a code's clearances of (e(p)+e(k)) * max(1, r(p)+r(k)); p on its own where there are none."""
    e, r = F.col(f"n_{kind}"), F.col("n_recall")
    recalled = e * r * F.col("k") + e * F.col("k_recall") + r * F.col(f"k_{kind}") + F.col(f"k_{kind}_recall")
    unrecalled = e * F.col("k_rows") + F.col(f"k_{kind}_rows")
    paired = F.when(r > 0, recalled).otherwise(unrecalled)
    return F.when(F.coalesce(F.col("k"), F.lit(0)) > 0, paired).otherwise(e * _at_least_one(r))


def _shared_terms(devices: DataFrame, sets: DataFrame, tuples: DataFrame) -> DataFrame:
    """What `_sum_over_pairs` counts twice, per approval (number, code) and kind of set.

    Three sums: events shared with a clearance, recalls shared with a clearance, and, added back, pairs that share
    both an event and a recall. The shared value leads the join keys: it tells rows apart soonest when they are sorted.
    """
    numbered = devices.filter(F.col("number").isNotNull() & F.col("code").isNotNull() & F.col("paired"))
    columns = ["number", "code", "copies", "n_report", "n_maker", "n_recall"]
    p = numbered.filter(F.col("role") == APPROVAL).select(*columns)
    k = numbered.filter(F.col("role") == CLEARANCE).select(*columns)
    sets = sets.filter(F.col("x").isNotNull()).select("number", "kind", "x")
    hot = stage(hot_values(sets, "x"), "hot-values")
    n, r = F.col("copies"), F.col("n_recall")

    # Steps that several others read are written once: the sets are joined once, and no job's plan holds them all.
    owners = numbered.select("role", "number", "code", "copies", "n_recall")
    owned = stage(salted_join(sets, owners, ["number"], ["x"], hashed=True), "owned-sets")
    k_own = owned.filter(F.col("role") == CLEARANCE).drop("role")
    k_sets = (
        k_own.groupBy("x", "code", "kind")
        .agg(
            F.sum(n).alias("k"),
            F.sum(n * r).alias("k_recall"),
            F.sum(n * _at_least_one(r)).alias("k_rows"),
        )
    )
    p_sets = owned.filter(F.col("role") == APPROVAL).select("number", "code", "kind", "x", "n_recall")
    met = hot_salted_join(p_sets, k_sets, ["x", "code", "kind"], hot, ["number"]).select(
        "number", "code", "kind", "x",
        F.when(r > 0, r * F.col("k") + F.col("k_recall")).otherwise(F.col("k_rows")).alias("t"),
    )
    met = stage(met, "shared-sets")
    events = met.groupBy("number", "code", "kind").agg(F.sum(-F.col("t")).alias("term"))

    k_named = salted_join(tuples, k, ["number"], ["recall"])
    p_named = salted_join(tuples, p.select("number", "code", "n_report", "n_maker"), ["number"], ["recall"])
    k_tuples = k_named.groupBy("code", "recall").agg(
        F.sum(n).alias("k"),
        F.sum(n * F.col("n_report")).alias("k_report"),
        F.sum(n * F.col("n_maker")).alias("k_maker"),
    )
    p_shared = stage(salted_join(p_named, k_tuples, ["code", "recall"], ["number"]), "shared-recalls")
    by_kind = F.inline(
        F.array(
            *[
                F.struct(F.lit(kind).alias("kind"), (F.col(f"n_{kind}") * F.col("k") + F.col(f"k_{kind}")).alias("t"))
                for kind in ("report", "maker")
            ]
        )
    )
    recalls = (
        p_shared.select("number", "code", by_kind).groupBy("number", "code", "kind").agg(F.sum(-F.col("t")).alias("term"))
    )

    p_keys = p_shared.select("number", "code", "recall")
    p_recalls = p_keys.select("code", "recall").distinct()
    k_keys = stage(
        salted_join(k_named, p_recalls, ["code", "recall"], ["number"], "left_semi").select("number", "code", "recall", "copies"),
        "shared-recalls",
    )
    # A value counts here only where both sides of the code have it, and only for numbers that share a recall too; few do,
    # so the values left are few per number.
    value, own = ["x", "code", "kind"], ["number", "code", "kind", "x"]
    k_common = salted_join(k_own.select(*own), k_keys.select("number", "code").distinct(), ["number", "code"], ["x"], "left_semi")
    k_common = k_common.join(unbroadcast(met.select(*value).distinct()), value, "left_semi")
    p_common = met.select(*own)
    k_both = (
        salted_join(k_common, k_keys, ["number", "code"], ["x"])
        .groupBy("x", "code", "kind", "recall")
        .agg(F.sum(n).alias("k"))
    )
    k_both = stage(k_both, "common-sets")
    p_both = salted_join(p_common, p_keys, ["number", "code"], ["x"])
    both = (
        hot_salted_join(p_both, k_both, ["x", "code", "kind", "recall"], hot, ["number"])
        .groupBy("number", "code", "kind")
        .agg(F.sum("k").alias("term"))
    )
    terms = events.unionByName(recalls).unionByName(both)
    return terms.groupBy("number", "code").agg(
        *[
            F.sum(F.when(F.col("kind") == kind, F.col("term")).otherwise(0)).alias(f"shared_{kind}")
            for kind in ("report", "maker")
        ]
    )


def _recall_events(devices: DataFrame, tuples: DataFrame) -> DataFrame:
    """Per device number: distinct recall events of its own and of all clearances it pairs with.

    The events of a code are counted once. A number's own figure is the sum over its codes, less what events under
    several of its codes count too often, plus its own events that none of its codes has.
    """
    events = tuples.select("number", F.col("recall.res_event_number").alias("event")).filter(F.col("event").isNotNull())
    events = events.distinct()
    coded = devices.filter(F.col("number").isNotNull() & F.col("code").isNotNull())
    k_codes = coded.filter(F.col("role") == CLEARANCE).select("number", "code").distinct()
    code_events = salted_join(events, k_codes, ["number"], ["event"]).select("code", "event").distinct()
    code_events = stage(code_events, "code-events")
    codes = coded.filter(F.col("role") == APPROVAL).select("number", "code").distinct()
    numbers = codes.groupBy("number").agg(F.count("*").alias("n_codes"))

    per_code = code_events.groupBy("code").agg(F.count("*").alias("n"))
    summed = codes.join(unbroadcast(per_code), "code").select("number", "n")
    repeated = code_events.groupBy("event").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("event")
    several = codes.join(unbroadcast(numbers.filter(F.col("n_codes") > 1)), "number", "left_semi")
    met = salted_join(code_events.join(unbroadcast(repeated), "event", "left_semi"), several, ["code"], ["event"])
    twice = met.groupBy("number", "event").agg((F.lit(1) - F.count("*")).alias("n")).select("number", "n")
    twice = stage(twice.filter(F.col("n") < 0), "repeated-events")

    # An event of its own is met once for each of its codes; it counts where none of them has it.
    own = salted_join(events, codes, ["number"], ["event"])
    own = own.join(unbroadcast(code_events.withColumn("seen", F.lit(1))), ["code", "event"], "left")
    own = own.groupBy("number", "event").agg((F.lit(1) - F.coalesce(F.max("seen"), F.lit(0))).cast("long").alias("n"))
    # The parts are added up by one aggregate: joined to the numbers one by one, they made the largest plan of the rollup.
    parts = numbers.select("number", F.lit(0).cast("long").alias("n"))
    for part in (summed, twice, own.select("number", "n")):
        parts = parts.unionByName(part)
    return parts.groupBy("number").agg(F.sum("n").alias("n_all"))


def _least(*cols: str) -> Column:
    return F.least(*[F.col(c) for c in cols])


def device_rollup(feeds: Feeds) -> DataFrame:
    """Device figures with the view's fan-out: an event counts once per view row that shows it."""
    sets = stage(observed_sets(feeds.maude), "observed-sets")
    tuples = stage(recall_tuples(feeds.recall), "recall-tuples")
    return rollup_of(feeds, sets, tuples, event_facts(sets))


def rollup_of(feeds: Feeds, sets: DataFrame, tuples: DataFrame, events: DataFrame) -> DataFrame:
    """`device_rollup` from distinct reports and makers, distinct recalls and the event facts of every number."""
    devices = stage(device_facts(feeds, events, tuples), "device-facts")
    codes = stage(_code_totals(devices, feeds.product_code), "code-totals")
    shared = stage(_shared_terms(devices, sets, tuples), "shared-terms")
    recalled = stage(_recall_events(devices, tuples), "recall-events")
    rows = F.coalesce("code_rows", F.lit(1))

    approvals = devices.filter((F.col("role") == APPROVAL) & F.col("number").isNotNull())
    approvals = salted_join(approvals, codes, ["code"], ["number"], "left").join(unbroadcast(shared), ["number", "code"], "left")
    figure = lambda kind: (
        F.col("copies") * rows * (_sum_over_pairs(kind) + F.coalesce(f"shared_{kind}", F.lit(0)))
    )
    approvals = approvals.select(
        "number",
        F.col("n_recall_event"),
        figure("report").alias("events"),
        figure("maker").alias("makers"),
        "device_class",
        _least("first_day", "k_first_day").alias("first_day"),
        F.greatest("last_day", "k_last_day").alias("last_day"),
        _least("first_cause", "k_first_cause").alias("first_cause"),
    )

    # A clearance is a device of its own where no approval, or only unnumbered ones, carry its code.
    clearances = devices.filter((F.col("role") == CLEARANCE) & F.col("number").isNotNull())
    clearances = salted_join(clearances, codes, ["code"], ["number"], "left")
    partners = F.when(F.coalesce("p", F.lit(0)) > 0, F.col("p_unnumbered")).otherwise(F.lit(1))
    view_rows = F.col("copies") * rows * F.col("partners") * _at_least_one(F.col("n_recall"))
    clearances = (
        clearances.withColumn("partners", partners)
        .filter(F.col("partners") > 0)
        .select(
            "number",
            "n_recall_event",
            (view_rows * F.col("n_report")).alias("events"),
            (view_rows * F.col("n_maker")).alias("makers"),
            "device_class",
            "first_day",
            "last_day",
            "first_cause",
        )
    )
    return (
        approvals.unionByName(clearances)
        .groupBy("number")
        .agg(
            F.max("n_recall_event").alias("n_own"),
            F.sum("events").alias("total_adverse_events"),
            F.sum("makers").alias("unique_manufacturers"),
            F.max("device_class").alias("device_class"),
            F.min("first_day").alias("first_event_date"),
            F.max("last_day").alias("last_event_date"),
            F.min("first_cause").alias("first_cause"),
        )
        .join(unbroadcast(recalled), "number", "left")
        .select(
            F.col("number").alias("PMA_PMN_NUM"),
            F.coalesce("n_all", "n_own").alias("recall_count"),
            "total_adverse_events",
            "unique_manufacturers",
            "device_class",
            "first_event_date",
            "last_event_date",
            F.coalesce("first_cause.cause", F.lit(UNKNOWN_CAUSE)).alias("root_cause_description"),
        )
    )


def device_rollup_exact(feeds: Feeds) -> DataFrame:
    """Device figures without fan-out: each number's own events and recalls, counted once."""
    return rollup_exact_of(feeds, event_facts(observed_sets(feeds.maude)), recall_tuples(feeds.recall))


def rollup_exact_of(feeds: Feeds, events: DataFrame, tuples: DataFrame) -> DataFrame:
    """`device_rollup_exact` from the event facts of every number and distinct recalls."""
    devices = device_facts(feeds, events, tuples).filter(F.col("number").isNotNull())
    return (
        salted_join(devices, code_classes(feeds.product_code), ["code"], ["number"], "left")
        .groupBy(F.col("number").alias("PMA_PMN_NUM"))
        .agg(
            F.max("n_recall_event").alias("recall_count"),
            F.max("n_report").alias("total_adverse_events"),
            F.max("n_maker").alias("unique_manufacturers"),
            F.max("device_class").alias("device_class"),
            F.min("first_day").alias("first_event_date"),
            F.max("last_day").alias("last_event_date"),
            F.min("first_cause").alias("first_cause"),
        )
        .withColumn("root_cause_description", F.coalesce("first_cause.cause", F.lit(UNKNOWN_CAUSE)))
        .drop("first_cause")
    )
