"""The registered queries: each takes a session and a table folder and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recall_lens.functions.cleaning import clean_date, clean_json_value, clean_text, to_number, truncate_columns
from recall_lens.operators import analytics, classify, forecasting, names, publish, timeseries
from recall_lens.operators.analytics import DeviceFilter
from recall_lens.operators.incremental import RollupState
from recall_lens.operators.integration import integrated_view
from recall_lens.operators.rollup import device_rollup, device_rollup_exact
from recall_lens.operators.scoring import FEATURES, score_components
from recall_lens.operators.skew import folder_state, stage
from recall_lens.plans import round_trips
from recall_lens.plans.refresh import score
from recall_lens.plans.round_trips import new_folder
from recall_lens.sinks.bucketed import BucketedTable
from recall_lens.sources import recall_feed
from recall_lens.sources.delimited import DelimitedFeed, read_feeds, read_text
from recall_lens.sources.encodings import single_byte
from recall_lens.sources.testdata import Feeds, feeds

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2025, 1, 1)
SCORED_AT = dt.datetime(2025, 1, 1)
EARLIER = dt.datetime(2024, 1, 1)
PERIODS = 6

# The choices the filtered queries run with.
CHOSEN = DeviceFilter(
    categories=("Medium", "High", "Critical"),
    classes=(1.0, 2.0, 3.0),
    causes=(analytics.ALL,),
    score=(0.2, 0.9),
    min_recalls=1,
)
EVERYTHING = DeviceFilter()
TEXT_WIDTHS = {"KNUMBER": 20, "DEVICENAME": 1000, "STATEORSUMM": None}

_published: dict[tuple[str, ...], DataFrame] = {}


def _once(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table of a folder, made once per session and state of the folder's files."""
    key = (spark.sparkContext.applicationId, folder, folder_state(spark, folder), name)
    if key not in _published:
        _published[key] = make()
    return _published[key]


def published(spark: SparkSession, folder: str, exact: bool = False) -> DataFrame:
    """The score table of a folder: scored and written once, then read like any published table."""
    name = "exact scores" if exact else "scores"
    return _once(spark, folder, name, lambda: stage(score(feeds(spark, folder), exact), "device-rpss"))


def published_names(spark: SparkSession, folder: str) -> DataFrame:
    """The name table of a folder, as `names.publish_names` writes it."""

    def make() -> DataFrame:
        path = f"{new_folder(spark)}/names"
        names.publish_names(names.device_names(feeds(spark, folder), None), path)
        return spark.read.parquet(path)

    return _once(spark, folder, "names", make)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(f"`{c}`", digits) for c in doubles})


def _on_feeds(build: Callable[[Feeds], DataFrame]) -> Query:
    return lambda spark, folder: rounded(build(feeds(spark, folder)))


def _on_scores(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(build(published(spark, folder)))


# --- scores and publishing ---------------------------------------------------------------------------------------


def rpss_components(spark: SparkSession, folder: str) -> DataFrame:
    components = score_components(device_rollup(feeds(spark, folder)))
    scores = {c: F.round(c, 6) for _, c in FEATURES}
    return components.withColumns(scores).drop("first_event_date", "last_event_date", "root_cause_description")


def _staged_runs(spark: SparkSession, folder: str) -> DataFrame:
    return published(spark, folder).unionByName(published(spark, folder, exact=True))


def dedup_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Two scoring runs staged together, one row per device kept."""
    return rounded(publish.dedup_staging(_staged_runs(spark, folder)))


def _target_and_source(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Earlier scores of the devices with events, and the new scores of the recalled devices."""
    target = (
        published(spark, folder, exact=True)
        .filter(F.col("total_adverse_events") > 0)
        .withColumn("last_scored", F.lit(EARLIER.isoformat(sep=" ")).cast("timestamp_ntz"))
    )
    return target, published(spark, folder).filter(F.col("recall_count") > 0)


def upsert_scores(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _target_and_source(spark, folder)
    return rounded(publish.upsert_scores(target, source, SCORED_AT))


def upsert_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge into a bucketed table, of which it rewrites the buckets of the recalled devices."""
    target, source = _target_and_source(spark, folder)
    table = BucketedTable(spark, new_folder(spark), publish.KEY)
    table.merge(target, lambda _: target)
    table.merge(source, lambda old: publish.upsert_scores(old, source, SCORED_AT))
    return rounded(table.read())


def _stamped(spark: SparkSession, folder: str) -> DataFrame:
    stamp = F.lit(SCORED_AT.isoformat(sep=" ")).cast("timestamp_ntz")
    return published(spark, folder).withColumn("last_scored", stamp)


def export_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(publish.snapshot(_stamped(spark, folder), names.device_names(feeds(spark, folder))))


def name_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return names.name_coverage(publish.snapshot(_stamped(spark, folder), names.device_names(feeds(spark, folder))))


def _loaded_twice(spark: SparkSession, folder: str) -> tuple[RollupState, Feeds]:
    """A rollup state that events and recalls come to in two loads, of which the second overlaps the first."""
    source = feeds(spark, folder)
    part = F.pmod(F.xxhash64("MDR_REPORT_KEY"), F.lit(10))
    recalls = F.pmod(F.xxhash64("cfres_id"), F.lit(10))
    state = RollupState(spark, new_folder(spark))
    for events, recalled in ((part < 6, recalls < 6), (part >= 4, recalls >= 4)):
        state.add_events(source.maude.filter(F.coalesce(events, F.lit(True))))
        state.add_recalls(source.recall.filter(F.coalesce(recalled, F.lit(True))))
    return state, source


def rollup_incremental(spark: SparkSession, folder: str) -> DataFrame:
    state, source = _loaded_twice(spark, folder)
    return rounded(state.rollup(source))


def rollup_exact_incremental(spark: SparkSession, folder: str) -> DataFrame:
    state, source = _loaded_twice(spark, folder)
    return rounded(state.rollup_exact(source))


# --- series and forecasts ----------------------------------------------------------------------------------------


def _dated(scored: DataFrame) -> DataFrame:
    return timeseries.assign_dates(scored, AS_OF)


def _series(scored: DataFrame) -> DataFrame:
    return timeseries.spread_series(_dated(scored))


def _text_dates(scored: DataFrame) -> DataFrame:
    """The dates as text in one of two layouts; devices without recalls carry a text that is no date."""
    odd = F.length("PMA_PMN_NUM") % 2 == 1
    text = F.when(odd, F.date_format("last_scored", "dd-MMM-yyyy")).otherwise(F.date_format("last_scored", "MM/dd/yyyy"))
    return _dated(scored).withColumn("last_scored", F.when(F.col("recall_count") > 0, text).otherwise(F.lit("31/31/2024")))


def _forecast(method: str, alignment: str = "month_start") -> Query:
    return _on_scores(lambda s: forecasting.forecast(_series(s), PERIODS, method, alignment))


def _padded(scored: DataFrame) -> DataFrame:
    return timeseries.pad_series(timeseries.plain_series(_dated(scored), freq="Y"), "Y")


def _history_and_forecast(scored: DataFrame) -> DataFrame:
    series = _series(scored)
    return forecasting.history_and_forecast(series, forecasting.forecast(series, PERIODS))


# --- cleaning ----------------------------------------------------------------------------------------------------


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cleaned_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    return docs.select("doc_id", clean_text(F.col("text")).alias("text"), clean_text(F.col("source")).alias("source"))


def cleaned_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates written in every layout of the feeds in turn, the last no date at all, and read back."""
    layouts = (
        "yyyy-MM-dd", " MM/dd/yyyy", "yyyyMMdd", "dd-MMM-yyyy", "MMM d, yyyy", "yyyy/M/d", "M/d/yy", "MMMM d, yyyy",
        "d MMMM yyyy", "dd MMM yyyy", "MM-dd-yyyy", "yyyy.MM.dd", "ddMMMyyyy", "yyyyMMdd HHmm", "yyyy-MM-dd HH:mm:ss",
        "'13/45/'yyyy",
    )
    turn, day = F.pmod("o_orderkey", F.lit(len(layouts))), F.col("o_orderdate")
    written = F.coalesce(*[F.when(turn == i, F.date_format(day, layout)) for i, layout in enumerate(layouts)])
    return _read(spark, folder, "orders").select("o_orderkey", clean_date(written).alias("order_day"))


def truncated_columns(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select(
        "doc_id",
        F.concat_ws("/", "source", "lang", F.md5("text")).alias("KNUMBER"),
        F.col("text").alias("DEVICENAME"),
        F.col("text").alias("STATEORSUMM"),
    )
    return truncate_columns(docs, TEXT_WIDTHS)


def coerced_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "events").select(
        "event_id",
        to_number(F.get_json_object("props", "$.k")).alias("k"),
        to_number(F.col("event_type")).alias("not_a_number"),
    )


def cleaned_json(spark: SparkSession, folder: str) -> DataFrame:
    nested = T.StructType([T.StructField("k", T.LongType())])
    return _read(spark, folder, "events").select(
        "event_id",
        clean_json_value(F.from_json("props", nested), nested).alias("props"),
        clean_json_value(F.col("event_type"), T.StringType()).alias("event_type"),
    )


def flat_recalls(spark: SparkSession, folder: str) -> DataFrame:
    """Recalls as a flat text table: the array of device numbers as JSON text."""
    recall = feeds(spark, folder).recall
    return recall.select(*[clean_json_value(F.col(f.name), f.dataType).alias(f.name) for f in recall.schema])


# --- feeds written and read back ---------------------------------------------------------------------------------


def ingest_delimited(spark: SparkSession, folder: str) -> DataFrame:
    """Parts written as delimited clearances, in two column orders, and read through the feed reader."""
    part, root = _read(spark, folder, "part"), new_folder(spark)
    columns = {
        "KNUMBER": F.concat(F.lit(" k"), F.col("p_partkey")),
        "DEVICENAME": F.col("p_name"),
        "PRODUCTCODE": F.lower("p_brand"),
        "APPLICANT": F.col("p_type"),
        "DECISIONDATE": F.date_format(F.date_add(F.lit("2020-01-01"), F.col("p_size")), "MM/dd/yyyy"),
    }
    for odd, names_ in ((0, list(columns)), (1, list(columns)[::-1])):
        rows = part.filter(F.col("p_partkey") % 2 == odd).select(*[columns[c].alias(c) for c in names_])
        rows.write.option("header", True).option("sep", "|").csv(f"{root}/{odd}")
    return read_feeds(spark, [DelimitedFeed("premarket_510k", f"{root}/*/*.csv")])["premarket_510k"].select(*columns)


def ingest_encodings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as clearances in UTF-8, cp1252 and Latin-1 by turns, and read by a feed that is told none.

    Characters outside Latin-1 are blanked first; every text gets one that tells its encoding from the others.
    """
    root = new_folder(spark)
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\x20-\x7e\xa0-\xff]", " ")
    docs = _read(spark, folder, "documents").select("doc_id", F.concat(F.lit("a"), text, F.lit("z")).alias("text"))
    for turn, (encoding, sign) in enumerate((("utf-8", "日€"), ("cp1252", "€œ"), ("latin1", "\x81"))):
        told = F.concat("text", F.lit(sign))
        told = told if encoding == "utf-8" else single_byte(encoding).encoded(told)
        rows = docs.filter(F.pmod("doc_id", F.lit(3)) == turn).select(F.col("doc_id").alias("KNUMBER"), told.alias("DEVICENAME"))
        writer = rows.write.option("header", True).option("sep", "|").option("escape", '"')
        writer.option("encoding", "UTF-8" if encoding == "utf-8" else "ISO-8859-1").csv(f"{root}/{turn}")
    read = read_text(spark, DelimitedFeed("premarket_510k", f"{root}/*/*.csv", encoding=("utf-8", "cp1252", "latin1")))
    name = F.col("DEVICENAME")
    return read.select(F.col("KNUMBER").cast("long").alias("doc_id"), F.length(name).alias("chars"), F.md5(name.cast("binary")).alias("digest"))


def ingest_recalls(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as recalls, one a line, their numbers as a list or as one text, and read through the reader."""
    orders, path = _read(spark, folder, "orders"), new_folder(spark)
    number = lambda c: F.concat(F.lit("k"), c.cast("string"))
    day = F.date_format("o_orderdate", "yyyyMMdd").alias("event_date_initiated")
    one = F.to_json(F.struct(F.col("o_orderkey").alias("cfres_id"), number(F.col("o_custkey")).alias("k_numbers"), day))
    two = F.array(number(F.col("o_custkey")), number(F.col("o_custkey") + 1))
    two = F.to_json(F.struct(F.col("o_orderkey").alias("cfres_id"), two.alias("k_numbers"), day))
    orders.select(F.when(F.col("o_orderkey") % 2 == 0, two).otherwise(one).alias("value")).write.text(path)
    recalls = recall_feed.clean_recalls(recall_feed.read_lines(spark, path))
    return recalls.select("cfres_id", F.array_join("k_numbers", ",").alias("k_numbers"), "event_date_initiated")


def ingest_document(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as recall documents of up to 200,000 members, each a file on one line, and read in ranges of bytes."""
    orders, path = _read(spark, folder, "orders"), new_folder(spark)
    texts = F.struct(
        F.col("o_orderkey").alias("cfres_id"),
        F.concat(F.lit('} ], "results": [{ \\ '), "o_orderpriority", F.lit('\n"{')).alias("action"),
        F.array(F.concat(F.lit("k"), F.col("o_custkey").cast("string"))).alias("k_numbers"),
        F.struct(F.array(F.struct(F.col("o_orderstatus").alias("status"))).alias("results")).alias("openfda"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("event_date_initiated"),
    )
    file = F.floor(F.col("o_orderkey") / 200_000).alias("file")
    rows = orders.select(file, F.lit(1).alias("part"), F.col("o_orderkey").alias("at"), F.concat(F.lit(","), F.to_json(texts)).alias("value"))
    ends = rows.select("file").distinct()
    head = ends.select("file", F.lit(0).alias("part"), F.lit(0).alias("at"), F.lit('{"meta": {"results": {"total": 1}, "results": [{"x": 1}]}, "results": [[{}], 7, {"cfres_id": null}').alias("value"))
    tail = ends.select("file", F.lit(2).alias("part"), F.lit(0).alias("at"), F.lit('], "other": [{"cfres_id": "no"}]}').alias("value"))
    document = rows.unionByName(head).unionByName(tail).repartition("file").sortWithinPartitions("file", "part", "at")
    document.select("file", "value").write.partitionBy("file").option("lineSep", " ").text(path)
    recalls = recall_feed.clean_recalls(recall_feed.read_documents(spark, path)).filter(F.col("cfres_id").isNotNull())
    return recalls.select("cfres_id", "action", F.array_join("k_numbers", ",").alias("k_numbers"), "openfda", "event_date_initiated")


# --- classifier --------------------------------------------------------------------------------------------------


def ml_split(spark: SparkSession, folder: str) -> DataFrame:
    prepared = classify.prepare(published(spark, folder)).filter(classify.valid_row())
    return classify.stratified_split(prepared).select("PMA_PMN_NUM", "has_recall", "is_test")


_trained: dict[tuple[str, ...], tuple[classify.RecallClassifier, DataFrame]] = {}


def trained(
    spark: SparkSession, folder: str, model_type: str = "random_forest"
) -> tuple[classify.RecallClassifier, DataFrame]:
    """The classifier of a folder, trained once per session, state of the folder's files and type; all its reports come
    from that one training."""
    key = (spark.sparkContext.applicationId, folder, folder_state(spark, folder), model_type)
    if key not in _trained:
        _trained[key] = classify.train(published(spark, folder), model_type=model_type)
    return _trained[key]


def ml_predictions(spark: SparkSession, folder: str) -> DataFrame:
    model, _ = trained(spark, folder)
    return rounded(model.predict(published(spark, folder)))


def ml_feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(trained(spark, folder)[0].feature_importance(spark))


def ml_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(classify.metrics(trained(spark, folder)[1]))


def ml_metrics_boosted(spark: SparkSession, folder: str) -> DataFrame:
    """The report of the gradient-boosted model, of as many rounds as `train` gives it."""
    return rounded(classify.metrics(trained(spark, folder, "gradient_boosting")[1]))


def ml_confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return classify.confusion_matrix(trained(spark, folder)[1])


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Quality as the label and toxicity as the prediction: reports on them need no model."""
    labels = _read(spark, folder, "labels").filter("quality IS NOT NULL AND toxic IS NOT NULL")
    guess = F.col("toxic").cast("double")
    return labels.select(F.col("quality").alias(classify.LABEL), guess.alias("prediction"), guess.alias("rawPrediction"))


def eval_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return classify.confusion_matrix(_labelled(spark, folder))


def eval_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(classify.metrics(_labelled(spark, folder)))


def _top_list(high_risk_only: bool) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        scored = published(spark, folder)
        model, _ = trained(spark, folder)

        def found(asked: DataFrame) -> DataFrame:
            named = names.lookup_names(published_names(spark, folder), asked)
            return named.withColumn("device_name", F.coalesce("device_name", F.lit(names.UNKNOWN_DEVICE)))

        return rounded(classify.top_predictions(model.predict(scored), found, high_risk_only=high_risk_only))

    return run


def names_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the 20 highest devices and of one that no feed has, found in the published name table."""
    top = publish.top_devices(published(spark, folder), 20).select(publish.KEY)
    asked = top.unionByName(spark.createDataFrame([("no such device",)], top.schema))
    return names.lookup_names(published_names(spark, folder), asked)


def ml_high_risk_count(spark: SparkSession, folder: str) -> DataFrame:
    scored = published(spark, folder)
    model, _ = trained(spark, folder)
    return classify.high_risk_count(model.predict(scored))


QUERIES: dict[str, Query] = {
    "integrated_view": _on_feeds(integrated_view),
    "device_rollup": _on_feeds(device_rollup),
    "device_rollup_exact": _on_feeds(device_rollup_exact),
    "rollup_incremental": rollup_incremental,
    "rollup_exact_incremental": rollup_exact_incremental,
    "rpss_components": rpss_components,
    "rpss_scores": _on_feeds(score),
    "rpss_scores_exact": _on_feeds(lambda f: score(f, exact=True)),
    "dedup_staging": dedup_staging,
    "upsert_scores": upsert_scores,
    "upsert_bucketed": upsert_bucketed,
    "scored_view": lambda spark, folder: rounded(publish.scored_view(_stamped(spark, folder))),
    "device_names": _on_feeds(names.device_names),
    "names_lookup": names_lookup,
    "export_snapshot": export_snapshot,
    "name_coverage": name_coverage,
    "summary_stats": _on_scores(analytics.summary_stats),
    "filter_options": _on_scores(analytics.filter_options),
    "filtered_devices": _on_scores(lambda s: analytics.filtered_devices(s, CHOSEN)),
    "filtered_count": _on_scores(lambda s: analytics.filtered_count(s, CHOSEN)),
    "risk_distribution": _on_scores(lambda s: analytics.risk_distribution(s, CHOSEN)),
    "risk_share": _on_scores(lambda s: analytics.risk_share(s, EVERYTHING)),
    "root_cause_impact": _on_scores(lambda s: analytics.root_cause_impact(s, CHOSEN)),
    "root_cause_impact_rows": _on_scores(
        lambda s: analytics.root_cause_impact(s, EVERYTHING, min_devices=0, distinct_devices=False)
    ),
    "kpis": _on_scores(lambda s: analytics.kpis(s, CHOSEN)),
    "kpis_limited_mean": _on_scores(lambda s: analytics.kpis(s, CHOSEN, mean_of_first=100)),
    "score_bands": _on_scores(analytics.score_bands),
    "assign_dates": _on_scores(lambda s: _dated(s).select("PMA_PMN_NUM", "recall_count", "last_scored")),
    "synthetic_dates": _on_scores(
        lambda s: timeseries.dates_by_rank(s, AS_OF).select("PMA_PMN_NUM", "synthetic_date")
    ),
    "ts_distributed": _on_scores(_series),
    "ts_plain": _on_scores(lambda s: timeseries.plain_series(_dated(s))),
    "ts_text_dates": _on_scores(lambda s: timeseries.plain_series(_text_dates(s))),
    "ts_quarterly": _on_scores(lambda s: timeseries.plain_series(_dated(s), freq="Q")),
    "ts_padded": _on_scores(_padded),
    "trailing_mean": _on_scores(lambda s: timeseries.trailing_mean(_series(s))),
    "trend_analysis": _on_scores(lambda s: timeseries.trend_analysis(_series(s))),
    "monthly_spine": _on_scores(lambda s: forecasting.monthly_spine(_series(s))),
    "forecast_moving_average": _forecast("moving_average"),
    "forecast_last_value": _forecast("last_value"),
    "forecast_exponential_smoothing": _forecast("exponential_smoothing"),
    "forecast_smoothed": _forecast("smoothed"),
    "forecast_linear_trend": _forecast("linear_trend"),
    "forecast_month_end_parity": _forecast("moving_average", "month_end"),
    "forecast_linear_month_end_parity": _forecast("linear_trend", "month_end"),
    "forecast_summary": _on_scores(
        lambda s: forecasting.forecast_summary(forecasting.forecast(_series(s), PERIODS))
    ),
    "history_and_forecast": _on_scores(_history_and_forecast),
    "clean_text": cleaned_text,
    "clean_dates": cleaned_dates,
    "truncate_columns": truncated_columns,
    "numeric_coerce": coerced_numbers,
    "clean_json": cleaned_json,
    "flat_recalls": flat_recalls,
    "ingest_delimited": ingest_delimited,
    "ingest_encodings": ingest_encodings,
    "ingest_recalls": ingest_recalls,
    "ingest_document": ingest_document,
    "eval_confusion": eval_confusion,
    "eval_report": eval_report,
    **round_trips.QUERIES,
    "ml_features": _on_scores(classify.feature_table),
    "ml_split": ml_split,
    "ml_predictions": ml_predictions,
    "ml_feature_importance": ml_feature_importance,
    "ml_metrics": ml_metrics,
    "ml_metrics_boosted": ml_metrics_boosted,
    "ml_confusion_matrix": ml_confusion_matrix,
    "ml_high_risk_count": ml_high_risk_count,
    "ml_top20": _top_list(high_risk_only=False),
    "ml_top20_high_risk": _top_list(high_risk_only=True),
}
