"""Recall likelihood: features, exact stratified split, tree ensembles, evaluation, prediction."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.functions.cleaning import with_alias
from recall_lens.functions.display import percent
from recall_lens.operators.dictionary import ordered_codes
from recall_lens.operators.names import with_device_names
from recall_lens.operators.publish import top_devices
from recall_lens.operators.skew import salted_join, spread_rank, stage

FEATURES = ("rpss", "device_class", "root_cause_encoded", "log_adverse_events", "log_manufacturers")
LABEL = "has_recall"
HIGH_RISK = 0.7

# Parts the training rows are dealt to: at least so many, and one for so many rows.
LEAST_PARTS = 8
PART_ROWS = 500_000
#: Thresholds a feature is cut at; causes are numbers, so there may be more of them.
MOST_BINS = 256
KEY = "PMA_PMN_NUM"


def prepare(scored: DataFrame) -> DataFrame:
    """Feature inputs: nulls to zero, missing causes to 'Other', logs of the counts, and the label."""
    df = with_alias(scored, "unique_manufacturers", ["unique-manufacturers"])
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return df.withColumns(
        {
            "f_rpss": zero("rpss"),
            "f_device_class": zero("device_class"),
            "f_cause": F.coalesce("root_cause_description", F.lit("Other")),
            "f_log_adverse_events": F.log1p(zero("total_adverse_events")),
            "f_log_manufacturers": F.log1p(zero("unique_manufacturers")),
            LABEL: (F.coalesce("recall_count", F.lit(0)) > 0).cast("int"),
        }
    )


def valid_row() -> Column:
    """Every numeric feature is a finite number."""
    numeric = [F.col(f"f_{c}") for c in ("rpss", "device_class", "log_adverse_events", "log_manufacturers")]
    condition = F.lit(True)
    for c in numeric:
        condition = condition & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return condition


def cause_codes(prepared: DataFrame) -> DataFrame:
    """Causes with their position in sorted order; as many rows as there are distinct causes."""
    codes = ordered_codes(prepared, "f_cause", "root_cause_encoded")
    return codes.withColumn("root_cause_encoded", F.col("root_cause_encoded").cast("double"))


def feature_table(scored: DataFrame) -> DataFrame:
    """The feature matrix and label, one row per device."""
    prepared = prepare(scored)
    coded = salted_join(prepared, cause_codes(prepared), ["f_cause"], [KEY], "left", bounded=True)
    return coded.select(
        KEY,
        F.col("f_rpss").alias("rpss"),
        F.col("f_device_class").alias("device_class"),
        "root_cause_encoded",
        F.col("f_log_adverse_events").alias("log_adverse_events"),
        F.col("f_log_manufacturers").alias("log_manufacturers"),
        LABEL,
    )


def stratified_split(prepared: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Exact split within each label: adds `is_test`. Repeatable, since order comes from a hash of the device number."""
    ranked = spread_rank(prepared, F.col(KEY), "_rank", [LABEL])
    in_train = F.col("_rank") <= F.round(F.col("_rank_total") * (1 - test_size))
    return ranked.withColumn("is_test", ~in_train).drop("_rank", "_rank_total")


def _estimator(model_type: str, trees: int, max_bins: int) -> RandomForestClassifier | GBTClassifier:
    common = dict(featuresCol="features", labelCol=LABEL, maxBins=max_bins, seed=42)
    if model_type == "random_forest":
        return RandomForestClassifier(numTrees=trees, maxDepth=10, minInstancesPerNode=2, **common)
    if model_type == "gradient_boosting":
        return GBTClassifier(maxIter=trees, maxDepth=5, stepSize=0.1, **common)
    raise ValueError(f"no such model: {model_type}")


@dataclass
class RecallClassifier:
    """A fitted pipeline with the numbers of the causes it has seen."""

    model: PipelineModel
    codes: DataFrame

    def _inputs(self, scored: DataFrame) -> DataFrame:
        """Feature inputs; a cause not seen in training counts as 'Other', and as a number of its own if that is new too."""
        other = F.col("root_cause_encoded")
        fallback = self.codes.agg(F.coalesce(F.max(F.when(F.col("f_cause") == "Other", other)), F.max(other) + 1)).first()[0]
        coded = salted_join(prepare(scored), self.codes, ["f_cause"], [KEY], "left", bounded=True)
        return coded.withColumn("f_root_cause_encoded", F.coalesce("root_cause_encoded", F.lit(fallback)))

    def predict(self, scored: DataFrame) -> DataFrame:
        """Input columns with class and probability; rows with an invalid feature get 0 and 0.0."""
        usable = valid_row()
        inputs = self._inputs(scored).withColumn("f_valid", usable)
        # Invalid numbers are zeroed for the model and their result is overwritten: one pass, no join back.
        numeric = ("f_rpss", "f_device_class", "f_log_adverse_events", "f_log_manufacturers")
        inputs = inputs.withColumns({c: F.when(F.col("f_valid"), F.col(c)).otherwise(F.lit(0.0)) for c in numeric})
        out = self.model.transform(inputs)
        probability = vector_to_array("probability")[1]
        return out.select(
            *[F.col(f"`{c}`") for c in scored.columns],
            F.when(F.col("f_valid"), F.col("prediction").cast("int")).otherwise(F.lit(0)).alias("predicted_recall"),
            F.when(F.col("f_valid"), probability).otherwise(F.lit(0.0)).alias("recall_probability"),
        )

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        weights = self.model.stages[-1].featureImportances.toArray()
        rows = [(name, float(w)) for name, w in zip(FEATURES, weights)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.col("importance").desc(), "feature"
        )

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.codes.write.mode("overwrite").parquet(f"{path}/causes")

    @classmethod
    def load(cls, path: str) -> RecallClassifier:
        model = PipelineModel.load(f"{path}/model")
        return cls(model, SparkSession.active().read.parquet(f"{path}/causes"))


def train(
    scored: DataFrame, test_size: float = 0.2, model_type: str = "random_forest", trees: int = 100
) -> tuple[RecallClassifier, DataFrame]:
    """Fit on the training part; returns the classifier and the test rows with their predictions."""
    _estimator(model_type, trees, 32)
    usable = prepare(scored).filter(valid_row())
    if usable.isEmpty():
        raise ValueError("no row has finite features")
    codes = stage(cause_codes(usable), "cause-codes")
    usable = salted_join(usable, codes, ["f_cause"], [KEY], bounded=True).withColumnRenamed("root_cause_encoded", "f_root_cause_encoded")
    assembler = VectorAssembler(inputCols=[f"f_{c}" for c in FEATURES], outputCol="features")
    parts = stratified_split(usable, test_size)
    estimator = _estimator(model_type, trees, min(MOST_BINS, max(32, codes.count() + 2)))
    # Bootstrap samples depend on where a row lies, so rows are placed by their key, in as many parts as their number
    # asks for and not the session: the same data, the same trees.
    fitted = parts.filter(~F.col("is_test"))
    places = max(LEAST_PARTS, fitted.count() // PART_ROWS)
    fitted = fitted.repartition(places, KEY).sortWithinPartitions(KEY)
    model = Pipeline(stages=[assembler, estimator]).fit(fitted)
    tested = model.transform(parts.filter("is_test")).select(
        KEY, LABEL, "prediction", "rawPrediction", vector_to_array("probability")[1].alias("recall_probability")
    )
    return RecallClassifier(model, codes), tested


def confusion_matrix(tested: DataFrame) -> DataFrame:
    """Counts of actual x predicted, all four cells."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counted = tested.agg(
        *[
            F.count(F.when((F.col(LABEL) == a) & (F.col("prediction") == p), 1)).alias(f"n{a}{p}") for a, p in cells
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n{a}{p}").alias("rows"))
            for a, p in cells
        ]
    )
    return counted.select(F.inline(rows))


def metrics(tested: DataFrame) -> DataFrame:
    """Accuracy, AUC, and precision / recall / F1 / support per class with macro and weighted means, as rows."""
    auc = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction", numBins=0).evaluate(tested)
    hit = lambda a, p: F.count(F.when((F.col(LABEL) == a) & (F.col("prediction") == p), 1))
    counted = tested.agg(*[hit(a, p).cast("double").alias(f"n{a}{p}") for a in (0, 1) for p in (0, 1)])
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0))
    out, support = {}, {}
    for c, o in ((0, 1), (1, 0)):
        tp, fn, fp = F.col(f"n{c}{c}"), F.col(f"n{c}{o}"), F.col(f"n{o}{c}")
        precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
        support[c] = tp + fn
        out[c] = (precision, recall, ratio(2 * precision * recall, precision + recall))
    total = support[0] + support[1]
    accuracy = ratio(F.col("n00") + F.col("n11"), total)
    macro = [(a + b) / 2 for a, b in zip(out[0], out[1])]
    weighted = [ratio(a * support[0] + b * support[1], total) for a, b in zip(out[0], out[1])]
    blank = [F.lit(None).cast("double")] * 2

    def row(name: str, precision: Column, recall: Column, f1: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("value"),
            n.cast("long").alias("support"),
        )

    rows = [
        row("No Recall", *out[0], support[0]),
        row("Has Recall", *out[1], support[1]),
        row("macro avg", *macro, total),
        row("weighted avg", *weighted, total),
        row("accuracy", *blank, accuracy, total),
        row("auc", *blank, F.lit(auc), total),
    ]
    return counted.select(F.inline(F.array(*rows)))


def high_risk_count(predicted: DataFrame) -> DataFrame:
    return predicted.agg(F.count(F.when(F.col("recall_probability") > HIGH_RISK, 1)).alias("high_risk_devices"))


def top_predictions(
    predicted: DataFrame,
    names: DataFrame | Callable[[DataFrame], DataFrame],
    n: int = 20,
    high_risk_only: bool = False,
) -> DataFrame:
    """The n likeliest devices with names; in the high-risk list a device without a name shows its number.

    `names` may be a function of the asked numbers, so that no others are looked up.
    """
    rows = predicted.filter(F.col("recall_probability") > HIGH_RISK) if high_risk_only else predicted
    listed = top_devices(rows, n, "recall_probability")
    # n rows at most: kept as they are, so that nothing is predicted again for the names
    top = predicted.sparkSession.createDataFrame(listed.collect(), listed.schema)
    found = names(top.select(KEY)) if callable(names) else names
    named = with_device_names(top, found, F.col(KEY) if high_risk_only else None)
    return named.select(
        "device_name",
        KEY,
        "rpss_category",
        "recall_count",
        "recall_probability",
        percent(F.col("recall_probability")).alias("recall_probability_text"),
        "total_adverse_events",
        "device_class",
        "rpss",
    ).orderBy(F.col("recall_probability").desc(), KEY)
