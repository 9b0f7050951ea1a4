from __future__ import annotations

import random

import pytest

from recall_lens.operators import classify
from recall_lens.plans import queries

SCHEMA = (
    "PMA_PMN_NUM string, recall_count long, total_adverse_events long, unique_manufacturers long, "
    "device_class double, root_cause_description string, rpss double, rpss_category string"
)


def device_rows(n=400, causes=("Design", "Packaging", "Software", None)):
    r = random.Random(1)
    rows = []
    for i in range(n):
        score = r.random()
        recalls = r.randrange(1, 5) if score + r.random() * 0.4 > 0.7 else 0
        rows.append(
            (
                f"K{i:05d}", recalls, r.randrange(200), r.randrange(5), float(r.randrange(1, 4)), r.choice(causes),
                score, "Low",
            )
        )
    return rows


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(device_rows(), SCHEMA)


@pytest.fixture(scope="module")
def trained(scored):
    return classify.train(scored, trees=20)


def test_split_is_exact_and_repeatable(scored):
    prepared = classify.prepare(scored)
    counts = {}
    for r in classify.stratified_split(prepared).groupBy("has_recall", "is_test").count().collect():
        counts[r["has_recall"], r["is_test"]] = r["count"]
    for label in (0, 1):
        n = counts[label, True] + counts[label, False]
        assert counts[label, False] == round(n * 0.8)
    pick = lambda df: {r["PMA_PMN_NUM"] for r in classify.stratified_split(df).filter("is_test").collect()}
    assert pick(prepared) == pick(prepared.repartition(7))


def test_quality_and_metrics(trained):
    rows = {r["metric"]: r for r in classify.metrics(trained[1]).collect()}
    assert rows["auc"]["value"] > 0.85 and rows["accuracy"]["value"] > 0.75
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in classify.confusion_matrix(trained[1]).collect()}
    total = sum(cells.values())
    assert rows["accuracy"]["value"] == pytest.approx((cells[0, 0] + cells[1, 1]) / total)
    assert rows["Has Recall"]["precision"] == pytest.approx(cells[1, 1] / (cells[1, 1] + cells[0, 1]))
    assert rows["Has Recall"]["recall"] == pytest.approx(cells[1, 1] / (cells[1, 1] + cells[1, 0]))
    assert rows["No Recall"]["support"] + rows["Has Recall"]["support"] == rows["macro avg"]["support"] == total


def test_predict_keeps_columns_and_zeroes_invalid_rows(spark, scored, trained):
    odd = [
        ("inf", 1, 5, 1, float("inf"), "Design", 0.9, "Low"),
        ("nan", 1, 5, 1, 2.0, "Design", float("nan"), "Low"),
        ("unseen", 1, 5, 1, 2.0, "Never seen", 0.95, "Low"),
        ("nulls", None, None, None, None, None, None, None),
    ]
    out = trained[0].predict(spark.createDataFrame(odd, SCHEMA))
    rows = {r["PMA_PMN_NUM"]: r for r in out.collect()}
    assert out.columns == [*scored.columns, "predicted_recall", "recall_probability"]
    assert all((rows[k]["predicted_recall"], rows[k]["recall_probability"]) == (0, 0.0) for k in ("inf", "nan"))
    assert rows["unseen"]["recall_probability"] > 0.5 and rows["inf"]["device_class"] == float("inf")


def test_cause_without_other_in_training(spark):
    model, _ = classify.train(spark.createDataFrame(device_rows(120, ("Design", "Software")), SCHEMA), trees=5)
    row = spark.createDataFrame([("x", 1, 5, 1, 2.0, "Never seen", 0.5, "Low")], SCHEMA)
    assert 0 <= model.predict(row).first()["recall_probability"] <= 1


def test_same_seed_same_predictions(scored, trained):
    again, _ = classify.train(scored, trees=20)
    of = lambda m: sorted((r["PMA_PMN_NUM"], r["recall_probability"]) for r in m.predict(scored).collect())
    assert of(again) == of(trained[0])


def test_save_and_load(spark, scored, trained, tmp_path):
    path = str(tmp_path / "model")
    trained[0].save(path)
    loaded = classify.RecallClassifier.load(path)
    assert sorted(loaded.predict(scored).collect()) == sorted(trained[0].predict(scored).collect())
    assert sorted(loaded.codes.collect()) == sorted(trained[0].codes.collect())


def test_importance(spark, trained):
    rows = trained[0].feature_importance(spark).collect()
    assert {r["feature"] for r in rows} == set(classify.FEATURES)
    assert rows[0]["feature"] == "rpss" and sum(r["importance"] for r in rows) == pytest.approx(1.0)


def test_gradient_boosting(scored):
    _, tested = classify.train(scored, model_type="gradient_boosting", trees=3)
    assert {r["metric"]: r for r in classify.metrics(tested).collect()}["auc"]["value"] > 0.8


def test_bad_input(spark, scored):
    with pytest.raises(ValueError):
        classify.train(scored, model_type="svm")
    with pytest.raises(ValueError):
        classify.train(spark.createDataFrame([("a", 1, 1, 1, float("inf"), "x", 0.5, "Low")], SCHEMA))


def test_top_lists(spark, scored, trained):
    names = spark.createDataFrame([("K00000", "Pump")], "PMA_PMN_NUM string, device_name string")
    predicted = trained[0].predict(scored)
    top = classify.top_predictions(predicted, names, 20).collect()
    assert len(top) == 20 and [r["recall_probability"] for r in top] == sorted(
        (r["recall_probability"] for r in top), reverse=True
    )
    assert {r["device_name"] for r in top} <= {"Pump", "—"}
    risky = classify.top_predictions(predicted, names, 20, high_risk_only=True).collect()
    assert all(r["recall_probability"] > 0.7 for r in risky)
    assert all(r["device_name"] in ("Pump", r["PMA_PMN_NUM"]) for r in risky)
    count = classify.high_risk_count(predicted).first()[0]
    assert count == predicted.filter("recall_probability > 0.7").count()


def test_features_take_either_manufacturer_column(spark):
    df = spark.createDataFrame(
        [("a", 1, 3, 7, 2.0, "Design", 0.5), ("b", None, None, None, None, None, None)],
        "PMA_PMN_NUM string, recall_count long, total_adverse_events long, `unique-manufacturers` long, "
        "device_class double, root_cause_description string, rpss double",
    )
    rows = {r["PMA_PMN_NUM"]: r for r in classify.feature_table(df).collect()}
    assert rows["a"]["log_manufacturers"] == pytest.approx(2.0794415416798357) and rows["a"]["has_recall"] == 1
    assert [rows["b"][c] for c in ("rpss", "device_class", "root_cause_encoded", "has_recall")] == [0, 0, 1, 0]


def test_boosted_query_trains_all_rounds_once(spark, scored, monkeypatch):
    made, estimator = [], classify._estimator
    monkeypatch.setattr(classify, "_estimator", lambda *a: made.append(a[:2]) or estimator(a[0], min(a[1], 2), a[2]))
    monkeypatch.setattr(queries, "published", lambda spark, folder: scored)
    monkeypatch.setattr(queries, "_trained", {})
    for _ in range(2):
        assert queries.ml_metrics_boosted(spark, "boosted").count() == 6
    assert set(made) == {("gradient_boosting", 100)} and len(queries._trained) == 1


def test_codes_follow_the_order_of_values(spark):
    from recall_lens.operators.dictionary import ordered_codes

    values = [f"{c}{i % 700}" for i in range(5000) for c in ("a", "B", "é", " ")] + [None] * 9
    df = spark.createDataFrame([(v, 1) for v in values], "cause string, code int").repartition(7)
    found = ordered_codes(df, "cause").collect()
    assert sorted((r.code, r.cause) for r in found) == list(enumerate(sorted({v for v in values if v}, key=str.encode)))
    assert ordered_codes(df.filter("cause IS NULL"), "cause").count() == 0


def test_trees_split_on_the_order_of_causes(spark):
    """Causes of one half of the alphabet mean recalls, other features nothing: few splits are enough."""
    rows = [(f"K{i:05d}", int(i % 60 >= 30), 5, 1, 2.0, f"cause {i % 60:02d}", 0.5, "Low") for i in range(1800)]
    _, tested = classify.train(spark.createDataFrame(rows, SCHEMA), trees=10)
    assert {r["metric"]: r["value"] for r in classify.metrics(tested).collect()}["accuracy"] == 1.0
