"""Ordinal regression: its gradient, its order of grades, and held-out documents."""

import numpy as np

from recall_lens.llm import queries, toxicity

FOLDER = "/root/testdata/sf0.1"


def test_grades_are_learnt_in_order():
    rng = np.random.default_rng(1)
    words = [set(rng.integers(100, 400, 12).tolist()) for _ in range(1500)]
    grades = rng.choice(3, 1500, p=[0.7, 0.2, 0.1])
    for w, g in zip(words, grades, strict=True):
        w |= set([[], [1], [1, 2]][g])
    model = toxicity.fit([np.array(sorted(w)) for w in words], grades)
    assert model.thresholds[0] < model.thresholds[1]
    scores = np.array([sum(model.weights.get(k, 0) for k in s) for s in ([], [1], [1, 2])])
    severity = model.grades(scores).sum(1)
    assert severity[0] < 0.3 < 0.7 < severity[1] < 1.3 < 1.7 < severity[2]


def test_one_grade_or_none_gives_no_weights():
    for grades in ([], [0, 0], [1, 2]):
        model = toxicity.fit([np.array([1, 2])] * len(grades), np.array(grades, int))
        assert model.weights == {}
        assert (model.grades(np.zeros(1))[0, 0] > 0.5) == (1 in grades)


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    half = labels.where("doc_id % 2 = 0")
    rows = toxicity.grade(docs, toxicity.learn(docs, half)).withColumnRenamed("toxic", "toxic_here").join(labels.where("doc_id % 2 = 1 AND toxic IS NOT NULL"), "doc_id").collect()
    flagged = np.array([r.toxic_here for r in rows])
    toxic = np.array([r.toxic == 1 for r in rows])
    assert flagged[toxic].mean() > 0.8 and flagged[~toxic].mean() < 0.03


def test_query_and_awkward_documents(spark, awkward, nothing):
    rows = queries.op9_toxicity(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r.severity <= 2 and r.toxic == (r.p_toxic >= toxicity.TOXIC) for r in rows)
    labels = spark.createDataFrame([(4, 1, None), (4, 0, 1), (None, 1, 0), (5, None, 1), (6, 0, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.learn(awkward, labels)
    assert toxicity.grade(awkward, model).count() == awkward.count()
    assert toxicity.grade(nothing, toxicity.learn(nothing, labels.limit(0))).count() == 0
