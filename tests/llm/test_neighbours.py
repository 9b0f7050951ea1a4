"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from recall_lens.llm import neighbours, queries

FOLDER = "/root/testdata/sf0.1"


def results(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


def test_hilbert_keys_visit_neighbouring_cells():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = neighbours.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_recall_of_the_query(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    got = results(queries.op10_neighbours(spark, FOLDER).collect())
    true = neighbours.exact(vectors, [r.vec_id for r in vectors.where("vec_id % 100 = 0").collect()])
    assert set(got) == set(true) and all(len(x) == 10 for x in got.values())
    hits = [len({i for _, i in got[q]} & {i for _, i in true[q]}) / 10 for q in true]
    assert np.mean(hits) >= 0.9
    small = neighbours.search(vectors, F.col("vec_id") % 100 == 0, block=64).collect()
    assert np.mean([len({i for _, i in results(small)[q]} & {i for _, i in true[q]}) / 10 for q in true]) >= 0.9


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(i, [1.0, float(i % 3)]) for i in range(40)] + [(100, None), (200, [0.0, 0.0]), (300, [1.0, None]), (400, [float("nan"), 1.0]), (500, [float("inf"), 1.0]), (600, [1.0]), (None, [1.0, 1.0]), (700, []), (3, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("point", F.lit(2))
    got = results(neighbours.search(vectors, F.col("vec_id") % 20 == 0).collect())
    sound = [(i, np.array(v)) for i, v in rows[:40]]
    for q, v in sound[::20]:
        assert got[q] == sorted((float(np.linalg.norm(w - v)), i) for i, w in sound if i != q)[:10]
    assert set(got) == {0, 20}


def test_few_or_no_vectors(spark):
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 5.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in neighbours.search(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 3.0)]
    assert neighbours.search(two.limit(0), F.col("vec_id") == 0).count() == 0
    assert neighbours.search(two, F.col("vec_id") == 9).count() == 0
    assert neighbours.search(two.limit(1), F.col("vec_id") == 0).count() == 0


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=2 + i % 2).tolist()) for i in range(60)] + [(61, [1.0] * 5)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = results(neighbours.search(vectors, F.col("vec_id") % 10 < 2).collect())
    asked = [i for i, v in rows if i % 10 < 2]
    assert got == {q: n for q, n in neighbours.exact(vectors, asked).items() if n}
    assert 61 not in got and len(got) == 12
