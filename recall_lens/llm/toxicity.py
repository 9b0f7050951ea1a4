"""Severity of toxic language by cumulative-link ordinal regression on sparse word features.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight for each feature, shared by all thresholds, which are kept in
order. x holds the distinct words of a text, lower-cased and without punctuation at their ends, and the stems they start
with, hashed to buckets; only buckets that go with the label on the
labelled sample beyond chance have a weight. The result is the expected grade.

Grades come from `labels`: 0 not toxic, 1 toxic in a text of good quality, 2 toxic in a text of bad quality.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from recall_lens.llm.staging import Carried, small_batches
from recall_lens.llm.text import batch, texts_of
from recall_lens.llm.worker import kept

#: Labelled rows that are learnt from at most, chosen by hash of doc_id.
LABELLED_ROWS = 8_000
BUCKETS = 1 << 20
GRADES = 3
#: Documents of the sample a word must be in, and how many standard errors its rate must differ from the mean.
MIN_DOCUMENTS = 4
#: Bytes of the stems.
STEMS = (4, 5, 6)
MIN_Z = 3.5
RIDGE = 1.0
STEPS = 300
#: P(grade > 0) from which a document counts as toxic.
TOXIC = 0.3

_EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_ARROW = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("p_toxic", pa.float64()), ("toxic", pa.bool_())])


def word_of(raw: bytes) -> bytes:
    return raw.strip(_EDGES)


def buckets(word: bytes) -> set[int]:
    """Buckets of a word and of its stems; none of an empty one."""
    parts = {word, *(b"^" + word[:n] for n in STEMS if len(word) >= n)} if word else ()
    return {xxh3_64_intdigest(p) % BUCKETS for p in parts}


def features(text: bytes) -> list[int]:
    """Buckets of the distinct words of a text, in order; a word of punctuation only is none."""
    return sorted(set().union(*map(buckets, set(map(word_of, set(text.lower().split()))))))


@dataclass(frozen=True)
class Ordinal:
    """Buckets with their weights, and the ordered thresholds."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) of each score, (texts, grades - 1)."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - np.asarray(scores, float)[:, None], -60, 60)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES) -> Ordinal:
    """Maximum likelihood with a ridge penalty, by full-batch Adam steps. No rows, or one grade only, give no weights."""
    n, toxic = len(rows), grades > 0
    if not n or not toxic.any() or toxic.all():
        return Ordinal({}, tuple(20.0 + k if not toxic.any() else -20.0 + k for k in range(n_grades - 1)))
    flat = np.concatenate(rows) if rows else np.empty(0, int)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    words, at, df = np.unique(flat, return_inverse=True, return_counts=True)
    base = toxic.mean()
    with_label = np.bincount(at, toxic[owner], len(words))
    z = (with_label - df * base) / np.sqrt(df * base * (1 - base))
    chosen = np.flatnonzero((df >= MIN_DOCUMENTS) & (np.abs(z) >= MIN_Z))
    place = np.full(len(words), -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[at] >= 0
    col, row = place[at][keep], owner[keep]
    # parameters: weights, first threshold, log gaps between thresholds
    x = np.zeros(len(chosen) + n_grades - 1)
    share = np.clip([(grades > k).mean() for k in range(n_grades - 1)], 1 / (n + 2), 1 - 1 / (n + 2))
    cuts = np.log((1 - share) / share)
    x[len(chosen)] = cuts[0]
    x[len(chosen) + 1 :] = np.log(np.maximum(np.diff(cuts), 0.05))
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        w, first, gaps = x[: len(chosen)], x[len(chosen)], np.exp(x[len(chosen) + 1 :])
        cuts = first + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(row, w[col], n)
        upper = 1 / (1 + np.exp(-np.clip(cuts - score[:, None], -30, 30)))  # P(grade <= k)
        full = np.concatenate([np.zeros((n, 1)), upper, np.ones((n, 1))], 1)
        own = np.maximum(full[np.arange(n), grades + 1] - full[np.arange(n), grades], 1e-12)
        slope = full * (1 - full)
        by_cut = np.zeros((n, n_grades + 1))
        by_cut[np.arange(n), grades + 1] += slope[np.arange(n), grades + 1] / own
        by_cut[np.arange(n), grades] -= slope[np.arange(n), grades] / own
        to_cut = by_cut[:, 1:-1].sum(0)
        grad = np.concatenate([-np.bincount(col, -by_cut.sum(1)[row], len(chosen)) + RIDGE * w, [-to_cut.sum()], -np.cumsum(to_cut[:0:-1])[::-1] * gaps]) / n
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        x -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    cuts = x[len(chosen)] + np.concatenate([[0], np.cumsum(np.exp(x[len(chosen) + 1 :]))])
    return Ordinal(dict(zip(words[chosen].tolist(), x[: len(chosen)].tolist(), strict=True)), tuple(cuts.tolist()))


def learn(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Ordinal:
    """A model from `docs` (doc_id, text) and `labels` (doc_id, toxic, quality).

    Labels without a doc_id or toxic are left out; a missing quality counts as good; of several labels of a document the
    gravest holds. About `rows` labels are taken, by hash of doc_id: at most that many reach the workers and the driver.
    """
    small_batches(docs.sparkSession)
    graded = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.when(F.col("toxic") < 1, 0).when(F.coalesce(F.col("quality"), F.lit(1)) < 1, 2).otherwise(1).alias("grade")
    )
    graded = graded.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    n = graded.count()
    if n > rows:
        graded = graded.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) < (rows << 30) // n)
    sample = graded.orderBy(F.xxhash64("doc_id", F.lit("toxic")), "doc_id").limit(rows)  # the share may be a few rows over
    joined = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array([features(t) for t in texts_of(b.column(1))], pa.list_(pa.int32()))], names=["grade", "words"])

    table = joined.mapInArrow(read, "grade int, words array<int>").toArrow()
    words = table["words"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    flat, ends = words.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
    return fit([flat[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)], table["grade"].to_numpy().astype(int))


class _Weights(dict):
    """Buckets with a weight of each raw word met; a worker remembers so many (about 30 MB)."""

    most = 200_000

    def __init__(self, weights: dict[int, float]) -> None:
        self.weights = weights

    def __missing__(self, raw: bytes) -> tuple[int, ...]:
        found = tuple(sorted(k for k in buckets(word_of(raw)) if k in self.weights))
        if len(self) < self.most:
            self[raw] = found
        return found


def grade(docs: DataFrame, model: Ordinal, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, severity (expected grade, 0 to the highest), p_toxic (P(grade > 0)), toxic (p_toxic of at
    least TOXIC, by words that speak for it) and the columns of `carry` of every row of `docs` (doc_id, text).

    Whole texts are read. Null and empty texts have no words, so they get the grade of a text without any known word.
    Repeated rows and rows without a doc_id are graded like others. A carried column that has the name of one of the first
    four comes back as `<name>_carried`.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = Carried(carry, _ARROW.names)
    names = [*_ARROW.names, *carried.inner()]

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        key = tuple(model.weights.items()), model.thresholds
        get = kept("toxicity", key, lambda: _Weights(model.weights)).__getitem__
        for b in batches:
            scores = []
            for text in texts_of(b.column(1)):
                found = set().union(*set(map(get, set(text.lower().split()))))
                scores.append(sum(model.weights[k] for k in sorted(found)))
            scores = np.array(scores, float)
            over = model.grades(scores)
            own = batch(_ARROW, [b.column(0), over.sum(1), over[:, 0], (over[:, 0] >= TOXIC) & (scores > 0)])
            yield pa.RecordBatch.from_arrays([*own.columns, *b.columns[1 if carried.text else 2 :]], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.col("text").alias("own_text"), *carried.held())
    taken = [T.StructField(n, f.dataType) for n, f in zip(carried.inner(), rows.schema.fields[1 if carried.text else 2 :], strict=True)]
    schema = T.StructType([*T.StructType.fromDDL("doc_id long, severity double, p_toxic double, toxic boolean"), *taken])
    return rows.mapInArrow(predict, schema).select(*_ARROW.names, *carried.back())
