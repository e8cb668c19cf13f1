"""Text quality as an ordinal regression on graded ratings.

Grades are ordered: 0 toxic, 1 poor, 2 good. One linear score of hashed text features is
shared by all grades; ordered thresholds cut it, so that the chance of a grade of at least
k is ``logistic(score - threshold k)``. Selection uses such a tail probability, and the
expected grade ranks documents.

Features are the distinct words of a text (lower case, hashed into buckets) and the
shapes of its tokens: upper and lower case letters, digits and signs, runs written once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import ship, slim, small_batches, text_hash
from sediment.llm.language import held_out
from sediment.llm.license_vote import groups_of, word_hashes

GRADES = 3
BUCKETS = 1 << 22
#: Labelled documents that the weights are fitted on, picked by a hash of their ids.
SAMPLE = 8192
IDF_POWER = 2
STEPS, RATE, DECAY = 200, 0.1, 1e-3
#: Documents of the sample that a feature must be in; one seen less often only tells documents apart.
LEAST_SEEN = 5
#: A document is selected at this chance of a grade of at least 2.
LEAST = 0.5

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x41:0x5B] = ord("A")
_CLASS[0x61:0x7B] = ord("a")
_CLASS[0x80:] = ord("a")
_CLASS[0x30:0x3A] = ord("0")
_CLASS[0x09:0x0E] = 0x20
#: How a sign looks to the word hash, which knows only letters and digits.
_PRINT = np.arange(256, dtype=np.uint8)
_PRINT[0x21:0x30] = np.arange(0xA1, 0xB0)
_PRINT[0x3A:0x41] = np.arange(0xBA, 0xC1)
_PRINT[0x5B:0x61] = np.arange(0xDB, 0xE1)
_PRINT[0x7B:0x80] = np.arange(0xF0, 0xF5)
_PRINT[ord("A")] = ord("z")


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: 1 for each distinct word, and each shape's root share of the tokens."""
    if not text:
        return np.empty(0, dtype=np.int64), np.empty(0)
    words = np.unique(groups_of(word_hashes(text), 1) % np.uint64(BUCKETS // 2)).astype(np.int64)
    kinds = _CLASS[np.frombuffer(text, dtype=np.uint8)]
    kinds = kinds[np.concatenate(([True], kinds[1:] != kinds[:-1]))]
    shapes = word_hashes(_PRINT[kinds].tobytes()) % np.uint64(BUCKETS // 2)
    shape, n = np.unique(shapes, return_counts=True)
    shares = np.sqrt(n / max(1, len(shapes))) * 4
    return np.concatenate((words, shape.astype(np.int64) + BUCKETS // 2)), np.concatenate((np.full(len(words), 1.0), shares))


@dataclass
class Model:
    """Weights per bucket and rising thresholds; ``thresholds[k]`` lies below grade k + 1."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: list[bytes | None]) -> np.ndarray:
        """Chance of a grade of at least 1, 2, ..., per text."""
        scores = np.array([float(self.weights[b] @ v) for b, v in map(features, texts)])
        return logistic(scores[:, None] - self.thresholds[None, :])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum likelihood with a small penalty, by full-batch steps of adaptive size.

    Rare grades weigh as much as frequent ones, by the root of their shares. The gaps between thresholds are exponentials, so they stay in order.
    """
    if not len(rows):
        return Model(np.zeros(BUCKETS, dtype=np.float32), np.arange(GRADES - 1, dtype=float) - 1)
    bucket = np.concatenate([b for b, _ in rows])
    value = np.concatenate([v for _, v in rows])
    owner = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows])
    used, bucket, seen = np.unique(bucket, return_inverse=True, return_counts=True)
    often = seen[bucket] >= LEAST_SEEN
    bucket, value, owner = bucket[often], value[often], owner[often]
    # Words of few documents tell more than those of most; the weights take the scale on.
    scale = (np.log(len(rows) / seen.clip(1, len(rows))) / np.log(len(rows) + 1)) ** IDF_POWER
    value = value * np.where(used < BUCKETS // 2, scale, 1.0)[bucket]
    weights = np.zeros(len(used))
    share = np.array([(grades <= k).mean() for k in range(GRADES - 1)]).clip(0.01, 0.99)
    start = np.maximum.accumulate(np.log(share / (1 - share)))
    shape = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 0.1))))
    moments = [np.zeros(len(used)), np.zeros(len(used)), np.zeros(GRADES - 1), np.zeros(GRADES - 1)]

    weight = 1 / np.sqrt(np.bincount(grades, minlength=GRADES)[grades])
    weight /= weight.sum()

    def cuts() -> np.ndarray:
        return np.concatenate((shape[:1], shape[0] + np.cumsum(np.exp(shape[1:]))))

    for step in range(1, steps + 1):
        score = np.bincount(owner, weights[bucket] * value, len(rows))
        at = cuts()
        # P(grade <= k) for k = -1 .. top; a grade's chance is a difference of neighbours.
        low = np.column_stack((np.zeros(len(rows)), logistic(at[None, :] - score[:, None]), np.ones(len(rows))))
        slope = low * (1 - low)
        row = np.arange(len(rows))
        chance = np.maximum(low[row, grades + 1] - low[row, grades], 1e-12)
        by_cut = np.zeros_like(low)  # gradient of the mean loss by each cut
        by_cut[row, grades + 1] -= slope[row, grades + 1] / chance
        by_cut[row, grades] += slope[row, grades] / chance
        by_cut *= weight[:, None]
        by_score = -by_cut.sum(axis=1)
        gradient = np.bincount(bucket, by_score[owner] * value, len(used)) + DECAY * weights
        own = by_cut[:, 1:-1].sum(axis=0)
        by_shape = np.concatenate(([own.sum()], [own[k:].sum() * np.exp(shape[k]) for k in range(1, GRADES - 1)]))
        for k, g in ((0, gradient), (2, by_shape)):
            moments[k] = 0.9 * moments[k] + 0.1 * g
            moments[k + 1] = 0.99 * moments[k + 1] + 0.01 * g * g
            move = RATE * (moments[k] / (1 - 0.9**step)) / (np.sqrt(moments[k + 1] / (1 - 0.99**step)) + 1e-10)
            if k == 0:
                weights = weights - move
            else:
                shape = shape - move
    every = np.zeros(BUCKETS, dtype=np.float32)
    every[used] = weights * np.where(used < BUCKETS // 2, scale, 1.0)
    return Model(every, cuts())


def learn(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE
) -> Model:
    """A model from at most ``sample`` labelled documents that are not held out.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; of several labels of a document the
    worst grade counts, and a label without grade (null quality, and not toxic) not at all.
    """
    ship(docs.sparkSession)
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    graded = labels.select(F.col("doc_id").alias("_id"), grade.alias("grade")).where("_id is not null and grade is not null")
    graded = graded.groupBy("_id").agg(F.min("grade").alias("grade")).where(~held_out(F.col("_id")))
    # At most ``sample`` small rows, so they can go to every task.
    picked = graded.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = slim(docs, doc=id_column, _text=text_column).where("_text is not null")
    rows = rows.join(F.broadcast(picked), F.col("doc") == F.col("_id")).select(F.col("_text").cast("binary"), "grade", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in small_batches(batches, 0):
            found = [features(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))],
                names=["grade", "doc", "buckets", "values"],
            )

    kind = rows.schema["doc"].dataType.simpleString()
    got = rows.mapInArrow(run, f"grade int, doc {kind}, buckets array<int>, `values` array<float>")
    # A repeated id brings one row: the one of smallest features.
    table = got.groupBy("doc").agg(F.min(F.struct("buckets", "values")).alias("x"), F.min("grade").alias("grade"))
    table = table.select("doc", "x.buckets", "x.values", "grade").toArrow().sort_by("doc")
    grades = table.column("grade").to_numpy()
    lists = [table.column(c).combine_chunks() for c in ("buckets", "values")]
    parts = [(lists[0][i].values.to_numpy(), lists[1][i].values.to_numpy().astype(float)) for i in range(len(grades))]
    return fit(parts, grades)


def grade(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``expected_grade``, ``p_clean``, ``p_good`` and ``selected``.

    The chances are of a grade of at least 1 and 2. Null and empty texts have no features
    and get what the thresholds alone say. Repeated rows stay; no rows give no rows.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = slim(docs, _id=id_column, _text=text_column)
    rows = rows.select("_id", text_hash(F.col("_text")).alias("_hash"), F.col("_text").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in small_batches(batches, 2):
            tails = shared.value.tails(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]), pa.array(tails[:, 1])],
                names=["_id", "_hash", "expected_grade", "p_clean", "p_good"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"_id {kind}, _hash long, expected_grade double, p_clean double, p_good double")
    return found.withColumn("selected", F.col("p_good") >= LEAST)
