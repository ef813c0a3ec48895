"""Quality classifier: ordinal cumulative-link regression on hashed text.

A rating is an ordered grade 0..K-1. One weight vector over hashed text features
gives a text its score s, shared by all grades, and ordered thresholds
t_1 < ... < t_{K-1} give P(grade >= k) = sigmoid(s - t_k). The expected grade is
the sum of these tail probabilities; a tail probability selects texts.

Features of a whole text are presences: each distinct lower-cased word, and a
log-scaled share of each word shape (the classes of a word's characters) and of
words that repeat the word before them. All are hashed to one weight vector.
Training is proximal AdaGrad in numpy on a bounded sample of rated texts.

Defined cases: a null or empty text has no features and gets the score 0 of the
bare thresholds; without rated texts every weight is 0; a text rated twice uses
its lowest grade; unrated rows are scored like all others; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import U, chunked, hash_sample, mix, small, span_hashes, staged, string_buffers, words_of

BITS = 18
SAMPLE_ROWS = 8_000        # bound on rated texts used for training
MIN_TEXTS = 8              # features of fewer sampled texts keep the weight 0
SHAPES = 1 << 20           # salts that keep the kinds of features apart
_SHAPE = np.full(256, ord("."), np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:], _SHAPE[48:58] = ord("A"), ord("a"), ord("a"), ord("0")
for _c in b"!?#*$%&|<>@/\\_=~":
    _SHAPE[_c] = _c


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a batch of texts: (row ends, feature, value)."""
    words, starts, ends, n = words_of(data, off, lower=True)
    shape = _SHAPE[data]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    forms = span_hashes(shape[keep], place[starts], place[ends]) if len(starts) else words
    cut = np.concatenate([[0], np.cumsum(n)]).tolist()
    ends_out, feats, values = [0], [], []
    shift = U(64 - BITS)
    for a, b in zip(cut, cut[1:]):
        if a < b:
            w = np.unique(words[a:b])
            f, c = np.unique(forms[a:b], return_counts=True)
            same = int((words[a + 1:b] == words[a:b - 1]).sum())
            feats += [w, mix(f ^ U(SHAPES)), np.array([12345], U) << U(40)]
            values += [np.full(len(w), 1.0 / np.sqrt(len(w))), 3.0 * c / (b - a), np.array([3.0 * same / (b - a)])]
            ends_out.append(ends_out[-1] + len(w) + len(f) + 1)
        else:
            ends_out.append(ends_out[-1])
    ids = np.concatenate(feats) >> shift if feats else np.zeros(0, U)
    return np.array(ends_out), ids.astype(np.int64), np.concatenate(values) if values else np.zeros(0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class CumulativeLink:
    weights: np.ndarray       # shared by all grades
    thresholds: np.ndarray    # ascending, one fewer than there are grades

    def scores(self, ends: np.ndarray, feats: np.ndarray, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.weights[feats] * values)])
        return np.diff(total[ends])

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. as columns."""
        return _sigmoid(scores[:, None] - self.thresholds)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, rounds: int = 150,
            rate: float = 2.0, penalty: float = 1.0) -> "CumulativeLink":
        """Proximal AdaGrad on the likelihood P(g) = P(>= g) - P(>= g + 1).

        The L1 penalty of a feature is ``penalty`` times the size that its gradient
        has by chance alone, so words without bearing on the grades keep the weight 0.
        """
        n, k = len(rows), len(self.thresholds)
        feats, values = (np.concatenate(x) for x in zip(*rows))
        texts = np.bincount(feats, minlength=len(self.weights))
        row = np.repeat(np.arange(n), [len(f) for f, _ in rows])
        use = texts[feats] >= min(MIN_TEXTS, max(1, n // 20))
        feats, values, row = feats[use], values[use], row[use]
        chance = penalty * np.sqrt(np.bincount(feats, values ** 2, len(self.weights))) / n
        # rare grades weigh as much as common ones, within a factor of 4
        share = np.bincount(grades, minlength=k + 1) / n
        weight = np.clip(1 / ((k + 1) * np.maximum(share, 1e-9)), 0.25, 4)[grades]
        seen, seen_t = np.full(len(self.weights), 1e-10), np.full(k, 1e-10)
        at_least, at_most = grades > 0, grades < k
        lo, hi = np.maximum(grades - 1, 0), np.minimum(grades, k - 1)
        for _ in range(rounds):
            s = np.bincount(row, self.weights[feats] * values, n)
            upper = np.where(at_least, _sigmoid(s - self.thresholds[lo]), 1.0)
            lower = np.where(at_most, _sigmoid(s - self.thresholds[hi]), 0.0)
            p = np.maximum(upper - lower, 1e-9)
            du = np.where(at_least, upper * (1 - upper) / p, 0.0) * weight / n
            dl = np.where(at_most, lower * (1 - lower) / p, 0.0) * weight / n
            g = np.bincount(feats, (dl - du)[row] * values, len(self.weights))
            seen += g * g
            step = rate / np.sqrt(seen)
            w = self.weights - step * g
            self.weights = np.sign(w) * np.maximum(np.abs(w) - step * chance, 0)
            gt = np.bincount(lo, du, k)[:k] - np.bincount(hi, dl, k)[:k]
            seen_t += gt * gt
            t = self.thresholds - 0.3 * rate * gt / np.sqrt(seen_t)
            self.thresholds = np.maximum.accumulate(t + 1e-6 * np.arange(k))
        return self


def rated(docs: DataFrame, labels: DataFrame, grade: Column, id_col: str = "doc_id", bound: int | None = None
          ) -> DataFrame:
    """(doc_id, text, grade) of the rated rows of ``docs``; ``labels`` holds the id and what ``grade`` reads.

    With ``bound``, about 1.3 times as many rated ids are chosen first, by their
    hash, from the thin labels alone; texts are then read for these ids only.
    """
    grades = labels.select(F.col(id_col).alias("doc_id"), grade.cast("int").alias("grade")).where(
        "grade is not null and doc_id is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    if bound is not None:
        grades = small(staged(hash_sample(staged(grades, "grades"), F.col("doc_id"), bound).drop("h"), "rated"))
    return docs.select(F.col(id_col).alias("doc_id"), F.col("text").alias("text")).join(grades, "doc_id")


def train(rows: DataFrame, grades: int, bound: int = SAMPLE_ROWS) -> CumulativeLink:
    """Fit on at most ``bound`` rows of (doc_id, text, grade), chosen by a hash of the id; features are made in the tasks."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, 1 << 20):
            ends, f, v = features(*string_buffers(b.column(0)))
            cut = list(zip(ends.tolist(), ends[1:].tolist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array([f[i:j].astype("<i4").tobytes() for i, j in cut], pa.binary()),
                 pa.array([v[i:j].astype("<f4").tobytes() for i, j in cut], pa.binary())], names=["grade", "h", "f", "v"])

    chosen = hash_sample(rows.select("doc_id", "text", "grade"), F.col("doc_id"), bound).select("text", "grade", "h")
    got = chosen.mapInArrow(extract, "grade int, h bigint, f binary, v binary").collect()
    got = sorted(got, key=lambda r: (r["h"], r["grade"], r["f"]))[:bound]
    model = CumulativeLink(np.zeros(1 << BITS), np.linspace(-1.0, 0.0, grades - 1) if grades > 1 else np.zeros(0))
    if not got:
        return model
    data = [(np.frombuffer(r["f"], "<i4").astype(np.int64), np.frombuffer(r["v"], "<f4").astype(np.float64)) for r in got]
    return model.fit(data, np.array([r["grade"] for r in got]))


def score(docs: DataFrame, model: CumulativeLink, tail: int, keep_at: float, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, expected_grade, tail_prob = P(grade >= tail), kept = tail_prob >= keep_at."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = rows.sparkSession.sparkContext.broadcast(
        (model.weights.astype(np.float32), model.thresholds))                 # 2^18 weights: 1 MB

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = CumulativeLink(shared.value[0].astype(np.float64), shared.value[1])
        for b in chunked(batches, 1 << 20):
            tails = own.tails(own.scores(*features(*string_buffers(b.column(1)))))
            p = tails[:, tail - 1]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tails.sum(1)), pa.array(p), pa.array(p >= keep_at)],
                                             names=["doc_id", "expected_grade", "tail_prob", "kept"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(apply, f"doc_id {id_type}, expected_grade double, tail_prob double, kept boolean")


#: Grades of the labels table: toxic texts below poor ones, poor ones below good ones.
GRADES = 3


def label_grade() -> Column:
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
