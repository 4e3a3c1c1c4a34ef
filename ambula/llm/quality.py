"""Quality scores by pairwise ranking (Bradley-Terry).

Each text has a vector of features. Of two labelled texts the better one is preferred with probability
sigmoid(w . (x_better - x_worse)); w is learned from preference pairs by logistic loss on the feature differences. A
text's score is s = w . x; the score at a quantile of the labelled scores, the one that separates the labels best, is the
threshold, and the score that is returned is sigmoid((s - threshold) * slope), so at least 0.5 from the threshold on.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambula.llm.base import quoted

#: Labelled rows that the model is fitted on at most, those of least hash; and pairs drawn of them.
SAMPLE_ROWS = 20_000
PAIRS = 200_000
FEATURES = (
    "letters", "upper", "digits", "spaces", "commas_stops", "symbols", "pipes", "marks", "distinct_words", "top_word", "word_length",
    "long_words", "short_words", "distinct_lines", "distinct_pairs", "repeats_next", "capital_words", "symbol_words", "log_words", "per_sentence", "blank",
)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*%&$@^~<>{}[]\\=+_`"]] = True
_ODD = re.compile(rb"[#*%&$@^~<>{}\[\]\\=+_`!|?]{2,}|\|")


def features(text: str | None) -> list[float]:
    """The features of a whole text; shares are of bytes, words, pairs of words or lines. Null counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, n = len(data), len(words)
    seen, pairs = Counter(words), set(zip(words, words[1:]))
    lines = [x for x in data.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    stops = counts[ord(".")] + counts[ord("!")] + counts[ord("?")]
    return [
        counts[_LETTER].sum() / size,
        counts[65:91].sum() / size,
        counts[48:58].sum() / size,
        (counts[32] + counts[10]) / size,
        (counts[ord(",")] + counts[ord(".")]) / size,
        min(0.1, counts[_SYMBOL].sum() / size),
        min(0.1, counts[ord("|")] / size),
        min(0.1, (counts[ord("!")] + counts[ord("?")]) / size),
        len(seen) / n * np.log1p(n) / 6,
        max(seen.values()) / n * min(1.0, n / 20),
        min(20.0, size / n) / 10,
        (lengths > 12).mean(),
        (lengths < 3).mean(),
        len(set(lines)) / len(lines),
        (len(pairs) + 1) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(w[:1].isupper() for w in words) / n,
        min(0.3, len(_ODD.findall(data)) / n),
        np.log1p(n) / 6,
        min(60.0, n / (1 + stops)) / 30,
        0.0,
    ]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = ((x - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip((s - self.threshold) * self.slope, -700, 700)))


def fit_pairs(x: np.ndarray, label: np.ndarray, seed: int = 7, rounds: int = 300) -> Model:
    """Fit the model on feature rows and labels 0 and 1. With one label only, all scores are its value's side of 0.5."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Model(mean, scale, np.zeros(x.shape[1]), -1.0 if len(good) else 1.0, 1.0)
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, PAIRS)] - z[rng.choice(bad, PAIRS)]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):  # Newton steps with an L2 term
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = -(d * p[:, None]).mean(0) + 1e-3 * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    threshold = float(np.quantile(s, best_quantile(s, label)))
    return Model(mean, scale, w, threshold, 1.0)


def best_quantile(s: np.ndarray, label: np.ndarray) -> float:
    """The quantile of the scores whose cut has the largest sum of label 0's share under it and label 1's share from it on."""
    order = np.argsort(s, kind="stable")
    below = np.concatenate(([0], np.cumsum(label[order] == 0))) / max(1, (label == 0).sum())
    above = 1 - np.concatenate(([0], np.cumsum(label[order] == 1))) / max(1, (label == 1).sum())
    under = int(np.argmax(below + above))  # rows under the cut
    return min(1.0, max(0.0, (under - 0.5) / max(1, len(s) - 1)))


def learn(docs: DataFrame, labels: DataFrame, held_out: bool = True, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most sample_rows labelled rows; with held_out, only on such as have crc32(doc_id) mod 3 other than 1.

    Null labels are left out, and so are doc_ids with both labels; of several texts of a doc_id that of the least features
    counts.
    """
    usable = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").select("doc_id", "quality")
    if held_out:
        usable = usable.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # the bound proves the broadcast's size
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text")
    x = rows.mapInArrow(_featured, "doc_id long, x array<double>").groupBy("doc_id").agg(F.min("x").alias("x"))
    fitted = x.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").toPandas()
    if not len(fitted):
        n = len(FEATURES)
        return Model(np.zeros(n), np.ones(n), np.zeros(n), 0.0, 1.0)
    return fit_pairs(np.array(fitted.x.tolist(), np.float64), fitted.quality.to_numpy())


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """A row of docs each as (row, score): all its columns, and 0 to 1; null and empty texts have the score of the empty text."""

    def run(batches):
        for batch in batches:
            x = np.array([features(t) for t in batch.column(1).to_pylist()]).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x), pa.float64())], ["row", "score"])

    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), "text")
    return rows.mapInArrow(run, T.StructType([rows.schema.fields[0], T.StructField("score", T.DoubleType())]))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs(doc_id, text), learned as learn() says.

    A null doc_id is never learned from and has a null held_out. Without labels all scores are 0.5. Rows are scored one by
    one, so equal texts have equal scores; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    scored = score_documents(docs, learn(docs, labels))
    return scored.select(
        "row.doc_id",
        (F.crc32(F.col("row.doc_id").cast("string")) % 3 == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs less the rows that score under 0.5; all columns stay, whatever their names."""
    return score_documents(docs, learn(docs, labels)).where("score >= 0.5").select("row.*")
