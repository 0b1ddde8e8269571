"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are character n-grams of 3 to 5 characters (A-Z lower-cased, hashed to 2**20 numbers). A text is cut into
blocks of ``BLOCK`` characters, an n-gram counts once for each block it starts in, and two blocks in a row are a window;
windows cover the whole text, and a text of one block is one window. Each feature
is scaled by the log of its smoothed share among toxic over that among clean windows, and a logistic regression is fitted
to the scaled features. A text's evidence is that of its worst window, so a long text is judged by the same measure as a
short one, over all of its characters; a line fitted on documents kept out of the regression turns evidence into a
probability.

Training takes a bounded sample: about ``sample`` labelled documents, half of each class where there are so many, those
of the smallest hashes of doc_id, with all windows of each. Labels other than 0 and 1
are left out; a repeated label counts once for each row. Empty and null texts have no features and get the score of no
evidence. With labels of one class only, or none, every score is the smoothed share of toxic labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import ASCII_LOWER, only, tidy
from millrace.llm.shingles import mix, slices

BITS = 20
SIZES = (3, 4, 5)
BLOCK = 300


def blocks(text: str) -> list[np.ndarray]:
    """For each n and block in turn, the distinct feature numbers of the n-grams that start there."""
    points = np.frombuffer(text.translate(ASCII_LOWER).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = []
    for n in SIZES:
        size = max(0, len(points) - n + 1)
        rolled = np.full(size, np.uint64(n))
        for k in range(n):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + points[k : size + k]
        numbers = (mix(rolled) >> np.uint64(64 - BITS)).astype(np.int32)
        out += [np.unique(numbers[at : at + BLOCK]) for at in range(0, max(1, len(points)), BLOCK)]
    return out


def windows(text: str, most: int | None = None) -> list[str]:
    """All windows, or at most so many, evenly spaced."""
    count = max(1, -(-len(text) // BLOCK) - 1)
    pick = range(count) if most is None or count <= most else np.unique(np.linspace(0, count - 1, most).astype(int))
    return [text[k * BLOCK : (k + 2) * BLOCK] for k in pick]


@dataclass
class Model:
    #: evidence of each feature number
    weights: np.ndarray
    slope: float
    intercept: float

    def evidence(self, text: str) -> float:
        """That of the worst window."""
        found = blocks(text)
        ends = np.cumsum([0, *map(len, found)])
        sums = np.concatenate([[0.0], np.cumsum(self.weights[np.concatenate(found)], dtype=np.float64)])
        own = (sums[ends[1:]] - sums[ends[:-1]]).reshape(len(SIZES), -1).sum(axis=0)
        return float((own[1:] + own[:-1]).max() if len(own) > 1 else own[0])

    def score(self, text: str | None) -> float:
        z = self.intercept + self.slope * self.evidence(text or "")
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def line(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic regression on one feature, by Newton's method with a little ridge."""
    scale = max(float(np.std(evidence)), 1e-9)
    x = np.stack([evidence / scale, np.ones_like(evidence)], axis=1)
    beta = np.array([1.0, 0.0])
    ridge = np.diag([1e-3, 1e-4]) * weight.sum() / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (weight * (toxic - p)) - ridge @ beta)
        beta = beta + np.clip(step, -2, 2)
    return float(max(beta[0], 1e-6) / scale), float(beta[1])


def fit(documents: list[tuple[list[str], int]], prior: float, rounds: int = 20, ridge: float = 2e-3, rate: float = 0.03, batch: int = 256) -> Model:
    """A model of documents given as windows with a label; prior: the share of toxic ones among all."""
    labels = np.array([t for _, t in documents])
    constant = Model(np.zeros(1 << BITS, np.float32), 1e-9, float(np.log(prior / (1 - prior))))
    if len(set(labels.tolist())) < 2 or min(np.bincount(labels)) < 2:
        return constant
    kept = np.zeros(len(documents), bool)  # for the line: every fourth of each class
    for t in (0, 1):
        kept[np.flatnonzero(labels == t)[3::4]] = True
    texts = [(w, t, 1 / len(ws)) for (ws, t), out in zip(documents, kept) if not out for w in ws]
    features = [np.concatenate(blocks(w)) for w, _, _ in texts]
    if not sum(map(len, features)):
        return constant
    y = np.array([t for _, t, _ in texts], np.float64)
    weight = np.array([v for _, _, v in texts])
    for t in (0, 1):
        weight[y == t] *= 0.5 / weight[y == t].sum()
    # naive Bayes: windows of a class that have the feature; what one window alone has says nothing
    of_clean, of_toxic = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)
    for of, t in ((of_clean, 0), (of_toxic, 1)):
        own = np.flatnonzero(y == t)
        for at in range(0, len(own), 1_000):
            of += np.bincount(np.concatenate([features[i] for i in own[at : at + 1_000]]), minlength=1 << BITS).astype(np.float32)
    ratio = np.log((of_toxic + 1) / (of_toxic.sum() + (1 << BITS))) - np.log((of_clean + 1) / (of_clean.sum() + (1 << BITS)))
    ratio = ratio.astype(np.float32)
    ratio[of_toxic + of_clean < 3] = 0
    used = np.flatnonzero(ratio)
    place = np.zeros(1 << BITS, np.int32)
    place[used] = np.arange(len(used))
    for i, f in enumerate(features):  # one at a time, so that memory holds them once
        features[i] = place[f[ratio[f] != 0]]
    ends = np.cumsum([0, *map(len, features)])
    flat, r = np.concatenate(features), ratio[used]
    del features
    # Adam over small batches; the second half of the passes is averaged
    beta, mean = np.full(len(used), 0.05, np.float32), np.zeros(len(used), np.float32)
    first, second = np.zeros(len(used), np.float32), np.zeros(len(used), np.float32)
    base, step, shuffled = 0.0, 0, np.random.default_rng(0)
    weight /= weight.mean()
    for k in range(rounds):
        order = shuffled.permutation(len(texts))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            own = np.concatenate([flat[ends[i] : ends[i + 1]] for i in rows])
            sizes = ends[rows + 1] - ends[rows]
            z = np.bincount(np.repeat(np.arange(len(rows)), sizes), (r * beta)[own], minlength=len(rows)) + base
            error = weight[rows] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            slope = (np.bincount(own, np.repeat(error, sizes), minlength=len(used)) * r).astype(np.float32) + np.float32(ridge) * beta
            step += 1
            first += np.float32(0.1) * (slope - first)
            second += np.float32(0.01) * (slope * slope - second)
            beta -= np.float32(rate / (1 - 0.9**step)) * first / (np.sqrt(second / np.float32(1 - 0.99**step)) + np.float32(1e-7))
            base -= 0.3 * float(error.sum())
        if k >= rounds // 2:
            mean += beta / np.float32(rounds - rounds // 2)
    beta = np.zeros(1 << BITS, np.float32)
    beta[used] = mean
    model = Model((beta * ratio).astype(np.float32), 1.0, 0.0)
    rest = [(max(model.evidence(w) for w in ws), t) for (ws, t), out in zip(documents, kept) if out]
    evidence, t = np.array([e for e, _ in rest]), np.array([t for _, t in rest], np.float64)
    each = np.where(t == 1, prior / max(t.sum(), 1), (1 - prior) / max((1 - t).sum(), 1)) * len(t)
    model.slope, model.intercept = line(evidence, t, each)
    return model


def train(documents: DataFrame, labels: DataFrame, sample: int = 2_000) -> Model:
    """A model of documents (doc_id, text) by labels (doc_id, toxic)."""
    marked = only(labels, "doc_id", "toxic").filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    if len(sizes) < 2:
        return fit([], prior)
    spread = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, sample / 2 / sizes[1])).otherwise(min(1.0, sample / 2 / sizes[0]))
    chosen = marked.filter(spread < share)  # about `sample` rows, whatever the input
    picked = only(documents, "doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")

    rows = picked.select("doc_id", F.col("toxic").cast("int"), "text").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["text"]))
    return fit([(windows(r["text"]), r["toxic"]) for r in rows], prior)


def scored(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """df with the toxicity of its text, in one pass without a shuffle."""
    from millrace.llm.bpe import put, with_field

    shared = df.sparkSession.sparkContext.broadcast(model)  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, text):
                yield put(part, name, pa.array([own.score(t) for t in part.column(text).to_pylist()], pa.float64()))

    return df.mapInArrow(tidy(run), with_field(df.schema, name, T.DoubleType()))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predictions(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each document; labels of rows held out are not learned from."""
    model = train(documents, only(labels, "doc_id", "toxic").filter(~held_out(F.col("doc_id"))))
    docs = only(documents, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return scored(docs, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
