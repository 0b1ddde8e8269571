"""Language identification as inference of a mixture.

Training counts character trigrams (lower-cased, runs of other characters than letters as one blank, hashed to
2**16 numbers) for each language, over whole texts of a bounded sample of labelled documents: those of the smallest
hashes of doc_id, about ``sample`` for each language. A document is then a mixture: expectation-maximisation estimates
the proportions of languages that make its trigrams likeliest. Languages enter in order of their share in the full
mixture, as long as the likelihood gains more than ``penalty`` * log(number of trigrams) for each further language.
The prediction is the language with the largest proportion in the set chosen (of equal ones the first by name), the
score that proportion.

A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing was learned. Rows with a
null language are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import only, tidy
from millrace.llm.shingles import mix, slices

BITS = 16
UNDETERMINED = "und"
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of letters and blanks; empty if there is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of the characters after a letter
    points = np.where(letter, points, 32)[keep]
    points = np.concatenate([[32], points, [32, 32]]).astype(np.uint64)
    return (mix(points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    #: likelihood of each trigram number by language
    likelihood: np.ndarray

    def mixture(self, text: str | None, penalty: float = 4.0, rounds: int = 12) -> dict[str, float]:
        """Proportions of the languages chosen; empty if undetermined."""
        found = trigrams(text or "")
        if not len(found) or not self.languages:
            return {}
        if len(found) < 1 << BITS:
            numbers, counts = np.unique(found, return_counts=True)
        else:
            counts = np.bincount(found, minlength=1 << BITS)
            numbers = np.flatnonzero(counts)
            counts = counts[numbers]
        like = self.likelihood[:, numbers]
        total = float(len(found))
        counts = counts.astype(np.float64)

        def fitted(rows: np.ndarray) -> tuple[float, np.ndarray]:
            own = like[rows]
            share = np.full(len(rows), 1 / len(rows))
            if len(rows) > 1:
                for _ in range(rounds):
                    share *= own @ (counts / (share @ own)) / total
            return float(counts @ np.log(share @ own)), share

        _, shares = fitted(np.arange(len(like)))
        order = np.argsort(-shares, kind="stable")
        best, share = fitted(order[:1])
        size = 1
        while size < len(order):
            value, more = fitted(order[: size + 1])
            if value - best <= penalty * np.log(total + 1):
                break
            best, share, size = value, more, size + 1
        return {self.languages[k]: float(v) for k, v in zip(order[:size], share)}

    def predict(self, text: str | None) -> tuple[str, float]:
        mixture = self.mixture(text)
        if not mixture:
            return UNDETERMINED, 0.0
        language = min(mixture, key=lambda x: (-mixture[x], x))
        return language, min(1.0, max(0.0, mixture[language]))


def train(labelled: DataFrame, sample: int = 1_000, smoothing: float = 0.5) -> Model:
    """A model of labelled (doc_id, text, lang), from about so many whole documents of each language."""
    rows = only(labelled, "doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.empty((0, 1 << BITS)))
    # the hash threshold of each language keeps about `sample` rows of it, wherever they lie
    shares = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))])
    spread = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter(spread < F.element_at(shares, F.col("lang"))).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = held.setdefault(lang, np.zeros(1 << BITS, np.int64))
                own += np.bincount(trigrams(text), minlength=1 << BITS)
        for lang, counts in held.items():
            numbers = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(numbers), pa.string()), "number": pa.array(numbers, pa.int32()), "n": pa.array(counts[numbers], pa.int64())})

    counted = chosen.mapInArrow(tidy(count), "lang string, number int, n long").groupBy("lang", "number").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(sizes)
    where = {lang: k for k, lang in enumerate(languages)}
    counts = np.zeros((len(languages), 1 << BITS))
    if counted.num_rows:
        counts[[where[x] for x in counted.column("lang").to_pylist()], counted.column("number").to_numpy()] = counted.column("n").to_numpy()
    counts += smoothing
    return Model(languages, counts / counts.sum(axis=1, keepdims=True))


def identify(df: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """df with the predicted language of its text and the score, in one pass without a shuffle."""
    from millrace.llm.bpe import put, with_field

    shared = df.sparkSession.sparkContext.broadcast(model)  # languages * 512 KB
    schema = with_field(with_field(df.schema, pred, T.StringType()), score, T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, text):
                found = [own.predict(t) for t in part.column(text).to_pylist()]
                yield put(put(part, pred, pa.array([x for x, _ in found], pa.string())), score, pa.array([y for _, y in found], pa.float64()))

    return df.mapInArrow(tidy(run), schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predictions(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document; rows held out are not learned from."""
    docs = only(documents, "doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.filter(~F.col("held_out")))
    return identify(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")
