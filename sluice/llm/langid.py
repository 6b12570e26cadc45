"""Language identification by sparse multinomial logistic regression.

Features are character n-grams (1 to 4) of the letters of a text, hashed into a
fixed number of buckets and weighted by TF-IDF. Weights are trained by
follow-the-regularised-leader with elastic-net penalties, so most of them are
exactly zero, and a temperature fitted on rows kept out of training turns scores
into calibrated probabilities.

Document frequencies are counted over all labelled training rows. The classifier
itself is fitted on a bounded sample of them, streamed through one task.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import in_slices, on_plain_names, valid_text, written

UNKNOWN = "und"
BUCKET_BITS = 15
GRAMS = 4
#: Rows in the fitting sample, shared evenly by the languages; at least one each.
SAMPLE_ROWS = 8000
#: Labels that a model may have; it holds a weight for each bucket and label.
MOST_LANGS = 2000
EPOCHS = 3
#: One row in so many of the sample is kept for calibration.
CALIBRATION = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.0005
#: Characters hashed at a time, so that a text of any length takes bounded memory.
BLOCK = 1 << 19
NOT_LETTERS = re.compile(r"[\W\d_]+")


def in_training(key: str = "doc_id") -> Column:
    """False for the held-out third of the documents: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 != 1


def letters(text: str) -> str:
    """The lower-cased words of a text, a space between them; empty without a letter."""
    words = NOT_LETTERS.sub(" ", text)
    return f" {words.strip().lower()} " if any(map(str.isalpha, words)) else ""


def gram_counts(words: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the character n-grams of ``letters(text)``."""
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for start in range(0, len(words), BLOCK):
        block = np.frombuffer(words[start : start + BLOCK + GRAMS - 1].encode("utf-32-le"), "<u4")
        own = min(BLOCK, len(words) - start)  # n-grams that begin in this block
        grams = np.zeros(len(block), np.uint32)
        for n in range(GRAMS):
            grams = (grams[: len(block) - n] if n == 0 else grams[:-1]) * np.uint32(0x01000193) + block[n:] + np.uint32(n + 1)
            if not len(grams):
                break
            spread = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            counts += np.bincount((spread >> np.uint32(32 - BUCKET_BITS))[:own], minlength=len(counts))
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def weigh(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of unit length."""
    values = (1 + np.log(counts)) * idf[buckets]
    return values / (np.linalg.norm(values) or 1.0)


def bucket_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(bucket, n)``: documents with each bucket; bucket -1 counts the documents."""
    found, total = np.zeros(1 << BUCKET_BITS, np.int64), 0
    for batch in in_slices(batches):
        for text in batch.column("text").to_pylist():
            if words := letters(text):
                found[gram_counts(words)[0]] += 1
                total += 1
    buckets = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *buckets], pa.int64()), pa.array([total, *found[buckets]], pa.int64())], ["bucket", "n"])


def idf_weights(labelled: DataFrame) -> np.ndarray:
    """IDF per bucket over all training rows; as many values as buckets."""
    counted = labelled.select("text").mapInArrow(bucket_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r["bucket"]: r["n"] for r in counted.collect()}
    total, frequency = found.pop(-1, 0), np.zeros(1 << BUCKET_BITS)
    for bucket, n in found.items():
        frequency[bucket] = n
    return np.log((1 + total) / (1 + frequency)) + 1


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        rows = [(key, lang, *gram_counts(words)) for key, lang, text in zip(*(batch.column(x).to_pylist() for x in ("key", "lang", "text")), strict=True) if (words := letters(text))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.string()),
                pa.array([r[2].astype("<u2").tobytes() for r in rows], pa.binary()),
                pa.array([np.minimum(r[3], 2**32 - 1).astype("<u4").tobytes() for r in rows], pa.binary()),
            ],
            ["key", "lang", "buckets", "counts"],
        )


class Leader:
    """Per-coordinate follow-the-regularised-leader for a softmax over classes."""

    def __init__(self, classes: int):
        shape = ((1 << BUCKET_BITS) + 1, classes)  # the last row is the intercept
        self.sums, self.squares = np.zeros(shape), np.zeros(shape)

    def weights(self, at) -> np.ndarray:
        z, n = self.sums[at], self.squares[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        own = self.weights(at)
        error = softmax(values @ own)
        error[label] -= 1
        step = values[:, None] * error[None, :]
        before = self.squares[at]
        after = before + step * step
        self.sums[at] += step - (np.sqrt(after) - np.sqrt(before)) / ALPHA * own
        self.squares[at] = after


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def best_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden section on its logarithm.

    One more row is counted as wrong than was, so that a sample without an error
    does not stand for certainty.
    """
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))
        other = (1 - p[np.arange(len(labels)), labels]).mean()
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).sum() - np.log(max(other, 1e-12)))

    low, high, golden = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(langs: list[str], idf: np.ndarray):
    """One model from a stream of rows by epoch; the last epoch calibrates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, leader = {x: i for i, x in enumerate(langs)}, Leader(len(langs))
        scores, labels, weights = [], [], None
        for batch in in_slices(batches):
            for epoch, lang, buckets, counts in zip(*(batch.column(x).to_pylist() for x in ("epoch", "lang", "buckets", "counts")), strict=True):
                at = np.frombuffer(buckets, "<u2").astype(np.int64)
                values = np.append(weigh(at, np.frombuffer(counts, "<u4").astype(np.int64), idf), 1.0)
                at = np.append(at, 1 << BUCKET_BITS)
                if epoch < EPOCHS:
                    leader.learn(at, values, place[lang])
                else:
                    weights = leader.weights(slice(None)) if weights is None else weights
                    scores.append(values @ weights[at])
                    labels.append(place[lang])
        temperature = best_temperature(np.array(scores), np.array(labels, dtype=np.int64))
        out = io.BytesIO()
        np.savez_compressed(out, weights=leader.weights(slice(None)).astype(np.float32), temperature=temperature)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["model"])

    return run


class Model:
    """Languages, IDF and weights; its size is buckets times languages."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.langs, self.idf, self.weights, self.temperature = langs, idf.astype(np.float32), weights, temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        words = letters(text or "")
        if not words or not self.langs:
            return UNKNOWN, 0.0
        at, counts = gram_counts(words)
        scores = weigh(at, counts, self.idf) @ self.weights[at] + self.weights[-1]
        p = softmax(scores / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(min(1.0, p[best]))


def fit(docs: DataFrame) -> Model:
    """A model learnt from text and non-null lang of the training documents.

    More than ``MOST_LANGS`` values of lang are an error: such a column is no language.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & in_training())
    labelled = labelled.select(F.xxhash64("doc_id", "text", "lang").alias("key"), F.col("lang").cast("string").alias("lang"), valid_text().alias("text"))
    langs = sorted(r["lang"] for r in labelled.select("lang").distinct().limit(MOST_LANGS + 1).collect())
    if len(langs) > MOST_LANGS:
        raise ValueError(f"lang has more than {MOST_LANGS} values")
    if not langs:
        return Model([], np.zeros(1), np.zeros((1, 0)), 1.0)
    idf = idf_weights(labelled)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    keys = labelled.select("lang", "key").distinct().withColumn("no", first).filter(F.col("no") <= max(1, SAMPLE_ROWS // len(langs)))
    keys = F.broadcast(written(keys.select("key"), "sample-keys"))  # SAMPLE_ROWS keys, or one a language
    sample = labelled.join(keys, "key", "left_semi").mapInArrow(features, "key long, lang string, buckets binary, counts binary")
    sample = written(sample.dropDuplicates(["key"]), "sample")
    epochs = F.when(F.pmod("key", F.lit(CALIBRATION)) == 0, F.array(F.lit(EPOCHS))).otherwise(F.sequence(F.lit(0), F.lit(EPOCHS - 1)))
    stream = sample.withColumn("epoch", F.explode(epochs)).withColumn("order", F.xxhash64("epoch", "key"))
    stream = stream.repartition(1).sortWithinPartitions("epoch", "order").select("epoch", "lang", "buckets", "counts")
    saved = np.load(io.BytesIO(bytes(stream.mapInArrow(train(langs, idf), "model binary").first()["model"])))
    return Model(langs, idf, saved["weights"], float(saved["temperature"]))


@on_plain_names("doc_id", "text", "lang")
def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with ``__lang`` and ``__score`` added; a model is fitted if none is given.

    ``__lang`` is a learnt value of lang, or ``und`` where text is NULL or has no
    letter, with ``__score`` 0; else the score is the calibrated probability.
    Texts are read whole, bytes that are not valid UTF-8 as U+FFFD, and only text is read. If no row can be learnt from, all
    are ``und``. Ties go to the first language in code point order. Repeated rows
    are predicted each and learnt from once. Needs text, and doc_id and lang to fit.
    """
    model = model or fit(docs)
    docs = docs.withColumn("text", F.make_valid_utf8(F.col("text").cast("string")))
    out = T.StructType([*docs.schema.fields, T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [model.predict(x) for x in batch.column("text").to_pylist()]
            own = {x: batch.column(x) for x in batch.schema.names}
            made = {"__lang": pa.array([x for x, _ in found], pa.string()), "__score": pa.array([x for _, x in found], pa.float64())}
            yield pa.RecordBatch.from_pydict(own | made)

    return docs.mapInArrow(run, out)
