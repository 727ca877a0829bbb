"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is lower-cased, everything but letters becomes one blank, and its 2- to 4-grams that hold no inner blank (so a word's edges count) are
hashed to rows of an embedding table. The text is the mean of those rows; a linear layer and a softmax give the languages. Table and
layer are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows; a temperature, fitted on part of the
sample, calibrates the scores, and the threshold of rejection is the lowest score at which accepted rows of that part reach the
wanted precision. Prediction folds table and layer into one array of a few numbers per hashed row and runs over whole texts in the
tasks.

Bounds: ``SAMPLE_ROWS`` rows a language, ``SAMPLE_CHARS`` characters of each (a window at a hashed place), ``MAX_LANGUAGES`` languages.

Defined results: ``und`` with score 0 if the text is null or has no letter, or if there was nothing to learn from. Ties go to the
language first in order. Repeated rows are predicted each; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import with_python

SAMPLE_ROWS = 600
SAMPLE_CHARS = 1_500
MAX_LANGUAGES = 200  # of one model; its table has a row of numbers a language
BUCKETS = 1 << 15
WIDTH = 16
ORDERS = (2, 3, 4)
CHUNK = 200_000  # characters of one text at a time


@cache
def _letters() -> np.ndarray:
    """Is this code point a letter?"""
    return np.array([unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)])


def buckets(text: str) -> np.ndarray:
    """Hashed rows of the n-grams of a text; empty if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, dtype=np.int64)
    keep = letter | np.r_[True, letter[:-1]]  # the first of several non-letters stands for all
    codes = np.where(letter, codes, 32)[keep].astype(np.uint64)
    if codes[0] != 32:
        codes = np.r_[np.uint64(32), codes]
    if codes[-1] != 32:
        codes = np.r_[codes, np.uint64(32)]
    blank = codes == 32
    found = []
    for order in ORDERS:
        n = len(codes) - order + 1
        if n <= 0:
            continue
        mixed = np.full(n, order, dtype=np.uint64)
        for k in range(order):
            mixed = (mixed ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        whole = np.ones(n, dtype=bool)
        for k in range(1, order - 1):
            whole &= ~blank[k : k + n]
        found.append((mixed[whole] % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(found)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    logits: np.ndarray  # BUCKETS x languages: embedding times layer
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, text: str) -> np.ndarray | None:
        """Calibrated probabilities of a whole text, None without letters."""
        total, n = np.zeros(len(self.languages)), 0
        at = 0
        while at < len(text):
            end = at + CHUNK
            while end < len(text) and text[end].isalpha():  # not inside a word
                end += 1
            rows = buckets(text[at:end])
            n += len(rows)
            total += self.logits[rows].sum(axis=0)
            at = end
        if not n:
            return None
        return _softmax((total / n + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        found = self.scores(text) if text and self.languages else None
        if found is None:
            return "und", 0.0
        best = int(np.argmax(found))
        return self.languages[best], float(found[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, str]], epochs: int = 6, rate: float = 0.5, precision: float = 0.99, seed: int = 7) -> LanguageModel:
    """Fit on (text, language) rows; every fifth row calibrates and is not trained on."""
    languages = tuple(sorted({lang for _, lang in rows}))
    number = {lang: i for i, lang in enumerate(languages)}
    data = [(rows_, number[lang]) for text, lang in sorted(rows) if len(rows_ := buckets(text))]
    if not data:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    held = [x for i, x in enumerate(data) if i % 5 == 4] or data
    used = [x for i, x in enumerate(data) if i % 5 != 4] or data
    draw = np.random.default_rng(seed)
    table = draw.normal(0, 1 / WIDTH, (BUCKETS, WIDTH))
    layer = np.zeros((WIDTH, len(languages)))
    bias = np.zeros(len(languages))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in draw.permutation(len(used)):
            at, label = used[i]
            mean = table[at].mean(axis=0)
            error = _softmax(mean @ layer + bias)
            error[label] -= 1
            back = layer @ error
            layer -= step * np.outer(mean, error)
            bias -= 0.1 * step * error
            # each n-gram moves as far as if it stood alone in the mean, shared by how many there are
            np.subtract.at(table, at, (step * 20 / len(at)) * back)
    logits = table @ layer
    raw = np.array([logits[at].mean(axis=0) + bias for at, _ in held])
    labels = np.array([label for _, label in held])

    def loss(t: float) -> float:
        return -float(np.log(_softmax(raw / t)[np.arange(len(labels)), labels] + 1e-12).mean())

    temperature = min(np.geomspace(0.1, 10, 60), key=loss)
    sure = _softmax(raw / temperature)
    best, right = sure.max(axis=1), sure.argmax(axis=1) == labels
    order = np.argsort(-best, kind="stable")
    reached = np.nonzero(np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision)[0]
    threshold = float(best[order[reached[-1]]]) if len(reached) else 1.0
    return LanguageModel(languages, logits.astype(np.float32).astype(np.float64), bias, float(temperature), threshold)


def learn(
    rows: DataFrame, text: str = "text", lang: str = "lang", per_language: int = SAMPLE_ROWS, max_languages: int = MAX_LANGUAGES
) -> LanguageModel:
    """Train on at most ``per_language`` (and a fifth more by chance) rows of each language, drawn by hash.

    Rows with more than ``max_languages`` languages are refused: no language is left out silently.
    """
    own = rows.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    counts = own.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages: raise max_languages, or merge rare ones first")
    if not counts:
        return train([])
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], per_language / r["n"])))
    drawn = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    start = F.pmod(F.xxhash64("text", F.lit("window")), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    # copies of one text are drawn together, so a group of copies could exceed the bound: each text counts once
    sample = (
        own.filter(drawn < share[F.col("lang")]).select("lang", F.xxhash64("text").alias("print"), F.substring("text", start, SAMPLE_CHARS).alias("part"))
        .dropDuplicates(["lang", "print"]).orderBy("print").limit(2 * per_language * len(counts)).select("part", "lang")
    )
    return train([(r["part"], r["lang"]) for r in sample.collect()])


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every whole text; accepted means the score reaches the calibrated threshold."""
    with_python(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.predict(body.as_py()) for body in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64()),
                    pa.array([x != "und" and s >= sent.value.threshold for x, s in found], pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "accepted"],
            )

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def query(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    model = learn(docs.filter(F.col("doc_id").isNotNull() & ~held_out))
    found = predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")
