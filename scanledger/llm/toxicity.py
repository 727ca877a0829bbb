"""Toxicity by compression distance: how much better toxic text's dictionary compresses a window than ordinary text's.

Two zstandard dictionaries are trained on a bounded sample of labelled rows. The ordinary one comes from windows of ordinary texts. The
toxic one has the same content and, behind it, what is trained on words that set toxic texts apart: words with a six-byte run that far
more toxic than ordinary texts hold. As both share the ordinary content, the lengths of an ordinary window differ by a byte or two only. A
text is cut into windows of eight words, whole. The gains in bytes (ordinary minus toxic length) are kept as a histogram, whose
best values, sums and counts above thresholds feed a logistic curve. The curve is fitted on rows that the dictionaries have not seen,
weighted to the true share of toxic rows, and gives the score.

Bounds: ``SAMPLE_ROWS`` rows a class, ``SAMPLE_CHARS`` characters of each (a window at a hashed place); dictionaries of 18 KB.

Defined results: null and empty texts score as texts without gains. Without rows of both classes to learn from every score is 0. Repeated rows
are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import with_python, written
from scanledger.llm.language_id import fold

SAMPLE_ROWS = 3_000
SAMPLE_CHARS = 8_000
WINDOW_WORDS = 8
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 2_048
RUN = 6
MIN_MATCH, SEARCH_LOG = 5, 8  # a binary-tree search, as windows are short and every byte counts
GAIN_STEPS = (3, 5, 7, 9)
MOST_GAIN = 63


def words(text: str) -> list[str]:
    return text.lower().split()


def windows(text: str) -> Iterator[bytes]:
    own = words(text)
    for at in range(0, len(own), WINDOW_WORDS):
        yield (" " + " ".join(own[at : at + WINDOW_WORDS])).encode()


def _runs(word: str) -> list[bytes]:
    raw = (" " + word).encode()
    return [raw[i : i + RUN] for i in range(max(1, len(raw) - RUN + 1))]


def _distinct(texts: list[str]) -> list[str]:
    """Texts that share few of their lowest word hashes with one before: copies must not count as evidence."""
    seen: dict[int, list[int]] = defaultdict(list)
    out: list[str] = []
    for text in texts:
        low = sorted({zlib.crc32(w.encode()) for w in words(text) if len(w) > 4})[:16]
        shared = Counter(i for x in low for i in seen[x])
        if len(low) >= 8 and shared and max(shared.values()) >= 6:
            continue
        for x in low:
            seen[x].append(len(out))
        out.append(text)
    return out


def _holders(texts: list[str]) -> Counter:
    found: Counter = Counter()
    for text in texts:
        found.update({run for w in set(words(text)) for run in _runs(w)})
    return found


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()[-size:]
    except zstandard.ZstdError:  # too little text to train on
        return b"".join(samples)[-size:]


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    curve: tuple[float, ...]

    def __getstate__(self) -> dict:
        return {"ordinary": self.ordinary, "toxic": self.toxic, "curve": self.curve}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_BTLAZY2, min_match=MIN_MATCH, search_log=SEARCH_LOG, window_log=17, hash_log=17, chain_log=16,
            target_length=64, write_content_size=False, write_checksum=False,
        )
        shared.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=shared, compression_params=settings)

    def gains(self, text: str | None) -> np.ndarray:
        """What the curve takes, from the gains of all windows of the text."""
        if "pair" not in self.__dict__:
            self.pair = self._compressor(self.ordinary).compress, self._compressor(self.toxic).compress
        plain, hostile = self.pair
        counts = [0] * (MOST_GAIN + 1)
        for window in windows(text or ""):
            gain = len(plain(window)) - len(hostile(window))
            counts[min(max(gain, 0), MOST_GAIN)] += 1
        held = np.array(counts)
        gain = np.arange(MOST_GAIN + 1)
        n = max(1, int(held.sum()))
        best = np.repeat(gain, np.minimum(held, 3))[::-1][:3]
        return np.array([
            best[0] if len(best) else 0, best.sum() / min(3, n), np.log1p((held * np.maximum(gain - 1, 0)).sum()),
            *(np.log1p(held[step:].sum()) for step in GAIN_STEPS), np.log(n), (held * np.maximum(gain - 2, 0)).sum() / n,
        ])

    def score(self, text: str | None) -> float:
        if not self.curve:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.gains(text) @ np.array(self.curve[:-1]) + self.curve[-1], -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's method with a small ridge."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (weight * (p - y)) + 1e-3 * w
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def train(toxic: list[str], ordinary: list[str], toxic_share: float) -> ToxicityModel:
    """Even rows make the dictionaries, odd ones fit the curve."""
    if len(toxic) < 2 or len(ordinary) < 2:
        return ToxicityModel(b"", b"", ())
    hostile, plain = _distinct(toxic[::2]), ordinary[::2]
    held, others = _holders(hostile), _holders(plain)
    least = max(3, 0.01 * len(hostile))
    telling = {
        run for run, n in held.items()
        if n >= least and np.log((n + 0.5) / len(hostile)) - np.log((others[run] + 0.5) / len(plain)) > 2.5
    }
    marked = [(" " + w).encode() for text in hostile for w in words(text) if not telling.isdisjoint(_runs(w))]
    spread = sorted((w for text in plain for w in windows(text)), key=zlib.crc32)[:60_000]
    base = _dictionary(ORDINARY_BYTES, spread)
    more = _dictionary(TOXIC_BYTES, marked * 3) if marked else b""
    model = ToxicityModel(base, base + more, ())
    texts = toxic[1::2] + ordinary[1::2]
    y = np.r_[np.ones(len(toxic) // 2), np.zeros(len(ordinary) // 2)]
    share = y.mean()
    weight = np.where(y == 1, toxic_share / share, (1 - toxic_share) / (1 - share))
    return ToxicityModel(base, base + more, _logistic(np.array([model.gains(t) for t in texts]), y, weight))


def learn(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", per_class: int = SAMPLE_ROWS
) -> ToxicityModel:
    """Train on about ``per_class`` rows of each class at most, drawn by a hash of the text.

    Only ids and hashes meet the labels; the texts of the drawn rows are then looked up where they lie.
    """
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text).cast("string")).alias("print"))
    known = labels.select(F.col(doc_id).alias("id"), (F.col(label) == 1).alias("toxic")).dropna()
    labelled = written(own.filter("text IS NOT NULL").select("id", "print").join(known, "id"), "labelled")
    counts = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return train([], [], 0.0)
    drawn = F.pmod(F.xxhash64("print", F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("toxic"), per_class / counts[True]).otherwise(per_class / counts[False])
    # copies are drawn together, so each text counts once; the limit is a bound, not reached by the shares as a rule
    picked = (
        labelled.filter(drawn < share).groupBy("toxic", "print").agg(F.min("id").alias("id"))
        .orderBy(F.xxhash64("print"), "toxic").limit(3 * per_class)
    )
    picked = written(picked, "picked").select("id", F.col("print").alias("mark"), "toxic")
    start = F.pmod(F.xxhash64("text", F.lit("window")), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    found = own.join(F.broadcast(picked), "id").filter(F.col("print") == F.col("mark"))
    sample = found.select("toxic", "print", F.substring("text", start, SAMPLE_CHARS).alias("part")).dropDuplicates(["toxic", "print"]).orderBy("print")
    rows = sample.collect()
    by = {kind: [r["part"] for r in rows if r["toxic"] == kind] for kind in (True, False)}
    return train(by[True], by[False], counts[True] / (counts[True] + counts[False]))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score) of every whole text."""
    with_python(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.score(body.as_py()) for body in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = learn(docs.filter(~held_out), labels)
    found = score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
