"""Best-fit packing by a configuration linear program over the histogram of piece lengths.

1. Tasks tokenize whole texts, keeping nothing between them, and cut only documents above the capacity; each piece keeps its length and a checksum.
2. One aggregate gives the histogram, at most ``capacity`` rows whatever the input's size; only that reaches the driver.
3. The driver solves the covering program over configurations (multisets of lengths that fit one sequence): multiplicative weights
   price the lengths, a knapsack dynamic program finds the best configuration at those prices, the averaged solution is rounded down,
   and what remains is filled in best-fit order, in groups of equal sequences, so no step depends on the number of pieces.
4. Pieces get a rank among those of their length, and the rank says which sequence and offset is theirs.

Defined results: a null text counts as an empty one (only the end token); an empty table gives no rows; repeated rows are packed each.
Pieces that agree in all columns are interchangeable.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanledger.llm.common import with_python, written

CAPACITY = 1024
END_ID = 2
RANK_BUCKET = 50_000  # pieces of one length that one task ranks, about
OWN_ROW = "own_row_"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Fixed value: how byte-level tokenizers split a text before merging.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The bytes that the letters of a byte-level vocabulary stand for: visible Latin-1 ones for themselves, the others from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _as_ranks(spec: dict) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Byte pieces by rank and the added tokens of a tokenizer file, None if it isn't a plain byte-level one whose ids are its merge order."""
    model, split, added = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
    plain = (
        model["type"] == "BPE" and spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex")
        and not split.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        and not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        return None
    special, vocabulary, letters = {a["content"]: a["id"] for a in added}, model["vocab"], _byte_of()
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or any(c not in letters for piece in vocabulary.keys() - special for c in piece):
        return None
    return {bytes(letters[c] for c in piece): i for piece, i in vocabulary.items() if piece not in special}, special


@cache
def text_encoder(path: str) -> Callable[[str], bytes]:
    """Token ids of a text as bytes (unsigned 32 bit, little endian). One for each Python worker; it keeps nothing of the texts.

    A plain byte-level file is read as ranks of byte pieces, which gives the same ids in a third of the time; any other one goes
    through its own tokenizer.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the work
    with open(path, encoding="utf-8") as file:
        found = _as_ranks(json.load(file))
    if found is None:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        return lambda text: np.asarray(model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    from tiktoken import Encoding

    ranks, special = found
    ranked_model = Encoding(os.path.basename(path), pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: ranked_model.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``ids``: whole if it fits, else full pieces behind a shorter first one."""
    total = len(ids) // 4
    at = 0
    first = total if total <= capacity else total % capacity or capacity
    while at < total:
        length = first if at == 0 else capacity
        yield at, length
        at += length


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", doc_id: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document; ``with_ids`` adds their token ids."""
    with_python(docs.sparkSession)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(tokenizer)
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), [[], [], [], [], []]
            tokens: list[list[int]] = []
            for key, body in zip(ids, batch.column(1), strict=True):
                encoded = encode(body.as_py() or "") + end
                for piece, (start, length) in enumerate(cut(encoded, capacity)):
                    part = encoded[4 * start : 4 * (start + length)]
                    for column, value in zip(rows, (key, piece, start, length, zlib.crc32(part)), strict=True):
                        column.append(value)
                    if with_ids:
                        tokens.append(np.frombuffer(part, dtype="<u4").tolist())
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            arrays = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]
            if with_ids:
                arrays, names = [*arrays, pa.array(tokens, pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, PIECES + (", ids array<long>" if with_ids else ""))


# ------------------------------------------------------------------------------------------------ the linear program

Config = tuple[int, ...]  # lengths, longest first


def _priced(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: by room, the best value and the index of a length to take (-1: leave one free)."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        k = upto[room]
        gain = values[:k] + best[room - lengths[:k]]
        i = int(gain.argmax())
        if gain[i] > best[room - 1]:
            best[room], pick[room] = gain[i], i
        else:
            best[room] = best[room - 1]
    return best, pick


def _configurations(pick: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """For each length, the best configuration that holds it: a row of length indexes, -1 where it ends."""
    own = np.arange(len(lengths))
    room = capacity - lengths
    rows = [own]
    while True:
        while (skip := (room > 0) & (pick[room] < 0)).any():
            room = room - skip
        chosen = np.where(room > 0, pick[room], -1)
        if (chosen < 0).all():
            return np.stack(rows, axis=1)
        room = room - np.where(chosen >= 0, lengths[chosen], 0)
        rows.append(chosen)


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = 100, rate: float = 2.0) -> list[tuple[Config, int]]:
    """Configurations and how many sequences take each; every piece of the histogram is placed exactly once.

    The work depends on ``capacity`` and ``rounds`` only.
    """
    full = histogram.get(capacity, 0)
    lengths = np.array(sorted(k for k, n in histogram.items() if n > 0 and k < capacity), dtype=np.int64)
    out: list[tuple[Config, int]] = [((capacity,), full)] if full else []
    if not len(lengths):
        return out
    demand = np.array([histogram[int(k)] for k in lengths], dtype=np.int64)

    # Multiplicative weights: a length that is covered ahead of the others loses price, one that lags gains. Each round covers one
    # more share of every length's demand, by the best configurations at the present prices.
    weight = np.ones(len(lengths))
    covered = np.zeros(len(lengths))
    amounts: dict[Config, float] = {}
    for t in range(1, rounds + 1):
        _, pick = _priced(lengths / capacity * weight, lengths, capacity)
        table = _configurations(pick, lengths, capacity)
        due = demand * (t / rounds) - covered
        for i in np.argsort(-lengths):
            if due[i] <= 0:
                continue
            items = table[i][table[i] >= 0]
            times = due[i] / np.count_nonzero(items == i)
            np.subtract.at(due, items, times)
            np.add.at(covered, items, times)
            config = tuple(sorted((int(k) for k in lengths[items]), reverse=True))
            amounts[config] = amounts.get(config, 0.0) + times
        weight = np.exp(-rate * (covered / demand - t / rounds))
    # systematic rounding, the fullest configurations first; none may cover a length more often than it occurs
    left = dict(zip(lengths.tolist(), demand.tolist(), strict=True))
    total = taken = 0.0
    for config in sorted(amounts, key=lambda c: (-sum(c), -amounts[c], c)):
        total += amounts[config]
        need = {k: config.count(k) for k in set(config)}
        times = min(int(total - taken), *(left[k] // n for k, n in need.items()))
        taken += int(total - taken)
        if times > 0:
            for k, n in need.items():
                left[k] -= times * n
            out.append((config, times))
    return out + best_fit({k: n for k, n in left.items() if n}, capacity)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Best-fit decreasing over groups of equal sequences: each length goes where it leaves the least room."""
    groups: dict[int, list[tuple[Config, int]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for room in range(length, capacity):
            for config, times in groups.pop(room, []):
                each = min(room // length, left)
                fit = min(times, left // each) if each else 0
                if fit:
                    left -= fit * each
                    groups.setdefault(room - each * length, []).append((config + (length,) * each, fit))
                if fit < times:
                    rest = times - fit
                    if 0 < left < room // length and each:  # the last few
                        groups.setdefault(room - left * length, []).append((config + (length,) * left, 1))
                        left, rest = 0, rest - 1
                    if rest:
                        groups.setdefault(room, []).append((config, rest))
            if not left:
                break
        each = capacity // length
        if left // each:
            groups.setdefault(capacity - each * length, []).append(((length,) * each, left // each))
        if left % each:
            groups.setdefault(capacity - (left % each) * length, []).append(((length,) * (left % each), 1))
    return [x for room in sorted(groups) for x in groups[room]]


# ---------------------------------------------------------------------------------------------------- places


def _places(configs: list[tuple[Config, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank of each interval, the first sequence it fills, the offset there."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for config, times in configs:
        offset = 0
        for length in config:
            found.setdefault(length, []).append((ranks.get(length, 0), sequence, offset))
            ranks[length] = ranks.get(length, 0) + times
            offset += length
        sequence += times
    return {k: tuple(np.array(x, dtype=np.int64) for x in zip(*v, strict=True)) for k, v in found.items()}


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """``rank`` (from 0) of each piece among those of its length. A frequent length is cut into hash buckets, each ranked by itself.

    Pieces with a number of their own (``own_row_``, stable) are dealt out by it, so that equal ones don't share a bucket.
    """
    buckets = max(1, -(-total // RANK_BUCKET))
    by = [c for c in ("doc_id", "piece", "ids_crc32", OWN_ROW) if c in pieces.columns]
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(*by), F.lit(buckets))).drop(OWN_ROW)
    before = (
        dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n"))
        .drop("n")
    )
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    own = dealt.withColumn("own", F.row_number().over(order) - 1)
    return own.join(before, ["length", "bucket"]).withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "bucket")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``pieces`` must be stable (a table): it is read more than once.

    It has doc_id, piece, start, length (1 to capacity) and ids_crc32; further columns are kept.
    """
    with_python(pieces.sparkSession)
    counts = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most capacity rows
    histogram = {int(r["length"]): int(r["n"]) for r in counts}
    places = _places(solve(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for length in np.unique(lengths):
                at = np.nonzero(lengths == length)[0]
                first, begins, offsets = places[int(length)]
                slot = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at], offset[at] = begins[slot] + rank[at] - first[slot], offsets[slot]
            kept = [i for i, name in enumerate(batch.schema.names) if name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(sequence), pa.array(offset)],
                [*(batch.schema.names[i] for i in kept), "sequence_id", "offset"],
            )

    dealt = ranked(pieces, sum(histogram.values()))
    schema = T.StructType([
        *(f for f in dealt.schema.fields if f.name != "rank"), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])
    return dealt.mapInArrow(place, schema).select(*(c for c in pieces.columns if c != OWN_ROW), "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text), cut and pack."""
    pieces = token_pieces(docs, tokenizer, capacity, end_id, with_ids=with_ids)
    return pack(written(pieces.withColumn(OWN_ROW, F.monotonically_increasing_id()), "pieces"), capacity)


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
