"""Reversible line dedup: exact reference tables behind sharded cuckoo filters.

A line's key is the line with blanks stripped and A-Z lower-cased; keys shorter than ``min_chars`` never count. A state holds

* ``references``: one row per (key, document) - the exact truth; deleting a document deletes its rows;
* ``counts``: per key the number of documents and the largest id holding it;
* ``filters``: per shard of the key space a cuckoo filter of the keys that ``min_docs`` or more documents hold.

``insert`` and ``delete`` recount only the keys they touch and insert into or delete from the filters what crossed the threshold, so
inserting documents and deleting them again gives back the same state. Dropping lines first asks the filters, which almost all lines
leave at once, and looks up only hits in the exact table; a false hit of a filter therefore changes nothing.

A frequent line is no hot group: a document names a key once, counts are aggregated before they are shuffled, and the question to
the filters is dealt by (shard, slice), each slice getting its own copy of the shard's filter.

Defined results: a null or empty text is one empty line and stays as it is. Rows without an id hold no references and keep all
lines. Rows with the same id are one document; each loses the same keys. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.llm.common import fresh, with_python, written

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 100_000  # keys of one filter, about
SLICE_ROWS = 400_000  # questions that one task asks of a filter, about

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
REFERENCES = "key binary, doc_id long"
COUNTS = "key binary, n long, largest long"
FILTERS = "shard long, n_shards long, filter binary"


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """16 bytes that stand for the key of a line, None if it is too short to count."""
    if len(line) < min_chars:
        return None
    raw = line.encode().strip(BLANKS).lower()  # bytes.lower() knows A-Z only
    if len(raw) < min_chars or len(raw.decode()) < min_chars:
        return None
    return hashlib.md5(raw, usedforsecurity=False).digest()


# ----------------------------------------------------------------------------------------------- the cuckoo filter


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _hashes(keys: list[bytes]) -> np.ndarray:
    """The first eight bytes of each key, mixed."""
    return _mix(np.frombuffer(b"".join(k[:8] for k in keys), dtype="<u8"))


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key lives in one of two buckets, each found from the other and the fingerprint."""

    SLOTS = 4
    ROUNDS = 500

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (cls.SLOTS * 0.8)))))
        return cls(np.zeros((buckets, cls.SLOTS), dtype="<u2"))

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        """A filter of these keys; grows until all fit."""
        size = len(hashes)
        while True:
            made = cls.sized(size)
            if made.insert(hashes):
                return made
            size = 2 * max(size, made.table.size)

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, dtype="<u2").reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _where(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = np.maximum(hashes >> np.uint64(48), np.uint64(1)).astype("<u2")
        return prints, (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (_mix(prints.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, one = self._where(hashes)
        two = self._other(prints, one)
        return ((self.table[one] == prints[:, None]) | (self.table[two] == prints[:, None])).any(axis=1)

    def _settle(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put into free slots what finds one; True for what didn't."""
        left = np.ones(len(prints), dtype=bool)
        for slot in range(self.SLOTS):
            at = np.nonzero(left & (self.table[bucket, slot] == 0))[0]
            _, first = np.unique(bucket[at], return_index=True)
            at = at[first]
            self.table[bucket[at], slot] = prints[at]
            left[at] = False
        return left

    def insert(self, hashes: np.ndarray) -> bool:
        """False if they don't all fit (the filter is then of no use); each call adds one copy of a key."""
        prints, bucket = self._where(hashes)
        for turn in range(self.ROUNDS):
            for _ in range(2):
                left = self._settle(prints, bucket)
                prints, bucket = prints[left], bucket[left]
                if not len(prints):
                    return True
                bucket = self._other(prints, bucket)
            # one of each full bucket makes room and moves to its other bucket
            _, first = np.unique(bucket, return_index=True)
            slot = (turn + bucket[first]) % self.SLOTS
            out = self.table[bucket[first], slot].copy()
            self.table[bucket[first], slot] = prints[first]
            prints[first] = out
            bucket[first] = self._other(out, bucket[first])
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Take away one copy of each key; all of them must have been inserted."""
        if not len(hashes):
            return
        prints, at = self._where(hashes)
        for _ in range(2):
            order = np.lexsort((prints, at))
            again = np.zeros(len(prints), dtype=np.int64)  # the how-many-eth equal (bucket, fingerprint) it is
            same = np.r_[False, (at[order][1:] == at[order][:-1]) & (prints[order][1:] == prints[order][:-1])]
            places = np.arange(len(prints))
            again[order] = places - np.maximum.accumulate(np.where(same, 0, places))
            equal = self.table[at] == prints[:, None]
            slot = np.where(equal & (equal.cumsum(axis=1) == again[:, None] + 1), np.arange(self.SLOTS), self.SLOTS).min(axis=1)
            found = slot < self.SLOTS
            self.table[at[found], slot[found]] = 0
            prints, at = prints[~found], self._other(prints[~found], at[~found])
            if not len(prints):
                return


# ------------------------------------------------------------------------------------------------------ state


@dataclass(frozen=True)
class LineState:
    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS


def empty_state(spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineState:
    made = (spark.createDataFrame([], schema) for schema in (REFERENCES, COUNTS, FILTERS))
    return LineState(*made, min_chars=min_chars, min_docs=min_docs)


def references(docs: DataFrame, min_chars: int = MIN_CHARS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Distinct (key, doc_id) of all lines."""
    with_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = [], []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = {line_key(line, min_chars) for line in body.as_py().split("\n")}
                own.discard(None)
                keys += own
                ids += [doc] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["key", "doc_id"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).dropna()
    # most documents have one row, so this distinct is a shuffle of 24 bytes a line; it spreads a frequent line over all tasks
    return source.mapInArrow(run, REFERENCES).distinct()


def _shard(key: F.Column, n_shards: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(key), n_shards)


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("largest"))


def _built(counts: DataFrame, min_docs: int) -> DataFrame:
    """Filters of all keys with ``min_docs`` or more documents; as many shards as the keys need."""
    frequent = counts.filter(F.col("n") >= min_docs).select("key")
    n_shards = max(1, -(-frequent.count() // SHARD_KEYS))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        raw = CuckooFilter.of(_hashes(list(rows["key"]))).dump()
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "n_shards": [n_shards], "filter": [raw]})

    with_python(counts.sparkSession)
    dealt = frequent.withColumn("shard", _shard(F.col("key"), F.lit(n_shards)))
    return dealt.groupBy("shard").applyInPandas(build, FILTERS)


def _moved(filters: DataFrame, changed: DataFrame, counts: DataFrame, min_docs: int) -> DataFrame:
    """``filters`` after ``changed`` (key, sign: 1 to insert, -1 to delete); shards that overflow are built anew from ``counts``."""
    first = filters.select("n_shards").first()
    if first is None:
        return written(_built(counts, min_docs), "line-filters")
    n_shards = int(first["n_shards"])

    def move(blobs: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        shard = int((keys if len(keys) else blobs)["shard"].iloc[0])
        held = CuckooFilter.load(blobs["filter"].iloc[0]) if len(blobs) else CuckooFilter.sized(SHARD_KEYS // 100)
        gone, come = (list(keys["key"][keys["sign"] == s]) for s in (-1, 1))
        held.delete(_hashes(gone))
        fits = held.insert(_hashes(come))
        return pd.DataFrame({"shard": [shard], "n_shards": [n_shards], "filter": [held.dump() if fits else None]})

    with_python(filters.sparkSession)
    dealt = changed.withColumn("shard", _shard(F.col("key"), F.lit(n_shards)))
    moved = written(
        filters.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(move, FILTERS), "line-filters-moved"
    )
    full = moved.filter("filter IS NULL").select("shard")
    if full.isEmpty():
        return moved

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        raw = CuckooFilter.of(_hashes(list(rows["key"]))).dump()
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "n_shards": [n_shards], "filter": [raw]})

    again = counts.filter(F.col("n") >= min_docs).withColumn("shard", _shard(F.col("key"), F.lit(n_shards))).join(full, "shard", "left_semi")
    rebuilt = again.select("key", "shard").groupBy("shard").applyInPandas(build, FILTERS)
    return written(moved.filter("filter IS NOT NULL").unionByName(rebuilt), "line-filters")


def _changed(state: LineState, refs: DataFrame, touched: DataFrame) -> LineState:
    """The state with ``refs`` as its references, where only ``touched`` keys may have another count."""
    new = written(_count(refs.join(touched, "key", "left_semi")), "line-recounted")
    old = state.counts.join(touched, "key", "left_semi")
    both = old.select("key", F.col("n").alias("was")).join(new.select("key", F.col("n").alias("now")), "key", "full")
    before, after = (F.coalesce(F.col(c), F.lit(0)) >= state.min_docs for c in ("was", "now"))
    crossed = both.filter(before != after).select("key", F.when(after, 1).otherwise(-1).alias("sign"))
    counts = written(state.counts.join(touched, "key", "left_anti").unionByName(new), "line-counts")
    filters = _moved(state.filters, crossed, counts, state.min_docs)
    return LineState(refs, counts, filters, state.min_chars, state.min_docs)


def insert(state: LineState, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> LineState:
    """The state with these documents; documents that it already holds change nothing."""
    came = written(references(docs, state.min_chars, text, doc_id), "line-references")
    if state.references.isEmpty():
        counts = written(_count(came), "line-counts")
        return LineState(came, counts, written(_built(counts, state.min_docs), "line-filters"), state.min_chars, state.min_docs)
    new = came.join(state.references, ["key", "doc_id"], "left_anti")
    return _changed(state, written(state.references.unionByName(new), "line-references-all"), came.select("key").distinct())


def delete(state: LineState, doc_ids: DataFrame, doc_id: str = "doc_id") -> LineState:
    """The state without these documents."""
    gone = doc_ids.select(F.col(doc_id).cast("long").alias("doc_id")).distinct()
    touched = written(state.references.join(gone, "doc_id", "left_semi").select("key").distinct(), "line-touched")
    return _changed(state, written(state.references.join(gone, "doc_id", "left_anti"), "line-references-all"), touched)


# ------------------------------------------------------------------------------------------------------- lookup


def droppable(state: LineState, refs: DataFrame) -> DataFrame:
    """The (doc_id, key) of ``refs`` that must go: in ``min_docs`` or more documents, and not in the largest one."""
    with_python(refs.sparkSession)
    first = state.filters.select("n_shards").first()
    if first is None:  # no key is frequent
        return refs.select("doc_id", "key").limit(0)
    n_shards = int(first["n_shards"])
    # a shard's questions grow with its hottest key; slices keep them even
    slices = max(1, -(-refs.count() // (n_shards * SLICE_ROWS)), -(-int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // n_shards))
    asked = refs.select(
        _shard(F.col("key"), F.lit(n_shards)).alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(slices)).alias("slice"),
        F.lit(1).alias("turn"), "key", "doc_id",
    )
    blobs = state.filters.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>")).alias("slice"), F.lit(0).alias("turn"),
        F.col("filter").alias("key"), F.lit(None).cast("long").alias("doc_id"),
    )
    dealt = asked.unionByName(blobs).repartition("shard", "slice").sortWithinPartitions("shard", "slice", "turn")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: CuckooFilter | None = None
        of = None
        for batch in batches:
            shards, parts, turns = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            ends = np.r_[np.nonzero((np.diff(shards) != 0) | (np.diff(parts) != 0))[0] + 1, len(shards)]
            kept = []
            at = 0
            for end in ends:
                if end == at:
                    continue
                group = (shards[at], parts[at])
                if turns[at] == 0:
                    held, of, at = CuckooFilter.load(batch.column(3)[int(at)].as_py()), group, at + 1
                if at < end and of == group and held is not None:
                    hits = held.contains(_hashes(batch.column(3).slice(at, end - at).to_pylist()))
                    kept.append(at + np.nonzero(hits)[0])
                at = end
            rows = batch.take(pa.array(np.concatenate(kept) if kept else np.zeros(0, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([rows.column(4), rows.column(3)], ["doc_id", "key"])

    hits = dealt.mapInArrow(ask, "doc_id long, key binary")
    exact = state.counts.filter(F.col("n") >= state.min_docs)
    return hits.join(exact, "key").filter(F.col("doc_id") < F.col("largest")).select("doc_id", "key")


def drop_lines(state: LineState, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", into: str = "deduped") -> DataFrame:
    """``docs`` with a struct column ``into``: kept (the text that stays), n_lines, n_dropped.

    The documents must have been inserted into ``state``; others keep all their lines.
    """
    spark = docs.sparkSession
    with_python(spark)
    gone = droppable(state, state.references).groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    own, keys = fresh(docs, "own_id_"), fresh(docs, "keys_")
    joined = docs.join(
        gone.select(F.col("doc_id").alias(own), F.col("keys").alias(keys)), F.col(doc_id).cast("long") == F.col(own), "left"
    ).drop(own)
    min_chars = state.min_chars

    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def without(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
        rows = []
        for body, out in zip(texts, drops, strict=True):
            lines = (body or "").split("\n")
            stay = lines
            if out is not None:
                out = set(out)
                stay = [line for line in lines if line_key(line, min_chars) not in out]
            rows.append((body if body is None else "\n".join(stay), len(lines), len(lines) - len(stay)))
        return pd.DataFrame(rows, columns=["kept", "n_lines", "n_dropped"])

    whole = F.struct(
        F.col(text).alias("kept"), F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"),
    )
    # the two branches keep documents that lose nothing out of Python
    same = joined.filter(F.col(keys).isNull()).withColumn(into, whole)
    less = joined.filter(F.col(keys).isNotNull()).withColumn(into, without(F.col(text).cast("string"), F.col(keys)))
    return same.unionByName(less).drop(keys)


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with their texts less the lines that other documents hold as well."""
    state = insert(empty_state(docs.sparkSession), docs, text, doc_id)
    into = fresh(docs, "deduped_")
    return drop_lines(state, docs, text, doc_id, into).withColumn(text, F.col(into)["kept"]).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    found = drop_lines(insert(empty_state(docs.sparkSession), docs), docs)
    kept = F.coalesce(F.col("deduped")["kept"], F.lit(""))
    return found.select(
        "doc_id", F.col("deduped")["n_lines"].alias("n_lines"), F.col("deduped")["n_dropped"].alias("n_dropped"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT row_id, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
keyed AS (
  SELECT row_id, doc_id, line, i,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line),
counts AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20 AND doc_id IS NOT NULL
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT row_id, k.doc_id, line, i, coalesce(k.doc_id < c.largest, false) AS drops FROM keyed k LEFT JOIN counts c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drops) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT drops), '')) AS kept_sha256
FROM judged GROUP BY row_id
"""
