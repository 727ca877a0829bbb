"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Words are runs of digits, letters and non-ASCII characters with A-Z lower-cased; a shingle is five of them in a row (a text of one to
four words is one shingle). A shingle that a text holds c times weighs 1 + ln c. Two texts are linked when the Jaccard similarity of
their shingle sets is 0.8 or more; documents form classes by chains of links.

1. Tasks shingle whole texts. Texts with the same shingles and counts are one *node*, so exact copies are never compared. The
   ProbMinHash signature of a node is the element of the earliest arrival at each register, where every shingle sends arrivals at a
   rate of its weight, and a shingle stops once its next arrival is later than those at all registers. Two signatures agree at a
   register with the probability Jaccard similarity.
2. 25 bands of five registers give buckets, once by those weights and once by weights of one. By weights of one, two signatures agree with
   the Jaccard similarity of the sets, however often either text repeats a shingle: a pair at 0.8 shares no bucket with probability 5e-5.
3. Within a bucket all nodes are verified against one centre, the node with most bucket mates, not against each other. Nodes of buckets
   that then lie in several classes are compared across classes by prefix filtering, which is exact: two sets at the similarity share
   a shingle among their rarest few. So no candidate of the bands is left out, and a large group of near copies costs a multiple of
   its size instead of its square.
4. Links become classes by alternating stars, in rounds that grow with the logarithm of the longest chain.

Defined results: a null text is a class of its own; texts without words belong together only if they are equal. The class id is the
smallest doc_id in the class (null only if all are null). Rows with the same id and text are members each. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import fresh, with_python, written
from scanledger.session import lookup

SIMILARITY = 0.8
WORDS = 5
BANDS, BAND_SIZE = 25, 5
SLOTS = 1 << 18  # counters of the shingle order, whatever the input
CHUNK = 1 << 20  # bytes of one text that are hashed at a time

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(raw: bytes) -> np.ndarray:
    codes = _LOWER[np.frombuffer(raw, dtype=np.uint8)]
    inside = _IN_WORD[codes]
    edges = np.diff(np.r_[False, inside, False].astype(np.int8))
    starts, ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    codes = codes[inside].astype(np.uint64) + np.uint64(1)
    firsts = np.r_[0, np.cumsum(sizes)[:-1]]
    place = np.arange(len(codes)) - np.repeat(firsts, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), _BASE))
    return _mix(np.add.reduceat(codes * powers[place], firsts) + sizes.astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, in order."""
    raw = text.encode()
    parts, at = [], 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        while end < len(raw) and _IN_WORD[_LOWER[raw[end]]]:  # not inside a word
            end += 1
        parts.append(_word_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def shingles(text: str | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of the whole text (sorted hashes) and how often each occurs."""
    hashed = word_hashes(text or "")
    width = min(words, len(hashed))
    if not width:
        return hashed, np.zeros(0, dtype=np.int64)
    total = np.zeros(len(hashed) - width + 1, dtype=np.uint64)
    for i in range(width):
        total += _mix(hashed[i : len(hashed) - width + 1 + i] + np.uint64((i + 1) * int(_BASE) % 2**64))
    return np.unique(_mix(total), return_counts=True)


def prob_min_hash(elements: np.ndarray, weights: np.ndarray, registers: int) -> np.ndarray:
    """The element whose Poisson process reaches each register first."""
    earliest = np.full(registers, np.inf)
    winner = np.zeros(registers, dtype=np.uint64)
    now = np.zeros(len(elements))
    turn = 0
    while len(elements):
        block = max(1, (2 * registers) // len(elements))  # few elements: several arrivals of each at once
        turns = np.arange(turn + 1, turn + block + 1, dtype=np.uint64)
        drawn = _mix(elements[:, None] + turns * _BASE)
        gaps = -np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[:, None]
        arrivals = now[:, None] + np.cumsum(gaps, axis=1)
        times, at = arrivals.ravel(), (_mix(drawn ^ _BASE) % np.uint64(registers)).astype(np.int64).ravel()
        useful = np.nonzero(times < earliest[at])[0]
        order = useful[np.argsort(times[useful], kind="stable")]
        where, first = np.unique(at[order], return_index=True)
        earliest[where] = times[order[first]]
        winner[where] = elements[order[first] // block]
        now = arrivals[:, -1]
        going = now < earliest.max()
        elements, weights, now = elements[going], weights[going], now[going]
        turn += block
    return winner


def bands(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Distinct buckets of the bands, by weights and, if they differ from it, by the plain set."""
    own = np.arange(1, BAND_SIZE + 1, dtype=np.uint64) * _BASE
    found = []
    for weights in [np.ones(len(elements)), *([1.0 + np.log(counts)] if (counts > 1).any() else [])]:
        signature = prob_min_hash(elements, weights, BANDS * BAND_SIZE).reshape(BANDS, BAND_SIZE)
        found.append(_mix(_mix(signature + own).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)))
    return np.unique(np.concatenate(found).astype(np.int64))


def node_key(elements: np.ndarray, counts: np.ndarray) -> bytes:
    return hashlib.md5(elements.tobytes() + counts.astype("<i8").tobytes(), usedforsecurity=False).digest()


# ------------------------------------------------------------------------------------------------------- in Spark


def _sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, print, node, n, bands) of every document; node is null where the text is, and without words there are no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, list[int]] = {}
        for batch in batches:
            nodes, sizes, buckets = [], [], []
            for body in batch.column(1):
                elements, counts = shingles(body.as_py())
                sizes.append(len(elements))
                if not len(elements):  # only equal texts belong together
                    raw = body.as_py()
                    nodes.append(None if raw is None else hashlib.md5(b"no words" + raw.encode(), usedforsecurity=False).digest())
                    buckets.append([])
                    continue
                node = node_key(elements, counts)
                if node not in met:
                    if len(met) >= 5_000:
                        met.clear()
                    met[node] = bands(elements, counts).tolist()
                nodes.append(node)
                buckets.append(met[node])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()),
                    pa.array(buckets, pa.list_(pa.int64())),
                ],
                ["doc_id", "print", "node", "n", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, print long, node binary, n int, bands array<long>")


def _shingled(docs: DataFrame) -> DataFrame:
    """(node, shingles) of every document with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for body in batch.column(1):
                elements, counts = shingles(body.as_py())
                if len(elements):
                    nodes.append(node_key(elements, counts))
                    sets.append(elements.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"]
            )

    return docs.mapInArrow(run, "node binary, shingles array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``pairs`` (nodes a and b) whose exact similarity suffices."""
    left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"{x}_set")) for x in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("a_set", "b_set"))
    return both.filter(common >= similarity * (F.size("a_set") + F.size("b_set") - common)).drop("a_set", "b_set")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest node it is connected to. Alternating stars."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    links = written(links, "links")
    known = None
    while True:
        row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == known or not row[0]:
            break
        known = tuple(row)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # every larger neighbour moves to the lowest node around
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # then all smaller neighbours of a node, and the node, move to the lowest of them
        large = written(large, "links-large")
        lowest = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        several = large.join(lowest.filter("n > 1"), "a").filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = several.unionByName(lowest.select("a", F.col("low").alias("b"))).filter("a != b").distinct()
        links = written(small, "links-small")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _shared_buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n, pull) of the buckets with two or more nodes; pull counts a node's bucket mates over all its bands."""
    members = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    sizes = written(members.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"), "bucket-sizes")
    shared = written(members.join(lookup(sizes, pinned=False), "bucket"), "shared")
    pulls = shared.groupBy("node").agg(F.sum("members").alias("pull"))
    return written(shared.join(pulls, "node").select("bucket", "node", "n", "pull"), "buckets")


def _prefix_pairs(mixed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of ``mixed`` (node, root) with different roots that can reach the similarity, by prefix filtering.

    With shingles in one order, rare ones first, two sets of that similarity share one among their first few; where it can stand depends
    on both sizes. Any common order gives the same pairs in the end; this one counts shingles in a fixed number of slots.
    """
    own = written(mixed.join(sets, "node"), "mixed-shingles")
    slot = F.pmod(F.col("s"), F.lit(SLOTS))
    counted = own.select(F.explode("shingles").alias("s")).groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).collect()
    counts = np.zeros(SLOTS, dtype=np.int64)
    counts[[r["slot"] for r in counted]] = [r["n"] for r in counted]
    sent = own.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, held in enumerate(batch.column("shingles")):
                values = held.values.to_numpy(zero_copy_only=False)
                first = len(values) - int(np.ceil(similarity * len(values) - 1e-9)) + 1
                order = np.lexsort((values, sent.value[values % SLOTS]))[:first]
                rows += [(int(s), at, i, len(values)) for at, s in enumerate(values[order])]
            shingle, at, row, n = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [], [])
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shingle, pa.int64()), pa.array(at, pa.int32()), pa.array(n, pa.int32()),
                 batch.column("node").take(row), batch.column("root").take(row)],
                ["shingle", "at", "n", "node", "root"],
            )

    prefixes = written(
        own.select("node", "root", "shingles").mapInArrow(run, "shingle long, at int, n int, node binary, root binary"), "prefixes"
    )
    a, b = prefixes.alias("a"), prefixes.alias("b")
    least = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("a.n") + F.col("b.n")) - 1e-9)
    meets = (
        (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.root") != F.col("b.root")) & (F.col("a.node") < F.col("b.node"))
        & (F.col("a.at") <= F.col("a.n") - least) & (F.col("b.at") <= F.col("b.n") - least)
    )
    return a.join(b, meets).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def _classes(buckets: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of all nodes with a link."""
    centre = buckets.groupBy("bucket").agg(F.max(F.struct("pull", "node", "n")).alias("c"), F.count("*").alias("members"))
    near = buckets.join(centre, "bucket").filter(
        (F.col("node") != F.col("c.node")) & (F.least("n", "c.n") >= similarity * F.greatest("n", "c.n"))
    )
    pairs = near.groupBy(F.col("c.node").alias("a"), F.col("node").alias("b")).agg(F.max("c.pull").alias("pull"))
    links = written(_verified(pairs, sets, similarity), "links-centres")
    # a first idea of the classes: each node under its strongest centre, and that under its own; it only saves comparisons
    under = links.groupBy(F.col("b").alias("node")).agg(F.max(F.struct("pull", F.col("a").alias("root"))).alias("c"))
    under = written(under.select("node", "c.root"), "under")
    above = under.select(F.col("node").alias("root"), F.col("root").alias("top"))
    label = under.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    labelled = written(buckets.join(label, "node", "left").withColumn("root", F.coalesce("root", "node")), "labelled")
    mixed = labelled.groupBy("bucket").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")
    ).filter("low != high AND members > 2").select("bucket")
    mixed = lookup(written(mixed, "mixed-buckets"), pinned=False)
    rest = written(labelled.join(mixed, "bucket", "left_semi").groupBy("node").agg(F.first("root").alias("root")), "mixed")
    links = links.select("a", "b")
    if not rest.isEmpty():
        links = links.unionByName(_verified(_prefix_pairs(rest, sets, similarity), sets, similarity).select("a", "b"))
    return written(components(links), "classes")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, class_key, print) of every row.

    class_key tells classes apart even where ids repeat, and is null for null texts; print is ``xxhash64`` of the text.
    """
    with_python(docs.sparkSession)
    docs = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(text).cast("string")).alias("print"),
    )
    sketched = written(_sketched(docs), "sketches")
    nodes = written(
        sketched.filter("node IS NOT NULL").groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "nodes",
    )
    buckets = _shared_buckets(nodes)
    # the shingles of nodes that share a bucket, read from one document each
    involved = buckets.select("node").distinct()
    holders = nodes.join(involved, "node", "left_semi").select(F.col("doc_id").alias("holder")).distinct()
    held = docs.join(lookup(written(holders, "holders"), pinned=False), F.col("doc_id").eqNullSafe(F.col("holder")), "left_semi")
    sets = written(_shingled(held).groupBy("node").agg(F.first("shingles").alias("shingles")), "shingles")
    classes = _classes(buckets, sets, similarity)
    rooted = nodes.select("node", "doc_id").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    named = rooted.join(ids, "root").select("node", "class_id", F.hex("root").alias("class_key"))
    class_id = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    return sketched.select("doc_id", "print", "node").join(named, "node", "left").select("doc_id", class_id, "class_key", "print")


def dedup_near(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each class: the one with the smallest id, and only one row of it. Null texts all stay."""
    named = written(near_duplicates(docs, text, doc_id).filter("class_key IS NOT NULL"), "near-classes")
    first = named.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "print")).alias("first"))
    judged = named.groupBy("class_key", "doc_id", "print").agg(F.count("*").alias("rows")).join(first, "class_key")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("print") == F.col("first.print"))
    own, mark = fresh(docs, "own_id_"), fresh(docs, "print_")
    judged = judged.select(F.col("doc_id").alias(own), F.col("print").alias(mark), stays.alias("stays"), "rows")
    gone, repeated = (written(judged.filter(x).drop("stays", "rows"), "near-rows") for x in ("NOT stays", "stays AND rows > 1"))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(F.col(text).cast("string")) == F.col(mark))
    kept = docs.join(lookup(gone, pinned=False), same, "left_anti")
    # rows that repeat a kept one are few as a rule, so texts need no shuffle to find them
    repeated = lookup(repeated, pinned=False)
    once = kept.join(repeated, same, "left_semi").dropDuplicates([doc_id, text])
    return kept.join(repeated, same, "left_anti").unionByName(once).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text")).drop("print")
