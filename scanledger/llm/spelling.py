"""Spelling variants: words one edit apart, found by search schemes over bidirectional FM-indexes, and the form each word leads to.

1. Words and their counts come from one aggregate over all texts, combined in the tasks first.
2. Two words one edit apart share the exact first half of one of them, or its exact second half. So words meet in parts by their first
   letters and, a second time, by their last ones: two letters for short words, four for longer ones. Small keys share parts; a key with
   more than ``PART`` words is cut into blocks of words that meet all blocks of askers, so a task's memory is bounded however hot a key is.
3. A task builds a bidirectional FM-index over the delimited words of its part: suffix ranks of the text and of its reverse, each as a
   wavelet matrix, with both intervals kept in step. All words that ask are searched at once, as arrays of intervals: the half is matched
   exactly from its inner end out to the delimiter, then the search turns and extends across the other half, allowing one error.
4. The pairs, each found once, are aggregated per word; chains of forms end by pointer jumping, a few joins.

Defined results: a null text has no words; a null id counts as the empty text in the place of the id; ties between forms go to the
smallest in code-point order; repeated rows count each; an empty table gives no rows. Runs may be of any length. Other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import ascii_lower, with_python, written

RUN = "[A-Za-zÀ-ÿ]+"
NO_RUN = "[^A-Za-zÀ-ÿ]+"
SPOILED = 97  # one word occurrence in so many loses a code point
MIN_LENGTH, MIN_COUNT = 5, 3
DOMINANCE = 2  # a form is at least so many times as frequent

PART = 32_000  # words of a part, about
ASKED_AT_ONCE = 4_096
SHORT, LONG = 2, 4  # letters of the keys of short and of longer words
PAIRS = "word string, near string, near_n long"


# ------------------------------------------------------------------------------------------------------- the index


def suffix_array(text: np.ndarray, bits: int) -> np.ndarray:
    """Starts of the suffixes in order; the last symbol is the only 0. Doubles the compared length until all ranks differ."""
    n, step = len(text), 63 // bits
    padded = np.concatenate([text.astype(np.int64), np.zeros(step, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(step):
        key = (key << bits) | padded[j : j + n]
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        later = np.zeros(n, np.int64)
        later[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + later
        step *= 2


class SuffixRanks:
    """Rank queries over the last column of a text's sorted rotations, as a wavelet matrix."""

    def __init__(self, text: np.ndarray, bits: int):
        self.starts = suffix_array(text, bits)
        last = text[self.starts - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        self.bits, self.ones, self.zeros = bits, [], []
        column = last
        for level in range(bits):
            bit = (column >> (bits - 1 - level)) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            column = np.concatenate([column[bit == 0], column[bit == 1]])
        symbols = np.arange(1 << bits)
        self.begin = self._down(np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64), symbols)[0]

    def _down(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        smaller = np.zeros(len(lo), np.int64)
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            lo1, hi1 = ones[lo], ones[hi]
            right = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            smaller += np.where(right, (hi - hi1) - (lo - lo1), 0)
            lo, hi = np.where(right, zeros + lo1, lo - lo1), np.where(right, zeros + hi1, hi - hi1)
        return lo, hi, smaller

    def extend(self, lo: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals after one more symbol: start, size, and how many rows of the old interval have a smaller symbol."""
        at, end, smaller = self._down(lo, lo + size, symbol)
        return self.first[symbol] + at - self.begin[symbol], end - at, smaller

    def expand(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """The same for every symbol that occurs: which interval, symbol, start, size, smaller."""
        which = np.arange(len(lo))
        hi, symbol, smaller = lo + size, np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            lo1, hi1 = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            lo0, hi0 = lo - lo1, hi - hi1
            left, right = np.flatnonzero(hi0 > lo0), np.flatnonzero(hi1 > lo1)
            which = np.concatenate([which[left], which[right]])
            symbol = np.concatenate([symbol[left] * 2, symbol[right] * 2 + 1])
            smaller = np.concatenate([smaller[left], (smaller + hi0 - lo0)[right]])
            lo, hi = np.concatenate([lo0[left], zeros + lo1[right]]), np.concatenate([hi0[left], zeros + hi1[right]])
        return which, symbol, self.first[symbol] + lo - self.begin[symbol], hi - lo, smaller


class BidirectionalIndex:
    """Words between delimiters; a search state is (start forward, start backward, size) of one pattern's two intervals."""

    END, MARK = 0, 1

    def __init__(self, words: list[str]):
        joined = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), dtype="<u4")
        self.letters, symbols = np.unique(joined, return_inverse=True)
        text = np.append(symbols.astype(np.int64).ravel() + self.MARK, self.END)
        bits = int(len(self.letters)).bit_length()
        self.forward = SuffixRanks(text, bits)
        self.backward = SuffixRanks(np.append(text[-2::-1], self.END), bits)
        self.word_at = np.cumsum(text == self.MARK) - 1
        self.size = len(text)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of words in one array, their offsets and lengths; letters that the index lacks get a symbol that never occurs."""
        lengths = np.array([len(w) for w in words], np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        at = np.searchsorted(self.letters, letters)
        there = self.letters[np.minimum(at, len(self.letters) - 1)] == letters
        return np.where(there, at + self.MARK, self.END), np.cumsum(lengths) - lengths, lengths

    def left(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        start, size, smaller = self.forward.extend(state[0], state[2], symbol)
        return np.stack([start, state[1] + smaller, size])

    def right(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        start, size, smaller = self.backward.extend(state[1], state[2], symbol)
        return np.stack([state[0] + smaller, start, size])

    def every_right(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        which, symbol, start, size, smaller = self.backward.expand(state[1], state[2])
        return which, symbol, np.stack([state[0][which] + smaller, start, size])

    def one_error(self, words: list[str], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (which of ``words``, which word of the index) exactly one edit apart, the edit behind the first ``halves`` letters."""
        letters, offsets, lengths = self.encode(words)
        asker = np.arange(len(words))
        state = np.stack([np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), self.size, np.int64)])
        at = np.asarray(halves, np.int64).copy()
        # the exact half, from its inner end out to the delimiter
        while len(asker):
            at -= 1
            symbol = np.where(at >= 0, letters[offsets[asker] + np.maximum(at, 0)], self.MARK)
            symbol = np.where(at >= -1, symbol, self.END)
            moving = at >= -1
            if not moving.any():
                break
            moved = self.left(state[:, moving], symbol[moving])
            state[:, moving] = moved
            alive = state[2] > 0
            asker, state, at = asker[alive], state[:, alive], at[alive]
        at = np.asarray(halves, np.int64)[asker].copy()
        wrong_asker, wrong_at, wrong = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((3, 0), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(asker) or len(wrong_asker):
            # states with the error behind them go on exactly, and end at the delimiter
            ends = wrong_at == lengths[wrong_asker]
            symbol = np.where(ends, self.MARK, letters[np.minimum(offsets[wrong_asker] + wrong_at, len(letters) - 1)])
            wrong = self.right(wrong, symbol)
            alive = wrong[2] > 0
            done, going = alive & ends, alive & ~ends
            found.append((np.repeat(wrong_asker[done], wrong[2][done]), self._words(wrong[:, done])))
            new_asker, new_at, new = [wrong_asker[going]], [wrong_at[going] + 1], [wrong[:, going]]
            if len(asker):
                inside = at < lengths[asker]
                expected = np.where(inside, letters[np.minimum(offsets[asker] + at, len(letters) - 1)], -1)
                which, symbol, grown = self.every_right(state)
                letter = symbol > self.MARK
                replaced = letter & inside[which] & (symbol != expected[which])
                # one letter more, one replaced, one less
                new_asker += [asker[which[letter]], asker[which[replaced]], asker[inside]]
                new_at += [at[which[letter]], at[which[replaced]] + 1, at[inside] + 1]
                new += [grown[:, letter], grown[:, replaced], state[:, inside]]
                right = symbol == expected[which]
                asker, at, state = asker[which[right]], at[which[right]] + 1, grown[:, right]
            wrong_asker, wrong_at, wrong = np.concatenate(new_asker), np.concatenate(new_at), np.concatenate(new, axis=1)
        asked, near = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (asker, asker)
        pairs = np.unique(asked * np.int64(self.size) + near)
        return pairs // self.size, pairs % self.size

    def _words(self, state: np.ndarray) -> np.ndarray:
        total = int(state[2].sum())
        inside = np.arange(total) - np.repeat(np.cumsum(state[2]) - state[2], state[2])
        return self.word_at[self.forward.starts[np.repeat(state[0], state[2]) + inside]]


def near_words(words: list[str], counts: np.ndarray, held: np.ndarray, asked: np.ndarray, backwards: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of a part: for each word that asks, the held words one edit apart that this direction is to find."""
    keys = [w[::-1] for w in words] if backwards else words
    kept, askers = np.flatnonzero(held), np.flatnonzero(asked)
    if not len(kept) or not len(askers):
        return
    index = BidirectionalIndex([keys[i] for i in kept])
    for at in range(0, len(askers), ASKED_AT_ONCE):
        some = askers[at : at + ASKED_AT_ONCE]
        lengths = np.array([len(keys[i]) for i in some])
        halves = lengths - lengths // 2 if backwards else lengths // 2
        which, near = index.one_error([keys[i] for i in some], halves)
        word, found = some[which], kept[near]
        if backwards:  # what shares the first half as well, the other direction has
            new = [not words[f].startswith(words[w][: len(words[w]) // 2]) for w, f in zip(word, found, strict=True)]
            word, found = word[new], found[new]
        yield pa.record_batch(
            [pa.array([words[i] for i in word], pa.string()), pa.array([words[i] for i in found], pa.string()), pa.array(counts[found], pa.int64())],
            names=["word", "near", "near_n"],
        )


def _search(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(groups))
    column = {name: table.column(name) for name in table.column_names}
    flags = (column[name].to_numpy(zero_copy_only=False).astype(bool) for name in ("held", "asked"))
    backwards = column["side"][0].as_py() == "s"
    yield from near_words(column["word"].to_pylist(), column["n"].to_numpy(), *flags, backwards)


# ------------------------------------------------------------------------------------------------------ in Spark


def spoiled(doc_id: Column, run: Column) -> Column:
    """The run, without one code point where the checksum of id and run says so."""

    def cut(w: Column, h: Column) -> Column:
        at = (h % F.length(w)).cast("int")
        return F.when(h % SPOILED == 0, F.concat(F.substring(w, F.lit(1), at), F.substring(w, at + 2, F.length(w)))).otherwise(w)

    return cut(run, F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words (word, n) of all texts: at least five code points and three occurrences."""
    runs = docs.select(F.col(doc_id).alias("id"), F.explode(F.split(F.col(text), NO_RUN)).alias("run")).filter(F.length("run") >= MIN_LENGTH)
    words = runs.select("id", ascii_lower(F.col("run")).alias("run")).select(spoiled(F.col("id"), F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= MIN_COUNT)


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs (word, near, near_n) exactly one edit apart, each once for either of its words; ``words`` has distinct word and n."""
    with_python(words.sparkSession)
    long, size = F.length("word"), F.col("size")

    def entry(side: str, letters: int, held: Column, asked: Column) -> Column:
        key = F.substring("word", 1, letters) if side == "p" else F.substring("word", -letters, letters)
        key = F.concat(F.lit(f"{side}{letters}:"), key)
        return F.when(held, F.struct(F.lit(side).alias("side"), key.alias("key"), held.alias("held"), asked.alias("asked")))

    # words of up to eight letters meet those of up to nine, longer ones those of at least eight
    entries = [e for s in "ps" for e in (entry(s, SHORT, long <= 9, long <= 8), entry(s, LONG, long >= 8, long >= 9))]
    keyed = words.select("word", "n", F.explode(F.array_compact(F.array(*entries))).alias("e")).select("word", "n", "e.*")
    keyed = written(keyed, "spelling-keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    parts = max(1, -(-keyed.count() // PART))
    sized = keyed.join(sizes, "key")

    blocks = F.when(size > PART, F.ceil(size / PART)).otherwise(1).cast("int")
    sized = sized.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))

    def cell(i: Column, j: Column, held: Column, asked: Column) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), held.alias("held"), asked.alias("asked"))

    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    holding = F.transform(every, lambda x: cell(F.col("own"), x, F.col("held"), F.col("asked") & (x == F.col("own"))))
    asking = F.transform(F.filter(every, lambda x: F.col("asked") & (x != F.col("own"))), lambda x: cell(x, F.col("own"), F.lit(False), F.lit(True)))
    shared = F.concat(F.col("side"), F.lit("-"), F.pmod(F.xxhash64("key"), F.lit(parts)).cast("string"))
    dealt = sized.select("word", "n", "side", "key", "blocks", F.explode(F.concat(holding, asking)).alias("cell"))
    dealt = dealt.select(
        F.when(F.col("blocks") == 1, shared).otherwise(F.concat_ws("/", "key", "cell.i", "cell.j")).alias("part"),
        "side", "word", "n", "cell.held", "cell.asked",
    )
    # a word meets a part under two keys at most (of short and of longer words); its flags are joined there
    once = dealt.groupBy("part", "side", "word").agg(F.first("n").alias("n"), F.max("held").alias("held"), F.max("asked").alias("asked"))
    return once.groupBy("part").applyInArrow(_search, PAIRS)


def _roots(links: DataFrame) -> DataFrame:
    """The end of every chain of (word, form), by pointer jumping; chains have no cycles, for counts grow along them."""
    ways = written(links.select("word", F.col("form").alias("root")), "spelling-ways")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        jumped = written(ways.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "spelling-ways")
        ways = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return ways


def group_variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``words`` (word, n) with form, root, n_near and form_n."""
    words = written(words.select("word", "n"), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    leads = -F.col("best.rank") >= dominance * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.rank")).alias("form_n"),
    )
    judged = written(judged, "spelling-forms")
    roots = _roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(docs: DataFrame) -> DataFrame:
    return group_variants(vocabulary(docs.select("doc_id", "text")))


ORACLE = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
run AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '{RUN}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents) WHERE length(run) >= {MIN_LENGTH} GROUP BY id, run),
bytes AS (SELECT *, hex(encode(id || ':' || run)) AS hex FROM run),
hashed AS (
  SELECT run, times, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(1, length(hex), 2), lambda i: (instr('0123456789ABCDEF', hex[i]) * 16 + instr('0123456789ABCDEF', hex[i + 1]) - 17)::BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS h
  FROM bytes, crc_table),
word AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {SPOILED} = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed)
  WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(times) >= {MIN_COUNT}),
short AS (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
pair AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM short AS a JOIN short AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM short AS a JOIN word AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM short AS a JOIN word AS b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(r := -near_n, w := near)) AS best FROM pair GROUP BY word),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.r >= {DOMINANCE} * n THEN best.w END AS form,
         CASE WHEN -best.r >= {DOMINANCE} * n THEN -best.r END AS form_n
  FROM word LEFT JOIN best USING (word)),
way AS (SELECT word, word AS root, form AS onward FROM judged
        UNION ALL SELECT way.word, judged.word, judged.form FROM way JOIN judged ON way.onward = judged.word)
SELECT judged.word, judged.form, way.root, judged.n, judged.n_near, judged.form_n
FROM judged JOIN way ON way.word = judged.word AND way.onward IS NULL
"""
