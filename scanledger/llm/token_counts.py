"""Word-piece counts by a linear longest-match automaton.

The vocabulary becomes a trie. Each trie node carries a failure link (where matching goes on after the longest piece has been taken
off) and the number of pieces taken off by following it, so greedy longest-match-first tokenization of a word is one walk over its
bytes that only adds numbers; no piece is ever built. Words met before are counted from memory.

Defined results: a null text counts as an empty one (0 words, 0 tokens). A word that the vocabulary cannot cover is one unknown token.
Repeated rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import with_python

CACHED_WORDS = 300_000  # per Python worker; the cache starts anew when full

# a blank belongs to the word behind it; letters, digits, other signs and other white space are words of their own
WORD = re.compile(r" ?[^\W\d_]+| ?\d+| ?[^\s\w]+| ?_+|\s")


class PieceAutomaton:
    """Greedy longest-match counts over bytes, with one vocabulary for word starts and one for what follows."""

    def __init__(self, start: Iterable[bytes], inside: Iterable[bytes] | None = None):
        self.children: list[dict[int, int]] = [{}]
        self.is_piece = [False]
        self.start = 0
        self._add(0, start)
        if inside is None:
            self.inside = 0
        else:
            self.inside = self._node()
            self._add(self.inside, inside)
        self._link()

    def _node(self) -> int:
        self.children.append({})
        self.is_piece.append(False)
        return len(self.children) - 1

    def _add(self, root: int, pieces: Iterable[bytes]) -> None:
        for piece in pieces:
            at = root
            for byte in piece:
                at = self.children[at].setdefault(byte, len(self.children))
                if at == len(self.children):
                    self._node()
            self.is_piece[at] = at != root

    def _link(self) -> None:
        """Failure links and popped counts, nodes nearer the roots first. A link of -1: nothing can be taken off, the word is unknown."""
        self.fail = [-1] * len(self.children)
        self.popped = [0] * len(self.children)
        level = sorted({self.start, self.inside})
        while level:
            below = []
            for parent in level:
                for byte, at in self.children[parent].items():
                    below.append(at)
                    if self.is_piece[at]:
                        self.fail[at], self.popped[at] = self.inside, 1
                        continue
                    link, count = self.fail[parent], self.popped[parent]
                    while link >= 0 and byte not in self.children[link]:
                        count += self.popped[link]
                        link = self.fail[link]
                    if link >= 0:
                        self.fail[at], self.popped[at] = self.children[link][byte], count
            level = below

    def count(self, word: bytes) -> int:
        """Pieces of the word, or -1 if the vocabulary cannot cover it."""
        children, fail, popped = self.children, self.fail, self.popped
        at, total = self.start, 0
        for byte in word:
            while (following := children[at].get(byte)) is None:
                total += popped[at]
                at = fail[at]
                if at < 0:
                    return -1
            at = following
        while at != self.inside and at != self.start:
            total += popped[at]
            at = fail[at]
            if at < 0:
                return -1
        return total


def byte_vocabulary(path: str) -> list[bytes]:
    """Pieces of a file of base64 pieces with their ranks."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every whole text; ``vocabulary`` is the path of the pieces, as each task sees it."""
    with_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = PieceAutomaton(byte_vocabulary(vocabulary))
        known: dict[str, int] = {}
        for batch in batches:
            words, tokens, unknown = [], [], []
            for body in batch.column(1):
                found = WORD.findall(body.as_py() or "")
                if len(known) > CACHED_WORDS:
                    known.clear()
                try:
                    counts = [known[w] for w in found]
                except KeyError:
                    for w in found:
                        if w not in known:
                            known[w] = automaton.count(w.encode())
                    counts = [known[w] for w in found]
                lost = counts.count(-1)
                words.append(len(counts))
                tokens.append(sum(counts) + 2 * lost)
                unknown.append(lost)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                ["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return count_tokens(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
