"""Spelling variants against brute force: the index alone, hot keys cut into blocks, and whole texts."""

import random
import re
import zlib

import numpy as np
import pytest

from scanledger.llm import spelling
from tests.llm.data import documents, rows, with_clashes


def apart_by_one(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    return (out | {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}) - {word}


def brute_pairs(words):
    letters = set("".join(words))
    return {(w, x) for w in words for x in apart_by_one(w, letters) & set(words)}


def some_words(seed, n, letters="abcéÀ", longest=12):
    draw = random.Random(seed)
    return sorted({"".join(draw.choice(letters) for _ in range(draw.randint(5, longest))) for _ in range(n)})


@pytest.mark.parametrize("words", [some_words(1, 1500), ["aaaaa", "aaaaaa", "aaaaaaa"], ["abcde"], some_words(2, 200, "ab", 40)])
def test_index_finds_each_pair_once(words):
    every, found = np.ones(len(words)), []
    for backwards in (False, True):
        for batch in spelling.near_words(words, np.arange(len(words)), every, every, backwards):
            found += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
    assert len(found) == len(set(found)) and set(found) == brute_pairs(words)


def test_suffixes_are_in_order():
    draw = random.Random(9)
    for n in (1, 2, 50, 400):
        text = [draw.randint(1, 3) for _ in range(n)] + [0]
        assert list(spelling.suffix_array(np.array(text), 2)) == sorted(range(n + 1), key=lambda i: text[i:])


@pytest.mark.parametrize("part", [spelling.PART, 40])
def test_pairs_with_hot_keys(spark, monkeypatch, part):
    monkeypatch.setattr(spelling, "PART", part)
    monkeypatch.setattr(spelling, "ASKED_AT_ONCE", 64)
    words = sorted({"pre" + w + "ing" for w in some_words(4, 500, "abc", 8)} | set(some_words(5, 300, "abcdefg", 9)))
    table = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long")
    found = rows(spelling.near_pairs(table), "word", "near", "near_n")
    assert found == sorted(((a, b, words.index(b) + 3) for a, b in brute_pairs(words)), key=repr)


def brute(table):
    counts = {}
    for doc_id, text in table:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    letters = set("".join(counts))
    near = {w: [x for x in apart_by_one(w, letters) if x in counts] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_whole_texts(spark):
    draw = random.Random(8)
    base = some_words(6, 60, "abcdeÉß", 9)
    weights = [3 ** draw.randint(0, 5) for _ in base]
    table = []
    for i in range(300):
        words = [w if draw.random() < 0.9 else w[:2] + draw.choice("abcdeÉ") + w[3:] for w in draw.choices(base, weights, k=40)]
        table.append((i % 250 if i % 17 else None, draw.choice([" ", "-", "\n", "1", "\U0001f600"]).join(w.upper() if draw.random() < 0.1 else w for w in words)))
    table += [(1, None), (2, ""), (3, "... 12 3"), (7, "tiedaa tiedab tiedac " * 3), (7, "tiedaa tiedab tiedac " * 3), (9, "×÷×÷× Ünder ünder under " * 4)]
    table += [(11, "vowaaa " * 3 + "vowaab " * 7 + "vowabb " * 15)]
    table += [(i, "q" * 1_500 + " " + "q" * 1_501) for i in range(4)]
    found = rows(spelling.query(with_clashes(documents(spark, table))), *COLUMNS)
    assert found == brute(table)
    assert ("vowaaa", "vowaab", "vowabb", 3, 1, 7) in found  # a chain of forms


def test_no_words(spark):
    for table in ([], [(1, "a few tiny bits"), (None, None)]):
        assert spelling.query(documents(spark, table)).count() == 0
