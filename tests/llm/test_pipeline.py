"""The pipeline's stages one by one against restatements in plain Python, on whole tables."""

import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scanledger.llm import quality
from tests.llm.data import changed, prose
from tests.llm.test_texts import brute_repeats

SF_DIR = "/root/testdata/sf0.001"
BLANK = r"[\x20\x09-\x0D]+"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text or "")) if w]


def good_line(line):
    words = [w for w in re.split(BLANK, line) if w]
    if not words:
        return True
    separators = sum(bool(re.fullmatch("[|>»›•·]+", w)) for w in words)
    symbols = len(re.findall("[#*$%&|<>]", line))
    boilerplate = re.search(quality.BOILERPLATE, line) and len(words) <= 40
    ends = re.search(r"[.!?…。][\"')\]”’»]*([\x20\x09-\x0D]|$)", line)
    return bool(ends) and not (separators >= 3 and separators * 8 >= len(words)) and symbols * 3 <= len(words) and not boilerplate


def quality_rules(docs):
    out = []
    for i, text in docs:
        words = [w for w in re.split(BLANK, text or "") if w]
        if len(words) < 50 or 100 * brute_repeats(text) > 50 * len(words):
            continue
        clean = "\n".join(line for line in text.split("\n") if good_line(line))
        chars = lambda t: len(re.sub(BLANK, "", t))
        if chars(text) - chars(clean) <= quality.MAX_LOST * chars(text):
            out.append((i, clean))
    return out


def line_dedup(docs):
    key = lambda line: lowered(line.strip("\x20\t\n\x0b\x0c\r"))
    holders = {}
    for i, text in docs:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= 20 and i is not None:
                holders.setdefault(k, set()).add(i)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= 3}
    return [(i, text and "\n".join(line for line in text.split("\n") if i is None or last.get(key(line), i) <= i)) for i, text in docs]


def near_dedup(docs):
    sets = []
    for _, text in docs:
        w = words_of(text)
        n = min(5, len(w))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else {text})
    root = list(range(len(docs)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and shared >= 0.8 * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    first = {}
    for k, (i, _) in enumerate(docs):
        first[top(k)] = min(first.get(top(k), i), i)
    return [d for k, d in enumerate(docs) if first[top(k)] == d[0]]


def decontaminated(docs, items):
    windows = {}
    for w in map(words_of, items):
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(len(w[k : k + 10]), set()).add(tuple(w[k : k + 10]))
    clean = []
    for i, text in docs:
        w = words_of(text)
        if not any(tuple(w[k : k + n]) in held for n, held in windows.items() for k in range(len(w) - n + 1)):
            clean.append((i, text))
    return clean


@pytest.fixture(scope="module")
def documents(spark):
    """The small table, and rows that each stage decides about."""
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").filter("text IS NOT NULL").first().text
    base, line = prose(77, 200), "This very line stands in a number of documents."
    texts = [base, changed(base, 20), changed(base, 100), base, prose(78, 90) + "\n" + item + ".", prose(79, 3_000), None, "", "too short."]
    texts += [prose(80 + i, 80) + "\n" + line for i in range(4)]
    odd = [(100_000 + i, t, "en", "odd", 0) for i, t in enumerate(texts)]
    return given.unionByName(spark.createDataFrame(odd, given.schema)).cache()


def test_stages_by_brute_force(spark, documents):
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").collect()]
    restated = [quality_rules, line_dedup, near_dedup, lambda docs: decontaminated(docs, items)]
    docs = documents
    for (name, stage), brute in zip(corpus_pipeline.STAGES, restated, strict=False):
        given = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == documents.columns
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(brute(given)), name
        assert name == "line_dedup" or docs.count() < len(given), name

    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {r.doc_id: len(model.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect()}
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF_DIR)
    totals = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert totals == lengths
    sequences = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 1024 for r in sequences)
    assert len(sequences) <= 1.05 * sum(lengths.values()) / 1024 + 2
