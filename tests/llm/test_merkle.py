"""The Merkle manifest against a tree built row by row."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from scanledger.llm import merkle
from tests.llm.data import CLASHING

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """The top of a list of nodes, and for each the (left, right) siblings on its way."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, p in enumerate(at):
            first = p - p % 16
            paths[i].append(("".join(level[first:p]), "".join(level[p + 1 : first + 16])))
        level = [digest("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        at = [p // 16 for p in at]
    return level[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        held = sorted(by[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = held, *climb([leaf(r) for r in held])
    root, up = climb([trees[s][1] for s in order])
    out = []
    for source, above in zip(order, up, strict=True):
        held, subroot, paths = trees[source]
        for r, path in zip(held, paths, strict=True):
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf((*r[:4], text))
            for left, right in path + above:
                node = digest(left + node + right)
            proof = digest("".join(left + right for left, right in path + above))
            out.append((r[0], leaf(r), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def test_edges(spark):
    rows = [
        (i, s, "en" if i % 3 else None, i, f"Text {i}É")
        for s, n in (("a", 1), ("b", 2), ("", 16), ("é", 17), (None, 18), ("z\U0001f600", 256), ("hot", 600)) for i in range(n)
    ]
    rows += [(None, "b", None, None, None), (5, "b", "", 0, ""), (5, "b", "", 0, ""), (5, "b", None, 0, None), (5, "b", None, 0, ""), (9, "b", "x", 1, "Q" * 200_000)]
    df = spark.createDataFrame(rows, DOCS).select("*", *(F.lit(i).alias(c) for i, c in enumerate((*CLASHING, "grp", "pos", "size", "kept", "top", "proof"))))
    assert found(merkle.query(df)) == brute(rows)


def test_one_row_and_none(spark):
    one = [(3, "s", "en", 1, "A")]
    assert found(merkle.query(spark.createDataFrame(one, DOCS))) == brute(one)
    empty = merkle.query(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and "verified" in empty.columns


def test_tampering_is_found(spark):
    rows = [(i, "s", "en", 1, "Capital" if i % 2 else "small") for i in range(300)]
    bad = {r.doc_id for r in merkle.query(spark.createDataFrame(rows, DOCS)).filter(~F.col("verified")).collect()}
    assert bad == {i for i in range(300) if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0}


@pytest.mark.parametrize("groups", [1, 300])
def test_many_levels(spark, groups):
    """Five levels in one group, or a tree of groups two blocks wide."""
    n = 70_000 if groups == 1 else 3_000
    leaves = spark.range(n).select("id", (F.col("id") % groups).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    out = merkle.manifest(leaves, "g", ["id"], keep=["id"])
    roots = out.select("root").distinct().collect()
    tops = [climb([digest(str(i)) for i in range(g, n, groups)])[0] for g in range(groups)]
    assert [r.root for r in roots] == [climb(tops)[0]]
    assert out.filter(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert out.select("id").distinct().count() == n
