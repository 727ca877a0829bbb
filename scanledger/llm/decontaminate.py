"""Benchmark decontamination: find every ten-word window of the test texts in the training texts.

Words are runs of digits, a-z and non-ASCII characters after A-Z are lower-cased. A window is ten words in a row; an item with one to nine
words is one window of that many. Everything is DataFrame functions:

1. The distinct windows of the benchmark become a hash set that is broadcast while it is counted small (``session.lookup``);
   beyond that the same join shuffles.
2. Every document's windows are hashed where the document lies and probed against the set. Only hits leave the task.
3. Hits go back to their documents and are verified word by word; documents without hits are not shuffled with their texts.

Defined results: a null text, and a text without words, has no windows, as document or as item. Windows of an item whose id is null count
as hits, but the item is not listed. Repeated items are one item, repeated documents are judged each. Empty tables: no rows, or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import ascii_lower, fresh, let, written
from scanledger.session import lookup

WINDOW = 10
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _hashes(w: Column, size: int) -> Column:
    """Hash of the window at each position of the words ``w``."""
    own = F.transform(w, lambda x: F.xxhash64(x))
    return let(
        own,
        lambda h: F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (size - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, size))),
        ),
    )


def windows(items: DataFrame, text: str = "text", item_id: str = "item_id", size: int = WINDOW) -> DataFrame:
    """(item_id, width, hash, phrase) of every window of the benchmark."""
    own = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(size))
    phrases = own.select(
        "item_id", width.alias("width"),
        F.explode(let(F.col("w"), lambda w: F.transform(
            F.sequence(F.lit(1), F.size(w) - F.least(F.size(w), F.lit(size)) + 1),
            lambda i: F.slice(w, i, F.least(F.size(w), F.lit(size))),
        ))).alias("part"),
    )
    chained = F.lit(None).cast("long")
    for k in range(1, size + 1):
        chained = F.when(F.col("width") == k, F.element_at(_hashes(F.col("part"), k), 1)).otherwise(chained)
    return phrases.select("item_id", "width", chained.alias("hash"), F.array_join("part", " ").alias("phrase")).distinct()


def find_hits(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = WINDOW) -> DataFrame:
    """(doc_id, print, n_words, hits) of every row: hits are the verified windows as (at, width, phrase), by position.

    ``print`` is ``xxhash64`` of the text, which tells rows with the same id apart.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("print"))
    own = lookup(windows(items, size=size).select("width", "hash", "phrase").distinct())
    widths = sorted(r["width"] for r in own.select("width").distinct().collect())  # at most ``size`` numbers
    if not widths:
        empty = F.array().cast("array<struct<at:int,width:int,phrase:string>>")
        return docs.select("doc_id", "print", F.size(words(F.col("text"))).cast("long").alias("n_words"), empty.alias("hits"))
    hashed = docs.select(
        "doc_id", "print",
        F.explode(let(words(F.col("text")), lambda w: F.array(*(
            F.struct(F.lit(k).alias("width"), _hashes(w, k).alias("hashes")) for k in widths
        )))).alias("by"),
    )
    placed = hashed.select("doc_id", "print", F.col("by.width").alias("width"), F.posexplode("by.hashes").alias("at", "hash"))
    likely = placed.join(own, ["hash", "width"]).groupBy("doc_id", "print").agg(
        F.collect_set(F.struct("at", "width", "phrase")).alias("likely")
    )
    likely = written(likely, "window-hits").select(
        F.col("doc_id").alias("hit_id"), F.col("print").alias("hit_print"), F.sort_array("likely").alias("likely")
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("print") == F.col("hit_print"))
    # only documents with a hit are dealt out with their texts; the narrow keys find them where they lie
    held = docs.join(lookup(likely.select("hit_id", "hit_print")), same, "left_semi").dropDuplicates(["doc_id", "print"])
    verified = let(
        words(F.col("text")),
        lambda w: F.filter("likely", lambda x: F.array_join(F.slice(w, x["at"] + 1, x["width"]), " ") == x["phrase"]),
    )
    hits = held.join(likely, same).select("hit_id", "hit_print", verified.alias("hits"))
    counted = docs.select("doc_id", "print", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<struct<at:int,width:int,phrase:string>>")
    return counted.join(hits, same, "left").select("doc_id", "print", "n_words", F.coalesce("hits", none).alias("hits"))


def _covered(hits: Column) -> Column:
    """Words inside any of the windows, which come sorted by position."""
    end = lambda x: x["at"] + x["width"]
    return F.aggregate(
        hits, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], end(x)).alias("end"),
            (a["n"] + F.greatest(F.lit(0), end(x) - F.greatest(a["end"], x["at"]))).alias("n"),
        ),
        lambda a: a["n"],
    )


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids) of every row; item_ids are strings in order."""
    items = items.select("item_id", "text")
    found = written(find_hits(docs, items, text, doc_id, size), "verified-hits")
    # windows and not hits meet the items, once per document
    met = found.filter(F.size("hits") > 0).select(
        "doc_id", "print", F.explode(F.array_distinct(F.transform("hits", lambda x: x["phrase"]))).alias("phrase")
    ).distinct()
    owners = lookup(windows(items, size=size).filter("item_id IS NOT NULL").select("phrase", F.col("item_id").cast("string").alias("item_id")))
    listed = met.join(owners, "phrase").groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    listed = listed.select(F.col("doc_id").alias("hit_id"), F.col("print").alias("hit_print"), "item_ids")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("print") == F.col("hit_print"))
    return found.join(listed, same, "left").select(
        "doc_id", "n_words", _covered(F.col("hits")).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = WINDOW) -> DataFrame:
    """The documents without any window of the benchmark."""
    hit, mark = fresh(docs, "hit_id_"), fresh(docs, "hit_print_")
    found = find_hits(docs, items.select("item_id", "text"), text, doc_id, size).filter(F.size("hits") > 0)
    gone = found.select(F.col("doc_id").alias(hit), F.col("print").alias(mark)).distinct()
    same = F.col(doc_id).eqNullSafe(F.col(hit)) & (F.xxhash64(F.col(text)) == F.col(mark))
    return docs.join(lookup(gone), same, "left_anti")


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = contamination(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
item AS (
  SELECT item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS width, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
pos AS (
  SELECT row_id, i, width, array_to_string(w[i : i + width - 1], ' ') AS phrase
  FROM (SELECT row_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM doc, (SELECT DISTINCT width FROM win) WHERE len(w) >= width)),
hit AS (SELECT row_id, i, width, item_id FROM pos JOIN win USING (width, phrase)),
cover AS (SELECT row_id, count(DISTINCT i + d) AS n FROM (SELECT row_id, i, unnest(range(0, width)) AS d FROM hit) GROUP BY row_id),
own AS (SELECT row_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY row_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM doc LEFT JOIN cover USING (row_id) LEFT JOIN own USING (row_id)
"""
