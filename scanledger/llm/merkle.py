"""Merkle manifest of a dataset: one root that certifies every row, and for each row the siblings that lead to it.

Rows become leaves (SHA-256 in lower-case hex). Inside a group, leaves follow an order; every 16 consecutive nodes become their hash
until one is left, the group's subroot. The subroots, in the order of the groups, become the root the same way.

A level of the tree is never a table of nodes. Aligned blocks of 256 nodes keep their level as one hex string of 64 characters a node;
parents are hashes of fixed-width substrings, siblings are the substrings beside a node, and two levels are climbed inside the row. The
blocks' own hashes are the nodes of the next round, so 10^11 leaves of one group take five rounds. Ranks come from ranges of the order,
hence a group that holds a third of all rows is never sorted in one task. Texts are hashed where they lie; only hashes are shuffled.

Defined results: null values have a mark of their own (``-``), so null and the empty text differ; a group of one leaf has no siblings
inside it; null groups come first; rows that agree in order and hash are interchangeable; a null id comes first and is never tampered
with; an empty table gives no rows. Other columns of the input are never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import ascii_lower, written
from scanledger.operators.ordering import ordered_position
from scanledger.session import lookup

FAN = 16
BLOCK = FAN * FAN
WIDTH = 64
RANGE_ROWS = 20_000  # rows that one task ranks, about

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"


def leaf_hash(values: Sequence[Column]) -> Column:
    """Hash of a row: each value as ``-`` if null, else its bytes' count, a colon and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (v.cast("string") for v in values)]
    return F.sha2(F.concat(*parts), 256)


def _parents(level: Column) -> Column:
    """The next level: one hash for each run of 16 nodes, the last run being what is left."""
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / (FAN * WIDTH)).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * FAN * WIDTH + 1, F.lit(FAN * WIDTH)), 256)), "")


def _flanks(level: Column, at: Column) -> Column:
    """What stands beside node ``at`` in its run: the strings to its left and right."""
    inside = at % FAN
    return F.struct(
        F.substring(level, (at - inside) * WIDTH + 1, inside * WIDTH).alias("left"),
        F.substring(level, (at + 1) * WIDTH + 1, (F.lit(FAN - 1) - inside) * WIDTH).alias("right"),
    )


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_text(proof: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _climb(nodes: DataFrame, most: int) -> DataFrame:
    """``nodes`` (grp, pos, size of the group, node, kept) with ``top``, the hash their group ends in, and ``proof``, the path to it.

    ``most`` is the largest group's size. Positions of a group run from 0 without gaps.
    """
    if most <= 1:
        return nodes.select("grp", "pos", "node", "kept", F.col("node").alias("top"), F.array().cast(PROOF).alias("proof"))
    block = F.floor(F.col("pos") / BLOCK).cast("long").alias("block")
    gathered = nodes.groupBy("grp", block).agg(
        F.sort_array(F.collect_list(F.struct("pos", "node", "kept"))).alias("items"), F.first("size").alias("size")
    )
    one = F.array_join(F.transform("items", lambda x: x["node"]), "")
    blocks = written(gathered.withColumn("low", one), "merkle")
    levels = blocks.withColumn("high", F.when(F.col("size") > 1, _parents(F.col("low"))))
    end = F.when(F.col("size") <= 1, F.col("low")).when(F.col("size") <= FAN, F.col("high")).otherwise(_parents(F.col("high")))
    size = F.when(F.col("size") <= BLOCK, F.lit(1).cast("long")).otherwise(F.ceil(F.col("size") / BLOCK))
    above = levels.select("grp", F.col("block").alias("pos"), size.alias("size"), end.alias("node"), F.lit(0).alias("kept"))
    up = _climb(above, -(-most // BLOCK)).select(F.col("grp").alias("up_grp"), F.col("pos").alias("up_pos"), "top", "proof")
    met = levels.join(up, F.col("grp").eqNullSafe(F.col("up_grp")) & (F.col("block") == F.col("up_pos")))
    opened = met.select("grp", "size", "low", "high", "top", "proof", F.posexplode("items").alias("at", "item"))
    own = (
        F.when(F.col("size") <= 1, F.array().cast(PROOF))
        .when(F.col("size") <= FAN, F.array(_flanks(F.col("low"), F.col("at"))))
        .otherwise(F.array(_flanks(F.col("low"), F.col("at")), _flanks(F.col("high"), F.floor(F.col("at") / FAN).cast("int"))))
    )
    return opened.select("grp", "item.pos", "item.node", "item.kept", "top", F.concat(own, "proof").alias("proof"))


def manifest(leaves: DataFrame, group: str, order: Sequence[str], leaf: str = "leaf", keep: Sequence[str] = ()) -> DataFrame:
    """Rows with the columns ``keep``, the leaf, its group's ``subroot``, the ``root`` of all and the ``proof``.

    A proof is an array of (left, right), one entry a level from the leaf to the root: the siblings' hashes as one string each. The
    groups' own count may grow with the data too: their subroots are ranked and climbed like leaves.
    """
    slim = leaves.select(
        F.col(group).alias("grp"), *(F.col(c).alias(f"ord_{i}") for i, c in enumerate(order)), F.col(leaf).alias("node"),
        F.struct(*(F.col(c) for c in keep)).alias("kept") if keep else F.lit(0).alias("kept"),
    )
    slim = written(slim, "leaves")
    sizes = written(slim.groupBy(F.col("grp").alias("size_grp")).agg(F.count(F.lit(1)).alias("size")), "sizes")
    most = sizes.agg(F.max("size")).first()[0] or 0
    placed = ordered_position(slim, ["grp"], [f"ord_{i}" for i in range(len(order))] + ["node"], "pos", target_rows=RANGE_ROWS)
    nodes = placed.join(lookup(sizes, pinned=False), F.col("grp").eqNullSafe(F.col("size_grp")))
    climbed = _climb(nodes.select("grp", "pos", "size", "node", "kept"), most)

    tops = written(climbed.filter(F.col("pos") == 0).select("grp", F.col("top").alias("node")), "subroots")
    count = tops.count()
    ranked = ordered_position(tops, [], ["grp"], "pos", target_rows=RANGE_ROWS)
    whole = _climb(
        ranked.select(F.lit(0).alias("grp"), "pos", F.lit(count).cast("long").alias("size"), "node", F.struct("grp").alias("kept")), count
    )
    roots = lookup(
        whole.select(F.col("kept.grp").alias("top_grp"), F.col("top").alias("root"), F.col("proof").alias("to_root"))
    )
    met = climbed.join(roots, F.col("grp").eqNullSafe(F.col("top_grp")))
    fields = [F.col("kept")[c].alias(c) for c in keep]
    return met.select(
        *fields, F.col("node").alias(leaf), F.col("top").alias("subroot"), "root", F.concat("proof", "to_root").alias("proof")
    )


def query(docs: DataFrame) -> DataFrame:
    values = {c: F.col(c) for c in LEAF_COLUMNS}
    tampers = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    changed = F.when(tampers, leaf_hash([*(values | {"text": ascii_lower(F.col("text"))}).values()]))
    leaves = docs.select("doc_id", "source", leaf_hash([*values.values()]).alias("leaf"), changed.alias("changed"))
    found = manifest(leaves, "source", ["doc_id"], keep=["doc_id", "changed"])
    folded = fold(F.coalesce("changed", "leaf"), F.col("proof"))
    out = found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"), folded.alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(levels: int = 6) -> str:
    """SQL that builds the tree level by level as tables; ``levels`` of 16 cover 16^6 leaves a group."""

    def tree(prefix: str, start: str) -> str:
        steps = [f"{prefix}0 AS ({start})"]
        for k in range(levels):
            steps.append(f"""
{prefix}r{k} AS (SELECT g, p // 16 AS p, first(n) AS n, string_agg(h, '' ORDER BY p) AS run FROM {prefix}{k} WHERE n > 1 GROUP BY g, p // 16),
{prefix}{k + 1} AS (SELECT g, p, (n + 15) // 16 AS n, sha256(run) AS h FROM {prefix}r{k} UNION ALL SELECT g, p, n, h FROM {prefix}{k} WHERE n = 1)""")
        return ",".join(steps)

    def path(prefix: str, at: str) -> tuple[list[str], list[str], list[str]]:
        joins, lefts, rights = [], [], []
        for k in range(levels):
            own = f"({at} // {16**k})"
            joins.append(f"LEFT JOIN {prefix}r{k} AS {prefix}j{k} ON {prefix}j{k}.g IS NOT DISTINCT FROM g AND {prefix}j{k}.p = {own} // 16")
            lefts.append(f"coalesce(substring({prefix}j{k}.run, 1, ({own} % 16) * 64), '')")
            rights.append(f"coalesce(substring({prefix}j{k}.run, ({own} % 16) * 64 + 65), '')")
        return joins, lefts, rights

    value = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"
    names = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "text"]
    row = " || ".join(value.format(n) for n in names)
    low = " || ".join(value.format(n) for n in [*names[:4], "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"])
    joins, lefts, rights = path("a", "x.p")
    more, more_l, more_r = path("b", "x.sp")
    lefts, rights = lefts + more_l, rights + more_r
    flanks = ", ".join(f"{l} AS l{i}, {r} AS r{i}" for i, (l, r) in enumerate(zip(lefts, rights, strict=True)))
    at_top = [f"aj{k}.p IS NOT NULL" for k in range(levels)] + [f"bj{k}.p IS NOT NULL" for k in range(levels)]
    exists = ", ".join(f"{e} AS e{i}" for i, e in enumerate(at_top))
    folds = "".join(f", f{i + 1} AS (SELECT *, CASE WHEN e{i} THEN sha256(l{i} || v{i} || r{i}) ELSE v{i} END AS v{i + 1} FROM f{i})" for i in range(2 * levels))
    joins_a = "\n".join(joins).replace("DISTINCT FROM g ", "DISTINCT FROM x.g ")
    joins_b = "\n".join(more).replace("IS NOT DISTINCT FROM g ", "= 0 ")
    return f"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
base AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, sha256({row}) AS leaf, sha256({low}) AS lowered,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
             lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 5 = 0 AS tampered
  FROM documents, crc_table),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY source) AS n,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS sp FROM base),
{tree("a", "SELECT source AS g, p, n, leaf AS h FROM ranked")},
tops AS (SELECT g, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS sp, count(*) OVER () AS n FROM a{levels}),
{tree("b", "SELECT 0 AS g, sp AS p, n, h FROM tops")},
x AS (SELECT doc_id, source AS g, p, sp, leaf, CASE WHEN tampered THEN lowered ELSE leaf END AS v0 FROM ranked),
f0 AS (SELECT x.*, tops.h AS subroot, b{levels}.h AS root, {flanks}, {exists} FROM x JOIN tops USING (sp) CROSS JOIN b{levels}
{joins_a}
{joins_b}){folds}
SELECT doc_id, leaf, subroot, root, sha256({" || ".join(f"l{i} || r{i}" for i in range(2 * levels))}) AS proof_sha256,
       v{2 * levels} AS folded_root, v{2 * levels} = root AS verified FROM f{2 * levels}
"""


ORACLE = _oracle()
