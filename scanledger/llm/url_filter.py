"""URL filtering by explicit rules and, beyond them, a tree of path templates.

Rules are (host, path, verdict); a rule fits its host and all subdomains if the path starts with the rule's, the longest rule wins (by host,
then path). What no rule fits is judged by the template tree:

1. Per host, a segment at a depth stays literal if it carries at least ``MIN_SHARE`` of the urls there; all others become the wildcard
   of their shape (number, hexadecimal, word, ...). So a place keeps at most 1 / MIN_SHARE literals, however many urls it has.
2. Sibling branches whose next segments and labels are distributed alike (a chi-square test against all siblings together) merge into one
   branch of the template.
3. A template is rejected if the share of blocked urls among its labelled ones, smoothed towards the share of its host and this
   towards that of all urls, reaches ``MAX_PURITY``.

Labels come from the caller; the query takes the verdicts of the rules. All statistics are aggregates over all urls; a host with a third of
the rows is aggregated in every task before anything is shuffled, and only templates are joined back.

Defined results: null urls and urls without ``://`` have an empty host and path and form templates of their own. Without labels nothing is
rejected. Repeated rows count and are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.llm.common import ascii_lower, written

MIN_SHARE = 0.02
MIN_COUNT = 5
STRENGTH = 10.0  # labelled urls that the smoothing is worth
MAX_PURITY = 0.8
MAX_CHI = 3.0  # chi-square a degree of freedom up to which branches are alike

# fixed by contract: verdict, host, path
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that wins (as host and path together) and its verdict, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule, verdict = F.when(fits, own + start).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def shape_of(segment: Column) -> Column:
    """Wildcard of a segment that varies."""
    return (
        F.when(segment == "", "").when(segment.rlike(r"^[0-9]+$"), "<number>")
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z0-9]{1,5}$"), "<number.file>").when(segment.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "<date>")
        .when(segment.rlike(r"^(?i)[0-9a-f-]{8,}$"), "<hex>").when(segment.rlike(r"\.[A-Za-z0-9]{1,5}$"), "<file>")
        .when(segment.rlike(r"[0-9]"), "<mixed>").otherwise("<word>")
    )


def templates(urls: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, path, label) as (host, path, template, label), one row a distinct path and label, with the number n of its urls."""
    paths = written(urls.groupBy("host", "path", "label").agg(F.count("*").alias("n")), "url-paths")
    split = paths.withColumn("segments", F.slice(F.split("path", "/"), 2, 1_000_000_000))
    # a segment's place: host, depth, and the shapes before it
    placed = split.withColumn("shapes", F.transform("segments", shape_of)).select(
        "host", "path", "label", "n", F.posexplode(F.arrays_zip("segments", "shapes")).alias("depth", "s"), "shapes"
    ).select(
        "host", "path", "label", "n", "depth", F.col("s.segments").alias("segment"), F.col("s.shapes").alias("shape"),
        F.array_join(F.slice("shapes", 1, F.col("depth")), "/").alias("above"),
        F.coalesce(F.get("shapes", F.col("depth") + 1), F.lit("<end>")).alias("below"),
    )
    place = ["host", "depth", "above"]
    by_segment = written(
        placed.groupBy(*place, "segment", "shape", "below", "label").agg(F.sum("n").alias("n")), "url-segments"
    )
    totals = by_segment.groupBy(*place).agg(F.sum("n").alias("total"))
    literal = (
        by_segment.groupBy(*place, "segment").agg(F.sum("n").alias("n")).join(totals, place)
        .filter((F.col("n") >= min_share * F.col("total")) & (F.col("n") >= MIN_COUNT) & (F.col("segment") != "")).select(*place, "segment")
    )
    literal = written(literal, "url-literals")
    merged = _merged(by_segment.join(literal, [*place, "segment"], "left_semi"), place)
    named = placed.join(merged, [*place, "segment"], "left").select(
        "host", "path", "label", "n", F.struct("depth", F.coalesce("branch", "shape").alias("name")).alias("s")
    )
    made = named.groupBy("host", "path", "label", "n").agg(F.sort_array(F.collect_list("s")).alias("s"))
    made = made.select("host", "path", "label", "n", F.array_join(F.transform("s", lambda x: x["name"]), "/").alias("template"))
    bare = split.filter(F.size("segments") == 0).select("host", "path", "label", "n", F.lit("").alias("template"))
    return made.unionByName(bare)


def _merged(rows: DataFrame, place: list[str]) -> DataFrame:
    """(place, segment, branch): literal segments, those alike under one name."""
    kinds = rows.groupBy(*place, "segment", F.concat_ws(" ", "below", F.coalesce("label", F.lit("-"))).alias("kind")).agg(F.sum("n").alias("n"))
    pooled = kinds.groupBy(*place, "kind").agg(F.sum("n").alias("kind_n"))
    sizes = kinds.groupBy(*place, "segment").agg(F.sum("n").alias("size"))
    # at most 1 / MIN_SHARE segments a place, so this grid of segments and kinds is small
    grid = sizes.join(pooled, place).join(kinds, [*place, "segment", "kind"], "left").fillna(0, ["n"])
    grid = grid.withColumn("all_", F.sum("kind_n").over(Window.partitionBy(*place, "segment")))
    expected = F.col("size") * F.col("kind_n") / F.col("all_")
    tested = grid.groupBy(*place, "segment").agg(
        F.sum((F.col("n") - expected) * (F.col("n") - expected) / expected).alias("chi"), F.count("*").alias("kinds")
    )
    alike = tested.withColumn("alike", F.col("chi") <= MAX_CHI * F.greatest(F.col("kinds") - 1, F.lit(1)))
    names = alike.filter("alike").groupBy(*place).agg(F.array_join(F.array_sort(F.collect_list("segment")), "|").alias("names"))
    return alike.join(names, place, "left").select(
        *place, "segment", F.when(F.col("alike"), F.concat(F.lit("{"), F.col("names"), F.lit("}"))).otherwise(F.col("segment")).alias("branch")
    )


def judged(made: DataFrame) -> DataFrame:
    """(host, template, purity) from rows with n and label (``block``, ``allow`` or null)."""
    def counts(*by: str) -> DataFrame:
        return made.groupBy(*by).agg(
            F.sum(F.when(F.col("label") == "block", F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("label").isNotNull(), F.col("n")).otherwise(0)).alias("seen"),
        )

    whole = counts().first()
    base = (whole["bad"] or 0) / whole["seen"] if whole["seen"] else 0.0
    smooth = lambda prior: (F.col("bad") + STRENGTH * prior) / (F.col("seen") + STRENGTH)
    # a host's own share leans on its labels only as far as they go
    hosts = counts("host").select("host", smooth(F.lit(base)).alias("host_purity"))
    prior = F.when(F.col("seen") > 0, F.col("host_purity")).otherwise(F.least("host_purity", F.lit(base)))
    return counts("host", "template").join(hosts, "host").select("host", "template", smooth(prior).alias("purity"))


def filter_urls(pages: DataFrame, url: str = "url", page_id: str = "page_id", rules=RULES, labels: Column | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row.

    ``labels`` is a column over host and path with ``block``, ``allow`` or null; left out, the rules' verdicts teach.
    """
    own = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, kind = rule_of(F.col("host"), F.col("path"), rules)
    own = own.withColumns({"rule": rule, "kind": kind})
    own = own.withColumn("label", F.col("kind") if labels is None else labels)
    made = written(templates(own.select("host", "path", "label")), "url-templates")
    found = judged(made)
    by_path = made.select("host", "path", "template").distinct().join(found, ["host", "template"])
    joined = own.join(by_path, ["host", "path"], "left")
    bad = F.coalesce(F.col("purity") >= MAX_PURITY, F.lit(False))
    verdict = F.coalesce(F.col("kind"), F.when(bad, "block").otherwise("allow")).alias("verdict")
    return joined.select("page_id", "host", "path", "rule", verdict, "template", "purity")


def query(pages: DataFrame) -> DataFrame:
    return filter_urls(pages.select("page_id", "url"))
