"""WARC archives of pages: written as splittable files, read back with a verified chain of record boundaries.

Writing: each page is one record; of pages with equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest id is the
response and the others are revisits that carry digest and length but no payload. Spark's text writer puts the records into files whose
line separator is the blank that ends a record, so the files are plain WARC.

Reading never trusts a magic by itself, since payloads may contain it:

1. Files are split at the magic, many tasks a file. A part gives a *candidate*: its offset and, if its header is whole, the offset
   where the next record must start.
2. Within a file, candidates whose successor is the very next part form runs. Run ends that point elsewhere are links between runs; pointer
   jumping (each round doubles the steps) from the run at the start of the file finds the runs that a reader would enter, and where.
3. Only candidates reached so are records; what lies between a record and its successor is its payload, even if it holds the magic.
   Payloads of records within one part are hashed in place; those that span parts are put together from just these parts.

Offsets are sums within a block and over the blocks of a file, so no task holds a whole file.

Defined results: a null html is an empty payload, a null url leaves the header out, null ids are written as empty and read as null. Rows
that repeat an id and a payload are responses alike. Magic at the start of a file is required; other files give no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanledger.llm.common import shared_folder, written
from scanledger.session import lookup

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
MIN_REVISIT = 100
STEP = len(MAGIC)


# ------------------------------------------------------------------------------------------------------ writing


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(value) the text of each page's record, without the blank that ends it; pages have page_id, url, html."""
    own = pages.select(
        "page_id", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20").alias("url"), F.coalesce("html", F.lit("")).alias("body")
    )
    size = F.octet_length("body").cast("long")
    own = own.withColumns({"size": size, "digest": F.sha2(F.col("body").cast("binary"), 256)})
    # only payloads that occur more than once, with their first page
    first = (
        own.filter(F.col("size") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("pages"))
        .filter("pages > 1 AND first IS NOT NULL").select("digest", "first")
    )
    joined = own.join(lookup(first), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("body"))
    uri = lambda x: F.concat(F.lit("<urn:page:"), x.cast("string"), F.lit(">"))
    return joined.select(F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", uri(F.coalesce(F.col("page_id").cast("string"), F.lit("")))),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Refers-To", F.when(revisit, uri(F.col("first")))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Payload-Length", F.col("size")),
        _header("Content-Length", F.octet_length(body)),
        F.lit("\r\n"), body,
    ).alias("value"))


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> str:
    """Write every page into files of ``folder``; returns the folder."""
    records(pages, min_revisit).write.option("lineSep", END).text(folder)
    return folder


# ------------------------------------------------------------------------------------------------------ reading


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    """(file, block, turn, raw) of what lies between magics; turn orders the parts of a block."""
    return spark.read.option("lineSep", MAGIC).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("turn"), F.col("value").cast("binary").alias("raw"),
    )


def _candidates(parts: DataFrame) -> DataFrame:
    """Header fields, sizes and the payload's hash where the part holds all of it; no payload is kept."""
    text = F.substring_index(F.col("raw").cast("string"), END, 1)
    held = parts.withColumns({"bytes": F.octet_length("raw").cast("long"), "head": text})
    head = F.octet_length("head").cast("long")
    whole = head + len(END) <= F.col("bytes")
    field = lambda name: F.regexp_extract("head", rf"(?mi)^{name}:[ \t]*([^\r\n]*)", 1)
    length = F.expr("try_cast(" + r"nullif(regexp_extract(head, '(?mi)^Content-Length:[ \t]*([0-9]+)[ \t]*\r?$', 1), '') AS bigint)")
    held = held.withColumns({"length": F.when(whole, length), "body_at": head + len(END)})
    # offsets count from the magic, which the parts have lost
    held = held.withColumn("reach", F.col("body_at") + F.col("length") + len(END))
    inside = F.col("reach") <= F.col("bytes")
    return held.select(
        "file", "block", "turn", "bytes", "body_at", "length", "reach", field("WARC-Type").alias("type"),
        field("WARC-Record-ID").alias("id"), field("WARC-Refers-To").alias("refers"), field("WARC-Target-URI").alias("uri"),
        F.regexp_extract("head", r"(?mi)^WARC-Payload-Digest:[ \t]*sha256:([0-9a-f]*)", 1).alias("stated"),
        F.expr(r"try_cast(nullif(regexp_extract(head, '(?mi)^WARC-Payload-Length:[ \t]*([0-9]+)', 1), '') AS bigint)").alias("stated_bytes"),
        F.when(inside, F.sha2(F.expr("substring(raw, int(body_at) + 1, int(length))"), 256)).alias("hashed"),
    )


def _with_offsets(parts: DataFrame) -> DataFrame:
    """``parts`` (file, block, turn, bytes, ...) with the offset of each part's magic in its file."""
    totals = parts.groupBy("file", "block").agg(F.sum(F.col("bytes") + STEP).alias("total"))
    order = Window.partitionBy("file").orderBy("block")
    base = totals.select("file", "block", (F.sum("total").over(order) - F.col("total") - STEP).alias("base"))
    own = Window.partitionBy("file", "block").orderBy("turn")
    placed = parts.withColumn("own", F.sum(F.col("bytes") + STEP).over(own) - F.col("bytes") - STEP)
    return placed.join(base, ["file", "block"]).withColumn("offset", F.col("base") + F.col("own")).drop("own", "base")


def _running_max(rows: DataFrame, value: Column, into: str, before: bool) -> DataFrame:
    """Running maximum in file order, by block and then over blocks; ``before`` leaves the row itself out."""
    rows = rows.withColumn("value_", value)
    tops = rows.groupBy("file", "block").agg(F.max("value_").alias("top"))
    carry = tops.select("file", "block", F.max("top").over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ).alias("carry"))
    own = Window.partitionBy("file", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    return rows.withColumn("own_", F.max("value_").over(own)).join(carry, ["file", "block"]).withColumn(
        into, F.greatest("own_", "carry")
    ).drop("own_", "carry", "value_")


def _entered(runs: DataFrame) -> DataFrame:
    """(file, run, entry) of the runs on the chain from each file's start; ``runs`` has file, run and where its end points: to, entry_to.

    Pointer jumping: the jump table doubles its step each round, and what is reached doubles with it.
    """
    reached = written(runs.filter("run = 0").select("file", "run", F.lit(0).cast("long").alias("entry")).distinct(), "reached")
    jumps = written(runs.filter("to IS NOT NULL").select("file", "run", "to", "entry_to"), "jumps")
    while not jumps.isEmpty():
        more = reached.join(jumps, ["file", "run"]).select("file", F.col("to").alias("run"), F.col("entry_to").alias("entry"))
        more = written(more.join(reached, ["file", "run"], "left_anti"), "reached-more")
        if more.isEmpty():
            break
        reached = written(reached.unionByName(more), "reached")
        further = jumps.select("file", F.col("run").alias("to"), F.col("to").alias("to_2"), F.col("entry_to").alias("entry_2"))
        jumps = written(
            jumps.drop("entry_to").join(further, ["file", "to"])
            .select("file", "run", F.col("to_2").alias("to"), F.col("entry_2").alias("entry_to")),
            "jumps",
        )
    return reached


def verified_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records on the chain: candidates' fields, offset, and hashed as far as one part tells."""
    placed = _with_offsets(written(_candidates(_parts(spark, folder)), "candidates"))
    placed = placed.filter("offset >= 0")  # what comes before a first magic isn't one
    placed = placed.withColumn("goes", F.col("offset") + STEP + F.col("reach")).withColumn("ends", F.col("offset") + STEP + F.col("bytes"))
    # a run ends where the successor isn't the next part; the next part then starts a new run, named by its offset
    broken = F.when(F.coalesce(F.col("goes") != F.col("ends"), F.lit(True)), F.col("ends"))
    rows = _running_max(placed, broken, "run", before=True)
    rows = written(rows.withColumn("run", F.coalesce("run", F.lit(0).cast("long"))), "runs")
    last = rows.filter("goes IS NULL OR goes != ends").select("file", "run", "goes")
    links = last.join(
        rows.select("file", F.col("offset").alias("goes"), F.col("run").alias("to")), ["file", "goes"], "left"
    ).select("file", "run", "to", F.col("goes").alias("entry_to"))
    starts = rows.filter("offset = 0").select("file", "run", F.lit(None).cast("long").alias("to"), F.lit(None).cast("long").alias("entry_to"))
    entered = _entered(links.filter("to IS NOT NULL").unionByName(starts))
    on = rows.join(entered, ["file", "run"], "left").withColumn("reached", F.coalesce(F.col("offset") >= F.col("entry"), F.lit(False)))
    return written(on.withColumn("reached", F.col("reached") & F.col("goes").isNotNull()), "chain").drop("entry")


def _spanning(spark: SparkSession, folder: str, chain: DataFrame) -> DataFrame:
    """(file, offset, joined) of records whose payload holds the magic: joined is the payload."""
    wide = chain.filter("reached AND goes > ends")
    if wide.isEmpty():
        return chain.select("file", "offset", F.lit(None).cast("binary").alias("joined")).limit(0)
    owned = _running_max(chain, F.when(F.col("reached"), F.col("offset")), "owner", before=False)
    needed = owned.join(
        wide.select("file", F.col("offset").alias("owner"), "body_at", "length").withColumnsRenamed({"body_at": "at", "length": "size"}),
        ["file", "owner"],
    ).select("file", "owner", "offset", "at", "size")
    files = wide.select("file").distinct()
    parts = _parts(spark, folder).join(lookup(files), "file", "left_semi").withColumn("bytes", F.octet_length("raw").cast("long"))
    pieces = _with_offsets(parts).join(needed, ["file", "offset"])
    together = pieces.groupBy("file", "owner", "at", "size").agg(F.sort_array(F.collect_list(F.struct("offset", "raw"))).alias("p"))
    raw = F.aggregate(
        F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))), F.element_at("p", 1)["raw"],
        lambda a, x: F.concat(a, F.lit(MAGIC).cast("binary"), x["raw"]),
    )
    cut = together.withColumn("all_", raw)
    return cut.select("file", F.col("owner").alias("offset"), F.expr("substring(all_, int(at) + 1, int(size))").alias("joined"))


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, record_type, refers_to, uri, payload_bytes, payload_digest, intact) of every record.

    Bytes and digest are those of the payload as read, for revisits those that the record states; intact says that stated and read
    ones agree.
    """
    chain = verified_records(spark, folder)
    wide = _spanning(spark, folder, chain).select("file", "offset", F.sha2("joined", 256).alias("joined_hash"))
    found = chain.filter("reached").join(wide, ["file", "offset"], "left")
    page = lambda name: F.expr(f"try_cast(nullif(regexp_extract({name}, '<urn:page:([^>]*)>', 1), '') AS bigint)")
    again = F.col("type") == "revisit"
    digest = F.coalesce("joined_hash", "hashed")
    return found.select(
        page("id").alias("page_id"), F.col("type").alias("record_type"), page("refers").alias("refers_to"), "uri",
        F.when(again, F.col("stated_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(again, F.col("stated")).otherwise(digest).alias("payload_digest"),
        (again | ((F.col("stated") == digest) & (F.col("stated_bytes") == F.col("length")))).alias("intact"),
    )


def query(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    folder = write_archives(pages.select("page_id", "url", "html"), shared_folder(spark, "warc"))
    found = read_archives(spark, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


ORACLE = """
WITH own AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
sized AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM own),
dup AS (SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN first END AS refers_to, true AS intact
FROM sized LEFT JOIN dup USING (payload_digest)
"""
