"""Projections, predicates and message parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanledger.config import CollectionConfig
from scanledger.functions import expressions as x
from scanledger.operators import template as tmpl
from scanledger.queries.registry import event_records, query, spread, table
from scanledger.sources.catalogue import data_links, flatten_records, read_catalogue_window
from scanledger.sources.messages import read_messages

_NAMED = "('s3://archive/' || p_type || '/' || replace(p_name, ' ', '_') || CASE WHEN p_size < 10 THEN '.xml' ELSE '.nc' END)"


def _part_urls(spark, sf):
    ending = F.when(F.col("p_size") < 10, ".xml").otherwise(".nc")
    url = F.concat(F.lit("s3://archive/"), "p_type", F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("_")), ending)
    return table(spark, sf, "part").select("p_partkey", url.alias("url"))


@query(
    "granule_ur",
    f"""SELECT p_partkey, regexp_replace(split_part({_NAMED}, '/', 5), '\\.nc$', '') AS granule_ur,
               ends_with({_NAMED}, '.nc') AS is_granule FROM part""",
)
def granule_ur(spark, sf):
    return _part_urls(spark, sf).select("p_partkey", x.granule_ur("url").alias("granule_ur"), x.is_granule_url("url").alias("is_granule"))


@query(
    "split_uri",
    """SELECT page_id, CASE WHEN s THEN split_part(u, '/', 3) END AS bucket,
              CASE WHEN s THEN substr(u, length(split_part(u, '/', 3)) + 7) END AS key
       FROM (SELECT page_id, starts_with(url, 'https://') AS s,
                    CASE WHEN starts_with(url, 'https://') THEN 's3://' || substr(url, 9) ELSE url END AS u FROM pages)""",
)
def split_uri(spark, sf):
    # https pages stand in for objects of a store; the others keep their unsupported scheme
    uri = F.when(F.startswith("url", F.lit("https://")), F.concat(F.lit("s3://"), F.expr("substring(url, 9)"))).otherwise(F.col("url"))
    parts = table(spark, sf, "pages").select("page_id", x.split_uri(uri, strict=False).alias("p"))
    return parts.select("page_id", F.col("p.bucket").alias("bucket"), F.col("p.key").alias("key"))


@query(
    "axis_timestamp",
    """SELECT event_id, make_timestamp(315964800000000 + CAST(round((epoch_us(ts) - 315964800000000) / 1e6 * 1000000) AS BIGINT)) AS shown,
              ts + INTERVAL 1 SECOND AS stamp FROM events""",
)
def axis_timestamp(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        x.axis_timestamp(x.axis_seconds("ts")).cast("timestamp_ntz").alias("shown"),
        x.reference_stamp("ts").alias("stamp"),
    )


@query(
    "parse_instant",
    """SELECT event_id, date_trunc('second', ts) AS zulu, date_trunc('second', ts) - INTERVAL 2 HOUR AS offset_two,
              date_trunc('second', ts) AS naive FROM events""",
)
def parse_instant(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")

    def shown(column):
        return x.parse_instant(column).cast("timestamp_ntz")

    return table(spark, sf, "events").select(
        "event_id",
        shown(F.concat(text, F.lit("Z"))).alias("zulu"),
        shown(F.concat(text, F.lit("+02:00"))).alias("offset_two"),
        shown(text).alias("naive"),
    )


@query(
    "mask_fill",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
              CASE WHEN l_quantity = 50 THEN CAST('NaN' AS DOUBLE) ELSE l_quantity END AS masked FROM lineitem""",
)
def mask_fill(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", x.mask_fill("l_quantity", F.lit(50.0)).alias("masked")
    )


@query(
    "values_equal",
    """SELECT p_partkey, p_size % 5 = p_partkey % 5 AS same, true AS same_list,
              p_size < 25 AS same_missing, p_partkey % 4 <> 3 AS same_object, p_size < 3 AS same_big,
              p_brand <> 'Brand#11' AS same_text FROM part""",
)
def values_equal(spark, sf):
    # sizes modulo 5 spelled as JSON in two ways; 0 stands for a non-finite number
    def spelled(n, quoted):
        special = '"NaN"' if quoted else "NaN"
        number = n.cast("double").cast("string") if quoted else n.cast("string")
        return F.when(n == 0, special).otherwise(number)

    size, key = F.col("p_size") % 5, F.col("p_partkey") % 5
    ints = F.concat(F.lit("["), F.col("p_size").cast("string"), F.lit(",2]"))
    doubles = F.concat(F.lit("["), F.col("p_size").cast("string"), F.lit(".0,2.0]"))
    gone = F.when(F.col("p_size") >= 25, F.col("p_brand"))
    parts = spread(table(spark, sf, "part").select("p_partkey", "p_size", "p_brand"), "p_partkey")
    return parts.select(
        "p_partkey",
        x.values_equal(spelled(size, True), spelled(key, False)).alias("same"),
        x.values_equal(ints, doubles).alias("same_list"),
        x.values_equal(gone, F.lit(None).cast("string")).alias("same_missing"),
        # keys in another order, blanks, exponents and trailing zeros; one in four has another number deep inside
        x.values_equal(
            F.format_string('{"b": [1e3, %d.50], "a": {"k": "x, 1.0]", "n": %d}}', "p_size", "p_partkey"),
            F.format_string(
                '{"a":{"n":%d.0,"k":"x, 1.0]"},"b":[1000,%d.5]}',
                F.col("p_partkey") + F.when(F.col("p_partkey") % 4 == 3, 1).otherwise(0), "p_size",
            ),
        ).alias("same_object"),
        # integers beyond what a double tells apart
        x.values_equal(
            (F.lit(9007199254740992) + F.col("p_size")).cast("string"), (F.lit(9007199254740992) + F.least("p_size", F.lit(2))).cast("string")
        ).alias("same_big"),
        # numbers inside strings are text
        x.values_equal(
            F.to_json(F.array(F.concat("p_brand", F.lit(" 1.0")))),
            F.to_json(F.array(F.concat("p_brand", F.when(F.col("p_brand") == "Brand#11", " 1").otherwise(" 1.0")))),
        ).alias("same_text"),
    )


@query(
    "cells_match",
    """SELECT l_returnflag, count(*) AS cells,
              CAST(sum(CASE WHEN l_discount >= 0.09 OR l_discount = l_tax THEN 1 ELSE 0 END) AS BIGINT) AS matching
       FROM lineitem GROUP BY 1""",
)
def cells_match(spark, sf):
    nan = F.lit(float("nan"))
    a = F.when(F.col("l_discount") >= 0.09, nan).otherwise(F.col("l_discount"))
    b = F.when(F.col("l_discount") >= 0.09, nan).otherwise(F.col("l_tax"))
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(x.cells_match(a, b)).alias("matching")
    )


# -- granule variables ----------------------------------------------------------------------------
# One granule per supplier-like size: part types are groups, part names variables, brands urls.

_VARS_SQL = """
vars AS (
  SELECT p_brand AS url, CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END AS grp, p_name AS name, p_partkey,
         CASE WHEN p_size < 30 THEN ['time', 'latitude', 'longitude'] ELSE ['latitude', 'longitude'] END AS dims,
         CASE WHEN p_size < 30 THEN [1, 8, p_size] ELSE [8, p_size] END AS shape
  FROM part
)"""


def granule_vars(spark, sf):
    timed = F.col("p_size") < 30

    def ints(*values):
        return F.array(*[v.cast("int") for v in values])

    size = F.col("p_size")
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("url"),
        F.when(F.col("p_type") == "ECONOMY", "").otherwise(F.col("p_type")).alias("grp"),
        F.col("p_name").alias("name"),
        "p_partkey",
        F.when(timed, F.array(F.lit("time"), F.lit("latitude"), F.lit("longitude"))).otherwise(F.array(F.lit("latitude"), F.lit("longitude"))).alias("dims"),
        F.when(timed, ints(F.lit(1), F.lit(8), size)).otherwise(ints(F.lit(8), size)).alias("shape"),
        F.when(timed, ints(F.lit(1), F.lit(3), F.lit(4))).otherwise(ints(F.lit(3), F.lit(4))).alias("chunk_shape"),
    )


_CONFIG = CollectionConfig(
    "parts", "PARTS", flatten_groups=("LARGE", "PROMO", "NOWHERE"), promote_to_time=("small ring", "red widget"),
    drop_variables=("blue bolt", "no such"),
)


@query(
    "flatten_groups",
    f"""WITH {_VARS_SQL}
        SELECT url, '' AS grp, name, p_partkey FROM vars WHERE grp IN ('', 'LARGE', 'PROMO', 'NOWHERE')""",
)
def flatten_groups(spark, sf):
    return tmpl.flatten_groups(granule_vars(spark, sf), _CONFIG.flatten_groups).select("url", "grp", "name", "p_partkey")


@query(
    "flatten_findings",
    f"""WITH {_VARS_SQL}, wanted AS (SELECT unnest(['LARGE', 'PROMO', 'NOWHERE']) AS g)
        SELECT 'flatten_groups' AS "check", url AS subject, 'variable collides: ' || name AS detail, 'error' AS severity
        FROM vars WHERE grp IN ('', 'LARGE', 'PROMO', 'NOWHERE') GROUP BY url, name HAVING count(*) > 1
        UNION ALL
        SELECT 'flatten_groups', u.url, 'group missing: ' || g, 'error'
        FROM (SELECT DISTINCT url FROM vars) u, wanted
        WHERE NOT EXISTS (SELECT 1 FROM vars v WHERE v.url = u.url AND v.grp = g)""",
)
def flatten_findings(spark, sf):
    return tmpl.flatten_findings(granule_vars(spark, sf), _CONFIG.flatten_groups)


@query(
    "drop_variables",
    f"""WITH {_VARS_SQL} SELECT url, name, p_partkey FROM vars WHERE name NOT IN ('blue bolt', 'no such')""",
)
def drop_variables(spark, sf):
    return tmpl.drop_variables(granule_vars(spark, sf), _CONFIG.drop_variables).select("url", "name", "p_partkey")


@query(
    "unknown_variables",
    f"""WITH {_VARS_SQL}, wanted AS (SELECT unnest(['blue bolt', 'no such']) AS n)
        SELECT 'drop_variables' AS "check", u.url AS subject, 'variable missing: ' || n AS detail, 'error' AS severity
        FROM (SELECT DISTINCT url FROM vars) u, wanted
        WHERE NOT EXISTS (SELECT 1 FROM vars v WHERE v.url = u.url AND v.name = n)""",
)
def unknown_variables(spark, sf):
    return tmpl.missing_names(granule_vars(spark, sf), _CONFIG.drop_variables, "drop_variables")


@query(
    "promote_to_time",
    f"""WITH {_VARS_SQL}
        SELECT p_partkey, name, array_to_string(CASE WHEN up THEN list_prepend('time', dims) ELSE dims END, ',') AS dims,
               array_to_string(CASE WHEN up THEN list_prepend(1, shape) ELSE shape END, ',') AS shape
        FROM (SELECT *, name IN ('small ring', 'red widget') AND NOT list_contains(dims, 'time') AS up FROM vars)""",
)
def promote_to_time(spark, sf):
    out = tmpl.promote_to_time(granule_vars(spark, sf), _CONFIG)
    return out.select(
        "p_partkey", "name", F.array_join("dims", ",").alias("dims"),
        F.array_join(F.col("shape").cast("array<string>"), ",").alias("shape"),
    )


@query(
    "unpromoted_variables",
    f"""WITH {_VARS_SQL} SELECT p_partkey, name FROM vars
        WHERE NOT list_contains(dims, 'time') AND name NOT IN ('small ring', 'red widget')""",
)
def unpromoted_variables(spark, sf):
    lifted = tmpl.promote_to_time(granule_vars(spark, sf), _CONFIG)
    return tmpl.unpromoted_variables(lifted, _CONFIG).select("p_partkey", "name")


@query(
    "resize_dims",
    f"""WITH {_VARS_SQL}
        SELECT p_partkey, array_to_string(list_transform(list_zip(dims, shape), lambda z:
          CASE WHEN z[1] = 'time' THEN 13611 WHEN z[1] = 'latitude' THEN 2950 ELSE z[2] END), ',') AS shape FROM vars""",
)
def resize_dims(spark, sf):
    out = tmpl.resize_dims(granule_vars(spark, sf), {"time": 13611, "latitude": 2950})
    return out.select("p_partkey", F.array_join(F.col("shape").cast("array<string>"), ",").alias("shape"))


@query("unknown_dims", "SELECT 'depth' AS dim")
def unknown_dims(spark, sf):
    return tmpl.unknown_dims(granule_vars(spark, sf), {"time": 1, "depth": 3})


@query(
    "expected_chunks",
    """SELECT p_partkey, CAST(3 * ceil(p_size / 4.0) AS BIGINT) AS expected FROM part""",
)
def expected_chunks(spark, sf):
    return granule_vars(spark, sf).select("p_partkey", x.expected_chunks("shape", "chunk_shape").alias("expected"))


@query(
    "override_time_chunk",
    """SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN '16384' WHEN p_size < 30 THEN '1,3,4' ELSE '3,4' END AS chunk FROM part""",
)
def override_time_chunk(spark, sf):
    # the root group's arrays stand for the time axis here
    named = granule_vars(spark, sf).withColumn("path", F.when(F.col("grp") == "", "/time").otherwise(F.concat(F.lit("/"), "grp")))
    out = tmpl.override_time_chunk(named, 16384)
    return out.select("p_partkey", F.array_join(F.col("chunk_shape").cast("array<string>"), ",").alias("chunk"))


# -- catalogue documents --------------------------------------------------------------------------


@query(
    "catalogue_records",
    """SELECT event_id AS position, event_type AS concept_id, 'E' || event_id AS granule_ur,
              CAST(user_id AS INTEGER) AS revision_id, ts AS begin_at,
              make_timestamp(epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 10000) AS end_at,
              CASE WHEN event_type <> 'error' THEN 's3://archive/E' || event_id || '.nc' END AS url FROM events""",
)
def catalogue_records(spark, sf):
    flat = flatten_records(event_records(spark, sf))
    return flat.select(
        "position", "concept_id", "granule_ur", "revision_id", F.col("begin").cast("timestamp_ntz").alias("begin_at"),
        F.col("end").cast("timestamp_ntz").alias("end_at"), "url",
    )


@query(
    "catalogue_window",
    """SELECT event_id AS position, ts AS begin_at FROM events
       WHERE make_timestamp(epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 10000) >= TIMESTAMP '2024-01-10'
         AND ts <= TIMESTAMP '2024-01-20' ORDER BY ts DESC, event_id LIMIT 100""",
)
def catalogue_window(spark, sf):
    flat = flatten_records(event_records(spark, sf))
    out = read_catalogue_window(flat, "2024-01-10T00:00:00Z", "2024-01-20T00:00:00", 100)
    return out.select("position", F.col("begin").cast("timestamp_ntz").alias("begin_at"))


@query(
    "direct_links",
    """SELECT event_type, count(*) AS records, CAST(sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT) AS linked
       FROM events GROUP BY 1""",
)
def direct_links(spark, sf):
    link = x.direct_link("umm.RelatedUrls")
    return event_records(spark, sf).groupBy(F.col("meta.`concept-id`").alias("event_type")).agg(
        F.count(F.lit(1)).alias("records"), F.count(link).alias("linked")
    )


@query(
    "data_link_findings",
    """SELECT 'data_link' AS "check", event_type AS subject, 'no .nc data link' AS detail, 'error' AS severity
       FROM events WHERE event_type = 'error'""",
)
def data_link_findings(spark, sf):
    return data_links(flatten_records(event_records(spark, sf)), "direct")[1]


@query(
    "keyword_paths",
    """SELECT p_partkey, p_type || ' > ' || p_brand || CASE WHEN p_size < 25 THEN ' > ' || p_name ELSE '' END AS keywords FROM part""",
)
def keyword_paths(spark, sf):
    level = F.struct(
        F.col("p_type").alias("Category"), F.lit("").alias("Topic"), F.col("p_brand").alias("Term"),
        F.when(F.col("p_size") < 25, F.col("p_name")).alias("VariableLevel1"),
        F.lit(None).cast("string").alias("VariableLevel2"), F.lit(None).cast("string").alias("VariableLevel3"),
    )
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(x.keyword_paths(F.array(level, level)), "; ").alias("keywords")
    )


@query(
    "citation",
    """SELECT p_partkey, 'Creator: ' || p_brand || CASE WHEN p_size < 25 THEN '; Title: ' || p_name ELSE '' END
              || '; Publisher: ' || p_type AS citation FROM part""",
)
def citation(spark, sf):
    entry = F.struct(
        F.col("p_brand").alias("Creator"), F.lit(None).cast("string").alias("ReleaseDate"),
        F.when(F.col("p_size") < 25, F.col("p_name")).otherwise("").alias("Title"), F.lit("").alias("Version"),
        F.col("p_type").alias("Publisher"), F.lit(None).cast("string").alias("OtherCitationDetails"),
    )
    return table(spark, sf, "part").select("p_partkey", x.citation(entry).alias("citation"))


@query(
    "truncate_value",
    """SELECT doc_id, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || ' (cut from ' || length(text) || ' characters)'
              ELSE text END AS shown FROM documents""",
)
def truncate_value(spark, sf):
    return table(spark, sf, "documents").select("doc_id", x.truncate_value("text").alias("shown"))


# -- predicates and messages ----------------------------------------------------------------------


@query(
    "url_schemes",
    """SELECT page_id, split_part(url, '://', 1) AS scheme, split_part(url, '://', 1) IN ('file', 's3', 'https') AS supported,
              NOT starts_with(url, 'https://m.') AS outside FROM pages""",
)
def url_schemes(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", x.scheme("url").alias("scheme"), x.has_supported_scheme("url").alias("supported"),
        x.outside_prefix("url", "https://m.").alias("outside"),
    )


_MESSAGES_SQL = """
messages AS (
  SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 's3://bucket/' || url WHEN 2 THEN url ELSE NULL END AS url,
         CASE page_id % 5 WHEN 3 THEN 'unreadable' WHEN 4 THEN 'skipped' ELSE 'ok' END AS state FROM pages
)"""


def messages(spark, sf):
    """pages as queue messages in five shapes."""
    kind = F.col("page_id") % 5
    poller = F.to_json(F.struct("url"))
    record = F.struct(
        F.struct(F.struct(F.lit("bucket").alias("name")).alias("bucket"), F.struct(F.col("url").alias("key")).alias("object")).alias("s3")
    )
    body = (
        F.when(kind == 0, poller)
        .when(kind == 1, F.to_json(F.struct(F.array(record).alias("Records"))))
        .when(kind == 2, F.to_json(F.struct(poller.alias("Message"))))
        .when(kind == 3, F.concat(F.lit("{broken "), "url"))
        .otherwise(F.to_json(F.struct(F.col("url").alias("other"))))
    )
    return table(spark, sf, "pages").select(
        "page_id", F.format_string("m%08d", "page_id").alias("message_id"), body.alias("body"), F.lit(1).alias("attempts")
    )


@query("read_messages", f"WITH {_MESSAGES_SQL} SELECT page_id, url, state FROM messages")
def messages_read(spark, sf):
    return read_messages(messages(spark, sf)).select("page_id", "url", "state")
