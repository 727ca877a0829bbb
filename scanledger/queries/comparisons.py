"""Template, attribute, coordinate, positional and catalogue comparisons; nearest in time."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanledger.config import CollectionConfig
from scanledger.functions import expressions as x
from scanledger.operators import compare as ops, template as tmpl, validate
from scanledger.queries.axis import _MERGE_SQL, merged_axis, old_axis, pending_ledger
from scanledger.queries.registry import AXIS_SQL, axis_entries, axis_slots, query, spread, table
from scanledger.queries.scalars import granule_vars
from scanledger.session import pin

# -- nodes: the orders seen by finished lines against those seen by open lines --------------------

_NODES_SQL = """
want AS (SELECT '/' || l_orderkey AS path, min(l_returnflag) AS data_type, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
got AS (SELECT '/' || l_orderkey AS path, min(l_returnflag) AS data_type, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
pairs AS (SELECT path, w.data_type AS wt, g.data_type AS gt, w.n AS wn, g.n AS gn FROM want w FULL JOIN got g USING (path))"""


def _nodes(spark, sf, status):
    return table(spark, sf, "lineitem").filter(F.col("l_linestatus") == status).groupBy(
        F.concat(F.lit("/"), F.col("l_orderkey").cast("string")).alias("path")
    ).agg(F.min("l_returnflag").alias("data_type"), F.count(F.lit(1)).alias("n"))


@query(
    "compare_nodes",
    f"""WITH {_NODES_SQL}
        SELECT path, 'missing' AS problem, NULL::VARCHAR AS field FROM pairs WHERE gn IS NULL
        UNION ALL SELECT path, 'unexpected', NULL FROM pairs WHERE wn IS NULL
        UNION ALL SELECT path, 'differs', 'data_type' FROM pairs WHERE wt <> gt
        UNION ALL SELECT path, 'differs', 'n' FROM pairs WHERE wn <> gn""",
)
def compare_nodes(spark, sf):
    out = ops.compare_nodes(_nodes(spark, sf, "F"), _nodes(spark, sf, "O"), fields=("data_type", "n"))
    return out.select("path", "problem", "field")


@query(
    "compare_nodes_allow_extra",
    f"""WITH {_NODES_SQL}
        SELECT 'missing' AS problem, count(*) AS n FROM pairs WHERE gn IS NULL
        UNION ALL SELECT 'differs', count(*) FILTER (wt <> gt) + count(*) FILTER (wn <> gn) FROM pairs""",
)
def compare_nodes_allow_extra(spark, sf):
    out = ops.compare_nodes(_nodes(spark, sf, "F"), _nodes(spark, sf, "O"), True, fields=("data_type", "n"))
    return out.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


# -- attributes: every part is a granule with one node per type -----------------------------------

_ATTRS_SQL = """
nodes AS (
  SELECT p_partkey AS url, '/' || p_type AS path,
         map_from_entries(list_concat([('brand', '"' || p_brand || '"'), ('size', CAST(p_size AS VARCHAR)), ('history', p_name)],
           CASE WHEN p_size >= 25 THEN [('title', p_name)] ELSE [] END)) AS attrs FROM part
),
declared AS (
  SELECT '/' || p_type AS path,
         map_from_entries(list_concat([('brand', '"' || min(p_brand) || '"'), ('size', max(p_size) || '.0')],
           CASE WHEN p_type = 'PROMO' THEN [('project', '1')] ELSE [] END)) AS want FROM part GROUP BY p_type
),
keyed AS (
  SELECT url, path, unnest(list_distinct(list_concat(map_keys(want), map_keys(attrs)))) AS key, want, attrs
  FROM nodes JOIN declared USING (path)
),
attr_diff AS (
  SELECT url, path, key, CASE WHEN list_contains(map_keys(want), key) AND NOT list_contains(map_keys(attrs), key) THEN 'missing'
                              WHEN NOT list_contains(map_keys(want), key) THEN 'extra'
                              WHEN replace(want[key], '.0', '') <> attrs[key] THEN 'differs' END AS problem
  FROM keyed WHERE key <> 'history'
)"""


def granule_nodes(spark, sf):
    def entry(key, value):
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    base = F.array(
        entry("brand", F.to_json(F.array("p_brand")).substr(F.lit(2), F.length("p_brand") + 2)),
        entry("size", F.col("p_size").cast("string")),
        entry("history", F.col("p_name")),
    )
    title = F.array(entry("title", F.col("p_name")))
    parts = spread(table(spark, sf, "part").select("p_partkey", "p_type", "p_brand", "p_size", "p_name"), "p_partkey")
    return parts.select(
        F.col("p_partkey").alias("url"), F.concat(F.lit("/"), "p_type").alias("path"),
        F.map_from_entries(F.when(F.col("p_size") >= 25, F.concat(base, title)).otherwise(base)).alias("attributes"),
    )


def declared_attributes(spark, sf):
    quoted = F.concat(F.lit('"'), F.min("p_brand"), F.lit('"'))
    spec = table(spark, sf, "part").groupBy("p_type").agg(quoted.alias("b"), F.concat(F.max("p_size").cast("string"), F.lit(".0")).alias("s"))
    base = F.create_map(F.lit("brand"), "b", F.lit("size"), "s")
    return spec.select(
        F.concat(F.lit("/"), "p_type").alias("path"),
        F.when(F.col("p_type") == "PROMO", F.map_concat(base, F.create_map(F.lit("project"), F.lit("1")))).otherwise(base).alias("attributes"),
    )


@query(
    "compare_attributes",
    f"""WITH {_ATTRS_SQL} SELECT url, path, key, problem, CASE WHEN problem = 'extra' THEN 'warning' ELSE 'error' END AS severity
        FROM attr_diff WHERE problem IS NOT NULL""",
)
def compare_attributes(spark, sf):
    out = ops.compare_attributes(declared_attributes(spark, sf), granule_nodes(spark, sf), {"history"})
    return out.select("url", "path", "key", "problem", "severity")


@query(
    "varying_attributes",
    f"""WITH {_ATTRS_SQL}, pairs AS (SELECT path, unnest(map_entries(attrs)) AS e FROM nodes),
        totals AS (SELECT path, count(*) AS n FROM nodes GROUP BY 1)
        SELECT path, e.key AS key, count(DISTINCT e.value) AS n_values, count(*) AS n_granules
        FROM pairs JOIN totals t USING (path) WHERE e.key <> 'history' GROUP BY path, e.key, t.n
        HAVING count(DISTINCT e.value) > 1 OR count(*) <> t.n""",
)
def varying_attributes(spark, sf):
    return tmpl.varying_attributes(granule_nodes(spark, sf), {"history"})


@query(
    "strip_attributes",
    f"""WITH {_ATTRS_SQL} SELECT url, path, array_to_string(list_sort(list_filter(map_keys(attrs), lambda k: k NOT IN ('history', 'size'))), ',') AS names
        FROM nodes""",
)
def strip_attributes(spark, sf):
    out = tmpl.strip_attributes(granule_nodes(spark, sf), {"history", "size"})
    return out.select("url", "path", F.array_join(F.array_sort(F.map_keys("attributes")), ",").alias("names"))


@query(
    "strip_write_artifacts",
    """SELECT p_partkey AS url, CASE WHEN p_type = 'PROMO' THEN '_FillValue,brand' ELSE 'brand' END AS names FROM part""",
)
def strip_write_artifacts(spark, sf):
    added = F.map_from_arrays(F.array(F.lit("brand"), F.lit("_FillValue"), F.lit("coordinates")), F.array("p_brand", F.lit("0"), F.lit("lat")))
    nodes = table(spark, sf, "part").select(
        F.col("p_partkey").alias("url"), F.concat(F.lit("/"), "p_type").alias("path"), added.alias("attributes")
    )
    carried = declared_attributes(spark, sf).withColumn(
        "attributes", F.when(F.col("path") == "/PROMO", F.map_concat("attributes", F.create_map(F.lit("_FillValue"), F.lit("0")))).otherwise(F.col("attributes"))
    )
    out = tmpl.strip_write_artifacts(nodes, carried)
    return out.select("url", F.array_join(F.array_sort(F.map_keys("attributes")), ",").alias("names"))


@query(
    "build_template",
    """WITH own AS (SELECT *, p_size < 30 AS timed FROM part WHERE p_brand = 'Brand#3' AND p_type IN ('ECONOMY', 'LARGE')
                      AND p_name <> 'blue bolt')
       SELECT '/' || p_name AS path, 'array' AS node_type,
              CASE WHEN timed OR p_name = 'red widget' THEN 3 ELSE 2 END AS n_dims, count(*) AS n, 0 AS n_attributes
       FROM own GROUP BY ALL
       UNION ALL SELECT '', 'group', NULL, 1, 2
       UNION ALL SELECT unnest(['/granule_ur', '/granule_url']), 'array', 1, 1, 0""",
)
def build_template(spark, sf):
    config = CollectionConfig(
        "parts", "PARTS", flatten_groups=("LARGE",), promote_to_time=("red widget",), drop_variables=("blue bolt",)
    )
    variables = granule_vars(spark, sf).withColumn("data_type", F.lit("double")).withColumn("fill_value", F.lit(-1e30))
    # the root node of a granule carries one attribute shared by all, one of its own and a volatile one
    root = table(spark, sf, "part").select("p_brand").distinct().select(
        F.col("p_brand").alias("url"), F.substring("p_brand", 1, 0).alias("path"),
        F.create_map(F.lit("project"), F.lit("1"), F.lit("title"), "p_brand", F.lit("history"), "p_brand").alias("attributes"),
    )
    out = tmpl.build_template(variables, root, "Brand#3", config)
    n_dims = F.when(F.col("dims").isNotNull(), F.size("dims"))
    return out.groupBy("path", "node_type", n_dims.alias("n_dims")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("attributes")).alias("n_attributes")
    )


@query(
    "store_findings",
    f"""WITH {_ATTRS_SQL}, k AS (SELECT path || '/' || url AS subject, unnest(list_distinct(list_concat(map_keys(want), map_keys(attrs)))) AS key, want, attrs FROM nodes JOIN declared USING (path))
        SELECT 'attributes' AS "check", subject,
               'attribute ' || key || ' ' || CASE WHEN want[key] IS NULL THEN 'extra' WHEN attrs[key] IS NULL THEN 'missing' ELSE 'differs' END AS detail,
               CASE WHEN want[key] IS NULL THEN 'warning' ELSE 'error' END AS severity
        FROM k WHERE key <> 'history' AND (want[key] IS NULL OR attrs[key] IS NULL OR replace(want[key], '.0', '') <> attrs[key])""",
)
def store_findings(spark, sf):
    empty = {
        "node_type": F.lit("group"), "data_type": F.lit(None).cast("string"), "shape": F.lit(None).cast("array<int>"),
        "chunk_shape": F.lit(None).cast("array<int>"), "fill_value": F.lit(None).cast("string"),
        "codecs": F.lit(None).cast("array<string>"), "dims": F.lit(None).cast("array<string>"),
    }
    # every part is a node of its own, declared as its type is
    parts = granule_nodes(spark, sf).withColumn("node", F.concat_ws("/", "path", F.col("url").cast("string")))
    store = parts.select(F.col("node").alias("path"), "attributes").withColumns(empty)
    spec = parts.select("path", "node").join(declared_attributes(spark, sf), "path").select(F.col("node").alias("path"), "attributes")
    return validate.validate_store(spec.withColumns(empty), store, False, {"history"})


# -- coordinates ----------------------------------------------------------------------------------


@query(
    "compare_coordinates",
    """WITH r AS (SELECT event_type AS axis, user_id AS idx, min(value) AS v FROM events WHERE value > 5 GROUP BY 1, 2),
            a AS (SELECT event_type AS axis, user_id AS idx, min(value) AS v FROM events WHERE value < 200 GROUP BY 1, 2),
            p AS (SELECT coalesce(r.axis, a.axis) AS axis, r.v AS rv, a.v AS av FROM r FULL JOIN a ON r.axis = a.axis AND r.idx = a.idx),
            s AS (SELECT axis, count(rv) AS n_reference, count(av) AS n_actual, count(*) FILTER (rv <> av) AS n_differing,
                         count(*) FILTER (rv IS NULL OR av IS NULL) AS n_unmatched FROM p GROUP BY 1)
       SELECT *, CASE WHEN n_actual = 0 THEN 'missing' WHEN n_unmatched > 0 THEN 'length' ELSE 'values' END AS problem
       FROM s WHERE n_differing > 0 OR n_unmatched > 0""",
)
def compare_coordinates(spark, sf):
    events = table(spark, sf, "events")

    def axis(rows):
        return rows.groupBy(F.col("event_type").alias("axis"), F.col("user_id").alias("idx")).agg(F.min("value").alias("value"))

    return ops.compare_coordinates(axis(events.filter("value > 5")), axis(events.filter("value < 200")))


@query(
    "shared_grid_check",
    """WITH g AS (SELECT l_linestatus AS s, l_returnflag AS axis, l_suppkey AS idx, count(*) AS v FROM lineitem GROUP BY ALL)
       SELECT coalesce(a.axis, b.axis) AS axis, count(*) FILTER (a.v <> b.v) AS n_differing
       FROM (SELECT * FROM g WHERE s = 'F') a FULL JOIN (SELECT * FROM g WHERE s = 'O') b ON a.axis = b.axis AND a.idx = b.idx
       GROUP BY 1 HAVING count(*) FILTER (a.v <> b.v OR a.v IS NULL OR b.v IS NULL) > 0""",
)
def shared_grid_check(spark, sf):
    def grid(status):
        lines = table(spark, sf, "lineitem").filter(F.col("l_linestatus") == status)
        return lines.groupBy(F.col("l_returnflag").alias("axis"), F.col("l_suppkey").alias("idx")).agg(
            F.count(F.lit(1)).cast("double").alias("value")
        )

    return ops.shared_grid_check(grid("F"), grid("O")).select("axis", "n_differing")


_AXES_SQL = """
named AS (SELECT vec_id, CASE WHEN label < 5 THEN 'latitude' ELSE 'longitude' END AS axis, embedding AS v FROM embeddings),
reference AS (SELECT axis, arg_min(v, vec_id) AS r FROM named GROUP BY 1),
axis_diff AS (
  SELECT vec_id, n.axis, 'values' AS problem FROM named n JOIN reference USING (axis) WHERE v <> r
  UNION ALL
  SELECT vec_id, r.axis, 'missing' FROM named n JOIN reference r ON n.axis <> r.axis
)"""


def _named_axes(spark, sf):
    """Every vector is a granule carrying one of two axes; the first vector with it is the reference."""
    axes = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("url"), "vec_id",
        F.when(F.col("label") < 5, "latitude").otherwise("longitude").alias("axis"), F.col("embedding").alias("values"),
    )
    return axes.groupBy("axis").agg(F.min_by("values", "vec_id").alias("values")), axes.drop("vec_id")


@query("compare_axes", f"WITH {_AXES_SQL} SELECT * FROM axis_diff")
def compare_axes(spark, sf):
    out = ops.compare_axes(*_named_axes(spark, sf))
    return out.select(F.col("url").cast("long").alias("vec_id"), "axis", "problem")


# -- axis against inventory and catalogue ---------------------------------------------------------


@query(
    "compare_positional",
    f"""WITH {_MERGE_SQL}
        SELECT coalesce(i.collection, s.collection) AS collection, coalesce(i.slot, s.slot) AS slot,
               CASE WHEN s.slot IS NULL THEN 'missing' WHEN i.slot IS NULL THEN 'unexpected' ELSE 'granule_ur' END AS problem
        FROM slots i FULL JOIN merged s ON i.collection = s.collection AND i.slot = s.slot
        WHERE s.slot IS NULL OR i.slot IS NULL OR i.granule_ur <> s.granule_ur""",
)
def compare_positional(spark, sf):
    return ops.compare_positional(merged_axis(spark, sf), axis_slots(spark, sf)).select("collection", "slot", "problem")


@query(
    "completeness_diff",
    f"""WITH {_MERGE_SQL},
        listed AS (SELECT DISTINCT o_orderpriority AS collection, 'G' || l_orderkey AS granule_ur
                   FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'),
        known AS (SELECT collection, granule_ur FROM old UNION SELECT collection, granule_ur FROM pending)
        SELECT *, 'not in archive' AS problem FROM (SELECT * FROM listed EXCEPT SELECT * FROM known)
        UNION ALL
        SELECT *, 'not in catalogue' FROM (SELECT collection, granule_ur FROM old EXCEPT SELECT * FROM listed)""",
)
def completeness_diff(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    listed = table(spark, sf, "orders").join(returned, "o_orderkey", "left_semi").select(
        F.col("o_orderpriority").alias("collection"), F.concat(F.lit("G"), F.col("o_orderkey").cast("string")).alias("granule_ur")
    )
    return ops.completeness_diff(listed, old_axis(spark, sf), pending_ledger(spark, sf))


_NEAR_SQL = """
recs AS (
  SELECT event_type AS collection, event_id AS rank, (epoch_us(ts) - 315964800000000) / 1e6 AS begin_at,
         (epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 10000 - 315964800000000) / 1e6 AS end_at,
         's3://archive/E' || event_id || '.nc' AS url FROM events
),
asked AS (
  SELECT event_type AS collection, event_id AS slot, (epoch_us(ts) - 315964800000000) / 1e6 + user_id * 5.0 AS time,
         's3://archive/E' || event_id || '.nc' AS granule_url FROM events
),
found AS (
  SELECT a.collection, a.slot, any_value(a.granule_url) AS granule_url,
         arg_min(r.url, struct_pack(d := abs(r.begin_at - a.time), r := r.rank)) AS found_url
  FROM asked a LEFT JOIN recs r ON r.collection = a.collection AND r.begin_at <= a.time + 240.0 AND r.end_at >= a.time - 240.0
  GROUP BY a.collection, a.slot
)"""


def nearest(spark, sf):
    """Every event is a catalogue record; its slot's in-file time lies 0 to 12 minutes later."""
    events = table(spark, sf, "events")
    at = x.axis_seconds("ts")
    length = F.round(F.col("value") * 100).cast("long") * 10_000
    micros = F.unix_micros(F.col("ts").cast("timestamp")) + length - F.lit(x.AXIS_EPOCH_SECONDS * 1_000_000).cast("long")
    url = F.concat(F.lit("s3://archive/E"), F.col("event_id").cast("string"), F.lit(".nc"))
    records = events.select(
        F.col("event_type").alias("collection"), F.col("event_id").alias("rank"), at.alias("begin"),
        (micros / 1e6).alias("end"), url.alias("url"), F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("granule_ur"),
    )
    slots = events.select(
        F.col("event_type").alias("collection"), F.col("event_id").cast("long").alias("slot"),
        (at + F.col("user_id") * 5.0).alias("time"), url.alias("granule_url"),
    )
    return ops.nearest_granule(slots, records)


@query("nearest_granule", f"WITH {_NEAR_SQL} SELECT collection, CAST(slot AS BIGINT) AS slot, found_url FROM found")
def nearest_granule(spark, sf):
    return nearest(spark, sf).select("collection", "slot", "found_url")


@query(
    "url_drift",
    f"WITH {_NEAR_SQL} SELECT collection, CAST(slot AS BIGINT) AS slot, granule_url, found_url FROM found WHERE found_url <> granule_url",
)
def url_drift(spark, sf):
    return ops.url_drift(nearest(spark, sf)).select("collection", "slot", "granule_url", "found_url")


@query(
    "align_collections",
    f"""WITH {AXIS_SQL},
        a AS (SELECT slot, time FROM slots WHERE collection = '1-URGENT'), b AS (SELECT slot, time FROM slots WHERE collection = '5-LOW')
        SELECT a.slot, any_value(a.time) AS time, arg_min(b.slot, struct_pack(d := abs(a.time - b.time), s := b.slot)) AS other_slot,
               min(abs(a.time - b.time)) AS gap
        FROM a, b GROUP BY a.slot""",
)
def align_collections(spark, sf):
    slots = axis_slots(spark, sf)
    first = slots.filter("collection = '1-URGENT'").select("slot", "time")
    return ops.align_collections(first, slots.filter("collection = '5-LOW'").select("slot", "time"))


@query(
    "select_nearest_time",
    f"""WITH {_MERGE_SQL}, q AS (SELECT o_orderkey AS request_id, o_orderpriority AS collection, epoch(o_orderdate) - 315964800 + 43200 AS time FROM orders),
        t AS (SELECT DISTINCT collection, time FROM q),
        n AS (SELECT t.collection, t.time, arg_min(o.slot, struct_pack(d := abs(t.time - o.time), s := o.slot)) AS slot, min(abs(t.time - o.time)) AS gap
              FROM t JOIN old o ON o.collection = t.collection GROUP BY 1, 2)
        SELECT request_id, q.collection, q.time, n.slot, n.gap FROM q JOIN n ON q.collection = n.collection AND q.time = n.time""",
)
def select_nearest_time(spark, sf):
    requests = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.col("o_orderpriority").alias("collection"), (x.axis_seconds("o_orderdate") + 43200.0).alias("time")
    )
    return ops.select_nearest_time(old_axis(spark, sf), requests)


@query(
    "granule_time_findings",
    """SELECT 'granule_time' AS "check", CAST(event_id AS VARCHAR) AS subject,
              CASE event_type WHEN 'error' THEN 'root attribute time_coverage_start_since_epoch missing'
                              WHEN 'signup' THEN '2 time steps instead of one'
                              WHEN 'click' THEN 'granule has no time variable'
                              ELSE 'root attribute time_coverage_start_since_epoch differs from the time' END AS detail, 'error' AS severity
       FROM events WHERE event_type IN ('error', 'signup', 'click') OR (event_type = 'view' AND value < 50)""",
)
def granule_time_findings(spark, sf):
    at = x.axis_seconds("ts")
    kind = F.col("event_type")
    times = F.when(kind == "signup", F.array(at, at)).when(kind != "click", F.array(at))
    epoch = F.when(kind == "error", F.lit(None).cast("double")).when((kind == "view") & (F.col("value") < 50), at + 1.0).otherwise(at)
    granules = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("url"), times.alias("times"), epoch.alias("epoch"))
    return validate.validate_granule_time(granules)


@query(
    "granule_findings",
    f"""WITH {_ATTRS_SQL}, {_AXES_SQL}
        SELECT 'attributes' AS "check", CAST(url AS VARCHAR) AS subject, 'attribute ' || path || ' ' || key || ' ' || problem AS detail,
               CASE WHEN problem = 'extra' THEN 'warning' ELSE 'error' END AS severity
        FROM attr_diff WHERE problem IS NOT NULL
        UNION ALL
        SELECT 'coordinates', CAST(vec_id AS VARCHAR), axis || ' ' || problem, 'error' FROM axis_diff""",
)
def granule_findings(spark, sf):
    nodes = granule_nodes(spark, sf).withColumn("url", F.col("url").cast("string"))
    return validate.validate_granules(declared_attributes(spark, sf), nodes, *_named_axes(spark, sf), {"history"})


@query(
    "publish_gate",
    f"""WITH {_MERGE_SQL},
        listed AS (SELECT * FROM slots WHERE year(to_timestamp(time + 315964800)::TIMESTAMP) < 2000),
        inv AS (SELECT collection, CAST(row_number() OVER (PARTITION BY collection ORDER BY time) - 1 AS BIGINT) AS slot, granule_ur FROM listed),
        held AS (SELECT m.collection, count(*) AS actual FROM lineitem JOIN merged m ON m.granule_ur = 'G' || l_orderkey GROUP BY 1),
        sizes AS (SELECT collection, count(*) AS n FROM merged GROUP BY 1)
        SELECT 'inventory' AS "check", count(*) AS n FROM inv i FULL JOIN merged s ON i.collection = s.collection AND i.slot = s.slot
        WHERE s.slot IS NULL OR i.slot IS NULL OR i.granule_ur <> s.granule_ur HAVING count(*) > 0
        UNION ALL
        SELECT 'references', count(*) FROM held JOIN sizes USING (collection) WHERE actual <> n * 4 HAVING count(*) > 0""",
)
def publish_gate(spark, sf):
    from scanledger.queries.references import axis_refs

    merged = pin(merged_axis(spark, sf))
    in_time = axis_entries(spark, sf).filter(F.year(x.axis_timestamp("time")) < 2000)
    from scanledger.operators.slots import assign_slots

    inventory = assign_slots(in_time).withColumnRenamed("url", "granule_url")
    refs = axis_refs(spark, sf, merged).withColumn("variable", F.lit("column"))
    expected = merged.groupBy("collection").agg((F.count(F.lit(1)) * 4).alias("expected")).withColumn("variable", F.lit("column"))
    found = validate.publish_gate(merged, inventory, refs, expected)
    return found.groupBy("check").agg(F.count(F.lit(1)).alias("n"))
