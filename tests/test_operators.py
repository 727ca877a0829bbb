"""Expressions, templates, references and audits on small inputs."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from scanledger.functions import expressions as x
from scanledger.operators import compare, refs
from scanledger.operators import template as tmpl
from scanledger.operators.grid import ChunkShape, inside_polygon, polygon_cells, polygon_runs, run_pieces, sampled_windows
from scanledger.operators.slots import sample_slots, spread_sample
from scanledger.operators.validate import validate_store
from scanledger.plans.verify import verify_store
from tests import tiny


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_urls(spark):
    assert one(spark, x.granule_ur(F.lit("s3://b/x/G_1.nc"))) == "G_1"
    assert tuple(one(spark, x.split_uri(F.lit("s3://bucket/a/b.json")))) == ("bucket", "a/b.json")
    assert tuple(one(spark, x.split_uri(F.lit("s3://bucket")))) == ("bucket", "")
    with pytest.raises(Exception, match="not an object uri"):
        one(spark, x.split_uri(F.lit("https://bucket/a")))
    assert one(spark, x.has_supported_scheme(F.lit("gs://b/a"))) is False
    assert one(spark, x.has_supported_scheme(F.lit("plain"))) is False


def test_times(spark):
    assert one(spark, x.axis_timestamp(F.lit(0.0))) == datetime.datetime(1980, 1, 6)
    assert one(spark, x.axis_timestamp(F.lit(1471196538.0244286))) == datetime.datetime(1980, 1, 6) + datetime.timedelta(seconds=1471196538.024429)
    assert one(spark, x.parse_instant(F.lit("2026-08-20T10:00:00+02:00"))) == datetime.datetime(2026, 8, 20, 8)
    assert one(spark, x.parse_instant(F.lit("soon"))) is None


@pytest.mark.parametrize(
    "a, b, equal",
    [('"NaN"', "NaN", True), ("1", "1.0", True), ("[1, 2.0]", "[1.0, 2]", True), ('["NaN",1]', "[NaN,1]", True), ('"x,1.0,y"', '"x,1,y"', False),
     ('"a"', '"b"', False), ("1e3", "1000", True), (None, None, True), (None, "1", False), ('"-Infinity"', "-Infinity", True), ('"say \\"NaN\\""', '"say NaN"', False),
     ("1e7", "10000000", True), ("-1e30", "-1" + "0" * 30, True), ("1e400", "Infinity", False), ("1e400", "1E+400", True), ("0.0", "-0", True),
     ("9007199254740993", "9007199254740992", False), ('{"a":1,"b":[1.0,2]}', '{"b":[1,2.00e0],"a":1}', True), ('"a1e7"', '"a10000000"', False),
     ('true', ' true', True), ('true', 'false', False),
     ('[1e2,"1e2"]', '[100,"1e2"]', True), ("01", "1", False), ('"1"', "1", False), ('"' + "x" * 200_000 + '"', '"' + "x" * 200_000 + 'y"', False)],
)
def test_values_equal(spark, a, b, equal):
    assert one(spark, x.values_equal(F.lit(a).cast("string"), F.lit(b).cast("string"))) is equal


def test_short_ways_agree_with_canonical_values(spark):
    """Numbers, strings and texts that go straight to the parser are equal exactly if their canonical spellings are."""
    texts = [
        "0", "-0", "0.0", "-0.00", "1", "-1", "1.0", "10", "10.50", "10.5", "1e1", "1.0E+1", "01", "+1", ".5", "1.", "1\n", " 1", "NaN", '"NaN"', "-Infinity", '"-Infinity"',
        '"1"', '""', '"', '"a', "red widget", '"red widget"', '"say \\"x\\""', '"\\u0061"', '"a"', "123456789012345678.5", "123456789012345678.50", "1234567890123456789",
        "1234567890123456789.0", "0.000000000000000001", "0.0000000000000000010", "1e-18", "[1000]", "[1000.0]", "[1e3]", "[-0.0]", "[0]", "[100]", "[100.00]", "{}", "[]", "null", " null",
        "[" + "9" * 36 + "]", "[" + "9" * 36 + ".0]", "[" + "9" * 45 + "]", "[" + "9" * 45 + ".0]", "[1" + "0" * 45 + "]", "[1e45]", '{"b":[1.50,"x"],"a":null}', '{"a":null,"b":[1.5,"x"]}',
        '{"a":null,"b":[15e-1,"x"]}', '{"a":1,"a":1}', "[NaN]", '["NaN"]', "[1,]", None,
    ]
    rows = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    wrong = rows.withColumn("got", x.values_equal("a", "b")).filter(~F.col("got").eqNullSafe(x.canonical_json("a").eqNullSafe(x.canonical_json("b"))))
    assert wrong.collect() == []


def test_equality_computes_its_arguments_once(spark):
    """Before, each argument was computed anew wherever the comparison named it."""
    seen = spark.range(1).select(x.values_equal(F.col("id").cast("string"), F.lit("other argument")).alias("e"))
    assert seen._jdf.queryExecution().analyzed().expressions().toString().count("other argument") == 1


def test_fill_and_chunks(spark):
    assert one(spark, F.isnan(x.mask_fill(F.lit(-9999).cast("short"), F.lit(-9999.0)))) is True
    assert one(spark, x.mask_fill(F.lit(3), None)) == 3
    shape, chunk = F.array(F.lit(10), F.lit(2950), F.lit(7750)), F.array(F.lit(1), F.lit(738), F.lit(1938))
    assert one(spark, x.expected_chunks(shape, chunk)) == 160
    assert one(spark, x.expected_chunks(F.array(F.lit(0), F.lit(5)), F.array(F.lit(1), F.lit(2)))) == 0


def test_template_of_the_tiny_collection(spark):
    t = {r.path: r for r in tiny.template(spark).collect()}
    assert set(t) == {"", "/time", "/latitude", "/longitude", "/weight", "/vertical_column", "/main_data_quality_flag", "/solar_zenith_angle",
                      "/surface_pressure", "/granule_ur", "/granule_url"}
    assert t["/weight"].dims == ["time", "latitude", "longitude"] and t["/weight"].chunk_shape == [1, 4, 6]
    assert t["/time"].chunk_shape == [16] and t["/granule_ur"].chunk_shape == [16]
    assert set(t[""].attributes) == {"Conventions", "project"}
    named = tiny.template(spark).withColumn("collection", F.lit("c"))
    lengths = spark.createDataFrame([("c", 13611)], "collection string, n_slots int")
    expected = {r.variable: r.expected for r in refs.expected_references(named, lengths).collect()}
    assert expected == {"weight": 13611, **{v: 4 * 13611 for v in tiny.CHUNKED}}


def test_reference_granules_must_agree(spark):
    from scanledger.plans.template import derive_template

    granules = [*tiny.first_granules(), tiny.granule("odd", tiny.TIMES[0], project='"OTHER"', latitude=[1.0, 2.0, 3.0, 4.0])]
    _, grid, findings = derive_template(tiny.headers_of(spark, granules), tiny.url_of("granule_0"), tiny.CONFIG)
    assert grid.exceptAll(tiny.coordinates(spark)).count() == 0 and grid.count() == 10
    assert {(f.check, f.subject) for f in findings.collect()} == {
        ("coordinates", tiny.url_of("odd")), ("attributes", tiny.url_of("odd")), ("varying_attributes", " project")}


def test_resize_keeps_chunks_and_names_unknown_dims(spark):
    out = {r.path: r for r in tmpl.resize_dims(tiny.template(spark), {"time": 9}).collect()}
    assert out["/vertical_column"].shape == [9, 4, 6] and out["/vertical_column"].chunk_shape == [1, 2, 3] and out["/latitude"].shape == [4]
    assert [r.dim for r in tmpl.unknown_dims(tiny.template(spark), {"time": 1, "depth": 2}).collect()] == ["depth"]


def store_findings(spark, change, allow_extra=False):
    template = tiny.template(spark)
    return {(f.check, f.subject, f.severity) for f in validate_store(template, change(template), allow_extra, {"history"}).collect()}


def test_store_validation(spark):
    column = F.col("path") == "/vertical_column"

    def with_attribute(key, value):
        return lambda t: t.withColumn("attributes", F.when(column, F.map_concat(x.without_keys("attributes", [key]), F.create_map(F.lit(key), F.lit(value)))).otherwise(F.col("attributes")))

    assert store_findings(spark, lambda t: t) == set()
    assert store_findings(spark, lambda t: t.filter(~column)) == {("nodes", "/vertical_column", "error")}
    extra = lambda t: t.unionByName(t.filter(column).withColumn("path", F.lit("/new")))
    assert store_findings(spark, extra) == {("nodes", "/new", "error")} and store_findings(spark, extra, True) == set()
    assert store_findings(spark, lambda t: t.withColumn("shape", F.when(column, F.array(F.lit(2))).otherwise(F.col("shape")))) == {("nodes", "/vertical_column", "error")}
    assert store_findings(spark, with_attribute("units", '"K"')) == {("attributes", "/vertical_column", "error")}
    assert store_findings(spark, with_attribute("more", "1")) == {("attributes", "/vertical_column", "warning")}
    assert store_findings(spark, with_attribute("history", "1")) == set()
    nan = lambda t: t.withColumn("fill_value", F.when(column, F.lit("-1.0E30")).otherwise(F.col("fill_value")))
    assert store_findings(spark, nan) == set()


def test_last_writer_wins(spark):
    rows = [(1, "v", s, 0, 0, s) for s in (0, 1, 2)] + [(2, "v", s, 0, 0, s) for s in (3, 4, 5)] + [(2, "v", 0, 0, 0, 5)]
    writes = spark.createDataFrame(rows, "writer_seq int, variable string, slot int, cy int, cx int, payload int")
    key = ["variable", "slot", "cy", "cx"]
    merged = refs.merge_writes(writes, key, ["payload"], ["writer_seq"])
    assert {r.slot: r.payload for r in merged.collect()} == {0: 5, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5}
    assert [(r.slot, r.writers) for r in refs.overlapping_writes(writes, key, "writer_seq").collect()] == [(0, 2)]


def test_overlaps_are_counted_without_holding_keys(spark):
    """One shuffle of bare rows; before, the tasks that read held every key in memory and dealt them out twice."""
    rows = [("v", 0, 1), ("v", 0, 1), ("v", 0, 3), ("v", 0, 2), ("v", 0, None), ("v", 1, 4), ("v", 1, 4), ("v", 2, None), ("v", 2, 5), (None, 3, 1), (None, 3, 2)]
    writes = spark.createDataFrame(rows, "variable string, slot int, writer int")
    out = refs.overlapping_writes(writes, ["variable", "slot"], "writer")
    steps = out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.slot, r.writers) for r in out.collect()) == [(0, 3), (3, 2)]
    assert "distinct" not in steps and steps.count("Exchange hashpartitioning") == 1
    assert "HashAggregate" not in steps[steps.rindex("Exchange hashpartitioning"):]


def test_arrays_of_several_slots_per_chunk_cannot_move(spark):
    assert refs.unmovable_arrays(tiny.template(spark)).count() == 0
    wide = tiny.template(spark).withColumn("chunk_shape", F.when(F.col("path") == "/weight", F.array(F.lit(2), F.lit(4), F.lit(6))).otherwise(F.col("chunk_shape")))
    assert [(r.path, r.slots_per_chunk) for r in refs.unmovable_arrays(wide).collect()] == [("/weight", 2)]


def test_missing_and_longer_axes(spark):
    ref = tiny.coordinates(spark)
    assert compare.compare_coordinates(ref, ref).count() == 0
    short = ref.filter(~((F.col("axis") == "latitude") & (F.col("idx") == 3)))
    assert [(r.axis, r.problem) for r in compare.compare_coordinates(ref, short).collect()] == [("latitude", "length")]
    gone = ref.filter("axis = 'latitude'")
    assert [(r.axis, r.problem) for r in compare.compare_coordinates(ref, gone).collect()] == [("longitude", "missing")]
    nan = ref.withColumn("value", F.when(F.col("idx") == 0, F.lit(float("nan"))).otherwise(F.col("value")).cast("float"))
    assert {r.problem for r in compare.compare_coordinates(nan, nan).collect()} == {"values"}


def test_spread_and_samples(spark):
    g = spark.createDataFrame([(float(t), i) for i, t in enumerate([0, 1, 9, 35, 36, 99, 100])], "t double, i int")
    out = spread_sample(g, 10, F.lit(0.0), F.lit(100.0), "t", ["i"])
    assert sorted(r.i for r in out.collect()) == [0, 3, 5]
    slots = spark.createDataFrame([("c", i) for i in range(50)], "collection string, slot int")
    picks = {seed: {r.slot for r in sample_slots(slots, 8, seed).collect()} for seed in (0, 1)}
    assert len(picks[0]) == 8 and picks[0] != picks[1]
    assert sample_slots(slots, 99).count() == 50


def test_top_of_each_group_is_limited_before_the_shuffle(spark):
    slots = spark.range(1000).select((F.col("id") % 3).cast("string").alias("collection"), F.col("id").cast("int").alias("slot"))
    assert "WindowGroupLimit" in sample_slots(slots, 8)._jdf.queryExecution().toString()


def test_polygon(spark):
    square = [(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0)]
    points = spark.createDataFrame([(5.0, 5.0), (5.0, 11.0), (-1.0, 5.0), (9.9, 0.1)], "lat double, lon double")
    assert [r.v for r in points.select(inside_polygon(F.col("lat"), F.col("lon"), square).alias("v")).collect()] == [True, False, False, True]


# -- audit ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def audit(spark):
    """Three 4 x 6 slots in 2 x 3 chunks and their sources."""
    slots = spark.createDataFrame([("c", i, t, f"g{i}", f"g{i}.nc") for i, t in enumerate(tiny.TIMES)], "collection string, slot int, time double, granule_ur string, granule_url string")
    chunks = [("c", "column", s, cy, cx, [float(s + 10 * (cy * 2 + k // 3) + cx * 3 + k % 3) for k in range(6)]) for s in range(3) for cy in range(2) for cx in range(2)]
    stored = spark.createDataFrame(chunks, "collection string, variable string, slot int, cy int, cx int, `values` array<double>")
    source = stored.select(F.concat(F.lit("g"), "slot", F.lit(".nc")).alias("url"), "variable", "cy", "cx", "values")
    heads = slots.select(F.col("granule_url").alias("url"), "time")
    grids = spark.createDataFrame([("c", "column", 4, 6, 12.0)], "collection string, variable string, ny int, nx int, fill double")
    return slots, stored, heads, source, grids, ChunkShape(2, 3)


def found(slots, stored, heads, source, grids, shape, **kw):
    return sorted((f.check, f.subject) for f in verify_store(slots, stored, heads, source, grids, shape, window=9, **kw).collect())


def test_clean_archive_has_no_findings(audit):
    assert found(*audit) == []


def test_wrong_reference_wrong_time_and_unreadable_source(audit):
    slots, stored, heads, source, grids, shape = audit
    wrong = source.withColumn("values", F.when((F.col("url") == "g1.nc") & (F.col("cy") == 1), F.transform("values", lambda v: v + 1)).otherwise(F.col("values")))
    assert found(slots, stored, heads, wrong, grids, shape) == [("values", "c/1/column")]
    assert found(slots, stored, heads.filter("url <> 'g2.nc'"), source, grids, shape) == [("read", "c/2")]
    late = heads.withColumn("time", F.when(F.col("url") == "g0.nc", F.col("time") + 1).otherwise(F.col("time")))
    assert found(slots, stored, late, source, grids, shape) == [("time", "c/0")]
    gone = source.filter("url <> 'g0.nc'")
    assert found(slots, stored, heads, gone, grids, shape) == [("values", "c/0/column")]


def test_superseded_and_vanished_granules(spark, audit):
    slots, stored, heads, source, grids, shape = audit
    records = spark.createDataFrame(
        [("c", tiny.TIMES[0] + 30, tiny.TIMES[0] + 90, 0, "g0.nc", "g0"), ("c", tiny.TIMES[1] - 20, tiny.TIMES[1], 1, "g1_new.nc", "g1")],
        "collection string, begin double, end double, rank long, url string, granule_ur string")
    more = heads.unionByName(heads.filter("url = 'g1.nc'").withColumn("url", F.lit("g1_new.nc")))
    moved = source.unionByName(source.filter("url = 'g1.nc'").withColumn("url", F.lit("g1_new.nc")))
    assert found(slots, stored, more, moved, grids, shape, records=records) == [("catalogue", "c/2"), ("url_drift", "c/1")]


def test_audit_reads_only_what_was_drawn(spark, tmp_path, audit):
    """Forty slots of two collections in one file each: the scans see the drawn collections, slots and chunks only."""
    from pyspark.sql import Row
    from scanledger.plans.verify import _restricted

    chunks = [(c, "column", s, cy, cx, [0.0] * 6) for c in "cd" for s in range(40) for cy in range(2) for cx in range(4)]
    table = spark.createDataFrame(chunks, "collection string, variable string, slot int, cy int, cx int, `values` array<double>")
    table.repartitionByRange(8, "slot").sortWithinPartitions("slot").write.partitionBy("collection", "variable").parquet(str(tmp_path / "chunks"))
    stored = spark.read.parquet(str(tmp_path / "chunks"))
    drawn = [Row(collection="c", slot=7, variable="column", y0=0, x0=0)]
    left = _restricted(stored, drawn, {"collection": "collection", "slot": "slot", "variable": "variable"}, ChunkShape(2, 3), 2)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "collection" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(slot,7)" in pushed or "In(slot, [7" in pushed
    assert "LessThanOrEqual(cx,0)" in pushed and "LessThanOrEqual(cy,0)" in pushed
    assert left.select(F.input_file_name()).distinct().count() == 1 and left.count() == 1
    slots, held, heads, source, grids, shape = audit
    assert found(slots, held, heads, source, grids, shape, samples=1) == []


def test_windows_read_only_their_chunks(audit):
    slots, stored, _, _, _, shape = audit
    windows = slots.select("collection", "slot", F.lit("column").alias("variable"), F.lit(1).alias("y0"), F.lit(2).alias("x0"))
    cells = sampled_windows(stored, shape, windows, 2, ["collection", "slot", "variable"])
    assert {(r.y, r.x, r.value) for r in cells.filter("slot = 0").collect()} == {(1, 2, 12.0), (1, 3, 13.0), (2, 2, 22.0), (2, 3, 23.0)}


def test_references_move_alike_with_and_without_broadcast(spark, monkeypatch):
    from scanledger import schema

    now = datetime.datetime(2024, 1, 1)
    held = spark.createDataFrame([("c", "v", s, 0, 0, f"g{s}", s, 1, now) for s in range(5)] + [("d", "v", 7, 0, 0, "h", 7, 1, now)], schema.CHUNK_REFS)
    moves = spark.createDataFrame([("c", "g2", 2, 3), ("c", "g3", 3, 4)], "collection string, granule_ur string, old_slot int, new_slot int")
    shifts = spark.createDataFrame([("c", 2)], "collection string, first_shift int")
    want = {("c", 0, 0), ("c", 1, 1), ("c", 3, 2), ("c", 4, 3), ("d", 7, 7)}  # slot 4 had no move and is cleared
    for limit in (500_000, 0):
        monkeypatch.setattr("scanledger.session.BROADCAST_ROWS", limit)
        out = refs.relocate_refs(held, moves, shifts)
        assert {(r.collection, r.slot, r.offset) for r in out.collect()} == want


def test_axes_are_compared_to_the_last_value(spark, tmp_path):
    import __spark_entry__ as entry

    base = [float(i) for i in range(64)]
    vectors = [(0, base, 1), (1, base, 1), (2, base[:8] + [-1.0] + base[9:], 1), (3, base[:63] + [-1.0], 1), (4, base, 7)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").write.parquet(str(tmp_path / "part.parquet"))
    queries = entry.queries()
    axes = queries["compare_axes"](spark, str(tmp_path)).filter("problem = 'values'").collect()
    assert sorted(r.vec_id for r in axes) == [2, 3]
    found = queries["granule_findings"](spark, str(tmp_path)).filter("check = 'coordinates' AND detail LIKE '%values'").collect()
    assert sorted(r.subject for r in found) == ["2", "3"]


def test_template_keeps_codecs(spark):
    h = tiny.headers_of(spark, tiny.first_granules()[:1])
    held = F.when(F.col("name") == "weight", F.array(F.lit('{"name": "zlib"}')))
    made = tmpl.build_template(h["vars"].withColumn("codecs", held), h["nodes"], tiny.url_of("granule_0"), tiny.CONFIG)
    codecs = {r.path: r.codecs for r in made.filter("node_type = 'array'").collect()}
    assert codecs.pop("/weight") == ['{"name": "zlib"}'] and len(codecs) > 2 and not any(codecs.values())
    assert {r.path for r in tiny.template(spark).filter("size(codecs) > 0").collect()} == set()


def test_polygon_runs_are_the_cells_inside(spark):
    draw = random.Random(11)
    axis = lambda n, start, step: [(i, start + step * i) for i in range(n)]
    lats, lons = axis(23, 10.0, 0.75), axis(37, -100.0, 0.5)
    lons[5:9] = [(i, v) for (i, _), (_, v) in zip(lons[5:9], reversed(lons[5:9]))]  # an axis need not rise
    points = spark.createDataFrame([(y, x, la, lo) for y, la in lats for x, lo in lons], "y int, x int, lat double, lon double")
    for corners in (3, 5, 9):  # edges of the larger ones cross each other
        polygon = [(draw.uniform(9, 28), draw.uniform(-101, -80)) for _ in range(corners)]
        want = {(r.y, r.x) for r in points.filter(inside_polygon(F.col("lat"), F.col("lon"), polygon)).collect()}
        runs = polygon_runs(lats, lons, polygon)
        assert {(y, x) for y, a, b in runs for x in range(a, b + 1)} == want
        cells = [(cy * 4 + (at - 1) // 8, x + k) for cy, cx, y, x, at, n in run_pieces(runs, ChunkShape(4, 8)) for k in range(n)]
        assert sorted(cells) == sorted(want)


def test_polygon_bounds_reach_the_scan(spark, tmp_path):
    chunks = [("v", 0, cy, cx, [float(cy * 100 + cx * 10 + i) for i in range(4)]) for cy in range(6) for cx in range(6)]
    spark.createDataFrame(chunks, "variable string, slot int, cy int, cx int, values array<double>").write.parquet(str(tmp_path / "c"))
    axis = spark.createDataFrame([(i, float(i)) for i in range(12)], "idx int, value double")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    out = polygon_cells(spark.read.parquet(str(tmp_path / "c")), ChunkShape(2, 2), axis, axis, [(3.5, 3.5), (3.5, 6.5), (6.5, 6.5), (6.5, 3.5)], ["slot"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(cy,2)" in plan and "LessThanOrEqual(cx,3)" in plan
    assert sorted((r.y, r.x, r.value) for r in out.collect()) == sorted(
        (y, x, y // 2 * 100 + x // 2 * 10 + y % 2 * 2.0 + x % 2) for y in (4, 5, 6) for x in (4, 5, 6)
    )


def test_references_in_chunk_order_are_read_by_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from scanledger.operators.grid import touching
    from scanledger.operators.refs import in_chunk_order

    side = 128
    refs = spark.range(side * side * 8).select(
        F.lit("c").alias("collection"), F.lit("v").alias("variable"), (F.col("id") % 8).cast("int").alias("slot"),
        (F.floor(F.col("id") / 8) % side).cast("int").alias("cy"), (F.floor(F.col("id") / (8 * side))).cast("int").alias("cx"),
        F.concat(F.lit("s3://archive/"), F.sha2(F.col("id").cast("string"), 256)).alias("url"),
    ).coalesce(1)

    def needed(name, df, y, x):
        folder = str(tmp_path / name)
        df.write.option("parquet.block.size", 256 * 1024).parquet(folder)
        groups = met = 0
        for file in glob.glob(f"{folder}/*.parquet"):
            meta = pq.ParquetFile(file).metadata
            for i in range(meta.num_row_groups):
                row = meta.row_group(i)
                at = {row.column(j).path_in_schema: row.column(j).statistics for j in range(row.num_columns)}
                groups += 1
                met += at["cy"].min <= y <= at["cy"].max and at["cx"].min <= x <= at["cx"].max
        window = touching(spark.read.parquet(folder), ChunkShape(1, 1), y, x, 3, 3)
        assert "GreaterThanOrEqual(cy" in window._jdf.queryExecution().executedPlan().toString()
        return groups, met, sorted(window.select("slot", "cy", "cx", "url").collect())

    by_row = needed("plain", refs.sortWithinPartitions("slot", "cy", "cx"), 40, 70)
    ordered = needed("ordered", in_chunk_order(refs, ["collection", "variable"]), 40, 70)
    assert by_row[2] == ordered[2] and len(ordered[2]) == 72
    assert ordered[0] > 16 and 4 * ordered[1] <= by_row[1]  # boxes of neighbouring stretches of the curve may overlap


def test_the_curve_takes_bits_in_turn(spark):
    pairs = [(0, 0), (0, 1), (1, 0), (5, 3), (2**31 - 1, 2**31 - 1), (2**31 - 1, 0), (12345, 678901)]
    found = spark.createDataFrame(pairs, "y int, x int").select("y", "x", x.interleaved("y", "x").alias("z")).collect()
    for r in found:
        assert r.z == sum(((r.y >> i & 1) << (2 * i + 1)) | ((r.x >> i & 1) << (2 * i)) for i in range(31))


def test_attributes_are_compared_once(spark):
    """Before, errors and warnings each compared all attributes, and again for every condition on the outcome."""
    schema = "path string, node_type string, data_type string, shape array<int>, chunk_shape array<int>, fill_value string, codecs array<string>, dims array<string>, attributes map<string,string>"
    def nodes(attributes):
        return spark.createDataFrame([("/v", "group", None, None, None, None, None, None, attributes)], schema)

    found = validate_store(nodes({"a": "1", "b": "2"}), nodes({"a": "1.0", "b": "3", "c": "x"}))
    assert {(f.detail, f.severity) for f in found.collect()} == {("attribute b differs", "error"), ("attribute c extra", "warning")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_union(") == 1


def test_much_work_a_row_reaches_all_cores(spark):
    """The table of parts is a few megabytes, which one or two tasks read."""
    import __spark_entry__

    found = __spark_entry__.queries()["values_equal"](spark, "/root/testdata/sf0.001")
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
