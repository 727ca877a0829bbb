"""Range-split ordering gives the same rows as one plain window, also with a hot group and hot values."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scanledger.operators import ordering
from scanledger.operators.compare import covered_cells, nearest_granule, nearest_in_time
from scanledger.operators.grid import robust_limits
from scanledger.operators.slots import assign_slots, axis_violations, merge_pending


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = []
    for i in range(900):
        # one group holds most rows, one value a third of them; one group is null
        group = "hot" if i % 10 < 7 else rnd.choice(["a", "b", None])
        at = 5.0 if i % 3 == 0 else rnd.uniform(0, 20)
        data.append((group, at, i, rnd.choice([None, rnd.randint(0, 100)])))
    return spark.createDataFrame(data, "g string, at double, id long, v int").repartition(5).cache()


def W():
    return Window.partitionBy("g").orderBy("at", "id")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ranges_are_cut(rows):
    ranges = ordering.plan_ranges(rows, ["g", "at", "id"], 50)
    assert ranges.count > 5
    sizes = rows.groupBy(ordering.range_index(["g", "at", "id"], ranges).alias("r")).count().collect()
    # the hot value is split as well: no range holds a third of the rows
    assert len(sizes) > 5 and max(s["count"] for s in sizes) < 300


def test_lag(rows):
    got = ordering.ordered_lag(rows, ["g"], ["at", "id"], ["id", "v"], "p", 50)
    assert same(got, rows.withColumn("p", F.lag(F.struct("id", "v")).over(W())))


def test_position(rows):
    got = ordering.ordered_position(rows, ["g"], ["at", "id"], "n", 50)
    assert same(got, rows.withColumn("n", F.row_number().over(W()).cast("long") - 1))


def test_running_max_and_sum(rows):
    before = W().rowsBetween(Window.unboundedPreceding, -1)
    got = ordering.ordered_running_max(rows, ["g"], ["at", "id"], "v", "m", target_rows=50)
    assert same(got, rows.withColumn("m", F.max("v").over(before)))
    upto = W().rowsBetween(Window.unboundedPreceding, 0)
    got = ordering.ordered_running_max(rows, ["g"], ["at", "id"], "v", "m", inclusive=True, target_rows=50)
    assert same(got, rows.withColumn("m", F.max("v").over(upto)))
    got = ordering.ordered_running_sum(rows, ["g"], ["at", "id"], "id", "s", 50)
    assert same(got, rows.withColumn("s", F.coalesce(F.sum("id").over(before), F.lit(0))))


def test_ranges_without_broadcast(rows, monkeypatch):
    monkeypatch.setattr("scanledger.session.BROADCAST_ROWS", 0)
    got = ordering.ordered_position(rows, ["g"], ["at", "id"], "n", 50)
    assert same(got, rows.withColumn("n", F.row_number().over(W()).cast("long") - 1))


def test_without_group(rows):
    got = ordering.ordered_position(rows, [], ["at", "id"], "n", 50)
    assert same(got, rows.withColumn("n", F.row_number().over(Window.orderBy("at", "id")).cast("long") - 1))


def test_axis_operators_agree_when_split(spark, rows):
    entries = rows.select(
        F.coalesce("g", F.lit("none")).alias("collection"), F.concat(F.lit("u"), "id").alias("granule_ur"),
        F.concat(F.lit("u"), F.col("id"), F.lit(".nc")).alias("url"), F.col("at").alias("time"), F.col("id").alias("position"),
    )
    assert same(assign_slots(entries, 60), assign_slots(entries))
    assert same(axis_violations(entries, target_rows=60), axis_violations(entries))
    old = assign_slots(entries.filter("position % 2 = 0")).withColumnRenamed("url", "granule_url")
    new = entries.filter("position % 2 = 1")
    assert same(merge_pending(old, new, 60), merge_pending(old, new))


def test_robust_limits_match_numpy(spark, rows):
    import numpy as np

    out = {r.g: (r.vmin, r.vmax) for r in robust_limits(rows.select("g", F.col("at").alias("value")), ["g"], target_rows=60).filter("g is not null").collect()}
    for g, limits in out.items():
        values = [r.at for r in rows.filter(F.col("g") == g).collect()]
        assert limits == pytest.approx(tuple(np.percentile(values, [2, 98])))


def brute_nearest(slots, records, w):
    found = {}
    for slot, t in slots:
        near = [r for r in records if r[0] <= t + w and r[1] >= t - w]
        found[slot] = min(near, key=lambda r: (abs(r[0] - t), r[2]))[2] if near else None
    return found


@pytest.mark.parametrize("seed, target, longest", [(1, None, 9_000), (2, 40, 12_000), (3, None, 252_000_000_000)])
def test_nearest_granule_is_exact(spark, seed, target, longest):
    rnd = random.Random(seed)
    starts = [rnd.choice([0, 600, 5000, rnd.uniform(-9000, 20000)]) for _ in range(60)]
    records = [(b, b + rnd.choice([0, 30, 700, 4000, 9000, longest]), i) for i, b in enumerate(starts)]
    slots = [(i, t) for i, t in enumerate(sorted({round(rnd.uniform(-500, 26000), 1) for _ in range(120)} | {360.0, 240.0, 840.0, 9240.0}))]
    r = spark.createDataFrame([("c", float(b), float(e), i, f"u{i}", f"g{i}") for b, e, i in records],
                              "collection string, begin double, end double, rank long, url string, granule_ur string")
    s = spark.createDataFrame([("c", i, float(t)) for i, t in slots], "collection string, slot int, time double")
    got = {x.slot: x.found_url for x in nearest_granule(s, r, 240.0, target).collect()}
    want = {k: v if v is None else f"u{v}" for k, v in brute_nearest(slots, records, 240.0).items()}
    assert got == want


def test_dyadic_cells_cover_a_range_once(spark):
    draw = random.Random(2)
    ranges = [(0, 0), (-1, 0), (5, 4), (-7, 9), (3, 3), (-525_000_000, 524_999_999)]
    ranges += [(a, a + draw.randint(0, 40)) for a in (draw.randint(-30, 30) for _ in range(60))]
    rows = spark.createDataFrame(ranges, "a long, b long").select("a", "b", covered_cells(F.col("a"), F.col("b")).alias("c")).collect()
    for r in rows:
        assert len(r.c) <= 2 * 40
        if r.b - r.a < 1000:
            held = [c for x in r.c for c in range(x.cell << x.level, (x.cell + 1) << x.level)]
            assert sorted(held) == list(range(r.a, r.b + 1))
        else:
            assert sum(1 << x.level for x in r.c) == r.b - r.a + 1


def test_top_of_large_groups(rows, monkeypatch):
    few = ordering.top_per_group(rows, ["g"], [F.col("at"), F.col("id")], 5)
    monkeypatch.setattr(ordering, "GROUP_LIMIT", 2)
    assert same(few, ordering.top_per_group(rows, ["g"], [F.col("at"), F.col("id")], 5))


def test_nearest_in_time_prefers_the_first_listed(spark):
    left = spark.createDataFrame([("c", 1, 10.0)], "g string, id long, at double")
    right = spark.createDataFrame([("c", 8.0, 2, "x"), ("c", 12.0, 1, "y"), ("c", 12.0, 0, "z")], "g string, at double, rank long, p string")
    got = nearest_in_time(left, right, ["g"], ["p"]).first()
    assert got.nearest.p == "z" and got.distance == 2.0


def test_lookup_counts_rows_and_bytes(spark, monkeypatch):
    from scanledger import session

    def broadcasts(rows):
        joined = spark.range(10).join(session.lookup(rows), "id")
        return "ResolvedHint (strategy=broadcast)" in joined._jdf.queryExecution().analyzed().toString()

    rows = spark.range(5).selectExpr("id", "repeat('x', 1000) AS text", "array(named_struct('a', id)) AS more")
    assert broadcasts(rows)
    monkeypatch.setattr(session, "BROADCAST_BYTES", 4_000)
    assert not broadcasts(rows)
    monkeypatch.setattr(session, "BROADCAST_ROWS", 4)
    assert not broadcasts(spark.range(5))


@pytest.mark.parametrize("target", [None, 60])
def test_neighbours_of_rows(rows, target):
    from scanledger.operators.ordering import ordered_neighbours

    taken = F.when(F.col("id") % 3 == 0, F.col("id"))
    earlier, later = W().rowsBetween(Window.unboundedPreceding, -1), W().rowsBetween(1, Window.unboundedFollowing)
    want = rows.withColumns({"before": F.max(taken).over(earlier), "after": F.first(taken, ignorenulls=True).over(later)})
    assert same(ordered_neighbours(rows, ["g"], ["at", "id"], taken, target), want)


def test_nearest_granule_shuffles_no_urls(spark, monkeypatch):
    """What is merged and sorted are times and ranks; before, urls and URs went through each stream twice."""
    from scanledger.operators import compare

    streams = []
    for name in ("ordered_neighbours", "ordered_running_max"):
        def seen(df, *args, run=getattr(compare, name), **kwargs):
            streams.append(df.schema.simpleString())
            return run(df, *args, **kwargs)

        monkeypatch.setattr(compare, name, seen)
    records = spark.createDataFrame(
        [("c", 0.0, 5000.0, 1, "u1", "g1"), ("c", 100.0, 110.0, 2, "u2", "g2")],
        "collection string, begin double, end double, rank long, url string, granule_ur string",
    )
    slots = spark.createDataFrame([("c", 0, 120.0), ("c", 1, 4000.0), ("c", 2, 9000.0)], "collection string, slot long, time double")
    found = {r.slot: (r.found_url, r.found_ur) for r in nearest_granule(slots, records).collect()}
    assert found == {0: ("u2", "g2"), 1: ("u1", "g1"), 2: (None, None)}
    assert len(streams) == 3 and not [s for s in streams if "url" in s or "granule_ur" in s]
