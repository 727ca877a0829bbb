"""Routing against a row-by-row model, ledger rules, and the round trip through re-sort."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scanledger import schema
from scanledger.operators import routing, slots as axis_ops
from scanledger.session import pin
from scanledger.streaming.forward import changed_tail

ARRIVAL = "delivery long, collection string, granule_ur string, url string, time double, valid boolean"


def model(arrivals, committed):
    """The rules, one arrival after the other."""
    axes = {}
    for collection, time, ur in committed:
        axes.setdefault(collection, []).append((time, ur))
    outcomes = {}
    for delivery, collection, ur, _, time, valid in sorted(arrivals):
        axis = axes.setdefault(collection, [])
        owner = [u for t, u in axis if t == time]
        if not valid or time != time:
            outcomes[delivery] = "rejected"
        elif owner:
            outcomes[delivery] = "written" if owner == [ur] else "rejected"
        elif any(u == ur for _, u in axis):
            outcomes[delivery] = "rejected"
        elif not axis or time > max(t for t, _ in axis):
            axis.append((time, ur))
            outcomes[delivery] = "written"
        else:
            outcomes[delivery] = "deferred"
    return outcomes


def frames(spark, arrivals, committed):
    rows = [(c, t, u, u + ".nc", "old") for c, t, u in committed]
    slots = spark.createDataFrame(rows, "collection string, time double, granule_ur string, granule_url string, ref_stage string")
    return spark.createDataFrame(arrivals, ARRIVAL), axis_ops.assign_slots(slots)


def outcomes_of(routed):
    return {r.delivery: r.outcome for r in routed.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_random_batches(spark, seed):
    rnd = random.Random(seed)
    committed = [(c, float(t), f"s{c}{t}") for c in "ab" for t in range(rnd.choice([0, 1, 5]))]
    urs = [f"u{i}" for i in range(rnd.choice([4, 30]))] + ["sa1", "sb2"]
    arrivals = []
    for i in range(80):
        base = i / 3 if seed % 2 else rnd.randint(0, 30)
        ur, time = rnd.choice(urs), float(int(base + rnd.randint(-3, 3)))
        arrivals.append((i, rnd.choice("aab"), ur, f"{ur}.nc", rnd.choice([time] * 30 + [float("nan")]), rnd.random() > 0.05))
    a, s = frames(spark, arrivals, committed)
    assert outcomes_of(routing.route_arrivals(a, s, ["delivery"], 20 if seed < 2 else None)) == model(arrivals, committed)


def test_chain_of_blocked_granules(spark):
    # whether each arrival is appended depends on the one before it
    arrivals, time = [], 0.0
    for i in range(6):
        arrivals += [(4 * i, "a", f"u{i}", "x.nc", time + 2, True), (4 * i + 1, "a", f"u{i}", "x.nc", time + 5, True),
                     (4 * i + 2, "a", f"u{i + 1}", "x.nc", time + 4, True), (4 * i + 3, "a", f"u{i + 1}", "x.nc", time + 6, True)]
        time += 3
    a, s = frames(spark, arrivals, [])
    assert outcomes_of(routing.route_arrivals(a, s, ["delivery"])) == model(arrivals, [])


def chain(names):
    """A10 A20 B17 B27 C24 C34 ...: whether a name's first row is appended depends on the name before it."""
    return [(2 * i + k, "a", f"u{i:03d}", "x.nc", 10.0 + 7 * i + 10 * k, True) for i in range(names) for k in (0, 1)]


def tangle(names, delivery=0, start=0.0):
    """Every name's first row comes too late to be appended because the one before it was appended by its second."""
    rows = [("v", 10.0), ("w", 3.0), ("w", 12.0)]
    for i in range(names):
        rows += [(f"t{i}", 11.5 + i), (f"t{i}", 13.0 + i)]
    return [(delivery + i, "a", f"{start}{ur}", "x.nc", start + time, True) for i, (ur, time) in enumerate(rows)]


@pytest.mark.parametrize("fold_rows", [0, 1_000])
def test_long_chains_take_as_many_checkpoints_as_short_ones(spark, monkeypatch, fold_rows):
    made = []
    monkeypatch.setattr(routing, "pin", lambda df: made.append(1) or pin(df))
    counts = {}
    for names in (16, 64):
        a, s = frames(spark, chain(names), [])
        made.clear()
        assert outcomes_of(routing.route_arrivals(a, s, ["delivery"], fold_rows=fold_rows)) == model(chain(names), [])
        counts[names] = len(made)
    assert counts[16] == counts[64] <= 12


def test_rounds_settle_all_pieces_at_once(spark, monkeypatch):
    """Ten tangles behind each other take as many rounds as one."""
    made = []
    monkeypatch.setattr(routing, "pin", lambda df: made.append(1) or pin(df))
    counts = {}
    for times in (1, 10):
        arrivals = [row for i in range(times) for row in tangle(4, 100 * i, 1000.0 * i)]
        a, s = frames(spark, arrivals, [])
        made.clear()
        assert outcomes_of(routing.route_arrivals(a, s, ["delivery"], fold_rows=0)) == model(arrivals, [])
        counts[times] = len(made)
    assert counts[1] == counts[10]


@pytest.mark.parametrize("fold_rows", [0, 6])
def test_random_repeats(spark, fold_rows):
    rnd = random.Random(fold_rows)
    arrivals = [(i, rnd.choice("aab"), f"u{rnd.randint(0, 9) + i // 12}", "x.nc", float(i // 3 + rnd.randint(0, 9)), True) for i in range(150)]
    a, s = frames(spark, arrivals, [("a", 3.0, "u0")])
    assert outcomes_of(routing.route_arrivals(a, s, ["delivery"], fold_rows=fold_rows)) == model(arrivals, [("a", 3.0, "u0")])
    assert outcomes_of(routing.route_arrivals(a, s, ["delivery"], 20, fold_rows)) == model(arrivals, [("a", 3.0, "u0")])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 5), st.integers(0, 12)), min_size=1, max_size=25))
def test_any_batch(spark, drawn):
    arrivals = [(i, c, f"u{u}", f"u{u}.nc", float(t), True) for i, (c, u, t) in enumerate(drawn)]
    a, s = frames(spark, arrivals, [("a", 3.0, "u0")])
    assert outcomes_of(routing.route_arrivals(a, s, ["delivery"])) == model(arrivals, [("a", 3.0, "u0")])


def test_permutation_resorts_to_the_inventory(spark):
    """Any arrival order, routed and then folded to the end, gives the sorted inventory; delivering
    everything again changes nothing."""
    rnd = random.Random(9)
    times = [float(t) for t in range(40)]
    rnd.shuffle(times)
    arrivals = [(i, "a", f"g{int(t):02d}", f"g{int(t):02d}.nc", t, True) for i, t in enumerate(times)]
    a, s = frames(spark, arrivals, [])
    routed = routing.route_arrivals(a, s, ["delivery"]).cache()
    axis = routing.sync_slots(s, routed, ["delivery"], "new")
    pending = routing.ledger_after(spark.createDataFrame([], schema.PENDING), routed, "delivery")
    assert axis_ops.stuck_pending(pending, axis).count() == 0
    while pending.count():
        fold = axis_ops.earliest_pending(pending, 15)
        merged = axis_ops.merge_pending(axis, fold)
        assert axis_ops.axis_violations(merged, "slot").count() == 0
        axis = pin(merged.withColumn("ref_stage", F.lit("x")))
        pending = pin(axis_ops.drain_pending(pending, fold))
    rows = [(r.slot, r.granule_ur, r.time) for r in axis.orderBy("slot").collect()]
    assert rows == [(i, f"g{i:02d}", float(i)) for i in range(40)]
    again = routing.route_arrivals(a, axis, ["delivery"])
    assert {(r.outcome, r.action) for r in again.collect()} == {("written", "overwrite")}


def test_ledger_keeps_the_place_of_a_corrected_entry(spark):
    pending = spark.createDataFrame([("a", "G1", "old.nc", 5.0, 1), ("a", "G2", "g2.nc", 6.0, 2)], schema.PENDING)
    news = spark.createDataFrame([("a", "G1", "new.nc", 5.5, 10), ("a", "G3", "g3.nc", 7.0, 11), ("a", "G1", "newer.nc", 5.7, 12)], schema.PENDING)
    rows = axis_ops.upsert_pending(pending, news).orderBy("seq").collect()
    assert [(r.granule_ur, r.url, r.time) for r in rows] == [("G1", "newer.nc", 5.7), ("G2", "g2.nc", 6.0), ("G3", "g3.nc", 7.0)]


def test_failed_commit_reports_every_message(spark):
    routed = spark.createDataFrame([("m1", "written"), ("m2", "rejected")], "message_id string, outcome string")
    assert [r.message_id for r in routing.batch_result(routed).collect()] == ["m2"]
    assert routing.batch_result(routed, committed=False).count() == 2


def test_a_batch_writes_only_the_rows_it_changes(spark):
    """Ten arrivals on an axis of a million slots: ten rows, the same axis as numbering everything again."""
    slots = pin(spark.range(1_000_000).select(
        F.lit("a").alias("collection"), F.col("id").cast("int").alias("slot"), F.col("id").cast("double").alias("time"),
        F.concat(F.lit("s"), "id").alias("granule_ur"), F.lit("old").alias("granule_url"), F.lit("first").alias("ref_stage"),
    ))
    arrivals = [(i, "a", f"n{i}", "new", 1_000_000.0 + i, True) for i in range(8)]
    arrivals += [(8, "a", "s5", "again", 5.0, True), (9, "a", "s77", "again", 77.0, True), (10, "b", "n0", "new", 3.0, True)]
    routed = pin(routing.route_arrivals(spark.createDataFrame(arrivals, ARRIVAL), slots, ["delivery"]))
    changes = pin(routing.axis_changes(slots, routed, ["delivery"], "second"))
    assert sorted((r.collection, r.slot, r.granule_ur, r.granule_url, r.ref_stage) for r in changes.collect()) == sorted(
        [("a", 1_000_000 + i, f"n{i}", "new", "second") for i in range(8)]
        + [("a", 5, "s5", "again", "second"), ("a", 77, "s77", "again", "second"), ("b", 0, "n0", "new", "second")]
    )
    axis = routing.with_changes(slots, changes)
    assert axis.count() == 1_000_009 and axis.filter("ref_stage = 'first'").count() == 999_998
    tail = changed_tail(slots, changes)
    assert tail.count() == 12  # the changed rows and the last committed one
