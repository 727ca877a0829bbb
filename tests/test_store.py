"""Backfill, forward batches, re-sort and publishing on the tiny collection."""

import datetime
import json
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scanledger.operators.findings import InvalidData
from scanledger.operators.refs import relocate_refs
from scanledger.operators.slots import first_shift, relocation_map
from scanledger.plans.backfill import backfill, header_findings
from scanledger.plans.resort import resort
from scanledger.plans.store import Store, VersionMoved
from scanledger.streaming.forward import process_batch, read_message_stream, run_forward
from tests import tiny
from tests.tiny import CONFIG, TIMES, granule


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """The archive after its backfill; tests work on copies."""
    store = tiny.new_store(spark, tmp_path_factory.mktemp("built") / "archive")
    granules = tiny.first_granules()
    backfill(store, tiny.entries_of(spark, granules), tiny.header(spark), tiny.headers_of(spark, granules), CONFIG)
    return store


@pytest.fixture()
def filled(built, tmp_path):
    shutil.copytree(built.base, tmp_path / "archive")
    return Store(built.spark, str(tmp_path / "archive"))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    """An initialized archive that no test manages to publish into."""
    return tiny.new_store(spark, tmp_path_factory.mktemp("empty") / "archive")


def feed(store, granules, batch_id, **kw):
    return process_batch(
        store, tiny.messages(store.spark, granules), tiny.headers_of(store.spark, granules), CONFIG, batch_id, **kw
    )


def test_uninitialized_store_refuses_work(spark, tmp_path):
    with pytest.raises(InvalidData, match="not initialized"):
        Store(spark, str(tmp_path / "none")).require_initialized()


def test_initialize_is_idempotent_and_empty(spark, empty):
    store = empty
    assert store.current().number == 1
    assert tiny.new_store(spark, store.base).current().number == 1
    assert store.read_inventory(store.current(), CONFIG.collection) is None
    assert tiny.axis(store) == [] and tiny.ledger(store) == []
    assert store.granule_refs().count() == 0


def test_backfill_places_every_reference(filled):
    assert [a[1] for a in tiny.axis(filled)] == ["granule_0", "granule_1", "granule_2"]
    assert [a[2] for a in tiny.axis(filled)] == TIMES
    inventory = filled.read_inventory(filled.current(), CONFIG.collection)
    assert [r.url for r in inventory.orderBy("position").collect()] == [tiny.url_of(f"granule_{i}") for i in range(3)]
    refs = filled.chunk_refs(filled.slots(filled.current()))
    assert refs.count() == 3 * tiny.REFS_PER_GRANULE
    assert {r.url for r in refs.filter("slot = 1").collect()} == {tiny.url_of("granule_1")}
    assert {r.last_updated_at for r in refs.collect()} == {tiny.STAMP}


def test_every_broken_granule_is_found(spark, empty):
    broken = [
        ("grid", {"latitude": [1.0, 2.0, 3.0, 4.0]}, "coordinates: latitude values"),
        ("nan_grid", {"latitude": [float("nan"), *tiny.LATITUDE[1:]]}, "coordinates: latitude values"),
        ("epoch", {"epoch": TIMES[1] + 1}, "granule_time: root attribute time_coverage_start_since_epoch differs from the time"),
        ("steps", {"times": [TIMES[1], TIMES[1]]}, "granule_time: 2 time steps instead of one"),
        ("value", {"project": '"OTHER"'}, "attributes: attribute  project differs"),
        ("absent", {"project": None}, "attributes: attribute  project missing"),
        ("group", {"variables": [v for v in tiny.VARIABLES if v[0] != "geolocation"]}, "flatten_groups: group missing: geolocation"),
        ("clash", {"variables": [*tiny.VARIABLES, ("product", "weight", "float32", ["time"], [1], [1], None)]}, "flatten_groups: variable collides: weight"),
        ("promote", {"variables": [v for v in tiny.VARIABLES if v[1] != "weight"]}, "promote_to_time: variable missing: weight"),
        ("stuck", {"variables": [*tiny.VARIABLES, ("product", "flat", "float32", ["latitude"], [4], [4], None)]}, "unpromoted_variables: no time dimension: flat"),
    ]
    granules = [granule(name, TIMES[1], **what) for name, what, _ in broken] + [granule("fine", TIMES[1]), granule("more", TIMES[1], extra="1")]
    found = header_findings(tiny.headers_of(spark, granules), tiny.template(spark), tiny.coordinates(spark), CONFIG).collect()
    errors = {(f.subject, f"{f.check}: {f.detail}") for f in found if f.severity == "error"}
    assert errors == {(tiny.url_of(name), text) for name, _, text in broken}
    assert {(f.subject, f.detail) for f in found if f.severity == "warning"} == {(tiny.url_of("more"), "attribute  extra extra")}


@pytest.mark.parametrize(
    "broken, text",
    [
        ({"latitude": [1.0, 2.0, 3.0, 4.0]}, "latitude values"),
        ({"times": [TIMES[1] + 1e-6], "epoch": TIMES[1] + 1e-6}, "matches 0 slots"),
    ],
)
def test_backfill_rejects_a_broken_granule(spark, empty, broken, text):
    granules = tiny.first_granules()
    granules[1] = {**granules[1], **broken}
    with pytest.raises(InvalidData, match=text):
        backfill(empty, tiny.entries_of(spark, granules), tiny.header(spark), tiny.headers_of(spark, granules), CONFIG)
    assert empty.current().number == 1


def test_gate_finds_missing_references(spark, empty):
    store = empty
    granules = tiny.first_granules()
    headers = tiny.headers_of(spark, granules)
    headers["refs"] = headers["refs"].filter(~((F.col("url") == tiny.url_of("granule_2")) & (F.col("variable") == "weight")))
    with pytest.raises(InvalidData, match="2 of 3 references"):
        backfill(store, tiny.entries_of(spark, granules), tiny.header(spark), headers, CONFIG)
    assert store.current().number == 1


def test_backfill_rejects_foreign_or_unsorted_inventories(spark, empty):
    store = empty
    granules = tiny.first_granules()
    headers = tiny.headers_of(spark, granules)
    with pytest.raises(InvalidData, match="not for"):
        backfill(store, tiny.entries_of(spark, granules), tiny.header(spark, "OTHER"), headers, CONFIG)
    with pytest.raises(InvalidData, match="axis_order"):
        backfill(store, tiny.entries_of(spark, granules[::-1]), tiny.header(spark), headers, CONFIG)


def test_missing_header_fails_the_run(spark, empty):
    store = empty
    granules = tiny.first_granules()
    with pytest.raises(InvalidData, match="header missing"):
        backfill(store, tiny.entries_of(spark, granules), tiny.header(spark), tiny.headers_of(spark, granules[:2]), CONFIG)


def test_forward_routes_every_case(filled):
    batch = [
        granule("new_end", TIMES[2] + 3600),
        granule("granule_1", TIMES[1], folder="s3://src/b"),
        granule("imposter", TIMES[0]),
        granule("late", TIMES[0] + 1800),
        granule("granule_2", TIMES[1] + 7),
        granule("bad", TIMES[2] + 7200, latitude=[0.0, 1.0, 2.0, 3.0]),
    ]
    feed(filled, batch, 0)
    assert [a[1] for a in tiny.axis(filled)] == ["granule_0", "granule_1", "granule_2", "new_end"]
    assert tiny.ledger(filled) == ["late"]
    current = filled.current()
    assert filled.slots(current).filter("slot = 1").first().granule_url == tiny.url_of("granule_1", "s3://src/b")
    refs = filled.chunk_refs(filled.slots(current))
    assert refs.count() == 4 * tiny.REFS_PER_GRANULE
    assert {r.url for r in refs.filter("slot = 1").collect()} == {tiny.url_of("granule_1", "s3://src/b")}
    assert {r.url for r in refs.filter("slot = 0").collect()} == {tiny.url_of("granule_0")}
    retried = {r.message_id.rsplit("/", 1)[-1] for r in filled.retries(current).collect()}
    assert retried == {"imposter.nc", "granule_2.nc", "bad.nc"}


def test_repeated_batch_changes_nothing(filled):
    batch = [granule("new_end", TIMES[2] + 3600), granule("late", TIMES[0] + 1800)]
    first = feed(filled, batch, 0)
    assert feed(filled, batch, 0) == first
    before = tiny.axis(filled)
    feed(filled, batch, 1)  # the same granules delivered again in another batch
    assert tiny.axis(filled) == before and tiny.ledger(filled) == ["late"]
    refs = filled.chunk_refs(filled.slots(filled.current()))
    assert refs.count() == 4 * tiny.REFS_PER_GRANULE


def test_moved_time_within_a_batch(filled):
    batch = [granule("u", TIMES[2] + 3600, folder="s3://src/a"), granule("u", TIMES[2] + 3593, folder="s3://src/b")]
    feed(filled, batch, 0)
    assert tiny.axis(filled)[-1] == (3, "u", TIMES[2] + 3600)
    assert filled.retries(filled.current()).count() == 1


def test_batch_is_taken_in_url_order(filled):
    twice = granule("b", TIMES[2] + 7200)
    sent = tiny.messages(filled.spark, [twice, granule("a", TIMES[2] + 3600)])
    headers = tiny.headers_of(filled.spark, [twice, granule("a", TIMES[2] + 3600)])
    process_batch(filled, sent.unionAll(sent), headers, CONFIG, 0)  # every message delivered twice
    assert [a[1] for a in tiny.axis(filled)][-2:] == ["a", "b"]


def test_dead_letters_after_the_last_attempt(filled):
    feed(filled, [granule("imposter", TIMES[0])], 0, max_attempts=2)
    assert filled.dead_letters().count() == 0
    other = [granule("later", TIMES[2] + 3600)]
    headers = tiny.headers_of(filled.spark, [granule("imposter", TIMES[0]), *other])
    process_batch(filled, tiny.messages(filled.spark, other), headers, CONFIG, 1, max_attempts=2)
    dead = filled.dead_letters().collect()
    assert [(d.attempts, d.reason) for d in dead] == [(2, "slot belongs to another granule")]
    assert filled.retries(filled.current()).count() == 0


def test_streams_and_collections_count_their_own_batches(filled):
    one = feed(filled, [granule("end_1", TIMES[2] + 3600)], 5, stream="a")
    assert feed(filled, [granule("end_2", TIMES[2] + 7200)], 5, stream="a") == one  # a repeated batch
    feed(filled, [granule("end_2", TIMES[2] + 7200)], 0, stream="b")
    assert [a[1] for a in tiny.axis(filled)][-2:] == ["end_1", "end_2"]
    version = filled.current()
    assert (version.last_batch(CONFIG.collection, "a"), version.last_batch(CONFIG.collection, "b")) == (5, 0)
    assert version.last_batch("other", "a") == -1


def test_a_second_collection_is_added_and_takes_no_foreign_retries(filled):
    spark = filled.spark
    feed(filled, [granule("imposter", TIMES[0])], 0)
    other = replace(CONFIG, collection="OTHER")
    named = F.lit("OTHER").alias("collection")
    before = tiny.axis(filled)
    added = filled.initialize(
        tiny.template(spark).select(named, "*"), tiny.coordinates(spark).select(named, "*"), tiny.header(spark, "OTHER")
    )
    assert added.number == filled.current().number and tiny.axis(filled) == before
    assert {r.collection for r in filled.meta(added).collect()} == {CONFIG.collection, "OTHER"}
    granules = [granule("first", TIMES[0])]
    process_batch(filled, tiny.messages(spark, granules), tiny.headers_of(spark, granules), other, 0)
    assert [(r.collection, r.attempts) for r in filled.retries(filled.current()).collect()] == [(CONFIG.collection, 1)]
    assert [r.granule_ur for r in filled.slots(filled.current()).filter("collection = 'OTHER'").collect()] == ["first"]


def test_an_unknown_collection_is_refused(spark, empty):
    granules = tiny.first_granules()
    stranger = replace(CONFIG, collection="OTHER")
    with pytest.raises(InvalidData, match="has no template"):
        backfill(
            empty, tiny.entries_of(spark, granules).withColumn("collection", F.lit("OTHER")), tiny.header(spark, "OTHER"),
            tiny.headers_of(spark, granules), stranger,
        )


def test_an_unfinished_marker_is_passed_over(filled):
    before = filled.current()
    open(f"{filled.base}/_versions/{before.number + 1:012d}.json", "w").close()
    assert filled.current() == before
    feed(filled, [granule("end", TIMES[2] + 3600)], 0)
    assert filled.current().number == before.number + 2 and tiny.axis(filled)[-1][1] == "end"


def test_a_lost_race_is_run_again(filled, monkeypatch, tmp_path):
    spark = filled.spark
    publish, lost = Store.publish, []

    def late(self, stage, expected, kind, batch=None):
        if kind == "forward" and not lost:
            lost.append(1)
            raise VersionMoved("lost")
        return publish(self, stage, expected, kind, batch)

    monkeypatch.setattr(Store, "publish", late)
    end = granule("end", TIMES[2] + 3600)
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "1.json").write_text(json.dumps({"message_id": "m", "body": json.dumps({"url": end["url"]})}))
    headers = tiny.headers_of(spark, [end])
    stream = read_message_stream(spark, str(tmp_path / "inbox"))
    run_forward(filled, stream, lambda: headers, CONFIG, str(tmp_path / "progress")).awaitTermination()
    assert lost and tiny.axis(filled)[-1][1] == "end"


def test_granules_without_axes_variables_or_attributes_are_found(spark):
    names = ("axes", "vars", "nodes")
    granules = [granule(name, TIMES[1]) for name in names] + [granule("fine", TIMES[1])]
    headers = tiny.headers_of(spark, granules)
    for name in names:
        headers[name] = headers[name].filter(F.col("url") != tiny.url_of(name))
    found = header_findings(headers, tiny.template(spark), tiny.coordinates(spark), CONFIG).filter("severity = 'error'").collect()
    text = {(f.subject, f.detail) for f in found}
    assert (tiny.url_of("axes"), "latitude missing") in text and (tiny.url_of("axes"), "longitude missing") in text
    assert (tiny.url_of("vars"), "granule has no variables") in text
    assert (tiny.url_of("nodes"), "granule has no attributes") in text
    assert tiny.url_of("fine") not in {f.subject for f in found}


def test_landed_headers_feed_a_backfill(spark, tmp_path):
    from scanledger.sources.files import read_granule_headers

    store = tiny.new_store(spark, tmp_path / "archive")
    granules = tiny.first_granules()
    for name, rows in tiny.headers_of(spark, granules).items():
        rows.write.parquet(str(tmp_path / "landed" / name))
    headers = read_granule_headers(spark, str(tmp_path / "landed"))
    backfill(store, tiny.entries_of(spark, granules), tiny.header(spark), headers, CONFIG)
    assert len(tiny.axis(store)) == 3


def test_resort_of_an_empty_ledger_is_a_noop(filled):
    before = filled.current()
    report = resort(filled, tiny.headers_of(filled.spark, tiny.first_granules()), CONFIG)
    assert not report.resorted and filled.current() == before


def test_resort_folds_and_moves_no_reference(filled):
    tail = TIMES[2] + 3600
    feed(filled, [granule("a_last", tail + 3600), granule("deep", TIMES[0] + 1800), granule("tail", tail)], 0)
    assert sorted(tiny.ledger(filled)) == ["deep", "tail"]
    before_version = filled.current()
    old = filled.slots(before_version)
    before = filled.chunk_refs(old)
    stored = filled.granule_refs().count()
    report = resort(filled, tiny.headers_of(filled.spark, [granule("deep", TIMES[0] + 1800), granule("tail", tail)]), CONFIG)
    assert (report.inserted, report.remaining, report.first_shift) == (2, 0, 1)
    assert [a[1] for a in tiny.axis(filled)] == ["granule_0", "deep", "granule_1", "granule_2", "tail", "a_last"]
    assert tiny.ledger(filled) == []
    new = filled.slots(filled.current())
    # only the inserted granules' references were written ...
    assert filled.granule_refs().count() == stored + 2 * tiny.REFS_PER_GRANULE
    # ... and the view equals the old references moved by the relocation operator, plus the new ones
    shifts = first_shift(old, new)
    moved = relocate_refs(before, relocation_map(old, new, shifts), shifts)
    kept = filled.chunk_refs(new.filter(~F.col("granule_ur").isin("deep", "tail")))
    assert moved.exceptAll(kept).count() == 0 and kept.exceptAll(moved).count() == 0


def test_resort_cap_folds_the_earliest(filled):
    feed(filled, [granule("x_end", TIMES[2] + 3600), granule("a_late", TIMES[1] + 1800), granule("b_early", TIMES[0] + 1800)], 0)
    headers = tiny.headers_of(filled.spark, [granule("a_late", TIMES[1] + 1800), granule("b_early", TIMES[0] + 1800)])
    report = resort(filled, headers, CONFIG, max_fold=1)
    assert (report.inserted, report.remaining, report.first_shift) == (1, 1, 1)
    assert tiny.ledger(filled) == ["a_late"]
    assert resort(filled, headers, CONFIG, max_fold=1).first_shift == 3
    assert [a[1] for a in tiny.axis(filled)] == ["granule_0", "b_early", "granule_1", "a_late", "granule_2", "x_end"]


def test_resort_aborts_on_a_collision(filled):
    from scanledger import schema

    spark = filled.spark
    pinned = filled.current()
    stage = filled.new_stage()
    rows = [(CONFIG.collection, "imposter", tiny.url_of("imposter"), TIMES[1], 0)]
    filled.write_state(stage, filled.slots(pinned), spark.createDataFrame(rows, schema.PENDING), filled.meta(pinned))
    filled.publish(stage, pinned, "test")
    before = filled.current()
    with pytest.raises(InvalidData, match="axis_order"):
        resort(filled, tiny.headers_of(spark, [granule("imposter", TIMES[1])]), CONFIG)
    assert filled.current() == before and tiny.ledger(filled) == ["imposter"]


def test_publish_is_refused_once_the_version_moved(filled):
    feed(filled, [granule("end", TIMES[2] + 3600), granule("late", TIMES[0] + 60)], 0)
    pinned = filled.current()
    stage = filled.new_stage()
    filled.write_state(stage, filled.slots(pinned), filled.pending(pinned), filled.meta(pinned))
    moved_to = filled.publish(stage, pinned, "other job")
    headers = tiny.headers_of(filled.spark, [granule("late", TIMES[0] + 60)])
    with pytest.raises(VersionMoved):
        resort(filled, headers, CONFIG, pinned=pinned)
    assert filled.current() == moved_to and tiny.ledger(filled) == ["late"]
    # a stale marker file cannot be replaced either
    with pytest.raises(VersionMoved):
        filled.publish(filled.new_stage(), pinned, "test")


def test_expired_files_spare_what_the_current_version_needs(filled):
    feed(filled, [granule("granule_1", TIMES[1], folder="s3://src/b")], 0)
    future = datetime.datetime.now(datetime.timezone.utc) + datetime.timedelta(days=1)
    old = filled.expired_files(future)
    stage = filled.current().stage
    kept_refs = {r.ref_stage for r in filled.slots(filled.current()).collect()}
    paths = [r.path for r in old.collect()]
    assert paths and not any(stage in p for p in paths) and not any(f"stage={s}/" in p for p in paths for s in kept_refs)
    past = datetime.datetime.now(datetime.timezone.utc) - datetime.timedelta(days=30)
    assert filled.expired_files(past).count() == 0 and filled.remove_expired(past) == 0
    before = filled.chunk_refs(filled.slots(filled.current())).collect()
    # the first whole axis stays, for the forward batch has written changes to it only
    assert filled.remove_expired(future) >= 1 and filled.expired_files(future).count() == 0
    assert sorted(filled.chunk_refs(filled.slots(filled.current())).collect()) == sorted(before)


def test_a_resort_counts_no_old_reference(spark, filled):
    """The gate reads counts; they are those of the references themselves."""
    current = filled.current()
    slots = filled.slots(current)
    counts = filled.reference_counts(slots)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "n_refs" in plan and "cy#" not in plan and "offset#" not in plan
    assert all("/ref_counts/" in f for f in counts.inputFiles() if "/stages/" not in f)
    want = {(r.granule_ur, r.variable): r.n for r in filled.chunk_refs(slots).join(slots.select("slot", "granule_ur"), "slot").groupBy("granule_ur", "variable").count().withColumnRenamed("count", "n").collect()}
    assert {(r.granule_ur, r.variable): r.n_refs for r in counts.collect()} == want and want
