"""Readers and writers on landed files."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from scanledger import schema
from scanledger.config import VOLATILE_ATTRIBUTES, CollectionConfig, load_collection
from scanledger.operators import catalogue as ops
from scanledger.operators.validate import validate_inventory
from scanledger.plans.poll import OVERLAP, initial_watermark, poll, poll_landed
from scanledger.sources import catalogue, files, inventory, template
from scanledger.sources.messages import read_messages

UTC = datetime.timezone.utc


def item(name, direct=True, revision="1", date="2026-08-01T00:00:00Z", begin="2026-07-01T00:00:00Z", ur=True, ending=".nc"):
    links = [{"Type": "GET DATA", "URL": f"https://host/{name}{ending}"}]
    if direct:
        links.append({"Type": "GET DATA VIA DIRECT ACCESS", "URL": f"s3://bucket/{name}{ending}"})
    umm = {"RelatedUrls": links, "TemporalExtent": {"RangeDateTime": {"BeginningDateTime": begin, "EndingDateTime": begin}}}
    if ur:
        umm["GranuleUR"] = name
    return {"meta": {"concept-id": f"c-{name}", "revision-id": revision, "revision-date": date}, "umm": umm}


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("listing")
    pages = [
        [item("a", revision="1"), item("b", direct=False), item("a", revision="3", begin="2026-07-02T00:00:00Z")],
        [item("c", ending=".xml", date="2026-08-10T12:00:00+02:00"), item("d", ur=False, revision=7), item("a", revision="3", begin="2026-07-09T00:00:00Z")],
        [],
    ]
    for n, page in enumerate(pages):
        (folder / f"page-{n:04d}.json").write_text(json.dumps({"items": page}, indent=1))
    return catalogue.flatten_records(catalogue.read_catalogue(spark, str(folder)))


def test_catalogue_pages(records):
    rows = records.orderBy("position").collect()
    assert [r.granule_ur for r in rows] == ["a", "b", "a", "c", "c-d", "a"]
    assert [r.url for r in rows] == ["s3://bucket/a.nc", None, "s3://bucket/a.nc", None, "s3://bucket/d.nc", "s3://bucket/a.nc"]
    assert rows[4].revision_id == 7 and rows[3].revision_date == datetime.datetime(2026, 8, 10, 10)


def test_newest_revision_keeps_the_first_listed(records):
    newest = ops.latest_revision(records, ["granule_ur"], "revision_id", ["position"])
    a = newest.filter("granule_ur = 'a'").collect()
    assert [(r.revision_id, r.begin) for r in a] == [(3, datetime.datetime(2026, 7, 2))]


def test_window_and_most_recent(records):
    latest = catalogue.read_catalogue_window(records, max_count=1).collect()
    assert [r.begin for r in latest] == [datetime.datetime(2026, 7, 9)]
    inside = catalogue.read_catalogue_window(records, "2026-07-02", "2026-07-05T00:00:00Z").collect()
    assert [r.begin for r in inside] == [datetime.datetime(2026, 7, 2)]


def test_data_links(records):
    linked, missing = catalogue.data_links(records, "direct")
    assert sorted(r.subject for r in missing.collect()) == ["c-b", "c-c"]
    assert {r.data_url for r in linked.collect()} == {"s3://bucket/a.nc", "s3://bucket/d.nc"}
    _, web_missing = catalogue.data_links(records, "external")
    assert [r.subject for r in web_missing.collect()] == ["c-c"]


def test_build_inventory(spark, records):
    times = spark.createDataFrame([("s3://bucket/a.nc", 7.5)], "url string, time double")
    entries, findings = ops.build_inventory(records, times, "C")
    assert [(r.granule_ur, r.time) for r in entries.collect()] == [("a", 7.5)]
    assert {(r.subject, r.detail) for r in findings.collect()} == {
        ("c-b", "no .nc data link"), ("c-c", "no .nc data link"), ("c-d", "header time could not be read")}


GRANULES = [{"url": f"s3://b/g{i}.nc", "granule_ur": f"g{i}", "time": 1471196538.0244286 + i} for i in range(3)]


def document(granules, schema_id="scan-inventory/1"):
    return {"schema": schema_id, "collection": "C", "concept_id": "C1", "time_units": "s", "built_at": "now", "granules": granules}


@pytest.mark.parametrize(
    "granules, schema_id, checks",
    [
        (GRANULES, "scan-inventory/1", set()),
        ([], "scan-inventory/1", {"empty"}),
        (GRANULES[::-1], "scan-inventory/1", {"axis_order"}),
        ([GRANULES[0], {**GRANULES[1], "time": GRANULES[0]["time"]}], "scan-inventory/1", {"axis_order"}),
        ([GRANULES[0], {**GRANULES[1], "granule_ur": "g0"}], "scan-inventory/1", {"duplicate_ur"}),
        ([{**GRANULES[0], "url": "s3://b/g0.xml"}], "scan-inventory/1", {"granule_url"}),
        (GRANULES, "other/2", {"schema"}),
    ],
)
def test_inventory_documents(spark, tmp_path, granules, schema_id, checks):
    (tmp_path / "inv.json").write_text(json.dumps(document(granules, schema_id), indent=1))
    header, entries = inventory.read_inventory(spark, str(tmp_path / "inv.json"))
    config = CollectionConfig("c", "C")
    assert {f.check for f in validate_inventory(entries, header, config).collect()} == checks


def test_inventory_round_trips_exactly(spark, tmp_path):
    (tmp_path / "inv.json").write_text(json.dumps(document(GRANULES)))
    header, entries = inventory.read_inventory(spark, str(tmp_path / "inv.json"))
    inventory.write_inventory_lines(entries, header, str(tmp_path / "lines"))
    head, again = inventory.read_inventory_lines(spark, str(tmp_path / "lines"))
    assert head.collect() == header.collect()
    assert [r.time for r in again.orderBy("position").collect()] == [g["time"] for g in GRANULES]
    inventory.write_inventory(entries, header, str(tmp_path / "table"))
    _, table = inventory.read_inventory_table(spark, str(tmp_path / "table"))
    assert [r.time for r in table.orderBy("position").collect()] == [g["time"] for g in GRANULES]


def test_partition_lists_are_pruned(spark, tmp_path):
    from scanledger.operators.slots import assign_batches, assign_slots

    entries = spark.createDataFrame([("C", f"u{i}.nc", f"u{i}", float(i)) for i in range(23)], "collection string, url string, granule_ur string, time double")
    inventory.write_partitions(assign_batches(assign_slots(entries), 10, 4), str(tmp_path / "parts"))
    part = inventory.read_partition(spark, str(tmp_path / "parts"), "C", 2)
    assert sorted(r.url for r in part.collect()) == ["u20.nc", "u21.nc", "u22.nc"]
    assert "PartitionFilters: [isnotnull(collection" in part._jdf.queryExecution().toString()
    assert [r.batch_id for r in inventory.read_partition(spark, str(tmp_path / "parts"), "C", 0).orderBy("slot").collect()] == [0] * 4 + [1] * 4 + [2] * 2


def test_messages(spark):
    record = {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "k/g.nc"}}}]}
    bodies = [{"url": "s3://x/1.nc"}, record, {"Message": json.dumps(record)}, {"Message": json.dumps({"url": "s3://x/2.nc"})}, {"Records": [{}]}, {"url": ""}]
    rows = [(str(i), json.dumps(b), 1) for i, b in enumerate(bodies)] + [("6", "no json {", 1)]
    got = {r.message_id: (r.url, r.sort_url, r.state) for r in read_messages(spark.createDataFrame(rows, schema.MESSAGES)).collect()}
    assert got == {
        "0": ("s3://x/1.nc", "s3://x/1.nc", "ok"), "1": ("s3://b/k/g.nc", "s3://b/k/g.nc", "ok"), "2": ("s3://b/k/g.nc", "s3://b/k/g.nc", "ok"),
        "3": ("s3://x/2.nc", "s3://x/2.nc", "ok"), "4": (None, "", "skipped"), "5": (None, "", "skipped"), "6": (None, "", "unreadable")}


def test_template_of_any_depth(spark, tmp_path):
    node = {"node_type": "array", "data_type": "int8", "shape": [1]}
    for i in range(10):
        node = {"node_type": "group", "members": {f"g{9 - i}": node}}
    (tmp_path / "deep.json").write_text(json.dumps(node))
    paths = {r.path for r in template.read_template(spark, str(tmp_path / "deep.json")).collect()}
    assert len(paths) == 11 and "/" + "/".join(f"g{i}" for i in range(10)) in paths


def test_pages_are_listed_by_number(spark, tmp_path):
    from scanledger.sources.catalogue import read_catalogue

    for n in (2, 10):
        (tmp_path / f"page-{n}.json").write_text(json.dumps({"items": [{"meta": {"concept-id": f"G{n}"}, "umm": {}}]}))
    rows = read_catalogue(spark, str(tmp_path)).orderBy("position").collect()
    assert [r.meta["concept-id"] for r in rows] == ["G2", "G10"]


def test_landed_pages_feed_the_audit(spark, tmp_path):
    from scanledger.operators.compare import nearest_granule
    from scanledger.sources.catalogue import audit_records, flatten_records, read_catalogue

    def record(name, begin, url=True):
        links = [{"Type": "GET DATA VIA DIRECT ACCESS", "URL": f"s3://a/{name}.nc"}] if url else []
        return {"meta": {"concept-id": name}, "umm": {
            "GranuleUR": name, "RelatedUrls": links,
            "TemporalExtent": {"RangeDateTime": {"BeginningDateTime": begin, "EndingDateTime": begin}}}}

    pages = {2: [record("a", "1980-01-06T00:01:40Z"), record("none", "1980-01-06T01:00:00Z", False)], 10: [record("b", "1980-01-06T00:01:40Z")]}
    for n, items in pages.items():
        (tmp_path / f"page-{n}.json").write_text(json.dumps({"items": items}))
    records = audit_records(flatten_records(read_catalogue(spark, str(tmp_path))), "C")
    assert sorted((r.granule_ur, r["rank"]) for r in records.collect()) == [("a", 0), ("b", 1)]
    slots = spark.createDataFrame([("C", 0, 110.0), ("C", 1, 9000.0)], "collection string, slot int, time double")
    assert {r.slot: r.found_ur for r in nearest_granule(slots, records).collect()} == {0: "a", 1: None}


def test_template_document(spark, tmp_path):
    array = {"node_type": "array", "data_type": "float64", "shape": [1, 4], "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": [1, 2]}},
             "fill_value": "NaN", "codecs": [{"name": "bytes"}], "dimension_names": ["time", "y"], "attributes": {"units": "m", "n": [1, 2]}}
    doc = {"node_type": "group", "attributes": {"title": "t"}, "members": {"product": {"attributes": {}, "node_type": "group", "members": {"column": array}}}}
    (tmp_path / "template.json").write_text(json.dumps(doc, indent=1))
    nodes = {r.path: r for r in template.read_template(spark, str(tmp_path / "template.json")).collect()}
    assert set(nodes) == {"", "/product", "/product/column"}
    column = nodes["/product/column"]
    assert (column.shape, column.chunk_shape, column.dims, column.fill_value) == ([1, 4], [1, 2], ["time", "y"], "NaN")
    assert column.attributes["n"].replace(" ", "") == "[1,2]" and nodes[""].node_type == "group"
    table = template.read_template(spark, str(tmp_path / "template.json"))
    template.write_template(table, str(tmp_path / "nodes"))
    again = template.read_template_table(spark, str(tmp_path / "nodes"))
    assert {r.path for r in again.collect()} == set(nodes)


def test_coordinates(spark, tmp_path):
    from tests import tiny

    template.write_coordinates(tiny.coordinates(spark), str(tmp_path / "axes"))
    back = template.read_coordinates(spark, str(tmp_path / "axes"))
    assert back.exceptAll(tiny.coordinates(spark)).count() == 0 and back.count() == 10
    with pytest.raises(FileNotFoundError, match="nowhere"):
        template.read_coordinates(spark, str(tmp_path / "nowhere"))


def test_source_files(spark, tmp_path):
    (tmp_path / "a.nc").write_bytes(b"x" * 7)
    (tmp_path / "b.txt").write_bytes(b"y")
    rows = files.source_files(spark, str(tmp_path), "*.nc").collect()
    assert [(r.length, (r.stamp - r.modificationTime).total_seconds()) for r in rows] == [(7, 1.0)]


def test_watermark_and_poll(spark, records, tmp_path):
    path = str(tmp_path / "mark")
    assert files.read_watermark(spark, path) is None
    sent = []
    now = datetime.datetime(2026, 8, 11, tzinfo=UTC)

    def broken(_):
        raise RuntimeError("queue down")

    with pytest.raises(RuntimeError):
        poll(spark, records, path, broken, now, "2026-08-02T00:00:00")
    assert files.read_watermark(spark, path) is None  # the next poll covers the same records
    since = poll(spark, records, path, lambda df: sent.extend(r.url for r in df.collect()), now, "2026-08-02T00:00:00")
    assert since == datetime.datetime(2026, 8, 1, tzinfo=UTC) and sorted(sent) == ["s3://bucket/a.nc"] * 3 + ["s3://bucket/d.nc"]
    later = now + datetime.timedelta(hours=1)
    assert poll(spark, records, path, lambda df: df.collect(), later) == now - OVERLAP


def test_landed_pages_are_polled_once_by_day(spark, tmp_path):
    pages, progress, mark = (str(tmp_path / x) for x in ("pages", "progress", "mark"))

    def land(day, name, *items):
        folder = tmp_path / "pages" / f"day={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(json.dumps({"items": list(items)}, indent=1))

    land("2026-07-30", "page-1.json", item("old", date="2026-07-30T10:00:00Z"))
    land("2026-08-01", "page-1.json", item("early", date="2026-07-31T23:00:00Z"), item("a"), item("b", direct=False))
    land("2026-08-02", "page-10.json", item("d", date="2026-08-02T01:00:00Z"))
    land("2026-08-02", "page-2.json", item("c", date="2026-08-02T01:00:00Z"))
    since = datetime.datetime(2026, 8, 1, tzinfo=UTC)
    read = catalogue.flatten_records(catalogue.read_catalogue_days(spark, pages, since))
    assert [r.granule_ur for r in read.orderBy("position").collect()] == ["early", "a", "b", "c", "d"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2026-08-01" in plan
    ranked = catalogue.audit_records(read, "X").orderBy("rank").collect()
    assert [r.granule_ur for r in ranked] == ["early", "a", "c", "d"]

    sent, batches = [], []

    def send(urls, batch_id):
        if not batches:
            batches.append(("failed", batch_id))
            raise RuntimeError("queue down")
        batches.append(("sent", batch_id))
        sent.extend(r.granule_ur for r in urls.collect())

    now = datetime.datetime(2026, 8, 3, tzinfo=UTC)
    first = "2026-08-02T00:00:00"
    with pytest.raises(Exception, match="queue down"):
        poll_landed(spark, pages, progress, mark, send, now, first, 1)
    assert files.read_watermark(spark, mark) is None
    assert poll_landed(spark, pages, progress, mark, send, now, first, 1) == since
    assert batches[0] == ("failed", 0) and batches[1] == ("sent", 0)  # the same batch again
    assert sorted(sent) == ["a", "c", "d"]
    sent.clear()
    land("2026-08-03", "page-1.json", item("e", date="2026-08-02T12:00:00Z"), item("d", date="2026-08-01T01:00:00Z"))
    assert poll_landed(spark, pages, progress, mark, send, now + datetime.timedelta(hours=1), first, 1) == now - OVERLAP
    assert sent == ["e"]  # pages read before are not read again


def test_first_poll_start():
    now = datetime.datetime(2026, 8, 20, tzinfo=UTC)
    assert initial_watermark(now) == now - datetime.timedelta(days=8)
    assert initial_watermark(now, "2026-08-01T00:00:00") == datetime.datetime(2026, 8, 1, tzinfo=UTC)
    assert initial_watermark(now, "2026-08-01T00:00:00+00:00") == datetime.datetime(2026, 8, 1, tzinfo=UTC)


def test_collection_file(tmp_path):
    (tmp_path / "c.toml").write_text(
        'name = "n"\ncollection_shortname = "S"\nconcept_id = "C"\nappend_dim = "time"\ntime_units = "s"\nflatten_groups = ["p"]\n'
        'promote_to_time = ["w"]\ndrop_variables = []\nextra_volatile_attributes = ["bounds"]\ntime_chunk_size = 9\n')
    config = load_collection(tmp_path / "c.toml")
    assert config.volatile_attributes == VOLATILE_ATTRIBUTES | {"bounds"} and config.time_chunk_size == 9


def test_publish_order_cases(spark):
    day = 86400
    cases = {
        "ordered": [(0, 0, 1), (10, 60, 1), (20, 120, 1)], "swap": [(0, 60, 1), (10, 0, 1)],
        "historical": [(0, 0, 1), (10, -1_000_000, 1), (20, 60, 1)], "shuffled": [(20, 120, 1), (0, 60, 1), (10, 0, 1)],
        "revised": [(0, 0, 2), (1, 1, 3)], "one": [(0, 0, 2)], "edge": [(0, 24 * 60, 2), (1, 0, 2)],
    }
    rows = [(k, p, s * 60, r) for k, v in cases.items() for p, s, r in v]
    log = spark.createDataFrame(rows, "c string, p int, s long, r int").withColumn("s", F.timestamp_seconds("s"))
    out = {r.c: r for r in ops.publish_order_report(log, ["c"], ["p"], "s", "r", day).collect()}
    counts = {k: (r.pairs, r.inversions, r.adjacent_swaps, r.historical_arrivals, r.republished) for k, r in out.items()}
    assert counts == {
        "ordered": (2, 0, 0, 0, 0), "swap": (1, 1, 1, 0, 0), "historical": (2, 1, 0, 1, 0), "shuffled": (2, 1, 1, 0, 0),
        "revised": (1, 0, 0, 0, 1), "one": (0, 0, 0, 0, 0), "edge": (1, 1, 1, 0, 0)}
    assert out["swap"].inversion_pct == 100.0 and out["one"].inversion_pct == 0.0 and out["revised"].republished_pct == 50.0


def test_collection_report(spark, tmp_path):
    doc = {
        "meta": {"concept-id": "C1", "revision-date": "2026-01-01"},
        "umm": {"ShortName": "S", "Version": "V1", "EntryTitle": "T", "DOI": {"DOI": "10.1"},
                "CollectionCitations": [{"Creator": "x", "Title": "t"}, {}],
                "Platforms": [{"ShortName": "P", "Instruments": [{"ShortName": "I"}, {}]}],
                "ScienceKeywords": [{"Category": "A", "Term": "B"}, {"Category": "A", "Term": "B"}],
                "TemporalExtents": [{"RangeDateTimes": [{"BeginningDateTime": "2023"}], "EndsAtPresentFlag": True,
                                     "TemporalResolution": {"Value": "1", "Unit": "Hour"}}]}}
    (tmp_path / "c.json").write_text(json.dumps(doc))
    docs = catalogue.read_collections(spark, str(tmp_path / "c.json"))
    granules = spark.createDataFrame([("C1", "g1", 1), ("C1", "g2", 2)], "concept_id string, granule_ur string, begin int")
    r = ops.collection_report(docs, granules).first()
    assert (r.title, r.granule_count, r.most_recent, r.keywords, r.instruments) == ("S V1", 2, "g2", ["A > B"], ["I", "?"])
    assert r.citations == ["Creator: x; Title: t", "{}"] and r.abstract == "(no abstract)"
    e = ops.temporal_extent(docs).first()
    assert (e.begin, e.end, e.resolution) == ("2023", "Present", "1 Hour")
