"""The forward consumer as a stream."""

import json

from scanledger.plans import store as plans_store
from scanledger.plans.backfill import backfill
from scanledger.streaming.forward import process_batch, read_message_stream, run_forward
from tests import tiny
from tests.tiny import CONFIG, TIMES, granule


def land(folder, name, granules):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"message_id": g["url"], "body": json.dumps({"url": g["url"]})}) for g in granules]
    (folder / name).write_text("\n".join(lines))


def test_stream_appends_defers_and_resumes(spark, tmp_path):
    store = tiny.new_store(spark, tmp_path / "archive")
    first = tiny.first_granules()
    backfill(store, tiny.entries_of(spark, first), tiny.header(spark), tiny.headers_of(spark, first), CONFIG)
    late = granule("late", TIMES[0] + 60)
    ends = [granule(f"end_{i}", TIMES[2] + 3600 * (i + 1)) for i in range(2)]
    headers = tiny.headers_of(spark, [late, *ends])
    inbox = tmp_path / "inbox"
    land(inbox, "1.json", [ends[0], late])

    def drain():
        query = run_forward(store, read_message_stream(spark, str(inbox), 1), lambda: headers, CONFIG, str(tmp_path / "progress"))
        query.awaitTermination()

    drain()
    assert [a[1] for a in tiny.axis(store)][-1] == "end_0" and tiny.ledger(store) == ["late"]
    version = store.current()
    assert version.kind == "forward" and [n for _, n in version.batches] == [0]
    land(inbox, "2.json", [ends[1]])
    drain()  # resumes after the files it has seen
    assert [a[1] for a in tiny.axis(store)][-2:] == ["end_0", "end_1"]
    assert [n for _, n in store.current().batches] == [1] and tiny.ledger(store) == ["late"]


def test_a_new_checkpoint_loses_no_batch(spark, tmp_path):
    store = tiny.new_store(spark, tmp_path / "archive")
    first = tiny.first_granules()
    backfill(store, tiny.entries_of(spark, first), tiny.header(spark), tiny.headers_of(spark, first), CONFIG)
    ends = [granule(f"end_{i}", TIMES[2] + 3600 * (i + 1)) for i in range(2)]
    headers = tiny.headers_of(spark, ends)
    for i, end in enumerate(ends):  # both checkpoints number their batch 0
        inbox = tmp_path / f"inbox_{i}"
        land(inbox, "1.json", [end])
        run_forward(
            store, read_message_stream(spark, str(inbox), 1), lambda: headers, CONFIG, str(tmp_path / f"progress_{i}")
        ).awaitTermination()
    assert [a[1] for a in tiny.axis(store)][-2:] == ["end_0", "end_1"]
    assert [n for _, n in store.current().batches] == [0, 0]


def test_batches_write_changes_until_there_are_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(plans_store, "MAX_CHANGES", 2)
    store = tiny.new_store(spark, tmp_path / "archive")
    first = tiny.first_granules()
    backfill(store, tiny.entries_of(spark, first), tiny.header(spark), tiny.headers_of(spark, first), CONFIG)
    ends = [granule(f"end_{i}", TIMES[2] + 3600 * (i + 1)) for i in range(4)]
    headers = tiny.headers_of(spark, ends)
    parts = []
    for i, end in enumerate(ends):
        process_batch(store, tiny.messages(spark, [end, ends[0]]), headers, CONFIG, i)  # the first one is written over each time
        parts.append(len(store._axis_parts(store.current())))
        written = sorted(r.granule_ur for r in store.changes(store.current().stage).collect())
        assert written == sorted({"end_0", f"end_{i}"})
    assert parts == [2, 3, 1, 2]  # the third batch writes a whole axis again
    rows = tiny.axis(store)
    assert [r[0] for r in rows] == list(range(len(rows))) and [r[1] for r in rows][-4:] == [f"end_{i}" for i in range(4)]
    stages = {r.ref_stage for r in store.slots(store.current()).filter("granule_ur = 'end_0'").collect()}
    assert stages == {store.current().stage}
    assert store.remove_expired("2100-01-01 00:00:00") > 0 and tiny.axis(store) == rows
