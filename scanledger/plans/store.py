"""Versioned tables of an archive: plain Parquet folders and one marker file per version.

A job writes its tables under a fresh stage folder and then creates the marker of version
``expected + 1``, which names the stage. Creating the marker fails if it exists, so of two jobs that
started from the same version one is refused and nothing of it becomes visible. Readers take the
stage of the highest marker. A marker appears whole or not at all: it is written under another name and
renamed without overwriting, which is atomic on HDFS; on object stores without that guarantee, use a
table format with optimistic commits for the markers.

References are stored by granule, not by slot: a slot row names its granule and the stage that
wrote its references (``ref_stage``). Appends and overwrites therefore add only their own
references, and a re-sort writes no reference of the granules it moves. A forward batch writes only the
axis rows it changes; readers lay the changes of up to ``MAX_CHANGES`` stages over a whole axis.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger import schema
from scanledger.operators.findings import InvalidData, require_valid
from scanledger.operators.refs import count_references, in_chunk_order
from scanledger.operators.routing import with_changes
from scanledger.operators.validate import validate_inventory
from scanledger.session import lookup


class VersionMoved(Exception):
    """Another job published first."""


def _path(spark: SparkSession, text: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, text: str) -> bool:
    path, fs = _path(spark, text)
    return bool(fs.exists(path))


def create_exclusive(spark: SparkSession, text: str, content: str) -> bool:
    """Create a small file in one step; False if it exists already.

    The content is written under another name and then renamed without overwriting, so nobody sees an unfinished file.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    path, fs = _path(spark, text)
    draft = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(content, "utf-8"))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(draft).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    plain = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    plain[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(path), plain)
    except Exception:
        fs.delete(draft, False)
        if fs.exists(path):
            return False
        raise
    return True


# Changed rows of the axis are gathered from so many stages at most; then the axis is written anew.
MAX_CHANGES = 20
AXIS_PARTS = "ordinal int, part string"

MARKER = "number int, stage string, kind string, batches map<string,bigint>"


@dataclass(frozen=True)
class Version:
    """A published version; ``batches`` names the newest micro-batch of each (collection, stream) it contains."""

    number: int
    stage: str
    kind: str
    batches: tuple[tuple[str, int], ...] = ()

    def last_batch(self, collection: str, stream: str) -> int:
        return dict(self.batches).get(stream_key(collection, stream), -1)


def stream_key(collection: str, stream: str) -> str:
    return json.dumps([collection, stream])


def _version(row) -> Version:
    return Version(row.number, row.stage, row.kind, tuple(sorted((row.batches or {}).items())))


@dataclass(frozen=True)
class Store:
    """Where an archive's tables live."""

    spark: SparkSession
    base: str

    # -- versions ---------------------------------------------------------------------------------

    def versions(self) -> DataFrame:
        """All markers as rows (number, stage, kind, batches)."""
        if not path_exists(self.spark, f"{self.base}/_versions"):
            return self.spark.createDataFrame([], MARKER)
        return self.spark.read.schema(MARKER).json(f"{self.base}/_versions/*.json").filter("number IS NOT NULL")

    def newest(self, n: int) -> list[Version]:
        """The ``n`` newest versions, oldest of them first."""
        return [_version(r) for r in reversed(self.versions().orderBy(F.desc("number")).limit(n).collect())]

    def _markers(self) -> list[str]:
        """Names of the marker files, oldest first."""
        folder, fs = _path(self.spark, f"{self.base}/_versions")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def current(self) -> Version | None:
        """The highest marker that can be read; others' files are not read."""
        for name in reversed(self._markers()):
            row = self.spark.read.schema(MARKER).json(f"{self.base}/_versions/{name}").first()
            if row is not None and row.number is not None:
                return _version(row)
        return None

    def require_initialized(self) -> Version:
        """The current version; an archive nobody initialized refuses work."""
        version = self.current()
        if version is None:
            raise InvalidData("no version has been published: the archive is not initialized")
        return version

    def require_collection(self, collection: str) -> tuple[DataFrame, DataFrame]:
        """Template and grid of a collection; without either nothing could be checked, so both must be there."""
        template = self.template().filter(F.col("collection") == collection).drop("collection")
        grid = self.coordinates().filter(F.col("collection") == collection).drop("collection")
        for name, rows in (("template", template), ("grid", grid)):
            if rows.isEmpty():
                raise InvalidData(f"collection {collection} has no {name}: it is not initialized")
        return template, grid

    def publish(
        self, stage: str, expected: Version | None, kind: str, batch: tuple[str, str, int] | None = None
    ) -> Version:
        """Make ``stage`` current if the current version is still ``expected``; write nothing after it.

        ``batch`` is (collection, stream, id) of the micro-batch that the stage contains.
        """
        if self.current() != expected:
            raise VersionMoved(f"version {expected.number if expected else 0} has been replaced meanwhile")
        batches = dict(expected.batches) if expected else {}
        if batch is not None:
            batches[stream_key(*batch[:2])] = batch[2]
        # an unreadable marker keeps its number
        number = max([expected.number if expected else 0, *(int(n.split(".")[0]) for n in self._markers())]) + 1
        text = json.dumps({"number": number, "stage": stage, "kind": kind, "batches": batches})
        if not create_exclusive(self.spark, f"{self.base}/_versions/{number:012d}.json", text):
            raise VersionMoved(f"another job has published version {number}")
        return Version(number, stage, kind, tuple(sorted(batches.items())))

    @staticmethod
    def new_stage() -> str:
        return uuid.uuid4().hex

    # -- tables -----------------------------------------------------------------------------------

    def _table(self, stage: str, name: str, ddl: str) -> DataFrame:
        return self.spark.read.schema(ddl).parquet(f"{self.base}/stages/{stage}/{name}")

    def _axis_parts(self, version: Version) -> list[str]:
        """Stages that make up a version's axis: a whole one, then at most ``MAX_CHANGES`` with changes to it."""
        path = f"{self.base}/stages/{version.stage}/axis"
        if not path_exists(self.spark, path):
            return [version.stage]
        return [r.part for r in self.spark.read.schema(AXIS_PARTS).json(path).orderBy("ordinal").collect()]

    def slots(self, version: Version) -> DataFrame:
        whole, *later = self._axis_parts(version)
        axis = self._table(whole, "slots", schema.SLOTS)
        if not later:
            return axis
        changes = [self._table(part, "changes", schema.SLOTS).withColumn("_ordinal", F.lit(i)) for i, part in enumerate(later)]
        newest = reduce(DataFrame.unionByName, changes).groupBy("collection", "slot").agg(
            F.max_by(F.struct("time", "granule_ur", "granule_url", "ref_stage"), "_ordinal").alias("_row")
        )
        return with_changes(axis, newest.select("collection", "slot", "_row.*"))

    def changes(self, stage: str) -> DataFrame:
        return self._table(stage, "changes", schema.SLOTS)

    def write_changes(self, stage: str, changes: DataFrame, pinned: Version) -> None:
        """The axis of ``pinned`` with changes: only those are written, or a whole axis once ``MAX_CHANGES`` have gathered."""
        self.write_table(stage, "changes", changes)
        parts = self._axis_parts(pinned)
        if len(parts) > MAX_CHANGES:
            self.write_table(stage, "slots", with_changes(self.slots(pinned), self.changes(stage)))
            return
        rows = list(enumerate([*parts, stage]))
        self.spark.createDataFrame(rows, AXIS_PARTS).coalesce(1).write.json(f"{self.base}/stages/{stage}/axis")

    def read_inventory(self, version: Version, collection: str) -> DataFrame | None:
        """The axis of a collection as inventory rows, checked on reading; None while it is empty."""
        entries = self.slots(version).filter(F.col("collection") == collection).select(
            "collection", F.col("granule_url").alias("url"), "granule_ur", "time", F.col("slot").cast("long").alias("position")
        )
        if entries.isEmpty():
            return None
        require_valid(validate_inventory(entries), f"axis of {collection}")
        return entries

    def pending(self, version: Version) -> DataFrame:
        return self._table(version.stage, "pending", schema.PENDING)

    def retries(self, version: Version) -> DataFrame:
        return self._table(version.stage, "retries", schema.RETRIES)

    def meta(self, version: Version) -> DataFrame:
        return self._table(version.stage, "meta", schema.STORE_META)

    def dead_letters(self) -> DataFrame:
        ddl = schema.RETRIES + ", reason string, stage string"
        if not path_exists(self.spark, f"{self.base}/dead"):
            return self.spark.createDataFrame([], ddl)
        published = self.versions().select("stage")
        return self.spark.read.schema(ddl).parquet(f"{self.base}/dead").join(published, "stage", "left_semi")

    def granule_refs(self) -> DataFrame:
        """References of every write, published or not; join on ``ref_stage`` picks the valid ones."""
        ddl = schema.GRANULE_REFS + ", stage string"
        if not path_exists(self.spark, f"{self.base}/refs"):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(f"{self.base}/refs")

    def chunk_refs(self, slots: DataFrame) -> DataFrame:
        """References by slot, as the axis ``slots`` sees them."""
        owners = slots.select("collection", "granule_ur", F.col("ref_stage").alias("stage"), "slot")
        joined = self.granule_refs().join(lookup(owners, pinned=False), ["collection", "granule_ur", "stage"])
        return joined.select(
            "collection", "variable", "slot", "cy", "cx", "url", "offset", "length", "last_updated_at"
        )

    def reference_counts(self, slots: DataFrame) -> DataFrame:
        """Counts (collection, granule_ur, variable, n_refs) of the references that the axis ``slots`` sees; no reference is read."""
        ddl = "collection string, granule_ur string, variable string, n_refs long, stage string"
        if not path_exists(self.spark, f"{self.base}/ref_counts"):
            return self.spark.createDataFrame([], ddl).drop("stage")
        owners = slots.select("collection", "granule_ur", F.col("ref_stage").alias("stage"))
        counts = self.spark.read.schema(ddl).parquet(f"{self.base}/ref_counts")
        return counts.join(lookup(owners, pinned=False), ["collection", "granule_ur", "stage"]).drop("stage")

    def template(self) -> DataFrame:
        ddl = "collection string, " + schema.TEMPLATE
        rows = self.spark.read.schema(ddl).json(f"{self.base}/template")
        return rows.select("collection", *(c for c in rows.columns if c != "collection"))

    def coordinates(self) -> DataFrame:
        rows = self.spark.read.schema("collection string, " + schema.COORDINATES).parquet(f"{self.base}/coordinates")
        return rows.select("collection", *(c for c in rows.columns if c != "collection"))

    def write_table(self, stage: str, name: str, rows: DataFrame) -> None:
        """A table with one row per granule or message."""
        rows.write.mode("errorifexists").parquet(f"{self.base}/stages/{stage}/{name}")

    def write_refs(self, stage: str, rows: DataFrame) -> None:
        """References of the granules a job wrote, in chunk order; AQE splits hot (collection, variable) pairs."""
        balanced = rows.select(
            "collection", "granule_ur", "variable", "cy", "cx", "url", "offset", "length", "last_updated_at"
        ).hint("rebalance", "collection", "variable")
        in_chunk_order(balanced, ["collection", "variable"]).write.mode("errorifexists").partitionBy("collection", "variable").parquet(f"{self.base}/refs/stage={stage}")
        written = self.spark.read.schema(schema.GRANULE_REFS).parquet(f"{self.base}/refs/stage={stage}")
        count_references(written).write.mode("errorifexists").parquet(f"{self.base}/ref_counts/stage={stage}")

    def write_state(
        self, stage: str, slots: DataFrame | None, pending: DataFrame, meta: DataFrame, retries: DataFrame | None = None
    ) -> None:
        """State of a version; ``slots`` is None where ``write_changes`` has written the axis."""
        if slots is not None:
            self.write_table(stage, "slots", slots)
        self.write_table(stage, "pending", pending)
        self.write_table(stage, "meta", meta)
        empty = self.spark.createDataFrame([], schema.RETRIES)
        self.write_table(stage, "retries", empty if retries is None else retries)

    # -- lifecycle --------------------------------------------------------------------------------

    def initialize(self, template: DataFrame, coordinates: DataFrame, meta: DataFrame) -> Version:
        """An empty axis, grid, metadata and ledger for each collection of ``meta`` that the archive does not have yet.

        ``template`` and ``coordinates`` carry a ``collection`` column. Collections already there stay as they are; if all
        are, nothing happens. What an unfinished run has left of a new collection is replaced.
        """
        existing = self.current()
        new = meta
        if existing is not None:
            new = meta.join(self.meta(existing).select("collection"), "collection", "left_anti").select(*meta.columns)
            if new.isEmpty():
                return existing
        own = new.select("collection").distinct()
        for name, rows, kind in (("template", template, "json"), ("coordinates", coordinates, "parquet")):
            rows.join(own, "collection", "left_semi").write.format(kind).partitionBy("collection").option(
                "partitionOverwriteMode", "dynamic"
            ).mode("overwrite").save(f"{self.base}/{name}")
        stage = self.new_stage()
        if existing is None:
            slots = self.spark.createDataFrame([], schema.SLOTS)
            self.write_state(stage, slots, self.spark.createDataFrame([], schema.PENDING), new)
        else:
            everything = self.meta(existing).unionByName(new)
            self.write_state(stage, self.slots(existing), self.pending(existing), everything, self.retries(existing))
        return self.publish(stage, existing, "initialize")

    def expired_files(self, older_than, keep_versions: int = 1) -> DataFrame:
        """Files last changed before ``older_than`` that no kept version needs.

        Kept are the newest ``keep_versions`` versions: their stage folders, and the reference
        stages their slots name.
        """
        return expired(self._files(), self._needed_stages(self.newest(keep_versions)), older_than)

    def _files(self) -> DataFrame:
        return (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load([p for p in (f"{self.base}/{name}" for name in ("stages", "refs", "ref_counts")) if path_exists(self.spark, p)])
            .select("path", "modificationTime", "length")
        )

    def remove_expired(self, older_than, keep_versions: int = 1) -> int:
        """Delete the folders all of whose files have expired; returns how many.

        A folder is what one job wrote, so their number grows with the runs, not with the data.
        """
        kept = self._needed_stages(self.newest(keep_versions))
        folder = F.regexp_extract("path", r"^(.*/(?:stages/|(?:refs|ref_counts)/stage=)[^/]+)/", 1)
        unneeded = expired(self._files(), kept, None).groupBy(folder.alias("folder")).agg(F.max("modificationTime").alias("newest"))
        old = [r.folder for r in unneeded.filter(F.col("newest") < F.lit(older_than).cast("timestamp")).toLocalIterator()]
        for name in old:
            path, fs = _path(self.spark, name)
            fs.delete(path, True)
        return len(old)

    def _needed_stages(self, kept: list[Version]) -> DataFrame:
        state = {part for v in kept for part in (v.stage, *self._axis_parts(v))}
        own = self.spark.createDataFrame([(part, "state") for part in sorted(state)], "stage string, kind string")
        for version in kept:
            named = self.slots(version).select(F.col("ref_stage").alias("stage"), F.lit("refs").alias("kind"))
            own = own.unionByName(named.filter(F.col("stage").isNotNull()).distinct())
        return own.distinct()


def expired(files: DataFrame, needed: DataFrame, older_than) -> DataFrame:
    """``files(path, modificationTime, length)`` older than the cutoff (None: of any age) whose stage nobody needs.

    ``needed(stage, kind)``: kind is ``state`` for stage folders and ``refs`` for reference folders.
    """
    state = F.regexp_extract("path", r"/stages/([^/]+)/", 1)
    refs = F.regexp_extract("path", r"/(?:refs|ref_counts)/stage=([^/]+)/", 1)
    keyed = files.withColumn("stage", F.when(state != "", state).otherwise(refs)).withColumn(
        "kind", F.when(state != "", "state").otherwise("refs")
    )
    unneeded = keyed.join(needed, ["stage", "kind"], "left_anti")
    if older_than is not None:
        unneeded = unneeded.filter(F.col("modificationTime") < F.lit(older_than).cast("timestamp"))
    return unneeded.select("path", "modificationTime", "length")

