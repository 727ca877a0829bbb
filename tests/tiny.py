"""A tiny collection: granules on a 4 x 6 grid, one scan per hour, values computed from the time."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import functions as F

from scanledger import schema
from scanledger.config import VOLATILE_ATTRIBUTES, CollectionConfig
from scanledger.operators.template import build_template
from scanledger.plans.store import Store

BASE_TIME = 1471196538.0244286
SPACING = 3600.0
TIMES = [BASE_TIME + i * SPACING for i in range(3)]
LATITUDE = [14.01, 33.67, 53.33, 72.99]
LONGITUDE = [-167.99, -136.99, -106.0, -75.0, -44.01, -13.01]
STAMP = datetime.datetime(2024, 5, 1, 0, 0, 1)

CONFIG = CollectionConfig(
    "tiny", "TINY_L3", "C1", flatten_groups=("product", "geolocation", "support_data"), promote_to_time=("weight",),
    volatile_attributes=VOLATILE_ATTRIBUTES | {"geospatial_lat_min"}, time_chunk_size=16,
)

# group, variable, type, dims, shape, chunk, fill value
VARIABLES = [
    ("", "time", "float64", ["time"], [1], [1], None),
    ("", "latitude", "float32", ["latitude"], [4], [4], None),
    ("", "longitude", "float32", ["longitude"], [6], [6], None),
    ("", "weight", "float32", ["latitude", "longitude"], [4, 6], [4, 6], 9.96921e36),
    ("product", "vertical_column", "float64", ["time", "latitude", "longitude"], [1, 4, 6], [1, 2, 3], -1e30),
    ("product", "main_data_quality_flag", "int16", ["time", "latitude", "longitude"], [1, 4, 6], [1, 2, 3], -9999.0),
    ("geolocation", "solar_zenith_angle", "float32", ["time", "latitude", "longitude"], [1, 4, 6], [1, 2, 3], -1e30),
    ("support_data", "surface_pressure", "float32", ["time", "latitude", "longitude"], [1, 4, 6], [1, 2, 3], -1e30),
]
CHUNKED = ["vertical_column", "main_data_quality_flag", "solar_zenith_angle", "surface_pressure"]
REFS_PER_GRANULE = 17


def url_of(name: str, folder: str = "s3://src/a") -> str:
    return f"{folder}/{name}.nc"


def headers_of(spark, granules: list[dict]) -> dict:
    """Header tables of ``{"url", "time"}`` granules; optional keys break one thing each.

    epoch: another epoch attribute; times: another time array; latitude: another axis;
    project: another attribute value (None leaves it out); extra: an undeclared attribute.
    """
    times, variables, nodes, axes, refs = [], [], [], [], []
    for n, g in enumerate(granules):
        url, at = g["url"], g["time"]
        times.append((url, g.get("times", [at]), g.get("epoch", at)))
        for grp, name, kind, dims, shape, chunk, fill in g.get("variables", VARIABLES):
            variables.append((url, grp, name, kind, dims, shape, chunk, fill, None, None))
        root = {"Conventions": '"CF-1.6"', "project": g.get("project", '"TINY"'), "history": f'"run {n}"',
                "time_coverage_start_since_epoch": json.dumps(at), "geospatial_lat_min": str(n)}
        if "extra" in g:
            root["extra"] = g["extra"]
        nodes.append((url, "", {k: v for k, v in root.items() if v is not None}))
        nodes.append((url, "/vertical_column", {"units": '"molecules/cm2"', "_FillValue": "-1e30"}))
        axes.append((url, "latitude", g.get("latitude", LATITUDE)))
        axes.append((url, "longitude", LONGITUDE))
        stamp = g.get("stamp", STAMP)
        for name in CHUNKED:
            for c in range(4):
                refs.append((CONFIG.collection, "", name, c // 2, c % 2, url, 1000 * n + c, 48, stamp))
        refs.append((CONFIG.collection, "", "weight", 0, 0, url, 9000 + n, 96, stamp))
    return {
        "times": spark.createDataFrame(times, "url string, times array<double>, epoch double"),
        "vars": spark.createDataFrame(variables, schema.GRANULE_VARS),
        "nodes": spark.createDataFrame(nodes, schema.GRANULE_NODES),
        "axes": spark.createDataFrame(axes, schema.GRANULE_AXES),
        "refs": spark.createDataFrame(refs, schema.GRANULE_REFS),
    }


def granule(name: str, at: float, folder: str = "s3://src/a", **breaks) -> dict:
    return {"url": url_of(name, folder), "time": at, **breaks}


def first_granules() -> list[dict]:
    return [granule(f"granule_{i}", t) for i, t in enumerate(TIMES)]


def entries_of(spark, granules: list[dict]):
    rows = [
        (CONFIG.collection, g["url"], g["url"].rsplit("/", 1)[-1].removesuffix(".nc"), g["time"], i)
        for i, g in enumerate(granules)
    ]
    return spark.createDataFrame(rows, "collection string, url string, granule_ur string, time double, position long")


def header(spark, collection: str = CONFIG.collection, schema_id: str = CONFIG.schema_id):
    rows = [(schema_id, collection, "C1", CONFIG.time_units, "2024-01-01T00:00:00Z")]
    return spark.createDataFrame(rows, schema.STORE_META)


def coordinates(spark):
    rows = [("latitude", i, v) for i, v in enumerate(LATITUDE)] + [("longitude", i, v) for i, v in enumerate(LONGITUDE)]
    return spark.createDataFrame(rows, schema.COORDINATES)


def template(spark):
    h = headers_of(spark, first_granules()[:1])
    return build_template(h["vars"], h["nodes"], url_of("granule_0"), CONFIG)


def new_store(spark, path) -> Store:
    store = Store(spark, str(path))
    named = F.lit(CONFIG.collection).alias("collection")
    store.initialize(
        template(spark).select(named, "*"), coordinates(spark).select(named, "*"), header(spark)
    )
    return store


def messages(spark, granules: list[dict]):
    rows = [(f"m{i}-{g['url']}", json.dumps({"url": g["url"]})) for i, g in enumerate(granules)]
    return spark.createDataFrame(rows, "message_id string, body string")


def axis(store: Store) -> list[tuple]:
    rows = store.slots(store.current()).orderBy("slot").collect()
    return [(r.slot, r.granule_ur, r.time) for r in rows]


def ledger(store: Store) -> list[str]:
    return [r.granule_ur for r in store.pending(store.current()).orderBy("seq").collect()]
