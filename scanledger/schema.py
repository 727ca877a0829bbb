"""Explicit schemas of every table the library reads or writes."""

from __future__ import annotations

GRANULE_ENTRY = "struct<url string, granule_ur string, time double>"

INVENTORY = (
    "schema string, collection string, concept_id string, time_units string, built_at string, "
    f"granules array<{GRANULE_ENTRY}>"
)

# one row per axis position; ref_stage names the write that holds the slot's references
SLOTS = (
    "collection string, slot long, time double, granule_ur string, granule_url string, ref_stage string"
)
PENDING = "collection string, granule_ur string, url string, time double, seq long"
STORE_META = (
    "schema string, collection string, concept_id string, time_units string, built_at string"
)
GRANULE_REFS = (
    "collection string, granule_ur string, variable string, cy int, cx int, url string, "
    "offset long, length long, last_updated_at timestamp"
)
CHUNK_REFS = (
    "collection string, variable string, slot long, cy int, cx int, url string, offset long, "
    "length long, last_updated_at timestamp"
)
TEMPLATE = (
    "path string, node_type string, data_type string, shape array<int>, chunk_shape array<int>, "
    "fill_value string, codecs array<string>, dims array<string>, attributes map<string,string>"
)
COORDINATES = "axis string, idx int, value float"
MESSAGES = "message_id string, body string, attempts int"
RETRIES = f"collection string, {MESSAGES}"
WATERMARK = "collection string, revision_date timestamp"

CATALOGUE_RECORD = (
    "meta struct<`concept-id`: string, `revision-id`: string, `revision-date`: string>, "
    "umm struct<GranuleUR: string, "
    "TemporalExtent: struct<RangeDateTime: struct<BeginningDateTime: string, EndingDateTime: string>>, "
    "RelatedUrls: array<struct<Type: string, URL: string>>>"
)
CATALOGUE_PAGE = f"items array<struct<{CATALOGUE_RECORD.replace('meta struct', 'meta: struct').replace('umm struct', 'umm: struct')}>>"

COLLECTION_RECORD = """
meta struct<`concept-id`: string, `revision-date`: string>,
umm struct<
  ShortName: string, Version: string, EntryTitle: string, Abstract: string,
  DOI: struct<DOI: string>,
  CollectionProgress: string,
  ProcessingLevel: struct<Id: string>,
  CollectionCitations: array<struct<Creator: string, ReleaseDate: string, Title: string, Version: string,
    Publisher: string, OtherCitationDetails: string>>,
  Platforms: array<struct<ShortName: string, Instruments: array<struct<ShortName: string>>>>,
  Projects: array<struct<ShortName: string>>,
  ScienceKeywords: array<struct<Category: string, Topic: string, Term: string, VariableLevel1: string,
    VariableLevel2: string, VariableLevel3: string>>,
  TemporalExtents: array<struct<RangeDateTimes: array<struct<BeginningDateTime: string, EndingDateTime: string>>,
    EndsAtPresentFlag: boolean, TemporalResolution: struct<Value: string, Unit: string>>>>
"""

GRANULE_VARS = (
    "url string, grp string, name string, data_type string, dims array<string>, shape array<int>, "
    "chunk_shape array<int>, fill_value double, codecs array<string>, filters array<string>"
)
GRANULE_NODES = "url string, path string, attributes map<string,string>"
GRANULE_TIMES = "url string, times array<double>, epoch double"
GRANULE_AXES = "url string, axis string, `values` array<float>"
FINDINGS = "check string, subject string, detail string, severity string"
