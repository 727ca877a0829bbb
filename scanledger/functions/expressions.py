"""Scalar expressions on urls, times, fill values, shapes and catalogue documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# 1980-01-06T00:00:00Z in seconds since 1970, and the catalogue's direct-access link type.
AXIS_EPOCH_SECONDS = 315964800
DIRECT_ACCESS = "GET DATA VIA DIRECT ACCESS"
SUPPORTED_SCHEMES = ("file", "s3", "https")


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


# -- urls -----------------------------------------------------------------------------------------


def file_name(url: ColumnOrName) -> Column:
    return F.substring_index(_col(url), "/", -1)


def granule_ur(url: ColumnOrName) -> Column:
    """File name without its ``.nc`` ending."""
    return F.regexp_replace(file_name(url), r"\.nc$", "")


def is_granule_url(url: ColumnOrName) -> Column:
    return F.coalesce(F.endswith(_col(url), F.lit(".nc")), F.lit(False))


def scheme(url: ColumnOrName) -> Column:
    return F.when(F.contains(_col(url), F.lit("://")), F.substring_index(_col(url), "://", 1))


def has_supported_scheme(url: ColumnOrName) -> Column:
    return F.coalesce(scheme(url).isin(*SUPPORTED_SCHEMES), F.lit(False))


def outside_prefix(url: ColumnOrName, prefix: str) -> Column:
    """True for links that do not lie under the allowed container."""
    return ~F.startswith(_col(url), F.lit(prefix))


def split_uri(uri: ColumnOrName, strict: bool = True) -> Column:
    """``struct<bucket, key>`` of an object uri; another scheme raises (strict) or gives null."""
    uri = _col(uri)
    parts = F.struct(
        F.regexp_extract(uri, r"^s3://([^/]*)", 1).alias("bucket"),
        F.regexp_extract(uri, r"(?s)^s3://[^/]*/(.*)$", 1).alias("key"),
    )
    ok = F.startswith(uri, F.lit("s3://"))
    if not strict:
        return F.when(ok, parts)
    problem = F.raise_error(F.concat(F.lit("not an object uri: "), F.coalesce(uri, F.lit("null"))))
    return F.when(ok, parts).otherwise(problem.cast("struct<bucket:string,key:string>"))


def direct_link(related_urls: ColumnOrName) -> Column:
    """First in-region granule link of a catalogue record, or null."""
    hits = F.filter(
        _col(related_urls),
        lambda r: (r["Type"] == DIRECT_ACCESS)
        & F.startswith(r["URL"], F.lit("s3://"))
        & F.endswith(r["URL"], F.lit(".nc")),
    )
    return F.get(hits, F.lit(0))["URL"]


def data_link(links: ColumnOrName, access: str = "direct") -> Column:
    """First ``.nc`` link of one access flavour out of a plain list of links, or null."""
    wanted = "s3" if access == "direct" else "https"
    hits = F.filter(
        _col(links),
        lambda u: F.endswith(u, F.lit(".nc")) & F.startswith(u, F.lit(f"{wanted}://")),
    )
    return F.get(hits, F.lit(0))


# -- times ----------------------------------------------------------------------------------------


def axis_timestamp(time: ColumnOrName) -> Column:
    """Axis seconds as a timestamp, for display only (the raw double stays the key)."""
    micros = F.round(_col(time) * 1_000_000).cast("long")
    return F.timestamp_micros(F.lit(AXIS_EPOCH_SECONDS * 1_000_000).cast("long") + micros)


def axis_seconds(instant: ColumnOrName) -> Column:
    """A timestamp as axis seconds."""
    micros = F.unix_micros(_col(instant).cast("timestamp"))
    return (micros - F.lit(AXIS_EPOCH_SECONDS * 1_000_000).cast("long")) / F.lit(1e6)


def parse_instant(text: ColumnOrName) -> Column:
    """ISO text to a timestamp; no offset means UTC (session time zone), junk gives null."""
    return F.try_to_timestamp(_col(text))


def reference_stamp(modified: ColumnOrName) -> Column:
    """Stamp of a reference: modification time of its source plus one second."""
    return _col(modified) + F.expr("INTERVAL 1 SECOND")


# -- values ---------------------------------------------------------------------------------------


def mask_fill(value: ColumnOrName, fill: ColumnOrName | None) -> Column:
    """Fill values become NaN and the rest doubles; without a fill value nothing changes."""
    if fill is None:
        return _col(value)
    value, fill = _col(value), _col(fill)
    return (
        F.when(fill.isNull(), value.cast("double"))
        .when(value == fill, F.lit(float("nan")))
        .otherwise(value.cast("double"))
    )


def cells_match(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Equality of two cells as doubles, with NaN equal to NaN."""
    return _col(a).cast("double").eqNullSafe(_col(b).cast("double"))


# a JSON string, so that what follows as an alternative is never found inside one; possessive, so that long ones need no stack
_STRING = r'("(?:[^"\\]++|\\[\s\S])*+")'
_NUMBER = r"(?<![\w.+-])-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?(?![\w.+-])"
# what is no number, strings whole, and then a number or nothing
_TOKENS = "((?:" + _STRING.replace("(", "(?:", 1) + '|[^"0-9-]++|(?!' + _NUMBER + r")[\s\S])*+)(" + _NUMBER + ")?"
_SPELLINGS = r'[0-9"{\[\s]|NaN|Infinity'  # two different texts without any of these are different JSON values
# numbers that fit decimal(38,18), strings without escapes and non-finite names, each as the whole text
_SHORT_NUMBER = r"\A-?(?:0|[1-9][0-9]{0,17})(?:\.[0-9]{1,18})?\z"
_SHORT_STRING = r'\A(?:"[^"\\]*+"|-?(?:NaN|Infinity))\z'
# what the parser rounds or does not know: exponents, more digits than a decimal has, bare non-finite names
_INEXACT = r"[0-9][eE]|[0-9][0-9.]{36}|NaN|Infinity"
_NUMERAL = "\ue000"  # before the text of a number: no string of the archive starts with it


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _numeral(number: Column) -> Column:
    """A JSON number as digits without zeros at either end and a power of ten: exact, whatever its size and spelling."""

    lower = F.translate(number, "E", "e")
    mantissa = F.substring_index(lower, "e", 1)
    shift = F.when(F.instr(lower, "e") == 0, F.lit(0)).otherwise(F.substring_index(lower, "e", -1).try_cast("decimal(38,0)"))
    fraction = F.when(F.instr(mantissa, ".") == 0, F.lit(0)).otherwise(F.length(mantissa) - F.instr(mantissa, "."))

    def of_digits(digits: Column) -> Column:
        def of_kept(kept: Column) -> Column:
            exponent = (shift - fraction + F.length(digits) - F.length(kept)).cast("decimal(38,0)").cast("string")
            text = F.concat(F.when(F.startswith(number, F.lit("-")), "-").otherwise(""), kept, F.lit("e"), exponent)
            return F.when(kept == "", "0").otherwise(F.coalesce(text, number))

        return _bound(F.rtrim(digits, F.lit("0")), of_kept)

    return _bound(F.ltrim(F.translate(mantissa, "-.", ""), F.lit("0")), of_digits)


def canonical_json(value: ColumnOrName) -> Column:
    """One spelling per JSON value: keys sorted, numbers as digits and a power of ten at every level.

    Non-finite names count as equal bare or quoted. Text that is no JSON stays as it is.
    """

    def spelled(value: Column) -> Column:
        # bare non-finite names get quotes; the marks vanish again where a string was met
        marked = F.regexp_replace(value, _STRING + "|(-?(?:NaN|Infinity))", "$1\u0001$2\u0001")
        quoted = F.regexp_replace(F.replace(marked, F.lit("\u0001\u0001"), F.lit("")), "\u0001([^\u0001]*)\u0001", '"$1"')
        named = F.contains(value, F.lit("NaN")) | F.contains(value, F.lit("Infinity"))
        # numbers become marked strings, so that the parser, which sorts the keys, rounds none
        return _bound(F.when(named, quoted).otherwise(value), exact)

    def exact(text: Column) -> Column:
        others, numbers = F.regexp_extract_all(text, F.lit(_TOKENS), 1), F.regexp_extract_all(text, F.lit(_TOKENS), 2)
        return F.array_join(
            F.zip_with(others, numbers, lambda o, n: F.when(n == "", o).otherwise(F.concat(o, F.lit('"' + _NUMERAL), _numeral(n), F.lit('"')))), ""
        )

    return _bound(_col(value), lambda v: _parsed(spelled(v), v))


def _parsed(text: Column, other: Column) -> Column:
    """The text of a parsed JSON value with its keys sorted, and ``other`` for what is no JSON."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), other)


def values_equal(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Structural equality of two JSON values, non-finite numbers equal in any spelling.

    Equal texts are not parsed, nor is plain text, which has one spelling only, nor are bare numbers and
    strings of the usual spellings. Of the rest, texts whose numbers the parser keeps exact go straight to it.
    """

    def compared(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        one_spelling = ~a.rlike(_SPELLINGS) & ~b.rlike(_SPELLINGS)
        numbers = F.when(a.rlike(_SHORT_NUMBER), 1).when(a.rlike(_SHORT_STRING), 2), F.when(b.rlike(_SHORT_NUMBER), 1).when(b.rlike(_SHORT_STRING), 2)
        scalar = _bound(
            F.struct(numbers[0].alias("a"), numbers[1].alias("b")),
            lambda kind: F.when(kind["a"] != kind["b"], False)
            .when((kind["a"] == 1) & (kind["b"] == 1), a.try_cast("decimal(38,18)") == b.try_cast("decimal(38,18)"))
            .when((kind["a"] == 2) & (kind["b"] == 2), F.trim(a, F.lit('"')) == F.trim(b, F.lit('"'))),
        )
        exact = ~a.rlike(_INEXACT) & ~b.rlike(_INEXACT)
        parsed = F.when(exact, _parsed(a, a).eqNullSafe(_parsed(b, b))).otherwise(canonical_json(a).eqNullSafe(canonical_json(b)))
        return F.when(a.eqNullSafe(b), True).when(one_spelling, False).when(a.isNull() | b.isNull(), False).otherwise(F.coalesce(scalar, parsed))

    return _bound(F.struct(_col(a).alias("a"), _col(b).alias("b")), compared)


# -- shapes and attribute maps --------------------------------------------------------------------


def expected_chunks(shape: ColumnOrName, chunk_shape: ColumnOrName) -> Column:
    """Number of chunks in the grid of one array."""
    counts = F.zip_with(
        _col(shape), _col(chunk_shape), lambda n, c: F.ceil(n / c).cast("long")
    )
    return F.aggregate(counts, F.lit(1).cast("long"), lambda acc, n: acc * n)


def resized_shape(dims: ColumnOrName, shape: ColumnOrName, sizes: dict[str, int | Column], kind: str = "int") -> Column:
    """Shape with the named dimensions set to new sizes; ``kind`` is the type of the shape's numbers."""

    def one(dim: Column, extent: Column) -> Column:
        out = extent
        for name, size in sizes.items():
            size = size if isinstance(size, Column) else F.lit(size)
            out = F.when(dim == name, size.cast(kind)).otherwise(out)
        return out

    return F.when(_col(dims).isNull(), _col(shape)).otherwise(F.zip_with(_col(dims), _col(shape), one))


def without_keys(attributes: ColumnOrName, names: Iterable[str]) -> Column:
    """Attribute map without the named entries."""
    names = sorted(names)
    if not names:
        return _col(attributes)
    return F.map_filter(_col(attributes), lambda k, _: ~k.isin(*names))


def storage_ratio(logical: ColumnOrName, stored: ColumnOrName) -> Column:
    """Logical over stored bytes, null where either is nothing."""
    logical, stored = _col(logical), _col(stored)
    return F.when((stored > 0) & (logical > 0), logical / stored)


# -- catalogue documents --------------------------------------------------------------------------


def joined_levels(levels: Sequence[ColumnOrName], separator: str = " > ") -> Column:
    """Non-empty levels joined in order."""
    present = F.filter(F.array(*[_col(c) for c in levels]), lambda v: v.isNotNull() & (v != ""))
    return F.array_join(present, separator)


# Keyword levels and citation parts, in order.
KEYWORD_LEVELS = ("Category", "Topic", "Term", "VariableLevel1", "VariableLevel2", "VariableLevel3")
CITATION_PARTS = ("Creator", "ReleaseDate", "Title", "Version", "Publisher", "OtherCitationDetails")


def keyword_paths(keywords: ColumnOrName) -> Column:
    """Distinct keyword paths in order of appearance."""
    paths = F.transform(_col(keywords), lambda k: joined_levels([k[name] for name in KEYWORD_LEVELS]))
    return F.array_distinct(paths)


def citation(entry: ColumnOrName) -> Column:
    """Labelled non-empty parts of one citation; the raw document when no part is set."""
    entry = _col(entry)
    parts = [
        F.when(entry[name] != "", F.concat(F.lit(f"{name}: "), entry[name])) for name in CITATION_PARTS
    ]
    text = joined_levels(parts, "; ")
    return F.when(text != "", text).otherwise(F.to_json(entry))


def truncate_value(text: ColumnOrName, limit: int = 500) -> Column:
    """Long text cut to ``limit`` characters, followed by its full length."""
    text = _col(text).cast("string")
    cut = F.concat(
        F.substring(text, 1, limit), F.lit(" (cut from "), F.length(text).cast("string"), F.lit(" characters)")
    )
    return F.when(F.length(text) > limit, cut).otherwise(text)


def interleaved(y: Column | str, x: Column | str) -> Column:
    """Place of (y, x) on the Z-order curve: the bits of both, taken in turn. For numbers from 0 to 2**31 - 1."""

    def spread(name: Column | str) -> Column:
        value = (F.col(name) if isinstance(name, str) else name).cast("long")
        for step in (16, 8, 4, 2, 1):  # halves move apart, then quarters, ... then single bits
            run = (1 << step) - 1
            mask = sum(run << at for at in range(0, 64, 2 * step))
            value = value.bitwiseOR(F.shiftleft(value, step)).bitwiseAND(F.lit(mask))
        return value

    return F.shiftleft(spread(y), 1).bitwiseOR(spread(x))
