"""Personal data: exact forms, and what bootstrapped context patterns find beside them.

1. *Base.* Four exact forms (email, ip, card, phone) are found in every whole text, with code-point offsets.
2. *Mentions.* A looser form finds everything that might be such an identifier. A mention whose value passes an exact form is a seed of
   that kind; another one is a candidate of each kind whose looser shape it has. The words around a mention are its contexts: two words
   before it, one word before it, and one word on either side.
3. *Graph.* Contexts (patterns) and values (instances) form a bipartite graph of distinct edges for each kind, so a copied document
   counts once. A pattern's confidence is the sum of its instances' scores over their number plus one; a seed scores 1, a seed of
   another kind 0, and a candidate the highest confidence among its reliable patterns. A few rounds let seeds lend confidence to
   patterns, those to candidates, and those to further patterns.
4. *Extraction.* A candidate with a pattern of high confidence becomes a span, unless it overlaps a base span of its text.

Everything is column expressions, aggregates and joins; scores are integers (millionths), so the order of sums doesn't matter. Texts
are never shuffled: what leaves a row are its mentions. Aggregates combine in the tasks first, patterns that cannot become reliable are
dropped before the rounds, and hot patterns or values are salted.

Defined results: a null text counts as empty and has no spans; repeated rows each get their own result, which is the same; rows with
equal texts have equal spans; ties between kinds go to the higher confidence, then to the kind listed first. Texts may be of any length:
every pattern takes time in proportion to it. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import ascii_lower, let, written
from scanledger.session import lookup

KINDS = ("email", "ip", "card", "phone")

# The four forms. Possessive quantifiers and look-behinds take nothing from them; they keep the time linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"

LOOSE_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
LOOSE_NUMBER = r"\+?\(?[0-9](?:(?:\)\x20?|[\x20.-]|\x20?\()?[0-9]){6,}+"
MENTION = f"{LOOSE_EMAIL}|{IP}|{LOOSE_NUMBER}"
SPACES = r"[\x20\x09-\x0D]+"
CONTEXT = 200  # code points on each side that hold the context words

ROUNDS = 3
SUPPORT = 3  # distinct instances' scores that a reliable pattern sums up to, at least
RELIABLE = 500_000  # millionths: patterns that lend their confidence to candidates
CONFIDENT = 800_000  # millionths: patterns whose candidates become spans
SALTS = 16

SPAN = "struct<start:int,stop:int,value:string>"


def _prefix_sums(lengths: Column) -> Column:
    """For each entry the sum of those before it, in blocks of about the square root of their number."""

    def sums(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(
            values, start,
            lambda a, x: F.struct((a["total"] + x).alias("total"), F.array_append(a["before"], a["total"]).alias("before")),
        )

    def blocks(values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(values))).cast("int")
        firsts = F.sequence(F.lit(0), F.size(values) - 1, width)
        return F.transform(firsts, lambda at: sums(F.slice(values, at + 1, width)))

    def joined(found: Column) -> Column:
        offsets = sums(F.transform(found, lambda b: b["total"]))["before"]
        return let(offsets, lambda o: F.flatten(F.transform(found, lambda b, i: F.transform(b["before"], lambda x: x + F.get(o, i)))))

    return let(lengths, lambda values: let(blocks(values), joined))


def _located(text: Column, pattern: str, with_gaps: bool = False) -> Column:
    """The matches of a pattern as structs of start, stop (code points, stop exclusive) and value; with the text around, if asked."""
    kind = f"array<{SPAN[:-1]},before:string,after:string>>" if with_gaps else f"array<{SPAN}>"

    def spans(hits: Column, gaps: Column) -> Column:
        steps = F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(gaps, i)))

        def span(h: Column, i: Column, sums: Column) -> Column:
            start = F.get(sums, i) + F.length(F.get(gaps, i))
            more = [F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after")] if with_gaps else []
            return F.struct(start.alias("start"), (start + F.length(h)).alias("stop"), h.alias("value"), *more)

        return let(_prefix_sums(steps), lambda sums: F.transform(hits, lambda h, i: span(h, i, sums)))

    def found(hits: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        return F.when(F.size(hits) == 0, F.array().cast(kind)).otherwise(let(gaps, lambda g: spans(hits, g)))

    return let(F.regexp_extract_all(text, F.lit(pattern), 0), found)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_ip(value: Column) -> Column:
    return value.rlike(IP_PARTS)


def _is_card(value: Column) -> Column:
    return let(_digits(value), lambda d: F.length(d).between(13, 19) & F.call_function("luhn_check", d))


def _is_phone(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def base_spans(text: Column) -> Column:
    """Struct of one array of (start, stop, value) for each kind; ``text`` must not be null."""
    none = F.array().cast(f"array<{SPAN}>")
    numeric = text.rlike("[0-9]")

    def kept(pattern: str, passes: Callable[[Column], Column]) -> Column:
        return F.filter(_located(text, pattern), lambda s: passes(s["value"]))

    return F.struct(
        F.when(F.contains(text, F.lit("@")), _located(text, EMAIL)).otherwise(none).alias("email"),
        F.when(numeric, kept(IP, _is_ip)).otherwise(none).alias("ip"),
        F.when(numeric, kept(CARD, _is_card)).otherwise(none).alias("card"),
        F.when(F.contains(text, F.lit("+")), kept(PHONE, _is_phone)).otherwise(none).alias("phone"),
    )


def _words(piece: Column) -> Column:
    """Words of a context: A-Z lower-cased and digits as 0."""
    plain = F.regexp_replace(ascii_lower(piece), "[0-9]", "0")
    return F.filter(F.split(plain, SPACES), lambda w: w != "")


def _contexts(before: Column, after: Column) -> Column:
    def named(l: Column, r: Column) -> Column:
        last, second, right = F.get(l, F.size(l) - 1), F.get(l, F.size(l) - 2), F.get(r, F.lit(0))
        return F.filter(
            F.array(
                F.concat(F.lit("2:"), second, F.lit(" "), last), F.concat(F.lit("1:"), last),
                F.concat(F.lit("b:"), last, F.lit(" _ "), right),
            ),
            lambda c: c.isNotNull(),
        )

    left = _words(F.substring(before, -CONTEXT, CONTEXT))
    return let(left, lambda l: let(_words(F.substring(after, 1, CONTEXT)), lambda r: named(l, r)))


def _seed(value: Column) -> Column:
    """The kind (its number) whose exact form a mention's value has, else null."""
    return (
        F.when(F.contains(value, F.lit("@")), F.when(value.rlike(f"^{EMAIL}$"), F.lit(0)))
        .when(value.rlike(f"^{IP}$"), F.when(_is_ip(value), F.lit(1)))
        .when(value.rlike(f"^{PHONE}$") & _is_phone(value), F.lit(3))
        .when(value.rlike(f"^{CARD}$") & _is_card(value), F.lit(2))
    )


def _shapes(value: Column) -> Column:
    """The kinds whose looser shape a mention's value has."""

    def of(n: Column) -> Column:
        ip = value.rlike(f"^{IP}$")
        return F.filter(
            F.array(
                F.when(F.contains(value, F.lit("@")), F.lit(0)), F.when(ip, F.lit(1)),
                F.when(value.rlike(f"^{CARD}$") & n.between(12, 19), F.lit(2)),
                F.when(~ip & ~F.contains(value, F.lit("@")) & n.between(7, 15), F.lit(3)),
            ),
            lambda k: k.isNotNull(),
        )

    return let(F.length(_digits(value)), of)


def mentions(text: Column) -> Column:
    """Array of (start, stop, value, seed, kinds, contexts) of everything that might be an identifier."""

    def described(m: Column) -> Column:
        value = m["value"]
        plain = F.when(F.contains(value, F.lit("@")), ascii_lower(value)).otherwise(F.regexp_replace(value, r"[\x20().-]", ""))
        return F.struct(
            m["start"].alias("start"), m["stop"].alias("stop"), plain.alias("value"), _seed(value).alias("seed"),
            _shapes(value).alias("kinds"), _contexts(m["before"], m["after"]).alias("contexts"),
        )

    apart = lambda m: ~m["before"].rlike("[A-Za-z0-9]$") & ~m["after"].rlike("^[A-Za-z0-9@_]")
    found = F.transform(F.filter(_located(text, MENTION, with_gaps=True), apart), described)
    return F.filter(found, lambda m: F.size(m["kinds"]) > 0)


def _edges(found: DataFrame) -> DataFrame:
    """Distinct (pattern, kind, instance) of a table of mentions, with what is known: 1 a seed, 0 one of another kind, null a candidate."""
    each = found.select(
        F.explode("contexts").alias("pattern"), "kinds", "value", "seed"
    ).select("pattern", F.explode("kinds").alias("kind"), "value", "seed")
    known = F.when(F.col("seed").isNotNull(), (F.col("seed") == F.col("kind")).cast("int"))
    return each.select("pattern", "kind", "value", known.alias("known")).groupBy("pattern", "kind", "value").agg(F.max("known").alias("known"))


def learn_patterns(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT) -> DataFrame:
    """Patterns (pattern, kind, n, seeds, confidence) that a table of mentions supports.

    ``found`` has one row a mention: value, seed, kinds, contexts. Only patterns with ``support`` distinct instances and at least one
    candidate matter, so only their edges go through the rounds.
    """
    edges = written(_edges(found), "pii-edges")
    totals = edges.groupBy("pattern", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("known", F.lit(0))).alias("seeds"),
        F.count(F.when(F.col("known").isNull(), 1)).alias("open"),
    )
    fixed = written(totals.filter((F.col("n") >= support) & (F.col("open") > 0)).drop("open"), "pii-patterns")
    salt = lambda value: F.pmod(F.xxhash64(value), F.lit(SALTS))
    salted = lookup(fixed.select("pattern", "kind").withColumn("salt", F.explode(F.array(*(F.lit(i).cast("long") for i in range(SALTS))))))
    unknown = edges.filter(F.col("known").isNull()).withColumn("salt", salt("value"))
    unknown = written(unknown.join(salted, ["pattern", "kind", "salt"]).select("pattern", "kind", "value", "salt"), "pii-open")

    def confidence(extra: Column) -> Column:
        return F.floor((F.col("seeds") * 1_000_000 + extra) / (F.col("n") + 1)).cast("long").alias("confidence")

    scores = fixed.select("pattern", "kind", "n", "seeds", F.lit(0).cast("long").alias("extra"))
    for step in range(rounds):
        reliable = scores.select("pattern", "kind", "n", "seeds", confidence(F.col("extra")), "extra").filter(
            (F.col("seeds") * 1_000_000 + F.col("extra") >= support * 1_000_000) & (F.col("confidence") >= RELIABLE)
        )
        spread = lookup(
            reliable.select("pattern", "kind", "confidence", F.explode(F.array(*(F.lit(i).cast("long") for i in range(SALTS)))).alias("salt"))
        )
        lent = unknown.join(spread, ["pattern", "kind", "salt"]).groupBy("value", "kind").agg(F.max("confidence").alias("score"))
        again = unknown.join(lookup(lent), ["value", "kind"]).groupBy("pattern", "kind").agg(F.sum("score").alias("extra"))
        scores = written(
            fixed.join(again, ["pattern", "kind"], "left").select(
                "pattern", "kind", "n", "seeds", F.coalesce("extra", F.lit(0)).cast("long").alias("extra")
            ),
            f"pii-round-{step}",
        )
    return scores.filter(F.col("seeds") * 1_000_000 + F.col("extra") >= support * 1_000_000).select(
        "pattern", "kind", "n", "seeds", confidence(F.col("extra"))
    )


def find_pii(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, support: int = SUPPORT) -> DataFrame:
    """The columns of ``docs`` without the text, and one struct column ``pii`` with two arrays of spans.

    ``base`` holds the exact forms, ``added`` what patterns of high confidence found: structs of kind (its number in ``KINDS``), start
    and stop in code points.
    """
    rest = [c for c in docs.columns if c != text]
    whole = F.coalesce(F.col(text), F.lit(""))
    seen = F.when(whole.rlike("[0-9@]"), mentions(whole))
    read = docs.select(
        F.struct(*rest).alias("row") if rest else F.lit(0).alias("row"), base_spans(whole).alias("base"), seen.alias("seen"),
        F.when(whole.rlike("[0-9@]"), F.concat(F.md5(whole), F.length(whole).cast("string"))).alias("text_key"),
    )

    def numbered(kind: int, name: str) -> Column:
        return F.transform(F.col("base")[name], lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))

    exact = F.concat(*(numbered(i, name) for i, name in enumerate(KINDS)))

    def beside(m: Column) -> Column:
        return m["seed"].isNull() & ~F.exists("exact", lambda s: (s["start"] < m["stop"]) & (m["start"] < s["stop"]))

    read = read.withColumn("exact", exact).withColumn("open", F.coalesce(F.filter("seen", beside), F.array().cast(_MENTIONS)))
    read = written(read.select("row", "exact", "seen", "open", F.when(F.size("open") > 0, F.col("text_key")).alias("text_key")), "pii-rows")

    found = read.select(F.explode("seen").alias("m")).select("m.value", "m.seed", "m.kinds", "m.contexts")
    patterns = learn_patterns(found, rounds, support).filter(F.col("confidence") >= CONFIDENT)
    salts = F.array(*(F.lit(i).cast("long") for i in range(SALTS)))
    patterns = lookup(patterns.select("pattern", "kind", "confidence", F.explode(salts).alias("salt")))
    # texts that are equal have equal spans, so each is looked at once
    once = read.filter(F.col("text_key").isNotNull()).groupBy("text_key").agg(F.first("open").alias("open"))
    opened = once.select("text_key", F.explode("open").alias("m")).select(
        "text_key", "m.start", "m.stop", F.explode("m.contexts").alias("pattern"), "m.kinds"
    ).select("text_key", "start", "stop", "pattern", F.explode("kinds").alias("kind"))
    opened = opened.withColumn("salt", F.pmod(F.xxhash64("text_key", "start"), F.lit(SALTS)))
    best = opened.join(patterns, ["pattern", "kind", "salt"]).groupBy("text_key", "start", "stop").agg(
        F.max(F.struct("confidence", (-F.col("kind")).alias("rank"))).alias("best")
    )
    span = F.struct((-F.col("best.rank")).alias("kind"), "start", "stop")
    added = best.groupBy("text_key").agg(F.sort_array(F.collect_list(span)).alias("added"))

    none = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    columns = [F.col("row")[c].alias(c) for c in rest]
    open_rows = read.filter(F.col("text_key").isNotNull()).join(lookup(added), "text_key", "left")
    with_added = open_rows.select(*columns, F.struct(F.col("exact").alias("base"), F.coalesce("added", none).alias("added")).alias("pii"))
    closed = read.filter(F.col("text_key").isNull())
    return with_added.unionByName(closed.select(*columns, F.struct(F.col("exact").alias("base"), none.alias("added")).alias("pii")))


_MENTIONS = "array<struct<start:int,stop:int,value:string,seed:int,kinds:array<int>,contexts:array<string>>>"


def spans_text(spans: Column) -> Column:
    """``kind:start:stop`` of spans in the order given, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def query(docs: DataFrame) -> DataFrame:
    found = find_pii(docs.select("doc_id", "text"))
    base = F.col("pii.base")

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{name}") for i, name in enumerate(KINDS)]
    every = F.sort_array(F.concat(base, F.col("pii.added")))
    return found.select(
        "doc_id", *counts, F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(every).alias("spans"),
        F.size("pii.added").cast("long").alias("n_added"),
    )


def _oracle(rounds: int = ROUNDS) -> str:
    """The same in SQL; its regular expressions are linear by themselves, so they need neither look-behinds nor possessive quantifiers."""
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    ip, card, phone = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", PHONE
    number = r"\+?\(?[0-9](?:(?:\)\x20?|[\x20.-]|\x20?\()?[0-9]){6,}"
    mention = rf"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*|[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)|{number}"
    located = """
{name} AS (
  SELECT id, hit, stop - length(hit) AS start, stop, before, after FROM (
    SELECT id, hit, before, after, sum(length(hit) + length(before)) OVER (PARTITION BY id ORDER BY i) AS stop FROM (
      SELECT id, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS before, unnest(gaps[2:]) AS after, generate_subscripts(hits, 1) AS i FROM (
        SELECT id, regexp_extract_all(text, '{pattern}', 0) AS hits, regexp_split_to_array(text, '{pattern}') AS gaps
        FROM d WHERE regexp_matches(text, '{pattern}')))))"""
    digits = "regexp_replace({0}, '[^0-9]', '', 'g')"
    of_hit = digits.format("hit")
    luhn = f"""list_sum(list_transform(range(1, length({of_hit}) + 1), lambda i:
        CASE WHEN (length({of_hit}) - i) % 2 = 0 THEN substring({of_hit}, i, 1)::INT
             ELSE (2 * substring({of_hit}, i, 1)::INT) // 10 + (2 * substring({of_hit}, i, 1)::INT) % 10 END)) % 10 = 0"""
    is_card = f"(CASE WHEN length({of_hit}) BETWEEN 13 AND 19 THEN {luhn} ELSE false END)"
    is_ip = f"regexp_matches(hit, '{IP_PARTS}')"
    is_phone = f"length({of_hit}) BETWEEN 9 AND 15"
    words = "list_filter(regexp_split_to_array(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    steps, extra = [], "0"
    source = "fixed"
    for k in range(rounds):
        steps.append(f"""
lent{k} AS (SELECT value, kind, max(confidence) AS score FROM open JOIN (
    SELECT pattern, kind, (seeds * 1000000 + {extra}) // (n + 1) AS confidence FROM {source} WHERE seeds * 1000000 + {extra} >= {SUPPORT}000000
  ) USING (pattern, kind) WHERE confidence >= {RELIABLE} GROUP BY value, kind),
again{k} AS (SELECT pattern, kind, sum(score) AS extra FROM open JOIN lent{k} USING (value, kind) GROUP BY pattern, kind),
scores{k} AS (SELECT pattern, kind, n, seeds, coalesce(a.extra, 0) AS extra FROM fixed LEFT JOIN again{k} AS a USING (pattern, kind))""")
        source, extra = f"scores{k}", "extra"
    finds = ",".join(located.format(name=f"at_{n}", pattern=p) for n, p in zip((*KINDS, "all"), (email, ip, card, phone, mention), strict=True))
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),{finds},
base AS (
  SELECT id, 0 AS kind, start, stop FROM at_email UNION ALL SELECT id, 1, start, stop FROM at_ip WHERE {is_ip}
  UNION ALL SELECT id, 2, start, stop FROM at_card WHERE {is_card} UNION ALL SELECT id, 3, start, stop FROM at_phone WHERE {is_phone}),
likely AS (
  SELECT *, length({of_hit}) AS digits, contains(hit, '@') AS mail, regexp_full_match(hit, '{ip}') AS dotted, regexp_full_match(hit, '{card}') AS plain
  FROM at_all WHERE NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9@_]')),
mention AS (
  SELECT id, start, stop,
    CASE WHEN mail THEN translate(hit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE regexp_replace(hit, '[\\x20().-]', '', 'g') END AS value,
    CASE WHEN mail THEN CASE WHEN regexp_full_match(hit, '{email}') THEN 0 END WHEN dotted THEN CASE WHEN {is_ip} THEN 1 END
         WHEN regexp_full_match(hit, '{phone}') AND {is_phone} THEN 3 WHEN plain AND {is_card} THEN 2 END AS seed,
    list_filter([CASE WHEN mail THEN 0 END, CASE WHEN dotted THEN 1 END, CASE WHEN plain AND digits BETWEEN 12 AND 19 THEN 2 END,
                 CASE WHEN NOT dotted AND NOT mail AND digits BETWEEN 7 AND 15 THEN 3 END], lambda k: k IS NOT NULL) AS kinds,
    {words.format(f"right(before, {CONTEXT})")} AS l, {words.format(f"left(after, {CONTEXT})")} AS r FROM likely),
context AS (SELECT id, start, stop, value, seed, kinds,
    list_filter(['2:' || l[-2] || ' ' || l[-1], '1:' || l[-1], 'b:' || l[-1] || ' _ ' || r[1]], lambda c: c IS NOT NULL) AS contexts FROM mention),
flat AS (SELECT id, start, stop, value, seed, kind, unnest(contexts) AS pattern FROM (SELECT *, unnest(kinds) AS kind FROM context)),
edge AS (SELECT pattern, kind, value, max(CASE WHEN seed IS NOT NULL THEN (seed = kind)::INT END) AS known FROM flat GROUP BY ALL),
fixed AS (SELECT pattern, kind, count(*) AS n, sum(coalesce(known, 0)) AS seeds FROM edge GROUP BY pattern, kind
          HAVING count(*) >= {SUPPORT} AND count(*) FILTER (known IS NULL) > 0),
open AS (SELECT pattern, kind, value FROM edge SEMI JOIN fixed USING (pattern, kind) WHERE known IS NULL),{",".join(steps)},
sure AS (SELECT pattern, kind, (seeds * 1000000 + extra) // (n + 1) AS confidence FROM {source}
         WHERE seeds * 1000000 + extra >= {SUPPORT}000000 AND (seeds * 1000000 + extra) // (n + 1) >= {CONFIDENT}),
added AS (
  SELECT id, start, stop, -max(struct_pack(c := confidence, r := -kind)).r AS kind FROM flat JOIN sure USING (pattern, kind)
  WHERE seed IS NULL AND NOT EXISTS (SELECT 1 FROM base WHERE base.id = flat.id AND base.start < flat.stop AND flat.start < base.stop)
  GROUP BY id, start, stop),
span AS (SELECT id, kind, start, stop, true AS exact FROM base UNION ALL SELECT id, kind, start, stop, false FROM added),
named AS (SELECT *, ['email', 'ip', 'card', 'phone'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS name FROM span),
total AS (SELECT id, count(*) FILTER (exact AND kind = 0) AS n_email, count(*) FILTER (exact AND kind = 1) AS n_ip,
    count(*) FILTER (exact AND kind = 2) AS n_card, count(*) FILTER (exact AND kind = 3) AS n_phone, count(*) FILTER (NOT exact) AS n_added,
    string_agg(name, ',' ORDER BY kind, start) FILTER (exact) AS base, string_agg(name, ',' ORDER BY kind, start) AS spans FROM named GROUP BY id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_added, 0) AS n_added
FROM d LEFT JOIN total USING (id)
"""


ORACLE = _oracle()
