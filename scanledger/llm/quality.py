"""Line-first quality rules: judge every line, drop the failing ones, then reject documents that lose too much.

Everything is column expressions over one row, so there is no shuffle and no Python.

Defined results: a null text has no words and no lines with a word, and is judged as an empty one (base_failed); its cleaned text
is null. Blank lines are never dropped. Repeated rows are judged one by one. Columns of the input are never read except the text,
and new columns take names that the caller chooses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import fresh, let

SPACES = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[^#*$%&|<>]+"
# a sentence ends at the end of the line, or inside it before a blank (prose that was cut off)
SENTENCE_END = r"[.!?\x{2026}\x{3002}][\"')\]\x{201D}\x{2019}\x{00BB}]*([\x20\x09-\x0D]|$)"
SEPARATOR = r"(^|[\x20\x09-\x0D])[|>\x{00BB}\x{203A}\x{2022}\x{00B7}]+(?=[\x20\x09-\x0D]|$)"
BOILERPLATE = (
    r"(?i)(all rights reserved|cookie policy|we use cookies|privacy policy|terms of (use|service)|enable javascript"
    r"|click here to|sign up for our newsletter|skip to (main )?content|lorem ipsum)"
)

MIN_WORDS = 50
MAX_LOST = 0.5  # share of a document's word characters that may go with failing lines


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Windows are 64-bit hashes. 33 of those bits and the position share one long, so one sort of longs puts possible equals side by
    side; only those few are then compared by the whole hash.
    """

    def windows(w: Column) -> Column:
        return F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
        )

    def beside(rows: Column, key) -> Column:
        return F.filter(
            rows,
            lambda x, i: F.coalesce(key(x) == key(F.get(rows, i - 1)), F.lit(False))
            | F.coalesce(key(x) == key(F.get(rows, i + 1)), F.lit(False)),
        )

    def repeated(hashes: Column) -> Column:
        packed = F.sort_array(F.transform(hashes, lambda x, i: F.shiftleft(x, 31).bitwiseOR(i.cast("long"))))
        likely = let(packed, lambda rows: beside(rows, lambda x: F.shiftright(x, 31)))

        def entry(x: Column) -> Column:
            at = x.bitwiseAND(F.lit(2**31 - 1)).cast("int")
            return F.struct(F.get(hashes, at).alias("hash"), at.alias("at"))

        equal = let(F.sort_array(F.transform(likely, entry)), lambda rows: beside(rows, lambda x: x["hash"]))
        return F.sort_array(F.transform(equal, lambda x: x["at"]))

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    return let(let(windows(words), repeated), covered).cast("long")


def base_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    by_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).alias("repeated")))
    filled = F.filter(F.split(text, "\n"), lambda line: line.rlike(A_WORD))
    doubled = let(filled, lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
    chars = F.length(F.regexp_replace(text, SPACES, "")).cast("long")
    symbols = F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long")
    return let(
        by_words,
        lambda w: F.struct(
            w["n"].alias("n_words"), chars.alias("word_chars"), symbols.alias("n_symbols"), doubled.alias("n_dup_lines"),
            w["repeated"].alias("n_repeat_words"),
        ),
    )


def line_passes(line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules of one line; blank lines pass."""
    words = F.size(F.array_remove(F.split(line, SPACES), ""))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    symbols = F.length(F.regexp_replace(line, SYMBOLS, ""))
    return ~line.rlike(A_WORD) | (
        line.rlike(SENTENCE_END)
        & ~((separators >= 3) & (separators * 8 >= words))
        & (symbols * 3 <= words)
        & ~(line.rlike(BOILERPLATE) & (words <= 40))
    )


def cleaned(text: Column) -> Column:
    """The text without failing lines."""
    return F.array_join(F.filter(F.split(text, "\n"), line_passes), "\n")


def judge_quality(docs: DataFrame, text: str = "text", into: str = "quality", max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` with one struct column: the base counts, base_failed, cleaned text, lost_chars and kept.

    ``into`` must not be a column of ``docs``.
    """
    counts, clean = fresh(docs, "counts_"), fresh(docs, "clean_")
    found = docs.withColumns({counts: base_counts(F.col(text)), clean: cleaned(F.col(text))})
    n = F.col(counts)
    failed = (n["n_words"] < MIN_WORDS) | (100 * n["n_repeat_words"] > 50 * n["n_words"])
    left = F.length(F.regexp_replace(F.coalesce(F.col(clean), F.lit("")), SPACES, "")).cast("long")
    lost = n["word_chars"] - left
    fields = [n[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return found.withColumn(
        into,
        F.struct(
            *fields, failed.alias("base_failed"), F.col(clean).alias("cleaned"), lost.alias("lost_chars"),
            (~failed & (lost <= max_lost * n["word_chars"])).alias("kept"),
        ),
    ).drop(counts, clean)


def keep_quality(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that pass, with their cleaned texts and the columns of ``docs``."""
    quality = fresh(docs, "quality_")
    judged = judge_quality(docs, text, quality, max_lost).filter(F.col(quality)["kept"])
    return judged.withColumn(text, F.col(quality)["cleaned"]).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    judged = judge_quality(docs.select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")
    return judged.select("doc_id", *(F.col("quality")[c].alias(c) for c in names))


ORACLE = r"""
WITH base AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS filled
  FROM documents),
word AS (SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM base),
tri AS (SELECT row_id, i, word AS a, lead(word, 1) OVER w AS b, lead(word, 2) OVER w AS c FROM word
        WINDOW w AS (PARTITION BY row_id ORDER BY i)),
twice AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, a, b, c) AS n FROM tri WHERE c IS NOT NULL)
          WHERE n > 1),
hit AS (SELECT row_id, count(DISTINCT i + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY row_id),
line AS (SELECT row_id, unnest(filled) AS l FROM base),
judged AS (
  SELECT row_id, l, len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n,
         len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: regexp_full_match(w, '[|>»›•·]+'))) AS separators,
         length(regexp_replace(l, '[^#*$%&|<>]+', '', 'g')) AS symbols
  FROM line),
good AS (
  SELECT row_id, sum(length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g'))) AS chars FROM judged
  WHERE regexp_matches(l, '[.!?…。]["'')\]”’»]*([\x20\x09-\x0D]|$)')
    AND NOT (separators >= 3 AND separators * 8 >= n) AND symbols * 3 <= n
    AND NOT (regexp_matches(l, '(?i)(all rights reserved|cookie policy|we use cookies|privacy policy|terms of (use|service)|enable javascript|click here to|sign up for our newsletter|skip to (main )?content|lorem ipsum)') AND n <= 40)
  GROUP BY row_id),
counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(filled) - len(list_distinct(filled)))::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words,
         coalesce(good.chars, 0)::BIGINT AS good_chars
  FROM base LEFT JOIN hit USING (row_id) LEFT JOIN good USING (row_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars - good_chars <= 0.5 * word_chars AS kept,
       word_chars - good_chars AS lost_chars
FROM counts
"""
