"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Each rule bounds one measure of a text. ``measured`` is a single Column: it splits the text, counts,
and compiles the table into the list of broken rules. Intermediate arrays are bound once, so the
Column may be filtered on or pushed down without being computed again for each use.

Defined results: a null text counts as an empty one (no words, so it fails the base rules); a ratio
over no words or no lines is 0; very long texts are measured whole; repeated rows and rows with
null ids are judged on their own; an empty table gives an empty table; other columns of the input
pass through untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueflow.llm.common import words

BASE_MIN_WORDS = 50
BASE_MAX_REPEATED_PERCENT = 50
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of the languages served (fixed values).
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not",
    "der", "die", "das", "und", "ein", "eine", "den", "von", "zu", "mit", "sich", "des", "auf", "ist", "im", "nicht",
    "le", "la", "les", "de", "des", "un", "une", "et", "en", "du", "que", "qui", "par", "pour", "sur", "avec",
    "el", "los", "las", "y", "se", "del", "por", "con", "su", "para", "al", "lo",
    "il", "di", "che", "è", "per", "non", "della", "sono", "os", "um", "uma", "não", "com", "dos", "mais",
    "het", "een", "van", "voor", "niet", "zijn", "och", "att", "det", "som", "på", "för", "är", "og", "til", "av", "af", "ikke",
    "nie", "się", "jest", "na", "że", "je", "jsou", "které", "ja", "ei", "oli", "että", "az", "és", "egy", "nem", "hogy",
    "și", "să", "este", "nu", "bir", "ve", "bu", "için", "yang", "dan", "dengan", "untuk", "ini", "và", "là", "của", "không",
)
LATIN_LETTERS = 0x24F  # last code point of the Latin blocks


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in [low, high]; a missing bound does not bind.

    A ``latin`` rule binds only texts of which no more than half is letters of other scripts.
    """

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    latin: bool = False


RULES = (
    Rule("word_length", "mean_word_chars", low=2.0, high=12.0, latin=True),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_ratio", low=0.01, latin=True),
    Rule("repeated_lines", "dup_line_ratio", high=0.4),
    Rule("ellipsis_lines", "ellipsis_line_ratio", high=0.3),
    Rule("bullet_lines", "bullet_line_ratio", high=0.9),
)

# Everything but letters and marks of scripts other than Latin.
OTHER_THAN_FOREIGN = rf"[\x00-\x{{{LATIN_LETTERS:X}}}]+|[^\p{{L}}\p{{M}}]+"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often and wherever the result is inlined."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(w: Column) -> Column:
    """Words in 3-word windows found twice or more.

    Windows are hashed to 64 bits, sorted with their positions, and equal neighbours give the starts
    of repeated windows. The words these cover are counted from the gaps between starts.
    """
    windows = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
    )
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    starts = lambda z: F.sort_array(F.transform(
        F.filter(z, lambda x, i: same(x, F.get(z, i + 1)) | same(x, F.get(z, i - 1))), lambda x: x["i"]
    ))
    covered = lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x
    )
    placed = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    counted = lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), let(placed(h), lambda z: let(starts(z), covered))
    ).otherwise(F.lit(0))
    return let(windows, counted)


def measured(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Every measure of a text and the verdict, as one struct."""
    line_has = lambda lines, pattern: F.size(F.filter(lines, lambda x: x.rlike(pattern))).cast("long")

    def counts(body: Column, w: Column, lines: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(body, BLANKS, "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.length(F.regexp_replace(body, OTHER_THAN_FOREIGN, "")).cast("long").alias("n_foreign"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop"),
            line_has(lines, r"(\.\.\.|…)[\x20\x09-\x0D]*$").alias("n_ellipsis"),
            line_has(lines, r"^[\x20\x09-\x0D]*[-•*]").alias("n_bullet"),
        )

    def ratios(c: Column) -> Column:
        return F.struct(
            *[c[n].alias(n) for n in (*COUNTS, "n_lines", "n_stop", "n_ellipsis", "n_bullet", "n_foreign")],
            _ratio(c["word_chars"], c["n_words"]).alias("mean_word_chars"),
            _ratio(c["n_symbols"], c["n_words"]).alias("symbol_ratio"),
            _ratio(c["n_foreign"], c["word_chars"]).alias("foreign_ratio"),
            _ratio(c["n_stop"], c["n_words"]).alias("stop_ratio"),
            _ratio(c["n_dup_lines"], c["n_lines"]).alias("dup_line_ratio"),
            _ratio(c["n_ellipsis"], c["n_lines"]).alias("ellipsis_line_ratio"),
            _ratio(c["n_bullet"], c["n_lines"]).alias("bullet_line_ratio"),
        )

    def verdict(m: Column) -> Column:
        failed = (m["n_words"] < BASE_MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_MAX_REPEATED_PERCENT * m["n_words"])
        return let(broken(m, rules), lambda b: F.struct(
            *[m[n].alias(n) for n in MEASURES], failed.alias("base_failed"), b.alias("broken"), (~failed & (F.size(b) == 0)).alias("kept")
        ))

    split = lambda body: F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    both = lambda body: let(words(body), lambda w: let(split(body), lambda lines: counts(body, w, lines)))
    return let(let(let(F.coalesce(text, F.lit("")), both), ratios), verdict)


MEASURES = (
    *COUNTS, "n_lines", "n_stop", "n_ellipsis", "n_bullet", "n_foreign", "foreign_ratio",
    "mean_word_chars", "symbol_ratio", "stop_ratio", "dup_line_ratio", "ellipsis_line_ratio", "bullet_line_ratio",
)


def broken(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that the measures ``m`` break, in table order."""
    checks = []
    for r in rules:
        binds = m["foreign_ratio"] <= 0.5 if r.latin else F.lit(True)
        if r.low is not None:
            checks.append(F.when(binds & (m[r.measure] < r.low), F.lit(r.name)))
        if r.high is not None:
            checks.append(F.when(binds & (m[r.measure] > r.high), F.lit(r.name)))
    return F.array_distinct(F.array_compact(F.array(*checks))) if checks else F.array().cast("array<string>")


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: id, counts, ratios, ``base_failed``, ``broken`` and ``kept``."""
    return docs.select(docs[doc_id].alias("doc_id"), measured(docs[text], rules).alias("m")).select("doc_id", "m.*")


def filter_quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return docs.filter(measured(docs[text], rules)["kept"])


def sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same counts and verdict for DuckDB, generated from the same table."""
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    free = lambda r: "foreign_ratio > 0.5 OR " if r.latin else ""
    bounds = [f"({free(r)}{r.measure} >= {r.low})" for r in rules if r.low is not None]
    bounds += [f"({free(r)}{r.measure} <= {r.high})" for r in rules if r.high is not None]
    return rf"""
    WITH t AS (
      SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS body,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM documents),
    pos AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM t),
    win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS times FROM pos),
    cover AS (SELECT DISTINCT rid, i + unnest([0, 1, 2]) AS j FROM win WHERE times > 1),
    rep AS (SELECT rid, count(*) AS n FROM cover GROUP BY rid),
    c AS (
      SELECT t.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             length(regexp_replace(body, '{OTHER_THAN_FOREIGN}', '', 'g')) AS n_foreign,
             CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop,
             len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis,
             len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-•*]'))) AS n_bullet,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM t LEFT JOIN rep ON t.rid = rep.rid),
    m AS (
      SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS mean_word_chars,
             CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbol_ratio,
             CASE WHEN word_chars > 0 THEN n_foreign / word_chars ELSE 0.0 END AS foreign_ratio,
             CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0.0 END AS stop_ratio,
             CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_ratio,
             CASE WHEN n_lines > 0 THEN n_ellipsis / n_lines ELSE 0.0 END AS ellipsis_line_ratio,
             CASE WHEN n_lines > 0 THEN n_bullet / n_lines ELSE 0.0 END AS bullet_line_ratio,
             n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_MAX_REPEATED_PERCENT} * n_words AS base_failed
      FROM c)
    SELECT doc_id, {", ".join(COUNTS)}, base_failed, NOT base_failed AND {" AND ".join(bounds)} AS kept FROM m
    """
