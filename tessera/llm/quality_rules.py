"""Quality rules, line first (native: SQL functions only).

Each line of a text is judged by itself -- symbols, navigation, shouting,
missing punctuation, boilerplate phrases. Lines that fail are removed; a
document that loses more than ``MAX_LOST_PCT`` percent of its line characters
is rejected. Base counts of the whole text (short, repetitive) reject as well.

Everything happens inside one row: no shuffle, no Python. A text's words are
bound once as a lambda variable (``_let``), otherwise the optimizer would
inline the split into every element of the higher-order functions.

Null text counts as empty: all counts 0, ``base_failed`` true (fewer than 20
words). Repeated rows are judged separately; other columns are ignored.

Lines and texts may be of any length; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

# Fixed values of the task.
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PCT = 30
SYMBOLS = "[#*$%&|<>]"

# Parameters of the line rules.
MAX_LOST_PCT = 60  # a short clean document may lose a long license line
MAX_SYMBOL_PCT = 5  # of a line's characters
MIN_NAV_BARS = 2  # separators that make a line a menu
MIN_PLAIN_WORDS = 8  # a line this long has some sentence punctuation
BOILERPLATE = [
    "all rights reserved",
    "click here",
    "cookie policy",
    "copyright",
    "enable javascript",
    "licensed under",
    "lorem ipsum",
    "privacy policy",
    "sign in",
    "subscribe to our",
    "terms of use",
]


def _either_case(phrase: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in phrase)


# The rules as patterns that mean the same to Java's and to RE2's engine.
HAS_WORD = WORD[:-1]
# Ends and pauses of sentences: Latin and Greek, Armenian, Hebrew, Arabic and Urdu, Syriac, Indic, Tibetan, Myanmar, Ethiopic,
# Khmer, Mongolian, Chinese and Japanese, full width, half width.
SENTENCE_MARK = "[.!?…,;:·։՝՞׃،؛؟۔܀।॥།༎၊။።፣፤፥፧។៕᠂᠃。、！，．：；？｡､]"
SHOUT = "!![ ].*!![ ].*!!"
UPPER_WORD = "[A-Z][A-Z]"
LOWER = "[a-z]"
BOILER = "|".join(_either_case(p) for p in BOILERPLATE)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _matches(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that match a one-character class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern + "+", ""))


def _repeated_words(words: Column, n: int = REPEAT_WINDOW) -> Column:
    """Words lying in an ``n``-word window that occurs twice or more."""

    def covered(hashes: Column) -> Column:
        def starts(ordered: Column) -> Column:
            def twin(e: Column, i: Column) -> Column:
                before = F.get(ordered, i - 1)["h"]
                after = F.get(ordered, i + 1)["h"]
                return F.coalesce(before == e["h"], F.lit(False)) | F.coalesce(
                    after == e["h"], F.lit(False)
                )

            return F.sort_array(F.transform(F.filter(ordered, twin), lambda e: e["p"]))

        def total(pos: Column) -> Column:
            reach = F.transform(
                pos, lambda p, i: F.least(F.lit(n), F.coalesce(F.get(pos, i + 1) - p, F.lit(n)))
            )
            return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

        ordered = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            _let(ordered, lambda o: _let(starts(o), total))
        )

    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n))
    )
    return F.when(F.size(words) >= n + 1, _let(windows, covered)).otherwise(F.lit(0).cast("long"))


def line_fails(line: Column) -> Column:
    """True for a line that is symbols, navigation, shouting, unpunctuated or boilerplate."""
    symbols = _matches(line, SYMBOLS)
    return (
        (symbols * 100 > F.length(line) * MAX_SYMBOL_PCT)
        | (_matches(line, "[|]") >= MIN_NAV_BARS)
        | line.rlike(SHOUT)
        | (line.rlike(UPPER_WORD) & ~line.rlike(LOWER) & (F.length(line) > 20))
        | (~line.rlike(SENTENCE_MARK) & (F.size(F.split(F.trim(line), "[ ]+")) >= MIN_PLAIN_WORDS))
        | line.rlike(BOILER)
    )


def line_clean(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> base counts, the cleaned text and the verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(HAS_WORD))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _repeated_words(w).alias("n_repeat_words"),
        )

    def judged(ls: Column) -> Column:
        good = F.filter(ls, lambda x: ~line_fails(x))
        size = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + F.length(x))
        return F.struct(
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            size(ls).alias("line_chars"),
            _let(good, lambda g: F.struct(size(g).alias("chars"), F.array_join(g, "\n").alias("text"))).alias("good"),
        )

    return (
        docs.select("doc_id", text.alias("text"))
        .select(
            "doc_id",
            _matches(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
            _let(words, counts).alias("w"),
            _let(lines, judged).alias("l"),
        )
        .select(
            "doc_id",
            "w.n_words",
            "w.word_chars",
            "n_symbols",
            "l.n_dup_lines",
            "w.n_repeat_words",
            (
                (F.col("w.n_words") < MIN_WORDS)
                | (F.col("w.n_repeat_words") * 100 > F.col("w.n_words") * MAX_REPEAT_PCT)
            ).alias("base_failed"),
            (F.col("l.line_chars") - F.col("l.good.chars")).alias("lost_chars"),
            F.col("l.line_chars").alias("line_chars"),
            F.col("l.good.text").alias("clean_text"),
        )
        .withColumn(
            "kept",
            ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("line_chars") * MAX_LOST_PCT),
        )
    )


# DuckDB SQL of the digest columns.
_SQL_FAILS = f"""
 (length(l) - length(regexp_replace(l, '{SYMBOLS}', '', 'g'))) * 100 > length(l) * {MAX_SYMBOL_PCT}
 OR length(l) - length(replace(l, '|', '')) >= {MIN_NAV_BARS}
 OR regexp_matches(l, '{SHOUT}')
 OR (regexp_matches(l, '{UPPER_WORD}') AND NOT regexp_matches(l, '{LOWER}') AND length(l) > 20)
 OR (NOT regexp_matches(l, '{SENTENCE_MARK}')
     AND len(string_split_regex(trim(l, ' '), '[ ]+')) >= {MIN_PLAIN_WORDS})
 OR regexp_matches(l, '{BOILER}')"""

ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{HAS_WORD}')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
    SELECT doc_id, i, array_to_string(w[i:i + {REPEAT_WINDOW - 1}], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {REPEAT_WINDOW - 2})) AS i FROM d))),
rep AS (
  SELECT doc_id, sum(least({REPEAT_WINDOW}, coalesce(nx - i, {REPEAT_WINDOW}))) AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM win WHERE c > 1)
  GROUP BY doc_id),
x AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    coalesce(list_sum(list_transform(ls, lambda l: length(l))), 0) AS all_chars,
    coalesce(list_sum(list_transform(list_filter(ls, lambda l: {_SQL_FAILS}), lambda l: length(l))), 0) AS lost
  FROM d LEFT JOIN rep USING (doc_id)),
y AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM x)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND lost * 100 <= all_chars * {MAX_LOST_PCT} AS kept
FROM y"""
