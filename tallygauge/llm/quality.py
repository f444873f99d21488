"""Line-first quality rules, as DataFrame expressions only.

Every line is judged on its own: its punctuation, whether it is navigation, whether it is
boilerplate. Failing lines are removed; a document that loses too many of its words is rejected.
Before that a base filter looks at the whole text: its length and the words inside repeated
three-word windows.

Nothing is exploded and nothing is shuffled: a document is one row from start to end, and work on
its words is arrays within that row. Windows are compared by 64-bit hashes of their words.

Defined results: a null or wordless text has no words and no lines, fails the base filter and is
not kept. Lines without a word are never counted and never removed. Rows are judged one by one, so
repeated rows get equal results; other columns of the table are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygauge.llm.storage import documents_only

#: Fewer words than this fail a document.
LEAST_WORDS = 50
#: The highest share of words, in percent, that may lie in repeated windows.
MOST_REPEATED = 50
#: The least share of words that must be left after cleaning.
LEAST_LEFT = 0.5
#: A line of at least so many words must end a sentence.
SENTENCE_WORDS = 8
#: The highest number of symbols per word of a line.
MOST_SYMBOLS = 0.3

#: Up to so many different repeated windows are looked up one by one; more are found by a sort.
FEW_REPEATS = 64

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|›»•·→"
MOST_SEPARATORS = 2
WORD = "[^ \\t-\\r]"
MANY_WORDS = f"^[ \\t-\\r]*({WORD}+[ \\t-\\r]+){{{SENTENCE_WORDS - 1}}}{WORD}"
SENTENCE_END = "[.!?:;…。！？][\"'”’»)\\]]*([ \\t-\\r]|$)"
NAVIGATION = (
    "(?i)^[ \\t-\\r]*(home|menu|log ?in|log ?out|sign ?in|sign ?up|register|subscribe|search|next|previous|"
    "back to top|skip to content|read more|share this|contact us|about us|site ?map)[ \\t-\\r]*[.!:]?[ \\t-\\r]*$"
)
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "use cookies",
    "uses cookies",
    "accept cookies",
    "enable javascript",
    "javascript is disabled",
    "click here",
    "lorem ipsum",
    "licensed under",
    "released under the",
    "subscribe to our",
    "copyright ©",
    "copyright (c)",
)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(text, "[\\t-\\r]", " "), " "), "")


def count_of(text: Column, characters: str) -> Column:
    """How often any of the characters is there."""
    return (F.size(F.split(text, f"[{characters}]", -1)) - 1).cast("bigint")


def windows_of(words: Column) -> Column:
    """A hash per three-word window, in order."""

    def hashed(w: Column) -> Column:
        last = F.size(w) - 2
        window = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.xxhash64(w[i], F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(last > 0, window).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashed)


def words_in_repeats(windows: Column) -> Column:
    """How many words lie in a window that is there twice or more."""

    def repeated_values(h: Column) -> Column:
        again = lambda s: F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1) == x, F.lit(False)))
        return F.array_distinct(let(F.sort_array(h), again))

    def looked_up(h: Column, values: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(values, h[i]))

    def sorted_out(h: Column) -> Column:
        def starts(s: Column) -> Column:
            near = lambda x, i, step: F.coalesce(F.get(s, i + step)["h"] == x["h"], F.lit(False))
            again = F.transform(s, lambda x, i: F.when(near(x, i, -1) | near(x, i, 1), x["i"]))
            return F.sort_array(F.filter(again, lambda i: i.isNotNull()))

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), starts)

    def repeated_starts(h: Column) -> Column:
        either = lambda v: F.when(F.size(v) <= FEW_REPEATS, looked_up(h, v)).otherwise(sorted_out(h))
        return let(repeated_values(h), either)

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
        add = lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"))
        return F.aggregate(at, start, add, lambda a: a["n"])

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(repeated_starts(h))).otherwise(F.lit(0).cast("bigint"))

    return let(windows, count)


def lines_of(text: Column) -> Column:
    """The lines with a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def cleaned_lines(lines: Column, text: Column) -> Column:
    """The lines that break none of the rules.

    Whether a rule's characters or phrases are in ``text`` at all is asked once per document.
    """
    either = lambda low: reduce(Column.__or__, [F.contains(low, F.lit(p)) for p in BOILERPLATE])
    phrase = lambda own: let(F.lower(own), either)
    asked = F.struct(
        lines.alias("lines"),
        (count_of(text, SYMBOLS) > 0).alias("symbols"),
        (count_of(text, SEPARATORS) > MOST_SEPARATORS).alias("separators"),
        phrase(text).alias("phrases"),
    )

    def clean(d: Column) -> Column:
        def fails(line: Column) -> Column:
            symbols = count_of(line, SYMBOLS) > MOST_SYMBOLS * F.size(words_of(line))
            unfinished = ~line.rlike(SENTENCE_END) & line.rlike(MANY_WORDS)
            navigation = line.rlike(NAVIGATION) | (d["separators"] & (count_of(line, SEPARATORS) > MOST_SEPARATORS))
            return unfinished | (d["symbols"] & symbols) | navigation | (d["phrases"] & phrase(line))

        return F.filter(d["lines"], lambda line: ~fails(line))

    return let(asked, clean)


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``cleaned`` (the text of the lines that stay) and the figures of the rules."""
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    arrays = docs.withColumns({"words": words_of(own), "lines": lines_of(own)})
    figures = arrays.withColumns(
        {
            "n_words": F.size("words").cast("bigint"),
            "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
            "n_symbols": count_of(own, SYMBOLS),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
            "n_repeat_words": words_in_repeats(windows_of(F.col("words"))),
            "stay": cleaned_lines(F.col("lines"), own),
        }
    )
    n_words = F.col("n_words")
    left = F.when(F.size("stay") == F.size("lines"), n_words).otherwise(F.size(words_of(F.array_join("stay", "\n"))))
    base_failed = (n_words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n_words)
    return (
        figures.withColumns(
            {"n_words_left": left.cast("bigint"), "base_failed": base_failed, "cleaned": F.array_join("stay", "\n")}
        )
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_words_left") >= LEAST_LEFT * n_words))
        .drop("words", "lines", "stay")
    )


def quality(docs: DataFrame) -> DataFrame:
    return judged(documents_only(docs)).drop("text", "cleaned")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the failing lines removed from their texts."""
    figures = judged(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("own")), "own")
    passed = figures.where("kept").select("row.*", F.col("cleaned").alias("__cleaned"))
    return passed.withColumn("text", F.col("__cleaned")).select(docs.columns)


WORDS_SQL = "[^\\x20\\x09-\\x0D]+"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def count_sql(text: str, characters: str) -> str:
    return f"len(regexp_extract_all({text}, {sql_text(f'[{characters}]')}))"


PHRASES_SQL = " OR ".join(f"contains(lower(line), {sql_text(p)})" for p in BOILERPLATE)
SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORDS_SQL}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORDS_SQL}')) AS lines
  FROM documents
), positions AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM positions
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY doc_id
), every_line AS (
  SELECT doc_id, unnest(lines) AS line FROM d
), judged AS (
  SELECT doc_id, len(regexp_extract_all(line, '{WORDS_SQL}')) AS n_words,
         NOT regexp_matches(line, {sql_text(SENTENCE_END)}) AND regexp_matches(line, '{MANY_WORDS}')
         OR {count_sql("line", SYMBOLS)} > {MOST_SYMBOLS}::DOUBLE * len(regexp_extract_all(line, '{WORDS_SQL}'))
         OR {count_sql("line", SEPARATORS)} > {MOST_SEPARATORS}
         OR regexp_matches(line, {sql_text(NAVIGATION)}) OR {PHRASES_SQL} AS fails
  FROM every_line
), remaining AS (
  SELECT doc_id, sum(n_words) AS n FROM judged WHERE NOT fails GROUP BY doc_id
), figures AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST({count_sql("text", SYMBOLS)} AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(l.n, 0) AS BIGINT) AS n_words_left,
         len(words) < {LEAST_WORDS} OR 100 * coalesce(r.n, 0) > {MOST_REPEATED} * len(words) AS base_failed
  FROM d LEFT JOIN repeats r USING (doc_id) LEFT JOIN remaining l USING (doc_id)
)
SELECT *, NOT base_failed AND n_words_left >= {LEAST_LEFT}::DOUBLE * n_words AS kept FROM figures
"""
