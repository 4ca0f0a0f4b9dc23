"""Line-first cleaning: rules per line, then a verdict on what is left.

A line fails by punctuation (mark characters or doubled end marks on many of
its words), by navigation (many separators) or by boilerplate (a licence,
rights, cookie or site phrase in a short line).  Failing lines go; a document
that loses more than ``max_lost`` of its words is rejected.

DataFrame and SQL functions only.  Windows of words are compared by 64-bit
hash inside one text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_LOST_PCT = 50
# A line's words: the share with marks from which it fails, the share of separators from which it is navigation.
MARKED_PCT = 30
SEPARATOR_PCT = 20
MIN_SEPARATORS = 3
BOILERPLATE_WORDS = 25

MARKED_WORD = r"[#*$%&<>]{2,}|[!?]{2,}\z|\A[#*$%&<>]+\z"
SEPARATORS = ["|", "»", "›", "•", "·", ">", "/"]
BOILERPLATE = (
    r"(?i)all rights reserved|released under the|licensed under|this work is licensed|©|\(c\) ?\d{4}|"
    r"terms (of (use|service)|and conditions)|privacy policy|cookie (policy|settings)|we use cookies|accept (all )?cookies|"
    r"sign (in|up)\b|log ?in\b|subscribe to|newsletter|click here|read more|skip to (main )?content|"
    r"share (this|on)|follow us|back to top|powered by|javascript|lorem ipsum"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN, -1))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that the text holds twice or more."""
    def of_hashes(hw: Column) -> Column:
        count = F.size(hw) - window + 1
        starts = F.sequence(F.lit(0), count - 1)
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(hw, i + k) for k in range(window)]))
        return F.when(count < 2, F.lit(0)).otherwise(let(windows, of_windows))

    def of_windows(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(
            F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at")))), of_sorted))

    def of_sorted(s: Column) -> Column:
        def position(x: Column, i: Column) -> Column:
            twin = (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
            return F.when(twin, x["at"])
        places = F.array_sort(F.filter(F.transform(s, position), lambda p: p.isNotNull()))
        start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(window), p - a["last"])).alias("n")),
            lambda a: a["n"])

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def line_verdict(line: Column) -> Column:
    """Of one line: its number of words and the rule that it fails (NULL: none)."""
    def of_words(words: Column) -> Column:
        n = F.size(words)
        marked = F.size(F.filter(words, lambda w: w.rlike(MARKED_WORD)))
        bars = F.size(F.filter(words, lambda w: w.isin(SEPARATORS)))
        rule = (F.when(n == 0, F.lit(None))
                .when((bars >= MIN_SEPARATORS) & (100 * bars >= SEPARATOR_PCT * n), "navigation")
                .when(100 * marked >= MARKED_PCT * n, "punctuation")
                .when((n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE), "boilerplate"))
        return F.struct(n.alias("n"), rule.alias("rule"), line.alias("line"))

    return let(words_of(line), of_words)


def clean_lines(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
                max_lost_pct: int = MAX_LOST_PCT) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per input row: ``doc`` (the input row as a struct),
    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``,
    ``n_lines_failed, n_words_lost, kept`` and ``clean_text`` (the lines that pass, joined by a newline).

    A NULL text counts as empty and has a NULL ``clean_text``; a text with
    fewer than ``min_words`` words fails; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    lines = F.split(text, "\n", -1)
    worded = F.filter(lines, lambda x: F.btrim(x, F.lit(WHITE)) != "")
    total_length = lambda ws: F.aggregate(ws, F.lit(0), lambda a, w: a + F.length(w))
    base = docs.select(F.struct("*").alias("doc")).select(
        "doc",
        let(words_of(text), lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"), total_length(ws).cast("long").alias("word_chars"),
            repeated_words(ws).cast("long").alias("n_repeat_words"))).alias("w"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(worded, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        F.transform(lines, line_verdict).alias("verdicts"))
    failed = F.filter("verdicts", lambda v: v["rule"].isNotNull())
    left = F.filter("verdicts", lambda v: v["rule"].isNull())
    return (base.select(
        "doc", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words",
        F.size(failed).cast("long").alias("n_lines_failed"),
        F.aggregate(failed, F.lit(0), lambda a, v: a + v["n"]).cast("long").alias("n_words_lost"),
        F.when(F.col("doc.text").isNotNull(), F.array_join(F.transform(left, lambda v: v["line"]), "\n")).alias("clean_text"))
        .withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_words_lost") <= max_lost_pct * F.col("n_words"))))
