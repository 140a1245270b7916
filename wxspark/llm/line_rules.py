"""Line-first cleaning, then a verdict on the document; built-in functions only.

Each line is judged on its own: navigation (several bars, or little but links and bullets), symbols in place
of letters, shouting, one word over and over, boilerplate phrases in short lines, and short lines without closing
punctuation. Failing lines are removed; a document that loses more than MOST_LOST of its words with them is
rejected, as is one that fails the base rules on words and repeats.

Lines and texts of any length are judged whole, in time proportional to them. Null texts have no words, fail the base rules and are not kept; so are empty ones. Repeated rows are judged one
by one; other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words, and the symbols that are counted.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
#: Base rules.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Line rules, as patterns of failing lines. A bar with blanks about it divides entries of a menu.
#: None of the patterns repeats a group or tries a line more than once from each place, so that a line of any length
#: takes time in proportion to it.
NAVIGATION = r" [|»›·] .* [|»›·] |^[\s|»›·•>-]+$"
SMALL_LETTER, TWO_CAPITALS = r"\p{Ll}", r"\p{Lu}\P{Lu}*\p{Lu}"
SHOUTED = r"\p{Lu}!!"
BOILERPLATE = (
    r"(?i)(?<![0-9A-Za-z_])(all rights reserved|terms of (use|service)|privacy policy|cookie policy|click here|sign in|log in|"
    r"subscribe to|enable javascript|skip to (main )?content|powered by|back to top)"
    r"(?![0-9A-Za-z_])"
)
CLOSED = r"[.!?:;\"'”’)…。！？]\s*$"
#: A line of at most so many words is short; symbols may be this share of a line's characters, percent.
SHORT, MOST_SYMBOLS = 8, 5
#: Percent of its words that a kept document may lose.
MOST_LOST = 20


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK + "+"))


def _fails(line: Column, words: Column) -> Column:
    """Whether a line, whose words are given, is to be removed. What tells most lines apart soonest is asked first."""
    short = F.size(words) <= SHORT
    symbols = F.char_length(line) - F.char_length(F.regexp_replace(line, SYMBOL, ""))
    return (
        line.rlike(NAVIGATION)
        | (100 * symbols > MOST_SYMBOLS * F.char_length(line))
        | (~line.rlike(SMALL_LETTER) & ~short & line.rlike(TWO_CAPITALS))
        | line.rlike(SHOUTED)
        | _repeats(words)
        | (short & line.rlike(BOILERPLATE))
        | (short & ~line.rlike(CLOSED))
    )


def _repeats(words: Column) -> Column:
    """Few different words for the length of the line."""
    return (F.size(words) >= 10) & (3 * F.size(F.array_distinct(words)) < F.size(words))


def cleaned(docs: DataFrame) -> DataFrame:
    """doc_id, the base columns, base_failed, cleaned text, n_lines, n_lines_removed, n_words_lost and kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK))
    base = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        _words(F.col("text")).alias("words"),
        F.char_length(F.regexp_replace("text", BLANK + "+", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", SYMBOL, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    # The three-word windows by hash. Only where a hash occurs twice are they sorted with their places.
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    counted = base.select(
        "doc_id", "word_chars", "n_symbols", "lines", F.size("words").cast("long").alias("n_words"), windows.alias("windows")
    )
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = counted.select(
        "doc_id", "word_chars", "n_symbols", "lines", "n_words",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).otherwise(none).alias("placed"),
    )
    twice = F.filter(
        "placed",
        lambda x, i: (F.get("placed", i - 1)["h"] == x["h"]) | F.coalesce(F.get("placed", i + 1)["h"] == x["h"], F.lit(False)),
    )
    starts = repeated.select(
        "doc_id", "word_chars", "n_symbols", "lines", "n_words",
        F.array_sort(F.transform(twice, lambda x: x["i"])).alias("starts"),
    )
    covered = F.aggregate(
        F.transform("starts", lambda s, k: F.least(F.lit(3), F.coalesce(F.get("starts", k + 1) - s, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, step: total + step,
    )
    judged = starts.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.filter(
            F.transform("lines", lambda line: F.struct(line.alias("line"), _words(line).alias("words"))),
            lambda x: ~_fails(x["line"], x["words"]),
        ).alias("good"),
    )
    return (
        judged.withColumn(
            "n_words_lost",
            F.col("n_words") - F.aggregate("good", F.lit(0).cast("long"), lambda total, x: total + F.size(x["words"])),
        )
        .withColumn("n_lines_removed", F.col("n_lines") - F.size("good"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        )
        .withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_words_lost") <= MOST_LOST * F.col("n_words")))
        .withColumn("text", F.array_join(F.transform("good", lambda x: x["line"]), "\n"))
        .drop("good")
    )


def rule_table(docs: DataFrame) -> DataFrame:
    """The figures and the verdict without the text."""
    return cleaned(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "n_words_lost",
    )
