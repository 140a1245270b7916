"""Small inputs that hold the awkward cases."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use for their own columns
    "score double, node string, key string, words string, label int, band long, order long, tie long, size int, p string"
)
LONG = "word " * 40_000 + "Last line here."
#: Single lines that patterns could stumble over: rules, capitals with one small letter behind, no blanks at all.
LINES = ["-" * 100_000, "A" * 100_000 + "b", "x" * 100_000, "|" * 100_000 + ".", " | " * 30_000, "A " * 50_000, "." * 100_000 + " " * 1_000 + "x", "½²Ⅷ " * 20_000]


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", len(text or ""), 0.5, "n", "k", "w", 1, 1, 1, 1, 1, "p")


def awkward(spark):
    """Null, empty, blank, letterless, very long and repeated texts; null and repeated ids."""
    rows = [
        row(1, None), row(2, ""), row(3, " \n\t "), row(4, "123 456"), row(5, LONG), row(6, "One small text of words."),
        row(6, "One small text of words."), row(7, "Eins zwei drei vier fünf.", None), row(None, "No id at all here."),
        row(None, None, None), row(8, "One small text of words."), row(9, "É́ ÀB \x00 👩‍👧 don't"),
    ]
    rows += [row(100 + k, line) for k, line in enumerate(LINES)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
