"""Quality statistics of whole texts, in DataFrame functions only (see ``outliers`` for the verdict)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of 8 words found twice or more in the text, the first find included."""
    def covered(hashes):
        # (hash, place) in order of the hash: a repeated window has an equal neighbour
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(pairs):
            def twin(p, k):
                before = F.get(pairs, k - 1).h
                after = F.get(pairs, k + 1).h
                return F.coalesce(before == p.h, F.lit(False)) | F.coalesce(after == p.h, F.lit(False))
            return F.sort_array(F.transform(F.filter(pairs, twin), lambda p: p.i))

        def length(at):
            return F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
                               F.lit(0), lambda a, b: a + b)

        return let(let(ordered, places), length)

    def of(w):
        def windows(hashes):
            return F.transform(F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
                               lambda i: F.xxhash64(F.slice(hashes, i, F.lit(WINDOW))))
        each = F.transform(w, lambda x: F.xxhash64(x))
        some = let(let(each, windows), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
        return F.when(F.size(w) <= WINDOW, 0).otherwise(some)

    return of(words)


def text_stats(docs: DataFrame, text="text", keep=()) -> DataFrame:
    """``keep`` columns with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (longs) of the whole text.

    A null text counts as empty: all statistics 0.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    tokens = F.filter(F.split(body, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")

    def numbers(w):
        return F.struct(F.size(w).alias("n"), repeated_words(w).alias("r"))

    counted = docs.select(
        *keep,
        F.char_length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        let(tokens, numbers).alias("__words"))
    return counted.select(*keep, F.col("__words.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
                          "n_dup_lines", F.col("__words.r").cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
