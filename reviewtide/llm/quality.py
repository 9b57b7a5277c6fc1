"""Line-first quality rules.

Every line is judged by itself: by its punctuation, as navigation, as boilerplate.
Failing lines go, and a document that loses too much of its text that way is rejected,
as is one that fails the base rules (too few words, too many repeated ones). All of it
is one projection over the documents; nothing is shuffled.

Null and empty texts have no words and are rejected for being short. Repeated rows are
judged each by itself. Other columns pass through; the added ones are named by
``COLUMNS`` and replace columns of those names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewtide.llm.common import free, let, packed, text_or_empty, total, without_spaces, words_of

# The symbols that the base statistics count.
SYMBOLS = "#*$%&|<>"
# Marks that separate the entries of a menu.
SEPARATORS = "|•»›→"
# Phrases of pages that are not prose.
BOILERPLATE = (
    "enable javascript",
    "javascript is disabled",
    "accept cookies",
    "cookie policy",
    "use of cookies",
    "privacy policy",
    "terms of service",
    "terms of use",
    "subscribe to our newsletter",
    "click here to",
    "skip to content",
    "lorem ipsum",
)
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "n_failed_lines", "lost_chars", "clean_text", "kept")
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """Limits of the rules. Percentages are of words, but ``max_lost`` of characters in words."""

    min_words: int = 10
    max_repeated: int = 20
    min_separated: int = 20  # a line of navigation has so many separators, and at least two
    min_noisy: int = 25  # noisy words: with two symbols, or two marks of emphasis, in a row
    max_boilerplate_words: int = 30
    max_lost: int = 30


def repeated_words(words: Column) -> Column:
    """Words inside windows of five that occur twice or more.

    Hashes tell at little cost that nothing repeats. Where some do, the windows are
    sorted by hash and text, so that equal ones are neighbours, and texts decide.
    """

    def hashed(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - WINDOW)
        return F.transform(at, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))

    def covered(w: Column, hashes: Column) -> Column:
        windows = F.sort_array(
            F.transform(
                hashes,
                lambda h, i: F.struct(
                    h.alias("h"),
                    F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("words"),
                    i.alias("at"),
                ),
            )
        )
        return let(windows, repeated_at)

    def repeated_at(windows: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            return F.coalesce((x["h"] == y["h"]) & (x["words"] == y["words"]), F.lit(False))

        at = F.transform(
            windows,
            lambda x, i: F.when(
                same(x, F.get(windows, i - 1)) | same(x, F.get(windows, i + 1)), x["at"]
            ),
        )
        starts = F.sort_array(F.filter(at, lambda i: i.isNotNull()))
        return let(
            starts,
            lambda s: total(
                F.transform(
                    s, lambda x, i: F.coalesce(F.least(F.get(s, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))
                )
            ),
        )

    def counted(w: Column, hashes: Column) -> Column:
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, covered(w, hashes)).otherwise(F.lit(0).cast("bigint"))

    none = F.lit(0).cast("bigint")
    return F.when(F.size(words) < WINDOW, none).otherwise(
        let(hashed(words), lambda hashes: counted(words, hashes))
    )


def duplicate_lines(text: Column) -> Column:
    with_words = F.filter(F.split(text, "\n"), lambda line: without_spaces(line) != "")
    return let(with_words, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def count_of(line: Column, characters: str) -> Column:
    return F.length(line) - F.length(F.translate(line, characters, ""))


def line_fails(line: Column, rules: Rules) -> Column:
    """Whether a line breaks the rule on punctuation, on navigation or on boilerplate."""
    words = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    noisy = F.regexp_count(line, F.lit(r"[#*$%&<>]{2,}|[!?]{2,}"))
    separators = count_of(line, SEPARATORS)
    phrase = F.lower(line).rlike("|".join(BOILERPLATE))
    return let(
        words,
        lambda n: ((noisy >= 2) & (100 * noisy >= rules.min_noisy * n))
        | ((separators >= 2) & (100 * separators >= rules.min_separated * n))
        | ((n <= rules.max_boilerplate_words) & phrase),
    )


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents with the columns named by ``COLUMNS``; no row is removed."""
    text = text_or_empty()
    others = [F.col(f"`{c}`") for c in docs.columns if c not in COLUMNS]
    lines = F.split(text, "\n")
    own_words, own_lines, all_lines = free(docs, "_words", "_lines", "_n_lines")
    judged = docs.select(
        *others,
        F.length(without_spaces(text)).cast("bigint").alias("word_chars"),
        count_of(text, SYMBOLS).cast("bigint").alias("n_symbols"),
        duplicate_lines(text).cast("bigint").alias("n_dup_lines"),
        let(
            words_of(text),
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("repeated")
            ),
        ).alias(own_words),
        F.filter(lines, lambda line: ~line_fails(line, rules)).alias(own_lines),
        F.size(lines).alias(all_lines),
    )
    names = [c for c in docs.columns if c not in COLUMNS]
    counted = judged.select(
        *(F.col(f"`{c}`") for c in names),
        F.col(f"{own_words}.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.col(f"{own_words}.repeated").alias("n_repeat_words"),
        F.array_join(own_lines, "\n").alias("clean_text"),
        (F.col(all_lines) - F.size(own_lines)).cast("bigint").alias("n_failed_lines"),
    )
    base_failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeated * F.col("n_words")
    )
    lost = F.when(F.col("n_failed_lines") == 0, F.lit(0)).otherwise(
        F.col("word_chars") - F.length(without_spaces(F.col("clean_text")))
    )
    verdict = counted.withColumn("base_failed", base_failed).withColumn(
        "lost_chars", lost.cast("bigint")
    )
    kept = ~F.col("base_failed") & (
        100 * F.col("lost_chars") <= rules.max_lost * F.col("word_chars")
    )
    return verdict.withColumn("kept", kept).select(*(f"`{c}`" for c in names), *COLUMNS)


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The kept documents without their failing lines, in the columns of ``docs``.

    ``n_chars``, where there is such a column, follows the text.
    """
    needed = [c for c in ("text", "n_chars") if c in docs.columns]
    whole, back = packed(docs, *needed)
    kept = judge(whole, rules).filter("kept")
    changed = F.col("n_failed_lines") > 0
    text = F.when(changed, F.col("clean_text")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.when(changed, F.length("clean_text")).otherwise(F.col("n_chars"))}
    kinds = dict(docs.dtypes)
    return kept.select(
        *(new[c].cast(kinds[c]).alias(c) if c in needed else column for c, column in zip(docs.columns, back))
    )
