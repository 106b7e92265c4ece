"""Quality rules, line first: bad lines go, then documents that lost too much text.

Each line with a word is judged alone: punctuation (too many signs, too few letters), navigation
(menu separators between short entries) and boilerplate (fixed phrases). A document is kept if it
passes the base rules, has a word left and its failed lines hold at most ``max_lost`` of its word
characters.

DataFrame functions only, all inside one row: no shuffle at any size. Repeated three-word windows
are found by sorting a (hash, position) per window, O(n log n) in the words of a text.

Defined results: null text has no word, counts as zero everywhere, fails the base rules and is not
kept. One output row per input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaystats.llm.text import BLANKS, BLANKS_PATTERN, let, pick

SYMBOLS = "#*$%&|<>"

# Signs that separate the entries of a menu, and phrases of page furniture.
SEPARATORS = "|>»›•·"
BOILERPLATE = (
    "all rights reserved",
    "accept all cookies",
    "we use cookies",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "click here",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "enable javascript",
    "lorem ipsum",
    "back to top",
    "share this article",
    "skip to content",
)


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS_PATTERN), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the array."""

    def windows(w: Column) -> Column:
        def pack(i: Column) -> Column:
            h = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            return F.struct(h.alias("h"), i.alias("i"))

        packed = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), pack))
        return let(packed, covered)

    def covered(s: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(s, i - 1)["h"] == x["h"], F.lit(False)
            )

        places = F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"].cast("long")))
        # A window covers three words, or as many as lie before the next one.
        return let(
            places,
            lambda p: F.aggregate(
                F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, n: F.least(F.coalesce(n - a, F.lit(3)), F.lit(3))),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    return let(words, lambda w: F.when(F.size(w) >= 3, windows(w)).otherwise(F.lit(0).cast("long")))


def line_fails(line: Column) -> Column:
    """Whether one line, bound by a lambda, breaks a rule."""
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    solid = F.length(F.translate(line, BLANKS, ""))
    menu = _count(line, SEPARATORS)
    words = F.size(_words(line))
    low = F.lower(line)
    phrase = F.lit(False)
    for text in BOILERPLATE:
        phrase = phrase | F.contains(low, F.lit(text))
    punctuation = letters * 2 < solid
    navigation = (menu >= 2) & (words < menu * 5)
    furniture = phrase & (words < 30)
    return punctuation | navigation | furniture


def rate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    max_repeat_pct: int = 50,
    max_lost: float = 0.3,
) -> DataFrame:
    """(id, text without failed lines, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_bad_lines, lost_chars, base_failed, kept) per input row."""
    docs = pick(docs, id_col, text_col).toDF("id", "raw")
    text = F.coalesce("raw", F.lit(""))
    with_word = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    numbers = let(
        text,
        lambda t: F.struct(
            (F.length(t) - _count(t, BLANKS)).cast("long").alias("word_chars"),
            _count(t, SYMBOLS).cast("long").alias("n_symbols"),
            let(
                _words(t),
                lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeats")),
            ).alias("words"),
        ),
    )

    def lines(all_lines: Column) -> Column:
        judged = F.transform(all_lines, lambda x: F.struct(x.alias("line"), line_fails(x).alias("bad")))
        return let(
            judged,
            lambda j: F.struct(
                (F.size(all_lines) - F.size(F.array_distinct(all_lines))).cast("long").alias("dups"),
                F.transform(F.filter(j, lambda x: ~x["bad"]), lambda x: x["line"]).alias("good"),
                F.size(F.filter(j, lambda x: x["bad"])).cast("long").alias("bad"),
                F.aggregate(
                    F.filter(j, lambda x: x["bad"]),
                    F.lit(0).cast("long"),
                    lambda total, x: total + F.length(F.translate(x["line"], BLANKS, "")),
                ).alias("lost"),
            ),
        )

    rated = docs.select("id", numbers.alias("n"), let(with_word, lines).alias("l"))
    failed = (F.col("n.words.n") < min_words) | (
        100 * F.col("n.words.repeats") > max_repeat_pct * F.col("n.words.n")
    )
    kept = ~failed & (F.size("l.good") > 0) & (F.col("l.lost") <= max_lost * F.col("n.word_chars"))
    return rated.select(
        F.col("id").alias(id_col),
        F.array_join("l.good", "\n").alias(text_col),
        F.col("n.words.n").alias("n_words"),
        F.col("n.word_chars").alias("word_chars"),
        F.col("n.n_symbols").alias("n_symbols"),
        F.col("l.dups").alias("n_dup_lines"),
        F.col("n.words.repeats").alias("n_repeat_words"),
        F.col("l.bad").alias("n_bad_lines"),
        F.col("l.lost").alias("lost_chars"),
        failed.alias("base_failed"),
        kept.alias("kept"),
    )
