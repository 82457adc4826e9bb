"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` holds one row per rule: the measure, its lowest and highest accepted
value, and the word count from which the rule speaks. ``judge`` turns the table
into boolean columns over the measures, all of them built-in expressions over
the row's own text: no shuffle, no user function. Repeated 8-word windows are
found per row: a window is the hash of eight word hashes; a row whose windows
are all distinct (array_distinct) is done, the others sort (hash, place) pairs
and count the places that a repeated window covers.

Measures: length (words, mean word length), symbols per word, share of words
that hold a letter, share of capitals, share of words ending in "!", share of
stop words, share of repeated lines, share of lines ending in an ellipsis,
share of distinct words.

Edge cases: NULL and empty texts have 0 words and fail the base rule; every
ratio over nothing is NULL and its rule passes; rows repeat as they come;
columns beyond doc_id and text are ignored. Windows are compared by 64-bit
hashes (two different windows of one text agree with odds under n^2 / 2^64).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, SPACE, let, text_of

WINDOW = 8
# The base rule.
LEAST_WORDS, MOST_REPEATED_PCT = 20, 30
SYMBOLS = "[#*$%&|<>]"
# Function words of the corpus languages (en, de, fr, es).
STOP_WORDS = ("a an and are as at be by for from have he his in is it of on or that the this to was were with "
              "als auch auf das dem den der des die ein eine es für im ist mit nicht sich sie und von zu "
              "au avec ce dans de du elle en est et il la le les ne par pas pour que qui sur un une "
              "al como con del el las lo los más no para por se su una y").split()
MARKS = r"[^\p{L}\x20\x09-\x0D]+"
BARE_WORD = r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]++(?=[\x20\x09-\x0D]|$)"
# measure, lowest, highest, from how many words on
RULES = (
    ("mean_word_len", 2.0, 14.0, 20),
    ("symbols_per_word", None, 0.2, 0),
    ("letter_word_share", 0.7, None, 20),
    ("capital_share", None, 0.5, 20),
    ("shout_share", None, 0.3, 20),
    ("stop_word_share", 0.04, None, 50),
    ("dup_line_share", None, 0.5, 0),
    ("ellipsis_line_share", None, 0.5, 20),
    ("distinct_word_share", 0.15, None, 50),
)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def repeat_words(words: Column) -> Column:
    """Words of ``words`` inside 8-word windows that occur twice or more."""
    def covered(windows: Column) -> Column:
        def places(pairs: Column) -> Column:
            twin = F.filter(pairs, lambda p, i: F.get(pairs, i - 1)["h"].eqNullSafe(p["h"])
                            | F.get(pairs, i + 1)["h"].eqNullSafe(p["h"]))
            return F.sort_array(F.transform(twin, lambda p: p["at"]))
        spans = let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))), places)
        total = let(spans, lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
            F.lit(0), lambda a, b: a + b))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(total)
    # hashes of 1, 2, 4 and then 8 neighbouring words: each pass joins the array with itself, moved
    def doubled(h: Column, by: int) -> Column:
        return let(h, lambda a: F.zip_with(a, F.slice(a, by + 1, F.size(a)), lambda x, y: F.xxhash64(x, y)))
    h = F.transform(words, lambda w: F.xxhash64(w))
    for by in (1, 2, 4):
        h = doubled(h, by)
    windows = F.slice(h, 1, F.size(words) - (WINDOW - 1))      # the last ones reach past the end
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(windows, covered))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and every measure of the threshold table."""
    t = docs.select("doc_id", text_of().alias("t"))
    t = t.select("doc_id", "t", F.btrim("t", F.lit(BLANKS)).alias("inner"))
    bare = F.regexp_replace(F.lower("inner"), MARKS, "")
    t = t.select("doc_id", "t", "inner", bare.alias("bare"), F.when(F.col("inner") == "", F.array().cast("array<string>")).otherwise(F.split("inner", SPACE)).alias("words"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    t = t.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.length(F.regexp_replace("t", r"\P{L}+", "")).alias("n_letters"), F.length(F.regexp_replace("t", r"\P{Lu}+", "")).alias("n_capitals"),
        F.regexp_count("inner", F.lit(BARE_WORD)).alias("n_bare_words"),
        F.size(F.filter("words", lambda w: w.endswith("!"))).alias("n_shouted"),
        F.size(F.filter(F.split("bare", SPACE), lambda w: w.isin(*sorted(set(STOP_WORDS))))).alias("n_stop"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).alias("n_ellipsis"),
        F.size(F.array_distinct("words")).alias("n_distinct"))
    n = F.col("n_words")
    return t.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _share(F.col("word_chars"), n).alias("mean_word_len"), _share(F.col("n_symbols"), n).alias("symbols_per_word"),
        _share(n - F.col("n_bare_words"), n).alias("letter_word_share"),
        _share(F.col("n_capitals"), F.col("n_letters")).alias("capital_share"),
        _share(F.col("n_shouted"), n).alias("shout_share"), _share(F.col("n_stop"), n).alias("stop_word_share"),
        _share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_share"),
        _share(F.col("n_ellipsis"), F.col("n_lines")).alias("ellipsis_line_share"),
        _share(F.col("n_distinct"), n).alias("distinct_word_share"))


def judge(measured: DataFrame, rules=RULES) -> DataFrame:
    """The measures plus base_failed, kept and ``failed``, the names of the
    rules that a text breaks."""
    base = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PCT)

    def broken(rule) -> Column:
        name, low, high, least = rule
        m = F.col(name)
        out = reduce(lambda a, b: a | b, [c for c in (None if low is None else m < low, None if high is None else m > high) if c is not None])
        return F.when((F.col("n_words") >= least) & out, F.lit(name))
    failed = F.array_compact(F.array(*[broken(r) for r in rules]))
    return (measured.withColumn("base_failed", base).withColumn("failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))


def quality(docs: DataFrame, rules=RULES) -> DataFrame:
    return judge(measures(docs), rules)
