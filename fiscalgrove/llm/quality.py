"""Quality rules whose thresholds adapt to each language and source.

Every document gets a few counts from its whole text. Mergeable quantile sketches of the ratios between them are
built per language and source, and merged upwards for groups that are too small; upper fences far outside
the middle half become the thresholds of the group. Documents join the thresholds of their group and are kept or
rejected. All of it is built-in functions: the text is looked at in one pass, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalgrove.llm.shared import WORD, let, stored, words_of

WINDOW = 8
#: groups of fewer documents take the thresholds of their language, or of all documents
MIN_GROUP = 100
#: how many times the spread of the middle half the fences stand off
REACH = 6.0
#: relative rank error of a sketch: one in so many
ACCURACY = 10_000
#: thresholds of up to so many groups (some 100 bytes each) are sent to all tasks; more are joined with a shuffle
MAX_SENT = 100_000
#: ratio -> least distance of a fence from the upper quartile, so that groups without spread reject nothing usual
RATIOS = {"symbols": 0.05, "dup_lines": 0.30, "repeats": 0.30, "word_length": 3.0}
_RATIO_OF = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
             "repeats": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words")}


def repeat_words(words: Column) -> Column:
    """Words inside windows of 8 that are found twice or more. Windows are compared by a 64-bit hash
    within one text, where two different ones agree with a chance below one in a billion even for a million words."""

    def covered(keys: Column) -> Column:
        ordered = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def at_twins(s: Column) -> Column:
            same = lambda j, k: F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
            twins = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
            return F.array_sort(F.transform(twins, lambda j: F.get(s, j)["i"]))

        def spread(p: Column) -> Column:
            steps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

        return let(let(ordered, at_twins), spread)

    keys = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    some = let(keys, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0).cast("long")).otherwise(covered(k)))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(some)


def counts(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD))
    n_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    return let(words_of(text), lambda w: let(n_lines, lambda n: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        n["n"].alias("n_lines"), n["dup"].alias("n_dup_lines"),
        repeat_words(w).alias("n_repeat_words"))))


def ratio(stats: Column, name: str) -> Column:
    part, whole = _RATIO_OF[name]
    return F.when(stats[whole] > 0, stats[part] / stats[whole]).otherwise(F.lit(0.0))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 20) | (100 * stats["n_repeat_words"] > 30 * stats["n_words"])


def thresholds(rows: DataFrame) -> DataFrame:
    """rows: lang, source, stats. One row per (lang, source): the highest allowed value of each ratio.

    Sketches cover the documents that pass the base rule. They are merged from (lang, source) to lang and to all
    documents in one aggregation; map-side partial sketches keep hot groups small.
    """
    quartiles = [F.percentile_approx(ratio(F.col("stats"), r), F.array(F.lit(0.25), F.lit(0.75)), F.lit(ACCURACY)).alias(r) for r in RATIOS]
    # null is a language and a source like any other, so it is told apart from the null of a higher level
    levels = rows.where(~base_failed(F.col("stats"))).select(
        F.struct("lang").alias("l"), F.struct("source").alias("s"), "stats").rollup("l", "s").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"), *quartiles)
    fences = F.struct(*[(F.col(r)[1] + F.greatest(F.lit(REACH) * (F.col(r)[1] - F.col(r)[0]), F.lit(slack))).alias(r) for r, slack in RATIOS.items()])
    levels = stored(levels.select("l", "s", "n", "level", fences.alias("most")), "quality-levels")
    big = F.col("n") >= MIN_GROUP
    groups = levels.where("level = 0").select("l", "s", F.when(big, F.col("most")).alias("own"))
    langs = levels.where("level = 1").select(F.col("l").alias("ll"), F.when(big, F.col("most")).alias("of_lang"))
    everything = levels.where("level = 3").select("most.*").first()  # one row, none where no document passes
    of_all = F.struct(*[F.lit(None if everything is None else everything[r]).cast("double").alias(r) for r in RATIOS])
    few = levels.count() <= MAX_SENT
    merged = groups.join(F.broadcast(langs) if few else langs, F.col("l") == F.col("ll"), "left")
    out = merged.select(F.col("l.lang").alias("t_lang"), F.col("s.source").alias("t_source"), F.coalesce("own", "of_lang", of_all).alias("most"))
    return F.broadcast(out) if few else out


def passes(stats: Column, most: Column) -> Column:
    """most: the limits of the row's group, null where it has none."""
    within = F.lit(True)
    for r in RATIOS:
        within &= ratio(stats, r) <= most[r]
    return ~base_failed(stats) & F.coalesce(within, F.lit(True))


def judged(rows: DataFrame) -> DataFrame:
    """rows: lang, source, stats and any others; adds base_failed and kept. Rows that fail the base rule and
    whose group has no row that passes join nothing and stay."""
    limits = thresholds(rows)
    both = rows.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    return both.withColumn("base_failed", base_failed(F.col("stats"))).withColumn(
        "kept", passes(F.col("stats"), F.col("most"))).drop("t_lang", "t_source", "most")


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: its id, the counts, ``base_failed``, ``kept``.

    A null or empty text has no words and fails. Null languages and sources form groups of their own. Repeated rows
    are judged alike; ids may be null. An empty table gives an empty result. Other columns are not looked at.
    """
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), counts(F.col(text_col)).alias("stats")), "quality")
    return judged(rows).select(F.col("id").alias(id_col), *[F.col(f"stats.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                               "base_failed", "kept")


def kept_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. Only the counts are stored; where the rows are
    judged they are counted again, so no copy of the texts takes disk, and the texts are not shuffled."""
    group = [F.col(lang_col).alias("lang"), F.col(source_col).alias("source")]
    limits = thresholds(stored(docs.select(*group, counts(F.col(text_col)).alias("stats")), "quality"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *group)
    both = rows.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    return both.where(let(counts(F.col("row")[text_col]), lambda s: passes(s, F.col("most")))).select("row.*")
