"""Quality rules: base counts of a text, and lines that many documents of a host share.

Normalised lines are hashed and counted by the documents of their host (the source) that hold
them. Lines above the limit are template lines: they are taken away, and a document that has
too little left is rejected. Everything is a column expression or an aggregate on hashes; texts
are read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewright.llm.text import LOWER, SPACE, UPPER, let, lines, strip, whole, words
from phasewright.session import stage

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def repeated_words(own: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more in the text.

    Windows are hashed and sorted with their position; a window equal to a neighbour repeats.
    The words covered by the repeated windows are the gaps between their sorted positions, each
    at most 3: linear after the sort, for texts of any length.
    """
    at = F.sequence(F.lit(0), F.size(own) - 3)
    hashed = F.transform(at, lambda i: F.struct(F.xxhash64(F.get(own, i), F.get(own, i + 1), F.get(own, i + 2)).alias("h"), i.alias("i")))
    places = F.array_sort(F.transform(let(F.sort_array(hashed), _repeats), lambda x: x["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(3))).alias("n")))
    return F.when(F.size(own) < 4, F.lit(0).cast("long")).otherwise(covered["n"])


def _repeats(ordered: Column) -> Column:
    same = lambda x, j: F.coalesce(F.get(ordered, j)["h"] == x["h"], F.lit(False))
    return F.filter(ordered, lambda x, j: same(x, j - 1) | same(x, j + 1))


def normalised(line: Column) -> Column:
    """A line without outer white space, A-Z in lower case, every digit as 0."""
    return F.translate(strip(line), UPPER + "123456789", LOWER + "0" * 9)


def quality_rules(
    docs: DataFrame, max_docs: int = 100, max_share: float = 0.01, min_left: float = 0.3, min_words: int = 50, max_repeat: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
) -> DataFrame:
    """One row for each row of ``docs``: base counts, lines removed, verdict.

    A line is above the limit if more documents of its host hold it than ``max_docs`` and than
    ``max_share`` of the host's documents. ``base_failed``: fewer than ``min_words`` words, or more
    than ``max_repeat`` of them in repeated 3-word windows. ``kept`` is false for these and for
    documents with less than ``min_left`` of their words outside such lines.

    Null texts have no words; a null host is a host of its own; each row counts as a document,
    also one that repeats; only the named columns are read, so others may have any name.
    """
    text, own = whole(F.col(text_col)), F.col("_words")
    with_word = F.filter(lines(F.col(text_col)), lambda line: strip(line) != "")
    base = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("_host"), text.alias("_text"), words(F.col(text_col)).alias("_words"), with_word.alias("_lines"))
        .select(
            "doc_id", "_host", F.size(own).cast("long").alias("n_words"), F.length(F.translate("_text", SPACE, "")).cast("long").alias("word_chars"),
            (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), repeated_words(own).alias("n_repeat_words"),
            F.transform("_lines", lambda line: F.struct(F.xxhash64(normalised(line)).alias("line"), F.size(words(line)).alias("words"))).alias("_lines"),
            F.monotonically_increasing_id().alias("_row"))
    )
    base = stage(base, "line-quality")
    held = base.select("_row", "_host", F.explode("_lines").alias("_l")).select("_row", "_host", "_l.line", "_l.words")
    once = base.select("_host", F.explode(F.array_distinct(F.transform("_lines", lambda x: x["line"]))).alias("line"))
    hosts = base.groupBy("_host").agg(F.count("*").alias("_host_docs"))
    often = (
        once.groupBy("_host", "line").agg(F.count("*").alias("_docs")).where(F.col("_docs") > max_docs).alias("o")
        .join(hosts.alias("h"), F.col("o._host").eqNullSafe(F.col("h._host"))).where(F.col("_docs") > F.col("_host_docs") * max_share)
        .select(F.col("o._host").alias("_host"), "line")
    )
    lost = (
        held.alias("l").join(often.alias("o"), (F.col("l.line") == F.col("o.line")) & F.col("l._host").eqNullSafe(F.col("o._host")), "left_semi")
        .groupBy("_row").agg(F.sum("words").alias("_lost"), F.count("*").alias("n_removed_lines"))
    )
    out = base.join(lost, "_row", "left").withColumn("n_left", F.col("n_words") - F.coalesce("_lost", F.lit(0)))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > F.col("n_words") * max_repeat)
    kept = ~F.col("base_failed") & (F.col("n_left") >= F.col("n_words") * min_left)
    return out.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"),
        F.coalesce("n_removed_lines", F.lit(0).cast("long")).alias("n_removed_lines"), "n_left")


