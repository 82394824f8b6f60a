"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix is dealt in blocks of equal numbers of words. Blocks go to sources by highest quotients
(target over 1, 3, 5, ...), then from each source to its bundles and from each bundle to its
shards in the same way, so that every shard has an integer quota and no group of an
apportionment grows with the table: a source of n shards has about sqrt(n) bundles of sqrt(n).
Inside a shard the documents stand in a seeded order; the quota is the blocks that follow a
seeded start, round the shard and on into a second turn if the quota asks for one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from phasewright.llm.text import let, words
from phasewright.session import stage


def apportion(parties: DataFrame, by: Sequence[str], order: Sequence[str], weight: str, total: str, out: str) -> DataFrame:
    """Sainte-Laguë seats for each party, ``total`` of them shared inside each group ``by``.

    Every seat whose quotient certainly is among the highest is given by a division; only the
    quotients near the last seat, about three for each party, are ranked. Ties go to the party
    first by ``order``. Parties without weight get none.
    """
    group = W.partitionBy(*by)
    some = F.col(weight) > 0
    sized = parties.withColumns({
        "_n": F.count(F.when(some, 1)).over(group), "_w": F.sum(F.col(weight).cast("double")).over(group)})
    near = F.col("_n") + 1
    seats_at = lambda n: F.floor(F.col(weight) * n / F.col("_w") + 0.5).cast("long")
    safe = F.when(some & (F.col(total) > near), seats_at(F.col(total) - near)).otherwise(F.lit(0).cast("long"))
    most = F.when(some & (F.col(total) > 0), seats_at(F.col(total) + near)).otherwise(F.lit(0).cast("long"))
    sized = sized.withColumns({"_safe": safe, "_most": most})
    sized = sized.withColumn("_open", F.col(total) - F.sum("_safe").over(group))
    keys = [*by, *order]
    ranked = (
        sized.where("_most > _safe").select(*keys, weight, "_open", F.explode(F.sequence(F.col("_safe") + 1, F.col("_most"))).alias("_k"))
        .withColumn("_place", F.row_number().over(group.orderBy((F.col(weight) / (2 * F.col("_k") - 1)).desc(), *order, "_k")))
        .where(F.col("_place") <= F.col("_open")).groupBy(*keys).agg(F.count("*").alias("_won"))
    )
    return (
        sized.join(ranked, keys, "left").withColumn(out, F.col("_safe") + F.coalesce("_won", F.lit(0)))
        .select(*parties.columns, out)
    )


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Word targets of the sources, from one row for each source (``source``, ``source_size``).

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all words.
    A target stops at ``limit`` times its source's size and the excess is shared again by weight,
    which is one level of water for all: target = least(limit * size, weight * level). Adds
    ``_rank`` and ``target``. The windows run over one row for each source.
    """
    everything = W.partitionBy()
    ranked = sizes.withColumn("_rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    by_ratio = W.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before, after = by_ratio.rowsBetween(W.unboundedPreceding, -1), by_ratio.rowsBetween(0, W.unboundedFollowing)
    return (
        ranked.withColumns({"_cap": F.col("source_size") * F.lit(float(limit)), "_weight": F.get(turn, ((F.col("_rank") - 1) % len(weights)).cast("int"))})
        .withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after))
        .withColumn("target", F.least("_cap", F.col("_weight") * F.max("_level").over(everything)))
        .select("source", "source_size", "_rank", "_all", "target")
    )


def _draw(*parts: Column) -> Column:
    """A seeded number that any engine with MD5 can repeat: 60 bits."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def mix(
    docs: DataFrame, columns: Sequence[str] = (), weights: Sequence[int] = (5, 2, 1), share: float = 1.5, limit: float = 2.0,
    block_words: int = 128, shard_words: int = 1_000_000, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix: one row for each row of ``docs`` with what is taken of it.

    Columns: ``doc_id``, the ones named in ``columns``, then ``size`` (words), ``source_size``,
    ``target`` (its source's), ``taken`` (words the mix takes, repeats counted), ``turns`` (whole
    readings of the document) and ``pieces`` (array of first word and number of words of the
    further parts). No document exceeds ``limit`` (2) times its size. The same rows and seed give
    the same mix on any cluster.

    A null text has size 0 and gives nothing; the null source is a source of its own, the last;
    rows with equal ids are separate rows, in the order of their sizes. ``columns`` that clash
    with a computed name are left out.
    """
    made = {"size", "source_size", "target", "taken", "turns", "pieces", "doc_id"}
    carried = [c for c in dict.fromkeys(columns) if c not in made and c != id_col]
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.struct(F.lit(True).alias("_"), *carried).alias("_carried"), F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))).alias("_md5"),
    )
    rows = stage(rows, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long")
    plan = source_targets(sizes, weights, share, limit).withColumns({
        "_blocks": F.round(F.col("_all") / block_words).cast("long"), "_bundles": F.ceil(F.sqrt(shards)).cast("long")})
    plan = plan.withColumn("_parts", F.ceil(shards / F.col("_bundles")).cast("long"))
    plan = stage(apportion(stage(plan, "mix-targets"), [], ["_rank"], "target", "_blocks", "_quota"), "mix-plan").alias("p")
    own = F.conv(F.substring("_md5", 1, 15), 16, 10).cast("long")
    placed = (
        rows.alias("r").join(plan, F.col("r.source").eqNullSafe(F.col("p.source")))
        .select("doc_id", "_carried", "size", "source_size", "target", "_md5", "_rank", "_quota", "_bundles", "_parts")
        .withColumns({"_bundle": own % F.col("_bundles"), "_shard": F.floor(own / F.col("_bundles")).cast("long") % F.col("_parts")})
    )
    shard_sizes = placed.groupBy("_rank", "_bundle", "_shard").agg(F.sum("size").alias("_words"), F.first("_quota").alias("_quota"))
    shard_sizes = stage(shard_sizes, "mix-shards")
    bundles = shard_sizes.groupBy("_rank", "_bundle").agg(F.sum("_words").alias("_bundle_words"), F.first("_quota").alias("_quota"))
    bundles = apportion(stage(bundles, "mix-bundles"), ["_rank"], ["_bundle"], "_bundle_words", "_quota", "_bundle_quota")
    quotas = apportion(
        shard_sizes.drop("_quota").join(bundles.select("_rank", "_bundle", "_bundle_quota"), ["_rank", "_bundle"]),
        ["_rank", "_bundle"], ["_shard"], "_words", "_bundle_quota", "_blocks")
    quotas = stage(quotas, "mix-quotas")
    in_order = W.partitionBy("_rank", "_bundle", "_shard").orderBy("_md5", "size")
    laid = placed.withColumn("_end", F.sum("size").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
    laid = laid.join(quotas.select("_rank", "_bundle", "_shard", "_words", "_blocks"), ["_rank", "_bundle", "_shard"])
    length = F.least(F.col("_blocks") * block_words, F.floor(F.col("_words") * F.lit(limit)).cast("long"))
    from_word = _draw(F.lit(str(seed)), F.lit("shard"), F.col("_rank").cast("string"), F.col("_bundle").cast("string"), F.col("_shard").cast("string"))
    some = F.greatest("_words", F.lit(1))
    laid = laid.withColumns({"_from": from_word % some, "_turns": F.floor(length / some).cast("int"), "_rest": length % some, "_start": F.col("_end") - F.col("size")})

    def part(lo: Column, hi: Column) -> Column:
        first, last = F.greatest(F.col("_start"), lo), F.least(F.col("_end"), hi)
        return F.struct((first - F.col("_start")).alias("first_word"), F.greatest(last - first, F.lit(0).cast("long")).alias("n_words"))

    zero = F.lit(0).cast("long")
    until = F.col("_from") + F.col("_rest")
    pieces = F.filter(F.array(part(F.col("_from"), F.least(until, F.col("_words"))), part(zero, until - F.col("_words"))), lambda p: p["n_words"] > 0)
    taken = F.col("_turns") * F.col("size") + F.aggregate("pieces", zero, lambda n, p: n + p["n_words"])
    return laid.withColumn("pieces", pieces).withColumn("taken", taken).select(
        "doc_id", *[F.col(f"_carried.{c}").alias(c) for c in carried], "size", "source_size", "target", "taken", F.col("_turns").alias("turns"), "pieces")


def mixed_text(text: Column, turns: Column, pieces: Column) -> Column:
    """The words a mix takes: the whole text as often as it is read through, then the further parts, joined by newlines."""
    cut = lambda own: F.transform(pieces, lambda p: F.array_join(F.slice(own, (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")), " "))
    return F.array_join(F.concat(F.array_repeat(text, turns), let(words(text), cut)), "\n")
