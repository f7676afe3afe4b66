"""Mixing sources to target weights by capped water-filling; DataFrame functions only.

Sources take weights in turn by code point (null last).  The wanted total is a share of all words.  A source's target
is ``least(cap, level * weight)`` where the cap is ``max_epochs`` times the source's words; the level is that at which
the targets add up to the total.  With sources in order of cap / weight, the level that holds once the first k are full
is ``(total - caps before) / (weights left)``; it rises while sources fill up and falls after, so the level is its
maximum: the fixed point that pouring the excess back by weight ends at.

A document is taken ``floor(target / source words)`` whole times, and a seeded order decides the fractional rest: the
documents that come first (by md5 of seed and id) are taken once more until the rest is used up; the last of them in
part.  So a source's taken words are its target, rounded.  Rows are written once with their sizes and their place in that order.
The order is cut into bins by the hash's first digits, as many as the number of rows asks for; sums by bin are pre-aggregated, and tell in which bin of a source the rest
ends.  Only rows of that bin are put in order, to find the row it ends in; then a row is told by comparing its place with that one's.  No
task gets a source whole, and texts aren't moved but by the join with one row a source.

Defined cases: a null or blank text has size 0 and takes 0; a null source is a source of its own; a null id counts as the
empty string in the hash; equal rows each count; an empty table gives no rows; sources without words get target 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, settled

SPACED = r"[\x20\x09-\x0D]*" + WORD
WEIGHTS = (3, 1, 2)
NAMES = ("size", "source_size", "target", "taken")


def words(text: Column) -> Column:
    """The number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(_key, source_size) -> with target, whole and rest; one row a source.  The windows see one row a source only."""
    everything = Window.partitionBy()
    by_name = Window.orderBy((F.col("_key") == "n").asc(), F.col("_key").asc())
    filling = Window.orderBy(F.col("_ratio").asc(), F.col("_turn").asc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("_turn", F.row_number().over(by_name))
        .withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_turn") - 1) % len(weights) + 1).cast("long"))
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_ratio", F.col("_cap").cast("double") / F.col("_weight"))
    )
    level = (F.sum("source_size").over(everything).cast("double") * share - F.coalesce(F.sum("_cap").over(filling), F.lit(0)).cast("double")) / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(filling), F.lit(0)))
    target = F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight"))
    return (
        ranked.withColumn("_step", level)
        .withColumn("_level", F.max("_step").over(everything))
        .withColumn("target", F.greatest(target, F.lit(0.0)))
        .withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("_rest", F.floor(F.col("target") + 0.5).cast("long") - F.col("_whole") * F.col("source_size"))
        .select("_key", "source_size", "target", "_whole", "_rest")
    )


def _placed(df: DataFrame, row: Column, *, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """The rows as a written table with their source's key, place in the seeded order and number of words."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    order = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    rows = df.select(row.alias("_row"), _source_key(F.col(source_col)).alias("_key"), words(F.col(text_col)).alias("size"), F.struct(order.alias("order"), name.alias("id")).alias("_hash"))
    rows = settled(rows.withColumn("_n", F.monotonically_increasing_id()))
    return rows.select("_row", "_key", "size", F.struct("_hash.order", "_hash.id", "size", F.col("_n").alias("n")).alias("_place"))


def _planned(df: DataFrame, row: Column, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_epochs: int = 2, seed: int = 0, bin_rows: int = 4096) -> DataFrame:
    """_row, size, source_size, target, _whole and _extra: whole copies and words besides that are taken."""
    rows = _placed(df, row, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed)
    slim = rows.select("_key", "size", "_place")
    digits = max(1, math.ceil(math.log(max(1, slim.count() / bin_rows), 16)))
    binned = slim.withColumn("_bin", F.substring("_place.order", 1, digits))
    bins = binned.groupBy("_key", "_bin").agg(F.sum("size").alias("_bin_size"))
    sizes = bins.groupBy("_key").agg(F.sum("_bin_size").alias("source_size"))
    aims = settled(targets(sizes, weights=weights, share=share, max_epochs=max_epochs))
    before_bin = F.coalesce(F.sum("_bin_size").over(Window.partitionBy("_key").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The bin in which a source's rest ends, and then the row.
    last_bin = bins.withColumn("_before_bin", before_bin).join(aims.select("_key", "_rest"), "_key").filter((F.col("_before_bin") < F.col("_rest")) & (F.col("_before_bin") + F.col("_bin_size") >= F.col("_rest")))
    in_bin = Window.partitionBy("_key").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    running = binned.join(last_bin.select("_key", "_bin", "_before_bin", "_rest"), ["_key", "_bin"]).withColumn("_left", F.col("_rest") - F.col("_before_bin") - F.coalesce(F.sum("size").over(in_bin), F.lit(0)))
    ends = running.filter((F.col("_left") > 0) & (F.col("_left") <= F.col("size"))).select("_key", F.col("_place").alias("_end"), F.col("_left").alias("_part"))
    plan = settled(aims.join(ends, "_key", "left"))
    extra = F.when(F.col("_end").isNull() | (F.col("_place") > F.col("_end")), 0).when(F.col("_place") < F.col("_end"), F.col("size")).otherwise(F.col("_part")).cast("long")
    return rows.join(plan, "_key").select("_row", "size", "source_size", "target", "_whole", extra.alias("_extra"))


def mix(df: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The id and size, source_size, target, taken of every row; the options are those of the plan."""
    planned = _planned(df, F.struct(F.col(id_col)), id_col=id_col, **options)
    return planned.select(F.col("_row")[id_col].alias(id_col), "size", "source_size", "target", (F.col("_whole") * F.col("size") + F.col("_extra")).alias("taken"))


def mixed_rows(df: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The mix itself, with the input's columns: a row for each whole copy that is taken, and one cut after its first words for a part, all as they stand in the text."""
    names = df.columns
    planned = _planned(df, F.struct(*(F.col(c) for c in names)), text_col=text_col, **options).withColumn("_text", F.col("_row")[text_col])
    whole = F.col("_whole") + F.when(F.col("_extra") == F.col("size"), 1).otherwise(0)
    spaced = F.regexp_extract_all(F.col("_text"), F.lit(SPACED), F.lit(0))  # each word with what stands before it
    part = F.when((F.col("_extra") > 0) & (F.col("_extra") < F.col("size")), F.array(F.array_join(F.slice(spaced, F.lit(1), F.col("_extra").cast("int")), ""))).otherwise(F.array().cast("array<string>"))
    copies = F.concat(F.array_repeat(F.col("_text"), F.when(F.col("size") > 0, whole).otherwise(0).cast("int")), part)
    return planned.select("_row", F.explode(copies).alias("_text")).select(*(F.col("_text").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names))
