"""Mixing sources to target weights by Pareto order sampling.

Each source's target is its share of all words. Within a source a document is due
copies in proportion to its weight, the binary digits of its number of words or a
column's value, so that the words of all add up to the target and none is due
more than ``MOST``: weights are few, and their sums say where the most is
reached. The whole copies are certain, and the rest is a chance ``p`` of one more.
Documents are ranked by the odds of a random number over the odds of ``p``, and
the sample is the front of that order whose words come nearest to what the whole
copies leave of the target: a sample of fixed size, in words, with unequal
chances. The order is cut by slices of the ranking value, so no source is ordered
in one task; all is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.store import Shared

#: Weights by the sources' order, repeating.
WEIGHTS = (5, 2, 1)
#: A source, and a document, is taken this many times at most.
MOST = 3
#: Slices of a source's order.
SLICES = 4096
#: Hexadecimal digits of the hash that is a document's random number: 13 are 52 bits, what a double holds.
DIGITS = 13


def words(text: Column) -> Column:
    """Words between blanks and \\x09-\\x0D."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``target`` beside the columns of ``sizes``: ``source, source_size``, one row a source.

    Sources by code point, null last, have the weights in turn and share all
    words by them; where a target passes ``most`` times the source's words it
    stays there, and the excess goes to the others by weight until none is
    above. Sources are capped in the order of their words over their weight, so
    one ordered pass finds who is capped.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", (F.col("source_size") * most).cast("decimal(20,0)"))
    by_ratio = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = rows.withColumn("place", F.row_number().over(by_ratio))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumn("left", left.cast("decimal(20,0)"))
    rows = rows.withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("capped", F.col("cap") * F.col("open").cast("decimal(12,0)") <= F.col("left") * F.col("weight").cast("decimal(12,0)"))
    # The first source that isn't capped fixes the level of all that follow.
    rows = rows.withColumn("level", F.min(F.when(~F.col("capped"), F.struct("place", F.col("left").cast("double").alias("left"), "open"))).over(every))
    shared_out = F.col("level.left") * F.col("weight") / F.col("level.open")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(shared_out)
    return rows.select(*sizes.columns, target.alias("target"))


def length_weight(size: Column) -> Column:
    """The binary digits of a number of words, 1 for none: longer documents are likelier, those of twice the words a little."""
    return F.length(F.bin(size)).cast("long")


def due_copies(cells: DataFrame, most: int = MOST) -> DataFrame:
    """``source, weight, due`` of ``cells``: ``source, target, weight, words``, a row for each weight of a source.

    Copies are due by weight, ``most`` at most: from the greatest weight down,
    weights are at the most as long as the rate that would serve the others
    brings theirs there too; the first that stays below fixes the rate.
    """
    own = Window.partitionBy("source")
    down = own.orderBy(F.desc("weight"))
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    weighed = F.col("words") * F.col("weight")
    rows = cells.withColumn("above", F.coalesce(F.sum("words").over(before), F.lit(0)))
    rows = rows.withColumn("below", F.sum(weighed).over(own) - F.coalesce(F.sum(weighed).over(before), F.lit(0)))
    left = F.col("target") - F.lit(float(most)) * F.col("above").cast("double")
    rows = rows.withColumn("rate", F.when(F.col("below") > 0, left / F.col("below").cast("double")).otherwise(F.lit(0.0)))
    rows = rows.withColumn("full", F.col("rate") * F.col("weight") >= F.lit(float(most)))
    # The greatest weight that isn't at the most.
    rows = rows.withColumn("level", F.max(F.when(~F.col("full"), F.struct("weight", "rate"))).over(own))
    due = F.when(F.col("level").isNull() | (F.col("weight") > F.col("level.weight")), F.lit(float(most))).otherwise(F.greatest(F.col("level.rate") * F.col("weight"), F.lit(0.0)))
    return rows.select("source", "weight", due.alias("due"))


def pareto_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 0,
    weight_col: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies``, and the columns of ``keep``: a row for each input row.

    A document's weight is the binary digits of its words, or ``weight_col``, a
    whole number of few different values; null, and what is below 1, counts as 1.
    Documents without words rank like others and change no sum; a source
    without words is due no copies. Ties of the ranking go by id, then size. A source is
    one row of a table that is ordered in one task: sources are few beside
    documents. Repeated rows are taken apart from each other, but rank together.
    Null texts have no words; an empty table gives an empty one.
    """
    shared = Shared(docs.sparkSession)
    base = [F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(F.col(text_col)).alias("size")]
    weight = length_weight(F.col("size")) if weight_col is None else F.greatest(F.coalesce(F.col("given"), F.lit(1)), F.lit(1))
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    number = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)
    given = (F.lit(None) if weight_col is None else F.col(weight_col)).cast("long").alias("given")
    rows = docs.select(*base, given, number.alias("u"), *[F.col(c).alias(f"kept_{c}") for c in keep]).withColumn("weight", weight).drop("given")
    rows = shared.keep(rows, "sizes")
    cells = shared.keep(rows.groupBy("source", "weight").agg(F.sum("size").alias("words")), "cells")
    rates = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most).withColumnRenamed("source", "s")
    cells = cells.join(rates, cells["source"].eqNullSafe(F.col("s"))).drop("s")
    due = due_copies(cells, most).withColumnsRenamed({"source": "s", "weight": "w"})
    cells = cells.join(due, cells["source"].eqNullSafe(F.col("s")) & (F.col("weight") == F.col("w"))).drop("s", "w", "words")
    # A row for each weight of each source.
    cells = shared.keep(cells.withColumn("due", F.when(F.col("source_size") > 0, F.col("due")).otherwise(F.lit(0.0))).withColumnsRenamed({"source": "s", "weight": "w"}), "rates")
    mixed = rows.join(cells, rows["source"].eqNullSafe(F.col("s")) & (F.col("weight") == F.col("w"))).drop("s", "w")
    mixed = mixed.withColumn("whole", F.floor("due")).withColumn("p", F.col("due") - F.col("whole"))
    # Odds over odds, as a number from 0 to 1 that orders alike.
    odds = F.col("u") / (1 - F.col("u")) * (1 - F.col("p")) / F.col("p")
    mixed = mixed.withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)))
    mixed = mixed.withColumn("slice", F.least(F.floor(F.col("rank") * SLICES), F.lit(SLICES - 1)).cast("int"))
    counted = (F.sum("size").alias("words"), F.sum(F.col("size") * F.col("whole")).alias("certain"), F.max("target").alias("target"))
    slices = mixed.groupBy("source", "slice").agg(*counted)
    by_slice = Window.partitionBy("source").orderBy(F.col("slice").asc_nulls_last())
    slices = slices.withColumn("rest", F.col("target") - F.sum("certain").over(Window.partitionBy("source"))).filter(F.col("slice").isNotNull())
    slices = slices.withColumn("through", F.sum("words").over(by_slice)).withColumn("before", F.col("through") - F.col("words"))
    slices = shared.keep(slices.select("source", "slice", "rest", "before", "through"), "slices")
    edge = slices.filter((F.col("before") < F.col("rest")) & (F.col("through") >= F.col("rest")))
    cut = slices.groupBy("source").agg(F.max("rest").alias("rest"), F.max(F.when(F.col("through") <= F.col("rest"), F.col("slice"))).alias("last_whole"))
    edge = edge.select("source", F.col("slice").alias("edge"), "before")
    cut = cut.join(edge.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    cut = shared.keep(cut.withColumnRenamed("source", "s"), "cuts")
    mixed = mixed.join(cut, mixed["source"].eqNullSafe(F.col("s")), "left").drop("s")
    # Only the rows of each source's one slice at the edge are ordered.
    at_edge = mixed.filter(F.col("slice") == F.col("edge"))
    running = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    at_edge = at_edge.withColumn("through", F.col("before") + F.sum("size").over(running))
    # A row goes in while it brings the words nearer to the rest.
    at_edge = at_edge.withColumn("more", (F.abs(F.col("through") - F.col("rest")) < F.abs(F.col("through") - F.col("size") - F.col("rest"))).cast("long"))
    others = mixed.filter(~F.coalesce(F.col("slice") == F.col("edge"), F.lit(False)))
    others = others.withColumn("more", F.coalesce((F.col("slice") < F.coalesce(F.col("edge"), F.col("last_whole") + 1)).cast("long"), F.lit(0)))
    out = [c for c in ("doc_id", "source", "size", "source_size", "target")]
    out += [F.col(f"kept_{c}").alias(c) for c in keep]
    copies = F.least((F.col("whole") + F.col("more")).cast("long"), F.lit(most)).cast("long").alias("copies")
    return others.select(*out, copies).unionByName(at_edge.select(*out, copies))
