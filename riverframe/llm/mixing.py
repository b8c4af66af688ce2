"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions alone.

The documents of a source, in an order fixed by a hash of the id, form blocks of ``BLOCK_DOCS``. A
source with weight ``w`` of ``H`` slots releases its block j (from 0) at slot ``floor(j * H / w)``; its
deadline is ``ceil((j + 1) * H / w)``. Earliest deadline first among the released blocks gives every slot a
block, so that after any number of slots every source is within less than one block of its target.
Weights are whole numbers that sum to ``H``, hence the schedule repeats every ``H`` slots: one period is
computed once, by a fold over its slots in a single row of the size of the number of sources, and a block's slot
follows from its number by arithmetic. Nothing is scheduled block by block.

Positions inside a source come from counts of (source, hash range) and numbers inside a range; there are
65 536 ranges of the id's hash, so that no source, however large, is ordered in one task.

Weights: given as a map, or proportional to ``size ** ALPHA`` over the sources present; they are rounded to ``H``
slots by largest remainder, every source with documents and a positive weight getting one at least.
``H`` is ``SLOTS`` or four times the number of sources, if that is more.

The plan goes on after a source has run out, its slots then stay empty; ``on_target`` marks the slots before
that. Every document gets exactly one row.

Defined results: a null source is a source of its own; null ids and repeated rows are documents like any other
(equal rows follow each other); sources without a target weight, or with weight 0, are last: slot null,
on_target false; an empty table gives an empty plan. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverframe.operators.settle import settle

BLOCK_DOCS = 16
SLOTS = 1000
ALPHA = 0.5

def _source_key() -> Column:
    """A text per source that is never null: a null source is one of its own."""
    return F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))


def whole_weights(sizes: DataFrame, targets: dict | None = None, slots: int = SLOTS) -> DataFrame:
    """One row: the sources in order, their whole weights and the period ``h``.

    ``sizes`` has key and n. Sources without a positive target are left out.
    """
    share = F.pow(F.col("n").cast("double"), F.lit(ALPHA))
    if targets is not None:
        pairs = [x for k, v in targets.items() for x in (F.lit("" if k is None else f"={k}"), F.lit(float(v)))]
        share = F.coalesce(F.create_map(*pairs)[F.col("key")] if pairs else F.lit(0.0), F.lit(0.0))
    wanted = sizes.select("key", share.alias("share")).where("share > 0")
    # One row per source from here on: a mixture has as many sources as someone has named.
    row = wanted.agg(F.array_sort(F.collect_list(F.struct("key", "share"))).alias("s")).where("size(s) > 0")
    row = row.withColumn("h", F.greatest(F.lit(slots), 4 * F.size("s")))
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + x["share"])
    free = F.col("h") - F.size("s")  # every source has one slot; the others go by share
    row = row.withColumn("total", total).withColumn(
        "q", F.transform("s", lambda x: F.struct(x["key"].alias("key"), (x["share"] / F.col("total") * free).alias("exact")))
    )
    row = row.withColumn("down", F.aggregate("q", F.lit(0), lambda a, x: a + F.floor(x["exact"]).cast("int"))).withColumn("rest", free - F.col("down"))
    ranked = F.array_sort(F.transform("q", lambda x: F.struct((F.floor(x["exact"]) - x["exact"]).alias("r"), x["key"].alias("key"))))
    row = row.withColumn("more", F.transform(F.slice(ranked, F.lit(1), F.col("rest")), lambda x: x["key"]))
    weight = lambda x: 1 + F.floor(x["exact"]).cast("int") + F.array_contains("more", x["key"]).cast("int")
    return row.select(F.transform("q", lambda x: x["key"]).alias("keys"), F.transform("q", weight).alias("w"), "h")


def _ceil_div(a: Column, b: Column) -> Column:
    return F.floor((a + b - 1) / b)


def one_period(weights: DataFrame) -> DataFrame:
    """key, w, h, place (0 to w - 1), slot: earliest deadline first over one period."""
    zero = F.struct(F.transform("w", lambda _: F.lit(0)).alias("done"), F.expr("cast(array() as array<int>)").alias("picked"))

    def step(state: Column, t: Column) -> Column:
        # (deadline, source) of every released block; the smallest goes first.
        heads = F.zip_with(state["done"], F.col("w"), lambda j, w: F.struct(F.when(F.floor(j * F.col("h") / w) <= t, _ceil_div((j + 1) * F.col("h"), w)).alias("d"), w.alias("w")))
        order = F.transform(heads, lambda x, i: F.when((x["w"] > 0) & x["d"].isNotNull(), F.struct(x["d"].cast("long").alias("d"), i.alias("i"))))
        best = F.array_min(F.filter(order, lambda x: x.isNotNull()))["i"]
        # A lambda over one element, so that the choice is made once and not for every source.
        return F.transform(F.array(best), lambda b: F.struct(
            F.transform(state["done"], lambda j, i: F.when(i == b, j + 1).otherwise(j)).alias("done"), F.concat(state["picked"], F.array(b)).alias("picked")
        ))[0]

    run = F.aggregate(F.sequence(F.lit(0), F.col("h") - 1), zero, step)
    slots = weights.select("keys", "w", "h", run["picked"].alias("picked")).select("keys", "w", "h", F.posexplode("picked").alias("slot", "i"))
    place = F.row_number().over(Window.partitionBy("i").orderBy("slot")) - 1
    return slots.where("i is not null").select(F.col("keys")[F.col("i")].alias("key"), F.col("w")[F.col("i")].alias("w"), "h", place.alias("place"), "slot")


def plan(docs: DataFrame, targets: dict | None = None, slots: int = SLOTS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """doc_id, source, position, block, slot, release, deadline, weight, on_target of every document."""
    rows = docs.select("doc_id", "source", _source_key().alias("key"), F.xxhash64("doc_id").alias("hash"))
    fine = F.shiftrightunsigned("hash", 48).cast("int")  # 65 536 ranges of the hash
    counts = settle(rows.groupBy("key", fine.alias("fine")).agg(F.count("*").alias("n")), "mixing-counts")
    before = F.sum("n").over(Window.partitionBy("key").orderBy("fine").rowsBetween(Window.unboundedPreceding, -1))
    begins = counts.select("key", "fine", F.coalesce(before, F.lit(0)).alias("begin"))
    numbered = rows.withColumn("fine", fine).withColumn("inside", F.row_number().over(Window.partitionBy("key", "fine").orderBy("hash", "doc_id")) - 1)
    placed = numbered.join(begins, ["key", "fine"]).withColumn("position", F.col("begin") + F.col("inside"))
    placed = placed.withColumn("block", F.floor(F.col("position") / block_docs))
    sizes = counts.groupBy("key").agg(F.sum("n").alias("n"))
    period = settle(one_period(whole_weights(sizes, targets, slots)), "mixing-period")
    ends = sizes.join(period.groupBy("key").agg(F.max("w").alias("w"), F.max("h").alias("h")), "key").withColumn("last", F.ceil(F.col("n") / block_docs))
    # The first slot that a source would have filled, had it one more block.
    over = ends.withColumn("place", F.expr("cast(last % w as int)")).join(period.select("key", "place", "slot"), ["key", "place"])
    limit = over.agg(F.min(F.floor(F.col("last") / F.col("w")) * F.col("h") + F.col("slot")).alias("horizon"))
    table = period.groupBy("key").agg(F.max("w").alias("weight"), F.max("h").alias("h"), F.transform(F.array_sort(F.collect_list(F.struct("place", "slot"))), lambda x: x["slot"]).alias("slots"))
    horizon = limit.first()[0] or 0
    joined = placed.join(F.broadcast(table), "key", "left")  # one row per source and together one entry per slot
    block, h, w = F.col("block"), F.col("h"), F.col("weight")
    slot = F.floor(block / w) * h + F.col("slots")[F.expr("cast(block % weight as int)")]
    return joined.select(
        "doc_id", "source", F.col("position").cast("long").alias("position"), block.cast("long").alias("block"), slot.cast("long").alias("slot"),
        F.floor(block * h / w).cast("long").alias("release"), _ceil_div((block + 1) * h, w).cast("long").alias("deadline"),
        F.col("weight").cast("int").alias("weight"), F.coalesce(slot < horizon, F.lit(False)).alias("on_target"),
    )
