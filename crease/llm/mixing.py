"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source are shuffled by a hash of their id and laid end to end; the line
of words is cut into blocks of equal length. Slot ``i`` of the schedule has the van der
Corput point of ``i``; the source in whose part of the cumulative targets the point falls
gets the slot. The points repeat with a period of ``2 ** BITS`` slots, and in each period a
source has the same number of slots, so the rank of a slot within its source is
``period * slots of the source in a period + rank inside the period``: no window runs over
the slots. A source's slot of rank ``r`` takes its block ``r mod blocks``.

A source with few points of the grid, or none, would miss its target by a large share. It is
dealt on its own: blocks so short that its target has many, and just the slots that fill the
target, spread evenly over the schedule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crease.llm.common import n_words
from crease.session import staged

#: Bits of a point: the period has 262,144 slots, the proven bound of the table that is broadcast.
BITS = 18
#: Weights of the sources in turn.
WEIGHTS = (3, 1, 2)
#: Words of a block: as many as give MIN_BLOCKS blocks in all, at least 1, at most MAX_WORDS.
MIN_BLOCKS, MAX_WORDS = 1 << 20, 4096
#: Sources with fewer cells are dealt on their own, by about as many blocks or more: no target is missed by 1 % for a cell.
LEAST_CELLS = 128
#: Parts of the shuffled order of a source that are summed up on their own.
PARTS = 1024


def sized(docs: DataFrame) -> DataFrame:
    """Documents as (doc_id, source, size, h): the words, and the place in the shuffled order."""
    return docs.select(
        "doc_id",
        "source",
        n_words(F.col("text")).alias("size"),
        F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10)
        .cast("long")
        .alias("h"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """One row for each source: its size, weight and target words.

    All sources share 150 % of all words by weight; a source stops at twice its size, and
    what it leaves is shared among the others until none is above. Sources are ordered by
    code point, null last. That is one row a source, so the windows are over few rows.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    per = per.withColumn("src", F.row_number().over(order).cast("long"))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("src") - 1) % len(WEIGHTS) + 1).cast("int")))
    per = per.withColumn("total", F.sum("source_size").over(every))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "src")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (1.5 * F.col("total") - 2 * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(rest)
    per = per.withColumn("full", 2 * F.col("source_size") / F.col("weight") <= level)
    taken = F.sum(F.when(F.col("full"), 2 * F.col("source_size")).otherwise(0)).over(every)
    open_ = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(every)
    share = F.col("weight") * (1.5 * F.col("total") - taken) / open_
    per = per.withColumn("target", F.when(F.col("full"), 2.0 * F.col("source_size")).otherwise(share))
    whole = F.floor("target").cast("long")
    upto = F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    per = per.withColumn("upto", upto).withColumn("goal", F.sum(whole).over(every))
    block = F.greatest(F.lit(1), F.least(F.lit(MAX_WORDS), F.expr(f"total div {MIN_BLOCKS}"))).cast("long")
    per = per.withColumn("block_words", block)
    cell = lambda words: F.when(
        F.col("goal") > 0, F.floor(words.cast("decimal(20,0)") * F.lit(1 << BITS) / F.col("goal").cast("decimal(20,0)"))
    ).otherwise(0)
    per = per.withColumn("lo", F.coalesce(cell(F.col("upto") - whole), F.lit(0)).cast("long"))
    per = per.withColumn("hi", F.coalesce(cell(F.col("upto")), F.lit(0)).cast("long"))
    per = per.withColumn("narrow", F.col("hi") - F.col("lo") < LEAST_CELLS).withColumn("line_words", F.col("block_words"))
    short = F.greatest(F.lit(1).cast("long"), F.least("block_words", F.expr(f"cast(floor(target) as bigint) div {LEAST_CELLS}")))
    per = per.withColumn("block_words", F.when(F.col("narrow"), short).otherwise(F.col("block_words")))
    return per.select(
        "source", "src", "weight", "source_size", "target", "block_words", "goal", "lo", "hi", "narrow", "line_words",
        F.ceil(F.col("source_size") / F.col("block_words")).cast("long").alias("blocks"),
    )


def schedule(spark: SparkSession, per_source: DataFrame) -> DataFrame:
    """The slots: (slot, src, epoch, block). A slot that would take a block a third time is void.

    ``per_source`` is the stored result of ``targets``; block length and slots are read from it.
    A block of a narrow source has the number of the slot of the line that it comes beside.
    """
    head = per_source.select("goal", F.col("line_words").alias("block_words")).head()
    if head is None or not head["goal"]:
        return spark.createDataFrame([], "slot long, src long, epoch long, block long")
    slots = max(1, round(head["goal"] / head["block_words"]))
    # The period: a source's cells as points, the bits of a point reversed as the slot.
    cells = per_source.where("not narrow").select(
        "src", "blocks", (F.col("hi") - F.col("lo")).alias("each"), F.explode(F.expr("sequence(lo, hi - 1)")).alias("cell")
    )
    turned = F.conv(F.reverse(F.lpad(F.bin("cell"), BITS, "0")), 2, 10).cast("long")
    ranked = cells.withColumn("turn", turned).withColumn(
        "rank", F.row_number().over(Window.partitionBy("src").orderBy("turn")).cast("long") - 1
    )
    line = spark.range(slots).select(
        F.col("id").alias("slot"), F.expr(f"id % {1 << BITS}").alias("turn"), F.expr(f"id div {1 << BITS}").alias("period")
    )
    nth = F.col("period") * F.col("each") + F.col("rank")
    dealt = line.join(F.broadcast(ranked.select("turn", "src", "blocks", "each", "rank")), "turn")
    dealt = dealt.withColumn("nth", nth)
    # Narrow sources: whole turns through the source, and the blocks that the rest of the target begins.
    need = F.expr(
        "(cast(floor(target) as bigint) div source_size) * blocks"
        " + cast(ceil((cast(floor(target) as bigint) % source_size) / block_words) as bigint)"
    )
    own = per_source.where("narrow and source_size > 0").withColumn("need", need).where("need > 0")
    own = own.select("src", "blocks", "need", F.explode(F.expr("sequence(0L, need - 1)")).alias("nth"))
    own = own.withColumn("slot", F.floor((F.col("nth") + 0.5) * slots / F.col("need")).cast("long"))
    columns = ["slot", "src", F.expr("nth div blocks").alias("epoch"), F.expr("nth % blocks").alias("block")]
    return dealt.select(*columns).unionByName(own.select(*columns)).where("epoch < 2")


def laid_out(sizes: DataFrame, per_source: DataFrame) -> DataFrame:
    """Documents with their source's row of ``targets`` and ``start``, the words of the source before them.

    A source's order is cut into parts by its hash, so a large source is summed by many tasks.
    """
    parted = sizes.withColumn("part", F.shiftright("h", 60 - PARTS.bit_length() + 1))
    inside = Window.partitionBy("source", "part").orderBy("h", "doc_id", "size")
    placed = parted.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = parted.groupBy("source", "part").agg(F.sum("size").alias("words"))
    line = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("words").over(line), F.lit(0))).drop("words")
    both = placed.alias("d").join(
        totals.alias("t"), F.expr("d.source <=> t.source and d.part = t.part")
    )
    both = both.select("d.doc_id", "d.source", "d.size", (F.expr("t.before + d.upto - d.size")).alias("start"))
    return both.alias("d").join(per_source.alias("s"), F.expr("d.source <=> s.source")).select("d.*", *[
        f"s.{c}" for c in ("src", "source_size", "target", "block_words")
    ])


def mix(docs: DataFrame) -> DataFrame:
    """One row for each document and epoch that takes words of it, and one for those never taken:
    doc_id, source, size, source_size, target, start, epoch (null: never taken), words.

    Null text: size 0, never taken. Null sources are one source. Repeated rows are documents
    of their own. Reruns agree, as order and schedule depend on the rows alone.
    """
    sizes = staged(sized(docs), "sizes")
    per_source = staged(targets(sizes), "targets")
    laid = staged(laid_out(sizes, per_source), "laid")
    first, last = F.expr("start div block_words"), F.expr("(start + size - 1) div block_words")
    pieces = laid.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    held = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("block_words")) - F.greatest(
        F.col("start"), F.col("block") * F.col("block_words")
    )
    pieces = pieces.select("src", "block", "start", held.alias("held"))
    taken = (
        pieces.hint("merge")  # the plan does not see that the explode makes many rows of few
        .join(schedule(docs.sparkSession, per_source), ["src", "block"])
        .groupBy("src", "start", "epoch")
        .agg(F.sum("held").alias("words"))
    )
    return (
        laid.withColumn("__start", F.when(F.col("size") > 0, F.col("start")))
        .join(taken.withColumnRenamed("start", "__start"), ["src", "__start"], "left")
        .select("doc_id", "source", "size", "source_size", "target", "start", "epoch", F.coalesce("words", F.lit(0)).cast("long").alias("words"))
    )


def totals(mixed: DataFrame) -> DataFrame:
    """Words that the mix takes of each document, from the rows of ``mix``."""
    by = ["source", "start", "doc_id", "size", "source_size", "target"]
    sums = mixed.where("size > 0").groupBy(*by).agg(F.sum("words").alias("taken"))
    none = mixed.where("size = 0").select(*by, F.lit(0).cast("long").alias("taken"))
    return sums.unionByName(none).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, whole, once for each epoch that takes any word of them.

    Rows with the same id are dealt alike: as often as the mix takes the one it takes most.
    """
    times = mix(docs).where("epoch is not null").groupBy("doc_id", "size", "start", "source").agg(F.count("*").alias("n"))
    times = times.groupBy("doc_id").agg(F.max("n").cast("int").alias("__times"))
    back = docs.join(times, docs["doc_id"].eqNullSafe(times["doc_id"])).select(*[docs[c] for c in docs.columns], "__times")
    return back.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)
