"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put in a shuffled order (by a hash of the doc_id) and laid end to end, up to
``EPOCHS`` times over; that stream of words is cut into blocks of equal size. The mix is a sequence of
slots. Slot i takes the golden-ratio point i * PHI (mod 1), and the source into whose piece of the
cumulative target weights the point falls. The r-th slot of a source takes the source's r-th block. So
every stretch of the mix has the sources near their shares, and reruns agree.

Points can miss a source of few blocks. A source whose target is less than ``FEW`` blocks gets slots of its own,
at even distances between the others, for exactly its target: its last block is cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.llm.common import text_key, unused, word_count, written

EPOCHS = 3
WEIGHTS = 3
#: 2 ** 32 divided by the golden ratio: points are multiples of it modulo 2 ** 32.
PHI, UNIT = 2654435769, 1 << 32
SLOTS, MOST_WORDS = 65_536, 1 << 20
CELL, CHUNK = 1 << 20, 1 << 14
#: Sources with a target of less blocks get their target exactly; with more, the points are off by a few blocks only.
FEW = 512


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source, from one row per source with its ``source_size``: weights 1, 2, 3, repeating, in
    code point order of the sources, null last; target: the weighted share of all words, at most EPOCHS times
    the source's own, what is over going to the others by weight. One row per source is all that this
    step's single task sees."""
    ranked = sizes.withColumn(
        "weight", (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % WEIGHTS + 1
    ).withColumn("most", F.lit(EPOCHS) * F.col("source_size"))
    # sources in the order in which they reach their limit as the level rises
    order = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    level = ranked.withColumns({
        "free_words": F.sum("source_size").over(Window.partitionBy())
        - F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "free_weight": F.sum("weight").over(rest),
    }).withColumn("full", F.col("most") * F.col("free_weight") < F.col("weight") * F.col("free_words"))
    # of the first source that stays below its limit: its words and weight are those of all such sources
    open_ = F.when(~F.col("full"), F.struct("free_words", "free_weight"))
    at = F.first(open_, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(
        F.col("weight") * F.col("at.free_words") / F.col("at.free_weight")
    )
    return level.withColumn("at", at).select("source", "source_size", "weight", F.round(target, 6).alias("target"))


def _few(block: int) -> Column:
    return F.col("target") < F.lit(FEW * block)


def schedule(targets: DataFrame, total: int, block: int) -> DataFrame:
    """slot, source, rank: which block of which source each slot takes. ``targets`` is one row per source."""
    n = math.ceil(total / block)
    drawn = _drawn(targets, n, block).select("slot", "source", F.lit(None).cast("long").alias("rank"))
    blocks = F.ceil(F.round("target") / block)
    own = targets.filter(_few(block)).select("source", blocks.alias("blocks")).filter("blocks > 0").select(
        "source", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("rank")
    )
    # where a source begins is a matter of its hash, or all sources of one block would stand together
    begin = F.pmod(F.xxhash64("source"), F.lit(UNIT)) / UNIT
    between = own.select(F.least(F.floor((F.col("rank") + begin) / F.col("blocks") * n), F.lit(n - 1)).alias("slot"), "source", "rank")
    # slots are numbered anew, chunk by chunk
    laid = drawn.union(between).withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    order = Window.partitionBy("chunk").orderBy("slot", F.asc_nulls_first("rank"), F.asc_nulls_last("source"))
    laid = laid.withColumn("turn", F.row_number().over(order) - 1)
    counts = laid.groupBy("chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("chunk", F.coalesce(before, F.lit(0)).alias("start"))
    laid = laid.join(starts, "chunk").select((F.col("start") + F.col("turn")).alias("slot"), "source", "rank")
    laid = written(laid, "mix-slots")
    return _ranked(laid.filter("rank IS NULL").select("slot", "source")).union(laid.filter("rank IS NOT NULL"))


def _drawn(targets: DataFrame, n: int, block: int) -> DataFrame:
    """slot, source: where the points of n slots fall, without those of sources that get slots of their own."""
    spark = targets.sparkSession
    span = Window.orderBy(F.asc_nulls_last("source"))
    # whole words and exact integers, so that the borders don't depend on the order of a sum
    upto = F.sum("share").over(span.rowsBetween(Window.unboundedPreceding, 0))
    pieces = targets.withColumn("share", F.floor("target").cast("decimal(28,0)")).withColumns({
        "upto": upto, "all": F.sum("share").over(Window.partitionBy()),
    }).withColumn("high", F.expr(f"CAST(upto AS DECIMAL(28,0)) * {UNIT}L div all")).withColumn(
        "low", F.lag("high", 1, 0).over(span)
    ).filter("high > low")
    cells = pieces.select(
        "source", "low", "high", _few(block).alias("few"), F.explode(F.sequence(F.floor(F.col("low") / CELL), F.floor((F.col("high") - 1) / CELL))).alias("cell")
    )
    slots = spark.range(n).withColumnRenamed("id", "slot")
    slots = slots.withColumn("point", F.pmod(F.col("slot") * PHI + UNIT // 2, F.lit(UNIT)))
    return slots.withColumn("cell", F.floor(F.col("point") / CELL)).join(cells, "cell").filter(
        "point >= low AND point < high AND NOT few"
    ).select("slot", "source")


def _ranked(slots: DataFrame) -> DataFrame:
    """slot, source, rank: how many slots of its source precede each slot."""
    drawn = slots.withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    counts = drawn.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(before, F.lit(0)).alias("start"))
    turn = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
    ranked = drawn.withColumn("turn", turn).join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c"))
    )
    return ranked.select("slot", "source", (F.col("start") + F.col("turn")).alias("rank"))


def _shuffled(rows: DataFrame, of_source: DataFrame, total_rows: int) -> DataFrame:
    """With ``before``: words of the source's documents that precede in the shuffled order, and the columns of
    ``of_source``, one row per source ``s``. A source is cut by the leading digits of the hash, so that a large
    source is many groups; rows meet their source's columns by these groups, never by the source alone."""
    digits = 2
    while 16**digits < total_rows / 50_000:
        digits += 1
    parts = rows.withColumn("part", F.substring("place", 1, digits))
    sums = parts.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("source", F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("start")).join(
        of_source, F.col("source").eqNullSafe(F.col("s"))
    ).drop("source")
    within = Window.partitionBy("source", "part").orderBy("place", "doc_id", "key").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))
    ).withColumn("before", F.col("start") + F.col("inside")).drop("part", "inside", "start", "s", "p")


def mix(docs: DataFrame, block_words: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents and pieces of the mix.

    Documents, one row each: doc_id, source, key, size, source_size, target (of its source), taken (its words in
    the mix, repeats counted). Pieces: slot, source, rank, doc_id, key, epoch, first and words: which words of which
    document stand in a slot, counted from ``first``. A null text has no words; documents without words are
    taken 0 times; a null source is a source of its own; rows that agree in doc_id and text follow each
    other; an empty table gives no rows.

    ``block_words``: words of a block; by default a 65,536th of all words, a million at most.
    """
    rows = docs.select(
        F.col("doc_id"), F.col("source"), text_key(F.col("text")).alias("key"), word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place"),
    )
    rows = written(rows, "mix-sizes")
    all_ = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()
    block = block_words or max(1, min(MOST_WORDS, all_.words // SLOTS))
    targets = written(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    plan = written(schedule(targets, all_.words, block), "mix-schedule")
    slots = plan.groupBy(F.col("source").alias("s")).agg((F.count("*") * block).alias("slots"))
    granted = F.when(_few(block), F.round("target").cast("long")).otherwise(F.coalesce("slots", F.lit(0)))
    ranged = targets.join(slots, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("s"), "source_size", "target",
        F.least(granted, EPOCHS * F.col("source_size")).alias("granted"),
    )
    laid = _shuffled(rows, ranged, all_.rows).drop("place").withColumn("row", F.monotonically_increasing_id())
    laid = written(laid, "mix-laid")
    epochs = laid.filter("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1)))).withColumn(
        "start", F.col("epoch") * F.col("source_size") + F.col("before")
    ).filter("start < granted").withColumn("end", F.least(F.col("start") + F.col("size"), F.col("granted")))
    cut = epochs.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    low, high = F.greatest("start", F.col("block") * block), F.least("end", (F.col("block") + 1) * block)
    cut = cut.select(
        "row", "doc_id", "key", "epoch", F.col("source").alias("s"), "block", (low - F.col("start")).alias("first"), (high - low).alias("words")
    )
    pieces = cut.join(plan, F.col("s").eqNullSafe(F.col("source")) & (F.col("block") == F.col("rank"))).drop("s", "block")
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    documents = laid.join(taken, "row", "left").select(
        "doc_id", "source", "key", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
    return documents, pieces.drop("row")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, all columns as they are: each as often as its taken words fill it, rounded
    to whole documents. Documents without words are not in a mix."""
    shares, _ = mix(docs)
    per = shares.groupBy("doc_id", "key").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    times = per.select("doc_id", "key", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("times"))
    key, often, turn = unused(docs.columns, "key", "times", "turn")
    wanted = times.filter("times > 0").withColumnsRenamed({"doc_id": "d", "key": "k", "times": often})
    keyed = docs.withColumn(key, text_key(F.col("text")))
    joined = keyed.join(wanted, keyed["doc_id"].eqNullSafe(wanted["d"]) & (keyed[key] == wanted["k"]))
    return joined.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(often)))).select(*(keyed[f"`{c}`"] for c in docs.columns))
