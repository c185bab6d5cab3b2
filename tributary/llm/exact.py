"""Exact dedup by content sort.

Rows are range-partitioned by sampled splitters over a bounded piece of the normalised text (its first
and last characters and its byte length, which equal texts share), sorted within partitions by that
piece and the whole normalised text, and each text is compared in full with its neighbour. Sorting is
Spark's external sort, so a partition may exceed memory. A piece that holds very many rows is dealt
over salts by chance, be it one row repeated; the first row of each salted run is compared again, in full, with those of the other salts.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.llm.common import kept_rows, text_key, written

HEAD, TAIL = 32, 16
KEY = ["head", "bytes", "tail", "salt"]


def normalised(text: Column) -> Column:
    """Null as empty, A-Z in lower case, all else as it is."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def exact_groups(docs: DataFrame, keep: str = "largest", hot_share: float = 0.25) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, key.

    Of equal normalised texts the row with the largest (or smallest) doc_id stays. ``key`` is the text's
    ``text_key``: of several rows that all have the doc_id that stays, the least key, and there any one, is
    marked as kept. Null texts equal empty
    ones; a null doc_id counts as smaller than any other; an empty table gives no rows.

    ``hot_share``: a sort key with more rows than this share of a mean partition is salted, so no task
    gets many more rows than the others, however large one group is.
    """
    spark = docs.sparkSession
    best = F.max if keep == "largest" else F.min
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", "text", normalised(F.substring(text, 1, HEAD)).alias("head"), F.octet_length(text).alias("bytes"),
        normalised(F.right(text, F.lit(TAIL))).alias("tail"),
    )
    pieces = rows.groupBy("head", "bytes", "tail").agg(F.count("*").alias("n")).filter("n > 1")
    total = max(1, docs.count())
    fill = max(64, int(hot_share * total / int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = pieces.filter(F.col("n") > fill).select("head", "bytes", "tail", F.ceil(F.col("n") / fill).alias("salts"))
    # rows of `hot` are at most total / fill: some for each partition, whatever the texts
    salted = rows.join(F.broadcast(hot), ["head", "bytes", "tail"], "left").withColumn(
        "salt", F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.floor(F.rand(29) * F.col("salts"))).cast("int")
    )
    placed = salted.repartitionByRange(*KEY).withColumn("norm", normalised(F.col("text")))
    near = Window.partitionBy(*KEY).orderBy("norm", "doc_id")
    first = ~F.col("norm").eqNullSafe(F.lag("norm").over(near)) | (F.row_number().over(near) == 1)
    compared = placed.withColumn("first", first).withColumns({
        "run": F.sum(F.col("first").cast("long")).over(near.rowsBetween(Window.unboundedPreceding, 0)),
        "sha": F.unhex(F.sha2("norm", 256)), "key": text_key(F.col("text")),
        "lead": F.when(F.col("first") & F.col("salts").isNotNull(), F.col("norm")),
    }).drop("norm", "text", "first")
    whole = Window.partitionBy(*KEY, "run")
    runs = written(compared.withColumns({
        "run_best": best("doc_id").over(whole), "run_size": F.count("*").over(whole),
        "turn": F.row_number().over(Window.partitionBy(*KEY, "run", "doc_id").orderBy("key")),
    }).withColumn("run_key", F.min(F.when(F.col("doc_id").eqNullSafe(F.col("run_best")), F.col("key"))).over(whole)), "exact-runs")

    heads = runs.filter(F.col("lead").isNotNull()).select(*KEY, "run", "lead", "run_best", "run_size", "run_key")
    merged = heads.groupBy("lead").agg(best("run_best").alias("best"), F.sum("run_size").alias("size"))
    joined = heads.join(merged, "lead")
    # rows with the doc_id that stays may stand in several salts: the least key, and there the least salt, has the one
    one = joined.filter(F.col("run_best").eqNullSafe(F.col("best"))).groupBy("lead").agg(F.min(F.struct("run_key", "salt")).alias("one"))
    settled = joined.join(one, "lead").select(*KEY, "run", "best", "size", (F.col("one.salt") == F.col("salt")).alias("holds"))
    cold = runs.filter(F.col("salts").isNull()).withColumns(
        {"best": F.col("run_best"), "size": F.col("run_size"), "holds": F.lit(True)}
    )
    warm = runs.filter(F.col("salts").isNotNull()).join(settled, [*KEY, "run"])
    return cold.unionByName(warm, allowMissingColumns=True).select(
        "doc_id", F.col("best").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("best")) & (F.col("turn") == 1) & F.col("holds")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "key",
    )


def distinct_texts(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The documents with one row for each text, all columns as they are."""
    groups = written(exact_groups(docs, keep).filter("group_size > 1"), "exact-groups")
    return kept_rows(docs, groups)
