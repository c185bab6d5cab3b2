"""Near-duplicate documents by BagMinHash over the multiset of word shingles.

A shingle that occurs w times has weight w, discretised to whole steps. Every (shingle, strip of weight
steps) has its own Poisson process in time, strips doubling in width: (0, 1], (1, 2], (2, 4], (4, 8] and so
on. A point of a process has a time, a weight step within the strip and one of the signature's components;
it counts when its step is at most w. A component holds the earliest time that counts. Two documents share
the points below the smaller weight of each shingle, so components agree with probability sum of minima by
sum of maxima, the weighted Jaccard similarity, without bias. Processes run in time order and stop at a
horizon by which all components are very likely set, so most shingles cost one draw; a document with a
component left unset is drawn again with twice the horizon.

Signatures are cut into bands; documents that agree in a band are compared by their whole multisets. In a large
bucket a few pairs come first, and then every pair not yet linked that the shingles in common don't rule out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tributary.llm.common import in_lots, kept_rows, spread_join, strings, text_key, written
from tributary.llm.graph import components
from tributary.llm.shingles import mix, multisets

SIMILAR = 0.8
#: A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8 ** 6) ** 24 = 0.9993.
BANDS, ROWS = 24, 6
#: Texts of about so many characters are hashed together.
TOGETHER = 1 << 18
#: Buckets of more documents are compared by stars and small groups first; what these leave apart follows by shingles.
ALL_PAIRS, GROUP = 8, 4
#: Documents of a shingle that one task compares with so many others.
TILE = 512
#: Cells in which shingles are counted to order them: 4 MB, which the driver and each task hold.
CELLS = 1 << 20
AT_ONCE = 4096
#: Counted cells leave a task so many at a time.
CELLS_OUT = 1 << 16
#: Bounds are lower by this share, so that rounding loses no pair.
SLACK = 1e-9
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _points(states, widths, lows, weights, docs, horizon, m, out):
    """Run processes up to the horizon of their document and keep the earliest times in ``out``.

    The more often processes go on, the fewer they are: then several points of each are drawn at once. Times
    add up point after point, so they don't depend on how many are drawn together.
    """
    single = bool((widths == 1).all())
    live, times, limit, drawn = np.arange(len(states)), np.zeros(len(states)), horizon[docs], 0
    scale = -1.0 / (m * widths)
    while len(live):
        ahead = max(1, min(512, AT_ONCE // len(live)))
        number = np.arange(drawn + 1, drawn + ahead + 1, dtype=np.uint64) * _STEP
        bits = mix(states[live][:, None] + number)
        waits = np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        waits *= scale[live][:, None]
        waits[:, 0] += times
        ran = np.cumsum(waits, axis=1)
        process, point = np.nonzero(ran < limit[live][:, None])
        who, when, second = live[process], ran[process, point], mix(bits[process, point] ^ _STEP)
        component = ((second >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        at = docs[who] * m + component
        if single:  # a strip of one step, which every weight in it covers
            np.minimum.at(out, at, when)
        else:
            step = lows[who] + np.floor((second & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * widths[who])
            counts = step < weights[who]
            np.minimum.at(out, at[counts], when[counts])
        on = np.flatnonzero(ran[:, -1] < limit[live])
        live, times, drawn = live[on], ran[on, -1], drawn + ahead


def signatures(values: np.ndarray, counts: np.ndarray, limits: np.ndarray, m: int = BANDS * ROWS) -> np.ndarray:
    """One row of m times per document, infinite for a document without shingles."""
    n = len(limits) - 1
    docs = np.repeat(np.arange(n), np.diff(limits))
    total = np.bincount(docs, counts, n)
    strips = []
    low, width = 0, 1
    while low < int(counts.max(initial=0)):
        some = np.flatnonzero(counts > low)
        state = mix(values[some] + mix(np.array([len(strips) + 1], np.uint64)))
        k = len(state)
        strips.append((state, np.full(k, float(width)), np.full(k, float(low)), counts[some].astype(float), docs[some]))
        low, width = low + width, max(1, low + width)
    out = np.full(n * m, np.inf)
    horizon = (np.log(m) + 2.5) / np.maximum(total, 1)
    while strips:
        for strip in strips:
            _points(*strip, horizon, m, out)
        unset = np.isinf(out.reshape(n, m)).any(axis=1)
        strips = [tuple(x[unset[strip[-1]]] for x in strip) for strip in strips]
        strips = [strip for strip in strips if len(strip[0])]
        horizon = horizon * 2
    return out.reshape(n, m)


def band_keys(times: np.ndarray) -> np.ndarray:
    """One 64-bit key per document and band."""
    bits = times.view(np.uint64).reshape(len(times), BANDS, ROWS)
    keys = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(times), BANDS))
    for k in range(ROWS):
        keys = mix(keys ^ bits[:, :, k])
    return keys.view(np.int64)


_SKETCH = T.StructType([
    T.StructField("weight", T.LongType()), T.StructField("digest", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
])


@F.arrow_udf(_SKETCH)
def _sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for texts in in_lots(strings(batch), TOGETHER):
            weights, digests, bands = [], [], []
            values, counts, limits = multisets(texts)
            keys = band_keys(signatures(values, counts, limits))
            for i in range(len(texts)):
                part = slice(limits[i], limits[i + 1])
                weights.append(int(counts[part].sum()))
                digests.append(hashlib.sha256(values[part].tobytes() + counts[part].tobytes()).digest()[:16])
                bands.append(keys[i] if limits[i] < limits[i + 1] else None)
            yield pa.StructArray.from_arrays(
                [pa.array(weights, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["weight", "digest", "bands"],
            )


def similarity(a: list[str], b: list[str]) -> np.ndarray:
    """Weighted Jaccard similarity of each text of a and the one of b."""
    values, counts, limits = multisets([*a, *b])
    out, n = np.zeros(len(a)), len(a)
    for i in range(n):
        p, q = slice(limits[i], limits[i + 1]), slice(limits[n + i], limits[n + i + 1])
        _, x, y = np.intersect1d(values[p], values[q], assume_unique=True, return_indices=True)
        shared = np.minimum(counts[p][x], counts[q][y]).sum()
        whole = counts[p].sum() + counts[q].sum() - shared
        out[i] = shared / whole if whole else 0.0
    return out


@F.arrow_udf(T.DoubleType())
def _similarity(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for batch in batches:
        a, b, size = [], [], 0
        for x, y in zip(*map(strings, batch)):
            a.append(x)
            b.append(y)
            size += len(x) + len(y)
            if size >= TOGETHER:
                yield pa.array(similarity(a, b))
                a, b, size = [], [], 0
        if a:
            yield pa.array(similarity(a, b))


def _close(x: Column, y: Column) -> Column:
    """Whether two weights allow the similarity."""
    return F.least(x, y) >= SIMILAR * (1 - SLACK) * F.greatest(x, y)


def _candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs a < b of nodes that share a band, without those whose weights rule out the similarity, and the
    members (bucket, node, weight) of the buckets that don't give all their pairs.

    A bucket of up to ALL_PAIRS nodes gives all its pairs. In a larger one each node is compared with the
    bucket's least and greatest node and within a group of about GROUP nodes, which is the same group in all
    buckets of a like size. That links most of a large family by few pairs; ``_apart`` gives the rest.
    """
    placed = written(nodes.select("node", "weight", F.explode("bands").alias("bucket")), "near-placed")
    whole = placed.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min(F.struct("node", "weight")).alias("low"), F.max(F.struct("node", "weight")).alias("high")
    ).filter("n > 1")
    ends = whole.select("low", "high")
    groups = F.when(F.col("n") <= ALL_PAIRS, 1).otherwise(F.pow(2.0, F.ceil(F.log2(F.col("n") / GROUP)))).cast("long")
    inner = spread_join(placed, whole.filter("n > 2").select("bucket", "n", "low", "high", groups.alias("groups")), ["bucket"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("groups"))
    ).withColumn("own", F.struct("node", "weight"))
    inner = written(inner.select("bucket", "part", "groups", "own", "low", "high"), "near-buckets")
    large = inner.filter("groups > 1")
    x, y = inner.select("bucket", "part", F.col("own").alias("low")), inner.select("bucket", "part", F.col("own").alias("high"))
    pairs = ends.union(large.select("low", F.col("own").alias("high"))).union(large.select("own", "high")).union(
        x.join(y, ["bucket", "part"]).select("low", "high")
    )
    pairs = pairs.filter((F.col("low.node") < F.col("high.node")) & _close(F.col("low.weight"), F.col("high.weight")))
    return pairs.select(F.col("low.node").alias("a"), F.col("high.node").alias("b")).distinct(), large.select("bucket", "own.*")


def _sets(frame: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """Some rows of the frame at a time, and of their texts the shingles, how often each occurs and the row it is in."""
    at = 0
    for texts in in_lots(frame["text"], TOGETHER):
        values, counts, limits = multisets(texts)
        yield frame.iloc[at:at + len(texts)], values, counts, np.repeat(np.arange(len(texts)), np.diff(limits))
        at += len(texts)


def _heads(texts: DataFrame) -> DataFrame:
    """shingle, node, weight, label, rest: the shingles at which a document (node, weight, label, text) can meet a similar
    one of another label, see ``_apart``.

    Shingles are counted in a sketch of a fixed number of cells, by their last bits. The order is by the count of the cell, then by
    the shingle, the same for all documents, whatever shares a cell; a cell in which all documents have one label holds no
    shingle that counts. So each task finds the heads of its documents, and no other shingle leaves it.
    """
    size = CELLS

    def cells_of(values: np.ndarray) -> np.ndarray:
        return (values & np.uint64(size - 1)).astype(np.int64)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs, low, high = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.full(size, -1, np.int64)
        for frame in frames:
            for some, values, _, row in _sets(frame):
                cells, labels = cells_of(values), some["label"].to_numpy()[row]
                np.add.at(docs, cells, 1)
                np.minimum.at(low, cells, labels)
                np.maximum.at(high, cells, labels)
        filled = np.flatnonzero(docs)
        for at in (filled[i:i + CELLS_OUT] for i in range(0, len(filled), CELLS_OUT)):
            yield pd.DataFrame({"cell": at, "docs": docs[at], "low": low[at], "high": high[at]})

    cells = texts.mapInPandas(counted, "cell long, docs long, low long, high long").groupBy("cell").agg(
        F.sum("docs").alias("docs"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    found = cells.filter("low < high").select(
        F.col("cell").cast("int").alias("cell"), F.least("docs", F.lit((1 << 31) - 1)).cast("int").alias("docs")
    ).toArrow()
    sketch = np.zeros(size, np.int32)  # 0: no documents of different labels
    sketch[found["cell"].to_numpy()] = found["docs"].to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def headed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for some, values, counts, row in _sets(frame):
                docs = shared.value[cells_of(values)]
                met = np.flatnonzero(docs)
                # most frequent first: the sum up to a shingle is the weight from it on in the order
                met = met[np.lexsort((values[met], -docs[met], row[met]))]
                sums, rows = np.cumsum(counts[met]), row[met]
                first = np.searchsorted(rows, rows)
                rest = sums - sums[first] + counts[met[first]] if len(met) else sums
                weight = some["weight"].to_numpy()[rows]
                head = np.flatnonzero(rest >= SIMILAR * (1 - SLACK) * weight)
                yield pd.DataFrame({
                    "shingle": values[met[head]].view(np.int64), "node": some["node"].to_numpy()[rows[head]], "weight": weight[head],
                    "label": some["label"].to_numpy()[rows[head]], "rest": rest[head],
                })

    return texts.mapInPandas(headed, "shingle long, node long, weight long, label long, rest long")


def _apart(members: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs a < b of all nodes of ``members`` that can be similar and have different labels.

    With the shingles of all documents in one order, rare ones first, let ``rest`` be the weight of a document
    from a shingle on. At the first shingle that two documents share, what they share is at most either's rest;
    and of similarity s it is s / (1 + s) of both weights together at least, s of either. So the pairs in which both rests of a
    shared shingle reach that hold every similar pair. Shingles whose documents all have one label are left
    out, also of the rests, as no pair of two labels shares them; and of the others the documents without the most frequent
    label meet all, in tiles.
    """
    named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    some = written(named.join(open_.select("bucket"), "bucket", "left_semi").select("node", "weight", "label").distinct(), "near-open")
    heads = written(_heads(some.join(texts, "node").select("node", "weight", "label", "text")), "near-heads")
    sizes = heads.groupBy("shingle", "label").agg(F.count("*").alias("n")).groupBy("shingle").agg(
        F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("most")
    ).filter("all > most.n")
    met = spread_join(heads, sizes.select(
        "shingle", F.col("most.label").alias("main"), F.ceil(F.col("all") / TILE).alias("wide"),
        F.ceil((F.col("all") - F.col("most.n")) / TILE).alias("deep"),
    ), ["shingle"])
    tiles = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = F.struct("node", "weight", "label", "rest")
    x = met.filter("label <> main").select("shingle", "main", F.pmod(F.xxhash64("node"), "deep").alias("i"), tiles("wide").alias("j"), own.alias("x"))
    y = met.select("shingle", F.pmod(F.xxhash64("node"), "wide").alias("j"), tiles("deep").alias("i"), own.alias("y"))
    enough = F.least("x.rest", "y.rest") * (1 + SIMILAR) >= SIMILAR * (1 - SLACK) * (F.col("x.weight") + F.col("y.weight"))
    once = (F.col("y.label") == F.col("main")) | (F.col("x.node") < F.col("y.node"))
    pairs = x.join(y, ["shingle", "i", "j"]).filter(
        (F.col("x.label") != F.col("y.label")) & once & _close(F.col("x.weight"), F.col("y.weight")) & enough
    )
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b whose texts are similar. Only the filter names the function: with its value as a column too, each
    task would compare all texts twice, in two Python workers at once that stay."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b"
    )
    return both.filter(_similarity("x", "y") >= SIMILAR).select("a", "b")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after further links between nodes of different labels, with a row for each node of these links."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).join(labels, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label")
    ).distinct()
    ends = written(ends, "near-ends")
    x, y = ends.select(F.col("node").alias("a"), F.col("label").alias("x")), ends.select(F.col("node").alias("b"), F.col("label").alias("y"))
    onto = components(links.join(x, "a").join(y, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    onto = onto.select(F.col("node").alias("label"), F.col("label").alias("onto"))
    return labels.union(ends).distinct().join(onto, "label", "left").select("node", F.coalesce("onto", "label").alias("label"))


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept, key.

    Documents are linked when their multisets of five-word shingles have weighted Jaccard similarity 0.8 or
    more; classes are the connected documents, ``class_id`` is the least doc_id of the class and its row is kept
    (of several with that doc_id, the one with the least ``text_key``, and there any one). Equal multisets are one node. A document without words, null or empty, is a class of its
    own row; one with less than five words has one shingle; an empty table gives no rows.
    """
    sketch = docs.select("doc_id", text_key(F.col("text")).alias("key"), _sketched(F.col("text")).alias("s"))
    sketch = written(sketch.select("doc_id", "key", "s.*"), "near-sketch")
    some = sketch.filter("weight > 0")
    nodes = written(some.groupBy("digest").agg(
        F.min(F.struct("doc_id", "key")).alias("at"), F.first("weight").alias("weight"), F.first("bands").alias("bands")
    ).withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    pairs, members = _candidates(nodes)
    pairs = written(pairs, "near-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(members.select("node")).distinct()
    asked = nodes.join(wanted, "node").select("node", "at.*")
    held = docs.select(F.col("doc_id").alias("d"), text_key(F.col("text")).alias("k"), "text")
    texts = written(asked.join(held, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))).groupBy("node").agg(
        F.first("text").alias("text")), "near-texts")
    labels = components(written(_linked(pairs, texts), "near-found"), "near")
    rest = written(_apart(members, labels, texts).join(pairs, ["a", "b"], "left_anti"), "near-apart")
    more = written(_linked(rest, texts), "near-more")
    if not more.isEmpty():
        labels = written(_joined(labels, more), "near-joined")
    known = nodes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("class"))
    placed = written(some.select("doc_id", "key", "digest").join(known, "digest").drop("digest"), "near-placed")
    # both written, so that the join below reads plain rows and can split a large class
    best = written(placed.groupBy("class").agg(
        F.min(F.struct("doc_id", "key")).alias("best"), F.count("*").alias("class_size")
    ), "near-best")
    same = written(placed.groupBy("class", "doc_id", "key").agg(F.count("*").alias("times")), "near-rows")
    judged = same.join(best, "class").select(
        "doc_id", "key", F.col("best.doc_id").alias("class_id"), "class_size", "times",
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("key") == F.col("best.key"))).alias("kept"),
    )
    again = judged.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    alone = sketch.filter("weight = 0").select(
        "doc_id", "key", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"),
    )
    return again.withColumn("kept", F.col("kept") & (F.col("turn") == 1)).drop("turn", "times").unionByName(alone).select(
        "doc_id", "class_id", "class_size", "kept", "key"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one of each class, all columns as they are."""
    return kept_rows(docs, written(near_classes(docs).filter("class_size > 1"), "near-classes"))
