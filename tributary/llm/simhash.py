"""Near-duplicate documents by SimHash fingerprints, searched in BK-trees.

A BK-tree holds fingerprints; each child hangs below its parent by an edge that bears their Hamming distance.
A search that stands at distance d from a node follows only the edges from d minus the radius to d plus the
radius: by the triangle inequality nothing within the radius is below another edge.

Fingerprints are cut into shards with a tree each. The 64 bits are divided into blocks; two fingerprints with at
most ``RADIUS`` differing bits agree in all blocks but ``RADIUS``, so for each choice of the other blocks a shard holds
the fingerprints that agree in them, and no link runs outside the shards. A shard with more than ``TREE`` fingerprints
is dealt over several trees, and every one of them is sent to all tasks that hold a part of the shard's queries.
All trees together grow with the documents, so a shard's trees go to the tasks that ask them, not to all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tributary.llm.common import in_lots, spread_join, stretches, written
from tributary.llm.graph import components

BITS, WIDTH, RADIUS, SEED = 64, 3, 3, 42
#: Fingerprints of one tree, at most about so many.
TREE = 4096
#: Blocks are as few as keep a shard's mean number of random fingerprints below this.
MEAN_SHARD = 64
#: Nodes that searches may stand at together, and pairs of a tree's size and its queries searched together.
TOGETHER = 1 << 20


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """XXH64 of the word shingles of a text, repeats included; of all its words where it has fewer."""
    out, last = [], []
    for part in stretches((text or "").encode().lower()):  # of bytes, only A-Z have a lower case
        words = last + part.split()  # bytes split at exactly the six ASCII blanks
        if len(words) >= width:
            runs = zip(*(islice(words, k, None) for k in range(width)))
            out.append(np.fromiter((xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs), np.uint64, len(words) - width + 1))
        last = words[-(width - 1):]
    if not out and last:
        return np.array([xxhash.xxh64_intdigest(b" ".join(last), SEED)], np.uint64)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """One 64-bit fingerprint per text: the bits that over half of its hashes have; zero without a word."""
    parts = [shingle_hashes(x) for x in texts]
    sizes = np.array([len(x) for x in parts], np.int64)
    some = np.flatnonzero(sizes)
    out = np.zeros(len(texts), np.uint64)
    if len(some):
        hashes = np.concatenate(parts)
        starts = (np.cumsum(sizes) - sizes)[some]
        for bit in range(BITS):
            ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), starts)
            out[some] |= (2 * ones > sizes[some]).astype(np.uint64) << np.uint64(bit)
    return out


@F.pandas_udf(T.LongType())
def _fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in batches:
        for texts in in_lots(series):
            yield pd.Series(fingerprints(texts).view(np.int64))


def grow(values: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Children of each value in the tree that begins at its root: row of the child, by distance, or -1.

    ``roots``: for each value the row of the first one of its tree. The result is that of inserting row after row.
    """
    child = np.full((len(values), BITS + 1), -1, np.int32)
    slots = child.reshape(-1)
    waiting = np.flatnonzero(roots != np.arange(len(values)))
    at = roots[waiting]
    while len(waiting):
        slot = at * (BITS + 1) + np.bitwise_count(values[waiting] ^ values[at]).astype(np.int64)
        empty = np.flatnonzero(slots[slot] < 0)
        taken, first = np.unique(slot[empty], return_index=True)
        slots[taken] = waiting[empty[first]]
        below = slots[slot].astype(np.int64)
        on = below != waiting
        waiting, at = waiting[on], below[on]
    return child


def search(values: np.ndarray, child: np.ndarray, queries: np.ndarray, roots: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) of all values within the radius, the edges beyond it not followed."""
    asked, found = [], []
    query, node = np.arange(len(queries)), roots
    while len(query):
        far = np.bitwise_count(queries[query] ^ values[node]).astype(np.int64)
        hit = far <= radius
        asked.append(query[hit])
        found.append(node[hit])
        edges = far[:, None] + np.arange(-radius, radius + 1)
        below = np.where((edges >= 0) & (edges <= BITS), child[node[:, None], edges.clip(0, BITS)], -1)
        which, edge = np.nonzero(below >= 0)
        query, node = query[which], below[which, edge].astype(np.int64)
    return np.concatenate(asked), np.concatenate(found)


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (rows, the least of a group) after links a, b."""
    while True:
        x, y = label[a], label[b]
        apart = np.flatnonzero(x != y)
        if not len(apart):
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further


def forest_links(tile: np.ndarray, values: np.ndarray, planted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (as values) that connect whatever is within the radius inside a tile, one for each value at most.

    Rows come tile after tile, those of its tree first. Where a tile has no others, its tree is asked for its own.
    """
    first = np.flatnonzero(np.diff(tile, prepend=tile[0] - 1))
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(tile))))
    trees = np.bincount(owner, planted, len(first)).astype(np.int64)
    own = trees == np.bincount(owner, minlength=len(first))
    child_rows = np.flatnonzero(planted)
    place = np.cumsum(planted) - 1  # row within the trees
    child = grow(values[child_rows], place[first][owner[child_rows]])
    asking = np.flatnonzero((own[owner] | ~planted) & (trees[owner] > 0))
    label = np.arange(len(values))
    work = np.cumsum(trees[owner[asking]])
    at = 0
    while at < len(asking):
        end = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + TOGETHER, "right")))
        some = asking[at:end]
        query, node = search(values[child_rows], child, values[some], place[first][owner[some]])
        label = _merge(label, some[query], child_rows[node])
        at = end
    linked = np.flatnonzero(label != np.arange(len(label)))
    return values[linked], values[label[linked]]


def _tiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of rows (shard, i, j, planted, value) that come sorted; a tile may go on in the next batch."""
    held: list[pd.DataFrame] = []

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        keys = frame[["shard", "i", "j"]].to_numpy()
        tile = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).any(axis=1)])
        a, b = forest_links(tile, frame["value"].to_numpy().view(np.uint64), frame["planted"].to_numpy())
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    for frame in frames:
        if not len(frame):
            continue
        frame = pd.concat([*held, frame], ignore_index=True)
        keys = frame[["shard", "i", "j"]].to_numpy()
        cut = int(np.argmax((keys == keys[-1]).all(axis=1)))
        held = [frame.iloc[cut:]]
        if cut:
            yield links(frame.iloc[:cut])
    if held:
        yield links(held[0].reset_index(drop=True))


def masks(blocks: int) -> list[int]:
    """For each choice of all blocks but RADIUS the bits in them, as signed integers."""
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    bits = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    out = [sum(some) for some in combinations(bits, blocks - RADIUS)]
    return [x - (1 << 64) if x >> 63 else x for x in out]


def close_links(nodes: DataFrame, tree: int = TREE) -> DataFrame:
    """Links a, b between the distinct ``value`` of ``nodes`` that connect all within RADIUS differing bits."""
    number, blocks = nodes.count(), RADIUS + 1
    while number > MEAN_SHARD << (BITS * (blocks - RADIUS) // blocks):
        blocks += 1
    shards = F.array(*(
        F.xxhash64(F.lit(k), F.col("value").bitwiseAND(F.lit(mask).cast("long"))) for k, mask in enumerate(masks(blocks))
    ))
    placed = written(nodes.select("value", F.explode(shards).alias("shard")), "simhash-shards")
    sizes = placed.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / tree)
    met = spread_join(placed, sizes, ["shard"]).select(
        "shard", "value", parts.alias("parts"), F.pmod(F.xxhash64("value"), parts).alias("part"),
    ).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    tiles = met.select(
        "shard", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        (F.col("part") <= F.col("other")).alias("planted"), "value",
    )
    dealt = tiles.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j", F.desc("planted"), "value")
    return dealt.mapInPandas(_tiles, "a long, b long")


def near_components(docs: DataFrame, tree: int = TREE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in at most RADIUS bits are linked, and ``component_id`` is the least doc_id of
    the linked ones. Texts are read whole; a null or empty one, or one without words, has fingerprint zero and is
    linked like any other. A text with fewer than three words has one shingle. Equal fingerprints are one node, however
    many documents have them. A null doc_id is never the least; a component of null doc_ids only has a null
    ``component_id``. Repeated rows each get their row; an empty table gives none.
    """
    rows = written(docs.select("doc_id", _fingerprint(F.col("text")).alias("value")), "simhash-rows")
    nodes = written(rows.groupBy("value").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    labels = components(written(close_links(nodes, tree).distinct(), "simhash-found"), "simhash")
    named = written(nodes.join(labels.withColumnRenamed("node", "value"), "value", "left").select(
        "value", "least", F.coalesce("label", "value").alias("label")
    ), "simhash-named")
    heads = named.groupBy("label").agg(F.min("least").alias("component_id"))
    known = written(spread_join(named, heads, ["label"]).select("value", "component_id"), "simhash-known")
    return spread_join(rows, known, ["value"]).select(
        "doc_id", F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), "component_id"
    )
