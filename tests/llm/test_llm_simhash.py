"""SimHash components against all pairs, and the trees against plain search."""

import random
import re

import numpy as np
import pytest
import xxhash

from test_llm_operators import as_set
from tributary.llm import graph, queries, simhash

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [words[i:i + 3] for i in range(len(words) - 2)] if len(words) > 2 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(run).encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(values):
    """For each value the least position that links lead to."""
    values, label = np.array(values, np.uint64), list(range(len(values)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 3) + i + 1:
            x, y = find(i), find(int(j))
            label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def plain_components(rows):
    values = [plain_fingerprint(text) for _, text in rows]
    groups = plain_groups(values)
    least = {}
    for (doc_id, _), g in zip(rows, groups):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return sorted(((d, f"{v:016x}", least.get(g)) for (d, _), v, g in zip(rows, values, groups)), key=repr)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = queries.QUERIES["op12_simhash_near_dedup"](spark, SF_DIR)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert as_set(got, *got.columns) == plain_components([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("tree", [2, 4096])
def test_near_components(wide, rows, tree):
    got = simhash.near_components(wide, tree)
    assert as_set(got, *got.columns) == plain_components([r[:2] for r in rows])


def test_empty(empty):
    assert simhash.near_components(empty).count() == 0


def test_long_text(monkeypatch):
    text = "".join(f"w{i % 77} A{i % 13}\n" for i in range(5000))
    whole = simhash.shingle_hashes(text)
    monkeypatch.setattr(simhash, "stretches", lambda raw, cut=simhash.stretches: cut(raw, 7))
    assert simhash.shingle_hashes(text).tolist() == whole.tolist()
    assert simhash.fingerprints(["two words", text]).tolist() == [plain_fingerprint("two words"), plain_fingerprint(text)]


def families(seed, n):
    """Chains and clouds of values some bits apart, random ones, and zero."""
    rnd = random.Random(seed)
    values = {0}
    while len(values) < n:
        value = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 1, 5, 60])):
            values.add(value)
            for _ in range(rnd.randint(1, 4)):
                value ^= 1 << rnd.randrange(64)
    return sorted(values)


@pytest.mark.parametrize("tree", [3, 50, 4096])
def test_links_of_families(spark, tree):
    values = families(tree, 1500)
    nodes = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "value long").repartition(5)
    links = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64))) for r in simhash.close_links(nodes, tree).collect()]
    assert all((a ^ b).bit_count() for a, b in links)
    place = {v: i for i, v in enumerate(values)}
    label = list(range(len(values)))
    for a, b in links:
        x, y = label[place[a]], label[place[b]]
        if x != y:
            label = [min(x, y) if z in (x, y) else z for z in label]
    assert label == plain_groups(values)


def test_tree_search():
    values = np.array(families(9, 700), np.uint64)
    roots = np.where(np.arange(len(values)) < 400, 0, 400)
    child = simhash.grow(values, roots)
    asked = values ^ np.uint64(5)
    for radius in (0, 3, 9):
        query, node = simhash.search(values, child, asked, roots, radius)
        want = {
            (i, j) for i in range(len(asked)) for j in range(len(values))
            if roots[i] == roots[j] and int(asked[i] ^ values[j]).bit_count() <= radius
        }
        assert set(zip(query.tolist(), node.tolist())) == want and len(query) == len(want)


def test_masks():
    """Any RADIUS bits lie outside the blocks of some mask."""
    rnd = random.Random(1)
    for blocks in (4, 5, 7):
        masks = [m % (1 << 64) for m in simhash.masks(blocks)]
        for _ in range(200):
            bits = sum(1 << b for b in rnd.sample(range(64), 3))
            assert any(not bits & m for m in masks)


def test_components_with_a_hub(spark):
    links = [(1, k) for k in range(2, 900)] + [(k, k + 1) for k in range(2000, 2040)] + [(5000, 5001), (5001, 5000)]
    got = graph.components(spark.createDataFrame(links, "a long, b long"))
    want = {**{k: 1 for k in range(1, 900)}, **{k: 2000 for k in range(2000, 2041)}, 5000: 5000, 5001: 5000}
    assert {r.node: r.label for r in got.collect()} == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).isEmpty()
