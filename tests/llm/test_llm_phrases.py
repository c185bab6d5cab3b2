"""Phrase collocations against a plain version that counts everything."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from test_llm_operators import as_set
from tributary.llm import phrases

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain_collocations(rows, top, least, share):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for m in range(1, 5):
                counts[lang].update(tuple(ws[i:i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, f in counts.items():
        around = Counter()
        for q, n in f.items():
            if n >= least:
                for m in range(2, len(q)):
                    for i in range(len(q) - m + 1):
                        around[q[i:i + m]] = max(around[q[i:i + m]], n)
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least or 100 * around[p] >= share * a:
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out, key=repr)


def feed(seed, n=300):
    rnd = random.Random(seed)
    names = [f"w{i}" for i in range(14)] + ["É", "ß", "日本", "x" * 40]
    weights = [1 / (i + 1) for i in range(len(names))]
    fixed = [" ".join(rnd.choices(names, k=k)) for k in (3, 4, 5, 6, 7)]
    rows = []
    for i in range(n):
        words = rnd.choices(names, weights, k=rnd.randint(0, 40))
        if rnd.random() < 0.4:
            words.insert(rnd.randint(0, len(words)), rnd.choice(fixed))
        text = "".join(w + rnd.choice([" ", " ", " ", "\t", ", ", "\n", "! ", ".", "  "]) for w in words)
        lang = rnd.choice(["en", "en", "en", "de", None, "und"])
        rows.append((i, rnd.choice([text, text.upper()]), lang, "s", 0))
    return rows + [(None, None, "en", None, 0), (7, "", "fr", "s", 0)] * 2


@pytest.mark.parametrize("seed, top, least, share", [(1, 3, 2, 80), (2, 12, 5, 80), (3, 2000, 2, 50), (4, 5, 3, 101)])
def test_collocations(spark, docs, seed, top, least, share):
    rows = feed(seed)
    got = phrases.collocations(spark.createDataFrame(rows, docs.schema).repartition(4), top, least, share)
    assert got.columns == COLUMNS
    assert as_set(got, *COLUMNS) == plain_collocations(rows, top, least, share)


def test_settled_late(spark, docs, monkeypatch):
    """Most phrases of the first level are inside longer ones, ties are many, and ranking is salted."""
    monkeypatch.setattr(phrases, "RANKED", 5)
    rows = [(i, f"a{i % 9} b{i % 9} c{i % 9} d{i % 9}. common {i % 5}, rare{i} x y", "en", "s", 0) for i in range(90)]
    got = phrases.collocations(spark.createDataFrame(rows, docs.schema), 4, 3, 80)
    assert as_set(got, *COLUMNS) == plain_collocations(rows, 4, 3, 80)


def test_odd_tables(wide, empty, rows):
    got = phrases.collocations(wide, 50, 2, 80)
    assert as_set(got, *COLUMNS) == plain_collocations(rows, 50, 2, 80)
    assert phrases.collocations(empty).count() == 0


def test_texts_in_parts(monkeypatch):
    """A text counts alike however it is cut to be read."""
    text = "one two, three\tfour five! six seven eight nine. ten eleven " * 3
    whole = phrases._Held()
    whole.add(text.encode())
    parts = phrases._Held()
    monkeypatch.setattr(phrases, "stretches", lambda raw, cut=phrases.stretches: cut(raw, 11))
    parts.add(text.encode())
    assert np.concatenate(whole.runs).tolist() == np.concatenate(parts.runs).tolist()


def test_full_filter(spark, docs, monkeypatch):
    """A filter with far too few bits lets everything through, and the result is the same."""
    monkeypatch.setattr(phrases, "BITS_MOST", 6)
    monkeypatch.setattr(phrases, "BITS_EACH", 1)
    rows = feed(5, 120)
    got = phrases.collocations(spark.createDataFrame(rows, docs.schema), 6, 2, 80)
    assert as_set(got, *COLUMNS) == plain_collocations(rows, 6, 2, 80)


def test_only_phrases_that_are_told_get_a_name(monkeypatch):
    """Longer phrases are looked up by the hashes of their words: nothing is hashed but words."""
    hashed, plain = [], phrases.xxhash.xxh64_intdigest
    monkeypatch.setattr(phrases.xxhash, "xxh64_intdigest", lambda x, seed: hashed.append(x) or plain(x, seed))
    everything, nothing = (phrases.Filter(np.full(1, fill, np.uint64)) for fill in (2**64 - 1, 0))
    held = phrases._Held()
    held.add(b"a b c d a b c. d c b a b c")
    counts = phrases._count(held, "en", phrases.Wanted((3, 4), everything, nothing, everything))
    found = {name.decode(): n for names, some in counts for name, n in zip(names, some.tolist())}
    assert found == {
        "a b c": 3, "b c d": 1, "c d a": 1, "d a b": 1, "d c b": 1, "c b a": 1, "b a b": 1,
        "a b c d": 1, "b c d a": 1, "c d a b": 1, "d a b c": 1, "d c b a": 1, "c b a b": 1, "b a b c": 1,
    }
    assert sorted(hashed) == sorted([b"en", *held.ids])
