"""Each operator against a plain version, and over the odd cases."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tributary.llm import bpe, exact, language, licenses, mixing, near, pii, quality, rules, shards, shingles
from tributary.llm.common import strings, text_key

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return BLANK.findall(text or "")


def as_set(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


# --- quality rules


def plain_measures(text):
    ws, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    covered = {j for i in range(len(ws) - 2) if windows[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_ledger(docs, wide, empty, rows):
    got = as_set(rules.ledger(wide), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == sorted(((r[0], *plain_measures(r[1])) for r in rows), key=repr)
    assert rules.ledger(empty).count() == 0
    assert rules.passing(empty).columns == empty.columns
    kept = rules.passing(wide)
    assert kept.columns == wide.columns
    judged = rules.judged(rules.ledger(docs))
    assert as_set(kept, "doc_id") == as_set(judged.filter("kept"), "doc_id")


def test_repeat_words():
    rnd = random.Random(4)
    for _ in range(300):
        text = " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 25)))
        assert rules.repeat_words(text.split()) == plain_measures(text)[4]


def test_ablations(sample):
    ledger = rules.ledger(sample)
    failed = [r.failed for r in ledger.collect()]
    names, mask = rules.POLICIES["v2"], rules.mask("v2")
    expected = {
        (n, sum(bool(f & rules.BIT[n]) for f in failed), sum(f & mask == rules.BIT[n] for f in failed)) for n in names
    }
    got = {tuple(r) for r in rules.ablations(ledger, "v2").select("rule", "failing", "freed").collect()}
    assert got == {x for x in expected}


# --- exact dedup


def normal(text):
    return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def plain_exact(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[normal(text)].append(doc_id)
    return sorted((
        (d, max((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items() for d in ids
    ), key=repr)


def test_exact_groups(wide, empty, rows):
    got = exact.exact_groups(wide)
    assert as_set(got, "doc_id", "keep_id", "group_size", "text_sha256") == plain_exact(rows)
    assert got.filter("kept").count() == len({normal(r[1]) for r in rows})
    assert exact.exact_groups(empty).count() == 0
    kept = exact.distinct_texts(wide)
    assert kept.columns == wide.columns
    assert sorted(normal(r.text) for r in kept.collect()) == sorted({normal(r[1]) for r in rows})
    assert exact.distinct_texts(empty).count() == 0


def test_exact_hot_group(spark):
    """A text with a third of the rows, and near misses that share its sort key."""
    rows = [(i, "Same text " * 20 if i % 3 else f"other {i}") for i in range(3000)]
    rows += [(5000 + i, "same text " * 9 + f"{i:010d}" + "same text " * 10) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = exact.exact_groups(docs, hot_share=0.01)
    assert as_set(got, "doc_id", "keep_id", "group_size", "text_sha256") == plain_exact(rows)
    assert exact.distinct_texts(docs).count() == len({normal(t) for _, t in rows})
    smallest = exact.exact_groups(docs, keep="smallest", hot_share=0.01).filter("kept AND group_size > 1")
    assert [r.doc_id for r in smallest.collect()] == [1]


# --- mixing


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        target = {s: weight[s] * left / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if target[s] > 3 * sizes[s]}
        if not over:
            return target | {s: 3 * sizes[s] for s in full}
        full |= over


def test_mix(docs, wide, empty, rows):
    documents, pieces = mixing.mix(wide, block_words=50)
    got = documents.collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    targets = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], abs=1e-5)
        assert 0 <= r.taken <= 3 * r.size
    for source in sizes:
        assert abs(sum(r.taken for r in got if r.source == source) - targets[source]) <= 50 * 4
    assert sum(r.taken for r in got) == pieces.agg(F.sum("words")).first()[0]
    slots = pieces.groupBy("slot").agg(F.sum("words").alias("n"), F.countDistinct(F.coalesce("source", F.lit("none"))).alias("s")).collect()
    assert max(r.n for r in slots) <= 50 and {r.s for r in slots} == {1}
    again, _ = mixing.mix(docs, block_words=50)
    assert as_set(again, "doc_id", "source", "size", "taken") == as_set(documents, "doc_id", "source", "size", "taken")
    assert mixing.mix(empty)[0].count() == 0
    assert mixing.mixed(empty).count() == 0
    assert mixing.mixed(wide).columns == wide.columns


def test_mix_is_spread(sample):
    """In every stretch of the mix a source has about its share."""
    documents, pieces = mixing.mix(sample)
    share = {r.source: r.target for r in documents.select("source", "target").distinct().collect()}
    total = sum(share.values())
    slots = [r.source for r in pieces.select("slot", "source").distinct().orderBy("slot").collect()]
    for begin in range(0, len(slots) - 2000, 2000):
        seen = Counter(slots[begin:begin + 2000])
        for source, target in share.items():
            assert abs(seen[source] / 2000 - target / total) < 0.02
    per = {(r.doc_id, r.key): r for r in documents.collect()}
    copies = Counter((r.doc_id, r.k) for r in mixing.mixed(sample).select("doc_id", text_key(F.col("text")).alias("k")).collect())
    for at, r in per.items():
        assert copies[at] == (math.floor(r.taken / r.size + 0.5) if r.size else 0)


def test_mix_keeps_tiny_sources(spark):
    """Sources far below one block of the default size get their target in a large corpus."""
    rows = [(i, " ".join(["w"] * 20_000), f"large{i % 3}") for i in range(150)]
    tiny = {f"tiny{i:02}": i + 1 for i in range(40)}
    rows += [(1000 + i, " ".join(["t"] * n), source) for i, (source, n) in enumerate(tiny.items())]
    documents, pieces = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4))
    taken, target = Counter(), {}
    for r in documents.collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    for source in tiny:
        assert abs(taken[source] - target[source]) <= 0.5
    for source in set(target) - set(tiny):
        assert taken[source] == pytest.approx(target[source], rel=0.01)
    slots = pieces.groupBy("slot").agg(F.countDistinct("source").alias("s")).collect()
    assert {r.s for r in slots} == {1}
    at = sorted(r.slot for r in pieces.filter("source LIKE 'tiny%'").select("slot").distinct().collect())
    assert at[0] < len(slots) / 4 and at[-1] > len(slots) * 3 / 4


# --- language and quality


def test_language_learns(spark, sample):
    held = language.id_crc32(4) == 2
    network, labels = language.fit(sample.filter(~held))
    got = language.predicted(sample, network, labels).join(sample.select("doc_id", "lang", held.alias("held")), "doc_id")
    right = [r.lang == r.lang_pred for r in got.collect() if r.held]
    assert len(right) > 30 and sum(right) / len(right) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !?"), (4, "é"), (5, "the " * 20_000), (None, "the")], "doc_id long, text string")
    rows = {r.doc_id: r for r in language.predicted(odd, network, labels).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and rows[4].lang_pred in labels
    assert all(0 <= r.score <= 1 for r in rows.values()) and len(rows) == 6
    assert language.predicted(odd.limit(0), network, labels).count() == 0
    assert [r.lang_pred for r in language.predicted(odd, None, []).collect()] == ["und"] * 6


def test_language_without_labels(docs, empty):
    assert language.fit(empty) == (None, [])
    assert language.fit(docs.withColumn("lang", F.lit(None).cast("string"))) == (None, [])


def test_language_gradients():
    network = language.Network(3, 4)
    for k in network.weights:
        network.weights[k] = network.weights[k].astype(np.float64)
    draw = np.random.default_rng(1)
    data, valid, truth = draw.integers(0, 256, (9, 5)).astype(np.uint8), np.array([9, 4, 9, 1, 7]), np.array([0, 1, 2, 1, 0])
    _, grads = network.step(data, valid, truth)
    for name, value in network.weights.items():
        for at in [tuple(draw.integers(0, s) for s in value.shape) for _ in range(4)] + [(int(data[2, 1]), 1)] * name.endswith("_in"):
            old, d = value[at], 2e-2
            losses = []
            for x in (old + d, old - d):
                value[at] = x
                losses.append(network.step(data, valid, truth)[0])
            value[at] = old
            assert (losses[0] - losses[1]) / (2 * d) == pytest.approx(float(grads[name][at]), abs=2e-3)


def test_windows_cover_all_bytes():
    texts = [b"", b"a" * 64, b"b" * 65, b"c"]
    data, valid, owner = language.windows(texts)
    assert valid.tolist() == [64, 64, 1, 1] and owner.tolist() == [1, 2, 2, 3]
    assert b"".join(bytes(row[:n]) for row, n in zip(data, valid)) == b"".join(texts)


def test_quality_learns(spark, sample):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = language.id_crc32(5) == 0
    network = quality.fit(sample, labels.filter(~held))
    got = quality.scored(sample, network).join(labels, "doc_id").collect()
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([x > y for x in good for y in bad]) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (None, "b" * 100_000)], "doc_id long, text string")
    rows = quality.scored(odd, network).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality.scored(odd.limit(0), network).count() == 0
    assert quality.fit(odd, labels.limit(0)) is None
    assert {r.score for r in quality.scored(odd, None).collect()} == {0.5}


def test_quality_learns_beside_repeated_ids(spark):
    """A chosen doc_id with very many rows leaves the others of its label in the sample."""
    rows = [(1 + i % 2, f"text {i}") for i in range(20_000)] + [(i, f"words {i}") for i in range(3, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 7)], "doc_id long, quality int")
    seen = []
    train = quality.Network.train
    quality.Network.train = lambda self, texts, truth: seen.extend(zip(texts, truth))
    try:
        assert quality.fit(docs, labels, sample_docs=3) is not None
    finally:
        quality.Network.train = train
    assert len(seen) == 6 and Counter(int(y) for _, y in seen) == {0: 3, 1: 3}
    assert {f"words {i}".encode() for i in range(3, 7)} <= {x for x, _ in seen}


def test_quality_learns_from_whole_texts(spark):
    long = "".join(f"word {i} " for i in range(20_000)) + "é"
    docs = spark.createDataFrame([(1, long), (2, "b"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, quality int")
    seen = []
    train = quality.Network.train
    quality.Network.train = lambda self, texts, truth: seen.extend(texts)
    try:
        quality.fit(docs, labels)
    finally:
        quality.Network.train = train
    assert sorted(seen) == sorted([long.encode(), b"b", b""])


def test_quality_gradients():
    network = quality.Network()
    network.w = {k: v.astype(np.float64) for k, v in network.w.items()}
    draw = np.random.default_rng(3)
    texts = [draw.integers(1, 256, n).astype(np.uint8).tobytes() for n in (10, 300, quality.TOGETHER * 300)]
    chunks, bounds = quality.chunked(texts)
    given = [chunks[a:b] for a, b in zip(bounds, bounds[1:])], np.array([0.0, 1.0, 1.0]), quality.self_match(chunks)
    _, grads = network.step(*given)
    for name, value in network.w.items():
        for at in [tuple(draw.integers(1 if name == "embed" and i == 0 else 0, n) for i, n in enumerate(value.shape)) for _ in range(6)]:
            old, d, losses = value[at], 1e-5, []
            for x in (old + d, old - d):
                value[at] = x
                losses.append(network.step(*given)[0])
            value[at] = old
            assert (losses[0] - losses[1]) / (2 * d) == pytest.approx(float(grads[name][at]), abs=1e-4)


def test_quality_scores_are_the_plain_forward_pass(spark):
    """Scores of whole texts against loops over chunks, positions and distances."""
    network = quality.Network()
    w = {k: v.astype(np.float64) for k, v in network.w.items()}
    rnd = random.Random(4)
    texts = [None, "", "a", "ab " * 200, "".join(rnd.choice("abcde é\n") for _ in range(1500))]

    def plain(text):
        raw, starts = (text or "").encode(), [0]
        while starts[-1] + quality.CHUNK < len(raw):
            starts.append(starts[-1] + quality.STRIDE)
        rows = []
        for start in starts:
            part = raw[start:start + quality.CHUNK]
            row = part + bytes(quality.CHUNK - len(part))
            spots = [w["embed"][list(row[i:i + quality.REACH])].ravel() for i in range(quality.CHUNK - quality.REACH + 1)]
            values = [max(0.0, max(spot @ w["filters"][:, k] for spot in spots) + w["bias"][k]) for k in range(quality.FILTERS)]
            best = 0.0
            for lag in quality.LAGS:
                same = sum(part[i] == part[i - lag] for i in range(lag, len(part)))
                best = max(best, same / max(len(part) - lag, 32))
            rows.append(values + [min(1.0, best)])
        pooled = np.concatenate([np.max(rows, axis=0), np.mean(rows, axis=0)])
        out = np.tanh(pooled @ w["hidden"] + w["hidden_bias"]) @ w["out"] + w["out_bias"][0]
        return 1 / (1 + np.exp(-out))

    got = quality.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), network).collect()
    for r in got:
        assert r.score == pytest.approx(plain(texts[r.doc_id]), abs=1e-4)


def test_chunks_cover_all_bytes():
    for n in (0, 1, 255, 256, 257, 480, 481, 5000):
        text = bytes(random.Random(n).randrange(1, 256) for _ in range(n))
        chunks, bounds = quality.chunked([text, b"x"])
        got = b"".join(bytes(c[:quality.STRIDE]) for c in chunks[:bounds[1] - 1]) + bytes(chunks[bounds[1] - 1])
        assert got.rstrip(b"\0") == text and bounds[2] - bounds[1] == 1


# --- license scan


def test_licenses(docs, wide, empty):
    assert [(r.doc_id, r.license, r.containment) for r in licenses.licenses(wide).collect()] == [(14, "MIT", 1.0)]
    assert licenses.licenses(empty).count() == 0


def test_license_recall(spark):
    """Each phrase at every place, whole and with a word changed; clean texts beside them."""
    rnd, rows, expected = random.Random(5), [], set()
    for t, (name, phrase) in enumerate(licenses.TEMPLATES):
        for i in range(6):
            ws = [f"v{rnd.randrange(500)}" for _ in range(rnd.randrange(80))]
            at = rnd.randrange(len(ws) + 1)
            text = phrase.split()
            if i == 5 and len(text) > 25:
                text[0] = "changed"
            rows.append((t * 10 + i, " ".join(ws[:at] + text + ws[at:])))
            expected.add((t * 10 + i, name))
        rows.append((t * 10 + 9, " ".join(f"v{rnd.randrange(500)}" for _ in range(200))))
    got = licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert expected <= {(r.doc_id, r.license) for r in got.collect()}
    assert all(d % 10 != 9 for d, in as_set(got, "doc_id"))


# --- personal data

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub(r"\D", "", m)) <= 19 and pii.luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"\D", "", m)) <= 15),
)


def plain_spans(text):
    found = [
        (*m.span(), k) for k, (_, pattern, holds) in enumerate(PATTERNS) for m in re.finditer(pattern, text or "") if holds(m[0])
    ]
    return sorted(found, key=lambda x: (x[0], x[2]))


def test_base_spans():
    rnd = random.Random(3)
    for _ in range(20_000):
        text = "".join(rnd.choice("a@.1+2 -()9%b0\n") for _ in range(rnd.randint(0, 45)))
        assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "@a.b" * 100_000, "+1 " + "(" * 400_000, "a@" * 200_000):
        pii.base_spans(text)


def test_personal_data(docs, wide, empty, sample, rows):
    got = pii.personal_data(wide).collect()
    assert sorted((r.base for r in got)) == sorted(pii.told(plain_spans(r[1])) for r in rows)
    assert all(set(filter(None, r.base.split(","))) <= set(r.spans.split(",")) for r in got)
    assert pii.personal_data(empty).count() == 0
    found = pii.personal_data(sample).collect()
    texts = {r.doc_id: r.text for r in sample.collect()}
    assert all(r.base == pii.told(plain_spans(texts[r.doc_id])) for r in found)


def test_field_learns():
    field = pii.Field()
    field.train(pii.labelled_lines())
    held = pii.labelled_lines(times=4, seed=99)
    texts = [text for text, _ in held]
    found = pii.added_spans(field, texts, [[] for _ in texts])
    right = sum(
        sorted(x) == sorted(s for s in spans if s[2] != 2 or pii._is_card(text[s[0]:s[1]]))
        for x, (text, spans) in zip(found, held)
    )
    assert right >= 0.97 * len(held)


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(8)
    field = pii.Field()
    field.emit[:], field.move[:], field.open[:] = (draw.normal(0, 1, x.shape) for x in (field.emit, field.move, field.open))
    texts = ["a 12 +3", "", "at (dot) x@y.z 5", "one\ntwo 2\n\nthree"]
    ws = pii.Words(texts)
    got, emit = field.viterbi(ws), field.emissions(ws)
    for begin, end in zip(ws.lines, ws.lines[1:]):
        best = max(
            (sum(emit[begin + i][x] for i, x in enumerate(path)) + field.open[path[0]]
             + sum(field.move[a, b] for a, b in zip(path, path[1:])), path)
            for path in np.ndindex(*[len(pii.LABELS)] * (end - begin))
        )[1]
        assert tuple(got[begin:end]) == best


# --- BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.VOCABULARY)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


ODD = [
    "", "  ", "Hello's we'll 'S I'M", "ΣΑΣ Σ", "İstanbul", "<|endoftext|>a <|startoftext|>B<|endoftext|>", "é é Å ﬁ", "123 4½ ²",
    "\x1c\x1d a\x85b\xa0c​d e", "😀😃👩‍👩‍👧 漢字かな", "ab" * 3000 + "!" * 700, "ßẞ", "_foo-bar__baz\n\n\t x</w> </w>", "ǅ ŉ",
    "w</w>i n</w>", "don't'll've're'd'", "a" * 5000,
]


def test_encoder_equals_the_library(library, sample):
    with open(bpe.VOCABULARY, encoding="utf-8") as file:
        coder = bpe.Encoder(file.read())
    rnd = random.Random(1)
    texts = ODD + [r.text for r in sample.limit(150).collect()]
    texts += ["".join(rnd.choice(string.ascii_lowercase + "etaoinshr" * 3) for _ in range(rnd.randint(1, 40))) for _ in range(2000)]
    for text in texts:
        wanted = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == wanted, text[:60]
        assert coder.decode(coder.encode(text)) == library.decode(wanted, skip_special_tokens=False)


def test_encoded(wide, empty, library, rows):
    got = bpe.encoded(wide, bpe.VOCABULARY)
    expected = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        expected.append((r[0], np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in got.collect()), key=repr) == sorted(expected, key=repr)
    assert bpe.digests(bpe.encoded(empty, bpe.VOCABULARY)).count() == 0
    again = bpe.decoded(got.withColumnRenamed("decoded", "was"), bpe.VOCABULARY)
    assert again.filter("NOT was <=> decoded").count() == 0


# --- near-duplicates


def plain_shingles(text):
    ws = re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else Counter([tuple(ws)] if ws else [])


def plain_similarity(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared) if a and b else 0.0


def plain_classes(rows):
    """Class of each row by all pairs that share a shingle."""
    sets = [plain_shingles(text) for _, text in rows]
    at = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            at[x].add(i)
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for x in s for j in at[x] if j < i}:
            if plain_similarity(s, sets[j]) >= 0.8:
                top[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return [(d, min((x for x in least[find(i)] if x is not None), default=None), len(least[find(i)])) for i, (d, _) in enumerate(rows)]


def test_similarity():
    rnd = random.Random(2)
    for _ in range(100):
        a = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 60))]
        b = [x if rnd.random() < 0.9 else "z" for x in a]
        a, b = " ".join(a), " ".join(b)
        assert near.similarity([a], [b])[0] == pytest.approx(plain_similarity(plain_shingles(a), plain_shingles(b)))


def test_a_pair_is_compared_once(spark):
    """One Python worker a task: a second comparison in the plan would hold another one, with its memory."""
    base = " ".join(f"w{i}" for i in range(60))
    texts = spark.createDataFrame([(1, base), (2, base + " more"), (3, "other " * 9)], "node long, text string")
    links = near._linked(spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long"), texts)
    assert [tuple(r) for r in links.select("a", "b").collect()] == [(1, 2)]
    assert links._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_strings_of_a_batch():
    texts = [None, "", *(f"{i}ß" for i in range(200)), None]
    for array in (pa.array(texts, pa.string()), pa.array(["cut", *texts], pa.string())[1:]):
        assert list(strings(array)) == texts
    assert list(strings(pa.array([], pa.string()))) == []


def test_signatures_are_unbiased():
    draw, errors = np.random.default_rng(1), []
    for trial in range(150):
        a = [f"{trial}w{draw.integers(0, 40)}" for _ in range(200)]
        b = [x if draw.random() < 0.8 else f"{trial}x{draw.integers(0, 9)}" for x in a]
        values, counts, limits = shingles.multisets([" ".join(a), " ".join(b)], 1)
        first, second = near.signatures(values, counts, limits)
        errors.append((first == second).mean() - plain_similarity(Counter(a), Counter(b)))
    assert abs(np.mean(errors)) < 4 * np.std(errors) / len(errors) ** 0.5
    assert np.std(errors) < 0.06


def test_near_classes(wide, empty, rows):
    got = near.near_classes(wide)
    expected = plain_classes([r[:2] for r in rows])
    # a document without words is a class of its own row
    expected = [x if plain_shingles(r[1]) else (r[0], r[0], 1) for x, r in zip(expected, rows)]
    assert as_set(got, "doc_id", "class_id", "class_size") == sorted(expected, key=repr)
    assert near.near_classes(empty).count() == 0
    left = near.one_of_each(wide)
    assert left.columns == wide.columns
    assert left.count() == got.filter("kept").count()


def test_near_classes_on_documents(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert as_set(near.near_classes(sample), "doc_id", "class_id", "class_size") == sorted(plain_classes(rows), key=repr)


def test_near_large_group(spark):
    """A group of many near copies, and a passage that many other documents share."""
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(900)}" for _ in range(300)]
    passage = [f"p{rnd.randrange(900)}" for _ in range(60)]
    rows = []
    for i in range(400):
        ws = list(base)
        for _ in range(3):
            ws[rnd.randrange(300)] = f"e{i}x{rnd.randrange(9)}"
        rows.append((i, " ".join(ws)))
    rows += [(1000 + i, " ".join(passage + [f"q{rnd.randrange(5000)}" for _ in range(100)])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert as_set(near.near_classes(docs), "doc_id", "class_id", "class_size") == sorted(plain_classes(rows), key=repr)


def test_near_pairs_inside_an_unlike_family(spark):
    """Texts around one passage, too unlike to be linked but for a few; and a family of middling similarity."""
    rnd = random.Random(4)
    core = [f"c{rnd.randrange(10**6)}" for _ in range(204)]

    def around(i, own):
        return " ".join(core + [f"o{i}x{k}" for k in range(own)])

    rows = [(i, around(i, 60)) for i in range(400)] + [(1000 + i, around(1000 + i, 20)) for i in range(6)]
    base = [f"b{rnd.randrange(10**6)}" for _ in range(300)]
    for i in range(150):
        ws = list(base)
        for k in rnd.sample(range(300), rnd.randrange(4, 12)):
            ws[k] = f"e{i}x{k}"
        rows.append((2000 + i, " ".join(ws)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert as_set(near.near_classes(docs), "doc_id", "class_id", "class_size") == sorted(plain_classes(rows), key=repr)


def test_near_heads_are_few_and_hold_all_similar_pairs(spark, monkeypatch):
    """Only the shingles at which similar texts of different labels can meet leave the tasks, also where shingles share a cell."""
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(40):
        words = list(base)
        for k in rnd.sample(range(300), rnd.choice([1, 4, 12])):
            words[k] = f"x{i}y{k}"
        rows.append((i, len(words) - 4, i if i % 4 == 0 else 1, " ".join(words)))
    like = {
        (a[0], b[0]) for a in rows for b in rows
        if a[2] != b[2] and near.similarity([a[3]], [b[3]])[0] >= near.SIMILAR
    }
    for cells in (1 << 20, 64):
        monkeypatch.setattr(near, "CELLS", cells)
        heads = defaultdict(dict)
        for r in near._heads(spark.createDataFrame(rows, "node long, weight long, label long, text string").repartition(3)).collect():
            heads[r.node][r.shingle] = r.rest
        assert sum(map(len, heads.values())) < 0.4 * sum(r[1] for r in rows)
        assert like and all(
            any(min(heads[a][t], heads[b][t]) * (1 + near.SIMILAR) >= near.SIMILAR * 2 * 296 - 1e-6 for t in heads[a].keys() & heads[b].keys())
            for a, b in like
        )


def test_components(spark):
    rnd = random.Random(6)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(70)]
    top = {}

    def find(i):
        while top.setdefault(i, i) != i:
            i = top[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    got = {r.node: r.label for r in near.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: find(i) for i in list(top)}


# --- shards


def check_shards(frame, rows, tolerance):
    got = frame.collect()
    assert len(got) == len(rows)
    sizes = sorted((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows if r[0] is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got if r.doc_id is not None) == sizes
    total, per, slots = sum(r["size"] for r in got), Counter(), defaultdict(list)
    for r in got:
        per[r["shard"]] += r["size"]
        slots[r["shard"]].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert set(per) <= set(range(16))
    assert max(per.values()) <= total / 16 + tolerance and (len(rows) < 500 or min(per.values()) >= total / 16 - tolerance)


def test_shards(wide, empty, sample, rows):
    largest = max(len((r[1] or "").encode()) for r in rows)
    check_shards(shards.shard(wide), rows, 2 * largest)
    assert shards.shard(empty).count() == 0
    documents = [(r.doc_id, r.text) for r in sample.collect()]
    check_shards(shards.shard(sample), documents, 2 * max(len(t.encode()) for _, t in documents))


def test_shards_hot_text(spark):
    rows = [(i, "same text" if i % 2 else f"text {i}") for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check_shards(shards.shard(frame, rows_per_task=20), rows, 400)


def test_shards_of_equal_rows(spark):
    """Rows that agree in text and doc_id, or have none, are cut like others; one giant row stays whole."""
    for doc_id in (7, None):
        rows = [(doc_id, "the same row")] * 3200
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = Counter(r["shard"] for r in shards.shard(frame).collect())
        assert set(got) == set(range(16)) and max(got.values()) - min(got.values()) <= 2
    rows = [(1, "x" * 20_000)] + [(2, "some text")] * 2000 + [(k, f"text {k}") for k in range(3, 2000)]
    check_shards(shards.shard(spark.createDataFrame(rows, "doc_id long, text string")), rows, 20_001)


def test_language_without_ids(spark):
    """A language is learned though all its rows have no doc_id, or the same one."""
    english = [(None, f"the {k} houses and the river where people were walking {k}", "en") for k in range(6000)]
    german = [(k, f"die {k} Häuser und der Fluss, an dem die Leute gingen {k}", "de") for k in range(500)]
    french = [(3, f"les {k} maisons et le fleuve où les gens marchaient {k}", "fr") for k in range(3000)] + [(4, "tout le même", "fr")] * 3000
    docs = spark.createDataFrame(english + german + french, "doc_id long, text string, lang string").repartition(4)
    network, labels = language.fit(docs)
    assert labels == ["de", "en", "fr"]
    found = {r.text: r.p for r in docs.dropDuplicates(["text"]).join(
        language.predicted(docs.select(F.col("text").alias("doc_id"), "text"), network, labels).select(
            F.col("doc_id").alias("text"), F.col("lang_pred").alias("p")).distinct(), "text").collect()}
    truth = {t: lang for _, t, lang in english + german + french}
    assert set(found) == set(truth) and sum(found[t] == lang for t, lang in truth.items()) > 0.95 * len(truth)


def plain_probabilities(network, text):
    """The network's forward pass, a position at a time, over the windows of a text."""
    w, n = network.weights, network.units
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    raw, total = text.encode(), 0
    for at in range(0, len(raw), language.SPAN):
        piece = raw[at:at + language.SPAN]
        padded, states = piece.ljust(language.SPAN, b"\0"), {}
        for side in "fb":
            h, seen = np.zeros(n), {}
            for t in range(language.SPAN) if side == "f" else reversed(range(language.SPAN)):
                given, past = w[f"{side}_in"][padded[t]], h @ w[f"{side}_re"]
                update, reset = sigmoid(given[:n] + past[:n]), sigmoid(given[n:2 * n] + past[n:2 * n])
                h = h + update * (np.tanh(given[2 * n:] + reset * past[2 * n:]) - h)
                seen[t] = h
            states[side] = seen
        for t in range(len(piece)):
            share = np.exp(np.concatenate([states["f"][t], states["b"][t], [1.0]]) @ w["out"])
            total = total + share / share.sum()
    return total / len(raw)


def test_language_forward(spark):
    network = language.Network(3, seed=11)
    texts = ["Ünïcödé and some more words, over several windows of bytes " * 4, "short", "x" * 64, "y" * 65]
    got = language.probabilities(network, [t.encode() for t in texts])
    assert np.allclose(got, [plain_probabilities(network, t) for t in texts], atol=1e-4)


def test_words_end_at_ascii_blanks_only(spark):
    """Other blanks are letters of a word to every rule, as in the query's SQL."""
    import duckdb

    from tributary.llm import queries

    rows = [(i, " ".join(x * 60)) for i, x in enumerate((
        ["LOUD quiet"], ["LOUD quiet", "so"], ["A\u0085b"], ["A\u001cb", "\u001d"], ["A B"], ["SHOUT"], [" "], ["ß", "ǅ", "İi"],
    ))]
    got = rules.judged(rules.ledger(spark.createDataFrame(rows, "doc_id long, text string")))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cursor = con.execute(queries.ORACLES["op8_quality_rules"])
    names = [d[0] for d in cursor.description]
    want = sorted((r[names.index("doc_id")], r[names.index("failed_bits")], r[names.index("kept")]) for r in cursor.fetchall())
    assert as_set(got, "doc_id", "failed", "kept") == want


def test_exact_row_repeated(spark):
    """One row repeated very often is dealt over all its salts, and one of it stays."""
    rows = [(5, "The same")] * 20_000 + [(k, "the SAME") for k in (1, 9, 9)] + [(None, "the same"), (3, "another")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = exact.exact_groups(docs)
    assert as_set(got, "doc_id", "keep_id", "group_size", "text_sha256") == plain_exact(rows)
    assert got.filter("kept").count() == 2 and exact.distinct_texts(docs).count() == 2


def by_sql(name, rows, columns="doc_id BIGINT, text VARCHAR, source VARCHAR"):
    """A query's SQL over some rows."""
    import duckdb

    from tributary.llm import queries

    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents({columns})")
    con.executemany(f"INSERT INTO documents VALUES ({', '.join('?' * len(rows[0]))})", rows)
    cursor = con.execute(queries.ORACLES[name])
    return [d[0] for d in cursor.description], cursor.fetchall()


def test_sibling_licenses(spark):
    """A notice is of the version that it names, wherever windows cut it; two notices are two."""
    gpl = "licensed under the GNU General Public License, version {}"
    rows = [(100 * v + shift, "pad " * shift + gpl.format(v) + " and more words follow here " * 3, "s") for v in (2, 3) for shift in range(40)]
    rows += [(900, gpl.format(2) + " " + "pad " * 5 + gpl.format(3), "s"), (901, gpl.format(4), "s"), (902, "Licensed under CC BY-NC 4.0", "s")]
    got = licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    names, want = by_sql("op5_license_scan", rows)
    assert as_set(got, *names) == sorted(want, key=repr)
    found = defaultdict(set)
    for r in got.collect():
        found[r.doc_id].add(r.license)
    assert all(found[100 * v + shift] == {f"GPL-{v}.0"} for v in (2, 3) for shift in range(40))
    assert found[900] == {"GPL-2.0", "GPL-3.0"} and found[902] == {"CC-BY-NC-4.0"}


@pytest.mark.parametrize("large, small", [(400_000, 30), (520, 40)])
def test_mix_by_sql(spark, large, small):
    """Sources of few blocks, or of none but one word, have their targets in the code and in the SQL."""
    rows = [(k, "word " * 130, f"s{k % 3}") for k in range(large // 130)] + [(10**6 + k, "few words here", "tiny") for k in range(small // 3)]
    documents, _ = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    names, want = by_sql("op1_mixing", rows)
    assert as_set(documents, *names) == sorted(want, key=repr)
    taken = sum(r.taken for r in documents.filter("source = 'tiny'").collect())
    assert abs(taken - min(3 * small, documents.filter("source = 'tiny'").first().target)) <= 1
