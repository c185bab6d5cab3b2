"""Alignment against a plain version with the libraries' own encoders."""

import hashlib
import json
import random
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from test_llm_operators import as_set
from tributary.llm import align, bpe, queries

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(align.BYTE_VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=align.PIECE_VOCABULARY)
    byte = {letter: k for k, letter in enumerate(bpe.byte_letters())}

    def groups(text):
        if not text:
            return []
        tokens = [(k, bytes(byte[x] for x in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
        pieces = []
        for k in b.encode(text):
            piece = b.id_to_piece(k)
            pieces.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        if b"".join(x for _, x in tokens) != raw or b"".join(x for _, x in pieces) != raw:
            return []
        ends = [set(np.cumsum([len(x) for _, x in some]).tolist()) for some in (tokens, pieces)]
        both, out = sorted(ends[0] & ends[1]), []
        for some in (tokens, pieces):
            at, of = 0, defaultdict(list)
            for k, x in some:
                of[bisect_right(both, at)].append(k)
                at += len(x)
            out.append([of[g] for g in range(len(both))])
        return list(zip(*out))

    def result(rows):
        found = [(doc_id, groups(text)) for doc_id, text in rows]
        counts = Counter()
        for _, gs in found:
            counts.update({(x, y) for left, right in gs for x in left for y in right})
        best = defaultdict(int)
        for (x, _), n in counts.items():
            best[x] = max(best[x], n)
        out = []
        for doc_id, gs in found:
            links = [(x, y) for left, right in gs for x in left for y in right]
            told = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in gs)
            out.append((
                doc_id, sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), len(links),
                sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(told.encode()).hexdigest() if gs else "",
            ))
        return sorted(out, key=repr)

    return result


TEXTS = [
    "▁ is a blank to the one", "<|endoftext|> <s> </s> <unk> <0x0A>", "  two  blanks\n\nand lines \t", "x" * 3000, "日本語のテキスト 🙂🙃",
    "\x00 nul", " ", "ends in a blank ", "don't they're I'M", "1234567890 3.14159", "é́ ﬁ Ⅷ ½ ﷺ", "  　 odd blanks", "ⅷ͸ unassigned",
]


def test_query(spark, plain):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = queries.QUERIES["op13_alignment"](spark, SF_DIR)
    assert got.columns == COLUMNS
    assert as_set(got, *COLUMNS) == plain([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("block", [40, align.BLOCK])
def test_alignment(spark, wide, rows, plain, block, monkeypatch):
    given = [r[:2] for r in rows] if block == align.BLOCK else [(i, x) for i, x in enumerate([*TEXTS, *TEXTS[:3], None])]
    docs = wide if block == align.BLOCK else spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    assert as_set(align.alignment(docs, block=block), *COLUMNS) == plain(given)


def test_empty(empty):
    assert align.alignment(empty).count() == 0


def test_long_texts(monkeypatch):
    """Parts of a long text have the tokens of the whole."""
    with open(align.BYTE_VOCABULARY, encoding="utf-8") as file:
        a = align.ByteTokens(file.read())
    with open(align.PIECE_VOCABULARY, "rb") as file:
        b = align.PieceTokens(file.read())
    text = "Some words, and 12 more; they're  odd\nlines with blanks and ünïcödé here " * 40
    whole = [v.whole(text).tolist() for v in (a, b)]
    monkeypatch.setattr(align, "LONG", 25)
    assert [v.whole(text).tolist() for v in (a, b)] == whole


def test_wide_groups(monkeypatch):
    """Groups expanded by distinct ids give the links of single tokens."""
    rnd = np.random.default_rng(3)
    of_a, of_b = np.sort(rnd.integers(0, 6, 200)), np.sort(rnd.integers(0, 6, 300))
    a, b = rnd.integers(0, 9, 200), rnd.integers(0, 9, 300)

    def links():
        out = Counter()
        for x, y, g, n in zip(*align.expanded(a, b, of_a, of_b, 6)):
            out[int(g), int(x), int(y)] += int(n)
        return out

    single = links()
    monkeypatch.setattr(align, "WIDE", 10)
    assert links() == single


def test_coalesced():
    rnd = random.Random(5)
    for _ in range(100):
        starts, ends = [], []
        for _ in range(2):
            cuts = sorted(rnd.sample(range(1, 40), rnd.randint(1, 20)))
            starts.append([0, *cuts])
            ends.append([*cuts, 40])
        both = sorted(set(ends[0]) & set(ends[1]))
        group = align.coalesced(np.array(starts[0] + starts[1]), np.array(ends[0] + ends[1]), np.repeat([0, 1], [len(starts[0]), len(starts[1])]))
        assert group.tolist() == [sum(e <= s for e in both) for s in starts[0] + starts[1]]


def test_other_vocabularies_are_refused():
    with open(bpe.VOCABULARY, encoding="utf-8") as file:
        spec = file.read()
    with pytest.raises((ValueError, KeyError, TypeError)):
        align.ByteTokens(spec)
    with open(align.BYTE_VOCABULARY, encoding="utf-8") as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError, match="byte-level"):
        align.ByteTokens(json.dumps(spec))
