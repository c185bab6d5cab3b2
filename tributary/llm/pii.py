"""Personal data: fixed patterns, and a linear-chain conditional random field for what they miss.

Base spans are the matches of four patterns. A conditional random field over word-shape features reads every
line of every text: it is trained on the driver from a small labelled table, and lines are decoded by Viterbi
in numpy batches. Where it sees an address, a number or a card in another spelling, as ``name (at) host (dot) org``
or a phone number without a plus, and the digits or parts are right for the kind, the span is added, unless it
touches a base span. Base spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tributary.llm.common import in_lots

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{part}-{kind}" for kind in KINDS for part in "BI"))

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match of digits and dots starts and ends with a whole run of digits
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])) % 10 == 0


def _is_card(text: str) -> bool:
    digits = "".join(_DIGITS.findall(text))
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 10 <= sum("0" <= c <= "9" for c in text) <= 15


def _is_ip(text: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the patterns' matches, by start and then kind. Each pattern takes time linear in the text."""
    found, last = [], 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            found.append((start, m.end(), 0))
            last = m.end()
    found += [(*m.span(), 1) for m in _IP.finditer(text) if _is_ip(m[0])]
    found += [(*m.span(), 2) for m in _CARD.finditer(text) if 14 <= m.end() - m.start() <= 37 and _is_card(m[0])]
    found += [(*m.span(), 3) for m in _PHONE.finditer(text) if _is_phone(m[0])]
    return sorted(found, key=lambda x: (x[0], x[2]))


# The labelled table: lines with marked spans. {a}: a name, {h}: a host word, {w}: any word, {n}: digits 0-9 for each #.
LABELLED = (
    "write to <email>{a} (at) {h} (dot) org</email> for {w} {w}",
    "mail: <email>{a} [at] {h} [dot] com</email>",
    "{w} <email>{a} at {h} dot com</email> {w} {w}",
    "reach me under <email>{a}.{a} at {h} dot net</email> or by post",
    "contact <email>{a}(at){h}.example.com</email> , {w}",
    "{w} {w} <email>{a}[at]{h}[dot]org</email>",
    "e-mail <email>{a} (at) {h}.com</email> {w}",
    "call <phone>(###) ###-####</phone> after {w}",
    "phone <phone>###-###-####</phone> {w} {w}",
    "tel. <phone>0## #### ####</phone>",
    "tel <phone>0##/#######-#</phone> {w}",
    "fax: <phone>00## ## ### ####</phone> {w}",
    "mobile <phone>0### ### ####</phone> or {w}",
    "ring <phone>(0##) #### ####</phone> {w} {w}",
    "{w} <phone>+# (###) ###-####</phone> ###.##.#.### {w}",
    "{w} <phone>+## ### ### ####</phone> ################ {w}",
    "card <card>####.####.####.####</card> {w}",
    "visa <card>####_####_####_####</card>",
    "card number <card>#### #### #### ####</card> {w} {w}",
    "host <ip>##[.]##[.]##[.]##</ip> {w}",
    "server <ip>1##[.]##[.]#[.]##</ip> is {w}",
    "{w} {w} at {w} {w} .",
    "{w} at {w} , {w} {w} {w}",
    "{w} the dot {w} at {h} {w}",
    "{w} {w} {w} {w} {w} {w} .",
    "{w} ### {w} ## {w}",
    "in 20## {w} {w} 19## .",
    "version #.#.# of {w} {w}",
    "{w} {w} ################ {w}",
    "{w} ######### {w} {w}",
    "{w} ## % of ### , ### {w}",
    "page ### - ### {w}",
    "call {w} at {w} for {w}",
    "card {w} {w} and mail {w}",
    "{w} ##/##/20## {w}",
    "order no. ######-## {w} {w}",
    "{w} (##) {w} (###) {w}",
    "at ##:## {w} {w} phone {w}",
    "#.# {w} , #.## {w} ; ### {w}",
    "{w} | {w} | {w} | ## | {w}",
    "{w}*** {w}%%% {w}&&& {w}$$$",
    "{w}!! {w}!! ###!! {w}!!",
)
_NAMES = "ana bert carla dora emil fritz gina hugo jane john maria otto paul rosa tom vera".split()
_HOSTS = "mail post example inbox web site office server".split()
_WORDS = "the of and is on with for house tree river light stone green walk letter paper music water".split()
#: Words with a feature of their own.
CUES = (
    "at dot (at) [at] {at} (dot) [dot] {dot} tel tel. tel: phone phone: call fax fax: mobile ring mail mail: e-mail email"
    " contact write reach card visa number host server ip org com net"
).split()


def labelled_lines(table: tuple[str, ...] = LABELLED, times: int = 12, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Lines and their spans: each line of the table, its slots filled by a seeded draw, a number of times."""
    draw, out = np.random.default_rng(seed), []
    fill = {"a": _NAMES, "h": _HOSTS, "w": _WORDS}
    for _ in range(times):
        for line in table:
            line = re.sub(r"\{([ahw])\}", lambda m: str(draw.choice(fill[m[1]])), line)
            line = re.sub("#", lambda _: str(draw.integers(0, 10)), line)
            text, spans, at = "", [], 0
            for m in re.finditer(r"<(\w+)>(.*?)</\1>", line):
                text += line[at:m.start()]
                spans.append((len(text), len(text) + len(m[2]), KINDS.index(m[1])))
                text, at = text + m[2], m.end()
            out.append((text + line[at:], spans))
    return out


_LETTER, _DIGIT, _AT, _DOT, _DASH, _BRACKET, _PLUS, _OTHER = (1 << i for i in range(8))
_FLAGS = np.full(256, _OTHER, np.uint8)
for _chars, _flag in (
    ("0123456789", _DIGIT), ("@", _AT), (".", _DOT), ("-/_", _DASH), ("()[]{}", _BRACKET), ("+", _PLUS), (",;:!?'\"", 0),
):
    _FLAGS[[ord(c) for c in _chars]] = _flag
_FLAGS[[*range(65, 91), *range(97, 123), *range(0xC0, 256)]] = _LETTER
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[*range(33), 0x85, 0xA0]] = True
_CUE_KEYS = np.array([int.from_bytes(x.encode(), "little") for x in CUES], np.uint64)
_CUE_ORDER = np.argsort(_CUE_KEYS)
_LENGTHS = np.digitize(np.arange(41), [2, 3, 4, 5, 9, 13])
_DIGITS_OF = np.digitize(np.arange(41), [1, 2, 3, 4, 5, 10, 14, 20])
#: Values of each feature: shape, size, cue, and shape and cue of the words before and after.
SIZES = (256, 7 * 9, len(CUES) + 1, 257, 257, len(CUES) + 2, len(CUES) + 2)


class Words:
    """The words of some texts, their places and their feature values; a line is a sequence."""

    def __init__(self, texts: list[str]) -> None:
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
        self.base = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])])
        codes = np.minimum(codes, 255).astype(np.uint8)
        edge = np.flatnonzero(np.diff(~_BLANK[codes], prepend=False, append=False))
        self.start, self.end = edge[::2], edge[1::2]
        n = len(self.start)
        line = np.searchsorted(np.flatnonzero(codes == 10), self.start)
        opens = np.flatnonzero(np.diff(line, prepend=-1)) if n else np.zeros(0, np.int64)
        self.lines = np.append(opens, n)
        self.features = np.zeros((len(SIZES), n), np.int64)
        if not n:
            return
        pairs = np.minimum(edge, len(codes) - 1)
        flags = _FLAGS[codes]
        # the end of the last word may be the end of the codes
        shape = np.bitwise_or.reduceat(flags, pairs)[::2]
        digits = np.add.reduceat((flags == _DIGIT).astype(np.int64), pairs)[::2]
        size = self.end - self.start
        key = np.zeros(n, np.uint64)
        for k in range(8):
            here = np.minimum(self.start + k, len(codes) - 1)
            key |= np.where(k < size, _LOWER[codes[here]], np.uint64(0)) << np.uint64(8 * k)
        at = np.minimum(np.searchsorted(_CUE_KEYS, key, sorter=_CUE_ORDER), len(CUES) - 1)
        cue = np.where((_CUE_KEYS[_CUE_ORDER[at]] == key) & (size <= 8), _CUE_ORDER[at] + 1, 0)
        f = self.features
        f[0], f[1], f[2] = shape, _LENGTHS[np.minimum(size, 40)] * 9 + _DIGITS_OF[np.minimum(digits, 40)], cue
        first, last = self.lines[:-1], self.lines[1:] - 1
        f[3, 1:], f[4, :-1], f[5, 1:], f[6, :-1] = shape[:-1], shape[1:], cue[:-1], cue[1:]
        f[3, first], f[4, last], f[5, first], f[6, last] = 256, 256, len(CUES) + 1, len(CUES) + 1


def _in_step(lines: np.ndarray) -> Iterator[np.ndarray]:
    """The t-th word of every line that has one, for t = 0, 1, ...; longer lines first, so they stay in front."""
    size = np.diff(lines)
    order = np.argsort(-size, kind="stable")
    begin, size = lines[:-1][order], size[order]
    live = len(size)
    for t in range(int(size[0]) if len(size) else 0):
        while size[live - 1] <= t:
            live -= 1
        yield begin[:live] + t


class Field:
    """Weights of a linear chain: of each feature value and label, and of each pair of labels in a row."""

    def __init__(self) -> None:
        k = len(LABELS)
        self.offsets = np.concatenate([[0], np.cumsum(SIZES)])
        self.emit = np.zeros((self.offsets[-1], k))
        self.move, self.open = np.zeros((k, k)), np.zeros(k)

    def emissions(self, words: Words) -> np.ndarray:
        total = np.zeros((words.features.shape[1], len(LABELS)), np.float32)
        table = self.emit.astype(np.float32)
        for values, offset in zip(words.features, self.offsets):
            total += table.take(values + offset, axis=0)
        return total

    def viterbi(self, words: Words) -> np.ndarray:
        """The best label of each word."""
        emit, n = self.emissions(words), words.features.shape[1]
        back, best = np.zeros((n, len(LABELS)), np.uint8), np.zeros(n, np.uint8)
        move, score, steps, ends = self.move.astype(np.float32), None, [], []
        for now in _in_step(words.lines):
            if score is None:
                score = self.open.astype(np.float32) + emit[now]
            else:
                ends.append(score[len(now):].argmax(axis=1))
                ways = score[:len(now), :, None] + move
                back[now] = ways.argmax(axis=1)
                score = ways.max(axis=1) + emit[now]
            steps.append(now)
        if score is None:
            return best
        ends.append(score.argmax(axis=1))
        at = ends.pop()
        best[steps[-1]] = at
        for t in range(len(steps) - 1, 0, -1):
            at = np.concatenate([back[steps[t], at], ends.pop()])
            best[steps[t - 1]] = at
        return best

    def train(self, lines: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 120, penalty: float = 0.02) -> None:
        """Gradient ascent (Adam) on the log-likelihood of the labelled lines, less a squared penalty."""
        words = Words([text for text, _ in lines])
        truth = np.zeros(len(words.start), np.int64)
        for i, (_, spans) in enumerate(lines):
            for start, end, kind in spans:
                inside = (words.start >= words.base[i] + start) & (words.start < words.base[i] + end)
                truth[inside] = 2 + 2 * kind
                truth[np.flatnonzero(inside)[:1]] = 1 + 2 * kind
        steps, k = list(_in_step(words.lines)), len(LABELS)
        first = [np.zeros_like(x) for x in (self.emit, self.move, self.open)]
        second = [np.zeros_like(x) for x in first]
        for i in range(1, rounds + 1):
            emit = self.emissions(words).astype(np.float64)
            ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
            ahead[steps[0]] = self.open + emit[steps[0]]
            for before, now in zip(steps, steps[1:]):
                ahead[now] = np.logaddexp.reduce(ahead[before[:len(now)], :, None] + self.move, axis=1) + emit[now]
            for before, now in zip(reversed(steps[:-1]), reversed(steps[1:])):
                behind[before[:len(now)]] = np.logaddexp.reduce(self.move + (emit[now] + behind[now])[:, None, :], axis=2)
            whole = np.zeros(len(emit))
            whole[steps[0]] = np.logaddexp.reduce(ahead[steps[0]] + behind[steps[0]], axis=1)
            for before, now in zip(steps, steps[1:]):
                whole[now] = whole[before[:len(now)]]
            likely = np.exp(ahead + behind - whole[:, None])
            likely[np.arange(len(truth)), truth] -= 1
            g_emit, g_move, g_open = np.zeros_like(self.emit), np.zeros_like(self.move), likely[steps[0]].sum(axis=0)
            for values, offset in zip(words.features, self.offsets):
                np.add.at(g_emit, values + offset, likely)
            for before, now in zip(steps, steps[1:]):
                both = before[:len(now)]
                pair = ahead[both][:, :, None] + self.move + (emit[now] + behind[now])[:, None, :] - whole[now][:, None, None]
                g_move += np.exp(pair).sum(axis=0)
                np.subtract.at(g_move, (truth[both], truth[now]), 1)
            for j, (value, gradient) in enumerate(zip((self.emit, self.move, self.open), (g_emit, g_move, g_open))):
                gradient = gradient / len(lines) + penalty / 100 * value
                first[j] += 0.1 * (gradient - first[j])
                second[j] += 0.01 * (gradient**2 - second[j])
                value -= 0.1 * first[j] / (1 - 0.9**i) / (np.sqrt(second[j] / (1 - 0.99**i)) + 1e-8)


_SPELLED = re.compile(
    r"[A-Za-z0-9._%+-]+ ?(?:\(at\)|\[at\]|\{at\}|(?<= )at(?= )) ?[A-Za-z0-9-]+(?: ?(?:\(dot\)|\[dot\]|\{dot\}|(?<= )dot(?= )|\.) ?[A-Za-z0-9-]+)+",
    re.IGNORECASE,
)
_HELD = (
    lambda x: _SPELLED.fullmatch(x) is not None,
    lambda x: re.fullmatch(r"[0-9]+(?: ?\[\.\] ?[0-9]+){3}", x) is not None and _is_ip(re.sub(r"[ \[\]]", "", x)),
    lambda x: re.fullmatch(r"[0-9][0-9 ._/-]+[0-9]", x) is not None and _is_card(x),
    lambda x: re.fullmatch(r"[+(]*[0-9]+[ ()/-][0-9 ()/-]*[0-9]", x) is not None and _is_phone(x),
)


def added_spans(field: Field, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """For each text the spans that the field finds besides the base spans, of the right form for their kind."""
    words = Words(texts)
    labels = field.viterbi(words)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    marked = np.flatnonzero(labels)
    of = np.searchsorted(words.base, words.start[marked], side="right") - 1
    opens = np.zeros(len(labels), bool)
    opens[words.lines[:-1]] = True
    at = 0
    while at < len(marked):
        kind, to = (labels[marked[at]] - 1) // 2, at + 1
        while to < len(marked) and marked[to] == marked[to - 1] + 1 and labels[marked[to]] == 2 + 2 * kind and not opens[marked[to]]:
            to += 1
        i = int(of[at])
        start, end = int(words.start[marked[at]] - words.base[i]), int(words.end[marked[to - 1]] - words.base[i])
        text = texts[i]
        while end > start and not text[end - 1].isalnum() and text[end - 1] not in ")]":
            end -= 1
        while start < end and not text[start].isalnum() and text[start] not in "([+":
            start += 1
        if _HELD[kind](text[start:end]) and not any(s < end and start < e for s, e, _ in base[i]):
            out[i].append((start, end, int(kind)))
        at = to
    return out


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda x: (x[0], x[2])))


def personal_data(docs: DataFrame, table: tuple[str, ...] = LABELLED) -> DataFrame:
    """One row per document: doc_id, base and spans, each as kind:start:end joined by commas, by start and then kind;
    places count code points, ends are exclusive. ``base`` are the patterns' matches, ``spans`` those and the field's.
    Null and empty texts have none; equal rows get equal spans; an empty table gives no rows."""
    field = Field()
    field.train(labelled_lines(table))

    @F.pandas_udf(T.StructType([T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())]))
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            rows = []
            for texts in in_lots(series):
                base = [base_spans(x) for x in texts]
                more = added_spans(field, texts, base)
                rows += [(told(x), told(x + y)) for x, y in zip(base, more)]
            yield pd.DataFrame(rows, columns=["base", "spans"], dtype=object)

    return docs.select("doc_id", find(F.col("text")).alias("f")).select("doc_id", "f.*")
