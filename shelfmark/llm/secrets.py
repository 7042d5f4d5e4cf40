"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds spans.

The field tags each token of a line as outside, begin or inside of a secret, from the
token's shape, its neighbouring words and features of its file, decoded by Viterbi. It is
trained here, on lines of a bounded sample of texts: with the values that the patterns find, with
planted secrets of many forms that no pattern matches, and with planted lines that only look like them.

Every line of every text is tagged, whatever it holds. Candidates (tokens of at least CANDIDATE bytes with a digit, or of
ASCII letters in both cases that change at least twice) only weigh in the choice of training lines.
"""

from __future__ import annotations

import base64
import re
import string
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import give_back_memory, text_column
from .words import chunks, mix, text_bytes

#: Fixed patterns; the kinds' order decides ties. Matches that are too short are dropped.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "crf")
#: The training sample: so many texts, each of at most so many characters.
SAMPLE_TEXTS, SAMPLE_CHARS = 600, 20_000
#: Lines that are made for training: with a planted secret, with a look-alike; and lines of the sample as they are.
PLANTED_LINES, LOOKALIKE_LINES, PLAIN_LINES = 1200, 900, 1200
#: Tokens of a training line at most: those around what it holds.
LINE_TOKENS = 24
#: Bytes of a token that may be a secret.
CANDIDATE = 8
O, B, I = 0, 1, 2  # noqa: E741
_WORDS = 1 << 16
#: Where each kind of feature begins: shape, mixture, gap, file, word before, word after, word before with gap.
_AT = np.cumsum([0, 512, 512, 16, 64, _WORDS, _WORDS, _WORDS])
N_FEATURES = int(_AT[-1])


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the value) of the fixed patterns, in order."""
    found, low = [], text.lower()
    if any(word in low for word in ("passw", "secret", "token", "api")):  # much faster than the pattern
        found += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Tokens(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    line: np.ndarray  # number of the token's line; lines never cross texts
    features: np.ndarray  # (token, kind of feature)


# character classes: 0 separator, 1 lower, 2 upper, 3 digit, 4 symbol of a value, 5 beyond ASCII
_CLASS = np.zeros(129, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128] = 1, 2, 3, 5
_CLASS[[ord(c) for c in "+/_.-"]] = 4
_GAP = np.zeros(129, dtype=np.uint8)  # bits: assignment, quote, other mark, line break
_GAP[[ord(":"), ord("=")]], _GAP[[ord("'"), ord('"'), ord("`")]] = 1, 2
_GAP[[c for c in range(33, 127) if not _CLASS[c] and not _GAP[c]]] = 4
_GAP[[10, 13]] = 8
_KIND = np.concatenate([_CLASS[:128], np.full(128, 5, np.uint8)])  # of bytes
_DIGIT, _MARK = _KIND == 3, np.concatenate([(_GAP[:128] > 0) & (_GAP[:128] < 8), np.zeros(128, bool)])
_POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(63, 0x9E3779B97F4A7C15, dtype=np.uint64)]), dtype=np.uint64)


def file_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A number for each text: its shares of digits and of marks, in four steps each."""
    out = np.zeros(len(offsets) - 1, dtype=np.int64)
    size = np.maximum(np.diff(offsets), 1)
    for weight, flags, steps in ((4, _DIGIT, [0.01, 0.03, 0.1]), (1, _MARK, [0.03, 0.06, 0.12])):
        total = np.concatenate([[0], np.cumsum(flags[data], dtype=np.int32)])
        out += weight * np.digitize((total[offsets[1:]] - total[offsets[:-1]]) / size, steps)
    return out


def tokenize(texts: list[str], file: np.ndarray | None = None) -> Tokens:
    """Tokens of the texts joined by line breaks; positions count code points of the joined text.

    ``file``: the features of the file that each text comes from; without, it is one by itself.
    """
    if file is None:
        file = file_features(*text_bytes(pa.array(texts, pa.string())))
    cp = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype=np.uint32)
    low = np.minimum(cp, 128).astype(np.uint8)
    kind = _CLASS[low]
    body = kind > 0
    edge = np.diff(np.concatenate([[0], body.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(start)
    if not n:
        return Tokens(start, end, start, np.zeros((0, 7), np.int64))

    def per_token(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return total[end] - total[start]

    size = end - start
    lower, upper, digit, symbol, wide = (per_token(kind == k) for k in (1, 2, 3, 4, 5))
    turns = per_token(np.concatenate([[True], kind[1:] != kind[:-1]]))  # changes of class, the first counts one
    # the gap before each token, from the token before it or the line's begin: what other lines and texts hold does not count
    marks = _GAP[low]
    gap = np.zeros(n, dtype=np.int64)
    behind = np.concatenate([[0], np.flatnonzero(marks == 8) + 1])
    behind = behind[np.searchsorted(behind, start, "right") - 1]
    ended = np.concatenate([[-1], end[:-1]])
    breaks = behind > ended
    since = np.maximum(behind, ended)
    for bit in (1, 2, 4):
        total = np.concatenate([[0], np.cumsum((marks & bit) > 0, dtype=np.int32)])
        gap += bit * (total[start] > total[since])
    line = np.cumsum(breaks) - 1
    # word hashes: of the first and last 32 characters at most, as identity of a neighbour
    at = np.flatnonzero(body)
    head = np.searchsorted(at, start)
    pos = np.minimum(np.arange(len(at)) - np.repeat(head, size), 31)
    letter = cp[at].astype(np.uint64) + np.uint64(32) * (kind[at] == 2)
    word = (mix(np.add.reduceat(letter * _POWERS[pos], head)) & np.uint64(_WORDS - 1)).astype(np.int64)
    before = np.concatenate([[0], word[:-1]])
    before[breaks] = 1
    after = np.concatenate([word[1:], [1]])
    after[:-1][breaks[1:]] = 1
    first = np.concatenate([[0], np.cumsum(np.array([len(t) for t in texts]) + 1)])[:-1]
    text_of = np.searchsorted(first, start, "right") - 1
    bucket = np.digitize(size, [2, 4, 8, 12, 16, 24, 32])
    shape = bucket * 32 + (lower > 0) * 1 + (upper > 0) * 2 + (digit > 0) * 4 + (symbol > 0) * 8 + (wide > 0) * 16
    mixture = bucket * 64 + np.digitize(digit / size, [0.001, 0.15, 0.3, 0.5, 0.9]) * 8 + np.digitize(turns / size, [0.05, 0.15, 0.25, 0.35, 0.5])
    features = np.stack([shape, mixture, gap, file[text_of] * 4 + np.minimum(bucket // 2, 3), before, after, (before * 8 + gap) % _WORDS], axis=1)
    return Tokens(start, end, line, features + _AT[:7])


class Crf(NamedTuple):
    emit: np.ndarray  # (feature, tag)
    move: np.ndarray  # (tag, tag)
    begin: np.ndarray  # (tag)

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = self.emit[features[:, 0]]
        for k in range(1, features.shape[1]):
            out += self.emit[features[:, k]]
        return out

    def tag(self, tokens: Tokens) -> np.ndarray:
        """The best tags of every line. A line in which no token can gain from leaving O is all O without a search."""
        tags = np.zeros(len(tokens.start), dtype=np.int8)
        if not len(tags):
            return tags
        e = self.scores(tokens.features)
        slack = 2 * max(0.0, float((self.move - self.move[O, O]).max()), float((self.begin - self.begin[O]).max()))
        lines = np.unique(tokens.line[np.maximum(e[:, B], e[:, I]) - e[:, O] + slack > 0])
        first = np.searchsorted(tokens.line, lines)
        size = np.searchsorted(tokens.line, lines, "right") - first
        order = np.argsort(-size, kind="stable")
        for a in range(0, len(order), 4096):
            some = order[a : a + 4096]
            self._viterbi(e, first[some], size[some], tags)
        return tags

    def _viterbi(self, e, first, size, tags) -> None:
        """Lines from the longest to the shortest, so that those still running are a prefix."""
        best = self.begin + e[first]
        back = np.zeros((int(size.sum()), 3), dtype=np.int8)
        at = np.cumsum(np.concatenate([[0], size[:-1]]))
        for t in range(1, int(size[0])):
            k = int(np.searchsorted(-size, -t, "left"))  # lines longer than t
            ways = best[:k, :, None] + self.move
            back[at[:k] + t] = ways.argmax(axis=1)
            best[:k] = ways.max(axis=1) + e[first[:k] + t]
        tag = best.argmax(axis=1)
        for t in range(int(size[0]) - 1, -1, -1):
            k = int(np.searchsorted(-size, -t, "left"))
            tags[first[:k] + t] = tag[:k]
            tag[:k] = back[at[:k] + t, tag[:k]]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    """Over an axis of the three tags."""
    a, b, c = np.moveaxis(x, axis, 0)
    m = np.maximum(np.maximum(a, b), c)
    return m + np.log(np.exp(a - m) + np.exp(b - m) + np.exp(c - m))


_ALNUM, _B64 = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
_KEYS = ("key", "credential", "passphrase", "auth", "pwd", "pin code", "signing key", "client id", "access code", "private", "login", "license", "activation code", "webhook", "session")


def _draw(rng: np.random.Generator, letters: str, low: int, high: int) -> str:
    return "".join(rng.choice(list(letters), int(rng.integers(low, high + 1))))


def secret_value(rng: np.random.Generator) -> str:
    """A random value in one of the forms that keys and passwords have."""
    kind = int(rng.integers(8))
    if kind == 0:
        return _draw(rng, _ALNUM, 16, 48)
    if kind == 1:
        return base64.b64encode(rng.bytes(int(rng.integers(12, 40)))).decode().rstrip("=")
    if kind == 2:
        return _draw(rng, "0123456789ABCDEF", 20, 40)
    if kind == 3:
        return _draw(rng, string.ascii_uppercase + "234567", 16, 32)
    if kind == 4:
        return "-".join(_draw(rng, _ALNUM, 5, 8) for _ in range(int(rng.integers(3, 6))))
    if kind == 5:
        return str(rng.choice(["ghp_", "sk_live_", "pk_test_", "xoxb-", "glpat-", "npm_", "hf_", "SG."])) + _draw(rng, _ALNUM, 20, 40)
    if kind == 6:
        return ".".join(base64.urlsafe_b64encode(rng.bytes(n)).decode().rstrip("=") for n in (18, int(rng.integers(20, 40)), 24))
    return _draw(rng, string.ascii_lowercase, 3, 6).capitalize() + _draw(rng, string.digits + "_-", 2, 4) + _draw(rng, _ALNUM, 4, 8)


def secret_phrase(rng: np.random.Generator) -> tuple[str, str]:
    """(phrase, its secret): a value where it may stand, such that no fixed pattern need match it."""
    value = secret_value(rng)
    kind = int(rng.integers(6))
    quote = str(rng.choice(["", '"', "'", "`"]))
    if kind <= 2 or len(value) < 16:
        lead = str(rng.choice(_KEYS)) + str(rng.choice([" = ", "=", ": ", " is ", " -> ", " => ", " "]))
        return lead + quote + value + quote, value
    if kind == 3:
        return str(rng.choice(["Authorization: Bearer ", "Bearer ", "Basic ", "curl -H X-Auth: "])) + value, value
    if kind == 4:
        value = _draw(rng, _ALNUM, 10, 20)
        return f"{rng.choice(['https', 'postgres', 'mysql', 'amqp'])}://{rng.choice(['admin', 'app', 'root'])}:{value}@{rng.choice(['db', 'host', 'example.com'])}/", value
    return quote + value + quote, value


def lookalike(rng: np.random.Generator) -> str:
    """Something with the shape of a secret that is none."""
    kind, n = int(rng.integers(11)), lambda a, b: int(rng.integers(a, b))
    if kind == 0:
        return f"{n(1, 256)}.{n(0, 256)}.{n(0, 256)}.{n(1, 256)}"
    if kind == 1:
        return f"{_draw(rng, string.ascii_lowercase, 3, 8)}.{_draw(rng, string.ascii_lowercase + string.digits, 3, 8)}@mail{n(1, 99)}.example.com"
    if kind == 2:
        return _draw(rng, string.digits, 8, 20)
    if kind == 3:
        return f"20{n(10, 40)}-{n(10, 13)}-{n(10, 28)}T{n(10, 24)}:{n(10, 60)}:00Z"
    if kind == 4:
        return f"https://www{n(1, 9)}.{_draw(rng, string.ascii_lowercase, 4, 9)}.com/{_draw(rng, string.ascii_lowercase, 3, 9)}/{n(1, 99999)}.html"
    if kind == 5:
        return "".join(_draw(rng, string.ascii_lowercase, 3, 7).capitalize() for _ in range(n(2, 5))) + str(n(0, 100)) * n(0, 2)
    if kind == 6:
        return f"v{n(0, 20)}.{n(0, 40)}.{n(0, 100)}-beta{n(1, 9)}"
    if kind == 7:
        return f"/usr/lib/{_draw(rng, string.ascii_lowercase, 3, 8)}{n(1, 12)}/{_draw(rng, string.ascii_lowercase, 3, 8)}_{n(1, 99)}.so"
    if kind == 8:
        return f"+{n(1, 99)}-{n(100, 999)}-{n(1000, 9999)}-{n(1000, 9999)}"
    if kind == 9:
        return str(uuid.UUID(bytes=rng.bytes(16)))
    return f"{_draw(rng, string.ascii_lowercase, 4, 9)}_{_draw(rng, string.ascii_lowercase, 3, 6)}_{n(1, 999)}"


def planted_lines(lines: list[str], n: int, make, seed: int) -> list[tuple[str, list]]:
    """So many (line, spans): words of one of ``lines`` with what ``make`` gives, (phrase, secret) or a phrase, among them."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(n if lines else 0):
        words = lines[int(rng.integers(len(lines)))].split(" ")
        a = int(rng.integers(len(words) + 1))
        left, right = (" ".join(words[max(0, a - 8) : a]) + " ").lstrip(" "), " " + " ".join(words[a : a + 8])
        made = make(rng)
        phrase, secret = made if isinstance(made, tuple) else (made, None)
        at = len(left) + phrase.rindex(secret) if secret else 0
        out.append((left + phrase + right, [(at, at + len(secret), "crf", at)] if secret else []))
    return out


def train_crf(texts: list[str], *, steps: int = 40, rate: float = 0.3, l2: float = 1e-4, longest: int = LINE_TOKENS, seed: int = 1) -> Crf:
    """Maximum conditional likelihood by forward-backward and Adam.

    Lines of more than ``longest`` tokens are cut to those around their secret, or to their first.
    Without any text the field tags everything as outside.
    """
    nothing = Crf(np.zeros((N_FEATURES, 3), np.float32), np.zeros((3, 3), np.float32), np.array([0.0, -1e3, -1e3], np.float32))
    nothing.move[:, [B, I]] = -1e3
    told = []  # line, spans, is it a line as it is
    for text in texts:
        spans, at = base_spans(text), 0
        for line in text.splitlines(keepends=True):
            mine = [(max(a - at, 0), b - at, k, v - at) for a, b, k, v in spans if v >= at and b <= at + len(line)]
            if not any(a < at + len(line) and b > at and not (v >= at and b <= at + len(line)) for a, b, _, v in spans):
                told.append((line.rstrip("\r\n"), mine))
            at += len(line)
    told = [t for t in told if t[0].strip()]
    plain = [t for t in told if not t[1]]
    if not told:
        return nothing
    hard = [t for t in plain if has_candidate(t[0])]
    even = lambda rows, n: [rows[k] for k in np.unique(np.linspace(0, len(rows) - 1, n).astype(int))] if rows else []
    words = [t for t, _ in plain] or ["a few words of no text"]
    chosen = [t for t in told if t[1]][:PLAIN_LINES] + even(hard, PLAIN_LINES // 2) + even(plain, PLAIN_LINES // 2)
    chosen += planted_lines(words, PLANTED_LINES, secret_phrase, seed) + planted_lines(words, LOOKALIKE_LINES, lookalike, seed + 1)
    texts, found = [t for t, _ in chosen], [s for _, s in chosen]
    tokens = tokenize(texts)
    gold = np.zeros(len(tokens.start), dtype=np.int8)
    offset = 0
    for text, spans in zip(texts, found, strict=True):
        for _, end, _, value in spans:
            a, b = np.searchsorted(tokens.end, offset + value, "right"), np.searchsorted(tokens.start, offset + end)
            if a < b:
                gold[a], gold[a + 1 : b] = B, I
        offset += len(text) + 1
    _, first, size = np.unique(tokens.line, return_index=True, return_counts=True)
    for k in np.flatnonzero(size > longest):
        on = np.flatnonzero(gold[first[k] : first[k] + size[k]])
        skip = min(max(0, int(on[0]) - longest // 2), size[k] - longest) if len(on) else 0
        first[k], size[k] = first[k] + skip, longest
    width = int(size.max(initial=1))
    grid = np.minimum(first[:, None] + np.arange(width), len(gold) - 1)
    on = np.arange(width) < size[:, None]
    flat = grid[on]
    x, y = tokens.features[flat], gold[flat]
    used, x = np.unique(x, return_inverse=True)  # only features that occur get weights
    x = x.reshape(len(flat), -1)
    spot = np.zeros(on.shape, dtype=np.int64)
    spot[on] = np.arange(len(flat))
    n_lines = len(size)
    w = {"emit": np.zeros((len(used), 3)), "move": np.zeros((3, 3)), "begin": np.zeros(3)}
    ys = np.where(on, y[spot], 0)
    told = {"emit": np.stack([np.bincount(x.ravel(), np.repeat(y == k, x.shape[1]), len(used)) for k in range(3)], 1), "move": np.zeros((3, 3)), "begin": np.bincount(ys[:, 0], minlength=3).astype(float)}
    np.add.at(told["move"], (ys[:, :-1][on[:, 1:]], ys[:, 1:][on[:, 1:]]), 1)
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        e = w["emit"][x].sum(axis=1)[spot]
        alpha, beta = np.empty((n_lines, width, 3)), np.zeros((n_lines, width, 3))
        alpha[:, 0] = w["begin"] + e[:, 0]
        for t in range(1, width):
            alpha[:, t] = _logsum(alpha[:, t - 1, :, None] + w["move"], 1) + e[:, t]
        for t in range(width - 2, -1, -1):
            beta[:, t] = np.where(on[:, t + 1, None], _logsum(w["move"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2), 0)
        z = _logsum(alpha[np.arange(n_lines), size - 1], 1)
        of = np.repeat(z, size)[:, None]
        p = np.exp((alpha + beta)[on] - of)
        two = on[:, 1:]
        pair = np.exp(alpha[:, :-1][two][:, :, None] + w["move"] + (e + beta)[:, 1:][two][:, None, :] - np.repeat(z, size - 1)[:, None, None])
        expected = {"emit": np.stack([np.bincount(x.ravel(), np.repeat(p[:, k], x.shape[1]), len(used)) for k in range(3)], 1), "move": pair.sum(0), "begin": np.exp(alpha[:, 0] + beta[:, 0] - z[:, None]).sum(0)}
        for k in w:
            g = (told[k] - expected[k]) / n_lines - l2 * w[k]
            m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g, 0.999 * m2[k] + 0.001 * g * g
            w[k] += rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    emit = np.zeros((N_FEATURES, 3), dtype=np.float32)
    emit[used] = w["emit"]
    return Crf(emit, w["move"].astype(np.float32), w["begin"].astype(np.float32))


def train_on(docs: DataFrame, text: str = "text", **options) -> Crf:
    """Train on a bounded sample of ``docs``: the SAMPLE_TEXTS texts of the smallest hashes among those
    of at most SAMPLE_CHARS characters, repeated ones once."""
    rows = docs.select(text_column(docs, text).alias("text")).where(F.length("text").between(1, SAMPLE_CHARS)).withColumn("h", F.xxhash64("text"))
    # hashes alone are ranked, so that no more than the chosen texts come to the driver
    chosen = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(SAMPLE_TEXTS).collect()]
    found = rows.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("text").alias("text")).collect() if chosen else []
    texts = {r["h"]: r["text"] for r in found}
    return train_crf([texts[h] for h in chosen], **options)


_SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


_TOKEN = re.compile(rb"[A-Za-z0-9+/_.\x80-\xff-]+")
#: Characters that are tagged at once: so many, or a longer line.
TAG_CHARS = 1 << 18
_BREAK = re.compile("[\r\n]")
_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _hinted(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts may hold a match of a fixed pattern; all that hold one are among them."""
    at = [np.flatnonzero(_HEX[data[: len(data) // 16 * 16]].reshape(-1, 16).all(axis=1)) * 16]  # 32 in a row fill 16 of these
    low = _LOWER[data].tobytes()
    for word in (b"passw", b"secret", b"token", b"apikey", b"api_key", b"akia"):
        k = low.find(word)
        while k >= 0:
            at.append([k])
            k = low.find(word, k + 1)
    return np.unique(np.searchsorted(offsets, np.concatenate(at).astype(np.int64), "right") - 1)


def has_candidate(line: str) -> bool:
    """Whether a line holds a candidate: such lines are half of the plain ones that training sees."""
    return any(len(t) >= CANDIDATE and (re.search(b"[0-9]", t) or _mixed(t)) for t in _TOKEN.findall(line.encode()))


def _mixed(token: bytes) -> bool:
    kind = _KIND[np.frombuffer(token, np.uint8)]
    return bool((kind == 1).any() and (kind == 2).any() and not (kind == 5).any() and np.count_nonzero(kind[1:] != kind[:-1]) >= 2)


def _groups(texts: list[str]) -> Iterator[list[tuple[int, int, str]]]:
    """All of the texts as groups of (text's number, place, part); long texts are cut behind line breaks, and lines never."""
    group, size = [], 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text):
            cut = len(text)
            if cut - at > TAG_CHARS:
                cut = max(text.rfind("\n", at, at + TAG_CHARS), text.rfind("\r", at, at + TAG_CHARS)) + 1
                if not cut:
                    after = _BREAK.search(text, at + TAG_CHARS)
                    cut = after.end() if after else len(text)
            group.append((k, at, text[at:cut]))
            size, at = size + cut - at, cut
            if size >= TAG_CHARS:
                yield group
                group, size = [], 0
    if group:
        yield group


def all_spans(texts: list[str], model: Crf, everywhere: bool = False) -> list[list[tuple[str, int, int]]]:
    """Per text (kind, start, end): the patterns' spans, and of the field's spans the parts outside these.

    The field's spans are those of lines with a match's begin or a candidate; ``everywhere``: those of all lines, as ``scan`` gives them.
    """
    found = spans_of(*text_bytes(pa.array(texts, pa.string())), model)
    return found if everywhere else [[s for s in spans if s[0] != "crf" or _tells(text, s[1], spans)] for text, spans in zip(texts, found, strict=True)]


def _tells(text: str, at: int, spans: list[tuple[str, int, int]]) -> bool:
    begin = max(text.rfind("\n", 0, at), text.rfind("\r", 0, at)) + 1
    after = _BREAK.search(text, at)
    end = after.start() if after else len(text)
    return any(begin <= a < end for kind, a, _ in spans if kind != "crf") or has_candidate(text[begin:end])


def spans_of(data: np.ndarray, offsets: np.ndarray, model: Crf) -> list[list[tuple[str, int, int]]]:
    """``all_spans`` everywhere in texts that lie one after the other in UTF-8 bytes: every line is tagged."""
    n = len(offsets) - 1
    fixed: list[list] = [[] for _ in range(n)]
    field: list[list] = [[] for _ in range(n)]
    if not len(data):
        return fixed
    texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    for t in _hinted(data, offsets).tolist():
        fixed[t] = [(kind, a, b) for a, b, kind, _ in base_spans(texts[t])]
    file = file_features(data, offsets)
    for group in _groups(texts):
        owner, at, parts = zip(*group, strict=True)
        tokens = tokenize(list(parts), file[list(owner)])
        tags = model.tag(tokens)
        hot = np.flatnonzero(tags)
        if not len(hot):
            continue
        heads = np.flatnonzero((tags[hot] == B) | np.concatenate([[True], (np.diff(hot) > 1) | (np.diff(tokens.line[hot]) > 0)]))
        starts, ends = tokens.start[hot[heads]], tokens.end[hot[np.append(heads[1:], len(hot)) - 1]]
        first = np.concatenate([[0], np.cumsum([len(x) + 1 for x in parts])])
        part = np.searchsorted(first, starts, "right") - 1
        for k, s, e in zip(part.tolist(), (starts - first[part]).tolist(), (ends - first[part]).tolist(), strict=True):
            field[owner[k]].append((at[k] + s, at[k] + e, parts[k][s:e]))
    out = []
    for spans, more in zip(fixed, field, strict=True):
        known = sorted((a, b) for _, a, b in spans)
        for a, b, value in more:
            begin = a
            for s, e in [(s, e) for s, e in known if s < b and e > a] + [(b, b)]:
                part = value[a - begin : max(a, s) - begin]
                if part.strip():
                    spans.append(("crf", a + len(part) - len(part.lstrip()), a + len(part.rstrip())))
                a = max(a, e)
        out.append(sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))
    return out


def _scanned(docs: DataFrame, model: Crf, text: str, into: str) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.withColumn("__text", text_column(docs, text))

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("__text"))
            spans = []
            for i, j in chunks(offsets):
                spans += [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], model.value)]
            kept = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(spans, _SPANS_ARROW)], [*kept.schema.names, into])
        give_back_memory()

    return rows.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, _SPANS)]))


def scan(docs: DataFrame, model: Crf, *, text: str = "text") -> DataFrame:
    """Add ``spans`` (kind, start, end; code points, end exclusive), by start, to every row of ``docs``.

    Null and empty texts have none; repeated rows have equal spans; texts are searched whole, very
    long ones too, each in one task; an empty table stays empty. A column named ``spans`` is replaced, all others stay.
    """
    return _scanned(docs.drop("spans"), model, text, "spans")


def redact(docs: DataFrame, model: Crf, *, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace what ``scan`` finds in the texts by a mark; overlapping spans become one mark. All other columns stay,
    one named ``spans`` too; null and empty texts stay as they are; an empty table stays empty."""
    t = F.col(f"`{text}`")
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda a, s: F.struct(
        F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(t, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).otherwise(a["out"]).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at"),
    )
    done = F.aggregate("__spans", zero, step, lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.length(t))))
    return _scanned(docs, model, text, "__spans").withColumn(text, F.when(F.size("__spans") > 0, done).otherwise(t)).drop("__spans")
