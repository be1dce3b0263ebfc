"""Secrets in whole texts: three patterns, and a linear-chain conditional random field over tokens.

The field tags every token of a text as secret begin, inside or outside. Its features are the
token's shape (length, kinds of characters, how often they change, known prefixes), the words
next to it, the characters around it, and how code-like the whole file is. It is trained by
maximum likelihood (forward and backward sums) on lines made by rule and on lines of a bounded
random sample of the table, labelled by the patterns; it is decoded by Viterbi over the whole
text. Spans of the field that touch none of the patterns' are added to them; a pattern's span
always stays.

Defined cases: NULL text is empty and has no spans; rows are judged one by one, so repeated
rows get equal answers; ranges are in code points, the end exclusive; an empty table gives an
empty result; a table without secrets trains on the made lines alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import secret_samples, tables
from logweave.llm.tables import free, others
from logweave.llm.words import LOWER, Words, member, texts, tokenise

#: Rows of the table that help to train, and lines made by rule.
SAMPLE_ROWS = 400
MADE_LINES = 1600
STEPS = 120

# The patterns, and the least length of what they must find.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
_NAMES = (b"password", b"passwd", b"secret", b"token", b"api")
KINDS = ("assign", "access", "hex", "crf")
LABELS = OUT, BEGIN, INSIDE = 0, 1, 2

_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[65:91] = _TOKEN[97:123] = _TOKEN[0x80:] = True
_TOKEN[list(b"+/_.~-")] = True
_KIND = np.full(256, 3, np.int8)  # digit, upper, lower, sign, beyond ASCII
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[0x80:] = 0, 1, 2, 4
_AROUND = np.full(256, 7, np.int8)
for _i, _chars in enumerate((b" \t\n\r", b"\"'`", b"=", b":", b"@", b"/", b".,;!?")):
    _AROUND[list(_chars)] = _i
_CODE = np.zeros(256, bool)
_CODE[list(b"{}();=<>[]\"'_")] = True


def _hashes(names: Sequence[str]) -> np.ndarray:
    body = " ".join(names).encode()
    data = np.frombuffer(body, np.uint8)
    return np.sort(tokenise(data, np.array([0, len(data)]), _TOKEN, LOWER).hashes)


_LISTS = [_hashes(x) for x in (secret_samples.STRONG, secret_samples.WEAK, secret_samples.PLAIN)]
#: Values of each feature: length, shape, changes, prefix, own word, words before (1, 2) and after, around (before, after), assigned, file, length x changes.
SIZES = (8, 32, 4, len(secret_samples.PREFIXES) + 1, 4, 4, 4, 4, 8, 8, 2, 3, 32)
_BASE = np.concatenate([[0], np.cumsum(SIZES)])


class Model(NamedTuple):
    weights: np.ndarray  # (feature values, labels)
    moves: np.ndarray  # (label before, label)
    begin: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Tokens, and for each the row of the weights of every feature."""
    words = tokenise(data, offsets, _TOKEN, LOWER)
    s, e, n = words.starts, words.ends, len(words.starts)
    out = np.zeros((n, len(SIZES)), np.int32)
    if not n:
        return words, out
    length = e - s
    kind = _KIND[data]
    shape = np.zeros(n, np.int64)
    for i in range(5):
        sums = np.concatenate([[0], np.cumsum(kind == i, dtype=np.int32)])
        shape |= (sums[e] > sums[s]).astype(np.int64) << i
    turns = np.concatenate([[0, 0], np.cumsum(kind[1:] != kind[:-1], dtype=np.int32)])
    change = (turns[e] - turns[s + 1]) / length
    prefix = np.zeros(n, np.int64)
    for i, text in enumerate(secret_samples.PREFIXES):
        own = np.frombuffer(text.encode(), np.uint8)
        at = np.flatnonzero(length > len(own))
        for j, c in enumerate(own):
            at = at[data[s[at] + j] == c]
        prefix[at] = i + 1
    named = np.zeros(n + 4, np.int64)
    for i, names in enumerate(_LISTS):
        named[2 : n + 2][member(words.hashes, names)] = i + 1
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    begin, end = words.first[:-1][doc], words.first[1:][doc]
    at = np.arange(n)
    before = np.where(s > offsets[doc], _AROUND[data[np.maximum(s - 1, 0)]], 0)
    after = np.where(e < offsets[doc + 1], _AROUND[data[np.minimum(e, len(data) - 1)]], 0)
    signs = np.concatenate([[0], np.cumsum((data == 61) | (data == 58), dtype=np.int32)])
    assigned = signs[s] > signs[np.maximum(s - 3, offsets[doc])]
    code = np.diff(np.concatenate([[0], np.cumsum(_CODE[data])])[offsets]) / np.maximum(np.diff(offsets), 1)
    long, often = np.searchsorted((4, 8, 12, 16, 20, 32, 48), length, "right"), np.searchsorted((0.001, 0.15, 0.3), change, "right")
    columns = (
        long, shape, often, prefix, named[2 : n + 2],
        np.where(at - 1 >= begin, named[1 : n + 1], 0), np.where(at - 2 >= begin, named[:n], 0), np.where(at + 1 < end, named[3 : n + 3], 0),
        before, after, assigned, np.searchsorted((0.03, 0.1), code, "right")[doc], long * 4 + often)
    for i, column in enumerate(columns):
        out[:, i] = column + _BASE[i]
    return words, out


def scores(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = weights[rows[:, 0]]
    for i in range(1, rows.shape[1]):
        out += weights[rows[:, i]]
    return out


def viterbi(unary: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """Best labels; text i has the tokens first[i]:first[i + 1]. All texts step together."""
    n, k = unary.shape
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    at0, sizes = first[:-1][order], sizes[order]
    back = np.zeros((n, k), np.int8)
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    value = np.zeros((len(sizes), k))
    for t, live in enumerate(active.tolist()):
        at = at0[:live] + t
        if t:
            ways = value[:live, :, None] + model.moves
            back[at] = ways.argmax(1)
            value[:live] = ways.max(1) + unary[at]
        else:
            value[:live] = model.begin + unary[at]
    labels, state = np.zeros(n, np.int8), value.argmax(1).astype(np.int8)
    for t in range(len(active) - 1, -1, -1):
        live = int(active[t])
        at = at0[:live] + t
        labels[at] = state[:live]
        state[:live] = back[at, state[:live]]
    return labels


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, decay: float = 2e-4) -> Model:
    """Maximum likelihood with Adam; sequences: feature rows and labels of each line."""
    sequences = [x for x in sequences if len(x[1])]
    b, long, k = len(sequences), max((len(y) for _, y in sequences), default=1), len(LABELS)
    x = np.zeros((b, long, len(SIZES)), np.int64)
    y, mask = np.zeros((b, long), np.int64), np.zeros((b, long), bool)
    for i, (rows, labels) in enumerate(sequences):
        x[i, : len(rows)], y[i, : len(labels)], mask[i, : len(labels)] = rows, labels, True
    total = _BASE[-1]
    sizes = (total * k, k * k, k)
    theta, m, v = np.zeros(sum(sizes)), np.zeros(sum(sizes)), np.zeros(sum(sizes))
    flat = x[mask].ravel()
    wide = len(SIZES)
    gold = np.zeros(sum(sizes))
    np.add.at(gold, flat * k + np.repeat(y[mask], wide), 1)
    both = mask[:, 1:]
    np.add.at(gold, sizes[0] + y[:, :-1][both] * k + y[:, 1:][both], 1)
    np.add.at(gold, sizes[0] + sizes[1] + y[:, 0], 1)
    for step in range(1, steps + 1):
        weights, moves, begin = theta[: sizes[0]].reshape(-1, k), theta[sizes[0] : -k].reshape(k, k), theta[-k:]
        unary = np.zeros((b, long, k))
        unary[mask] = scores(x[mask], weights)
        ahead, behind = np.zeros((b, long, k)), np.zeros((b, long, k))
        ahead[:, 0] = begin + unary[:, 0]
        for t in range(1, long):
            new = _logsum(ahead[:, t - 1, :, None] + moves, 1) + unary[:, t]
            ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
        for t in range(long - 2, -1, -1):
            new = _logsum(moves[None] + (unary[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(mask[:, t + 1, None], new, 0)
        z = _logsum(ahead[:, -1], 1)
        single = np.exp(ahead + behind - z[:, None, None])
        pair = np.exp(ahead[:, :-1, :, None] + moves + (unary[:, 1:] + behind[:, 1:])[:, :, None, :] - z[:, None, None, None])
        expected = np.concatenate([
            np.stack([np.bincount(flat, weights=np.repeat(single[mask][:, c], wide), minlength=total) for c in range(k)], 1).ravel(),
            pair[both].sum(0).ravel(), single[:, 0].sum(0)])
        grad = (gold - expected) / max(b, 1) - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights, moves, begin = theta[: sizes[0]].reshape(-1, k), theta[sizes[0] : -k].reshape(k, k).copy(), theta[-k:].copy()
    moves[OUT, INSIDE] = begin[INSIDE] = -1e6
    return Model(weights.astype(np.float32), moves, begin)


def patterns(body: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of what the patterns find, in order."""
    out = []
    low = body.lower()
    if any(name in low for name in _NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(body) if m.end(2) - m.start(2) >= 12]
    if b"AKIA" in body:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(body) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(body)]
    return sorted(out)


def _labelled(text: bytes, spans: Sequence[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    words, rows = features(data, np.array([0, len(data)]))
    labels = np.zeros(len(words.starts), np.int64)
    for a, b in spans:
        own = np.flatnonzero((words.starts < b) & (words.ends > a))
        labels[own], labels[own[:1]] = INSIDE, BEGIN
    return rows, labels


def _value_of(body: bytes, start: int, kind: int, end: int) -> tuple[int, int]:
    """The secret alone, without the name it is assigned to."""
    return ASSIGN.match(body, start).span(2) if kind == 0 else (start, end)


def stretches(body: bytes) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """Short pieces of a text with their secrets: around its first findings, or one stretch without any."""
    found = patterns(body)
    out = []
    for start, _, end in found[:3]:
        lo, hi = max(0, body.rfind(b"\n", max(0, start - 160), start) + 1, start - 160), min(len(body), end + 80)
        own = [_value_of(body, *x) for x in found if x[0] >= lo and x[2] <= hi]
        out.append((body[lo:hi], [(a - lo, b - lo) for a, b in own]))
    return out or [(body[:300], [])]


def made_lines(n: int = MADE_LINES) -> list[tuple[bytes, list[tuple[int, int]]]]:
    return [(text.encode(), [(len(text[:a].encode()), len(text[:b].encode())) for a, b in spans]) for text, spans in secret_samples.lines(n)]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [piece for body in batch.columns[-1] for piece in stretches(body.as_py())]
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array([x for x, _ in out], pa.binary()), "secrets": pa.array([[list(s) for s in spans] for _, spans in out], pa.list_(pa.list_(pa.int32())))})


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """From made lines and from pieces of a bounded random sample of the table's texts, labelled by the patterns."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body")
    n = docs.count()
    sample = docs.select(body).sample(fraction=min(1.0, 2 * sample_rows / max(n, 1)), seed=3).limit(sample_rows)
    rows = sample.mapInArrow(_pieces, "piece binary, secrets array<array<int>>").toLocalIterator()
    return fit([_labelled(x, spans) for x, spans in made_lines() + [(bytes(r["piece"]), r["secrets"]) for r in rows]])


def _tag(model: Model):
    held_most = 1 << 20

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[dict]] = []
            parts: list[tuple] = []

            def flush() -> None:
                shift = np.cumsum([0] + [len(p[2]) for p in parts])
                first = np.concatenate([p[0].first[:-1] + s for p, s in zip(parts, shift[:-1], strict=True)] + [shift[-1:]])
                labels = viterbi(np.concatenate([p[2] for p in parts]), first, model)
                for (words, offsets, _, base, points), s in zip(parts, shift[:-1], strict=True):
                    found.extend(_spans(words, offsets, labels[s : s + len(words.starts)], base, points))
                parts.clear()

            held = 0
            for _, _, data, offsets in texts(batch.columns[-1]):
                words, rows = features(data, offsets)
                body = data.tobytes()
                base = [patterns(body[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)])
                parts.append((words, offsets, scores(rows, model.weights), base, points))
                held += len(rows)
                if held > held_most:
                    flush()
                    held = 0
            if parts:
                flush()
            keep = dict(zip(batch.schema.names[:-1], batch.columns[:-1], strict=True))
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_pydict(keep | {"spans": pa.array(found, kind)})

    return work


def _spans(words: Words, offsets: np.ndarray, labels: np.ndarray, base: list, points: np.ndarray) -> Iterator[list[dict]]:
    """Of each text the patterns' spans and the field's others, in order of start and kind."""
    begins = np.flatnonzero(labels == BEGIN)
    doc = np.searchsorted(words.first, begins, "right") - 1
    of: dict[int, list] = {}
    for t, d in zip(begins.tolist(), doc.tolist(), strict=True):
        end = t
        while end + 1 < words.first[d + 1] and labels[end + 1] == INSIDE:
            end += 1
        of.setdefault(d, []).append((int(words.starts[t] - offsets[d]), 3, int(words.ends[end] - offsets[d])))
    for d, own in enumerate(base):
        more = [x for x in of.get(d, ()) if all(x[2] <= a or x[0] >= b for a, _, b in own)]
        at = offsets[d]
        yield [{"kind": KINDS[k], "start": int(points[at + a] - points[at]), "end": int(points[at + b] - points[at])} for a, k, b in sorted(own + more)]


def find_secrets(docs: DataFrame, *columns: str, model: Model | None = None) -> DataFrame:
    """`columns` of docs and spans: kind (assign, access, hex, crf), start and end in code points."""
    kinds, keep = dict(docs.dtypes), others(columns, ["spans"])
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["spans array<struct<kind: string, start: int, end: int>>"])
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias(free(keep, "body"))
    return docs.select(*[f"`{c}`" for c in keep], body).mapInArrow(_tag(train(docs) if model is None else model), schema)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_secrets(tables.read(spark, sf_dir, "documents"), "doc_id")

    def said(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda x: x["kind"] != KINDS[3])
    return rows.select("doc_id", *[number(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


QUERIES = {"op1_secret_scan": op1_secret_scan}
#: A trained field is no SQL; tests hold the base spans, Viterbi and gradients against brute force.
ORACLES: dict[str, str] = {}
