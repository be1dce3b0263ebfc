"""Languages of texts and of their spans: script ranges, word scores and Viterbi decoding.

Training counts the letter trigrams (over folded bytes, hashed to 65536 buckets) of every
labelled row of the training part, by language, in one pass with a partial sum in each task;
the model is one number per bucket and language. A word's score is the sum over its trigrams.
The script of a word's first letter narrows it to the languages that use that script. Viterbi
over the words of a text, with a price for every change of language, labels its spans; the
text's language is the one with most letters, its score their share.

Defined cases: NULL text or text without a letter is `und` with score 0 and no spans; with a
single learned language that one always wins; no training rows at all give `und` everywhere;
ties go to the language first in order. Rows of NULL lang or NULL doc_id do not train.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import tables
from logweave.llm.tables import free, others
from logweave.llm.words import AS_IS, NOT_SPACE, texts, tokenise

BUCKETS = 1 << 16
#: Price of a change of language between two words, in nats.
SWITCH = 12.0
#: A language uses a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Least log probability of a trigram below that of its best language.
FLOOR = -4.0
#: Score of a language whose script the word is not in.
BARRED = -60.0
#: Scores (of a word for a language) decoded at once, and looked up at once.
_DECODE = 1 << 22
_LOOKUP = 1 << 17

UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[0x80:] = np.arange(0x80, 0x100)

# Script of a character by the lead byte of its UTF-8 form; 0 is none.
_SCRIPTS = [(0x41, 0x5A, 1), (0x61, 0x7A, 1), (0xC3, 0xCA, 1), (0xCD, 0xCF, 2), (0xD0, 0xD3, 3), (0xD4, 0xD5, 4), (0xD6, 0xD7, 5),
            (0xD8, 0xDD, 6), (0xE0, 0xE0, 7), (0xE1, 0xE1, 8), (0xE3, 0xE9, 9), (0xEA, 0xED, 10), (0xF0, 0xF4, 11)]
N_SCRIPTS = 12
_SCRIPT = np.zeros(256, np.int8)
for _first, _last, _name in _SCRIPTS:
    _SCRIPT[_first : _last + 1] = _name


class Model(NamedTuple):
    langs: list[str]
    table: np.ndarray  # (BUCKETS + 1, languages); the last row is for bytes that are no letter
    barred: np.ndarray  # (scripts, languages)


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around each byte; BUCKETS where the byte is no letter."""
    folded = _FOLD[data]
    before, after = np.empty(len(data), np.uint32), np.empty(len(data), np.uint32)
    before[1:], after[:-1] = folded[:-1], folded[1:]
    full = offsets[:-1] < offsets[1:]
    before[offsets[:-1][full]] = 0x20
    after[offsets[1:][full] - 1] = 0x20
    key = (before << np.uint32(16)) | (folded.astype(np.uint32) << np.uint32(8)) | after
    key *= np.uint32(2654435761)
    out = (key >> np.uint32(16)).astype(np.int32)
    out[folded == 0x20] = BUCKETS
    return out


def _count(langs: list[str]):
    at = {lang: i for i, lang in enumerate(langs)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(langs), BUCKETS + 1), np.int64)
        scripts = np.zeros((len(langs), N_SCRIPTS), np.int64)
        for batch in batches:
            own = np.array([at.get(x, -1) for x in batch["lang"].to_pylist()], np.int64)
            for lo, hi, data, offsets in texts(batch.columns[-1]):
                lang = np.repeat(own[lo:hi], np.diff(offsets))
                grams, script = _trigrams(data, offsets), _SCRIPT[data]
                for i in range(len(langs)):
                    mine = lang == i
                    seen[i] += np.bincount(grams[mine], minlength=BUCKETS + 1)
                    scripts[i] += np.bincount(script[mine], minlength=N_SCRIPTS)
        for kind, counts in (("gram", seen[:, :BUCKETS]), ("script", scripts)):
            i, key = np.nonzero(counts)
            yield pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(i), pa.string()), "i": pa.array(i, pa.int32()), "key": pa.array(key, pa.int32()), "n": pa.array(counts[i, key], pa.int64())})

    return work


def _body() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")


def train(labelled: DataFrame) -> Model:
    """From columns text and lang. The driver gets languages x 65536 numbers at most."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    langs = sorted(r[0] for r in rows.select(F.col("lang").cast("string")).distinct().collect())
    seen, scripts = np.zeros((len(langs), BUCKETS), np.int64), np.zeros((len(langs), N_SCRIPTS), np.int64)
    counts = rows.select(F.col("lang").cast("string").alias("lang"), _body().alias("body")).mapInArrow(_count(langs), "kind string, i int, key int, n bigint")
    for row in counts.groupBy("kind", "i", "key").agg(F.sum("n").alias("n")).toLocalIterator():
        (seen if row["kind"] == "gram" else scripts)[row["i"], row["key"]] = row["n"]
    return fitted(langs, seen, scripts)


def fitted(langs: list[str], seen: np.ndarray, scripts: np.ndarray) -> Model:
    logs = np.log((seen + 0.5) / (seen.sum(1, keepdims=True) + 0.5 * BUCKETS))
    table = np.zeros((BUCKETS + 1, len(langs)), np.float32)
    barred = np.zeros((N_SCRIPTS, len(langs)), np.float32)
    if langs:
        table[:BUCKETS] = np.maximum(logs - logs.max(0), FLOOR).T
        letters = scripts[:, 1:]
        uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(1, keepdims=True), 1)
        uses &= letters > 0
        barred[1:] = np.where(uses.T | ~uses.any(0)[:, None], 0, BARRED)
    return Model(langs, table, barred)


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of each word; text i has the words first[i]:first[i + 1]. All texts step together."""
    n, k = scores.shape
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = first[:-1][order], sizes[order]
    stays, best_of = np.zeros((n, k), bool), np.zeros(n, np.int32)
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    value = np.zeros((len(sizes), k), np.float64)
    for t, live in enumerate(active.tolist()):
        at, v = begin[:live] + t, value[:live]
        if t:
            top = v.argmax(1)
            cut = v[np.arange(live), top][:, None] - switch
            stays[at] = v >= cut
            best_of[at] = top
            np.maximum(v, cut, out=v)
        v += scores[at]
    labels = np.zeros(n, np.int32)
    state = value.argmax(1).astype(np.int32) if k else np.zeros(len(sizes), np.int32)
    for t in range(len(active) - 1, -1, -1):
        live = int(active[t])
        at, own = begin[:live] + t, state[:live]
        labels[at] = own
        if t:
            keep = stays[at, own]
            state[:live] = np.where(keep, own, best_of[at])
    return labels


def _decode(model: Model, switch: float, names: tuple[str, str, str]):
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))

    def results(parts: list[tuple]) -> Iterator[tuple[str, float, list]]:
        scores = np.concatenate([p[0] for p in parts])
        letters = np.concatenate([p[1] for p in parts])
        shift = np.cumsum([0] + [len(p[1]) for p in parts])
        first = np.concatenate([p[2][:-1] + s for p, s in zip(parts, shift[:-1], strict=True)] + [shift[-1:]])
        labels = viterbi(scores, first, switch)
        k = len(model.langs)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        shares = np.bincount(doc * k + labels, weights=letters, minlength=(len(first) - 1) * k).reshape(-1, k)
        change = np.flatnonzero((np.diff(labels, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
        of = np.searchsorted(change, first)
        has = np.concatenate([p[3] for p in parts])
        for d in range(len(first) - 1):
            total = shares[d].sum()
            if not has[d] or total == 0:
                yield UNKNOWN, 0.0, []
                continue
            begins = change[of[d] : of[d + 1]]
            ends = np.append(begins[1:], first[d + 1]) - 1
            best = int(shares[d].argmax())
            yield model.langs[best], float(shares[d][best] / total), [
                {"first": a, "last": b, "lang": model.langs[c]} for a, b, c in zip((begins - first[d]).tolist(), (ends - first[d]).tolist(), labels[begins].tolist(), strict=True)]

    def scored(data: np.ndarray, offsets: np.ndarray) -> tuple:
        words = tokenise(data, offsets, NOT_SPACE, AS_IS)
        n = len(offsets) - 1
        is_letter = _FOLD[data] != 0x20
        lead = _SCRIPT[data] > 0
        sums = np.concatenate([[0], np.cumsum(lead)])
        letters = (sums[words.ends] - sums[words.starts]).astype(np.float64)
        has = np.zeros(n, bool)
        ascii_letters = np.concatenate([[0], np.cumsum((_FOLD[data] != 0x20) & (data < 0x80))])[offsets]
        other = np.concatenate([[0], np.cumsum(data >= 0x80)])[offsets]
        has = np.diff(ascii_letters) > 0
        for d in np.flatnonzero(~has & (np.diff(other) > 0)).tolist():
            has[d] = any(c.isalpha() for c in data[offsets[d] : offsets[d + 1]].tobytes().decode(errors="replace"))
        scores = np.zeros((len(words.starts), len(model.langs)), np.float32)
        if len(words.starts):
            grams = _trigrams(data, offsets)
            step = max(1, _LOOKUP // len(model.langs))
            for a in range(0, len(words.starts), step):
                b = min(a + step, len(words.starts))
                lo, hi = words.starts[a], words.ends[b - 1]
                scores[a:b] = np.add.reduceat(model.table[grams[lo:hi]], words.starts[a:b] - lo, axis=0)
            # The script of the first character that has one.
            leads = np.append(np.flatnonzero(lead), len(data))
            at = leads[np.searchsorted(leads, words.starts)]
            script = np.where(at < words.ends, _SCRIPT[np.minimum(data[np.minimum(at, len(data) - 1)], 255)], 0)
            scores += model.barred[script]
            # A text of letters outside all ranges still has a language.
            bare = np.flatnonzero(has & (np.bincount(np.repeat(np.arange(n), np.diff(words.first)), weights=letters, minlength=n) == 0))
            for d in bare.tolist():
                a, b = words.first[d], words.first[d + 1]
                sums_other = np.concatenate([[0], np.cumsum(is_letter)])
                letters[a:b] = sums_other[words.ends[a:b]] - sums_other[words.starts[a:b]]
        return scores, letters, words.first, has

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, float, list]] = []
            parts: list[tuple] = []
            held = 0
            for _, _, data, offsets in texts(batch.columns[-1]):
                if not model.langs:
                    out += [(UNKNOWN, 0.0, [])] * (len(offsets) - 1)
                    continue
                parts.append(scored(data, offsets))
                held += parts[-1][0].size
                if held > _DECODE:
                    out += results(parts)
                    parts, held = [], 0
            if parts:
                out += results(parts)
            keep = dict(zip(batch.schema.names[:-1], batch.columns[:-1], strict=True))
            yield pa.RecordBatch.from_pydict(keep | {
                names[0]: pa.array([x[0] for x in out], pa.string()), names[1]: pa.array([x[1] for x in out], pa.float64()),
                names[2]: pa.array([x[2] for x in out], spans_type),
            })

    return work


def identify(docs: DataFrame, model: Model, *columns: str, switch: float = SWITCH, names: tuple[str, str, str] = ("lang_pred", "score", "spans")) -> DataFrame:
    """`columns` of docs, then under `names` the language, its score and spans (word ranges, 0-based, both ends included)."""
    kinds, keep = dict(docs.dtypes), others(columns, names)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"`{c}` {kind}" for c, kind in zip(names, ("string", "double", "array<struct<first: int, last: int, lang: string>>"), strict=True)])
    return docs.select(*[f"`{c}`" for c in keep], _body().alias(free(keep, "body"))).mapInArrow(_decode(model, switch, names), schema)


def fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def train_on_folds(docs: DataFrame) -> Model:
    """Learn from the rows whose fold is not 2."""
    return train(docs.where(fold() != 2))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    rows = identify(docs, train_on_folds(docs), "doc_id")
    return rows.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


QUERIES = {"op9_language_id": op9_language_id}
#: A trained model and its decoding are not SQL; tests hold accuracy and a plain Viterbi against it.
ORACLES: dict[str, str] = {}
