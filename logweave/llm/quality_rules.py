"""Quality rules as a short-circuit cascade, ordered by rejections for cost on a sample.

A rule has a measure over a text and a range of good values. On a bounded random sample each
rule's time and its rejections are measured; then the rule that rejects most of what is left
for its time comes first, and so on. Over the whole table a text meets the rules in that
order and stops at its first rejection: a rule's measure is computed for those texts only
that all earlier rules passed. The verdict is the same in any order; only the cost differs.

Base figures (words, symbols, repeated lines and windows) are wanted for every text and are
computed first; a text that fails the base test enters no rule. Letters and ends of sentences
are those of all scripts; the length of words counts only where a script parts them.

Defined cases: NULL or wordless text has no words, all figures 0, and fails the base test;
an empty sample leaves the rules in the order of their names; rows are judged one by one, so
repeated rows get equal answers; columns of any other name are not read.
"""

from __future__ import annotations

import time
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import tables
from logweave.llm.tables import free, others
from logweave.llm.words import AS_IS, NOT_SPACE, Words, mix, texts, tokenise, windows

#: Rows of the sample that orders the rules.
SAMPLE_ROWS = 2000
MIN_WORDS = 20
REPEAT = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT[48:58] = True

# What ends a sentence or clause, in the scripts of the world; and code points, from to,
# of scripts that put no spaces between words: Thai and Lao, Tibetan, Burmese, Khmer, kana, Han.
STOPS = ".!?:;\u0589\u061b\u061f\u06d4\u0964\u0965\u104a\u104b\u1362\u1367\u17d4\u17d5\u2026\u3002\uff01\uff0e\uff1a\uff1b\uff1f\uff61"
UNSPACED = ((0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
#: From this share of a text's characters on, its words are no measure of anything.
UNSPACED_SHARE = 0.3
_IS_LETTER, _IS_UNSPACED, _IS_STOP = 1, 2, 4
_TOP = 0x20000  # from here on all that is in use are Han letters


@cache
def _kinds() -> np.ndarray:
    """What each code point below `_TOP` is."""
    out = np.array([_IS_LETTER * (unicodedata.category(chr(i))[0] in "LM") for i in range(_TOP)], np.uint8)
    for low, high in UNSPACED:
        out[low : min(high + 1, _TOP)] |= _IS_UNSPACED
    out[[ord(x) for x in STOPS]] |= _IS_STOP
    return out


def kinds(data: np.ndarray) -> np.ndarray:
    """Of each byte that begins a character what it is; 0 for the others."""
    table = _kinds()
    if not len(data) or data.max() < 0x80:
        return table[data]
    at = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[at]
    size = 1 + (first >= 0xC0).astype(np.int8) + (first >= 0xE0) + (first >= 0xF0)
    point = (first & np.array([0, 0x7F, 0x1F, 0x0F, 0x07], np.uint8)[size]).astype(np.int64)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        point[more] = (point[more] << 6) | (data[np.minimum(at[more] + k, len(data) - 1)] & 0x3F)
    out = np.zeros(len(data), np.uint8)
    out[at] = np.where(point < _TOP, table[np.minimum(point, _TOP - 1)], _IS_LETTER | _IS_UNSPACED)
    return out


class Text(NamedTuple):
    """Some whole texts: bytes, bounds, words and the base figures of each."""

    data: np.ndarray
    offsets: np.ndarray
    words: Words
    base: dict[str, np.ndarray]

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a flag of each byte."""
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[self.offsets])

    def per_word(self, flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[self.words.first])


class Rule(NamedTuple):
    name: str
    measure: Callable[[Text], np.ndarray]
    least: float
    most: float


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _adjacent(t: Text) -> np.ndarray:
    """Share of words equal to the one before."""
    same = np.zeros(len(t.words.hashes), bool)
    same[1:] = t.words.hashes[1:] == t.words.hashes[:-1]
    same[t.words.first[:-1][np.diff(t.words.first) > 0]] = False
    return _share(t.per_word(same), t.base["n_words"])


def _letters(t: Text) -> np.ndarray:
    return t.per_text(kinds(t.data) & _IS_LETTER > 0)


def _unspaced(t: Text, own: np.ndarray) -> np.ndarray:
    return _share(t.per_text(own & _IS_UNSPACED > 0), t.base["word_chars"]) >= UNSPACED_SHARE


def _ends(t: Text) -> np.ndarray:
    """Share of words that end as a sentence or clause does; without spaces, of characters that end one."""
    own = kinds(t.data)
    stop = own & _IS_STOP > 0
    last = np.maximum.accumulate(np.where((t.data & 0xC0) != 0x80, np.arange(len(t.data)), 0)) if len(t.data) else t.data
    spaced = _share(t.per_word(stop[last[t.words.ends - 1]] if len(t.words.ends) else np.zeros(0, bool)), t.base["n_words"])
    return np.where(_unspaced(t, own), _share(t.per_text(stop), t.base["word_chars"]), spaced)


def _mean_word(t: Text) -> np.ndarray:
    """Characters for each word; where there are no spaces between words, a length that no rule minds."""
    return np.where(_unspaced(t, kinds(t.data)), MEAN_WORD[0], _share(t.base["word_chars"], t.base["n_words"]))


MEAN_WORD = (2.5, 14.0)
RULES = (
    Rule("adjacent_words", _adjacent, 0.0, 0.3),
    Rule("digits", lambda t: _share(t.per_text(_DIGIT[t.data]), t.base["word_chars"]), 0.0, 0.4),
    Rule("duplicate_lines", lambda t: _share(t.base["n_dup_lines"], t.base["n_lines"]), 0.0, 0.5),
    Rule("letters", lambda t: _share(_letters(t), t.base["word_chars"]), 0.6, 2.0),
    Rule("mean_word", _mean_word, *MEAN_WORD),
    Rule("sentence_ends", _ends, 0.005, 1.0),
    Rule("symbols", lambda t: _share(t.base["n_symbols"], t.base["n_words"]), 0.0, 0.25),
    Rule("upper_case", lambda t: _share(t.per_text(_UPPER[t.data]), _letters(t)), 0.0, 0.5),
)


def _dup_lines(body: bytes) -> tuple[int, int]:
    lines = [x for x in body.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def measured(data: np.ndarray, offsets: np.ndarray) -> Text:
    words = tokenise(data, offsets, NOT_SPACE, AS_IS)
    n_words = np.diff(words.first)
    inside = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = inside[words.ends] - inside[words.starts]
    body = data.tobytes()
    lines = [_dup_lines(body[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    at = np.flatnonzero(words.room() >= REPEAT)
    doc = np.repeat(np.arange(len(n_words), dtype=np.uint64), n_words)
    keys = mix(windows(words.hashes, REPEAT)[at] ^ mix(doc[at] + np.uint64(1))) if len(at) else np.empty(0, np.uint64)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = at[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]] if len(at) else at
    change = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + REPEAT, -1)
    t = Text(data, offsets, words, {})
    t.base.update(
        n_words=n_words, word_chars=np.diff(np.concatenate([[0], np.cumsum(chars)])[words.first]), n_symbols=t.per_text(_SYMBOL[data]),
        n_dup_lines=np.array([x[1] for x in lines], np.int64), n_lines=np.array([x[0] for x in lines], np.int64),
        n_repeat_words=t.per_word(np.cumsum(change[:-1]) > 0))
    return t


def base_failed(t: Text) -> np.ndarray:
    return (t.base["n_words"] < MIN_WORDS) | (100 * t.base["n_repeat_words"] > 30 * t.base["n_words"])


def _only(t: Text, pick: np.ndarray) -> Text:
    """Those texts alone, so that a measure costs what they hold."""
    sizes, counts = np.diff(t.offsets)[pick], np.diff(t.words.first)[pick]
    take = _ranges(t.offsets[pick], sizes)
    own = _ranges(t.words.first[pick], counts)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    shift = np.repeat(offsets[:-1] - t.offsets[pick], counts)
    words = Words(t.data[take], t.words.starts[own] + shift, t.words.ends[own] + shift, t.words.hashes[own], np.concatenate([[0], np.cumsum(counts)]))
    return Text(words.data, offsets, words, {k: v[pick] for k, v in t.base.items()})


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + sizes, sizes)


def _bad(rule: Rule, t: Text) -> np.ndarray:
    value = rule.measure(t)
    return (value < rule.least) | (value > rule.most)


def _try(rules: Sequence[Rule]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in texts(batch.columns[-1]):
                t = measured(data, offsets)
                rows, costs = [], []
                for rule in rules:
                    began = time.perf_counter()
                    rows.append(_bad(rule, t))
                    costs.append((time.perf_counter() - began) / max(len(offsets) - 1, 1))
                yield pa.RecordBatch.from_pydict({
                    "bad": pa.array(np.stack(rows, 1).tolist(), pa.list_(pa.bool_())), "base": pa.array(base_failed(t)),
                    "cost": pa.array([costs] * (len(offsets) - 1), pa.list_(pa.float64()))})

    return work


def ordered(rules: Sequence[Rule], bad: np.ndarray, costs: np.ndarray) -> list[Rule]:
    """Greedily the rule that rejects most of the rows still left for its cost."""
    left, alive, out = list(range(len(rules))), np.ones(len(bad), bool), []
    while left:
        best = max(left, key=lambda i: (bad[alive, i].mean() / max(costs[i], 1e-12) if alive.any() else 0.0, -i))
        out.append(rules[best])
        left.remove(best)
        alive &= ~bad[:, best]
    return out


def _bodies(docs: DataFrame, *keep: str) -> DataFrame:
    return docs.select(*[f"`{c}`" for c in keep], F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias(free(keep, "body")))


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The order of the rules for this table, from a sample of about `sample_rows` rows."""
    n = docs.count()
    sample = docs.select("text").sample(fraction=min(1.0, 2 * sample_rows / max(n, 1)), seed=11).limit(sample_rows)
    rows = [r for r in _bodies(sample).mapInArrow(_try(rules), "bad array<boolean>, base boolean, cost array<double>").toLocalIterator() if not r["base"]]
    bad = np.array([r["bad"] for r in rows], bool).reshape(len(rows), len(rules))
    costs = np.mean([r["cost"] for r in rows], 0) if rows else np.ones(len(rules))
    return ordered(rules, bad, costs)


def _cascade(rules: Sequence[Rule]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list] = {}
            for _, _, data, offsets in texts(batch.columns[-1]):
                t = measured(data, offsets)
                failed = base_failed(t)
                reason = np.full(len(failed), -1)
                pick = np.flatnonzero(~failed)
                own = _only(t, pick)
                for i, rule in enumerate(rules):
                    if not len(pick):
                        break
                    bad = _bad(rule, own)
                    reason[pick[bad]] = i
                    if bad.any():
                        pick, own = pick[~bad], _only(own, np.flatnonzero(~bad))
                names = np.array(["base"] + [r.name for r in rules] + [None], object)
                said = np.where(failed, 0, np.where(reason < 0, len(rules) + 1, reason + 1))
                for name, value in [*t.base.items(), ("base_failed", failed), ("rejected_by", names[said])]:
                    parts.setdefault(name, []).append(value)
            keep = dict(zip(batch.schema.names[:-1], batch.columns[:-1], strict=True))
            out = {name: np.concatenate(parts[name]) if parts else [] for name in FIGURES}
            yield pa.RecordBatch.from_pydict(keep | {
                name: pa.array(value, pa.bool_() if name == "base_failed" else pa.string() if name == "rejected_by" else pa.int64()) for name, value in out.items()})

    return work


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by")


def judge(docs: DataFrame, *columns: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """`columns` of docs, the base figures, base_failed and rejected_by (`base`, a rule, or NULL if kept)."""
    kinds, keep = dict(docs.dtypes), others(columns, FIGURES)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{x} {'boolean' if x == 'base_failed' else 'string' if x == 'rejected_by' else 'bigint'}" for x in FIGURES])
    return _bodies(docs, *keep).mapInArrow(_cascade(plan(docs) if rules is None else rules), schema)


def kept() -> Column:
    return F.col("rejected_by").isNull()


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(tables.read(spark, sf_dir, "documents"), "doc_id")
    return rows.select("doc_id", *FIGURES[:6], kept().alias("kept"))


_NO_WORD = r"[\x20\x09-\x0D]+"
_LIMIT = {rule.name: rule for rule in RULES}
_STOPS_SQL = "[" + STOPS.replace(".", "\\.") + "]"
_UNSPACED_SQL = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in UNSPACED) + "]"
RULES_SQL = rf"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS body FROM doc),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT body) AS n_dup FROM line WHERE regexp_matches(body, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS body FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM doc WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, body) > 1),
repeated AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i FROM doc),
words AS (
  SELECT doc_id, sum(length(x)) AS chars, count(*) FILTER (x = before) AS same, count(*) FILTER (regexp_matches(x, '{_STOPS_SQL}$')) AS word_ends
  FROM (SELECT *, lag(x) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM word) GROUP BY doc_id),
figures AS (
  SELECT doc.doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, same, word_ends,
    length(t) - length(regexp_replace(t, '{_STOPS_SQL}', '', 'g')) AS stops,
    length(t) - length(regexp_replace(t, '{_UNSPACED_SQL}', '', 'g')) >= {UNSPACED_SHARE} * greatest(chars, 1) AS unspaced,
    length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS digits,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper,
    length(t) - length(regexp_replace(t, '[\p{{L}}\p{{M}}]', '', 'g')) AS letters
  FROM doc LEFT JOIN lines ON lines.doc_id = doc.doc_id LEFT JOIN repeated ON repeated.doc_id = doc.doc_id LEFT JOIN words ON words.doc_id = doc.doc_id),
tested AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND same / n_words <= {_LIMIT['adjacent_words'].most} AND digits / word_chars <= {_LIMIT['digits'].most}
  AND n_dup_lines / greatest(n_lines, 1) <= {_LIMIT['duplicate_lines'].most} AND letters / word_chars >= {_LIMIT['letters'].least}
  AND (unspaced OR word_chars / n_words BETWEEN {_LIMIT['mean_word'].least} AND {_LIMIT['mean_word'].most})
  AND CASE WHEN unspaced THEN stops / word_chars ELSE word_ends / n_words END >= {_LIMIT['sentence_ends'].least}
  AND n_symbols / n_words <= {_LIMIT['symbols'].most} AND upper / greatest(letters, 1) <= {_LIMIT['upper_case'].most} AS kept
FROM tested
"""

QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLES = {"op2_quality_rules": RULES_SQL}
