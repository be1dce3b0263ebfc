"""Words and windows over bytes against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from logweave.llm import packed
from logweave.llm.words import ALNUM, AS_IS, LOWER, NOT_SPACE, covered, reps, texts, tokenise, windows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CASES = ["", " ", "a", "one two\tthree\n", "\x0bé\xa0ü x", "A-B c.d 9Z", "ß" * 300, " lead", "trail ", "x\x00y \x7f z", "a b a b a b", "w" * 200_000 + " v"]


def _made(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("ab é\n\t.A9-") for _ in range(r.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("is_word,fold,pattern,lower", [
    (NOT_SPACE, AS_IS, r"[^\x20\x09-\x0D]+", False), (NOT_SPACE, LOWER, r"[^\x20\x09-\x0D]+", True),
    (ALNUM, LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)])
def test_words_are_those_of_the_pattern(is_word, fold, pattern, lower):
    bodies = CASES + _made(1, 200)
    column = pa.array([x.encode() for x in bodies] + [None], pa.binary())
    seen, hashes = {}, {}
    for lo, hi, data, offsets in texts(column):
        words = tokenise(data, offsets, is_word, fold)
        for i in range(hi - lo):
            a, b = words.first[i], words.first[i + 1]
            seen[lo + i] = [bytes(data[s:e]).decode() for s, e in zip(words.starts[a:b], words.ends[a:b])]
            for w, h in zip(seen[lo + i], words.hashes[a:b].tolist()):
                hashes.setdefault(w.translate(UPPER) if lower else w, set()).add(h)
    for i, x in enumerate(bodies + [""]):
        # The bytes stay as they are; the pattern is that of the lowered text, of the same length.
        spans = [m.span() for m in re.finditer(pattern, x.translate(UPPER) if lower else x)]
        assert seen[i] == [x[a:b] for a, b in spans]
    assert all(len(h) == 1 for h in hashes.values())
    assert len(set().union(*hashes.values())) == len(hashes)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 10, 18, 35])
def test_windows_are_equal_where_the_words_are(n):
    r = np.random.default_rng(n)
    base = r.integers(0, 2, 400).astype(np.uint64)
    got = windows(base, n)
    assert len(got) == len(base) - n + 1
    by_words: dict = {}
    for i, h in enumerate(got.tolist()):
        by_words.setdefault(tuple(base[i : i + n].tolist()), set()).add(h)
    assert all(len(h) == 1 for h in by_words.values())
    assert len(set().union(*by_words.values())) == len(by_words)
    assert len(windows(base[: n - 1], n)) == 0


def test_covered_and_reps():
    assert covered(np.array([1, 2, 7]), 9, 2).tolist() == [False, True, True, True, False, False, False, True, True]
    assert reps(np.array([3, 1, 3, 3, 1, 2], np.uint64)).tolist() == [1, 1, 2, 3, 3]
    assert reps(np.empty(0, np.uint64)).tolist() == []


def test_packed_keys_come_back():
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64))
    assert (packed._unpack(packed._pack(values), np.uint64) == values).all()
    narrow = (values >> np.uint64(32)).astype(np.uint32)
    assert (packed._unpack(packed._pack(narrow), np.uint32) == narrow).all()


def test_repeated_hashes_over_batches(spark):
    r = np.random.default_rng(5)
    own = {b: r.integers(0, 300, 200).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for b in range(4)}
    rows = pa.concat_tables([packed.send(b, x, 6, True) for b, x in own.items()])
    sent = spark.createDataFrame(rows.to_pandas(), packed.SENT)
    counts = dict(zip(*np.unique(np.concatenate(list(own.values())), return_counts=True)))
    got = {b: set() for b in own}
    for row in packed.repeated(sent, 6, True).collect():
        got[row.batch] |= set(np.frombuffer(row.found, np.uint64).tolist())
    assert got == {b: {int(h) for h in x if counts[h] > 1} for b, x in own.items()}
