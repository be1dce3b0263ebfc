"""Substring and line dedup, near copies and contamination against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logweave.llm import components, decontaminate, jaccard_join, line_dedup, substring_dedup

WORD = r"[^\x20\x09-\x0D]+"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, source string, uid string, body string, batch string, gone string, hits int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", "u", "b", "x", "g", 1) for i, t in rows], SCHEMA).repartition(3)


def corpus(seed: int, n: int) -> list[tuple[int, str | None]]:
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") + r.choice("xyzuvw") + str(r.randint(0, 30))
    shared = [" ".join(word() for _ in range(r.choice((20, 36, 60, 90)))) for _ in range(4)]
    out = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(r.randint(0, 50))) for _ in range(r.randint(1, 4))]
        if r.random() < 0.5:
            parts.insert(r.randint(0, len(parts)), r.choice(shared))
        text = r.choice(("\n", " ")).join(parts)
        if out and r.random() < 0.4:
            words = (r.choice(out)[1] or "").split(" ")
            for _ in range(r.choice((0, 1, 2, 5))):
                words[r.randrange(len(words))] = word()
            text = " ".join(words)
        out.append((i, text))
    return out + [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "one two"), (n + 4, "One two"), (n + 5, "q " * 200)]


def removed_by_force(texts: list[list[str]], width: int) -> list[list[bool]]:
    counts = Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if counts[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append(gone)
    return out


@pytest.mark.parametrize("width", [35, 7])
def test_substrings_go_as_by_force(spark, width):
    rows = corpus(3, 60)
    words = [re.findall(WORD, t or "") for _, t in rows]
    gone = removed_by_force(words, width)
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(frame(spark, rows), width).collect()}
    for (i, _), w, g in zip(rows, words, gone):
        kept = " ".join(x for x, y in zip(w, g) if not y)
        assert (got[i].n_words, got[i].kept_text) == (len(w), kept)
        assert sum(x.last - x.first + 1 for x in got[i].repeats) == sum(g)
    assert any(map(any, gone))


def test_substring_query_digest(spark, tmp_path):
    frame(spark, corpus(4, 20)).write.parquet(str(tmp_path / "documents.parquet"))
    row = {r.doc_id: r for r in substring_dedup.op8_substring_dedup(spark, str(tmp_path)).collect()}[20]
    assert (row.n_words, row.n_removed, row.kept_sha256) == (0, 0, hashlib.sha256(b"").hexdigest())


def test_repeated_rows_and_empty_tables(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, long), (None, long + " x"), (2, "short")]
    got = substring_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r.n_words, r.kept_text) for r in got) == [(1, "short"), (40, ""), (40, ""), (41, "x")]
    assert substring_dedup.remove_repeats(frame(spark, [])).collect() == []
    assert jaccard_join.classes(frame(spark, [])).collect() == []
    assert line_dedup.drop_repeated_lines(frame(spark, [])).collect() == []
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(frame(spark, []), bench).collect() == []
    assert [r.items for r in decontaminate.contamination(frame(spark, [(1, "a b")]), bench).collect()] == [[]]


def linked_by_force(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(WORD, (t or "").translate(UPPER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed,pivots,rest", [(5, jaccard_join.PIVOTS, jaccard_join.REST), (6, 1, 0)])
def test_near_copies_as_by_force(spark, monkeypatch, seed, pivots, rest):
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard_join, "REST", rest)
    rows = corpus(seed, 90)
    r = random.Random(seed)
    base = [f"c{k}" for k in range(120)]
    for i in range(25):  # a chain and a cluster: copies of copies with few words changed
        words = list(base)
        for _ in range(r.randint(0, 5)):
            words[r.randrange(120)] = f"d{r.randint(0, 10_000)}"
        rows.append((1000 + i, " ".join(words)))
        if i % 5 == 0:
            base = words
    want = linked_by_force(rows)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.classes(frame(spark, rows)).collect()}
    assert got == want
    assert sum(i != c for i, (_, c) in want.items()) > 20
    kept = {x.doc_id for x in jaccard_join.one_of_each(frame(spark, rows)).collect()}
    assert kept == {i for i, (n, c) in want.items() if c == i}


def test_near_copies_edge_cases(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (7, text), (7, text), (3, None), (4, ""), (None, None)]
    got = Counter((x.doc_id, x.n_shingles, x.component_id) for x in jaccard_join.classes(frame(spark, rows)).collect())
    assert got == Counter({(None, 26, 7): 1, (7, 26, 7): 2, (3, 0, 3): 1, (4, 0, 4): 1, (None, 0, None): 1})
    kept = jaccard_join.one_of_each(frame(spark, rows))
    assert kept.columns == SCHEMA.replace(" bigint", "").replace(" string", "").replace(" int", "").split(", ")
    assert sorted((x.doc_id is None, x.doc_id or 0, x.text or "") for x in kept.collect()) == [(False, 3, ""), (False, 4, ""), (False, 7, text), (True, 0, "")]


@pytest.mark.parametrize("n", [41, 100])
def test_prefixes_of_similar_sets_have_enough_in_common(n):
    import numpy as np

    r = np.random.default_rng(n)
    levels = np.zeros(jaccard_join.SKETCH, np.uint8)
    for _ in range(200):
        x = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        change = r.integers(0, n // 8)
        y = np.unique(np.concatenate([x[change:], r.integers(0, 1 << 63, r.integers(0, n // 8)).astype(np.uint64)]))
        # Of what one set has and the other has not, some is in no third set either.
        left = []
        for own, other in ((x, y), (y, x)):
            differ = np.setdiff1d(own, other)
            left.append(np.setdiff1d(own, differ[: r.integers(0, len(differ) + 1)]))
        sizes = [jaccard_join.prefix_size(len(own)) - (len(own) - len(rest)) for own, rest in zip((x, y), left)]
        if jaccard_join.similar(x, y):
            assert min(sizes) > 0
            for seed in jaccard_join.ORDERS:
                heads = [set(jaccard_join.prefix(rest, levels, seed, size).tolist()) for rest, size in zip(left, sizes)]
                assert len(heads[0] & heads[1]) >= jaccard_join.least_common(len(x), len(y))


def test_components_of_chains_stars_and_rings(spark):
    r = random.Random(2)
    names = list(range(200))
    r.shuffle(names)
    chain = list(zip(names[:80], names[1:81]))
    star = [(names[100], x) for x in names[101:140]]
    ring = list(zip(names[150:170], names[151:170] + [names[150]]))
    edges = chain + star + ring + [(names[190], names[190]), (names[3], names[2])]
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {}
    for part in (names[:81], names[100:140], names[150:170]):
        want.update(dict.fromkeys(part, min(part)))
    assert got == want
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def lines_by_force(rows, run=3, least_words=line_dedup.LEAST_WORDS):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda x: x[0]):
        lines = (t or "").split("\n")
        own = [k for k, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for k in range(len(own) - run + 1):
            key = tuple(lines[j].strip(" ") for j in own[k : k + run])
            if key in seen:
                gone |= set(own[k : k + run])
            seen.add(key)
        for k in own:
            body = lines[k].strip(" ")
            if len(re.findall(WORD, body)) >= least_words:
                if body in seen:
                    gone.add(k)
                seen.add(body)
        out[i] = (sorted(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_lines_go_as_by_force(spark):
    r = random.Random(8)
    rows = [(i, "\n".join(r.choice((f"line {r.randint(0, 12)}", f" line {r.randint(0, 12)} ", "", "  ")) for _ in range(r.randint(0, 25)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "same\n" * 30), (103, "x\n" * 2000)]
    # Passages on one line or two: copies of a whole text, lines among others, one word short of a run, one in the same text again.
    passage = [" ".join(f"w{n}\u00e4{k}" for n in range(20)) for k in range(4)]
    rows += [(110 + k, passage[0]) for k in range(5)] + [(120, f"{passage[1]}\nown line"), (121, f"other\n  {passage[1]} \nend"), (122, passage[1].replace(" ", "\t"))]
    rows += [(130 + k, passage[2].rsplit(" ", 1)[0]) for k in range(3)] + [(140, f"{passage[3]}\nbetween\n{passage[3]}"), (141, "\n".join([*passage, "new"]))]
    got = {x.doc_id: x for x in line_dedup.drop_repeated_lines(frame(spark, rows)).collect()}
    want = lines_by_force(rows)
    for i, t in rows:
        assert (got[i].gone or []) == want[i][0], i
        assert got[i].text == (t if t is None or not want[i][0] else want[i][1])
    assert sum(bool(g) for g, _ in want.values()) > 8


@pytest.mark.parametrize("window", [1, 2, 5])
def test_winnowing_leaves_a_fingerprint_in_every_window(spark, window):
    r = random.Random(window)
    grams = [r.randint(0, 6) for _ in range(40)]
    got = spark.range(1).select(line_dedup._fingerprints(F.array(*[F.lit(x) for x in grams]), window).alias("x")).first().x
    for i in range(len(grams) - window + 1):
        own = grams[i : i + window]
        assert max(k for k in range(i, i + window) if grams[k] == min(own)) in got


def test_repeated_rows_are_no_later_lines(spark):
    text = "a\nb\nc"
    got = line_dedup.drop_repeated_lines(frame(spark, [(1, text), (1, text), (None, text), (2, "a\nb\nc\nd")])).collect()
    assert sorted((x.doc_id or 99, x.text) for x in got) == [(1, text), (1, text), (2, "d"), (99, "")]


@pytest.mark.parametrize("block", [200_000, 3])
def test_contamination_as_by_force(spark, block):
    r = random.Random(9)
    word = lambda: r.choice(("ab", "Cd", "éf", "x9")) + str(r.randint(0, 5))
    items = [(i, " ".join(word() for _ in range(r.choice((1, 3, 4, 9, 10, 11, 25))))) for i in range(12)] + [(5, "twice under one id ab1"), (50, None), (51, "--"), (None, "no id at all here")]
    docs = []
    for i in range(40):
        parts = [" ".join(word() for _ in range(r.randint(0, 30)))]
        if r.random() < 0.7:
            words = (r.choice(items)[1] or "").upper().split(" ")
            parts.insert(r.randint(0, 1), "-".join(words[r.randint(0, 2) :]))
        docs.append((i, ". ".join(parts)))
    docs += [(98, None), (99, ""), (97, docs[0][1])]
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, t in items:
        w = pattern.findall((t or "").translate(UPPER))
        for k in range(len(w) - min(10, len(w)) + 1) if w else ():
            windows[tuple(w[k : k + 10])].add("" if item is None else str(item))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {x.doc_id: x for x in decontaminate.contamination(frame(spark, docs), bench, block_windows=block).collect()}
    for i, t in docs:
        w, hit, found = pattern.findall((t or "").translate(UPPER)), set(), set()
        for own, ids in windows.items():
            for k in range(len(w) - len(own) + 1):
                if tuple(w[k : k + len(own)]) == own:
                    hit |= set(range(k, k + len(own)))
                    found |= ids
        assert got[i].n_words == len(w)
        assert got[i].items == sorted(found)
        assert {k for x in got[i].hits for k in range(x["first"], x["last"] + 1)} == hit
    assert 5 < sum(bool(x.items) for x in got.values())
    clean = decontaminate.clean_documents(frame(spark, docs), bench)
    assert {x.doc_id for x in clean.collect()} == {i for i, x in got.items() if not x.items}
