"""Merkle manifest, periodic runs and exact copies against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.llm import cuckoo, exact_dedup, merkle, periodic_runs

WORD = r"[^\x20\x09-\x0D]+"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, node string, `text as bytes` string, digest string, tree string, shard int"


def stored(spark, rows, tmp_path, parts=3):
    """A folder with a table `documents` of rows (doc_id, source, lang, n_chars, text) and columns of clashing names."""
    folder = str(tmp_path / "tables")
    spark.createDataFrame([(*r, "x", "x", "x", "x", 1) for r in rows], DOCS).repartition(parts).write.parquet(f"{folder}/documents.parquet")
    return folder


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Merkle manifest


def levels_by_force(leaves: list[str]) -> list[list[str]]:
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def way(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """Left and right siblings on each level."""
    out = []
    for level in levels[:-1]:
        low = at // 8 * 8
        out.append(("".join(level[low:at]), "".join(level[at + 1 : low + 8])))
        at //= 8
    return out


def leaf_of(row, text) -> str:
    body = "".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (*row[:4], text))
    return sha(body)


def manifest_by_force(rows) -> list[tuple]:
    trees: dict = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        built[name] = levels_by_force([leaf_of(r, r[4]) for r in trees[name]])
    top = levels_by_force([built[n][-1][0] for n in names])
    out = []
    for t, name in enumerate(names):
        for at, row in enumerate(trees[name]):
            steps = way(built[name], at) + way(top, t)
            shown = row[4]
            if shown is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                shown = shown.translate(UPPER)
            fold = leaf_of(row, shown)
            for left, right in steps:
                fold = sha(left + fold + right)
            root = top[-1][0]
            out.append((row[0], leaf_of(row, row[4]), built[name][-1][0], root, sha("".join(a + b for a, b in steps)), fold, fold == root))
    return out


def _documents(sizes: dict, seed: int = 1):
    r = random.Random(seed)
    rows, at = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            at += r.randint(1, 3)
            text = r.choice([None, "", f"Text {at} Ä世", "all lower", "UP\nper " * 3])
            rows.append((at, r.choice([None, "web", "ö"]), lang, r.choice([None, at, -3]), text))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"en": 5000, None: 9, "de": 1, "": 8, "zz": 65, "fr": 513},
    {f"l{i:02d}": 1 + i % 3 for i in range(70)},
    {"en": 700},
    {"en": 1},
    {None: 8},
    {"a": 1, "b": 1},
], ids=["six", "seventy", "one", "single", "null", "two"])
def test_manifest_as_by_force(spark, tmp_path, sizes):
    rows = _documents(sizes)
    got = merkle.op11_merkle_manifest(spark, stored(spark, rows, tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(manifest_by_force(rows))


def test_manifest_of_repeated_and_null_rows(spark, tmp_path):
    rows = [(5, "s", "en", 1, "Same")] * 30 + [(5, "s", "en", 1, "other")] * 2 + [(None, None, None, None, None)] * 3 + [(None, "s", "en", 1, "x" * 300_000)]
    got = merkle.op11_merkle_manifest(spark, stored(spark, rows, tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, manifest_by_force(rows)))


def test_manifest_of_an_empty_table(spark, tmp_path):
    assert merkle.op11_merkle_manifest(spark, stored(spark, [], tmp_path)).collect() == []


def test_nodes_link_to_their_parents(spark, tmp_path):
    rows = _documents({"en": 5000, "de": 30})
    docs = spark.read.parquet(stored(spark, rows, tmp_path) + "/documents.parquet")
    made = merkle.build(docs, "doc_id", "lang", merkle.leaf(F.col("doc_id"), F.col("text")))
    nodes = made.nodes.collect()
    ids = {tuple(n.node): n for n in nodes}
    assert len(ids) == len(nodes)
    for n in nodes:
        if n.parent is not None:
            above = ids[tuple(n.parent)]
            assert bytes(above.hashes)[32 * n.place : 32 * n.place + 32] == bytes(n.hash)
    assert all(r.node is None or tuple(r.node) in ids for r in made.runs.collect())
    # No node is looked for by more than a block's 64 runs.
    assert made.runs.groupBy("node").count().agg(F.max("count")).first()[0] <= 64


def test_manifest_lifts_the_row_limit_only_while_it_runs(spark, tmp_path):
    key = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(key, "10")
    try:
        rows = _documents({"en": 300})
        assert merkle.op11_merkle_manifest(spark, stored(spark, rows, tmp_path)).count() == 300
        assert spark.conf.get(key) == "10"
    finally:
        spark.conf.unset(key)


# Periodic runs


def runs_by_force(words: list) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            n = j + q - i
            own = words[i : i + n]
            if n >= max(6, 4 * q) and not any(own[r:] == own[:-r] for r in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda x: (x[0], x[2]))


def periodic_by_force(doc_id, text) -> tuple:
    words = re.findall(WORD, text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = runs_by_force(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda x: (x[1], -x[0], -x[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def _words(r: random.Random) -> list[int]:
    n, k, out = r.randrange(0, 120), r.choice((1, 2, 3, 5)), []
    while len(out) < n:
        out += [r.randrange(k + 1) for _ in range(r.randrange(1, 10))] * r.randrange(1, 8) + [r.randrange(9)] * r.randrange(0, 2)
    return out


def test_runs_of_many_texts_as_by_force():
    r = random.Random(4)
    rows = [_words(r) for _ in range(600)]
    first = np.cumsum([0] + [len(x) for x in rows])
    hashes = np.array([0x9E3779B97F4A7C15 * (w + 1) % 2**64 for x in rows for w in x], np.uint64)
    got = periodic_runs.runs_of_texts(hashes, first)
    for i, x in enumerate(rows):
        assert got.get(i, []) == runs_by_force(x), x


def test_splitting_leaves_only_segments_of_frequent_words():
    words = np.array([1, 2, 1, 2, 1, 2, 1, 2, 9, 1, 2, 3, 1, 2, 3, 1, 2, 8], np.uint64)
    assert periodic_runs.split_by_frequency(words, np.array([0, len(words)])) == [(0, 8)]


def test_periodic_query_as_by_force(spark, tmp_path):
    r = random.Random(5)
    rows = [(i, " \t\n"[i % 3].join(f"{'wÄ' * (w % 2)}{w}" for w in _words(r))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, "a " * 20), (None, None), (7, rows[7][1]), (1003, "x y " * 30000), (1004, "a"), (1005, "A a " * 5)]
    got = periodic_runs.op12_periodic_runs(spark, stored(spark, [(i, "s", "l", 1, t) for i, t in rows], tmp_path)).collect()
    small = {(i, t) for i, t in rows if i != 1003}
    want = {(i, t): periodic_by_force(i, t) for i, t in small}
    assert sorted(map(repr, (tuple(x) for x in got if x.doc_id != 1003))) == sorted(repr(want[r]) for r in rows if r[0] != 1003)
    long = next(x for x in got if x.doc_id == 1003)
    h = zlib.crc32(b"1003")
    assert h % 10 and (long.n_runs, long.start, long.length, long.period, long.exponent_milli) == (1, 0, 60000, 2, 30_000_000)


def test_long_runs_of_long_periods():
    r = np.random.default_rng(1)
    for period, n in ((70_000, 400_000), (1, 300_000), (2, 300_001), (999, 5000)):
        unit = r.integers(1, 1 << 60, period).astype(np.uint64)
        words = np.concatenate([r.integers(1, 1 << 60, 7).astype(np.uint64), np.resize(unit, n), r.integers(1, 1 << 60, 5).astype(np.uint64)])
        assert periodic_runs.runs_of_texts(words, np.array([0, len(words)])) == {0: [(7, n, period)]}


def test_words_that_share_a_hash_are_told_apart(monkeypatch, spark):
    real = periodic_runs.tokenise
    monkeypatch.setattr(periodic_runs, "tokenise", lambda *a: real(*a)._replace(hashes=np.ones(len(real(*a).starts), np.uint64)))
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([b"a b c d e f g h", b"a a a a a a b"], pa.binary())], [periodic_runs._TEXT])
    out = next(periodic_runs._work(iter([batch])))
    assert out.column("runs").to_pylist() == [[], [{"start": 0, "length": 6, "period": 1}]]
    assert out.column("collapsed").to_pylist() == ["a b c d e f g h", "a b"]


def test_periodic_of_an_empty_table(spark, tmp_path):
    assert periodic_runs.op12_periodic_runs(spark, stored(spark, [], tmp_path)).collect() == []


# Exact copies


def copies_by_force(rows) -> list[tuple]:
    groups: dict = {}
    for i, text in rows:
        groups.setdefault((text or "").translate(UPPER), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        out += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return sorted(map(repr, out))


def _copied(seed: int):
    r = random.Random(seed)
    texts = [f"Text {i} ÄÖ" for i in range(60)] + ["", None, "TEXT 3 ÄÖ", "text 4 äö", "hot"]
    rows = [(i, r.choice(texts)) for i in range(500)] + [(i, "HOT" if i % 2 else "hot") for i in range(500, 900)]
    return rows + [(None, "hot"), (None, "alone"), (None, "alone"), (3, "x" * 500_000), (4, "X" * 500_000), (9, "twice"), (9, "twice")]


def test_copies_as_by_force(spark, tmp_path, monkeypatch):
    rows = _copied(1)
    got = exact_dedup.op13_exact_dedup(spark, stored(spark, [(i, "s", "l", 1, t) for i, t in rows], tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == copies_by_force(rows)
    assert exact_dedup.op13_exact_dedup(spark, stored(spark, [], tmp_path / "empty")).collect() == []


def test_an_index_takes_and_gives_back_documents(spark):
    docs = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    rows = _copied(2)
    fresh, gone = rows[600:], rows[100:300] + [(850, "hot"), (None, "alone"), (9, "twice"), (123456, "hot"), (0, "not there")]
    held = exact_dedup.stored(exact_dedup.index(docs(rows[:600])))
    held = exact_dedup.stored(exact_dedup.insert(held, docs(fresh)))
    key = lambda x: (x[0], (x[1] or "").translate(UPPER))
    leave = set(map(key, gone))
    held = exact_dedup.stored(exact_dedup.delete(held, docs(gone)))
    left = [x for x in rows if key(x) not in leave]
    see = lambda: sorted(repr((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex())) for r in exact_dedup.copies(held).collect())
    assert see() == copies_by_force(left)
    # Every live digest is in its shard's filter; what went is in none but for a false yes.
    filters = {r.shard: cuckoo.CuckooFilter.from_bytes(bytes(r.body)) for r in held.shards.where("kind = 0").collect()}
    live = [(r.shard, bytes(r.digest)) for r in held.shards.where("kind = 1").collect()]
    assert all(d in filters[s] for s, d in live)
    assert sum(r.n for r in held.shards.where("kind = 0").collect()) == len(live)
    held = exact_dedup.insert(held, docs([(1000, "Hot"), (1001, "new")]))
    assert see() == copies_by_force(left + [(1000, "Hot"), (1001, "new")])


def test_a_filter_that_overflows_is_built_anew_from_its_keys():
    shard = exact_dedup._Shard(0)
    bits = shard.filter.bits
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, d in enumerate(digests):
        shard.come(d, i, 1, b"%d" % i)
    assert shard.filter.bits > bits and all(d in shard.filter for d in digests)
    for d in digests[:2000]:
        shard.go(d, None, 1)
    assert set(shard.content) == set(digests[2000:]) and all(d in shard.filter for d in digests[2000:])
    assert sum(d in shard.filter for d in digests[:2000]) < 20
    assert np.count_nonzero(shard.filter.table) == 1000
    again = cuckoo.CuckooFilter.from_bytes(shard.filter.to_bytes())
    assert again.bits == shard.filter.bits and (again.table == shard.filter.table).all()


def test_a_false_hit_is_a_new_text():
    shard = exact_dedup._Shard(0)
    one, other = b"a" * 32, b"b" * 22 + b"a" * 10
    shard.come(one, 1, 1, b"one")
    assert other in shard.filter
    shard.come(other, 2, 1, b"other")
    shard.go(b"c" * 22 + b"a" * 10, None, 1)
    assert shard.content == {one: [1, 1, b"one"], other: [2, 1, b"other"]}
    shard.go(one, None, 1)
    assert other in shard.filter and list(shard.content) == [other]


def test_texts_are_sent_once_for_every_hold(spark, monkeypatch):
    rows = [(i, "copy") for i in range(500)] + [(1000 + i, f"single {i}") for i in range(20)]
    sent = exact_dedup._sent(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), 6, 2).collect()
    assert len(sent) == 21 and {(r.n, r.top) for r in sent if bytes(r.body) == b"copy"} == {(500, 499)}
