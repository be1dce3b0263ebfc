"""Trained operators: decoding and marginals against enumeration, held-out accuracy, and edge cases."""

import hashlib
import itertools
import math
import random
import re
import textwrap

import numpy as np
import pytest

from logweave.llm import html_extract, html_samples, html_tree, language, licenses, mixing, quality_rules, secret_samples, secrets


def test_language_viterbi_is_the_best_path():
    r = np.random.default_rng(1)
    first = np.array([0, 4, 4, 9, 10])
    scores = r.normal(size=(10, 3)) * 3
    got = language.viterbi(scores, first, 2.0)
    for a, b in zip(first[:-1], first[1:]):
        ways = itertools.product(range(3), repeat=b - a)
        value = lambda w: sum(scores[a + i, x] for i, x in enumerate(w)) - 2.0 * sum(x != y for x, y in zip(w, w[1:]))
        best = max(ways, key=value)
        assert math.isclose(value(tuple(got[a:b].tolist())), value(best), abs_tol=1e-9)


def test_language_viterbi_with_many_languages(spark):
    r = np.random.default_rng(2)
    k, first = 200, np.array([0, 3, 3, 40, 41])
    scores = r.normal(size=(41, k)) * 3
    scores[:, 150:] += 2
    got = language.viterbi(scores, first, 4.0)
    for a, b in zip(first[:-1], first[1:]):
        own, best = got[a:b].tolist(), np.zeros(k)
        for i in range(a, b):
            best = (np.maximum(best, best.max() - 4.0) if i > a else best) + scores[i]
        assert all(0 <= x < k for x in own)
        assert own == [] or math.isclose(sum(scores[a + i, x] for i, x in enumerate(own)) - 4.0 * sum(x != y for x, y in zip(own, own[1:])), best.max())

    word = lambda i: "".join(chr(97 + int(d)) * 3 for d in f"{i:03d}")
    docs = spark.createDataFrame([(i, " ".join([word(i)] * 5), f"l{i:03d}") for i in range(200)], "doc_id bigint, text string, lang string")
    rows = language.identify(docs, language.train(docs), "doc_id", "lang").collect()
    assert len(rows) == 200 and {x.lang_pred for x in rows} <= {x.lang for x in rows}
    assert all(x.lang_pred == x.lang for x in rows if x.doc_id in (0, 127, 128, 199))


LANGS = {"aa": "ka ko ki kan tok mik", "bb": "zub zeb drub ubz brez", "ru": "да нет мир дом лес"}


def speak(r, lang, n):
    return " ".join(r.choice(LANGS[lang].split()) + r.choice(LANGS[lang].split()) for _ in range(n))


def test_languages_spans_and_edges(spark):
    r = random.Random(3)
    rows = [(i, speak(r, lang, r.randint(3, 40)), lang, "x", 0.5) for i, lang in enumerate(list(LANGS) * 40)]
    schema = "doc_id bigint, text string, lang string, spans string, score double"
    docs = spark.createDataFrame(rows + [(900, None, "aa", "x", 1.0), (901, "kako", None, "x", 1.0)], schema)
    model = language.train(docs)
    assert model.langs == sorted(LANGS)
    mixed = speak(r, "aa", 20) + " " + speak(r, "bb", 8)
    asked = [(1, mixed), (2, None), (3, ""), (4, "12 34 --"), (5, "дом лес 7"), (6, "ქართული"), (None, speak(r, "bb", 5)), (7, mixed), (8, "ka " * 30_000)]
    asked = spark.createDataFrame([(i, t, "k", "s", 0.0) for i, t in asked], schema)
    got = {x.doc_id: x for x in language.identify(asked, model, *asked.columns).collect()}
    assert [(x["first"], x["last"], x["lang"]) for x in got[1].spans] == [(0, 19, "aa"), (20, 27, "bb")]
    assert got[1].lang_pred == "aa" and 0.5 < got[1].score < 1 and got[7].spans == got[1].spans and got[1].lang == "k"
    assert [(got[i].lang_pred, got[i].score) for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert got[5].lang_pred == "ru" and got[None].lang_pred == "bb" and got[8].lang_pred == "aa"
    assert got[6].lang_pred in LANGS
    none = language.train(docs.limit(0))
    assert [x.lang_pred for x in language.identify(asked.limit(1), none, "doc_id").collect()] == ["und"]
    assert language.identify(asked.limit(0), model, "doc_id").collect() == []


def test_language_held_out_accuracy(spark, tmp_path):
    r = random.Random(4)
    rows = [(i, speak(r, lang, r.randint(2, 30)), lang) for i, lang in enumerate(list(LANGS) * 80)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = language.op9_language_id(spark, str(tmp_path)).collect()
    want = {i: lang for i, _, lang in rows}
    held = [x for x in got if x.held_out]
    assert len(held) > 20 and all(x.lang_pred == want[x.doc_id] for x in held) and all(0 <= x.score <= 1 for x in got)


@pytest.fixture(scope="module")
def tagger():
    return secrets.fit([secrets._labelled(*x) for x in secrets.made_lines(500)], steps=80)


def test_field_viterbi_is_the_best_path():
    r = np.random.default_rng(2)
    first, unary = np.array([0, 0, 5, 6, 10]), r.normal(size=(10, 3))
    model = secrets.Model(np.zeros((1, 3)), r.normal(size=(3, 3)), r.normal(size=3))
    got = secrets.viterbi(unary, first, model)
    for a, b in zip(first[:-1], first[1:]):
        value = lambda w: (model.begin[w[0]] if w else 0) + sum(unary[a + i, x] for i, x in enumerate(w)) + sum(model.moves[x, y] for x, y in zip(w, w[1:]))
        best = max(itertools.product(range(3), repeat=b - a), key=value)
        assert math.isclose(value(tuple(got[a:b].tolist())), value(best), abs_tol=1e-9)


def test_field_finds_held_out_secrets(tagger):
    right = wrong = missed = 0
    for text, spans in secret_samples.lines(200, seed=77):
        rows, gold = secrets._labelled(text.encode(), [(len(text[:a].encode()), len(text[:b].encode())) for a, b in spans])
        said = secrets.viterbi(secrets.scores(rows, tagger.weights), np.array([0, len(rows)]), tagger)
        right += int(((said > 0) & (gold > 0)).sum())
        wrong += int(((said > 0) & (gold == 0)).sum())
        missed += int(((said == 0) & (gold > 0)).sum())
    assert right > 100 and wrong <= 0.03 * right and missed <= 0.05 * right


def base_by_force(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"(?:(?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16])


def test_base_spans_stay_as_the_patterns_give_them(spark, tmp_path):
    key = "AKIA" + "ABCDEFGHIJKLMNOP"
    bodies = [None, "", "é Password : 'abcdefghijkl' x", "token=short", 'ſecret="abcdefghijklmn"', f"ü {key} é 0123456789abcdef0", "secret = token=abcdefghijklmnop",
              "ApiKey='0123456789abcdef0123'", "a" * 100_000 + " api_key: zzzzzzzzzzzz", "TOKEN:x token:yyyyyyyyyyyyy", f"{key}", f"token = {key}"] * 2
    rows = [(i, t) for i, t in enumerate(bodies)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for x in secrets.op1_secret_scan(spark, str(tmp_path)).collect():
        base = base_by_force(bodies[x.doc_id] or "")
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert x.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [x.n_assign, x.n_access, x.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(said.split(",")) <= set(x.spans.split(","))


def test_secrets_of_empty_tables_and_clashing_names(spark, tagger):
    docs = spark.createDataFrame([(1, "password is Xy7Qp9Lm2Kd8Rt4Z now", "mine", "b")], "doc_id bigint, text string, spans string, body string")
    got = secrets.find_secrets(docs, *docs.columns, model=tagger).collect()
    assert [(s.kind, docs.first().text[s.start : s.end]) for s in got[0].spans] == [("crf", "Xy7Qp9Lm2Kd8Rt4Z")]
    assert secrets.find_secrets(docs.limit(0), "doc_id").collect() == []


def test_sum_product_gives_exact_marginals():
    r = np.random.default_rng(3)
    trees = [html_tree.read(x) for x in ("<div><p>a<p>b</div>c", "<p>x")]
    f = html_extract.forest(trees)
    unary, edges = r.normal(size=(len(f.parent), 2)), r.normal(size=(html_extract.EDGES, 2, 2))
    single, joint, _ = html_extract.sum_product(f, unary, edges)
    total, marginal, pair = 0.0, np.zeros((len(unary), 2)), np.zeros((len(unary), 2, 2))
    for y in itertools.product((0, 1), repeat=len(unary)):
        w = math.exp(sum(unary[i, c] for i, c in enumerate(y)) + sum(edges[f.kind[i], y[p], y[i]] for i, p in enumerate(f.parent) if p >= 0))
        total += w
        for i, p in enumerate(f.parent):
            marginal[i, y[i]] += w
            if p >= 0:
                pair[i, y[p], y[i]] += w
    assert np.allclose(np.exp(single), marginal / total)
    own = f.parent >= 0
    assert np.allclose(np.exp(joint[own]), pair[own] / total)


def test_pages_of_other_layouts_are_read(spark):
    wrong = total = 0
    model = html_extract.trained()
    for page in html_samples.pages(120, seed=991):
        tree, gold = html_extract.labelled(page)
        f = html_extract.forest([tree])
        said = html_extract.sum_product(f, html_extract.unary_of(f, model.weights), model.edges)[0][:, 1] > math.log(0.5)
        leaf = np.array(tree.tag) < 0
        wrong, total = wrong + int((said != gold)[leaf].sum()), total + int(leaf.sum())
    assert wrong <= 0.01 * total


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav>
<div class="cookie-banner"><p>We use cookies for this site.</p></div><article><h1>A &amp; B</h1><p>One&nbsp;two
 three &lt;tag&gt; and so on for a while.<br>More text here, with <b>bold<p>Second paragraph is long enough to be read. &copy &am</article>
<form><p>Write to us now</p></form><section id=comments><p>I like it very much.</p></section><footer>&copy; me</footer>"""


def test_page_text_is_whole_and_decoded(spark):
    rows = [(1, "u", PAGE, "t", 1), (2, "v", None, "t", 1), (3, "w", "", "t", 1), (4, "x", "<p", "t", 1), (5, "y", "<div" * 2000, "t", 1), (None, None, PAGE, "t", 1), (6, "z", "<!-- <article>", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    got = {x.page_id: x for x in html_extract.extract(pages, *pages.columns).collect()}
    want = "A & B\n\nOne two three <tag> and so on for a while. More text here, with bold\n\nSecond paragraph is long enough to be read. © &am"
    assert got[1].text == want and got[1].n_chars == len(want) and got[None].text == want
    assert [got[i].text for i in (2, 3, 4, 6)] == [""] * 4
    assert html_extract.extract(pages.limit(0), "page_id").collect() == []


def test_reader_closes_what_browsers_close():
    def shape(page):
        t = html_tree.read(page)
        names = list(html_tree.TAGS)
        return [(names[t.tag[p]], t.text[i]) for i, p in enumerate(t.parent) if t.tag[i] < 0]

    assert shape("<p>a<div>b</p>c</div>") == [("p", "a"), ("div", "b"), ("div", "c")] or shape("<p>a<div>b</p>c</div>")[:2] == [("p", "a"), ("div", "b c")]
    assert shape("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == [("li", "a"), ("li", "b"), ("li", "c"), ("li", "d"), ("html", "e")]
    assert shape("<table><tr><td>a<td>b<tr><td>c</table>") == [("td", "a"), ("td", "b"), ("td", "c")]
    assert shape('<p title="a>b">x</p><a href=\'>\'>y</a> 1 < 2') == [("p", "x"), ("html", "y 1 < 2")]
    assert shape("<STYLE>p{}</STYLE><P CLASS=x>a</P><textarea><p>no</textarea>") == [("p", "a")]


def test_reader_goes_on_after_skipped_elements():
    def words(page):
        return " ".join(html_tree.read(page).text).split()

    for name in sorted(html_tree.SKIPPED):
        assert words(f"<div>a<{name} class=x>no<p>no</p></{name}> b</div>") == ["a", "b"]
        assert words(f"<body><{name}><article><p>whole text</p></article>")[-2:] == ["whole", "text"]
        assert words(f"<body><div><{name}></div><article><p>whole text</p></article><div><{name}>no</{name}></div>")[-2:] == ["whole", "text"]
        assert words(f"<body><{name}/><p>text</p>") == ["text"]
    assert words("<object>no<object>no</object>no</object>a<svg><svg></svg>no</svg>b") == ["a", "b"]
    assert words("<button>go<p>text<button>no</button>") == ["go", "text"]
    assert words("<p>so <math><mi>x</mi> <mo>=</mo> <mn>2</mn></math> holds") == ["so", "x", "=", "2", "holds"]
    assert words("a<button title='</button>'>no</button>b<!-- <svg> --> <script>'<svg>'</script>c<svg></svg>") == ["a", "b", "c"]
    assert words("a<script>b") == ["a"] and words("a<textarea><p>no</textarea>b") == ["a", "b"]
    assert len(words("<svg><p>x" * 3000)) == 3000


#: Words, what stands between them, what ends a sentence.
PROSE = {
    "zh": ("\u6211\u4eec \u4eca\u5929 \u4e00\u8d77 \u53bb \u516c\u56ed \u770b\u82b1 \u5929\u6c14 \u5f88 \u597d \u5b66\u6821 \u8001\u5e08", "", "\u3002"),
    "th": ("\u0e27\u0e31\u0e19 \u0e19\u0e35\u0e49 \u0e2d\u0e32\u0e01\u0e32\u0e28 \u0e14\u0e35 \u0e21\u0e32\u0e01 \u0e40\u0e23\u0e32 \u0e44\u0e1b \u0e40\u0e17\u0e35\u0e48\u0e22\u0e27", "", "\u2026"),
    "ar": ("\u0630\u0647\u0628 \u0627\u0644\u0648\u0644\u062f \u0625\u0644\u0649 \u0627\u0644\u0645\u062f\u0631\u0633\u0629 \u0641\u064a \u0627\u0644\u0635\u0628\u0627\u062d \u0643\u0630\u0644\u0643", " ", "\u061f"),
    "hi": ("\u0932\u0921\u093c\u0915\u093e \u0938\u0941\u092c\u0939 \u0935\u093f\u0926\u094d\u092f\u093e\u0932\u092f \u091c\u093e\u0924\u093e \u0939\u0948 \u0914\u0930 \u092a\u0922\u093c\u0924\u093e", " ", "\u0964"),
    "ru": ("\u043c\u0430\u043b\u044c\u0447\u0438\u043a \u0443\u0442\u0440\u043e\u043c \u0448\u043a\u043e\u043b\u0443 \u0438\u0434\u0451\u0442 \u0447\u0438\u0442\u0430\u0442\u044c \u0438 \u043f\u0438\u0441\u0430\u0442\u044c", " ", "."),
    "en": ("the boy went to school in morning and learned read write", " ", "."),
}


def test_prose_of_every_script_is_kept(spark):
    r = random.Random(6)
    rows = []
    for i, (words, between, stop) in enumerate(PROSE.values()):
        words = words.split()
        rows.append((i, " ".join(between.join(r.choice(words) for _ in range(r.randint(6, 12))) + stop for _ in range(60))))
    rows += [(90, " ".join("\U0001F600" * (1 + k % 3) + str(k) for k in range(30))), (91, " ".join(f"\u2014\u2014{k}" for k in range(30)))]
    got = {x.doc_id: x for x in quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", rules=quality_rules.RULES).collect()}
    assert [got[i].rejected_by for i in range(len(PROSE))] == [None] * len(PROSE)
    assert {got[90].rejected_by, got[91].rejected_by} <= {"letters", "digits"}


def test_kinds_of_characters():
    import unicodedata

    r = random.Random(3)
    text = "".join(chr(x) for x in [r.choice((r.randrange(32, 128), r.randrange(0xA0, 0xD800), r.randrange(0xE000, 0x32000))) for _ in range(4000)]) + quality_rules.STOPS
    data = np.frombuffer(text.encode(), np.uint8)
    own = quality_rules.kinds(data)[(data & 0xC0) != 0x80]
    for x, kind in zip(text, own.tolist(), strict=True):
        if ord(x) < 0x20000:
            assert (kind & 1 > 0) == (unicodedata.category(x)[0] in "LM"), hex(ord(x))
        assert (kind & 2 > 0) == any(a <= ord(x) <= b for a, b in quality_rules.UNSPACED) and (kind & 4 > 0) == (x in quality_rules.STOPS)


def test_cascade_order_and_verdicts(spark):
    good = " ".join(f"word{i} text." for i in range(30))
    rows = [(1, good), (2, "WORD AND SHOUT, " * 3 + " ".join(f"UPPER{chr(65 + i)}." for i in range(26))), (3, None), (4, ""), (5, " ".join(f"w{i}***." for i in range(40))), (6, good), (None, good), (7, "a b " * 50)]
    docs = spark.createDataFrame([(i, t, 1, "b") for i, t in rows], "doc_id bigint, text string, n_words int, body string")
    one = {(x.doc_id, x.n_words): x.rejected_by for x in quality_rules.judge(docs, "doc_id", "n_words").collect()}
    two = {(x.doc_id, x.n_words): x.rejected_by for x in quality_rules.judge(docs, "doc_id", rules=quality_rules.RULES[::-1]).collect()}
    assert {k: v is None for k, v in one.items()} == {k: v is None for k, v in two.items()}
    assert {k[0]: v for k, v in one.items()} == {1: None, 2: "upper_case", 3: "base", 4: "base", 5: "symbols", 6: None, None: None, 7: "base"}
    assert quality_rules.judge(docs.limit(0), "doc_id").collect() == []
    rules = quality_rules.RULES[:3]
    bad = np.array([[1, 1, 0]] * 6 + [[0, 1, 0]] * 2 + [[0, 0, 1]] * 2, bool)
    assert [r.name for r in quality_rules.ordered(rules, bad, np.array([1.0, 1.0, 1.0]))] == [rules[1].name, rules[2].name, rules[0].name]
    assert quality_rules.ordered(rules, bad, np.array([1.0, 9.0, 9.0]))[0] == rules[0]


FILES = [
    ("a/LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("a/x.py", "print(1)"), ("a/b/y.py", "code\n# Licensed under the Apache License, Version 2.0.\ncode"), ("a/b/z.py", None), ("a/b/c/LICENSE.md", "This work is licensed under the GNU General Public License, version 3."),
    ("a/b/c/q.py", ""), ("d/x.py", "the license of a driver"), (None, "Released under the MIT License."), ("top.py", "x"), ("a/x.py", "print(1)"),
    ("e/h.c", "/* Licensed under the Apache License, Version 2.0 (the License);\n * you may not use this file except in compliance with the License.\n */\nint main;"),
]


def test_licences_and_their_folders(spark):
    files = spark.createDataFrame([(p, t, "old", 3) for p, t in FILES], "path string, text string, license string, score int")
    got = [(x.path, x.own_license, x.license, x.folder_of_license) for x in licenses.scan(files).collect()]
    assert sorted(got, key=str) == sorted([
        ("a/LICENSE", "MIT", "MIT", None), ("a/x.py", None, "MIT", "a"), ("a/x.py", None, "MIT", "a"), ("a/b/y.py", "Apache-2.0", "Apache-2.0", None), ("a/b/z.py", None, "MIT", "a"),
        ("a/b/c/LICENSE.md", "GPL-3.0", "GPL-3.0", None), ("a/b/c/q.py", None, "GPL-3.0", "a/b/c"), ("d/x.py", None, None, None), (None, "MIT", "MIT", None), ("top.py", None, None, None),
        ("e/h.c", "Apache-2.0", "Apache-2.0", None)], key=str)
    assert licenses.scan(files.limit(0)).collect() == []


def test_repeated_files_hold_the_same_notices(spark):
    apache = next(t for n, t in licenses.NOTICES if n == "Apache-2.0" and len(t) > 100).split(" ")
    header = "\n".join(" ".join(apache[i : i + 12]) for i in range(0, len(apache), 12))
    header = "import os\n" + header + "\nprint(1)"
    rows = [("one/a.c", header)] + [("many/a.c", header)] * 5 + [(None, header)] * 4 + [("a/LICENSE", header)] * 3
    files = spark.createDataFrame(rows, "path string, text string")
    found = licenses.notices(files.where("path = 'one/a.c'")).collect()
    assert len(found) == 1
    whole = [sorted(found[0].terms)]
    for where in ("path = 'many/a.c'", "path IS NULL", "path = 'a/LICENSE'"):
        got = licenses.notices(files.where(where)).where("notice >= 0").distinct().collect()
        assert [sorted(x.terms) for x in got] == whole
    scores = {(x.own_license, x.own_score) for x in licenses.scan(files.where("path IS NULL OR path NOT LIKE '%LICENSE'")).collect()}
    assert len(scores) == 1 and scores.pop()[0] == "Apache-2.0"


def wrapped(text, mark):
    return "\n".join("\n".join(mark + x for x in textwrap.wrap(part, 72)) or mark.rstrip() for part in text.split("\n"))


def test_standard_headers_get_their_own_names(spark):
    files, want = [], {}

    def add(name, path, text):
        files.append((path, text))
        want[path] = name

    for name, (subject, kind, version) in {
            "GPL-2.0": ("program", "", "2"), "GPL-3.0": ("program", "", "3"), "AGPL-3.0": ("program", "Affero ", "3"), "LGPL-2.1": ("library", "Lesser ", "2.1"), "LGPL-3.0": ("library", "Lesser ", "3")}.items():
        header = (
            f"Foo, a {subject} for bars. Copyright (C) 2020 A. N. Author\n\nThis {subject} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by "
            f"the Free Software Foundation; either version {version} of the License, or (at your option) any later version.\n\nThis {subject} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details.\n\nYou should have received a copy of the GNU {kind}General Public License "
            f"along with this {subject}; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.")
        add(name, f"src/{name}/a.c", "/*\n" + wrapped(header, " * ") + "\n */\nint main;\n")
        add(name, f"one/{name}/a.py", wrapped(header.replace("\n\n", " "), "# ") + "\nprint(1)\n")
        add(name, f"spdx/{name}/a.c", f"// SPDX-License-Identifier: {name}-or-later\nint main;")
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, "
           "this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
    more = "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    for name, text in (("BSD-2-Clause", bsd), ("BSD-3-Clause", bsd + more)):
        add(name, f"src/{name}/a.c", wrapped(text, " * ") + "\nint main;")
        add(name, f"lic/{name}/LICENSE", "Copyright (c) 2020, A. N. Author\nAll rights reserved.\n\n" + text + licenses._BSD_END)
    add("MPL-2.0", "src/m.c", wrapped("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", " * "))
    for name, kind in (("CC-BY-4.0", "Attribution"), ("CC-BY-NC-4.0", "Attribution-NonCommercial"), ("CC-BY-SA-4.0", "Attribution-ShareAlike")):
        add(name, f"src/{name}.md", f"# Data\n\nThis work is licensed under the Creative Commons {kind} 4.0 International License.\n")
    for x in licenses.TEXTS.glob("*.txt"):
        add(x.stem, f"lic/{x.stem}/COPYING", x.read_text())
    assert len(want) == 30
    rows = licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()
    assert {x.path: x.own_license for x in rows} == want


def weights_by_force(tokens, entropy, repeats):
    whole = sum(tokens)

    def weights(a):
        raw = [(t / whole) ** a for t in tokens]
        return [x / sum(raw) for x in raw]

    def fine(a):
        w = weights(a)
        return -sum(x * math.log(x) for x in w) >= entropy * math.log(len(tokens)) - 1e-12

    def passes(a):
        return max(w * whole / t for w, t in zip(weights(a), tokens))

    grid = [i / 4000 for i in range(4001)]
    best = max((a for a in grid if fine(a)), default=0.0)
    return best if passes(best) <= repeats else min(a for a in grid if passes(a) <= repeats)


@pytest.mark.parametrize("tokens,entropy,repeats", [([900, 50, 30, 20], 0.9, 100.0), ([900, 50, 30, 20], 0.95, 2.0), ([10, 10, 10], 0.99, 4.0), ([5], 0.9, 4.0), ([70, 30], 0.1, 4.0)])
def test_exponent_by_force(spark, tokens, entropy, repeats):
    totals = spark.createDataFrame([(str(i), t) for i, t in enumerate(tokens)] + [("none", 0)], "key string, tokens bigint")
    assert abs(mixing.exponent(totals, entropy, repeats) - weights_by_force(tokens, entropy, repeats)) < 1e-3


def test_mix_fills_budgets(spark):
    r = random.Random(6)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}" if i % 21 else None, "w " * r.randint(0, 40), 9.0, "e") for i in range(1500)]
    docs = spark.createDataFrame(rows + [(9999, "empty", None, 9.0, "e")], "doc_id bigint, source string, text string, at double, epoch string")
    got = mixing.mix(docs, entropy=0.9, blocks=64).collect()
    whole = sum(len(t.split()) for _, _, t, _, _ in rows)
    sums, weights, seen = {}, {}, {}
    for x in got:
        sums[x.source] = sums.get(x.source, 0) + x.n_tokens
        weights[x.source] = x.weight
        seen.setdefault((x.source, x.epoch), []).append(x.doc_id)
        assert 0 <= x["at"] <= 1
    own = {}
    for _, s, t, _, _ in rows:
        own[s] = own.get(s, 0) + len(t.split())
    assert abs(sum(weights.values()) - 1) < 1e-9 and set(weights) == set(own)
    for s, w in weights.items():
        assert abs(sums[s] - w * whole) <= max(own[s] / 64 * 3, 45), s
        assert w * whole / own[s] <= mixing.REPEATS + 1e-6
    for (s, e), ids in seen.items():
        assert len(ids) == len(set(ids))
        if (s, e + 1) in seen:
            assert len(ids) == sum(1 for _, x, _, _, _ in rows if x == s)
    again = mixing.mix(docs, entropy=0.9, blocks=64).collect()
    assert sorted((x.doc_id, x.epoch, x["at"]) for x in again) == sorted((x.doc_id, x.epoch, x["at"]) for x in got)
    assert mixing.mix(docs.limit(0)).collect() == []


def test_word_counts_are_those_of_the_pattern(spark):
    bodies = [None, "", " a\tb\x0bc\n", "é\xa0ü z"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(bodies)], "i int, text string").select("i", mixing.n_tokens().alias("n")).orderBy("i").collect()
    assert [x.n for x in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in bodies]


def test_stages_of_the_corpus_run_against_their_operators(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(12)
    prose = lambda n: " ".join(r.choice(("th", "er", "an", "in", "on", "re")) + r.choice(("ion", "ed", "ing", "at", "es")) + str(r.randint(0, 9)) for _ in range(n))
    item = prose(15)
    base = prose(60)
    near = base.split(" ")
    near[30] = "changed"
    rows = [(i, prose(50), "en", "a", 0) for i in range(10)] + [
        (20, base, "en", "a", 0), (21, base.upper(), "en", "b", 0), (22, " ".join(near), "en", "b", 0), (23, prose(5) + " " + item, "en", "a", 0), (24, "12 34", "en", "a", 0), (25, None, "en", "a", 0),
        (26, "l1 x\nl2 y\nl3 z", "en", "a", 0), (27, "l1 x\nl2 y\nl3 z", "en", "a", 0), (28, "l1 x\nl2 y\nl3 z\nown line here", "en", "a", 0),
        (29, base, "en", "b", 0)]   # one long line again
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, left = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        left.append({x.doc_id for x in docs.collect()})
    assert left[0] == {x[0] for x in rows} - {24, 25}
    assert left[1] == left[0] - {27, 29}
    assert {x.doc_id: (x.text, x.n_chars) for x in docs.collect()}[28] == ("own line here", 13)
    assert left[2] == left[1] - {21, 22}
    assert left[3] == left[2] - {23}
    assert {x.doc_id for x in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= left[3]
