"""Operators on single texts: results against plain Python and public libraries,
and the defined results for nulls, empty and long texts, repeated rows, empty
tables and clashing column names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from quayside.llm import boosted_quality, html_main, licence_scan, line_rules, mixture_shards, prefix_bpe, token_counts, vector_packing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, sequence_id long"
TEXTS = [
    None, "", " \n\t ", "one", "The same line here.\nThe same line here.\nAnother one stands here.", "a b c d e f g a b c d e f g a b c d e",
    "naïve café — ½ ² 日本語 テスト", "x" * 3000, "word " * 4000, "<|endoftext|> a<|endoftext|>b", "don't  stop\r\n\r\n now",
    "Home | About | Contact | Help\nThis is a fine long sentence that ends with a mark.", "Released under the MIT License.",
]


def docs(spark, texts=TEXTS):
    rows = [(k, t, "en", None if k % 3 == 0 else f"s{k % 2}", 0, 5, 0.5, 9) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[4:6], SCHEMA)


def by_id(df, id="doc_id"):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r[id]].append(r)
    return out


def test_prefix_bpe_equals_the_library(spark):
    ranks = prefix_bpe.read_ranks(open(RANKS, "rb").read())
    want = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(prefix_bpe.encode_documents(docs(spark), RANKS, public_tokenizers.PATTERN))
    digests = by_id(prefix_bpe.encode_digests(docs(spark), RANKS, public_tokenizers.PATTERN))
    assert sum(map(len, got.values())) == len(TEXTS) + 2
    for k, text in enumerate(TEXTS):
        ids = want.encode_ordinary(text or "")
        assert list(got[k][0].token_ids) == ids
        assert bytes(got[k][0].decoded) == (text or "").encode()
        d = digests[k][0]
        assert (d.n_tokens, d.ids_sha256, d.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert prefix_bpe.encode_digests(docs(spark).limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_prefix_table_appends_and_edits_exactly():
    v = prefix_bpe.Vocabulary(prefix_bpe.read_ranks(open(RANKS, "rb").read()))
    rng = random.Random(5)
    for _ in range(150):
        data = bytes(rng.choice(b"thenraosig \xc3\xa91") for _ in range(rng.randrange(1, 30)))
        cut = rng.randrange(len(data) + 1)
        table = prefix_bpe.PrefixTable(v, data[:cut]).append(data[cut:])
        assert table.tokens() == prefix_bpe.merge_by_rank(data, v.ranks)
        a, b = sorted((rng.randrange(len(data) + 1), rng.randrange(len(data) + 1)))
        edited = data[:a] + b"ing" + data[b:]
        assert table.replace(a, b, b"ing").tokens() == prefix_bpe.merge_by_rank(edited, v.ranks)
    with pytest.raises(ValueError):
        prefix_bpe.Vocabulary({b"a": 0})


def test_token_counts_equal_the_library(spark):
    want = Tokenizer.from_file(BYTE_BPE)
    got = by_id(token_counts.count_tokens(docs(spark), BYTE_BPE, limit=100))
    for k, text in enumerate(TEXTS):
        n = len(want.encode(text or "", add_special_tokens=False).ids)
        assert got[k][0][1:] == (len((text or "").encode()), n, n > 100)
    assert len(got[4]) == 2
    assert token_counts.count_tokens(docs(spark).limit(0), BYTE_BPE).count() == 0


def test_packing_holds_every_id_once(spark):
    want = Tokenizer.from_file(BYTE_BPE)
    source = docs(spark)
    rows = vector_packing.pack_documents(source, BYTE_BPE, max_tokens=64, max_segments=4, max_loss=60 + 4).collect()
    pieces = by_id(vector_packing.pack_documents(docs(spark, TEXTS).dropDuplicates(["doc_id"]), BYTE_BPE, 64, 4))
    for k, text in enumerate(TEXTS):
        ids = want.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for p in sorted(pieces[k], key=lambda p: p.start):
            part = np.array(ids[p.start:p.start + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += p.length
        assert at == len(ids)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for held in sequences.values():
        held.sort(key=lambda r: r.offset)
        assert [r.offset for r in held] == list(np.cumsum([0] + [r.length for r in held])[:-1])
        assert sum(r.length for r in held) <= 64 and len(held) <= 4
    assert vector_packing.pack_documents(source.limit(0), BYTE_BPE).count() == 0


def test_placing_respects_all_three_limits():
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 100, 500)
    loss = np.minimum(tokens, rng.integers(0, 60, 500))
    sequence, offset = vector_packing.place(tokens, loss, 128, 5, 64)
    for s in range(sequence.max() + 1):
        held = sequence == s
        assert tokens[held].sum() <= 128 and held.sum() <= 5 and loss[held].sum() <= 64
        order = np.argsort(offset[held])
        assert (np.cumsum(tokens[held][order]) - tokens[held][order] == offset[held][order]).all()
    none = np.zeros(0, np.int64)
    assert len(vector_packing.place(none, none, 10, 1, 10)[0]) == 0
    with pytest.raises(ValueError):
        vector_packing.place(np.array([11]), np.array([1]), 10, 1, 10)


def plain_rules(text):
    text = text or ""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    words = word.findall(text)
    lines = [x for x in text.split("\n") if word.search(x)]
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    marked = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked), failed)


def test_line_rules_against_plain_python(spark):
    df = docs(spark)
    measured = line_rules.measure(df)
    assert measured.columns == [*df.columns, "rules"]
    got = by_id(measured)
    for k, text in enumerate(TEXTS):
        r = got[k][0].rules
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_rules(text), text
        assert not (r.base_failed and r.kept)
    assert line_rules.measure(df.limit(0)).count() == 0
    assert "Python" not in measured._jdf.queryExecution().toString()


def test_line_rules_verdict(spark):
    prose = "This line is ordinary prose that goes on for a while and then stops.\n"
    menu = "Home | News | Sport | Weather | Contact | About us | Legal | Careers\n"
    cases = [prose * 1 + "Another line of ordinary prose follows it here.", prose + menu * 1 + menu.replace("Home", "Top") + menu.replace("Home", "Shop"),
             "wow### this$$$ is%%% full*** of&&& marks### and### more### and### more###", prose + "Click here to accept cookies."]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    kept = {r.doc_id: r.rules.kept for r in line_rules.measure(df).collect()}
    assert kept == {0: True, 1: False, 2: False, 3: True}
    cleaned = {r.doc_id: r.t for r in df.select("doc_id", line_rules.clean(df.text).alias("t")).collect()}
    assert cleaned[3] == prose.rstrip("\n") and cleaned[1] == prose


def test_shards_follow_the_mixture(spark):
    rows = [(k if k % 7 else 7, f"t{k}" if k % 5 else None, "a" if k % 3 == 0 else (None if k % 3 == 1 else "b")) for k in range(1, 1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixture_shards.interleave(df, 24).collect()
    assert len(got) == len(rows)
    shards = collections.defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    sizes = [len(v) for v in shards.values()]
    assert set(shards) == set(range(24)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in shards.values())
    whole = collections.Counter(r.stratum for r in got)
    for v in shards.values():
        part = collections.Counter(r.stratum for r in v)
        assert all(abs(part[s] - whole[s] * len(v) / len(got)) <= 2 for s in whole)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert mixture_shards.interleave(df.limit(0), 24).count() == 0


def test_licences(spark):
    mit = " ".join(licence_scan.SENTENCES["MITGrant"][0].split())
    cases = {
        "Some prose. Released under the MIT License. More prose.": (["MIT"], "permissive"),
        "a | b | c\nThis work is licensed under the GNU General Public License, version 3.\nx": (["GPL-3.0-only"], "copyleft"),
        "/* MIT License\n *\n * Copyright (c) 2020 A Person\n *\n * " + mit.replace("without restriction", "without\n * restriction") + "\n */": (["MIT"], "permissive"),
        '# Licensed under the Apache License, Version 2.0\n# (the "License"); you may not use this file except in compliance with the License.': (["Apache-2.0"], "permissive"),
        "// SPDX-License-Identifier: GPL-3.0-only\nint x;": (["GPL-3.0-only"], "copyleft"),
        "This tool is licensed under the Foo License.": (["unknown"], "unknown"),
        "Released under the MIT License. All rights reserved.": (["MIT", "all-rights-reserved"], "restricted"),
        "He warranted no permission to redistribute his thoughts": ([], "none"),
    }
    texts = [*cases, None, "", "word. " * 30000 + "Licensed under CC BY-NC 4.0."]
    got = by_id(licence_scan.scan_licences(docs(spark, texts)))
    for k, (licences, kind) in enumerate(cases.values()):
        assert (list(got[k][0].licences), got[k][0].licence_kind) == (licences, kind), texts[k]
    n = len(cases)
    assert [got[n + k][0].licence_kind for k in range(3)] == ["none", "none", "restricted"]
    assert licence_scan.scan_licences(docs(spark).limit(0)).count() == 0


def test_every_known_sentence_is_found_alone():
    own = licence_scan.SentenceRules({"Own": ["Use it as you like"]}, [("own", "permissive", ["Own"])])
    assert own.scan("Words. Use it as you\n like. Words.") == (["Own"], ["own"], "permissive")
    rules = licence_scan.SentenceRules()
    for name, forms in licence_scan.SENTENCES.items():
        for form in forms:
            assert rules.scan(f"{form}.")[0] == [name], form
            assert rules.scan("# " + form.upper().replace(" ", "\n# "))[0] == [name], form
    assert rules.scan("Released under CC0 1.0.")[1:] == (["CC0-1.0"], "permissive")


def test_quality_trees(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choice("the river runs over old stones and under green trees".split()) for _ in range(60)) + "." for _ in range(150)]
    bad = [" | ".join(rng.choice("buy### cheap$$$ now%%%".split()) for _ in range(60)) for _ in range(150)]
    texts = [t for pair in zip(good, bad) for t in pair] + [None, "", "x " * 50000]
    df = spark.createDataFrame([(k, t, 0.1, "z") for k, t in enumerate(texts)], "doc_id long, text string, score double, quality string")
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(300)] + [(3, None), (None, 1), (10**9, 1)], "doc_id long, quality int")
    model = boosted_quality.train(df, labels)
    scored = boosted_quality.score(df, model, name="p").withColumn("held", boosted_quality.held_out()).collect()
    assert all(0 <= r.p <= 1 for r in scored)
    held = [r for r in scored if r.held and r.doc_id < 300]
    assert held and all((r.p >= 0.7) == (r.doc_id % 2 == 0) for r in held)
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)
    # labels of held-out rows change nothing
    other = spark.createDataFrame([(k, k % 2 if zlib.crc32(str(k).encode()) % 4 == 2 else 1 - k % 2) for k in range(300)], "doc_id long, quality int")
    again = boosted_quality.score(df, boosted_quality.train(df, other), name="p").collect()
    assert {r.doc_id: r.p for r in again} == {r.doc_id: r.p for r in scored}
    nothing = boosted_quality.train(df.limit(0), labels.limit(0))
    assert {r.p for r in boosted_quality.score(df, nothing, name="p").collect()} == {0.5}


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    model = boosted_quality.fit_trees(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float), trees=10, depth=3)

    def walk(row):
        total = model.base
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.predict(x), [walk(r) for r in x])


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("bits", [1 << 27, 16])
def test_common_lines_are_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(html_main, "TABLE_BITS", bits)
    rng = random.Random(3)
    for _ in range(1500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        found = html_main.common_lines(np.array(a, np.int64), np.array(b, np.int64))
        rest = iter(b)
        assert len(found) == longest(a, b) and all(a[i] in rest for i in found)


def test_pages_lose_what_neighbours_share(spark):
    page = "<html><head><title>T</title></head><body><div><p>Site name</p><p>Join us now</p></div><p>{}</p><p>{}</p><div><p>Made by us</p></div></body></html>"
    rows = [(k, f"http://a.example.org/x/{k}", page.format(f"First unique words of page {k} " * 5, f"More &amp; more of page {k}<br>here " * 5)) for k in range(12)]
    article = '<body><nav><a>Menu</a></nav><article><h1>Title</h1><p>A  text\n of <b>one</b> block</p><p>Same sentence.</p><div class="comments"><p>Nice</p></div></article><aside>Side</aside><footer>F</footer>'
    rows += [(100, "https://b.example.org/1.html", article), (101, "https://b.example.org/2", article.replace("Title", "Other")),
             (102, None, None), (103, "http://c.example.org/", ""), (104, "http://d.example.org/", "plain &lt;text"),
             (105, "http://e.example.org/", "<p>" + "long words " * 20000 + "</p><script>var p='</p>';"), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = by_id(html_main.extract_main_text(df), "page_id")
    for k in range(12):
        assert got[k][0].text == "\n".join([f"First unique words of page {k} " * 5, f"More & more of page {k} here " * 5]).replace(" \n", "\n").strip()
    assert len(got[0]) == 2 and got[0][0] == got[0][1]
    assert got[100][0].text == "Title\nA text of one block\nSame sentence." and got[101][0].text.startswith("Other\n")
    assert got[102][0].text == got[103][0].text == "" and got[104][0].text == "plain <text"
    assert got[105][0].text == ("long words " * 20000).strip() and got[105][0].n_chars == len(got[105][0].text)
    assert html_main.extract_main_text(df.limit(0)).count() == 0


def page_texts(pages):
    """Main texts of pages of one host, in the order of their paths."""
    outlines = [html_main.lines_of(p) for p in pages]
    ids = [np.array([zlib.crc32(t.encode()) for t in ts], np.int64) for ts, _ in outlines]
    chars = [np.array([len(t) for t in ts], np.int64) for ts, _ in outlines]
    sides = [html_main.others(ids, chars, ["h"] * len(pages), step) for step in (-1, 1)]
    return [html_main.main_text(ts, roles, html_main.shared_lines(ids[k], [ids[s[k]] for s in sides if s[k] is not None])) for k, (ts, roles) in enumerate(outlines)]


def test_the_comparison_decides_where_markup_does_not():
    body = [f"The body of page {k} stands in plain words, {k * 7919} of them." for k in range(4)]
    teaser = ["<div><p>Home</p><p>Shop</p></div><div><p>%s</p></div><article><p>Teaser %d</p></article>" % (b, k) for k, b in enumerate(body)]
    assert page_texts(teaser) == [f"{b}\nTeaser {k}" for k, b in enumerate(body)]
    menus = ["<main><ul><li>Home</li><li>Shop</li></ul><h1>News</h1><p>%s</p><p>It is the same here.</p></main>" % b for b in body]
    assert page_texts(menus) == [f"News\n{b}\nIt is the same here." for b in body]
    frame = "<p>Home and shop and news and all that the site has to say at length on every page</p><p>%s</p>"
    assert page_texts([frame % "Short one", frame % "Other two 2 2"]) == ["Short one", "Other two 2 2"]
    copies = ["<p>Site</p><p>%s</p>" % body[k] for k in (0, 0, 0, 1)]
    assert page_texts(copies) == [body[0]] * 3 + [body[1]]


def test_a_name_does_not_take_the_page():
    text = "<h1 id='navigation'>Title</h1><section id='social-history'><h2 id='related-work'>Part</h2><p data-hidden='false' title='the hidden valley'>Words.</p></section>"
    want = "Title\nPart\nWords."
    for opened in ("<article>", "<div class='layout no-sidebar'><article>", "<div class='container with-sidebar'><main>", "<div class='sidebar'><article>"):
        assert page_texts([f"<body><div class='ad'>Buy this</div>{opened}{text}"]) == [want], opened
    plain = ["<div class='layout no-sidebar'><p>Site</p><p>Words of page %d.</p></div>" % k for k in range(2)]
    assert page_texts(plain) == ["Words of page 0.", "Words of page 1."] and page_texts(plain[:1]) == ["Site\nWords of page 0."]
    assert page_texts(["<body><p>Text</p><p hidden>No</p><p style='display: none'>No</p><article><p>Much more text.</p></article>"]) == ["Much more text."]
