"""Phrases, hard negatives and reply trees against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.llm import hard_negatives, phrase_mining, reply_trees
from quayside.llm.shared import Scratch

# --------------------------------------------------------------------------- phrases


def brute_phrases(rows, least, longest=4):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        if any(l == lang and len(q) > len(p) and b >= least and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for (l, q), b in f.items()):
            continue
        score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return sorted(out)


def mined(spark, rows, least, **options):
    df = spark.createDataFrame([(l, t, 1, "x", 2) for l, t in rows], "lang string, text string, n long, id string, r int").repartition(3)
    got = phrase_mining.mine_phrases(df, least, **options)
    return sorted((r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got.collect())


@pytest.mark.parametrize("block", [250_000, 40])
def test_phrases_equal_brute_force(spark, monkeypatch, block):
    for name, value in (("BLOCK_WORDS", block), ("RELATION_WORDS", 16 if block == 40 else 65536), ("TASK_NAMES", 10 if block == 40 else 250_000)):
        monkeypatch.setattr(phrase_mining, name, value)
    rng = random.Random(4)
    words = ["a", "B", "é", "É", "the", "of", "x\x1cy", "\x00", "zz-top", "ÿ"]
    rows = [(None, None), ("en", ""), ("en", " \t "), (None, "a b. a b"), ("und", "a b a b"), ("en", "a a a a a a a")]
    for k in range(150):
        lang = rng.choice(["en", "en", "en", "de", None])
        rows.append((lang, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ? "]) for _ in range(rng.randrange(60)))))
    rows += [("fr", "New York City Hall opens. in New York City Hall")] * 8
    rows.append(("en", "the of " * 3000))
    want = brute_phrases(rows, 6)
    assert len(want) > 100 and mined(spark, rows, 6) == want


def test_phrases_of_nothing_and_long_counts(spark):
    assert mined(spark, [], 2) == []
    assert mined(spark, [("en", "only once here"), (None, None)], 2) == []
    # Counts whose product with two million passes 64 bits.
    big = spark.createDataFrame([(9_000_000_000_000_000, 9_100_000_000_000_000, 9_200_000_000_000_000)], "f long, l long, r long")
    got = big.selectExpr("CAST(f AS DECIMAL(20,0)) * 2000000 div (CAST(l AS DECIMAL(20,0)) + r) AS s").first().s
    assert got == 2000000 * 9_000_000_000_000_000 // 18_300_000_000_000_000


def test_best_phrases_by_score_count_and_bytes(spark):
    rows = [("en", p, a, 1, 1, 1, s) for p, a, s in (("b", 5, 9), ("a", 5, 9), ("é", 5, 9), ("z", 6, 9), ("y", 1, 10))] + [("de", "q", 1, 1, 1, 1, 1)]
    got = phrase_mining.best_of_each_language(spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long"), 4)
    assert sorted((r.lang, r.rank, r.phrase) for r in got.collect()) == [("de", 1, "q"), ("en", 1, "y"), ("en", 2, "z"), ("en", 3, "a"), ("en", 4, "b")]


def test_parts_of_a_frequent_phrase_are_told_by_few_tasks(spark):
    rows = [np.array([11, 22, 0, 1000 + k, 0], np.uint64).tobytes() for k in range(32)]
    relation = spark.createDataFrame([(bytearray(r),) for r in rows], "ids binary").repartition(32)
    frequent = phrase_mining._added_up(phrase_mining._next_counts(relation, 64), 30).cache()
    name = int(phrase_mining.joined(np.array([11, 22], np.uint64))[1].view(np.int64)[0])
    assert [(r.id, r.n) for r in frequent.collect()] == [(name, 32)]
    known, told = (spark.sparkContext.broadcast(phrase_mining.semi_join_filter(frequent.selectExpr(f"{c} AS id"))) for c in ("id", "told"))
    told_parts = phrase_mining._next_relation(relation, known, told).filter("kind = 'name'").collect()
    assert 1 <= len(told_parts) <= 3 and {(r.id, r.left, r.right) for r in told_parts} == {(name, 11, 22)}


def test_counts_of_two_phrases_of_one_name_are_an_error(spark):
    def counted(*firsts):
        rows = [phrase_mining._count_rows(np.array([5, 9, 5], np.uint64), phrase_mining._marks(np.array([f, 1, f], np.uint64), np.uint32(k)), 64) for k, f in enumerate(firsts)]
        return spark.createDataFrame(pd.concat(rows), "r long, names binary, counts binary, marks binary")

    assert sorted((r.id, r.n) for r in phrase_mining._added_up(counted(7, 7), 2).collect()) == [(5, 4), (9, 2)]
    assert phrase_mining._added_up(counted(7, 8), 9).collect() == []
    with pytest.raises(Exception, match="64-bit"):
        phrase_mining._added_up(counted(7, 8), 4).collect()


def test_two_phrases_of_one_name_are_an_error():
    names = phrase_mining._Names("left")
    list(names.add(np.array([1], np.uint64), np.array([1]), np.array([5], np.uint64)))
    list(names.add(np.array([1], np.uint64), np.array([1]), np.array([6], np.uint64)))
    with pytest.raises(ValueError, match="64-bit"):
        list(names.flush())


# --------------------------------------------------------------------------- hard negatives


def brute_negatives(rows, every, positives=5, negatives=3):
    good = [(i, l, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, l, v in rows
            if i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, (i, l, v) in enumerate(good):
        if i % every:
            continue
        score = lambda w: sum(a * b for a, b in zip(v, w))
        others = [(-score(w), j, m == l) for n, (j, m, w) in enumerate(good) if n != k and len(w) == len(v)]
        for s, j, _ in sorted(o for o in others if o[2])[:positives]:
            fit = sorted(o for o in others if not o[2] and 50 * -s <= 100 * -o[0] <= 95 * -s)
            out += [(i, j, r + 1, o[1], -s, -o[0]) for r, o in enumerate(fit[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("block", [512, 16])
def test_negatives_equal_brute_force(spark, monkeypatch, block):
    if block == 16:
        for name, value in (("BLOCK_ROWS", 16), ("SPAN_BLOCKS", 2), ("PAGE_BLOCKS", 3), ("PAGE_GROUPS", 2)):
            monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 12))
    vectors = [base[k % 6] + rng.normal(size=12) * 0.3 for k in range(160)] + [np.ones(12)] * 30 + [rng.normal(size=12) for _ in range(40)] + [rng.normal(size=3) for _ in range(20)]
    vectors = [[float(np.float32(x)) for x in v] for v in vectors]
    vectors += [None, [], [float("nan")] * 12, [float("inf")] * 12, [None] * 12, [0.0] * 12, [1e30] + [0.0] * 11]
    rows = [(int(i), int(rng.integers(0, 4)), v) for i, v in zip(rng.permutation(len(vectors)), vectors)]
    rows += [(None, 1, vectors[0]), (10_000, None, vectors[0])]
    df = spark.createDataFrame([(i, l, v, 5, "x") for i, l, v in rows], "vec_id long, label int, embedding array<float>, rid long, block string").repartition(4)
    got = sorted(tuple(r) for r in hard_negatives.mine_hard_negatives(df, F.col("vec_id") % 5 == 0).collect())
    want = [w for w in brute_negatives([r for r in rows if r[2] is None or not r[2] or r[2][0] != 1e30], 5)]
    huge = {i for i, _, v in rows if v and v[0] == 1e30}
    # The row of huge parts has scores past 64 bits; the others' rows are compared where it has no say.
    free = {a for a, *_ in want} - huge
    assert {g for g in got if g[0] in free and not huge & {g[1], g[3]}} <= set(want)
    assert len(want) > 200
    plain = df.filter(F.coalesce(~F.array_contains("embedding", F.lit(1e30).cast("float")), F.lit(True)))
    assert sorted(tuple(r) for r in hard_negatives.mine_hard_negatives(plain, F.col("vec_id") % 5 == 0).collect()) == want
    assert hard_negatives.mine_hard_negatives(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_repeated_vectors_are_rows_of_their_own(spark):
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (3, 2, [0.75, 0.0]), (4, 2, [0.75, 0.0]), (2, 2, [0.75, 0.0]), (1, 2, [0.25, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = sorted(tuple(r) for r in hard_negatives.mine_hard_negatives(df, F.col("vec_id") == 0).collect())
    one = [(0, 0, r, i, 65536, 49152) for r, i in ((1, 2), (2, 3), (3, 4))]
    assert got == sorted(one + one)


def test_bounds_hold_and_the_curve_is_one():
    rng = np.random.default_rng(1)
    x, a = np.floor(rng.normal(size=(40, 9)) * 200), np.floor(rng.normal(size=(7, 9)) * 200)
    least, most = hard_negatives.bounds(a, x.min(0)[None], x.max(0)[None])
    scores = hard_negatives.products(a, x)
    assert (scores >= least).all() and (scores <= most).all()
    for bits, dim in ((3, 2), (2, 3), (1, 5)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
        keys = hard_negatives.hilbert_key(grid, bits)
        assert len(set(keys)) == len(grid)
        path = grid[sorted(range(len(grid)), key=lambda k: keys[k])]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()  # neighbours on the curve are neighbours
    big = np.array([[2.0 ** 60, 1.0]])
    assert hard_negatives.products(big, np.array([[4.0, 1.0]]))[0, 0] == 2 ** 62 + 1
    assert hard_negatives.products(big, big)[0, 0] == 2 ** 63 - 1


# --------------------------------------------------------------------------- reply trees


def tree_rows(rng):
    rows = [("t", 0, None, "system", "root", 0.5)]
    for k in range(1, 60):
        rows.append(("t", k, rng.randrange(max(0, k - 6), k), rng.choice(["user", "assistant"]), f"m{k} <|im_end|> \\ <\\|x", rng.random()))
    rows += [("u", 100 + k, 99 + k if k else None, "user" if k % 2 == 0 else "assistant", None if k == 3 else f"{k}\n", None) for k in range(37)]
    rows += [("lost", 200, 999, "assistant", "parent is not there", 1.0), ("lost", 201, 200, None, "", 1.0)]
    rows += [("ring", 300, 301, "user", "a", 1.0), ("ring", 301, 300, "user", "b", 1.0), ("ring", 302, 301, "user", "hangs on it", 1.0)]
    rows += [(None, 400, None, "user\n%0A", "no tree", 1.0)]
    return rows


def brute_paths(rows):
    by = {r[1]: r for r in rows}
    parents = {r[2] for r in rows}
    found = collections.defaultdict(list)
    for r in rows:
        if r[1] in parents:
            continue
        path, seen, at = [], set(), r
        while at is not None and at[1] not in seen:
            seen.add(at[1])
            path.append(at)
            at = by.get(at[2]) if at[2] is not None else None
        if at is None:
            found[r[0]].append((-sum(p[5] or 0.0 for p in path) / len(path), r[1], path[::-1]))
    return {t: sorted(p, key=lambda x: (round(x[0], 9), x[1])) for t, p in found.items()}


def test_paths_and_conversations_equal_brute_force(spark):
    rows = tree_rows(random.Random(6))
    df = spark.createDataFrame([(*r, 1) for r in rows], "tree string, node long, parent long, role string, text string, score double, path int").repartition(3)
    want = brute_paths(rows)
    assert len(want["t"]) > 10 and set(want) == {"t", "u", "lost", None}
    out = reply_trees.format_paths(df).withColumn("said", reply_trees.read_back(F.col("formatted"))).withColumn(
        "loss", reply_trees.under_loss(F.col("formatted"), F.col("turns"))).collect()
    got = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: r.branch):
        got[r.tree].append((r.path, [(s.role, s.text) for s in r.said], list(r.loss)))
        assert len(r.turns) == len(r.said)
        for t, s in zip(r.turns, r.said):
            assert r.formatted[t.start:].startswith("<|im_start|>")
            written = r.formatted[t.text_start:t.text_start + t.text_length]
            assert re.sub(r"<\\(\\*)\|", r"<\1|", written) == s.text and t.loss == (s.role == "assistant")
    for tree, found in want.items():
        assert got[tree] == [(leaf, [(p[3] or "", p[4] or "") for p in path], [p[4] or "" for p in path if p[3] == "assistant"]) for _, leaf, path in found]
    best = reply_trees.format_paths(df, branches=2).collect()
    assert sorted((r.tree or "", r.path) for r in best) == sorted((t or "", leaf) for t, found in want.items() for _, leaf, _ in found[:2])
    assert reply_trees.format_paths(df.limit(0)).count() == 0


def test_escapes_round_trip(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(["<", "|", "\\", "im_end", ">", "é", "\n"]) for _ in range(rng.randrange(30))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", reply_trees.escaped(F.col("t")))
    for r in df.withColumn("b", reply_trees.unescaped(F.col("e"))).collect():
        assert r.b == r.t and "<|" not in r.e


def test_chains_by_turn_with_ties_nulls_and_a_hot_conversation(spark):
    rng = random.Random(9)
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"text {k}") for k in range(700)] + [(2, 0, None, None), (2, 0, None, None), (None, 1, "user", "x"), (3, None, "assistant", "first"), (3, 5, "user", "b"), (3, 5, "user", "a")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    scratch = Scratch(spark, "t")
    got = {r.tree: [(s.role, s.text) for s in r.said] for r in reply_trees.format_paths(
        reply_trees.chains(df, "conv_id", "turn", "role", "text", scratch), scratch=scratch).withColumn("said", reply_trees.read_back(F.col("formatted"))).collect()}
    assert got[1] == [("user" if k % 2 == 0 else "assistant", f"text {k}") for k in range(700)]
    assert got[2] == [("", ""), ("", "")] and got[None] == [("user", "x")]
    assert got[3][0] == ("assistant", "first") and sorted(got[3][1:]) == [("user", "a"), ("user", "b")]
    assert len(got) == 4


def test_no_python_on_the_main_path(spark):
    from quayside.llm import queries

    plan = queries.op13_reply_tree_chats(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_planted_conversation_comes_back(spark):
    from quayside.llm import queries

    row = queries.op13_reply_tree_chats(spark, "/root/testdata/sf0.001").filter("conv_id = -1").first()
    said = "<|im_end|><|im_start|>assistant ok"
    assert row.n_turns == 2 and row.loss_chars == len(said) and row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
