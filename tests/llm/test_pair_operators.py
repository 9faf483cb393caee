"""Operators on pairs against brute force, and the pipeline against its stages."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import metric_join, ngram_join, queries
from quayside.llm.shared import Scratch, components, maybe_member

SF_SMALL = "/root/testdata/sf0.001"


def grouped(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def word_sets(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_groups(rows):
    sets = {i: word_sets(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, grouped(ids, links)


def near_copies(rng, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**9)}"
        yield " ".join(words)


def test_ngram_groups_equal_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"v{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = [None, "", " \t\n", "one two", "ONE two", "one two three", "É x", "é x", "a\x1cb c", "a b c d e", "A B C D E F"]
    texts += list(near_copies(rng, [rng.choice(vocabulary) for _ in range(150)], 120, 6))
    texts += list(near_copies(rng, [rng.choice(vocabulary) for _ in range(90)], 30, 3))
    texts += ["copy of one text that stands here many times over"] * 40
    for k in range(60):  # a passage in many documents of other words
        texts.append(" ".join([*passage, *[f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(5, 120))]]))
    for k in range(8):  # growing texts: a chain of links
        texts.append(" ".join(f"c{i}" for i in range(40 + 6 * k)))
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(20000)))
    order = list(range(1, len(texts) + 1))
    rng.shuffle(order)
    rows = list(zip(order, texts))
    sizes, want = brute_groups(rows)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, node string").repartition(4)
    got = ngram_join.jaccard_groups(df).collect()
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert {r.doc_id: r.component_id for r in got} == want
    kept = ngram_join.drop_copies(spark.read.parquet(written(spark, df)))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in want.items() if i == c)


def written(spark, df):
    from quayside.session import scratch_path

    path = scratch_path(spark, "t")
    df.write.parquet(path)
    return path


def test_ngram_groups_of_repeated_rows_and_nothing(spark):
    rows = [(5, "same text"), (5, "same text"), (None, "same text"), (7, None), (7, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in ngram_join.jaccard_groups(df).collect())
    assert got == [(0, 0, 0), (0, 1, 5), (5, 1, 5), (5, 1, 5), (7, 0, 7), (7, 0, 7)]
    kept = ngram_join.drop_copies(spark.read.parquet(written(spark, df))).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (5, "same text"), (7, ""), (7, "")]
    assert ngram_join.jaccard_groups(df.limit(0)).count() == 0


def test_copies_go_though_files_are_packed_anew(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(60)]
    rows = [(k, texts[k // 2 if k % 3 else k % 60]) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7, "doc_id")
    _, want = brute_groups(rows)
    path, run, setting = written(spark, df), ngram_join.JaccardGroups.run, "spark.sql.files.openCostInBytes"

    def packed_anew(join):  # as when an executor is lost between the two plans
        found = run(join)
        spark.conf.set(setting, "1m")
        return found

    monkeypatch.setattr(ngram_join.JaccardGroups, "run", packed_anew)
    spark.conf.set(setting, "1")
    try:
        kept = sorted(r.doc_id for r in ngram_join.drop_copies(spark.read.parquet(path)).collect())
    finally:
        spark.conf.unset(setting)
    assert kept == sorted(i for i, c in want.items() if i == c)


def test_packed_cells_round_trip():
    rng = np.random.default_rng(0)
    for size in (1, 5, 5000):
        for top in (1 << 32, 70000):
            cells = np.sort(rng.integers(0, top, size).astype(np.uint32))
            assert (ngram_join._unpack(ngram_join._pack(cells, 0), 0) == cells).all()


def test_frequent_shingles_stand_in_the_last_fragment():
    h = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 5000, dtype=np.uint64))
    often = h[::7]
    known = ngram_join.FrequentFirst(ngram_join._cells(often), np.full(len(often), 9))
    *rare, last = known.fragments(h)
    assert len(rare) == ngram_join.FRAGMENTS - 1 and (last == often).all()
    assert (np.concatenate(rare) == np.delete(h, np.arange(0, len(h), 7))).all() and all(len(s) for s in rare)
    assert sum(map(len, ngram_join.FrequentFirst(np.zeros(0, int), np.zeros(0, int)).fragments(h))) == len(h)


def brute_vectors(rows):
    links, count = [], {i: 0 for i, _ in rows}
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for n, (a, x) in enumerate(good):
        for b, y in good[n + 1:]:
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.9:
                links.append((a, b))
                count[a] += 1
                count[b] += 1
    return count, grouped([i for i, _ in rows], links)


@pytest.mark.parametrize("cell", [4096, 40])
def test_near_vectors_equal_brute_force(spark, monkeypatch, cell):
    for name, value in (("CELL_VECTORS", cell), ("HOME_BLOCK", min(cell, 64)), ("MEMBER_BLOCK", 100 if cell == 40 else 8192), ("STRIP", 16)):
        monkeypatch.setattr(metric_join, name, value)
    rng = np.random.default_rng(7)
    f = lambda m: [[float(x) for x in v] for v in np.asarray(m, np.float32)]
    base = rng.normal(size=16)
    vectors = f(rng.normal(size=(80, 16))) + f(base + rng.normal(size=(60, 16)) * 0.35) + f([base] * 30) + f(rng.normal(size=(5, 3)))
    vectors += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    order = rng.permutation(len(vectors)) + 1
    rows = [(int(i), v) for i, v in zip(order, vectors)]
    count, want = brute_vectors(rows)
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, n long, cid long").repartition(3)
    got = metric_join.near_vectors(df).collect()
    assert {r.vec_id: r.n_links for r in got} == count
    assert {r.vec_id: r.component_id for r in got} == want
    assert metric_join.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_write_no_vector_twice_for_their_blocks(spark, monkeypatch):
    """On vectors that are as good as random each cell has guests from all others."""
    for name, value in (("CELL_VECTORS", 40), ("HOME_BLOCK", 32), ("MEMBER_BLOCK", 64)):
        monkeypatch.setattr(metric_join, name, value)
    kept = {}

    class Noted(metric_join.Scratch):
        def keep(self, df, *args, **kwargs):
            plan = df._jdf.queryExecution().executedPlan().toString()
            back = super().keep(df, *args, **kwargs)
            name = "blocks" if "cids" in back.columns else "links" if "linked" in back.columns else "other"
            kept[name] = (plan, [len(r.cids) // 8 for r in back.select("cids").collect()] if name == "blocks" else None)
            return back

    monkeypatch.setattr(metric_join, "Scratch", Noted)
    x = np.random.default_rng(5).normal(size=(300, 12))
    near = metric_join.near_vectors(spark.createDataFrame([(n, [float(c) for c in v]) for n, v in enumerate(x)], "vec_id long, embedding array<double>"))
    sizes, plan = kept["blocks"][1], kept["links"][0]
    assert sum(sizes) == 300 and max(sizes) <= 64 and len(sizes) > 7
    # What is dealt out for the links are the blocks as they are written; their pairs go nowhere but to the task that compares them.
    lines = plan.splitlines()
    dealt = [k for k, line in enumerate(lines) if " Exchange " in line]
    assert len(dealt) == 2 and all("RoundRobinPartitioning" in lines[k] and k > plan[:plan.index("CartesianProduct")].count("\n") for k in dealt)
    assert near.count() == 300


def test_kept_tables_leave_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().endswith(".data")}

    before = files()
    table = Scratch(spark, "t").keep(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count())
    assert len(table.collect()) == 7
    for _ in range(10):  # removal is not waited for
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 100 + k) for k in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    want = grouped({x for e in edges for x in e if e[0] != e[1]}, edges)
    got = components(spark, spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()
    assert {r.id: r.component_id for r in got} == want
    assert components(spark, spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def test_bitmap_never_misses(spark):
    ids = spark.range(0, 5000, 7)
    flagged = maybe_member(spark.range(5000), "id", ids, "may", 715)
    assert flagged.filter("NOT may AND id % 7 = 0").count() == 0
    assert flagged.filter("may").count() < 2500


def test_pipeline_is_its_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    scored = {r.doc_id: r.predicted for r in queries.op9_boosted_quality(spark, SF_SMALL).collect()}
    after = P.quality_classifier(spark, docs, SF_SMALL)
    assert after.columns == columns
    good = {i for i in ids if scored[i] == 1}
    assert {r.doc_id for r in after.collect()} == good
    rules = {r.doc_id: r.kept for r in queries.op3_line_rules(spark, SF_SMALL).collect()}
    good = {i for i in good if rules[i]}
    texts = {r.doc_id: r.text for r in docs.collect()}
    _, group = brute_groups([(i, texts[i]) for i in good])
    good = {i for i in good if group[i] == i}
    pieces = P.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} == good
    whole = {r.doc_id: r.doc_tokens for r in queries.op8_vector_packing(spark, SF_SMALL).collect()}
    assert {i: sum(r.length for r in pieces if r.doc_id == i) for i in good} == {i: whole[i] for i in good}
    assert len(P.STAGES) == 4


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(want.select(*columns).fetchall())
