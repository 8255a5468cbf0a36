"""Near copies, lines, benchmark passages and fingerprints, against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.llm import decontaminate, fingerprint, line_dedup, ngram_join
from annospark.llm.graph import components


def docs_of(spark, rows):
    # further columns with clashing names must not matter
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, Found string, sig_ long").repartition(3)


def near_copies(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    docs = []

    def changed(base, k):
        base = list(base)
        for _ in range(k):
            base[rnd.randrange(len(base))] = rnd.choice(words)
        return base

    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 8, 20, 60, 200]))]
        docs += [" ".join(changed(base, rnd.choice([0, 0, 1, 2]))) for _ in range(rnd.choice([1, 2, 30]))]
    chain = [rnd.choice(words) for _ in range(120)]
    for _ in range(40):  # each links to its neighbours alone
        chain = changed(chain, 1)
        docs.append(" ".join(chain))
    hot = [rnd.choice(words) for _ in range(60)]
    docs += [" ".join(hot + [rnd.choice(words) for _ in range(rnd.choice([2, 4, 8]))]) for _ in range(60)]
    docs += ["", "a", "A", "  \n", None, "b c d e", "b c d e f"]
    rnd.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("block_rows, keys", [(3072, 1 << 20), (7, 40)])
def test_ngram_join_equals_brute_force(spark, monkeypatch, block_rows, keys):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(ngram_join, "KEYS_AT_ONCE", keys)
    monkeypatch.setattr(ngram_join, "FREQUENT", 2 if block_rows == 7 else 32)
    rows = near_copies(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_sets(docs_of(spark, rows)).collect()}
    assert got == ngram_join.brute_force(rows)


def test_passages_of_two_documents_do_not_chain_the_corpus_to_one_block(spark, monkeypatch):
    rnd = random.Random(3)
    some = lambda k: [f"w{rnd.randrange(10**9)}" for _ in range(k)]
    passages = [some(150) for _ in range(201)]
    rows = [(i, " ".join(passages[i] + some(150) + passages[i + 1])) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " " + " ".join(some(20))) for i in range(0, 200, 20)]
    blocks = []

    def seen(edges, name="components"):
        out = components(edges, name)
        if name == "blocks":
            blocks.extend(r["count"] for r in out.groupBy("comp").count().collect())
        return out

    monkeypatch.setattr(ngram_join, "components", seen)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_sets(docs_of(spark, rows), shingle=5, num=80).collect()}
    assert got == ngram_join.brute_force(rows, shingle=5, num=80)
    assert max(blocks) <= 4 and len(blocks) >= 10


@pytest.mark.parametrize("crowd", [2, 3, 16])
def test_crowded_keys_and_batches_that_cut_them(spark, monkeypatch, crowd):
    monkeypatch.setattr(ngram_join, "PAIRED", crowd)
    monkeypatch.setattr(ngram_join, "KEYS_JOINED", 5)
    monkeypatch.setattr(ngram_join, "PAIRS_AT_ONCE", 3)
    rows = near_copies(8)
    batches = [[("k", 9), ("k", 9), ("k", 3)], [("k", 3), ("k", 7), ("k", 2), ("k", 8), ("l", 5)], [("l", 6), ("m", 1)]]
    cell = 20
    key = {c: (i + 1 << 6) + cell for i, c in enumerate("klm")}
    need = int(ngram_join.Cells(80, 100).need[cell])
    out = [r for b in ngram_join._joined(80, 100)(ngram_join._triples([key[k] for k, _ in x], [v for _, v in x], [ngram_join.KEY] * len(x)) for x in batches) for r in zip(*(c.to_pylist() for c in b.columns))]
    joined = {frozenset(r[:2]) for r in out if r[2] == ngram_join.EDGE}
    counts = [(frozenset(r[:2]), ngram_join.PAIR - r[2]) for r in out if r[2] < ngram_join.PAIR]
    few = {frozenset(x) for x in itertools.combinations([2, 3, 7, 8, 9], 2)} if crowd == 16 else set()
    assert {x for x, _ in counts} == few | {frozenset((5, 6))} and {c for _, c in counts} == {-(-ngram_join.WHOLE // need)}
    assert set().union(*joined) == ({2, 3, 7, 8, 9} if crowd < 16 else set()) and len(joined) == (4 if crowd < 16 else 0)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_sets(docs_of(spark, rows)).collect()}
    assert got == ngram_join.brute_force(rows)


@pytest.mark.parametrize("num, den", [(85, 100), (80, 100), (1, 2)])
def test_rows_that_link_share_a_key_and_products_find_all(num, den):
    rnd = np.random.default_rng(num)
    for turn in range(60):
        n = int(rnd.choice([2, 7, 20, 50, 200, 900]))
        base, sets = rnd.integers(0, 1 << 64, n, np.uint64), []
        for _ in range(12):
            s = base[: rnd.integers(n * num // den, n + 1)].copy()
            at = rnd.integers(0, n, rnd.integers(0, max(2, n // 8)))
            at = at[at < len(s)]
            s[at] = rnd.integers(0, 1 << 64, len(at), np.uint64)
            sets.append(np.unique(s))
        sets = [s for s in sets if len(s)]
        column = np.unique(rnd.choice(base, n // 3))  # any table of frequent columns will do
        cells = ngram_join.Cells(num, den, (column, rnd.integers(1, 9, len(column)).astype(np.int32)))
        key, owner = cells.keys(sets)
        have = [set(key[owner == i].tolist()) for i in range(len(sets))]
        links = []
        for i, j in itertools.combinations(range(len(sets)), 2):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if den * shared >= num * (len(sets[i]) + len(sets[j]) - shared):
                links.append((i, j))
                assert have[i] & have[j] or len(sets[i]) == len(sets[j]) == shared
        everything = np.arange(len(sets))
        wanted = ngram_join._united(everything, *np.array(links, np.int64).reshape(-1, 2).T)
        _, got, _ = ngram_join.block_links(sets, everything, np.zeros(len(sets), np.int64), num, den)
        assert got.tolist() == wanted.tolist()
        half = everything % 2
        _, got, _ = ngram_join.block_links(sets, everything, half, num, den)
        across = [(i, j) for i, j in links if half[i] != half[j]]
        assert got.tolist() == ngram_join._united(everything, *np.array(across, np.int64).reshape(-1, 2).T).tolist()


def test_products_of_many_rows_count_light_and_heavy_columns():
    rnd = np.random.default_rng(1)
    core = rnd.integers(0, 1 << 64, 30, np.uint64)
    sets = [np.unique(np.concatenate((rnd.choice(core, rnd.integers(20, 31), False), rnd.integers(0, 40, 3).astype(np.uint64) + np.uint64(i // 3 * 50)))) for i in range(150)]
    links = [(i, j) for i, j in itertools.combinations(range(150), 2) if 100 * (s := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (len(sets[i]) + len(sets[j]) - s)]
    everything = np.arange(150)
    _, got, _ = ngram_join.block_links(sets, everything, np.zeros(150, np.int64), 85, 100)
    assert got.tolist() == ngram_join._united(everything, *np.array(links).T).tolist() and 1 < len(set(got.tolist())) < 150


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(8)
    names = rnd.sample(range(-(1 << 60), 1 << 60), 400)
    edges = [(names[i], names[i + 1]) for i in range(150)] + [(names[200], names[i]) for i in range(201, 300)] + [(names[300], names[301]), (names[301], names[300]), (names[310], names[310])]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    groups = [names[:151], names[200:300], names[300:302]]
    assert got == {x: min(group) for group in groups for x in group}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ngram_join_edge_rows(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (7, None), (None, "q r s t u v")]
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id) for r in ngram_join.similar_sets(docs_of(spark, rows)).collect())
    assert got == [(-1, 2, 5), (-1, 3, None), (5, 2, 5), (5, 2, 5), (7, 0, 7)]
    assert ngram_join.similar_sets(docs_of(spark, rows).where("false")).count() == 0


def test_shingle_sets_of_long_and_odd_texts():
    rnd = random.Random(2)
    long = " ".join(rnd.choice(["a", "bb", "É\t", "d\n"]) * rnd.randrange(1, 4) for _ in range(400_000))
    texts = [None, "", long, " x ", "a b", "A b"]
    sets = ngram_join.shingle_sets(texts, 4)
    words = long.encode().lower().split()
    assert [len(s) for s in sets] == [0, 0, len({tuple(words[i : i + 4]) for i in range(len(words) - 3)}), 1, 1, 1]
    assert (sets[4] == sets[5]).all() and (ngram_join._group_sets([long.encode().lower()], 4)[0] == sets[2]).all()


@pytest.mark.parametrize("partitions", [1, 7])
def test_line_dedup_equals_brute_force(spark, partitions):
    rnd = random.Random(3)
    pool = [f"common line number {i}" for i in range(6)] + ["  Common Line number 1\t", "short", "", "ÉÉÉÉÉÉÉÉÉÉ", "éééééééééé", "\x0bcommon line number 2"]
    rows = [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.7 else f"own {i} line {j}" for j in range(rnd.randrange(1, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "common line number 1"), (103, "common line number 0\n" * 2000)]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    got = [tuple(r) for r in line_dedup.digests(line_dedup.dedup_lines(docs_of(spark, rows))).collect()]
    spark.conf.set("spark.sql.shuffle.partitions", was)
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(line_dedup.brute_force(rows), key=key)


def test_line_dedup_repeated_rows_and_emptied_documents(spark):
    rows = [(1, "a shared long line\nkeep"), (1, "a shared long line\nkeep"), (2, "a shared long line"), (3, None), (4, "")]
    got = sorted((r.doc_id, r.text) for r in line_dedup.drop_copied_lines(docs_of(spark, rows)).collect() if r.text is not None)
    assert got == [(1, rows[0][1]), (1, rows[0][1]), (4, "")]
    bitmaps = {r.doc_id: r for r in line_dedup.keep_bitmaps(docs_of(spark, rows)).collect()}
    assert line_dedup.keep_lines(bitmaps[2].bitmap, 1).tolist() == [False] and line_dedup.keep_lines(bitmaps[1].bitmap, 2).tolist() == [True, True]
    assert line_dedup.dedup_lines(docs_of(spark, rows).where("false")).count() == 0


def contaminated(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 10, 14, 30])))) for i in range(12)] + [(None, "w1 w2"), (20, None), (21, "É-x"), (3, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]
    docs = []
    for i in range(60):
        body = [rnd.choice(words) for _ in range(rnd.randrange(40))]
        if rnd.random() < 0.6:
            body[5:5] = (rnd.choice(items)[1] or "").split()
        docs.append((i, rnd.choice([" ", "-", ".\n"]).join(body).upper()))
    return docs + [(90, None), (91, ""), (None, "é x é x"), (92, "É X"), (93, "w1 " * 5000)], items


@pytest.mark.parametrize("block", [5, 10_000])
def test_decontamination_equals_brute_force(spark, block):
    rows, items = contaminated(1)
    found = decontaminate.find_contamination(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_words=block)
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, decontaminate.report(found).collect()), key=key) == sorted(decontaminate.brute_force(rows, items), key=key)


def test_spans_are_cut_and_documents_go(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, f"Before it: {item.upper()}! After, all that stays here and some more words too."), (2, item), (3, "clean"), (4, None)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r.doc_id: r.text for r in decontaminate.remove_contamination(docs_of(spark, rows), items).collect()}
    assert out == {1: "Before it: ! After, all that stays here and some more words too.", 3: "clean", 4: None}
    kept = decontaminate.remove_contamination(docs_of(spark, rows), items, mode="documents")
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4] and kept.columns == ["doc_id", "text", "Found", "sig_"]
    none = decontaminate.report(decontaminate.find_contamination(docs_of(spark, rows), items.where("false")))
    assert [r.n_hit for r in none.collect()] == [0] * 4


def test_fingerprints_estimate_resemblance(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    rows = [(i * 3, " ".join(rnd.choice(words) for _ in range(rnd.choice([2, 40, 600])))) for i in range(30)] + [(200, ""), (201, None), (202, "é😀 " * 40)]
    got = {r.doc_id: r for r in fingerprint.edited_likeness(docs_of(spark, [*rows, (None, "x y z")])).collect()}
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(len(w) - 4)} or ({tuple(t.lower().split())} if t.split() else set())
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        m = len(text) // 4
        edited = text[: len(text) - m] + following[:m]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for seen, true in ((r.near_edited, like(shingles(text), shingles(edited))), (r.near_next, like(shingles(text), shingles(following)))):
            assert abs(seen - true) < 0.2 and 0 <= seen <= 1
    assert got[200].fingerprint == got[201].fingerprint == "" and got[None].near_next is None


def test_sketches_merge(spark):
    one, two = " ".join(f"a{i}" for i in range(400)), " ".join(f"b{i}" for i in range(300))
    row = spark.createDataFrame([(one, two)], "a string, b string")
    row = fingerprint.with_sketch(fingerprint.with_sketch(row, "a", "x"), "b", "y")
    both = fingerprint.merged(F.col("x"), F.col("y"))
    out = row.select(
        fingerprint.containment(F.col("x"), both).alias("c"), fingerprint.resemblance(F.col("x"), both).alias("r"), fingerprint.distinct_count(both).alias("n"),
        fingerprint.distinct_count(F.col("x")).alias("na"),
    ).first()
    assert out.c == 1.0 and abs(out.r - 396 / 692) < 0.15 and abs(out.n / 692 - 1) < 0.3 and abs(out.na / 396 - 1) < 0.3


def test_repeated_ids_have_one_next_text(spark):
    rows = [(1, "aaaa"), (2, "bbbb"), (2, "cccc"), (3, "dddd")]
    got = fingerprint.edited_likeness(docs_of(spark, rows)).collect()
    assert sorted(r.edited_sha256 for r in got) == sorted(hashlib.sha256(t).hexdigest() for t in (b"aaab", b"bbbd", b"cccd", b"ddda"))
