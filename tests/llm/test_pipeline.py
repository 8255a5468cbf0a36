"""The pipeline's stages on planted cases, against plain Python."""

import random

import pytest

import corpus_pipeline


@pytest.fixture
def folder(spark, tmp_path):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice(["an", "the", "lo", "ri", "us", "mi", "ke"]) for _ in range(rnd.randrange(1, 4)))
    line = lambda: " ".join(word() for _ in range(14)).capitalize() + "."
    passage = " ".join(word() for _ in range(20))
    clean = ["\n".join(line() for _ in range(6)) for _ in range(120)]
    junk = [" | ".join(word() + "%%%" for _ in range(60)) for _ in range(40)]
    texts = clean + junk
    shared = line() + " " + line()
    base = "\n".join(line() for _ in range(9))
    planted = {
        "copy": clean[3],  # an exact copy of a clean document
        "shared_a": line() + "\n" + shared, "shared_b": line() + "\n" + shared,
        "near_a": base, "near_b": base.replace("\n", " \n ").replace(".", ",", 1).replace("\n", "; "),
        "leak": line() + "\n" + passage + "\n" + line(), "null": None,
    }
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    ids = {k: 1000 + i for i, k in enumerate(planted)}
    rows += [(ids[k], t, "en", "s1", len(t or "")) for k, t in planted.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i < 120), 0) for i in range(0, 160, 2)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), ids, passage, shared


def test_stages_take_effect(spark, folder):
    d, ids, passage, shared = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        seen.append({r.doc_id: r for r in docs.collect()})
        if len(seen) < len(corpus_pipeline.STAGES):
            assert docs.columns == corpus_pipeline.COLUMNS
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    quality, lines, near, clean, packed = seen
    assert not [i for i in range(120, 160) if i in quality] and all(i in quality for i in range(120))
    assert ids["copy"] not in lines and all(i in lines for i in range(120))
    assert shared in lines[ids["shared_a"]].text and shared not in lines[ids["shared_b"]].text
    assert all(r.n_chars == len(r.text) for r in lines.values() if r.text is not None)
    assert ids["near_a"] in near and ids["near_b"] not in near and all(i in near for i in range(120))
    assert passage in near[ids["leak"]].text and passage not in clean[ids["leak"]].text and set(clean) == set(near)
    assert set(packed) == set(clean)


def test_near_copies_without_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(80))
    near = text.replace("w40 ", "x ")
    rows = [(5, text), (5, text), (7, near), (None, near), (9, "other words here and there"), (None, "no id no id at all"), (None, "no id no id at all "), (11, None), (12, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = [(r.doc_id, r.text) for r in corpus_pipeline.near_copy_stage(spark, docs, "").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert [(i, (t or "").strip()) for i, t in sorted(out, key=key)] == [(5, text), (5, text), (9, rows[4][1]), (11, ""), (12, ""), (None, ""), (None, "no id no id at all")]
    assert corpus_pipeline.near_copy_stage(spark, docs.where("false"), "").count() == 0


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder[0]).select("doc_id").distinct().count() >= 120
