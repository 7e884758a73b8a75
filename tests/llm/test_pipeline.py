import hashlib

import corpus_pipeline as cp
from pyspark.sql import functions as F

import __spark_entry__ as E
from quern.llm import near_dedup
from quern.llm.common import written
from tests.llm import brute
from tests.llm.test_corpus import contamination

SF10 = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF10}/documents.parquet")
    columns = docs.columns
    steps = {}
    for name, stage in cp.STAGES:
        steps[name] = docs = written(stage(spark, docs, SF10))
        if name != cp.STAGES[-1][0]:
            assert docs.columns == columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF10}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps["quality_classifier"].collect()}
    assert sum(i in kept for i, q in labels.items() if q) > 0.98 * sum(labels.values())
    assert sum(i in kept for i, q in labels.items() if not q) < 0.1 * sum(not q for q in labels.values())

    deduped = {r.doc_id: r for r in steps["line_dedup"].collect()}
    assert all(r.n_chars == len(r.text) for r in deduped.values())
    sets = {i: brute.shingle_set(r.text, 5) for i, r in deduped.items()}
    want = brute.components({i: s for i, s in sets.items() if s}, 80)
    near = {r.doc_id: r.text for r in steps["minhash_near_dedup"].collect()}
    assert set(near) == {i for i in sets if want.get(i, i) == i}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF10}/benchmark.parquet").collect()]
    windows = {w for _, t in items for w in brute.words(t)}
    suspect = {i for i, t in near.items() if len(windows & set(brute.words(t))) > 3}
    clean = {r.doc_id for r in steps["benchmark_decontamination"].collect()}
    assert clean == {i for i, t in near.items() if not (i in suspect and contamination(t, items)[-1])}

    last = {r.doc_id: r for r in steps["byte_bpe"].collect()}
    assert set(last) == clean
    assert all(r.decoded_sha256 == hashlib.sha256(near[i].encode()).hexdigest() and r.n_tokens == len(r.ids) for i, r in last.items())


def test_copies_leave_one_text_over_the_whole_pipeline(spark):
    """Copies and near copies of documents that pass the classifier, by way of every stage."""
    real = spark.read.parquet(f"{SF10}/documents.parquet")
    good = [r.asDict() for r in cp.quality_classifier(spark, real, SF10).orderBy("doc_id").limit(400).collect()]
    good = [r for r in good if r["doc_id"] is not None and r["text"].count("\n") >= 6][:40]
    assert len(good) == 40
    start, added, changed = 10**9, [], {}
    for k, r in enumerate(good):
        lines = r["text"].split("\n")
        at = len(lines) // 2
        near = [*lines[:at], f"Changed line{k}", *lines[at + 1:]]
        changed[start + 2 * k + 1] = near[at]
        added += [{**r, "doc_id": start + 2 * k}, {**r, "doc_id": start + 2 * k + 1, "text": "\n".join(near)}]
    docs = real.unionByName(spark.createDataFrame(added, real.schema))
    passed = None
    for name, stage in cp.STAGES[:-1]:
        docs = written(stage(spark, docs, SF10))
        if name == "quality_classifier":
            passed = {r.doc_id for r in docs.filter(F.col("doc_id") >= start).collect()}
    left = {r.doc_id: r.text for r in docs.filter(F.col("doc_id") >= start).collect()}
    assert len(passed) > 60
    assert not [i for i in left if i % 2 == 0]  # exact copies
    # Of a near copy only what differs, or a line alone, can stay.
    assert all(t == changed[i] for i, t in left.items())


def test_stages_with_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        before = docs.count()
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF10)
            assert name == "byte_bpe" or out.columns == docs.columns
            assert out.count() <= before
    assert near_dedup.Rule() == near_dedup.Rule(5, 80)


def test_columns_that_bear_the_stages_names_stay(spark):
    names = ("_hash", "text_hash", "_text_hash", "place", "score", "n_lines", "n_removed", "removed", "id", "hash", "row", "rest", "whole", "cell")
    rows = [(i, f"line one of {i // 2}\nline two of {i // 2}\nand a third of {i}", "en", "s", 1, *range(70, 70 + len(names))) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF10)
        assert out.columns == docs.columns
        assert {tuple(r[n] for n in names) for r in out.collect()} <= {tuple(range(70, 70 + len(names)))}, name


def test_repeated_rows_leave_one(spark, odd):
    out = cp.minhash_near_dedup(spark, odd, SF10).filter(F.col("doc_id") == 3).collect()
    assert len(out) == len({r.text for r in out})


def test_registered():
    assert "pipeline" in E.queries() and sum(n.startswith("op") and n[2].isdigit() for n in E.queries()) == 13
