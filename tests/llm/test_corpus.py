"""Operators over the whole corpus: decontamination, substring and line dedup, fingerprints, near duplicates."""

import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from quern.llm import decontaminate, fingerprints, line_dedup, near_dedup, substring_dedup
from quern.llm.components import connected_components
from quern.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import ODD


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    order = sorted(names)
    want = sorted((tuple(r[names.index(c)] for c in order) for r in cur.fetchall()), key=repr)
    df = QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == order
    assert sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr) == want


# op4

def contamination(text, items):
    w, hit, found = brute.words(text), set(), set()
    for item, phrase in items:
        p = brute.words(phrase)
        n = min(13, len(p))
        windows = {tuple(p[i:i + n]) for i in range(len(p) - n + 1)} if p else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block", [4 << 20, 20])
def test_decontamination_against_brute_force(spark, odd, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)  # small: many blocks of phrases
    items = [(1, "Three four FIVE"), (2, "one two three four five six seven eight nine ten eleven twelve thirteen"), (3, ""), (4, None), (None, "x"),
             (5, "x"), (6, "word1 thing1 word2 thing2 word3 thing3 word4 thing4 word5 thing5 word6 thing6 word7 thing7"), (7, "l2 c d l3 e f l1")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.summary(decontaminate.search(decontaminate.build_index(odd), benchmark)).collect()
    want = [(r[0], *contamination(r[1], [i for i in items if i[0] is not None])) for r in ODD]
    once = decontaminate.summary(decontaminate.search_documents(odd, benchmark)).collect()
    assert sorted(map(tuple, once), key=repr) == sorted(map(tuple, out), key=repr)
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)


def test_decontamination_without_items_or_documents(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.summary(decontaminate.search(decontaminate.build_index(odd), none)).collect()} == {0}
    assert decontaminate.search(decontaminate.build_index(empty), none).count() == 0


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha x beta y gamma"), (3, "alpha x y z v beta gamma"), (4, "gamma beta")], "doc_id long, text string")
    item = spark.createDataFrame([(9, "alpha beta gamma")], "item_id long, text string")
    found = {r.doc_id: [(m.item, m.exact) for m in r.matches] for r in decontaminate.search(decontaminate.build_index(docs), item, slop=2).collect()}
    assert found[1] == [("9", True)] and ("9", False) in found[2] and found[3] == [] and found[4] == []


# op5

def test_substring_dedup_finds_planted_passages(spark):
    passage = " ".join(f"p{i} q{i * 7 % 13}" for i in range(30))
    texts = [(i, f"own words of document number {i} stand here\n{passage if i % 3 == 0 else 'nothing planted in this one ' + str(i)}\nend {i}") for i in range(30)]
    texts += [(100, f"before it {passage}. And after it there is more text."), (101, f"Another start here. {passage}. And more after it, quite other text.")]
    out = substring_dedup.repeated(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id for r in out} == {i for i in range(30) if i % 3 == 0 and i} | {101}
    at = dict(texts)
    assert all(at[r.doc_id][r.start:r.end].strip(".") == passage for r in out)
    assert {r.kept_doc_id for r in out} == {0}


def test_substring_removal_and_odd(spark, odd, empty):
    docs = spark.createDataFrame([(1, "é a b c d e f g h\nx"), (2, "y\nÉ, a b c d e f g h!\nz")], "doc_id long, text string")
    assert substring_dedup.repeated(docs).count() == 0  # only A-Z is folded
    docs = spark.createDataFrame([(1, "é a b c d e f g h\nx"), (2, "éé\né, A b c d e f g h!\nz"), (3, None)], "doc_id long, text string")
    spans = substring_dedup.repeated(docs)
    assert [(r.doc_id, r.start, r.end, r.kept_start) for r in spans.collect()] == [(2, 3, 22, 0)]
    assert {r.doc_id: r.text for r in substring_dedup.remove(docs, spans).collect()} == {1: "é a b c d e f g h\nx", 2: "éé\n\nz", 3: None}
    out = substring_dedup.repeated(odd)
    assert {r.doc_id for r in out.collect()} >= {4} and substring_dedup.repeated(empty).count() == 0
    assert substring_dedup.remove(odd, out).count() == len(ODD)


# op8

def test_fingerprints_against_brute_force(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op8_fingerprints"](spark, SF_SMALL).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert len(got) == len(rows)
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        changed = fingerprints.edited(text, following)
        n = len(text) // 4
        assert changed == text[:len(text) - n] + following[:n]
        g, own = got[i], fingerprints.digest(text.encode())
        assert (g.n_chars, g.edited_sha256, g.fingerprint) == (len(text), hashlib.sha256(changed.encode()).hexdigest(), own.hex())
        assert g.edited_fingerprint == fingerprints.digest(changed.encode()).hex()
        assert math.isclose(g.near_edited, fingerprints.likeness(own, fingerprints.digest(changed.encode())))
        assert math.isclose(g.near_next, fingerprints.likeness(own, fingerprints.digest(following.encode())))


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_fingerprint_slices_dont_change_the_result(spark, docs, slices):
    want = sorted(map(tuple, fingerprints.compare_with_next(docs, 4).collect()))
    assert sorted(map(tuple, fingerprints.compare_with_next(docs, slices).collect())) == want


def test_fingerprints_odd(spark, odd, empty):
    out = fingerprints.compare_with_next(odd).collect()
    assert len(out) == len(ODD) and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in out)
    assert fingerprints.compare_with_next(empty).count() == 0
    alone = fingerprints.compare_with_next(spark.createDataFrame([(5, "just this one text")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0
    assert fingerprints.fingerprint(odd).count() == len(ODD)


# op9

def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1300)] + [(7000, 7000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1300)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("rule", [near_dedup.Rule(3, 85), near_dedup.Rule()])
def test_near_dedup_against_all_pairs(spark, docs, rule):
    rows = docs.collect()
    sets = {r.doc_id: brute.shingle_set(r.text, rule.shingle) for r in rows}
    want = brute.components(sets, rule.percent)
    for r in near_dedup.components(docs, rule).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("small, most", [(2, 40), (8, 1 << 19)])
def test_near_dedup_of_a_large_group_in_blocks(spark, monkeypatch, small, most):
    """Near copies of one text: branches and clusters that stay large are compared block against block."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "MOST_SHINGLES", most)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(40):
        w = list(base)
        for k in range(i % 4):
            w[(7 * i + 13 * k) % 60] = f"new{i}-{k}"
        texts.append((i, " ".join(w)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = {i: brute.shingle_set(t, 3) for i, t in texts}
    want = brute.components(sets, 85)
    assert len(set(want.values())) > 1
    assert {r.doc_id: r.component_id for r in near_dedup.components(docs, near_dedup.Rule(3, 85)).collect()} == want


def test_near_dedup_odd(odd, empty):
    out = near_dedup.components(odd, near_dedup.Rule(3, 85)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in ODD)
    by = {(r.doc_id, r.n_shingles): r for r in out}
    assert by[4, 7].component_id == 3 and not by[4, 7].kept and by[3, 7].kept
    assert by[1, 0].kept and by[2, 0].kept and by[8, 0].kept and by[6, by_size(out, 6)].component_id == 5
    assert all(r.kept and r.component_id is None for r in out if r.doc_id is None)
    assert near_dedup.components(empty).count() == 0


def by_size(out, doc_id):
    return next(r.n_shingles for r in out if r.doc_id == doc_id)


def test_recall_of_the_trees():
    for s in (0.8, 0.85):
        assert near_dedup.missed(s) ** near_dedup.trees(s) <= 1 - near_dedup.RECALL + 1e-12


# op10

def chunks(text):
    lines = text.split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, start = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or (hashes[i] + 31 * (hashes[i - 1] if i else 0)) % 3 == 0:
            out.append((start, "\n".join(lines[start:i + 1]), i + 1 - start))
            start = i + 1
    return out


def test_line_dedup_against_brute_force(spark, docs, odd):
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text").filter("doc_id is null or doc_id > 3").withColumn("doc_id", F.col("doc_id") + 10**6))
    rows = sorted({(r.doc_id, r.text) for r in df.collect()}, key=lambda r: (r[0] is not None, r[0] or 0))
    first, want = {}, {}
    for i, text in rows:
        for start, body, n in chunks(text) if text is not None else []:
            if n >= 2 and body.strip(" "):
                first.setdefault(body, (i, start))
    for i, text in rows:
        if text is not None:
            kept = [(b, n) for s, b, n in chunks(text) if not (n >= 2 and b.strip(" ") and first[b] != (i, s))]
            lines = len(text.split("\n"))
            want[i, text] = ("\n".join(b for b, _ in kept), lines, lines - sum(n for _, n in kept))
    before = sorted(r[0] or -1 for r in rows)
    out = line_dedup.dedup(df.withColumn("original", F.col("text"))).collect()
    assert sorted({r.doc_id or -1 for r in out}) == sorted(set(before))
    for r in out:
        assert (r.text, r.n_lines, r.n_removed) == (want[r.doc_id, r.original] if r.original is not None else (None, 0, 0))


def test_line_chunks_resist_shifts():
    lines = [f"line {i} {i * i}" for i in range(200)]
    a, b = chunks("\n".join(lines)), chunks("\n".join(["inserted", *lines]))
    assert len({x[1] for x in a} - {x[1] for x in b}) <= 2


def test_line_dedup_odd(odd, empty):
    out = line_dedup.dedup(odd)
    assert out.count() == len(ODD) and out.columns.count("n_lines") == 1
    assert line_dedup.dedup(empty).count() == 0


def whole(rows):
    """The whole rule of line dedup, one document after another; rows: (id, text) in order."""
    first, out = {}, []
    for i, text in rows:
        lines, gone = text.split("\n"), set()
        at = [k for k, x in enumerate(lines) if x.strip(" \t\r")]
        units = [(a, b, lines[a] + "\n" + lines[b]) for a, b in zip(at, at[1:])]
        units += [(a, a + 1, lines[a] + "\n") for a in at if a + 1 < len(lines) and a + 1 not in at]
        units += [(a - 1, a, "\n" + lines[a]) for a in at if a and a - 1 not in at]
        for a, b, key in sorted(units):
            kept = first.setdefault(key, (i, a, b))
            if kept != (i, a, b):
                gone.update(range(max(a, kept[2] + 1) if kept[0] == i and a <= kept[2] else a, b + 1))
        rest = [x for k, x in enumerate(lines) if k not in gone]
        if gone and not any(x.strip(" \t\r") for x in rest):
            rest = []
        out.append((i, "\n".join(rest), len(lines), len(lines) - len(rest)))
    return out


def test_whole_line_dedup_against_brute_force(spark, docs):
    rows = [(i + 10, f"own {i}\n" + "\n".join(f"passage {n} line {k}" for k in range(n)) + f"\nend {i}") for n in range(1, 13) for i in (2 * n, 2 * n + 1)]
    rows += [(100, "a\na\na\na\na"), (101, "p\n\n\n\nq"), (102, "x\np\nq\n"), (103, "p\n\n\n\nq\n\n\n"), (104, "\n\n"), (105, ""), (106, "only\n"), (107, "only\n")]
    rows += [(r.doc_id + 1000, r.text) for r in docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r.doc_id: tuple(r) for r in line_dedup.dedup_whole(df).collect()}
    assert out == {r[0]: r for r in whole(sorted(rows))}
    left = {i: text for i, text, _, _ in out.values()}
    assert left[100] == "a\na" and left[103] == "" and left[107] == ""
    # A passage of two lines or more goes whole wherever it stands.
    assert all(left[2 * n + 11] == f"own {2 * n + 1}\nend {2 * n + 1}" for n in range(2, 13))
    assert {x for _, t in rows for x in t.split("\n")} == {x for t in left.values() for x in t.split("\n")}


def test_whole_line_dedup_odd(spark, odd, empty):
    out = line_dedup.dedup_whole(odd)
    assert out.count() == len(ODD) and out.columns.count("n_lines") == 1
    assert line_dedup.dedup_whole(empty).count() == 0
    docs = spark.createDataFrame([(None, "a\nb"), (None, "a\nb"), (1, "a\nb"), (1, "a\nb\nc"), (2, None)], "doc_id long, text string")
    got = [(r.doc_id, r.text, r.n_removed) for r in line_dedup.dedup_whole(docs).collect()]
    assert sorted(got, key=repr) == sorted([(None, "a\nb", 0)] * 2 + [(1, "", 2), (1, "c", 2), (2, None, 0)], key=repr)


def test_near_copies_go_before_their_lines(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    long = [(i, t) for i, t in rows if t.count("\n") >= 5][:15]
    for i, t in long:
        lines = t.split("\n")
        at = max(range(len(lines)), key=lambda k: len(lines[k]))
        few = lines[at].split(" ")
        rows += [(10**6 + i, t), (2 * 10**6 + i, "\n".join([*lines[:at], " ".join(["new", *few[1:]]), *lines[at + 1:]]))]
    rows.append((3 * 10**6, "own words\n" + long[0][1]))
    out = {r.doc_id: r.text for r in line_dedup.dedup_whole(spark.createDataFrame(rows, "doc_id long, text string"), near=(5, 80)).collect()}
    texts = dict(rows)
    sets = {i: brute.shingle_set(t, 5) for i, t in rows}
    for i, _ in long:
        a, b = sets[i], sets[2 * 10**6 + i]
        assert 10**6 + i not in out
        assert (2 * 10**6 + i not in out) == (100 * len(a & b) >= 80 * len(a | b))
    # What goes has a near copy of smaller id.
    for i in set(texts) - set(out):
        assert any(j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in sets if sets[j])


def test_the_pipelines_line_dedup_takes_out_repeated_chunks(spark, monkeypatch):
    """A chunk with blank lines that stand in no unit goes whole, by its bytes, as the chunks of ``dedup`` do; whatever the ids, one place stays."""
    import corpus_pipeline as cp
    texts = (f"\n\n\n\nlow {k}\nlast {k}" for k in range(10**4))
    body = next(t for t in texts if chunks(f"{t}\nx")[0][1] == t)
    rows = [(1, f"{body}\nmine alone {1}"), (2, f"{body}\nmine alone {2}"), (3, "nothing of it\nhere")]
    rows += [(4, f"{body}\nsame id {k}") for k in range(3)]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    plain = {r.text for r in line_dedup.dedup_whole(df).collect()}
    assert "\n\n" in "".join(t for t in plain if "alone 2" in t)  # units leave the first blank lines
    calls, compared = [], line_dedup.later_chunks
    monkeypatch.setattr(line_dedup, "later_chunks", lambda *a: (calls.append(a), compared(*a))[1])
    left = {(r.doc_id, r.text) for r in cp.line_deduplication(spark, df, None).collect()}
    assert calls and (1, rows[0][1]) in left and (2, "mine alone 2") in left
    assert {t for i, t in left if i == 4} == {f"same id {k}" for k in range(3)}
