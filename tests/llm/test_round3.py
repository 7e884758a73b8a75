"""Jaccard join, embedding whitening and filter interaction audit against plain versions."""

import hashlib
import itertools
import math
import random
import re

import time

import numpy as np
import pytest

from quern.llm import filter_audit, fingerprints, jaccard_join, license_scan, whitening
from quern.llm import shingle_sets as hashed
from tests.llm import brute
from tests.llm.conftest import ODD


# --- filter audit ---------------------------------------------------------------------

def fails(text, doc_id, all_rows):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {"A"} if len(ws) < 50 else set()
    out |= {"B"} if 100 * len(set(ws)) < 65 * len(ws) else set()
    out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else set()
    out |= {"D"} if re.search("[#$%&*|]", text) else set()
    return out | ({"E"} if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in all_rows) else set())


def plain_audit(rows, labels):
    """rows (doc_id, text, source), labels (doc_id, quality, toxic): one document and order after another."""
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    parts = {}
    for i, text, source in rows:
        parts.setdefault(source or "", []).append((i, fails(text or "", i, rows)))
    out = []
    for part, found in parts.items():
        gone = {}
        for order in itertools.permutations("ABCDE"):
            left = found
            for step, name in enumerate(order, 1):
                lost = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                n = sum(name in f for _, f in found)
                gone[name] = gone.get(name, 0) + len(lost)
                out.append([part, "".join(order), step, len(left), len(lost), n - len(lost), sum(f == {name} for _, f in found),
                            sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost)])
        for row in out[-600:]:
            row.append(gone[row[1][row[2] - 1]])
    return sorted(map(tuple, out))


def odd_texts():
    rng = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "delta#", "x", "é", "50%"]
    texts = [None, "", " \n ", "a " * 49 + "b", " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i % 20}" for i in range(60)), "Ab" * 300]
    texts += [" ".join(rng.choices(words, k=rng.randrange(80))) for _ in range(30)]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "one", "two", "hot", "hot", "hot"])) for _ in range(150)]
    return rows + rows[:20]


def test_filter_audit_against_brute_force(spark):
    rows = odd_texts()
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 60, 2)] + [(4, 1, None), (None, 1, 1), (5, None, 1)]
    docs = spark.createDataFrame([(*r, 1, "m", 2) for r in rows], "doc_id long, text string, source string, n long, mask string, part int").repartition(5)
    out = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, out.collect())) == plain_audit(rows, labels)


def test_filter_audit_on_odd_and_empty_tables(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, filter_audit.audit(odd, labels).collect())) == plain_audit([(r[0], r[1], r[3]) for r in ODD], [])
    assert filter_audit.audit(empty, labels).count() == 0


def test_swaps_lead_through_all_orders():
    for size in range(1, 6):
        orders = [list(range(size))]
        for place in filter_audit.adjacent_swaps(size):
            o = list(orders[-1])
            o[place], o[place + 1] = o[place + 1], o[place]
            orders.append(o)
        assert len(orders) == len(set(map(tuple, orders))) == math.factorial(size)


def test_diagram_shares_nodes_and_keeps_counts_when_swapped():
    rng = random.Random(5)
    weights = {m: (rng.randrange(4), rng.randrange(2)) for m in range(32) if rng.random() < 0.7}
    diagram = filter_audit.Diagram(weights, 5)
    for place in filter_audit.adjacent_swaps(5):
        diagram.swap(place)
        assert all(len(set(level)) == len(level) for level in diagram.levels)
        before = 0
        for name, kept, gone in diagram.steps():
            assert gone[0] == sum(w[0] for m, w in weights.items() if not m & before and m >> name & 1)
            before |= 1 << name
            assert kept[1] == sum(w[1] for m, w in weights.items() if not m & before)
    even = filter_audit.Diagram({m: (1,) for m in range(32)}, 5)
    assert [len(level) for level in even.levels] == [1] * 5


# --- whitening --------------------------------------------------------------------------

@pytest.mark.parametrize("case", ["random", "diagonal", "equal", "near", "one", "two", "split", "low rank", "large"])
def test_leading_components_against_numpy(case):
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    spread = {"random": rng.random(40), "equal": np.repeat([3.0, 2.0, 2.0, 1.0], 10), "near": 1 + np.arange(40) * 1e-9, "low rank": np.r_[5.0, 4.0, np.zeros(38)]}
    if case in spread:
        a = turn @ np.diag(spread[case]) @ turn.T
        a = (a + a.T) / 2
    else:
        b = rng.standard_normal((200, 200))
        a = {"diagonal": np.diag(rng.random(12)), "one": np.array([[2.5]]), "two": np.array([[2.0, 1.0], [1.0, 2.0]]),
             "split": np.kron(np.eye(3), [[2.0, 1.0], [1.0, 2.0]]), "large": b @ b.T}[case]
    values, vectors = whitening.leading_components(a, 8)
    k, norm = min(8, len(a)), np.abs(a).max()
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], rtol=0, atol=1e-13 * norm * len(a))
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13 * len(a)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * norm * len(a)


def plain_whitening(rows, d):
    usable = [(i, v) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in usable], object)
    n, s = len(x), x.sum(axis=0)
    centred = (x - s / n).astype(float)
    cov = centred.T @ centred / n
    e, w = np.linalg.eigh(cov)
    return usable, [int(((n * r - s) ** 2).sum()) for r in x], centred, e[::-1], w[:, ::-1], np.trace(cov)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((700, 12)) * np.r_[np.linspace(3, 1, 10), 0.2, 0.1]).astype(np.float32)
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, []), (902, [1.0] * 11), (903, [float("nan")] * 12), (904, [1.0] * 11 + [float("inf")]), (905, [None] + [1.0] * 11)]
    rows += [(None, rows[0][1]), (3, rows[3][1])] + [(2000 + i, rows[7][1]) for i in range(300)]
    df = spark.createDataFrame([(*r, 1, [2.0]) for r in rows], "vec_id long, embedding array<float>, component int, whitened array<double>").repartition(7)
    usable, deviation, centred, e, w, trace = plain_whitening(rows, 12)
    out = whitening.whiten(df).collect()
    assert len(out) == 8 * len(usable) == 8 * 1002 and {r.n for r in out} == {1002}
    assert sorted((r.vec_id, r.deviation) for r in out if r.component == 1 and r.vec_id is not None) == sorted((i, v) for (i, _), v in zip(usable, deviation) if i is not None)
    error = {r.identity_error for r in out}
    assert len(error) == 1 and max(error) < 1e-9
    for k in range(8):
        want = {i: v for (i, _), v in zip(usable, centred @ w[:, k] / math.sqrt(e[k]))}
        got = {r.vec_id: r.whitened for r in out if r.component == k + 1}
        sign = math.copysign(1, want[0] * got[0])
        assert all(abs(sign * got[i] - v) < 1e-9 for i, v in want.items())
        assert [r.explained for r in out if r.component == k + 1] == pytest.approx([e[k] / trace] * len(usable), rel=1e-9)


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(6)] + [(9, [1.0]), (10, [5.0, 1.0])]
    out = whitening.whiten(spark.createDataFrame(line, schema)).collect()
    assert {r.component for r in out} == {1} and {r.vec_id for r in out} == set(range(6))
    assert sum(r.whitened ** 2 for r in out) == pytest.approx(6) and out[0].explained == pytest.approx(1)
    far = [(i, [float(10.0 ** 9 * i), 1.0]) for i in range(4)]
    assert all(r.deviation is None for r in whitening.whiten(spark.createDataFrame(far, schema)).collect() if r.vec_id in (0, 3))


# --- Jaccard join -------------------------------------------------------------------------

def plain_join(rows, size=5, percent=80):
    """rows (doc_id, text) -> sorted (doc_id, n_shingles, component_id, n_links); ids unique or repeated with the same text."""
    sets = {i: brute.shingle_set(t, size) for i, t in rows if i is not None}
    links = {i: 0 for i in sets}
    for a, b in itertools.combinations(sets, 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            links[a] += 1
            links[b] += 1
    label = brute.components({i: s for i, s in sets.items() if s}, percent)
    return sorted(((i, len(brute.shingle_set(t, size)), label.get(i, i), links.get(i, 0)) for i, t in rows), key=repr)


def edited_texts(n=160):
    """Families of texts a few words apart, at all similarities around the threshold, beside loners and copies."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for family in range(8):
        base = [word() for _ in range(rng.choice([3, 8, 60, 150]))]
        for _ in range(n // 8):
            text = list(base)
            for _ in range(rng.randrange(6)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
    passage = " ".join(f"common{i}" for i in range(60))
    rows += [f"{word()} {word()} {passage} " + " ".join(word() for _ in range(rng.randrange(120))) for _ in range(60)]
    rows += [rows[0]] * 5 + ["", None, " ", "one", "ONE", "one two", "É x"]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("limits", [{}, {"LONG": 10, "MOST_SHINGLES": 400}])
def test_jaccard_join_against_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)
    rows = edited_texts()
    docs = spark.createDataFrame([(*r, 1, "d", 4) for r in rows], "doc_id long, text string, node long, digest string, n_links int").repartition(6)
    out = jaccard_join.join(docs).collect()
    assert sorted(map(tuple, out), key=repr) == plain_join(rows)
    assert any(r.n_links > 12 for r in out) and len({r.component_id for r in out}) > 60


def test_jaccard_join_on_odd_and_empty_tables(spark, odd, empty):
    out = {(r.doc_id, r.n_shingles): (r.component_id, r.n_links) for r in jaccard_join.join(odd).collect()}
    assert len(jaccard_join.join(odd).collect()) == len(ODD)
    assert out[5, out_size(5)] == (5, 1) and out[6, out_size(6)] == (5, 1)
    assert out[1, 0] == (1, 0) and out[2, 0] == (2, 0) and out[None, 0] == (None, 0)
    assert out[4, 5] == (3, 1) and {tuple(r) for r in jaccard_join.join(odd).collect() if r.doc_id == 3} == {(3, 5, 3, 1), (3, 5, 3, 0)}  # of two texts
    assert jaccard_join.join(empty).count() == 0


def out_size(doc_id):
    return len(brute.shingle_set(next(r[1] for r in ODD if r[0] == doc_id), 5))


def test_overlaps_equal_intersections():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 5000, 300)).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[:len(base) - int(rng.integers(60))], rng.integers(0, 5000, rng.integers(40)).astype(np.uint64)])) for _ in range(50)]
    sets += [np.unique(rng.integers(0, 9000, 50)).astype(np.uint64) for _ in range(20)] + [sets[3]]
    for i, shared in jaccard_join.overlaps(sets):
        assert shared.tolist() == [len(np.intersect1d(sets[i], s)) for s in sets]


def test_lists_of_any_length_connect_the_same_nodes(monkeypatch):
    """Long lists cut into blocks against all pairs of the same entries."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rng, rule = np.random.default_rng(8), jaccard_join.Rule()
    for across in (False, True):
        n = 60
        size = rng.integers(20, 60, n)
        position, node = rng.integers(0, 8, n), rng.permutation(1000)[:n]
        bits = (rng.random((n, jaccard_join.BITS // 8)) < 0.01).astype(np.uint8)
        side = rng.integers(0, 2, n) if across else np.full(n, -1)
        a, b = jaccard_join._long_list(node, size, position, bits, side, rule)
        possible = [(int(node[i]), int(node[j])) for i in range(n) for j in range(n) if i != j and not (across and side[i] == side[j])
                    and min(size[i] - position[i], size[j] - position[j]) >= rule.overlap(size[i], size[j])
                    and np.bitwise_count(bits[i] ^ bits[j]).sum() <= size[i] + size[j] - 2 * rule.overlap(size[i], size[j])]
        assert possible and set(zip(a.tolist(), b.tolist())) <= set(possible)
        both = {int(x): {int(x)} for x in node}
        want = brute_groups(both, possible)
        assert brute_groups(both, list(zip(a.tolist(), b.tolist()))) == want


def brute_groups(nodes, links):
    groups = {x: frozenset(s) for x, s in nodes.items()}
    for a, b in links:
        for x in (joined := groups[a] | groups[b]):
            groups[x] = joined
    return groups


def test_bounds_lose_no_link():
    """Blocks, positions, prefixes and parity bits never exclude a linked pair."""
    rng, rule = random.Random(6), jaccard_join.Rule()
    ranks = np.random.default_rng(0).permutation(1 << jaccard_join.CELL_BITS).astype(np.uint64)
    for _ in range(300):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 90))]
        other = list(words)
        for _ in range(rng.randrange(3)):
            other[rng.randrange(len(other))] = "zz"
        sets = hashed.shingle_sets([" ".join(w).encode() for w in (words, other)], 5)
        a, b = (jaccard_join.ordered(x, ranks) for x in sets)
        shared = np.intersect1d(a, b)
        if 100 * len(shared) < 80 * (len(a) + len(b) - len(shared)):
            continue
        first = shared[0]
        at, bt = np.searchsorted(a, first), np.searchsorted(b, first)
        assert at < rule.prefix(len(a)) and bt < rule.prefix(len(b))
        assert min(len(a) - at, len(b) - bt) >= rule.overlap(len(a), len(b))
        assert jaccard_join.reachable(len(a), at, *(np.array([v]) for v in (len(b), len(b), bt)), rule)[0]
        differ = int(np.bitwise_count(jaccard_join.parity(a) ^ jaccard_join.parity(b)).sum())
        assert differ <= len(a) + len(b) - 2 * rule.overlap(len(a), len(b))
        nodes, sizes = np.array([7, 9]), np.array([len(a), len(b)])
        assert list(jaccard_join._alike(nodes, sizes, list(map(jaccard_join.sketch, sets)), np.array([-1, -1]), rule))


def test_shingle_sets_against_words(monkeypatch):
    """Same sets where texts have the same words, whatever the pieces, blanks and neighbours."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice(["a", "B", "cc", "Dd", "é", "x" * 50]) for _ in range(rng.randrange(40))) for _ in range(60)] + ["", " ", "y" * 500, None, "Q w " + "z" * 300]
    plain = [t if t is None else t.encode() for t in texts]
    spaced = [t if t is None else ("\t" + t.upper().replace("É", "é").replace(" ", " \n\v")).encode() for t in texts]
    found = hashed.shingle_sets(plain, 5)
    assert [len(x) for x in found] == [len(brute.shingle_set(t, 5)) for t in texts]
    sizes = {len({tuple(x) for x in found}), len({frozenset(brute.shingle_set(t, 5)) for t in texts})}
    assert len(sizes) == 1
    monkeypatch.setattr(hashed, "PIECE", 64)
    for other in (hashed.shingle_sets(spaced, 5), *zip(*[hashed.shingle_sets([t], 5) for t in spaced])):
        assert all(np.array_equal(a, b) for a, b in zip(found, other))


# --- earlier operators ------------------------------------------------------------------------

def test_long_license_expressions_take_linear_time():
    began = time.process_time()
    nested = license_scan.expression_tokens("(" * 50_000 + "MIT" + ")" * 50_001)
    assert len(nested) == 100_001 and license_scan.evaluate(license_scan.to_postfix(nested)) == ({"mit"}, 1.0)
    for line in (" or ".join(f"L{i}" for i in range(50_000)), " or (".join(f"L{i}" for i in range(50_000)) + ")" * 49_999):
        names, _ = license_scan.evaluate(license_scan.to_postfix(license_scan.expression_tokens(line)))
        assert len(names) == 50_000
    assert time.process_time() - began < 10


@pytest.mark.parametrize("slices", [1, 4])
def test_rows_of_a_null_id_come_first(spark, slices):
    rows = [(None, "nothing but the null row's own text here"), (1, "alpha beta gamma delta"), (2, "some other words entirely"), (3, "the last document of all of them")]
    out = {r.doc_id: r for r in fingerprints.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string"), slices).collect()}
    for (i, text), (_, after) in zip(rows, [*rows[1:], rows[0]]):
        n = len(text) // 4
        assert out[i].edited_sha256 == hashlib.sha256((text[:len(text) - n] + after[:n]).encode()).hexdigest()


def test_decode_of_slices_null_lists_and_vocabularies_with_gaps():
    import base64

    import pyarrow as pa

    from quern.llm.bpe import _Decode

    class Vocabulary:
        value = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ((b"a", 0), (b"bc", 7), (b"\xff", 3)))

    lists = pa.array([[0], [7, 3], None, [], [3, 0, 7]], pa.list_(pa.int32()))
    decode = _Decode(Vocabulary)
    assert decode(lists)[0].to_pylist() == [b"a", b"bc\xff", b"", b"", b"\xffabc"]
    assert decode(lists.slice(1, 3))[0].to_pylist() == [b"bc\xff", b"", b""]
    assert decode(lists.slice(2, 2))[0].to_pylist() == [b"", b""] and decode(lists.slice(0, 0))[0].to_pylist() == []
    for bad in ([1], [8], [-1], [None]):
        with pytest.raises(ValueError, match="not in the vocabulary"):
            decode(pa.array([bad], pa.list_(pa.int32())))
