"""Pattern matching against a plain backtracking search, and its limits."""

import datetime as dt
import random
import time

import pytest

from quern.operators.match import Matcher, Var, match_recognize


def rows_of(letters, times=None):
    return [{"_mr_t": (times or range(len(letters)))[i], "ts": i, "id": i, "v": ord(c), **{f"_mr_{x}": x.lower() in "abc" and c in s for x, s in
             (("A", "ax"), ("B", "bx"), ("C", "cx"))}} for i, c in enumerate(letters)]


def preferred(rows, pattern, start, within):
    """End and places of the preferred match from ``start``, by trying all ways in order of preference."""
    def rec(p, i, places):
        if p == len(pattern):
            return i, places
        v, most = pattern[p], 0
        while i + most < len(rows) and (v.max is None or most < v.max) and rows[i + most][f"_mr_{v.name}"] and (
                within is None or rows[i + most]["_mr_t"] - rows[start]["_mr_t"] <= within):
            most += 1
        for n in (range(most, v.min - 1, -1) if v.greedy else range(v.min, most + 1)):
            found = rec(p + 1, i + n, [*places, (i, i + n)])
            if found:
                return found
        return None
    return rec(0, start, [])


def plain(rows, pattern, after, within=None):
    out, at = [], 0
    while at < len(rows):
        found = preferred(rows, pattern, at, within)
        if found is None:
            at += 1
            continue
        end, places = found
        out.append((at, end - 1, places[0][1] - places[0][0]))
        at = end if after == "PAST LAST ROW" else at + 1
    return out


@pytest.mark.parametrize("after", ["PAST LAST ROW", "TO NEXT ROW"])
@pytest.mark.parametrize("within", [None, 4])
@pytest.mark.parametrize("pattern", [
    [Var("A", 1, None), Var("B")], [Var("A", 1, None, False), Var("B")], [Var("A", 0, None), Var("B", 0, 2), Var("C")],
    [Var("A"), Var("B", 0, 1), Var("C", 2, 2)], [Var("A", 2, 3), Var("B", 1, None, False), Var("C")], [Var("A"), Var("B", 1, None, False)]])
def test_matches_equal_a_plain_search_in_any_batches(after, within, pattern):
    rng = random.Random(5)
    for _ in range(150):
        letters = "".join(rng.choices("abcx-", k=rng.randrange(1, 30)))
        t, times = 0, []
        for _ in letters:
            t += rng.randrange(3)
            times.append(t)
        rows = rows_of(letters, times)
        measures = {"s": ("first", None, "id"), "e": ("last", None, "id"), "n": ("count", "A", "id")}
        make = lambda: Matcher(pattern, measures, after, within, "ts", "id")
        m, got, at = make(), [], 0
        while at < len(rows):  # batches, with the state stored in between
            k = rng.randrange(1, 6)
            got += m.push(rows[at:at + k], False)
            at, state, m = at + k, m.dump(), make()
            m.load(state)
        got += m.push([], True)
        assert [(r["s"], r["e"], r["n"]) for r in got] == plain(rows, pattern, after, within)


def test_conditions_on_the_match_so_far():
    """Falling, then rising prices, by LAST with an offset, against a plain search."""
    rng = random.Random(6)
    down = lambda m: m.row["v"] < (m.first("S", "v") if m.last("D", "v", 1) is None else m.last("D", "v", 1))
    up = lambda m: m.row["v"] > (m.last("D", "v") if m.last("U", "v", 1) is None else m.last("U", "v", 1)) and m.sum("DU", "v") < 60
    for _ in range(200):
        v = [rng.randrange(12) for _ in range(rng.randrange(40))]
        rows = [{"_mr_t": i, "_mr_S": True, "_mr_E": x % 2 == 0, "ts": i, "id": i, "v": x} for i, x in enumerate(v)]
        m = Matcher([Var("S"), Var("D", 1, None), Var("U", 1, None), Var("E")], {"s": ("first", "S", "id"), "e": ("last", "E", "id"), "u": ("count", "U", "id"),
                    "low": ("min", "DU", "v")}, "PAST LAST ROW", None, "ts", "id", {"D": down, "U": up}, {"DU": ["D", "U"]})
        got = [(r["s"], r["e"], r["u"], r["low"]) for r in m.push(rows, True)]
        exp, at = [], 0
        while at < len(v):
            ways = []
            d = at + 1
            while d < len(v) and v[d] < v[d - 1]:
                d += 1
                u = d
                while u < len(v) and v[u] > v[u - 1] and sum(v[at + 1:u + 1]) < 60:
                    u += 1
                    if u < len(v) and v[u] % 2 == 0:
                        ways.append((d, u))
            if ways:
                d, u = max(ways)
                exp.append((at, u, u - d, min(v[at + 1:u])))
                at = u + 1
            else:
                at += 1
        assert got == exp


def test_skip_to_a_variable():
    for rows, starts in (("aaxxb", [0, 2]), ("axb", [0, 1]), ("axxab", [0, 1, 3])):
        m = Matcher([Var("A", 1, 2), Var("B")] if rows == "aaxxb" else [Var("A"), Var("B")], {"s": ("first", None, "id")}, ("TO FIRST", "B"), None, "ts", "id")
        assert [r["s"] for r in m.push(rows_of(rows), True)] == starts, rows
    m = Matcher([Var("A"), Var("B", 0, 1), Var("C")], {"s": ("first", None, "id")}, ("TO LAST", "B"), None, "ts", "id")
    with pytest.raises(ValueError, match="not in the match"):
        m.push(rows_of("ac"), True)
    m = Matcher([Var("A"), Var("B")], {}, ("TO FIRST", "A"), None, "ts", "id")
    with pytest.raises(ValueError, match="same match"):
        m.push(rows_of("ab"), True)


def test_last_variable_must_have_an_end():
    for last in (Var("B", 1, None), Var("B", 0, 1), Var("B", 1, 2)):
        with pytest.raises(ValueError, match="last variable"):
            Matcher([Var("A"), last], {}, "PAST LAST ROW", None, "ts", "id")
    with pytest.raises(ValueError, match="variable already"):
        Matcher([Var("A"), Var("B")], {}, "PAST LAST ROW", None, "ts", "id", subset={"A": ["B"]})


def test_time_grows_with_the_rows_and_old_rows_go():
    m = Matcher([Var("A", 1, None, False), Var("B")], {"n": ("count", "A", "id")}, "PAST LAST ROW", None, "ts", "id")
    rows = rows_of("a" * 99 + "b") * 2_000
    start = time.process_time()
    for at in range(0, len(rows), 1000):
        assert all(r["n"] == 99 for r in m.push(rows[at:at + 1000], False))
        assert len(m.rows) < 1000 and len(m.live) <= 1
    assert time.process_time() - start < 20


def test_runs_out_of_time_free_what_waits_behind_them():
    m = Matcher([Var("A"), Var("B", 1, None), Var("C")], {"s": ("first", None, "id")}, "TO NEXT ROW", 10, "ts", "id")
    rows = rows_of("abx", [0, 1, 2])
    assert [r["s"] for r in m.push(rows, False)] == []  # b may take x and wait for c
    assert [r["s"] for r in m.expire(10)] == [] and [r["s"] for r in m.expire(11)] == [0]


def test_batch_form_with_a_hot_key_null_keys_and_rows_without_time(spark):
    base = dt.datetime(2024, 1, 1)
    data = [("hot", base + dt.timedelta(seconds=i), i, float(i % 7)) for i in range(5000)]
    data += [(None, base + dt.timedelta(seconds=i), i, float(i % 3)) for i in range(9)] + [("hot", None, 1, 1.0), ("one", base, 1, 1.0)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id long, v double")
    out = match_recognize(df, ["k"], ["ts", "id"], [Var("S"), Var("U", 1, None), Var("E")],
                          {"U": lambda m: m.row["v"] > m.prev("v"), "E": lambda m: m.row["v"] == 0},
                          {"s": ("first", "S", "id"), "e": ("last", "E", "id"), "at": "match_rowtime", "last": "classifier"},
                          "s long, e long, at timestamp_ntz, last string", columns=["v"], back=1).collect()
    hot = sorted((r.s, r.e) for r in out if r.k == "hot")
    assert hot == [(0, 7)] + [(8 + 7 * i, 14 + 7 * i) for i in range((5000 - 15) // 7 + 1) if 14 + 7 * i < 5000]
    assert sorted((r.s, r.e) for r in out if r.k is None) == [(0, 3), (4, 6)]
    assert all(r["at"] == base + dt.timedelta(seconds=r.e) and r["last"] == "E" for r in out)
    empty = match_recognize(df.limit(0), ["k"], ["ts", "id"], [Var("S"), Var("E")], {}, {"s": ("first", "S", "id")}, "s long")
    assert empty.collect() == []
