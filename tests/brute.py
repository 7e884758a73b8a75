"""Brute-force reference implementations used by the tests (plain Python)."""

from __future__ import annotations

import re


def java_hash(s: str) -> int:
    h = 0
    for ch in s:
        h = (31 * h + ord(ch)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def state_machine(events, table, initial="Initial"):
    """events: list of (key, order, letter, id) -> alerts [(key, state, letter, id)]."""
    state, alerts = {}, []
    for key, _, ev, ident in sorted(events, key=lambda e: (e[0], e[1], e[3])):
        cur = state.get(key, initial)
        nxt = table.get(cur, {}).get(ev)
        if nxt is None:
            alerts.append((key, cur, ev, ident))
        elif nxt not in table:
            state.pop(key, None)
        else:
            state[key] = nxt
    return alerts


def delta_trigger(rows, threshold):
    """rows: (key, order, id, value) -> firings [(key, id, value, count)]."""
    out, last, cnt = [], {}, {}
    for key, _, ident, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        cnt[key] = cnt.get(key, 0) + 1
        if key not in last:
            last[key] = v
        elif abs(v - last[key]) > threshold:
            last[key] = v
            out.append((key, ident, v, cnt[key]))
    return out


def regex_match(symbols, pattern, within=None, times=None):
    """Non-overlapping leftmost matches (skip past last row) of a pattern of
    (var, min, max, greedy) over rows given as sets of satisfied variables,
    by translating to a Python regex over one character per row and
    variable choice.  Only used for patterns whose variables are mutually
    exclusive per row, where the translation is exact."""
    letters = {}
    for i, (v, *_rest) in enumerate(pattern):
        letters[v] = chr(ord("A") + i)
    text = "".join(next((letters[v] for v in letters if v in s), "_") for s in symbols)
    parts = []
    for v, lo, hi, greedy in pattern:
        q = "{%d,%s}" % (lo, "" if hi is None else hi)
        parts.append(letters[v] + q + ("" if greedy else "?"))
    rx = re.compile("".join(parts))
    out, pos = [], 0
    while pos < len(text):
        m = rx.match(text, pos)
        if m and m.end() > m.start() and (within is None or times[m.end() - 1] - times[pos] <= within):
            out.append((m.start(), m.end()))
            pos = m.end()
        else:
            pos += 1
    return out
