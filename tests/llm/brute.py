"""Plain versions of the contracts, one document after another."""

import re

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(UPPER))


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def shingle_set(text, size):
    w = blank_words(text)
    n = min(size, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def components(sets, percent):
    """sets: {id: set} -> {id: smallest id reachable}, over all pairs."""
    label = {k: k for k in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {k: root(k) for k in sets}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                    "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]():
                out.append((kind, m.start(), m.end()))
    return out
