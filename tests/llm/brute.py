"""Plain Python answers, written from the definitions and without the operators."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PLAIN_WORD = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text):
    assign = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    said = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))
    count = Counter(f[3] for f in found)
    return count["assign"], count["access"], count["hex"], sha(said)


def shingle_set(text):
    words = PLAIN_WORD.findall(low(text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def components(rows):
    """rows: (doc_id, text) -> {(doc_id, n_shingles, component_id)}, by comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(a), find(i)) for i, a in sets)


def contamination(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(low(text))
        size = min(10, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[k : k + size])].add(item)
    out = []
    for doc, text in rows:
        words = WORD.findall(low(text))
        hit, found = [False] * len(words), set()
        for size in {len(window) for window in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit[k : k + size] = [True] * size
                    found |= windows[tuple(words[k : k + size])]
        out.append((doc, len(words), sum(hit), len(found), sha(",".join(sorted(map(str, found))))))
    return sorted(out)


def quality(text):
    text = text or ""
    words = PLAIN_WORD.findall(text)
    at = defaultdict(list)
    for k in range(len(words) - 7):
        at[tuple(words[k : k + 8])].append(k)
    hit = set()
    for places in at.values():
        if len(places) > 1:
            hit.update(p + d for p in places for d in range(8))
    seen, again = set(), 0
    for line in text.split("\n"):
        if PLAIN_WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit), failed


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    words = WORD.findall(low(text))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        said = phrase.split()
        for k in range(len(words) - len(said) + 1):
            if words[k : k + len(said)] == said:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def line_key(line):
    return low(line.strip(" \t\n\x0b\x0c\r"))


def lines(rows):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= 10:
                holders[line_key(line)].add(doc)
    out = []
    for doc, text in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if len(holders.get(line_key(x), ())) < 2 or min(holders[line_key(x)]) == doc]
        out.append((doc, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out)
