"""Plain forms of the rules, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    phrases = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
    places = [
        (i, label)
        for label, phrase in phrases
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def secret_base(text):
    text = text or ""
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def shingles(text):
    words = WORD.findall(lower(text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def near_components(rows):
    """{row number: component id} from (doc_id, text) rows, by comparing rows that share a shingle."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for j in {j for s in own for j in holders[s]}:
            if 100 * len(own & sets[j]) >= 75 * len(own | sets[j]):
                parent[root(i)] = root(j)
        for s in own:
            holders[s].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [d for d in (least.get(root(i)), doc_id) if d is not None]
        least[root(i)] = min(known, default=None)
    return {i: least[root(i)] for i in range(len(rows))}
