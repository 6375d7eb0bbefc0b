"""The contracts again, as plainly as possible, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {i: i + 32 for i in range(65, 91)}


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def components(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near(docs, k, percent):
    """doc -> (set size, component)."""
    sets = {d: shingles(t, k) for d, t in docs}
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links.append((a, b))
    whole = components(ids, links)
    return {d: (len(sets[d]), whole[d]) for d in ids}


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = WORD.findall(text)
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(triples)
    covered = {i + j for i, t in enumerate(triples) if count[t] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def line_dedup(docs, min_chars=20, min_docs=3):
    """doc -> (lines, dropped, kept text)."""
    holders: dict[str, set] = {}
    split = {d: (t or "").split("\n") for d, t in docs}
    key = lambda line: line.strip(SPACE).translate(LOW)
    for d, lines in split.items():
        for line in lines:
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(d)
    out = {}
    for d, lines in split.items():
        kept = [x for x in lines if not (len(h := holders.get(key(x), ())) >= min_docs and max(h) != d)]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def repeats(docs, length=50):
    """doc -> (bytes, removed, spans, kept bytes)."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        raw, own = (t or "").encode(), set()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            own.add(window)
            if window in seen:
                gone[i : i + length] = [True] * length
        seen |= own
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return out


PATTERNS = (
    (re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 6),
    (re.compile(r"(AKIA[A-Z0-9]+)"), 20),
    (re.compile(r"([0-9a-f]+)"), 24),
)


def base_secrets(text):
    found = []
    for k, (pattern, least) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            if len(m[pattern.groups]) >= least:
                found.append((m.start(), k, m.end()))
    return sorted(found)
