"""Lexical search against plain Python, hashes of awkward strings."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from touchline.llm import lexical_search
from touchline.llm.lexical_search import LEVELS, TERM, search
from touchline.llm.line_dedup import dedup_lines
from touchline.llm.text import LOWER, Hasher, _product

DOCS = "rank int, text string, doc_id long, score double"
ITEMS = "item_id long, doc_id int, text string"


def terms(text):
    return re.findall(TERM, bytes(LOWER[np.frombuffer((text or "").encode(), np.uint8)]).decode())


def plain_search(docs, items, top):
    counts = [Counter(terms(t)) for _, t in docs]
    held = Counter(t for c in counts for t in c)
    n, total = sum(1 for c in counts if c), sum(c.total() for c in counts)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), c in zip(docs, counts, strict=True):
            if c:
                m = 75 + (25 * c.total() * n) // total
                gain = lambda t: math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))  # noqa: B023, E731
                scored.append((-sum(k * gain(t) for t, k in Counter(terms(text)).items()), doc is not None, doc or 0))
        best = sorted(s for s in scored if s[0] < 0)[:top]
        out += [(item, i + 1, d if some else None, -s) for i, (s, some, d) in enumerate(best)]
    return out


def sorted_rows(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def run(llm, docs, items, top=20):
    frame = llm.createDataFrame([(7, t, d, 0.5) for d, t in docs], DOCS).repartition(4)
    asked = llm.createDataFrame([(i, 3, t) for i, t in items], ITEMS)
    return [tuple(r) for r in search(frame, asked, top=top).collect()]


ITEM_TEXTS = [None, "", "... -- !!", "one", "same same words", "a LINE that several documents hold", "Été naïve 中文 joined", "nowhere xyzzy", "x" * 300 + " token"]


def test_ranks_equal_plain_ones(llm, given):
    items = [(i % 7 if i else None, t) for i, t in enumerate(ITEM_TEXTS)] + [(100 + d, t) for d, t in given[:12]]
    docs = [*given, (None, "one line without an id"), (None, "one line without an id"), (10_003, "one again")]
    assert sorted_rows(run(llm, docs, items)) == sorted_rows(plain_search(docs, items, 20))


def test_many_copies_and_ties(llm, monkeypatch):
    docs = [(i, "the same common words stand here") for i in range(0, 600, 2)] + [(i, f"the same common words stand there {i}") for i in range(1, 600, 2)]
    docs += [(1000 + i, "filler " * i + "words") for i in range(1, 90)]
    items = [(1, "common words"), (2, "words"), (3, "filler filler the same here"), (4, "stand there")]
    assert sorted_rows(run(llm, docs, items, 7)) == sorted_rows(plain_search(docs, items, 7))


def test_small_batches_and_blocks_give_the_same(llm, given, monkeypatch):
    items = [(i, t) for i, (_, t) in enumerate(given[:9])]
    monkeypatch.setattr(lexical_search, "BATCH_TERMS", 40)
    assert sorted_rows(run(llm, given, items, 5)) == sorted_rows(plain_search(given, items, 5))


def test_no_documents_and_no_items(llm):
    assert run(llm, [], [(1, "a")]) == []
    assert run(llm, [(1, "a b"), (2, None)], []) == []
    assert run(llm, [(1, None), (2, "--")], [(1, "a")]) == []


def test_bounds_are_never_too_low():
    rng = np.random.default_rng(5)
    names = [f"t{i}" for i in range(60)]
    rows = [type("Row", (), {"item": i % 4, "term": t, "weight": 100 + i}) for i, t in enumerate(names)]
    batch = lexical_search._Batch(rows, {})
    group = []
    for d in range(40):
        some = np.sort(rng.choice(60, rng.integers(1, 30), replace=False))
        tf = np.minimum(1 + rng.geometric(0.3, len(some)), 200) if d else np.full(len(some), 5000)
        group.append((d, int(tf.sum()), batch.hashes[some], tf, some))
    block = lexical_search._Blocks.block(5, [g[:4] for g in group])
    lengths = np.array(block["lengths"])
    for at, to, add in lexical_search._bounds(batch, block["n_rows"], lengths, block["bits"], 40, int(lengths.sum())):
        for d in range(at, to):
            _, length, _, tf, some = group[d]
            m = 75 + 25 * length * 40 // int(lengths.sum())
            exact = np.zeros(60, np.int64)
            exact[some] = 10**9 * tf // (1000 * tf + 12 * m)
            assert (add[:, d - at] >= exact).all()
            low = np.isin(tf, LEVELS[:3])
            assert not low.any() or (add[some[low], d - at] == exact[some[low]]).mean() > 0.5


def thue_morse(n):
    out = b"a"
    while len(out) < n:
        out += out.translate(bytes.maketrans(b"ab", b"ba"))
    return out


def test_products_modulo_the_prime():
    p = 2**61 - 1
    rng = np.random.default_rng(3)
    a = np.append(rng.integers(0, p, 2000, dtype=np.uint64), np.array([0, 1, p - 1, p - 1, 2**31], np.uint64))
    b = np.append(rng.integers(0, p, 2000, dtype=np.uint64), np.array([p - 1, p - 1, p - 1, 1, 2**60], np.uint64))
    assert _product(a, b).tolist() == [int(x) * int(y) % p for x, y in zip(a, b, strict=True)]


@pytest.mark.parametrize("n", [64, 1024, 1 << 16])
def test_hashes_tell_thue_morse_strings_apart(n):
    one = thue_morse(n)
    other = one.translate(bytes.maketrans(b"ab", b"ba"))
    hashes = Hasher(np.frombuffer(b"xy" + one + other + one, np.uint8)).spans(np.array([2, 2 + n, 2 + 2 * n]), np.array([2 + n, 2 + 2 * n, 2 + 3 * n]))
    assert hashes[0] == hashes[2] != hashes[1]


def test_no_line_goes_for_a_string_that_collides_in_powers_of_two(llm):
    one = thue_morse(1024).decode()
    other = one.translate(str.maketrans("ab", "ba"))
    got = dedup_lines(llm.createDataFrame([(1, one), (2, one), (3, other)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_dropped) for r in got} == {(1, 0), (2, 0), (3, 0)}
