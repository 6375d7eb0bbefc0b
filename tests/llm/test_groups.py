"""Operators that compare texts or vectors."""

import math

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from plain import components, line_dedup, near, repeats

from touchline.llm import embedding_join, graph, jaccard_join, suffix_dedup
from touchline.llm.embedding_join import link_by_cosine
from touchline.llm.jaccard_join import near_documents
from touchline.llm.line_dedup import PerfectHash, dedup_lines
from touchline.llm.suffix_sort import deep_shallow


def near_copies(n, words, edits, seed, base="w"):
    rng = np.random.default_rng(seed)
    text = [f"{base}{i}" for i in range(words)]
    out = []
    for k in range(n):
        own = list(text)
        for at in rng.integers(0, words, edits):
            own[at] = f"x{k}_{at}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_near_documents_equal_brute_force(documents, given, nothing, k, percent):
    want = near(given, k, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_documents(documents, k, percent).collect()}
    assert got == want
    assert near_documents(nothing, k, percent).count() == 0


def test_large_groups_of_near_copies_are_joined_recursively(llm, monkeypatch):
    """Groups larger than a region and a task: cells, stuck blocks and pivots all take part."""
    monkeypatch.setattr(jaccard_join, "LEAF_DOCS", 12)
    texts = near_copies(60, 80, 1, 1) + near_copies(50, 90, 3, 2, "v") + near_copies(40, 60, 9, 3, "u")
    texts += [" ".join(f"hot{i}" for i in range(40)) + f" tail{j} end{j}" for j in range(45)] + texts[:5]
    docs = list(enumerate(texts))
    frame = llm.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_documents(frame, 3, 90).collect()}
    assert got == near(docs, 3, 90)


def test_rows_with_null_and_repeated_keys(llm):
    text = " ".join(f"a{i}" for i in range(30))
    frame = llm.createDataFrame([(None, text), (5, text), (5, text), (3, text + " b"), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in near_documents(frame, 3, 90).collect())
    assert got == [(-1, -1), (3, 3), (5, 3), (5, 3), (9, 9)]
    lines = llm.createDataFrame([(None, "a line of twenty characters or more")] + [(d, "a line of twenty characters or more\nx") for d in (4, 4, 7)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_dropped, r.kept) for r in dedup_lines(lines).collect())
    assert got == [(-1, 1, ""), (4, 1, "x"), (4, 1, "x"), (7, 0, "a line of twenty characters or more\nx")]
    long = "z" * 20 + "".join(f"{i:03d}" for i in range(40))
    raw = llm.createDataFrame([(None, long), (4, long), (4, long), (7, "yy" + long)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed, bytes(r.kept).decode()) for r in suffix_dedup.remove_repeats(raw).collect())
    assert got == [(-1, 0, long), (4, 0, long), (4, 0, long), (7, len(long), "yy")]


def test_lines_equal_brute_force(documents, given, nothing):
    want = line_dedup(given)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in dedup_lines(documents).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 10
    assert dedup_lines(nothing).count() == 0


def test_hot_lines_are_dealt_over_copies(llm, monkeypatch):
    monkeypatch.setattr("touchline.llm.line_dedup.PROBES", 8)
    monkeypatch.setattr("touchline.llm.line_dedup.SHARD_KEYS", 4)
    docs = [(d, "\n".join(["one line that everybody has in the text", f"line number {d % 9} of a smaller family", f"own line {d} of nobody else at all"])) for d in range(80)]
    frame = llm.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in dedup_lines(frame).collect()}
    assert got == line_dedup(docs)


@settings(max_examples=40, deadline=None)
@cases(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash_is_minimal(keys):
    keys = np.array(sorted(keys), np.uint64)
    hashed = PerfectHash.build(keys)
    assert sorted(hashed.find(keys).tolist()) == list(range(len(keys)))


def test_repeated_keys_have_no_perfect_hash():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([3, 3], np.uint64))


@pytest.mark.parametrize("hot", [3, 4096])
def test_repeats_equal_brute_force(documents, given, nothing, hot):
    want = repeats(given)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(documents, hot=hot).collect()}
    assert got == want
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_repeats_across_segments_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    off = np.array([0, 10, 3000, 3049, 3099, 5000])
    whole = suffix_dedup.anchors(data, off)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 333)
    cut = suffix_dedup.anchors(data, off)
    windows = lambda a: {(int(w) + i): int(h) for h, w, n in zip(*a, strict=True) for i in range(n)}
    assert windows(whole) == windows(cut)
    assert set(windows(whole)) == {w for a, b in zip(off[:-1], off[1:], strict=True) for w in range(a, b - 49)}


@settings(max_examples=60, deadline=None)
@cases(st.text("ab", min_size=40, max_size=200), st.integers(9, 30), st.sampled_from([8, 16]))
def test_deep_shallow_order(text, depth, shallow):
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.arange(len(data) - depth + 1)
    order, equal = deep_shallow(data, starts, depth, shallow)
    found = [text[s : s + depth] for s in starts[order]]
    assert found == sorted(found)
    assert equal.tolist() == [bool(i and found[i] == found[i - 1]) for i in range(len(found))]
    assert sorted(order.tolist()) == starts.tolist()


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 16))
    return [(centres[i % 6] + rng.normal(size=16) * (0.1 if i % 3 else 0.6)).tolist() for i in range(n)]


def linked(rows, cosine):
    good = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    unit = {i: v / np.sqrt((v * v).sum()) for i, v in good.items()}
    links = [(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] >= cosine]
    whole = components([i for i, _ in rows], links)
    return {i: (sum(i in x for x in links), whole[i], whole[i] == i) for i, _ in rows}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_equal_brute_force(llm, monkeypatch, kind):
    monkeypatch.setattr(embedding_join, "BLOCK", 16)
    monkeypatch.setattr(embedding_join, "FAN_OUT", 2)
    values = vectors(150, 7)
    values = [[float(np.float32(x)) for x in v] for v in values]
    odd = [None, [0.0] * 16, [math.nan] + [1.0] * 15, [None] + [1.0] * 15, [math.inf] + [0.0] * 15, values[0], values[0], [-0.0] + [0.0] * 14 + [3.0], [0.0] * 15 + [3.0], [0.0] * 15 + [1e-30]]
    rows = list(enumerate(values + odd))
    frame = llm.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, n_links int, key string").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_join.link_by_cosine(frame, 0.9).collect()}
    assert got == linked(rows, 0.9)
    assert embedding_join.link_by_cosine(frame.limit(0), 0.9).count() == 0


def test_vectors_of_unequal_lengths_and_rows_that_share_an_id(llm):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0, 0.0]), (4, [0.0, 2.0, 0.0, 0.0]), (5, [0.99, 0.01])]
    got = {r.vec_id: r for r in link_by_cosine(llm.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9).collect()}
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {1: (1, 1), 2: (1, 2), 3: (0, 3), 4: (1, 2), 5: (1, 1)}
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [0.0, 1.0]), (7, [0.0, 3.0]), (8, [-1.0, 0.0])]
    got = link_by_cosine(llm.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [
        (1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (7, 1, 1, False), (8, 0, 8, True),
    ]


def test_far_blocks_are_skipped(llm):
    boxes = [(i, [float(i), 0.0], [i + 0.5, 0.0]) for i in range(20)]
    frame = llm.createDataFrame(boxes, "block long, low array<double>, high array<double>")
    got = {(r.a, r.b) for r in embedding_join.near_blocks(frame, 20, 0.6, 2).collect()}
    assert got == {(i, j) for i in range(20) for j in range(i, 20) if j - i <= 1}


def test_components_of_chains_stars_and_cliques(llm):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(i, j) for i in range(200, 212) for j in range(200, i)] + [(300, 300), (400, None), (7, 7)]
    frame = llm.createDataFrame(links, "a long, b long").repartition(5)
    got = {r.node: r.component for r in graph.components(frame).collect()}
    want = components(range(500), [x for x in links if x[1] is not None])
    assert got == {n: c for n, c in want.items() if n != c}
    assert graph.components(frame.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@cases(st.integers(1, 12), st.integers(1, 12), st.floats(0, 1), st.integers(0, 1000))
def test_spanning_links_connect_the_same(n, m, share, seed):
    linked = np.random.default_rng(seed).random((n, m)) < share
    i, j = graph.spanning(linked)
    assert linked[i, j].all()
    nodes = range(n + m)
    every = components(nodes, [(a, n + b) for a, b in zip(*np.nonzero(linked), strict=True)])
    assert components(nodes, [(a, n + b) for a, b in zip(i, j, strict=True)]) == every
