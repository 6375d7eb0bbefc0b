"""Token files, packing, the line classifier, and the pipeline."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from plain import base_secrets, line_dedup, near, quality

from touchline.llm import byte_bpe, packing, quality_crf, token_counts
from touchline.llm.packing import Item, Limits, Packer, pack_examples, pack_texts
from touchline.llm.text import texts_of
from touchline.llm.word_bpe import tokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def ids_of(text):
    return [*tokenizer(WORDS).encode(text or "", add_special_tokens=False).ids, 2]


def check_sequences(rows, limits):
    """Pieces of each sequence follow each other, limits hold, and padding is nothing."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for pieces in by.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        total = sum(r.length for r in pieces)
        assert total == limits.tokens or total & (total - 1) == 0
        assert total <= limits.tokens and len(pieces) <= limits.segments and sum(r.n_loss for r in pieces) <= limits.loss
        assert all(r.length > 0 for r in pieces)


@pytest.mark.parametrize("limits", [Limits(), Limits(tokens=64, segments=3, loss=64)])
def test_every_id_is_packed_once(documents, given, nothing, limits):
    rows = pack_texts(documents, WORDS, limits, with_ids=True).collect()
    check_sequences(rows, limits)
    for doc, text in given:
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        want = ids_of(text)
        assert [i for r in own for i in r.ids] == want
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        for r in own:
            assert r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert pack_texts(nothing, WORDS).count() == 0


def test_windows_hand_over_what_is_left(documents, given, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW_ITEMS", 5)
    words = tokenizer(WORDS)
    out = []
    packer = Packer(Limits(tokens=128, segments=4, loss=128), lambda *piece: out.append(piece), 0)
    total = 0
    for k, (doc, text) in enumerate(given):
        ids = np.array([*words.encode(text or "", add_special_tokens=False).ids, 2], np.uint32)
        total += len(ids)
        packer.add(Item(doc, ids, np.arange(len(ids) + 1)))
        if k % 5 == 4:
            packer.run(last=False)
    packer.run(last=True)
    assert sum(n for _, _, n, _, _ in out) == total


@settings(max_examples=60, deadline=None)
@cases(st.lists(st.lists(st.booleans(), min_size=1, max_size=40), max_size=12), st.integers(2, 5), st.integers(1, 4), st.integers(1, 20))
def test_limits_hold_for_any_examples(flags, power, segments, loss):
    limits = Limits(2**power, segments, min(loss, 2**power))
    out = []
    packer = Packer(limits, lambda *piece: out.append(piece), 0)
    for k, f in enumerate(flags):
        packer.add(Item(k, np.arange(len(f), dtype=np.uint32), np.concatenate(([0], np.cumsum(f)))))
    packer.run(last=True)
    by = {}
    covered = {}
    for item, start, n, sequence, _ in out:
        by.setdefault(sequence, []).append((n, int(item.loss_before[start + n] - item.loss_before[start])))
        covered.setdefault(item.doc, []).extend(range(start, start + n))
    assert covered == {k: list(range(len(f))) for k, f in enumerate(flags)} or {k: sorted(v) for k, v in covered.items()} == {k: list(range(len(f))) for k, f in enumerate(flags)}
    for pieces in by.values():
        assert len(pieces) <= segments and sum(n for n, _ in pieces) <= limits.tokens and sum(x for _, x in pieces) <= limits.loss


def test_examples_with_loss_flags(llm):
    rows = [(1, [5, 6, 7, 8], [False, False, True, True]), (2, [9, 9], None), (3, None, [True]), (4, [], []), (5, [1] * 10, [True] * 10), (None, [4], [None])]
    frame = llm.createDataFrame(rows, "doc_id long, ids array<int>, loss array<boolean>").coalesce(1)
    limits = Limits(tokens=8, segments=2, loss=4)
    out = pack_examples(frame, limits).collect()
    check_sequences(out, limits)
    assert {r.doc_id for r in out} == {1, 2, 5, None}
    assert sum(r.n_loss for r in out) == 12
    assert sorted(i for r in out if r.doc_id == 1 for i in r.ids) == [5, 6, 7, 8]


@pytest.mark.parametrize("block", [7, 1 << 16])
def test_counts_from_files_alone(documents, given, nothing, block):
    separator = 50256
    enc = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    blocks, held = token_counts.write_token_files(documents, RANKS, public_tokenizers.PATTERN, separator, block_tokens=block)
    counts = token_counts.count_tokens(blocks, separator, group=50)
    got = {r.doc_id: r.n_tokens for r in held.join(counts, ["file", "nth"], "full").collect()}
    assert got == {d: len(enc.encode_ordinary(t or "")) for d, t in given}
    blocks, held = token_counts.write_token_files(nothing, RANKS, public_tokenizers.PATTERN, separator)
    assert token_counts.count_tokens(blocks, separator).count() == 0 and held.count() == 0


def test_counts_of_plain_files(llm, tmp_path):
    ids = np.array([5, 0, 1, 2, 5, 5, 3, 3, 3, 5, 4, 4], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    blocks = token_counts.blocks_of_files(llm, str(tmp_path), 3)
    got = sorted((r.nth, r.n_tokens) for r in token_counts.count_tokens(blocks, 5, 2).collect())
    assert got == [(0, 0), (1, 3), (2, 0), (3, 3), (4, 2)]


def test_marginals_equal_sums_over_all_labellings():
    rng = np.random.default_rng(0)
    first = np.array([0, 1, 4, 4, 9])
    emission, steps = rng.normal(size=9), rng.normal(size=(2, 2))
    good, pairs = quality_crf.marginals(emission, first, steps, pairs=True)
    want, joint = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        if not n:
            continue
        weights = []
        for code in range(1 << n):
            y = [(code >> t) & 1 for t in range(n)]
            weights.append((np.exp(sum(emission[a + t] * y[t] for t in range(n)) + sum(steps[y[t], y[t + 1]] for t in range(n - 1))), y))
        total = sum(w for w, _ in weights)
        for w, y in weights:
            want[a:b] += w / total * np.array(y)
            for t in range(n - 1):
                joint[y[t], y[t + 1]] += w / total
    assert good == pytest.approx(want) and pairs == pytest.approx(joint)


def test_neighbours_pull_a_doubtful_line():
    field_steps = np.array([[1.0, -1.0], [-1.0, 1.0]])
    alone, _ = quality_crf.marginals(np.array([-0.5]), np.array([0, 1]), field_steps)
    among, _ = quality_crf.marginals(np.array([3.0, -0.5, 3.0]), np.array([0, 3]), field_steps)
    assert alone[0] < 0.5 < among[1]


def test_quality_of_held_out_documents(llm, folder):
    folder = folder.replace("sf0.001", "sf0.01")
    docs, labels = (llm.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    field = quality_crf.train(docs, labels)
    out = quality_crf.score_documents(docs, field).join(labels, "doc_id").withColumn("held", quality_crf.held_out("doc_id"))
    rows = out.where("held").select("score", "quality", "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows) and len(rows) > 80
    assert np.mean([(r.score >= 0.5) == bool(r.quality) for r in rows]) > 0.95


def test_scores_of_odd_texts(documents, given, nothing):
    texts = texts_of(pa.array([t for _, t in given]))
    rng = np.random.default_rng(1)
    features, _, first = quality_crf.line_features(texts)
    field = quality_crf.fit(features, first, rng.integers(0, 2, len(texts)), steps=5)
    rows = quality_crf.score_documents(documents, field).collect()
    assert len(rows) == len(given) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert all(by[10_000 + i] == pytest.approx(by[20_000 + i]) for i in range(13))
    assert quality_crf.score_documents(nothing, field).count() == 0


def test_training_without_both_labels(llm, documents):
    labels = llm.createDataFrame([(0, 1, None), (2, 1, 0), (None, 0, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    field = quality_crf.train(documents, labels)
    assert {r.score for r in quality_crf.score_documents(documents, field).collect()} == {0.5}


def test_pipeline_stages_equal_brute_force(llm, folder):
    import corpus_pipeline as pipeline
    from touchline.session import materialize

    docs = llm.read.parquet(f"{folder}/documents.parquet")
    before = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "near duplicates", "secret scans", "packing"]
    seen = {}
    for name, stage in stages.items():
        docs = materialize(stage(llm, docs, folder), "stage")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = {k: [(r.doc_id, r.text) for r in v.collect()] for k, v in seen.items() if k != "packing"}
    kept = dict(rows["quality rules"])
    assert all(d not in kept for d, t in before if quality(t)[5])
    assert sum(d in kept for d, t in before if not quality(t)[5]) > 100
    want = {d: t for d, (_, _, t) in line_dedup(rows["quality rules"]).items() if t.strip()}
    assert dict(rows["line dedup"]) == want
    groups = near(rows["line dedup"], 5, 80)
    assert dict(rows["near duplicates"]) == {d: t for d, t in want.items() if groups[d][1] == d}
    last = dict(rows["secret scans"])
    assert set(last) == set(dict(rows["near duplicates"]))
    for d, t in rows["near duplicates"]:
        assert not base_secrets(last[d]) and (base_secrets(t) or last[d] == t or "[secret]" in last[d])
    pieces = seen["packing"].collect()
    assert {r.doc_id for r in pieces} == set(last)
    check_sequences(pieces, Limits())
    for d, t in rows["secret scans"]:
        own = sorted((r.start, r.ids) for r in pieces if r.doc_id == d)
        assert [i for _, ids in own for i in ids] == ids_of(t)


def test_pipeline_of_nothing(llm, folder, tmp_path):
    import corpus_pipeline as pipeline

    llm.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(llm, str(tmp_path)).count() == 0
