"""Chat formatting and Merkle proofs against plain Python."""

import hashlib
import zlib

import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.llm.chat_format import escape, format_chats, loss_text, read_turns, unescape
from touchline.llm.merkle import fold, leaf_hash, manifest, proof_digest

TURNS = "turn long, conv_id long, role string, text string, formatted string, segments int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_format(turns):
    out, before = "", None
    for role, text in turns:
        if role == before:
            out = out.removesuffix("<|im_end|>\n") + "<|im_sep|>"
        else:
            out += f"<|im_start|>{role}\n"
        out += text.replace("<!|", "<!!|").replace("<|", "<!|") + "<|im_end|>\n"
        before = role
    return out


ODD_TURNS = [
    (0, 1, "user", "hello"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\nforged"), (2, 1, "assistant", None), (3, 1, "user", "a < b | c <| d <!| e"),
    (0, 2, None, "no role"), (1, 2, None, None), (2, 2, "", "empty role"), (None, 2, "user", "no turn"),
    (5, 3, "assistant", "again"), (5, 3, "assistant", "again"), (5, 3, "assistant", "<|im_sep|>"),
    (0, None, "user", "no id"), (1, None, "assistant", "Été \U0001f600 <"), (2, None, "assistant", "|im_end|>"),
    (0, 4, "odd\nrole <|im_end|> ", "x" * 200_000),
]


def grouped(rows):
    out = {}
    for turn, conv, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(rows)] for c, rows in out.items()}


@pytest.fixture(scope="module")
def chats(llm):
    rows = [(turn, conv, role, text, "clash", 7) for turn, conv, role, text in ODD_TURNS]
    return format_chats(llm.createDataFrame(rows, TURNS).repartition(3)).cache()


def test_turns_come_back_as_they_were(chats):
    read = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chats.select("conv_id", read_turns(F.col("formatted")).alias("turns")).collect()}
    assert read == grouped(ODD_TURNS)


def test_formatted_as_in_plain_python(chats):
    got = {r.conv_id: r.formatted for r in chats.collect()}
    for conv, turns in grouped(ODD_TURNS).items():
        if conv != 4 and conv != 2:
            assert got[conv] == plain_format(turns)
    assert got[1].count("<|im_start|>") == 3
    assert got[4].startswith("<|im_start|>odd%0Arole+%3C%7Cim_end%7C%3E+\n")


def test_loss_is_on_assistant_texts_alone(chats):
    for r in chats.select("conv_id", "formatted", "segments", loss_text(F.col("segments")).alias("loss")).collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.loss == "".join(t for role, t in grouped(ODD_TURNS)[r.conv_id] if role == "assistant")


def test_other_loss_roles_and_no_rows(llm):
    frame = llm.createDataFrame([(0, 1, "system", "s", "", 0), (1, 1, "user", "u", "", 0)], TURNS)
    assert format_chats(frame, loss_roles=("system", "user")).select(loss_text(F.col("segments"))).first()[0] == "su"
    assert format_chats(frame.limit(0)).collect() == []


@settings(max_examples=15, deadline=None)
@cases(st.lists(st.text("<!|im_>a\n", max_size=12), min_size=1, max_size=40))
def test_escapes_are_undone(llm, texts):
    frame = llm.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in frame.select("t", "e", unescape(F.col("e")).alias("back")).collect():
        assert r.back == r.t and "<|" not in r.e


def test_a_long_conversation_is_linear(llm):
    n = 30_000
    turns = llm.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("text "), "id").alias("text"),
    )
    row = format_chats(turns).select(F.size(read_turns(F.col("formatted"))), F.length(loss_text(F.col("segments")))).first()
    assert row[0] == n
    assert row[1] == sum(len(f"text {i}") for i in range(n) if i % 3)


def plain_leaf(row, lower=False):
    doc, source, lang, chars, text = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    parts = [None if v is None else str(v) for v in (doc, source, lang, chars, text)]
    return sha("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def plain_tree(leaves):
    """Root, and for each leaf the siblings (left, right) of every level."""
    paths, nodes, owners = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        ups, up_owners = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for k in range(len(run)):
                for leaf in owners[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            ups.append(sha("".join(run)))
            up_owners.append([i for k in range(len(run)) for i in owners[at + k]])
        nodes, owners = ups, up_owners
    return nodes[0], paths


def plain_manifest(rows):
    """[(doc_id, leaf, subroot, root, proof digest)] of all rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, members = {}, {}
    for source in order:
        members[source] = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[source] = plain_tree([plain_leaf(r) for r in members[source]])
    root, tops = plain_tree([trees[s][0] for s in order])
    out = []
    for number, source in enumerate(order):
        for row, path in zip(members[source], trees[source][1], strict=True):
            out.append((row[0], plain_leaf(row), trees[source][0], root, sha("".join(a + b for a, b in path + tops[number]))))
    return out


DOCS = "text string, doc_id long, lang string, source string, n_chars long, path string, leaf_of int"


def docs_frame(llm, rows):
    return llm.createDataFrame([(t, d, g, s, n, "clash", 1) for d, s, g, n, t in rows], DOCS).repartition(5)


def spark_manifest(frame):
    fields = [frame[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return manifest(frame.withColumn("leaf", leaf_hash(fields)), "source", "doc_id", "leaf", ["n_chars"])


@pytest.mark.parametrize("sizes", [(1,), (2, 16, 17, 1), (3,) * 18, (1, 273)])
def test_roots_and_proofs_equal_plain_ones(llm, sizes):
    rows = [(1000 * i + j, None if i == 1 else f"src{i}", "en" if j % 3 else None, j, None if j == 2 else f"Text {i} {j} É") for i, n in enumerate(sizes) for j in range(n)]
    got = spark_manifest(docs_frame(llm, rows)).withColumn("back", fold(F.col("leaf"), F.col("path"))).withColumn("proof", proof_digest(F.col("path"))).collect()
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in got) == sorted(plain_manifest(rows))
    assert all(r.back == r.root for r in got)


def test_null_and_repeated_ids_and_no_rows(llm):
    rows = [(None, "a", None, None, None)] * 2 + [(7, "a", "en", 1, "x"), (7, "a", "en", 1, "y"), (7, "a", "en", 1, "x"), (None, None, None, None, "")]
    got = spark_manifest(docs_frame(llm, rows)).withColumn("proof", proof_digest(F.col("path"))).collect()
    key = lambda r: tuple((v is not None, v) if v is not None else (False, 0) for v in r)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in got), key=key) == sorted(plain_manifest(rows), key=key)
    assert spark_manifest(docs_frame(llm, rows).limit(0)).collect() == []


def test_tampered_rows_do_not_verify(llm, folder, tmp_path):
    from touchline.llm.merkle import op12_merkle_manifest

    got = op12_merkle_manifest(llm, folder).collect()
    rows = {r.doc_id: (r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in llm.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(got) == len(rows)
    for r in got:
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and plain_leaf(rows[r.doc_id], True) != plain_leaf(rows[r.doc_id])
        assert r.verified == (not changed)
    assert any(not r.verified for r in got)
