"""Suffix-array dedup: removes what 50-byte strings repeat from documents with smaller ids.

Sorting a suffix for each byte of the corpus would move it many times over. Any
50 bytes contain 35 strings of 16; the one with the least hash is the anchor of
that 50-byte window, the same wherever the window occurs. So

1. texts are packed into chunks, written once;
2. chunks send their anchors' hashes (about one for 18 bytes) to buckets, which
   tell each chunk the ones that occur elsewhere;
3. only windows of shared anchors travel, as short stretches of text, equal ones
   once a chunk. Each bucket orders their suffixes to depth 50, deep-shallow,
   and finds for each run of equal ones the smallest document;
4. chunks get the stretches they lose.

Windows of anchors with very many occurrences are dealt out by their own hash
instead of the anchor's, so a passage that a third of all documents share fills
no single bucket.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.suffix_sort import deep_shallow
from touchline.llm.tables import query, table
from touchline.llm.text import Hasher, mix, slices
from touchline.session import materialize

LENGTH = 50
GRAM = 16
CHUNK_BYTES = 2 << 20
SEGMENT = 1 << 19
BUCKET_BYTES = 4 << 20
HOT = 4096
META = np.dtype([("doc", "<i8"), ("idx", "<u4"), ("start", "<u4"), ("n", "<u4")])
SPAN = np.dtype([("idx", "<u4"), ("start", "<u4"), ("end", "<u4")])
CHUNKS = "chunk long, docs array<long>, digests array<binary>, sizes array<long>, packed binary"


def _chunks(batches):
    base = TaskContext.get().partitionId() << 24
    for k, (rows, texts) in enumerate(slices(batches, "text", CHUNK_BYTES)):
        digests = [hashlib.blake2b(texts.text(i), digest_size=16).digest() for i in range(len(texts))]
        packed = zstandard.ZstdCompressor(level=3).compress(texts.data.tobytes())
        columns = [[base + k], [rows.column("doc_id").to_pylist()], [digests], [np.diff(texts.off).tolist()], [packed]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["chunk", "docs", "digests", "sizes", "packed"])


def _each(batches):
    """Rows as dictionaries, one at a time: they are large."""
    for rows in batches:
        for i in range(rows.num_rows):
            yield rows.slice(i, 1).to_pylist()[0]


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["packed"]), np.uint8) if row["packed"] else np.zeros(0, np.uint8)
    return data, np.concatenate(([0], np.cumsum(np.array(row["sizes"], np.int64))))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at each place, taken as two whole words; anchors only deal windows out, so nothing rests on it."""
    words = np.ascontiguousarray(np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,)))
    return mix(words[: len(data) - GRAM + 1] ^ mix(words[8:] + np.uint64(0xA0761D6478BD642F)))


def _anchors_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor, and the first window and number of windows it stands for; windows stay in their text."""
    begin, end = off[:-1], off[1:] - LENGTH + 1
    begin, end = begin[end > begin], end[end > begin]
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(len(data) - GRAM + 1)
    hashes = _gram_hashes(data)
    # 40 bits of hash over the place, so that the least is the leftmost of equal ones
    key = (hashes >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64)
    grams = LENGTH - GRAM + 1
    least, width = key, 1
    while 2 * width <= grams:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(key) - grams + 1], least[grams - width : grams - width + len(key) - grams + 1])
    size = end - begin
    stops = np.cumsum(size)
    window = np.repeat(begin - (stops - size), size) + np.arange(stops[-1])
    anchor = (least[window] & np.uint64((1 << 24) - 1)).astype(np.int64)
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)))
    first = np.flatnonzero(new)
    # anchors have small hashes: spread them over all buckets
    return mix(hashes[anchor[first]]), window[first], np.diff(np.append(first, len(window)))


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for any amount of text, a segment at a time."""
    found, a = [], 0
    n = len(off) - 1
    while a < n:
        if off[a + 1] - off[a] > SEGMENT:  # a long text in overlapping segments
            for low in range(off[a], off[a + 1], SEGMENT):
                high = min(low + SEGMENT + LENGTH - 1, off[a + 1])
                h, w, c = _anchors_of(data[low:high], np.array([0, high - low]))
                found.append((h, w + low, c))
            a += 1
            continue
        b = max(a + 1, int(np.searchsorted(off, off[a] + SEGMENT, "right")) - 1)
        h, w, c = _anchors_of(data[off[a] : off[b]], off[a : b + 1] - off[a])
        found.append((h, w + off[a], c))
        a = b
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _short(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket, and the 40 bits of the hash after it."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), (hashes >> np.uint64(24 - bits)) & np.uint64((1 << 40) - 1)


def _pack40(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack40(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _sent_anchors(bits: int):
    def run(batches):
        for row in _each(batches):
            hashes, _, _ = anchors(*_unpacked(row))
            distinct, count = np.unique(hashes, return_counts=True)
            bucket, short = _short(distinct, bits)
            cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
            count = np.minimum(count, 255).astype(np.uint8)
            which = np.flatnonzero(np.diff(cuts))
            grams = [_pack40(short[cuts[b] : cuts[b + 1]]) for b in which]
            counts = [count[cuts[b] : cuts[b + 1]].tobytes() for b in which]
            columns = [pa.array(which, pa.int32()), pa.array([row["chunk"]] * len(which), pa.int64()), pa.array(grams, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "grams", "counts"])

    return run


def _shared_anchors(hot: int):
    """One bucket: for every chunk, its anchors that occur twice or more anywhere, and which of them very often."""

    def run(rows: pa.Table) -> pa.Table:
        parts = [_unpack40(g) for g in rows.column("grams").to_pylist()]
        count = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.uint8)
        distinct, back = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(back, weights=count)[back]
        stops = np.cumsum([0, *map(len, parts)])
        shared, often = [], []
        for a, b, part in zip(stops[:-1], stops[1:], parts, strict=True):
            mine = total[a:b]
            shared.append(_pack40(part[mine > 1]))
            often.append(_pack40(part[mine >= hot]))
        columns = [*(rows.column(c).combine_chunks() for c in ("bucket", "chunk")), *(pa.array(x, pa.binary()) for x in (shared, often))]
        out = pa.table(columns, names=["bucket", "chunk", "shared", "often"])
        return out.filter(pa.array([bool(s) for s in shared]))

    return run


def _member(bucket: np.ndarray, short: np.ndarray, replies: list[dict], what: str) -> np.ndarray:
    """Whether each anchor is in its bucket's reply."""
    sent = np.sort(np.concatenate([np.zeros(0, np.uint64), *((np.uint64(r["bucket"]) << np.uint64(40)) | _unpack40(r[what]) for r in replies)]))
    if not len(sent):
        return np.zeros(len(short), bool)
    own = (bucket.astype(np.uint64) << np.uint64(40)) | short
    return sent[np.minimum(np.searchsorted(sent, own), len(sent) - 1)] == own


def _stretches(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    stops = np.cumsum(size)
    return data[np.repeat(start - (stops - size), size) + np.arange(stops[-1] if len(stops) else 0)]


def _sent_windows(bits: int):
    """For each chunk: stretches of shared windows by bucket, and what its own copies already settle."""

    def run(batches):
        for row in _each(batches):
            data, off = _unpacked(row)
            hashes, window, n = anchors(data, off)
            bucket, short = _short(hashes, bits)
            idx = np.searchsorted(off, window, "right") - 1
            doc = np.array([-1 if d is None else d for d in row["docs"]], np.int64)
            skip = np.array([d is None for d in row["docs"]], bool)
            skip[np.array(row["copies"] or [], np.int64)] = True
            use = ~skip[idx] & _member(bucket, short, row["replies"] or [], "shared")
            often = _member(bucket[use], short[use], row["replies"] or [], "often")
            window, n, idx, bucket = window[use], n[use], idx[use], bucket[use]
            if often.any():  # one stretch for each window of a frequent anchor, by its own hash
                each = n[often]
                stops = np.cumsum(each)
                w = np.repeat(window[often] - (stops - each), each) + np.arange(stops[-1])
                i = np.repeat(idx[often], each)
                h = Hasher(data).spans(w, w + LENGTH)
                window, n, idx = np.concatenate((window[~often], w)), np.concatenate((n[~often], np.ones(len(w), np.int64))), np.concatenate((idx[~often], i))
                bucket = np.concatenate((bucket[~often], _short(h, bits)[0]))
            size = n + LENGTH - 1
            same = Hasher(data).spans(window, window + size) if len(window) else np.zeros(0, np.uint64)
            order = np.lexsort((doc[idx], same, bucket))
            window, n, idx, bucket, size, same = (x[order] for x in (window, n, idx, bucket, size, same))
            first = np.ones(len(window), bool)
            first[1:] = (same[1:] != same[:-1]) | (bucket[1:] != bucket[:-1])
            least = doc[idx][first][np.cumsum(first) - 1]
            lost = doc[idx] > least
            spans = np.zeros(lost.sum(), SPAN)
            spans["idx"], spans["start"] = idx[lost], (window - off[idx])[lost]
            spans["end"] = spans["start"] + size[lost]
            sent = ~lost  # with its repeats inside the smallest document
            meta = np.zeros(sent.sum(), META)
            meta["doc"], meta["idx"], meta["start"], meta["n"] = doc[idx][sent], idx[sent], (window - off[idx])[sent], n[sent]
            window, size, bucket = window[sent], size[sent], bucket[sent]
            which, cut = np.unique(bucket, return_index=True)
            cut = np.append(cut, len(bucket))
            pack = zstandard.ZstdCompressor(level=3)
            texts = [pack.compress(_stretches(data, window[a:b], size[a:b]).tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            metas = [pack.compress(meta[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            m = len(which)
            columns = [
                pa.array([*which.tolist(), -1 - row["chunk"]], pa.int64()),
                pa.array([row["chunk"]] * (m + 1), pa.int64()),
                pa.array([*metas, None], pa.binary()),
                pa.array([*texts, spans.tobytes()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "meta", "data"])

    return run


def _repeated(rows: pa.Table) -> pa.Table:
    """One bucket: which windows start in a smaller document as well, as spans of each chunk.

    A bucket below zero is what a chunk has settled on its own.
    """
    if rows.column("bucket")[0].as_py() < 0:
        return rows.select(["chunk", "data"]).rename_columns(["chunk", "spans"])
    unpack = zstandard.ZstdDecompressor()
    metas = [np.frombuffer(unpack.decompress(m), META) for m in rows.column("meta").to_pylist()]
    data = np.frombuffer(b"".join(unpack.decompress(d) for d in rows.column("data").to_pylist()), np.uint8)
    meta = np.concatenate(metas)
    n = meta["n"].astype(np.int64)
    size = n + LENGTH - 1
    begin = np.cumsum(size) - size
    total = int(n.sum())
    item = np.repeat(np.arange(len(n), dtype=np.int32), n)
    nth = np.arange(total, dtype=np.int32) - np.repeat((np.cumsum(n) - n).astype(np.int32), n)
    order, equal = deep_shallow(data, begin.astype(np.int32)[item] + nth, LENGTH)
    run_of = np.cumsum(~equal, dtype=np.int32) - 1
    doc = meta["doc"][item[order]]
    least = np.minimum.reduceat(doc, np.flatnonzero(~equal)) if total else doc
    lost = np.zeros(total, bool)
    lost[order] = doc > least[run_of]
    at = np.flatnonzero(lost)
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1] + 1) | (item[at][1:] != item[at][:-1])
    opens = at[first]
    closes = at[np.append(first[1:], True)] if len(at) else at
    spans = np.zeros(len(opens), SPAN)
    spans["idx"] = meta["idx"][item[opens]]
    spans["start"] = meta["start"][item[opens]] + nth[opens]
    spans["end"] = meta["start"][item[opens]] + nth[closes] + LENGTH
    owner = np.repeat(np.arange(len(metas)), [len(m) for m in metas])[item[opens]]
    cuts = np.searchsorted(owner, np.arange(len(metas) + 1))
    out = [spans[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    found = pa.table([rows.column("chunk").combine_chunks(), pa.array(out, pa.binary())], names=["chunk", "spans"])
    return found.filter(pa.array([bool(x) for x in out]))


def _kept(batches):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for row in _each(batches):
        data, off = _unpacked(row)
        edge = np.zeros(len(data) + 1, np.int32)
        for raw in row["spans"] or []:
            spans = np.frombuffer(raw, SPAN)
            base = off[spans["idx"]]
            np.add.at(edge, base + spans["start"], 1)
            np.add.at(edge, base + spans["end"], -1)
        gone = np.cumsum(edge[:-1]) > 0
        for i in row["copies"] or []:
            if off[i + 1] - off[i] >= LENGTH:
                gone[off[i] : off[i + 1]] = True
        starts = gone.copy()
        starts[1:] &= ~gone[:-1]
        inner = off[1:-1][off[1:-1] < len(gone)]
        starts[inner] = gone[inner]
        count = np.concatenate(([0], np.cumsum(gone)))
        runs = np.concatenate(([0], np.cumsum(starts)))
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]
        columns = [pa.array(row["docs"], pa.int64()), pa.array(np.diff(off)), pa.array(np.diff(count[off])), pa.array(np.diff(runs[off])), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept binary``: whole texts as UTF-8 without repeated 50-byte strings.

    A byte goes if any 50 bytes that cover it also start in a document with a
    smaller key, as the texts were given. Null and empty texts have no bytes.
    Rows with one key do not remove each other's bytes; rows with a null key
    stay whole and remove nothing. What is kept may cut characters, so it is
    binary. Other columns are not read.
    """
    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chunks = materialize(chosen.mapInArrow(_chunks, CHUNKS), "chunks")
    each = chunks.select("chunk", F.posexplode(F.arrays_zip("docs", "digests", "sizes")))
    each = each.select("chunk", F.col("pos").alias("idx"), "col.docs", "col.digests", "col.sizes")
    classes = each.where("docs IS NOT NULL").groupBy("digests").agg(F.min("docs").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = each.join(classes.select("digests", "least"), "digests").where("docs > least").groupBy("chunk").agg(F.collect_list("idx").alias("copies"))
    copies = materialize(copies, "copies")
    total = chunks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n")).first()["n"] or 0
    bits = min(16, max(4, math.ceil(math.log2(max(1, total / BUCKET_BYTES)))))
    sent = chunks.select("chunk", "sizes", "packed").mapInArrow(_sent_anchors(bits), "bucket int, chunk long, grams binary, counts binary")
    replies = sent.groupBy("bucket").applyInArrow(_shared_anchors(hot), "bucket int, chunk long, shared binary, often binary")
    replies = materialize(replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "shared", "often")).alias("replies")), "shared-anchors")
    asked = chunks.select("chunk", "docs", "sizes", "packed").join(replies, "chunk").join(copies, "chunk", "left")
    windows = asked.mapInArrow(_sent_windows(bits), "bucket long, chunk long, meta binary, data binary")
    lost = windows.groupBy("bucket").applyInArrow(_repeated, "chunk long, spans binary")
    lost = materialize(lost.groupBy("chunk").agg(F.collect_list("spans").alias("spans")), "lost-spans")
    final = chunks.select("chunk", "docs", "sizes", "packed").join(lost, "chunk", "left").join(copies, "chunk", "left")
    return final.mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


@query("op10_suffix_dedup")
def op10(spark, folder):
    out = remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
