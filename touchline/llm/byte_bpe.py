"""Byte-level BPE with tiktoken and a local rank file.

A text is cut where a character that is no white space meets a blank or a line
break: no match of the pattern spans that place, and the look-ahead of the
white-space rule sees the same characters on its right, so pieces encoded one
by one give the ids of the whole text. A very long run of white space would
overflow the stack of the library's pattern matcher; all of it but a last
character before other text is one match, and is encoded as such without the
pattern. Ids are hashed and decoded piece by
piece; memory follows the piece, not the text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.tables import query, table

PIECE = 1 << 16
_CUT = re.compile(r"(?<=\S)[ \n]")
#: what Python calls white space and Unicode does not; never cut after these
_DOUBT = "\x1c\x1d\x1e\x1f"
#: runs of Unicode white space too long for the pattern matcher
LONG_RUN = 4096
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _decimal(size: int) -> list[str]:
    return [str(i) for i in range(size)]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in parts of about ``size`` characters that can be encoded one by one."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        while cut and text[cut.start() - 1] in _DOUBT:
            cut = _CUT.search(text, cut.start() + 1)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encoded(text: str, enc: tiktoken.Encoding, size: int = PIECE) -> Iterator[list[int]]:
    """Ids of the text, part by part."""
    at = 0
    for run in _SPACES.finditer(text):
        for part in pieces(text[at : run.start()], size):
            yield enc.encode_ordinary(part)
        at = run.end() - (run.end() < len(text))
        yield enc._encode_single_piece(text[run.start() : at])
    for part in pieces(text[at:], size):
        yield enc.encode_ordinary(part)


def encode(text: str, enc: tiktoken.Encoding, size: int = PIECE) -> list[int]:
    return [i for ids in encoded(text, enc, size) for i in ids]


def digest(text: str, enc: tiktoken.Encoding, size: int = PIECE) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids as decimal text, and of the bytes they decode to."""
    decimal = _decimal(enc.n_vocab)
    ids_hash, bytes_hash, n = hashlib.sha256(), hashlib.sha256(), 0
    for ids in encoded(text, enc, size):
        if ids:
            ids_hash.update(("," * (n > 0) + ",".join([decimal[i] for i in ids])).encode())
            bytes_hash.update(enc.decode_bytes(ids))
            n += len(ids)
    return n, ids_hash.hexdigest(), bytes_hash.hexdigest()


def encode_texts(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids array<int>``: the ids of every whole text. Null and empty texts have none; other columns are not read."""

    def run(batches):
        enc = encoding(path, pattern)
        for rows in batches:
            ids = [encode(t or "", enc) for t in rows.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    chosen = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return chosen.mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(ids: DataFrame, path: str, pattern: str, key: str = "doc_id", column: str = "ids") -> DataFrame:
    """``doc_id, bytes binary``: raw bytes, which need not be whole characters. A null list gives null."""

    def run(batches):
        enc = encoding(path, pattern)
        for rows in batches:
            out = [None if i is None else enc.decode_bytes(i) for i in rows.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    chosen = ids.select(ids[key].cast("long").alias("doc_id"), ids[column].alias("ids"))
    return chosen.mapInArrow(run, "doc_id long, bytes binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of the ids and of the bytes they decode to, for every whole text.

    Null and empty texts have no ids and the digests of nothing. Equal rows give
    equal rows; a null key stays null. One scan without a shuffle.
    """

    def run(batches):
        enc = encoding(path, pattern)
        for rows in batches:
            found = [digest(t or "", enc) for t in rows.column("text").to_pylist()]
            n, ids, raw = zip(*found, strict=True) if found else ((), (), ())
            columns = [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op4_byte_bpe")
def op4(spark, folder):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip_digests(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
