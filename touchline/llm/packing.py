"""Vector bin packing of documents into training sequences.

Every sequence holds at most ``tokens`` ids, ``segments`` pieces and ``loss``
loss-bearing ids. The sequence being filled takes the piece whose demand
vector has the largest dot product with the room that is left in each
dimension; if none fits whole, the best one is cut. A sequence that reaches
its segment or loss limit early is trimmed to a power of two, as are the last
ones of a partition, so nothing is padded. Each partition packs its own rows,
in windows of bounded size that hand what is left to the next.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.tables import query, table
from touchline.llm.text import slices
from touchline.llm.word_bpe import shared

#: id after each document
END_ID = 2
WINDOW_IDS = 1 << 21
WINDOW_ITEMS = 2048

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, n_loss long, ids array<int>"
)


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 64
    loss: int = 4096


@dataclass
class Item:
    """What is left of a document: its ids, and the loss-bearing ids before each (and in all)."""

    doc: int | None
    ids: np.ndarray
    loss_before: np.ndarray
    at: int = 0


def fit(item: Item, room: int, room_loss: int) -> int:
    """Most ids that can be taken from the front of what is left."""
    n = min(room, len(item.ids) - item.at)
    if item.loss_before[item.at + n] - item.loss_before[item.at] > room_loss:
        n = int(np.searchsorted(item.loss_before, item.loss_before[item.at] + room_loss, "right")) - 1 - item.at
    return n


class Packer:
    """Fills sequences from a pool; ``emit(item, start, length, sequence, offset)`` gets each piece."""

    def __init__(self, limits: Limits, emit, first_id: int):
        self.limits, self.emit, self.next_id = limits, emit, first_id
        self.pool: list[Item] = []

    def _write(self, pieces: list[tuple[Item, int, int, int]]) -> None:
        offset = 0
        for item, start, n, _ in pieces:
            self.emit(item, start, n, self.next_id, offset)
            offset += n
        self.next_id += 1

    def _fill(self, items: list[Item], left: np.ndarray, loss: np.ndarray) -> list[tuple[Item, int, int, int]]:
        """Item, start, length and place in the pool of each piece of one sequence.

        ``left``, ``loss``: ids and loss-bearing ids left of each item.
        """
        cap = self.limits
        room, room_loss, pieces = cap.tokens, cap.loss, []
        while room and len(pieces) < cap.segments:
            weight = left * (room / cap.tokens**2) + loss * (room_loss / cap.loss**2) + (cap.segments - len(pieces)) / cap.segments**2
            whole = (left > 0) & (left <= room) & (loss <= room_loss)
            weight[~(whole if whole.any() else left > 0)] = -1
            best = int(np.argmax(weight))
            n = fit(items[best], room, room_loss) if weight[best] >= 0 else 0
            if not n:
                break
            item = items[best]
            pieces.append((item, item.at, n, best))
            item.at += n
            used = int(item.loss_before[item.at] - item.loss_before[item.at - n])
            left[best] -= n
            loss[best] -= used
            room, room_loss = room - n, room_loss - used
        return pieces

    def run(self, last: bool) -> None:
        """Packs the pool; unless this is the last time, what would not fill a sequence stays."""
        cap = self.limits.tokens
        items = self.pool
        left = np.array([len(i.ids) - i.at for i in items], np.int64)
        loss = np.array([i.loss_before[-1] - i.loss_before[i.at] for i in items], np.int64)
        while len(items) and left.sum() >= (1 if last else cap):
            pieces = self._fill(items, left, loss)
            total = sum(n for _, _, n, _ in pieces)
            keep = total if total == cap else 1 << (total.bit_length() - 1)
            while total > keep:  # back to the pool, from the end of the last piece
                item, start, n, k = pieces.pop()
                back = min(n, total - keep)
                item.at -= back
                left[k] += back
                loss[k] += item.loss_before[item.at + back] - item.loss_before[item.at]
                total -= back
                if n > back:
                    pieces.append((item, start, n - back, k))
            self._write(pieces)
            if not (left > 0).all() and (left > 0).sum() < len(left) // 2:
                alive = np.flatnonzero(left > 0)
                items, left, loss = [items[k] for k in alive], left[alive], loss[alive]
        self.pool = [i for i in items if i.at < len(i.ids)]

    def add(self, item: Item) -> None:
        """A piece that fills a sequence alone is written at once."""
        cap = self.limits.tokens
        while len(item.ids) - item.at >= cap and fit(item, cap, self.limits.loss) == cap:
            self._write([(item, item.at, cap, 0)])
            item.at += cap
        if item.at < len(item.ids):
            self.pool.append(item)


def _pack(batches, limits: Limits, items_of, with_ids: bool):
    out: list[tuple] = []

    def emit(item: Item, start: int, n: int, sequence: int, offset: int) -> None:
        ids = item.ids[start : start + n]
        loss = int(item.loss_before[start + n] - item.loss_before[start])
        crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
        out.append((item.doc, start, n, crc, len(item.ids), sequence, offset, loss, ids if with_ids else None))

    packer = Packer(limits, emit, TaskContext.get().partitionId() << 40)

    def flush():
        if out:
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 8
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            arrays.append(pa.array([None if i is None else i.astype(np.int32) for i in columns[8]], pa.list_(pa.int32())))
            out.clear()
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_loss", "ids"])

    held = 0
    for item in items_of(batches):
        packer.add(item)
        held += len(item.ids)
        if held >= WINDOW_IDS or len(packer.pool) >= WINDOW_ITEMS:
            packer.run(last=False)
            for rest in packer.pool:  # let go of the arrays of the whole slice
                rest.ids, rest.loss_before = rest.ids.copy(), rest.loss_before.copy()
            held = 0
            yield from flush()
    packer.run(last=True)
    yield from flush()


def pack_texts(
    docs: DataFrame,
    path: str,
    limits: Limits = Limits(),
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every whole text in sequences; the first id of a document bears no loss.

    Null and empty texts have one id, the end id. Repeated rows and null keys
    are packed like any other row. Other columns are not read. One scan without
    a shuffle; sequence ids are distinct over partitions. An empty table gives
    no rows.
    """

    def items_of(batches):
        words = shared(path)
        for rows, texts in slices(batches, "text"):
            ids, first = words.encode(texts)
            for k, doc in enumerate(rows.column("doc_id").to_pylist()):
                own = np.append(ids[first[k] : first[k + 1]], np.uint32(end_id))
                yield Item(doc, own, np.maximum(np.arange(len(own) + 1) - 1, 0))

    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(lambda batches: _pack(batches, limits, items_of, with_ids), SCHEMA)


def pack_examples(examples: DataFrame, limits: Limits, key: str = "doc_id", ids: str = "ids", loss: str = "loss", with_ids: bool = True) -> DataFrame:
    """The same for tokenized instruction data: ``ids`` and, for each id, whether it bears loss.

    A null or empty list of ids gives no piece; a null loss list or flag bears none.
    """

    def items_of(batches):
        for rows in batches:
            for doc, own, bears in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "ids", "loss")), strict=True):
                if own:
                    flags = [bool(x) for x in (bears or [])][: len(own)]
                    flags += [False] * (len(own) - len(flags))
                    yield Item(doc, np.array(own, np.uint32), np.concatenate(([0], np.cumsum(flags))))

    chosen = examples.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).alias("ids"), F.col(loss).cast("array<boolean>").alias("loss"))
    return chosen.mapInArrow(lambda batches: _pack(batches, limits, items_of, with_ids), SCHEMA)


@query("op5_vector_packing")
def op5(spark, folder):
    import public_tokenizers

    return pack_texts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")
