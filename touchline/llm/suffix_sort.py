"""Deep-shallow order of suffixes, all compared to a fixed depth.

Shallow: multikey quicksort on words of eight bytes, each word only within
groups that the words before left equal. Deep: what is still equal after
``shallow`` bytes mostly shares a long prefix, so groups become blind tries:
a node only stores how many bytes its members share and the byte on which they
part. All tries grow a level at a time, in whole-array operations.
"""

from __future__ import annotations

import numpy as np

PART = 1 << 22


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | data[at + k]
    return out


def _groups(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(new)
    return begin, np.diff(np.append(begin, len(new)))


def _shared(data: np.ndarray, at: np.ndarray, lead: np.ndarray, depth: int, low: int) -> np.ndarray:
    """Bytes that each suffix has in common with its group's first, ``low`` of them known."""
    out = np.empty(len(at), np.int64)
    columns = np.arange(low, depth)
    for i in range(0, len(at), PART // max(1, depth - low)):
        part = slice(i, i + PART // max(1, depth - low))
        differ = data[at[part, None] + columns] != data[lead[part, None] + columns]
        out[part] = np.where(differ.any(1), low + differ.argmax(1), depth)
    return out


def deep_shallow(data: np.ndarray, starts: np.ndarray, depth: int, shallow: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``depth`` bytes, and whether each (in that order) equals the one before.

    ``data`` holds at least ``depth`` bytes from every start.
    """
    shallow = min(shallow, depth - depth % 8)
    order = np.arange(len(starts), dtype=np.int32)
    new = np.zeros(len(starts), bool)
    new[:1] = True
    for low in range(0, shallow, 8):
        begin, size = _groups(new)
        open_ = np.flatnonzero(np.repeat(size > 1, size))
        if not len(open_):
            break
        own = np.cumsum(new, dtype=np.int32)[open_]
        word = _words(data, starts[order[open_]] + low)
        by = np.lexsort((word, own)) if low else np.argsort(word)
        order[open_] = order[open_][by]
        new[open_[1:]] |= word[by][1:] != word[by][:-1]
    active = np.flatnonzero(np.repeat((s := _groups(new)[1]) > 1, s)) if len(starts) else np.zeros(0, np.int64)
    known = shallow
    while len(active):
        begin, size = _groups(new[active])
        at = starts[order[active]]
        lead = np.repeat(at[begin], size)
        branch = np.repeat(np.minimum.reduceat(_shared(data, at, lead, depth, known), begin), size)
        parted = branch < depth
        active, at, branch = active[parted], at[parted], branch[parted]
        if not len(active):
            break
        own = np.cumsum(new[active], dtype=np.int32)
        byte = data[at + branch]
        by = np.lexsort((byte, own))
        order[active] = order[active][by]
        new[active[1:]] |= byte[by][1:] != byte[by][:-1]
        size = _groups(new[active])[1]
        active = active[np.repeat(size > 1, size)]
    return order, ~new
