"""Document quality from a linear-chain conditional random field over lines.

Every line gets numbers for its make-up, and those of the lines before and
after it. The field labels lines good or bad; a labelled document teaches its
label for each of its lines. A document's score is the mean of its lines'
probabilities of being good, from forward and backward sums, weighted by length.
The field is fitted on a bounded sample of labelled rows; all rows are scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.tables import query, table
from touchline.llm.text import Hasher, Texts, slices, within

#: bound of the sample the field is fitted on: so many documents, none longer than so many characters
TRAIN_DOCS = 3000
TRAIN_CHARS = 100_000
STEPS = 150
RATE = 0.1
PENALTY = 1e-3


def _set(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_CLASSES = (
    _set(range(65, 91)),
    _set(range(97, 123)),
    _set(range(48, 58)),
    _set(range(128, 256)),
    _set(b"!?"),
    _set(b".,;:'\"()-"),
    _set(b"#*$%&|<>=_~^{}[]@\\+/"),
    _set(b"|"),
)
_END = _set(b".!?:\"'")
N_OWN = len(_CLASSES) + 9


def line_features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with those of its neighbours, its weight, and each text's first line."""
    data = texts.data
    start, end, first = texts.lines()
    owner = within(first)
    hashes = Hasher(data)
    ws, we, _ = texts.words()
    w0, w1 = np.searchsorted(ws, start), np.searchsorted(ws, end)
    words = w1 - w0
    points = texts.code_points()
    solid = np.concatenate(([0], np.cumsum(points[we] - points[ws])))
    chars = solid[w1] - solid[w0]
    safe = np.maximum(chars, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask[data], dtype=np.int32)))
        return (sums[end] - sums[start]) / safe

    own = np.zeros((len(start), N_OWN))
    for k, mask in enumerate(_CLASSES):
        own[:, k] = np.minimum(share(mask), 2)
    k = len(_CLASSES)
    word = hashes.spans(ws, we)
    again = np.concatenate(([0], np.cumsum(np.concatenate(([False], word[1:] == word[:-1])))))
    line_of = np.repeat(np.arange(len(start)), words)
    order = np.lexsort((word, line_of))
    fresh = np.ones(len(word), bool)
    fresh[1:] = (word[order][1:] != word[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][fresh], minlength=len(start))
    key = hashes.spans(start, end)
    order = np.lexsort((np.arange(len(key)), key, owner))
    dup = np.zeros(len(key), bool)
    dup[order[1:][(key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])]] = True
    own[:, k] = np.log1p(chars) / 5
    own[:, k + 1] = np.log1p(words) / 3
    own[:, k + 2] = np.minimum(chars / np.maximum(words, 1), 30) / 10
    own[:, k + 3] = np.where(words > 1, (again[w1] - again[np.minimum(w0 + 1, w1)]) / np.maximum(words - 1, 1), 0)
    own[:, k + 4] = distinct / np.maximum(words, 1)
    own[:, k + 5] = dup
    if len(we):
        last, head = we[np.maximum(w1 - 1, 0)] - 1, ws[np.minimum(w0, len(ws) - 1)]
        own[:, k + 6] = np.where(words > 0, _END[data[last]], False)
        own[:, k + 7] = np.where(words > 0, _CLASSES[0][data[head]], False)
    own[:, k + 8] = words == 0
    before, after = np.zeros_like(own), np.zeros_like(own)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    before[inner + 1], after[inner] = own[inner], own[inner + 1]
    lone = np.zeros((len(own), 2))
    lone[first[:-1], 0] = 1
    lone[first[1:] - 1, 1] = 1
    return np.hstack((own, before, after, lone)), chars, first


@dataclass
class Field:
    """Weights of the features for a good line, and of neighbours' labels (bad, good) x (bad, good)."""

    weights: np.ndarray
    bias: float
    steps: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return (features - self.mean) / self.scale @ self.weights + self.bias


def marginals(emission: np.ndarray, first: np.ndarray, steps: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Probability that each line is good; with ``pairs``, the expected number of each pair of neighbouring labels.

    All texts move on together, a line at a time, the longest first.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, length = first[:-1][order], size[order]
    longest = int(length[0]) if len(length) else 0
    live = np.searchsorted(-length, -np.arange(longest), "left")  # texts with more than t lines
    forward = np.zeros((len(emission), 2))
    backward = np.zeros((len(emission), 2))
    score = np.column_stack((np.zeros(len(emission)), emission))
    for t in range(longest):
        at = begin[: live[t]] + t
        forward[at] = score[at]
        if t:
            past = forward[at - 1][:, :, None] + steps
            forward[at] += np.logaddexp(past[:, 0], past[:, 1])
    for t in range(longest - 2, -1, -1):
        at = begin[: live[t + 1]] + t
        ahead = steps + (score[at + 1] + backward[at + 1])[:, None, :]
        backward[at] = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
    both = forward + backward
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    if not pairs:
        return good, None
    owner = within(first)
    at = np.flatnonzero(owner[1:] == owner[:-1])
    joint = forward[at][:, :, None] + steps + (score[at + 1] + backward[at + 1])[:, None, :]
    joint = np.exp(joint - np.logaddexp(both[at, 0], both[at, 1])[:, None, None])
    return good, joint.sum(0)


def fit(features: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Field:
    """Maximum likelihood of the labels, each text given the same weight, with a small penalty; Adam on all lines."""
    mean, scale = features.mean(0), features.std(0) + 1e-3
    x = (features - mean) / scale
    size = np.diff(first)
    owner = within(first)
    y = label[owner].astype(float)
    share = (1 / size)[owner]
    total = len(label)
    theta = np.zeros(x.shape[1] + 1)
    trans = np.zeros((2, 2))
    same = np.zeros((2, 2))
    for v in (0, 1):
        same[v, v] = (size[label == v] - 1).sum()
    moments = [np.zeros_like(theta), np.zeros_like(theta), np.zeros_like(trans), np.zeros_like(trans)]
    links = max(1.0, same.sum())
    for step in range(1, steps + 1):
        good, pairs = marginals(x @ theta[:-1] + theta[-1], first, trans, pairs=True)
        gap = (y - good) * share
        grads = (np.append(x.T @ gap, gap.sum()) / total - PENALTY * theta, (same - pairs) / links - PENALTY * trans)
        for k, (value, grad) in enumerate(zip((theta, trans), grads, strict=True)):
            moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * grad
            moments[2 * k + 1] = 0.99 * moments[2 * k + 1] + 0.01 * grad * grad
            value += RATE * (moments[2 * k] / (1 - 0.9**step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.99**step)) + 1e-8)
    return Field(theta[:-1], float(theta[-1]), trans, mean, scale)


def scores(texts: Texts, field: Field) -> np.ndarray:
    features, weight, first = line_features(texts)
    good, _ = marginals(field.emissions(features), first, field.steps)
    weight = weight.astype(float)
    owner = within(first)
    blank = np.bincount(owner, weight, minlength=len(texts)) == 0
    weight[blank[owner]] = 1
    return np.clip(np.bincount(owner, weight * good) / np.bincount(owner, weight), 0, 1)


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_docs: int = TRAIN_DOCS,
    max_chars: int = TRAIN_CHARS,
) -> Field:
    """Fits the field on at most ``max_docs`` labelled documents that are not held out, the first by a hash of the key.

    Labels that are null or of a null key are not used. Without both labels the
    field knows nothing and scores every text one half.
    """
    usable = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sample = usable.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    found = chosen.where(F.coalesce(F.length("text"), F.lit(0)) <= max_chars).join(F.broadcast(sample), "doc_id")
    rows = found.select("text", "label").toArrow()
    n_features = 3 * N_OWN + 2
    if len(rows) == 0 or len(set(known := rows.column("label").to_numpy())) < 2:
        return Field(np.zeros(n_features), 0.0, np.zeros((2, 2)), np.zeros(n_features), np.ones(n_features))
    parts, firsts, lines = [], [np.zeros(1, np.int64)], 0
    for batch in rows.combine_chunks().to_batches():
        for _, texts in slices([batch], "text"):
            features, _, first = line_features(texts)
            parts.append(features)
            firsts.append(first[1:] + lines)
            lines += len(features)
    return fit(np.concatenate(parts), np.concatenate(firsts), known)


def score_documents(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text: the length-weighted probability that its lines are good.

    Null and empty texts are one empty line. Equal texts get equal scores; a
    null key stays null. Other columns are not read. One scan without a shuffle.
    """

    def run(batches):
        for rows, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(scores(texts, field))], ["doc_id", "score"])

    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, score double")


@query("op8_line_crf")
def op8(spark, folder):
    docs = table(spark, folder, "documents")
    out = score_documents(docs, train(docs, table(spark, folder, "labels")))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
