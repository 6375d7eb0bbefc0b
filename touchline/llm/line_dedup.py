"""Line dedup: documents probe sharded minimal perfect hashes instead of joining lines.

1. Every document gives its distinct line keys as 64-bit hashes. They are
   counted by document, and the largest document that holds each is kept.
2. Keys in enough documents are dealt into shards of bounded size. A shard
   becomes one minimal perfect hash (levels of bit arrays, index by rank) over
   arrays of fingerprints, counts and last holders.
3. Line hashes travel to their shard, and look themselves up in its arrays as
   they stream by. Shards with many probes are copied, and their probes dealt
   out by document, so a line that half of all documents share is no hot task.
4. Documents get the hashes that they lose and drop those lines.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.tables import keyed_texts, query, rest_of, table, with_rest
from touchline.llm.text import Hasher, Texts, mix, slices
from touchline.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 1 << 16
PROBES = 1 << 18
ROOMY = 2
_MAX_LEVELS = 64
#: the arrays that a probe reads, and what they hold
ARRAYS = {"words": "u8", "levels": "i8", "prints": "u8", "holders": "i8"}


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys.

    On each level keys claim bits of an array twice their number; a key alone
    on its bit stays, the others go on to the next level. A key's index is the
    number of set bits before its own.
    """

    def __init__(self, words: np.ndarray, levels: np.ndarray):
        self.words, self.levels = words, levels
        ones = np.bitwise_count(words).astype(np.int64)
        self.rank = np.concatenate(([0], np.cumsum(ones)))

    @staticmethod
    def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0xC2B2AE3D27D4EB4F % (1 << 64))
        return (mix(keys + seed) % np.uint64(bits)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        parts, sizes = [], []
        for level in range(_MAX_LEVELS):
            if not len(keys):
                break
            bits = -(-ROOMY * len(keys) // 64) * 64
            at = cls._place(keys, level, bits)
            alone = np.bincount(at, minlength=bits) == 1
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(bits)
            keys = keys[~alone[at]]
        if len(keys):
            raise ValueError("keys are not distinct")
        return cls(np.concatenate([np.zeros(0, np.uint64), *parts]), np.array(sizes, np.int64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; any index, or -1, for keys that are not held."""
        out = np.full(len(keys), -1, np.int64)
        open_, base = np.arange(len(keys)), 0
        for level, bits in enumerate(self.levels):
            at = base + self._place(keys[open_], level, int(bits))
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.rank[word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
            base += int(bits)
        return out


def line_keys(texts: Texts, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, key hash and whether it counts, of each line; first line of each text."""
    start, end, first = texts.lines()
    a, b = texts.stripped(start, end)
    points = texts.code_points()
    return start, end, Hasher(texts.lowered().data).spans(a, b), points[b] - points[a] >= min_chars, first


def _keys_of(docs: DataFrame, min_chars: int) -> DataFrame:
    def run(batches):
        for rows, texts in slices(batches, "text"):
            _, _, key, counts, first = line_keys(texts, min_chars)
            owner = np.repeat(np.arange(len(texts)), np.diff(first))[counts]
            key = key[counts].view(np.int64)
            order = np.lexsort((key, owner))
            key, owner = key[order], owner[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(key[new]), rows.column("doc_id").take(pa.array(owner[new]))], ["key", "doc_id"])

    return docs.mapInArrow(run, "key long, doc_id long")


def _shards(frequent: DataFrame, n_shards: int, usual: int) -> DataFrame:
    """One row per shard: its hash function and arrays, and over how many copies its probes are dealt.

    ``usual``: probes of a shard without any hot line.
    """
    kind = "shard int, copies int, words binary, levels binary, prints binary, counts binary, holders binary"

    def build(rows: pa.Table) -> pa.Table:
        key = rows.column("key").to_numpy().view(np.uint64)
        count = rows.column("n").to_numpy()
        hashed = PerfectHash.build(key)
        at = hashed.find(key)
        prints, counts, holders = np.empty_like(key), np.empty(len(key), np.uint32), np.empty(len(key), np.int64)
        prints[at] = mix(key)
        counts[at] = np.minimum(count, 2**32 - 1)
        holders[at] = rows.column("holder").to_numpy()
        arrays = [hashed.words, hashed.levels, prints, counts, holders]
        copies = 1 + (usual + int(count.sum())) // PROBES
        return pa.table([[rows.column("shard")[0].as_py()], [copies], *([x.tobytes()] for x in arrays)], schema=shard_schema)

    shard_schema = pa.schema([("shard", pa.int32()), ("copies", pa.int32()), *((x, pa.binary()) for x in ("words", "levels", "prints", "counts", "holders"))])
    return frequent.withColumn("shard", F.pmod("key", F.lit(n_shards)).cast("int")).groupBy("shard").applyInArrow(build, kind)


def _probe(batches):
    """Rows sorted by shard and copy, the arrays first: passes on the probes that lose their line."""
    hashed = prints = holders = None
    at = (None, None)
    for rows in batches:
        shard, copy = (rows.column(c).to_numpy() for c in ("shard", "copy"))
        cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(copy) != 0) | rows.column("words").is_valid().to_numpy(zero_copy_only=False)[:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, rows.num_rows], strict=True):
            part = rows.slice(a, b - a)
            if part.column("words").is_valid()[0].as_py():
                words, levels, prints, holders = (np.frombuffer(part.column(c)[0].as_py(), t) for c, t in ARRAYS.items())
                hashed, at = PerfectHash(words, levels), (shard[a], copy[a])
                continue
            if at != (shard[a], copy[a]):
                continue  # no frequent key in this shard
            key = part.column("key").to_numpy().view(np.uint64)
            index = hashed.find(key)
            held = index >= 0
            held[held] = prints[index[held]] == mix(key[held])
            doc = part.column("doc_id")
            known = doc.is_valid().to_numpy(zero_copy_only=False)
            numbers = doc.fill_null(0).to_numpy()
            held[held] = (holders[index[held]] != numbers[held]) | ~known[held]
            yield pa.RecordBatch.from_arrays([part.column("key").filter(pa.array(held)), doc.filter(pa.array(held))], ["key", "doc_id"])


def lost_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``doc_id, lost array<long>``: key hashes of the lines that each document loses."""
    spark = docs.sparkSession
    pairs = materialize(_keys_of(docs, min_chars).distinct(), "line-keys")
    counted = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("holder"))
    frequent = materialize(counted.where((F.col("n") >= min_docs) & F.col("holder").isNotNull()), "line-counts")
    n_shards = 1 + frequent.count() // SHARD_KEYS
    shards = materialize(_shards(frequent, n_shards, pairs.count() // n_shards), "line-shards")
    arrays = shards.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    probes = pairs.withColumn("shard", F.pmod("key", F.lit(n_shards)).cast("int")).join(shards.select("shard", "copies"), "shard")
    probes = probes.withColumn("copy", F.pmod(F.xxhash64("doc_id"), F.col("copies")).cast("int")).drop("copies")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_shards)
    met = probes.unionByName(arrays, allowMissingColumns=True).repartition(n, "shard", "copy")
    met = met.sortWithinPartitions("shard", "copy", F.col("words").isNull())
    lost = met.mapInArrow(_probe, "key long, doc_id long")
    return lost.groupBy("doc_id").agg(F.collect_list("key").alias("lost"))


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    key: str = "doc_id",
    text: str = "text",
    rest: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept``: whole texts without lines held by ``min_docs`` documents or more.

    A line is compared without white space at its ends and with A-Z lower-cased;
    shorter keys than ``min_chars`` code points always stay. The largest key of
    the documents that hold a line keeps it, with all its repeats there. Null and
    empty texts are one empty line. Rows with one key count as one document. A
    null key is a document smaller than all others. Other columns are not read,
    but for those in ``rest``, which come back as a struct of that name.
    """
    chosen = keyed_texts(docs, key, text, rest)
    kind = with_rest("doc_id long, n_lines long, n_dropped long, kept string", chosen)
    lost = lost_lines(chosen.select("doc_id", "text"), min_chars, min_docs).withColumnRenamed("doc_id", "loser")
    both = chosen.join(lost, F.col("doc_id").eqNullSafe(F.col("loser")), "left").drop("loser")

    def run(batches):
        for rows, texts in slices(batches, "text"):
            start, end, found, counts, first = line_keys(texts, min_chars)
            n_dropped, kept = np.zeros(len(texts), np.int64), []
            for i, lost in enumerate(rows.column("lost")):
                a, b = first[i], first[i + 1]
                if not lost.is_valid:
                    kept.append(texts.text(i))
                    continue
                gone = counts[a:b] & np.isin(found[a:b], lost.values.to_numpy().view(np.uint64))
                n_dropped[i] = gone.sum()
                kept.append(b"\n".join(texts.data[start[k] : end[k]].tobytes() for k in np.flatnonzero(~gone) + a))
            out = [rows.column("doc_id"), pa.array(np.diff(first)), pa.array(n_dropped), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*out, *rest_of(rows)], kind.names)

    return both.mapInArrow(run, kind)


OP7_SQL = """
WITH l AS (
  SELECT doc_id, i, ls[i] AS s,
         translate(trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), f AS (
  SELECT k, max(doc_id) AS holder FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT doc_id, i, s, holder IS NOT NULL AND doc_id <> holder AS gone FROM l LEFT JOIN f USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(s, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op7_line_dedup", OP7_SQL)
def op7(spark, folder):
    out = dedup_lines(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
