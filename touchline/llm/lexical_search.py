"""Ranked lexical search over bit-sliced signatures.

Every document gets a Bloom signature of its terms, and of (term, count) at the
steps of ``LEVELS``, so that counts are bounded as well. Signatures of documents
of about equal size lie side by side in blocks: a row of a block is one bit
position, a column one document. A query ANDs the rows of each of its terms;
the slices of all steps, weighted, sum up to a bound on every document's score.
The bound is never too low: a signature may claim a term or a count that is not
there, but never misses one.

A search has two rounds over the blocks. The first takes each item's documents
with the highest bounds and scores them by their texts; the ``top``-th of these
scores is a score that the answer must reach. The second keeps every document
whose bound reaches it, all of which are scored by their texts. What is left
out is provably below, or equal and later by id. Documents of the same terms
and counts have the same score for every item, so of such copies only the
``top`` first by id are scored. Counts of documents are by the terms' texts.

Score: a term's weight is floor(1000 ln((2N+2)/(2df+1))), a document's length
factor m is 75 + 25nN div L, and a term that stands tf times adds weight times
(10^9 tf) div (1000 tf + 12 m), once for each time the item holds it.

Documents without terms (null, empty, marks only) are not ranked, items without
terms have no rows. Rows that share an id are documents, or items, of their own;
null ids rank first among equals. Other columns are not read.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.tables import keyed_texts, query, sifted, table
from touchline.llm.text import Hasher, Texts, mix, slices, within
from touchline.operators.windows import top_n
from touchline.session import materialize

# fixed values of the ranking
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER_LETTERS, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 20
#: most that a term can add, whatever its count
MOST = 10**6

#: counts at which a term gets another signature entry; a document that has step k but not k + 1 has less than step k + 1
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128], np.int64)
#: rows set by an entry, rows for each entry of the largest document of a block, and factor between the sizes of blocks
PROBES, ROWS_PER_ENTRY, GROWTH = 6, 20, 1.25
#: bits of a block before it is packed (4 MB in the making), and most documents in it
CELLS, BLOCK_DOCS = 1 << 22, 2048
#: words of the bitmap that sifts terms nobody asks for: fixed size, at most so many rows reach the driver
SIFT_WORDS = 1 << 17
#: about so many terms of items are searched at once; they are broadcast
BATCH_TERMS = 1 << 15
#: documents scored for each place in the answer before the second round: bounds that are too high take some of them
FIRST = 3
#: documents whose bounds are summed at once
STRIPE = 512
#: distinct terms counted before counts are passed on
FLUSH = 1 << 16

IS_TERM = np.zeros(256, bool)
IS_TERM[48:58] = IS_TERM[65:91] = IS_TERM[97:123] = IS_TERM[128:] = True

BLOCK = "n_rows int, n_docs int, n_terms long, doc_ids array<long>, lengths array<long>, kinds array<binary>, bits binary, terms array<string>, found array<long>"


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER_LETTERS, LOWER_LETTERS)


def terms_of(text: Column) -> Column:
    """All terms of a text, in order; none if null."""
    return F.regexp_extract_all(F.coalesce(lowered(text), F.lit("")), F.lit(TERM), F.lit(0))


def _rows(hashes: np.ndarray, level: np.ndarray | int, n_rows: np.ndarray | int) -> list[np.ndarray]:
    """The rows that each entry sets, for blocks of ``n_rows`` rows."""
    entry = mix(hashes + np.asarray(level).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    out = []
    for _ in range(PROBES):
        entry = mix(entry + np.uint64(0xA0761D6478BD642F))
        out.append(((entry >> np.uint64(32)) * np.asarray(n_rows).astype(np.uint64) >> np.uint64(32)).astype(np.int64))
    return out


def _sift_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> np.uint64(6)).astype(np.int64) & (SIFT_WORDS - 1), np.uint64(1) << (hashes & np.uint64(63))


def _size_class(entries: np.ndarray) -> np.ndarray:
    return np.ceil(np.log(np.maximum(entries, 32) / 32) / np.log(GROWTH) - 1e-9).astype(np.int64)


def _class_rows(size: int) -> int:
    return int(np.ceil(32 * GROWTH**size)) * ROWS_PER_ENTRY


class _Blocks:
    """Documents of one partition on their way into blocks."""

    def __init__(self):
        self.waiting: dict[int, list] = {}

    def add(self, size: int, doc, length: int, hashes: np.ndarray, counts: np.ndarray):
        """Takes a document; returns a block if one is full."""
        group = self.waiting.setdefault(size, [])
        group.append((doc, length, hashes, counts))
        if len(group) >= max(1, min(BLOCK_DOCS, CELLS // _class_rows(size))):
            return self.block(size, self.waiting.pop(size))
        return None

    def rest(self):
        for size in sorted(self.waiting):
            yield self.block(size, self.waiting[size])
        self.waiting = {}

    @staticmethod
    def block(size: int, group: list) -> dict:
        n_rows = _class_rows(size)
        column = np.repeat(np.arange(len(group)), [len(g[2]) for g in group])
        hashes, counts = np.concatenate([g[2] for g in group]), np.concatenate([g[3] for g in group])
        bits = np.zeros((n_rows, len(group)), bool)
        for k, step in enumerate(LEVELS):
            some = counts >= step
            if not some.any():
                break
            for row in _rows(hashes[some], k, n_rows):
                bits[row, column[some]] = True
        lengths = [g[1] for g in group]
        return {
            "n_rows": n_rows, "n_docs": len(group), "n_terms": sum(lengths), "doc_ids": [g[0] for g in group], "lengths": lengths,
            "kinds": [blake2b(g[2].tobytes() + g[3].tobytes(), digest_size=16).digest() for g in group], "bits": np.packbits(bits, axis=1).tobytes(), "terms": [], "found": [],
        }


def _index_batches(sift):
    """Blocks of the documents, and how many of them hold each term that may be asked for."""

    def run(batches):
        schema = pa.schema([("n_rows", pa.int32()), ("n_docs", pa.int32()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                            ("lengths", pa.list_(pa.int64())), ("kinds", pa.list_(pa.binary())), ("bits", pa.binary()), ("terms", pa.list_(pa.string())), ("found", pa.list_(pa.int64()))])
        wanted, blocks, counted = sift.value, _Blocks(), {}

        def out(rows):
            return pa.RecordBatch.from_pylist(rows, schema)

        def counts():
            row = {"n_rows": 0, "n_docs": 0, "n_terms": 0, "doc_ids": [], "lengths": [], "kinds": [], "bits": b"",
                   "terms": [t.decode() for t in counted], "found": list(counted.values())}
            counted.clear()
            return row

        for part, texts in slices(batches, "text"):
            ids = part.column("doc_id").to_pylist()
            low = texts.lowered()
            start, end, first = low.words(within=IS_TERM)
            if not len(start):
                continue
            hashes, doc = Hasher(low.data).spans(start, end), within(first)
            order = np.lexsort((hashes, doc))
            h, d = hashes[order], doc[order]
            new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]))))
            h, d, tf, at = h[new], d[new], np.diff(np.append(new, len(order))), order[new]

            word, bit = _sift_places(h)
            known = (wanted[word] & bit) != 0
            distinct, where, n = np.unique(h[known], return_index=True, return_counts=True)
            at = at[known]
            for w, k in zip(where.tolist(), n.tolist(), strict=True):
                term = low.data[start[at[w]] : end[at[w]]].tobytes()
                counted[term] = counted.get(term, 0) + k
            if len(counted) >= FLUSH:
                yield out([counts()])

            bounds = np.searchsorted(d, np.arange(len(texts) + 1))
            steps = np.concatenate(([0], np.cumsum(np.searchsorted(LEVELS, tf, "right"))))
            sizes = _size_class(steps[bounds[1:]] - steps[bounds[:-1]])
            for i in np.flatnonzero(np.diff(first)).tolist():
                a, b = bounds[i], bounds[i + 1]
                block = blocks.add(int(sizes[i]), ids[i], int(first[i + 1] - first[i]), h[a:b].copy(), tf[a:b].copy())
                if block is not None:
                    yield out([block])
        for block in blocks.rest():
            yield out([block])
        if counted:
            yield out([counts()])

    return run


def _sift(spark: SparkSession, items: DataFrame):
    """A bitmap of the items' terms, of fixed size, on every executor."""

    def places(batches):
        for _, texts in slices(batches, "text"):
            low = texts.lowered()
            start, end, _ = low.words(within=IS_TERM)
            word, bit = _sift_places(Hasher(low.data).spans(start, end))
            for at in range(0, len(word), 1 << 16):
                some = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(word[some]), pa.array(bit[some].view(np.int64))], ["word", "bit"])

    words = items.select("text").mapInArrow(places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    bitmap = np.zeros(SIFT_WORDS, np.uint64)
    for r in words:
        bitmap[r.word] = np.uint64(r.bits & (2**64 - 1))
    return spark.sparkContext.broadcast(bitmap)


class _Batch:
    """Terms of some items: hashes of the distinct ones, and for each item which of them it holds with what weight."""

    def __init__(self, rows, least: dict):
        names = sorted({r.term for r in rows})
        data = "".join(names).encode()
        ends = np.cumsum([len(t.encode()) for t in names])
        self.hashes = Hasher(np.frombuffer(data, np.uint8)).spans(np.concatenate(([0], ends[:-1])), ends)
        order = np.argsort(self.hashes)
        self.hashes, self.terms = self.hashes[order], [names[i].encode() for i in order]
        place = {t.decode(): i for i, t in enumerate(self.terms)}
        held: dict[int, list] = {}
        for r in rows:
            held.setdefault(r.item, []).append((place[r.term], r.weight))
        self.items = [(item, np.array([p for p, _ in some]), np.array([w for _, w in some], np.int64)) for item, some in held.items()]
        #: for each item the score that candidates must reach, and the last id that may do so with that very score
        self.least = {item: least.get(item, (1, None)) for item in held}


def _bounds(batch: _Batch, n_rows: int, lengths: np.ndarray, bits: np.ndarray, n: int, total: int):
    """For stripes of a block: where they start and an upper bound for each (item, document)."""
    width = -(-len(lengths) // 8)
    packed = np.frombuffer(bits, np.uint8).reshape(n_rows, width)
    m = 75 + 25 * lengths * n // total
    ceilings = [*(LEVELS[1:] - 1).tolist(), None]
    most = [np.full(len(m), MOST, np.int64) if c is None else 10**9 * c // (1000 * c + 12 * m) for c in ceilings]
    slices_of = []
    alive, chosen = np.arange(len(batch.hashes)), None
    for k in range(len(LEVELS)):
        rows = _rows(batch.hashes[alive], k, n_rows)
        for row in rows:
            chosen = packed[row] if chosen is None else chosen & packed[row]
        some = chosen.any(axis=1)
        alive, chosen = alive[some], chosen[some]
        if not len(alive):
            break
        slices_of.append((alive, chosen))
    for at in range(0, len(m), STRIPE):
        to = min(at + STRIPE, len(m))
        add = np.zeros((len(batch.hashes), to - at))
        below = np.zeros(to - at, np.int64)
        for k, (alive, chosen) in enumerate(slices_of):
            gain = most[k][at:to] - below
            below = most[k][at:to]
            flags = np.unpackbits(chosen[:, at // 8 : -(-to // 8)], axis=1, count=to - at)
            add[alive] += flags * gain.astype(np.float64)
        yield at, to, add


def _sums(add: np.ndarray, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sums of an item's slices, in whole numbers."""
    if int(weights.sum()) * MOST < 2**53:
        return (weights.astype(np.float64) @ add[places]).astype(np.int64)
    return weights @ add[places].astype(np.int64)


SOUGHT = "item long, doc_id long, kind binary, bound long"
CANDIDATE = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("kind", pa.binary()), ("bound", pa.int64())])


def _rank_first(ids: list) -> np.ndarray:
    """Ids as numbers in the order of ranking, nulls first."""
    return np.array([-(2**63) if x is None else x for x in ids], np.int64)


class _Highest:
    """The ``top`` candidates of each item with the highest bounds, the first ids among equals."""

    def __init__(self, top: int):
        self.top, self.kept = top, {}

    def take(self, item, bound, ids, keys, kinds):
        kept = self.kept.setdefault(item, [])
        floor = -kept[-1][0] if len(kept) >= self.top else 1
        hit = np.flatnonzero(bound >= floor)
        hit = hit[np.lexsort((keys[hit], -bound[hit]))[: self.top]]
        kept.extend((-int(bound[i]), int(keys[i]), ids[i], kinds[i]) for i in hit.tolist())
        kept.sort(key=lambda x: x[:2])
        del kept[self.top :]
        return ()

    def rest(self):
        for item, kept in self.kept.items():
            for bound, _, doc, kind in kept:
                yield item, doc, kind, -bound


class _Reaching:
    """All candidates whose bound reaches their item's least score, of copies the ``top`` first ids."""

    def __init__(self, top: int, least: dict):
        self.top, self.least, self.kept, self.size = top, least, {}, 0

    def take(self, item, bound, ids, keys, kinds):
        least, last = self.least[item]
        reaches = bound >= least
        if last is not None:
            reaches &= (bound > least) | (keys <= last)
        for i in np.flatnonzero(reaches).tolist():
            kept = self.kept.setdefault((item, kinds[i]), [])
            kept.append((int(keys[i]), ids[i], int(bound[i])))
            self.size += 1
            if len(kept) > 2 * self.top:
                kept.sort(key=lambda x: x[0])
                self.size -= len(kept) - self.top
                del kept[self.top :]
        return self.rest() if self.size > FLUSH else ()

    def rest(self):
        for (item, kind), kept in self.kept.items():
            for _, doc, bound in sorted(kept, key=lambda x: x[0])[: self.top]:
                yield item, doc, kind, bound
        self.kept, self.size = {}, 0


def _search_batches(shared, n: int, total: int, top: int, first_round: bool):
    """Candidates among the documents of a partition."""

    def run(batches):
        batch = shared.value
        chosen = _Highest(top) if first_round else _Reaching(top, batch.least)

        def out(rows):
            rows = list(rows)
            return pa.RecordBatch.from_pylist([dict(zip(CANDIDATE.names, r, strict=True)) for r in rows], CANDIDATE)

        for part in batches:
            for row in part.to_pylist():
                ids, kinds, lengths = row["doc_ids"], row["kinds"], np.array(row["lengths"], np.int64)
                keys = _rank_first(ids)
                for at, to, add in _bounds(batch, row["n_rows"], lengths, row["bits"], n, total):
                    for item, places, weights in batch.items:
                        found = list(chosen.take(item, _sums(add, places, weights), ids[at:to], keys[at:to], kinds[at:to]))
                        if found:
                            yield out(found)
        found = list(chosen.rest())
        for at in range(0, len(found), FLUSH):
            yield out(found[at : at + FLUSH])

    return run


def _counts(batch: _Batch, texts: Texts) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Number of terms of each text, and which of the batch's terms it holds how often."""
    low = texts.lowered()
    start, end, first = low.words(within=IS_TERM)
    hashes = Hasher(low.data).spans(start, end)
    place = np.minimum(np.searchsorted(batch.hashes, hashes), len(batch.hashes) - 1)
    found = np.flatnonzero(batch.hashes[place] == hashes)
    real = [low.data[start[i] : end[i]].tobytes() == batch.terms[k] for i, k in zip(found.tolist(), place[found].tolist(), strict=True)]
    found = found[np.array(real, bool)]
    bounds = np.searchsorted(found, first)
    return np.diff(first), [np.unique(place[found[a:b]], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _score_batches(shared, n: int, total: int):
    """(item, doc_id, score) of whole texts for the items that each of them is a candidate of."""

    def run(batches):
        batch = shared.value
        terms_of_item = {item: (places, weights) for item, places, weights in batch.items}
        for part, texts in slices(batches, "text"):
            lengths, counts = _counts(batch, texts)
            rows = []
            for doc, items, length, (held, tf) in zip(part.column("doc_id").to_pylist(), part.column("items").to_pylist(), lengths.tolist(), counts, strict=True):
                gain = np.zeros(len(batch.hashes), np.int64)
                gain[held] = 10**9 * tf // (1000 * tf + 12 * (75 + 25 * length * n // total))
                for item in items:
                    places, weights = terms_of_item[item]
                    score = int(weights @ gain[places])
                    if score > 0:
                        rows.append((item, doc, score))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ((), (), ()))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return run


def _scores(docs: DataFrame, pairs: DataFrame, shared, n: int, total: int) -> DataFrame:
    """``item, doc_id, score`` above 0 of all documents that the pairs name, by their texts."""
    grouped = pairs.groupBy(F.col("doc_id").alias("of")).agg(F.collect_set("item").alias("items"))
    maybe = sifted(docs, "doc_id", grouped, "of").where("maybe").drop("maybe")
    met = maybe.join(grouped, F.col("doc_id").eqNullSafe(F.col("of"))).select("doc_id", "text", "items")
    return met.mapInArrow(_score_batches(shared, n, total), "item long, doc_id long, score long")


def _best_of_batch(texts: DataFrame, blocks: DataFrame, asked: DataFrame, n: int, total: int, top: int) -> DataFrame | None:
    """The ``top`` documents of each item of a batch, whose terms are broadcast; none for a batch without items."""
    spark = texts.sparkSession
    rows = asked.collect()
    if not rows:
        return None

    def candidates(shared, count: int, first_round: bool) -> DataFrame:
        found = blocks.mapInArrow(_search_batches(shared, n, total, count, first_round), SOUGHT)
        return materialize(found, "search-candidates")

    shared = spark.sparkContext.broadcast(_Batch(rows, {}))
    first = candidates(shared, FIRST * top, True)
    first = top_n(first, ["item"], [F.desc("bound"), F.asc("doc_id")], FIRST * top).select("item", "doc_id").distinct()
    best = top_n(_scores(texts, first, shared, n, total), ["item"], [F.desc("score"), F.asc("doc_id")], top)
    lowest = best.groupBy("item").agg(F.count(F.lit(1)).alias("places"), F.max(F.struct((-F.col("score")).alias("down"), "doc_id")).alias("end"))
    # one row for each item of the batch
    least = {r.item: (-r.end.down, r.end.doc_id) for r in lowest.where(F.col("places") >= top).collect()}

    shared = spark.sparkContext.broadcast(_Batch(rows, least))
    pairs = top_n(candidates(shared, top, False), ["item", "kind"], [F.asc("doc_id")], top).select("item", "doc_id").distinct()
    scores = _scores(texts, materialize(pairs, "search-pairs"), shared, n, total)
    return materialize(top_n(scores, ["item"], [F.desc("score"), F.asc("doc_id")], top, "rank"), "search-best")


def search(docs: DataFrame, items: DataFrame, doc: str = "doc_id", doc_text: str = "text", item: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``top`` documents with the highest scores above 0."""
    spark = docs.sparkSession
    texts = keyed_texts(docs, doc, doc_text)
    asked = materialize(
        items.select(F.monotonically_increasing_id().alias("item"), items[item].alias("item_id"), items[item_text].alias("text")), "search-items"
    )
    blocks = materialize(texts.mapInArrow(_index_batches(_sift(spark, asked)), BLOCK), "search-index")

    n, total = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    nothing = asked.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    if not n:
        return nothing
    held = blocks.select(F.explode(F.arrays_zip("terms", "found")).alias("x")).groupBy("x.terms").agg(F.sum("x.found").alias("df"))
    of_items = asked.select("item", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * n + 2) / (2.0 * F.col("df") + 1)))
    # terms in no document add nothing
    weighed = of_items.join(held, F.col("term") == F.col("terms")).select("item", "term", (weight * F.col("times")).cast("long").alias("weight"))
    weighed = materialize(weighed.where("weight > 0"), "search-terms")
    batches = -(-weighed.count() // BATCH_TERMS)
    chosen = blocks.where("n_docs > 0").select("n_rows", "lengths", "doc_ids", "kinds", "bits")
    out = None
    for k in range(batches):
        batch = weighed.where(F.pmod(F.xxhash64("item"), F.lit(batches)) == k)
        found = _best_of_batch(texts, chosen, batch, n, total, top)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        return nothing
    return out.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


SQL = f"""
WITH occurrences AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER_LETTERS}', '{LOWER_LETTERS}'), '{TERM}')) AS term FROM documents
), lengths AS (SELECT doc_id, count(*) AS n FROM occurrences GROUP BY doc_id),
counts AS (SELECT doc_id, term, count(*) AS tf FROM occurrences GROUP BY doc_id, term),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
asked AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER_LETTERS}', '{LOWER_LETTERS}'), '{TERM}')) AS term FROM benchmark
), times AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, whole GROUP BY term, docs
), scores AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
    FROM times JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), whole
    GROUP BY item_id, doc_id
), placed AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {TOP}
"""


@query("op13_lexical_search", SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item, out of all documents."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
