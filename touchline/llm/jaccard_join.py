"""Jaccard join of documents on word shingles as a metric-space join.

The Jaccard distance is a metric, but documents that share no shingle are all
at distance one, where pivots cannot tell them apart. So the first pivots are
single shingles: a document lies in the regions of its rarest shingles, as many
as a linked partner cannot miss all but one of, crossed with bands of set size
(a window around the empty set). Small regions give candidate pairs. Large ones
are joined recursively: documents as pivots make Voronoi cells, boundary
documents are copied to every cell that the triangle inequality allows, and
cells are cut again until they fit a task. What the metric cannot separate is
joined block by block. Every link comes from exact set sizes.

Rarity is the order of counts in a fixed array of 2**20 cells over all
documents; any order gives the same links.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.graph import components, spanning
from touchline.llm.tables import query, sifted, table
from touchline.llm.text import Hasher, Texts, mix, slices, windows
from touchline.session import materialize

CELLS = 20
CELL_ROWS = 64
SHARED = 2
SMALL = 24
LEAF_DOCS = 1024
LEAF_SHINGLES = 1 << 21
PIVOTS = 16
STUCK = 0.7


def shingle_sets(texts: Texts, k: int) -> list[np.ndarray]:
    """Distinct shingles of each text as sorted hashes; A-Z count as a-z."""
    low = texts.lowered()
    start, end, first = low.words()
    words = Hasher(low.data).spans(start, end)
    n_words = np.diff(first)
    hashes, at = windows(words, first, k)
    cut = np.searchsorted(at, first)
    out = []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        h = np.sort(hashes[a:b])
        out.append(h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h)
    for short in range(1, k):
        which = np.flatnonzero(n_words == short)
        if len(which):
            hashes, at = windows(words, first, short)
            for i in which:
                out[i] = mix(hashes[np.searchsorted(at, first[i])][None] + np.uint64(short))
    return out


class Measure:
    """When two sets link: ``100 * intersection >= percent * union``."""

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("percent must be over 50, at most 100")
        self.percent = percent
        self.width = max(math.log(1.35), 2 * math.log(100 / percent))

    def least(self, n):
        """Shingles that a partner shares at least with a set of ``n``."""
        return -(-self.percent * n // 100)

    def linked(self, both, n, m):
        return 100 * both >= self.percent * (n + m - both)

    def near(self, n, m):
        """Can sets of these sizes link at all."""
        return 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)

    def band(self, n):
        return np.floor(np.log(np.maximum(n, 1)) / self.width + 1e-9).astype(np.int32)


def _heads(k: int):
    """A row for each document, and at the end of a task the counts of its shingles by cell."""

    def counts_of(held: list[np.ndarray]) -> np.ndarray:
        return np.bincount((np.concatenate(held) >> np.uint64(64 - CELLS)).astype(np.int64), minlength=1 << CELLS).astype(np.uint32)

    def run(batches):
        cells, held, waiting = np.zeros(1 << CELLS, np.uint32), [], 0
        for rows, texts in slices(batches, "text"):
            sets = shingle_sets(texts, k)
            held += sets
            waiting += sum(map(len, sets))
            if waiting > 1 << CELLS:
                cells, held, waiting = cells + counts_of(held), [], 0
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            n = len(sets)
            columns = [rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if held:
            cells += counts_of(held)
        if cells.any():
            parts = [zstandard.compress(p.tobytes()) for p in np.split(cells, CELL_ROWS)]
            columns = [pa.nulls(CELL_ROWS, pa.int64()), pa.nulls(CELL_ROWS, pa.int64()), pa.nulls(CELL_ROWS, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(range(CELL_ROWS), pa.int32()), pa.array(parts, pa.binary())], names)

    names = ["doc_id", "n", "digest", "part", "counts"]
    return run


def _add_counts(batches):
    total: dict[int, np.ndarray] = {}
    for rows in batches:
        for part, counts in zip(rows.column("part").to_pylist(), rows.column("counts"), strict=True):
            own = np.frombuffer(zstandard.decompress(counts.as_py()), np.uint32).astype(np.uint64)
            total[part] = total[part] + own if part in total else own
    if total:
        # steps of a twelfth of a doubling keep the order well enough in one byte for counts up to 2**21, coarser beyond
        steps = [np.minimum(255, np.log2(np.maximum(t, 1)) * 12).astype(np.uint8).tobytes() for t in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(steps, pa.binary())], ["part", "steps"])


def rarity(heads: DataFrame) -> np.ndarray:
    """One byte for each of 2**20 cells (1 MB whatever the input): how often its shingles occur."""
    sums = heads.where("part IS NOT NULL").select("part", "counts").repartition(CELL_ROWS, "part")
    out = np.zeros((CELL_ROWS, (1 << CELLS) // CELL_ROWS), np.uint8)
    for row in sums.mapInArrow(_add_counts, "part int, steps binary").collect():
        out[row.part] = np.frombuffer(row.steps, np.uint8)
    return out.ravel()


def _entries(k: int, measure: Measure, cells):
    """The regions of each document: its rarest shingles, in its size band and the one below if a partner may be there."""

    def run(batches):
        steps = cells.value
        for rows, texts in slices(batches, "text"):
            ids = rows.column("doc_id").to_numpy()
            keys, docs, sizes = [], [], []
            for doc, s in zip(ids, shingle_sets(texts, k), strict=True):
                n = len(s)
                take = min(n, n - measure.least(n) + SHARED)
                step = steps[(s >> np.uint64(64 - CELLS)).astype(np.int64)]
                if take < n:
                    last = np.partition(step, take - 1)[take - 1]
                    sure = s[step < last]
                    s = np.concatenate((sure, s[step == last][: take - len(sure)]))  # hashes are in order: the same choice everywhere
                keys.append(s)
                docs.append(np.full(len(s), doc))
                sizes.append(np.full(len(s), n))
            key, doc, n = np.concatenate(keys), np.concatenate(docs), np.concatenate(sizes)
            band = measure.band(n)
            below = n * (measure.percent / 100) < np.exp(measure.width * band) + 1e-6
            key, doc, n, band = (np.concatenate((x, y[below])) for x, y in ((key, key), (doc, doc), (n, n), (band, band - 1)))
            columns = [pa.array(key.view(np.int64)), pa.array(band.astype(np.int32)), pa.array(doc), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "band", "doc", "n"])

    return run


def _regions(measure: Measure):
    """Rows sorted by region: pairs of small ones, members of large ones under their first document."""

    def pairs(doc, n, band, run):
        home = measure.band(n)
        for step in range(1, SMALL):
            if len(doc) <= step:
                break
            i = np.flatnonzero(run[:-step] == run[step:])
            if not len(i):
                break
            j = i + step
            ok = measure.near(n[i], n[j]) & (np.minimum(home[i], home[j]) == band[i])
            a, b = np.minimum(doc[i[ok]], doc[j[ok]]), np.maximum(doc[i[ok]], doc[j[ok]])
            yield batch(a, b, True)

    def batch(a, b, pair: bool):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), pair))], ["region", "doc", "pair"])

    def run(batches):
        names = ("key", "band", "doc", "n")
        held = [np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int64)]
        hot = None  # key, band and pivot of a large region that may go on
        stream = iter(batches)
        while True:
            rows = next(stream, None)
            if rows is not None:
                held = [np.concatenate((h, rows.column(c).to_numpy())) for h, c in zip(held, names, strict=True)]
            key, band, doc, n = held
            if len(key):
                new = np.concatenate(([True], (key[1:] != key[:-1]) | (band[1:] != band[:-1])))
                run_of = np.cumsum(new) - 1
                begin = np.flatnonzero(new)
                size = np.diff(np.append(begin, len(key)))
                pivot = doc[begin]
                large = size > SMALL
                if hot is not None and hot[:2] == (key[0], band[0]):
                    pivot[0], large[0] = hot[2], True
                open_ = rows is not None  # the last run may go on
                if open_ and not large[-1]:
                    done = run_of < run_of[-1]
                else:
                    done = np.ones(len(key), bool)
                hot = (key[-1], band[-1], pivot[-1]) if large[-1] else None
                member = large[run_of]
                if member.any():
                    yield batch(pivot[run_of[member]], doc[member], False)
                few = done & ~member
                yield from pairs(doc[few], n[few], band[few], run_of[few])
                held = [x[~done] for x in held]
            if rows is None:
                return

    return run


def _sets_of(rows: pa.RecordBatch, k: int):
    for part, texts in slices([rows], "text"):
        yield part, shingle_sets(texts, k)


def _against_pivots(k: int, measure: Measure):
    """Rows sorted by region with its pivots first: shared shingles of each document with each pivot."""

    def run(batches):
        pivots, loading = [], False
        for rows in batches:
            for part, sets in _sets_of(rows, k):
                out = []
                keys = (part.column(c).to_pylist() for c in ("region", "slot", "doc"))
                for region, slot, doc, s in zip(*keys, sets, strict=True):
                    if slot is not None:
                        pivots = [*pivots, (slot, doc, s)] if loading else [(slot, doc, s)]
                        loading = True
                        continue
                    loading = False
                    for place, pivot, p in pivots:
                        if pivot == doc:
                            out.append((region, doc, place, pivot, 0.0, False))
                        elif len(s) and len(p):
                            both = len(np.intersect1d(s, p, assume_unique=True))
                            out.append((region, doc, place, pivot, 1 - both / (len(s) + len(p) - both), bool(measure.linked(both, len(s), len(p)))))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.bool_())
                columns = zip(*out, strict=True) if out else [()] * 6
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["region", "doc", "slot", "pivot", "distance", "linked"])

    return run


PIVOT_SCHEMA = "region long, doc long, slot int, pivot long, distance double, linked boolean"


def _leaf(k: int, measure: Measure):
    """All links within one region of bounded size, as a forest."""

    def run(rows: pa.Table) -> pa.Table:
        docs, sets = [], []
        for batch in rows.to_batches():
            for part, own in _sets_of(batch, k):
                docs += part.column("doc").to_pylist()
                sets += own
        size = np.array([len(s) for s in sets])
        shingles, column = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), size)
        column = np.where(np.bincount(column, minlength=len(shingles)) > 1, np.arange(len(shingles)), -1)[column]
        used = column >= 0
        _, column = np.unique(column[used], return_inverse=True)
        row = row[used]
        both = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
            a, b = np.searchsorted(column, (low, low + 2048))
            held = np.zeros((len(sets), 2048), np.float32)
            held[row[a:b], column[a:b] - low] = 1
            both += held @ held.T
        links = np.triu(measure.linked(both.astype(np.int64), size[:, None], size[None, :]), 1)
        i, j = spanning(links)
        docs = np.array(docs, np.int64)
        return pa.table({"a": pa.array(docs[i], pa.int64()), "b": pa.array(docs[j], pa.int64())})

    return run


def _pivot_distances(members: DataFrame, pivots: DataFrame, k: int, measure: Measure, copies_of: DataFrame) -> DataFrame:
    """Members meet their region's pivots; large regions are dealt over copies of them. All carry their text."""
    salted = members.join(copies_of, "region").withColumn("copy", F.pmod(F.xxhash64("doc"), F.col("copies")).cast("int")).drop("copies")
    spread = pivots.join(copies_of, "region").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    met = salted.withColumn("slot", F.lit(None).cast("int")).unionByName(spread)
    met = met.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), "region", "copy")
    met = met.sortWithinPartitions("region", "copy", F.col("slot").isNull(), "doc").select("region", "slot", "doc", "text")
    return met.mapInArrow(_against_pivots(k, measure), PIVOT_SCHEMA)


def _split(members: DataFrame, sizes: DataFrame, texts: DataFrame, k: int, measure: Measure, turn: int) -> tuple[DataFrame, DataFrame]:
    """One step of the recursion on regions that are too large: new regions, and the links of their pivots."""
    slot = F.pmod(F.xxhash64("doc", F.lit(turn)), F.lit(PIVOTS)).cast("int")
    pivots = members.groupBy("region", slot.alias("slot")).agg(F.min_by("doc", F.xxhash64("doc", F.lit(turn + 1000))).alias("doc"))
    copies = sizes.select("region", (1 + F.floor(F.col("docs") / LEAF_DOCS)).cast("int").alias("copies"))
    with_text = members.join(texts, "doc")
    found = materialize(_pivot_distances(with_text, pivots.join(texts, "doc"), k, measure, copies), "pivot-distances")
    links = found.where("linked").select(F.col("doc").alias("a"), F.col("pivot").alias("b"))
    eps = 1 - measure.percent / 100 + 1e-9
    own = found.groupBy("region", "doc").agg(F.min(F.struct("distance", "slot")).alias("home"))
    cells = found.join(own, ["region", "doc"]).withColumn("at_home", F.col("slot") == F.col("home.slot"))
    radius = cells.where("at_home").groupBy("region", "slot").agg(F.max("distance").alias("radius"))
    inside = F.col("at_home") | ((F.col("distance") <= F.col("home.distance") + 2 * eps) & (F.col("distance") <= F.col("radius") + eps))
    cells = cells.join(radius, ["region", "slot"]).where(inside)
    return materialize(cells.select(F.xxhash64("region", "slot", F.lit(turn)).alias("region"), F.col("region").alias("parent"), "doc"), "regions"), links


def _sizes(members: DataFrame, shingles: DataFrame) -> DataFrame:
    return members.join(shingles, "doc").groupBy("region").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total"))


def _links_of_large(members: DataFrame, shingles: DataFrame, texts: DataFrame, k: int, measure: Measure) -> list[DataFrame]:
    """Links within large regions: Voronoi cells until they fit, blocks of what stays together."""
    links, leaves = [], []
    turn = 0
    while not members.isEmpty():
        sizes = materialize(_sizes(members, shingles), "region-sizes")
        fits = (F.col("docs") <= LEAF_DOCS) & (F.col("total") <= LEAF_SHINGLES)
        leaves.append(members.join(sizes.where(fits).select("region"), "region").select("region", "doc"))
        over = sizes.where(~fits)
        if over.isEmpty():
            break
        if turn and "parent" in members.columns:
            stuck = members.join(over, "region").select("region", "parent", "docs").distinct().join(before, "parent")
            stuck = materialize(stuck.where(F.col("docs") > STUCK * F.col("parent_docs")).select("region", "docs"), "stuck")
            blocks = members.join(stuck.join(sizes.select("region", "total"), "region"), "region")
            n = F.ceil(F.greatest(2 * F.col("docs") / LEAF_DOCS, 2 * F.col("total") / LEAF_SHINGLES)).cast("int") + 1
            blocks = blocks.withColumn("blocks", n).withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
            blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            pair = F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other"), F.lit("block"))
            leaves.append(blocks.select(pair.alias("region"), "doc"))
            over = over.join(stuck.select("region"), "region", "left_anti")
        over = materialize(over.select("region", "docs"), "large-regions")
        if over.isEmpty():
            break
        before = over.select(F.col("region").alias("parent"), F.col("docs").alias("parent_docs"))
        members, pivot_links = _split(members.join(over.select("region"), "region").select("region", "doc"), over, texts, k, measure, turn)
        links.append(pivot_links)
        turn += 1
    small = leaves[0]
    for more in leaves[1:]:
        small = small.unionByName(more)
    small = small.join(texts, "doc").select("region", "doc", "text")
    return [*links, small.groupBy("region").applyInArrow(_leaf(k, measure), "a long, b long")]


def _by_row(chosen: DataFrame, keyless: DataFrame, k: int, percent: int) -> DataFrame:
    """Near documents where rows share keys: numbered rows are linked, and named by the smallest key among them."""
    numbered = materialize(chosen.where("doc_id IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "numbered-rows")
    found = near_documents(numbered, k, percent, key="row").withColumnRenamed("doc_id", "row").join(numbered.select("row", "doc_id"), "row")
    found = materialize(found, "linked-rows")
    for name in ("class_id", "component_id"):
        least = found.groupBy(name).agg(F.min("doc_id").alias("least"))
        found = found.join(least, name).drop(name).withColumnRenamed("least", name)
    none = F.lit(None).cast("long")
    keyless = keyless.select("doc_id", F.col("n").alias("n_shingles"), none.alias("class_id"), none.alias("component_id"))
    return found.select(keyless.columns).unionByName(keyless)


def near_documents(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` of every document.

    ``class_id`` is the smallest document with the same set of shingles,
    ``component_id`` the smallest reachable by links. Fewer than ``k`` words are
    one shingle; null texts and texts without words have none, link with
    nothing and are classes of their own, like rows with a null key (whose
    class is null). Rows that repeat a key are linked each by its own text. Other
    columns are not read.
    """
    spark = docs.sparkSession
    measure = Measure(percent)
    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = chosen.where("doc_id IS NOT NULL AND text IS NOT NULL")
    heads = materialize(chosen.mapInArrow(_heads(k), "doc_id long, n long, digest binary, part int, counts binary"), "shingle-heads")
    rows = heads.where("part IS NULL").select("doc_id", "n", "digest")
    if not rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty():
        return _by_row(chosen, rows.where("doc_id IS NULL"), k, percent)
    classes = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.first("n").alias("n"))
    classes = materialize(classes, "shingle-classes")
    shingles = classes.select(F.col("class_id").alias("doc"), "n")
    cells = spark.sparkContext.broadcast(rarity(heads))
    later = rows.join(classes.where("n > 1"), "digest").where("doc_id > class_id").select("doc_id").distinct()
    later = materialize(later.unionByName(rows.where("n < 2 AND doc_id IS NOT NULL").select("doc_id")), "later-copies")
    marked = sifted(known, "doc_id", later, "doc_id")
    firsts = marked.where("NOT maybe").drop("maybe").unionByName(marked.where("maybe").drop("maybe").join(later, "doc_id", "left_anti"))
    entries = firsts.mapInArrow(_entries(k, measure, cells), "key long, band int, doc long, n long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = entries.repartition(4 * parts, "key", "band").sortWithinPartitions("key", "band", F.xxhash64("doc"), "doc")
    met = materialize(entries.mapInArrow(_regions(measure), "region long, doc long, pair boolean"), "regions")
    pairs = met.where("pair").groupBy("region", "doc").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= SHARED).select("region", "doc")
    pairs = materialize(pairs, "candidates")
    members = materialize(met.where("NOT pair").select("region", "doc").distinct(), "members")
    wanted = pairs.select("doc").unionAll(pairs.select("region")).unionAll(members.select("doc")).distinct()
    wanted = materialize(wanted, "wanted")
    likely = sifted(known, "doc_id", wanted, "doc").where("maybe")
    texts = likely.join(wanted, likely.doc_id == wanted.doc, "left_semi").select(F.col("doc_id").alias("doc"), "text")
    texts = materialize(texts.dropDuplicates(["doc"]), "candidate-texts")
    one = pairs.groupBy("region").agg(F.count(F.lit(1)).alias("docs")).select("region", (1 + F.floor(F.col("docs") / LEAF_DOCS)).cast("int").alias("copies"))
    pivots = pairs.select("region").distinct().select("region", F.lit(0).alias("slot"), F.col("region").alias("doc")).join(texts, "doc")
    star = _pivot_distances(pairs.join(texts, "doc"), pivots, k, measure, one)
    links = [star.where("linked").select(F.col("doc").alias("a"), F.col("pivot").alias("b"))]
    if not members.isEmpty():
        links += _links_of_large(members, shingles, texts, k, measure)
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    whole = components(every)
    labels = classes.join(whole, classes.class_id == whole.node, "left").select("digest", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    named = rows.join(labels, "digest", "left")
    return named.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 2
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)
), reach(node, via) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.via = l.a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(via) AS component_id FROM reach GROUP BY node) ON node = d.doc_id
"""


@query("op1_jaccard_join", OP1_SQL)
def op1(spark, folder):
    return near_documents(table(spark, folder, "documents"), k=3, percent=90).drop("class_id")
