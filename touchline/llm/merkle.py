"""Merkle manifest of a dataset: a root for each group of rows, one for all, and a proof for every row.

Rows are leaves, numbered within their group by id. The slots of a parent are
columns: conditional aggregates spread the children of every parent over
``FANOUT`` of them, their concatenation is hashed, and what is left when one
child is taken out is that child's siblings. Every level is a sixteenth of the
one below; the driver only learns how many leaves the largest group has.

Going down again, a parent's siblings and those of its ancestors reach its
children through one join a level, made before the children are spread out, so
the long proofs of the upper levels are moved once for sixteen children.

A null field enters a leaf as ``-``, a group may be null (it comes first), ids
that are null come first in their group. Rows with the same id are leaves of
their own, in the order of their hashes. A group of one row has its leaf as its
root and adds nothing to its proof. Without rows there is no root and no row.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.tables import query, table
from touchline.operators.windows import running_totals
from touchline.session import materialize

FANOUT = 16
SLOTS = [f"slot{k}" for k in range(FANOUT)]


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of the fields, each as its length in bytes, a colon and its value, or ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _hex(hash_bytes: Column) -> Column:
    return F.lower(F.hex(hash_bytes))


def _hashes() -> Column:
    return F.transform("kids", lambda node: _hex(node["hash"]))


def _alone() -> Column:
    """Whether a run holds the only node of its level, which then goes up as it is."""
    return (F.col("run") == 0) & (F.size("kids") == 1)


def _runs(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each run of ``FANOUT`` nodes as one row: a column for every slot, put together as ``kids``, and the hash of them all."""
    slot = F.pmod("place", F.lit(FANOUT))
    spread = nodes.groupBy(*keys, F.floor(F.col("place") / FANOUT).alias("run")).agg(
        *[F.max(F.when(slot == k, F.col("node"))).alias(s) for k, s in enumerate(SLOTS)]
    )
    kids = spread.select(*keys, "run", F.array_compact(F.array(*SLOTS)).alias("kids"))
    up = F.when(_alone(), F.get("kids", F.lit(0))["hash"]).otherwise(F.unhex(digest(F.array_join(_hashes(), ""))))
    return kids.withColumn("hash", up)


def _levels(nodes: DataFrame, keys: Sequence[str], most: int, label: str) -> list[DataFrame]:
    """Runs of every level, up to the one where each group has a single run."""
    out = [materialize(_runs(nodes, keys), f"{label}-runs")]
    while most > FANOUT:
        most = -(-most // FANOUT)
        up = out[-1].select(*keys, F.col("run").alias("place"), F.struct("hash").alias("node"))
        out.append(materialize(_runs(up, keys), f"{label}-runs"))
    return out


def _siblings(slot: Column) -> Column:
    """What a run adds to the path of the child in ``slot``: the hashes left and right of it."""
    left = F.array_join(F.slice("hashes", F.lit(1), slot), "")
    right = F.array_join(F.slice("hashes", slot + 2, F.lit(FANOUT)), "")
    step = F.struct(left.alias("left"), right.alias("right"))
    return F.when(F.col("alone"), F.slice(F.array(step), 1, 0)).otherwise(F.array(step))


def _paths(levels: list[DataFrame], keys: Sequence[str], top: DataFrame, above: Sequence[str]) -> DataFrame:
    """The runs of the lowest level with ``path``, from above them to the top, and the columns ``above``."""
    rows = top
    for down in reversed(levels[:-1]):
        parent = rows.select(
            *[F.col(k).alias(f"up_{k}") for k in keys], F.col("run").alias("up"), _hashes().alias("hashes"), _alone().alias("alone"), "path", *above
        )
        test = F.floor(F.col("run") / FANOUT) == F.col("up")
        for k in keys:
            test = test & F.col(k).eqNullSafe(F.col(f"up_{k}"))
        slot = F.pmod("run", F.lit(FANOUT)).cast("int")
        joined = down.join(parent, test).withColumn("path", F.concat(_siblings(slot), F.col("path")))
        rows = joined.drop("up", "hashes", "alone", *[f"up_{k}" for k in keys])
    return rows


def manifest(leaves: DataFrame, group: str, order: str, leaf: str, payload: Sequence[str] = ()) -> DataFrame:
    """Every leaf with its group's root, the root of all and its proof.

    ``leaf`` is the hex hash of a row. Returns ``group, order, leaf, payload,
    subroot, root`` (hex) and ``path``: from the leaf to the root, for each run
    on the way, the hashes left and right of the own one.
    """
    names = [f"payload_{i}" for i in range(len(payload))]
    own = leaves.select(
        leaves[group].alias("part"),
        leaves[order].alias("key"),
        F.unhex(leaves[leaf]).alias("hash"),
        *[leaves[c].alias(n) for c, n in zip(payload, names, strict=True)],
        F.lit(1).cast("long").alias("one"),
    )
    numbered = running_totals(own, ["part"], ["key", "hash"], {"place": "one"})
    nodes = numbered.select("part", "place", F.struct("hash", "key", *names).alias("node"))
    lowest = materialize(nodes, "merkle-leaves")
    most = lowest.agg(F.max("place")).first()[0]
    levels = _levels(lowest, ["part"], 0 if most is None else most + 1, "merkle-group")

    roots = levels[-1].select("part", "hash", F.lit(1).cast("long").alias("one"))
    parts = materialize(running_totals(roots, [], ["part"], {"place": "one"}), "merkle-groups")
    found = parts.agg(F.max("place")).first()[0]
    upper = _levels(parts.select("place", F.struct("hash", "part").alias("node")), [], 0 if found is None else found + 1, "merkle-top")

    nowhere = F.expr("CAST(array() AS ARRAY<STRUCT<left: STRING, right: STRING>>)")
    top = upper[-1].select("*", nowhere.alias("path"), _hex(F.col("hash")).alias("root"))
    of_parts = _children(_paths(upper, [], top, ["root"]), ["root"])
    of_parts = of_parts.select(F.col("node.part").alias("of"), _hex(F.col("node.hash")).alias("subroot"), "root", "path")
    top = levels[-1].join(of_parts, F.col("part").eqNullSafe(F.col("of"))).drop("of")
    done = _children(_paths(levels, ["part"], top, ["subroot", "root"]), ["part", "subroot", "root"])
    return done.select(
        F.col("part").alias(group),
        F.col("node.key").alias(order),
        _hex(F.col("node.hash")).alias(leaf),
        *[F.col(f"node.{n}").alias(c) for c, n in zip(payload, names, strict=True)],
        "subroot",
        "root",
        "path",
    )


def _children(runs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each child, its path lengthened by its siblings."""
    spread = runs.select(*columns, "path", _hashes().alias("hashes"), _alone().alias("alone"), F.posexplode("kids").alias("slot", "node"))
    return spread.withColumn("path", F.concat(_siblings(F.col("slot")), F.col("path")))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings on its path."""
    return F.aggregate(path, leaf, lambda at, step: digest(F.concat(step["left"], at, step["right"])))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


# fixed values of the tampering trial
TAMPERED_EVERY = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(name: str, value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-') AS {name}"


#: unsigned crc32 of the id's decimal digits, bit by bit
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1), lambda i: ord(substr(CAST(doc_id AS VARCHAR), i, 1)))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _sql(group_levels: int = 6, top_levels: int = 4) -> str:
    """The same by windows: two subqueries for each level going up, one coming back to the leaves."""
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    values = {"f1": "CAST(doc_id AS VARCHAR)", "f2": "source", "f3": "lang", "f4": "CAST(n_chars AS VARCHAR)", "f5": "text", "f6": lowered}
    parts = [
        "fields AS (SELECT doc_id, source, " + ", ".join(_field(k, v) for k, v in values.items()) + " FROM documents)",
        "hashed AS (SELECT doc_id, source, sha256(f1 || f2 || f3 || f4 || f5) AS leaf, sha256(f1 || f2 || f3 || f4 || f6) AS changed FROM fields)",
        f"leaves AS (SELECT *, CASE WHEN {_CRC} % {TAMPERED_EVERY} = 0 THEN changed ELSE leaf END AS seen, "
        "row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed)",
        "a0 AS (SELECT source, place, leaf AS h FROM leaves)",
    ]

    def climb(name: str, levels: int) -> None:
        for k in range(levels):
            around = f"OVER (PARTITION BY source, place // {FANOUT} ORDER BY place ROWS BETWEEN"
            parts.append(
                f"{name}_run{k} AS (SELECT source, place, h, count(*) OVER (PARTITION BY source) = 1 AS alone, "
                f"coalesce(string_agg(h, '') {around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(h, '') {around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
            )
            parts.append(
                f"{name}{k + 1} AS (SELECT source, place // {FANOUT} AS place, "
                f"CASE WHEN bool_and(alone) THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY place)) END AS h "
                f"FROM {name}_run{k} GROUP BY source, place // {FANOUT})"
            )

    climb("a", group_levels)
    parts.append(f"tops AS (SELECT source AS part, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS number FROM a{group_levels})")
    parts.append("b0 AS (SELECT NULL AS source, number AS place, subroot AS h FROM tops)")
    climb("b", top_levels)
    parts.append(
        "path0 AS (SELECT doc_id, leaf, source, place AS spot, number, subroot, '' AS proof, seen AS folded "
        "FROM leaves JOIN tops ON source IS NOT DISTINCT FROM part)"
    )
    for k in range(group_levels + top_levels):
        at = k if k < group_levels else k - group_levels
        name, test = ("a", "p.source IS NOT DISTINCT FROM n.source AND p.spot = n.place") if k < group_levels else ("b", "p.number = n.place")
        spot, number = (f"p.spot // {FANOUT}", "p.number") if k < group_levels else ("p.spot", f"p.number // {FANOUT}")
        parts.append(
            f"path{k + 1} AS (SELECT p.doc_id, p.leaf, p.source, {spot} AS spot, {number} AS number, p.subroot, "
            "CASE WHEN alone THEN proof ELSE proof || l || r END AS proof, "
            f"CASE WHEN alone THEN folded ELSE sha256(l || folded || r) END AS folded FROM path{k} p JOIN {name}_run{at} n ON {test})"
        )
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, "
        f"folded AS folded_root, folded = h AS verified FROM path{group_levels + top_levels}, b{top_levels}"
    )


@query("op12_merkle_manifest", _sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, checked against documents of which a fifth are tampered with."""
    docs = table(spark, sf_dir, "documents")
    fields = [docs[c] for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.crc32(docs["doc_id"].cast("string")) % TAMPERED_EVERY == 0
    changed = F.when(chosen, F.unhex(leaf_hash([*fields, F.translate(docs["text"], UPPER, LOWER)])))
    leaves = docs.select("doc_id", "source", leaf_hash([*fields, docs["text"]]).alias("leaf"), changed.alias("changed"))
    proofs = manifest(materialize(leaves, "merkle-documents"), "source", "doc_id", "leaf", ["changed"])
    folded = fold(F.coalesce(_hex(F.col("changed")), F.col("leaf")), F.col("path"))
    checked = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
