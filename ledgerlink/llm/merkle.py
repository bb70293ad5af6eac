"""Merkle manifest of a dataset: one tree per group of rows, one over the groups' roots, and a proof for every row.

Only every ``STRIDE``-th level of a tree is stored, as aligned subtrees of the nodes below it. To extract proofs, each
subtree's missing nodes are made again from its stored ones, the siblings on every path are given out, and the made
nodes are dropped. A task holds one subtree (512 nodes) at a time, whatever the size of the tree.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import lower_ascii
from ledgerlink.staging import stage

FANOUT = 8
# Levels from one stored level to the next.
STRIDE = 3


def combine(nodes: Iterable[bytes]) -> bytes:
    """The parent of some nodes: the hash of their digests written as hex."""
    return sha256(b"".join(n.hex().encode() for n in nodes)).digest()


def height(n: int) -> int:
    """Levels above ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def grow(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes and so many levels above them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([combine(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def subtree(nodes: list[bytes], place: int, stride: int) -> list[list[bytes]]:
    """All levels of an aligned subtree up to the next stored one, or to the root of a tree that ends before.

    Only the first subtree can be a whole tree. If others follow it, it is full.
    """
    return grow(nodes, stride if place else height(len(nodes)))


def paths_in(levels: list[list[bytes]]) -> Iterator[tuple[bytes, bytes]]:
    """(siblings, shape) of each lowest node, level by level, left to right.

    A level's shape is two bytes: the node's place in its run, and how long the run is.
    """
    for place in range(len(levels[0])):
        siblings, shape = [], bytearray()
        for level in levels[:-1]:
            run = place - place % FANOUT
            nodes = level[run : run + FANOUT]
            shape += bytes((place - run, len(nodes)))
            siblings += nodes[: place - run] + nodes[place - run + 1 :]
            place //= FANOUT
        yield b"".join(siblings), bytes(shape)


def fold(digest: bytes, proof: bytes, shape: bytes) -> bytes:
    """The root that a leaf's digest and its proof give."""
    at = 0
    for i in range(0, len(shape), 2):
        place, size = shape[i], shape[i + 1]
        run = [proof[at + 32 * k : at + 32 * (k + 1)] for k in range(size - 1)]
        run.insert(place, digest)
        digest, at = combine(run), at + 32 * (size - 1)
    return digest


@F.arrow_udf(T.BinaryType())
def folded_root(digest: pa.Array, proof: pa.Array, shape: pa.Array) -> pa.Array:
    """What a holder of a row's digest and proof computes; it needs nothing else."""
    made = zip(digest.to_pylist(), proof.to_pylist(), shape.to_pylist(), strict=True)
    return pa.array([fold(*one) for one in made], pa.binary())


def row_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as ``-`` if null, else its UTF-8 byte count, a colon and itself."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, values)), 256))


def numbered(rows: DataFrame, tree: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (staged) with ``pos``, their place in ``tree`` in ascending order; nulls come first.

    Sorted by ranges over the cluster; places are counted per range, so no task holds a tree. Where a range starts
    in its tree is a sum over ranges.
    """
    ranged = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    ranged = ranged.withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id())
    ranged = stage(ranged, name)
    before = Window.partitionBy("tree_").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(F.col("part").alias("part_"), F.col(tree).alias("tree_")).agg(
        F.count("*").alias("n"), F.min("seq").alias("first")
    )
    # One row per range and tree.
    base = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    sizes = sizes.select("part_", "tree_", base.alias("base"))
    meet = (F.col("part") == F.col("part_")) & F.col(tree).eqNullSafe(F.col("tree_"))
    pos = (F.col("seq") + F.col("base")).alias("pos")
    return ranged.join(sizes, meet).select(*rows.columns, pos)


def _subtrees(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, int, pa.StructArray]]:
    """Each row's other values, the place of its subtree, and the subtree's nodes."""
    for batch in batches:
        nodes = batch.column("nodes")
        rest = [c for c in batch.schema.names if c != "nodes"]
        for i in range(len(batch)):
            row = {c: batch.column(c)[i].as_py() for c in rest}
            start, end = nodes.offsets[i].as_py(), nodes.offsets[i + 1].as_py()
            yield row, row["sub"], nodes.values.slice(start, end - start)


def stored_levels(leaves: DataFrame, name: str, stride: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of every tree, lowest first, as aligned subtrees; and (tree, digest) of the roots.

    ``leaves`` has (tree, pos, digest) and any other columns, which stay with the lowest level.
    """
    schema = T.StructType(
        [leaves.schema["tree"], T.StructField("pos", T.LongType()), T.StructField("digest", T.BinaryType())]
    )

    def tops(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for _, place, nodes in _subtrees([batch.select(["sub", "nodes"])]):
                made.append(subtree(nodes.field("digest").to_pylist(), place, stride)[-1][0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("sub"), pa.array(made, pa.binary())], ["tree", "pos", "digest"]
            )

    levels, nodes = [], leaves
    while True:
        node = F.struct("pos", *[c for c in nodes.columns if c not in ("tree", "pos")])
        place = F.floor(F.col("pos") / FANOUT**stride).alias("sub")
        grouped = nodes.groupBy("tree", place).agg(F.sort_array(F.collect_list(node)).alias("nodes"))
        levels.append(stage(grouped, f"{name}_{len(levels)}"))
        nodes = stage(levels[-1].mapInArrow(tops, schema), f"{name}_tops_{len(levels)}")
        if nodes.filter("pos > 0").isEmpty():
            return levels, nodes.select("tree", "digest")


def extracted(levels: list[DataFrame], outer: DataFrame, stride: int) -> DataFrame:
    """Every leaf with ``proof`` and ``shape`` up to where ``outer``'s begin; ``outer`` has (tree, proof, shape) and
    what else is to stay with a tree. Subtrees are regenerated once each, from the top down."""
    rest = [c for c in outer.columns if c not in ("tree", "proof", "shape")]
    above = outer.withColumn("pos", F.lit(0).cast("long"))
    for level in reversed(levels):
        given = above.select(F.col("tree").alias("tree_"), F.col("pos").alias("sub_"), "proof", "shape", *rest)
        meet = F.col("tree").eqNullSafe(F.col("tree_")) & (F.col("sub") == F.col("sub_"))
        met = level.join(given, meet).drop("tree_", "sub_")
        node = level.schema["nodes"].dataType.elementType
        schema = T.StructType(
            [level.schema["tree"], *node.fields, *[outer.schema[c] for c in ("proof", "shape", *rest)]]
        )

        def extract(batches, schema=schema, node=node):
            from pyspark.sql.pandas.types import to_arrow_schema

            out = to_arrow_schema(schema)
            for row, place, nodes in _subtrees(batches):
                paths = paths_in(subtree(nodes.field("digest").to_pylist(), place, stride))
                columns = [pa.array([row["tree"]] * len(nodes), out.field(0).type)]
                columns += [nodes.field(f.name) for f in node.fields]
                proofs, shapes = zip(*paths, strict=True)
                columns.append(pa.array([p + row["proof"] for p in proofs], pa.binary()))
                columns.append(pa.array([s + row["shape"] for s in shapes], pa.binary()))
                columns += [pa.array([row[c]] * len(nodes), out.field(c).type) for c in rest]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, out, strict=True)], schema=out
                )

        above = met.mapInArrow(extract, schema)
        if level is not levels[0]:
            above = stage(above, "merkle_paths")
    return above


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    tree_col: str = "lang",
    carried: Mapping[str, Column] | None = None,
    stride: int = STRIDE,
) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): every row with its leaf, its tree's root, the dataset's root and its proof; and the roots by tree.

    A leaf is the digest of ``columns``. Per value of ``tree_col`` leaves stand in ascending order of id; the trees'
    roots, in bytewise order of that value, are the leaves of one more tree. Null ids and null groups come first. Rows
    with one id are ordered by leaf, and equal rows each have a leaf. Empty and very long texts are values like any
    other. An empty table gives no rows. Other columns are not looked at. ``proof`` holds the siblings' digests from
    leaf to root, ``shape`` the place and length of each run; ``folded_root`` needs only these and a digest. ``carried``
    names further values to keep with a row. Every ``stride``-th level is stored, which does not change the result.
    """
    kept = {f"carried_{c}": v for c, v in (carried or {}).items()}
    leaves = docs.select(
        docs[id_col].alias("id"),
        docs[tree_col].cast("string").alias("tree"),
        row_digest([docs[c] for c in columns]).alias("digest"),
        *[v.alias(c) for c, v in kept.items()],
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = stage(leaves, "merkle_leaves")
    # The row number spreads equal rows over ranges; it was written with them, so it does not change.
    placed = numbered(leaves, "tree", ["id", "digest", "row"], "merkle_ranked").drop("row")
    levels, roots = stored_levels(placed, "merkle", stride)
    # The trees' roots are leaves of one tree, whose own key is a constant.
    tops = stage(roots.select(F.lit(0).alias("all"), F.col("tree").alias("group"), "digest"), "merkle_roots")
    outer, whole = stored_levels(
        numbered(tops, "all", ["group"], "merkle_groups").withColumnRenamed("all", "tree"), "merkle_outer", stride
    )
    nothing = F.lit(b"")
    start = whole.select("tree", nothing.alias("proof"), nothing.alias("shape"), F.col("digest").alias("root"))
    groups = extracted(outer, start, stride)
    groups = stage(
        groups.select(F.col("group").alias("tree"), "proof", "shape", F.col("digest").alias("subroot"), "root"),
        "merkle_group_paths",
    )
    rows = extracted(levels, groups, stride).select(
        F.col("id").alias(id_col),
        F.col("tree").alias(tree_col),
        F.col("digest").alias("leaf"),
        *[F.col(f"carried_{c}").alias(c) for c in carried or {}],
        "proof",
        "shape",
        "subroot",
        "root",
    )
    return rows, groups.select(F.col("tree").alias(tree_col), "subroot", "root")


def merkle_audit(
    docs: DataFrame, every_nth: int = 3, text_col: str = "text", id_col: str = "doc_id", stride: int = STRIDE
) -> DataFrame:
    """Proofs checked against tampered rows: the text is lower-cased (A-Z) where ``every_nth`` divides the id's crc32.

    (id, leaf, subroot, root, proof_sha256, folded_root, verified), digests as lower-case hex. The first five are those
    of the untampered rows. Rows without an id are not tampered with, and a text without A-Z stays as it is and verifies.
    """
    columns = ("doc_id", "source", "lang", "n_chars", text_col)
    hit = F.crc32(docs[id_col].cast("string").cast("binary")) % every_nth == 0
    lowered = [F.expr(lower_ascii(f"`{c}`")) if c == text_col else docs[c] for c in columns]
    tampered = F.when(hit, row_digest(lowered))
    rows, _ = merkle_manifest(docs, columns, id_col, carried={"tampered": tampered}, stride=stride)

    def hexed(value: Column, name: str) -> Column:
        return F.lower(F.hex(value)).alias(name)

    rows = rows.withColumn("folded", folded_root(F.coalesce("tampered", "leaf"), "proof", "shape"))
    return rows.select(
        id_col,
        *[hexed(F.col(c), c) for c in ("leaf", "subroot", "root")],
        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
        hexed(F.col("folded"), "folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def merkle_sql(every_nth: int = 3) -> str:
    """DuckDB SQL over ``documents``: all levels of all trees at once, and each path folded step by step."""

    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # The checksum of the id's digits, byte by byte and bit by bit; its polynomial is a fixed value.
    step = "list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda a, b: {step}), 4294967295::BIGINT)"
    return f"""
WITH RECURSIVE raw AS (
    SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, {leaf('text')} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {crc} % {every_nth} = 0 THEN {leaf(lower)} END AS altered FROM documents
), leaves AS (
    SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS n FROM raw
), nodes AS (
    SELECT tree, 0 AS level, pos, n, leaf AS h FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY tree, level, n, pos // {FANOUT}
), subroots AS (
    SELECT tree, h, tree - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, pos, n, h FROM subroots
    UNION ALL
    SELECT level + 1, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' ORDER BY pos))
    FROM tops WHERE n > 1 GROUP BY level, n, pos // {FANOUT}
), runs AS (
    SELECT tree, level, pos // {FANOUT} AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
    UNION ALL
    SELECT 0, level, pos // {FANOUT}, list(h ORDER BY pos) FROM tops WHERE n > 1 GROUP BY ALL
), steps AS (
    SELECT l.row, r.level AS depth, l.pos // ({FANOUT}::BIGINT ** r.level)::BIGINT % {FANOUT} + 1 AS place, r.hs
    FROM leaves l JOIN runs r ON r.tree = l.tree AND r.run = l.pos // ({FANOUT}::BIGINT ** (r.level + 1))::BIGINT
    UNION ALL
    SELECT l.row, 1000 + r.level, (l.tree - 1) // ({FANOUT}::BIGINT ** r.level)::BIGINT % {FANOUT} + 1, r.hs
    FROM leaves l JOIN runs r ON r.tree = 0 AND r.run = (l.tree - 1) // ({FANOUT}::BIGINT ** (r.level + 1))::BIGINT
), paths AS (
    SELECT row, row_number() OVER (PARTITION BY row ORDER BY depth) AS step,
        array_to_string(hs[:place - 1], '') AS l, array_to_string(hs[place + 1:], '') AS r FROM steps
), folds AS (
    SELECT row, 0::BIGINT AS step, coalesce(altered, leaf) AS h FROM leaves
    UNION ALL
    SELECT f.row, p.step, sha256(p.l || f.h || p.r) FROM folds f JOIN paths p ON p.row = f.row AND p.step = f.step + 1
), folded AS (
    SELECT row, max_by(h, step) AS h FROM folds GROUP BY row
), proofs AS (
    SELECT row, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM paths GROUP BY row
), root AS (
    SELECT h FROM tops WHERE n = 1
)
SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
    f.h AS folded_root, f.h = root.h AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN folded f USING (row) LEFT JOIN proofs p USING (row), root
"""
