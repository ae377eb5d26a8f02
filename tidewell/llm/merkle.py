"""A Merkle manifest of a table: leaves, subroots by group, one root, and a proof for every row.

1. Every row becomes its leaf digest where it is read; texts go no further. Rows are placed by a range partitioning over
   (group, order), so a group that holds a third of all rows is spread over a third of the partitions.
2. Rows of a group stand in blocks of ``FANOUT ** HEIGHT`` places. Runs never cross a block, so a block is a window group of
   bounded size, and one shuffle and sort serve all its levels. Per level, lag and lead columns at fixed offsets, masked
   by the slot in the run and the run's length, are a node's siblings; the first child of a run hashes the parent.
3. Block roots, one row per block, climb in the same way until every group has one root. The roots of the groups are
   the rows of a last tree, in order of their groups.
4. Proofs come down: what a block root has met on its way joins its block by (group, block). No join gathers a group.

Defined results: a null value is ``-`` in a leaf, so null and empty texts differ; a null group is a group of its own and
comes first; null order values come first, ties go by the leaf, so equal rows are separate leaves in any order; a lone
row is its own subroot, a lone subroot the root, without siblings; an empty table gives an empty table. Other
columns of the input may have any name.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import written

FANOUT = 16
# Levels of a block: 4,096 places.
HEIGHT = 3
# Siblings on both sides of a node, one pair per level.
STEPS = "array<struct<left: string, right: string>>"


def digest(parts: Column) -> Column:
    return F.sha2(parts, 256)


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row's values, each with its length in bytes."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def folded(node: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, node, lambda below, step: digest(F.concat(step["left"], below, step["right"])))


def proof_digest(steps: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return digest(F.concat_ws("", F.transform(steps, lambda step: F.concat(step["left"], step["right"]))))


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by))


def placed(rows: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``_pos``, the place in the group from 0, and ``_n``, the size of the group.

    A range partitioning numbers the rows; one row per partition and group is summed up to place them.
    """
    numbered = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    numbered = written(numbered.withColumn("_at", F.monotonically_increasing_id()), "placed").withColumn("_part", F.shiftright("_at", 33))
    pieces = numbered.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    starts = pieces.select(
        group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(Window.partitionBy(group)).alias("_n")
    )
    return numbered.join(starts, [group, "_part"]).withColumn("_pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """Rows with ``_group, _pos, _n, _node``: plus ``_block``, ``_up`` (the block's root, in its first row) and ``_steps``."""
    block = Window.partitionBy("_group", "_block").orderBy("_pos")
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = nodes.withColumns({"_block": _div(F.col("_pos"), FANOUT**HEIGHT), "_up": F.col("_node"), "_steps": F.array().cast(STEPS)})
    for level in range(HEIGHT):
        # A node of this level stands in the first row below it; rows in between hold none.
        stride = FANOUT**level
        at, nodes_here = _div(F.col("_pos"), stride), _div(F.col("_n") + (stride - 1), stride)
        slot = at % FANOUT
        length = F.least(F.lit(FANOUT), nodes_here - (at - slot))
        before = {f"_b{k}": F.lag("_up", k * stride).over(block) for k in range(1, FANOUT)}
        after = {f"_a{k}": F.lead("_up", k * stride).over(block) for k in range(1, FANOUT)}
        left = F.concat_ws("", *[F.when(slot >= k, F.col(f"_b{k}")) for k in reversed(range(1, FANOUT))])
        right = F.concat_ws("", *[F.when(slot + k < length, F.col(f"_a{k}")) for k in range(1, FANOUT)])
        open_ = F.col("_n") > stride
        head = F.col("_pos") % stride == 0
        step = F.when(head & open_, F.struct(left.alias("left"), right.alias("right")))
        rows = rows.withColumns(before | after).withColumn("_step", step).drop(*before, *after)
        parent = F.when(open_, digest(F.concat("_up", "_step.right"))).otherwise(F.col("_up"))
        rows = rows.withColumn("_up", F.when(F.col("_pos") % (stride * FANOUT) == 0, parent))
        if level:
            rows = rows.withColumn("_step", F.last("_step", ignorenulls=True).over(upto))
        met = F.when(F.col("_step").isNull(), F.col("_steps")).otherwise(F.concat("_steps", F.array("_step")))
        rows = rows.withColumn("_steps", met).drop("_step")
    return rows


def _climbed(nodes: DataFrame, above: bool) -> DataFrame:
    """``nodes`` with ``_steps`` up to the root, ``_subroot`` and ``_root``; ``above`` adds the tree over the groups."""
    size = FANOUT**HEIGHT
    inside = _in_blocks(nodes)
    heads = inside.where(F.col("_pos") % size == 0)
    heads = heads.select("_group", F.col("_block").alias("_pos"), _div(F.col("_n") + (size - 1), size).alias("_n"), F.col("_up").alias("_node"))
    heads = written(heads, "heads")
    if not heads.where("_n > 1").isEmpty():
        ends = _climbed(heads, above).drop("_n", "_node")
    elif above:
        roots = placed(heads.select(F.lit("").alias("_all"), "_group", "_node"), "_all", [F.col("_group")])
        ends = _climbed(roots.select(F.col("_all").alias("_group"), "_pos", "_n", "_node", F.col("_group").alias("_of")), False)
        ends = ends.select(F.col("_of").alias("_group"), F.lit(0).cast("long").alias("_pos"), "_steps", F.col("_node").alias("_subroot"), "_root")
    else:
        ends = heads.select("_group", "_pos", F.array().cast(STEPS).alias("_steps"), F.lit(None).cast("string").alias("_subroot"), F.col("_node").alias("_root"))
    ends = ends.select("_group", F.col("_pos").alias("_block"), F.col("_steps").alias("_later"), "_subroot", "_root")
    own = inside.drop("_up").withColumnRenamed("_steps", "_own")
    joined = own.join(ends, ["_group", "_block"]).withColumn("_steps", F.concat("_own", "_later"))
    return joined.drop("_block", "_own", "_later")


def manifest(rows: DataFrame, group: str, order: Sequence[str], node: str) -> DataFrame:
    """``rows`` with ``steps`` (siblings from the leaf ``node`` to the root), ``subroot`` and ``root``, which replace columns
    of these names.

    Groups and ``order`` ascend by bytes or number, nulls first; a group's rows of equal order go by ``node``.
    """
    ordered = {f"_o{i}": F.col(c) for i, c in enumerate(order)}
    named = rows.select(
        F.struct("*").alias("_row"),
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("_group"),
        F.col(node).alias("_node"),
        *[c.alias(name) for name, c in ordered.items()],
    )
    done = _climbed(placed(named, "_group", [*[F.col(c).asc_nulls_first() for c in ordered], F.col("_node")]), above=True)
    own = {c: F.col(f"_row.`{c}`") for c in rows.columns}
    made = {"steps": F.col("_steps"), "subroot": F.col("_subroot"), "root": F.col("_root")}
    return done.select(*[v.alias(c) for c, v in ({k: v for k, v in own.items() if k not in made} | made).items()])


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def verified(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` (:data:`COLUMNS`) and what its proofs say about a copy with some texts altered."""
    values = [F.col(c) for c in COLUMNS]
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    leaves = docs.select(
        "doc_id", "source", leaf(values).alias("leaf"), F.when(altered, leaf([*values[:-1], lowered(values[-1])])).alias("altered")
    )
    done = manifest(written(leaves, "leaves"), "source", ["doc_id"], "leaf")
    found = done.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"),
        folded(F.coalesce("altered", "leaf"), F.col("steps")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_manifest(spark, folder: str) -> DataFrame:
    return verified(spark.read.parquet(f"{folder}/documents.parquet"))


# --- the same in SQL ----------------------------------------------------------------------------


def _tree(name: str, start: str, levels: int) -> str:
    """Levels 0 to ``levels`` of a forest: ``{name}0`` has ``grp, pos, node``; a lone node goes up as it is."""
    made = [f"{name}0 AS ({start})"]
    for level in range(levels):
        made.append(f"""{name}{level + 1} AS (
    SELECT grp, pos // {FANOUT} AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE any_value(node) END AS node,
        any_value(n) > 1 AS open, list(node ORDER BY pos) AS run
    FROM (SELECT *, COUNT(*) OVER (PARTITION BY grp) AS n FROM {name}{level}) GROUP BY grp, pos // {FANOUT})""")
    return ",\n".join(made)


def _climb(name: str, source: str, levels: int) -> str:
    """Proof text and folded digest of the rows of ``source`` (``grp, pos, proof, fold``), level by level."""
    made, last = [], source
    for level in range(levels):
        stride = FANOUT**level
        made.append(f"""{name}_at{level} AS (
    SELECT s.* EXCLUDE (proof, fold), CASE WHEN p.open THEN s.proof || left_ || right_ ELSE s.proof END AS proof,
        CASE WHEN p.open THEN sha256(left_ || s.fold || right_) ELSE s.fold END AS fold
    FROM {last} s JOIN (SELECT *, pos AS up FROM {name}{level + 1}) p ON p.grp = s.grp AND p.up = s.pos // {stride * FANOUT},
    LATERAL (SELECT s.pos // {stride} % {FANOUT} AS slot),
    LATERAL (SELECT array_to_string(p.run[1:slot], '') AS left_, array_to_string(p.run[slot + 2:], '') AS right_))""")
        last = f"{name}_at{level}"
    return ",\n".join(made)


def _leaf_sql(text: str) -> str:
    parts = [*[f"CAST({c} AS VARCHAR)" for c in COLUMNS[:-1]], text]
    return "sha256(" + " || ".join(f"CASE WHEN {p} IS NULL THEN '-' ELSE strlen({p}) || ':' || {p} END" for p in parts) + ")"


# CRC-32 of a decimal number, bit by bit: a byte is added, then eight shifts follow, each marked -1.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
    ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295::BIGINT)"""
# Levels that suffice for any table DuckDB reads in reasonable time.
_LEVELS, _TOP_LEVELS = 7, 5
OP13_SQL = f"""
WITH base AS (
    SELECT doc_id, COALESCE('=' || source, '') AS grp, {_leaf_sql("text")} AS leaf,
        CASE WHEN {_CRC} % 5 = 0 THEN {_leaf_sql(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} END AS altered
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM base
), {_tree("t", "SELECT grp, pos, leaf AS node FROM leaves", _LEVELS)},
{_tree("u", f"SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, node, grp AS part FROM t{_LEVELS}", _TOP_LEVELS)},
own AS (SELECT *, '' AS proof, COALESCE(altered, leaf) AS fold FROM leaves),
{_climb("t", "own", _LEVELS)},
upper_ AS (
    SELECT a.doc_id, a.leaf, a.proof, a.fold, u.grp, u.pos, u.node AS subroot FROM t_at{_LEVELS - 1} a JOIN u0 u ON u.part = a.grp
), {_climb("u", "upper_", _TOP_LEVELS)}
SELECT a.doc_id, a.leaf, a.subroot, r.node AS root, sha256(a.proof) AS proof_sha256, a.fold AS folded_root, a.fold = r.node AS verified
FROM u_at{_TOP_LEVELS - 1} a, u{_TOP_LEVELS} r
"""
