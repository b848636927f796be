"""A Merkle manifest of a dataset: one tree per shelf of rows, and one over the shelves.

Every row is a leaf. Leaves of a shelf (here a language) stand in the order of their ids;
runs of ``ARITY`` neighbours become one node, level by level, until one is left. The
shelves' last nodes, in the order of the shelves' names, are the leaves of the tree over
them. Levels are built bottom up, each from the stored one below, and stored as rows that
name their parent.

A proof is read back by a recursive query: it climbs from parent to parent, notes the
siblings there and folds the hash that each leaf carries into the parent's, until a node
without parent is reached. The leaves of one run have the same way from there on, so they
climb in one row, each with its own hash. Nodes far up are met by many runs; they are
stored in up to ``COPIES`` copies, and the runs are dealt out over these by their place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.shared import ascii_lower, settle, shared_dir

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
#: Runs that meet at one copy of a node, and copies of a node far up.
SHARE, COPIES = ARITY**2, ARITY**3
#: Number of the tree over the shelves.
TOP = -1
_ROWS, _LEVELS = "spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit"


def encoded(value: Column) -> Column:
    """A value as its UTF-8 length, a colon and itself; a hyphen for NULL."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_hash(values: Sequence[Column]) -> Column:
    """SHA-256 of the encoded values, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(encoded, values)), 256))


def joint_hash(hashes: Column) -> Column:
    """SHA-256 of the hexadecimal text of 32-byte hashes, one after the other."""
    return F.unhex(F.sha2(F.lower(F.hex(hashes)), 256))


def _text(value: Column) -> Column:
    return F.lower(F.hex(value))


def numbered(rows: DataFrame, within: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their number, from 0, in ``order`` among those with equal ``within``,
    and ``<name>_of``, how many these are. NULLs come first and are equal.

    Rows are dealt out and sorted by range. A row's number is its place in its task, and
    what the tasks before hold of its group: no group has to fit into one task. ``order``
    should tell all rows apart, or equal ones stay together.
    """
    keys = [*within, *order]
    placed = settle(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    )
    task = F.shiftright("_at", 33).alias("_task")
    held = placed.groupBy(task, *within).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # One row for each task and group.
    groups = ", ".join(f"`{c}`" for c in within)
    part = f"PARTITION BY {groups}" if within else ""
    held = held.selectExpr(
        "*",
        f"sum(_n) OVER ({part} ORDER BY _task ROWS UNBOUNDED PRECEDING) - _n AS _before",
        f"sum(_n) OVER ({part}) AS `{name}_of`",
    )
    other = held.select(*(F.col(c).alias(f"_{k}") for k, c in enumerate(within)), "_task", "_first", "_before", f"{name}_of")
    same = F.shiftright(placed["_at"], 33) == other["_task"]
    for k, c in enumerate(within):
        same = same & placed[c].eqNullSafe(other[f"_{k}"])
    found = placed.join(other, same).withColumn(name, F.col("_at") - F.col("_first") + F.col("_before"))
    return found.select(*rows.columns, name, f"{name}_of")


def _link(nodes: DataFrame, shelves: int) -> DataFrame:
    """Nodes with their parent: in their tree, for a shelf's last one in the tree over all."""
    inside, above = F.col("n") > 1, (F.col("tree") != TOP) & F.lit(shelves > 1)

    def up(own: Column, shelf: Column) -> Column:
        return F.when(inside, own).when(above, shelf)

    return nodes.withColumns(
        {
            "up_tree": up(F.col("tree"), F.lit(TOP).cast("bigint")),
            "up_level": up(F.col("level") + 1, F.lit(1)),
            "up_idx": up(F.floor(F.col("idx") / ARITY), F.floor(F.col("tree") / ARITY)),
            "place": up(F.col("idx") % ARITY, F.col("tree") % ARITY).cast("int"),
        }
    )


def _next(n: Column) -> Column:
    """Nodes on the level above ``n`` of them."""
    return F.floor((n + (ARITY - 1)) / ARITY)


def _above(nodes: DataFrame) -> DataFrame:
    """The level above: every run of ``ARITY`` neighbours, its hashes in order as children."""
    up = nodes.filter("n > 1").groupBy("tree", F.floor(F.col("idx") / ARITY).alias("idx"))
    pairs = F.array_sort(F.collect_list(F.struct("idx", "hash")))
    runs = up.agg(
        F.aggregate(pairs, F.unhex(F.lit("")), lambda made, c: F.concat(made, c["hash"])).alias("children"),
        _next(F.max("n")).alias("n"),
    )
    return runs.select("tree", "idx", "n", joint_hash(F.col("children")).alias("hash"), "children")


def build(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs of leaves, and all nodes above them, stored.

    ``leaves`` has lang, doc_id, leaf and candidate, a hash to climb with (NULL: leaf);
    of rows equal in all the order doesn't matter. A run is the lowest node: tree, level,
    idx, hash and members, the leaves of the run in order; a shelf's lone leaf is a run
    at level 0 and its own hash. Runs and nodes are linked to their parent (up_tree,
    up_level, up_idx, and their place there); the root has none. tree is the number
    of the shelf by name, NULL first, or ``TOP``.
    """
    spark = leaves.sparkSession
    folder = shared_dir(spark, "merkle")
    # What equal rows are dealt out by; fixed by writing it.
    leaves = settle(leaves.withColumn("_row", F.monotonically_increasing_id()))
    ranked = numbered(leaves, ["lang"], ["doc_id", "leaf", "_row"], "idx")
    shelves = numbered(leaves.select("lang").distinct(), [], ["lang"], "tree")
    count = shelves.count()
    # A shelf is a short row, and with few shelves Spark sends them to the leaves.
    shelves = shelves.select(F.col("lang").alias("_lang"), "tree")
    placed = ranked.join(shelves, ranked["lang"].eqNullSafe(shelves["_lang"]))
    members = F.array_sort(F.collect_list(F.struct("idx", "doc_id", "leaf", "candidate")))
    runs = (
        placed.groupBy("tree", F.floor(F.col("idx") / ARITY).alias("idx"))
        .agg(members.alias("members"), F.max("idx_of").alias("of"))
        .withColumn("level", F.when(F.col("of") > 1, 1).otherwise(0))
        .withColumn("n", _next(F.col("of")))
        .withColumn("children", F.aggregate("members", F.unhex(F.lit("")), lambda made, m: F.concat(made, m["leaf"])))
        .withColumn("hash", F.when(F.col("of") > 1, joint_hash(F.col("children"))).otherwise(F.col("children")))
    )
    _link(runs.drop("of"), count).write.parquet(f"{folder}/runs")
    runs = spark.read.parquet(f"{folder}/runs")
    most = runs.agg(F.max("n")).first()[0] or 0

    def stored(nodes: DataFrame, level: int, path: str) -> DataFrame:
        linked = _link(nodes.withColumn("level", F.lit(level)), count)
        linked.write.parquet(f"{folder}/{path}{level}")
        return spark.read.parquet(f"{folder}/{path}{level}")

    at = runs.select("tree", "idx", "n", "hash")
    subroots, levels, level = at.filter("n = 1"), [], 1
    while most > 1:
        level, most = level + 1, -(-most // ARITY)
        at = stored(_above(at), level, "level")
        levels.append(at)
        subroots = subroots.unionByName(at.select(*subroots.columns).filter("n = 1"))
    at = subroots.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.lit(count).cast("bigint").alias("n"), "hash"
    )
    most, level = count, 0
    while most > 1:
        level, most = level + 1, -(-most // ARITY)
        at = stored(_above(at), level, "top")
        levels.append(at)
    if not levels:  # nothing, or one run
        empty = "tree bigint, idx bigint, n bigint, hash binary, children binary, level int"
        levels = [_link(spark.createDataFrame([], empty), count)]
    nodes = levels[0]
    for other in levels[1:]:
        nodes = nodes.unionByName(other)
    return runs, nodes


def _copies(tree: str, level: str) -> str:
    """Copies of a node: so many that few runs meet at one, ``COPIES`` at most."""
    power = f"CAST(pow({ARITY}, least({level}, 6) - 1) AS BIGINT) div {SHARE}"
    return f"if({tree} = {TOP}, {COPIES}, greatest(1, least({COPIES}, {power})))"


_PUT = "concat(substring({p}.children, 1, 32 * c.place), {hash}, substring({p}.children, 32 * c.place + 33))"
_CLIMB = f"""
WITH RECURSIVE climb(tree, idx, folded, members, reached, siblings, step, up_tree, up_level, up_idx, place) AS (
  SELECT tree, idx, folded, members, if(up_tree <=> tree, NULL, hash), CAST(NULL AS BINARY), 0,
    up_tree, up_level, up_idx, place FROM {{runs}}
  UNION ALL
  SELECT c.tree, c.idx,
    transform(c.folded, f -> unhex(sha2(lower(hex({_PUT.format(p="p", hash="f")})), 256))),
    NULL, if(p.up_tree <=> p.tree, NULL, p.hash), {_PUT.format(p="p", hash="unhex('')")}, c.step + 1,
    p.up_tree, p.up_level, p.up_idx, p.place
  FROM climb c JOIN {{nodes}} p ON p.tree = c.up_tree AND p.level = c.up_level AND p.idx = c.up_idx
    AND p.copy = c.idx % ({_copies("c.up_tree", "c.up_level")}))
SELECT tree, idx, members, reached, siblings, step, up_tree, if(up_tree IS NULL, folded, NULL) AS folded FROM climb
"""


def climb(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """For every leaf doc_id, leaf, subroot, root, proof_sha256 (of the siblings' hashes on
    the way up, left to right), and folded_root: the root that its candidate gives in the
    leaf's place. All as hexadecimal text."""
    spark = runs.sparkSession
    copies = F.sequence(F.lit(0).cast("bigint"), F.expr(f"CAST({_copies('tree', 'level')} AS BIGINT) - 1"))
    copied = nodes.withColumn("copy", F.explode(copies))
    # The first step needs no join: a run has its leaves.
    hash_of = "coalesce(m.candidate, m.leaf)"
    swapped = f"concat(substring(children, 1, 32 * k), {hash_of}, substring(children, 32 * k + 33))"
    start = runs.withColumn(
        "folded",
        F.expr(f"transform(members, (m, k) -> if(level = 0, {hash_of}, unhex(sha2(lower(hex({swapped})), 256))))"),
    )
    kept = {name: spark.conf.get(name, None) for name in (_ROWS, _LEVELS)}
    # All runs climb at once: their number is no sign of a query that never ends.
    spark.conf.set(_ROWS, "-1")
    spark.conf.set(_LEVELS, "100")
    try:
        steps = spark.sql(_CLIMB, runs=start, nodes=copied)
        ways = steps.groupBy("tree", "idx").agg(
            F.first("members", ignorenulls=True).alias("members"),
            F.first("folded", ignorenulls=True).alias("folded"),
            F.max_by("reached", F.when(F.col("up_tree").isNull(), 0)).alias("root"),
            F.min_by("reached", F.when(F.col("reached").isNotNull(), F.col("step"))).alias("subroot"),
            F.array_sort(F.collect_list(F.when(F.col("step") > 0, F.struct("step", "siblings")))).alias("way"),
        )
        above = F.aggregate("way", F.unhex(F.lit("")), lambda made, w: F.concat(made, w["siblings"]))
        every = ways.select(
            _text(F.col("root")).alias("root"),
            _text(F.col("subroot")).alias("subroot"),
            "folded",
            "members",
            above.alias("above"),
            F.posexplode("members").alias("at", "m"),
        )
        beside = F.aggregate(
            F.filter("members", lambda m, k: k != F.col("at")), F.unhex(F.lit("")), lambda made, m: F.concat(made, m["leaf"])
        )
        found = every.select(
            "m.doc_id",
            _text(F.col("m.leaf")).alias("leaf"),
            "subroot",
            "root",
            F.sha2(_text(F.concat(beside, "above")), 256).alias("proof_sha256"),
            _text(F.get("folded", F.col("at"))).alias("folded_root"),
        )
        return settle(found)  # computed here, while the session allows it
    finally:
        for name, value in kept.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def tampered(doc_id: Column) -> Column:
    """Rows that a test of the manifest changes: a third, by a checksum of the id. A row
    without id is left alone."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``FIELDS``): doc_id, leaf, subroot, root, proof_sha256,
    folded_root and verified.

    Hashes are SHA-256 as lower-case hex. folded_root is climbed from the leaf, or, for
    the rows of :func:`tampered`, from the leaf of the text in lower case (A-Z alone);
    verified says whether it is the root. NULL fields are hashed as such, an empty text
    differs from NULL; rows with NULL in lang form a shelf, NULL in doc_id comes first.
    Of rows with one doc_id the smaller leaf comes first; equal rows have equal leaves,
    each at its own place. A lone row is its own root, an empty table gives no rows.
    Long texts are hashed whole, where they are read; other columns are dropped.
    """
    plain = [F.col(name) for name in FIELDS]
    changed = [ascii_lower(F.col(name)) if name == "text" else F.col(name) for name in FIELDS]
    leaf = leaf_hash(plain)
    hashed = docs.select(
        "doc_id",
        "lang",
        leaf.alias("leaf"),
        F.when(tampered(F.col("doc_id")), leaf_hash(changed)).alias("candidate"),
    )
    found = climb(*build(hashed))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
