"""Merkle manifest of a table with a proof for every row (operator 11).

Every row is a leaf, the SHA-256 of its fields. The leaves of one group (a language) ascend by key and form a binary
tree; the groups' roots, in order of the group, form the last tree. Digests are concatenated as lower-case hex text.

1. Leaves are numbered within their group by written range partitions (:func:`prefix.running_sums`).
2. Trees are built ``SPAN`` levels at a time: 2 ** SPAN neighbouring nodes are gathered and give all nodes above them,
   so a table of 2 ** 32 leaves takes four shuffles, and each group of rows is bounded.
3. Proofs come from pointer jumping. A node holds a pointer, at first to its parent, and the segment of siblings up to
   it, at first its own. Each round joins the nodes with themselves: the pointer moves on to the pointer of the node it
   points to, and that node's segment is appended, so distances double. Only nodes whose level is a multiple of the
   new distance go on, so a round holds little more than the leaves. Rows that reach the root leave the rounds.

Segments are kept as binary digests with one letter a level for the side of the sibling: ``L``, ``R`` or ``-`` (none).
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .prefix import running_sums
from .stage import Stage

#: Levels built by one gathering.
SPAN = 8
#: Bytes of nodes that are sent to every executor as the pointed-to side of a join; beyond, the join shuffles.
BROADCAST_BYTES = 32 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*fields: Column) -> Column:
    """Hex SHA-256 over the fields in order: ``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    def coded(c):
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[coded(c) for c in fields]).cast("binary"), 256)


def fold(leaf: str, sides: str = "sides", siblings: str = "siblings") -> Column:
    """The root that a leaf and its proof give; names of columns."""
    sib = f"lower(hex(substring({siblings}, s.at * 32 + 1, 32)))"
    side = f"substring({sides}, i, 1)"
    return F.expr(f"""aggregate(slice(sequence(0, length({sides})), 2, length({sides})), named_struct('h', {leaf}, 'at', 0),
        (s, i) -> named_struct('h', sha2(CASE {side} WHEN '-' THEN s.h WHEN 'L' THEN concat({sib}, s.h) ELSE concat(s.h, {sib}) END, 256),
                               'at', s.at + if({side} = '-', 0, 1)), s -> s.h)""")


def _levels(n: int) -> int:
    """Levels above ``n`` leaves."""
    return ceil(log2(n)) if n > 1 else 0


def _build(st: Stage, leaves: DataFrame, most: int, name: str, payload: list[str]) -> DataFrame:
    """leaves: t, up (levels above the leaves of the tree), idx, h (hex), payload -> nodes: t, up, level, idx, h (of leaves
    and roots, else null), side (null: the root), sib (binary), payload (of leaves). ``most`` is the largest ``up``."""
    level, out = leaves.withColumn("level", F.lit(0)), []
    for p in range(most // SPAN + 1):
        kept = payload if p == 0 else []
        rows = (level.withColumn("chunk", F.expr(f"idx div {1 << SPAN}")).groupBy("t", "up", "chunk")
                .agg(F.sort_array(F.collect_list(F.struct("idx", "h", *kept))).alias("leaf")).withColumn("h0", F.expr("transform(leaf, x -> x.h)")))
        for j in range(SPAN):
            pair = f"transform(sequence(0, (size(h{j}) - 1) div 2), i -> sha2(concat(h{j}[2 * i], coalesce(get(h{j}, 2 * i + 1), '')), 256))"
            rows = rows.withColumn(f"h{j + 1}", F.expr(f"CASE WHEN up > {p * SPAN + j} THEN {pair} END"))

        def nodes(j):
            at = p * SPAN + j
            root = f"up = {at}"
            seen = "".join(f", '{c}', leaf[i].{c}" if j == 0 and kept else f", '{c}', CAST(NULL AS {kinds[c]})" for c in payload)
            h = "x" if j == 0 and p == 0 or j == SPAN else f"CASE WHEN {root} THEN x END"
            other = f"get(h{j}, i + 1 - 2 * (i % 2))"
            side = "CAST(NULL AS STRING)" if j == SPAN else f"CASE WHEN {root} THEN NULL WHEN i % 2 = 1 THEN 'L' WHEN {other} IS NULL THEN '-' ELSE 'R' END"
            return (f"transform(coalesce(h{j}, CAST(array() AS ARRAY<STRING>)), (x, i) -> named_struct('level', {at}, 'idx', chunk * {1 << (SPAN - j)} + i, "
                    f"'h', {h}, 'side', {side}, 'sib', unhex({other}){seen}))")
        kinds = dict(leaves.dtypes)
        flat = rows.select("t", "up", F.expr("inline(concat(" + ", ".join(nodes(j) for j in range(SPAN + 1)) + "))"))
        done = st.put(f"{name}-{p}", flat)
        out.append(done.where(F.col("level") < (p + 1) * SPAN))
        level = done.where(F.col("level") == (p + 1) * SPAN)  # roots at that level come back as a tree of one node
    whole = out[0]
    for d in out[1:]:
        whole = whole.unionByName(d)
    return whole


def merkle_proofs(spark: SparkSession, docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id",
                  also: dict[str, Column] | None = None) -> DataFrame:
    """A row for each row of ``docs``: ``key``, leaf, the columns of ``also``, subroot, root, sides and siblings (the proof,
    see :func:`fold`). Digests are hex text, ``siblings`` the binary digests one after the other, from the leaf up.

    ``also`` gives further strings of a row, such as the leaf of another version of it. Leaves ascend by key, nulls
    first; rows that tie in the key stand in order of the leaf, so equal rows are neighbours and all are leaves. Null
    is a group of its own, before the others, which are ordered by their UTF-8 bytes; the empty string is another. Null
    and empty fields give different leaves. A single row is leaf, subroot and root, with an empty proof. An empty
    table gives an empty result. Columns that are not named are ignored and may have any names.
    """
    also = also or {}
    st = Stage(spark, "merkle")
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    extra = {f"p{i}": c for i, c in enumerate(also.values())}
    rows = docs.select(tree.alias("tree"), F.col(key).alias("key"), leaf_digest(*[F.col(c) for c in fields]).alias("h"),
                       F.lit(1).cast("long").alias("one"), *[c.cast("string").alias(n) for n, c in extra.items()])
    placed, sums = running_sums(st, st.put("leaves", rows), ["key", "h"], "one", group="tree", name="order")
    trees, count = running_sums(st, st.put("groups", sums.select("tree", F.col("rows").alias("n"))), ["tree"], "n", name="tree-order")
    trees = st.put("trees", trees.select("tree", F.col("row").alias("t"), F.expr("CASE WHEN n > 1 THEN length(bin(n - 1)) ELSE 0 END").alias("up")))
    n_trees = trees.count()
    payload = ["key", *extra]
    numbered = placed.join(trees, "tree").select("t", "up", F.col("row").alias("idx"), "h", *payload)
    most = trees.agg(F.max("up")).first()[0] or 0
    nodes = _build(st, numbered, most, "nodes", payload)

    # the tree over the groups' roots
    roots = st.put("roots", nodes.where("side IS NULL").select("t", "up", F.col("h").alias("subroot")))
    above = _levels(n_trees)
    forest = _build(st, roots.select(F.lit(-1).cast("long").alias("t"), F.lit(above).alias("up"), F.col("t").alias("idx"), F.col("subroot").alias("h")),
                    above, "forest", [])
    root = forest.where("side IS NULL").select("h").first()
    root = root[0] if root else ""
    none = [F.lit(None).cast(numbered.schema[c].dataType).alias(c) for c in payload]

    def linked(df, more, last):
        """With pointer and segment; ``last`` tells that the parent is the root."""
        return df.select("t", "level", "idx", F.when(~last, F.col("t")).alias("pt"), F.when(~last, F.col("level") + 1).alias("pl"),
                         F.when(~last, F.expr("idx div 2")).alias("pi"), F.col("side").alias("sides"),
                         F.coalesce("sib", F.lit(b"")).alias("siblings"), *more)
    own = [F.when(F.col("level") == 0, F.col("h")).alias("leaf"), *payload]
    inner = linked(nodes.where("side IS NOT NULL"), own, (F.lit(n_trees) == 1) & (F.col("level") + 1 == F.col("up")))
    tops = (nodes.where("side IS NULL").select("t", "level", "idx", *own)
            .join(linked(forest.where("level = 0 AND side IS NOT NULL"), [], F.col("up") == 1)
                  .select(F.col("idx").alias("t"), "pt", "pl", "pi", "sides", "siblings"), "t")
            .select(*inner.columns))
    high = linked(forest.where("level > 0 AND side IS NOT NULL"), [F.lit(None).cast("string").alias("leaf"), *none], F.col("level") + 1 == F.col("up"))
    state = inner.unionByName(tops).unionByName(high)
    done = []
    if n_trees == 1 and most == 0:  # one row: leaf and root
        done.append(nodes.select("t", F.lit("").alias("sides"), F.lit(b"").alias("siblings"), *own))
    leaf = F.col("leaf").isNotNull()
    out = ["t", "sides", "siblings", "leaf", *payload]
    step, old = 1, None
    while step < most + above:
        state = st.put(f"jump-{step}", state)
        if old:
            st.drop(old)
        arrived = state.where("pt IS NULL")
        done.append(st.put(f"done-{step}", arrived.where(leaf).select(*out)))
        on = (F.col("level") % (2 * step) == 0) | (F.col("t") == -1)
        to = state.where(((F.col("level") % (2 * step) == step) | (F.col("t") == -1)) & ~leaf).select(
            F.col("t").alias("pt"), F.col("level").alias("pl"), F.col("idx").alias("pi"), F.col("pt").alias("qt"), F.col("pl").alias("ql"),
            F.col("pi").alias("qi"), F.col("sides").alias("s2"), F.col("siblings").alias("b2"))
        to = F.broadcast(to) if to.count() * (33 * step + 64) <= BROADCAST_BYTES else to
        moved = state.where(on & F.col("pt").isNotNull()).join(to, ["pt", "pl", "pi"]).select(
            "t", "level", "idx", F.col("qt").alias("pt"), F.col("ql").alias("pl"), F.col("qi").alias("pi"),
            F.concat("sides", "s2").alias("sides"), F.concat("siblings", "b2").alias("siblings"), "leaf", *payload)
        state, old, step = moved.unionByName(arrived.where(on & ~leaf)), f"jump-{step}", 2 * step
    done.append(state.where(leaf).select(*out))
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    return whole.join(roots, "t").select(F.col("key").alias(key), "leaf", *[F.col(n).alias(a) for n, a in zip(extra, also)], "subroot",
                                         F.lit(root).alias("root"), "sides", "siblings")
