"""Mixing sources to target weights by hierarchical budgeting (operator 8).

A token budget is handed down a tree of domains, languages and sources. At each node the children share the node's
budget in proportion to their weights, but no child gets more than its leaves can give (their tokens times the
epochs allowed). What a child cannot take goes to its siblings in proportion to their weights, until all of the
budget is placed or all are full; since a node's own share was bounded by what its leaves can give, a shortage only
reaches an ancestor's siblings when the siblings below are full.

The share at which a node's children fill up is found in closed form: in ascending order of capacity per weight, a
child is full if the budget covers it and everything smaller. Budgets are whole tokens, rounded down.

Each leaf then takes a prefix of its documents in a seeded random order, epoch after epoch, up to its budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prefix import running_sums
from .stage import Stage, text_or_empty

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"


def _share(children: DataFrame, parent: list[str], weight: str) -> DataFrame:
    """children: (parent..., own key, cap, weight, budget of the parent) -> with ``own`` (long), the child's budget."""
    exact = lambda e: F.expr(e).cast("decimal(38,0)")
    ws = Window.partitionBy(*parent)
    order = [(F.col("cap") / F.col(weight)).asc(), F.col("_key").asc()]
    upto = ws.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    c = (children.withColumn("_caps", F.sum("cap").over(upto)).withColumn("_ws", F.sum(weight).over(upto))
         .withColumn("_w", F.sum(weight).over(ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    # full: the budget covers all smaller children and this one's ratio for all others
    full = (exact("_caps") * exact(weight) + exact("cap") * exact("_w - _ws")) <= exact("budget") * exact(weight)
    c = c.withColumn("_full", full)
    every = ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    c = (c.withColumn("_taken", F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(every), F.lit(0)))
         .withColumn("_open", F.coalesce(F.sum(F.when(~F.col("_full"), F.col(weight))).over(every), F.lit(0))))
    part = F.expr(f"CASE WHEN _full THEN cap ELSE least(cap, CAST(CAST(budget - _taken AS DECIMAL(20,0)) * {weight} div _open AS BIGINT)) END")
    return c.withColumn("own", part.cast("long")).drop("_caps", "_ws", "_w", "_full", "_taken", "_open")


def budgets(leaves: DataFrame, budget: int, epochs: int = 1, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """``leaves`` (levels..., tokens long, w_<level> long > 0 for each) -> levels..., tokens, budget (long).

    ``w_<level>`` is the weight of the leaf's node at that level among its siblings. Leaves without a positive
    weight get nothing. The table has one row for each leaf that occurs.
    """
    tree = leaves.withColumn("cap", F.col("tokens") * epochs)
    for lv in levels:
        tree = tree.where(F.col(f"w_{lv}") > 0)
    given = None
    for i, lv in enumerate(levels):
        path, parent = list(levels[:i + 1]), list(levels[:i])
        nodes = tree.groupBy(*path).agg(F.sum("cap").alias("cap"), F.max(f"w_{lv}").alias("w")).withColumn("_key", F.col(lv))
        if given is None:
            nodes = nodes.withColumn("budget", F.least(F.lit(budget).cast("long"), F.sum("cap").over(Window.partitionBy())))
        else:
            nodes = nodes.join(given, parent)
        given = _share(nodes, parent, "w").select(*path, F.col("own").alias("budget"))
    return tree.select(*levels, "tokens").join(given, list(levels))


def mix(spark: SparkSession, docs: DataFrame, domain: Column, weights: dict[str, Column], percent: int,
        epochs: int = 1, seed: int = 1) -> DataFrame:
    """Select documents so that their word counts follow ``weights`` -> ``docs``' columns,
    ``_domain``, ``_lang``, ``_source``, ``_epoch``, ``_tokens``.

    docs: doc_id, text, lang, source and any others; ``domain`` maps a row to its domain; ``weights`` gives for each
    of domain, lang and source a positive whole number from those columns (0: nothing is taken); ``percent`` is the
    share of all words to take, at most 100 for each epoch. An order of a leaf in an epoch is that of the MD5 of seed, epoch
    and doc_id; documents are taken while fewer words than the budget stand before them.

    Null domain, lang and source are the name ''. Documents without words weigh nothing: they come along when the
    budget of their leaf is not yet reached. Rows that tie in doc_id are ordered by their words and a hash of the whole
    row; a null doc_id stands under that hash. Of equal rows as many are taken as the budget allows. Empty tables give
    an empty result.

    Texts are not shuffled: what a leaf takes of an epoch ends at one place of its order, and every row compares
    itself with the places of its leaf - a table of one row for each leaf and epoch.
    """
    st = Stage(spark, "mixing")
    words = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    name = {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}
    node = lambda lv: F.coalesce(name[lv].cast("string"), F.lit(""))
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    number = F.coalesce(F.col("doc_id").cast("long"), whole)
    rows = docs.select(number.alias("doc_id"), whole.alias("row"), *[node(lv).alias(lv) for lv in LEVELS], words.alias("tokens"))
    base = st.put("sizes", rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")))
    leaves = st.put("leaves", base.groupBy(*LEVELS).agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens")))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    tree = leaves.select("*", *[weights[lv].cast("long").alias(f"w_{lv}") for lv in LEVELS])
    plan = st.put("budgets", budgets(tree, total * percent // 100, epochs))
    leaf = F.concat_ws("\x1f", *LEVELS)
    queue = (base.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
             .select(leaf.alias("leaf"), "epoch", _place(seed, F.col("epoch"), F.col("doc_id")).alias("key"), "tokens", F.col("row").alias("same"), "copies",
                     (F.col("tokens") * F.col("copies")).alias("load")))
    placed, _ = running_sums(st, st.put("queue", queue), ["epoch", "key", "tokens", "same"], "load", group="leaf", name="order")
    # of the last rows of a leaf, those before which the budget is not reached
    fit = F.expr("if(tokens = 0, copies, least(copies, (budget - before + tokens - 1) div tokens))")
    ends = (placed.join(plan.select(leaf.alias("leaf"), "budget", *LEVELS), "leaf").where("before < budget")
            .groupBy(*LEVELS, "epoch").agg(F.max(F.struct("key", "tokens", "same", "copies", fit.alias("fit"))).alias("end")))
    ends = st.put("ends", ends)
    part = ends.where("end.fit < end.copies")
    mine = docs.select(F.struct(*docs.columns).alias("_doc"), *[node(lv).alias(f"_{lv}") for lv in LEVELS], words.alias("_tokens"), number.alias("_number"), whole.alias("_same"))
    st.drop("sizes", "queue", "order", "order-totals")

    def at_ends(e: DataFrame) -> DataFrame:
        e = e.select(*[F.col(lv).alias(f"_{lv}") for lv in LEVELS], F.col("epoch").alias("_epoch"),
                     F.struct("end.key", "end.tokens", "end.same").alias("_end"), F.col("end.fit").alias("_fit"), (F.col("end.fit") == F.col("end.copies")).alias("_all"))
        here = F.struct(_place(seed, F.col("_epoch"), F.col("_number")).alias("key"), F.col("_tokens").alias("tokens"), F.col("_same").alias("same"))
        return mine.join(e, [f"_{lv}" for lv in LEVELS]).withColumn("_here", here)
    out = ["_doc", *[f"_{lv}" for lv in LEVELS], "_epoch", "_tokens"]
    taken = at_ends(ends).where((F.col("_here") < F.col("_end")) | (F.col("_all") & (F.col("_here") == F.col("_end")))).select(*out)
    if not part.isEmpty():  # equal rows of which some are taken: one stands for them, combined before the shuffle
        split = (at_ends(part).where(F.col("_here") == F.col("_end")).groupBy(*[f"_{lv}" for lv in LEVELS], "_epoch", "_tokens")
                 .agg(F.first("_doc").alias("_doc"), F.first("_fit").alias("_fit")))
        taken = taken.unionByName(split.withColumn("_", F.explode(F.expr("sequence(1, CAST(_fit AS INT))"))).select(*out))
    return taken.select("_doc.*", *out[1:])


def _place(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed).cast("string"), epoch.cast("string"), doc_id.cast("string")).cast("binary"))
