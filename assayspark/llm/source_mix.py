"""Mixing sources to target weights over a domain - language - source tree, by DataFrame operations only.

A token budget flows down the tree. Children share their parent's budget by weight; a child that cannot use its share
(its tokens times `epochs`) takes what it can, and its siblings share the rest by weight. A shortage reaches the
parent's own siblings only when the whole family is used up, since a family asks for no more than it can use.

A leaf's target is filled by whole epochs, then by a prefix of the next one. Each epoch has its own seeded order of the
leaf's documents, the order of md5(seed, epoch, doc_id), and the prefix is the longest one within the target. Its end is
found by sums over ever finer ranges of the order, so no task sorts a leaf however many rows it holds.

Null text has no tokens; null domains, languages and sources are values like others. Rows that repeat a doc_id (or
have none) in a leaf share one place in each order and go together. A leaf without tokens takes nothing. An empty table
gives an empty result; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from assayspark.session import settle

LEAF = ["domain", "language", "source"]


@dataclass(frozen=True)
class Plan:
    """share: the budget as a share of all tokens; weights: by level, whole numbers, 1 where none is given."""

    share: float = 0.8
    epochs: int = 2
    seed: str = "mix"
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    digits: int = 3  # of a place in hex: 4,096 ranges of a leaf, then 4,096 of the one that holds the end

    def weight(self, level: str) -> Column:
        out = F.lit(1.0)
        for name, w in self.weights.get(level, {}).items():
            out = F.when(F.col(level) == name, F.lit(float(w))).otherwise(out)
        return out


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def poured(children: DataFrame, parent: list[str], names: list[str], budget: str) -> DataFrame:
    """Share each parent's `budget` among its children by `weight`, none above its `cap`: adds `given`."""
    w = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ranked = w.orderBy(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).asc_nulls_last(), *names)
    rows = children.withColumns({
        "used": F.coalesce(F.sum("cap").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "left": F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing)),
    })
    full = (F.col("weight") > 0) & (F.col("cap") * F.col("left") <= (F.col(budget) - F.col("used")) * F.col("weight"))
    rows = rows.withColumn("full", full)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(w)
    spent = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(w)
    rows = rows.withColumns({"open_weight": open_weight, "spent": spent})
    part = (F.col(budget) - F.col("spent")) * F.col("weight") / F.col("open_weight")
    given = F.when(F.col("full"), F.col("cap")).when(F.col("open_weight") > 0, part).otherwise(0.0)
    return rows.withColumn("given", given).drop("used", "left", "full", "open_weight", "spent")


def targets(leaves: DataFrame, plan: Plan) -> DataFrame:
    """Add `target`, the tokens that each leaf is to give. leaves: domain, language, source, tokens."""
    total = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(plan.share)).cast("double").alias("budget"))
    rows = leaves.withColumn("cap", (F.col("tokens") * plan.epochs).cast("double"))
    for depth, level in enumerate(LEAF):
        above, names = LEAF[:depth], LEAF[: depth + 1]
        nodes = rows.groupBy(*names).agg(F.sum("cap").alias("cap")).withColumn("weight", plan.weight(level))
        if depth == 0:
            nodes = nodes.join(F.broadcast(total))  # one row
        else:
            nodes = nodes.alias("n").join(given.alias("g"), _same("n", "g", above)).select("n.*", F.col("g.given").alias("budget"))
        given = poured(nodes, above, names, "budget").select(*names, "given")
    return leaves.alias("n").join(given.alias("g"), _same("n", "g", LEAF)).select("n.*", F.floor("g.given").cast("long").alias("target"))


def _same(a: str, b: str, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def by_leaf(rows: DataFrame, leaves: DataFrame, most: int = 100_000, parts: int = 64) -> DataFrame:
    """Rows (as r) with their leaf (as l). At most `most` leaves, counted, are broadcast; more are joined with a leaf's rows in parts."""
    if leaves.limit(most + 1).count() <= most:
        return rows.alias("r").join(F.broadcast(leaves).alias("l"), _same("r", "l", LEAF))
    rows = rows.withColumn("part_", F.pmod(F.monotonically_increasing_id(), F.lit(parts)))
    leaves = leaves.withColumn("part_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return rows.alias("r").join(leaves.alias("l"), _same("r", "l", ["part_", *LEAF]))


def place(doc_id: Column, epoch: Column, seed: str) -> Column:
    """A document's place in the order of an epoch, as hex text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _range_with_end(rows: DataFrame, digits: int) -> DataFrame:
    """Per leaf, the range of the order in which its prefix ends, and the tokens before it. rows: leaf, place, tokens, rest."""
    sums = rows.groupBy(*LEAF, "rest", F.substring("place", 1, digits).alias("range")).agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("range"))
    after = sums.withColumn("upto", upto).where("upto > rest")
    return after.groupBy(*LEAF).agg(F.min("range").alias("range"), F.min(F.struct("range", (F.col("upto") - F.col("tokens")).alias("t")))["t"].alias("before"))


def cuts(rows: DataFrame, leaves: DataFrame, plan: Plan) -> DataFrame:
    """leaf, target, whole, cut: whole epochs of each leaf, and the last place of the next one that still belongs.

    rows: domain, language, source, doc_id, tokens.
    """
    goals = leaves.withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens"))).otherwise(0).cast("long"))
    # whole epochs by integers: a quotient of large numbers may round up
    goals = goals.withColumn("whole", F.col("whole") - (F.col("whole") * F.col("tokens") > F.col("target")).cast("long"))
    goals = settle(goals.withColumn("rest", F.col("target") - F.col("whole") * F.col("tokens")), "goals")
    part = goals.where("rest > 0").select(*LEAF, "whole", "rest")
    kept = [f"r.{c}" for c in (*LEAF, "doc_id", "tokens")]
    open_rows = by_leaf(rows, part).select(*kept, "l.rest", place(F.col("r.doc_id"), F.col("l.whole"), plan.seed).alias("place"))
    for digits in (plan.digits, 2 * plan.digits):
        ends = settle(_range_with_end(open_rows, digits), "ends")
        inside = F.substring("r.place", 1, digits) == F.col("l.range")
        open_rows = by_leaf(open_rows, ends).where(inside).select(*kept, "r.place", (F.col("r.rest") - F.col("l.before")).alias("rest"))
        open_rows = settle(open_rows, "open")  # the rows of one range of each leaf
    upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("place"))  # equal places count together
    last = open_rows.withColumn("upto", upto).where("upto <= rest").groupBy(*LEAF).agg(F.max("place").alias("last"))
    cut = ends.alias("b").join(last.alias("l"), _same("b", "l", LEAF), "left").select(*[f"b.{c}" for c in LEAF], F.coalesce("l.last", "b.range").alias("cut"))
    return goals.alias("g").join(cut.alias("c"), _same("g", "c", LEAF), "left").select(*[f"g.{c}" for c in LEAF], "g.target", "g.whole", "c.cut")


def copies(doc_id: Column, whole: Column, cut: Column, seed: str) -> Column:
    """How often a document is taken: its leaf's whole epochs, and once more if it lies in the prefix of the next."""
    return (whole + F.coalesce((place(doc_id, whole, seed) <= cut).cast("long"), F.lit(0))).alias("copies")


def plan_leaves(docs: DataFrame, domain: Column, language: Column, source: Column, doc_id: Column, text: Column, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """The narrow rows (leaf, doc_id, tokens) and the leaves with target, whole and cut. One pass over the texts."""
    rows = docs.select(domain.alias("domain"), language.alias("language"), source.alias("source"), doc_id.alias("doc_id"), n_words(text).alias("tokens"))
    rows = settle(rows, "tokens")
    leaves = settle(targets(rows.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens")), plan), "targets")
    return rows, cuts(rows, leaves, plan)


def decide(docs: DataFrame, domain: Column, language: Column, source: Column, doc_id: Column, text: Column, plan: Plan = Plan()) -> DataFrame:
    """doc_id, domain, language, source, n_tokens, target_tokens (of its leaf) and copies of every row."""
    rows, leaves = plan_leaves(docs, domain, language, source, doc_id, text, plan)
    return by_leaf(rows, settle(leaves, "cuts")).select(
        "r.doc_id", *[f"r.{c}" for c in LEAF], F.col("r.tokens").alias("n_tokens"), F.col("l.target").alias("target_tokens"),
        copies(F.col("r.doc_id"), F.col("l.whole"), F.col("l.cut"), plan.seed),
    )


def mixed(docs: DataFrame, domain: Column, language: Column, source: Column, doc_id: Column, text: Column, plan: Plan = Plan()) -> DataFrame:
    """The rows of the mixture, each as often as it is taken, with their own columns. Texts are not shuffled."""
    _, leaves = plan_leaves(docs, domain, language, source, doc_id, text, plan)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(own, domain.alias("domain"), language.alias("language"), source.alias("source"), doc_id.alias("doc_id"))
    rows = by_leaf(rows, settle(leaves, "cuts"))
    rows = rows.select("r.row", copies(F.col("r.doc_id"), F.col("l.whole"), F.col("l.cut"), plan.seed)).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
