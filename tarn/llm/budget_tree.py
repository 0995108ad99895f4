"""Mixing sources to target weights by hierarchical budgeting.

Sources form a tree: domain, language, source. The token budget goes down from the root: at each node
it is shared among the children in proportion to their weights, none getting more than all its leaves
can give over the allowed epochs; what one child cannot use goes to its siblings, and only what all
of them cannot use stays with the parent's siblings. The fill level of a node has a closed form over its
children in the order of capacity by weight, so every level of the tree is one window over its nodes.

Each leaf then gives a prefix of its own seeded order, epoch by epoch: whole epochs, and of the last
one the documents before the budget is met. Prefix sums over a hot leaf never sit in one task: tokens
are first summed over ranges of the hash, so a leaf's window has at most 4,096 rows an epoch, and each
chosen range, a small part of the leaf, is sorted by itself to place its documents.

Tokens are words (runs without ASCII white space). Null language or source are nodes of their own;
documents without tokens, and rows without id, are never selected; a leaf without tokens gets nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import Scratch

RANGES = 4096  # hash ranges of a leaf
LEVELS = ["domain", "lang", "source"]


def token_count(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")


def default_domain(source: Column) -> Column:
    """Domain of a source by its number: five sources each; one for sources without a number."""
    n = F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d{1,9})$", 1)
    return F.when(n == "", "other").otherwise(F.concat(F.lit("domain"), F.floor(F.expr("try_cast(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) AS bigint)") / 5).cast("string")))


def fill(nodes: DataFrame, group: list[str], budget: str, weight: str, cap: str, tie: list[str]) -> Column:
    """Share of ``budget`` for each node among its siblings: min(cap, level * weight), summing to it."""
    by = Window.partitionBy(*group).orderBy(F.col(cap) / F.col(weight), *tie)
    before = F.coalesce(F.sum(cap).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(weight).over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.col(budget) - before) / rest
    full = level * F.col(weight) >= F.col(cap)
    open_level = F.max(F.when(~full, level)).over(Window.partitionBy(*group))
    return F.when(full, F.col(cap)).otherwise(F.least(F.col(cap), F.greatest(F.lit(0.0), open_level * F.col(weight))))


def budgets(leaves: DataFrame, total: float, weights: dict[str, dict[str, float]], epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with ``budget``; weights: level -> name -> weight, else 1."""
    by_leaf = leaves.select(*LEVELS, "tokens", (F.col("tokens") * epochs).cast("double").alias("cap"))

    def weight(level: str) -> Column:
        given = weights.get(level, {})
        pairs = [F.lit(x) for k, v in given.items() for x in (k, float(v))]
        return F.coalesce(F.create_map(*pairs)[F.coalesce(level, F.lit(""))], F.lit(1.0)) if pairs else F.lit(1.0)

    parent: DataFrame | None = None
    for depth, level in enumerate(LEVELS, 1):
        path = LEVELS[:depth]
        nodes = by_leaf.groupBy(*path).agg(F.sum("cap").alias("cap")).filter("cap > 0").withColumn("weight", weight(level))
        if parent is None:
            nodes = nodes.withColumn("above", F.lit(float(total))).withColumn("root", F.lit(0))
            group = ["root"]
        else:
            keys = LEVELS[: depth - 1]
            up = parent.select(*[F.col(c).alias(f"up_{c}") for c in keys], F.col("budget").alias("above"))
            on = [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in keys]
            nodes, group = nodes.join(up, on).drop(*[f"up_{c}" for c in keys]), keys
        parent = nodes.withColumn("budget", fill(nodes, group, "above", "weight", "cap", path)).select(*path, "weight", "cap", "budget")
    return parent


def mix(
    docs: DataFrame,
    total_tokens: int | None = None,
    share: float = 0.9,
    weights: dict[str, dict[str, float]] | None = None,
    epochs: int = 1,
    seed: int = 11,
    domain: Column | None = None,
) -> DataFrame:
    """(doc_id, domain, lang, source, epoch, n_tokens, start_token, budget): selected documents.

    total_tokens: the budget; by default ``share`` of all tokens. epochs: most times a document is
    used; each epoch has its own order. start_token: tokens of the leaf's epoch before the document.
    """
    tmp = Scratch(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), token_count(F.col("text").cast("string")).alias("n_tokens"))
    rows = tmp.put(src.withColumn("domain", default_domain(F.col("source")) if domain is None else domain).filter("doc_id is not null and n_tokens > 0"), "tokens")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    total = total_tokens if total_tokens is not None else share * (leaves.agg(F.sum("tokens")).first()[0] or 0)
    planned = tmp.put(budgets(leaves, float(total), weights or {}, epochs), "budgets")

    order = F.xxhash64(F.lit(seed), "epoch", "doc_id")
    dealt = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))) if epochs > 1 else rows.withColumn("epoch", F.lit(0))
    dealt = dealt.withColumn("order", order).withColumn("range", F.shiftrightunsigned("order", 52).cast("int"))
    names = [F.coalesce(c, F.lit("\0")).alias(f"k_{c}") for c in LEVELS]
    keys = [f"k_{c}" for c in LEVELS]
    sums = dealt.groupBy(*names, "epoch", "range").agg(F.sum("n_tokens").alias("in_range"))
    ahead = Window.partitionBy(*keys).orderBy("epoch", "range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "epoch", "range", "in_range", F.coalesce(F.sum("in_range").over(ahead), F.lit(0)).alias("base"))
    limits = planned.select(*names, F.floor("budget").alias("budget"))
    used = starts.join(limits, keys).filter("base < budget").withColumn("whole", F.col("base") + F.col("in_range") <= F.col("budget"))
    tagged = dealt.select("*", *names).join(used, [*keys, "epoch", "range"])
    within = Window.partitionBy(*keys, "epoch", "range").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    out = tagged.withColumn("start_token", at).filter(F.col("whole") | (F.col("start_token") + F.col("n_tokens") <= F.col("budget")))
    return out.select("doc_id", *LEVELS, "epoch", "n_tokens", "start_token", "budget")
