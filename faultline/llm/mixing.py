"""Mixing sources to target weights by hierarchical token budgets, in DataFrame functions only.

Documents are leaves of a tree domain - language - source.  A token budget is handed down the tree
in proportion to weights.  A child never gets more than its subtree can supply in the allowed
epochs; what it cannot use goes to its siblings in proportion to their weights, and only what all
siblings cannot use is missing from the parent, which is capped in the same way one level above.
A leaf repeats its documents in whole epochs and takes the rest of its budget from the beginning
of one more epoch: documents in seeded order, the last of them cut to the tokens still needed.

Tokens are words between blanks.  All budget arithmetic is exact.

Defined cases: a null domain, language or source is the child ``(none)``; a null or blank text has
no tokens and is never taken; rows with one doc_id are separate rows; a budget above the supply
takes everything ``max_epochs`` times; further columns of the documents are kept, those named like
the result's own are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.common import stored

LEVELS = ("domain", "language", "origin")
# Three hexadecimal digits of the order key: a leaf is searched in 4,096 slices.
SLICE_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Recipe:
    """Target weights (integers; a name that is not listed has weight 1), the budget as a share of
    all tokens, and how often a document may be used."""

    domain: str = (
        "CASE WHEN source = 'src0' THEN 'web' WHEN source RLIKE '^src[1-9]$' THEN 'books'"
        " WHEN source RLIKE '^src[0-9]+$' THEN 'reference' END"
    )
    weights: dict[str, dict[str, int]] = field(
        default_factory=lambda: {
            "domain": {"web": 3, "books": 4, "reference": 3},
            "language": {"en": 5, "de": 2, "fr": 2, "es": 2},
            "origin": {},
        }
    )
    share: tuple[int, int] = (7, 10)
    max_epochs: int = 2
    seed: int = 11

    def __hash__(self):
        return id(self)


def counted(docs: DataFrame, recipe: Recipe) -> DataFrame:
    """The document as a struct, its place in the tree and its tokens."""
    named = [F.expr(recipe.domain), F.col("lang"), F.col("source")]
    return docs.select(
        F.struct("*").alias("document"),
        F.col("doc_id").alias("id"),
        *[F.coalesce(column, F.lit("(none)")).alias(level) for column, level in zip(named, LEVELS)],
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("tokens"),
    )


def _weight(level: str, recipe: Recipe) -> Column:
    chosen = F.lit(1)
    for name, weight in recipe.weights.get(level, {}).items():
        chosen = F.when(F.col(level) == name, F.lit(weight)).otherwise(chosen)
    return chosen.cast("decimal(12,0)")


def _share_out(children: DataFrame, parents: list[str], level: str, recipe: Recipe) -> DataFrame:
    """Adds ``budget``: the parent's ``parent_budget`` by weight, no child above its ``cap``.

    Sorted by cap per weight, the children that are filled come first.  Behind them, what is left
    is divided by weight; differences of rounded running shares add up exactly.
    """
    if parents:
        order = Window.partitionBy(*parents)
    else:
        order = Window.partitionBy(F.lit(1))
    ordered = order.orderBy(F.col("cap").cast("double") / F.col("weight").cast("double"), level)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("decimal(20,0)")
    frame = children.withColumn("weight", _weight(level, recipe)).withColumns(
        {
            "used": F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("decimal(20,0)"),
            "heavier": (F.sum("weight").over(order) - F.coalesce(F.sum("weight").over(before), zero)).cast("decimal(14,0)"),
            "running": F.sum("weight").over(upto).cast("decimal(14,0)"),
        }
    )
    left = F.col("parent_budget").cast("decimal(20,0)") - F.col("used")
    frame = frame.withColumn("filled", F.col("cap").cast("decimal(20,0)") * F.col("heavier") <= left * F.col("weight"))
    first = F.min(F.when(~F.col("filled"), F.struct(F.col("used"), F.col("running") - F.col("weight"), F.col("heavier"))))
    frame = frame.withColumn("open", first.over(order))
    rest = (F.col("parent_budget").cast("decimal(20,0)") - F.col("open.used")).cast("decimal(20,0)")
    at = F.expr("cast(running - open.col2 AS decimal(14,0))")
    return frame.withColumns({"_rest": rest, "_at": at, "_all": F.col("open.heavier")}).withColumn(
        "budget",
        F.expr(
            "CASE WHEN filled THEN cap ELSE cast((_rest * _at) div _all AS bigint)"
            " - cast((_rest * cast(_at - weight AS decimal(14,0))) div _all AS bigint) END"
        ),
    )


def leaf_budgets(leaves: DataFrame, recipe: Recipe, budget: int | None = None) -> DataFrame:
    """Budget of each leaf from leaves with ``supply`` tokens: supply, budget, epochs and rest."""
    tree = [leaves.withColumn("cap", F.col("supply") * recipe.max_epochs)]
    for depth in (2, 1):
        sums = [F.sum(name).cast("long").alias(name) for name in ("supply", "cap")]
        tree.insert(0, tree[0].groupBy(*LEVELS[:depth]).agg(*sums))
    supply = F.sum("supply").over(Window.partitionBy(F.lit(1)))
    share = (supply.cast("decimal(20,0)") * recipe.share[0], F.lit(recipe.share[1]))
    total = F.lit(budget) if budget is not None else F.floor(share[0] / share[1])
    level = _share_out(tree[0].withColumn("parent_budget", total.cast("long")), [], LEVELS[0], recipe)
    for depth in (2, 3):
        parents = list(LEVELS[: depth - 1])
        above = level.select(*parents, F.col("budget").cast("long").alias("parent_budget"))
        level = _share_out(tree[depth - 1].join(above, parents), parents, LEVELS[depth - 1], recipe)
    return level.select(
        *LEVELS,
        "supply",
        F.col("budget").cast("long").alias("budget"),
        F.expr("cast(budget div supply AS int)").alias("epochs"),
        F.expr("cast(budget % supply AS bigint)").alias("rest"),
    )


def _order_key(recipe: Recipe) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(recipe.seed)), F.col("epochs").cast("string"), F.col("id").cast("string")))


def budget_plan(counts: DataFrame, recipe: Recipe, budget: int | None = None) -> DataFrame:
    """One stored row per leaf: its budget and where its last, partial epoch ends.

    ``counts`` holds the tree levels, id and tokens.  The tokens of each slice of the order give
    the slice in which the budget ends (``cut``) and the tokens before it (``ahead``).
    """
    leaves = counts.filter("tokens > 0").groupBy(*LEVELS).agg(F.sum("tokens").cast("long").alias("supply"))
    plan = stored(leaf_budgets(leaves, recipe, budget), "leaves")
    slices = (
        counts.join(plan.filter("rest > 0"), list(LEVELS))
        .withColumn("slice", F.substring(_order_key(recipe), 1, SLICE_DIGITS))
        .groupBy(*LEVELS, "rest", "slice")
        .agg(F.sum("tokens").cast("long").alias("tokens"))
    )
    ordered = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        slices.withColumn("through", F.sum("tokens").over(ordered))
        .filter("through >= rest")
        .groupBy(*LEVELS)
        .agg(F.min("slice").alias("cut"), F.min(F.col("through") - F.col("tokens")).cast("long").alias("ahead"))
    )
    return stored(plan.join(ends, list(LEVELS), "left"), "plan")


def take(counts: DataFrame, plan: DataFrame, recipe: Recipe, carried: list[str]) -> DataFrame:
    """The taken rows with the ``carried`` columns, ``epoch`` and ``taken`` tokens.

    Rows meet the leaf table (one row per leaf, a bounded tree) and nothing else; only the rows of
    the slice in which a leaf's budget ends are ordered.
    """
    rows = counts.filter("tokens > 0").join(plan, list(LEVELS))
    result = [*carried, *LEVELS, "tokens", "epoch", "taken"]
    whole = (
        rows.filter("epochs > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
        .withColumn("taken", F.col("tokens"))
        .select(*result)
    )
    last = rows.filter("rest > 0").withColumn("key", _order_key(recipe)).withColumn(
        "slice", F.substring("key", 1, SLICE_DIGITS)
    )
    early = last.filter("slice < cut").withColumn("epoch", F.col("epochs")).withColumn("taken", F.col("tokens"))
    before = Window.partitionBy(*LEVELS).orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    ending = (
        last.filter("slice = cut")
        .withColumn("epoch", F.col("epochs"))
        .withColumn("still", F.col("rest") - F.col("ahead") - F.coalesce(F.sum("tokens").over(before), F.lit(0)))
        .filter("still > 0")
        .withColumn("taken", F.least("tokens", "still"))
    )
    return whole.union(early.select(*result)).union(ending.select(*result))


def mixture(docs: DataFrame, recipe: Recipe = Recipe(), budget: int | None = None) -> DataFrame:
    """What is taken: doc_id, domain, language, origin, tokens, epoch (int) and taken (long)."""
    counts = stored(counted(docs, recipe).drop("document"), "tokens")
    return take(counts, budget_plan(counts, recipe, budget), recipe, ["id"]).withColumnRenamed("id", "doc_id")


def mixed_documents(docs: DataFrame, recipe: Recipe = Recipe(), budget: int | None = None) -> DataFrame:
    """The mixture as documents with the same columns: one row per use, a cut text is the first
    ``taken`` words joined by spaces, ``n_chars`` follows the text."""
    rows = counted(docs, recipe)
    counts = stored(rows.drop("document"), "tokens")
    taken = take(rows, budget_plan(counts, recipe, budget), recipe, ["document"])
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all("document.text", F.lit(f"({WORD})")), 1, F.col("taken").cast("int")))
    text = F.when(F.col("taken") < F.col("tokens"), cut).otherwise(F.col("document.text"))
    shown = {"text": text, "n_chars": F.length("text").cast("long")}
    flat = taken.withColumn("text", text)
    return flat.select(
        *[shown["n_chars"].alias(c) if c == "n_chars" else F.col("text") if c == "text" else F.col(f"document.`{c}`").alias(c)
          for c in docs.columns]
    )
