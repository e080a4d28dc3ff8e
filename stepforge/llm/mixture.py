"""Mixing sources to target weights by hierarchical budgets; built-in functions only.

Documents hang on the leaves of a tree domain - language - source.  A budget of tokens
goes down the tree by integer weights.  A node can use at most ``max_epochs`` times the
tokens below it; what a node can't use goes to its siblings by their weights, and only
what all siblings together can't use is left to the level above.  (Budgets are shared
out from the top with the capacity of every subtree known, which is the same.)

A leaf takes its documents in seeded order, epoch after epoch: whole epochs while the
budget covers them, then the longest prefix of the next epoch that fits.  The running
sum is taken in two steps, over slots of the order and within a slot, so no task holds
a whole leaf.

Defined results: a null text has no tokens; a leaf without tokens gives no documents; null languages or sources are named
``(none)``; rows equal in id and text are one document; a null id sorts as ``null``;
ties in the order are settled by id and tokens; an empty table gives an empty table;
extra columns are kept by ``select`` and ignored by ``choose``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepforge.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
BUDGET_PERCENT = 60
MAX_EPOCHS = 2
SEED = 17


def domain_of(source: Column) -> Column:
    """Four domains by the number at the end of a source's name."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(number == "", "(none)").otherwise(F.concat(F.lit("d"), (number.try_cast("long") % 4).cast("string")))


def _weight(name: Column, weights: Mapping[str, int] | None) -> Column:
    out = F.lit(1).cast("long")
    for key, w in (weights or {}).items():
        if int(w) != w or w <= 0:
            raise ValueError(f"weight of {key} must be a positive integer")
        out = F.when(name == key, F.lit(int(w)).cast("long")).otherwise(out)
    return out


def _share(nodes: DataFrame, path: list[str], child: str, weights: Mapping[str, int] | None) -> DataFrame:
    """Budgets of the children of each parent: from (path, child, capacity, given) to (path, child, capacity, budget).

    ``given`` is the parent's budget.  Children are taken by capacity per weight: the
    first ones are filled up, the rest share what is left by weight.
    """
    weighted = nodes.withColumn("weight", _weight(F.col(child), weights))
    family = Window.partitionBy(*(path or [F.lit(0)]))
    line = family.orderBy(F.col("capacity") / F.col("weight"), child)
    left = F.col("given") - F.coalesce(F.sum("capacity").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing))
    full = weighted.withColumn("is_full", F.col("capacity") * open_weight <= F.col("weight") * left)
    rest = F.col("given") - F.coalesce(F.sum(F.when(F.col("is_full"), F.col("capacity"))).over(family), F.lit(0))
    free = F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(family)
    shared = full.withColumn("rest", rest).withColumn("free", free)
    budget = F.when(F.col("is_full"), F.col("capacity")).otherwise(F.expr("rest * weight div free"))
    return shared.select(*path, child, "capacity", budget.alias("budget"))


def budgets(leaves: DataFrame, percent: int, max_epochs: int, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Budget of every leaf.  ``leaves``: the levels and ``supply`` in tokens, one row per leaf of the tree."""
    shared = None
    for depth, child in enumerate(LEVELS):
        path = list(LEVELS[:depth])
        nodes = leaves.groupBy(*path, child).agg(F.sum("supply").alias("supply")).withColumn(
            "capacity", F.col("supply") * max_epochs
        )
        if shared is None:
            nodes = nodes.withColumn("all", F.sum("supply").over(Window.partitionBy(F.lit(0)))).withColumn(
                "given", F.expr(f"all * {int(percent)} div 100")
            )
        else:
            nodes = nodes.join(shared.select(*path, F.col("budget").alias("given")), path)
        shared = _share(nodes, path, child, weights.get(child))
    return shared


def _key(epoch: Column, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.substring(F.md5(text), 1, 16)


def choose(docs: DataFrame, percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
           weights: Mapping[str, Mapping[str, int]] | None = None, domain: Column | None = None) -> DataFrame:
    """Chosen documents, one row per epoch: doc_id, text_key, epoch, domain, lang, source, n_tokens, leaf_budget.

    The budget is ``percent`` of all tokens.  ``domain`` is an expression over the
    documents; ``domain_of(source)`` by default.
    """
    if weights is None:
        weights = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS}
    none = F.lit("(none)")
    sized = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64("text").alias("text_key"),
            F.coalesce(domain if domain is not None else domain_of(F.col("source")), none).alias("domain"),
            F.coalesce(F.col("lang").cast("string"), none).alias("lang"),
            F.coalesce(F.col("source").cast("string"), none).alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        ).dropDuplicates(["doc_id", "text_key"]),
        "sized",
    )
    leaves = materialize(sized.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply")), "leaves")
    given = budgets(leaves, percent, max_epochs, weights)
    plan = materialize(
        given.join(leaves, list(LEVELS)).where("supply > 0").select(
            *LEVELS, F.col("budget").alias("leaf_budget"), F.expr("budget div supply").alias("epochs"),
            (F.col("budget") % F.col("supply")).alias("over"),
        ),
        "plan",
    )
    planned = sized.join(plan, list(LEVELS))
    whole = planned.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
    last = planned.where("over > 0").withColumn("epoch", F.col("epochs")).withColumn("key", _key(F.col("epoch"), seed))
    last = last.withColumn("slot", F.substring("key", 1, 3))
    slots = last.groupBy(*LEVELS, "slot").agg(F.sum("n_tokens").alias("slot_tokens"))
    order = Window.partitionBy(*LEVELS).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = slots.select(*LEVELS, "slot", F.coalesce(F.sum("slot_tokens").over(order), F.lit(0)).alias("base"))
    within = Window.partitionBy(*LEVELS, "slot").orderBy("key", "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    prefix = (
        last.withColumn("sum_in_slot", F.sum("n_tokens").over(within))
        .join(bases, [*LEVELS, "slot"])
        .where(F.col("base") + F.col("sum_in_slot") <= F.col("over"))
    )
    columns = ["doc_id", "text_key", "epoch", *LEVELS, "n_tokens", "leaf_budget"]
    return whole.select(*columns).unionByName(prefix.select(*columns))


def select(docs: DataFrame, **options) -> DataFrame:
    """The chosen documents with their own columns, once for every epoch they are in."""
    chosen = choose(docs, **options).select(F.col("doc_id").alias("_id"), "text_key", "epoch")
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names))
    same = F.col(own["doc_id"]).cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(own["text"]) == F.col("text_key"))
    joined = docs.toDF(*names).join(chosen, same)
    return joined.dropDuplicates(["_id", "text_key", "epoch"]).select(*names).toDF(*docs.columns)


def _sql_weight(column: str, weights: Mapping[str, int]) -> str:
    if not weights:
        return "1"
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {w}" for k, w in weights.items()) + " ELSE 1 END"


def _sql_level(depth: int, weights: Mapping[str, Mapping[str, int]]) -> str:
    child, path = LEVELS[depth], ", ".join(LEVELS[:depth])
    own = f"{path}, {child}" if path else child
    family = f"PARTITION BY {path}" if path else ""
    over = f"JOIN (SELECT {path}, budget AS given FROM level{depth - 1}) p USING ({path})" if path else "JOIN total ON true"
    line = f"{family} ORDER BY capacity::DOUBLE / weight, {child}"
    return f"""
nodes{depth} AS (
  SELECT n.*, given, {_sql_weight(child, weights.get(child, {}))} AS weight
  FROM (SELECT {own}, sum(capacity)::BIGINT AS capacity FROM leaves GROUP BY {own}) n
  {over}),
full{depth} AS (
  SELECT *, capacity * sum(weight) OVER ({line} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= weight * (given -
    coalesce(sum(capacity) OVER ({line} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full FROM nodes{depth}),
level{depth} AS (
  SELECT {own}, capacity, (CASE WHEN is_full THEN capacity ELSE
    (given - coalesce(sum(capacity) FILTER (is_full) OVER ({family}), 0)) * weight
    // sum(weight) FILTER (NOT is_full) OVER ({family}) END)::BIGINT AS budget FROM full{depth})"""


def sql(percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """The rows of ``choose`` (without text_key) in SQL, for tables whose rows differ in doc_id."""
    weights = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS}
    number = "regexp_extract(source, '([0-9]{1,9})$', 1)"
    return f"""
WITH sized AS (
  SELECT doc_id,
    coalesce(CASE WHEN {number} = '' THEN '(none)' ELSE 'd' || (CAST({number} AS BIGINT) % 4) END, '(none)') AS domain,
    coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply, sum(n_tokens)::BIGINT * {max_epochs} AS capacity
  FROM sized GROUP BY ALL),
total AS (SELECT (coalesce(sum(supply), 0) * {percent} // 100)::BIGINT AS given FROM leaves),
{','.join(_sql_level(d, weights) for d in range(3))},
plan AS (SELECT domain, lang, source, budget AS leaf_budget, budget // supply AS epochs, budget % supply AS over_
  FROM level2 JOIN leaves USING (domain, lang, source) WHERE supply > 0),
planned AS (SELECT * FROM sized JOIN plan USING (domain, lang, source)),
whole AS (SELECT *, unnest(range(epochs)) AS epoch FROM planned),
ordered AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY
    substr(md5('{seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 16), doc_id, n_tokens
    ROWS UNBOUNDED PRECEDING) AS running FROM planned WHERE over_ > 0)
SELECT doc_id, epoch, domain, lang, source, n_tokens, leaf_budget FROM whole
UNION ALL SELECT doc_id, epochs, domain, lang, source, n_tokens, leaf_budget FROM ordered WHERE running <= over_"""
