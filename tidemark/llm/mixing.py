"""Mixing sources to target weights by hierarchical budgeting.

The tree's levels are columns of the documents (here domain, language,
source).  A node's capacity is its leaves' tokens times ``max_epochs``.  From
the root down, a node's budget is split among its children in proportion to
their weights; a child that can't use its share is filled, and what it leaves
goes to its siblings.  As capacities are those of whole subtrees, a shortage
goes to a more distant branch only if all siblings are full.  Budgets are whole
tokens: shares are rounded down, so at most a token for each child stays unused.

A leaf with a budget of B tokens takes its documents in a seeded order, epoch
after epoch (each epoch has an order of its own), as long as the running total
before a document is under B: the shortest prefix that reaches the budget.

The split is done by windows over siblings, whose number is that of distinct
sources, not of documents.  Prefixes are found without a window over a whole
leaf: totals of hash ranges of about ``range_rows`` documents give each range's
offset, and only the one range in which a budget ends is ordered by row.

Edge cases: a null level value is the name '(null)'; a null or empty text has
no tokens and is never taken; a missing weight is 1, a null or negative one 0;
repeated rows count each and may be taken each; a budget beyond all capacity
takes every epoch; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fingerprint, stored

EPOCHS = 2


def tokens(text: Column) -> Column:
    """Words of the text: maximal runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def domain(source: Column) -> Column:
    """A domain for sources that have none: sources are dealt to four domains by
    the number in their names."""
    return F.concat(F.lit("d"), (F.coalesce(F.regexp_extract(source, "([0-9]+)", 1).try_cast("long"), F.lit(0)) % 4).cast("string"))


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, DataFrame], total: Column) -> DataFrame:
    """``leaves`` (levels..., tokens, cap) with a column ``budget``.

    ``weights`` has, by level, frames of that level's column and ``weight``;
    ``total`` is the root's budget, an expression on the capacity ``cap``.
    """
    root = leaves.groupBy().agg(F.coalesce(F.sum("cap"), F.lit(0)).cast("long").alias("cap"))
    tree = F.lit(root.select(F.least(total.cast("long"), "cap").alias("budget")).first()[0])
    for d in range(1, len(levels) + 1):
        path, up = levels[:d], levels[:d - 1]
        kids = leaves.groupBy(*path).agg(F.sum("cap").cast("long").alias("cap"))
        w = weights.get(levels[d - 1])
        if w is not None:
            w = w.groupBy(levels[d - 1]).agg(F.max(F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))).alias("w"))
            kids = kids.join(w, levels[d - 1], "left").withColumn("w", F.coalesce("w", F.lit(1.0)))
        else:
            kids = kids.withColumn("w", F.lit(1.0))
        kids = kids.join(tree, up) if up else kids.withColumn("budget", tree)
        # Children by the level at which they are full: those before are full,
        # the rest share what remains by weight.
        full_at = F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(F.lit(float("inf")))
        kids = kids.withColumn("full_at", full_at)
        order = Window.partitionBy(*up).orderBy("full_at", path[-1])
        sofar, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
        kids = (kids.withColumn("caps", F.sum("cap").over(sofar)).withColumn("ws", F.sum("w").over(after))
                .withColumn("is_full", (F.col("w") > 0) & (F.col("caps") - F.col("cap") + F.col("full_at") * F.col("ws") <= F.col("budget"))))
        all_ = Window.partitionBy(*up)
        used = F.coalesce(F.sum(F.when(F.col("is_full"), F.col("cap"))).over(all_), F.lit(0))
        open_ = F.sum(F.when(~F.col("is_full"), F.col("w")).otherwise(0.0)).over(all_)
        share = F.when(F.col("is_full"), F.col("cap")).when(open_ > 0, F.floor((F.col("budget") - used) * F.col("w") / open_)).otherwise(F.lit(0))
        tree = kids.withColumn("_b", F.least(share.cast("long"), "cap")).select(*path, F.col("_b").alias("budget"))
    return leaves.join(tree, levels)


def select_prefix(docs: DataFrame, leaves: DataFrame, levels: list[str], key: list[Column], seed: int, epochs: int, range_rows: int = 4096) -> DataFrame:
    """(docs columns, epoch, tokens_before) of the documents that fill each
    leaf's budget; ``docs`` has the levels and ``n_tokens``."""
    each = docs.join(leaves.select(*levels, "budget", "total", "n"), levels)
    # Whole epochs are taken outright; one more may be taken in part.
    per = [F.greatest(F.lit(0).cast("long"), F.least(F.col("budget") - F.lit(e) * F.col("total"), "total")) for e in range(epochs)]
    each = (each.where("total > 0 and n_tokens > 0").withColumn("_per", F.array(*[F.struct(F.lit(e).alias("epoch"), p.alias("want")) for e, p in enumerate(per)]))
            .withColumn("_e", F.explode(F.filter("_per", lambda x: x.want > 0))).withColumn("epoch", F.col("_e.epoch")).withColumn("_want", F.col("_e.want")))
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), *[k.cast("string") for k in key]).cast("binary"))
    at = F.conv(F.substring("_draw", 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    each = each.withColumn("_draw", draw).withColumn("_range", F.floor(at * F.ceil(F.col("n") / range_rows)).cast("long"))
    leaf = [*levels, "epoch"]
    sums = each.groupBy(*leaf, "_range").agg(F.sum("n_tokens").alias("_in"))
    before = Window.partitionBy(*leaf).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0).cast("long")))
    each = each.join(sums, [*leaf, "_range"]).where("_before < _want")
    ties = [c for c in docs.columns if c not in levels]
    within = Window.partitionBy(*leaf, "_range").orderBy("_draw", *ties).rowsBetween(Window.unboundedPreceding, -1)
    run = each.withColumn("tokens_before", F.col("_before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0).cast("long")))
    return run.where("tokens_before < _want").select(*docs.columns, "epoch", "tokens_before")


def mix(docs: DataFrame, levels: list[str], weights: dict[str, DataFrame], fraction: float = 0.5, epochs: int = EPOCHS, seed: int = 11,
        key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` (levels, ``key``, ``n_tokens``, ...) chosen for a budget
    of ``fraction`` of all tokens, with ``epoch`` and ``tokens_before``."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("(null)")).alias(c) if c in levels else F.col(c) for c in docs.columns])
    sizes = docs.groupBy(*levels).agg(F.sum("n_tokens").cast("long").alias("total"), F.count("*").alias("n"))
    leaves = stored(sizes.withColumn("cap", F.col("total") * epochs))
    got = stored(budgets(leaves, levels, weights, F.floor(F.col("cap") * F.lit(fraction) / epochs)))
    return select_prefix(docs, got, levels, [F.col(key)], seed, epochs)


def weight_rows(spark, name: str, weights: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(list(weights.items()), f"{name} string, weight double")


def oracle_sql(fraction: float = 0.5, epochs: int = EPOCHS, seed: int = 11, source: str = "documents", columns: str = "") -> str:
    """DuckDB SQL for the rows of ``production``, over the relation ``source``."""
    case = lambda c, w: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in w.items()) + " ELSE 1.0::DOUBLE END"
    ctes = [f"""src AS (SELECT 'd' || CAST(coalesce(try_cast(nullif(regexp_extract(source, '([0-9]+)', 1), '') AS BIGINT), 0) % 4 AS VARCHAR) AS domain,
      coalesce(lang, '(null)') AS lang, coalesce(source, '(null)') AS source, doc_id,
      coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0)::BIGINT AS n_tokens{columns} FROM {source})""",
            f"""leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS total, sum(n_tokens)::BIGINT * {epochs} AS cap FROM src GROUP BY ALL)""",
            f"""t0 AS (SELECT least(floor(sum(cap) * {fraction}::DOUBLE / {epochs})::BIGINT, sum(cap)::BIGINT) AS budget FROM leaves)"""]
    weights = {"domain": case("domain", DOMAIN_WEIGHTS), "lang": case("lang", LANG_WEIGHTS), "source": "1.0::DOUBLE"}
    for d in range(1, len(LEVELS) + 1):
        path, up, own = ", ".join(LEVELS[:d]), ", ".join(LEVELS[:d - 1]), LEVELS[d - 1]
        by = f"PARTITION BY {up}" if up else ""
        join = f"JOIN t{d - 1} USING ({up})" if up else "CROSS JOIN t0"
        ctes += [f"""k{d} AS (SELECT {path}, sum(cap)::BIGINT AS cap, {weights[own]} AS w FROM leaves GROUP BY {path})""",
                 f"""f{d} AS (SELECT *, sum(cap) OVER ({by} ORDER BY cap / w, {own} ROWS UNBOUNDED PRECEDING) AS caps,
      sum(w) OVER ({by} ORDER BY cap / w, {own} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM k{d} {join})""",
                 f"""g{d} AS (SELECT *, caps - cap + cap / w * ws <= budget AS is_full FROM f{d})""",
                 f"""t{d} AS (SELECT {path}, least((CASE WHEN is_full THEN cap ELSE
      floor((budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({by}), 0)) * w / sum(CASE WHEN is_full THEN 0.0::DOUBLE ELSE w END) OVER ({by})) END)::BIGINT, cap) AS budget FROM g{d})"""]
    ctes += [f"""per AS (SELECT src.*, e.epoch, greatest(0, least(budget - e.epoch * total, total)) AS want
      FROM src JOIN leaves USING (domain, lang, source) JOIN t3 USING (domain, lang, source), (SELECT unnest(range({epochs}))::INTEGER AS epoch) e WHERE n_tokens > 0)""",
             f"""runs AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch
      ORDER BY md5('{seed}:' || epoch || ':' || doc_id) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS tokens_before FROM per WHERE want > 0)"""]
    return "WITH " + ",\n".join(ctes) + "\nSELECT * EXCLUDE (want) FROM runs WHERE tokens_before < want"


LEVELS = ["domain", "lang", "source"]
DOMAIN_WEIGHTS = {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}
LANG_WEIGHTS = {"en": 5.0, "de": 3.0, "fr": 2.0, "es": 2.0}


def production(spark, docs: DataFrame, fraction: float = 0.5) -> DataFrame:
    """The registered mix of a documents table: (domain, lang, source, doc_id,
    n_tokens, epoch, tokens_before)."""
    src = docs.select(domain(F.col("source").cast("string")).alias("domain"), F.col("lang"), F.col("source"), F.col("doc_id"),
                      tokens(F.col("text").cast("string")).alias("n_tokens"))
    src = src.withColumn("domain", F.coalesce("domain", F.lit("d0")))
    return mix(stored(src, "mix-sizes"), LEVELS, {"domain": weight_rows(spark, "domain", DOMAIN_WEIGHTS),
                                                  "lang": weight_rows(spark, "lang", LANG_WEIGHTS)}, fraction)


def drawn(spark, docs: DataFrame, fraction: float = 0.5) -> DataFrame:
    """``docs``, all columns, as drawn by the mix, with ``domain``, ``n_tokens``,
    ``epoch`` and ``tokens_before``.  The draw works on sizes alone; texts are
    joined to it by id and fingerprint at the end."""
    own = fingerprint(F.col("text").cast("string"))
    src = docs.select(F.coalesce(domain(F.col("source").cast("string")), F.lit("d0")).alias("domain"), "lang", "source", "doc_id",
                      own.alias("__fp"), tokens(F.col("text").cast("string")).alias("n_tokens")).where("n_tokens > 0")
    chosen = mix(stored(src, "mix-sizes"), LEVELS, {"domain": weight_rows(spark, "domain", DOMAIN_WEIGHTS),
                                                    "lang": weight_rows(spark, "lang", LANG_WEIGHTS)}, fraction)
    # Rows of equal id, text and leaf are alike: each is numbered, on both sides.
    names = {c: F.col(c).alias(f"__{c}") for c in ("lang", "source")}
    alike = Window.partitionBy("__fp", "doc_id", "lang", "source", "epoch").orderBy("tokens_before")
    chosen = chosen.withColumn("__i", F.row_number().over(alike)).select("domain", "n_tokens", "epoch", "tokens_before", "__i", "__fp",
                                                                         F.col("doc_id").alias("__id"), *names.values())
    keys = [F.col("__own"), F.col("doc_id"), F.col("lang"), F.col("source")]
    rows = docs.withColumn("__own", own).withColumn("__j", F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id")))
    null = F.lit("(null)")
    on = ((F.col("__own") == F.col("__fp")) & (F.col("__i") == F.col("__j")) & F.col("doc_id").eqNullSafe(F.col("__id"))
          & (F.coalesce(F.col("lang").cast("string"), null) == F.col("__lang"))
          & (F.coalesce(F.col("source").cast("string"), null) == F.col("__source")))
    extra = ["domain", "n_tokens", "epoch", "tokens_before"]
    return rows.join(chosen, on).select(*[F.col(c) for c in docs.columns if c not in extra], *extra)
