"""Mixing sources to target weights: budgets down a domain-language-source tree, prefixes of seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tenderline.llm.shared import stored

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
EPOCHS = 3
SEED = 17
#: Hex digits of the order key that cut a leaf's epoch into slices: 16 ** 3 slices.
SLICE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def _filled(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Children (weight, cap) of each parent with `budget`: the same with `share`, their part of it.

    A child gets its budget in proportion to its weight, but no more than its cap; what it cannot use goes
    to its siblings in proportion to theirs. Children are taken in the order cap / weight, so those before a
    child that stays below its cap are the full ones."""
    order = W.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), "name")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    nodes = nodes.withColumn("full", F.col("cap") * rest <= F.col("weight") * (F.col("budget") - before))
    group = W.partitionBy(*parent)
    used = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group)
    open_ = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group)
    return nodes.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * (F.col("budget") - used) / open_))


def budgets(leaves: DataFrame, budget: Column, epochs: int) -> DataFrame:
    """For leaves (domain, lang, source, tokens, and a weight for each level): the whole tokens of each, `quota`.

    A node can use the tokens of its leaves `epochs` times. From the root down each node divides its
    budget among its children, so a shortage moves to siblings first, and above only when all of a
    node is short. Weights are whole numbers; nodes without a weight above zero get nothing."""
    live = leaves.where("domain_weight > 0 and lang_weight > 0 and source_weight > 0").withColumn("cap", (F.col("tokens") * epochs).cast("double"))
    above, given = [], None
    for depth, level in enumerate(LEVELS):
        keys = list(LEVELS[: depth + 1])
        nodes = live.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.max(f"{level}_weight").cast("double").alias("weight")).withColumn("name", F.col(level))
        nodes = nodes.withColumn("budget", budget.cast("double")) if given is None else nodes.join(given, above)
        given = _filled(nodes, above or [F.lit(0)]).select(*keys, F.col("share").alias("budget"))
        above = keys
    return leaves.join(given, list(LEVELS)).select(*LEVELS, "tokens", F.floor("budget").alias("quota")).where("quota > 0")


def mixture(docs: DataFrame, weights: DataFrame, percent: int, epochs: int = EPOCHS, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, domain, lang, source, epoch, tokens_taken, and the columns of `carry`) of a mixture of `percent` % of all tokens.

    `docs` has (doc_id, domain, lang, source, n_tokens); `weights` has the leaves with domain_weight,
    lang_weight and source_weight. A null domain, language or source is the node "(none)". Leaves without weights get
    nothing. In each epoch the documents of a leaf follow each other by md5(seed:epoch:doc_id); the leaf's
    quota is a prefix of the tokens of its epochs, so the last document may be taken in part. Documents
    without tokens are left out; rows that repeat an id, and rows with a null id, are documents of their own. If all leaves together hold
    fewer tokens than asked for, all of all epochs is taken. An empty table gives none.

    Only DataFrame functions. Whole epochs need no order. The last epoch of a leaf is cut into slices by its
    order key; slices are summed, and only the slice in which the quota ends is put in order."""
    named = [F.coalesce(F.col(c), F.lit(NONE)).alias(c) for c in LEVELS]
    docs = stored(docs.where("n_tokens > 0").select("doc_id", *named, "n_tokens", *carry), "mix")
    weights = weights.select(*named, *[f"{c}_weight" for c in LEVELS]).dropDuplicates(list(LEVELS))
    leaves = docs.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    quotas = budgets(leaves.join(weights, list(LEVELS)), F.lit(total * percent // 100), epochs)
    quotas = stored(quotas.select(*LEVELS, F.expr("quota div tokens").alias("whole"), F.expr("quota % tokens").alias("rest")), "quotas")

    member = docs.join(quotas, list(LEVELS))
    full = member.where("whole > 0").select("doc_id", *LEVELS, F.explode(F.expr("sequence(1, whole)")).alias("epoch"), F.col("n_tokens").alias("tokens_taken"), *carry)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("whole") + 1).cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = member.where("rest > 0").withColumn("key", key).withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
    sums = keyed.groupBy(*LEVELS, "slice").agg(F.sum("n_tokens").alias("t"))
    along = W.partitionBy(*LEVELS).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("t").over(along), F.lit(0)))
    keyed = keyed.join(sums, [*LEVELS, "slice"]).where("before < rest")
    inside = keyed.where("before + t <= rest").withColumn("taken", F.col("n_tokens"))
    along = W.partitionBy(*LEVELS, "slice").orderBy("key", "doc_id", "n_tokens", *carry).rowsBetween(W.unboundedPreceding, -1)
    edge = keyed.where("before + t > rest").withColumn("taken", F.least("n_tokens", F.col("rest") - F.col("before") - F.coalesce(F.sum("n_tokens").over(along), F.lit(0))))
    part = inside.unionByName(edge).where("taken > 0").select("doc_id", *LEVELS, (F.col("whole") + 1).alias("epoch"), F.col("taken").alias("tokens_taken"), *carry)
    return full.union(part)


#: Weights of the mixture over the test tables, by the number in a source's name.
PERCENT = 60
DOMAIN = "concat('d', {n} % 3)"
WEIGHTS = {
    "domain_weight": "CASE {n} % 3 WHEN 0 THEN 2 WHEN 1 THEN 5 ELSE 3 END",
    "lang_weight": "CASE lang WHEN 'en' THEN 6 WHEN 'fr' THEN 3 WHEN 'de' THEN 2 ELSE 1 END",
    "source_weight": "1 + {n} % 4",
}


def mixed_documents(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The mixture over a table like `documents`, with the columns of `carry`; a source without a number counts as number 0."""
    number = "coalesce(try_cast(regexp_extract(source, '([0-9]+)', 1) as int), 0)"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.expr(DOMAIN.format(n=number)).alias("domain"), word_count(F.col("text")).alias("n_tokens"), *carry)
    weights = rows.select(*LEVELS).distinct().select(*LEVELS, *[F.expr(e.format(n=number)).alias(c) for c, e in WEIGHTS.items()])
    return mixture(rows, weights, PERCENT, carry=carry)


def _sql() -> str:
    n = "coalesce(try_cast(regexp_extract(source, '([0-9]+)', 1) as int), 0)"
    levels, parts = "", []
    for depth, level in enumerate(LEVELS):
        keys, up = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
        nodes = f"SELECT {keys}, sum(cap) AS cap, max({level}_weight)::DOUBLE AS weight FROM leaves GROUP BY {keys}"
        source = f"({nodes}) CROSS JOIN total" if not depth else f"({nodes}) JOIN (SELECT {up}, share AS budget FROM l{depth - 1}) USING ({up})"
        group = f"PARTITION BY {up}" if up else ""
        parts.append(f"""
o{depth} AS (SELECT *, cap * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= weight * (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
  FROM {source} WINDOW o AS ({group} ORDER BY cap / weight, {level})),
l{depth} AS (SELECT *, CASE WHEN filled THEN cap ELSE weight * (budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({group}))
    / sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({group}) END AS share FROM o{depth}),""")
    levels = "".join(parts)
    weights = ", ".join(f"{e.format(n=n)} AS {c}" for c, e in WEIGHTS.items())
    return f"""
WITH d AS (SELECT * FROM (
    SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source, {DOMAIN.format(n=n)} AS domain,
      len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n_tokens FROM documents) WHERE n_tokens > 0),
total AS (SELECT floor(sum(n_tokens) * {PERCENT} / 100)::DOUBLE AS budget FROM d),
leaves AS (SELECT *, (tokens * {EPOCHS})::DOUBLE AS cap, {weights} FROM (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL)),{levels}
quotas AS (SELECT domain, lang, source, tokens, floor(share) AS quota FROM l2 JOIN leaves USING (domain, lang, source)),
streams AS (SELECT d.*, quota, epoch, md5(concat_ws(':', '{SEED}', epoch, doc_id)) AS key
  FROM d JOIN quotas USING (domain, lang, source), range(1, {EPOCHS} + 1) e(epoch)),
placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY epoch, key, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM streams)
SELECT doc_id, domain, lang, source, epoch, least(n_tokens, quota - before)::BIGINT AS tokens_taken FROM placed WHERE before < quota"""


SQL = _sql()
