"""Benchmark passages inside training texts: spaced seeds, confirmed with room for substitutions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.llm.shared import stored

#: Token masks: 1 is compared, 0 is ignored. Each compares six tokens.
MASKS = ("111111", "110101101", "11001010011")
SPAN = 13
PERCENT = 80
BROADCAST_SEEDS = 500_000


def light_masks(size: int, percent: int) -> list[tuple[int, str]]:
    """(offset, mask) over an item of `size` tokens: whichever tokens differ, if few enough for `percent` % to agree, one mask misses them all.

    If s tokens may differ, the item is cut into s + 2 blocks (or single tokens), and each mask leaves out s of them."""
    spare = size * (100 - percent) // 100
    blocks = min(size, spare + 2)
    cuts = [size * k // blocks for k in range(blocks + 1)]
    out = []
    for gone in combinations(range(blocks), spare):
        bits = "".join(("0" if k in gone else "1") * (cuts[k + 1] - cuts[k]) for k in range(blocks))
        out.append((bits.index("1"), bits.strip("0")))
    return out


def tokens(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _windows(rows: DataFrame, masks: tuple[str, ...], *keep: str) -> DataFrame:
    """For rows with hashed `tokens`: each start `at` and `mask` that fits, with the `seed`, a hash of the tokens
    that the mask compares. Only the columns of `keep` go with each of them."""
    # Tokens side by side with those that follow. The outer transform binds the tokens; a plain column would be worked out anew for each use.
    shifted = ", ".join(f"slice(h, {i + 1}, size(h))" for i in range(max(map(len, masks))))
    spots = rows.select(*keep, F.posexplode(F.expr(f"transform(array(tokens), h -> arrays_zip({shifted}))[0]")).alias("at", "t"))
    token = [F.col("t").getField(str(i)) for i in range(max(map(len, masks)))]
    seeds = []
    for k, mask in enumerate(masks):
        picked = [token[i] for i, bit in enumerate(mask) if bit == "1"]
        seeds.append(F.when(token[len(mask) - 1].isNotNull(), F.xxhash64(F.lit(k), *picked)))
    return spots.select(*keep, "at", F.posexplode(F.array(*seeds)).alias("mask", "seed")).where("seed is not null")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    masks: tuple[str, ...] = MASKS,
    span: int = SPAN,
    percent: int = PERCENT,
) -> DataFrame:
    """Pairs (doc_id, item_id) of texts that hold a passage of a benchmark item, with `places`, the
    number of positions of the text at which a confirmed hit starts, and `first_at`, the first of them.

    A hit is a position of the text and one of the item at which the tokens that a mask compares are equal.
    It is confirmed when some `span` tokens of the item (the whole item if shorter) that include the masked window
    agree with the text, laid out from the hit, in at least `percent` % of their places; a place outside
    the text does not agree. So substituted tokens are tolerated, inserted ones are not.

    Items with fewer than `span` tokens also have the masks of `light_masks`, each at its place in the item: whatever
    is substituted within `percent`, one of them hits. Texts get those masks only for the numbers of tokens that such items have.

    All positions of all texts are searched. Null and empty texts have no hit. Null ids are rows like others. Repeated rows count once in `places`.
    Seeds of the benchmark are broadcast only when fewer than BROADCAST_SEEDS were counted; else both
    sides are shuffled. Other columns are not read."""
    hashed = lambda c: F.transform(tokens(c), lambda t: F.xxhash64(t))
    items = benchmark.select(F.col(item_col).alias("item_id"), hashed(F.col(item_text_col)).alias("tokens"))
    short = sorted(r.n for r in items.select(F.size("tokens").alias("n")).where(f"n > 0 and n < {span}").distinct().collect())
    light = [(n, at, mask) for n in short for at, mask in light_masks(n, percent)]
    base, masks = len(masks), masks + tuple(sorted({m for _, _, m in light} - set(masks)))
    widths = F.array(*[F.lit(len(m)) for m in masks])
    seeds = _windows(items, masks, "item_id", "tokens")
    fits = F.col("mask") < base
    for n, at, mask in light:
        fits |= (F.size("tokens") == n) & (F.col("at") == at) & (F.col("mask") == masks.index(mask))
    seeds = seeds.where(fits).withColumn("width", F.get(widths, "mask")).withColumn("from", F.expr(f"greatest(0, at + width - {span})"))
    seeds = seeds.select("seed", F.struct("item_id", "width", F.expr(f"slice(tokens, from + 1, least(size(tokens), at + {span}) - from)").alias("part"), F.expr("at - from").alias("lead"), F.expr(f"least({span}, size(tokens))").alias("need")).alias("x"))
    if seeds.count() < BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tag"))
    hits = _windows(texts.select("doc_id", "tag", hashed(F.col("text")).alias("tokens")), masks, "doc_id", "tag").join(seeds, "seed")
    hits = stored(hits.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("at", "x")).alias("hits")), "hits")
    # Each text with hits once more, its hits beside its tokens: a row of tokens is never copied for each hit.
    found = texts.join(hits, texts.doc_id.eqNullSafe(hits.doc_id) & (texts.tag == hits.tag)).select(texts.doc_id, hashed(F.col("text")).alias("tokens"), "hits")
    same = "transform(y.x.part, (t, i) -> if(get(h, y.at - y.x.lead + i) = t, 1, 0))"
    starts = "sequence(greatest(0, y.x.lead + y.x.width - y.x.need), least(y.x.lead, size(y.x.part) - y.x.need))"
    some = "greatest(0, y.x.lead + y.x.width - y.x.need) <= least(y.x.lead, size(y.x.part) - y.x.need)"
    good = f"{some} and exists(transform(array({same}), z -> transform({starts}, s -> aggregate(slice(z, s + 1, y.x.need), 0, (a, v) -> a + v)))[0], k -> 100 * k >= {percent} * y.x.need)"
    found = found.select("doc_id", F.explode(F.expr(f"transform(array(tokens), h -> filter(hits, y -> {good}))[0]")).alias("y"))
    return found.groupBy("doc_id", F.col("y.x.item_id").alias("item_id")).agg(F.countDistinct("y.at").alias("places"), F.min("y.at").alias("first_at"))


def _sql() -> str:
    picks = ", ".join(f"({k}, {len(m)}, [{', '.join(str(i) for i, b in enumerate(m) if b == '1')}])" for k, m in enumerate(MASKS))
    words = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    return f"""
    WITH masks(mask, width, picks) AS (VALUES {picks}),
    d AS (SELECT doc_id, {words} AS w FROM documents),
    b AS (SELECT item_id, {words} AS w FROM benchmark),
    dw AS (SELECT doc_id, w, mask, width, p, array_to_string(list_transform(picks, lambda i: w[p + i + 1]), ' ') AS seed
           FROM (SELECT *, unnest(range(0, len(w) - width + 1)) AS p FROM d, masks)),
    bw AS (SELECT item_id, w, mask, p AS q, array_to_string(list_transform(picks, lambda i: w[p + i + 1]), ' ') AS seed, least({SPAN}, len(w)) AS need
           FROM (SELECT *, unnest(range(0, len(w) - width + 1)) AS p FROM b, masks)),
    hits AS (SELECT doc_id, item_id, p, width, q, need, dw.w AS x, bw.w AS y FROM dw JOIN bw USING (mask, seed)),
    tried AS (SELECT *, unnest(range(greatest(0, q + width - need), least(q, len(y) - need) + 1)) AS s FROM hits),
    good AS (SELECT doc_id, item_id, p FROM tried
             WHERE 100 * len(list_filter(range(s, s + need), lambda j: p - q + j >= 0 AND x[p - q + j + 1] = y[j + 1])) >= {PERCENT} * need)
    SELECT doc_id, item_id, count(DISTINCT p) AS places, min(p) AS first_at FROM good GROUP BY doc_id, item_id"""


SQL = _sql()
