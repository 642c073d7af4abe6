"""Tables in the folder that all executors share, and components of a graph."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of 64 bits in the bitmap of a set.
WORDS = 16
#: Members of a bucket that are compared with the others in a round after the first.
DRAWS = 1
#: Members of a bucket, at most, that are all compared with each other when the hub leaves some outside.
SMALL = 32


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset and all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, read often, safe when executors go.

    Tables stay until the owner of the folder clears it, since results are read from them lazily."""
    spark, schema = df.sparkSession, df.schema
    path = new_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(schema).parquet(path)


def numbered(rows: DataFrame, order: list[str], direct: Column, name: str, codec: str | None = None) -> DataFrame:
    """The rows in a stored table, each with a `node` of its own that grows along `order`.

    `direct` is such a number for nearly all inputs (null where it is none). Where two rows have the same one, or one has none, all rows are
    put in order and counted through instead. The least node of a bucket is then its earliest member, which others are likely to be copies of."""
    table = stored(rows, name, codec)
    if table.groupBy(direct.alias("n")).count().where("count > 1 or n is null").isEmpty():
        return table.withColumn("node", direct)
    return stored(table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("node", F.monotonically_increasing_id()), name, codec)


def discard(*tables: DataFrame) -> None:
    """Removes stored tables that no later step reads."""
    for table in tables:
        files = table.inputFiles()
        if files:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, component) of the undirected edges (a, b): component is the least node reachable.

    Rounds of large-star and small-star steps: each is a grouped minimum and a join, and edges never
    outnumber those given. Nodes without an edge to another are left out; null ends are ignored."""
    spark = edges.sparkSession
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("m", "a").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("u", "m")).distinct()
        last, now = now, stored(small, name)
        discard(last)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished steps now; it does so when the driver collects its garbage."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def _least_first(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def star_components(buckets: DataFrame, confirm: Callable[[DataFrame], DataFrame], items: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame | None:
    """(node, component) over the links between nodes that share a bucket; None when nothing is linked.

    `buckets` has (bucket, node); `confirm` takes pairs (a, b) and returns those linked, that is with
    100 * intersection >= percent * union of their sets; `items` takes nodes and returns the (node, item) of their sets.
    The pairs of the first call of `confirm` name all nodes that share a bucket; later calls, and `items`, get no others.

    1. Stars: in each bucket one member, its hub, is compared with the others, so a bucket costs as many pairs
       as it has members. The hub is the member with most fellows over all its buckets: variants share more buckets with what they
       are variants of than with each other. Of equals it is the least node. The links give components.
    2. Small buckets: those of up to SMALL members, some of them outside the hub's component, are done with by comparing all
       their pairs in different components, at most SMALL / 2 for each of their rows.
    3. Draws: in larger buckets with members outside the hub's component, DRAWS members chosen by a hash are compared with those of
       other components. A chosen member is in the hub's component as often as members are, so a round costs about
       2 * DRAWS pairs for each member outside. Rounds go on while each leaves at most half of the members outside.
    4. Rest: members still outside the component of their larger bucket's hub may be linked to any
       live member of such buckets. Items are put in one order, rarest first; a linked pair has its first shared item among the first
       n - ceil(percent * n / 100) + 1 of each of its two sets, and few enough items before it. So members are joined on those
       rare items, and not on what the whole group has. Items that no other live set has cannot be shared, which bounds a
       partner's size. Each set also has a bitmap of 64 * WORDS places, by ranges of the hash: a place that only one of two
       sets has stands for at least one item that is not shared, which bounds the intersection. Only pairs within
       the bounds are compared. Nothing is left unseen: a pair is in one component, or compared, or cannot be linked."""
    spark, p = buckets.sparkSession, percent
    # Dealt once, for the counts and for the join with them.
    buckets = buckets.repartition("bucket")
    counts = buckets.groupBy("bucket").agg(F.count("*").alias("k"), F.min("node").alias("least")).where("k > 1")
    buckets = stored(buckets.join(counts.hint("shuffle_hash"), "bucket"), "buckets")
    release(spark)
    crowded = buckets.where("k > 2").select("bucket", "node", "k")
    fellows = crowded.groupBy("node").agg(F.sum("k").alias("fellows"))
    hubs = crowded.join(fellows, "node").groupBy("bucket").agg(F.max(F.struct("fellows", F.bitwise_not("node").alias("turned"))).alias("hub"))
    hubs = hubs.select("bucket", F.bitwise_not("hub.turned").alias("hub"))
    wide, buckets = buckets, stored(buckets.join(hubs, "bucket", "left").select("bucket", "node", "k", F.coalesce("hub", "least").alias("hub")), "hubs")
    discard(wide)
    tried = stored(buckets.where("node <> hub").select(*_least_first("node", "hub")).distinct(), "stars")
    release(spark)
    links = stored(confirm(tried), "links")
    release(spark)
    labels, linked, before = components(links), not links.isEmpty(), None
    while True:
        named = buckets.join(labels, "node", "left").select("bucket", "node", "k", "hub", F.coalesce("component", "node").alias("comp"))
        mains = labels.select(F.col("node").alias("hub"), F.col("component").alias("main"))
        named = named.join(mains, "hub", "left").select("bucket", "node", "k", "comp", F.coalesce("main", "hub").alias("main"))
        apart = named.groupBy("bucket").agg(F.max(F.col("comp") != F.col("main")).alias("apart")).where("apart")
        live = stored(named.join(apart.select("bucket"), "bucket", "left_semi"), "live")
        members = live.where(F.col("k") > SMALL)
        outside = members.where("comp <> main").count()
        small = live.where(F.col("k") <= SMALL) if before is None else live.limit(0)
        if not outside and small.isEmpty():
            return labels if linked else None
        if before is not None and 2 * outside > before:
            break
        before = outside
        draws = []
        for k in range(DRAWS):
            order = F.xxhash64(F.lit(outside), F.lit(k), "bucket", "node")
            draws += [F.min_by("node", order).alias(f"node{k}"), F.min_by("comp", order).alias(f"comp{k}")]
        drawn = members.groupBy("bucket").agg(*draws)
        drawn = drawn.select("bucket", F.explode(F.array(*[F.struct(F.col(f"node{k}").alias("node"), F.col(f"comp{k}").alias("comp")) for k in range(DRAWS)])).alias("d")).select("bucket", F.col("d.node").alias("d_node"), F.col("d.comp").alias("d_comp"))
        pairs = members.join(drawn, "bucket").where("comp <> d_comp").select(*_least_first("node", "d_node"))
        others = small.select("bucket", F.col("node").alias("other"), F.col("comp").alias("other_comp"))
        pairs = pairs.union(small.join(others, "bucket").where("node < other and comp <> other_comp").select("node", "other"))
        pairs = stored(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "draws")
        more = stored(confirm(pairs), "links")
        release(spark)
        tried = tried.union(pairs)
        if more.isEmpty() and not outside:
            return labels if linked else None
        if more.isEmpty():
            break
        labels, linked = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), True
        discard(live)
    discard(buckets)
    held = stored(items(members.select("node").distinct()), "held")
    release(spark)
    place = F.shiftrightunsigned("item", 54).cast("int")
    bits = [F.bit_or(F.when(F.shiftright(place, 6) == k, F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63))).otherwise(0)) for k in range(WORDS)]
    # Dealt by item once; the rows of an item are one for each live member at most.
    shown = held.withColumn("k", F.count("*").over(Window.partitionBy("item")))
    sets = shown.groupBy("node").agg(F.count("*").alias("n"), F.array(*bits).alias("f"), F.count_if(F.col("k") == 1).alias("own"), F.sort_array(F.collect_list(F.struct("k", "item"))).alias("rare"))
    sets = sets.selectExpr("node", "n", "f", f"least(100 * n div {p}, ({100 + p} * (n - own) - {p} * n) div {p}) as most", f"slice(rare, 1, cast(n - ({p} * n + 99) div 100 + 1 as int)) as rare")
    sets = stored(sets.where(f"100 * most >= {p} * n"), "sets")
    discard(held)
    release(spark)
    named = members.groupBy("node").agg(F.first("comp").alias("comp"), F.max(F.col("comp") != F.col("main")).alias("outside"))
    live = sets.join(named, "node").select("node", "comp", "outside", "n", "f", "most", F.posexplode("rare").alias("at", "x")).where("x.k > 1").withColumn("item", F.col("x.item")).drop("x")
    rest = live.where("outside").select("item", *[F.col(c).alias(f"c_{c}") for c in ("node", "comp", "n", "f", "most", "at")])
    unlike = "aggregate(zip_with({}, {}, (x, y) -> bit_count(x & ~y)), 0, (x, y) -> x + y)"
    after = "least(n - at, c_n - c_at)"
    both = f"least(n - {unlike.format('f', 'c_f')}, c_n - {unlike.format('c_f', 'f')})"
    near = [f"{100 + p} * {bound} >= {p} * (n + c_n)" for bound in (after, both)]
    pairs = live.join(rest, "item").where(f"comp <> c_comp and n <= c_most and c_n <= most and {' and '.join(near)}")
    pairs = pairs.select(*_least_first("node", "c_node")).distinct().join(tried, ["a", "b"], "left_anti")
    pairs = stored(pairs, "pairs")
    discard(members, sets)
    release(spark)
    more = stored(confirm(pairs), "links")
    discard(pairs)
    release(spark)
    if more.isEmpty():
        return labels if linked else None
    return components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))


def agree(s: str, t: str, percent: int) -> Column:
    """Whether arrays of distinct items have 100 * intersection >= percent * union."""
    both = F.size(F.array_intersect(s, t))
    return 100 * both >= percent * (F.size(s) + F.size(t) - both)


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def hashed_sample(rows: DataFrame, size: int, seed: int, *columns: str) -> DataFrame:
    """About `size` of the rows, or all if there are fewer: those whose hash of the columns is low enough.

    Rows are counted, not sorted, so no task gets more than its own."""
    total = rows.count()
    if total <= size:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 40)) < F.lit(size * (1 << 40) // total))
