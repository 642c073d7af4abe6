"""The trie of conversations that share prefixes, by recursive cuts at half depth."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.llm.shared import stored
from tenderline.operators.balance import hot_codes, join_to_unique
from tenderline.operators.timeline import total_before, unroll, with_copies, with_slot

#: Conversations are rebuilt in families of so many ids, with at most SHARED - 1 turns of the first one in front.
FAMILY, SHARED = 5, 9
#: The name of the empty prefix.
ROOT = bytes(16)


def name_of(*parts: str | Column) -> Column:
    """16 bytes of the SHA-256 of names, which all have 16 bytes, or of one text."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turns(conversations: DataFrame) -> tuple[DataFrame, list[int]]:
    """(conv_id, pos, name, n_bytes) of the turns, numbered from 0 in each conversation; and the hot conversations.

    Turns go by `turn`, null first; ties by the name, a hash of role and text, where null counts as empty. Rows without a conv_id are in
    no conversation. Texts stay where they are: what is shuffled is their names and sizes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().cast("int").alias("numbered"), F.col("turn").cast("long").alias("turn"),
        name_of(F.length(role).cast("string"), F.lit(":"), role, text).alias("name"), F.octet_length(text).cast("long").alias("n_bytes"),
    )
    rows = stored(rows, "turn-names")
    codes = hot_codes(rows, ["conv_id"])
    order = ["numbered", "turn", "name"]
    placed = with_slot(with_copies(rows, rows.columns, codes), "conv_id", order, codes)
    placed = unroll(total_before(placed, "conv_id", order, "copies", "ahead", codes), codes)
    return placed.select("conv_id", (F.col("ahead") + F.col("copy") - 1).cast("long").alias("pos"), "name", "n_bytes"), codes


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, len) of all conversations and (c, pos, name, n_bytes) of their turns after rebuilding.

    Conversation c has the first h turns of conversation c - c % 5 (all if there are fewer, none if it does not exist) and then its own
    turns after the first h; h is the crc32 of c in decimal, modulo 9."""
    placed, codes = turns(conversations)
    placed = stored(placed, "turns")
    own = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = own.select("conv_id", "n", family.alias("first"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h"))
    own = stored(own, "own")
    heads = own.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    convs = own.join(heads, "first", "left").withColumn("m", F.least("h", F.coalesce("n_first", F.lit(0))))
    convs = stored(convs.select("conv_id", "first", "h", "m", (F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("len")), "conversations")
    borrowed = placed.where(F.col("pos") < SHARED - 1).withColumnRenamed("conv_id", "first").join(convs.select("first", F.col("conv_id").alias("c"), "h"), "first").where("pos < h")
    rest = join_to_unique(placed, convs.select("conv_id", "h", "m"), ["conv_id"], "inner", codes).where("pos >= h")
    rest = rest.select(F.col("conv_id").alias("c"), (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "name", "n_bytes")
    both = borrowed.select("c", "pos", "name", "n_bytes").unionByName(rest)
    return convs.select(F.col("conv_id").alias("c"), "len"), stored(both, "sequences")


def named_prefixes(convs: DataFrame, sequences: DataFrame, levels: int) -> DataFrame:
    """(c, d, len, name): the name of the first d items of each sequence, for d from 0 to its length.

    The recursion cuts a tree of height 2^k at half depth. A sequence that reaches the cut has a cut prefix, named after the tree it is in and
    the name of its upper half; it goes on in the tree of that name in the lower forest. All trees of one height are cut in one
    step, upper and lower ones side by side, so there are as many steps as the depth has binary digits. Upper halves are whole blocks
    of 2^k items, named beforehand from the two halves of each.

    Equal names are equal prefixes (128 bits of SHA-256). A sequence enters at the height that it needs. Every step joins on sequence and
    block, so that a sequence with very many items is spread over tasks."""
    blocks = [sequences.select("c", F.col("pos").alias("i"), "name")]
    for _ in range(1, levels):
        half = [F.max(F.when(F.col("i") % 2 == side, F.col("name"))).alias(f"half{side}") for side in (0, 1)]
        pairs = blocks[-1].groupBy("c", F.shiftright("i", 1).alias("i")).agg(*half).where("half0 is not null and half1 is not null")
        blocks.append(stored(pairs.select("c", "i", name_of("half0", "half1").alias("name")), "blocks"))
    # A sequence of len items has len + 1 prefixes and needs as many levels as len has binary digits.
    needs = F.when(F.col("len") > 0, F.length(F.bin("len"))).otherwise(0)
    entering = convs.select("c", F.lit(0).cast("long").alias("i"), "len", F.lit(ROOT).alias("tree"), needs.alias("needs"))
    trees = entering.where(F.col("needs") == levels).drop("needs")
    for k in range(levels - 1, -1, -1):
        size = 1 << k
        upper = blocks[k].select("c", (F.shiftright("i", 1)).alias("i"), F.col("name").alias("upper")).where(blocks[k].i % 2 == 0)
        cut = trees.join(upper, ["c", "i"], "left")
        below = F.when(F.col("len") >= (2 * F.col("i") + 1) * size, F.struct((2 * F.col("i") + 1).alias("i"), name_of("tree", "upper").alias("tree")))
        halves = F.array_compact(F.array(F.struct((2 * F.col("i")).alias("i"), F.col("tree")), below))
        trees = cut.select("c", "len", F.inline(halves)).select("c", "i", "len", "tree")
        trees = trees.unionByName(entering.where(F.col("needs") == k).drop("needs"))
    return trees.select("c", F.col("i").alias("d"), "len", F.col("tree").alias("name"))


def grafted(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """Sums over subtrees: rows (name, leaves, saved) that add up per node to what it and all below it have.

    `nodes` has (name, depth, via, leaves, saved), via being any sequence through the node, and `paths` (c, d, len, name). Trees of
    height 1 have their own values. Trees of two heights are joined by grafting: the total of each tree of a lower forest goes to
    all nodes on the way from the cut above it to the root of the upper tree, which is a piece of the path of one sequence
    through its root. Roots of one depth have different sequences, so a step has no more rows than there are turns."""
    columns = ["name", "depth", "via", "leaves", "saved"]
    total = nodes.select(*columns)
    for k in range(levels):
        half = 1 << k
        roots = total.where(F.col("depth") % (2 * half) == half).groupBy("name", "depth").agg(F.min("via").alias("c"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        roots = roots.select("c", (F.expr(f"depth div {half}") - 1).alias("block"), "leaves", "saved")
        upper = paths.withColumn("block", F.expr(f"d div {half}")).where(f"block % 2 = 0 and len >= (block + 1) * {half}")
        onto = upper.join(roots, ["c", "block"]).groupBy("name").agg(F.max("d").alias("depth"), F.min("c").alias("via"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        total = total.unionByName(stored(onto.select(*columns), "grafts"))
    return total.select("name", "leaves", "saved")


def _runs(column: pa.Array) -> np.ndarray:
    """Where in a sorted column a new value begins, and the length."""
    keys = column.to_pylist()
    return np.array([i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]] + [len(keys)])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            at, ids = _runs(batch.column(0)), batch.column(1).to_pylist()
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[:-1])), batch.column(1).take(pa.array(at[:-1])), pa.array(texts, pa.string())], names=["name", "least", "text"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, running = None, None
    for batch in batches:
        done = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if running is not None and name == now:
                running.update(b",")
            else:
                if running is not None:
                    done.append((now, running.hexdigest()))
                now, running = name, hashlib.sha256()
            running.update(text.encode())
        yield _named(done)
    if running is not None:
        yield _named([(now, running.hexdigest())])


def _named(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["name", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) of rows (name, c): SHA-256 of the numbers c in ascending order, joined by commas.

    Rows are put in order over all tasks, and runs of a name within a batch become one text there, so that a name with
    very many rows is spread at first. The texts of a name are then hashed one after the other, which a chain such as SHA-256 asks for: as a
    stream in the sort order, with one text in memory at a time."""
    many = max(2, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pieces = ends.select("name", "c").repartitionByRange(many, "name", "c").sortWithinPartitions("name", "c").mapInArrow(_pieces, "name binary, least long, text string")
    return pieces.repartition(many, "name").sortWithinPartitions("name", "least").mapInArrow(_digests, "name binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a distinct sequence of the first d turns (role and text) of rebuilt conversations; those are its members. conv_id is its least member, so
    (conv_id, depth) names it; parent_conv_id is that of its parent, null for the root (depth 0). n_children are its children, n_leaves the childless nodes
    of its subtree, itself included; saved_tokens adds (n_convs - 1) times the UTF-8 bytes of the last text over its subtree. ends_sha256 is the
    hash of the members that end there, in ascending order.

    Prefixes are named (`named_prefixes`) and totals brought up (`grafted`) by cuts at half depth, in as many steps as the longest conversation
    has binary digits. Null role or text counts as empty; rows without conv_id are left out; rows that repeat are turns like others;
    other columns are not read. A conversation without turns after rebuilding ends at the root. An empty table gives no rows."""
    convs, sequences = rebuilt(conversations)
    longest = convs.agg(F.max("len")).first()[0]
    levels = int(longest or 0).bit_length()
    named = named_prefixes(convs, sequences, levels)
    # What follows a prefix in a sequence: the bytes of the turn with the same number.
    paths = stored(named.join(sequences.select("c", F.col("pos").alias("d"), "n_bytes"), ["c", "d"], "left"), "paths")
    nodes = paths.groupBy("name").agg(F.max("d").alias("depth"), F.count("*").alias("n_convs"), F.min("c").alias("via"), (F.max("len") == F.max("d")).cast("long").alias("leaves"))
    before = paths.select(F.col("c").alias("via"), (F.col("d") + 1).alias("depth"), F.col("name").alias("parent"), F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"))
    nodes = nodes.join(before, ["via", "depth"], "left").withColumn("saved", F.coalesce((F.col("n_convs") - 1) * F.col("n_bytes"), F.lit(0)))
    nodes = stored(nodes.select("name", "parent", "depth", "via", "n_convs", "leaves", "saved"), "nodes")
    reps = nodes.select(F.col("name").alias("parent"), F.col("via").alias("parent_conv_id"))
    with_parent = join_to_unique(nodes, reps, ["parent"], "left").withColumnRenamed("via", "conv_id")

    # What is known of a node comes from five sides; one grouping brings it together.
    columns = {"conv_id": "long", "depth": "long", "parent_conv_id": "long", "n_convs": "long", "n_children": "long", "n_leaves": "long", "saved_tokens": "long", "ends_sha256": "string"}

    def known(rows: DataFrame) -> DataFrame:
        return rows.select("name", *[F.col(c).cast(t) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()])

    sides = known(with_parent.select("name", "conv_id", "depth", "parent_conv_id", "n_convs"))
    sides = sides.unionByName(known(nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "name")))
    sides = sides.unionByName(known(grafted(nodes, paths, levels).withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})))
    sides = sides.unionByName(known(end_digests(paths.where("d = len"))))
    one = [F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")]
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    out = sides.groupBy("name").agg(*one, *sums, F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    return out.drop("name")


#: The same from whole prefixes. The crc32 is that of zlib: polynomial 3988292384, started and ended by 4294967295.
SQL = f"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY i) AS t
  FROM (SELECT i::BIGINT AS i FROM range(256) r(i))),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
convs AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS first,
    xor(list_reduce(list_prepend(4294967295, [ascii(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')]), lambda a, b: xor(a // 256, t[(xor(a, b) & 255) + 1])), 4294967295) % {SHARED} AS h
  FROM ids, crc_table),
own AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) - 1 AS pos, item, size FROM (
    SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item, octet_length(encode(coalesce(text, ''))) AS size
    FROM conversations WHERE conv_id IS NOT NULL)),
parts AS (
  SELECT c.conv_id, 0 AS part, o.pos, item, size FROM convs c JOIN own o ON o.conv_id = c.first AND o.pos < h
  UNION ALL SELECT c.conv_id, 1, o.pos, item, size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos >= h),
seqs AS MATERIALIZED (
  SELECT conv_id, coalesce(items, []) AS items, coalesce(sizes, []) AS sizes FROM ids LEFT JOIN (
    SELECT conv_id, list(item ORDER BY part, pos) AS items, list(size ORDER BY part, pos) AS sizes FROM parts GROUP BY conv_id) USING (conv_id)),
paths AS MATERIALIZED (
  SELECT conv_id, d, len(items) AS n, sha256(array_to_string(items[1:d], '')) AS node, CASE WHEN d > 0 THEN sha256(array_to_string(items[1:d - 1], '')) END AS above, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(range(len(items) + 1)) AS d FROM seqs)),
nodes AS MATERIALIZED (
  SELECT node, any_value(above) AS above, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved, max(n) = any_value(d) AS leaf,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM paths GROUP BY node),
sums AS (SELECT p.node, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM nodes v JOIN paths p ON p.conv_id = v.conv_id AND p.d <= v.depth GROUP BY p.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, (SELECT count(*) FROM nodes x WHERE x.above = n.node) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.above JOIN sums ON sums.node = n.node"""
