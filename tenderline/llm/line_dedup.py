"""Fuzzy line deduplication: MinHash over character shingles, bands, exact confirmation, union-find."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.llm.shared import WORDS, agree, discard, ends, numbered, release, star_components, stored

SHINGLE_CHARS = 9
BANDS, BAND_ROWS = 16, 4
PERCENT = 80
#: For the number of a line in its text, in the number of a line among all.
LINE_BITS = 31
#: Of the tables between steps.
CODEC = "zstd"

_draw = random.Random(5)
#: One order of the hashes for each minimum of a band; the high two bits differ, so that minima come from other quarters of the hashes.
ORDERS = [(k << 62 | _draw.getrandbits(62)) - (1 << 63) for k in range(BAND_ROWS)]


def _units(line: Column) -> Column:
    """Four bytes for each character, so that any shingle is reached in one step."""
    return F.encode(line, "UTF-32")


def _starts(size: int) -> str:
    """Where the shingles begin in the bytes of `_units`, counted from 1."""
    return f"sequence(1, greatest(1, cast(length(units) as int) - {4 * size - 1}), 4)"


def _hashed(lines: DataFrame, size: int) -> DataFrame:
    """(node, h) of each shingle of rows (node, line), in the task that has the line."""
    units = lines.select("node", _units(F.col("line")).alias("units"))
    shingles = units.select("node", F.explode(F.expr(_starts(size))).alias("at"), "units")
    return shingles.select("node", F.xxhash64(F.expr(f"substring(units, at, {4 * size})")).alias("h"))


def _marks(hashed: DataFrame) -> DataFrame:
    """(node, n, f) of rows (node, h): their number, and a bitmap of 64 * WORDS places by ranges of the hash; a word each before they are put together."""
    place = F.shiftrightunsigned("h", 54).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63))
    words = hashed.groupBy("node", F.shiftright(place, 6).alias("word")).agg(F.count("*").alias("n"), F.bit_or(bit).alias("bits"))
    return words.groupBy("node").agg(F.sum("n").alias("n"), F.array(*[F.bit_or(F.when(F.col("word") == k, F.col("bits")).otherwise(0)) for k in range(WORDS)]).alias("f"))


def line_table(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, line_no, line) of the lines with any sign but white space; the tag is a hash of the text."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("tag"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def _plain(docs: DataFrame) -> bool:
    """Whether each row has an id of its own that leaves room for a line number beside it in 63 bits."""
    return docs.groupBy("doc_id").count().where(f"count > 1 or doc_id is null or not doc_id between 0 and {(1 << 63 - LINE_BITS) - 1}").isEmpty()


def duplicate_lines(docs: DataFrame, size: int = SHINGLE_CHARS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, tag, line_no) of the lines that stay, for rows (doc_id, text): of equal or linked lines, the first.

    Two lines are linked when 100 * intersection >= percent * union of their sets of distinct shingles of
    `size` characters; a shorter line is its own only shingle. Components of linked lines keep
    their line with the least (doc_id, tag, line_no), the tag being a hash of the text."""
    kept = _first_lines(docs, size, percent)
    if "tag" not in kept.columns:
        kept = kept.join(docs.select("doc_id", F.xxhash64("text").alias("tag")), "doc_id")
    return kept.select("doc_id", "tag", "line_no")


def _first_lines(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The rows of `duplicate_lines`; without the tag where each id has one text."""
    spark = docs.sparkSession
    lines = line_table(docs)
    if _plain(docs):
        # The least of plain numbers is found by hash; the least of places would sort the texts.
        number = F.shiftleft("doc_id", LINE_BITS).bitwiseOR(F.col("line_no").cast("long"))
        distinct = stored(lines.groupBy("line").agg(F.min(number).alias("node")), "lines", CODEC)
        place = [F.shiftright("node", LINE_BITS).alias("doc_id"), F.col("node").bitwiseAND((1 << LINE_BITS) - 1).cast("int").alias("line_no")]
    else:
        place = ["doc_id", "tag", "line_no"]
        owned = lines.groupBy("line").agg(F.min(F.struct(*place)).alias("owner"))
        distinct = numbered(owned.select(*[F.col(f"owner.{c}").alias(c) for c in place], "line"), place, F.lit(None).cast("long"), "lines", CODEC)
    release(spark)

    # Placed by node as texts, so that the shingles of a line meet in the task that makes them.
    hashed = _hashed(distinct.where(F.length("line") >= size).select("node", "line").repartition("node"), size)
    band = F.col("h").bitwiseAND(BANDS - 1).alias("band")
    minima = hashed.groupBy("node", band).agg(*[F.min(F.col("h").bitwiseXOR(F.lit(o))).alias(f"m{k}") for k, o in enumerate(ORDERS)])
    buckets = stored(minima.select(F.xxhash64("band", *[f"m{k}" for k in range(BAND_ROWS)]).alias("bucket"), "node"), "bands", CODEC)
    release(spark)
    # The outer transform binds the encoded line; a plain column would be encoded anew for each shingle.
    every = f"array_distinct(transform(array(encode({{}}, 'UTF-32')), units -> transform({_starts(size)}, at -> xxhash64(substring(units, at, {4 * size}))))[0])"
    known: list[DataFrame] = []

    def texts_and_marks(pairs: DataFrame) -> list[DataFrame]:
        """(node, line), and (node, n, f): places and bitmap of the shingles, of all nodes that share a bucket; made with the first pairs."""
        if not known:
            known.append(stored(distinct.select("node", "line").join(ends(pairs).hint("shuffle_hash"), "node", "left_semi"), "texts", CODEC))
            release(spark)
            known.append(stored(_marks(_hashed(known[0].repartition("node"), size)), "marks", CODEC))
            release(spark)
        return known

    def confirm(pairs: DataFrame) -> DataFrame:
        texts, marks = texts_and_marks(pairs)
        # No bound by length alone: a line that repeats inside itself has few distinct shingles. A place that one of two lines only has set
        # stands for a shingle that is not shared, at least; there are at most (n + m) * (100 - percent) / (100 + percent) of those in linked lines.
        ab = pairs.join(marks.selectExpr("node as b", "n as m", "f as g"), "b").join(marks.selectExpr("node as a", "n", "f"), "a")
        apart = "aggregate(zip_with(f, g, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y)"
        ab = ab.where(f"{100 - percent} * (n + m) >= {100 + percent} * {apart}").select("a", "b")
        ab = ab.join(texts.selectExpr("node as b", "line as t"), "b").join(texts.selectExpr("node as a", "line as s"), "a")
        return ab.select("a", "b", *[F.expr(every.format(c)).alias(c) for c in "st"]).where(agree("s", "t", percent)).select("a", "b")

    def items(nodes: DataFrame) -> DataFrame:
        return known[0].join(nodes, "node", "left_semi").select("node", F.explode(F.expr(every.format("line"))).alias("item"))

    labels = star_components(buckets, confirm, items, percent)
    discard(buckets, *known)
    kept = distinct.drop("line")
    if labels is not None:
        # Nodes grow along the places of their lines, so a component is named by its first line.
        kept = kept.join(labels.where("node <> component").select("node").hint("shuffle_hash"), "node", "left_anti")
    return kept.select(*place)


def without_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_CHARS, percent: int = PERCENT, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_lines, n_kept, the columns of `carry`, text with the lines that stay, in their order, joined by line feeds.

    Lines end at line feeds; lines of white space alone are left out of the counts and of the text. Of equal or
    linked lines of all documents the one with the least (doc_id, line number) stays. A null text stays null.
    Rows with a null id keep all their lines and take part in nothing. Rows that repeat an id with other texts are
    documents of their own, in the order of the texts' hashes; rows that repeat id and text keep the same lines. Other
    columns are not read.

    Only DataFrame functions. Distinct lines are hashed once; each shingle belongs to one band, by the low bits of its hash, and costs
    one hash and that band's minima. 16 bands of 4: two lines at 0.8 share no band in 2 of 10,000 cases. Candidates are stars
    (`star_components`); the lines of a bucket are never paired with each other."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    kept = _first_lines(rows.where("doc_id is not null").select("doc_id", "text"), size, percent)
    same = F.col("doc_id") == F.col("__id")
    keys = [F.col("doc_id").alias("__id")]
    if "tag" in kept.columns:
        rows = rows.withColumn("__tag", F.xxhash64("text"))
        same, keys = same & (F.col("__tag") == F.col("__other")), [*keys, F.col("tag").alias("__other")]
    kept = kept.groupBy(*keys).agg(F.sort_array(F.collect_list("line_no")).alias("__stay"))
    split = "transform(array(split(text, '\\n', -1)), l -> {})[0]"
    real = "filter(l, x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    stay = f"if(doc_id is null, {real}, transform(coalesce(__stay, cast(array() as array<int>)), i -> l[i]))"
    new = split.format(f"named_struct('n', size({real}), 'text', if(l is null, null, array_join({stay}, '\\n')))")
    # One row for each text, so that it is split once for the count and the text.
    joined = rows.join(kept.hint("shuffle_hash"), same, "left").select("doc_id", *carry, "__stay", F.explode(F.array(F.expr(new))).alias("__new"))
    count = F.coalesce("__new.n", F.lit(0)).cast("long")
    stays = F.when(F.col("doc_id").isNull(), count).otherwise(F.coalesce(F.size("__stay"), F.lit(0)).cast("long"))
    return joined.select("doc_id", count.alias("n_lines"), stays.alias("n_kept"), *carry, F.col("__new.text").alias("text"))


SQL = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, generate_subscripts(parts, 1) - 1 AS no, unnest(parts) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
lines AS (SELECT * FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
owners AS MATERIALIZED (SELECT line, min((doc_id, no)) AS o, row_number() OVER (ORDER BY min((doc_id, no))) AS node FROM lines GROUP BY line),
shingles AS MATERIALIZED (
  SELECT DISTINCT node, line[s + 1 : s + {SHINGLE_CHARS}] AS g FROM (SELECT node, line, unnest(range(0, greatest(0, length(line) - {SHINGLE_CHARS}) + 1)) AS s FROM owners)),
sizes AS MATERIALIZED (SELECT node, count(*) AS n FROM shingles GROUP BY node),
pairs AS (SELECT a.node AS a, b.node AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.g = b.g AND a.node < b.node GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS node, a AS other FROM both_ways UNION SELECT reach.node, b FROM reach JOIN both_ways ON reach.other = a),
gone AS (SELECT node FROM reach GROUP BY node HAVING min(other) < node),
stay AS (SELECT o, line FROM owners WHERE node NOT IN (SELECT node FROM gone)),
kept AS (SELECT o[1] AS doc_id, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY o) AS text FROM stay GROUP BY 1)
SELECT d.doc_id, (SELECT count(*) FROM lines x WHERE x.doc_id = d.doc_id) AS n_lines, coalesce(n_kept, 0) AS n_kept, md5(CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END) AS kept_md5
FROM documents d LEFT JOIN kept USING (doc_id)"""
