"""Bytes that repeat across documents: positions sampled by content, grouped by hash (in place of prefix doubling)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderline.llm.shared import discard, release, stored
from tenderline.llm.text import BASE, BYTES, CHUNK_BYTES, chunks, mixed, powers

FIRST = 16
#: Of the tables between steps, which stand beside the shuffles of the step that reads them.
CODEC = "zstd"
#: Spans whose bytes are gathered at once.
SPANS = 1 << 15
#: Groups of a window's places for its sample, each with a string that all windows of the group have.
GROUPS = 3
#: Bits of the ranks that are dealt; ranks equal by chance let runs pass that later steps find unique.
RANK_BITS = 48
#: Hot ranks: looked for in one document of SAMPLE; those in HOT_SHARE of them or more; HOT_RANKS at most.
SAMPLE, HOT_SHARE, HOT_RANKS = 64, 1e-3, 1_000_000


def _prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the FIRST bytes at each position, doubled from those of one byte."""
    h, size = BYTES[data], 1
    while size < FIRST:
        h = h[:-size] * np.uint64(pow(0x9E3779B97F4A7C15, size, 1 << 64)) + h[size:]
        size *= 2
    return mixed(h)


def sampled(data: np.ndarray, offsets: np.ndarray, length: int, h: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Runs of windows of `length` bytes that sample the same position: (text, first window, windows, place of
    the sample after the first window's start, hash). `h` has the hashes of `data` where they are known.

    A window samples the first of its positions whose hash of FIRST bytes is least. That depends on
    the bytes of the window alone, so equal windows sample equal bytes at equal places."""
    width = length - FIRST + 1
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    h = _prefix_hashes(data) if h is None else h
    least = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size < width:
        step = min(size, width - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Windows go by their place in `data`; those across two texts are left out, and each text begins a run.
    texts = np.flatnonzero(np.diff(offsets) >= length)
    begins = offsets[texts]
    new = np.zeros(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    new[begins] = True
    first = np.flatnonzero(new)
    text = np.searchsorted(offsets, first, side="right") - 1
    stops = offsets[text + 1] - length + 1
    inside = first < stops
    if not inside.any():
        return none, none, none, none, none
    runs = np.minimum(np.r_[first[1:], len(at)], stops)[inside]
    text, first = text[inside], first[inside]
    return text, first - offsets[text], runs - first, at[first] - first, h[at[first]].view(np.int64)


def grown(h: np.ndarray, at: np.ndarray, windows: np.ndarray, spot: np.ndarray, length: int) -> np.ndarray:
    """GROUPS ranks for the run of each sample at `at`, of strings of about three quarters of a window that hold the sample.

    Windows go in groups by the place of the sample after their start. What is before the sample at the first place of a
    group, and after it at the last, is in all windows of the group; with the sample it is ranked. 0 stands for a
    group that no window of the run is in. `h` has the hashes of the bytes."""
    spare = length - FIRST
    edges = [round(k * (spare + 1) / GROUPS) for k in range(GROUPS + 1)]
    ranks = np.zeros((len(at), GROUPS), np.uint64)
    for k, (low, high) in enumerate(zip(edges, [e - 1 for e in edges[1:]], strict=False)):
        if low > high:
            continue
        needed = (spot >= low) & (spot - windows < high)
        begin, rest = at[needed] - low, low + spare - high
        rank = np.full(len(begin), k + 1, np.uint64)
        # FIRST bytes at a time; the last may lie over those before.
        for step in (*range(0, rest, FIRST), rest):
            rank = mixed(rank * np.uint64(BASE) + h[begin + step])
        ranks[needed, k] = np.maximum(rank >> np.uint64(64 - RANK_BITS), np.uint64(1))
    return ranks.view(np.int64)


def _ranked(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, place of the sample, ranks of its groups) of the runs of a chunk."""
    h = _prefix_hashes(data)
    text, start, windows, spot, _ = sampled(data, offsets, length, h)
    return text, start, windows, spot, grown(h, offsets[text] + start + spot, windows, spot, length)


def _found(rank: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each rank is among others that are in order."""
    if not len(ordered):
        return np.zeros(len(rank), bool)
    return ordered[np.minimum(np.searchsorted(ordered, rank), len(ordered) - 1)] == rank


def _samples(length: int, hot: Broadcast | None):
    """(doc_id, rank) of the groups of each text's runs, without hot ranks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in chunks(batch.column(1)):
                text, _, _, _, ranks = _ranked(data, offsets, length)
                text, rank = np.repeat(text, GROUPS), ranks.ravel()
                cold = rank != 0
                if hot is not None:
                    cold &= ~_found(rank, hot.value)
                text, rank = text[cold], rank[cold]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text + first)), pa.array(rank)], names=["doc_id", "rank"])

    return run


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    return powers(n), powers(n, pow(BASE, -1, 1 << 64))


def _run_hashes(data: np.ndarray, begin: np.ndarray, size: np.ndarray, power: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """A hash of the bytes data[begin : begin + size] of each run, with the powers of BASE and of its inverse."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * power[: len(data)], dtype=np.uint64, out=sums[1:])
    # Divided by the power at the start, so that equal bytes are equal wherever they are.
    return mixed((sums[begin + size] - sums[begin]) * inverse[begin] + size.astype(np.uint64))


def _among(text: np.ndarray, rank: np.ndarray, ranks: pa.ListArray) -> np.ndarray:
    """Whether each rank is in the list of its text."""
    listed, bounds = ranks.values.to_numpy(), ranks.offsets.to_numpy()
    sizes = np.where(ranks.is_valid().to_numpy(zero_copy_only=False), np.diff(bounds), 0)
    if not sizes.sum():
        return np.zeros(len(rank), bool)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    listed = listed[np.arange(ends[-1]) + np.repeat(bounds[:-1] - (ends - sizes), sizes)]
    # Text and rank in one number. One met by chance lets a run pass that the grouping of runs then finds in no other document.
    names = [mixed(r.view(np.uint64) + t.astype(np.uint64) * np.uint64(BASE)) for t, r in ((owner, listed), (text, rank))]
    return _found(names[1], np.sort(names[0]))


def _runs(length: int, hot: Broadcast):
    """For rows (doc_id, tag, text, ranks): the runs of windows with a group that has one of these ranks or a hot one.

    k0 and so on are the ranks of such groups, or 0; same is a hash of the bytes under the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _powers(CHUNK_BYTES)
        for batch in batches:
            for first, end, data, offsets in chunks(batch.column(2)):
                power, inverse = held if len(data) <= CHUNK_BYTES else _powers(len(data))
                text, start, windows, spot, ranks = _ranked(data, offsets, length)
                held_by, rank = np.repeat(text, GROUPS), ranks.ravel()
                alive = _found(rank, hot.value)
                rest = np.flatnonzero(~alive & (rank != 0))
                alive[rest] = _among(held_by[rest], rank[rest], batch.column(3).slice(first, end - first))
                ranks = np.where(alive, rank, 0).reshape(-1, GROUPS)
                alive = ranks.any(axis=1)
                text, start, windows, spot, ranks = (x[alive] for x in (text, start, windows, spot, ranks))
                same = _run_hashes(data, offsets[text] + start, windows + length - 1, power, inverse).view(np.int64)
                take = pa.array(text + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int16)), pa.array(spot.astype(np.int16)), *[pa.array(k.copy()) for k in ranks.T], pa.array(same)],
                    names=["doc_id", "tag", "start", "windows", "spot", *[f"k{k}" for k in range(GROUPS)], "same"],
                )

    return run


def _bytes_of(length: int):
    """For rows (doc_id, text, runs): the bytes of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in chunks(batch.column(1)):
                lists = batch.column(2).slice(first, end - first)
                bounds = lists.offsets.to_numpy()
                owner = np.repeat(np.arange(end - first), np.diff(bounds))
                for at in range(0, len(owner), SPANS):
                    runs, of = lists.values.slice(bounds[0] + at, min(SPANS, len(owner) - at)), owner[at : at + SPANS]
                    begin = offsets[of] + runs.field("start").to_numpy()
                    size = runs.field("windows").to_numpy().astype(np.int64) + length - 1
                    ends = np.cumsum(size)
                    span = data[np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)]
                    spans = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(np.r_[0, ends].astype(np.int32)), pa.py_buffer(span)])
                    same = batch.column(0).take(pa.array(of + first))
                    yield pa.RecordBatch.from_arrays([runs.field("id"), same, runs.field("windows"), runs.field("spot"), spans], names=["id", "doc_id", "windows", "spot", "span"])

    return run


def _hot_ranks(rows: DataFrame, length: int) -> np.ndarray:
    """Ranks that a sample of one document in SAMPLE finds in about HOT_SHARE of the documents or more, if they
    are few enough to be sent to all tasks. They only spread the work: being hot, they count as repeated."""
    part = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(SAMPLE)) == 0)
    floor = max(16, int(part.count() * HOT_SHARE))
    ranks = part.select("doc_id", "text").mapInArrow(_samples(length, None), "doc_id long, rank long").groupBy("rank").count().where(F.col("count") >= floor)
    found = ranks.select("rank").limit(HOT_RANKS + 1).toArrow().column(0).to_numpy()
    return np.sort(found if len(found) <= HOT_RANKS else found[:0])


def _remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            doc, text, starts, ends = batch.column(0)[i].as_py(), batch.column(1)[i], batch.column(2)[i], batch.column(3)[i]
            text = text.as_buffer().to_pybytes() if text.is_valid else b""
            if not starts.is_valid or not len(starts):
                rows.append((doc, len(text), 0, 0, hashlib.sha256(text).hexdigest(), [], []))
                continue
            a, b = starts.values.to_numpy(), ends.values.to_numpy()
            order = np.argsort(a, kind="stable")
            a, b = a[order], np.maximum.accumulate(b[order])
            new = np.r_[True, a[1:] > b[:-1]]
            a, b = a[new].tolist(), b[np.r_[np.flatnonzero(new)[1:] - 1, len(b) - 1]].tolist()
            left, at = hashlib.sha256(), 0
            for x, y in zip(a, b, strict=True):
                left.update(text[at:x])
                at = y
            left.update(text[at:])
            rows.append((doc, len(text), sum(b) - sum(a), len(a), left.hexdigest(), a, b))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def _grown(spans: DataFrame, length: int) -> DataFrame:
    """(id, at) of the windows of (id, doc_id, span, windows, spot) that also start in a document smaller than the span's own.

    A window holds the sampled FIRST bytes and, before or after them, at least half of its other bytes: a side. One
    that is in one of these documents only leaves. What is left grows to whole windows, each ranked by its halves."""
    half = (length - FIRST) // 2
    right = spans.where(f"spot + {FIRST + half} <= length(span)")
    left = spans.where(f"spot > {half}")
    sides = right.select("id", "doc_id", "span", F.expr(f"spot - {half}").alias("from"), (F.col("windows") - 1).alias("to"), F.lit(1).alias("side"), F.expr(f"xxhash64(substring(span, spot + 1, {FIRST + half}))").alias("grown"))
    sides = sides.union(left.select("id", "doc_id", "span", F.lit(0), F.expr(f"least(windows - 1, spot - {half + 1})"), F.lit(0), F.expr(f"xxhash64(substring(span, spot - {half} + 1, {FIRST + half}))")))
    shared = sides.groupBy("side", "grown").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("side", "grown")
    # Joins are with what is left of the groups, looked up by hash, so that the many rows beside it need not be sorted.
    alive = sides.join(shared.hint("shuffle_hash"), ["side", "grown"], "left_semi").withColumn("from", F.expr("greatest(0, from)"))
    alive = stored(alive.where("from <= to").select("id", "doc_id", "span", "from", "to"), "grown", CODEC)
    release(alive.sparkSession)
    spots = alive.select("id", "doc_id", "span", F.explode(F.sequence("from", "to")).alias("at"))
    cut = length // 2
    spots = spots.select("id", "doc_id", "at", F.expr(f"xxhash64(substring(span, at + 1, {cut}))").alias("first"), F.expr(f"xxhash64(substring(span, at + {cut + 1}, {length - cut}))").alias("second"))
    least = spots.groupBy("first", "second").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most")
    # Stored, so that the windows dealt to be grouped are gone before they are dealt to be looked up.
    least = stored(least, "least", CODEC)
    release(alive.sparkSession)
    return spots.join(least.hint("shuffle_hash"), ["first", "second"]).where("least < doc_id").select("id", "at")


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed runs as starts and ends.

    Removed is each byte under a string of `length` bytes that also starts in a document with a smaller
    id; strings are those of the input, never across documents. Texts are taken whole, as UTF-8.

    Ranks by growing strings, dropping positions as soon as they are unique to a document:
    1. Strings of about three quarters of a window, up to GROUPS for each run of windows that sample one position of FIRST
       bytes (about 1 of 18 positions), see `grown`. A window whose string occurs in one document cannot repeat.
       FIRST bytes alone are not ranked: the more text there is the more of them repeat by chance, and what they let
       pass would grow faster than the input. Ranks are dealt once; those in several documents return to
       theirs. Ranks that very many documents have are known from a sample and not dealt.
    2. The bytes under the whole run of windows, as a hash beside the ranks. Runs with equal bytes are one class; in all its documents
       but the least every window is removed.
    3. For the least document of classes that share a rank with others: whole windows (`_grown`).

    Null text has no bytes. A row with a null id is neither changed nor a source. Rows that repeat an id are
    one document as to "smaller", each with its own text. Other columns are not read."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = rows.where("doc_id is not null and text is not null")
    hot = spark.sparkContext.broadcast(_hot_ranks(named, length))
    samples = named.mapInArrow(_samples(length, hot), "doc_id long, rank long")
    # A window, since both sides of a join would make and deal the samples, each for itself.
    same = Window.partitionBy("rank")
    alive = samples.select("doc_id", "rank", F.min("doc_id").over(same).alias("lo"), F.max("doc_id").over(same).alias("hi")).where("lo < hi")
    # A tag tells rows that repeat an id; it would be most of what is dealt of a run, so others have none.
    many = rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("many"))
    alive = stored(alive.groupBy("doc_id").agg(F.collect_set("rank").alias("ranks")).join(many, "doc_id", "full"), "alive", CODEC)
    release(spark)

    known = named.join(alive.hint("shuffle_hash"), "doc_id", "left").select("doc_id", F.expr("if(many, xxhash64(text), null)").alias("tag"), F.col("text").cast("binary").alias("text"), "ranks")
    name = [f"k{k}" for k in range(GROUPS)] + ["same"]
    runs = stored(known.mapInArrow(_runs(length, hot), f"doc_id long, tag long, start int, windows short, spot short, {', '.join(f'{k} long' for k in name)}"), "runs", CODEC)
    discard(alive)
    release(spark)

    classes = runs.groupBy(*name).agg(F.min("doc_id").alias("least"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes", CODEC)
    release(spark)
    held = classes.select("id", "least", F.explode(F.array(*name[:-1])).alias("rank")).where("rank <> 0")
    shared = held.groupBy("rank").agg(F.min("least").alias("lo"), F.max("least").alias("hi")).where("lo < hi").select("rank")
    contested = stored(held.join(shared.hint("shuffle_hash"), "rank", "left_semi").select("id").distinct(), "contested", CODEC)
    release(spark)
    flagged = classes.join(contested.withColumn("contested", F.lit(True)).hint("shuffle_hash"), "id", "left")
    # Few wide columns are dealt: compressed rows cost more by the number of their parts than by their bytes.
    named_by = [F.xxhash64(*name[:-1]).alias("key"), "same"]
    dealt = runs.select(*named_by, "doc_id", "tag", F.expr("shiftleft(cast(start as bigint), 30) | shiftleft(cast(windows as bigint), 15) | spot").alias("place"))
    dealt = dealt.join(flagged.select(*named_by, "least", "id", "contested").hint("shuffle_hash"), ["key", "same"]).where("doc_id > least or contested")
    places = ["cast(shiftright(place, 30) as int) as start", "cast(shiftright(place, 15) & 32767 as short) as windows", "cast(place & 32767 as short) as spot"]
    hits = stored(dealt.selectExpr("doc_id", "tag", *places, "least", "id", "contested"), "hits", CODEC)
    discard(runs, classes, contested)
    release(spark)

    theirs = "doc_id = of and (tag is null or tag = xxhash64(text))"
    # One run of each contested class, in its least document; their bytes come from the texts once more.
    chosen = hits.where("contested and doc_id = least").select("id", "doc_id", "tag", "start", "windows", "spot").dropDuplicates(["id", "doc_id"])
    chosen = chosen.select("doc_id", "tag", F.struct("id", "start", "windows", "spot").alias("run"))
    chosen = chosen.groupBy("doc_id", "tag").agg(F.collect_list("run").alias("runs"))
    chosen = chosen.withColumnRenamed("doc_id", "of").hint("shuffle_hash")
    texts = named.join(chosen, F.expr(theirs)).select("doc_id", F.col("text").cast("binary").alias("text"), "runs")
    spans = stored(texts.mapInArrow(_bytes_of(length), "id long, doc_id long, windows short, spot short, span binary"), "spans", CODEC)
    release(spark)
    marks = stored(_grown(spans, length), "marks", CODEC)
    discard(spans)
    release(spark)

    copies = hits.where("doc_id > least").select("doc_id", "tag", F.col("start").alias("a"), F.expr(f"start + windows + {length - 1}").alias("b"))
    single = hits.where("doc_id = least").join(marks.hint("shuffle_hash"), "id").select("doc_id", "tag", F.expr("start + at").alias("a"), F.expr(f"start + at + {length}").alias("b"))
    removed = copies.union(single).groupBy("doc_id", "tag").agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    removed = removed.withColumnRenamed("doc_id", "of").hint("shuffle_hash")
    whole = rows.join(removed, F.expr(theirs), "left").select("doc_id", F.col("text").cast("binary").alias("text"), "a", "b")
    return whole.mapInArrow(_remaining, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<int>, ends array<int>")
