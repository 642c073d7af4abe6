"""Near-duplicate documents: one-permutation MinHash, optimal densification, star-shaped candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.llm.shared import agree, components, discard, ends, numbered, star_components, stored
from tenderline.llm.text import LOWER, chunks, mixed, shingle_hashes, word_hashes, words

BINS = 128
ROWS_PER_BAND = 4
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _donors(tries: int) -> np.ndarray:
    """For each bin a fixed pseudo-random sequence of bins to borrow from."""
    seeds = np.arange(BINS * tries, dtype=np.uint64).reshape(BINS, tries)
    return (mixed(seeds + np.uint64(0x5851F42D4C957F2D)) >> np.uint64(57)).astype(np.uint8)


DONORS = _donors(1024)


def signature(shingles: np.ndarray) -> np.ndarray:
    """One minimum per bin of a sorted hash set; an empty bin takes that of the first filled bin of its sequence."""
    bins = (shingles >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    out = np.full(BINS, EMPTY)
    out[bins[first]] = shingles[first]
    filled = np.zeros(BINS, dtype=bool)
    filled[bins[first]] = True
    empty = np.flatnonzero(~filled)
    for tries in (32, DONORS.shape[1]):
        if not len(empty):
            break
        found = filled[DONORS[empty, :tries]]
        hit = found.any(axis=1)
        out[empty[hit]] = out[DONORS[empty[hit], found[hit].argmax(axis=1)]]
        empty = empty[~hit]
    out[empty] = shingles[0]
    return out


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per text the sorted hashes of its distinct word shingles, A-Z taken as a-z."""
    for first, end, data, offsets in chunks(column):
        data = LOWER[data]
        starts, ends, index = words(data, offsets)
        hashes = word_hashes(data, starts, ends)
        for i in range(end - first):
            yield np.unique(shingle_hashes(hashes[index[i] : index[i + 1]], size))


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d1, d2, sigs = [], [], [], []
            for s in shingle_sets(batch.column(1), size):
                n.append(len(s))
                d1.append(mixed(s).sum(dtype=np.uint64))
                d2.append(mixed(s ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64))
                sigs.append(signature(s) if len(s) else np.full(BINS, EMPTY))
            if not n:
                continue
            sig = np.stack(sigs).reshape(len(n), -1, ROWS_PER_BAND)
            band = np.broadcast_to(np.arange(sig.shape[1], dtype=np.uint64), sig.shape[:2])
            for i in range(ROWS_PER_BAND):
                band = mixed(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, i])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, band.size + 1, band.shape[1], dtype=np.int32)), pa.array(np.ascontiguousarray(band).view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(np.array(d1, np.uint64).view(np.int64)), pa.array(np.array(d2, np.uint64).view(np.int64)), lists, batch.column(2)],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "tag"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = 256
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                sets = [s.view(np.int64) for s in shingle_sets(part.column(1), size)]
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["node", "items"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least doc_id reachable over links), kept.

    Two documents are linked when 100 * intersection >= percent * union of their sets of distinct word
    shingles (A-Z as a-z; with fewer words, the whole sequence is the one shingle). Sets come from whole
    texts; equal sets are one class, and classes are the nodes of the graph, numbered apart from the ids.

    Candidates: 128 one-permutation minima, empty bins densified, 32 bands of 4. A pair at 0.8 shares no
    band in about 5 of 10^8 cases. `star_components` compares them on full sets.

    Null or empty texts and texts without words have no shingle and no link. An id that several texts carry is
    one document: its texts are linked with each other, too, in so far as they have shingles. Rows with a null id take the
    component of their class, or null; they link nothing; kept is true for those with null. Repeated rows are rows of one
    class and each is returned. Other columns of the input are not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tagged = rows.withColumn("tag", F.xxhash64("text"))
    signatures = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, tag long"
    signed = stored(tagged.mapInArrow(_signatures(shingle_words), signatures), "signatures")
    owner = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "tag"))).alias("owner")
    classes = signed.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(owner, F.first("bands").alias("bands"))
    classes = classes.where("owner is not null").select("d1", "d2", "n_shingles", "owner.*", "bands")
    classes = numbered(classes, ["doc_id", "tag", "d1", "d2"], F.col("doc_id"), "classes")
    member = classes.select(F.explode("bands").alias("bucket"), "node")

    sizes = classes.select("node", "n_shingles")
    # Rows that repeat id and text give the set of their class once; looked for, since it costs a shuffle of sets to make sure.
    again = not signed.where("doc_id is not null").groupBy("doc_id", "tag").count().where("count > 1").isEmpty()

    def sets(nodes: DataFrame) -> DataFrame:
        wanted = classes.select("doc_id", "tag", "node").join(nodes, "node", "left_semi")
        texts = tagged.join(wanted, ["doc_id", "tag"]).select("node", "text")
        found = texts.mapInArrow(_sets(shingle_words), "node long, items array<long>")
        return found.dropDuplicates(["node"]) if again else found

    def confirm(pairs: DataFrame) -> DataFrame:
        ab = pairs.join(sizes.selectExpr("node as a", "n_shingles as n"), "a").join(sizes.selectExpr("node as b", "n_shingles as m"), "b")
        ab = ab.where(f"100 * least(n, m) >= {percent} * greatest(n, m)").select("a", "b")
        known = stored(sets(ends(ab)), "sets")
        ab = ab.join(known.selectExpr("node as b", "items as t"), "b").join(known.selectExpr("node as a", "items as s"), "a")
        found = stored(ab.where(agree("s", "t", percent)).select("a", "b").distinct(), "found")
        discard(known)
        return found

    def items(nodes: DataFrame) -> DataFrame:
        return sets(nodes).select("node", F.explode("items").alias("item"))

    labels = star_components(member, confirm, items, percent)

    of_class = signed.drop("bands", "tag").join(classes.select("d1", "d2", "n_shingles", "node"), ["d1", "d2", "n_shingles"], "left")
    labels = _with_ids(of_class, labels)
    out = of_class.withColumn("component", F.col("node")) if labels is None else of_class.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = out.where("node is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    component = F.coalesce("least", "doc_id")
    out = out.join(least, "component", "left")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def _with_ids(of_class: DataFrame, labels: DataFrame | None) -> DataFrame | None:
    """The components after classes that share an id are linked as well."""
    shared = of_class.where("doc_id is not null and node is not null").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("other")).where("b <> other")
    if shared.isEmpty():
        return labels
    edges = of_class.join(shared.select("doc_id", "b"), "doc_id").select(F.col("node").alias("a"), "b").where("a <> b")
    if labels is not None:
        edges = edges.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return components(edges)
