"""Toxicity: cumulative-link ordinal regression over sparse word features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.llm.shared import hashed_sample, stored
from tenderline.llm.text import texts_of

#: Bound of the labelled documents that the model is fitted on.
SAMPLE_DOCS = 20_000
#: A word is a feature if it is in MIN_DOCS toxic documents and MIN_Z standard errors more frequent there. Since it is in MIN_DOCS of the
#: sample's documents, the sample bounds the number of features, too.
MIN_DOCS = 5
MIN_Z = 6.0
#: What the ridge and the cut are chosen from, by labels held out of the fit: every HELD_OUT-th document of the sample.
RIDGES = (1e-3, 1e-4, 1e-5)
CUTS = tuple(k / 20 for k in range(2, 20))
HELD_OUT = 5
FALSE_ALARMS = 0.002

WORD = r"\p{L}+"


def graded(labels: DataFrame, docs: DataFrame, sample: int = SAMPLE_DOCS, seed: int = 3) -> DataFrame:
    """(doc_id, text, grade) of about `sample` labelled documents, grade being the 0 or 1 of `toxic`.

    Labels without it are left out. The labels are sampled first, so what is broadcast is as many rows of two numbers."""
    known = labels.where("toxic is not null").select("doc_id", F.col("toxic").alias("grade"))
    return docs.select("doc_id", "text").join(F.broadcast(hashed_sample(known, sample, seed, "doc_id")), "doc_id")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grade, words, counts, part) of texts: distinct lower-case words."""
    word = regex.compile(WORD)
    for batch in batches:
        found = [Counter(word.findall(t.lower())) if t else Counter() for part in texts_of(batch.column(1), 256) for t in part]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([list(c) for c in found], pa.list_(pa.string())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32())), batch.column(2)],
            names=["grade", "words", "counts", "part"],
        )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, levels: int, ridge: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights w and ascending thresholds t of P(grade > k) = sigmoid(w.x - t_k), by gradient steps (Adam).

    All thresholds share w. They are t_0 plus sums of squares, so they stay in order."""
    n = max(1, len(grades))
    w = np.zeros(width)
    above = np.array([(grades > k).mean() for k in range(levels - 1)]) if len(grades) else np.full(levels - 1, 0.5)
    start = -np.log(np.clip(above, 1e-4, 1 - 1e-4) / (1 - np.clip(above, 1e-4, 1 - 1e-4)))
    free = np.r_[start[:1], np.sqrt(np.maximum(np.diff(start), 1e-3))]
    theta = np.r_[w, free]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, free = theta[:width], theta[width:]
        t = np.cumsum(np.r_[free[:1], free[1:] ** 2])
        score = np.bincount(rows, values * w[columns], minlength=len(grades))
        upper = np.c_[np.ones(len(grades)), _sigmoid(score[:, None] - t)]
        upper = np.c_[upper, np.zeros(len(grades))]
        at = np.arange(len(grades))
        p = np.maximum(upper[at, grades] - upper[at, grades + 1], 1e-12)
        slope = upper * (1 - upper)
        d_score = -(slope[at, grades] - slope[at, grades + 1]) / p
        d_t = np.zeros(levels + 1)
        np.add.at(d_t, grades, slope[at, grades] / p)
        np.add.at(d_t, grades + 1, -slope[at, grades + 1] / p)
        d_t = d_t[1:levels] / n
        d_free = np.cumsum(d_t[::-1])[::-1] * np.r_[1.0, 2 * free[1:]]
        grad = np.r_[np.bincount(columns, values * d_score[rows], minlength=width) / n + ridge * w, d_free]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    free = theta[width:]
    return theta[:width], np.cumsum(np.r_[free[:1], free[1:] ** 2])


def chances(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > k) for each threshold k, one row for each score."""
    return _sigmoid(np.asarray(scores, dtype=float)[:, None] - thresholds)


def chosen_cut(p: np.ndarray, toxic: np.ndarray, false_alarms: float = FALSE_ALARMS) -> tuple[float, float, float]:
    """(cut, share of the toxic found, share of the others found) for the lowest cut of CUTS that keeps to the rate of false alarms.

    Where none does, the highest cut."""
    for cut in CUTS:
        wrong = float((p[~toxic] >= cut).mean()) if (~toxic).any() else 0.0
        if wrong <= false_alarms:
            break
    return cut, float((p[toxic] >= cut).mean()) if toxic.any() else 1.0, wrong


def chosen_ridge(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, levels: int, out: np.ndarray) -> tuple[float, float, float, float]:
    """(ridge, cut, recall, false alarms): the ridge that finds most of the toxic among the rows marked in `out`, which are not fitted.

    Of equal ones the largest ridge. Where nothing toxic or nothing clean is held out, the middle ridge and a cut of one half."""
    if len({*(grades[out] > 0).tolist()}) < 2 or len({*(grades[~out] > 0).tolist()}) < 2:
        return RIDGES[1], 0.5, float("nan"), float("nan")
    place = np.cumsum(~out) - 1
    used, best = ~out[rows], None
    for ridge in RIDGES:
        w, t = fit_ordinal(place[rows[used]], columns[used], values[used], grades[~out], width, levels, ridge)
        scores = np.bincount(rows, values * w[columns], minlength=len(grades))
        found = chosen_cut(chances(scores[out], t)[:, 0], grades[out] > 0)
        if best is None or found[1] > best[2]:
            best = (ridge, *found)
    return best


def fit(labelled: DataFrame, sample: int = SAMPLE_DOCS, split: int = 3, seed: int = 3) -> dict:
    """A model out of about `sample` rows (doc_id, text, grade), chosen by a hash; grades are 0, 1, 2 and so on.

    Words are counted in Spark: features are those in MIN_DOCS documents above grade 0, whose share among those
    exceeds that among the others by MIN_Z standard errors. Each of them counts, also one that mostly occurs beside a stronger
    one: the driver gets their occurrences in the sample and fits the regression to all. Ridge and cut are chosen by a fifth of the sample that is held out of
    a first fit: the cut is the lowest with at most FALSE_ALARMS of the clean documents above it, the ridge the one that then finds most of the
    toxic ones; `held_out` of the model says how many of both. The regression is then fitted to all rows with that ridge.

    Where the labels have only 0 and 1, the 1s are split into `split` grades at quantiles of how much of these words they hold, so
    that severity has an order: it is then derived from the features, not from the labels. Rows without text or grade are left out. Without rows, or with one grade only, or without
    a telling word, the model says grade 0 for all."""
    rows = labelled.where("text is not null and grade is not null")
    chosen = hashed_sample(rows, sample, seed, "doc_id").select("doc_id", F.col("grade").cast("int").alias("grade"), "text")
    many = max(8, chosen.sparkSession.sparkContext.defaultParallelism)
    # Dealt by id and text, so that copies of one text are spread as well; the rest of the division says who is held out.
    dealt = chosen.withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text"), F.lit(HELD_OUT)).cast("int"))
    bags = dealt.repartition(many, "doc_id", "text").select("grade", "text", "part").mapInArrow(_features, "grade int, words array<string>, counts array<int>, part int")
    bags = stored(bags.withColumn("row", F.monotonically_increasing_id()), "bags")
    none = {"words": {}, "weights": np.zeros(0), "thresholds": np.full(1, 40.0), "cut": 0.5, "held_out": {"recall": float("nan"), "false_alarms": float("nan")}}
    sizes = {r["grade"]: r["n"] for r in bags.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    toxic, total = sum(n for g, n in sizes.items() if g > 0), sum(sizes.values())
    if toxic in (0, total):
        return none
    held = bags.select("row", "grade", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("row", "grade", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    seen = held.groupBy("word").agg(F.count(F.when(F.col("grade") > 0, 1)).alias("a"), F.count("*").alias("k")).where(f"a >= {MIN_DOCS}")
    share = F.col("k") / float(total)
    error = F.sqrt(share * (1 - share) * (1 / float(toxic) + 1 / float(total - toxic)))
    z = (F.col("a") / float(toxic) - (F.col("k") - F.col("a")) / float(total - toxic)) / F.nullif(error, F.lit(0.0))
    words = [r["word"] for r in seen.withColumn("z", z).where(F.col("z") >= MIN_Z).orderBy("word").collect()]
    if not words:
        return none
    # One row for each sampled document, with its candidate words only; in an order that does not depend on how rows came.
    known = F.array_sort(F.filter(F.arrays_zip("words", "counts"), lambda x: x.words.isin(words)))
    sparse = sorted(bags.select("grade", "part", known.alias("x")).collect(), key=lambda r: (r["grade"], r["part"], r["x"]))
    grades = np.array([r["grade"] for r in sparse])
    column = {w: i for i, w in enumerate(words)}
    at = [(i, column[e["words"]], np.log1p(e["counts"])) for i, r in enumerate(sparse) for e in r["x"]]
    r, c, v = (np.array([e[k] for e in at], dtype=d) for k, d in enumerate((np.int64, np.int64, float)))
    if grades.max() == 1 and split > 1:
        held_words = np.bincount(r, v, minlength=len(grades))
        cuts = np.unique(np.quantile(held_words[(grades > 0) & (held_words > 0)], np.arange(1, split) / split))
        grades = np.where(grades > 0, 1 + (held_words[:, None] > cuts).sum(axis=1), 0)
    levels = int(grades.max()) + 1
    ridge, cut, recall, wrong = chosen_ridge(r, c, v, grades, len(words), levels, np.array([e["part"] == 0 for e in sparse]))
    weights, thresholds = fit_ordinal(r, c, v, grades, len(words), levels, ridge)
    return {"words": column, "weights": weights, "thresholds": thresholds, "cut": cut, "held_out": {"recall": recall, "false_alarms": wrong}}


def severity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the columns of `carry`, expected_severity (the mean grade, 0 to levels - 1), p_toxic (P(grade > 0)), grade
    (the most probable one, the least of equals), toxic (p_toxic at or above the cut of the model).

    Features are logarithms of word counts in the whole text. A null or empty text has no features.
    Rows are independent: null and repeated ids are rows like others. Other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, place, weights, thresholds = regex.compile(WORD), shared.value["words"], shared.value["weights"], shared.value["thresholds"]
        cut = shared.value["cut"]
        for batch in batches:
            scores = []
            for part in texts_of(batch.column(1), 256):
                for text in part:
                    found = Counter(w for w in word.findall(text.lower()) if w in place) if text and place else {}
                    scores.append(sum(weights[place[w]] * np.log1p(n) for w, n in sorted(found.items())))
            upper = chances(scores, thresholds)
            p = np.c_[np.ones(len(scores)), upper] - np.c_[upper, np.zeros(len(scores))]
            columns = [pa.array(upper.sum(axis=1)), pa.array(upper[:, 0]), pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(upper[:, 0] >= cut)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *columns], names=["doc_id", *carry, "expected_severity", "p_toxic", "grade", "toxic"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"), *carry)
    carried = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in carry)
    return rows.mapInArrow(run, f"doc_id long, {carried}expected_severity double, p_toxic double, grade int, toxic boolean")
