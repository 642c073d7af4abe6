"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.llm.shared import stored
from tenderline.llm.text import SEPARATOR, chunks, shingle_hashes, word_hashes, words

#: The signs counted as symbols, and frequent words of four languages.
SYMBOLS = b"#*$%&|<>"
STOP_WORDS = frozenset(
    "the of and to in is that it for was on with as be at by this not are from or have an "
    "der die das und ist nicht ein eine den von zu mit sich auf für im dem des "
    "le la les et des est un une du que en qui dans pour sur pas au il ne "
    "el los las y de que es en un una por con no se su para al lo como".split()
)
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_alpha_words", "n_stop_words")
MIN_WORDS = 50


def _repeated(hashes: np.ndarray) -> int:
    if len(hashes) < 3:
        return 0
    _, inverse, counts = np.unique(shingle_hashes(hashes, 3), return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(hashes), dtype=bool)
    for i in range(3):
        covered[i : i + len(twice)] |= twice
    return int(covered.sum())


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    letter = np.zeros(256, dtype=bool)
    letter[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    stops = [w.encode() for w in STOP_WORDS]
    joined = np.frombuffer(b"".join(stops), np.uint8)
    ends = np.cumsum([len(w) for w in stops])
    stop = np.sort(word_hashes(joined, ends - [len(w) for w in stops], ends))
    space = " \t\n\v\f\r"
    for batch in batches:
        out = [[] for _ in STATS + EXTRA]
        for first, end, data, offsets in chunks(batch.column(1)):
            starts, stopped, index = words(data, offsets)
            hashes = word_hashes(data, starts, stopped)
            points = np.r_[0, np.cumsum(~SEPARATOR[data] & ((data & 0xC0) != 0x80))]
            symbols, letters = np.r_[0, np.cumsum(symbol[data])], np.r_[0, np.cumsum(letter[data])]
            alpha = np.r_[0, np.cumsum(letters[stopped] > letters[starts])]
            at = np.searchsorted(stop, hashes)
            frequent = np.r_[0, np.cumsum(stop[np.minimum(at, len(stop) - 1)] == hashes)]
            texts = batch.column(1).slice(first, end - first)
            for i in range(end - first):
                a, b, x, y = offsets[i], offsets[i + 1], index[i], index[i + 1]
                lines = [line for line in (texts[i].as_py() or "").split("\n") if line.strip(space)]
                row = (y - x, points[b] - points[a], symbols[b] - symbols[a], len(lines) - len(set(lines)), _repeated(hashes[x:y]), len(lines), alpha[y] - alpha[x], frequent[y] - frequent[x])
                for column, value in zip(out, row, strict=True):
                    column.append(int(value))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in out]], names=["doc_id", *STATS, *EXTRA])


def vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes for (1) and against (-1) quality, 0 to abstain, by name."""
    n, lines = F.col("n_words"), F.col("n_lines")
    per_word = lambda c: F.col(c) / F.nullif(n, F.lit(0))
    out = {}
    for name, value, good, bad in (
        ("length", n, lambda v: v.between(100, 50_000), lambda v: v < MIN_WORDS),
        ("word_length", per_word("word_chars"), lambda v: v.between(3, 10), lambda v: (v < 2) | (v > 15)),
        ("symbols", per_word("n_symbols"), lambda v: v <= 0.05, lambda v: v > 0.2),
        ("lines", F.col("n_dup_lines") / F.nullif(lines, F.lit(0)), lambda v: v <= 0.1, lambda v: v > 0.3),
        ("repetition", per_word("n_repeat_words"), lambda v: v <= 0.1, lambda v: v > 0.3),
        ("letters", per_word("n_alpha_words"), lambda v: v >= 0.8, lambda v: v < 0.6),
        ("stop_words", F.when(n >= MIN_WORDS, per_word("n_stop_words")), lambda v: v >= 0.1, lambda v: v < 0.05),
    ):
        out[name] = vote(value, good(value), bad(value))
    return out


def fit_accuracies(votes: np.ndarray, counts: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Per rule the chance that its vote is right on good and on bad documents, and the share of good ones.

    Expectation-maximisation over vote patterns; abstaining says nothing. It starts from the filter in which
    all must pass (mostly bad where any rule votes against), which also tells which class is the good one.
    A rule that votes the same way on both classes ends up without weight."""
    weight = counts / max(1, counts.sum())
    p = np.where((votes < 0).any(axis=1), 0.2, 0.9)
    accuracy, share = np.full((2, votes.shape[1]), 0.8), 0.7
    for _ in range(rounds):
        right = np.stack([(weight * p) @ (votes > 0), (weight * (1 - p)) @ (votes < 0)])
        cast = np.stack([(weight * p) @ (votes != 0), (weight * (1 - p)) @ (votes != 0)])
        accuracy = np.clip((right + 0.8e-4) / (cast + 1e-4), 0.001, 0.999)
        share = float(np.clip(weight @ p, 0.02, 0.98))
        now = posterior(votes, accuracy, share)
        moved, p = np.abs(now - p).max(initial=0.0), now
        if moved < 1e-9:
            break
    return accuracy, share


def log_odds(accuracy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a vote for and a vote against add to the log odds of a good document."""
    return np.log(accuracy[0] / (1 - accuracy[1])), np.log((1 - accuracy[0]) / accuracy[1])


def posterior(votes: np.ndarray, accuracy: np.ndarray, share: float) -> np.ndarray:
    for_, against = log_odds(accuracy)
    return 1 / (1 + np.exp(-(np.log(share / (1 - share)) + (votes > 0) @ for_ + (votes < 0) @ against)))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, `quality` (posterior probability, 0 to 1), kept.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word that equal an
    earlier line of the text), n_repeat_words (words in 3-word windows found at least twice in the text).
    base_failed: fewer than 50 words, or more than half of them repeated. kept: not base_failed and quality
    >= threshold. The rules' accuracies are estimated over all rows: the votes are grouped, and the
    driver sees one row for each vote pattern (three to the number of rules at most). Whole texts; a
    null text has no words. Rows are independent but for the accuracies; null and repeated ids are
    rows like others. Other columns are not read. An empty table gives none."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    stats = rows.mapInArrow(_stats, "doc_id long, " + ", ".join(f"{c} long" for c in STATS + EXTRA))
    named = rules()
    stats = stored(stats.select("*", F.array(*[v.cast("byte") for v in named.values()]).alias("votes")), "votes")
    # In a fixed order, so that sums over the patterns have the same bits however the rows came.
    patterns = sorted(stats.groupBy("votes").count().collect(), key=lambda r: r.votes)
    votes = np.array([r.votes for r in patterns], dtype=float).reshape(len(patterns), len(named))
    accuracy, share = fit_accuracies(votes, np.array([r["count"] for r in patterns], dtype=float))
    odds = F.lit(float(np.log(share / (1 - share))))
    for k, (for_, against) in enumerate(zip(*log_odds(accuracy), strict=True)):
        cast = F.get("votes", F.lit(k))
        odds = odds + F.when(cast > 0, float(for_)).when(cast < 0, float(against)).otherwise(0.0)
    probability = 1 / (1 + F.exp(-odds))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = stats.select("doc_id", *STATS, failed.alias("base_failed"), probability.alias("quality"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
