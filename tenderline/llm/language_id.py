"""Language of texts: word frequencies first, character n-grams for words never seen."""

from __future__ import annotations

import sys
import types
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.llm.shared import hashed_sample
from tenderline.llm.text import texts_of

#: Bound of what the model learns from: labelled documents, chosen by a hash.
SAMPLE_DOCS = 20_000
LONGEST_GRAM = 5
#: Bounds of what a worker remembers: words with their scores, and characters in those words.
CACHED_WORDS, CACHED_CHARS = 1 << 17, 1 << 22
#: Words that are looked up together.
TOGETHER = 1 << 15
UNDETERMINED = "und"


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of lower-case words, summed within slices of a batch, so that few are held at once."""
    letters = regex.compile(r"\p{L}+")
    for batch in batches:
        langs, at = batch.column(0).to_pylist(), 0
        for part in texts_of(batch.column(1), 256):
            words = Counter()
            for text in part:
                words.update((langs[at], w) for w in letters.findall(text.lower()))
                at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in words], pa.string()), pa.array([k[1] for k in words], pa.string()), pa.array(words.values(), pa.int64())], names=["lang", "word", "n"]
            )


def unit_counts(labelled: DataFrame) -> DataFrame:
    """(lang, kind, unit, n) over rows (lang, text): kind 0 are the words, kind k their n-grams of k characters.

    Words are counted first, and n-grams are taken from distinct words, weighted by their counts. A word stands
    between two underscores for that."""
    many = max(8, labelled.sparkSession.sparkContext.defaultParallelism)
    words = labelled.select("lang", "text").repartition(many).mapInArrow(_words, "lang string, word string, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    grams = "flatten(transform(sequence(1, {k}), k -> if(length(padded) < k, array(), transform(sequence(1, length(padded) - k + 1), i -> named_struct('kind', k, 'unit', substring(padded, i, k))))))"
    units = words.withColumn("padded", F.concat(F.lit("_"), "word", F.lit("_"))).select("lang", "n", F.inline(F.expr(grams.format(k=LONGEST_GRAM))))
    units = units.groupBy("lang", "kind", "unit").agg(F.sum("n").alias("n"))
    return words.select("lang", F.lit(0).alias("kind"), F.col("word").alias("unit"), "n").unionByName(units)


def code(unit: str) -> int:
    return xxhash.xxh64_intdigest(unit.encode("utf-8", "surrogatepass"))


def table(units: list[str], langs: np.ndarray, counts: np.ndarray, n_langs: int) -> dict[str, np.ndarray]:
    """Log frequencies of units: sorted codes, and for each the languages that have it.

    A unit that a language does not have has that language's frequency of one half. 64-bit codes stand for units; 12 bytes a unit and
    6 bytes for each language that has it. Plain arrays, so that they can be broadcast."""
    codes = np.fromiter(map(code, units), np.uint64, len(units))
    order = np.lexsort((langs, codes))
    codes, langs, counts = codes[order], langs[order], counts[order]
    distinct, first = np.unique(codes, return_index=True)
    totals = np.bincount(langs, counts, minlength=n_langs) + 0.5 * max(1, len(distinct))
    logs, absent = np.log((counts + 0.5) / totals[langs]), np.log(0.5 / totals)
    return {"codes": distinct, "starts": np.append(first, len(codes)).astype(np.int32), "langs": langs.astype(np.uint16), "logs": logs.astype(np.float32), "absent": absent.astype(np.float32)}


def places(known: dict[str, np.ndarray], units: list[str]) -> np.ndarray:
    """Where the units are in the table, -1 for those that are not."""
    wanted, codes = np.fromiter(map(code, units), np.uint64, len(units)), known["codes"]
    if not len(codes):
        return np.full(len(units), -1)
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[at] == wanted, at, -1)


def rows_at(known: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """One row of log frequencies for each place."""
    out = np.tile(known["absent"], (len(at), 1))
    many = known["starts"][at + 1] - known["starts"][at]
    row = np.repeat(np.arange(len(at)), many)
    flat = np.arange(len(row)) + np.repeat(known["starts"][at] - np.cumsum(many) + many, many)
    out[row, known["langs"][flat]] = known["logs"][flat]
    return out


def fit(labelled: DataFrame, sample: int = SAMPLE_DOCS, seed: int = 7) -> dict:
    """Log frequencies per language out of about `sample` documents (doc_id, text, lang), chosen by a hash.

    Nothing else is bounded: all words of those documents and all their n-grams up to LONGEST_GRAM characters are held."""
    known = labelled.where("text is not null and lang is not null")
    chosen = hashed_sample(known, sample, seed, "doc_id")
    found = unit_counts(chosen).toArrow()
    lang_of = found.column("lang").combine_chunks().dictionary_encode()
    lang_of = lang_of if isinstance(lang_of, pa.DictionaryArray) else lang_of.combine_chunks()
    names = lang_of.dictionary.to_pylist()
    langs = sorted(names)
    place = np.array([langs.index(n) for n in names], dtype=np.int64)
    lang_at = place[lang_of.indices.to_numpy()] if names else np.zeros(0, np.int64)
    kind, counts = found.column("kind").to_numpy(), found.column("n").to_numpy().astype(float)
    tables = []
    for k in range(LONGEST_GRAM + 1):
        here = kind == k
        tables.append(table(found.column("unit").filter(pa.array(here)).to_pylist(), lang_at[here], counts[here], len(langs)))
    return {"langs": langs, "words": tables[0], "grams": tables[1:]}


def scores(model: dict, words: list[str]) -> np.ndarray:
    """Per word the log frequencies of a known word; else the mean over its longest n-grams of which any is known; else nothing."""
    out = np.zeros((len(words), len(model["langs"])), np.float32)
    at = places(model["words"], words)
    out[at >= 0] = rows_at(model["words"], at[at >= 0])
    left = np.flatnonzero(at < 0)
    for size in range(LONGEST_GRAM, 0, -1):
        known, units, owner = model["grams"][size - 1], [], []
        for i in left.tolist():
            padded = f"_{words[i]}_"
            units += [padded[k : k + size] for k in range(len(padded) - size + 1)]
            owner.append(len(units))
        at = places(known, units)
        owner = np.repeat(np.arange(len(left)), np.diff(np.array(owner, dtype=np.int64), prepend=0))[at >= 0]
        if len(owner):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            sums = np.add.reduceat(rows_at(known, at[at >= 0]).astype(np.float64), first, axis=0)
            out[left[owner[first]]] = sums / np.diff(np.append(first, len(owner)))[:, None]
            left = np.delete(left, owner[first])
    return out


class Predictor:
    """Languages of texts; the scores of words met are remembered up to a bound."""

    def __init__(self, model: dict):
        self.model, self.letters = model, regex.compile(r"\p{L}+")
        self.forget()

    def forget(self) -> None:
        self.place, self.rows, self.chars = {}, np.zeros((0, len(self.model["langs"])), np.float32), 0

    def learn(self, words: set[str]) -> None:
        fresh = words - self.place.keys()
        if len(self.place) + len(fresh) > CACHED_WORDS or self.chars > CACHED_CHARS:
            self.forget()
            fresh = words
        ordered = list(fresh)
        first = len(self.place)
        if first + len(ordered) > len(self.rows):
            grown = np.zeros((max(2 * len(self.rows), first + len(ordered)), self.rows.shape[1]), np.float32)
            grown[:first] = self.rows[:first]
            self.rows = grown
        self.rows[first : first + len(ordered)] = scores(self.model, ordered)
        self.place.update(zip(ordered, range(first, first + len(ordered)), strict=True))
        self.chars += sum(map(len, ordered))

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        langs = self.model["langs"]
        totals, numbers, waiting, size = np.zeros((len(texts), len(langs))), np.zeros(len(texts)), [], 0

        def add() -> None:
            self.learn({w for _, words in waiting for w in words})
            for i, words in waiting:
                at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                totals[i] += self.rows[at].sum(axis=0, dtype=np.float64)
            waiting.clear()

        for i, text in enumerate(texts):
            words = self.letters.findall(text.lower()) if text and langs else []
            numbers[i] = len(words)
            for first in range(0, len(words), TOGETHER):
                waiting.append((i, words[first : first + TOGETHER]))
                size += len(waiting[-1][1])
                if size >= TOGETHER:
                    add()
                    size = 0
        add()
        out = []
        for total, n in zip(totals, numbers, strict=True):
            if not n:
                out.append((UNDETERMINED, 0.0))
                continue
            mean = total / n
            best = int(mean.argmax())
            out.append((langs[best], float(1.0 / np.exp((mean - mean[best]) * min(n, 10)).sum())))
        return out


def languages(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score (0 to 1), from the whole text and the model alone.

    The words (runs of letters, lower case) of a text have their log frequencies per language averaged; a word the model
    does not hold backs off to its character n-grams, longest first. The score is the posterior of the best
    language with at most ten words' weight; of equal languages the first by name. A text that is null or
    has no letter, or an empty model, gives `und` and 0. Rows are independent: null and repeated ids
    are rows like others. Other columns are not read."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Kept from task to task of a worker process, under a module of its own.
        kept = sys.modules.setdefault("tenderline_language_id", types.ModuleType("tenderline_language_id")).__dict__
        if kept.get("key") != key:
            kept.update(key=key, predict=Predictor(shared.value))
        predict = kept["predict"]
        for batch in batches:
            found = [f for part in texts_of(batch.column(1), 256) for f in predict(part)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str) -> Column:
    """Documents that no language is learned from: crc32 of the id as text is a multiple of 5; a null id is one too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))
