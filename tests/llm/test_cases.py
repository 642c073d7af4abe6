"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tenderline.llm import decontamination, language_id, line_dedup, mixing, near_dedup, quality_rules, suffix_dedup, token_counts, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tokens string, h string, bucket long, node long, stay string, tag string"
PROSE = " ".join(f"word{i % 97} of{i}" for i in range(400))
ROWS = [
    (1, PROSE, "en", "src1"),
    (2, PROSE, "en", "src1"),
    (2, PROSE, "en", "src1"),
    (3, None, None, None),
    (4, "", "fr", "src2"),
    (5, " \t\n\v\f\r ", "fr", None),
    (6, "é́ü 中文 \U0001f600\nx\nx\n\nx", None, "src2"),
    (None, PROSE + " more", "en", "src1"),
    (None, None, None, None),
    (7, "one", "de", "src3"),
    (8, "a" * 30_000, "de", "src3"),
    (9, " ".join(f"long{i}" for i in range(30_000)), "de", "src3"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y", 1, 2, "s", "t") for r in rows], SCHEMA)


def benchmark(spark):
    return spark.createDataFrame([(1, " ".join(f"word{i % 97} of{i}" for i in range(20, 60))), (2, None), (3, ""), (4, "too short")], "item_id long, text string")


def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


OPERATORS = {
    "mixing": lambda spark, d: mixing.mixed_documents(d),
    "decontamination": lambda spark, d: decontamination.leaks(d, benchmark(spark)),
    "toxicity": lambda spark, d: toxicity.severity(d, toxicity.fit(d.select("doc_id", "text", (F.col("doc_id") % 2).alias("grade")))),
    "lines": lambda spark, d: line_dedup.without_duplicate_lines(d),
    "tokens": lambda spark, d: token_counts.token_counts(d, path()),
    "language": lambda spark, d: language_id.languages(d, language_id.fit(d)),
    "near": lambda spark, d: near_dedup.near_duplicates(d),
    "quality": lambda spark, d: quality_rules.quality(d),
    "bytes": lambda spark, d: suffix_dedup.repeated_bytes(d),
}
EVERY_ROW = ("toxicity", "lines", "tokens", "language", "near", "quality", "bytes")


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    out = OPERATORS[name](spark, frame(spark, ROWS)).collect()
    if name in EVERY_ROW:
        assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in ROWS)
    again = OPERATORS[name](spark, frame(spark, ROWS[::-1])).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, frame(spark, [])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_all_null(spark, name):
    out = OPERATORS[name](spark, frame(spark, [(None, None, None, None)] * 3)).collect()
    assert len(out) == (3 if name in EVERY_ROW else 0)


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def test_near(spark):
    out = by_id(near_dedup.near_duplicates(frame(spark, ROWS)))
    assert (out[2].component_id, out[2].kept, out[1].kept) == (1, False, True)
    assert out[3].n_shingles == out[4].n_shingles == out[5].n_shingles == 0
    assert out[3].kept and out[4].kept and out[5].kept and out[7].n_shingles == 1


def test_bytes(spark):
    out = by_id(suffix_dedup.repeated_bytes(frame(spark, ROWS)))
    assert out[1].n_removed == 0 and out[2].n_removed == out[2].n_bytes == len(PROSE)
    assert out[8].n_removed == 0 and out[3].n_bytes == out[4].n_bytes == 0


def test_lines(spark):
    out = by_id(line_dedup.without_duplicate_lines(frame(spark, ROWS)))
    assert out[3].text is None and out[4].text == out[5].text == ""
    assert (out[6].n_lines, out[6].n_kept, out[6].text) == (4, 2, "é́ü 中文 \U0001f600\nx")
    assert (out[1].n_kept, out[2].n_kept) == (1, 0)


def test_lines_of_repeated_ids(spark):
    rows = [(1, "only line of the first text", "en", "s"), (1, "a line\nanother one\na third one of this text", "en", "s"), (1, "a line\nanother one\na third one of this text", "en", "s")]
    out = line_dedup.without_duplicate_lines(frame(spark, rows)).collect()
    assert sorted((r.n_lines, r.n_kept) for r in out) == [(1, 1), (3, 3), (3, 3)]


def test_mixing_takes_prefixes(spark):
    rows = [(i, "w " * (i % 7 + 1), "en" if i % 3 else None, f"src{i % 5}") for i in range(200)]
    out = mixing.mixed_documents(frame(spark, rows)).collect()
    total = sum(i % 7 + 1 for i in range(200))
    taken = sum(r.tokens_taken for r in out)
    assert total * mixing.PERCENT // 100 - 15 <= taken <= total * mixing.PERCENT // 100
    assert {r.lang for r in out} == {"en", mixing.NONE}


def test_budgets_move_to_siblings_first(spark):
    leaves = [("a", "en", "s1", 10, 1, 1, 1), ("a", "en", "s2", 1000, 1, 1, 1), ("a", "fr", "s3", 1000, 1, 1, 1), ("b", "en", "s4", 1000, 1, 1, 1)]
    names = "domain string, lang string, source string, tokens long, domain_weight int, lang_weight int, source_weight int"
    out = {r.source: r.quota for r in mixing.budgets(spark.createDataFrame(leaves, names), F.lit(400), 1).collect()}
    assert out == {"s1": 10, "s2": 90, "s3": 100, "s4": 200}


def test_leaks_tolerate_substitutions(spark):
    words = [f"word{i % 97}" if i % 2 else f"of{i}" for i in range(40)]
    item = " ".join(words)
    swapped = " ".join("other" if i in (9, 25) else w for i, w in enumerate(words))
    shuffled = " ".join(sorted(words))
    docs = frame(spark, [(1, f"Some text. {item.upper()}", "en", "s"), (2, f"before {swapped} after", "en", "s"), (3, shuffled, "en", "s"), (4, " ".join(words[:8]), "en", "s")])
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()} == {(1, 7), (2, 7)}


def test_shuffled_seeds_agree_with_broadcast(spark, monkeypatch):
    docs, items = frame(spark, ROWS), benchmark(spark)
    want = sorted(map(repr, decontamination.leaks(docs, items).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", 0)
    assert want and sorted(map(repr, decontamination.leaks(docs, items).collect())) == want


def test_quality_base(spark):
    out = by_id(quality_rules.quality(frame(spark, [*ROWS, (20, "# b c " * 40 + "| line\n\n| line", "en", "s")])))
    r = out[20]
    assert (r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == (124, 42, 0, 124 - 4, True, False)
    assert out[6].n_dup_lines == 2 and out[6].word_chars == 9 and out[3].n_words == 0


def test_language_without_letters(spark):
    out = by_id(language_id.languages(frame(spark, [*ROWS, (30, "123 _ 45²", "en", "s")]), language_id.fit(frame(spark, ROWS))))
    assert [out[i].lang_pred for i in (3, 4, 5, 30)] == ["und"] * 4 and out[30].score == 0
    assert out[1].lang_pred == "en" and out[9].lang_pred == "de"


def test_toxicity_orders_grades(spark):
    rows = [(i, f"plain words number {i} " + "vile " * (i % 4), "en", "s") for i in range(400)]
    docs = frame(spark, rows)
    graded = docs.select("doc_id", "text", F.when(F.col("doc_id") % 4 == 0, 0).otherwise(1).alias("grade"))
    model = toxicity.fit(graded)
    assert list(model["thresholds"]) == sorted(model["thresholds"])
    out = by_id(toxicity.severity(docs, model))
    assert not out[0].toxic and out[1].toxic and out[1].expected_severity < out[3].expected_severity


def test_mix_keeps_null_and_repeated_ids(spark, tmp_path):
    # A small leaf, all of which all epochs take, and a large one; each with null ids, exact copies and one id with two texts.
    small = [(1, "a b c", "en", "src1"), (5, "x y", "en", "src1"), (5, "x y", "en", "src1"), (None, "n o p q", "en", "src1"), (None, "r", "en", "src1"), (6, "s t", "en", "src1"), (6, "u v w", "en", "src1")]
    large = [(None if i % 5 == 0 else 100 + i // 3, "w " * (i % 7 + 1), "en", "src3") for i in range(300)]
    rows = small + large
    size = lambda text: len(text.split())
    out = corpus_pipeline.mix(spark, frame(spark, rows).select(*corpus_pipeline.COLUMNS), str(tmp_path)).collect()
    got = sorted(((str(r.doc_id), r.text, r.tokens_taken, r.epoch) for r in out if r.source == "src1"))
    assert got == sorted((str(i), t, size(t), e) for i, t, _, _ in small for e in range(1, mixing.EPOCHS + 1))
    total = sum(size(t) for _, t, _, _ in rows)
    assert 0 <= total * mixing.PERCENT // 100 - sum(r.tokens_taken for r in out) < 2
    taken, held = Counter((r.doc_id, r.text, r.epoch) for r in out if r.source == "src3"), Counter((i, t) for i, t, _, _ in large)
    assert taken and all(n <= held[i, t] for (i, t, _), n in taken.items()) and any(i is None for i, _, _ in taken)


def test_toxicity_weighs_words_beside_stronger_ones(spark):
    # "vile" is in all toxic texts, "mean" and "nasty" only beside it; texts to judge hold them without it.
    rows = [(i, f"plain words number {i}" + (" vile" if i % 4 == 0 else "") + (" mean" if i % 8 == 0 else "") + (" nasty" if i % 12 == 0 else ""), "en", "s") for i in range(480)]
    model = toxicity.fit(frame(spark, rows).select("doc_id", "text", (F.col("doc_id") % 4 == 0).cast("int").alias("grade")))
    assert set(model["words"]) == {"vile", "mean", "nasty"} and all(model["weights"] > 0)
    out = by_id(toxicity.severity(frame(spark, [(1, "plain words", "en", "s"), (2, "mean mean nasty nasty words", "en", "s"), (3, "vile words", "en", "s")]), model))
    assert not out[1].toxic and out[3].toxic and out[2].p_toxic > out[1].p_toxic


def test_pipeline_stages_keep_columns(spark, tmp_path):
    frame(spark, ROWS).select("doc_id", F.lit(0).alias("quality"), (F.col("doc_id") % 2).alias("toxic")).write.parquet(str(tmp_path / "labels.parquet"))
    benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (ROWS, []):
        docs = frame(spark, rows).select(*corpus_pipeline.COLUMNS)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= 0


def test_empty_archives(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.page_records(warc.read_archives(spark, warc.write_archives(pages))).count() == 0


def test_pipeline_decides_on_each_row(spark, tmp_path):
    """Null and repeated ids: what one row holds does not throw out another."""
    benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    leak = " ".join(f"word{i % 97} of{i}" for i in range(18, 62))
    clean = [" ".join(f"{name}{i}" for i in range(60)) for name in ("red", "green", "blue")]
    rows = [(None, leak, "en", "s"), (None, clean[0], "en", "s"), (5, leak + " x", "en", "s"), (5, clean[1], "en", "s"), (6, clean[2], "en", "s"), (6, clean[2], "en", "s")]
    docs = frame(spark, rows).select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(None, clean[0]), (5, clean[1]), (6, clean[2]), (6, clean[2])])
    kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(None, clean[0]), (5, leak + " x"), (5, clean[1]), (6, clean[2])])
