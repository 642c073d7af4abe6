"""The models' numbers, worked out again in plain Python, and the pipeline's stages against SQL over what each was given."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

import corpus_pipeline
from tenderline.llm import decontamination, mixing, queries, quality_rules, toxicity
from tenderline.llm.shared import stored
from tests.compare import connect

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def texts(spark):
    return [(r.doc_id, r.text or "") for r in documents(spark).select("doc_id", "text").collect()]


def counts_of(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)),
        "n_repeat_words": len(repeated),
    }, (len(lines), sum(bool(re.search("[A-Za-z]|[^\x00-\x7f]", w)) for w in words), sum(w in quality_rules.STOP_WORDS for w in words))


def votes_of(c, more):
    n, lines, alpha, stops = c["n_words"], *more

    def vote(value, good, bad):
        return 0 if value is None else -1 if bad(value) else 1 if good(value) else 0

    per = (lambda x: x / n) if n else lambda x: None
    return (
        vote(n, lambda v: 100 <= v <= 50_000, lambda v: v < 50),
        vote(per(c["word_chars"]), lambda v: 3 <= v <= 10, lambda v: v < 2 or v > 15),
        vote(per(c["n_symbols"]), lambda v: v <= 0.05, lambda v: v > 0.2),
        vote(c["n_dup_lines"] / lines if lines else None, lambda v: v <= 0.1, lambda v: v > 0.3),
        vote(per(c["n_repeat_words"]), lambda v: v <= 0.1, lambda v: v > 0.3),
        vote(per(alpha), lambda v: v >= 0.8, lambda v: v < 0.6),
        vote(per(stops) if n >= 50 else None, lambda v: v >= 0.1, lambda v: v < 0.05),
    )


def chance(votes, right_good, right_bad, share):
    odds = math.log(share / (1 - share))
    for v, g, b in zip(votes, right_good, right_bad, strict=True):
        odds += math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b) if v < 0 else 0
    return 1 / (1 + math.exp(-odds))


def expected_quality(patterns):
    """Posterior of each vote pattern after expectation-maximisation, one pattern and one rule at a time."""
    total, p = sum(patterns.values()), {v: 0.2 if min(v) < 0 else 0.9 for v in patterns}
    for _ in range(300):
        accuracy = []
        for sign, weight in ((1, lambda v: p[v]), (-1, lambda v: 1 - p[v])):
            right = [sum(n / total * weight(v) for v, n in patterns.items() if v[k] == sign) for k in range(7)]
            cast = [sum(n / total * weight(v) for v, n in patterns.items() if v[k]) for k in range(7)]
            accuracy.append([min(0.999, max(0.001, (r + 0.8e-4) / (c + 1e-4))) for r, c in zip(right, cast, strict=True)])
        share = min(0.98, max(0.02, sum(n / total * p[v] for v, n in patterns.items())))
        now = {v: chance(v, *accuracy, share) for v in patterns}
        moved, p = max(abs(now[v] - p[v]) for v in p), now
        if moved < 1e-9:
            break
    return p


def test_quality_counts_and_posteriors(spark):
    rows = {doc: counts_of(text) for doc, text in texts(spark)}
    votes = {doc: votes_of(*row) for doc, row in rows.items()}
    quality = expected_quality(Counter(votes.values()))
    out = queries.QUERIES["op9_quality_rules"](spark, FOLDER).collect()
    assert len(out) == len(rows) and len(set(votes.values())) > 3
    for r in out:
        c = rows[r.doc_id][0]
        failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        assert ({k: r[k] for k in c}, r.base_failed) == (c, failed)
        assert r.quality == pytest.approx(quality[votes[r.doc_id]], abs=1e-6)
        assert r.kept == (not failed and r.quality >= 0.5)


def units_of(word):
    padded = f"_{word}_"
    return [(k, padded[i : i + k]) for k in range(1, 6) for i in range(len(padded) - k + 1)]


def test_language_scores(spark):
    letters, seen = regex.compile(r"\p{L}+"), defaultdict(Counter)
    rows = [(r.doc_id, r.text, r.lang) for r in documents(spark).select("doc_id", "text", "lang").collect()]
    held = {doc: zlib.crc32(str(doc).encode()) % 5 == 0 for doc, _, _ in rows}
    for doc, text, lang in rows:
        if text is not None and lang is not None and not held[doc]:
            seen[lang].update(letters.findall(text.lower()))
    langs = sorted(seen)
    tables = defaultdict(lambda: [Counter() for _ in langs])
    for i, lang in enumerate(langs):
        for word, n in seen[lang].items():
            tables[0][i][word] += n
            for k, unit in units_of(word):
                tables[k][i][unit] += n
    known = {k: set().union(*t) for k, t in tables.items()}
    logs = {k: [lambda u, c=c, d=sum(c.values()) + 0.5 * len(known[k]): math.log((c[u] + 0.5) / d) for c in t] for k, t in tables.items()}
    cached = {}

    def row(word):
        if word not in cached:
            units = [(0, word)] if word in known[0] else []
            for k in range(5, 0, -1):
                units = units or [(k, u) for j, u in units_of(word) if j == k and u in known[k]]
            cached[word] = np.mean([[f(u) for f in logs[k]] for k, u in units], axis=0) if units else np.zeros(len(langs))
        return cached[word]

    out = {r.doc_id: r for r in queries.QUERIES["op7_language_id"](spark, FOLDER).collect()}
    assert len(out) == len(rows)
    for doc, text, _ in rows:
        words = letters.findall((text or "").lower())
        assert out[doc].held_out == held[doc]
        if not words:
            assert (out[doc].lang_pred, out[doc].score) == ("und", 0.0)
            continue
        mean = np.mean([row(w) for w in words], axis=0)
        assert mean[langs.index(out[doc].lang_pred)] == pytest.approx(mean.max(), abs=1e-5)
        assert out[doc].score == pytest.approx(1 / np.exp((mean - mean.max()) * min(len(words), 10)).sum(), abs=1e-3)


def loss(w, t, rows, grades, ridge):
    """Mean negative log likelihood of the grades, one document at a time, and the ridge."""
    total = 0.0
    for x, grade in zip(rows, grades, strict=True):
        score = sum(w[c] * v for c, v in x.items())
        above = [1.0, *(1 / (1 + math.exp(-(score - k))) for k in t), 0.0]
        total -= math.log(max(above[grade] - above[grade + 1], 1e-12))
    return total / len(grades) + ridge / 2 * sum(k * k for k in w)


def test_ordinal_fit_is_the_least_loss():
    draw = random.Random(2)
    real, cuts = [1.5, -1.0, 0.7, 0.0, 2.0], [-0.5, 1.0, 2.5]
    rows = [{c: math.log1p(draw.randrange(1, 6)) for c in range(5) if draw.random() < 0.4} for _ in range(300)]
    grades = []
    for x in rows:
        noise = draw.random()
        score = sum(real[c] * v for c, v in x.items()) + math.log(noise / (1 - noise))
        grades.append(sum(score > k for k in cuts))
    at = [(i, c, v) for i, x in enumerate(rows) for c, v in x.items()]
    w, t = toxicity.fit_ordinal(*(np.array([e[k] for e in at]) for k in range(3)), np.array(grades), 5, 4, 1e-3)
    assert list(t) == sorted(t) and [k > 0 for k in w[[0, 1, 2, 4]]] == [True, False, True, True]
    best = loss(w, t, rows, grades, 1e-3)
    for k in range(8):
        for step in (0.05, -0.05):
            moved = np.r_[w, t]
            moved[k] += step
            assert best <= loss(moved[:5], moved[5:], rows, grades, 1e-3) + 1e-6
    assert best < loss(real, cuts, rows, grades, 1e-3) + 1e-6


def test_severity_of_each_text(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.fit(toxicity.graded(labels, documents(spark)))
    out = {r.doc_id: r for r in toxicity.severity(documents(spark), model).collect()}
    for doc, text in texts(spark):
        found = Counter(w for w in regex.findall(r"\p{L}+", text.lower()) if w in model["words"])
        score = sum(model["weights"][model["words"][w]] * math.log1p(n) for w, n in found.items())
        above = [1 / (1 + math.exp(-max(-40, min(40, score - t)))) for t in model["thresholds"]]
        assert out[doc].expected_severity == pytest.approx(sum(above)) and out[doc].p_toxic == pytest.approx(above[0])
        assert out[doc].toxic == (out[doc].p_toxic >= model["cut"])


def test_stages_against_what_each_was_given(spark):
    """Rejected are those that the model calls toxic, those that the SQL finds in the benchmark; taken is what the SQL takes."""
    docs = documents(spark)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, FOLDER), "stage")
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        given = {r.doc_id for r in docs.select("doc_id").collect()}
        con = connect(FOLDER)
        con.execute("DROP VIEW IF EXISTS documents")
        con.register("documents", docs.toArrow())
        if name == "toxicity":
            scored = toxicity.severity(docs, toxicity.fit(toxicity.graded(labels, docs)))
            assert ids == {r.doc_id for r in scored.where("not toxic").collect()} and ids < given
        elif name == "benchmark decontamination":
            assert ids == given - {r[0] for r in con.execute(decontamination.SQL).fetchall()}
        elif name == "mixing":
            want = con.execute(f"SELECT doc_id, epoch, tokens_taken FROM ({mixing.SQL})").fetchall()
            assert sorted((r.doc_id, r.epoch, r.tokens_taken) for r in out.collect()) == sorted(want)
        docs = out
