"""Operators against brute force, the SQL, the tokenizer library and labels, on the small tables."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from tenderline.llm import line_dedup, queries, suffix_dedup, token_counts, warc
from tenderline.llm.line_dedup import without_duplicate_lines
from tenderline.llm.near_dedup import near_duplicates
from tests.compare import connect, of_duckdb, of_spark

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", queries.CHECKS)
def test_sql(spark, name):
    con = connect(FOLDER)
    assert of_spark(queries.QUERIES[name](spark, FOLDER)) == of_duckdb(con, queries.CHECKS[name])


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def components_by_brute_force(texts, size):
    sets, places = {}, defaultdict(list)
    for doc, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
        for s in sets[doc]:
            places[s].append(doc)
    shared = Counter()
    for docs in places.values():
        docs.sort()
        shared.update((a, b) for i, b in enumerate(docs) for a in docs[:i])
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), k in shared.items():
        if 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_minhash(spark):
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op8_minhash"](spark, FOLDER).collect()}
    assert out == components_by_brute_force([(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()], 4)


def test_minhash_of_a_spread_group(spark):
    draw = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join("x%d" % draw.randrange(10**6) if draw.random() < draw.choice((0.01, 0.03, 0.06)) else w for w in base)) for i in range(300)]
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=4).collect()}
    assert out == components_by_brute_force(rows, 4)


def test_minhash_where_ids_are_carried_by_two_texts(spark):
    draw = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join("x%d" % draw.randrange(10**6) if draw.random() < draw.choice((0.01, 0.03, 0.06)) else w for w in base)) for i in range(300)]
    expected = components_by_brute_force(rows, 4)
    other = [(i, " ".join(f"own{i}x{k}" for k in range(40 + i % 50))) for i in range(300)]
    again = rows[:40] + other[:20] + [(None, rows[7][1]), (5, None), (6, "")]
    out = near_duplicates(spark.createDataFrame(rows + other + again, "doc_id long, text string"), shingle_words=4).collect()
    assert len(out) == 663
    assert {(r.doc_id, r.component_id) for r in out if r.doc_id is not None and r.n_shingles} == {(i, c) for i, (_, c) in expected.items()}
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(expected[7][1], False)]


def test_minhash_links_the_texts_of_one_id(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(30)) for x in "abc")
    rows = [(9, a), (4, a), (9, b), (7, b), (8, c), (None, c), (None, "only one without an id")]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in out) == [(0, 0, True), (0, 8, False), (4, 4, True), (7, 4, False), (8, 8, True), (9, 4, False), (9, 4, False)]


def lines_kept_by_brute_force(lines):
    """Numbers of the lines that stay, all in one document and distinct."""
    sets = [{line[i : i + 9] for i in range(max(0, len(line) - 9) + 1)} for line in lines]
    root = list(range(len(lines)))
    for i, s in enumerate(sets):
        for j, t in enumerate(sets[:i]):
            if 100 * len(s & t) >= 80 * len(s | t):
                least, other = sorted((root[i], root[j]))
                root = [least if r == other else r for r in root]
    return sorted(set(root))


REPEATING = ["=" * 30, "=" * 80, "=" * 300, "=" * 9, "=" * 8, "buy now and save. " * 10, "buy now and save. " * 40, "exactly 9", "another line that nothing else is like", "- " * 20, "- " * 45, "-+" * 150]


def test_lines_that_repeat_inside_themselves(spark):
    for lines in (REPEATING, REPEATING[::-1]):
        out = without_duplicate_lines(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).first()
        want = [lines[i] for i in lines_kept_by_brute_force(lines)]
        assert len(want) < len(lines) - 3 and out.text.split("\n") == want


def removed_by_brute_force(rows):
    first = {}
    for doc, data in sorted(rows):
        for i in range(len(data) - 49):
            first.setdefault(data[i : i + 50], doc)
    out = {}
    for doc, data in rows:
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < doc:
                gone[i : i + 50] = b"\1" * 50
        left = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_suffix(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(suffix_dedup, "SAMPLE", 2)
    draw = random.Random(6)
    parts = ["".join(draw.choice("abc é") for _ in range(draw.randrange(20, 140))) for _ in range(60)] + ["ab" * 80, " " * 120]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randrange(0, 6)))) for i in range(150)]
    out = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == removed_by_brute_force([(i, t.encode()) for i, t in rows])


def test_tokens_agree_with_the_library(spark):
    file = public_tokenizers.path("byte_bpe_50k.json")
    library, count = tokenizers.Tokenizer.from_file(file), token_counts.counter(token_counts.load(file))
    draw = random.Random(1)
    pool = [chr(i) for i in [*range(0x250), 0x1680, 0x2003, 0x200B, 0x3000, 0x4E2D, 0x1F600, 0x301, 0x2160, 0x0661]] + ["<|endoftext|>", "'ll", "  ", "\n", "ing"]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randrange(15))) for _ in range(4000)] + ["", "a" * 5000]
    assert [count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    out = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.QUERIES["op6_token_counts"](spark, FOLDER).collect()}
    rows = [(r.doc_id, r.text or "") for r in documents(spark).select("doc_id", "text").collect()]
    for (doc, text), found in zip(rows, library.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        assert out[doc] == (len(text.encode()), len(found.ids), len(found.ids) > 1024)


def test_languages_held_out(spark):
    out = queries.QUERIES["op7_language_id"](spark, FOLDER).where("held_out").join(documents(spark).select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    assert len(out) > 100 and np.mean([r.lang == r.lang_pred for r in out]) > 0.95


def test_quality_against_labels(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality").withColumnRenamed("quality", "label")
    out = queries.QUERIES["op9_quality_rules"](spark, FOLDER).join(labels, "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept == (r.label == 1) for r in out]) > 0.95


def test_toxicity_against_labels(spark):
    out = queries.QUERIES["op4_toxicity"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet").selectExpr("doc_id", "toxic as label"), "doc_id").collect()
    assert np.mean([r.toxic == (r.label == 1) for r in out]) > 0.9
    assert not any(r.toxic and r.label == 0 for r in out)


def test_toxicity_recall_beside_false_alarms(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic is not null").selectExpr("doc_id", "toxic as label")
    out = queries.QUERIES["op4_toxicity"](spark, FOLDER).join(labels, "doc_id").join(documents(spark).select("doc_id", "text"), "doc_id").collect()
    insults = {"trash", "worthless", "idiot", "stupid", "loser", "pathetic", "disgusting", "clown", "scum", "moron"}
    told = [r.toxic for r in out if insults & set(re.findall(r"\w+", (r.text or "").lower()))]
    assert len(told) > 30 and all(told)
    assert sum(r.toxic for r in out if r.label == 1) > 0.6 * sum(r.label == 1 for r in out)
    assert not any(r.toxic for r in out if r.label == 0)


def records(kinds):
    return [warc.record(i, f"http://x/{i}", b"<p>%d</p>" % i * 50, hashlib.sha1(b"<p>%d</p>" % i * 50).hexdigest(), None if k else i + 1, "2020-01-01T00:00:00Z") for i, k in enumerate(kinds)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    raw = records([True, True, False, True, True])
    whole = [warc.member(r) for r in raw] if packed else raw
    data = warc.NOTHING.join(whole) if packed else b"".join(whole)
    assert [p.reason for p in warc.parts(data)] == [""] * 5
    damaged = bytearray(data)
    place = data.index(whole[1]) + len(whole[1]) // 2
    damaged[place : place + 9] = b"\0damaged\0"
    found = list(warc.parts(bytes(damaged)))
    kept = [p.fields["warc-record-id"] for p in found if not p.reason]
    gaps = [p for p in found if p.reason]
    assert kept == [f"<urn:x-page:{i}>" for i in (0, 2, 3, 4)]
    assert len(gaps) == 1 and gaps[0].offset <= place < gaps[0].offset + gaps[0].length
    cut = list(warc.parts(data[:-10] if not packed else data[: len(data) - 10]))
    assert [bool(p.reason) for p in cut] == [False] * 4 + [True]
    assert [bool(p.reason) for p in warc.parts(b"junk" + data)] == [True] + [False] * 5
    assert list(warc.parts(b"")) == [] and [p.length for p in warc.parts(b"no record")] == [9]


def test_archives_with_copies_and_nulls(spark, tmp_path):
    large = "<p>é</p>" * 200
    rows = [(1, "u", large), (5, "u\r\nX: y", large), (3, None, large), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (None, "u", "y" * 2000)]
    folder = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))
    out = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.page_records(warc.read_archives(spark, folder)).collect()}
    size, digest = len(large.encode()), hashlib.sha1(large.encode()).hexdigest()
    assert out[1] == out[3] == (size, digest, "revisit", 5) and out[5] == (size, digest, "response", None)
    assert out[2][2] == out[4][2] == "response" and out[6] == (0, hashlib.sha1(b"").hexdigest(), "response", None) and out[None][2] == "response"
    # Damaged copies; the checksum files beside the originals would stop Spark before the reader.
    for name in os.listdir(folder.removeprefix("file://").removeprefix("file:")):
        if name.startswith("part-"):
            with open(os.path.join(folder.removeprefix("file://").removeprefix("file:"), name), "rb") as file:
                data = bytearray(file.read())
            if data and b"damaged" not in b"".join(p.read_bytes() for p in tmp_path.iterdir()):
                data[15:22] = b"damaged"
            (tmp_path / name).write_bytes(data)
    after = warc.read_archives(spark, str(tmp_path))
    assert after.where("reason is not null").count() == 1 and after.where("warc_type is not null").count() == len(rows) - 1


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    docs, sizes = documents(spark), []
    from tenderline.llm.shared import stored

    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        sizes.append(docs.select("doc_id").distinct().count())
        if name == "minhash near-dedup":
            rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
            assert all(d == c for d, (_, c) in components_by_brute_force(rows, 5).items())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    assert docs.columns == [*pipeline.COLUMNS, "epoch", "tokens_taken"]


def test_lines_are_not_sorted_or_dealt_more_than_needed(spark, monkeypatch):
    """Texts are grouped by hash, and those that are compared are taken out of all lines once for all comparisons."""
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdefghijklmnop", k=7)) for _ in range(30)]
    rows = [(i, " ".join(draw.choices(words, k=40)) + "\n" + " ".join(words) + f" {i}") for i in range(60)]
    plans, write = [], line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name, codec=None: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), write(df, name, codec))[1])
    out = line_dedup.without_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    lines = list(dict.fromkeys(line for _, text in rows for line in text.split("\n")))
    assert sum(r.n_kept for r in out.select("n_kept").collect()) == len(lines_kept_by_brute_force(lines))
    found = dict(plans)
    assert "SortAggregate" not in found["lines"] and "Sort " not in found["lines"]
    assert [name for name, _ in plans].count("texts") == [name for name, _ in plans].count("marks") == 1


def test_marks_never_keep_linked_lines_apart(spark):
    """The bound by marks, over pairs of all similarities, also of lines that repeat inside themselves."""
    draw = random.Random(6)
    base = "".join(draw.choices("abcdefgh ", k=150))
    lines = list(dict.fromkeys([base * k for k in (1, 2, 7)] + [base[:cut] + "".join(draw.choices("xyz", k=draw.randrange(40))) + base[cut:] for cut in range(0, 150, 4)]))
    table = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    marks = {r.node: r for r in line_dedup._marks(line_dedup._hashed(table, 9)).collect()}
    sets = [{line[i : i + 9] for i in range(len(line) - 8)} for line in lines]
    linked = 0
    for a in range(len(lines)):
        assert marks[a].n == len(lines[a]) - 8
        assert sum(w.bit_count() if w >= 0 else (w + (1 << 64)).bit_count() for w in marks[a].f) <= len(sets[a])
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                linked += 1
                apart = sum(((x ^ y) & ((1 << 64) - 1)).bit_count() for x, y in zip(marks[a].f, marks[b].f, strict=True))
                assert 20 * (marks[a].n + marks[b].n) >= 180 * apart
    assert linked > 20


@pytest.mark.parametrize("first", [0, (1 << 32) - 3, 1 << 40, -5])
def test_line_numbers_of_any_id(spark, first):
    rows = [(first + i, f"the very same line of all the texts\nline {i * 7919} of its own, in text {i}") for i in range(4)]
    out = {r.doc_id: (r.n_lines, r.n_kept) for r in line_dedup.without_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {first: (2, 2), **{first + i: (2, 1) for i in (1, 2, 3)}}


@pytest.mark.parametrize("base", [True, False])
def test_lines_of_a_spread_group(spark, base):
    """Variants whose origin comes last or is not there: few are linked with the first of them."""
    draw = random.Random(8)
    origin = " ".join(f"word{i}" for i in range(40))
    lines = ["".join(draw.choice("xyz#") if draw.random() < draw.choice((0.002, 0.008, 0.015)) else c for c in origin) for _ in range(250)]
    far = ["".join(draw.choice("xyz#") if draw.random() < 0.02 else c for c in f"{k} unlike " * 30) for k in range(20) for _ in range(4)]
    lines = list(dict.fromkeys(lines + far + [origin] * base))
    out = without_duplicate_lines(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).first()
    want = [lines[i] for i in lines_kept_by_brute_force(lines)]
    assert 1 < len(want) < len(lines) and out.text.split("\n") == want


@pytest.mark.parametrize("few", [3, 1 << 15])
def test_tasks_of_op10_take_many_texts_at_once(monkeypatch, few):
    """One batch of spans for a chunk of texts, not one for each text; ranks are looked up for all texts of a chunk."""
    monkeypatch.setattr(suffix_dedup, "SPANS", few)
    texts = [b"", b"ab" * 40, b"x" * 49, bytes(range(97, 123)) * 5, b"ab" * 40 + b"c" * 60]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    text, start, windows, spot, rank = suffix_dedup.sampled(data, offsets, 50)
    h = [int(x) >> 32 for x in suffix_dedup._prefix_hashes(data)]
    expected = []
    for t, body in enumerate(texts):
        for p in range(len(body) - 49):
            at = min(range(offsets[t] + p, offsets[t] + p + 35), key=h.__getitem__) - offsets[t]
            if expected and expected[-1][0] == t and expected[-1][1] + expected[-1][3] == at:
                expected[-1][2] += 1
            else:
                expected.append([t, p, 1, at - p])
    assert [list(r) for r in zip(*(x.tolist() for x in (text, start, windows, spot)))] == expected
    lists = pa.array([None, rank[text == 1].tolist()[:1], [], rank[text == 3].tolist()[1:], [5]], pa.list_(pa.int64()))
    listed = [r in (lists[t].as_py() or []) for t, r in zip(text.tolist(), rank.tolist())]
    assert suffix_dedup._among(text, rank, lists).tolist() == listed
    kind = pa.struct([("id", pa.int64()), ("start", pa.int32()), ("windows", pa.int16()), ("spot", pa.int16())])
    runs = [[(i, int(start[i]), int(windows[i]), int(spot[i])) for i in np.flatnonzero(text == t)] for t in (1, 3, 4)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 3, 4]), pa.array([texts[t] for t in (1, 3, 4)]), pa.array(runs, pa.list_(kind))], names=["doc_id", "text", "runs"])
    made = list(suffix_dedup._bytes_of(50)(iter([batch])))
    spans = [(r["id"], r["doc_id"], r["span"]) for b in made for r in b.to_pylist()]
    assert spans == [(i, t, texts[t][start[i] : start[i] + windows[i] + 49]) for i, t in enumerate(text.tolist())]
    assert len(made) == -(-len(spans) // few)


def test_stored_tables_take_a_codec(spark):
    from tenderline.llm.shared import stored

    rows = stored(spark.range(3), "codec", suffix_dedup.CODEC)
    assert all(".zstd." in f for f in rows.inputFiles()) and rows.count() == 3


def test_windows_are_looked_up_without_sorting(spark):
    text = bytes(range(97, 123)) * 4
    spans = spark.createDataFrame([(k, k, 5, 4, bytearray(text[k : 54 + k])) for k in (0, 26)], "id long, doc_id long, windows short, spot short, span binary")
    found = suffix_dedup._grown(spans, 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert {(r.id, r.at) for r in found.collect()} == {(26, at) for at in range(5)}


def test_samples_are_made_once(spark, monkeypatch):
    plans, stored = {}, suffix_dedup.stored

    def kept(rows, name, codec=None):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return stored(rows, name, codec)

    monkeypatch.setattr(suffix_dedup, "stored", kept)
    text = "".join(random.Random(4).choices("abcdefgh", k=90))
    out = suffix_dedup.repeated_bytes(spark.createDataFrame([(1, text), (2, "x" + text)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_removed) for r in out} == {(1, 0), (2, 90)}
    assert plans["alive"].count("MapInArrow") == 1


def test_strings_that_repeat_by_chance_are_not_kept(spark, monkeypatch):
    """Pieces of 24 bytes that all documents have, and no window of 50: op10 keeps no run of them."""
    kept, stored = {}, suffix_dedup.stored

    def counted(rows, name, codec=None):
        out = stored(rows, name, codec)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "stored", counted)
    draw = random.Random(12)
    drawn = lambda n: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    pieces = [drawn(24) for _ in range(12)]
    rows = [(i, "".join(draw.choice(pieces) + drawn(10) for _ in range(20))) for i in range(12)]
    out = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.n_removed for r in out] == [0] * 12
    assert kept["runs"] == kept["spans"] == 0


@pytest.mark.parametrize("length", [16, 17, 20, 35, 50, 90])
def test_ranks_of_groups(length):
    """Each window of a run is in one group, whose string it has; ranks are equal when strings are."""
    draw = random.Random(length)
    parts = ["".join(draw.choices("ab", k=70)) for _ in range(6)]
    texts = ["".join(draw.choices(parts, k=draw.randrange(5))).encode() for _ in range(12)]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    h = suffix_dedup._prefix_hashes(data)
    text, start, windows, spot, rank = suffix_dedup.sampled(data, offsets, length)
    assert all((x == y).all() for x, y in zip(suffix_dedup.sampled(data, offsets, length, h), (text, start, windows, spot, rank), strict=True))
    ranks = suffix_dedup.grown(h, offsets[text] + start + spot, windows, spot, length)
    spare, groups = length - suffix_dedup.FIRST, suffix_dedup.GROUPS
    edges = [round(k * (spare + 1) / groups) for k in range(groups + 1)]
    strings = {}
    for t, a, w, s, found in zip(text, start, windows, spot, ranks.tolist(), strict=True):
        for k in range(groups):
            inside = [p for p in range(w) if edges[k] <= s - p < edges[k + 1]]
            assert (found[k] != 0) == bool(inside)
            if inside:
                begin, end = a + s - edges[k], a + s + suffix_dedup.FIRST + spare - (edges[k + 1] - 1)
                assert all(a + p <= begin and end <= a + p + length for p in inside)
                strings.setdefault((k, texts[t][begin:end]), set()).add(found[k])
    assert all(len(x) == 1 for x in strings.values())
    assert len(set.union(*strings.values())) == len(strings)


def test_rows_that_repeat_an_id_keep_their_own_bytes(spark):
    draw = random.Random(3)
    parts = ["".join(draw.choices("abcdefgh", k=draw.randrange(40, 120))) for _ in range(12)]
    rows = [(i // 3 if i % 2 else i, "".join(draw.choices(parts, k=draw.randrange(5)))) for i in range(60)]
    rows += [rows[7], rows[20], (None, parts[0]), (3, None)]
    out = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    first, want = {}, []
    for doc, text in sorted(r for r in rows if None not in r):
        for i in range(len(text) - 49):
            first.setdefault(text[i : i + 50], doc)
    for doc, text in rows:
        gone = bytearray(len(text or ""))
        for i in range(len(gone) - 49 if doc is not None else 0):
            if first[text[i : i + 50]] < doc:
                gone[i : i + 50] = b"\1" * 50
        want.append((doc, len(gone), sum(gone), hashlib.sha256(bytes(x for x, g in zip((text or "").encode(), gone, strict=True) if not g)).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256)) for r in out)
    assert sum(r.n_removed > 0 for r in out) > 20
