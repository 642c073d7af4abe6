"""Benchmark items below thirteen tokens, by all patterns of substitutions."""

from __future__ import annotations

from itertools import combinations

from tenderline.llm import decontamination


def test_short_items_by_all_substitutions(spark):
    items, docs, want, doc = [], [], set(), 0
    for n in range(1, 14):
        words = [f"n{n}w{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        for k in range(min(n, 3) + 1):
            for gone in combinations(range(n), k):
                # In the middle of a text, and as all of it.
                for before, after in (("one two ", " three four"), ("", "")):
                    doc += 1
                    docs.append((doc, before + " ".join("other" if i in gone else w for i, w in enumerate(words)) + after))
                    if 100 * (n - k) >= 80 * n:
                        want.add((doc, n))
        # Cut off by the start of the text.
        for k in range(1, min(n, 4)):
            doc += 1
            docs.append((doc, " ".join(words[k:]) + " and more"))
            if 100 * (n - k) >= 80 * n:
                want.add((doc, n))
    out = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in out.collect()} == want
