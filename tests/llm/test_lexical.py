"""Ranked search against scores of all pairs, and what the bounds leave out."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortweave.llm import lexical
from cohortweave.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return Counter(TERM.findall(lowered))


def all_pairs(docs, items, k=10):
    """(item_id, rank, doc_id, score) from the score of every pair."""
    counted = [(d, c) for d, c in ((d, terms(t)) for d, t in docs) if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms(text)}
        scores = []
        for doc_id, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, n + 1, d, -s) for n, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def searched(spark, docs, items, **options):
    found = lexical.ranked_search(
        prepare(spark).createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), **options
    )
    return sorted(map(tuple, found.collect()), key=repr)


def test_terms_are_those_of_the_pattern():
    rng = random.Random(2)
    for _ in range(3_000):
        text = "".join(chr(rng.choice([rng.randrange(0x90), rng.randrange(0x3000), rng.randrange(0xE000, 0x11000)])) for _ in range(30))
        assert Counter(t.decode() for t in lexical.terms_of(text)) == terms(text)


@pytest.fixture(scope="module")
def prose():
    """Two languages, documents of very different lengths, ties and items copied into documents."""
    rng = random.Random(4)
    words = [[f"{a}{int(rng.expovariate(0.01))}" for _ in range(4_000)] for a in ("x", "ü")]
    docs = [(i, " ".join(rng.choices(words[i % 2], k=int(rng.lognormvariate(4, 1)) + 1))) for i in range(900)]
    items = [(i, " ".join(rng.choices(words[i % 2], k=rng.randrange(1, 30)))) for i in range(300)]
    docs += [(900 + i, f"{docs[i][1]} {items[i][1]}") for i in range(100)] + [(2_000 + i, docs[7][1]) for i in range(40)]
    return docs, items


def test_search_matches_the_scores_of_all_pairs(spark, prose):
    docs, items = prose
    assert searched(spark, docs, items) == all_pairs(docs, items)


def test_lots_of_items_give_the_same(spark, prose, monkeypatch):
    docs, items = prose
    monkeypatch.setattr(lexical, "PASS_BYTES", 12_000)
    assert searched(spark, docs[:300], items[:200], k=3) == all_pairs(docs[:300], items[:200], 3)


def test_bounds_leave_most_pairs_out_and_no_result():
    """One block at a time, as tasks do: thresholds rise and node pairs fall away."""
    rng = np.random.default_rng(1)
    lot = [(i, [b"t%d" % t for t in 40 * (i // 16) + rng.choice(40, 6, replace=False)]) for i in range(512)]
    vocabulary = {b"t%d" % t: t for t in range(40 * 32)}
    tree = lexical.item_tree(lot, vocabulary, np.full(len(vocabulary), 60), 8_192, 10)
    blocks = []
    for b in range(32):
        terms = np.array([np.sort(40 * b + rng.choice(40, 8, replace=False)) for _ in range(256)])
        blocks.append((np.arange(256) + 256 * b, np.zeros(256, bool), np.full(256, 8), terms.ravel(), rng.integers(1, 10**6, terms.size)))
    best = lexical.Best(tree)
    scored = sum(lexical.search_block(tree, best, *block) for block in blocks)
    assert scored <= 2 * 512 * 256
    found = {}
    for item, _, doc_id, score in best.rows():
        found.setdefault(item, []).append((-score, doc_id))
    items = tree.levels[0]
    for item in range(0, 512, 37):
        weights = dict(zip(items.terms[items.starts[item] : items.starts[item + 1]], items.weights[items.starts[item] : items.starts[item + 1]]))
        scores = [
            (-int(sum(weights.get(t, 0) * v for t, v in zip(ts, vs))), int(d))
            for ids, _, _, terms, values in blocks
            for d, ts, vs in zip(ids, terms.reshape(256, 8), values.reshape(256, 8))
        ]
        assert sorted(found[item]) == sorted(s for s in scores if s[0] < 0)[:10]


def test_sums_beyond_doubles_stay_exact():
    lot = [(0, [b"t%d" % t for t in range(400_000)])]
    vocabulary = {b"t%d" % t: t for t in range(400_000)}
    tree = lexical.item_tree(lot, vocabulary, np.ones(400_000, np.int64), 10**12, 2)
    assert tree.levels[0].weights.dtype == np.int64
    best = lexical.Best(tree)
    values = np.full(400_000, 999_999)
    for doc_id, last in ((1, 5), (2, 6)):
        lexical.search_block(tree, best, np.array([doc_id]), np.zeros(1, bool), np.array([400_000]), np.arange(400_000), np.append(values[:-1], last))
    weight = int(tree.levels[0].weights[0])
    assert [r[2:] for r in best.rows()] == [(2, weight * (399_999 * 999_999 + 6)), (1, weight * (399_999 * 999_999 + 5))]


def test_nulls_ties_repeats_long_texts_and_clashing_names(spark):
    long_text = " ".join(f"w{i % 9_000}" for i in range(300_000))
    docs = [(1, None), (None, "red fox"), (2, ""), (3, "Red, fox!"), (3, "red fox"), (None, "red fox"), (4, "... --"), (5, long_text), (6, "ÄPFEL äpfel w1 w2 w8999")]
    items = [(1, "red FOX fox"), (1, "red FOX fox"), (None, "äpfel"), (2, None), (3, ""), (4, "unknown"), (5, "w1 w8999 fox"), (6, "!?")]
    assert searched(spark, docs, items) == all_pairs(docs, items)
    wider = prepare(spark).createDataFrame([(*d, None, None, None) for d in docs], DOCS).withColumns({c: F.lit("mine") for c in ("n", "terms", "tie", "block", "score", "item_id")})
    named = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("mine") for c in ("doc_id", "rank", "item")})
    assert sorted(map(tuple, lexical.ranked_search(wider, named).collect()), key=repr) == all_pairs(docs, items)


def test_empty_tables_and_tables_without_terms(spark):
    assert searched(spark, [], [(1, "a")]) == [] and searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, "!"), (2, None)], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], [(1, "!"), (2, "b")]) == []
