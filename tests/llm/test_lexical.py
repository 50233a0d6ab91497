"""Ranked search against scores written out from the definition."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from seriesloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, top=20):
    """(item_id, rank, doc_id, score) over all pairs."""
    counted = [(doc, Counter(split(text))) for doc, text in docs]
    lengths = [c.total() for _, c in counted]
    documents, words = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for (doc, c), n in zip(counted, lengths, strict=True):
            score = 0
            for t in split(text):
                if c[t]:
                    m = 100 - 25 + 25 * n * documents // words
                    score += math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def make(seed, n=400):
    rnd = random.Random(seed)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(4000)]
    docs = []
    for i in range(n):
        if docs and rnd.random() < 0.3:
            docs.append((i, rnd.choice(docs[:5])[1]))  # large groups of copies: ties
        else:
            docs.append((i, " ".join(rnd.choices(words, k=rnd.choice([0, 1, 5, 50, 50, 300])))))
    items = [(j, " ".join(rnd.choices(words, k=rnd.randint(0, 40)))) for j in range(30)]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, monkeypatch, seed):
    docs, items = make(seed)
    monkeypatch.setattr(lexical, "BUCKET", 16)
    if seed == 1:
        monkeypatch.setattr(lexical, "BLOCK", 100)  # several blocks of items
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    result = lexical.top_documents(df, spark.createDataFrame(items, "item_id long, text string"))
    assert found(result) == expected(docs, items)


def test_bounds_leave_pairs_out():
    docs, items = make(7, 3000)
    counted = [lexical.terms(t.encode()) for _, t in docs]
    vocabulary = sorted(set().union(*counted))
    place = {t: n for n, t in enumerate(vocabulary)}
    df = Counter(t for c in counted for t in c)
    triples = [(r, place[t], lexical.impact(n, 100)) for r, c in enumerate(counted) for t, n in c.items()]
    wanted = [(i, place[t], n * lexical.weight(len(docs), df[t])) for i, (_, text) in enumerate(items) for t, n in lexical.terms(text.encode()).items() if t in place]
    wanted.sort()
    block = lexical.Items(*(np.array(x, np.int64) for x in zip(*wanted, strict=True)), np.zeros(len(items), np.int64), len(vocabulary))
    search = lexical.Search(block, 5)
    search.take(list(range(len(docs))), *(np.array(x, np.int64) for x in zip(*triples, strict=True)))
    for i in range(len(items)):
        own = {t: v for item, t, v in wanted if item == i}
        scores = Counter()
        for r, t, v in triples:
            scores[r] += own.get(t, 0) * v
        plain = sorted((-s, r) for r, s in scores.items() if s > 0)[:5]
        assert [(s, doc) for s, _, doc in search.best[i]] == plain
    assert search.scored < len(docs) * len(items) / 4


def test_terms_of_long_texts(monkeypatch):
    text = "Ab-c d9é漢 x_y\x7f" * 500
    whole = lexical.terms(text.encode())
    assert whole == Counter(t.encode() for t in split(text))
    monkeypatch.setattr(lexical, "PART", 10)
    assert lexical.terms(text.encode()) == whole


def test_hard_rows(spark, hard, nothing):
    items = [(1, "Alpha BETA word word"), (1, "Alpha BETA word word"), (1, "six"), (2, None), (3, ""), (None, "café 漢字 some"), (4, "nowhere")]
    queries = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank", "2 as score", "3 as doc_id")
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    assert found(lexical.top_documents(hard, queries)) == expected(rows, items)
    assert found(lexical.top_documents(hard, queries, top=1)) == expected(rows, items, 1)
    assert lexical.top_documents(nothing, queries).count() == 0
    assert lexical.top_documents(hard, queries.where("false")).count() == 0
