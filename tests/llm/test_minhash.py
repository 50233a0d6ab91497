"""Near duplicates against all pairs of full sets."""

import random
import re

import numpy as np
import pytest
from conftest_llm import make_texts

from seriesloom.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    """(doc_id, n_shingles, component_id) of every row by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                parent[top(a)] = top(b)
    least = {}
    for n, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(n)] = min(least.get(top(n), doc), doc)
    return sorted(str((doc, len(sets[n]), least.get(top(n)))) for n, (doc, _) in enumerate(rows))


def found(df):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in df.collect())


def test_hard_rows(spark, hard, nothing):
    result = minhash.near_duplicates(hard).cache()
    assert found(result) == expected([(r.doc_id, r.text) for r in hard.collect()])
    kept = [r.doc_id for r in result.where("kept").collect()]
    assert sorted(k for k in kept if k is not None) == [1, 4, 5, 6, 7, 8, 10]  # one of the two rows 7
    assert kept.count(None) == 2  # the text without words, and the one that is alike to nothing
    assert minhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_copies_and_passages(spark, monkeypatch, seed):
    if seed == 3:
        monkeypatch.setattr(minhash, "LINKS", 5)
        monkeypatch.setattr(minhash, "THINNED", 20)
    rows = list(enumerate(make_texts(seed)))
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    result = minhash.near_duplicates(df).cache()
    assert found(result) == expected(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in result.collect())


def test_lists_longer_than_a_block(spark, monkeypatch):
    """A passage makes one list of all rows; hubs are switched off, so that blocks do all the work."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "hub_pairs", lambda posted, facts: posted.selectExpr("key as a", "key as b", "0 as bucket_a", "0 as bucket_b", "true as sure").limit(0))
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(80)]
    rows = [(n, " ".join([f"own{n}-{i}" for i in range(rnd.choice([4, 8, 30, 60]))] + passage)) for n in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(minhash.near_duplicates(df)) == expected(rows)


@pytest.mark.parametrize("links", [1 << 18, 10, 1])
def test_long_chains_of_links(spark, monkeypatch, links):
    """Components reach along a chain of links in which only neighbours are alike, in one task and in many."""
    monkeypatch.setattr(minhash, "LINKS", links)
    key = lambda n: n.to_bytes(16, "big")
    edges = [(key(i), key(i + 1)) for i in range(60)] + [(key(100 + i), key(100)) for i in range(1, 20)]
    edges += [(key(200 + i * 37 % 60), key(200 + (i + 1) * 37 % 60)) for i in range(59)]  # in no order
    random.Random(2).shuffle(edges)
    df = spark.createDataFrame([*edges, *edges[:9]], "a binary, b binary").repartition(7)
    tied = minhash.components(df).collect()
    expected = {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 20)} | {200 + i: 200 for i in range(1, 60)}
    assert len(tied) == len(expected) and {int.from_bytes(r.key): int.from_bytes(r.component) for r in tied} == expected


def test_parities_bound_the_difference():
    rnd = random.Random(6)
    for size in (1, 5, 100, 3000):
        sets = [np.unique(np.array([rnd.getrandbits(64) for _ in range(size)], np.uint64)) for _ in range(2)]
        sets.append(np.unique(np.r_[sets[0][: size // 2], sets[1]]))
        for a in sets:
            for b in sets:
                words = [np.frombuffer(minhash.parities(s), np.uint64).reshape(1, -1) for s in (a, b)]
                differing, common = minhash._differing(*words)[0], len(np.intersect1d(a, b))
                assert differing <= len(a) + len(b) - 2 * common
                if 100 * common >= 75 * (len(a) + len(b) - common):
                    assert minhash._bounded(differing, len(a) + len(b))


def test_words_are_not_cut_between_parts(monkeypatch):
    whole = minhash.shingles([b"some words here and there and everywhere", b"x" * 50 + b" y"])
    monkeypatch.setattr(minhash, "PART", 4)
    parts = minhash.shingles([b"some words here and there and everywhere", b"x" * 50 + b" y"])
    assert [a.tolist() for a in whole] == [b.tolist() for b in parts]
