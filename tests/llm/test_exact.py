"""Composable fingerprints and exact duplicates against plain grouping."""

import hashlib
import random
import re
import sys
from collections import defaultdict

import numpy as np
import pytest
from conftest_llm import make_texts
from pyspark import cloudpickle

from seriesloom.llm import exact

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # its functions run on workers

WHITE = re.compile(r"[\x20\x09-\x0D]")


def plain_fingerprint(data: bytes) -> list[int]:
    out = [0] * len(exact.BASES)
    for byte in data:
        out = [(v * int(b) + byte) % exact.PRIME for v, b in zip(out, exact.BASES, strict=True)]
    return out


def test_fingerprints_equal_horner_and_compose():
    rnd = random.Random(3)
    texts = [rnd.randbytes(n) for n in (0, 1, 5, exact.CHUNK - 1, exact.CHUNK, exact.CHUNK + 1, 3 * exact.CHUNK + 7)]
    found = exact.fingerprints(texts)
    assert [list(map(int, f)) for f in found] == [plain_fingerprint(t) for t in texts]
    for a in range(len(texts)):
        for b in range(len(texts)):
            both = exact.fingerprints([texts[a] + texts[b]])[0]
            assert list(exact.combine(found[a], found[b], len(texts[b]))) == list(both)


def test_long_text_spans_products(monkeypatch):
    monkeypatch.setattr(exact, "ROWS", 2)
    text = random.Random(1).randbytes(7 * exact.CHUNK + 3)
    assert list(map(int, exact.fingerprints([b"x", text, b""])[1])) == plain_fingerprint(text)


def expected(rows):
    groups = defaultdict(list)
    for n, (doc, text) in enumerate(rows):
        groups[WHITE.sub("", text or "")].append((-len(text or ""), doc is None, doc or 0, n))
    out = []
    for text, members in groups.items():
        best = min(members)
        for member in members:
            doc = None if member[1] else member[2]
            keep = None if best[1] else best[2]
            out.append((doc, keep, len(members), member[3] == best[3], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(str, out))


def found(df):
    return sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in df.collect())


def test_hard_rows(spark, hard, nothing):
    assert found(exact.exact_duplicates(hard)) == expected([(r.doc_id, r.text) for r in hard.collect()])
    assert exact.exact_duplicates(nothing).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_copies(spark, seed):
    rows = list(enumerate(make_texts(seed)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(exact.exact_duplicates(df)) == expected(rows)


def by_length(texts):
    return [f"{len(t):x}" for t in texts]


def test_equal_fingerprints_of_different_texts_are_told_apart(spark):
    """With all texts of a length colliding, the comparison has to find the differences."""
    rows = list(enumerate(["ab", "a b", "cd", "cd", "xyz", "", "cdcd" * 40000, "cdcd" * 39999 + "cdce", "cdcd" * 40000]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(exact.exact_duplicates(df, keys_of=by_length)) == expected(rows)


def test_powers():
    exponents = np.array([0, 1, 2, 3, 1000, 123456789])
    assert exact.powers(exact.BASES, exponents).tolist() == [[pow(int(b), int(e), exact.PRIME) for b in exact.BASES] for e in exponents]
