"""Importance resampling against the definition written out, and what it does to the documents drawn."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from seriesloom.llm import resample
from seriesloom.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SF = "/root/testdata/sf0.001"


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def features(text):
    words = split(text)
    return [zlib.crc32(f.encode()) % 10000 for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]]


def expected(docs, target):
    """Rows (doc_id, n_features, weight, score, rank) by plain loops."""
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in features(text):
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    rows = []
    for doc, text in docs:
        own = features(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(own), weight, score, None, len(split(text)) >= 20])
    drawn = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for n, r in enumerate(drawn[: 25 * len(drawn) // 100], 1):
        r[4] = n
    return sorted(str(r[:5]) for r in rows)


def found(df):
    return sorted(str([r.doc_id, r.n_features, r.weight, r.score, r["rank"]]) for r in df.collect())


def test_whole_tables(spark):
    docs, target = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    rows = found(resample.resample(docs, target))
    assert rows == expected([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])


def test_hard_rows(spark, hard, nothing):
    target = spark.createDataFrame([(1, "alpha BETA gamma"), (2, None), (3, "漢字 😀")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in hard.collect()] * 9
    many = hard
    for _ in range(8):
        many = many.unionByName(hard)
    texts = [r.text for r in target.collect()]
    assert found(resample.resample(many, target)) == expected(rows, texts)
    assert found(resample.resample(many, nothing)) == expected(rows, [])
    assert resample.resample(nothing, target).count() == 0
    assert found(resample.resample(hard.where("text is null or text = ''"), target)) == expected([r for r in rows[: hard.count()] if not r[1]], texts)


@pytest.mark.parametrize("seed", range(3))
def test_parts_of_long_texts(monkeypatch, seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice(["Ab", "é", "漢", " ", " - ", "_", "7", "x" * 30, ". " * 20]) for _ in range(3000))
    gain = np.arange(10000)
    array = pa.array([text])
    whole = resample.summed(array, None), resample.summed(array, gain)
    monkeypatch.setattr(resample, "PART", rnd.choice([7, 50, 1000]))
    for before, after in zip(whole, (resample.summed(array, None), resample.summed(array, gain)), strict=True):
        assert all((a == b).all() for a, b in zip(before, after, strict=True))
    assert whole[0][0][0] == len(features(text)) and whole[0][1][0] == len(split(text))
    assert whole[1][2][0] == sum(features(text))


def test_ranks_over_ranges(spark):
    rows = [(i % 50, i) for i in range(5000)] + [(7, 5000 + i) for i in range(5000)]
    df = spark.createDataFrame(rows, "score long, doc_id long")
    ranked = resample.in_order(df.repartition(3), [resample.F.desc("score"), resample.F.col("doc_id").asc()], "rank")
    assert sorted((r["rank"], r.score, r.doc_id) for r in ranked.collect()) == [(n, *r) for n, r in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1)]


def test_drawn_documents_are_nearer_to_the_target(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(f"{'t' if i % 10 == 0 else 's'}{rnd.randrange(300)}" for _ in range(60))) for i in range(2000)]
    target = spark.createDataFrame([(" ".join(f"t{rnd.randrange(300)}" for _ in range(60)),) for _ in range(50)], "text string")
    drawn = [r.doc_id for r in resample.resample(spark.createDataFrame(rows, "doc_id long, text string"), target).where("rank is not null").collect()]
    assert len(drawn) == 500 and sum(d % 10 == 0 for d in drawn) > 150  # of the 200 alike to the target
