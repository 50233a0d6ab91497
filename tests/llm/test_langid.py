"""Languages: the models against Kneser-Ney written out with dictionaries, and accuracy on rows held out."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from seriesloom.llm import langid
from seriesloom.llm.common import table

SF = "/root/testdata/sf0.01"


def plain_model(counts, symbols):
    """chance(context, symbol) by recursion over dictionaries, from the definition."""
    order = langid.ORDER
    raw = [Counter() for _ in range(order + 1)]
    for word, n in counts.items():
        marked = ("<", *word, ">")
        for k in range(1, order + 1):
            for i in range(max(k - 1, 1), len(marked)):
                raw[k][marked[i - k + 1 : i + 1]] += n
    used = [None] * (order + 1)
    for k in range(1, order + 1):
        if k == order:
            used[k] = dict(raw[k])
            continue
        before = defaultdict(set)
        for gram in raw[k + 1]:
            before[gram[1:]].add(gram[0])
        used[k] = {g: raw[k][g] if g[0] == "<" else len(before[g]) for g in raw[k]}
    discount = [0.0] * (order + 1)
    for k in range(1, order + 1):
        ones, twos = (sum(v == x for v in used[k].values()) for x in (1, 2))
        discount[k] = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.1
    after = defaultdict(list)
    for k in range(1, order + 1):
        for gram, n in used[k].items():
            after[k, gram[:-1]].append(n)

    def chance(context, symbol):
        k = len(context) + 1
        seen = after[k, context]
        below = 1 / symbols if k == 1 else chance(context[1:], symbol)
        if not seen:
            return below
        own = max(used[k].get((*context, symbol), 0) - discount[k], 0)
        return own / sum(seen) + discount[k] * len(seen) / sum(seen) * below

    return chance


def plain_score(chance, word):
    marked = ("<", *word, ">")
    return sum(math.log(chance(marked[max(0, i - langid.ORDER + 1) : i], marked[i])) for i in range(1, len(marked)))


def make_counts(seed):
    rnd = random.Random(seed)
    return {lang: dict(Counter("".join(rnd.choices(parts, k=rnd.randint(1, 4))) for _ in range(300))) for lang, parts in (("aa", ["ka", "to", "ri", "n"]), ("bb", ["ska", "eu", "t", "oë"]))}


@pytest.mark.parametrize("seed", range(2))
def test_models_equal_the_definition(seed):
    counts = make_counts(seed)
    model = langid.Model.of(counts)
    tried = [*list(counts["aa"])[:40], *list(counts["bb"])[:40], "q", "kaq", "zzzzzzzz", "漢字", "a" * 64]
    found = model.word_scores(tried)
    symbols = len({c for own in counts.values() for w in own for c in w}) + 2
    for n, lang in enumerate(model.languages):
        chance = plain_model(counts[lang], symbols)
        for word, row in zip(tried, found, strict=True):
            assert math.isclose(row[n], plain_score(chance, word), rel_tol=1e-5), (lang, word)


def test_chances_add_up():
    counts = make_counts(5)["aa"]
    alphabet = sorted({c for w in counts for c in w})
    chance = plain_model(counts, len(alphabet) + 1)
    for context in (("<",), ("k", "a"), ("t", "o", "r", "i"), ("q",)):
        assert math.isclose(sum(chance(context, c) for c in [*alphabet, ">"]), 1, rel_tol=1e-9)


def test_words_of_long_texts_are_not_cut():
    text = "Straße naïve 3x a_b ² " * 20_000
    assert langid.words(text) == Counter({"straße": 20_000, "naïve": 20_000, "x": 20_000, "a": 20_000, "b": 20_000, "²": 20_000})
    assert langid.words("é" * 300) == Counter({"é" * 64: 4, "é" * 44: 1})
    assert not langid.has_letter(Counter({"²": 1})) and langid.has_letter(Counter({"²x": 1}))


def test_cache_changes_nothing(monkeypatch):
    model = langid.Model.of(make_counts(1))
    texts = [langid.words(" ".join(make_counts(s)["aa"])) for s in range(8)]
    whole = langid.Reader(model).entropies(texts)[0]
    monkeypatch.setattr(langid, "CACHE", 100)
    monkeypatch.setattr(langid, "BATCH", 7)
    reader = langid.Reader(model)
    for row, text in enumerate(texts):
        assert reader.entropies([text])[0][0] == pytest.approx(whole[row])


def held(doc_id, by=3):
    return zlib.crc32(str(doc_id).encode()) % by


def test_accuracy_on_rows_held_out(spark):
    docs = table(spark, SF, "documents")
    truth = {r.doc_id: r for r in docs.collect()}
    model = langid.fit(docs)
    rows = langid.predict_languages(docs, model).collect()
    assert len(rows) == len(truth) and all(r.held_out == (held(r.doc_id) == 1) for r in rows)
    unseen = [r for r in rows if r.held_out]
    right = [r.lang_pred == truth[r.doc_id].lang for r in unseen]
    assert sum(right) >= 0.98 * len(unseen)
    # calibrated: the mean score is near the share that is right
    assert abs(sum(r.score for r in unseen) / len(unseen) - sum(right) / len(unseen)) < 0.05
    plain = langid.predictions(langid.Reader(model), [langid.words(truth[r.doc_id].text) for r in unseen[:50]])
    assert [(r.lang_pred, round(r.score, 9)) for r in unseen[:50]] == [(lang, round(s, 9)) for lang, s in plain]


def test_learns_only_from_its_rows(spark):
    rows = [(i, "kato rin" if i % 2 else "ska teu", ("aa" if i % 2 else "bb") if held(i) != 1 else "never") for i in range(300)]
    rows += [(1000 + i, "kato rin", None) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == ["aa", "bb"]
    assert {(r.doc_id % 2, r.lang_pred) for r in langid.predict_languages(docs, model).where("doc_id < 300").collect()} == {(1, "aa"), (0, "bb")}


def test_hard_rows(spark, hard, nothing):
    model = langid.fit(hard)
    rows = langid.predict_languages(hard, model).collect()
    assert len(rows) == hard.count()
    assert {r.lang_pred for r in rows if r.doc_id in (4, 5, 6)} == {"und"} and {r.score for r in rows if r.doc_id in (4, 5, 6)} == {0.0}
    assert all(0 <= r.score <= 1 and r.lang_pred in [*model.languages, "und"] for r in rows)
    assert {r.lang_pred for r in langid.predict_languages(hard, model, least=1.1).collect()} == {"und"}
    empty = langid.fit(nothing)
    assert empty.languages == [] and langid.predict_languages(nothing, empty).count() == 0
    assert {r.lang_pred for r in langid.predict_languages(hard, empty).collect()} == {"und"}
