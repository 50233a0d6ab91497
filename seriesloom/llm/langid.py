"""Language by interpolated Kneser-Ney models of letters, one per language, with a calibrated score.

A text's words, runs of letters in lower case, are read letter by letter between a begin and an end mark. Each
language's model tells a letter's chance after the up to four symbols before it, and the language with the least
cross-entropy per symbol is chosen. All models share sorted arrays of gram hashes, one per order, beside a matrix with
a column per language, so one binary search serves all languages.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, slices, stored

ORDER = 5
#: Distinct texts a language is learned from, words kept of them, and languages: the fit's bounds.
DOCUMENTS, WORDS, LANGUAGES = 2000, 20_000, 256
#: A fifth of the texts calibrates; of each the whole and one run of so many words.
CALIBRATE, RUNS = 5, (1, 2, 4, 8, 16)
#: Words whose scores a task remembers, words scored at a time, and code points of a part of a long text.
CACHE, BATCH, PART = 300_000, 20_000, 1 << 18
NONE = "und"

_WORD = re.compile(r"[^\W\d_]{1,64}")
_LETTER = re.compile(r"[^\W\d_]")
_BEGIN, _END = "\x02", "\x03"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> Counter[str]:
    """Runs of letters in lower case, longer ones in pieces of 64, counted; long texts are read in parts that cut no run."""
    text, out, at = text.lower(), Counter(), 0
    while at < len(text):
        end = at + PART
        while end < len(text) and _LETTER.match(text, end):
            end += 1
        out.update(_WORD.findall(text, at, min(end, len(text))))
        at = end
    return out


def has_letter(found: Counter[str]) -> bool:
    return any(map(str.isalpha, found)) or any(c.isalpha() for word in found for c in word)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def grams(some: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes per order of the gram that ends at each symbol, the symbol's place in its word, and the word's number.

    A gram that would begin before its word has no meaning; its place is below its order less one.
    """
    marked = [_BEGIN + word + _END for word in some]
    symbols = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(m) for m in marked], np.int64)
    number = np.repeat(np.arange(len(some)), sizes)
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes = [_mixed((symbols + np.uint64(1)) * _MIX)]
    for k in range(1, ORDER):
        before = np.r_[np.zeros(k, np.uint64), symbols[:-k]] if len(symbols) > k else np.zeros(len(symbols), np.uint64)
        hashes.append(_mixed((hashes[-1] + before + np.uint64(1)) * _MIX))
    return hashes, place, number


@dataclass(frozen=True)
class Language:
    """One language's model: per order gram hashes with ln p, context hashes with ln of the weight of the order below."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    unseen: float


def kneser_ney(counts: dict[str, int], symbols: int) -> Language:
    """Interpolated Kneser-Ney over the words and their counts; ``symbols`` is the size of the alphabet of all languages.

    The highest order counts occurrences; the ones below count the different symbols found before a gram, and
    occurrences where it begins a word. Each order has one absolute discount, n1 / (n1 + 2 n2).
    """
    some = list(counts)
    hashes, place, number = grams(some)
    times = np.array([counts[w] for w in some], np.float64)[number]
    out_grams, out_contexts = [], []
    below = np.zeros(0)
    unseen = 0.0
    for k in range(1, ORDER + 1):
        here = np.flatnonzero(place >= max(k - 1, 1))  # the begin mark is never foretold
        keys, first, inverse = np.unique(hashes[k - 1][here], return_index=True, return_inverse=True)
        raw = np.bincount(inverse, times[here], len(keys))
        adjusted = raw
        if k < ORDER:
            longer = here[place[here] >= k]
            _, one = np.unique(hashes[k][longer], return_index=True)
            kinds = np.bincount(np.searchsorted(keys, hashes[k - 1][longer[one]]), minlength=len(keys))
            starts = place[here[first]] == k - 1
            adjusted = np.where(starts, raw, kinds) if k > 1 else kinds.astype(float)
        ones, twos = int((adjusted == 1).sum()), int((adjusted == 2).sum())
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.1
        own = np.maximum(adjusted - discount, 0)
        if k == 1:
            total = adjusted.sum()
            unseen = discount * len(keys) / total / symbols
            p = own / total + unseen
        else:
            before = hashes[k - 2][here[first] - 1]
            contexts, of = np.unique(before, return_inverse=True)
            total = np.bincount(of, adjusted)
            weight = discount * np.bincount(of) / total
            lower_keys, lower = out_grams[-1][0], below
            suffix = np.searchsorted(lower_keys, hashes[k - 2][here[first]])
            p = own / total[of] + weight[of] * lower[suffix]
            out_contexts.append((contexts, np.log(weight)))
        below = p
        out_grams.append((keys, np.log(p)))
    return Language(out_grams, out_contexts, float(np.log(unseen)))


def _merged(tables: list[tuple[np.ndarray, np.ndarray]], missing: float) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(np.concatenate([k for k, _ in tables]))
    values = np.full((len(keys), len(tables)), missing, np.float32)
    for n, (own, value) in enumerate(tables):
        values[np.searchsorted(keys, own), n] = value
    return keys, values


def _rows(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, place, -1)


@dataclass(frozen=True, eq=False)
class Model:
    """All languages' models over common sorted hashes, and the calibration's line."""

    languages: list[str] = field(default_factory=list)
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    unseen: np.ndarray = field(default_factory=lambda: np.zeros(0))
    line: tuple[float, ...] = (0.0, 1.0, 0.0)

    @staticmethod
    def of(counts: dict[str, dict[str, int]]) -> Model:
        """Learn from the words of each language and their counts."""
        names = sorted(counts)
        if not names:
            return Model()
        symbols = len({c for own in counts.values() for word in own for c in word}) + 2
        made = [kneser_ney(counts[n], symbols) for n in names]
        both = [_merged([m.grams[k] for m in made], np.nan) for k in range(ORDER)]
        contexts = [_merged([m.contexts[k] for m in made], 0.0) for k in range(ORDER - 1)]
        return Model(names, both, contexts, np.array([m.unseen for m in made]))

    def word_scores(self, some: list[str]) -> np.ndarray:
        """ln of each word's chance, a row per word and a column per language."""
        out = [np.zeros((0, len(self.languages)))]
        for at in range(0, len(some), BATCH):
            part = some[at : at + BATCH]
            hashes, place, number = grams(part)
            here = np.flatnonzero(place >= 1)
            found = None
            for k in range(1, ORDER + 1):
                keys, values = self.grams[k - 1]
                row = _rows(keys, hashes[k - 1][here])
                own = np.where((row >= 0)[:, None], values[row], np.nan)
                if k == 1:
                    found = np.where(np.isnan(own), self.unseen, own)
                    continue
                keys, values = self.contexts[k - 2]
                row = _rows(keys, hashes[k - 2][here - 1])
                other = np.where((row >= 0)[:, None], values[row], 0) + found
                found = np.where((place[here] >= k - 1)[:, None], np.where(np.isnan(own), other, own), found)
            starts = np.searchsorted(number[here], np.arange(len(part)))
            out.append(np.add.reduceat(found, starts, axis=0, dtype=np.float64))
        return np.concatenate(out)


class Reader:
    """Cross-entropies of texts by a model; scores of words are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)))

    def entropies(self, texts: list[Counter[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol of each text and language, and each text's symbols, end marks included; 0 without words."""
        every = set().union(*texts) if texts else set()
        if len(self.known) + len(every - self.known.keys()) > CACHE:
            self._forget()
        new = sorted(every - self.known.keys())
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
        symbols = np.array([sum(n * (len(w) + 1) for w, n in t.items()) for t in texts], np.int64)
        out = np.zeros((len(texts), len(self.model.languages)))
        for row, found in enumerate(texts):
            if found:
                at = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
                times = np.fromiter(found.values(), np.float64, len(found))
                out[row] = times @ self.scores[at] / (-np.log(2) * symbols[row])
        return out, symbols


def _features(entropies: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best language's column, the first of equal ones, and what the score is made of: lead and entropy."""
    best = entropies.argmin(axis=1)
    ranked = np.sort(entropies, axis=1)
    lead = (ranked[:, 1] - ranked[:, 0] if entropies.shape[1] > 1 else np.ones(len(best))) * np.sqrt(symbols)
    return best, np.stack([np.ones(len(best)), lead, ranked[:, 0]], axis=1)


def _scored(line: tuple[float, ...], features: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ np.array(line), -30, 30)))


def predictions(reader: Reader, texts: list[Counter[str]], least: float = 0.0) -> list[tuple[str, float]]:
    """Language and score of each text; ``und`` and 0 without a letter or a model, ``und`` with a score below ``least``."""
    if not reader.model.languages:
        return [(NONE, 0.0)] * len(texts)
    entropies, symbols = reader.entropies(texts)
    best, features = _features(entropies, symbols)
    scores = _scored(reader.model.line, features)
    return [
        ((reader.model.languages[b] if s >= least else NONE), s) if has_letter(t) else (NONE, 0.0)
        for t, b, s in zip(texts, best.tolist(), scores.tolist(), strict=True)
    ]


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3).cast("int")


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """lang, h, text, place: of each language the ``DOCUMENTS`` distinct whole texts first in hash order, numbered.

    Languages are the ``LANGUAGES`` with most rows. Rows are thinned by the texts' hash before they meet, and rows
    of equal texts are joined on the tasks that read them, so copies give one row.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & (remainder(F.col(id_col)) != 1))
    sizes = rows.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    share = F.least(F.lit(1.0), F.lit(3.0 * DOCUMENTS) / F.col("count")) * F.lit(1 << 30)
    texts = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")).where("text != ''")
    thinned = texts.join(F.broadcast(sizes.select("lang", share.alias("share"))), "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("share"))
    distinct = thinned.groupBy("lang", "h").agg(F.first("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h"))
    return distinct.withColumn("place", place).where(F.col("place") <= DOCUMENTS)


def _counted(texts: DataFrame) -> dict[str, dict[str, int]]:
    """Of each language the ``WORDS`` most frequent words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found: Counter[tuple[str, str]] = Counter()
                for lang, text in zip(*(part.column(c).to_pylist() for c in ("lang", "text")), strict=True):
                    found.update({(lang, word): n for word, n in words(text).items()})
                columns = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())]
                yield pa.record_batch(columns, names=["lang", "word", "n"])

    counts = texts.select("lang", "text").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    out: dict[str, dict[str, int]] = {}
    for row in counts.withColumn("place", place).where(F.col("place") <= WORDS).toArrow().to_pylist():
        out.setdefault(row["lang"], {})[row["word"]] = row["n"]
    return out


def _calibrated(model: Model, texts: DataFrame) -> tuple[float, ...]:
    """The logistic line from lead and entropy to the chance of being right, over whole texts and runs of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for part in slices(batch):
                tried, right = [], []
                for lang, text, h in zip(*(part.column(c).to_pylist() for c in ("lang", "text", "h")), strict=True):
                    whole = words(text)
                    every = list(whole.elements())
                    runs = [Counter(every[(at := h % (len(every) - n + 1)) : at + n]) for n in RUNS if n < len(every)]
                    for counted in (whole, *runs) if whole else ():
                        tried.append(counted)
                        right.append(lang)
                if tried:
                    best, features = _features(*reader.entropies(tried))
                    good = [float(model.languages[b] == lang) for b, lang in zip(best.tolist(), right, strict=True)]
                    yield pa.record_batch([pa.array(c, pa.float64()) for c in (features[:, 1], features[:, 2], good)], names=["lead", "entropy", "good"])

    known = texts.where(F.col("lang").isin(model.languages)).select("lang", "text", "h").mapInArrow(run, "lead double, entropy double, good double").toPandas()
    if not len(known):
        return Model.line
    design = np.stack([np.ones(len(known)), known["lead"], known["entropy"]], axis=1)
    return logistic(design, known["good"].to_numpy())


def logistic(design: np.ndarray, goal: np.ndarray) -> tuple[float, ...]:
    """Weights by Newton steps with a small ridge; goals are drawn a little inward so that the line stays finite."""
    goal = (goal * len(goal) + 0.5) / (len(goal) + 1)
    line = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ line, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(len(line))
        step = np.linalg.solve(hessian, design.T @ (goal - p) - 1e-3 * line)
        line += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, line))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from text and language of the rows whose remainder is not 1; see :func:`sample` for the bounds.

    Null languages and empty texts are left out. Only counted words and two numbers per calibrated text reach the
    driver. Without such rows the model has no language.
    """
    texts = stored(sample(docs, id_col, text_col, lang_col), "lang-sample")
    held = F.col("place") % CALIBRATE == 0
    model = Model.of(_counted(texts.where(~held)))
    if not model.languages:
        return model
    return Model(model.languages, model.grams, model.contexts, model.unseen, _calibrated(model, texts.where(held)))


def _work(reader_of: Callable[[], Reader], least: float, texts: list[str]) -> dict[str, list]:
    found = predictions(reader_of(), [words(t) for t in texts], least)
    return {"lang_pred": [lang for lang, _ in found], "score": [score for _, score in found]}


class _Once:
    """A model's reader, made where it is first called for: a task has one."""

    def __init__(self, model: Model):
        self.model, self.reader = model, None

    def __call__(self) -> Reader:
        self.reader = self.reader or Reader(self.model)
        return self.reader


def predict_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least: float = 0.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; other columns are not read, an empty table gives no rows.

    ``lang_pred`` is the language of least cross-entropy, the first in code point order of equal ones, and
    ``score`` the calibrated chance that it is right. Texts scored below ``least`` are ``und``, as are, with score
    0, null texts and texts without a letter. Equal texts get equal results.
    """
    work = functools.partial(_work, _Once(model), least)
    found = map_texts(docs, "lang_pred string, score double", work, id_col, text_col)
    return found.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score")
