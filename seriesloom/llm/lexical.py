"""Ranked lexical search: the largest integer scores of each item over impact vectors in buckets of length.

A document is the vector of its impacts on the terms of the items, an item the vector of its terms' weights, and a
score their product. Vectors are taken in order of length, the longest sixteenth of all documents before the others, and
in each task from the longest bucket on. A bucket is passed over for an item where the product of lengths cannot reach
the item's threshold, the least of the best scores known so far (Cauchy-Schwarz). Inside a bucket the largest impact on each
coordinate bounds what an item's lighter coordinates can add; they are left out as long as they cannot make half the
threshold, so only documents that hold one of the heavier ones are looked at, and what their part and the bound
cannot lift to the threshold falls away. Survivors are scored in whole numbers.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored

#: Documents that an item gets.
TOP = 20
#: Coordinates of a block of items: a bound of what is told to all tasks at once. One item may be larger by itself.
BLOCK = 1 << 17
#: Rows of a bucket of vectors, and the share of documents, the longest, that set the thresholds.
BUCKET, FIRST = 256, 16
#: Bytes of a long text whose terms are taken at a time, and pairs that are scored at a time.
PART, PAIRS = 1 << 20, 1 << 15

_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> Counter[bytes]:
    """Terms of a text with their occurrences: runs of letters, digits and whatever is not ASCII, A-Z in lower case."""
    if len(text) <= PART:
        return Counter(text.translate(_KEEP).split())
    out, plain, at = Counter(), text.translate(_KEEP), 0
    while at < len(plain):
        end = plain.find(b" ", at + PART)
        end = len(plain) if end < 0 else end
        out.update(plain[at:end].split())
        at = end
    return out


def item_vectors(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item (a key), item_id, term, times of the distinct rows of ``items``."""
    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    key = F.concat_ws(":", F.col("item_id").isNull().cast("string"), F.col("item_id").cast("string"), F.sha2("text", 256))
    rows = rows.select(key.alias("item"), "item_id", "text").dropDuplicates(["item"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts = [terms(t) for t in part.column("text").to_pylist()]
                row = pa.array(np.repeat(np.arange(len(counts)), [len(c) for c in counts]))
                columns = [part.column("item").take(row), part.column("item_id").take(row), pa.array([t for c in counts for t in c], pa.binary()), pa.array([n for c in counts for n in c.values()], pa.int64())]
                yield pa.record_batch(columns, names=["item", "item_id", "term", "times"])

    return rows.mapInArrow(run, f"item string, item_id {kind}, term binary, times long")


def document_vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (terms with repeats), at (places in ``vocabulary``) and tf of every row; a null text has no terms."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: n for n, term in enumerate(vocabulary)}
        for batch in batches:
            for part in slices(batch):
                sizes, at, tf, total = [], [], [], []
                for text in part.column("text").to_pylist():
                    counts = terms(text)
                    found = [(place[t], n) for t, n in counts.items() if t in place]
                    sizes.append(len(found))
                    at.extend(a for a, _ in found)
                    tf.extend(n for _, n in found)
                    total.append(counts.total())
                ends = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, t)) for x, t in ((at, pa.int32()), (tf, pa.int64()))]
                yield pa.record_batch([part.column("doc_id"), pa.array(total, pa.int64()), *lists], names=["doc_id", "n", "at", "tf"])

    return rows.mapInArrow(run, f"doc_id {kind}, n long, at array<int>, tf array<bigint>")


def impact(tf, m):
    """What ``tf`` occurrences of a term count in a document of relative length ``m``, below a million."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass(frozen=True, eq=False)
class Items:
    """Weighted coordinates of a block of items, in order of item and term, and what each item has to reach."""

    item: np.ndarray
    term: np.ndarray
    value: np.ndarray
    least: np.ndarray
    terms: int

    @functools.cached_property
    def lengths(self) -> np.ndarray:
        return np.sqrt(np.bincount(self.item, self.value.astype(float) ** 2, len(self.least)))

    @functools.cached_property
    def begins(self) -> np.ndarray:
        return np.searchsorted(self.item, np.arange(len(self.least) + 1))


class Search:
    """The best documents of every item among the vectors seen by one task."""

    def __init__(self, items: Items, top: int):
        self.items, self.top = items, top
        self.least = items.least.copy()
        self.best: list[list[tuple]] = [[] for _ in items.least]
        self.looked = self.scored = 0

    def take(self, ids: list, row: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
        """Vectors as (row, term, value) in order of row; ``ids`` are the rows' ids in ascending order, nulls last."""
        lengths = np.sqrt(np.bincount(row, value.astype(float) ** 2, len(ids)))
        order = np.lexsort((np.arange(len(ids)), -lengths))
        starts = np.searchsorted(row, np.arange(len(ids) + 1))
        for at in range(0, len(order), BUCKET):
            rows = np.sort(order[at : at + BUCKET])
            if lengths[order[at]] == 0:
                break  # no coordinates from here on
            sizes = starts[rows + 1] - starts[rows]
            where = np.repeat(starts[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            self._bucket(ids, rows, lengths[rows], np.repeat(np.arange(len(rows)), sizes), term[where], value[where])

    def _bucket(self, ids: list, rows: np.ndarray, lengths: np.ndarray, row: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
        items, least, many = self.items, self.least, len(self.least)
        active = items.lengths * lengths.max() * (1 + 1e-9) >= np.maximum(least, 1)
        if not active.any():
            return
        most = np.zeros(items.terms, np.int64)
        np.maximum.at(most, term, value)
        # of each active item the coordinates, the lightest first, that cannot make half its threshold are put off
        own = np.flatnonzero(active[items.item] & (most[items.term] > 0))
        reach = (items.value[own] * most[items.term[own]]).astype(float)
        order = np.lexsort((reach, items.item[own]))
        own, reach = own[order], reach[order]
        begins = np.searchsorted(items.item[own], np.arange(many + 1))
        upto = np.cumsum(reach)
        upto -= np.r_[0.0, upto][begins[items.item[own]]]
        heavy = upto * 2 > least[items.item[own]]
        rest = np.bincount(items.item[own[~heavy]], reach[~heavy], many)
        own = own[heavy]
        # the heavy coordinates' part of every product, over the vectors that hold one
        own = own[np.argsort(items.term[own], kind="stable")]
        first, last = (np.searchsorted(items.term[own], term, side) for side in ("left", "right"))
        times = last - first
        where = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())
        pair = np.repeat(row, times) * many + items.item[own[where]]
        part = np.bincount(pair, np.repeat(value, times) * items.value[own[where]].astype(float), len(rows) * many)
        self.looked += len(pair)
        found = np.flatnonzero(part)
        of, item = found // many, found % many
        upper = np.minimum(part[found] + rest[item], items.lengths[item] * lengths[of]) * (1 + 1e-9)
        keep = upper >= least[item]
        of, item = of[keep], item[keep]
        keys = row * items.terms + term
        sort = np.argsort(keys)
        keys, value = keys[sort], value[sort]
        for at in range(0, len(of), PAIRS):
            self._score(ids, rows, of[at : at + PAIRS], item[at : at + PAIRS], keys, value)

    def _score(self, ids: list, rows: np.ndarray, of: np.ndarray, item: np.ndarray, keys: np.ndarray, value: np.ndarray) -> None:
        """Exact products of the pairs; what belongs to the best of an item is kept."""
        items = self.items
        begin, end = items.begins[item], items.begins[item + 1]
        sizes = end - begin
        where = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        wanted = np.repeat(of, sizes) * items.terms + items.term[where]
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        products = np.where(keys[place] == wanted, value[place], 0) * items.value[where]
        score = np.add.reduceat(products, np.cumsum(sizes) - sizes)
        self.scored += len(score)
        keep = np.flatnonzero((score > 0) & (score >= self.least[item]))
        order = keep[np.lexsort((rows[of[keep]], -score[keep], item[keep]))]
        nth = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        changed = set()
        for n in order[nth < self.top].tolist():
            doc = ids[rows[of[n]]]
            self.best[item[n]].append((-int(score[n]), doc is None, 0 if doc is None else doc))
            changed.add(int(item[n]))
        for n in changed:
            self.best[n] = sorted(self.best[n])[: self.top]
            if len(self.best[n]) == self.top:
                self.least[n] = max(self.least[n], -self.best[n][-1][0])


def _best(vectors: DataFrame, items: Items, keys: list[str], top: int) -> DataFrame:
    """item, doc_id, score: the best of each task's vectors (doc_id, m, at, tf)."""
    kind = vectors.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, of_id = Search(items, top), None
        for batch in batches:
            of_id = batch.schema.field("doc_id").type
            table = batch.take(pc.sort_indices(batch.column("doc_id"), null_placement="at_end"))
            sizes = pc.list_value_length(table.column("at")).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            term, tf = (pc.list_flatten(table.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "tf"))
            search.take(table.column("doc_id").to_pylist(), row, term, impact(tf, np.asarray(table.column("m"))[row]))
        if of_id is not None:
            found = [(keys[n], None if none else doc, -score) for n, best in enumerate(search.best) for score, none, doc in best]
            yield pa.record_batch([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), of_id, pa.int64()))], names=["item", "doc_id", "score"])

    return vectors.select("doc_id", "m", "at", "tf").mapInArrow(run, f"item string, doc_id {kind}, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _length(tf: Column, m: Column) -> Column:
    value = (F.lit(1_000_000_000).cast("double"), F.lit(1000), F.lit(12))
    return F.sqrt(F.aggregate(tf, F.lit(0.0), lambda total, t: total + F.pow(value[0] * t / (value[1] * t + value[2] * m), F.lit(2.0))))


def _block(docs: DataFrame, coordinates: pa.Table, top: int, id_col: str, text_col: str) -> DataFrame:
    vocabulary = sorted(set(coordinates.column("term").to_pylist()))
    vectors = stored(document_vectors(docs, vocabulary, id_col, text_col), "search-vectors")
    documents, words = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = dict(vectors.select(F.explode("at").alias("at")).groupBy("at").count().toArrow().to_pandas().itertuples(index=False))
    keys = sorted(set(coordinates.column("item").to_pylist()))
    item = np.searchsorted(np.array(keys, object), np.array(coordinates.column("item").to_pylist(), object))
    term = np.searchsorted(np.array(vocabulary, object), np.array(coordinates.column("term").to_pylist(), object))
    value = np.asarray(coordinates.column("times")) * np.array([weight(documents, df.get(t, 0)) for t in range(len(vocabulary))], np.int64)[term]
    order = np.lexsort((term, item))
    items = Items(item[order], term[order], value[order], np.zeros(len(keys), np.int64), len(vocabulary))
    m = F.expr(f"75 + cast((25 * cast(n as decimal(38, 0)) * {documents}) div {max(words or 0, 1)} as bigint)")
    known = vectors.where(F.size("at") > 0).withColumn("m", m).withColumn("length", _length(F.col("tf"), F.col("m")))
    edge = known.agg(F.percentile_approx("length", 1 - 1 / FIRST, 1000)).first()[0]
    edge = math.inf if edge is None else edge
    first = stored(_best(known.where(F.col("length") >= edge), items, keys, top), "search-first")
    full = _ranked(first, top).where(F.col("rank") == top).select("item", "score").toArrow().to_pylist()
    least = dict.fromkeys(keys, 0) | {r["item"]: r["score"] for r in full}
    items = Items(items.item, items.term, items.value, np.array([least[k] for k in keys], np.int64), items.terms)
    others = _best(known.where(F.col("length") < edge), items, keys, top)
    return stored(_ranked(first.unionByName(others), top), "search-best")


def top_documents(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id, score: of each item the ``top`` documents of largest score above 0, equal ones by id.

    Items alike in id and text are one; those alike in the id only are ranked apart. Every row of ``docs`` is a
    document, a null id comes last among equal scores, null and empty texts score nothing. Items are taken in blocks of a
    bounded number of coordinates, each block against all documents; only its terms, their document counts and a
    threshold per item reach the driver. Empty tables give no rows; other columns are not read.
    """
    vectors = stored(item_vectors(items, item_col, text_col), "search-items")
    blocks = -(-vectors.count() // BLOCK)
    ids = vectors.select("item", "item_id").distinct()
    out = ids.select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(docs.schema[id_col].dataType).alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    for n in range(blocks):
        coordinates = vectors.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == n).select("item", "term", "times").toArrow()
        if coordinates.num_rows:
            best = _block(docs, coordinates, top, id_col, text_col)
            out = out.unionByName(best.join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out
