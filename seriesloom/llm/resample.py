"""Importance resampling towards a target: hashed one- and two-word features by Arrow kernels, seeded Gumbel scores.

A slice of texts is put in lower case, split and flattened by Arrow's kernels, and its words become indices of a dictionary.
Shifted indices form the pairs of words; every distinct word and pair is hashed once. Of all documents and of the
target only the counts per bucket are gathered. A document's weight is the mean of its features' gains, and the highest
weights with seeded noise are drawn, which draws without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored

BUCKETS = 10_000
#: Words that a document needs to be drawn, percent of such documents that are drawn, and the seed of the noise.
WORDS, PERCENT, SEED = 20, 25, 7
#: Bytes of a long text that are split at a time.
PART = 1 << 20

#: Everything but digits, a-z and what is not ASCII, after A-Z are in lower case.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BREAK = [not (48 <= b <= 57 or 97 <= b <= 122 or b >= 128) for b in range(256)]


def _encoded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Text and dictionary index of every word, and the dictionary."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), _BETWEEN)
    coded = pc.dictionary_encode(pc.list_flatten(lists))
    row, index = np.asarray(pc.list_parent_indices(lists)), np.asarray(coded.indices)
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    some = np.array([bool(n) for n in names], bool)[index] if names else np.zeros(0, bool)
    return row[some], index[some], names


def buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of every feature, and the words of each text. Features of a text are its words, then its pairs."""
    row, index, names = _encoded(texts)
    crc = [zlib.crc32(n) for n in names]
    single = np.array(crc, np.int64) % BUCKETS
    follows = np.flatnonzero(row[1:] == row[:-1])
    pairs, inverse = np.unique(index[follows].astype(np.int64) * max(1, len(names)) + index[follows + 1], return_inverse=True)
    spaced = [b" " + n for n in names]
    left, right = np.divmod(pairs, max(1, len(names)))
    double = np.array([zlib.crc32(spaced[b], crc[a]) % BUCKETS for a, b in zip(left.tolist(), right.tolist(), strict=True)], np.int64)
    bucket = np.concatenate([single.take(index), double.take(inverse)])
    return np.concatenate([row, row[follows]]), bucket, np.bincount(row, minlength=len(texts))


def _parts(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    """A long text in parts that cut no word, and of each its last word, which pairs with the next part's first."""
    at, size = 0, len(text)
    lower = text.lower()
    while at < size:
        end = at + PART
        while end < size and not _BREAK[lower[end]]:
            end += 1
        end = min(end, size)
        last = end
        while last > at and _BREAK[lower[last - 1]]:
            last -= 1
        first = last
        while first > at and not _BREAK[lower[first - 1]]:
            first -= 1
        yield text[at:end], text[first:last]
        at = end


def summed(texts: pa.Array, gains: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, words and sum of gains of each text; with no gains, the counts per bucket in place of the sums."""
    if len(texts) == 1 and texts[0].is_valid and len(data := texts[0].as_buffer().to_pybytes()) > PART:
        return _long(data, gains)
    row, bucket, words = buckets(texts)
    features = np.bincount(row, minlength=len(texts))
    if gains is None:
        return features, words, np.bincount(bucket, minlength=BUCKETS)
    order = np.argsort(row, kind="stable")
    some = np.flatnonzero(features)
    out = np.zeros(len(texts), np.int64)
    if len(some):
        out[some] = np.add.reduceat(gains.take(bucket[order]), (np.cumsum(features) - features)[some])
    return features, words, out


def _long(data: bytes, gains: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One long text part by part: a part's last word is read again before the next part and taken off once."""
    total, before = None, b""
    for part, last in _parts(data):
        joined = summed_text(before + b" " + part, gains) if before else summed_text(part, gains)
        if before:
            joined = [a - b for a, b in zip(joined, summed_text(before, gains), strict=True)]
        total = joined if total is None else [a + b for a, b in zip(total, joined, strict=True)]
        before = last or before
    return tuple(total)


def summed_text(text: bytes, gains: np.ndarray | None) -> list[np.ndarray]:
    row, bucket, words = buckets(pa.array([text.decode()], pa.string()))
    return [np.array([len(bucket)]), words, np.bincount(bucket, minlength=BUCKETS) if gains is None else np.array([gains.take(bucket).sum()], np.int64)]


def _texts(table: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")


def bucket_counts(table: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features per bucket over every row of ``table``; a task sends a row per bucket it has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch):
                total += summed(part.column("text"), None)[2]
        met = np.flatnonzero(total)
        yield pa.record_batch([pa.array(met, pa.int32()), pa.array(total[met])], names=["bucket", "n"])

    counts = table.select(_texts(table, text_col)).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in counts.collect():  # BUCKETS rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target to source share per bucket, one added to each count."""
    whole, wanted = int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (whole + BUCKETS) / ((s + 1) * (wanted + BUCKETS)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variable, from a hash of seed and id; a null id counts as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighted(docs: DataFrame, per_bucket: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight of every row: the floored mean of its features' gains, 0 without any."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                features, words, sums = summed(part.column("text"), per_bucket)
                weight = sums // np.maximum(features, 1)
                yield pa.record_batch([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in (words, features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).alias("doc_id"), _texts(docs, text_col)).mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their number from 1 in ``order``: sorted ranges are numbered apart and offset by the rows before them.

    Ranges come from Spark's sample of the order itself, so they are even whatever the values are; only counts per
    range meet. Rows alike in the whole order may be numbered either way.
    """
    ranged = stored(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "resample-ranges")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))  # a row per range
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(name, own).join(F.broadcast(offsets), "_range").withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = PERCENT, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row, all but the id long.

    Of the N rows with at least ``words`` words the floor(percent * N / 100) of highest score are drawn and ranked from
    1, equal scores by id, null last; other ranks are null. Null texts have no features and weight 0, as have empty
    ones. Every row counts, repeated ones too. An empty ``docs`` gives no rows, an empty ``target`` weighs by
    rarity alone. Other columns are not read.
    """
    per_bucket = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    rows = weighted(docs, per_bucket, id_col, text_col)
    rows = stored(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resample-rows")
    fit = rows.where(F.col("n_words") >= words)
    draw = percent * fit.count() // 100
    ranked = in_order(fit, [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("weight").asc()], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    others = rows.where(F.col("n_words") < words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns).unionByName(others.select(*columns))
