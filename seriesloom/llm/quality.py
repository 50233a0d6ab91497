"""Quality score from compression with dictionaries of good and of bad text."""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored

#: Code points of the pieces that are compressed; a text's sizes are the sums over its pieces. In longer ones the
#: dictionary counts for less and less against what the piece itself has shown.
PIECE = 512
#: Labelled documents that are taken per class to fit with, pieces of each, spread over its whole text, and pieces for a
#: class's dictionary: the fit's bounds.
DOCUMENTS, PER_DOCUMENT, PIECES = 2000, 12, 6000
#: Bytes of a dictionary.
DICTIONARY = 96 << 10
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """Dictionaries and the line of the calibration; without dictionaries the score is ``prior``."""

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    offset: float = 0.0
    prior: float = 0.5


@functools.lru_cache(maxsize=4)
def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in (good, bad):
        words = zstandard.ZstdCompressionDict(content)
        words.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False))
    return out


def difference(text: str | None, good: bytes, bad: bytes) -> float:
    """(size with the bad dictionary - size with the good one) / their sum, over all pieces; 0 for an empty text."""
    sizes = [0, 0]
    for at in range(0, len(text or ""), PIECE):
        piece = text[at : at + PIECE].encode()
        for i, compressor in enumerate(_compressors(good, bad)):
            sizes[i] += len(compressor.compress(piece))
    return (sizes[1] - sizes[0]) / sum(sizes) if text else 0.0


def score_of(model: Model, text: str | None) -> float:
    if not model.good:
        return model.prior
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * difference(text, model.good, model.bad) + model.offset))))


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def _clear(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """_id, label, part, h of the ids whose labels agree; null labels and ids are left out, and remainder 0 is held out."""
    clear = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
    clear = clear.agg(F.min(label_col).alias("low"), F.max(label_col).alias("high")).where("low = high").select("_id", F.col("low").alias("label"))
    return clear.withColumn("part", remainder(F.col("_id"))).where("part > 0").withColumn("h", F.xxhash64("_id"))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """_id, label, part, at, piece: of each class the ``DOCUMENTS`` ids first in hash order, of each id ``PER_DOCUMENT`` pieces.

    Whole texts are cut into pieces and those first in hash order are taken, so they are spread over the text, and a
    huge one counts as much as others.
    """
    clear = _clear(labels, id_col, label_col)
    chosen = [clear.where(F.col("label") == k).orderBy("h", "_id").limit(DOCUMENTS) for k in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * DOCUMENTS rows at most
    cut = F.expr(f"regexp_extract_all(_text, '(?s).{{1,{PIECE}}}', 0)")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(ids, "_id").where("_text != ''")
    pieces = texts.select("_id", "label", "part", F.posexplode(cut).alias("at", "piece"))
    place = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64("at", "piece"), "at", "piece"))
    return pieces.withColumn("_place", place).where(F.col("_place") <= PER_DOCUMENT).drop("_place")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on a bounded sample of the labelled rows whose remainder is not 0; see :func:`sample`.

    Of remainders 1 to 3 the ``PIECES`` pieces first in hash order build the class's dictionary; all documents taken of
    remainder 4 calibrate, each by its pieces. That is all that reaches the driver. With a class missing, or
    too little text for a dictionary, the model scores its prior, the share of label 1 (0.5 without labels).
    """
    clear = _clear(labels, id_col, label_col)
    pieces = stored(sample(docs, labels, id_col, text_col, label_col), "quality-pieces")
    built_of = {k: pieces.where("part < 4").where(F.col("label") == k).orderBy(F.xxhash64("piece"), "piece").limit(PIECES).collect() for k in (0, 1)}
    held_of = pieces.where("part = 4").orderBy("label", "_id", "at", "piece").collect()  # 2 * DOCUMENTS * PER_DOCUMENT rows at most
    share = clear.agg(F.avg("label")).first()[0]
    prior = 0.5 if share is None else float(share)
    built = {}
    for k in (0, 1):
        samples = [r["piece"].encode() for r in built_of[k]]
        try:
            built[k] = zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
        except (zstandard.ZstdError, ValueError):
            return Model(prior=prior)
    whole: dict[tuple, str] = {}
    for r in held_of:
        whole[r["label"], r["_id"]] = whole.get((r["label"], r["_id"]), "") + r["piece"]
    held = [(difference(text, built[1], built[0]), k) for (k, _), text in whole.items()]
    if {label for _, label in held} != {0, 1}:
        return Model(prior=prior)
    slope, offset = calibrate(np.array([d for d, _ in held]), np.array([y for _, y in held]), prior)
    return Model(built[1], built[0], slope, offset, prior)


def calibrate(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Logistic line by Newton steps with a small ridge, classes weighted to the prior."""
    scale = float(np.std(x)) or 1.0
    design = np.stack([x / scale, np.ones(len(x))], axis=1)
    prior = min(max(prior, 0.01), 0.99)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    # targets short of 0 and 1 keep the line finite where the classes can be told apart
    goal = np.where(y == 1, 1 - 1 / (len(y) + 2), 1 / (len(y) + 2))
    line = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ line, -30, 30)))
        gradient = design.T @ (weight * (goal - p)) - 1e-3 * line
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        line += step
        if np.abs(step).max() < 1e-9:
            break
    return float(line[0] / scale), float(line[1])


def score(model: Model, text: Column) -> Column:
    """The score of every whole text, between 0 and 1; a null or empty text gets the calibrated score of difference 0."""

    def of(texts: pa.Array) -> pa.Array:
        batch = pa.record_batch([texts], names=["text"])
        return pa.array([score_of(model, t) for part in slices(batch) for t in part.column("text").to_pylist()], pa.float64())

    return F.arrow_udf(of, "double")(F.coalesce(text, F.lit("")))


def quality_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; other columns are not read, an empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), (remainder(F.col(id_col)) == 0).alias("held_out"), score(model, F.col(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
