"""Exact duplicates by composable polynomial fingerprints, confirmed by a chunkwise comparison."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, map_texts, slices, stored

PRIME = (1 << 31) - 1
BASES = np.array([1_186_537_133, 798_561_901, 1_675_311_497, 434_891_219], dtype=np.uint64)
#: Bytes of a chunk: 2^8 (a byte) * 2^31 (a power) * 2^11 stays exact in a double.
CHUNK = 2048
#: Chunks hashed by one matrix product.
ROWS = 2048
#: Bytes of the pieces that are compared.
PIECE = 64 << 10
WHITE_BYTES = b" \t\n\x0b\x0c\r"


def powers(bases: np.ndarray, exponents: np.ndarray) -> np.ndarray:
    """``bases ** exponents`` modulo the prime, one row per exponent."""
    out = np.ones((len(exponents), len(bases)), np.uint64)
    square, left = np.broadcast_to(bases, out.shape).copy(), exponents.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square[odd] % PRIME
        square, left = square * square % PRIME, left >> np.uint64(1)
    return out


_WEIGHTS = powers(BASES, np.arange(CHUNK - 1, -1, -1)).astype(np.float64)
_SHIFT = powers(BASES, np.array([CHUNK]))[0]


def combine(left: np.ndarray, right: np.ndarray, right_bytes: int) -> np.ndarray:
    """Fingerprint of two texts in a row from theirs: the left one is shifted by the length of the right one."""
    return (left * powers(BASES, np.array([right_bytes]))[0] + right) % PRIME


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Polynomial values of texts, one row of residues per text.

    Every text is cut into chunks of one size, the first one padded with zero bytes on its left, which leaves
    the polynomial as it is. The chunks of all texts are hashed by matrix products, and the hashes of a text
    combined by powers of the chunk's shift. Memory is one product's chunks, whatever the texts' lengths.
    """
    counts = np.array([-(-len(t) // CHUNK) for t in texts], dtype=np.int64)
    hashes, held = [], np.zeros((ROWS, CHUNK), np.uint8)
    row = 0
    for text in texts:
        flat, head = np.frombuffer(text, np.uint8), len(text) % CHUNK
        if head:
            held[row, :CHUNK - head], held[row, CHUNK - head:] = 0, flat[:head]
            row += 1
        at = head
        while True:
            if row == ROWS:
                hashes.append(_hash(held))
                row = 0
            take = min(ROWS - row, (len(flat) - at) // CHUNK)
            if not take:
                break
            held[row:row + take] = flat[at:at + take * CHUNK].reshape(take, CHUNK)
            row, at = row + take, at + take * CHUNK
    hashes.append(_hash(held[:row]))
    flat = np.concatenate(hashes)
    out = np.zeros((len(texts), len(BASES)), np.uint64)
    if len(flat):
        some = np.flatnonzero(counts)
        starts = np.cumsum(counts)[some] - counts[some]
        behind = np.repeat(np.cumsum(counts)[some] - 1, counts[some]) - np.arange(len(flat))
        many = behind > 0
        flat[many] = flat[many] * powers(_SHIFT, behind[many]) % PRIME
        out[some] = np.add.reduceat(flat, starts, axis=0) % PRIME
    return out


def _hash(chunks: np.ndarray) -> np.ndarray:
    return (chunks.astype(np.float64) @ _WEIGHTS).astype(np.uint64) % PRIME


def _keys(texts: list[bytes]) -> list[str]:
    """Length and fingerprint as text."""
    return [f"{len(t):x}-{p.astype('>u4').tobytes().hex()}" for t, p in zip(texts, fingerprints(texts), strict=True)]


def _describe(keys: Callable, texts: list[bytes]) -> dict[str, list]:
    kept = [t.translate(None, WHITE_BYTES) for t in texts]
    chars = [len(t) - np.count_nonzero(np.frombuffer(t, np.uint8) & 0xC0 == 0x80) for t in texts]
    return {"fingerprint": keys(kept), "text_sha256": [hashlib.sha256(t).hexdigest() for t in kept], "n_points": chars}


def mismatches(docs: DataFrame, keys: DataFrame, text_col: str = "text", keys_of: Callable = _keys) -> DataFrame:
    """Keys whose texts differ somewhere though length and fingerprint agree.

    Only texts whose key may be in ``keys`` travel, cut into pieces: the executors test a bitmap of 2^20 hash
    buckets, a bound of its own. Pieces of one key and place are compared by a partially aggregated minimum and
    maximum, a stream of pieces on every task, so the size of a group or of a text doesn't matter.
    """
    buckets = 1 << 20
    marked = np.zeros(buckets, bool)
    found = keys.select(F.pmod(F.crc32("fingerprint"), F.lit(buckets)).cast("int").alias("b")).distinct().toPandas()
    marked[found["b"].to_numpy(dtype=np.int64)] = True
    bits = np.packbits(marked)
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        import zlib

        import pyarrow as pa

        wanted = np.unpackbits(bits).astype(bool)
        schema = pa.schema([("fingerprint", pa.string()), ("place", pa.int64()), ("piece", pa.binary())])
        for batch in batches:
            for part in slices(batch):
                kept = [t.translate(None, WHITE_BYTES) for t in part.column("text").to_pylist()]
                names = keys_of(kept)
                out = [(n, at, t[at:at + PIECE]) for n, t in zip(names, kept, strict=True) if wanted[zlib.crc32(n.encode()) % buckets] for at in range(0, len(t), PIECE)]
                yield pa.record_batch([pa.array([x[i] for x in out], of.type) for i, of in enumerate(schema)], schema=schema)

    pieces = rows.mapInArrow(run, "fingerprint string, place long, piece binary").join(keys.select("fingerprint"), "fingerprint", "left_semi")
    ends = pieces.groupBy("fingerprint", "place").agg(F.min("piece").alias("low"), F.max("piece").alias("high"))
    return ends.where("low != high").select("fingerprint").distinct()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys_of: Callable = _keys) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; a null text is the empty one, and all such rows are one
    group. Of a group the row with the most code points stays, then the smallest id (a null id comes last); of
    rows that agree in text and id too, one stays. Groups come from length and fingerprint; where the comparison
    finds a difference, the group is divided by the digest of its texts. An empty table gives no rows; other
    columns are not read. ``keys_of`` gives texts their fingerprints as strings.
    """
    describe = functools.partial(_describe, keys_of)
    rows = stored(map_texts(docs, "fingerprint string, text_sha256 string, n_points long", describe, id_col, text_col, raw=True), "exact-rows")
    several = stored(rows.groupBy("fingerprint").count().where("count > 1"), "exact-groups")
    clash = stored(mismatches(docs, several, text_col, keys_of), "exact-clash")
    part = F.when(F.col("clash"), F.col("text_sha256")).otherwise("")
    # clashes are written first: Spark then knows their size, which is next to nothing, and rows stay where they are; should
    # there be many, the join can split a large group, as the grouping has an exchange of its own
    same = stored(rows.join(clash.withColumn("clash", F.lit(True)), "fingerprint", "left").withColumn("part", part), "exact-same")
    same = stored(same.groupBy("fingerprint", "part", "text_sha256", "n_points", "doc_id").agg(F.count("*").alias("n")), "exact-parts")
    order = F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    best = same.groupBy("fingerprint", "part").agg(F.min(order).alias("best"), F.sum("n").alias("group_size"))
    best = best.select("fingerprint", "part", F.col("best.id").alias("keep_id"), F.col("best.n").alias("keep_n"), "group_size")
    joined = join_groups(same, best, ["fingerprint", "part"], "exact-best")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == -F.col("keep_n"))
    each = F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: stays & (i == 1))
    return joined.select("doc_id", "keep_id", "group_size", F.explode(each).alias("kept"), "text_sha256")
