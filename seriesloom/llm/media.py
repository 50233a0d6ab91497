"""Image columns: Netpbm and BMP to numpy and back, area resizing by integral images, NPY tiles, difference hashes."""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, slices, stored

#: Bytes of a payload's unit and of an image row: 24 pixels of 3 samples.
UNIT, ROW = 576, 72
#: Rows of samples that are summed at a time.
STRIP = 8192
#: Width and height of the picture that is cut into tiles, and of a tile.
THUMB, TILE = 32, 16
_FIELD = re.compile(rb"(?:[ \t\r\n\x0b\x0c]|#[^\r\n]*)*([^ \t\r\n\x0b\x0c#]+)")


class Unreadable(ValueError):
    """Bytes that are no image of the supported formats."""


def encode_pnm(image: np.ndarray) -> bytes:
    """Height x width (grey) or height x width x 3 samples of 8 bits as binary PGM or PPM."""
    kind = b"P5" if image.ndim == 2 else b"P6"
    return b"%s\n%d %d\n255\n" % (kind, image.shape[1], image.shape[0]) + np.ascontiguousarray(image, np.uint8).tobytes()


def decode_pnm(data: bytes) -> np.ndarray:
    """P1 to P6, samples scaled to 8 bits: grey pictures have two dimensions, coloured ones three."""
    at, fields = 2, []
    kind = data[:2]
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        found = _FIELD.match(data, at)
        if not found or not found[1].isdigit():
            raise Unreadable("bad Netpbm header")
        fields.append(int(found[1]))
        at = found.end()
    width, height, most = *fields[:2], fields[2] if len(fields) == 3 else 1
    bands = 3 if kind in (b"P3", b"P6") else 1
    if not 0 < most < 65536:
        raise Unreadable("bad maximum")
    count = width * height * bands
    if kind == b"P4":
        stride = -(-width // 8)
        bits = np.frombuffer(_exactly(data, at + 1, stride * height), np.uint8).reshape(height, stride)
        samples = 1 - np.unpackbits(bits, axis=1)[:, :width]
    elif kind in (b"P5", b"P6"):
        wide = most > 255
        samples = np.frombuffer(_exactly(data, at + 1, count * (1 + wide)), ">u2" if wide else np.uint8)
    else:
        text = re.sub(rb"#[^\r\n]*", b" ", data[at:])
        items = [b"%c" % c for c in re.sub(rb"\s", b"", text)] if kind == b"P1" else text.split()
        if len(items) < count:
            raise Unreadable("too few samples")
        samples = np.array(items[:count], dtype=np.int64)
        samples = 1 - samples if kind == b"P1" else samples
    if most != 255:
        samples = (np.asarray(samples, np.int64) * 255 + most // 2) // most
    return np.asarray(samples, np.uint8).reshape((height, width, 3) if bands == 3 else (height, width))


def encode_bmp(image: np.ndarray) -> bytes:
    """Samples of 8 bits as an uncompressed BMP: grey with a palette, colour as 24 bits."""
    height, width = image.shape[:2]
    grey = image.ndim == 2
    stride = -(-width * (1 if grey else 3) // 4) * 4
    rows = np.zeros((height, stride), np.uint8)
    rows[:, : width * (1 if grey else 3)] = (image if grey else image[:, :, ::-1]).reshape(height, -1)
    palette = np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4).copy() if grey else np.zeros((0, 4), np.uint8)
    palette[:, 3:] = 0
    offset = 54 + palette.size
    head = struct.pack("<2sIHHI", b"BM", offset + rows.size, 0, 0, offset)
    info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8 if grey else 24, 0, rows.size, 2835, 2835, len(palette), 0)
    return head + info + palette.tobytes() + rows[::-1].tobytes()


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits, bottom-up or top-down; a grey palette gives two dimensions."""
    if len(data) < 54:
        raise Unreadable("short BMP header")
    offset, size, width, height, _, bits, packing = struct.unpack_from("<IIiiHHI", data, 10)
    used = struct.unpack_from("<I", data, 46)[0]
    down, height = height < 0, abs(height)
    if size < 40 or width <= 0 or packing or bits not in (1, 4, 8, 24, 32):
        raise Unreadable("unsupported BMP")
    stride = -(-width * bits // 32) * 4
    rows = np.frombuffer(_exactly(data, offset, stride * height), np.uint8).reshape(height, stride)
    rows = rows if down else rows[::-1]
    if bits >= 24:
        return np.ascontiguousarray(rows[:, : width * bits // 8].reshape(height, width, bits // 8)[:, :, 2::-1])
    if bits == 8:
        index = rows[:, :width]
    elif bits == 4:
        index = np.stack([rows >> 4, rows & 15], axis=2).reshape(height, -1)[:, :width]
    else:
        index = np.unpackbits(rows, axis=1)[:, :width]
    colours = used or 1 << bits
    palette = np.frombuffer(_exactly(data, 14 + size, colours * 4), np.uint8).reshape(-1, 4)[:, 2::-1]
    if index.size and index.max() >= colours:
        raise Unreadable("colour out of the palette")
    image = palette[index]
    return np.ascontiguousarray(image[:, :, 0]) if (palette == palette[:, :1]).all() else image


def _exactly(data: bytes, at: int, count: int) -> memoryview:
    if len(data) < at + count:
        raise Unreadable("too few samples")
    return memoryview(data)[at : at + count]


def decode(data: bytes) -> np.ndarray:
    """The picture in Netpbm or BMP bytes; :class:`Unreadable` for anything else."""
    if data[:2] == b"BM":
        return decode_bmp(data)
    if data[:1] == b"P" and data[1:2] in b"123456" and len(data) > 2:
        return decode_pnm(data)
    raise Unreadable("neither Netpbm nor BMP")


def _edge_sums(values: np.ndarray, parts: int) -> np.ndarray:
    """Integral of ``values`` along axis 0 at the ``parts + 1`` edges of equal parts, between rows by interpolation."""
    rows = len(values)
    edges = np.arange(parts + 1) * (rows / parts)
    whole = np.minimum(edges.astype(np.int64), rows)
    share = edges - whole
    out = np.empty((parts + 1, *values.shape[1:]))
    carried, at = np.zeros(values.shape[1:]), 0
    for begin in range(0, rows, STRIP):
        strip = values[begin : begin + STRIP]
        sums = np.cumsum(strip, axis=0, dtype=np.float64) + carried
        while at <= parts and whole[at] < begin + len(strip):
            row = whole[at] - begin
            out[at] = (sums[row - 1] if row else carried) + share[at] * strip[row]
            at += 1
        carried = sums[-1]
    out[at:] = carried
    return out


def resize_area(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over each of height x width equal areas, edges taken by the share they cover.

    The means are differences of the picture's integral image, of which only the rows and columns at the edges are
    kept; a tall picture is summed in strips.
    """
    rows = np.diff(_edge_sums(image, height), axis=0)
    cells = np.diff(_edge_sums(rows.swapaxes(0, 1), width), axis=0).swapaxes(0, 1)
    return cells * (height * width / (image.shape[0] * image.shape[1]))


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image @ np.array([0.299, 0.587, 0.114])


def difference_hash(image: np.ndarray) -> str:
    """64 bits in hex: whether each of 8 x 9 area means is below its right neighbour."""
    cells = np.round(grey(resize_area(image, 8, 9)), 6)
    return np.packbits(cells[:, :-1] < cells[:, 1:]).tobytes().hex()


def npy(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(tile), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def tiles(image: np.ndarray, thumb: int = THUMB, tile: int = TILE) -> list[tuple[int, int, bytes]]:
    """The picture area-resized to ``thumb`` squared and cut: row, column and NPY bytes of each tile."""
    small = np.clip(np.rint(resize_area(image, thumb, thumb)), 0, 255).astype(np.uint8)
    return [(y // tile, x // tile, npy(small[y : y + tile, x : x + tile])) for y in range(0, thumb, tile) for x in range(0, thumb, tile)]


def payload(text: bytes) -> bytes:
    """The text with bytes 255 up to a positive multiple of the unit."""
    return text + b"\xff" * (UNIT * max(1, -(-len(text) // UNIT)) - len(text))


#: How a picture is stored, by the name of its format.
ENCODERS = {"pnm": encode_pnm, "bmp": encode_bmp}


def _storing(formats: tuple[str, ...]):
    encoders = [ENCODERS[name] for name in formats]

    def store(texts: list[bytes]) -> dict[str, list]:
        media = [
            encoders[zlib.crc32(t) % len(encoders)](np.frombuffer(payload(t), np.uint8).reshape(-1, ROW // 3, 3)) for t in texts
        ]
        return {"n_bytes": [len(t) for t in texts], "media": media}

    return store


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", formats: tuple[str, ...] = ("pnm",)) -> DataFrame:
    """doc_id, n_bytes, media: every whole text as a picture of 24 pixels a row, one 8-bit sample a byte.

    Of several ``formats`` (``pnm``, ``bmp``) the checksum of the text chooses one. A null or empty text gives a
    picture of 255s. Equal texts give equal media; there is one row per row.
    """
    return map_texts(docs, "n_bytes long, media binary", _storing(formats), id_col, text_col, raw=True)


_FEATURES = {
    "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(),
    "media_sha256": pa.string(), "feature": pa.string(),
    "tiles": pa.list_(pa.struct([("row", pa.int32()), ("col", pa.int32()), ("content", pa.binary())])), "error": pa.string(),
}
_FEATURES_DDL = (
    "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, "
    "tiles array<struct<row: int, col: int, content: binary>>, error string"
)


def features(media: DataFrame, column: str = "media", tail: int = UNIT) -> DataFrame:
    """All columns but the picture's bytes, and what is read back from them.

    payload_bytes, payload_sha256, tail_crc32 (of the samples and the last ``tail`` of them), media_bytes, media_sha256,
    feature (difference hash), tiles (row, column and NPY bytes), error. Bytes that hold no readable picture, nulls and
    pictures without pixels give nulls and a message in ``error``.
    """
    rest = [f for f in media.schema.fields if f.name != column]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), _FEATURES_DDL])
    names = [f.name for f in rest]

    def run(batches):
        for batch in batches:
            for part in slices(batch, column):
                found = [_read(data, tail) for data in part.column(column).to_pylist()]
                made = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(_FEATURES.values())]
                yield pa.record_batch([*(part.column(n) for n in names), *made], names=[*names, *_FEATURES])

    return media.select(*names, column).mapInArrow(run, schema)


def _read(data: bytes | None, tail: int = UNIT) -> tuple:
    if data is None:
        return (None,) * 7 + ("null",)
    size = len(data), hashlib.sha256(data).hexdigest()
    try:
        image = decode(data)
        if not image.size:
            raise Unreadable("no pixels")
    except Unreadable as e:
        return None, None, None, *size, None, None, str(e)
    samples = memoryview(image.reshape(-1))
    cut = [{"row": y, "col": x, "content": content} for y, x, content in tiles(image)]
    return len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-tail:]), *size, difference_hash(image), cut, None


def written_features(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", formats: tuple[str, ...] = ("pnm", "bmp"), keep_media: bool = False,
    tail: int = UNIT,
) -> DataFrame:
    """Texts as pictures, their features and NPY tiles written to the shared folder, and what is read back.

    doc_id, n_bytes and the columns of ``features``, which takes ``tail``. With ``keep_media`` the pictures are a table of their own first and
    the features are made of the table; otherwise the bytes go from the step that makes them to the one that decodes
    them. A lost executor repeats its own tasks only.
    """
    media = store_texts(docs, id_col, text_col, formats)
    media = stored(media, "media", compression="zstd") if keep_media else media
    return stored(features(media, tail=tail), "tiles", compression="zstd")


def tiles_digest(tiles: Column) -> Column:
    """SHA-256 of the contents of an array of tiles, one after the other; null for null."""
    return F.sha2(F.aggregate(tiles, F.lit(b""), lambda all_, tile: F.concat(all_, tile["content"])), 256)


def tile_rows(media: DataFrame, id_col: str = "doc_id", column: str = "media", thumb: int = THUMB, tile: int = TILE) -> DataFrame:
    """id, path, content: the NPY tiles of every readable picture, named id/row-column.npy; others give no rows."""
    rows = media.select(F.col(id_col).alias("doc_id"), F.col(column).alias("media"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "media"):
                ids, paths, contents = [], [], []
                for n, (doc, data) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("media").to_pylist(), strict=True)):
                    try:
                        image = decode(data or b"")
                    except Unreadable:
                        continue
                    for y, x, content in tiles(image, thumb, tile) if image.size else ():
                        ids.append(n)
                        paths.append(f"{doc}/{y}-{x}.npy")
                        contents.append(content)
                yield pa.record_batch([part.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["doc_id", "path", "content"])

    return rows.mapInArrow(run, f"doc_id {kind}, path string, content binary")


def write_tiles(media: DataFrame, folder: str, **options) -> None:
    """Write the tiles as Parquet of path and NPY bytes."""
    tile_rows(media, **options).write.parquet(folder)
