"""Encoding of the fixed series record inside Avro object containers (public Avro specification).

Helper of the ``series_avro`` data source: whole arrays are encoded and decoded with vector
operations; only text is handled item by item.
"""

from __future__ import annotations

import io
import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The record layout that readers of these files expect.
SCHEMA = {
    "type": "record",
    "name": "AvroStream",
    "fields": [
        {"name": "channel", "type": "string"},
        {"name": "timestamps", "type": {"type": "array", "items": "long"}},
        {
            "name": "values",
            "type": {
                "type": "array",
                "items": [
                    "double",
                    "string",
                    "long",
                    {"type": "record", "name": "DoubleArray",
                     "fields": [{"name": "items", "type": {"type": "array", "items": "double"}}]},
                    {"type": "record", "name": "StringArray",
                     "fields": [{"name": "items", "type": {"type": "array", "items": "string"}}]},
                    {"type": "record", "name": "JsonStruct", "fields": [{"name": "json", "type": "string"}]},
                ],
            },
        },
        {"name": "tags", "type": {"type": "map", "values": "string"}, "default": {}},
    ],
}
MAGIC = b"Obj\x01"
FIELDS = [f["name"] for f in SCHEMA["fields"]]

DOUBLE = np.dtype([("tag", "u1"), ("v", "<f8")])
_SHIFTS = np.arange(10, dtype=np.uint64) * np.uint64(7)


# -- encoding ------------------------------------------------------------------------------


def longs(values) -> bytes:
    """Zigzag variable-length integers, all at once."""
    v = np.asarray(values, dtype=np.int64)
    z = ((v << 1) ^ (v >> 63)).view(np.uint64)
    size = np.ones(len(z), dtype=np.int64)
    for shift in _SHIFTS[1:]:
        size += (z >> shift) > 0
    width = int(size.max()) if len(size) else 0
    groups = ((z[:, None] >> _SHIFTS[:width]) & np.uint64(0x7F)).astype(np.uint8)
    at = np.arange(width)
    groups |= np.where(at < (size - 1)[:, None], 0x80, 0).astype(np.uint8)
    return groups[at < size[:, None]].tobytes()


def long(value: int) -> bytes:
    return _unsigned((value << 1) ^ (value >> 63))


def text(value: str) -> bytes:
    raw = value.encode()
    return long(len(raw)) + raw


def array(count: int, body: bytes) -> bytes:
    return long(count) + body + b"\x00" if count else b"\x00"


def sized_array(count: int, body: bytes) -> bytes:
    """An array as one chunk that tells its length in bytes, so that readers may skip it."""
    return long(-count) + long(len(body)) + body + b"\x00" if count else b"\x00"


def _texts(items: pa.Array, tag: bytes = b"") -> bytes:
    """Each text behind ``tag`` and its length; heads are made once per length."""
    raw = items.cast(pa.binary()).to_pylist()
    heads: dict[int, bytes] = {}
    for n in set(map(len, raw)):
        heads[n] = tag + long(n)
    pieces = [b""] * (2 * len(raw))
    pieces[0::2] = [heads[len(r)] for r in raw]
    pieces[1::2] = raw
    return b"".join(pieces)


def _double_items(values) -> bytes:
    v = np.asarray(values, dtype="<f8")
    return array(len(v), v.tobytes())


def values(kind: str, items: pa.Array) -> bytes:
    """The body of ``values``: each item is its branch number and its content. Nulls have no branch."""
    if items.null_count:
        raise ValueError(f"a series of {kind} holds null values")
    if kind == "double":
        out = np.zeros(len(items), dtype=DOUBLE)
        out["v"] = items.to_numpy(zero_copy_only=False)
        return out.tobytes()
    if kind == "int":
        pairs = np.empty(2 * len(items), dtype=np.int64)
        pairs[0::2] = 2
        pairs[1::2] = items.to_numpy(zero_copy_only=False)
        return longs(pairs)
    if kind in ("string", "struct"):
        return _texts(items, long(1 if kind == "string" else 5))
    tag = long(3 if kind == "double_array" else 4)
    lists = (items[i].values for i in range(len(items)))
    if kind == "double_array":
        return b"".join(tag + _double_items(v) for v in lists)
    return b"".join(tag + array(len(v), _texts(v)) for v in lists)


#: Bytes of items that are encoded at a time; each such part of an array is a chunk of its own.
PART_BYTES = 1 << 22
#: Raw bytes that are packed at a time: a multiple of the 64 KB that Snappy packs independently.
PACK_BYTES = 1 << 20


def _ends(items: pa.Array) -> np.ndarray:
    """Bytes of the items up to each one, its own included, about."""
    kind = items.type
    if pa.types.is_list(kind):
        lengths = pc.list_value_length(items).to_numpy(zero_copy_only=False)
        inner = np.concatenate(([0], _ends(items.flatten())))
        return inner[np.cumsum(lengths)] + 8 * np.arange(1, len(items) + 1)
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return np.cumsum(pc.binary_length(items).to_numpy(zero_copy_only=False).astype(np.int64) + 8)
    return 9 * np.arange(1, len(items) + 1)


def _parts(kind: str, items: pa.Array) -> Iterator[pa.Array]:
    """Consecutive parts of about ``PART_BYTES``, one item at least."""
    if items.null_count:
        raise ValueError(f"a series of {kind} holds null values")
    ends, at, before = _ends(items), 0, 0
    while at < len(items):
        stop = max(at + 1, int(np.searchsorted(ends, before + PART_BYTES, side="right")))
        yield items.slice(at, stop - at)
        at, before = stop, int(ends[stop - 1])


def pieces(channel: str, tags: list[tuple[str, str]], stamps, kind: str, items: pa.Array | None) -> Iterator[bytes]:
    """The bytes of a record in pieces: a long series is never encoded whole."""
    yield text(channel)
    step = PART_BYTES // 8
    for at in range(0, len(stamps), step):
        part = stamps[at : at + step]
        yield sized_array(len(part), longs(part))[:-1]  # without the end mark, as chunks follow
    yield b"\x00"
    for part in _parts(kind, items) if items is not None and len(items) else ():
        yield sized_array(len(part), values(kind, part))[:-1]
    yield b"\x00"
    yield array(len(tags), b"".join(text(k) + text(v) for k, v in tags))


def record(channel: str, tags: list[tuple[str, str]], stamps, kind: str, items: pa.Array | None) -> bytes:
    return b"".join(pieces(channel, tags, stamps, kind, items))


def header(sync: bytes, metadata: dict[str, str]) -> bytes:
    meta = {"avro.schema": json.dumps(SCHEMA), "avro.codec": "snappy", **metadata}
    return MAGIC + array(len(meta), b"".join(text(k) + text(v) for k, v in meta.items())) + sync


class Block:
    """A block under way: what is added is packed a megabyte at a time, so only packed bytes are held.

    Snappy's format is the raw length and then the packed parts, which it packs independently.
    """

    def __init__(self):
        self.records = self.size = self.checksum = 0
        self.waiting, self.packed = bytearray(), []

    def add(self, pieces: Iterable[bytes]) -> None:
        for piece in pieces:
            self.size += len(piece)
            self.waiting += piece
            if len(self.waiting) >= PACK_BYTES:
                whole = len(self.waiting) // PACK_BYTES * PACK_BYTES
                for at in range(0, whole, PACK_BYTES):
                    self._pack(bytes(self.waiting[at : at + PACK_BYTES]))
                del self.waiting[:whole]
        self.records += 1

    def _pack(self, raw: bytes) -> None:
        self.checksum = zlib.crc32(raw, self.checksum)
        packed = pa.Codec("snappy").compress(raw, asbytes=True)
        self.packed.append(packed[len(_unsigned(len(raw))) :])

    def write(self, file, sync: bytes) -> None:
        if self.waiting:
            self._pack(bytes(self.waiting))
        parts = [_unsigned(self.size), *self.packed, self.checksum.to_bytes(4, "big")]
        file.write(long(self.records) + long(sum(map(len, parts))))
        for part in parts:
            file.write(part)
        file.write(sync)


def _unsigned(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def block(records: list[bytes], sync: bytes) -> bytes:
    made, out = Block(), io.BytesIO()
    for each in records:
        made.add([each])
    made.write(out, sync)
    return out.getvalue()


# -- decoding ------------------------------------------------------------------------------


class Cursor:
    """Reads the primitive types from decoded bytes."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.bytes = np.frombuffer(raw, dtype=np.uint8)
        self.at = 0

    def long(self) -> int:
        z = shift = 0
        while True:
            b = self.raw[self.at]
            self.at += 1
            z |= (b & 0x7F) << shift
            if b < 0x80:
                return (z >> 1) ^ -(z & 1)
            shift += 7

    def take(self, n: int) -> bytes:
        out = self.raw[self.at : self.at + n]
        if n < 0 or len(out) != n:
            raise ValueError("container data ends early")
        self.at += n
        return out

    def text(self) -> str:
        return self.take(self.long()).decode()

    def counts(self):
        """Item counts of the chunks of an array or map."""
        while (count := self.long()) != 0:
            if count < 0:
                self.long()
                count = -count
            yield count

    def skip_array(self, item) -> int:
        """Pass over an array and return its item count; ``item`` reads one where the length is not told."""
        total = 0
        while (count := self.long()) != 0:
            if count < 0:
                size, count = self.long(), -count
                if size < 0 or self.at + size > len(self.raw):
                    raise ValueError("container data ends early")
                self.at += size
            else:
                for _ in range(count):
                    item(self)
            total += count
        return total

    def tagged_texts(self, count: int, tag: int) -> list[bytes] | None:
        """``count`` texts behind the same branch byte, or nothing if another branch comes between."""
        raw, at, out = self.raw, self.at, []
        try:
            for _ in range(count):
                if raw[at] != tag:
                    return None
                b = raw[at + 1]
                at += 2
                z, shift = b & 0x7F, 7
                while b >= 0x80:
                    b = raw[at]
                    at += 1
                    z |= (b & 0x7F) << shift
                    shift += 7
                n = z >> 1
                out.append(raw[at : at + n])
                at += n
        except IndexError:
            raise ValueError("container data ends early") from None
        if at > len(raw):
            raise ValueError("container data ends early")
        self.at = at
        return out

    def peek_longs(self, count: int) -> tuple[np.ndarray, int]:
        window = self.bytes[self.at : self.at + 10 * count]
        ends = np.flatnonzero(window < 0x80)[:count]
        if len(ends) < count:
            raise ValueError("container data ends early")
        starts = np.concatenate(([0], ends[:-1] + 1))
        body = window[: ends[-1] + 1]
        place = np.arange(len(body)) - np.repeat(starts, ends - starts + 1)
        parts = (body & 0x7F).astype(np.uint64) << (place.astype(np.uint64) * np.uint64(7))
        z = np.add.reduceat(parts, starts)
        return (z >> np.uint64(1)).view(np.int64) ^ -(z & np.uint64(1)).view(np.int64), len(body)

    def longs(self) -> np.ndarray:
        out = []
        for count in self.counts():
            found, used = self.peek_longs(count)
            self.at += used
            out.append(found)
        return np.concatenate(out) if out else np.empty(0, dtype=np.int64)

    def doubles(self) -> list[float]:
        out: list[float] = []
        for count in self.counts():
            out += np.frombuffer(self.take(8 * count), dtype="<f8").tolist()
        return out

    def texts(self) -> list[str]:
        return [self.text() for count in self.counts() for _ in range(count)]


_READ = {
    0: ("d", lambda c: float(np.frombuffer(c.take(8), "<f8")[0])),
    1: ("s", Cursor.text),
    2: ("l", Cursor.long),
    3: ("da", Cursor.doubles),
    4: ("sa", Cursor.texts),
    5: ("json", Cursor.text),
}


def _union_array(value_type: pa.StructType, count: int, tags, found: dict) -> pa.StructArray:
    columns = []
    for field in value_type:
        if field.name == "tag":
            columns.append(pa.array(tags, field.type))
        elif field.name in found:
            given = found[field.name]
            columns.append(given.cast(field.type) if isinstance(given, pa.Array) else pa.array(given, field.type))
        else:
            columns.append(pa.nulls(count, field.type))
    return pa.StructArray.from_arrays(columns, fields=list(value_type))


def read_values(cursor: Cursor, value_type: pa.StructType) -> list[pa.StructArray]:
    """The ``values`` array as union structs; runs of doubles or longs are read at once."""
    out = []
    for count in cursor.counts():
        run = cursor.bytes[cursor.at : cursor.at + 9 * count]
        if len(run) == 9 * count and not run[::9].any():
            found = {"d": run.view(DOUBLE)["v"].astype("f8")}
            out.append(_union_array(value_type, count, np.zeros(count, dtype=np.int32), found))
            cursor.at += 9 * count
            continue
        if cursor.raw[cursor.at] == 4:  # branch 2
            try:
                pairs, used = cursor.peek_longs(2 * count)
            except ValueError:
                pairs = np.ones(1)
            if (pairs[0::2] == 2).all():
                out.append(_union_array(value_type, count, np.full(count, 2, dtype=np.int32), {"l": pairs[1::2]}))
                cursor.at += used
                continue
        if cursor.raw[cursor.at] in (2, 10):  # branches 1 and 5
            tag = cursor.raw[cursor.at]
            if (texts := cursor.tagged_texts(count, tag)) is not None:
                name, found = _READ[tag >> 1][0], pa.array(texts, pa.binary()).cast(pa.string())
                out.append(_union_array(value_type, count, np.full(count, tag >> 1, dtype=np.int32), {name: found}))
                continue
        tags, items = [], {name: [None] * count for name, _ in _READ.values()}
        for i in range(count):
            tag = cursor.long()
            name, read = _READ[tag]
            tags.append(tag)
            items[name][i] = read(cursor)
        out.append(_union_array(value_type, count, tags, items))
    return out


def _read_value(cursor: Cursor):
    return _READ[cursor.long()][1](cursor)


def read_record(cursor: Cursor, value_type: pa.StructType, keep=None, counts_only: bool = False):
    """Channel, stamps, values and tags of the next record, or None if ``keep`` refuses its channel.

    The channel is tested first, and what is not wanted is passed over: in files written here by
    one step, in other files item by item. ``counts_only`` gives the number of stamps in their place
    and no values.
    """
    channel = cursor.text()
    wanted = keep is None or keep(channel)
    if wanted and not counts_only:
        stamps = cursor.longs()
        items = read_values(cursor, value_type)
    else:
        stamps, items = cursor.skip_array(Cursor.long), None
        cursor.skip_array(_read_value)
    tags = [(cursor.text(), cursor.text()) for count in cursor.counts() for _ in range(count)]
    return (channel, stamps, items, tags) if wanted else None


class Container:
    """Sequential access to the blocks of an open container file, from any split of it."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        file.seek(0)
        head = file.read(min(size, 1 << 16))
        while True:
            cursor = Cursor(head)
            try:
                if cursor.take(4) != MAGIC:
                    raise SyntaxError("not an Avro container")
                self.metadata = {
                    cursor.text(): cursor.take(cursor.long())
                    for count in cursor.counts() for _ in range(count)
                }
                self.sync = cursor.take(16)
                break
            except (IndexError, ValueError):
                if len(head) == size:
                    raise ValueError("container header ends early") from None
                head += file.read(min(size - len(head), 1 << 20))
        self.body = cursor.at
        names = [f["name"] for f in json.loads(self.metadata["avro.schema"])["fields"]]
        if names != FIELDS:
            raise ValueError(f"container holds records of {names}, not series")
        self.codec = self.metadata.get("avro.codec", b"null").decode()

    def _seek_block(self, start: int) -> int:
        """First block beginning at or after ``start``: right behind a sync marker."""
        if start <= self.body:
            return self.body
        at, tail = start - 16, b""
        self.file.seek(at)
        while chunk := self.file.read(1 << 20):
            found = (tail + chunk).find(self.sync)
            if found >= 0:
                return at - len(tail) + found + 16
            at += len(chunk)
            tail = (tail + chunk)[-15:]
        return self.size

    def _read(self, n: int) -> bytes:
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("container data ends early")
        return data

    def _read_long(self) -> int:
        out = self._read(1)
        while out[-1] >= 0x80:
            out += self._read(1)
        return Cursor(out).long()

    def blocks(self, start: int = 0, stop: int | None = None):
        """(record count, raw bytes) of each block that begins in [start, stop)."""
        at = self._seek_block(start)
        self.file.seek(at)
        while at < min(self.size, self.size if stop is None else stop):
            count, length = self._read_long(), self._read_long()
            data = self._read(length)
            if self._read(16) != self.sync:
                raise ValueError("sync marker is missing")
            at = self.file.tell()
            raw = self.unpack(data)
            del data
            yield count, raw
            del raw

    def unpack(self, data: bytes) -> bytes:
        if self.codec == "null":
            return data
        if self.codec == "deflate":
            return zlib.decompress(data, -15)
        if self.codec != "snappy":
            raise ValueError(f"codec {self.codec} is not supported")
        length = shift = i = 0  # the raw length stands in front of the packed bytes
        while True:
            length |= (data[i] & 0x7F) << shift
            if data[i] < 0x80:
                break
            i, shift = i + 1, shift + 7
        raw = pa.Codec("snappy").decompress(data[:-4], length, asbytes=True)
        if zlib.crc32(raw) != int.from_bytes(data[-4:], "big"):
            raise ValueError("checksum does not match")
        return raw
