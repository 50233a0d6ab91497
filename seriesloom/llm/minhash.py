"""Near duplicates: signature coordinates as an inverted join, confirmed on full shingle sets, as components.

1. Every text becomes its set of word shingles, a key of that set and a MinHash signature; texts with equal sets are
   one class from here on.
2. A class is posted under its signature's (coordinate, value) tokens. Two signatures that agree in ``MATCHES``
   coordinates share a token among their first ``COORDINATES - MATCHES + 1`` in any common order, so only that prefix
   is posted; tokens known to be frequent come last in the order.
3. Posts of a token meet in lists, in three passes. First each list proposes the pairs with its hub: large groups of
   copies are joined without their pairs. Then, in lists that hold several groups of rows much like their hubs, rows are
   merged in order of set size, skipping from where sizes differ too much, equal coordinates are counted, and every row
   proposes the nearest row of another group, as in a spanning forest. These pairs are confirmed and joined to
   components. Last, all pairs of different components that remain are proposed.
4. A proposed pair also has to pass a bound that is never wrong: the bits in which the parities of two sets' hash
   buckets differ are at most their symmetric difference, and linked sets differ in a seventh of their sizes' sum at
   most. What passes is confirmed on the full sets; linked pairs become components by union and find in the tasks.

A link of similarity 0.75 is missed when fewer than 10 of 32 coordinates agree: 3.4e-8, less above.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, join_groups, map_texts, slices, stored

SHINGLE = 5
#: Similarity in hundredths from which texts are linked.
SIMILARITY = 75
COORDINATES, MATCHES = 32, 10
PREFIX = COORDINATES - MATCHES + 1
#: Buckets of which a sketch holds the parity.
PARITIES = 1024
SKETCH = COORDINATES + PARITIES // 8
#: Tokens of more than one in so many classes are frequent; so many of them are told to all tasks, and about so many
#: classes, thinned by hash, are looked at to find them.
SHARE, FREQUENT, THINNED = 4096, 1 << 16, 1 << 16
#: Equal coordinates from which a row is taken to be linked with its list's hub until full sets are compared.
SURE = 28
#: Links that a task joins at a time: the number of tasks follows the number of links.
LINKS = 1 << 18
#: Rows of a block of a list, and buckets of ids that preselect texts: bounds of their own.
BLOCK, BUCKETS = 2048, 1 << 18
#: Parts of a frequent token's list that have a hub of their own.
PARTS = 64
#: Salts over which the pairs of one hub are confirmed.
SALTS = 16

#: Bytes of text whose words are hashed at a time.
PART = 1 << 18

_IS_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.random.default_rng(1).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(2).integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every word: a polynomial in its bytes modulo 2^64, from sums over the whole data."""
    hashes, places, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PART)
        while end < len(data) and not _IS_WHITE[data[end]]:  # no word is cut
            end += 1
        part = np.frombuffer(data, np.uint8, end - at, at)
        power, back = _powers(len(part))
        edges = np.flatnonzero(np.diff(np.r_[True, _IS_WHITE[part], True].view(np.int8)))
        starts, ends = edges[0::2], edges[1::2]
        sums = np.cumsum((part + np.uint64(1)) * power)
        sums = np.r_[np.zeros(1, np.uint64), sums]
        hashes.append(_mixed((sums[ends] - sums[starts]) * back[starts]))
        places.append(starts + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(places)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


@functools.lru_cache(maxsize=1)
def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    made = []
    for factor in (base, pow(base, -1, 1 << 64)):
        powers = np.full(size, factor, np.uint64)
        powers[0] = 1
        made.append(np.multiply.accumulate(powers))
    return made[0], made[1]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; the usual size is kept."""
    power, back = _tables(max(size, PART + 256))
    return power[:size], back[:size]


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's five-word runs; of all its words together if they are fewer."""
    ids, places = _word_hashes(b"\n".join(texts).translate(_LOWER))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(places, begins)
    runs = _runs(ids, SHINGLE) if len(ids) >= SHINGLE else ids[:0]
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = end - begin
        own = runs[begin : end - SHINGLE + 1] if n >= SHINGLE else _runs(ids[begin:end], n) if n else ids[:0]
        out.append(np.unique(own))
    return out


def _runs(ids: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words."""
    runs = np.full(len(ids) - size + 1, size, np.uint64)
    for at in range(size):
        runs = (runs + ids[at : len(ids) - size + 1 + at]) * _MIX
    return _mixed(runs)


def set_key(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 32-bit minima per set; no set may be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), COORDINATES), np.uint32)
    with np.errstate(over="ignore"):
        for i in range(COORDINATES):
            out[:, i] = np.minimum.reduceat(flat * _ODD[i] + _ADD[i], starts) >> np.uint64(32)
    return out


def parities(hashes: np.ndarray) -> bytes:
    """Whether each bucket of the hashes' upper bits holds an odd number of them."""
    counts = np.bincount((hashes >> np.uint64(54)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def _sketched(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A byte of each coordinate, and the parities as words."""
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)
    return flat[:, :COORDINATES], np.ascontiguousarray(flat[:, COORDINATES:]).view(np.uint64)


def _differing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Parities that differ: at most the elements that only one of the sets has."""
    return np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)


def _bounded(differing: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets that differ so much may be linked: difference * (100 + 75) <= (100 - 75) * sum of sizes."""
    return differing * (100 + SIMILARITY) <= (100 - SIMILARITY) * sizes


def _describe(texts: list[bytes]) -> dict[str, list]:
    sets = shingles(texts)
    some = [n for n, s in enumerate(sets) if len(s)]
    signed = dict(zip(some, signatures([sets[n] for n in some]), strict=True)) if some else {}
    return {
        "n_shingles": [len(s) for s in sets],
        "key": [set_key(s) if len(s) else None for s in sets],
        "signature": [signed[n].tobytes() if n in signed else None for n in range(len(sets))],
        "sketch": [signed[n].astype(np.uint8).tobytes() + parities(sets[n]) if n in signed else None for n in range(len(sets))],
    }


def _tokens(signature: np.ndarray) -> np.ndarray:
    """Token of every (coordinate, value) pair, a row per signature."""
    place = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)
    return _mixed(signature.astype(np.uint64) | place).view(np.int64)


def _signed(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def frequent_tokens(classes: DataFrame) -> np.ndarray:
    """Sorted tokens of more than one in ``SHARE`` of all classes with about how many they have; a hint on the posting order.

    Classes are thinned by their key to a bounded number first, so what is found depends on neither files nor partitions.
    """
    total = classes.count()
    every = max(1, total // THINNED)
    thinned = classes.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, counts = np.unique(_tokens(_signed(batch.column(0))).ravel(), return_counts=True)
            yield pa.record_batch([pa.array(tokens), pa.array(counts)], names=["token", "n"])

    counts = thinned.select("signature").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    often = counts.where(F.col("n") > max(2, total // every // SHARE))
    top = often.orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()
    order = np.argsort(top["token"].to_numpy(np.int64))
    return np.stack([top["token"].to_numpy(np.int64)[order], top["n"].to_numpy(np.int64)[order] * every])


def _lookup(frequent: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    if not frequent.shape[1]:
        return np.zeros(tokens.shape, np.int64)
    place = np.minimum(np.searchsorted(frequent[0], tokens), frequent.shape[1] - 1)
    return np.where(frequent[0][place] == tokens, frequent[1][place], 0)


def posts(classes: DataFrame, frequent: np.ndarray) -> DataFrame:
    """token, often, key, n for the prefix of every class: rare tokens first, then by count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                tokens = _tokens(_signed(part.column("signature")))
                often = _lookup(frequent, tokens)
                order = np.lexsort((tokens, often), axis=1)[:, :PREFIX]
                row = np.repeat(np.arange(len(tokens)), PREFIX)
                columns = [np.take_along_axis(x, order, axis=1).ravel() for x in (tokens, often)]
                yield pa.record_batch([*map(pa.array, columns), part.column("key").take(pa.array(row)), part.column("n_shingles").take(pa.array(row))], names=["token", "often", "key", "n"])

    return classes.select("key", "n_shingles", "signature").mapInArrow(run, "token long, often long, key binary, n long")


def lists(classes: DataFrame, frequent: np.ndarray) -> DataFrame:
    """token, key, n, part, blocks for the posts of all tokens that have several.

    A frequent token's posts are dealt over parts, so the windows that count posts are bounded. ``blocks`` is how
    many blocks the token's list needs, by its counted rows or, for frequent tokens, by the thinned count and a margin.
    """
    found = posts(classes, frequent)
    part = F.when(F.col("often") > 0, F.pmod(F.xxhash64("key"), F.lit(PARTS))).otherwise(0).cast("int")
    counted = found.withColumn("part", part).withColumn("rows", F.count("*").over(Window.partitionBy("token", "part")))
    longest = F.when(F.col("often") > 0, F.col("often") + classes.count() // SHARE).otherwise(F.col("rows"))
    several = counted.where("rows > 1 or often > 0").withColumn("blocks", F.ceil(longest / BLOCK).cast("int"))
    return several.select("token", "key", "n", "part", "blocks")


def _runs_of(table: pa.Table, columns: tuple[str, ...]) -> np.ndarray:
    """Where a new list, or part of one, begins."""
    keys = [np.asarray(table.column(c)) for c in columns]
    return np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]


def _proposed(a: np.ndarray, b: np.ndarray, table: pa.Table, sure: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows ``a`` and ``b`` as pairs of keys with their texts' buckets, the smaller key first, and whether they are sure."""
    key, bucket = np.array(table.column("key").to_pylist(), dtype=object), np.asarray(table.column("bucket"))
    sure = np.zeros(len(a), bool) if sure is None else sure
    pairs = sorted({(*min((key[x], key[y], bucket[x], bucket[y]), (key[y], key[x], bucket[y], bucket[x])), s) for x, y, s in zip(a.tolist(), b.tolist(), sure.tolist(), strict=True)})
    types = (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.bool_())
    return pa.record_batch([pa.array([p[i] for p in pairs], t) for i, t in enumerate(types)], names=["a", "b", "bucket_a", "bucket_b", "sure"])


_PAIRS = "a binary, b binary, bucket_a int, bucket_b int, sure boolean"


def hub_pairs(posted: DataFrame, facts: DataFrame) -> DataFrame:
    """The rows of every list, or part of a frequent one, that may be linked with its first row.

    ``facts`` has sketch and bucket of each key. Lists stream by; a task remembers the open list's hub alone.
    """
    rows = posted.select("token", "part", "key", "n").join(facts.select("key", "sketch", "bucket"), "key")
    rows = rows.repartition("token", "part").sortWithinPartitions("token", "part", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if hub is None else pa.concat_tables([hub, table])
            starts = np.flatnonzero(_runs_of(table, ("token", "part")))
            of = np.repeat(starts, np.diff(np.r_[starts, table.num_rows]))
            here = np.arange(table.num_rows)
            of, here = of[of != here], here[of != here]
            n, (low, odd) = np.asarray(table.column("n")), _sketched(table.column("sketch"))
            sizes = n[of] + n[here]
            kept = np.minimum(n[of], n[here]) * 100 >= np.maximum(n[of], n[here]) * SIMILARITY
            equal = (low[of] == low[here]).sum(axis=1)
            kept &= _bounded(_differing(odd[of], odd[here]), sizes) & (equal >= MATCHES)
            yield _proposed(of[kept], here[kept], table, equal[kept] >= SURE)
            hub = table.slice(starts[-1], 1)

    return rows.mapInArrow(run, _PAIRS)


def rest_pairs(posted: DataFrame, facts: DataFrame, linked: DataFrame, nearest: bool) -> DataFrame:
    """Pairs of different components that may be linked, from all lists.

    ``linked`` names the components of keys that have links. A list longer than a block is dealt over pairs of
    blocks, so that no task holds a list. Rows come in order of size; each is compared with the rows behind it
    until their size is too large, then with none. ``nearest`` leaves each row of a block its nearest partner only.
    """
    known = facts.select("key", "sketch", "bucket").join(linked, "key", "left").withColumn("component", F.coalesce("component", "key"))
    rows = posted.join(known, "key").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "n", "sketch", "bucket", "component")
    rows = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            last = int(np.flatnonzero(_runs_of(table, ("token", "i", "j")))[-1])
            held = table.slice(last)
            if last:
                yield _compared(table.slice(0, last), nearest)
        if held is not None:
            yield _compared(held, nearest)

    return rows.mapInArrow(run, _PAIRS)


def _compared(table: pa.Table, nearest: bool) -> pa.RecordBatch:
    number = np.unique(np.array(table.column("component").to_pylist(), dtype=object), return_inverse=True)[1]
    starts = np.flatnonzero(_runs_of(table, ("token", "i", "j")))
    mixed = np.minimum.reduceat(number, starts) != np.maximum.reduceat(number, starts)
    keep = np.repeat(mixed, np.diff(np.r_[starts, table.num_rows]))
    table, number = table.filter(pa.array(keep)), number[keep]  # lists of one component have nothing to add
    i, j, own, n = (np.asarray(table.column(c)) for c in ("i", "j", "own", "n"))
    if not len(n):
        return _proposed(n, n, table)
    low, odd = _sketched(table.column("sketch"))
    starts = _runs_of(table, ("token", "i", "j"))
    ends = np.r_[np.flatnonzero(starts)[1:], len(n)][np.cumsum(starts) - 1]
    best, partner = np.full(len(n), np.inf), np.full(len(n), -1)
    found_a, found_b = [], []
    left, step = np.arange(len(n)), 1
    while len(left):
        left = left[left + step < ends[left]]
        left = left[n[left + step] * SIMILARITY <= n[left] * 100]  # sizes only grow from here
        other = left + step
        tried = (number[left] != number[other]) & ((i[left] == j[left]) | (own[left] != own[other]))
        a, b = left[tried], other[tried]
        for at in range(0, len(a), 65536):
            x, y = a[at : at + 65536], b[at : at + 65536]
            differing, sizes = _differing(odd[x], odd[y]), n[x] + n[y]
            alike = _bounded(differing, sizes) & ((low[x] == low[y]).sum(axis=1) >= MATCHES)
            x, y, far = x[alike], y[alike], (differing / sizes)[alike]
            if nearest:
                for one, two in ((x, y), (y, x)):
                    closer = far < best[one]
                    best[one[closer]], partner[one[closer]] = far[closer], two[closer]
            else:
                found_a.append(x)
                found_b.append(y)
        step += 1
    if nearest:
        some = np.flatnonzero(partner >= 0)
        return _proposed(some, partner[some], table)
    none = [np.zeros(0, np.int64)]
    return _proposed(np.concatenate(found_a or none), np.concatenate(found_b or none), table)


def sets_of(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, hashes: the full sets of the classes in ``pairs``, each from one text.

    Buckets of ids, of which there is a fixed number, choose the texts. The key computed from a text decides, as an id may
    be null or occur with several texts.
    """
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("key"), F.col("bucket_a").alias("bucket")), F.struct(F.col("b").alias("key"), F.col("bucket_b").alias("bucket")))).alias("end"))
    wanted = stored(ends.select("end.key", "end.bucket").distinct(), "near-wanted")
    rows = docs.select(F.col(text_col).alias("text"), _bucket(F.col(id_col)).alias("bucket")).where("text is not null")
    rows = rows.join(F.broadcast(wanted.select("bucket").distinct()), "bucket", "left_semi").select(F.col("text").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES // 2):
                sets = [s for s in shingles(part.column("text").to_pylist()) if len(s)]
                yield pa.record_batch([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "hashes"])

    found = rows.mapInArrow(run, "key binary, hashes binary").join(wanted.select("key"), "key", "left_semi")
    return found.dropDuplicates(["key"])


def _bucket(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(BUCKETS)).cast("int")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough.

    The pairs of a key are dealt over salts; on each, the key's own set comes first and its partners' sets stream by.
    """
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("salt"))
    asked = salted.select("a", "salt", F.lit(0).alias("kind"), F.col("a").alias("key")).distinct().unionByName(salted.select("a", "salt", F.lit(1).alias("kind"), F.col("b").alias("key")))
    rows = asked.join(sets, "key").repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for part in slices(batch, "hashes"):
                for a, kind, key, data in zip(*(part.column(c).to_pylist() for c in ("a", "kind", "key", "hashes")), strict=True):
                    hashes = np.frombuffer(data, np.uint64)
                    if kind == 0:
                        hub, own = a, hashes
                    elif a == hub:
                        place = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
                        common = int((own[place] == hashes).sum())
                        if 100 * common >= SIMILARITY * (len(own) + len(hashes) - common):
                            out.append((a, key))
            yield pa.record_batch([pa.array([p[k] for p in out], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """key, component (the smallest key that can be reached) for every key in ``links`` (a, b) but that smallest one.

    A task joins ``LINKS`` links by union and find and points each key to the least one around. Where that takes several
    tasks, pointers are dealt by the pointing key, of which a task sent one at most, and joined again, until every
    key has one pointer; then they are followed, twice as far in each step, to where they end. Pointers are kept
    in the shared folder, neighbourhoods are never gathered, and what still moves is read from the step's own rows.
    ``links`` is counted first, so it should be a written table.
    """
    tasks = max(1, -(-links.count() // LINKS))
    pointers = links.coalesce(tasks).mapInArrow(_joined(None), _POINTERS)
    if tasks == 1:
        return stored(pointers, "near-pointers").select(F.col("a").alias("key"), F.col("b").alias("component"))
    while True:
        dealt = pointers.select("a", "b").repartition("a").sortWithinPartitions("a")
        pointers = stored(dealt.mapInArrow(_joined("a"), _POINTERS), "near-pointers")
        if pointers.where("open").isEmpty():
            break
    while True:
        ends = pointers.select(F.col("a").alias("b"), F.col("b").alias("further"))
        followed = pointers.select("a", "b").join(ends, "b", "left")
        followed = followed.select("a", F.coalesce("further", "b").alias("b"), F.col("further").isNotNull().alias("open"))
        pointers = stored(followed, "near-pointers")
        if pointers.where("open").isEmpty():
            return pointers.select(F.col("a").alias("key"), F.col("b").alias("component"))


_POINTERS = "a binary, b binary, open boolean"


def _joined(key: str | None):
    """A step of :func:`components` on a task's rows (a, b): a pointer to the least key around for every other key.

    ``open`` tells that the pointing key may be dealt elsewhere too. Beyond the keys of ``LINKS`` links, rows sorted by
    ``key`` are let go where a new key begins, others at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[bytes, bytes] = {}
        own: set[bytes] = set()

        def top(x: bytes) -> bytes:
            root = x
            while (up := parent.get(root, root)) != root:
                root = up
            while x != root:
                parent[x], x = root, parent[x]
            return root

        def made() -> pa.RecordBatch:
            found = [(x, top(x)) for x in parent]
            found = [(x, root, key is None or x not in own) for x, root in found if x != root]
            return pa.record_batch([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.binary(), pa.binary(), pa.bool_()))], names=["a", "b", "open"])

        before = None
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                if len(parent) >= 2 * LINKS and (key is None or a != before):
                    yield made()
                    parent.clear()
                    own.clear()
                before = a
                own.add(a)
                one, two = top(a), top(b)
                parent.setdefault(a, a)
                parent.setdefault(b, b)
                parent[max(one, two)] = min(one, two)
        yield made()

    return run


def near_classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, key), classes (key, n_shingles, first_id) and components of keys."""
    rows = stored(map_texts(docs, "n_shingles long, key binary, signature binary, sketch binary", _describe, id_col, text_col, raw=True), "near-rows")
    best = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "n_shingles", "signature", "sketch")
    classes = rows.where("n_shingles > 0").groupBy("key").agg(F.min(best).alias("best"))
    classes = stored(classes.select("key", F.col("best.id").alias("first_id"), "best.n_shingles", "best.signature", "best.sketch"), "near-classes")
    facts = classes.withColumn("bucket", _bucket(F.col("first_id")))
    posted = stored(lists(classes, frequent_tokens(classes)), "near-lists")
    hubs = stored(hub_pairs(posted, facts), "near-hubs")
    # a sketch of the components, from signatures alone, is enough to leave out most pairs
    ends = F.explode(F.array(F.struct(F.col("b").alias("key"), F.col("a").alias("component")), F.struct(F.col("a").alias("key"), F.col("a").alias("component"))))
    rough = hubs.where("sure").select(ends.alias("end")).groupBy("end.key").agg(F.min("end.component").alias("component"))
    links = _confirm(docs, hubs.unionByName(rest_pairs(posted, facts, rough, True)), id_col, text_col)
    linked = components(links)
    last = _confirm(docs, rest_pairs(posted, facts, linked, False), id_col, text_col)
    if not last.isEmpty():
        linked = components(linked.select(F.col("key").alias("a"), F.col("component").alias("b")).unionByName(last))
    return rows, classes, linked


def _confirm(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    pairs = stored(pairs.drop("sure").distinct(), "near-pairs")
    return stored(confirmed(pairs, sets_of(docs, pairs, id_col, text_col)), "near-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    ``component_id`` is the smallest id that links reach; null ids come last, and it is null if there is no other.
    One row of a component is kept, the one with that id; of several rows with it, those with the smallest set
    key are alike and one of them is kept. Texts without words are linked with nothing and kept. An empty table gives
    no rows; other columns are not read.
    """
    rows, classes, linked = near_classes(docs, id_col, text_col)
    facts = classes.join(linked, "key", "left").withColumn("component", F.coalesce("component", "key"))
    first = F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id").alias("id"), F.col("key").alias("best_key"))
    heads = facts.groupBy("component").agg(F.min(first).alias("first"))
    facts = join_groups(facts.select("key", "component"), heads, ["component"], "near-heads")
    same = rows.where("n_shingles > 0").groupBy("key", "doc_id", "n_shingles").agg(F.count("*").alias("times"))
    joined = join_groups(same, facts.select("key", "first"), ["key"], "near-facts")
    stays = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.best_key"))
    each = F.transform(F.sequence(F.lit(1), F.col("times").cast("int")), lambda i: stays & (i == 1))
    some = joined.select("doc_id", "n_shingles", F.col("first.id").alias("component_id"), F.explode(each).alias("kept"))
    none = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return some.unionByName(none)
