"""Greedy segmentation in order: delay-bounded batches (C3) and next-fit requests (C4).

Both walk a key's rows in order and cut when a rule says so. The next cut depends only on where
the last one was, so a run of rows has a jump table, found with vector operations for all keys
of an Arrow batch at once. Rows stream through the task sorted by key and order, with the state
of the open key carried from batch to batch: no group is ever held whole.

A hot key is walked by many tasks. Each of its cells is first summarised, in parallel, by what
any cut entering it leads to at its end. Such a summary is a function from state to state, and two
in a row compose to one of the same form, so ``FAN`` neighbouring cells become one, and again, until
``FAN`` are left. From there the states are followed down, level by level, to the one that each cell
starts from; last, all cells are numbered in parallel like ordinary keys. No task follows more than
``FAN`` summaries of a key in a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.operators.spread import ROWS_PER_CELL, null_safe, present, split_hot_keys
from seriesloom.session import scratch_dir

_SEGMENTS_PER_CELL = 64

# Neighbouring summaries that are composed, and followed, by one task.
FAN = 64


def _first_above(values: np.ndarray, limit: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each row the first later index whose value exceeds the row's limit, at most its end."""
    low, high = np.arange(len(values)) + 1, ends.copy()
    while (low < high).any():
        mid = (low + high) // 2
        up = values[np.minimum(mid, len(values) - 1)] <= limit
        open_ = low < high
        low = np.where(open_ & up, mid + 1, low)
        high = np.where(open_ & ~up, mid, high)
    return low


@dataclass(frozen=True)
class DelayRule:
    """Close a batch with its N-th point, or with the first one arriving > delay after the last close.

    State: (time of the last close, points waiting). A cut row ends its segment.
    """

    max_points: int
    delay: int
    closes: bool = True

    def start(self, rows):
        return int(rows[0]), 0

    def jumps(self, rows, ends):
        nearest = np.minimum(ends, np.arange(len(rows)) + self.max_points)
        return _first_above(rows, rows + self.delay, nearest)

    def enter(self, rows, state):
        by_time = int(np.searchsorted(rows, state[0] + self.delay, side="right"))
        return min(by_time, self.max_points - state[1] - 1), 0

    def leave(self, rows, cut, state):
        return (int(rows[cut]), len(rows) - 1 - cut) if cut >= 0 else (state[0], state[1] + len(rows))

    def enter_all(self, rows, x, y):
        by_time = np.searchsorted(rows, x + self.delay, side="right")
        return np.minimum(by_time, self.max_points - y - 1), np.zeros_like(y)

    def leave_all(self, rows, cuts):
        return rows[cuts], len(rows) - 1 - cuts

    def pass_all(self, rows, x, y):
        return x, y + len(rows)

    def guards(self, rows, seen):
        """For each entry the last arrival before it: no earlier row may have closed the batch."""
        before = seen.last if seen.count else -(2**63)
        return np.concatenate(([before], rows[:-1]))

    def possible(self, seen, at, guards):
        return (at < self.max_points) & (guards <= seen.first + self.delay)

    def reaches(self, state, at, guard):
        return (guard <= state[0] + self.delay) & (at <= self.max_points - state[1] - 1)

    def last_reached(self, at, guard, x, y):
        by_count = np.searchsorted(at, self.max_points - y - 1, side="right")
        return np.minimum(np.searchsorted(guard, x + self.delay, side="right"), by_count) - 1

    def behind(self, none, at, guard):
        """An entry of the next cell, seen from this one's start; ``none`` is this cell's row without a cut."""
        return none[0] + at, np.maximum(guard, none[1])

    def passed(self, x, y, at, guard):
        """The state after a cell without a cut, whose last row of the summary has ``at`` and ``guard``."""
        return x, y + at

    def keeps(self, first, at, guard):
        """Whether an entry behind a passed cell that begins with ``first`` can be reached at all."""
        return (at < self.max_points) & (guard <= first + self.delay)

    @property
    def max_entries(self):
        return self.max_points


@dataclass(frozen=True)
class FitRule:
    """Start a new request when a block does not fit; an empty request takes any block.

    State: (0, points in the open request). A cut row starts its segment. An empty open request
    is as good as one that starts at the next row.
    """

    capacity: int
    closes: bool = False

    def start(self, rows):
        return 0, 0

    def _until(self, rows):
        return np.concatenate(([0], np.cumsum(rows)))

    def jumps(self, rows, ends):
        total = self._until(rows)
        fits = np.searchsorted(total[1:], total[:-1] + self.capacity, side="right")
        filled = np.where(rows > 0, np.arange(len(rows)), len(rows))
        first = np.minimum.accumulate(filled[::-1])[::-1]
        return np.minimum(np.maximum(fits, first + 1), ends)

    def enter(self, rows, state):
        if state[1] == 0:
            return 0, 1
        return int(np.searchsorted(self._until(rows)[1:], self.capacity - state[1], side="right")), 0

    def leave(self, rows, cut, state):
        return 0, int(rows[cut:].sum()) if cut >= 0 else state[1] + int(rows.sum())

    def enter_all(self, rows, x, y):
        fits = np.searchsorted(self._until(rows)[1:], self.capacity - y, side="right")
        return np.where(y == 0, 0, fits), (y == 0).astype(np.int64)

    def leave_all(self, rows, cuts):
        total = self._until(rows)
        return np.zeros_like(cuts), total[-1] - total[cuts]

    def pass_all(self, rows, x, y):
        return x, y + rows.sum()

    def guards(self, rows, seen):
        """For each entry the points before it in the cell: they must fit into the open request."""
        return seen.total + self._until(rows)[:-1]

    def possible(self, seen, at, guards):
        return (at == 0) | (guards < self.capacity)

    def reaches(self, state, at, guard):
        return (at == 0) | ((state[1] > 0) & (state[1] + guard <= self.capacity))

    def last_reached(self, at, guard, x, y):
        fits = np.searchsorted(guard, self.capacity - y, side="right") - 1
        return np.where(y == 0, 0, np.maximum(fits, 0))

    def behind(self, none, at, guard):
        return none[0] + at, none[1] + guard

    def passed(self, x, y, at, guard):
        return 0 * x, y + guard

    def keeps(self, first, at, guard):
        return guard < self.capacity

    @property
    def max_entries(self):
        return self.capacity


@dataclass(frozen=True)
class SizeRule:
    """Start a new segment when it holds ``max_points`` rows, or the next row's bytes do not fit.

    Rows weigh one byte at least. State: (points, bytes of the open segment), (0, 0) at the start. A cut row
    starts its segment; one row may be larger than ``max_bytes`` by itself.
    """

    max_points: int
    max_bytes: int
    closes: bool = False

    def start(self, rows):
        return 0, 0

    def _until(self, rows):
        return np.concatenate(([0], np.cumsum(rows)))

    def jumps(self, rows, ends):
        total, here = self._until(rows), np.arange(len(rows))
        fits = np.searchsorted(total[1:], total[:-1] + self.max_bytes, side="right")
        return np.minimum(np.minimum(np.maximum(fits, here + 1), here + self.max_points), ends)

    def enter(self, rows, state):
        at, free = self.enter_all(rows, np.array([state[0]]), np.array([state[1]]))
        return int(at[0]), int(free[0])

    def leave(self, rows, cut, state):
        return (len(rows) - cut, int(rows[cut:].sum())) if cut >= 0 else (state[0] + len(rows), state[1] + int(rows.sum()))

    def enter_all(self, rows, x, y):
        fits = np.searchsorted(self._until(rows)[1:], self.max_bytes - y, side="right")
        return np.where(x == 0, 0, np.minimum(fits, self.max_points - x)), (x == 0).astype(np.int64)

    def leave_all(self, rows, cuts):
        total = self._until(rows)
        return len(rows) - cuts, total[-1] - total[cuts]

    def pass_all(self, rows, x, y):
        return x + len(rows), y + rows.sum()

    def guards(self, rows, seen):
        return seen.total + self._until(rows)[:-1]

    def possible(self, seen, at, guards):
        return (at == 0) | ((guards < self.max_bytes) & (at < self.max_points))

    def reaches(self, state, at, guard):
        return (at == 0) | ((state[0] > 0) & (state[1] + guard <= self.max_bytes) & (state[0] + at <= self.max_points))

    def last_reached(self, at, guard, x, y):
        fits = np.searchsorted(guard, self.max_bytes - y, side="right")
        return np.where(x == 0, 0, np.maximum(np.minimum(fits, np.searchsorted(at, self.max_points - x, side="right")) - 1, 0))

    def behind(self, none, at, guard):
        return none[0] + at, none[1] + guard

    def passed(self, x, y, at, guard):
        return x + at, y + guard

    def keeps(self, first, at, guard):
        return (guard < self.max_bytes) & (at < self.max_points)

    @property
    def max_entries(self):
        return self.max_points


Rule = DelayRule | FitRule | SizeRule


def walk(rule: Rule, rows: np.ndarray, jump: list[int], base: int, state, first: int):
    """Number one key's rows: (numbers, end state). ``jump`` counts from ``base``."""
    at, free = rule.enter(rows, state)
    marks = np.zeros(len(rows) + 1, dtype=np.int64)
    shift = 1 if rule.closes else 0
    last = -1
    while at < len(rows):
        marks[at + shift] = 1 - free
        free, last, at = 0, at, jump[base + at] - base
    numbers = first + np.cumsum(marks)
    return numbers[:-1], rule.leave(rows, last, state), int(numbers[-1])


Summary = np.ndarray  # rows of (first entry, guard, end state x, end state y, cuts made)


class Summariser:
    """What each entry cut leads to at the end of a cell, worked out as the rows stream by.

    All open possibilities are advanced through a batch at once, and neighbouring ones that
    have come to the same state are merged, so memory follows the number of possible entries
    (at most one segment's length) and not the size of the cell.
    """

    def __init__(self, rule: Rule):
        self.rule = rule
        self.open = np.empty((0, 5), dtype=np.int64)
        self.count = self.total = 0
        self.first = self.last = None

    def feed(self, rows: np.ndarray) -> None:
        rule, n = self.rule, len(rows)
        self.first = int(rows[0]) if self.first is None else self.first
        jump = rule.jumps(rows, np.full(n, n))
        end = np.where(jump < n, jump, np.arange(n))
        hops = (jump < n).astype(np.int64)
        while True:  # pointer doubling: the last cut that each cut of this batch leads to
            further = end[end]
            if np.array_equal(further, end):
                break
            hops, end = hops + hops[end], further

        at, guard, x, y, cuts = self.open.T
        cut, free = rule.enter_all(rows, x, y)
        hit = cut < n
        passed_x, passed_y = rule.pass_all(rows, x, y)
        reached = np.where(hit, cut, 0)
        left_x, left_y = rule.leave_all(rows, end[reached])
        advanced = np.stack([
            at, guard, np.where(hit, left_x, passed_x), np.where(hit, left_y, passed_y),
            cuts + np.where(hit, hops[reached] + 1 - free, 0),
        ], axis=1)

        entries, guards = self.count + np.arange(n), rule.guards(rows, self)
        new = np.flatnonzero(rule.possible(self, entries, guards))
        new_x, new_y = rule.leave_all(rows, end[new])
        added = np.stack([entries[new], guards[new], new_x, new_y, hops[new] + 1], axis=1)

        both = np.concatenate([advanced, added])
        differs = (both[1:, 2:] != both[:-1, 2:]).any(axis=1)
        self.open = both[np.concatenate(([True], differs))]
        self.count, self.total, self.last = self.count + n, self.total + int(rows.sum()), int(rows[-1])

    def result(self) -> Summary:
        none = self.count, (self.last if self.rule.closes else self.total), 0, 0, 0  # no cut in this cell
        return np.concatenate([self.open, np.array([none], dtype=np.int64)])


def step(rule: Rule, cell: Summary, state):
    """State after a summarised cell, and the number of cuts counted in it."""
    reached = np.flatnonzero(rule.reaches(state, cell[:, 0], cell[:, 1]))[-1]
    at, guard, x, y, cuts = cell[reached].tolist()
    if cuts == 0:
        return rule.passed(*state, at, guard), 0
    return (x, y), cuts - (1 if not rule.closes and state[1] == 0 else 0)


def compose(rule: Rule, first: int, cell: Summary, following: Summary) -> Summary:
    """The summary of two cells in a row; ``first`` is the weight of the first row of the first one.

    What enters the first cell leads to a state in which the second one is entered. What passes the first one
    without a cut may be cut in the second, whose entries are counted from the first one's start.
    """
    own, none = cell[:-1], cell[-1]
    reached = rule.last_reached(following[:, 0], following[:, 1], own[:, 2], own[:, 3])
    _, _, x, y, cuts = following[reached].T
    passed = reached == len(following) - 1
    passed_x, passed_y = rule.passed(own[:, 2], own[:, 3], *following[-1, :2])
    if not rule.closes:
        cuts = cuts - ((own[:, 3] == 0) & ~passed)
    led = np.stack([own[:, 0], own[:, 1], np.where(passed, passed_x, x), np.where(passed, passed_y, y), own[:, 4] + np.where(passed, 0, cuts)], axis=1)
    at, guard = rule.behind(none, following[:, 0], following[:, 1])
    behind = np.stack([at, guard, *following[:, 2:].T], axis=1)
    both = np.concatenate([led, behind[:-1][rule.keeps(first, at[:-1], guard[:-1])]])
    differs = (both[1:, 2:] != both[:-1, 2:]).any(axis=1)
    return np.concatenate([both[np.concatenate(([True], differs))], behind[-1:]])


def _run_starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Index of the first row of each run of equal keys."""
    changed = np.zeros(batch.num_rows, dtype=bool)
    changed[0] = True
    for key in keys:
        col = batch.column(key)
        before, after = col.slice(0, len(col) - 1), col.slice(1)
        same = pc.fill_null(pc.equal(before, after), False)
        both_null = pc.and_(pc.is_null(before), pc.is_null(after))
        changed[1:] |= ~pc.or_(same, both_null).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)


def _numbering(rule: Rule, keys: list[str], weight: str, name: str, schema: pa.Schema, entered: bool):
    """Worker over rows sorted by key and order; the open key's state crosses batches."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key = state = None
        current = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = _run_starts(batch, keys)
            ends = np.append(starts[1:], len(rows))
            jump = rule.jumps(rows, np.repeat(ends, ends - starts)).tolist()
            numbers = np.empty(len(rows), dtype=np.int64)
            for lo, hi in zip(starts.tolist(), ends.tolist()):
                run = rows[lo:hi]
                if lo > 0 or open_key != [batch.column(k)[0].as_py() for k in keys]:
                    state, current = rule.start(run), 0
                    if entered and batch.column("_first")[lo].is_valid:
                        state = batch.column("_x")[lo].as_py(), batch.column("_y")[lo].as_py()
                        current = batch.column("_first")[lo].as_py()
                numbers[lo:hi], state, current = walk(rule, run, jump, lo, state, current)
            open_key = [batch.column(k)[len(rows) - 1].as_py() for k in keys]
            columns = [
                pa.array(numbers) if f.name == name else batch.column(f.name).cast(f.type) for f in schema
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return number


_SUMMARY = ("_at", "_guard", "_x", "_y", "_cuts")


def _in_order(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows of a key in one partition, sorted.

    Hashing the key again keeps this exchange: one by the key itself is dropped when a join below
    already has that partitioning, and is lost when that join is turned into a broadcast at run time.
    """
    return df.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *order)


def _cells_of(batches: Iterator[pa.RecordBatch], names: list[str], values: tuple[str, ...]):
    """Each cell (values of ``names``, its first row as a batch of one, numbers of its rows); rows come sorted by ``names``."""
    open_cell, head, parts = None, None, []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        numbers = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in values], axis=1)
        starts = _run_starts(batch, names).tolist()
        for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
            cell = tuple(batch.column(c)[lo].as_py() for c in names)
            if cell != open_cell:
                if parts:
                    yield open_cell, head, np.concatenate(parts)
                open_cell, head, parts = cell, batch.slice(lo, 1), []
            parts.append(numbers[lo:hi])
    if parts:
        yield open_cell, head, np.concatenate(parts)


def _cell_states(
    hot: DataFrame, rule: Rule, keys: list[str], order: list[str], weight: str, cells: int, states: DataFrame | None
) -> DataFrame:
    """State and segment number that each cell of a hot key starts from; a key starts from its row of ``states``.

    Cells are summarised in parallel and the summaries kept in the shared folder. ``FAN`` neighbours are composed
    to one until a key, which has ``cells`` at most, has ``FAN``; these are followed, and the states found are handed
    down to the cells that were composed.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    def longs(*names: str) -> T.StructType:
        return T.StructType([*[hot.schema[k] for k in keys], *[T.StructField(c, T.LongType()) for c in names]])

    summary_type, state_type = longs("_cell", *_SUMMARY, "_start"), longs("_cell", "_x", "_y", "_first")
    summary_arrow, state_arrow = to_arrow_schema(summary_type), to_arrow_schema(state_type)
    spark = hot.sparkSession

    def cell_rows(cell: tuple, parts: Summary, first: int) -> pa.RecordBatch:
        columns = dict(zip([*keys, "_cell"], [[v] * len(parts) for v in cell]))
        columns |= {c: parts[:, i] for i, c in enumerate(_SUMMARY)}
        columns["_start"] = np.full(len(parts), first)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) for f in summary_arrow], schema=summary_arrow
        )

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_cell = summary = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = _run_starts(batch, [*keys, "_cell"]).tolist()
            for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
                cell = tuple(batch.column(c)[lo].as_py() for c in [*keys, "_cell"])
                if cell != open_cell:
                    if summary:
                        yield cell_rows(open_cell, summary.result(), summary.first)
                    open_cell, summary = cell, Summariser(rule)
                summary.feed(values[lo:hi])
        if summary:
            yield cell_rows(open_cell, summary.result(), summary.first)

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = whole = first = None
        for (*key, _, parent), head, parts in _cells_of(batches, [*keys, "_cell", "_parent"], _SUMMARY):
            start = head.column("_start")[0].as_py()
            if (*key, parent) != group:
                if group:
                    yield cell_rows(group, whole, first)
                group, whole, first = (*key, parent), parts, start
            else:
                whole = compose(rule, first, whole, parts)
        if group:
            yield cell_rows(group, whole, first)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, first, found = None, None, 0, []
        for (*key, cell, parent), head, parts in _cells_of(batches, [*keys, "_cell", "_parent"], _SUMMARY):
            if (*key, parent) != group:
                group, state, first = (*key, parent), (rule.start([head.column("_start")[0].as_py()])[0], 0), 0
                if head.column("_first")[0].is_valid:
                    state, first = tuple(head.column(c)[0].as_py() for c in ("_x0", "_y0")), head.column("_first")[0].as_py()
            found.append((*key, cell, *state, first))
            state, cuts = step(rule, parts, state)
            first += cuts
        columns = zip(*found) if found else [[]] * len(state_arrow)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, state_arrow)], schema=state_arrow)

    def kept(found: DataFrame) -> DataFrame:
        path = scratch_dir(spark, "summaries")
        found.write.parquet(path)
        return spark.read.schema(summary_type).parquet(path)

    parent = F.call_function("div", F.col("_cell"), F.lit(FAN).cast("bigint"))
    levels = [kept(_in_order(hot, ["_cell", *keys], order).mapInArrow(summaries, summary_type))]
    while cells > FAN:
        grouped = _in_order(levels[-1].withColumn("_parent", parent), [*keys, "_parent"], ["_cell", "_at"])
        levels.append(kept(grouped.mapInArrow(composed, summary_type)))
        cells = -(-cells // FAN)
    # the topmost summaries begin where the key does, the others where their parent does
    begin = states.select(*keys, F.lit(0).cast("bigint").alias("_parent"), F.col("_x").alias("_x0"), F.col("_y").alias("_y0"), "_first") if states is not None else None
    for level in reversed(levels):
        own = level.withColumn("_parent", F.lit(0).cast("bigint") if level is levels[-1] else parent)
        if begin is None:
            own = own.select("*", *[F.lit(None).cast("bigint").alias(c) for c in ("_x0", "_y0", "_first")])
        else:
            own = null_safe(own, begin, [*keys, "_parent"])
        found = _in_order(own, [*keys, "_parent"], ["_cell", "_at"]).mapInArrow(follow, state_type)
        begin = found.select(*keys, F.col("_cell").alias("_parent"), F.col("_x").alias("_x0"), F.col("_y").alias("_y0"), "_first")
    return found


def segment(
    df: DataFrame, keys: list[str], order: list[str], weight: str, rule: Rule, name: str,
    rows_per_cell: int = ROWS_PER_CELL, states: DataFrame | None = None,
) -> DataFrame:
    """Append the segment number ``name`` of each row, walking each key in ``order``.

    A null in the first column of ``order`` is an error; keys may be null. ``states`` (the keys, ``_x``, ``_y`` and
    ``_first``) has what keys start from that were walked before; others start anew.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, T.LongType())])
    # Cells much longer than a segment, so that their summaries are short against their rows.
    enough = max(rows_per_cell, _SEGMENTS_PER_CELL * rule.max_entries)
    df = df.withColumn(order[0], present(order[0]))
    # rows that arrive at one time stay in one cell: a batch closes by the time alone
    cells, any_hot = split_hot_keys(df, keys, order[:1] if rule.closes else order, enough)
    run_keys, rows = list(keys), df
    if any_hot:
        run_keys = ["_cell", *keys]  # the cell first: it tells the rows of a hot key apart when sorting
        hot = cells.where(F.col("_cell").isNotNull()).select(*dict.fromkeys([*run_keys, *order, weight]))
        # one row per cell, as many as the cuts: broadcast, so that the rows themselves move once
        rows = null_safe(cells, F.broadcast(_cell_states(hot, rule, keys, order, weight, any_hot, states)), run_keys)
    if states is not None:
        carried = [F.col(c).alias(f"_s{c}") for c in ("_x", "_y", "_first")]
        rows = null_safe(rows, states.select(*keys, *carried), keys)
        for c in ("_x", "_y", "_first"):
            rows = rows.withColumn(c, F.coalesce(c, f"_s{c}") if any_hot else F.col(f"_s{c}")).drop(f"_s{c}")
    worker = _numbering(rule, run_keys, weight, name, to_arrow_schema(schema), any_hot or states is not None)
    return _in_order(rows, run_keys, order).mapInArrow(worker, schema)


def batch_by_delay(
    points: DataFrame, max_points: int, delay_ns: int, arrival: str = "arrival_ns",
    keys: tuple[str, ...] = ("channel", "tags_key"), ties: tuple[str, ...] = ("seq",),
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Number the batches of each channel, bounded by count and delay.

    A batch closes with the point that is its N-th, or that arrives strictly more than
    ``delay_ns`` after the last close; the clock starts with the first arrival. Nothing closes
    without a point; the leftover is the last batch.
    """
    rule = DelayRule(max_points, delay_ns)
    return segment(points, list(keys), [arrival, *ties], arrival, rule, "batch", rows_per_cell)


def pack_next_fit(
    blocks: DataFrame, keys: list[str], order: list[str], size: str, capacity: int,
    rows_per_cell: int = ROWS_PER_CELL, name: str = "request_id",
) -> DataFrame:
    """Pack blocks of ``size`` points into requests, next-fit in ``order``, per key (C4).

    A block is accepted when the request is empty or stays within ``capacity``. Blocks are never
    split, so one oversize block may exceed it. ``order`` starts with a numeric column.
    """
    return segment(blocks, keys, order, size, FitRule(capacity), name, rows_per_cell)
