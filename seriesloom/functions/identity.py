"""Channel identity: name plus canonical tags."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_CHANNEL = "values"  # fixed value: name of a series that carries no channel

_PART = r"((?:\\.|[^=;\\])*)"
_PAIR = f"{_PART}={_PART}"


def _escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("="), F.lit("\\="))
    return F.replace(text, F.lit(";"), F.lit("\\;"))


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def _no_tags() -> Column:
    return F.create_map().cast("map<string,string>")


def channel_or_default(channel: Column) -> Column:
    """A series without a channel name is called ``values``."""
    return F.coalesce(channel, F.lit(DEFAULT_CHANNEL))


def _each_name(entries: Column, work: Callable[[Column, Column], Column]) -> Column:
    """``work(name, value)`` of the different names of ``entries`` in order, each with the value given last.

    Only names are sorted, as plain strings, and the list is bound to no name of its own: both are several times
    faster than to sort entries with their places. A list that is dear to compute is better stored in a column."""
    keys, values = entries["key"], entries["value"]
    last = lambda k: F.element_at(values, -F.array_position(F.reverse(keys), k).cast("int"))
    return F.transform(F.sort_array(F.array_distinct(keys)), lambda k: work(k, last(k)))


def tag_map(tags: Column | Mapping[str, Column] | None, entries: bool = False) -> Column:
    """Canonical tag map: sorted by key, the last of equal keys wins, absent means empty.

    ``tags`` is a map column, a dict of tag name -> column, or (``entries=True``) a column of
    ``array<struct<key,value>>`` in the order the tags were given.
    """
    if tags is None:
        return _no_tags()
    if isinstance(tags, Mapping):
        pairs = [part for k in sorted(tags) for part in (F.lit(k), tags[k].cast("string"))]
        return F.create_map(*pairs) if pairs else _no_tags()
    if not entries:
        return F.coalesce(F.map_from_entries(F.sort_array(F.map_entries(tags))), _no_tags())
    return F.coalesce(F.map_from_entries(_each_name(tags, lambda k, v: F.struct(k.alias("key"), v.alias("value")))), _no_tags())


def tags_key(tags: Column | Mapping[str, Column] | None, entries: bool = False) -> Column:
    """Tags as one text ``k=v;k=v``, sorted by key, with ``\\ = ;`` escaped so that it is injective.

    With a dict of columns the order is known when the plan is built, so the key is a plain
    concatenation inside generated code; from ``entries``, as in ``tag_map``, no map is built on
    the way. A null tag value is refused, and so is a null name among ``entries``.
    """
    if not isinstance(tags, Column) and not tags:
        return F.lit("")
    null = F.raise_error(F.lit("tag values must be strings, got null"))
    if isinstance(tags, Mapping):
        parts = [
            F.concat(_escape(F.lit(k)), F.lit("="), _escape(tags[k].cast("string"))) for k in sorted(tags)
        ]
        return F.coalesce(F.concat(*[x for p in parts for x in (F.lit(";"), p)][1:]), null)
    text = lambda t: F.coalesce(_escape(t), null)
    pair = lambda k, v: F.concat(text(k), F.lit("="), text(v))
    if entries:
        pairs = _each_name(tags, pair)
    else:
        pairs = F.transform(F.sort_array(F.map_entries(tags)), lambda e: pair(e["key"], e["value"]))
    return F.coalesce(F.array_join(pairs, ";"), F.lit(""))


def tags_from_key(key: Column) -> Column:
    """The tag map back from its text, so that maps need not travel through shuffles."""
    part = lambda i: F.transform(F.regexp_extract_all(key, F.lit(_PAIR), F.lit(i)), _unescape)
    return F.map_from_arrays(part(1), part(2))
