"""Edits of JSON text that keep the type of every untouched value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOC = "map<string,variant>"


def build_object(**fields: Column) -> Column:
    """One JSON object; a NULL field is written as null."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"})


def _text(entries: Column, key: str) -> Column:
    return F.try_variant_get(F.try_element_at(entries, F.lit(key)), "$", "string")


def _put(entries: Column, key: str, value: Column, drop: tuple[str, ...] = ()) -> Column:
    gone = (key, *drop)
    rest = F.map_filter(entries, lambda k, _: ~k.isin(*gone))
    return F.map_concat(rest, F.create_map(F.lit(key), value))


def _last_wins(entries: Column) -> Column:
    """Entries without repeated keys: of several the last stays, as in a binary JSON column."""
    keys = F.map_keys(entries)
    unique = F.filter(
        F.map_entries(entries), lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"])
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(F.map_from_entries(unique))


def _entries(doc: Column) -> Column:
    return F.transform(F.array(F.from_json(doc, _DOC)), _last_wins)[0]


def edit(doc: Column, *changes: Callable[[Column], Column]) -> Column:
    """The document after all changes of its entries, with one parse and one print.

    A change gives the new entries, or NULL to leave them. A document that no change touches, or that is
    no JSON object, stays as it was to the letter.
    """
    state = F.struct(_entries(doc).alias("entries"), F.lit(False).alias("touched"))
    steps = F.array(state)
    for change in changes:
        def step(s: Column, change=change) -> Column:
            new = F.transform(F.array(change(s["entries"])), lambda n: F.struct(
                F.coalesce(n, s["entries"]).alias("entries"), (s["touched"] | n.isNotNull()).alias("touched")
            ))
            return new[0]

        steps = F.transform(steps, _one_argument(step))
    return F.coalesce(F.transform(steps, lambda s: F.when(s["touched"], F.to_json(s["entries"])))[0], doc)


def _one_argument(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda s: f(s)


def text_value(doc: Column, key: str) -> Column:
    """The value as text; JSON null and a missing key give NULL."""
    return _text(_entries(doc), key)


def has_key(doc: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(F.from_json(doc, _DOC), F.lit(key)), F.lit(False))


def key_renamed(old: str, new: str) -> Callable[[Column], Column]:
    return lambda m: F.when(
        F.map_contains_key(m, F.lit(old)), _put(m, new, F.try_element_at(m, F.lit(old)), drop=(old,))
    )


def value_trimmed(key: str) -> Callable[[Column], Column]:
    return lambda m: F.when(_text(m, key).isNotNull(), _put(m, key, F.trim(_text(m, key)).cast("variant")))


def value_replaced(key: str, pattern: str, replacement: str) -> Callable[[Column], Column]:
    return lambda m: F.when(F.ilike(_text(m, key), F.lit(pattern)), _put(m, key, F.lit(replacement).cast("variant")))


def rename_keys(doc: Column, renames: dict[str, str]) -> Column:
    """Rename in the given order; documents without the key stay as they are."""
    return edit(doc, *[key_renamed(old, new) for old, new in renames.items()])


def trim_value(doc: Column, key: str) -> Column:
    """Trim one value as text; JSON null stays null."""
    return edit(doc, value_trimmed(key))


def replace_value(doc: Column, key: str, pattern: str, replacement: str) -> Column:
    """Set the value where its text matches the case-insensitive pattern."""
    return edit(doc, value_replaced(key, pattern, replacement))
