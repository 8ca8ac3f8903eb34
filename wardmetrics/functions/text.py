"""Name cleaning, slugs, category maps and comma lists."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitise(column: Column) -> Column:
    """Table-safe name: lower case, odd characters to ``_``, runs of ``_`` collapsed."""
    lowered = F.replace(F.lower(column), F.lit(" "), F.lit("_"))
    return F.regexp_replace(F.regexp_replace(lowered, "[^a-zA-Z0-9._-]", "_"), "_{2,}", "_")


def sanitise_name(name: object) -> str:
    """Plain-string twin of :func:`sanitise`, for table and path names."""
    lowered = str(name).lower().replace(" ", "_")
    return re.sub("_{2,}", "_", re.sub("[^a-zA-Z0-9._-]", "_", lowered))


def standardise(column: Column) -> Column:
    """Join-key form of a name: lower case, `` and `` as `` & ``, outer blanks cut."""
    return F.trim(F.replace(F.lower(column), F.lit(" and "), F.lit(" & ")))


def standard_key(column: Column, data_type: str) -> Column:
    """Text form of a key part. Whole numbers go through bigint so 2023 and 2023.0 agree; others keep their own text."""
    if data_type in ("float", "double") or data_type.startswith("decimal"):
        number = column.cast("double")
        whole = F.when(number == F.floor(number), number.try_cast("bigint"))
        return F.coalesce(whole.cast("string"), standardise(number.cast("string")))
    return standardise(column.cast("string"))


def slugify(column: Column) -> Column:
    """``criminal-damage arson`` -> ``criminal_damage_arson``."""
    return F.btrim(F.regexp_replace(F.lower(column), "[^a-z0-9]+", "_"), F.lit("_"))


def slugify_name(name: str) -> str:
    return re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")


def category_group(column: Column, groups: Mapping[str, str], default: str = "Other") -> Column:
    """Group label for a category; unknown and null categories get ``default``."""
    if not groups:
        return F.lit(default)
    pairs = [F.lit(part) for item in groups.items() for part in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), F.lit(default))


def comma_items(column: Column) -> Column:
    """Trimmed items of a comma list; an empty part stays an item."""
    return F.transform(F.split(column, ","), lambda part: F.trim(part))


def presence_text(base: Column, flags: Sequence[tuple[Column, str]], empty: str = "None") -> Column:
    """Base text followed by the label of every positive count."""
    parts = [F.nullif(F.trim(base), F.lit(""))]
    parts += [F.when(count > 0, F.lit(label)) for count, label in flags]
    return F.coalesce(F.nullif(F.concat_ws(", ", *parts), F.lit("")), F.lit(empty))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)
