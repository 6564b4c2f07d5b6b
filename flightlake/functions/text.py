"""Text helpers with Python's idea of white space, word edges and case."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightlake.constants import OVERRIDE_PATTERNS, REDACTED, TRUE_WORDS


# Python counts four control characters as white space that Java does not
SPACE = r"[\s\x1c-\x1f]"


def strip(value: Column) -> Column:
    return F.regexp_replace(value, f"(?U)^{SPACE}+|{SPACE}+$", "")


def blank_to_null(value: Column) -> Column:
    return F.nullif(strip(value), F.lit(""))


def redact(value: Column) -> Column:
    """Replace every instruction-override phrase."""
    pattern = "(?iU)(" + "|".join(OVERRIDE_PATTERNS).replace(r"\s", SPACE) + ")"
    return F.regexp_replace(value, pattern, REDACTED)


def contains_any(value: Column, words: Iterable[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | value.contains(word)
    return found


def count_contained(value: Column, words: Iterable[str]) -> Column:
    total = F.lit(0)
    for word in words:
        total = total + value.contains(word).cast("int")
    return total


def truthy(value: Column) -> Column:
    return F.lower(strip(value)).isin(TRUE_WORDS)


def last_segment(value: Column) -> Column:
    """What follows the last slash; an absent name gives an empty text."""
    return F.coalesce(F.element_at(F.split(value, "/"), -1), F.lit(""))


def flatten_parts(parts: Column) -> Column:
    """Content sent as a list of {text} parts becomes one string; NULL becomes empty."""
    texts = F.transform(parts, lambda part: F.coalesce(part["text"], F.lit("")))
    return F.coalesce(F.array_join(texts, " "), F.lit(""))


def json_row_text(names: Iterable[str]) -> Column:
    """One row as indented JSON text, two spaces deep, in the given column order."""

    def value(name: str) -> Column:
        listed = F.to_json(F.array(F.col(name)), {"ignoreNullFields": "false"})
        return F.substr(listed, F.lit(2), F.length(listed) - 2)

    lines = [F.concat(F.lit(f'  "{name}": '), value(name)) for name in names]
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *lines), F.lit("\n}"))
