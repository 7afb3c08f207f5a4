"""Text and number functions of the catalogue, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldlake.functions._columns import col

_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def contains_ci(value, literal: str) -> Column:
    """Whether value holds literal in any case; null counts as no."""
    return F.coalesce(F.lower(col(value)).contains(literal.lower()), F.lit(False))


def number_or_null(value) -> Column:
    """The number that a text is, null for other text (also for a suffix as in `2.5d`)."""
    text = col(value).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def fixed(value, digits: int) -> Column:
    """value with so many decimals, rounded from its exact binary value and ties to even, as Python and SQL's printf write it
    (Java rounds up the shortest decimal: 14.35, which is a little less, would become 14.4). Null and numbers without
    decimals of their own are left to format_string."""
    x, scale = F.abs(col(value).cast("double")), float(10**digits)
    high = x * 134217729.0 - (x * 134217729.0 - x)
    # The product and its rounding error are exactly x * scale, as both halves of x have room for the scale's digits.
    product = x * scale
    error = high * scale - product + (x - high) * scale
    whole = F.floor(product)
    part = product - whole
    up = (part > 0.5) | (part == 0.5) & ((error > 0) | (error == 0) & (whole % 2 == 1))
    n = whole + up.cast("long")
    unit = 10**digits
    text = F.concat(((n - n % unit) / unit).cast("long").cast("string"), F.lit("."), F.lpad((n % unit).cast("string"), digits, "0"))
    sign = F.when(col(value).cast("double").cast("string").startswith("-"), "-").otherwise("")
    return F.when(x * scale < 2.0**52, F.concat(sign, text)).otherwise(F.format_string(f"%.{digits}f", col(value).cast("double")))


def or_default(value, default: str) -> Column:
    """value, or default where it is null or empty."""
    return F.coalesce(F.nullif(col(value), F.lit("")), F.lit(default))


def chain_list(value) -> Column:
    """Parts of a `a | b` list, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(col(value), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def first_chain(value) -> Column:
    """The first part of a `a | b` list, the raw text if it has none."""
    return F.coalesce(F.try_element_at(chain_list(value), F.lit(1)), col(value))


def first_spaced(value) -> Column:
    """The text before the first ` | `."""
    return F.trim(F.split_part(col(value), F.lit(" | "), F.lit(1)))


def comma_list(value) -> Column:
    return F.transform(F.split(col(value), ","), lambda x: F.trim(x))


def sanitize(value, default: str = "Human", most: int = 50) -> Column:
    """A name for files: letters and digits of any script, `-` and `_` stay, others become `_`; at most 50 characters."""
    return F.substring(F.regexp_replace(or_default(value, default), r"[^\p{L}\p{N}_-]", "_"), 1, most)


def entity_parts(value) -> Column:
    """The two parts of `pdb_entity` as an array, null unless there are exactly two."""
    parts = F.split(col(value), "_")
    return F.when(F.size(parts) == 2, parts)


def sequence_number(value) -> Column:
    """A 0-based index from a 1-based number of digits only, else null."""
    text = col(value).cast("string")
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int") - 1)


def component_label(path) -> Column:
    """The component that a file name stands for; antibody comes before human_ag and mouse_ag, else the stem."""
    name = F.regexp_extract(col(path), r"([^/]+)$", 1)
    low = F.lower(name)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return (
        F.when(low.contains("antibody"), "antibody")
        .when(low.contains("human_ag"), "human_ag")
        .when(low.contains("mouse_ag"), "mouse_ag")
        .otherwise(stem)
    )
