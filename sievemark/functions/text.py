"""Text, number and path formatting as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_double(value: Column) -> Column:
    """Number, or NULL for NaN and for text that is not a number."""
    return F.nullif(value.try_cast("double"), F.lit(float("nan")))


def fixed(value: Column, decimals: int) -> Column:
    """Fixed decimals, half-even on the exact binary value, no grouping; NULL stays NULL."""
    return F.replace(F.format_number(value, decimals), F.lit(","), F.lit(""))


def percent_text(value: Column, decimals: int = 1) -> Column:
    """``0.1234`` → ``12.3 %``; NULL → a dash."""
    return F.coalesce(F.concat(fixed(value * 100, decimals), F.lit(" %")), F.lit("—"))


def decimal_comma(value: Column, decimals: int = 2) -> Column:
    """Fixed decimals with a decimal comma; NULL stays NULL."""
    return F.translate(fixed(value, decimals), ".", ",")


def thousands(value: Column, separator: str = "\u00a0") -> Column:
    """Integer with a thousands separator (a no-break space by default)."""
    text = F.replace(F.format_string("%,d", value.cast("bigint")), F.lit(","), F.lit(separator))
    return F.when(value.isNotNull(), text)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(name: Column) -> Column:
    """Name without its last extension; a leading dot belongs to the stem."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def file_extension(name: Column) -> Column:
    """Lower-case extension with its dot, '' without one."""
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def relative_path(path: Column, root: Column) -> Column:
    return F.when(F.startswith(path, root), F.ltrim(F.substr(path, F.length(root) + 1), F.lit("/"))).otherwise(path)


def base_id(stem: Column) -> Column:
    """Strip one trailing ``_<digits>``."""
    return F.regexp_extract(stem, r"^(.+?)(?:_(\d+))?$", 1)


def group_id(label: Column, stem: Column) -> Column:
    """``class::base``."""
    return F.concat_ws("::", label, base_id(stem))


def display_label(latin: Column, common: Column) -> Column:
    return F.concat_ws(" // ", latin, common)


# Status and conclusion labels of a pipeline run.
OPEN_STATES = {"in_progress": "EN COURS", "queued": "EN ATTENTE"}
CONCLUSIONS = {"success": "SUCCES", "failure": "ECHEC", "cancelled": "ANNULE"}
UNKNOWN_STATE = "INCONNU"


def status_label(status: Column, conclusion: Column) -> Column:
    done = F.when(F.coalesce(conclusion, F.lit("")) == "", UNKNOWN_STATE)
    for key, label in CONCLUSIONS.items():
        done = done.when(conclusion == key, label)
    done = done.otherwise(F.upper(conclusion))
    result = F.when(status == "completed", done)
    for key, label in OPEN_STATES.items():
        result = result.when(status == key, label)
    return result.otherwise(UNKNOWN_STATE)


def replace_words(text: Column, mapping: list[tuple[str, str]]) -> Column:
    """Ordered whole-word replacements; word borders follow Unicode letters and digits."""
    for old, new in mapping:
        if old != new:
            text = F.regexp_replace(
                text, rf"(?U)\b{re.escape(old)}\b", F.lit(new.replace("\\", "\\\\").replace("$", "\\$"))
            )
    return text


def to_json_array(items: Column) -> Column:
    return F.to_json(items)


def from_json_array(text: Column, schema: str = "array<struct<species:string,confidence:double,rank:int>>") -> Column:
    return F.from_json(text, schema)
