"""Text normalisation and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def category_or_unknown(c: Column) -> Column:
    return F.coalesce(blank_to_null(F.trim(c)), F.lit("Unknown"))


def capitalize_first(c: Column) -> Column:
    """Only the first letter upper-cased; ``initcap`` would change every word."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def normalise_name(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "'", ""))


def last_path_part(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, "^\\uFEFF", "")


def sanitise_identifier(c: Column, fallback: str) -> Column:
    """Letters, digits and underscores only; never empty, never starting with a digit."""
    cleaned = F.regexp_replace(F.regexp_replace(F.trim(c), "[^A-Za-z0-9_]", "_"), "^_+|_+$", "")
    named = F.coalesce(blank_to_null(cleaned), F.lit(fallback))
    return F.when(named.rlike("^[0-9]"), F.concat(F.lit("x_"), named)).otherwise(named)


def agency_mappings(c: Column) -> Column:
    """'muni:SF,bart:BA' -> map; blanks are ignored, a part without both sides is an error."""
    parts = F.filter(F.transform(F.split(c, ","), lambda p: F.trim(p)), lambda p: p != "")
    pairs = F.transform(
        parts,
        lambda p: F.struct(
            F.trim(F.substring_index(p, ":", 1)).alias("key"),
            F.trim(F.regexp_replace(p, "^[^:]*:", "")).alias("value"),
        ),
    )
    usable = (F.size(parts) > 0) & F.forall(parts, lambda p: p.rlike(r"^\s*[^:\s][^:]*:\s*\S"))
    return F.when(usable, F.map_from_entries(pairs)).otherwise(
        F.raise_error(F.concat(F.lit("invalid agency mapping: "), F.coalesce(c, F.lit("NULL"))))
    )


def normalise_boundary_id(c: Column) -> Column:
    """'53.0' -> '53'; blanks and 'none' -> NULL; other text unchanged."""
    text = F.trim(c)
    number = text.try_cast("double")
    whole = number.isNotNull() & (number == F.floor(number))
    return (
        F.when((text == "") | (F.lower(text) == "none"), F.lit(None).cast("string"))
        .when(whole, F.floor(number).cast("string"))
        .otherwise(text)
    )


def json_cell(c: Column) -> Column:
    """Nested value -> JSON text for a table cell; NULL -> ''."""
    return F.coalesce(F.to_json(c), F.lit(""))


def count_label(c: Column) -> Column:
    return F.coalesce(F.format_number(c.cast("bigint"), 0), F.lit("N/A"))


def delay_label(seconds: Column) -> Column:
    minutes = F.regexp_replace(F.format_number(F.abs(seconds.cast("double")) / 60.0, 1), ",", "")
    return (
        F.when(seconds.isNull(), F.lit("N/A"))
        .when(F.abs(seconds) < 0.5, F.lit("0.0 min on time"))
        .when(seconds > 0, F.concat(minutes, F.lit(" min late")))
        .otherwise(F.concat(minutes, F.lit(" min early")))
    )


def percent_label(c: Column) -> Column:
    number = F.regexp_replace(F.format_number(c.cast("double"), 1), ",", "")
    return F.coalesce(F.concat(number, F.lit("%")), F.lit("N/A"))


def currency_label(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("$"), F.format_number(c.cast("double"), 0)), F.lit("N/A"))


def listing_label(count: Column) -> Column:
    n = F.coalesce(count.cast("bigint"), F.lit(0))
    word = F.when(n == 1, F.lit(" listing")).otherwise(F.lit(" listings"))
    return F.concat(F.format_number(n, 0), word)


def date_label(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "MMM d, yyyy"), F.lit("today"))


def bytes_label(c: Column) -> Column:
    units = ["B", "KB", "MB", "GB", "TB", "PB", "EB"]
    label = None
    for power, unit in enumerate(units):
        scaled = c.cast("double") / F.lit(float(1024**power))
        text = F.concat(F.regexp_replace(F.format_number(scaled, 1), ",", ""), F.lit(" " + unit))
        if label is None:
            label = F.when(F.abs(scaled) < 1024.0, text)
        elif unit != "EB":
            label = label.when(F.abs(scaled) < 1024.0, text)
        else:
            label = label.otherwise(text)
    return F.when(c.isNotNull(), label)
