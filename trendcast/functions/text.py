"""Text and nested-value expressions: name lists, JSON text, ISO durations, numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def join_names(arr, field: str | None = None, sep: str = ", ") -> Column:
    """Join an array (optionally of structs, taking ``field``) into text; absent array -> ''."""
    a = F.coalesce(_c(arr), F.array())
    if field is not None:
        a = F.transform(a, lambda x: x.getField(field))
    return F.array_join(a, sep)


# ISO-8601 duration: a sign, calendar parts (years, months), weeks, days, hours, minutes, seconds.
# Calendar parts have no fixed length and count nothing; the other parts beside them do.
_NUM = r"\d+(?:[.,]\d+)?"
ISO_DURATION = (rf"^([+-]?)P(?!$)(?:{_NUM}Y)?(?:{_NUM}M)?(?:({_NUM})W)?(?:({_NUM})D)?"
                rf"(?:T(?:({_NUM})H)?(?:({_NUM})M)?(?:({_NUM})S)?)?$")
_UNIT_SECS = (604800, 86400, 3600, 60, 1)


def iso_duration_secs(col) -> Column:
    """ISO-8601 duration text -> whole seconds (fraction cut towards zero); bad or NULL -> 0.

    One regular-expression pass turns the text into its parts, split by bars; they
    are bound to a name, so the pass is not repeated for each of them.
    """
    def secs_of(parts: Column) -> Column:
        total = F.lit(0.0)
        for idx, secs in enumerate(_UNIT_SECS, start=1):
            # A missing part is not cast: a failing cast costs more than all the rest.
            value = F.nullif(F.replace(F.get(parts, F.lit(idx)), F.lit(","), F.lit(".")), F.lit("")).try_cast("double")
            total = total + F.coalesce(value, F.lit(0.0)) * F.lit(float(secs))
        signed = F.when(F.get(parts, F.lit(0)) == "-", -F.floor(total)).otherwise(F.floor(total))
        return F.when(F.size(parts) == 6, signed)

    parts = F.split(F.regexp_replace(_c(col), ISO_DURATION, r"$1|$2|$3|$4|$5|$6"), r"\|")
    found = F.get(F.transform(F.array(parts), secs_of), F.lit(0))
    return F.when(~F.contains(_c(col), F.lit("|")), F.coalesce(found, F.lit(0))).otherwise(F.lit(0)).cast("bigint")


def int_or_zero(col) -> Column:
    """Integer from number or numeric text, 0 when missing or not a number."""
    return F.coalesce(_c(col).cast("string").try_cast("bigint"), F.lit(0).cast("bigint"))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace NULLs with per-column defaults; add the column when it is missing."""
    cols = {}
    for name, default in defaults.items():
        if name in df.columns:
            cols[name] = F.coalesce(F.col(name), F.lit(default))
        else:
            cols[name] = F.lit(default)
    return df.withColumns(cols)


def tags_text(df: DataFrame, col: str = "tags") -> DataFrame:
    """Store a tag list as text: JSON array text for arrays, text as is, NULL column if absent."""
    if col not in df.columns:
        return df.withColumn(col, F.lit(None).cast("string"))
    dtype = df.schema[col].dataType.typeName()
    if dtype == "array":
        return df.withColumn(col, F.to_json(F.coalesce(F.col(col), F.array().cast(df.schema[col].dataType))))
    return df.withColumn(col, F.col(col).cast("string"))
