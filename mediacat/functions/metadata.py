"""Column functions over raw batch metadata and JSON rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacat.schemas import STATUSES


def parse_time(text: Column) -> Column:
    """Timestamp of ISO text, null when it does not parse."""
    return F.try_to_timestamp(text)


def resolution(width: Column, height: Column, strict: bool = False) -> Column:
    """`WxH`. A missing side is skipped; with `strict` it makes the result null."""
    sides = (width.cast("string"), height.cast("string"))
    return F.concat(sides[0], F.lit("x"), sides[1]) if strict else F.concat_ws("x", *sides)


def latency_sec(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, null if either is null."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def status_normalized(status: Column, mode: str = "reference") -> Column:
    """Coarse status. `reference` knows indexed, failed and pending only; `full` keeps canonical words."""
    base = F.when(status == "ready", "indexed")
    if mode == "reference":
        return base.when(status.isin("failed", "timeout"), "failed").otherwise("pending")
    if mode == "full":
        failed = status.isin("failed", "timeout", "upload_failed")
        return base.when(failed, "failed").when(status.isin(*STATUSES), status).otherwise("pending")
    raise ValueError(f"unknown mode: {mode}")


def tags_map(text: Column) -> Column:
    """Tags as a map from JSON text that holds a map or a list; a list entry gets an empty value."""
    listed = F.from_json(text, "array<string>")
    from_list = F.map_from_arrays(
        F.array_distinct(F.array_compact(listed)),
        F.transform(F.array_distinct(F.array_compact(listed)), lambda _: F.lit("")),
    )
    as_map = F.when(F.ltrim(text).startswith("["), from_list).otherwise(F.from_json(text, "map<string,string>"))
    return F.coalesce(as_map, F.create_map().cast("map<string,string>"))


def iso_text(ts: Column) -> Column:
    """ISO text with offset; the fraction appears only when it is not zero."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(seconds, F.when(fraction == ".000000", "").otherwise(fraction), F.lit("+00:00"))


def compact(value: Column, kind: T.DataType) -> Column:
    """Value with times as ISO text and null map values removed, at every depth."""
    if isinstance(kind, T.TimestampType):
        return iso_text(value)
    if isinstance(kind, T.MapType):
        kept = F.map_filter(value, lambda _, v: v.isNotNull())
        return F.transform_values(kept, lambda _, v: compact(v, kind.valueType))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: compact(v, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [compact(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def compact_json(schema: T.StructType) -> Column:
    """JSON object of the columns in `schema` without null fields; nulls inside lists stay."""
    row = F.struct(*[compact(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])
    return F.to_json(row, {"ignoreNullFields": "true"})
