"""Search responses: JSON text to hit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _typed(item: Column, field: str, kind: str, types: str, default: object) -> Column:
    """Field of a JSON object, or the default when it is absent or of another type."""
    found = F.schema_of_variant(F.try_variant_get(item, f"$.{field}", "variant")).rlike(types)
    return F.coalesce(F.when(found, F.try_variant_get(item, f"$.{field}", kind)), F.lit(default))


def parse_hits(df: DataFrame, response: str) -> DataFrame:
    """One row per hit of the `data` array in column `response`; other columns are kept.

    Items that are not objects are skipped, wrong types become '' or 0, a missing array gives no rows.
    """
    text, number = "^STRING$", "^(DOUBLE|FLOAT|BIGINT|DECIMAL.*)$"
    data = F.try_variant_get(F.try_parse_json(F.col(response)), "$.data", "array<variant>")
    others = [c for c in df.columns if c != response]
    items = df.select(*others, F.posexplode(data).alias("position", "item"))
    items = items.filter(F.schema_of_variant("item").startswith("OBJECT"))
    item = F.col("item")
    return items.select(
        *others,
        "position",
        _typed(item, "video_id", "string", text, "").alias("video_id"),
        _typed(item, "score", "double", number, 0.0).alias("score"),
        _typed(item, "start", "double", number, 0.0).alias("start"),
        _typed(item, "end", "double", number, 0.0).alias("end"),
        _typed(item, "confidence", "string", text, "").alias("confidence"),
        _typed(item, "thumbnail_url", "string", text, "").alias("thumbnail_url"),
    )
