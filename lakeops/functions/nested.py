"""JSON and nested values to columns and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_rows(df: DataFrame, json_col: str, element_schema: str, outer: bool = False) -> DataFrame:
    """One row per element of a JSON array of objects, its fields as columns.

    `outer` keeps rows whose array is empty or malformed, with null fields.
    """
    parsed = F.from_json(F.col(json_col), f"array<struct<{element_schema}>>")
    expand = F.inline_outer if outer else F.inline
    kept = [c for c in df.columns if c != json_col]
    return df.select(*kept, expand(parsed))


def map_rows(df: DataFrame, map_col: str, key: str = "k", value: str = "v") -> DataFrame:
    kept = [c for c in df.columns if c != map_col]
    return df.select(*kept, F.explode(F.col(map_col)).alias(key, value))


def flatten_struct(df: DataFrame, struct_col: str) -> DataFrame:
    kept = [c for c in df.columns if c != struct_col]
    return df.select(f"{struct_col}.*", *kept)


def row_hash(columns: list[str | Column], sep: str = "||", null_marker: str = "\\N") -> Column:
    """SHA-256 over the text of the columns.

    `concat_ws` skips nulls, which makes (null, a) equal to (a, null); the marker keeps
    them apart.
    """
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_marker)) for c in columns]
    return F.sha2(F.concat_ws(sep, *texts), 256)


def stable_hash(df: DataFrame) -> Column:
    """A 64-bit hash of the row. Maps, which have no hash of their own, go by their sorted entries' text."""

    def part(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.MapType):
            entries = F.transform(F.map_entries(c), lambda e: F.to_json(F.struct(e.alias("e"))))
            return F.array_join(F.array_sort(entries), ",")
        return F.to_json(F.struct(c)) if "map<" in field.dataType.simpleString() else c

    return F.xxhash64(*[part(f) for f in df.schema])
