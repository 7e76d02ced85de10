"""Comparable forms of state values.

Two values are the same when their canonical forms are: map entry order does
not matter, list order does, a null map is an empty one, a null map value is
the empty string, and an empty rack is no rack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

EMPTY_AS_NULL = ("rack",)


def config(col: Column) -> Column:
    """A config map without nulls: absent means empty, a null value means ''."""
    empty = F.create_map().cast("map<string,string>")
    filled = F.transform_values(col, lambda _, value: F.coalesce(value, F.lit("")))
    return F.coalesce(filled, empty)


def config_from_entries(entries: Column, name: str = "name", value: str = "value") -> Column:
    """An entry list as a map; of entries with the same name the last one wins."""
    names = entries[name]
    distinct = F.array_except(names, F.array(F.lit(None).cast("string")))
    last = F.transform(
        distinct,
        lambda n: F.element_at(F.filter(entries, lambda e: e[name] == n), -1)[value],
    )
    found = F.when(
        F.size(distinct) == F.size(names), F.map_from_arrays(names, entries[value])
    ).otherwise(F.map_from_arrays(distinct, last))
    return F.coalesce(found, F.create_map().cast("map<string,string>"))


def config_to_entries(col: Column) -> Column:
    """A config map as an entry list in key order, null values as ''."""
    entries = F.transform(
        F.sort_array(F.map_entries(col)),
        lambda e: F.struct(e["key"].alias("name"), F.coalesce(e["value"], F.lit("")).alias("value")),
    )
    none = F.array().cast("array<struct<name:string,value:string>>")
    return F.coalesce(entries, none)


def node(id: Column, host: Column, port: Column, rack: Column) -> Column:
    """A node value; an empty rack is no rack."""
    return F.struct(
        id.cast("int").alias("id"),
        host.alias("host"),
        port.cast("int").alias("port"),
        F.nullif(rack, F.lit("")).alias("rack"),
    )


def _needs_canon(dtype: DataType) -> bool:
    if isinstance(dtype, MapType):
        return True
    if isinstance(dtype, ArrayType):
        return _needs_canon(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(f.name in EMPTY_AS_NULL or _needs_canon(f.dataType) for f in dtype.fields)
    return False


def canon(col: Column, dtype: DataType) -> Column:
    """The canonical form of a value of the given type."""
    if not _needs_canon(dtype):
        return col
    if isinstance(dtype, MapType):
        entries = F.sort_array(F.map_entries(col))
        if isinstance(dtype.valueType, StringType):
            return config_to_entries(col)
        return F.coalesce(entries, F.array().cast(ArrayType(_entry_type(dtype))))
    if isinstance(dtype, ArrayType):
        return F.transform(col, lambda item: canon(item, dtype.elementType))
    fields = [
        (
            F.nullif(col[f.name], F.lit(""))
            if f.name in EMPTY_AS_NULL and isinstance(f.dataType, StringType)
            else canon(col[f.name], f.dataType)
        ).alias(f.name)
        for f in dtype.fields
    ]
    return F.when(col.isNotNull(), F.struct(*fields))


def _entry_type(dtype: MapType) -> StructType:
    return StructType().add("key", dtype.keyType, False).add("value", dtype.valueType)


def same(left: Column, right: Column, dtype: DataType) -> Column:
    """Null-safe equality of two values of one type."""
    return canon(left, dtype).eqNullSafe(canon(right, dtype))


def digest(col: Column, dtype: DataType) -> Column:
    """32 bytes that stand for a value: the SHA-256 of its canonical form, null for null.

    Values that are ``same`` have one digest. That others have one too can be left
    out of account, as of any file that is named by such a digest.
    """
    text = F.to_json(F.struct(canon(col, dtype).alias("v")), {"ignoreNullFields": "false"})
    return F.when(col.isNotNull(), F.unhex(F.sha2(text, 256)))


def tidy(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows in exactly the given shape, absent columns as null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
