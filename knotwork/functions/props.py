"""Property map encoding and predicates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from knotwork.functions.text import fold_literal, fold_punctuation

# Properties every vertex declares; they are real columns, so predicates on them
# reach the Parquet scan.  All other properties live in the ``props`` map.
DECLARED = ("name", "id", "text", "ref_doc_id", "doc_id", "triplet_source_id")
PROPS_TYPE = T.MapType(T.StringType(), T.StringType())


def prop(key: str) -> Column:
    """A property by name, wherever it is kept."""
    return F.col(key) if key in DECLARED else F.try_element_at(F.col("props"), F.lit(key))


def property_equals(key: str, value: object) -> Column:
    """Equality with a stored property; stored values are text."""
    stored = prop(key)
    if value is None:
        raise ValueError(f"no value given for property {key!r}")
    if isinstance(value, bool):
        return F.lower(stored) == str(value).lower()
    if isinstance(value, int):
        # Plain notation digit by digit, so that nothing is rounded; powers as numbers.
        sign = "-" if value < 0 else "[+-]?" if value == 0 else r"\+?"
        plain = F.rlike(stored, F.lit(rf"^\s*{sign}0*{abs(value)}(\.0*)?\s*$"))
        power = F.rlike(stored, F.lit("[eE]")) & (stored.try_cast("double") == F.lit(float(value)))
        return plain | F.coalesce(power, F.lit(False))
    if isinstance(value, float):
        return stored.try_cast("double") == F.lit(value)
    return stored == F.lit(fold_literal(value))


def all_equal(properties: Mapping[str, object]) -> Column:
    """Conjunction over a property mapping; unknown properties count as no match."""
    if not properties:
        raise ValueError("no properties given")
    matches = F.lit(True)
    for key, value in properties.items():
        matches = matches & property_equals(key, value)
    return F.coalesce(matches, F.lit(False))


def json_field(key: str, path: str) -> Column:
    """A field of a property that holds JSON text."""
    return F.get_json_object(prop(key), path)


def with_nested(vertices: DataFrame, **columns: str) -> DataFrame:
    """``vertices`` with a VARIANT column for each ``name=property`` that holds JSON text.

    The text is parsed once, whatever number of fields is read; text that is no JSON, and a
    property that is not there, give NULL.
    """
    return vertices.withColumns({name: F.try_parse_json(prop(key)) for name, key in columns.items()})


def nested_field(column: str, path: str, kind: str) -> Column:
    """The field at ``path`` of a parsed property as a value of SQL type ``kind``; NULL when
    there is none or it is of another kind."""
    return F.try_variant_get(F.col(column), path, kind)


def encode(df: DataFrame, column: str) -> Column:
    """One typed column as property text: nested values as JSON, scalars as strings."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.col(column))
    if isinstance(dtype, T.BooleanType):
        return F.initcap(F.col(column).cast("string"))
    return F.col(column).cast("string")


def props_from(df: DataFrame, columns: list[str]) -> Column:
    """A property map out of typed columns, without the empty ones."""
    if not columns:
        return no_props()
    pairs = [x for c in columns for x in (F.lit(c), encode(df, c))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def no_props() -> Column:
    return F.create_map().cast(PROPS_TYPE)


def without(props: Column, keys: tuple[str, ...]) -> Column:
    """The map without reserved keys and empty values."""
    return F.map_filter(props, lambda k, v: v.isNotNull() & ~k.isin(*keys))


def fold_values(props: Column) -> Column:
    return F.transform_values(props, lambda _, v: fold_punctuation(v))


def drop_large(props: Column, limit: int = 1000) -> Column:
    """Leave out property text longer than ``limit`` characters."""
    return F.map_filter(props, lambda _, v: F.length(v) <= limit)


def overlay(old: Column, new: Column) -> Column:
    """New entries over old ones; neither side may be lost when the other is NULL."""
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.map_concat(kept, new))


def without_system_fields(props: Column) -> Column:
    return F.map_filter(props, lambda k, _: ~k.startswith("@"))
