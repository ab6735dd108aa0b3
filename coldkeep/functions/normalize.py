"""Comparable text for column names and values.

`lenient` ignores case, padding, fractions of a second and digits past the fifth decimal.
`strict` keeps all of them and tells NULL from the text 'null'.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Formats and tokens that make the compared text.
NULL_TOKEN = "null"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
NUMBER_SCALE = 5

_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
_FRACTIONAL = (T.DecimalType, T.DoubleType, T.FloatType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.StructType)


def null_token(value: Column, text: Column) -> Column:
    return F.when(value.isNull(), F.lit(NULL_TOKEN)).otherwise(text)


def fill_token(text: Column) -> Column:
    return F.coalesce(text, F.lit(NULL_TOKEN))


def norm_timestamp(c: Column) -> Column:
    return null_token(c, F.date_format(c, TIMESTAMP_FORMAT))


def norm_number(c: Column, scale: int = NUMBER_SCALE) -> Column:
    return null_token(c, F.format_number(c.cast("double"), scale))


def norm_integer(c: Column) -> Column:
    return null_token(c, c.cast("string"))


def norm_boolean(c: Column) -> Column:
    return null_token(c, F.when(c, F.lit("true")).otherwise(F.lit("false")))


def norm_text(c: Column) -> Column:
    return null_token(c, F.trim(F.lower(c.cast("string"))))


def _nested_text(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(c)))
    return F.to_json(c)


def norm_value(c: Column, data_type: T.DataType, mode: str = "lenient") -> Column:
    if mode not in ("lenient", "strict"):
        raise ValueError(f"unknown comparison mode: {mode!r}")
    if isinstance(data_type, T.BinaryType):
        # Blobs are compared by digest, so wide bytes never enter a shuffle.
        return null_token(c, F.sha2(c, 256))
    if isinstance(data_type, (*_NESTED, T.MapType)):
        text = _nested_text(c, data_type)
        return norm_text(text) if mode == "lenient" else null_token(c, text)
    if isinstance(data_type, _INTEGRAL):
        return norm_integer(c)
    if isinstance(data_type, T.BooleanType):
        return norm_boolean(c)
    if mode == "strict":
        if isinstance(data_type, T.StringType):
            return null_token(c, F.concat(F.lit("'"), c, F.lit("'")))
        return null_token(c, c.cast("string"))
    if isinstance(data_type, _TEMPORAL):
        return norm_timestamp(c)
    if isinstance(data_type, _FRACTIONAL):
        return norm_number(c)
    return norm_text(c)


# Limits of number_key. Below the first a double lies close enough to its 5-decimal value for the
# shortcut; above the second no two doubles share a text, so the ways may part there.
_SHORTCUT_BELOW = "1e9D"
_PARSED_BELOW = "1e12D"


def number_key(name: str) -> Column:
    """A bigint that is equal exactly where `norm_number` is, for a tenth of the cost.

    A double that is the nearest one to some 5-decimal value is formatted as that value, so the
    value times 100,000 stands for the text. Only other doubles are formatted.
    """
    x = f"double(`{name}`)"
    text = f"format_number({x}, {NUMBER_SCALE})"
    return F.expr(
        f"""CASE
        WHEN `{name}` IS NULL THEN NULL
        WHEN {x} = 0D AND string({x}) = '0.0' THEN 0L
        WHEN abs({x}) < {_SHORTCUT_BELOW} AND rint({x} * 1e5D) / 1e5D = {x}
             AND rint({x} * 1e5D) <> 0D THEN bigint(rint({x} * 1e5D))
        WHEN abs({x}) < {_PARSED_BELOW} AND {text} <> '-0.00000'
             THEN bigint(CAST(replace({text}, ',', '') AS DECIMAL(20, 5)) * 100000)
        ELSE xxhash64({text}) END"""
    )


def value_key(name: str, data_type: T.DataType, other: T.DataType, mode: str = "lenient") -> Column:
    """A value to hash that is equal exactly where the normalised text is, NULL for NULL.

    Text is made only where the types of the two sides are not of one kind.
    """
    c, both = F.col(f"`{name}`"), (data_type, other)

    def kind(*types: type) -> bool:
        return all(isinstance(t, types) for t in both)

    if kind(*_INTEGRAL):
        return c.cast("bigint")
    if kind(T.BooleanType):
        return c
    if mode == "strict" and data_type == other and isinstance(data_type, (T.StringType, *_TEMPORAL)):
        return c
    if mode == "lenient" and kind(*_TEMPORAL):
        return F.unix_seconds(c.cast("timestamp"))
    if mode == "lenient" and kind(*_FRACTIONAL):
        return number_key(name)
    return norm_value(c, data_type, mode)


def normalize_names(df: DataFrame) -> DataFrame:
    """Trim and lower-case column names; names that become equal are an error."""
    names = [name.strip().lower() for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"column names differ only by case or padding: {clashes}")
    return df.toDF(*names)


def normalize_values(df: DataFrame, ignore: Iterable[str] = (), mode: str = "lenient") -> DataFrame:
    """Every column that is not ignored becomes a non-null string, in one projection."""
    skip = set(ignore)
    return df.select(
        *[
            F.col(f"`{f.name}`")
            if f.name in skip
            else norm_value(F.col(f"`{f.name}`"), f.dataType, mode).alias(f.name)
            for f in df.schema.fields
        ]
    )
