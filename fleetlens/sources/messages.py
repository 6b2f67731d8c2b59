"""JSON text in a ``value`` column to rows, and back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from ..functions.time import iso_text, parse_clock, parse_time

_CORRUPT = "_corrupt_record"
_TEXT = "_text"
_TIMES = (TimestampType, TimestampNTZType)


def decode(messages: DataFrame, schema: StructType, on_error: str = "drop",
           value: str = "value") -> DataFrame:
    """Rows of ``schema`` from JSON objects.

    A missing field is NULL. Messages without a value carry no row. Otherwise:

    ``fail``  any text that does not fit the schema stops the query;
    ``drop``  text that is not a JSON object is skipped, a field that does not
              convert becomes NULL;
    ``keep``  as ``drop``, but skipped text comes out as an all-NULL row with the
              text in ``_corrupt_record``.

    Times are ISO-8601 text. A number, a year or a clock time alone is none: it
    stops the query in ``fail`` and is NULL otherwise.
    """
    text = F.col(value)
    names = [f.name for f in schema.fields]
    columns = [_from_wire(f, on_error == "fail") for f in schema.fields]
    schema = StructType([StructField(f.name, StringType() if isinstance(f.dataType, _TIMES) else f.dataType)
                         for f in schema.fields])
    if on_error == "fail":
        # from_json takes blank text for NULL in every mode.
        solid = F.when(F.trim(text) == "", F.raise_error(F.lit("blank message"))).otherwise(text)
        parsed = F.from_json(solid, schema, {"mode": "FAILFAST"})
        return _kept(messages, parsed, lambda row: row.isNotNull()).select(*columns)
    if on_error not in ("drop", "keep"):
        raise ValueError(f"unknown on_error: {on_error!r}")

    with_corrupt = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    parsed = F.from_json(text, with_corrupt, {"mode": "PERMISSIVE",
                                              "columnNameOfCorruptRecord": _CORRUPT})

    # The corrupt column is also set when one field does not convert; only those
    # rows are looked at again, to see whether the text is an object at all.
    def is_object(corrupt: Column) -> Column:
        return corrupt.isNull() | (F.get_json_object(text, "$").isNotNull()
                                   & F.ltrim(text).startswith("{"))

    if on_error == "drop":
        rows = _kept(messages, parsed,
                     lambda row: row.isNotNull() & is_object(row.getField(_CORRUPT)))
        return rows.select(*columns)
    # Blank text has no row, and is neither an object nor NULL.
    rows = (messages.where(text.isNotNull())
            .select(text.alias(_TEXT), F.inline_outer(F.array(parsed))))
    text = F.col(_TEXT)
    whole = is_object(F.col(_CORRUPT)) & (F.trim(text) != "")
    return rows.select(*[F.when(whole, column).alias(name) for name, column in zip(names, columns)],
                       F.when(~whole, text).alias(_CORRUPT))


def _from_wire(field: StructField, strict: bool) -> Column:
    """A field with its type, times from their text."""
    text = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, _TIMES):
        return text
    time = parse_time(text) if isinstance(field.dataType, TimestampType) else parse_clock(text)
    if strict:
        wrong = F.raise_error(F.concat(F.lit(f"MALFORMED time in {field.name}: "), text))
        time = F.when(text.isNotNull() & time.isNull(), wrong.cast(field.dataType)).otherwise(time)
    return time.alias(field.name)


def _kept(messages: DataFrame, parsed: Column, wanted: Callable[[Column], Column]) -> DataFrame:
    """The fields of ``parsed`` where it is ``wanted``.

    A ``where`` on the parsed row would be moved below the projection and parse
    every message twice; filtering a one-element array parses once.
    """
    return messages.select(F.inline(F.filter(F.array(parsed), wanted)))


def encode(rows: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """One JSON object per row, in ``value``. Instants become ISO-8601 text."""

    def on_wire(field: StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            column = iso_text(column)
        elif isinstance(field.dataType, TimestampNTZType):
            column = iso_text(column, suffix="")
        return column.alias(field.name)

    return to_messages(rows.select(F.struct(*[on_wire(f) for f in rows.schema.fields]).alias("r")),
                       "r", keep_nulls)


def to_messages(rows: DataFrame, record: str | Column, keep_nulls: bool = True) -> DataFrame:
    """``value`` text from a struct column or expression."""
    column = F.col(record) if isinstance(record, str) else record
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return rows.select(F.to_json(column, options).alias("value"))
