"""Message codec: keyed JSON encode, lenient decode against a declared schema,
and the dead-letter split.

Lenient decode semantics (per message / per field):
  * a message that is not a JSON object (malformed text, empty, ``null``, an
    array, a scalar, a NULL value) is invalid -> dead letter, never a table row;
  * inside a valid object a field that cannot be read as its declared type is
    NULL and its neighbours survive; missing fields are NULL; extra fields are
    ignored; numeric text ("1.5", "7") is read as the number.

Implementation: ``try_parse_json`` to a VARIANT once per message, cast to the
declared struct with ``try_variant_get`` -- JVM-side expressions, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from tidewater.functions.timefn import format_iso_local, parse_iso_local

VARIANT_COL = "_v"
VALID_COL = "_valid"
ERROR_COL = "_error"

# Dead-letter reasons.
ERR_NULL = "null message"
ERR_MALFORMED = "malformed JSON"
ERR_NOT_OBJECT = "not a JSON object"


def wire_type(schema: StructType) -> StructType:
    """The declared schema as read off the wire: timestamps arrive as text."""
    return StructType([StructField(f.name, StringType() if isinstance(f.dataType, (TimestampType, TimestampNTZType))
                                   else f.dataType) for f in schema.fields])


def record(value: Column, schema: StructType) -> Column:
    """One message -> the declared record, or NULL when the message is not a JSON
    object.  Casting the parsed VARIANT to the whole struct applies the lenient
    rules field by field (a bad field is NULL, its neighbours survive)."""
    return F.try_variant_get(F.try_parse_json(value), "$", wire_type(schema).simpleString())


def is_record(value: Column, schema: StructType) -> Column:
    """True when the message decodes to ``schema`` (i.e. is a JSON object)."""
    return record(value, schema).isNotNull()


def _typed_fields(schema: StructType) -> list[Column]:
    out = []
    for f in schema.fields:
        if isinstance(f.dataType, TimestampType):
            out.append(parse_iso_local(f.name).alias(f.name))
        elif isinstance(f.dataType, TimestampNTZType):
            out.append(parse_iso_local(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            out.append(F.col(f.name))
    return out


def _one_or_none(c: Column) -> Column:
    """Emit 0 or 1 rows per input row.  Used instead of a Filter: Catalyst pushes a
    Filter on a computed column below the projection that computes it, which
    would parse every message twice."""
    return F.inline(F.array_compact(F.array(c)))


def decode_valid(df: DataFrame, schema: StructType, value_col: str = "value",
                 keep: tuple[str, ...] = ("key", "topic", "partition", "offset")) -> DataFrame:
    """Valid messages only: (kept envelope columns, declared fields...).  Each
    message is parsed exactly once."""
    kept = [c for c in keep if c in df.columns]
    with_rec = df.select(*kept, record(F.col(value_col), schema).alias("_r"))
    row = F.when(F.col("_r").isNotNull(), F.struct(*[F.col(c) for c in kept], F.col("_r")))
    return with_rec.select(_one_or_none(row)).select(*kept, "_r.*").select(*kept, *_typed_fields(schema))


def _error_text(value: Column, variant: Column, rec: Column) -> Column:
    return (F.when(value.isNull(), F.lit(ERR_NULL))
            .when(variant.isNull(), F.lit(ERR_MALFORMED))
            .when(rec.isNull(), F.lit(ERR_NOT_OBJECT)))


def dead_letters(df: DataFrame, schema: StructType, value_col: str = "value",
                 keep: tuple[str, ...] = ("key", "topic", "partition", "offset")) -> DataFrame:
    """Invalid messages only: (kept envelope columns, value, error)."""
    kept = [c for c in keep if c in df.columns]
    parsed = df.select(*kept, F.col(value_col).alias("value"), F.try_parse_json(F.col(value_col)).alias(VARIANT_COL))
    v = F.col(VARIANT_COL)
    err = _error_text(F.col("value"), v, F.try_variant_get(v, "$", wire_type(schema).simpleString()))
    row = F.when(err.isNotNull(), F.struct(*[F.col(c) for c in kept], F.col("value"), err.alias("error")))
    return parsed.select(_one_or_none(row))


def decode(df: DataFrame, schema: StructType, value_col: str = "value",
           keep: tuple[str, ...] = ("key", "topic", "partition", "offset")) -> DataFrame:
    """Every message with ``_valid`` and ``_error`` plus the declared fields (NULL
    for invalid messages), for callers that route both kinds from one frame."""
    kept = [c for c in keep if c in df.columns]
    parsed = df.select(*kept, F.col(value_col), F.try_parse_json(F.col(value_col)).alias(VARIANT_COL))
    v = F.col(VARIANT_COL)
    with_rec = parsed.select(*kept, value_col, v,
                             F.try_variant_get(v, "$", wire_type(schema).simpleString()).alias("_r"))
    err = _error_text(F.col(value_col), v, F.col("_r"))
    flat = with_rec.select(*kept, value_col, err.alias(ERROR_COL), "_r.*")
    return flat.select(*kept, value_col, F.col(ERROR_COL).isNull().alias(VALID_COL), ERROR_COL,
                       *_typed_fields(schema))


def valid_rows(decoded: DataFrame, schema: StructType,
               keep: tuple[str, ...] = ("key", "topic", "partition", "offset")) -> DataFrame:
    kept = [c for c in keep if c in decoded.columns]
    return decoded.where(F.col(VALID_COL)).select(*kept, *[f.name for f in schema.fields])


def split_dead_letters(decoded: DataFrame, value_col: str = "value") -> DataFrame:
    """Dead letters out of a :func:`decode` frame."""
    kept = [c for c in ("key", "topic", "partition", "offset") if c in decoded.columns]
    return decoded.where(~F.col(VALID_COL)).select(
        *kept, F.col(value_col).alias("value"), F.col(ERROR_COL).alias("error"))


def payload_struct(df: DataFrame, schema: StructType, ts_format: bool = True) -> Column:
    """struct(...) of the declared payload fields in declared order; timestamps are
    written as ISO-8601 local text with microseconds."""
    parts = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)) and ts_format:
            c = format_iso_local(c)
        parts.append(c.alias(f.name))
    return F.struct(*parts)


def encode_keyed_json(df: DataFrame, schema: StructType, key_field: str,
                      keep_nulls: bool = True) -> DataFrame:
    """(payload columns) -> (key, value): the keyed JSON message of each row.
    NULL fields are written as explicit ``null`` when ``keep_nulls``."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return df.select(F.col(key_field).cast("string").alias("key"),
                     F.to_json(payload_struct(df, schema), opts).alias("value"),
                     *[c for c in df.columns if c not in {f.name for f in schema.fields}])


def partition_by_key(df: DataFrame, num_partitions: int, key: str = "key") -> DataFrame:
    """Same key -> same partition (hash partitioning on the message key)."""
    return df.repartition(num_partitions, F.col(key))
