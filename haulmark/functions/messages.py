"""JSON messages: binary value to typed columns, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.schemas import POINT

# Fixed value: ISO-8601 with six fractional digits and no zone.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parsed(messages: DataFrame, schema: T.StructType, *, corrupt: str | None = None) -> DataFrame:
    """Columns of ``schema`` read from the JSON text in a binary ``value``.

    Permissive: text that is no JSON object gives a row of nulls, a field of the
    wrong type is null by itself, unknown keys are ignored. With ``corrupt`` the
    text of such rows is kept in a column of that name. Times without a zone are
    in the session zone.
    """
    options = {}
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    data = F.from_json(F.col("value").cast("string"), schema, options)
    return messages.select(data.alias("data")).select("data.*")


def encoded(frame: DataFrame) -> DataFrame:
    """One JSON message per row in a binary ``value``. Null fields are left out."""
    text = json_text(F.struct(*frame.columns))
    return frame.select(text.cast("binary").alias("value"))


def json_text(record: Column) -> Column:
    return F.to_json(
        record, {"timestampFormat": ISO_MICROS, "timestampNTZFormat": ISO_MICROS}
    )


def point_in(text: Column) -> Column:
    """The ``{lat, lng}`` object in a text; null when the text holds none.

    Plain place names are not parsed, since each would raise an error inside the
    parser. ``nullif`` keeps the parse to one per row; a condition on the fields
    would repeat it.
    """
    nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in POINT])
    of_object = F.when(F.ltrim(text).startswith("{"), text)
    return F.nullif(F.from_json(of_object, POINT), nothing)
