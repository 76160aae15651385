"""JSON text to declared columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import named

CORRUPT = "__corrupt"
REASONS = "reasons"
REASONS_TYPE = T.ArrayType(
    T.StructType([T.StructField("field", T.StringType()), T.StructField("reason", T.StringType())])
)


def decode_json(
    df: DataFrame,
    schema: T.StructType,
    value_col: str = "value",
    on_malformed: str = "keep",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Decode one JSON object per row into the columns of the schema.

    ``keep`` returns a row for every row: text that is no JSON object gives
    nulls, and so does a field of the wrong type. Unknown fields are left out.
    ``quarantine`` returns two tables: the rows that fit the schema, and the
    text of those that do not, as ``value``.
    """
    if on_malformed == "keep":
        record = F.from_json(named(value_col).cast("string"), schema)
        return df.select(record.alias("record")).select("record.*")
    if on_malformed == "quarantine":
        flagged = flag_malformed(df, schema, value_col)
        good = flagged.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        bad = flagged.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
        return good, bad
    raise ValueError(f"on_malformed must be 'keep' or 'quarantine', not {on_malformed!r}")


def flag_malformed(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Decode, with the text of a row that does not fit the schema in ``CORRUPT``."""
    return df.select(parse_once(named(value_col), schema).alias("record")).select("record.*")


def parse_once(value: Column, schema: T.StructType) -> Column:
    """A generator of one record per row, ``CORRUPT`` among its fields.

    A filter on a plain ``from_json`` column is pushed below it and parses the
    text a second time; it cannot be pushed below a generator.
    """
    flagged = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(value.cast("string"), flagged, {"columnNameOfCorruptRecord": CORRUPT})
    return F.explode_outer(F.array(record))


def with_reasons(
    df: DataFrame, schema: T.StructType, value_col: str = "value", primary: str | None = None
) -> DataFrame:
    """Why a text does not fit the schema, field by field, as an array ``reasons``.

    Meant for rows already found malformed: the text is read once more into the declared
    record, which keeps the fields that fit, and once into a VARIANT, which tells what was there
    for those that do not. An entry is ``(field, reason)``:

    * ``(null, 'empty')``: no text; ``(null, 'no JSON')``: cut off or something else;
      ``(null, 'no object')``: JSON, but a list or a plain value;
      ``(null, 'not readable')``: an object that fits no VARIANT, as with a name given twice;
    * ``(f, 'wrong type: <found>')``: the field is there and is no such value;
    * ``(primary, 'missing')`` and ``(primary, 'null')``, if ``primary`` is given.

    A text that fits gives an empty array.
    """
    text = named(value_col).cast("string")
    read = F.struct(
        F.from_json(text, schema).alias("record"),
        F.try_parse_json(text).alias("found"),
        F.get_json_object(text, "$").alias("json"),
    )
    # A generator, so that neither parse is repeated for every field.
    bound = df.select("*", F.explode_outer(F.array(read)).alias("__read"))
    record, found, json = (F.col(f"__read.{n}") for n in ("record", "found", "json"))
    kind = F.schema_of_variant(found)

    def entry(field: str | None, reason: Column) -> Column:
        return F.struct(F.lit(field).cast("string").alias("field"), reason.alias("reason"))

    held = found.try_cast("map<string, variant>")
    entries = []
    for f in schema.fields:
        there = F.try_element_at(held, F.lit(f.name))
        lost = there.isNotNull() & ~F.is_variant_null(there) & record[f.name].isNull()
        wrong = F.concat(F.lit("wrong type: "), F.regexp_extract(F.schema_of_variant(there), "^[A-Z]+", 0))
        entries.append(F.when(lost, entry(f.name, wrong)))
        if f.name == primary:
            entries.append(F.when(there.isNull(), entry(f.name, F.lit("missing"))))
            entries.append(F.when(F.is_variant_null(there), entry(f.name, F.lit("null"))))
    whole = (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", entry(None, F.lit("empty")))
        .when(found.isNull() & json.isNull(), entry(None, F.lit("no JSON")))
        .when(found.isNull(), entry(None, F.lit("not readable")))
        .when(~kind.startswith("OBJECT"), entry(None, F.lit("no object")))
    )
    fields = F.filter(F.array(*entries), lambda e: e.isNotNull())
    reasons = F.when(whole.isNotNull(), F.array(whole)).otherwise(fields)
    return bound.withColumn(REASONS, reasons.cast(REASONS_TYPE)).drop("__read")
