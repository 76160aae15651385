"""Batch jobs that make lookup tables, names and sample records.

Each job is a function of DataFrames. ``run_jobs`` runs a list of them from a
configuration, reading and writing files.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_plain_word, named, sentinel_number, strip_marker, title_pair
from ..operators import (
    most_common,
    n_rarest,
    row_id,
    sample_uniform,
    sample_weighted,
    translate,
    zip_rows,
)

# Fixed values of the source tables.
DISORDER = "(disorder)"
COUNTRIES = ("E92000001", "W92000004")  # England and Wales
PSEUDO_MARKER = "(pseudo) "
SEXES = ("boy", "girl")


def code_frequency(
    codes: DataFrame,
    description: str = "Description",
    usage: str = "Usage",
    marker: str = DISORDER,
    sentinel: str = "*",
) -> DataFrame:
    """``(disease, usage)`` for the codes whose description ends with the marker.

    The marker and the blank before it are taken out of the text; the sentinel
    stands for a usage too small to publish and counts as 1.
    """
    return codes.where(named(description).endswith(marker)).select(
        strip_marker(named(description), " " + marker).alias("disease"),
        sentinel_number(named(usage), sentinel).alias("usage"),
    )


def place_dimensions(
    postcodes: DataFrame,
    cities: DataFrame,
    regions: DataFrame,
    countries: tuple[str, ...] = COUNTRIES,
) -> tuple[DataFrame, DataFrame]:
    """``(city, region)`` and ``(postcode, city)`` from postcodes and two code tables.

    A city gets the region most of its postcodes are in, counted over all of
    them; only postcodes in use, without an end of term, are listed.
    """
    region_names = regions.select(
        "RGN20CD", strip_marker(F.col("RGN20NM"), PSEUDO_MARKER).alias("RGN20NM")
    )
    wanted = postcodes.where(F.col("ctry").isin(*countries))
    placed = translate(wanted, "ttwa", "city", cities, "TTWA11CD", "TTWA11NM")
    regional = translate(placed, "rgn", "region", region_names, "RGN20CD", "RGN20NM")
    # The list of postcodes needs no region, so it does not join for one.
    in_use = placed.where(F.col("doterm").isNull())
    return (
        most_common(regional, "city", "region"),
        in_use.select(F.col("pcds").alias("postcode"), "city"),
    )


def rare_names(names: DataFrame, number: int) -> DataFrame:
    """``forename``: the rarest names, half of them of each sex.

    A name is as common as in its best year; with an odd number the first sex
    has one more. A name that both sexes have can come twice.
    """
    shares = dict(zip(SEXES, (math.ceil(number / 2), math.floor(number / 2))))
    return n_rarest(names, "sex", "name", "percent", shares).select(
        F.col("name").alias("forename")
    )


def compound_names(
    nouns: DataFrame,
    noun: str,
    number: int,
    seed: int | str,
    key: str | None = None,
    algorithm: str = "xxhash64",
) -> DataFrame:
    """``surname``: two independent samples of plain nouns, put side by side.

    ``key`` names the column that identifies a row, the noun itself by default;
    give one when a noun occurs in several rows, so that each row has its own
    chance to be drawn.
    """
    plain = nouns.where(is_plain_word(named(noun)))

    def sample(part: str) -> DataFrame:
        drawn = sample_uniform(plain, number, key or noun, f"{seed}:{part}", algorithm)
        order = _draw_order(f"{seed}:{part}", key or noun)
        return drawn.select(named(noun).alias(part), order.alias(f"{part}_order"))

    zipped = zip_rows(
        sample("first"), sample("second"), ["first_order"], ["second_order"], at_most=number
    )
    return zipped.select(title_pair(F.col("first"), F.col("second")).alias("surname"))


def assemble_records(
    forenames: DataFrame,
    surnames: DataFrame,
    places: DataFrame,
    diseases: DataFrame,
    number: int,
    seed: int | str,
    algorithm: str = "xxhash64",
    keys: dict[str, str] | None = None,
) -> DataFrame:
    """Sample records: names and places drawn evenly, diseases by their usage.

    ``(patient_id, patient_name, city, postcode, disease)``, numbered from 0.

    Rows are drawn by ``forename``, ``surname``, ``postcode`` and ``disease``. Where
    one of these occurs in several rows, name a column in ``keys`` that tells its rows
    apart, such as ``{"forename": "row"}``: rows of one key come or stay away together.
    """
    keys = keys or {}

    def numbered(sample: DataFrame, name: str, *columns: str) -> DataFrame:
        order = _draw_order(f"{seed}:{name}", keys.get(name, name))
        ranked = row_id(sample, order, name="patient_id", at_most=number)
        return ranked.select(name, *columns, "patient_id")

    def evenly(table: DataFrame, name: str, *columns: str) -> DataFrame:
        key = keys.get(name, name)
        drawn = sample_uniform(table, number, key, f"{seed}:{name}:draw", algorithm)
        return numbered(drawn, name, *columns)

    by_usage = sample_weighted(
        diseases, number, keys.get("disease", "disease"), "usage", f"{seed}:disease:draw", algorithm
    )
    parts = [
        evenly(forenames, "forename"),
        evenly(surnames, "surname"),
        evenly(places, "postcode", "city"),
        numbered(by_usage, "disease"),
    ]
    records = parts[0]
    for part in parts[1:]:
        records = records.join(part, "patient_id")
    return records.select(
        F.col("patient_id").cast("int").alias("patient_id"),
        F.concat("forename", F.lit(" "), "surname").alias("patient_name"),
        "city",
        "postcode",
        "disease",
    )


def _draw_order(seed: str, key: str) -> Column:
    """A random order of a sample, the same one for the same seed."""
    return F.md5(F.concat_ws(":", F.lit(seed), named(key).cast("string")))


# --- running jobs from a configuration --------------------------------------


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, or CSV with a header line when the name says so."""
    if path.endswith(".csv"):
        return spark.read.option("header", "true").option("escape", '"').csv(path)
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    """One JSON object per line, null fields written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _code_frequency(spark, input, output):
    write_parquet(code_frequency(read_any(spark, input)), output)


def _place_dimensions(
    spark,
    nspl_fact_table_filename,
    ttwa_dimension_filename,
    rgn20cd_dimension_filename,
    city_table_output,
    region_table_output,
):
    city_region, postcode_city = place_dimensions(
        read_any(spark, nspl_fact_table_filename).select("ctry", "pcds", "doterm", "rgn", "ttwa"),
        read_any(spark, ttwa_dimension_filename).select("TTWA11CD", "TTWA11NM"),
        read_any(spark, rgn20cd_dimension_filename).select("RGN20CD", "RGN20NM"),
    )
    write_parquet(city_region, region_table_output)
    write_parquet(postcode_city, city_table_output)


def _rare_names(spark, input, number, output):
    names = read_any(spark, input).withColumn("percent", F.col("percent").cast("double"))
    write_parquet(rare_names(names, number), output)


def _compound_names(spark, input, number, output, noun="noun", seed=0, key=None):
    write_parquet(compound_names(read_any(spark, input), noun, number, seed, key), output)


def _assemble_records(
    spark,
    number,
    city_filename,
    snomed_filename,
    forenames_filename,
    surnames_filename,
    output,
    seed=0,
):
    records = assemble_records(
        read_any(spark, forenames_filename),
        read_any(spark, surnames_filename),
        read_any(spark, city_filename),
        read_any(spark, snomed_filename),
        number,
        seed,
    )
    write_ndjson(records, output)


# The job names a configuration uses.
JOBS: dict[str, Callable[..., None]] = {
    "snomed_transform": _code_frequency,
    "postcode_transform": _place_dimensions,
    "forenames_transform": _rare_names,
    "surnames_transform": _compound_names,
    "sample_data_transform": _assemble_records,
}


def run_jobs(spark: SparkSession, config: dict | str) -> list[str]:
    """Run the jobs listed under ``transform``, in order; returns their names.

    All names are looked up before the first job starts, since later jobs read
    what earlier ones wrote.
    """
    if isinstance(config, str):
        config = json.loads(Path(config).read_text(encoding="utf-8"))
    listed = [(entry["function"], entry["params"]) for entry in config["transform"]]
    for name, _ in listed:
        if name not in JOBS:
            raise ValueError(f"no job named {name!r}, only {sorted(JOBS)}")
    for name, params in listed:
        JOBS[name](spark, **params)
    return [name for name, _ in listed]
