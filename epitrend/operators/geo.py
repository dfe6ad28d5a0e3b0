"""Entity names to three-letter codes."""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitrend.config import ENTITY, MEASURES
from epitrend.functions.names import normalized_name
from epitrend.functions.sizing import broadcast_if_bounded


def listed_aliases() -> list[tuple[str, str]]:
    """(name, alpha-3 code) as the data files list them: common names of
    countries, and spellings that daily reports use (``report_spellings.csv``)."""
    rows = []
    for name in ("iso3166_alpha3.csv", "report_spellings.csv"):
        with open(os.path.join(os.path.dirname(os.path.dirname(__file__)), "data", name), encoding="utf-8", newline="") as fh:
            rows += [(r["alias"], r["code"]) for r in csv.DictReader(fh)]
    return rows


def locale_names(spark: SparkSession) -> list[tuple[str, str]]:
    """(English name, alpha-3 code) of every ISO 3166-1 country that the JVM
    knows: 249 of them."""
    locale = spark._jvm.java.util.Locale
    countries = [locale("", c) for c in locale.getISOCountries()]
    return [(c.getDisplayCountry(locale.ENGLISH), c.getISO3Country()) for c in countries]


def iso_aliases(spark: SparkSession) -> DataFrame:
    """``alias, code``: ISO 3166-1 alpha-3 codes of all 249 countries under the
    JVM's English names, common names and spellings of daily reports. Names that
    no country has (ships, ``Others``, ``Channel Islands``) stay without a code; add
    yours by a union with a table of your own."""
    rows = dict.fromkeys([*listed_aliases(), *locale_names(spark)])
    return spark.createDataFrame(list(rows), "alias string, code string")


def country_codes(df: DataFrame, aliases: DataFrame, entity: str = ENTITY,
                  alias_col: str = "alias", code_col: str = "code",
                  out: str = "Country_clean", max_aliases: int = 200_000) -> DataFrame:
    """Add ``out`` = code of ``entity`` looked up in ``aliases`` (alias ->
    code) on a normalised name; no match gives null (such rows are kept;
    map views skip them). Measures become long, as in the reference's map
    table. Aliases that normalise to the same key keep the smallest code.

    The alias table is a reference list of names; it is broadcast when it has
    at most ``max_aliases`` rows, else joined by shuffle."""
    table = (aliases.select(normalized_name(alias_col).alias("_key"), F.col(code_col))
             .groupBy("_key").agg(F.min(code_col).alias(out)))
    table = broadcast_if_bounded(table, max_aliases, materialize=True)
    keyed = df.withColumn("_key", normalized_name(entity))
    joined = keyed.join(table, "_key", "left").drop("_key")
    measures = [m for m in (*MEASURES, "Active") if m in df.columns]
    return joined.withColumns({m: F.col(m).cast("long") for m in measures})


def rename_entities(df: DataFrame, aliases: DataFrame, entity: str = ENTITY,
                    alias_col: str = "alias", name_col: str = "name",
                    max_aliases: int = 200_000) -> DataFrame:
    """Replace ``entity`` by the canonical ``name`` of a matching alias
    (normalised key, e.g. spelling variants and typos of a country name);
    names without an alias stay as they are. Apply before ``daily_rollup`` so
    the variants are summed under one name."""
    table = (aliases.select(normalized_name(alias_col).alias("_key"), F.col(name_col))
             .groupBy("_key").agg(F.min(name_col).alias("_canonical")))
    table = broadcast_if_bounded(table, max_aliases, materialize=True)
    keyed = df.withColumn("_key", normalized_name(entity))
    joined = keyed.join(table, "_key", "left")
    return joined.withColumn(entity, F.coalesce(F.col("_canonical"), F.col(entity))).drop(
        "_key", "_canonical").select(*df.columns)
