"""Names that no alias lists: the nearest alias by edit distance.

Blocking keeps this from comparing all names with all aliases. Names are cut
into overlapping pieces of ``GRAM`` characters (the ends padded, equal pieces
numbered). One edit changes at most ``GRAM`` of them, so of any ``GRAM`` x d + 1
pieces of a name one at least is also in every alias within d edits. The rarest
pieces among the aliases are taken: few aliases share them, and none within
reach is missed. Lengths and ``levenshtein`` decide over the candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitrend.config import ENTITY
from epitrend.functions.names import normalized_name
from epitrend.functions.sizing import broadcast_if_bounded
from epitrend.session import checkpoint_root

GRAM = 3
MAX_EDITS = 3      # edits at most ...
EDIT_SHARE = 4     # ... and one for so many characters of the name


def name_grams(key: Column, size: int = GRAM) -> Column:
    """The padded pieces of a normalised name, equal ones numbered."""
    padded = F.concat(F.repeat(F.lit("^"), F.lit(size - 1)), key, F.repeat(F.lit("$"), F.lit(size - 1)))
    cut = F.transform(F.sequence(F.lit(1), F.char_length(padded) - (size - 1)),
                      lambda i: F.substring(padded, i, F.lit(size)))
    count = lambda parts, i: F.size(F.filter(F.slice(parts, F.lit(1), i + 1), lambda g: g == F.get(parts, i)))
    return F.transform(cut, lambda g, i: F.concat(g, F.lit("#"), count(cut, i).cast("string")))


def allowed_edits(key: Column, max_edits: int = MAX_EDITS, share: int = EDIT_SHARE) -> Column:
    """Edits that a name of this length may be off: none under ``share`` characters."""
    return F.least(F.lit(max_edits), F.floor(F.char_length(key) / share)).cast("int")


def match_names(names: DataFrame, aliases: DataFrame, entity: str = ENTITY, alias_col: str = "alias",
                code_col: str = "code", max_edits: int = MAX_EDITS, share: int = EDIT_SHARE) -> DataFrame:
    """``entity, code, status, distance, candidates`` for every distinct name.

    ``status`` is ``exact`` (the normalised name is an alias), ``approximate`` (the
    nearest aliases within the allowed edits have one code), ``ambiguous`` (they
    have several: ``code`` is null and ``candidates`` lists them) or ``unmatched``.
    A null name is unmatched. Aliases that normalise alike keep the smallest code,
    as in ``country_codes``."""
    if share <= GRAM:
        raise ValueError(f"share must be over {GRAM}: shorter names have too few pieces to block on")
    checkpoint_root(names.sparkSession)
    known = aliases.select(normalized_name(alias_col).alias("_alias"), F.col(code_col).alias("_code")) \
        .where("_alias <> ''").groupBy("_alias").agg(F.min("_code").alias("_code")).checkpoint(eager=True)
    each = names.select(F.col(entity).alias("_name")).distinct().withColumn("_key", normalized_name("_name"))
    looked = each.join(known, F.col("_key") == F.col("_alias"), "left").checkpoint(eager=True)
    rest = looked.where("_code is null and _key is not null").select("_key").distinct() \
        .withColumn("_edits", allowed_edits(F.col("_key"), max_edits, share)).where("_edits > 0")
    held = known.select("_alias", "_code", F.explode(name_grams(F.col("_alias"))).alias("_gram"))
    common = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_often"))
    rarest = Window.partitionBy("_key").orderBy("_often", "_gram")
    probes = rest.select("_key", "_edits", F.explode(name_grams(F.col("_key"))).alias("_gram")) \
        .join(common, "_gram", "left").withColumn("_often", F.coalesce("_often", F.lit(0))) \
        .withColumn("_r", F.row_number().over(rarest)).where(F.col("_r") <= GRAM * F.col("_edits") + 1)
    pairs = probes.join(held, "_gram") \
        .where(F.abs(F.char_length("_key") - F.char_length("_alias")) <= F.col("_edits")) \
        .select("_key", "_edits", "_alias", "_code").distinct()
    near = pairs.withColumn("_d", F.levenshtein("_key", "_alias")).where(F.col("_d") <= F.col("_edits"))
    best = near.groupBy("_key", "_d").agg(F.sort_array(F.collect_set("_code")).alias("_codes")) \
        .groupBy("_key").agg(F.min_by(F.struct("_d", "_codes"), "_d").alias("_best"))
    found = looked.join(best, "_key", "left")
    codes, exact = F.col("_best._codes"), F.col("_code").isNotNull()
    return found.select(
        F.col("_name").alias(entity),
        F.when(exact, F.col("_code")).when(F.size(codes) == 1, F.get(codes, F.lit(0))).alias("code"),
        F.when(exact, "exact").when(F.size(codes) == 1, "approximate").when(F.size(codes) > 1, "ambiguous")
        .otherwise("unmatched").alias("status"),
        F.when(exact, F.lit(0)).otherwise(F.col("_best._d")).cast("int").alias("distance"),
        F.when(exact, F.array("_code")).otherwise(codes).alias("candidates"))


def approximate_codes(df: DataFrame, aliases: DataFrame, entity: str = ENTITY, out: str = "Country_clean",
                      max_names: int = 200_000, **how) -> DataFrame:
    """``df`` with ``out``, the code that ``match_names`` finds for ``entity``; rows
    are kept whatever is found. The names' table is broadcast when it has at most
    ``max_names`` rows, else joined by shuffle."""
    codes = match_names(df, aliases, entity, **how).select(F.col(entity).alias("_found"), F.col("code").alias(out))
    codes = broadcast_if_bounded(codes.where("_found is not null"), max_names, materialize=True)
    return df.join(codes, F.col(entity) == F.col("_found"), "left").drop("_found")
