"""Text checks and the deny-list flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions.values import col

# --- fixed value: characters a clean label may hold ---
ALLOWED_CHARACTERS = (
    "^[一-龥a-zA-Z0-9\\[\\]\\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)\"]+$"
)


def is_blank(c: str | Column) -> Column:
    """Null, empty or nothing but characters up to the space."""
    return F.coalesce(F.regexp_replace(col(c), "[\\x00-\\x20]+", "") == "", F.lit(True))


def is_allowed(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike(ALLOWED_CHARACTERS), F.lit(False))


def capitalise_first(c: str | Column) -> Column:
    return F.concat(F.upper(F.substring(col(c), 1, 1)), F.substring(col(c), F.lit(2), F.length(col(c))))


def lowercase_first(c: str | Column) -> Column:
    return F.concat(F.lower(F.substring(col(c), 1, 1)), F.substring(col(c), F.lit(2), F.length(col(c))))


def list_to_text(c: str | Column, separator: str = ", ") -> Column:
    """Null list gives null; elements are joined in order."""
    return F.when(col(c).isNotNull(), F.concat_ws(separator, col(c)))


def sensitive_word_flag(texts: DataFrame, words: DataFrame, key: str, text: str, word: str = "word") -> DataFrame:
    """Which texts hold words of the deny list.

    Whole texts are cut into distinct lower-case words inside the row.  The
    list is joined as a table, and only words on it pass the join; their hits
    are then attached to the texts.  Spark broadcasts the list while it is
    small and shuffles by word when it is not.
    """
    tokens = F.array_distinct(F.split(F.lower(F.col(text)), "[^\\p{L}\\p{N}]+"))
    listed = words.select(F.lower(F.col(word)).alias("token")).distinct()
    hits = (
        texts.select(F.col(key).alias("__key"), F.explode(tokens).alias("token"))
        .join(listed, "token")
        .groupBy("__key", "token")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("__key")
        .agg(F.sum("n").alias("hits"), F.array_join(F.sort_array(F.collect_list("token")), ",").alias("found"))
    )
    return (
        texts.select(key)
        .distinct()
        .join(hits, F.col(key).eqNullSafe(F.col("__key")), "left")
        .select(key, F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"), F.coalesce("found", F.lit("")).alias("found"))
        .withColumn("flagged", F.col("hits") > 0)
    )
