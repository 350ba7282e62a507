"""Bucket and key expressions, hex numbers, payload words, hash lists, encryption."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions.values import col

# --- fixed values: accounts so busy that each has a bucket of its own ---
BUSY_ACCOUNT_BUCKETS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}


def hash_bucket(c: str | Column, buckets: int = 128, fixed: Mapping[str, str] | None = None) -> Column:
    """Four-digit bucket from the last three hex digits of the md5.

    ``fixed`` gives known hot keys (compared in lower case) a bucket of
    their own, so that they do not crowd a hashed one.
    """
    text = col(c).cast("string")
    tail = F.conv(F.right(F.md5(text), F.lit(3)), 16, 10).cast("int")
    hashed = F.lpad((tail % buckets).cast("string"), 4, "0")
    if not fixed:
        return hashed
    table = F.create_map(*[F.lit(x) for pair in fixed.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(text)), hashed)


def row_key(
    fields: Sequence[str | Column],
    hashed: Sequence[bool] | None = None,
    separator: str = "",
    hash_whole: bool = False,
) -> Column:
    """Composite key: chosen fields md5-hashed, joined, optionally hashed again."""
    flags = hashed or [False] * len(fields)
    parts = [
        F.md5(col(f).cast("string")) if flag else col(f).cast("string")
        for f, flag in zip(fields, flags, strict=True)
    ]
    key = F.concat_ws(separator, *parts)
    return F.md5(key) if hash_whole else key


def _hex_digits(c: str | Column) -> Column:
    """Significant digits of a ``0x`` number."""
    text = F.lower(col(c))
    return F.ltrim(F.substring(text, F.lit(3), F.length(text)), F.lit("0"))


def hex_overflow(c: str | Column, bits: int = 112) -> Column:
    """True when a ``0x`` number needs more than ``bits`` bits."""
    wide = F.length(_hex_digits(c)) > bits // 4
    return F.coalesce(F.lower(col(c)).startswith("0x") & wide, F.lit(False))


def hex_amount(c: str | Column, in_units: bool = False) -> Column:
    """Number from decimal text or ``0x`` hex text; null gives 0.

    ``in_units`` divides by 10**18.  A decimal holds 38 digits, so hex numbers
    are exact up to 112 bits; wider ones give null here, :func:`hex_overflow`
    marks them and :func:`hex_text` has all their digits.  Numbers that fit a long, as most do, take a
    short way.
    """
    text, digits = F.lower(col(c)), _hex_digits(c)
    is_hex = text.startswith("0x")
    padded = F.lpad(digits, 28, "0")
    high, low = (F.conv(F.substring(padded, at, 14), 16, 10).cast("decimal(17,0)") for at in (1, 15))
    short = F.conv(digits, 16, 10).cast("bigint")
    is_short = is_hex & (F.length(digits) <= 15) & (F.length(digits) > 0)
    wide_hex = F.when(~hex_overflow(c), high * F.lit(16**14).cast("decimal(17,0)") + low)
    if not in_units:
        kind = "decimal(38,4)"
        return (
            F.when(text.isNull(), F.lit(0).cast(kind))
            .when(is_short, short.cast(kind))
            .when(is_hex, wide_hex.cast(kind))
            .otherwise(text.try_cast(kind))
        )
    kind, unit = "decimal(38,18)", 10**18
    step = F.lit("0.000000000000000001").cast("decimal(18,18)")

    def shifted(units: Column, rest: Column) -> Column:
        # Split at 10**18 first: a direct decimal division would drop digits.
        return (units.cast("decimal(18,0)") + rest.cast("decimal(18,0)") * step).cast(kind)

    per_unit = F.lit(unit).cast("decimal(19,0)")
    wide = F.when(is_hex, wide_hex.cast("decimal(36,0)")).otherwise(text.try_cast("decimal(36,0)"))
    rest = wide % per_unit
    short_rest = short % F.lit(unit)
    return (
        F.when(text.isNull(), F.lit(0).cast(kind))
        .when(is_short & (short < unit), shifted(F.lit(0), short_rest))
        .otherwise(shifted((wide - rest) / per_unit, rest))
    )


def hex_text(c: str | Column) -> Column:
    """Exact decimal digits of a ``0x`` number of any width, as text; null for other text.

    The number is built up in limbs of nine decimal digits, six hex digits at a time.
    """
    digits, limb, step = _hex_digits(c), 10**9, 16**6
    count = F.ceil(F.length(digits) / 6).cast("int")
    padded = F.lpad(digits, count * 6, F.lit("0"))
    groups = F.transform(
        F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.conv(F.substring(padded, i * 6 + 1, F.lit(6)), 16, 10).cast("bigint"),
    )
    empty = F.array().cast("array<bigint>")

    def add(limbs: Column, group: Column) -> Column:  # limbs * 16**6 + group, lowest limb first
        def carry(so_far: Column, value: Column) -> Column:
            total = value * step + so_far["over"]
            return F.struct(
                F.floor(total / limb).cast("bigint").alias("over"), F.concat(so_far["out"], F.array(total % limb)).alias("out")
            )

        start = F.struct(group.alias("over"), empty.alias("out"))
        return F.aggregate(
            limbs, start, carry, lambda s: F.concat(s["out"], F.when(s["over"] > 0, F.array(s["over"])).otherwise(empty))
        )

    limbs = F.reverse(F.aggregate(groups, empty, add))
    text = F.ltrim(F.array_join(F.transform(limbs, lambda x: F.lpad(x.cast("string"), 9, "0")), ""), F.lit("0"))
    return F.when(F.lower(col(c)).rlike("^0x[0-9a-f]*$"), F.when(text == "", "0").otherwise(text))


def split_words(c: str | Column, width: int = 64) -> Column:
    """Whole ``width``-digit words after the ``0x`` prefix, each prefixed again.

    The number of words is the text length, prefix included, divided by the
    width, so an incomplete last word is left out.
    """
    text = col(c)
    count = F.floor(F.length(text) / F.lit(width)).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    words = F.transform(starts, lambda i: F.concat(F.lit("0x"), F.substring(text, i * width + 3, F.lit(width))))
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, words).otherwise(F.array().cast("array<string>"))


def append_hash_list(df: DataFrame, key: str, item: str, seq: str) -> DataFrame:
    """Items per key with their place in the list, one row for each.

    A key may own any number of items, so its list is rows, not an array;
    read it ordered by ``seq``.  An item that arrives again at its place is
    kept once, so appending is adding rows.
    """
    return df.select(key, F.col(seq).alias("seq"), F.col(item).alias("item")).distinct()


def encrypt_columns(df: DataFrame, columns: Sequence[str], secret: Column) -> DataFrame:
    """AES-256-GCM: 12-byte nonce, ciphertext, 16-byte tag, as base64 text.

    ``secret`` is a 32-byte binary column expression; callers take it from
    the environment or a secret store.
    """
    return df.withColumns({c: F.base64(F.aes_encrypt(F.col(c).cast("string"), secret, F.lit("GCM"))) for c in columns})


def decrypt_columns(df: DataFrame, columns: Sequence[str], secret: Column) -> DataFrame:
    return df.withColumns(
        {c: F.aes_decrypt(F.unbase64(F.col(c)), secret, F.lit("GCM")).cast("string") for c in columns}
    )
