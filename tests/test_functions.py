import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from daymill.functions import days, keys, text, values


def one(spark, expr, **cols):
    schema = ", ".join(f"{n} {t}" for n, (t, _) in cols.items()) or "x int"
    data = [tuple(v for _, v in cols.values())] if cols else [(0,)]
    return spark.createDataFrame(data, schema).select(expr.alias("r")).first()["r"]


def test_hash_bucket_matches_definition(spark):
    names = ["a", "b", "Customer#1", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", keys.hash_bucket("n", 128).alias("b"))
    for r in df.collect():
        assert r["b"] == f"{int(hashlib.md5(r['n'].encode()).hexdigest()[-3:], 16) % 128:04d}"
    hot = keys.hash_bucket("n", 128, keys.BUSY_ACCOUNT_BUCKETS)
    assert one(spark, hot, n=("string", "0xDAC17F958D2EE523A2206206994597C13D831EC7")) == "9002"
    assert one(spark, hot, n=("string", None)) is None


def test_row_key(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    plain = df.select(keys.row_key(["a", "b"], [False, True], "|").alias("k")).first()["k"]
    assert plain == "1|" + md5("x")
    assert df.select(keys.row_key(["a", "b"], [False, True], "|", True).alias("k")).first()["k"] == md5(plain)


def test_hex_amount(spark):
    def amount(v, **kw):
        return one(spark, keys.hex_amount("v", **kw), v=("string", v))

    assert amount("0xff") == 255 and amount("0XFF") == 255 and amount("0x0") == 0 and amount("0x") == 0
    assert amount(None) == 0 and amount("12.5") == Decimal("12.5")
    assert amount("0x" + "f" * 16) == 2**64 - 1
    assert amount("0x" + "f" * 28) == 2**112 - 1
    assert amount("0x1" + "0" * 28) is None  # 113 bits: flagged, never wrapped
    assert one(spark, keys.hex_overflow("v"), v=("string", "0x1" + "0" * 28)) is True
    assert one(spark, keys.hex_overflow("v"), v=("string", "0x000" + "f" * 28)) is False
    assert amount(hex(15 * 10**17), in_units=True) == Decimal("1.5")
    assert amount(hex(10**18 + 1), in_units=True) == Decimal("1.000000000000000001")
    assert amount(hex(123456789 * 10**18 + 7), in_units=True) == Decimal("123456789.000000000000000007")
    assert amount(None, in_units=True) == 0 and amount(str(3 * 10**18), in_units=True) == 3
    assert amount("junk") is None


def test_hex_text_has_all_digits(spark):
    values = [0, 1, 10**9, 2**64 - 1, 2**112, 2**120 + 12345, 2**256 - 1, 10**70, 16**6, 16**12 * 999_999_999]
    df = spark.createDataFrame([(hex(v),) for v in values] + [("0x",), ("0x" + "0" * 50 + "ff",), ("12",), (None,), ("0xzz",)], "v string")
    assert [r[0] for r in df.select(keys.hex_text("v")).collect()] == [*map(str, values), "0", "255", None, None, None]


def test_split_words(spark):
    word = "ab" * 32
    split = lambda v: one(spark, keys.split_words("v"), v=("string", v))
    assert split("0x" + word + "cd" * 32) == ["0x" + word, "0x" + "cd" * 32]
    assert split("0x" + word + "12") == ["0x" + word]
    assert split("0x12") == [] and split("") == [] and split(None) == []


def test_append_hash_list_is_one_row_per_item(spark, rows):
    df = spark.createDataFrame([("k", i, f"h{i}") for i in range(25)] + [("j", 3, "x"), ("j", 3, "x")], "k string, seq long, h string")
    out = rows(keys.append_hash_list(df, "k", "h", "seq"))
    assert len(out) == 26 and ("j", 3, "x") in out and ("k", 24, "h24") in out


def test_encryption_layout_and_round_trip(spark):
    secret = F.unhex(F.sha2(F.lit("test"), 256))
    df = spark.createDataFrame([("abc",), (None,), ("",)], "t string")
    stored = keys.encrypt_columns(df, ["t"], secret)
    assert stored.select(F.length(F.unbase64("t"))).first()[0] == 12 + 3 + 16
    assert [r["t"] for r in keys.decrypt_columns(stored, ["t"], secret).collect()] == ["abc", None, ""]


def test_windows(spark, rows):
    day = dt.date(2024, 1, 30)
    df = spark.createDataFrame([(day - dt.timedelta(days=n),) for n in (0, 6, 7, 29, 30, -1)], "dt date")
    got = rows(days.in_windows(df, day).groupBy("recent_days").count())
    assert got == [(1, 1), (30, 4), (7, 2)]
    assert days.window_start("20240130", 7) == dt.date(2024, 1, 24)


def test_times(spark):
    ms = one(spark, days.millis_to_timestamp("v"), v=("string", "1704067200123"))
    assert ms == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert one(spark, days.millis_to_timestamp("v"), v=("string", "soon")) is None
    week = lambda d: one(spark, days.iso_week("v"), v=("date", dt.date.fromisoformat(d)))
    assert week("2021-01-01") == "2020-53" and week("2024-12-30") == "2025-01" and week("2024-02-01") == "2024-05"


def test_day_range(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 27), dt.date(2024, 3, 1))], "a date, b date")
    assert [r["day"] for r in days.day_range(df, "a", "b").collect()] == [20240227, 20240228, 20240229, 20240301]


def test_values(spark):
    assert one(spark, values.ratio("a", "b", 4), a=("long", 1), b=("long", 3)) == 0.3333
    assert one(spark, values.ratio("a", "b", 4), a=("long", 1), b=("long", 0)) is None
    amount = ("decimal(16,2)", Decimal("3235649.13"))
    assert one(spark, values.decimal_ratio("a", "b"), a=amount, b=("long", 14)) == Decimal("231117.80")
    assert one(spark, values.mask_name("a"), a=("string", "Bob")) == "B*"
    phone = values.hash_if_valid("a", values.PHONE_PATTERN)
    assert one(spark, phone, a=("string", "13912345678")) == hashlib.md5(b"13912345678").hexdigest()
    assert one(spark, phone, a=("string", "12912345678")) is None


def test_text_checks(spark):
    blank = lambda v: one(spark, text.is_blank("v"), v=("string", v))
    assert blank(None) and blank("") and blank(" \t\n") and not blank(" a ")
    allowed = lambda v: one(spark, text.is_allowed("v"), v=("string", v))
    assert allowed("价格abc-1") and not allowed("a b") and not allowed("") and not allowed(None)
    assert one(spark, text.capitalise_first("v"), v=("string", "abC")) == "AbC"
    assert one(spark, text.lowercase_first("v"), v=("string", "ABC")) == "aBC"
    assert one(spark, text.list_to_text("v"), v=("array<string>", ["a", "b"])) == "a, b"
    assert one(spark, text.list_to_text("v"), v=("array<string>", None)) is None


def test_sensitive_words_read_the_whole_text(spark, rows):
    long = "clean " * 50_000 + "Secret"
    df = spark.createDataFrame([(1, "a secret, SECRET key"), (2, "nothing"), (3, None), (4, long)], "id int, t string")
    words = spark.createDataFrame([("secret",), ("key",), ("Secret",)], "word string")
    out = text.sensitive_word_flag(df, words, "id", "t")
    assert rows(out, "id", "hits", "found", "flagged") == [
        (1, 2, "key,secret", True), (2, 0, "", False), (3, 0, "", False), (4, 1, "secret", True),
    ]
