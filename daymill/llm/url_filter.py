"""Allow and block lists of canonical URLs: a blocked Bloom filter in front of an exact hash join.

A listed URL is a host and a path; it fits that host and its subdomains, for paths that begin with its path.  What an
address could be listed under follows from the list's shapes (labels of the host, length of the path), so an address has
a few candidates.  Each candidate picks one block of 256 bits by its hash and tests one bit in each of the block's
eight words.  The filter is bounded, so every task has it; candidates that pass, possible hits, meet the list itself in
a hash join, which removes the false ones.

Everything is SQL functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.llm.common import col, fresh, replace

#: Words of 32 bits in a block; a listed URL sets one bit in each.
WORDS = 8
#: Listed URLs meant for a block, 16 bits for each.
URLS_PER_BLOCK = 16
#: Blocks at most: 2 MB, the bound of what is broadcast.  A longer list has more false positives, which the join removes.
MOST_BLOCKS = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (``A-Z`` lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    start = F.locate("://", url)
    rest = F.when(F.coalesce(start, F.lit(0)) > 0, F.substring(url, start + F.lit(3), F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def labels(host: Column) -> Column:
    """Number of labels of a host."""
    return F.when(host == "", 0).otherwise(F.size(F.split(host, "\\.")))


def canonical(listed: DataFrame) -> DataFrame:
    """(host, path, verdict) of a list: hosts in lower case, null paths empty, one row for each pair.

    A pair listed both ways is blocked.  Rows without a host or verdict are left out.
    """
    tidy = listed.select(
        F.translate(col("host").cast("string"), UPPER, LOWER).alias("host"),
        F.coalesce(col("path").cast("string"), F.lit("")).alias("path"),
        F.lower(col("verdict").cast("string")).alias("verdict"),
    )
    kept = tidy.where((F.col("host") != "") & F.col("verdict").isin("allow", "block"))
    return kept.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def blocks_for(urls: int) -> int:
    """Blocks of a filter for a list of so many URLs."""
    return max(1, min(MOST_BLOCKS, -(-urls // URLS_PER_BLOCK)))


def _bits(host: Column, path: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a listed URL and its mask for each word of the block, one bit."""
    which = F.pmod(F.xxhash64(host, path), F.lit(blocks)).cast("int")
    hashed = F.xxhash64(path, F.lit("bits"), host)
    places = [F.shiftrightunsigned(hashed, 5 * w).bitwiseAND(F.lit(31)).cast("int") for w in range(WORDS)]
    return which, [F.call_function("shiftleft", F.lit(1), place) for place in places]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of a canonical list: ``block`` and its words ``w0`` to ``w7``, at most ``blocks`` rows."""
    which, masks = _bits(F.col("host"), F.col("path"), blocks)
    return listed.groupBy(which.alias("block")).agg(*[F.bit_or(m).alias(f"w{w}") for w, m in enumerate(masks)])


def possible(pairs: DataFrame, listed: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``pairs`` whose ``host`` and ``path`` the filter of ``listed`` lets pass: all that are listed, few others."""
    which, masks = _bits(F.col("host"), F.col("path"), blocks)
    # Bounded: MOST_BLOCKS rows of 9 ints.
    probed = pairs.withColumn("block", which).join(F.broadcast(bloom(listed, blocks)), "block")
    passed = reduce(lambda a, b: a & b, [F.col(f"w{w}").bitwiseAND(m) != 0 for w, m in enumerate(masks)])
    return probed.where(passed).select(*map(col, pairs.columns))


def candidates(host: Column, path: Column, shapes: Column) -> Column:
    """What an address may be listed under, for ``shapes`` (array of labels, length) of the list."""
    fitting = F.filter(shapes, lambda s: (s["labels"] <= labels(host)) & (s["length"] <= F.length(path)))
    return F.transform(
        fitting,
        lambda s: F.struct(
            F.call_function("substring_index", host, F.lit("."), -s["labels"]).alias("host"),
            F.substring(path, F.lit(1), s["length"]).alias("path"),
        ),
    )


def judge(pages: DataFrame, listed: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``listed`` has ``host``, ``path`` and ``verdict`` (allow or block).  The longest listed URL that fits decides (of
    two of one length the one with the longer host); ``rule`` is its host and path.  Where none fits, ``rule`` is null
    and the verdict is ``otherwise``.  All rows are kept, repeated ones too; input columns of the new names are
    replaced.  Null URLs and those without ``://`` have an empty host and path and fit nothing; a listed path that
    isn't empty never fits an empty one.  An empty list gives ``otherwise`` everywhere.
    """
    host, path = host_and_path(col(url).cast("string"))
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    taken = pages.select(*map(col, keep))
    h, p, out = fresh(taken, "url_host"), fresh(taken, "url_path"), fresh(taken, "best")
    parsed = pages.select(*map(col, keep), host.alias(h), path.alias(p))

    canon = canonical(listed)
    shapes = canon.agg(F.collect_set(F.struct(labels(F.col("host")).alias("labels"), F.length("path").alias("length"))).alias("shapes"))
    # Each address once: copies are folded before the shuffle.
    addresses = parsed.where(F.col(h) != "").select(F.col(h).alias("url_host"), F.col(p).alias("url_path")).distinct()
    given = addresses.withColumn("shapes", shapes.scalar()).withColumn("c", F.explode(candidates(F.col("url_host"), F.col("url_path"), F.col("shapes"))))
    pairs = given.select("url_host", "url_path", F.col("c.host").alias("host"), F.col("c.path").alias("path"))
    hits = possible(pairs, canon, blocks_for(canon.count())).join(canon, ["host", "path"])
    longest = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), F.concat("host", "path").alias("rule"), F.col("verdict"))
    best = hits.groupBy(F.col("url_host").alias(h), F.col("url_path").alias(p)).agg(F.max(longest).alias(out))

    new = {"host": F.col(h), "path": F.col(p), "rule": F.col(out)["rule"], "verdict": F.coalesce(F.col(out)["verdict"], F.lit(otherwise))}
    return replace(parsed.join(best, [h, p], "left"), new, keep)
