"""Mixing sources to target weights, in SQL functions only.

The words of each source are laid out document after document and packed into blocks of ``block_words``, fewer in a
small source; the last block of a source may be short.  The mix is a row of slots, one block each.  How many slots a
source gets is fixed by its target and by the words its blocks really hold: whole passes, then the blocks that come
nearest to what is left.  Which slots of which output shard they are is drawn without replacement (a pseudorandom
permutation deals the slots out), so the source counts of a shard are a multinomial draw that is held to the totals,
and each source hits its target to within half a block, one that is full exactly.  A
source's slots then go through a pseudorandom permutation of the source's block numbers, a fresh one for each pass over
the source, and are joined to the blocks by number.  Every draw is a hash of its place and the seed: a rerun, or a task
run again on another executor, gives the same mix.

Nothing is gathered per source: positions inside a source come from sums over small hashed groups of its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymill.llm.common import WORD, col, fresh, partitions, stored

#: Weights of the sources in code point order, repeating; null is the last source.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words asked for, as a share of all words.
SHARE = 1.5
#: A source is read so many times at most.
PASSES = 2
BLOCK_WORDS = 128
#: Blocks that a source's target, or the source if smaller, has at least; its blocks are cut smaller for it.
LEAST_BLOCKS = 16
SHARD_SLOTS = 4096
SEED = 42
#: Documents in a group whose positions one task adds up.
GROUP_ROWS = 2048
#: Rounds of the permutation.
ROUNDS = 16


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(index: Column, n: Column, *salt: Column, back: bool = False) -> Column:
    """``index`` moved by a pseudorandom permutation of 0..n-1 that ``salt`` selects (a swap-or-not network).

    Each round pairs x with key - x (mod n) and swaps the pair or not by a hash of its larger member: a bijection for
    any n, without a walk and without a table.  Each round undoes itself: ``back`` runs them in the other order, which
    gives the inverse.
    """

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(r, n, *salt), n) - x, n)
        swap = F.pmod(F.xxhash64(F.greatest(x, other), r, F.lit("swap"), *salt), F.lit(2)) == 1
        return F.when(swap, other).otherwise(x)

    first, last = (ROUNDS, 1) if back else (1, ROUNDS)
    return F.aggregate(F.sequence(F.lit(first), F.lit(last)), index.cast("long"), step)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(source, source_size) with ``target`` added.

    The sources share ``share`` of all words by weight.  No target exceeds ``passes`` times its source; what a full
    source can't take goes to the others by weight.  One row per source: the windows here run over sources, not data.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    given = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    most = given.withColumn("most", F.lit(float(passes)) * F.col("source_size")).withColumn("fill", F.col("most") / F.col("weight"))
    # Sources fill up in the order of most / weight; the level at which the rest share is set by the first that fits.
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (
        most.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("most").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).over(everything))
    )
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("level") * F.col("weight")))
    return level.select("source", "source_size", target.alias("target"))


@dataclass
class Mix:
    """``documents``: row columns, size, source_size, target, block_words of its source, first_word.  ``slots``: the
    mix, one row per slot.  ``takes``: (source, block, times)."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    takes: DataFrame


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> Mix:
    """Lays out, draws and joins; see the module's text.

    ``Mix.documents`` has ``key``, ``source`` and a hash of the two and the text (``mark``), with the size in words.  Null texts and
    texts without words have size 0.  Rows with equal keys are laid out by their text's hash; rows that are there
    twice are two stretches of words.
    """
    sized = stored(
        docs.select(col(key).alias("key"), col(source).cast("string").alias("source"), F.xxhash64(col(key), col(source), col(text)).alias("mark"), word_count(col(text)).alias("size")),
        "sizes",
    )
    wanted = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, passes)
    fitting = F.ceil(F.least(F.col("target"), F.col("source_size").cast("double")) / LEAST_BLOCKS)
    sources = stored(wanted.withColumn("block_words", F.least(F.lit(block_words).cast("long"), F.greatest(fitting, F.lit(1).cast("long")))), "sources")
    spread = sized.withColumn("group", F.pmod(F.xxhash64("key", "mark", F.lit(seed)), F.lit(max(1, sized.count() // GROUP_ROWS + 1))))
    sums = spread.groupBy("source", "group").agg(F.sum("size").alias("held"))
    before = F.sum("held").over(Window.partitionBy("source").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select(F.col("source").alias("of"), F.col("group").alias("in"), F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.sum("size").over(Window.partitionBy("source", "group").orderBy("key", "mark").rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        spread.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("group") == F.col("in")))
        .select("key", "source", "mark", "size", (F.col("start") + F.col("inside")).alias("first_word"))
    )
    documents = placed.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")

    # Slots: the whole mix is numbered source by source; the number of a source's slots follows its target.  Of the
    # last pass, the first ``more`` permuted blocks hold more * block_words words, less what the short block lacks.
    b, size = F.col("block_words"), F.col("source_size")
    held = sources.where("source_size > 0").withColumn("blocks", F.ceil(size / b)).withColumn("whole", F.floor(F.col("target") / size))
    held = held.withColumn("rest", F.col("target") - F.col("whole") * size).withColumn("lacks", F.col("blocks") * b - size)
    short = permuted(F.col("blocks") - 1, F.col("blocks"), F.lit(seed), F.col("source"), F.col("whole"), back=True)

    def off(more: Column) -> Column:
        return F.abs(more * b - F.when(more > F.col("short_at"), F.col("lacks")).otherwise(0) - F.col("rest"))

    fewer = held.withColumn("short_at", short).withColumn("fewer", F.least(F.floor(F.col("rest") / b), F.col("blocks")))
    tried = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.least(F.col("fewer") + i, F.col("blocks")))
    nearest = F.array_min(F.transform(tried, lambda more: F.struct(off(more).alias("off"), more.alias("more"))))["more"]
    blocks = fewer.select("source", "blocks", (F.col("whole") * F.col("blocks") + nearest).cast("long").alias("wanted"))
    up_to = blocks.withColumn("first_slot", F.sum("wanted").over(Window.orderBy(F.col("source").asc_nulls_last())) - F.col("wanted")).withColumn(
        "all_slots", F.sum("wanted").over(Window.partitionBy())
    )
    numbered = up_to.where("wanted > 0").select(
        "source", "blocks", "first_slot", "all_slots", "wanted", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("wanted") - 1) / SHARD_SLOTS))).alias("run")
    )
    dealt = numbered.repartition(partitions(docs), "source", "run").select(
        "source",
        "blocks",
        "first_slot",
        "all_slots",
        F.explode(F.sequence(F.col("run") * SHARD_SLOTS, F.least(F.col("wanted"), (F.col("run") + 1) * SHARD_SLOTS) - 1)).alias("number"),
    )
    place = permuted(F.col("first_slot") + F.col("number"), F.col("all_slots"), F.lit(seed), F.lit("slot"))
    turn = F.floor(F.col("number") / F.col("blocks"))
    slots = dealt.select(
        "source",
        place.alias("place"),
        turn.alias("pass"),
        permuted(F.pmod(F.col("number"), F.col("blocks")), F.col("blocks"), F.lit(seed), F.col("source"), turn).alias("block"),
    ).withColumn("shard", F.floor(F.col("place") / SHARD_SLOTS))
    takes = slots.groupBy("source", "block").agg(F.count("*").alias("times"), F.max("pass").alias("last_pass"), F.min("pass").alias("first_pass"))
    return Mix(documents, sources, slots, takes)


def stretches(mixed: Mix) -> DataFrame:
    """(key, source, mark, first_word, block, pass, from_word, to_word): the words of each document, counted from 0,
    that each drawn block takes; ``to_word`` is exclusive."""
    b = F.col("block_words")
    lying = mixed.documents.where("size > 0").select(
        "key",
        "source",
        "mark",
        "size",
        "first_word",
        "block_words",
        F.explode(F.sequence(F.floor(F.col("first_word") / b), F.floor((F.col("first_word") + F.col("size") - 1) / b))).alias("block"),
    )
    # The slots unfold from few rows and grow with the data: never a broadcast.
    drawn = mixed.slots.select(F.col("source").alias("of"), F.col("block").alias("number"), "pass", "shard", "place").hint("merge")
    joined = lying.join(drawn, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("number")))
    return joined.select(
        "key",
        "source",
        "mark",
        "first_word",
        "size",
        "block",
        "pass",
        "shard",
        "place",
        F.greatest(F.col("block") * b - F.col("first_word"), F.lit(0)).alias("from_word"),
        F.least((F.col("block") + 1) * b - F.col("first_word"), F.col("size")).alias("to_word"),
    )


def taken(mixed: Mix) -> DataFrame:
    """(key, source, mark, size, source_size, target, taken): words the mix takes of each document, repeats counted."""
    row = ["key", "source", "mark", "first_word", "size"]
    rows = mixed.documents.select(*row, "source_size", "target", F.lit(0).cast("long").alias("words"))
    nothing = F.lit(None).cast("long"), F.lit(None).cast("double")
    drawn = stretches(mixed).select(*row, *nothing, (F.col("to_word") - F.col("from_word")).alias("words"))
    counted = rows.where("size > 0").union(drawn).groupBy(*row).agg(F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("words").alias("taken"))
    out = ["key", "source", "mark", "size", "source_size", "target", "taken"]
    return counted.select(*out).union(rows.where("size = 0").withColumnRenamed("words", "taken").select(*out))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix as documents: for each pass over a source, each document with the words taken of it in that pass.

    Rows have the columns of ``docs``; ``text`` keeps the white space before each word taken, and is the whole text,
    unchanged, where all its words are taken.  A document of which nothing is taken, so any without words, is left
    out; one that is taken twice comes twice.  ``n_chars``, if there, is set anew.  Rows that agree in key, source and
    text are copies and get the other columns of one of them.
    """
    mark, cuts = fresh(docs, "mark"), fresh(docs, "cuts")
    mixed = mix(docs, key, text, source, **options)
    row = ["key", "source", "mark", "first_word", "size", "pass"]
    parts = stretches(mixed).groupBy(*row).agg(
        F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias("cuts"), F.sum(F.col("to_word") - F.col("from_word")).alias("words")
    )
    # One row per document and pass; a row that is there twice in docs has a stretch of its own for each.
    k, s, words, size = (fresh(docs, "its_" + c) for c in ("key", "source", "words", "size"))
    parts = parts.select(F.col("key").alias(k), F.col("source").alias(s), F.col("mark").alias(mark), F.col("cuts").alias(cuts), F.col("words").alias(words), F.col("size").alias(size))
    marked = docs.withColumn(mark, F.xxhash64(col(key), col(source), col(text))).repartition(F.col(mark))
    joined = marked.dropDuplicates([key, source, mark]).join(parts, mark)
    joined = joined.where(col(key).eqNullSafe(F.col(k)) & col(source).cast("string").eqNullSafe(F.col(s)))
    whole, listed = F.col(words) == F.col(size), fresh(docs, "listed_words")
    every = F.regexp_extract_all(col(text), F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    # A column of its own, read twice below: put into the lambda, the words would be cut anew for every stretch.
    joined = joined.withColumn(listed, F.when(~whole, every))
    picked = F.flatten(F.transform(cuts, lambda c: F.slice(F.col(listed), (c["from_word"] + 1).cast("int"), (c["to_word"] - c["from_word"]).cast("int"))))
    new = F.when(F.size(listed) > 0, F.array_join(picked, "")).otherwise(col(text))
    made = joined.select(*[new.alias(c) if c == text else col(c) for c in docs.columns])
    return made.withColumn("n_chars", F.length(col(text)).cast("long")) if "n_chars" in docs.columns else made
