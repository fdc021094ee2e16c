"""Mixing sources to target weights with a low-discrepancy schedule.

Each source gets a share of all words by its weight, at most ``most`` times its own
words; what is over goes to the others by weight. The mix is a sequence of slots, and
a source has as many as its target has blocks of ``block`` words, the last one cut at
the target, so every source meets its target to the word, however small it is. The
slots' points are those of the golden ratio, moved to multiples of 1 / slots: slot i
has point i * g mod slots, with g near slots / phi and prime to it, so each point occurs
once. Points go through the sources' cumulative numbers of slots, which spreads
every source evenly over the sequence. Slots are ranked per source, and the r-th slot
of a source takes the r-th block of words of its documents, which lie end to end in
shuffled order, over again when they run out.

DataFrame functions only; one number, that of the slots, comes to the driver. Shuffled
order is by MD5 of seed and id, so reruns agree. A source's points are made from its
own numbers, without looking any up. Running sums and ranks are taken in two steps,
within buckets and over buckets, so a source with a third of all rows is never sorted
in one task. The table of sources has one row per source.

Results for unusual input: null text has size 0, and a document of size 0 takes
nothing; a source without words has target 0; a null source is a source of its own,
ranked last; a null id is shuffled as an empty one; rows of one id are documents of
their own, in no defined order among themselves, which does not matter as equal rows
are alike; an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetide.llm.common import stored

#: The golden ratio less one, as a fraction of 2**64.
GOLDEN, ONE = 11400714819323198485, 1 << 64
#: Steps that are looked at on both sides; prime ones are never that far apart.
NEAR = 500
#: Slots whose ranks are counted together, and buckets of the shuffled order.
CHUNK, BUCKETS = 1 << 16, 1 << 12


def word_count(text: Column) -> Column:
    """Runs of bytes that are not ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per source its number in order, its words and its target.

    With the sources in order of words per weight, those up to some place are held
    at ``most`` times their words, and the rest share what is left by weight.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int")
    )
    sources = sources.withColumn("weight", weight).withColumn("place", F.row_number().over(named))
    full = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    after = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    held = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    share = (F.sum("source_size").over(everything) - held) / F.sum("weight").over(after)
    sources = sources.withColumn("share", share).withColumn("cap", F.col("source_size") * most)
    open_ = F.col("share") * F.col("weight") < F.col("cap")
    # the first source that is not held sets the level for all that follow it
    first = F.min(F.when(open_, F.struct("rank", "share"))).over(everything)["share"]
    sources = sources.withColumn("rank", F.row_number().over(full)).withColumn("level", first)
    target = F.when(
        F.col("level").isNull() | (F.col("level") * F.col("weight") >= F.col("cap")), F.col("cap").cast("double")
    ).otherwise(F.col("level") * F.col("weight"))
    return sources.select("source", "place", "source_size", target.alias("target"))


def _step(slots: int) -> int:
    """A number prime to ``slots`` near ``slots / phi``. Of the ``NEAR`` next ones it is
    that whose continued fraction over ``slots`` has the smallest terms, as the golden
    ratio's are, which keeps the points even at all lengths."""
    near = max(1, slots * GOLDEN // ONE)
    around = sorted(range(max(1, near - NEAR), min(slots, near + NEAR) + 1), key=lambda g: abs(g - near))
    return min((g for g in around if gcd(g, slots) == 1), key=lambda g: _terms(g, slots))


def _terms(low: int, high: int) -> list[int]:
    """Terms of ``low / high`` as a continued fraction, largest first."""
    terms = []
    while low:
        terms.append(high // low)
        low, high = high % low, low
    return sorted(terms, reverse=True)


def _blocks(targeted: DataFrame, block: int) -> DataFrame:
    """Whole words of each target, and the slots they fill."""
    words = F.floor(F.col("target") + 0.5).cast("long")
    return targeted.withColumn("words", words).withColumn("blocks", F.ceil(words / block).cast("long"))


def schedule(targeted: DataFrame, block: int) -> DataFrame:
    """Slots in order: ``slot``, the ``place`` of its source, its ``rank`` there."""
    blocks = _blocks(targeted, block).where("blocks > 0")
    slots = blocks.agg(F.sum("blocks")).first()[0] or 0
    # point p is that of slot p * inverse mod slots
    inverse = pow(_step(slots), -1, slots) if slots > 1 else 1
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sources = blocks.select("place", "blocks", F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("first"))
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / CHUNK)))
    some = sources.withColumn("some", chunks).repartition("place", "some")
    low = F.col("some") * CHUNK
    low, high = F.col("first") + low, F.col("first") + F.least(low + CHUNK, F.col("blocks")) - 1
    points = some.select("place", F.explode(F.sequence(low, high)).alias("point"))
    wide = F.col("point").cast("decimal(19,0)") * F.lit(inverse).cast("decimal(19,0)") % F.lit(max(slots, 1)).cast("decimal(19,0)")
    slot = wide.cast("long") if slots >= 1 << 31 else F.col("point") * inverse % max(slots, 1)
    placed = points.select("place", slot.alias("slot")).withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    counts = placed.groupBy("place", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("place").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("place", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("place", "chunk").orderBy("slot")
    ranked = placed.withColumn("within", F.row_number().over(within) - 1).join(offsets, ["place", "chunk"])
    return ranked.select("slot", "place", (F.col("offset") + F.col("within")).alias("rank"))


def source_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    block: int = 1024,
    seed: str = "mix",
) -> DataFrame:
    """Per document its words, its source's words and target, and the words the mix takes."""
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    sized = stored(sized, "sized")  # the texts are read and counted once
    targeted = _blocks(targets(sized, weights, most), block)
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = sized.withColumn("digest", digest).withColumn("bucket", F.conv(F.substring("digest", 1, 3), 16, 10).cast("int"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("of"), "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    ).join(targeted, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    within = Window.partitionBy("source", "bucket").orderBy("digest", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = rows.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).alias("r").join(
        offsets.alias("o"),
        F.col("r.source").eqNullSafe(F.col("o.source")) & (F.col("r.bucket") == F.col("o.bucket")),
    )
    laid = laid.select(
        "doc_id", "size", "source_size", "target", F.col("words").alias("wanted"), "place", (F.col("offset") + F.col("within")).alias("start"), "digest"
    )
    rounds = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    turns = laid.where("size > 0").withColumn("round", rounds).withColumn(
        "at", F.col("start") + F.col("round") * F.col("source_size")
    )
    last = F.floor((F.col("at") + F.col("size") - 1) / block)
    parts = turns.withColumn("rank", F.explode(F.sequence(F.floor(F.col("at") / block), last)))
    low, high = F.col("rank") * block, (F.col("rank") + 1) * block
    words = F.least(high, F.col("at") + F.col("size"), F.col("wanted")) - F.greatest(low, F.col("at"))
    slots = schedule(targeted, block).select("place", "rank", "slot")
    met = parts.withColumn("words", words).join(slots, ["place", "rank"], "left")
    keys = ["place", "start", "doc_id", "size", "source_size", "target"]
    used = F.when(F.col("slot").isNotNull(), F.greatest(F.col("words"), F.lit(0))).otherwise(0)
    taken = met.groupBy(*keys).agg(F.sum(used).alias("taken"))
    none = laid.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return taken.select(*columns).unionByName(none.select(*columns))
