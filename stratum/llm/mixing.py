"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sizes are words. Each source's target is its weight's share of all words; a target stops at
``max_epochs`` times the source's own words and the excess goes to the other sources by weight
until none is above. A source gives as many complete epochs as fit its target; the remainder is
a weighted sample without replacement: every document draws an exponential key divided by its
quality weight, and the smallest keys are taken, in order, while at least half of the next
document fits. So a source's taken words miss its target by half a document at most.

Scale: the measures of every row (source, key, size: some 30 bytes) are stored once. Logarithms of
keys are cut into ``BUCKETS`` ranges an e-fold, none of which holds more than 0.6 % of a source whatever its
weights (the density of the logarithm of an exponential number is 0.37 at most). One map-side-combined
sum by (source, bucket) finds the range in which each source's budget ends; only the measures in that
range are put in order, by range partitions with prefix sums, and give the first key that is not taken.
Texts are never sorted or shuffled. Sources themselves are numbered and filled by range partitions,
however many there are.

Defined cases: NULL or empty text has size 0 and takes 0; a NULL source is a source of its own
(last in order); a source without words has target 0, and no row is taken more than ``max_epochs`` times;
rows that repeat are rows of their own, ordered by their place in the scan; an empty table gives an empty result; other columns pass
through unless they use a result's name, which then holds the result.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import code_point_key, stored
from stratum.sources.incremental import page_numbers

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
BUCKETS = 64            # ranges of keys an e-fold
MAX_BROADCAST_SOURCES = 20_000   # beyond it the plan is joined by a shuffle
SEED = 20240601
SYMBOLS = b"#*$%&|<>!"
_P = "__mix_"           # prefix of working columns


@F.pandas_udf(T.StructType().add("size", T.LongType()).add("weight", T.DoubleType()))
def text_measures(texts: pd.Series) -> pd.DataFrame:
    """Words of each text, and its quality weight in (0, 1]: it falls with the share of table, list
    and mark-up symbols. NULL is the empty text."""
    data = [t.encode() if t else b"" for t in texts]
    symbols = [1 - len(d.translate(None, SYMBOLS)) / len(d) if d else 0.0 for d in data]
    return pd.DataFrame({"size": [len(d.split()) for d in data], "weight": [1 / (1 + 20 * s) for s in symbols]})


def uniform(*cols: Column, seed: int = SEED) -> Column:
    """A number in (0, 1) that depends on the row's values and the seed only."""
    top53 = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)
    return (top53.cast("double") + 0.5) / float(2 ** 53)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
                   share: float = 1.0) -> DataFrame:
    """(source, source_size) -> adds ``target``.

    Water filling without a loop: a source is capped when the scale at which it fills up
    (max_epochs * size / weight) lies below the final scale. Ordered by that value, the scale
    with the first k sources capped is (total - capped words) / (weight left); the first source
    whose own value reaches it, and all after it, are uncapped. Sources are numbered, and the
    values ordered, by range partitions with offsets, so no task holds them all.
    """
    key = sizes.select("source", "source_size", F.col("source").isNull().alias(_P + "null"),
                       code_point_key(F.col("source")).alias(_P + "key"))
    w = page_numbers(key, [_P + "null", _P + "key"]).withColumn(_P + "k", (F.col("row_no") - 1) % len(weights))
    weight = reduce(lambda e, kw: e.when(F.col(_P + "k") == kw[0], F.lit(float(kw[1]))),
                    list(enumerate(weights))[1:], F.when(F.col(_P + "k") == 0, F.lit(float(weights[0]))))
    w = (w.withColumn(_P + "w", weight)
         .withColumn(_P + "cap", F.lit(float(max_epochs)) * F.col("source_size")))
    final = F.lit(_final_scale(w, share)).cast("double")
    target = F.least(F.col(_P + "cap"), F.coalesce(F.col(_P + "w") * final, F.col(_P + "cap")))
    return w.select("source", "source_size", target.alias("target"))


def _final_scale(w: DataFrame, share: float) -> float | None:
    """The scale at which the uncapped sources take all that is left; None if every source is capped.

    Sums of a range of values, one row each, are added up first; then each range adds its own.
    """
    spark, fills = w.sparkSession, F.col(_P + "cap") / F.col(_P + "w")
    values = w.groupBy(fills.alias("fills")).agg(F.sum(_P + "cap").alias("cap"), F.sum(_P + "w").alias("w"),
                                                 F.sum("source_size").alias("size"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(values.repartitionByRange(n, "fills").withColumn("part", F.spark_partition_id()), "fills")
    ranges = ranged.groupBy("part").agg(*[F.sum(c).alias(c) for c in ("cap", "w", "size")]).toPandas().sort_values("part")
    total = float(ranges["size"].sum()) * float(share)
    ranges["before"] = ranges["cap"].cumsum() - ranges["cap"]
    ranges["after"] = ranges["w"].sum() - ranges["w"].cumsum()
    offsets = spark.createDataFrame(ranges[["part", "before", "after"]], "part int, before double, after double")
    order = Window.partitionBy("part").orderBy("fills")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    scale = (F.greatest(F.lit(0.0), F.lit(total) - F.col("before") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.col("after") + F.sum("w").over(after)))
    scaled = ranged.join(F.broadcast(offsets), "part").withColumn("scale", scale)
    # scales rise up to the first uncapped value and fall after it: its own is the largest
    return scaled.where("fills >= scale").agg(F.max("scale")).first()[0]


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0, seed: int = SEED) -> DataFrame:
    """``df`` with size, source_size, target, taken and copies (how often the row is taken)."""
    text, source = F.col(text_col), F.col(source_col)
    results = ["size", "source_size", "target", "taken", "copies"]
    chance = uniform(F.col(id_col), text, source, seed=seed)
    key, bucket = F.col(_P + "key"), F.col(_P + "bucket")
    rows = (df.withColumn(_P + "tie", F.xxhash64(F.monotonically_increasing_id()))
            .withColumn(_P + "text", text_measures(text)).withColumn(_P + "source", source)
            .withColumn(_P + "key", -F.log(chance) / F.col(_P + "text.weight"))
            .withColumn(_P + "size", F.col(_P + "text.size"))
            .withColumn(_P + "bucket", F.floor(F.log(key) * BUCKETS).cast("int")))
    narrow = stored(rows.select(*[_P + c for c in ("source", "bucket", "key", "tie", "size")]), "mix")
    plan = _small(_plan(narrow, weights, max_epochs, share))
    rows = rows.join(plan, F.col(_P + "source").eqNullSafe(F.col(_P + "at_source")), "left")
    edge, cut = F.col(_P + "edge"), F.col(_P + "cut")
    before = F.coalesce(F.struct(key.alias("key"), F.col(_P + "tie").alias("tie")) < cut, F.lit(True))
    copies = F.col(_P + "epochs") + ((bucket < edge) | ((bucket == edge) & before)).cast("int")
    return rows.select(*[rows[f"`{c}`"] for c in df.columns if c not in results],
                       F.col(_P + "size").alias("size"), F.col(_P + "words").alias("source_size"),
                       F.col(_P + "target").alias("target"),
                       (F.col(_P + "size") * copies).cast("long").alias("taken"),
                       copies.cast("int").alias("copies"))


def _small(plan: DataFrame) -> DataFrame:
    """The plan as a broadcast table if it has few enough sources, checked; else as it is."""
    head = plan.take(MAX_BROADCAST_SOURCES + 1)
    if len(head) > MAX_BROADCAST_SOURCES:
        return plan
    return F.broadcast(plan.sparkSession.createDataFrame(head, plan.schema))


def _plan(narrow: DataFrame, weights, max_epochs: int, share: float) -> DataFrame:
    """Per source: complete epochs, the bucket in which the rest ends, and the (key, tie) that is the
    first one not taken there (NULL: all of that bucket are taken)."""
    sums = stored(narrow.groupBy(_P + "source", _P + "bucket").agg(F.sum(_P + "size").alias("n")), "sums")
    sizes = sums.groupBy(F.col(_P + "source").alias("source")).agg(F.sum("n").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs, share)
    words, target = F.col("source_size"), F.col("target")
    epochs = F.when(words > 0, F.floor(target / words + 1e-12)).otherwise(0).cast("long")
    targets = (targets.withColumn(_P + "epochs", epochs)
               .withColumn(_P + "rest", target - words * F.col(_P + "epochs")))
    upto = Window.partitionBy(_P + "source").orderBy(_P + "bucket")
    running = sums.withColumn(_P + "upto", F.sum("n").over(upto))
    found = running.join(targets, F.col(_P + "source").eqNullSafe(F.col("source")))
    # The edge is the first bucket whose running sum exceeds the rest (beyond the last: none is), or none
    # at all where not even half a word is left.
    over = F.col(_P + "upto") > F.col(_P + "rest")
    edge = F.min(F.when(over, F.struct(F.col(_P + "bucket").alias("b"),
                                       (F.col(_P + "rest") - (F.col(_P + "upto") - F.col("n"))).alias("l"))))
    ends = (found.groupBy(F.col("source").alias(_P + "at_source"), F.col("source_size").alias(_P + "words"),
                          F.col("target").alias(_P + "target"), _P + "epochs", _P + "rest")
            .agg(edge.alias("e"))
            .select(_P + "at_source", _P + "words", _P + "target", _P + "epochs",
                    F.when(F.col(_P + "rest") < 0.5, F.lit(-2 ** 31))
                    .otherwise(F.coalesce("e.b", F.lit(2 ** 31 - 1))).alias(_P + "edge"),
                    F.coalesce("e.l", F.lit(0.0)).alias(_P + "left")))
    ends = stored(ends, "ends")
    cuts = _cuts(narrow, ends)
    return (ends.join(cuts, F.col(_P + "at_source").eqNullSafe(F.col(_P + "cut_source")), "left")
            .drop(_P + "cut_source", _P + "left"))


def _cuts(narrow: DataFrame, ends: DataFrame) -> DataFrame:
    """Per source the first (key, tie) of its edge bucket of which less than half fits what is left.

    The rows of the edge buckets are put in order by range partitions; the sums of each source in
    each partition, one row each, give the sum before the partition.
    """
    at = (F.col(_P + "source").eqNullSafe(F.col(_P + "at_source"))) & (F.col(_P + "bucket") == F.col(_P + "edge"))
    close = narrow.join(_small(ends.select(_P + "at_source", _P + "edge", _P + "left")), at)
    order = [code_point_key(F.col(_P + "source")), F.col(_P + "key"), F.col(_P + "tie")]
    ranged = stored(close.select(_P + "source", _P + "key", _P + "tie", _P + "size", _P + "left")
                    .repartitionByRange(*order).withColumn(_P + "part", F.spark_partition_id()), "edges")
    sums = ranged.groupBy(_P + "source", _P + "part").agg(F.sum(_P + "size").alias("n"))
    earlier = Window.partitionBy(_P + "source").orderBy(_P + "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(_P + "source").alias("s"), F.col(_P + "part").alias("p"),
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy(_P + "part", _P + "source").orderBy(_P + "key", _P + "tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.withColumn(_P + "inside", F.coalesce(F.sum(_P + "size").over(inside), F.lit(0)))
    placed = placed.join(offsets, F.col(_P + "source").eqNullSafe(F.col("s")) & (F.col(_P + "part") == F.col("p")))
    fails = F.col("offset") + F.col(_P + "inside") + F.col(_P + "size") / 2 > F.col(_P + "left")
    found = placed.groupBy(F.col(_P + "source").alias(_P + "cut_source")).agg(
        F.min(F.when(fails, F.struct(F.col(_P + "key").alias("key"), F.col(_P + "tie").alias("tie")))).alias("first_out"),
        F.max(F.when(~fails, F.col(_P + "key"))).alias("last_in"))
    # places in a scan matter only where rows of one key are cut apart: none of a key is taken else
    tie = F.when(F.col("last_in") == F.col("first_out.key"), F.col("first_out.tie")).otherwise(F.lit(-2 ** 63))
    cut = F.when(F.col("first_out").isNotNull(), F.struct(F.col("first_out.key").alias("key"), tie.alias("tie")))
    return found.select(_P + "cut_source", cut.alias(_P + "cut"))
