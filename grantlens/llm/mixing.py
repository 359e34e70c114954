"""Mixing sources to target weights by whole copies and Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, table

#: Steps of the sampling order whose sizes are summed before rows are looked at one by one.
BINS = 4096
#: Halvings of the interval in which the scale of a source's inclusion odds is sought.
HALVINGS = 60
#: Documents after the cut of which one may close the gap that is left.
NEXT = 64

#: Sources (about 100 bytes each) up to which their table is broadcast; beyond, joins shuffle and split hot sources.
BROADCAST_SOURCES = 100_000


def source_targets(sizes: DataFrame, copies: float = 3.0, share: float = 1.0) -> DataFrame:
    """Adds weight, target (words) to one row for each source: (source, source_size).

    Sources in code-point order, null last, weigh 1, 2, 3, 1, 2, 3, ... and share `share` of all sizes. A target stops
    at `copies` times the source's size; what is over goes to the others by weight. With sources in order of
    size / weight this needs one pass: a source is held at its limit exactly if the level that those before it leave
    is above its own.
    """
    every = Window.partitionBy(F.lit(0))
    upto = Window.partitionBy(F.lit(0)).orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("_limit").over(upto), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    )
    ranked = (
        sizes.withColumn("_rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", (F.col("_rank") % 3 + 1).cast("long"))
        .withColumn("_limit", F.col("source_size") * F.lit(float(copies)))
        .withColumn("_ratio", F.col("_limit") / F.col("weight"))
        .withColumn("_level", level)
        .withColumn("_held", F.col("_level") >= F.col("_ratio"))
    )
    free = F.min(F.when(~F.col("_held"), F.struct("_ratio", "_rank", "_level"))).over(every)
    target = F.when(F.col("_held"), F.col("_limit")).otherwise(free["_level"] * F.col("weight"))
    return ranked.withColumn("target", F.least(target, F.col("_limit"))).select(
        "source", "source_size", "weight", "target"
    )


def size_class(size: Column) -> Column:
    """0, 1, 2, ... for sizes 0, 1, 2-3, 4-7, ..."""
    return F.floor(F.log2(size + F.lit(1.0))).cast("int")


def odds_of(of_class: Column) -> Column:
    """Inclusion odds, up to a scale, of a size class: longer documents are likelier, by half from one word to 32."""
    return 1 + of_class * F.lit(0.1)


def odds_scale(classes: Column, rest: Column) -> Column:
    """The scale c for which the expected words, the sum of words * p with p / (1 - p) = c * odds, are `rest`.

    classes is an array of (odds, words): some 40 entries at most for a source.
    """

    def words(c: Column) -> Column:
        part = lambda acc, x: acc + x["words"] * (c * x["odds"]) / (1 + c * x["odds"])
        return F.aggregate(classes, F.lit(0.0), part)

    def halve(acc: Column, _: Column) -> Column:
        mid = (acc["low"] + acc["high"]) / 2
        less = words(F.exp(mid)) < rest
        return F.struct(F.when(less, mid).otherwise(acc["low"]).alias("low"), F.when(less, acc["high"]).otherwise(mid).alias("high"))

    start = F.struct(F.lit(-60.0).alias("low"), F.lit(60.0).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, halve, lambda acc: F.exp((acc["low"] + acc["high"]) / 2))


def per_source(small: DataFrame) -> DataFrame:
    """A table with one row for each source, for joins: broadcast if it is shown to be small, else as it is."""
    small = materialize(small, "mix-sources")
    return F.broadcast(small) if small.count() <= BROADCAST_SOURCES else small


def mix(sized: DataFrame, seed: int = 9, copies: float = 3.0, share: float = 1.0) -> DataFrame:
    """sized (doc_id, source, size, any more columns) with source_size, target and copies (int).

    Every document of a source first gets the whole copies that are certain, floor(target / source_size). For the
    rest, inclusion probabilities p are unequal: p / (1 - p) is proportional to `odds_of` the document's size class,
    scaled so that the expected words are those still wanted. Documents are ranked by (u / (1 - u)) / (p / (1 - p))
    with u from a hash of seed and doc_id (Pareto order sampling); the sample is of fixed size in words: the ranking is
    taken up to the words that are still wanted. As documents differ in size, that leaves a gap: of the next 64
    documents those that still fit are added in their order, and then the one that best closes the gap if that brings
    the total nearer. Reruns agree, and no document gets more than `copies` copies (rounded up).

    Sources are summed in 4096 steps of the ranking first, so that only the step in which the cut falls is sorted:
    a source with a third of all rows is never gathered. Null sources form one source; null sizes count as 0; repeated
    rows are separate rows with one rank; a source of size 0 has target 0 and gets no copies; an empty table stays
    empty. Columns named source_size, target or copies are replaced.
    """
    kept = [c for c in sized.columns if c not in ("source_size", "target", "copies")]
    rows = sized.select(*kept).withColumn("size", F.coalesce("size", F.lit(0)).cast("long"))
    key = [F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_n")]
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = F.col("target") / F.col("source_size")
    want = (
        source_targets(sizes, copies, share)
        .withColumn("_per", F.when(F.col("source_size") > 0, per).otherwise(0.0))
        .withColumn("_whole", F.floor("_per").cast("int"))
        .withColumn("_p", F.col("_per") - F.col("_whole"))
        .select(*key, "source_size", "target", "_whole", "_p", (F.col("_p") * F.col("source_size")).alias("_rest"))
    )
    words = rows.groupBy(*key, size_class(F.col("size")).alias("_c")).agg(F.sum("size").alias("words"))
    listed = F.sort_array(F.collect_list(F.struct(odds_of(F.col("_c")).alias("odds"), "words")))
    words = words.groupBy("_s", "_n").agg(listed.alias("_classes"))
    want = want.join(words, ["_s", "_n"]).withColumn("_scale", odds_scale(F.col("_classes"), F.col("_rest"))).drop("_classes")
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    odds = (u / (1 - u)) / (F.col("_scale") * odds_of(size_class(F.col("size"))))
    want = per_source(want)
    rows = rows.select("*", *key).join(want, ["_s", "_n"])
    rows = rows.withColumn("_q", F.when(F.col("_p") > 0, odds))
    rows = rows.withColumn("_bin", F.least(F.lit(BINS - 1), F.floor(BINS * F.col("_q") / (1 + F.col("_q")))).cast("int"))

    # where the cut falls, from the sums of the steps: at most 4096 rows for a source
    bins = rows.where("_p > 0").groupBy("_s", "_n", "_bin").agg(
        F.sum("size").alias("_words"), F.count("*").alias("_docs"), F.first("_rest").alias("_rest")
    )
    order = Window.partitionBy("_s", "_n").orderBy("_bin")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_below", F.coalesce(F.sum("_words").over(past), F.lit(0)))
    bins = bins.withColumn("_open", F.col("_below") + F.col("_words") > F.col("_rest"))
    bins = bins.withColumn("_seen", F.coalesce(F.sum(F.when(F.col("_open"), F.col("_docs"))).over(past), F.lit(0)))
    cut = bins.groupBy("_s", "_n").agg(
        F.min(F.when(F.col("_open"), F.col("_bin"))).alias("_from"),
        F.max(F.when(F.col("_open") & ((F.col("_seen") < NEXT)), F.col("_bin"))).alias("_to"),
        F.min(F.when(F.col("_open"), F.struct("_bin", "_below")))["_below"].alias("_sum"),
    )
    rows = rows.join(per_source(cut), ["_s", "_n"], "left")
    near = (F.col("_bin") >= F.col("_from")) & (F.col("_bin") <= F.col("_to"))
    near = F.coalesce(near, F.lit(False))
    sure = F.coalesce((F.col("_p") > 0) & (F.col("_from").isNull() | (F.col("_bin") < F.col("_from"))), F.lit(False))
    far = rows.where(~near).withColumn("copies", F.col("_whole") + sure.cast("int"))

    line = Window.partitionBy("_s", "_n").orderBy("_q", "doc_id", "size")
    run = line.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_s", "_n")
    close = (
        rows.where(near)
        .withColumn("_cum", F.col("_sum") + F.sum("size").over(run))
        .withColumn("_place", F.row_number().over(line))
        .withColumn("_in", F.col("_cum") <= F.col("_rest"))
        .withColumn("_gap", F.col("_rest") - F.coalesce(F.max(F.when(F.col("_in"), F.col("_cum"))).over(whole), "_sum"))
        .withColumn("_ins", F.sum(F.col("_in").cast("int")).over(whole))
    )
    # the next documents, in their order, as far as each fits into what is left: at most 64 for a source
    after = close.where(~F.col("_in") & (F.col("_place") <= F.col("_ins") + NEXT)).groupBy("_s", "_n").agg(
        F.sort_array(F.collect_list(F.struct("_place", "size"))).alias("_next"), F.first("_gap").alias("_gap")
    )
    start = F.struct(F.col("_gap").cast("double").alias("gap"), F.array().cast("array<int>").alias("places"))
    fill = F.aggregate(
        "_next",
        start,
        lambda acc, x: F.when(
            x["size"] <= acc["gap"],
            F.struct((acc["gap"] - x["size"]).alias("gap"), F.array_append(acc["places"], x["_place"]).alias("places")),
        ).otherwise(acc),
    )
    after = after.withColumn("_fill", fill)
    miss = F.transform("_next", lambda x: F.struct(F.abs(F.col("_fill.gap") - x["size"]), x["_place"].alias("place")))
    miss = F.filter(miss, lambda x: (x["col1"] < F.col("_fill.gap")) & ~F.array_contains(F.col("_fill.places"), x["place"]))
    last = F.when(F.size(miss) > 0, F.array(F.array_min(miss)["place"])).otherwise(F.array().cast("array<int>"))
    more = after.select("_s", "_n", F.explode(F.concat("_fill.places", last)).alias("_place"), F.lit(True).alias("_added"))
    close = close.join(more, ["_s", "_n", "_place"], "left")
    close = close.withColumn("copies", F.col("_whole") + (F.col("_in") | F.col("_added").isNotNull()).cast("int"))
    columns = [*kept, "source_size", "target", "copies"]
    return far.select(*columns).unionByName(close.select(*columns))


def sized_documents(docs: DataFrame) -> DataFrame:
    """docs with size: the words of the text, 0 for null."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    return docs.withColumn("size", words.cast("long"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3, ...: doc_id, size, source_size, target, taken."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = materialize(sized_documents(docs).drop("text"), "mix")
    out = mix(sized)
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )
