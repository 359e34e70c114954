"""Near-duplicate vectors by NN-descent over neighbour lists."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, forget, materialize, table, with_end

THRESHOLD = 0.93
#: Neighbours in a list, and those round a node that are compared with each other.
LIST, AROUND = 8, 12
#: Lists that are full of links are enlarged to these lengths, in so many rounds at most.
LONGER, GROWTH = (16, 32), 8
#: First lists: hash tables in a round, and following rows of a bucket that a row is compared with.
TABLES, AHEAD = 12, 6
#: Bits of a bucket at most: a label's buckets hold about one row each.
BITS = 30
#: Rounds of refinement after new tables, and the share of new links below which they end.
ROUNDS, SETTLED = 4, 0.002
#: Vectors, about, whose links are counted by brute force; the recall that is asked, and rounds of new tables at most.
AUDIT, RECALL, TRIES = 512, 0.99, 12
#: Rows of a block where a component with a list that stays full is compared block by block.
BLOCK = 512


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(-1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(-1, keepdims=True))


def vector_classes(vectors: DataFrame) -> DataFrame:
    """One row for each different usable vector of a label: node, label, vec, least (smallest vec_id), copies."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(x, lambda v: v != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite & some
    rows = vectors.where(F.coalesce(usable, F.lit(False)))
    out = rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    # vectors of different lengths are of different kinds
    kind = F.xxhash64("label", F.size("embedding")).alias("label")
    return out.select(F.xxhash64("label", "embedding").alias("node"), kind, F.col("embedding").alias("vec"), "least", "copies")


def first_lists(classes: DataFrame, round_: int) -> DataFrame:
    """Pairs (u, v, cos) of rows that are close in a bucket of random hyperplanes, ordered by one more projection.

    A label has as many buckets as rows, about. Rows are dealt out by range of (label, table, bucket, projection), so
    that a bucket of very many rows is cut into several tasks.
    """
    sizes = classes.groupBy("label").count()
    bits = F.least(F.lit(BITS), F.greatest(F.lit(0), F.ceil(F.log2("count")) - 1)).cast("int")
    sized = classes.join(sizes.select("label", bits.alias("bits")), "label")

    def codes(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 2000):
                part = b.iloc[i : i + 2000]
                for size in part["vec"].map(len).unique():
                    own = part[part["vec"].map(len) == size]
                    x, mask = matrix(own["vec"]), (1 << own["bits"].to_numpy().astype(np.int64)) - 1
                    for t in range(TABLES):
                        r = np.random.default_rng([int(size), round_, t])
                        sides = x @ r.normal(size=(int(size), BITS + 1))
                        code = ((sides[:, :BITS] > 0).astype(np.int64) << np.arange(BITS)).sum(1) & mask
                        yield pd.DataFrame(
                            {"label": own["label"], "t": t, "code": code, "line": sides[:, BITS], "node": own["node"], "vec": own["vec"]}
                        )

    def compare(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail: pd.DataFrame | None = None
        for b in batches:
            old = 0
            if tail is not None:
                old = len(tail)
                b = pd.concat([tail, b], ignore_index=True)
            tail = b.iloc[-AHEAD:]
            key = b[["label", "t", "code"]].to_numpy()
            node = b["node"].to_numpy()
            for d in range(1, AHEAD + 1):
                i = np.arange(max(0, old - d), len(b) - d)
                i = i[(key[i] == key[i + d]).all(1)]
                for part in np.array_split(i, max(1, len(i) // 5000)):
                    if not len(part):
                        continue
                    c = cosines(unit(matrix(b["vec"].iloc[part])), unit(matrix(b["vec"].iloc[part + d])))
                    yield pd.DataFrame({"u": node[part], "v": node[part + d], "cos": c})

    rows = sized.select("node", "label", "vec", "bits").mapInPandas(
        codes, "label long, t int, code long, line double, node long, vec array<float>"
    )
    parts = max(rows.sparkSession.sparkContext.defaultParallelism * 2, 8)
    dealt = rows.repartitionByRange(parts, "label", "t", "code", "line").sortWithinPartitions("label", "t", "code", "line")
    return dealt.mapInPandas(compare, "u long, v long, cos double")


def shorten(pairs: DataFrame, length: int) -> DataFrame:
    """Lists (u, v, cos) of the LIST nearest of both directions of pairs, and of links up to `length`."""
    both = pairs.select("u", "v", "cos").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), "cos"))
    once = both.where("u <> v").groupBy("u", "v").agg(F.max("cos").alias("cos"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cos"), "v"))
    near = once.withColumn("rank", rank).where(F.col("rank") <= length)
    return near.where((F.col("rank") <= LIST) | (F.col("cos") >= THRESHOLD)).drop("rank")


def full(lists: DataFrame, length: int) -> DataFrame:
    """Nodes (u) whose lists hold `length` links: there may be more."""
    return lists.where(F.col("cos") >= THRESHOLD).groupBy("u").count().where(F.col("count") >= length).select("u")


def neighbours(lists: DataFrame) -> DataFrame:
    """The AROUND nearest neighbours, and reverse neighbours, (u, v) of each node."""
    return shorten(lists, AROUND).select("u", "v")


def any_neighbours(lists: DataFrame, length: int, round_: int) -> DataFrame:
    """AROUND neighbours (u, v), by chance, of each node with `length` links: other ones in each round."""
    links = lists.where(F.col("cos") >= THRESHOLD).select("u", "v")
    links = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct().join(full(lists, length), "u")
    chance = F.row_number().over(Window.partitionBy("u").orderBy(F.xxhash64("u", "v", F.lit(round_))))
    return links.withColumn("rank", chance).where(F.col("rank") <= AROUND).select("u", "v")


def descend(around: DataFrame, classes: DataFrame, floor: float) -> DataFrame:
    """Pairs (u, v, cos), of a cosine of `floor` and more, among the neighbours (u, v) of each node."""

    def compare(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail: pd.DataFrame | None = None
        for b in with_end(batches):
            if b is None:
                b, tail = tail, None
                if b is None:
                    return
            else:
                b = b if tail is None else pd.concat([tail, b], ignore_index=True)
                last = b["u"].to_numpy() == b["u"].iloc[-1]
                b, tail = b[~last], b[last]
            if not len(b):
                continue
            sizes = b["vec"].map(len)
            for size in sizes.unique():
                yield from among(b[sizes == size])

    def among(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        u, node = b["u"].to_numpy(), b["v"].to_numpy()
        starts = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
        counts = np.diff(np.r_[starts, len(u)])
        x = unit(matrix(b["vec"]))
        for n in np.unique(counts[counts > 1]):
            rows = starts[counts == n][:, None] + np.arange(n)
            for part in np.array_split(rows, max(1, len(rows) // 1000)):
                c = np.einsum("gik,gjk->gij", x[part], x[part], optimize=True)
                i, j = np.triu_indices(n, 1)
                close = c[:, i, j]
                good = close >= floor
                yield pd.DataFrame({"u": node[part[:, i]][good], "v": node[part[:, j]][good], "cos": close[good]})

    rows = around.join(classes.select(F.col("node").alias("v"), "vec"), "v")
    dealt = rows.repartition("u").sortWithinPartitions("u")
    return dealt.mapInPandas(compare, "u long, v long, cos double").distinct()


def dense_components(lists: DataFrame, length: int) -> DataFrame:
    """(node, component) of components that have a node whose list holds `length` links: they are compared in full."""
    edges = lists.where(F.col("cos") >= THRESHOLD).select(F.col("u").alias("a"), F.col("v").alias("b"))
    if full(lists, length).isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    parts = materialize(components(edges), "parts")
    dense = parts.join(full(lists, length).withColumnRenamed("u", "node"), "node").select("component").distinct()
    return parts.join(dense, "component", "left_semi").select("node", "component")


def recall(lists: DataFrame, classes: DataFrame, length: int, salt: int) -> float:
    """Share of the true links of some AUDIT nodes, by brute force, that are found; that many vectors are collected.

    The nodes are drawn from all, and half of them from nodes with links. Of a node of a component that is compared in
    full, the links within the component count as found, and those to other nodes as lost; of others the lists' links.
    """
    near = lists.where(F.col("cos") >= THRESHOLD).select(F.col("u").alias("node")).distinct()
    order = F.xxhash64("node", F.lit(salt))
    some = classes.select("node").orderBy(order).limit(AUDIT // 2).unionByName(near.orderBy(order).limit(AUDIT // 2)).distinct()
    tagged = classes.select("node", "label", "vec").join(dense_components(lists, length), "node", "left")
    chosen = tagged.join(F.broadcast(some), "node").select("node", "label", "vec", F.col("component").cast("string").alias("component")).toPandas()
    if not len(chosen):
        return 1.0

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, within = (np.zeros(len(chosen), dtype=np.int64) for _ in range(2))
            sizes, mine = b["vec"].map(len), chosen["vec"].map(len)
            for size in set(sizes) & set(mine):
                own, asked = b[sizes == size], np.flatnonzero(mine == size)
                c = unit(matrix(own["vec"])) @ unit(matrix(chosen["vec"].iloc[asked])).T
                same = own["label"].to_numpy()[:, None] == chosen["label"].to_numpy()[asked][None]
                other = own["node"].to_numpy()[:, None] != chosen["node"].to_numpy()[asked][None]
                true = (c >= THRESHOLD) & same & other
                together = own["component"].to_numpy(object)[:, None] == chosen["component"].to_numpy(object)[asked][None]
                out[asked] += true.sum(0)
                within[asked] += (true & together & own["component"].notna().to_numpy()[:, None]).sum(0)
            yield pd.DataFrame({"u": chosen["node"], "n": out, "within": within, "dense": chosen["component"].notna()})

    rows = tagged.withColumn("component", F.col("component").cast("string"))
    true = rows.mapInPandas(count, "u long, n long, within long, dense boolean").groupBy("u").agg(F.sum("n").alias("n"), F.sum("within").alias("within"), F.max("dense").alias("dense"))
    linked = lists.where(F.col("cos") >= THRESHOLD).groupBy("u").agg(F.count("*").alias("found"))
    got = true.join(linked, "u", "left").withColumn("found", F.when(F.col("dense"), F.col("within")).otherwise(F.least("n", F.coalesce("found", F.lit(0)))))
    row = got.agg(F.sum("n").alias("n"), F.sum("found").alias("found")).first()
    return row["found"] / row["n"] if row and row["n"] else 1.0


def neighbour_graph(classes: DataFrame) -> tuple[DataFrame, int, float]:
    """(neighbour lists (u, v, cos), longest length, audited recall).

    Lists are refined until few new links appear. Those that are full of links are enlarged, through pairs of their
    own neighbours. New tables follow until the audit, of other nodes each time, finds nearly all links.
    """
    lists, length = None, LONGER[-1]
    for round_ in range(TRIES):
        new = first_lists(classes, round_)
        lists = materialize(shorten(new if lists is None else lists.unionByName(new), length), "lists")
        links = lists.where(F.col("cos") >= THRESHOLD).count()
        for _ in range(ROUNDS):
            better = materialize(shorten(lists.unionByName(descend(neighbours(lists), classes, -1.0)), length), "lists")
            forget(lists)
            now = better.where(F.col("cos") >= THRESHOLD).count()
            lists, gained, links = better, now - links, now
            if gained <= SETTLED * max(now, 1):
                break
        # around nodes with as many links as a list holds, every pair of neighbours gets its turn
        for i in range(GROWTH):
            if full(lists, LIST).isEmpty():
                break
            more = descend(any_neighbours(lists, LIST, i), classes, THRESHOLD)
            better = materialize(shorten(lists.unionByName(more), LONGER[min(i, len(LONGER) - 1)]), "lists")
            forget(lists)
            now = better.where(F.col("cos") >= THRESHOLD).count()
            lists, gained, links = better, now - links, now
            if i >= len(LONGER) and gained <= SETTLED * max(now, 1):
                break
        found = recall(lists, classes, length, round_)
        if found >= RECALL:
            return lists, length, found
    raise RuntimeError(f"after {TRIES} rounds of tables the lists hold {found:.3f} of the links only")


def complete(members: DataFrame) -> DataFrame:
    """(node, found) links by comparing members (component, node, label, vec, copies, n) of components in full, by blocks."""

    def compare(b: pd.DataFrame) -> pd.DataFrame:
        i, j = int(b["i"].iloc[0]), int(b["j"].iloc[0])
        left, right = b[b["block"] == i], b[b["block"] == j]
        c = unit(matrix(left["vec"])) @ unit(matrix(right["vec"])).T >= THRESHOLD
        if i == j:
            np.fill_diagonal(c, False)
            return pd.DataFrame({"node": left["node"], "found": c @ left["copies"].to_numpy()})
        return pd.DataFrame(
            {
                "node": np.concatenate([left["node"], right["node"]]),
                "found": np.concatenate([c @ right["copies"].to_numpy(), c.T @ left["copies"].to_numpy()]),
            }
        )

    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    pairs = rows.select("component", "i", "j", "block", "node", "vec", "copies")
    got = pairs.groupBy("component", "i", "j").applyInPandas(compare, "node long, found long")
    return got.groupBy("node").agg(F.sum("found").alias("found"))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vectors (vec_id, embedding, label) to (vec_id, n_links, component_id, kept, recall).

    Vectors of one label link at a cosine of 0.93 or more. Null labels or vec_ids, vectors that are null, empty or
    zero, and those with null or non-finite components link with nothing; vectors of different lengths don't link.
    Equal vectors are one node with a count, so copies are never paired. Lists of 8 neighbours are first filled from
    random-hyperplane buckets and refined through neighbours of neighbours (NN-descent). A list that is full of links
    is saturated and enlarged to 16, then to 32 links. Where it is full again, the exact way for the rest is to compare
    its whole component by blocks, which counts links without a row for each. An audit by brute force over some 512
    vectors adds more buckets while recall is under 0.99; column `recall` holds what it found, and it raises an error
    if twelve rounds don't do. Repeated rows are separate vectors of one id; other columns are ignored; empty in,
    empty out.
    """
    # one file part for each task later on; the copies of a vector have met here
    classes = materialize(vector_classes(vectors), "classes")
    lists, length, audited = neighbour_graph(classes)
    edges = materialize(lists.where(F.col("cos") >= THRESHOLD), "links")
    parts = materialize(components(edges.select(F.col("u").alias("a"), F.col("v").alias("b"))), "parts")
    dense = parts.join(full(lists, length).withColumnRenamed("u", "node"), "node").select("component").distinct()
    sizes = parts.groupBy("component").agg(F.count("*").alias("n"))
    within = parts.join(sizes.join(dense, "component"), "component")
    within = within.join(classes.select("node", "label", "vec", "copies"), "node")
    exact = complete(within)
    counted = edges.join(classes.select(F.col("node").alias("v"), "copies"), "v").groupBy("u").agg(F.sum("copies").alias("listed"))
    nodes = (
        classes.select("node", "least", "copies")
        .join(parts, "node", "left")
        .join(exact, "node", "left")
        .join(counted.withColumnRenamed("u", "node"), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("links", F.coalesce("found", "listed", F.lit(0)) + F.col("copies") - 1)
    )
    nodes = materialize(nodes.select("node", "component", "least", "links"), "nodes")
    forget(lists)
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    of = nodes.join(least, "component").select("node", "links", "component_id")
    # rows that are no member of a class join nothing
    x = F.col("embedding")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    good = F.coalesce(good & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    keyed = vectors.select("vec_id", F.when(good, F.xxhash64("label", "embedding")).alias("node"))
    out = keyed.join(of, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
        F.lit(audited).alias("recall"),
    )


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all embeddings: vec_id, n_links, component_id, kept."""
    found = near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.select("vec_id", "n_links", "component_id", "kept")
