"""Comparison of own datasets with an external catalog, and agreement of reviewers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import norm_url
from ..rules import ALTERNATIVE_ACCESSION, LINK_TEXT_REPOSITORIES


def signal(own: DataFrame, catalog: DataFrame, catalog_pmids: DataFrame) -> DataFrame:
    """own (pmid, id, ...) with outcome: the catalog names this paper, other papers only, no paper, or doesn't list it."""
    listed = catalog.select("acc").distinct().withColumn("_listed", F.lit(True))
    some = catalog_pmids.select("acc").distinct().withColumn("_some", F.lit(True))
    this = catalog_pmids.select("acc", "pmid").distinct().withColumn("_this", F.lit(True))
    j = own.withColumn("acc", F.lower(F.trim("id"))).join(listed, "acc", "left").join(some, "acc", "left").join(this, ["acc", "pmid"], "left")
    outcome = (
        F.when(F.col("_listed").isNull(), "not listed").when(F.col("_this").isNotNull(), "this paper")
        .when(F.col("_some").isNotNull(), "other papers only").otherwise("no paper")
    )
    return j.withColumn("outcome", outcome).drop("_listed", "_some", "_this")


def without_derived(catalog: DataFrame) -> DataFrame:
    """The catalog without sets that are curated from series."""
    return catalog.where(~F.upper("acc").startswith("GDS"))


def exact(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    return candidates.withColumn("acc", F.lower(F.trim("id"))).join(catalog.select("acc").distinct(), "acc", "left_semi")


def aliases(catalog: DataFrame) -> DataFrame:
    """(acc, alias): the accessions that a listed dataset goes by, its own and those that its link text names."""
    named = F.regexp_extract_all("link_text", F.lit("(?i)" + ALTERNATIVE_ACCESSION), F.lit(1))
    every = F.array_append(F.transform(F.coalesce(named, F.array().cast("array<string>")), F.lower), F.col("acc"))
    return catalog.select("acc", F.explode(every).alias("alias")).distinct()


def papers_by_alias(catalog: DataFrame, catalog_pmids: DataFrame) -> DataFrame:
    """(acc, pmid): papers that the catalog gives for an accession, under whichever of a dataset's accessions."""
    return aliases(catalog).join(catalog_pmids, "acc").select(F.col("alias").alias("acc"), "pmid").distinct()


def listed(candidates: DataFrame, catalog: DataFrame, url: Column) -> DataFrame:
    """Candidates that the catalog lists by accession, in a link text (some repositories), or by link."""
    some = by_link_text(candidates.where(F.col("repo").isin(LINK_TEXT_REPOSITORIES)), catalog)
    found = exact(candidates, catalog).drop("acc").unionByName(some.drop("acc")).unionByName(by_url(candidates, catalog, url))
    return found.distinct()


def benchmark(catalog: DataFrame, catalog_pmids: DataFrame, identifiers: DataFrame) -> DataFrame:
    """(pmid, acc, found, own): the catalog's pairs of paper and dataset, found if the paper names any of its accessions."""
    pairs = catalog_pmids.join(aliases(catalog), "acc", "left").select("pmid", "acc", F.coalesce("alias", "acc").alias("alias"))
    named = identifiers.select("pmid", F.lower("id").alias("alias"), "id", "role")
    own = F.coalesce(F.bool_or(F.col("role") == "generated"), F.lit(False))
    return pairs.join(named, ["pmid", "alias"], "left").groupBy("pmid", "acc").agg((F.count("id") > 0).alias("found"), own.alias("own"))


def by_link_text(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Candidates that stand as a whole word in any link text: texts are cut into words, so that it is an equi-join."""
    words = catalog.select(F.explode(F.split(F.lower("link_text"), "[^0-9a-z_]+")).alias("acc")).where("acc <> ''").distinct()
    return candidates.withColumn("acc", F.lower(F.trim("id"))).join(words, "acc", "left_semi")


def by_url(candidates: DataFrame, catalog: DataFrame, url: Column) -> DataFrame:
    """Candidates whose landing page or identifier is a catalog link, both normalized."""
    links = catalog.select(norm_url(F.col("url")).alias("acc")).distinct()
    keys = candidates.withColumn("acc", F.explode(F.array_distinct(F.array(norm_url(url), norm_url(F.col("id"))))))
    return keys.join(links, "acc", "left_semi").drop("acc").distinct()


def kappa(pairs: DataFrame, a: Column, b: Column) -> DataFrame:
    """n, agreement and Cohen's kappa of two yes/no raters; kappa is null where agreement by chance is sure."""
    g = pairs.agg(F.count("*").alias("n"), F.count_if(a == b).alias("same"), F.count_if(a).alias("a"), F.count_if(b).alias("b"))
    n = F.col("n").cast("double")
    observed = F.col("same") / n
    chance = (F.col("a") / n) * (F.col("b") / n) + (1 - F.col("a") / n) * (1 - F.col("b") / n)
    return g.select("n", "same", observed.alias("agreement"), F.when(chance != 1, (observed - chance) / (1 - chance)).alias("kappa"))


def weighted_percent(population: Column, hits: Column, judged: Column) -> Column:
    """Percent of hits among the judged rows of each stratum, weighted by the strata's sizes; strata are few rows."""
    w = Window.partitionBy(F.lit(0))
    of = population * hits / judged
    return 100 * F.sum(of).over(w) / F.nullif(F.sum(population).over(w), F.lit(0))
