"""Landed pages and files as tables, with explicit schemas; nothing is inferred and nothing is fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import LABELS

AWARD_PAGE = """results array<struct<core_project_num:string,project_num:string,appl_id:bigint,project_title:string,fiscal_year:int,project_start_date:string,
    award_amount:bigint,organization:struct<org_name:string,org_state:string>,agency_ic_admin:struct<abbreviation:string>>>"""
LINK_PAGE = "results array<struct<coreproject:string,pmid:bigint,applid:bigint>>"
METADATA_PAGE = "resultList struct<result:array<struct<pmid:string,pmcid:string,doi:string,title:string,pubType:string,isOpenAccess:string,firstPublicationDate:string,authorString:string>>>"
FALLBACK_PAGE = "result map<string,struct<uid:string,title:string,epubdate:string,sortpubdate:string,articleids:array<struct<idtype:string,value:string>>,authors:array<struct<name:string>>>>"


def awards(spark: SparkSession, path: str) -> DataFrame:
    """Award pages to one row for each project, nested organization and agency flattened."""
    r = spark.read.schema(AWARD_PAGE).json(path).select(F.explode("results").alias("r"))
    return r.select(
        "r.core_project_num", "r.project_num", "r.appl_id", F.col("r.project_title").alias("title"), F.col("r.organization.org_name").alias("org"),
        F.col("r.organization.org_state").alias("org_state"), "r.fiscal_year", F.col("r.agency_ic_admin.abbreviation").alias("ic"), F.col("r.award_amount").alias("amount"),
    )


def links(spark: SparkSession, path: str) -> DataFrame:
    r = spark.read.schema(LINK_PAGE).json(path).select(F.explode("results").alias("r"))
    return r.select("r.coreproject", F.col("r.pmid").cast("string").alias("pmid"), "r.applid")


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the first feed; records without a pmid are dropped."""
    r = spark.read.schema(METADATA_PAGE).json(path).select(F.explode("resultList.result").alias("r"))
    return r.select("r.*").where("pmid IS NOT NULL")


def metadata_fallback(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the second feed in the columns of the first: an object by uid, ids by type, slashed dates, a list of authors."""
    r = spark.read.schema(FALLBACK_PAGE).json(path).select(F.explode("result").alias("uid", "r"))
    ids = F.map_from_entries(F.transform("r.articleids", lambda x: F.struct(x["idtype"], x["value"])))
    return r.select(
        F.col("uid").alias("pmid"), ids["pmc"].alias("pmcid"), ids["doi"].alias("doi"), F.col("r.title").alias("title"), F.lit(None).cast("string").alias("pubType"),
        F.lit("N").alias("isOpenAccess"), F.replace(F.substring("r.sortpubdate", 1, 10), F.lit("/"), F.lit("-")).alias("firstPublicationDate"),
        F.array_join(F.transform("r.authors", lambda x: x["name"]), ", ").alias("authorString"),
    )


def fulltext_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a feed, whole and as bytes: pmcid, path and content; a file is named by its paper, or its folder is, as pmcid=..."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    folder, own = F.regexp_extract("path", r"/pmcid=([^/]+)/[^/]*$", 1), F.regexp_extract("path", r"/([^/]+?)(?:\.xml)?$", 1)
    return rows.select(F.when(folder != "", folder).otherwise(own).alias("pmcid"), "path", "content")


#: Characters at a text's beginning among which an article must begin.
HEAD = 5000


def fulltext(feeds: dict[str, DataFrame], open_access: DataFrame) -> DataFrame:
    """(pmcid, source, xml): one full text a paper, of feeds in their order (name: pmcid, path, content).

    Papers that are open (open_access: pmcid, is_open) take the first feed that has a text, others the last feed's only.
    A text counts if an article begins in its first 5,000 characters. Who wins is decided on paths, and the texts are
    joined to that once, hashed by the small side: no text is sorted.
    """
    files = None
    for i, (feed, rows) in enumerate(feeds.items()):
        found = rows.withColumns({"source": F.lit(feed), "_order": F.lit(i)})
        files = found if files is None else files.unionByName(found)
    # a character has four bytes at most
    head = F.substring(F.decode(F.substring("content", 1, 4 * HEAD), "UTF-8"), 1, HEAD)
    places = files.where(head.contains("<article")).select("pmcid", "path", "_order")
    usable = places.join(open_access.select("pmcid", "is_open").distinct(), "pmcid").where(F.col("is_open") | (F.col("_order") == len(feeds) - 1))
    first = usable.groupBy("pmcid").agg(F.min_by("path", F.struct("_order", "path")).alias("path"))
    won = files.join(first.select("path").hint("shuffle_hash"), "path", "left_semi")
    return won.select("pmcid", "source", F.decode("content", "UTF-8").alias("xml"))


def responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("repo string, id string, kind string, method string, url string, status int, text string, error string").json(path)


def tab_files(spark: SparkSession, *patterns: str) -> DataFrame:
    """Tab-separated files by patterns of paths, each with the columns of its own first line, as one table of texts.

    Files of one header are read together; columns that a file has not are null. Besides its columns a row has `file`.
    """
    lines = spark.read.text(list(patterns)).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    heads = lines.where("at = 0").withColumn("n", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "n").alias("head"))
    out = None
    # one row for each file; of a header's files all are read at once
    for r in heads.groupBy("head").agg(F.collect_list("file").alias("files")).toLocalIterator():
        schema = ", ".join("`" + c.strip().replace("`", "``") + "` string" for c in r["head"].split("\t"))
        rows = spark.read.schema(schema).option("sep", "\t").option("header", True).option("escape", '"').csv(r["files"]).withColumn("file", F.col("_metadata.file_path"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no files at {patterns}")
    return out


def catalog(spark: SparkSession, datasets: list[str], resources: list[str]) -> tuple[DataFrame, DataFrame]:
    """Dataset files and resource files, by patterns, as tables: (acc, repo, link_text, pmids) and (url)."""
    rows = tab_files(spark, *datasets)
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in rows.columns else F.lit("")
    pmids = F.array_compact(F.transform(F.split(text("dataset_pmid"), r"[;,\s]+"), lambda x: F.when(x != "", x)))
    links = F.concat_ws(" ", text("dataset_source_url"), text("study_links"))
    made = rows.select(F.lower(F.trim("dataset_source_id")).alias("acc"), F.col("dataset_source_repo").alias("repo"), links.alias("link_text"), pmids.alias("pmids"))
    return made, tab_files(spark, *resources).select(F.col("resource_source_url").alias("url"))


def overrides(spark: SparkSession, path: str, columns: str = "pmid string, label string, reason string", header: bool = True) -> DataFrame:
    """Review labels of CSV files: rows with a pmid and a known label, of each pmid the last in the order of files and lines.

    Lines with too many or too few fields keep what they have. A file is read by one task, which gives its lines their
    order; the last line is found by an aggregate, so that a pmid of very many lines meets in no task.
    """
    names = [c.split()[0] for c in columns.split(", ")]
    rows = spark.read.schema(columns).option("header", header).option("mode", "PERMISSIVE").option("multiLine", True).option("escape", '"').csv(path)
    rows = rows.select(F.trim("pmid").alias("pmid"), *names[1:], F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id()).alias("_line"))
    good = rows.where((F.col("pmid") != "") & F.col("label").isin(LABELS))
    return good.groupBy("pmid").agg(F.max_by(F.struct(*names[1:]), "_line").alias("_last")).select("pmid", "_last.*")


def answers(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Review answers, one JSON a line; those without a role are dropped."""
    return spark.read.schema(schema).json(path).where("role IS NOT NULL")
