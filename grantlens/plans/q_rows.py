"""Queries of projections, filters, set operations, windows, top lists, decision rules and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import catalog as K
from ..operators import mentions as M
from ..operators import papers as P
from ..operators import records as R
from ..rules import LABELS
from .base import Data, query

OWN = "role = 'generated' AND cls <> 'url'"


# ---------------------------------------------------------------- projections and filters


@query("flt_cohort", """SELECT core_project_num, appl_id, fiscal_year FROM {project}
    WHERE ic = 'CA' AND fiscal_year = 2021 AND activity = 'R01' AND award_type IN ('1', '2')""")
def flt_cohort(d: Data) -> DataFrame:
    keep = (F.col("ic") == "CA") & (F.col("fiscal_year") == 2021) & (F.col("activity") == "R01") & F.col("award_type").isin("1", "2")
    return d.project.where(keep).select("core_project_num", "appl_id", "fiscal_year")


@query("prj_papers", """SELECT pmid, open_access = 'Y' AS is_oa, in_pmc = 'Y' AS in_pmc_flag, lower(pub_type) LIKE '%preprint%' AS is_preprint,
    COALESCE(fulltext_source, 'none') AS metadata_source FROM {paper}""")
def prj_papers(d: Data) -> DataFrame:
    return d.paper.select(
        "pmid", (F.col("open_access") == "Y").alias("is_oa"), (F.col("in_pmc") == "Y").alias("in_pmc_flag"),
        F.lower("pub_type").contains("preprint").alias("is_preprint"), F.coalesce("fulltext_source", F.lit("none")).alias("metadata_source"),
    )


@query("flt_checkable", """SELECT pmid, fulltext_source IS NOT NULL AS checkable, CASE WHEN fulltext_source IS NOT NULL THEN ''
    WHEN pmcid IS NULL THEN 'no PMCID' ELSE 'not in the open sets' END AS note FROM {paper}""")
def flt_checkable(d: Data) -> DataFrame:
    full = F.col("fulltext_source").isNotNull()
    note = F.when(full, "").when(F.col("pmcid").isNull(), "no PMCID").otherwise("not in the open sets")
    return d.paper.select("pmid", full.alias("checkable"), note.alias("note"))


@query("flt_own_identifiers", f"SELECT pmid, repo, id FROM {{ident}} WHERE {OWN}")
def flt_own_identifiers(d: Data) -> DataFrame:
    return M.own_identifiers(d.ident).select("pmid", "repo", "id")


@query("flt_own_data", f"SELECT pmid, repo, id, 'data' AS kind FROM {{ident}} WHERE {OWN} AND NOT is_code UNION ALL SELECT pmid, repo, id, 'code' FROM {{ident}} WHERE {OWN} AND is_code")
def flt_own_data(d: Data) -> DataFrame:
    own = M.own_identifiers(d.ident)
    return own.select("pmid", "repo", "id", F.when(F.col("is_code"), "code").otherwise("data").alias("kind"))


@query("flt_new_data_deposit", f"""SELECT pmid, MAX(CASE WHEN {OWN} AND NOT is_code AND cls IN ('public', 'generic', 'controlled') THEN 1 ELSE 0 END) = 1 AS new_data
    FROM {{ident}} GROUP BY pmid""")
def flt_new_data_deposit(d: Data) -> DataFrame:
    new = (F.col("role") == "generated") & ~F.col("is_code") & F.col("cls").isin("public", "generic", "controlled")
    return d.ident.groupBy("pmid").agg(F.bool_or(new).alias("new_data"))


@query("flt_record_wanted", """SELECT DISTINCT repo, id FROM {ident} WHERE repo IN ('GEO', 'SRA/BioProject', 'Zenodo', 'PRIDE/ProteomeXchange')
    AND (role IN ('generated', 'unknown') OR role = 'reused' AND evidence LIKE 'reused by default%')""")
def flt_record_wanted(d: Data) -> DataFrame:
    by_default = (F.col("role") == "reused") & F.col("evidence").startswith("reused by default")
    read = F.col("repo").isin("GEO", "SRA/BioProject", "Zenodo", "PRIDE/ProteomeXchange")
    return d.ident.where(read & (F.col("role").isin("generated", "unknown") | by_default)).select("repo", "id").distinct()


@query("flt_publishable", "SELECT repo, id, tier FROM {candidate} WHERE status = 'RESOLVES'")
def flt_publishable(d: Data) -> DataFrame:
    return d.candidate.where(F.col("status") == "RESOLVES").select("repo", "id", "tier")


@query("flt_not_in_catalog", "SELECT repo, id FROM {candidate} WHERE type = 'dataset' AND lower(id) NOT IN (SELECT acc FROM {catalog})")
def flt_not_in_catalog(d: Data) -> DataFrame:
    c = d.candidate.where(F.col("type") == "dataset")
    return c.join(d.catalog.select(F.col("acc")), F.lower("id") == F.col("acc"), "left_anti").select("repo", "id")


@query("flt_date_window", """SELECT pmid, pub_date, COALESCE(CAST(pub_date AS STRING), '9999') < '1996-01-01' AS before_snapshot
    FROM {paper} WHERE pub_date BETWEEN DATE '1994-01-01' AND DATE '1997-12-31'""")
def flt_date_window(d: Data) -> DataFrame:
    inside = F.col("pub_date").between(F.lit("1994-01-01").cast("date"), F.lit("1997-12-31").cast("date"))
    before = F.coalesce(F.col("pub_date").cast("string"), F.lit("9999")) < "1996-01-01"
    return d.paper.where(inside).select("pmid", "pub_date", before.alias("before_snapshot"))


@query("flt_before_all_awards", """SELECT p.pmid FROM {paper} p LEFT JOIN {link} l ON p.pmid = l.pmid LEFT JOIN {award} a ON l.coreproject = a.core_project_num
    GROUP BY p.pmid HAVING MIN(CASE WHEN a.start_date IS NULL OR p.pub_date < a.start_date THEN 1 ELSE 0 END) = 1""")
def flt_before_all_awards(d: Data) -> DataFrame:
    j = d.paper.join(d.link, "pmid", "left").join(d.award, F.col("coreproject") == F.col("core_project_num"), "left")
    before = F.col("start_date").isNull() | F.coalesce(F.col("pub_date") < F.col("start_date"), F.lit(False))
    return j.groupBy("pmid").agg(F.bool_and(before).alias("all_before")).where("all_before").select("pmid")


#: Links for the identifiers of links, by the paper's number: some lead to people, articles or filters, others only seem to.
_LINKS = """CASE CAST(pmid AS BIGINT) % 7 WHEN 0 THEN 'https://ORCID.org/' || pmid WHEN 1 THEN 'http://www.ncbi.nlm.nih.gov/pmc/articles/' || pmid WHEN 2 THEN 'https://dx.doi.org/10.1/' || pmid
    WHEN 3 THEN 'https://eu.safelinks.protection.outlook.com/?url=' || pmid WHEN 4 THEN 'https://www.ncbi.nlm.nih.gov/geo/' || pmid WHEN 5 THEN 'https://lab.org/orcid.org/' || pmid ELSE id END"""


@query("flt_link_noise", f"SELECT pmid, {_LINKS} AS url FROM {{ident}} WHERE cls = 'url' AND CAST(pmid AS BIGINT) % 7 > 3")
def flt_link_noise(d: Data) -> DataFrame:
    links = d.ident.where("cls = 'url'").select("pmid", F.expr(_LINKS).alias("url"))
    return links.where(~M.leads_to_no_data(F.col("url")))


@query("flt_disagreements", "SELECT doc_id, role_a, role_b FROM {rated} WHERE role_a <> role_b")
def flt_disagreements(d: Data) -> DataFrame:
    return d.rated.where(F.col("role_a") != F.col("role_b")).select("doc_id", "role_a", "role_b")


@query("prj_id_strings", """SELECT i.pmid, string_agg(i.repo || ':' || i.id || COALESCE(' [' || s.status || ']', ''), '; ' ORDER BY i.repo, i.id) AS ids
    FROM {ident} i LEFT JOIN {status} s ON i.repo = s.repo AND i.id = s.id WHERE i.role IN ('generated', 'unknown') GROUP BY i.pmid""")
def prj_id_strings(d: Data) -> DataFrame:
    j = d.ident.where(F.col("role").isin("generated", "unknown")).join(d.status, ["repo", "id"], "left")
    text = F.concat("repo", F.lit(":"), "id", F.coalesce(F.concat(F.lit(" ["), "status", F.lit("]")), F.lit("")))
    items = F.array_sort(F.collect_list(F.struct("repo", "id", text.alias("t"))))
    return j.groupBy("pmid").agg(F.array_join(F.transform(items, lambda x: x["t"]), "; ").alias("ids"))


@query("flt_derived_series", """SELECT acc FROM (SELECT CASE WHEN CAST(acc[-1] AS VARCHAR) IN ('3', '7') THEN replace(acc, 'gse', 'gds') ELSE acc END AS acc FROM {catalog}) t WHERE acc NOT LIKE 'gds%'""")
def flt_derived_series(d: Data) -> DataFrame:
    # some series are listed by the curated sets that were made of them
    acc = F.when(F.right("acc", F.lit(1)).isin("3", "7"), F.replace("acc", F.lit("gse"), F.lit("gds"))).otherwise(F.col("acc"))
    return K.without_derived(d.catalog.select(acc.alias("acc")))


# ---------------------------------------------------------------- set operations


@query("set_common", """SELECT COUNT(DISTINCT pmid) AS papers, COUNT(*) AS pairs FROM (SELECT DISTINCT pmid, lower(id) AS acc FROM {ident}
    INTERSECT SELECT pmid, acc FROM {catalog_pmid}) t""")
def set_common(d: Data) -> DataFrame:
    both = d.ident.select("pmid", F.lower("id").alias("acc")).intersect(d.catalog_pmid.select("pmid", "acc"))
    return both.agg(F.count_distinct("pmid").alias("papers"), F.count("*").alias("pairs"))


@query("set_union_feeds", """SELECT pmid, title, 'primary' AS feed, pub_type FROM {paper} WHERE fulltext_source IS NOT NULL
    UNION ALL SELECT pmid, title, 'fallback', NULL FROM {paper} WHERE fulltext_source IS NULL""")
def set_union_feeds(d: Data) -> DataFrame:
    first = d.paper.where("fulltext_source IS NOT NULL").select("pmid", "title", F.lit("primary").alias("feed"), "pub_type")
    second = d.paper.where("fulltext_source IS NULL").select("pmid", "title", F.lit("fallback").alias("feed"))
    return first.unionByName(second, allowMissingColumns=True)


@query("set_distinct", "SELECT DISTINCT repo, id FROM {ident} UNION ALL SELECT DISTINCT 'url', lower(id) FROM {mention} WHERE cls = 'url'")
def set_distinct(d: Data) -> DataFrame:
    urls = d.mention.where("cls = 'url'").select(F.lit("url").alias("repo"), F.lower("id").alias("id"))
    return d.ident.select("repo", "id").distinct().unionByName(urls.distinct())


@query("set_sample_frame", """WITH c AS (SELECT pmid, 'catalog' AS part FROM {paper} WHERE pmid IN (SELECT pmid FROM {catalog_pmid})),
    o AS (SELECT pmid, ROW_NUMBER() OVER (ORDER BY md5('7|' || pmid), pmid) AS n FROM {paper} WHERE pmid NOT IN (SELECT pmid FROM {catalog_pmid}))
    SELECT pmid, part FROM c UNION ALL SELECT pmid, 'other' FROM o WHERE n <= 200""")
def set_sample_frame(d: Data) -> DataFrame:
    listed = d.catalog_pmid.select("pmid").distinct()
    one = d.paper.join(listed, "pmid", "left_semi").select("pmid", F.lit("catalog").alias("part"))
    rest = d.paper.join(listed, "pmid", "left_anti").select("pmid")
    two = rest.orderBy(F.md5(F.concat(F.lit("7|"), "pmid")), "pmid").limit(200)
    return one.unionByName(two.withColumn("part", F.lit("other")))


@query("set_exclude_done", "SELECT pmid, label FROM {labelled} WHERE CAST(pmid AS BIGINT) NOT IN (SELECT doc_id FROM {labels})")
def set_exclude_done(d: Data) -> DataFrame:
    done = d.labels.select(F.col("doc_id").cast("string").alias("pmid"))
    return d.labelled.join(done, "pmid", "left_anti").select("pmid", "label")


# ---------------------------------------------------------------- windows and top lists


def within_budget(df: DataFrame, keys: list[str], order: list, length: F.Column, limit: int) -> DataFrame:
    """Rows in order while their running length stays within the limit."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("used", F.sum(length).over(w)).where(F.col("used") <= limit)


@query("win_budget", """SELECT conv_id, turn, used FROM (SELECT conv_id, turn, CAST(SUM(length(text)) OVER (PARTITION BY conv_id ORDER BY turn, role, text
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS used FROM {conversations}) t WHERE used <= 600""")
def win_budget(d: Data) -> DataFrame:
    rows = within_budget(d.conversations, ["conv_id"], ["turn", "role", "text"], F.length("text"), 600)
    return rows.select("conv_id", "turn", "used")


@query("win_first", """SELECT repo, id, pmid, ord FROM (SELECT repo, id, pmid, ord, ROW_NUMBER() OVER (PARTITION BY repo, id ORDER BY CAST(pmid AS BIGINT), ord) AS n
    FROM {mention}) t WHERE n = 1""")
def win_first(d: Data) -> DataFrame:
    return R.first_by(d.mention, ["repo", "id"], [F.col("pmid").cast("long").alias("n"), F.col("ord")]).select("repo", "id", "pmid", "ord")


@query("win_gaps", """WITH g AS (SELECT user_id, epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM {events}),
    k AS (SELECT user_id, gap, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY gap) AS n, COUNT(*) OVER (PARTITION BY user_id) AS c
      FROM g WHERE gap > 0 AND gap < 36000000000)
    SELECT user_id, CAST(c AS BIGINT) AS n_gaps, CAST(gap AS BIGINT) AS median_us FROM k WHERE n = c // 2 + 1""")
def win_gaps(d: Data) -> DataFrame:
    w = Window.partitionBy("user_id")
    gap = F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(w.orderBy("ts", "event_id"))
    g = d.events.withColumn("ts", F.col("ts").cast("timestamp")).select("user_id", gap.alias("gap")).where("gap > 0 AND gap < 36000000000")
    k = g.withColumn("n", F.row_number().over(w.orderBy("gap"))).withColumn("n_gaps", F.count("*").over(w))
    return k.where(F.col("n") == F.floor(F.col("n_gaps") / 2) + 1).select("user_id", "n_gaps", F.col("gap").alias("median_us"))


def stratified_sample(df: DataFrame, strata: list[str], key: str, n: int, seed: int) -> DataFrame:
    """n rows of each stratum, the same ones in every run: first by the MD5 of seed and key."""
    order = [F.md5(F.concat(F.lit(f"{seed}|"), F.col(key))), F.col(key)]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*strata).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


@query("win_sample", """SELECT label, pmid FROM (SELECT label, pmid, ROW_NUMBER() OVER (PARTITION BY label ORDER BY md5('21|' || pmid), pmid) AS n
    FROM {labelled}) t WHERE n <= 20""")
def win_sample(d: Data) -> DataFrame:
    return stratified_sample(d.labelled, ["label"], "pmid", 20, 21).select("label", "pmid")


@query("top_limit_awards", "SELECT core_project_num, appl_id FROM {project} ORDER BY appl_id LIMIT 50")
def top_limit_awards(d: Data) -> DataFrame:
    return d.project.select("core_project_num", "appl_id").orderBy("appl_id").limit(50)


@query("top_repos", f"""WITH c AS (SELECT repo, COUNT(*) AS n FROM {{ident}} WHERE {OWN} GROUP BY repo),
    r AS (SELECT repo, n, ROW_NUMBER() OVER (ORDER BY n DESC, repo) AS k FROM c)
    SELECT CASE WHEN k <= 10 THEN repo ELSE 'rest' END AS repository, CAST(SUM(n) AS BIGINT) AS n FROM r GROUP BY 1""")
def top_repos(d: Data) -> DataFrame:
    counts = M.own_identifiers(d.ident).groupBy("repo").agg(F.count("*").alias("n"))  # one row for each repository
    k = F.row_number().over(Window.orderBy(F.desc("n"), "repo"))
    named = counts.withColumn("repository", F.when(k <= 10, F.col("repo")).otherwise("rest"))
    return named.groupBy("repository").agg(F.sum("n").alias("n"))


#: Identifiers of a role that a list shows, and of all that a reason names.
SLICES = {"reused": 15, "generated": 12, "unknown": 6}
NAMED = 4


@query("top_slices", f"""SELECT pmid, {", ".join(f"COALESCE(string_agg(id, ';' ORDER BY id) FILTER (WHERE role = '{r}' AND n <= {k}), '') AS {r}" for r, k in SLICES.items())},
    string_agg(id, ';' ORDER BY id) FILTER (WHERE m <= {NAMED}) AS named
    FROM (SELECT pmid, id, role, ROW_NUMBER() OVER (PARTITION BY pmid, role ORDER BY id) AS n, ROW_NUMBER() OVER (PARTITION BY pmid ORDER BY id) AS m FROM (SELECT DISTINCT 'p' || CAST(CAST(pmid AS BIGINT) % 90 AS STRING) AS pmid, id, role FROM {{ident}}) i) t GROUP BY pmid""")
def top_slices(d: Data) -> DataFrame:
    """Heads of a paper's lists by role, in order; what is beyond is not shown."""
    heads = [F.array_join(F.slice(F.array_sort(F.collect_list(F.when(F.col("role") == r, F.col("id")))), 1, k), ";").alias(r) for r, k in SLICES.items()]
    # ninety papers with many identifiers
    few = F.concat(F.lit("p"), (F.col("pmid").cast("long") % 90).cast("string"))
    rows = d.ident.select(few.alias("pmid"), "id", "role").distinct()
    return rows.groupBy("pmid").agg(*heads, F.array_join(F.slice(F.array_sort(F.collect_list("id")), 1, NAMED), ";").alias("named"))


@query("top_receipt_order", """SELECT l.coreproject, p.pmid, CAST(ROW_NUMBER() OVER (PARTITION BY l.coreproject ORDER BY p.pub_date NULLS FIRST, CAST(p.pmid AS BIGINT)) AS INT) AS rank
    FROM {link} l JOIN {paper} p ON l.pmid = p.pmid""")
def top_receipt_order(d: Data) -> DataFrame:
    """An award's papers as rows in the order of their dates; files nest them."""
    order = Window.partitionBy("coreproject").orderBy("pub_date", F.col("pmid").cast("long"))
    return d.link.join(d.paper.select("pmid", "pub_date"), "pmid").select("coreproject", "pmid", F.row_number().over(order).alias("rank"))


def apportion(counts: DataFrame, total: int, least: int = 2, unweighed: str = "NOT_CHECKABLE") -> DataFrame:
    """counts (label, n, n_reviewed) with quota and reviewed_quota, on two levels.

    Each label gets `least`, the rest is shared out in proportion to n, rounded by largest remainder (ties in the order
    of LABELS); `unweighed` takes no part in that. A label gets no more than it has. Of its quota a third, one at
    least, is kept for reviewed papers, as far as there are any. Labels are few; their table is one partition.
    """
    w = Window.partitionBy(F.lit(0))
    place = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in LABELS]), F.col("label")), F.lit(0))
    weight = F.when(F.col("label") == unweighed, 0).otherwise(F.col("n"))
    c = counts.withColumns({"_base": F.least(F.col("n"), F.lit(least)), "_weight": weight, "_place": place})
    # whole numbers only: floor and remainder of free * weight / sum of weights
    c = c.withColumn("_free", F.greatest(F.lit(total) - F.sum("_base").over(w), F.lit(0))).withColumn("_sum", F.greatest(F.sum("_weight").over(w), F.lit(1)))
    c = c.withColumn("_whole", F.expr("_free * _weight div _sum")).withColumn("_rest", F.expr("_free * _weight % _sum"))
    # those that take no part come last
    k = F.row_number().over(w.orderBy((F.col("_weight") == 0).cast("int"), F.desc("_rest"), "_place", "label"))
    more = ((k <= F.col("_free") - F.sum("_whole").over(w)) & (F.col("_weight") > 0)).cast("int")
    quota = F.least(F.col("n"), F.col("_base") + F.col("_whole") + more).cast("long")
    third = F.least(F.col("n_reviewed"), F.greatest(F.lit(1), F.floor(F.col("quota") / 3))).cast("long")
    return c.withColumn("quota", quota).withColumn("reviewed_quota", F.least(third, F.col("quota"))).select("label", "n", "n_reviewed", "quota", "reviewed_quota")


@query("top_apportion", f"""WITH c AS (SELECT label, COUNT(*) AS n, COUNT(CASE WHEN label_source = 'review' THEN 1 END) AS n_reviewed, COALESCE(list_position({LABELS}, label), 0) AS place FROM {{labelled}} WHERE label <> 'NEEDS_REVIEW' GROUP BY label),
    b AS (SELECT *, LEAST(n, 2) AS base, CASE WHEN label = 'NOT_CHECKABLE' THEN 0 ELSE n END AS weight FROM c), f AS (SELECT *, CAST(100 - SUM(base) OVER () AS BIGINT) AS free, CAST(SUM(weight) OVER () AS BIGINT) AS s FROM b),
    w AS (SELECT *, free * weight // s AS whole, free * weight % s AS rest FROM f), k AS (SELECT *, ROW_NUMBER() OVER (ORDER BY CASE WHEN weight = 0 THEN 1 ELSE 0 END, rest DESC, place, label) AS k, SUM(whole) OVER () AS used FROM w),
    q AS (SELECT *, CAST(LEAST(n, base + whole + CASE WHEN weight > 0 AND k <= free - used THEN 1 ELSE 0 END) AS BIGINT) AS quota FROM k)
    SELECT label, n, n_reviewed, quota, CAST(LEAST(n_reviewed, GREATEST(1, quota // 3), quota) AS BIGINT) AS reviewed_quota FROM q""")
def top_apportion(d: Data) -> DataFrame:
    papers = d.labelled.where("label <> 'NEEDS_REVIEW'")
    return apportion(papers.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("label_source") == "review").alias("n_reviewed")), 100)


@query("top_quota_scale", """SELECT label, COUNT(*) AS n, CAST(LEAST(COUNT(*), (COUNT(*) * 60 + (SELECT COUNT(*) FROM {labelled}) - 1) // (SELECT COUNT(*) FROM {labelled})) AS BIGINT) AS quota
    FROM {labelled} GROUP BY label""")
def top_quota_scale(d: Data) -> DataFrame:
    counts = d.labelled.groupBy("label").agg(F.count("*").alias("n"))
    counts = counts.withColumn("all", F.sum("n").over(Window.partitionBy(F.lit(0))))
    return counts.select("label", "n", F.least(F.col("n"), F.expr("(n * 60 + all - 1) div all")).alias("quota"))


# ---------------------------------------------------------------- decision rules

_FACTS = """SELECT pmid, MAX(CASE WHEN role = 'generated' AND cls IN ('public', 'generic', 'code') THEN 1 ELSE 0 END) AS own_public,
    MAX(CASE WHEN role = 'generated' AND cls = 'controlled' THEN 1 ELSE 0 END) AS own_controlled,
    MAX(CASE WHEN role = 'generated' AND cls = 'url' THEN 1 ELSE 0 END) AS own_url, MAX(CASE WHEN role = 'unknown' AND cls <> 'url' THEN 1 ELSE 0 END) AS unknown,
    MAX(CASE WHEN role = 'reused' AND cls <> 'url' THEN 1 ELSE 0 END) AS reused, MAX(CASE WHEN role = 'reused' AND in_das THEN 1 ELSE 0 END) AS reused_in_das, """ + ", ".join(f"array_to_string(list_sort(list_distinct(list(repo || ':' || id) FILTER (WHERE role = '{r}' AND cls <> 'url')))[1:4], ', ') AS {r}_heads" for r in ("generated", "unknown", "reused")) + """
    FROM {ident} GROUP BY pmid"""


def statement_cues(d: Data) -> DataFrame:
    """Cues of statements, derived from the paper's number."""
    k = F.col("pmid").cast("long")
    return d.paper.select(
        "pmid", (k % 4 == 0).alias("on_request"), (k % 5 == 1).alias("in_article"), (k % 6 == 2).alias("no_data"), (k % 11 == 3).alias("will_deposit"),
        (k % 13 == 4).alias("controlled_gen"), (k % 3 == 1).alias("reuse_in_statement"), (k % 9 == 5).alias("gen_in_statement"),
        F.when(k % 7 < 4, "section").otherwise("none").alias("statement_kind"),
    )


_RULES = [
    ("fulltext_source IS NULL", "NOT_CHECKABLE", "'no open full text'"),
    ("own_public = 1", "PUBLIC_REPOSITORY", "'own deposits: ' || COALESCE(generated_heads, '')"),
    ("own_controlled = 1", "CONTROLLED_ACCESS", "'own deposits under controlled access: ' || COALESCE(generated_heads, '')"),
    ("n % 13 = 4 AND n % 4 <> 0", "CONTROLLED_ACCESS", "'own data under controlled access, without an accession'"),
    ("title = 'A review of the field'", "NO_DATA_GENERATED", "'the title names a review'"),
    ("unknown = 1", "NEEDS_REVIEW", "'unclear whether own: ' || COALESCE(unknown_heads, '')"),
    ("own_url = 1", "NEEDS_REVIEW", "'shared at a link of no known repository'"),
    ("n % 13 = 4", "NEEDS_REVIEW", "'controlled access and on request'"),
    ("n % 11 = 3 AND n % 4 <> 0", "NEEDS_REVIEW", "'a deposit is promised'"),
    ("n % 4 = 0 AND n % 5 <> 1", "ON_REQUEST", "'on request'"),
    ("n % 5 = 1", "IN_ARTICLE", "CASE WHEN n % 4 = 0 THEN 'in the article, the rest on request' ELSE 'in the article' END"),
    ("n % 6 = 2 AND (n % 3 = 1 OR COALESCE(reused_in_das, 0) = 1)", "REUSED_ONLY", "'no new data; reused: ' || COALESCE(reused_heads, '')"),
    ("n % 6 = 2", "NO_DATA_GENERATED", "'the statement says that there are no data'"),
    ("n % 7 < 4 AND (n % 3 = 1 OR COALESCE(reused, 0) = 1) AND n % 9 <> 5", "REUSED_ONLY", "'reused: ' || COALESCE(reused_heads, '')"),
    ("n % 7 < 4", "NEEDS_REVIEW", "'a statement that no rule reads'"),
    ("pub_type = 'editorial'", "NO_DATA_GENERATED", "'no research article'"),
]
_LABELLED = f"""WITH f AS ({_FACTS}), k AS (SELECT *, CAST(pmid AS BIGINT) AS n FROM {{paper}})
    SELECT k.pmid, CASE {" ".join(f"WHEN {w} THEN '{x}'" for w, x, _ in _RULES)} ELSE 'NO_STATEMENT' END AS label, substr(CASE {" ".join(f"WHEN {w} THEN {r}" for w, _, r in _RULES)} ELSE 'no statement found' END, 1, 300) AS reason
    FROM k LEFT JOIN f ON k.pmid = f.pmid"""


def labels_of(d: Data) -> DataFrame:
    facts = P.identifier_facts(d.ident)
    papers = d.paper.join(facts, "pmid", "left").join(statement_cues(d), "pmid", "left")
    return P.label(papers).select("pmid", "label", "reason")


@query("cls_label", _LABELLED)
def cls_label(d: Data) -> DataFrame:
    return labels_of(d)


@query("cls_review_title", "SELECT pmid, title = 'A review of the field' AS is_review FROM {paper}")
def cls_review_title(d: Data) -> DataFrame:
    return d.paper.select("pmid", P.review_title(F.col("title")).alias("is_review"))


@query("cls_non_research", "SELECT pmid, pub_type = 'editorial' AS non_research FROM {paper}")
def cls_non_research(d: Data) -> DataFrame:
    return d.paper.select("pmid", P.non_research(F.col("pub_type")).alias("non_research"))


@query("cls_flags", f"""SELECT i.pmid, COALESCE(string_agg(CASE WHEN {OWN} AND s.status IN ('NOT_FOUND', 'PRIVATE') THEN i.id END, ';' ORDER BY i.id), '') AS dead_ids,
    MAX(CASE WHEN {OWN} AND is_code THEN 1 ELSE 0 END) = 1 AS code_shared,
    MAX(CASE WHEN {OWN} AND NOT is_code THEN 1 ELSE 0 END) = 1 AND MAX(CASE WHEN role = 'reused' AND cls <> 'url' THEN 1 ELSE 0 END) = 1 AS mixed
    FROM {{ident}} i LEFT JOIN {{status}} s ON i.repo = s.repo AND i.id = s.id GROUP BY i.pmid""")
def cls_flags(d: Data) -> DataFrame:
    j = d.ident.join(d.status, ["repo", "id"], "left")
    own = (F.col("role") == "generated") & (F.col("cls") != "url")
    dead = F.when(own & F.col("status").isin("NOT_FOUND", "PRIVATE"), F.col("id"))
    return j.groupBy("pmid").agg(
        F.array_join(F.array_sort(F.collect_list(dead)), ";").alias("dead_ids"), F.bool_or(own & F.col("is_code")).alias("code_shared"),
        (F.bool_or(own & ~F.col("is_code")) & F.bool_or((F.col("role") == "reused") & (F.col("cls") != "url"))).alias("mixed"),
    )


def overrides(d: Data) -> DataFrame:
    k = F.col("doc_id")
    return d.labels.select(
        k.cast("string").alias("pmid"), F.when(F.col("quality") == 1, "ON_REQUEST").otherwise("IN_ARTICLE").alias("label"),
        F.when(k % 3 == 0, " Yes ").when(k % 3 == 1, "no").otherwise("").alias("mixed"), F.when(F.col("toxic") == 1, "y").alias("code_shared"),
        F.when(k % 2 == 0, F.concat(F.lit(" read as "), k.cast("string"))).otherwise(" ").alias("note"),
    )


@query("cls_override", """SELECT p.pmid, COALESCE(CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.quality = 1 THEN 'ON_REQUEST' ELSE 'IN_ARTICLE' END END, p.label) AS label,
    CASE WHEN l.doc_id IS NOT NULL THEN 'review' ELSE 'rules' END AS label_source,
    CASE WHEN l.doc_id % 3 = 0 THEN TRUE WHEN l.doc_id % 3 = 1 THEN FALSE ELSE CAST(p.pmid AS BIGINT) % 2 = 0 END AS mixed,
    CASE WHEN l.toxic = 1 THEN TRUE ELSE FALSE END AS code_shared,
    CASE WHEN l.doc_id IS NULL THEN 'by rule' WHEN l.doc_id % 2 = 0 THEN 'read as ' || CAST(l.doc_id AS STRING) ELSE 'reviewed' END AS reason
    FROM {labelled} p LEFT JOIN {labels} l ON p.pmid = CAST(l.doc_id AS STRING)""")
def cls_override(d: Data) -> DataFrame:
    papers = d.labelled.select("pmid", "label", (F.col("pmid").cast("long") % 2 == 0).alias("mixed"), F.lit(False).alias("code_shared"), F.lit("by rule").alias("reason"))
    return P.override(papers, overrides(d)).select("pmid", "label", "label_source", "mixed", "code_shared", "reason")


@query("cls_triage", "SELECT repo, id, tier FROM {candidate}")
def cls_triage(d: Data) -> DataFrame:
    own = M.own_identifiers(d.ident)
    confirmed = own.join(d.record_pmid, ["repo", "id", "pmid"], "left_semi").select("repo", "id").distinct().withColumn("sure", F.lit(True))
    g = own.groupBy("repo", "id").agg(F.bool_or("in_das").alias("explicit"))
    # an identifier that is checked several times has the first of its statuses by name
    status = d.status.groupBy("repo", "id").agg(F.min("status").alias("status"))
    g = g.join(status, ["repo", "id"], "left").join(confirmed, ["repo", "id"], "left")
    return g.select("repo", "id", P.triage(F.col("status"), F.coalesce("sure", F.lit(False)), F.col("explicit")).alias("tier"))


@query("cls_catalog_signal", f"""WITH c AS (SELECT acc, MAX(CASE WHEN pmid IS NULL THEN 0 ELSE 1 END) AS has FROM (SELECT k.acc, p.pmid FROM (SELECT DISTINCT acc FROM {{catalog}}) k
      LEFT JOIN {{catalog_pmid}} p ON k.acc = p.acc) t GROUP BY acc)
    SELECT i.pmid, i.id, CASE WHEN c.acc IS NULL THEN 'not listed' WHEN p.pmid IS NOT NULL THEN 'this paper' WHEN c.has = 1 THEN 'other papers only' ELSE 'no paper' END AS outcome
    FROM {{ident}} i LEFT JOIN c ON lower(i.id) = c.acc LEFT JOIN {{catalog_pmid}} p ON p.acc = c.acc AND p.pmid = i.pmid WHERE {OWN} AND NOT is_code""")
def cls_catalog_signal(d: Data) -> DataFrame:
    from ..operators.catalog import signal

    return signal(M.own_data(d.ident), d.catalog, d.catalog_pmid).select("pmid", "id", "outcome")


ANSWER = "concat('LABEL: ', label, '\nMIXED: no\nCONFIDENCE: ', case when cast(pmid as bigint) % 3 = 0 then 'high' else 'low' end)"


@query("cls_parse_answer", """SELECT pmid, CASE WHEN label = 'NO_STATEMENT' THEN 'UNPARSED' ELSE label END AS label, FALSE AS mixed,
    CASE WHEN CAST(pmid AS BIGINT) % 3 = 0 THEN 'high' ELSE 'low' END AS conf FROM {labelled}""")
def cls_parse_answer(d: Data) -> DataFrame:
    text = F.expr(ANSWER)
    line = lambda k: F.trim(F.regexp_extract(text, rf"(?im)^{k}\s*:\s*(.+)$", 1))
    known = ["PUBLIC_REPOSITORY", "CONTROLLED_ACCESS", "ON_REQUEST", "IN_ARTICLE", "NEEDS_REVIEW", "NOT_CHECKABLE"]
    said = F.upper(line("LABEL"))
    label = F.when(said.isin(known), said).otherwise("UNPARSED")
    return d.labelled.select("pmid", label.alias("label"), (F.lower(line("MIXED")) == "yes").alias("mixed"), F.lower(line("CONFIDENCE")).alias("conf"))


# ---------------------------------------------------------------- scalar functions


@query("fn_date", """SELECT pmid, CASE WHEN CAST(pmid AS BIGINT) % 4 = 0 THEN make_date(year(pub_date), 1, 1) WHEN CAST(pmid AS BIGINT) % 4 = 1 THEN NULL ELSE pub_date END AS d,
    pub_date AS m, date_diff('day', DATE '1995-01-01', pub_date) AS days, CAST(pub_date - INTERVAL 365 DAY AS DATE) AS year_before FROM {paper} WHERE pub_date IS NOT NULL""")
def fn_date(d: Data) -> DataFrame:
    k = F.col("pmid").cast("long") % 4
    text = F.when(k == 0, F.date_format("pub_date", "yyyy")).when(k == 1, F.lit("unknown")).otherwise(F.date_format("pub_date", "yyyy-MM-dd"))
    return d.paper.where("pub_date IS NOT NULL").select(
        "pmid", C.iso_date(text).alias("d"), C.month_date(F.date_format("pub_date", "MMM  dd yyyy")).alias("m"),
        F.datediff("pub_date", F.lit("1995-01-01").cast("date")).cast("long").alias("days"), F.date_sub("pub_date", 365).alias("year_before"),
    )


@query("fn_string", r"""SELECT doc_id, trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')) AS flat, CASE WHEN length(trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g'))) <= 80
    THEN trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')) ELSE rtrim(substr(trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')), 1, 79)) || '…' END AS clipped FROM {documents}""")
def fn_string(d: Data) -> DataFrame:
    flat = F.trim(F.regexp_replace("text", r"\s+", " "))
    return d.documents.select("doc_id", flat.alias("flat"), C.clip(F.col("text"), 80).alias("clipped"))


def norm_sql(x: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({x})), '^https?://', ''), '^www\.', ''), '/+$', ''), '\.git$', '')"


_HOST = "regexp_extract(url, '(?i)^((?:https?://)?[^/]*)', 1)"


@query("fn_url", f"SELECT acc, {norm_sql('url')} AS norm, lower({_HOST}) || substr(url, length({_HOST}) + 1) AS low FROM {{catalog}}")
def fn_url(d: Data) -> DataFrame:
    return d.catalog.select("acc", C.norm_url(F.col("url")).alias("norm"), C.lower_host(F.col("url")).alias("low"))


_HEX = "lower(sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(repo || '|' || id)))"


@query("fn_uuid5", f"""WITH h AS (SELECT repo, id, {_HEX} AS h FROM {{status}})
    SELECT repo, id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
      CASE WHEN substr(h, 17, 1) IN ('0', '4', '8', 'c') THEN '8' WHEN substr(h, 17, 1) IN ('1', '5', '9', 'd') THEN '9' WHEN substr(h, 17, 1) IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END
      || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM h""")
def fn_uuid5(d: Data) -> DataFrame:
    return d.status.select("repo", "id", C.uuid5(F.concat_ws("|", "repo", "id")).alias("uuid"))


@query("fn_array", """SELECT pmid, string_agg(DISTINCT repo, ';' ORDER BY repo) AS repos, MIN(ord) AS first_ord, MAX(CASE WHEN repo = 'GEO' THEN 1 ELSE 0 END) = 1 AS has_geo,
    MIN(CASE WHEN cls = 'public' THEN 1 ELSE 0 END) = 1 AS all_public FROM {ident} GROUP BY pmid""")
def fn_array(d: Data) -> DataFrame:
    g = d.ident.groupBy("pmid").agg(F.array_sort(F.collect_set("repo")).alias("r"), F.collect_list("ord").alias("o"), F.collect_list("cls").alias("c"))
    return g.select(
        "pmid", F.array_join("r", ";").alias("repos"), F.array_min("o").alias("first_ord"), F.arrays_overlap("r", F.array(F.lit("GEO"))).alias("has_geo"),
        F.forall("c", lambda x: x == "public").alias("all_public"),
    )


@query("fn_map", """WITH l AS (SELECT UNNEST(['PUBLIC_REPOSITORY', 'ON_REQUEST', 'REUSED_ONLY']) AS label), c AS (SELECT label, COUNT(*) AS n FROM {labelled} GROUP BY label)
    SELECT l.label, COALESCE(c.n, 0) AS n FROM l LEFT JOIN c ON l.label = c.label""")
def fn_map(d: Data) -> DataFrame:
    names = ["PUBLIC_REPOSITORY", "ON_REQUEST", "REUSED_ONLY"]
    one = d.labelled.agg(*[F.count_if(F.col("label") == x).alias(x) for x in names])
    counts = F.map_from_arrays(F.array(*[F.lit(x) for x in names]), F.array(*names))
    return one.select(F.explode(counts).alias("label", "n"))


@query("fn_json", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none.deep') AS missing FROM {events}""")
def fn_json(d: Data) -> DataFrame:
    p = F.from_json("props", "k long, none struct<deep:string>")
    return d.events.select("event_id", p["k"].alias("k"), p["none"]["deep"].alias("missing"))


@query("fn_math", """SELECT label, CAST(SUM(CASE WHEN label_source = 'review' THEN 1 ELSE 0 END) AS BIGINT) AS a, COUNT(*) AS b,
    100.0::DOUBLE * SUM(CASE WHEN label_source = 'review' THEN 1 ELSE 0 END) / COUNT(*) AS pct, CAST(NULL AS DOUBLE) AS none FROM {labelled} GROUP BY label""")
def fn_math(d: Data) -> DataFrame:
    a, b = F.count_if(F.col("label_source") == "review"), F.count("*")
    g = d.labelled.groupBy("label").agg(a.alias("a"), b.alias("b"))
    return g.select("label", "a", "b", C.percent(F.col("a"), F.col("b")).alias("pct"), C.percent(F.col("a"), F.lit(0)).alias("none"))


@query("fn_epmc_link", """SELECT pmid, CASE WHEN pmcid IS NOT NULL THEN 'https://europepmc.org/article/PMC/' || pmcid ELSE 'https://europepmc.org/article/MED/' || pmid END AS link FROM {paper}""")
def fn_epmc_link(d: Data) -> DataFrame:
    return d.paper.select("pmid", C.article_link(F.col("pmcid"), F.col("pmid")).alias("link"))
