"""Queries of aggregations: awards, receipts, summaries, catalog recall, agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.columns import percent
from ..operators import catalog as K
from ..operators import mentions as M
from ..operators import papers as P
from ..operators import records as R
from ..rules import LABELS, MAIN_REPOSITORIES
from .base import Data, query
from .q_joins import _EARLY as EARLY
from .q_joins import _ALIAS, _LISTED, early_publications, join_catalog_papers, join_pubmed_links
from .q_links import _CHECK, STUDY_SQL, studies, tiers
from .q_rows import OWN, statement_cues

MAIN = ", ".join(f"'{x}'" for x in MAIN_REPOSITORIES)
LABEL_ROWS = " UNION ALL ".join(f"SELECT '{x}' AS label" for x in LABELS)


def award_rollup(projects: DataFrame) -> DataFrame:
    """Yearly projects to awards: the first title, organization and dates by application, numbers in order, summed amounts."""
    first = lambda c: F.min_by(c, "appl_id")
    return projects.groupBy("core_project_num").agg(
        first("title").alias("title"), first("org").alias("org"), first("start_date").alias("start_date"),
        F.array_join(F.array_sort(F.collect_set("project_num")), ";").alias("project_nums"),
        F.sum(F.coalesce("amount", F.lit(0))).alias("amount"), F.count("*").alias("n_projects"),
    )


@query("agg_award_rollup", """SELECT core_project_num, arg_min(title, appl_id) AS title, arg_min(org, appl_id) AS org, arg_min(start_date, appl_id) AS start_date,
    string_agg(DISTINCT project_num, ';' ORDER BY project_num) AS project_nums, CAST(SUM(COALESCE(amount, 0)) AS BIGINT) AS amount, COUNT(*) AS n_projects FROM {project} GROUP BY core_project_num""")
def agg_award_rollup(d: Data) -> DataFrame:
    return award_rollup(d.project)


@query("agg_paper_awards", "SELECT pmid, string_agg(DISTINCT coreproject, ';' ORDER BY coreproject) AS awards FROM {link} GROUP BY pmid")
def agg_paper_awards(d: Data) -> DataFrame:
    return d.link.groupBy("pmid").agg(F.array_join(F.array_sort(F.collect_set("coreproject")), ";").alias("awards"))


def receipts(awards: DataFrame, links: DataFrame, labelled: DataFrame, identifiers: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row for each award, with zeros for one without papers: papers, checkable papers and their share, a count of each
    label, papers with new data, code, both new and reused data, or a dead link; different dead identifiers and repositories."""
    pairs = links.select("coreproject", "pmid").distinct()
    own = M.own_identifiers(identifiers)
    papers = pairs.join(labelled.select("pmid", "label", "fulltext_source"), "pmid").join(P.flags(identifiers, statuses), "pmid", "left")
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    per = papers.groupBy("coreproject").agg(
        F.count("*").alias("n_papers"), F.count("fulltext_source").alias("n_checkable"), *[n(F.col("label") == x).alias(f"n_{x.lower()}") for x in LABELS],
        n(F.col("new_data")).alias("n_new_data"), n(F.col("code_shared")).alias("n_code"), n(F.col("mixed")).alias("n_mixed"), n(F.col("link_dead")).alias("n_link_dead"),
    )
    repos = pairs.join(own.select("pmid", "repo").distinct(), "pmid").groupBy("coreproject").agg(F.count_distinct("repo").alias("n_repositories"))
    dead = own.join(statuses.where(F.col("status").isin(P.DEAD)).select("repo", "id"), ["repo", "id"], "left_semi").select("pmid", "id")
    dead = pairs.join(dead, "pmid").groupBy("coreproject").agg(F.count_distinct("id").alias("n_dead_ids"))
    j = awards.select(F.col("core_project_num").alias("coreproject"))
    for x in (per, repos, dead):
        j = j.join(x, "coreproject", "left")
    j = j.na.fill(0)
    return j.withColumn("any_public_deposit", F.col("n_public_repository") > 0).withColumn("coverage_pct", percent(F.col("n_checkable"), F.col("n_papers")))


# new data, code, both new and reused data, and dead links of papers
_FLAGS = f"""SELECT i.pmid, MAX(CASE WHEN {OWN} AND NOT is_code THEN 1 ELSE 0 END) AS nd, MAX(CASE WHEN {OWN} AND is_code THEN 1 ELSE 0 END) AS cd,
    MAX(CASE WHEN role = 'reused' AND cls <> 'url' THEN 1 ELSE 0 END) AS ru, MAX(CASE WHEN {OWN} AND s.status IN ('NOT_FOUND', 'PRIVATE') THEN 1 ELSE 0 END) AS dl
    FROM {{ident}} i LEFT JOIN {{status}} s ON i.repo = s.repo AND i.id = s.id GROUP BY i.pmid"""
_RECEIPT = f"""WITH f AS ({_FLAGS}),
    p AS (SELECT l.coreproject, l.pmid, b.label, b.fulltext_source, f.* EXCLUDE (pmid) FROM {{link}} l JOIN {{labelled}} b ON l.pmid = b.pmid LEFT JOIN f ON f.pmid = l.pmid),
    r AS (SELECT l.coreproject, COUNT(DISTINCT i.repo) AS n, COUNT(DISTINCT CASE WHEN s.status IN ('NOT_FOUND', 'PRIVATE') THEN i.id END) AS dead
      FROM {{link}} l JOIN {{ident}} i ON l.pmid = i.pmid LEFT JOIN {{status}} s ON i.repo = s.repo AND i.id = s.id WHERE {OWN} GROUP BY l.coreproject)
    SELECT a.core_project_num AS coreproject, COUNT(p.pmid) AS n_papers, COUNT(p.fulltext_source) AS n_checkable,
    {", ".join(f"COUNT(CASE WHEN p.label = '{x}' THEN 1 END) AS n_{x.lower()}" for x in LABELS)},
    COUNT(CASE WHEN p.nd = 1 THEN 1 END) AS n_new_data, COUNT(CASE WHEN p.cd = 1 THEN 1 END) AS n_code, COUNT(CASE WHEN p.nd = 1 AND p.ru = 1 THEN 1 END) AS n_mixed,
    COUNT(CASE WHEN p.dl = 1 THEN 1 END) AS n_link_dead, COALESCE(MAX(r.n), 0) AS n_repositories, COALESCE(MAX(r.dead), 0) AS n_dead_ids,
    COUNT(CASE WHEN p.label = 'PUBLIC_REPOSITORY' THEN 1 END) > 0 AS any_public_deposit, 100.0::DOUBLE * COUNT(p.fulltext_source) / NULLIF(COUNT(p.pmid), 0) AS coverage_pct
    FROM {{award}} a LEFT JOIN p ON a.core_project_num = p.coreproject LEFT JOIN r ON a.core_project_num = r.coreproject GROUP BY a.core_project_num"""


@query("agg_receipt", _RECEIPT)
def agg_receipt(d: Data) -> DataFrame:
    return receipts(d.award, d.link, d.labelled, d.ident, d.status)


@query("agg_label_counts", f"""WITH l AS ({LABEL_ROWS}), g AS (SELECT label, label_source, COUNT(*) AS n FROM {{labelled}} GROUP BY GROUPING SETS ((label), (label_source), (label, label_source)))
    SELECT label, label_source, n FROM g UNION ALL SELECT l.label, NULL, 0 FROM l WHERE l.label NOT IN (SELECT label FROM {{labelled}})""")
def agg_label_counts(d: Data) -> DataFrame:
    sets = d.labelled.groupingSets([["label"], ["label_source"], ["label", "label_source"]], "label", "label_source").agg(F.count("*").alias("n"))
    names = d.spark.createDataFrame([(x,) for x in LABELS], "label string")
    none = names.join(d.labelled.select("label").distinct(), "label", "left_anti").select("label", F.lit(None).cast("string").alias("label_source"), F.lit(0).cast("long").alias("n"))
    return sets.select("label", "label_source", "n").unionByName(none)


@query("agg_shares", """SELECT label, COUNT(*) AS n, 100.0::DOUBLE * COUNT(*) / (SELECT COUNT(*) FROM {labelled} WHERE label <> 'NOT_CHECKABLE') AS share FROM {labelled}
    WHERE label <> 'NOT_CHECKABLE' GROUP BY label""")
def agg_shares(d: Data) -> DataFrame:
    counts = d.labelled.where("label <> 'NOT_CHECKABLE'").groupBy("label").agg(F.count("*").alias("n"))
    return counts.withColumn("share", percent(F.col("n"), F.sum("n").over(Window.partitionBy(F.lit(0)))))


@query("agg_funnel", """SELECT 'awards' AS step, COUNT(*) AS n FROM {award} UNION ALL SELECT 'awards with papers', COUNT(DISTINCT coreproject) FROM {link}
    UNION ALL SELECT 'papers', COUNT(*) FROM {paper} UNION ALL SELECT 'with pmcid', COUNT(pmcid) FROM {paper} UNION ALL SELECT 'full text', COUNT(fulltext_source) FROM {paper}
    UNION ALL SELECT 'statement', COUNT(CASE WHEN CAST(pmid AS BIGINT) % 7 < 4 THEN fulltext_source END) FROM {paper}
    UNION ALL SELECT 'public deposit', COUNT(CASE WHEN label = 'PUBLIC_REPOSITORY' THEN 1 END) FROM {labelled}""")
def agg_funnel(d: Data) -> DataFrame:
    awards = d.award.agg(F.count("*").alias("awards"))
    with_papers = d.link.agg(F.count_distinct("coreproject").alias("awards with papers"))
    stated = statement_cues(d).select("pmid", F.col("statement_kind") != "none")
    papers = d.paper.join(stated.toDF("pmid", "stated"), "pmid").agg(
        F.count("*").alias("papers"), F.count("pmcid").alias("with pmcid"), F.count("fulltext_source").alias("full text"),
        F.count(F.when(F.col("stated"), F.col("fulltext_source"))).alias("statement"),
    )
    deposits = d.labelled.agg(F.count_if(F.col("label") == "PUBLIC_REPOSITORY").alias("public deposit"))
    rows = [x.unpivot([], x.columns, "step", "n") for x in (awards, with_papers, papers, deposits)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query("agg_status_by_repo", f"""WITH o AS (SELECT DISTINCT i.repo, i.id, COALESCE(s.status, 'NOT_CHECKED') AS status FROM {{ident}} i LEFT JOIN {{status}} s ON i.repo = s.repo AND i.id = s.id WHERE {OWN})
    SELECT repo, status, COUNT(*) AS n FROM o GROUP BY ROLLUP (repo, status)""")
def agg_status_by_repo(d: Data) -> DataFrame:
    own = M.own_identifiers(d.ident).select("repo", "id").distinct().join(d.status, ["repo", "id"], "left")
    own = own.withColumn("status", F.coalesce("status", F.lit("NOT_CHECKED")))
    return own.rollup("repo", "status").agg(F.count("*").alias("n"))


def dead_rate(statuses: DataFrame) -> DataFrame:
    """Dead (not found, private), definite answers and their ratio."""
    dead = F.count_if(F.col("status").isin("NOT_FOUND", "PRIVATE"))
    sure = F.count_if(F.col("status").isin("RESOLVES", "NOT_FOUND", "PRIVATE", "RESTRICTED"))
    return statuses.agg(dead.alias("dead"), sure.alias("definite")).withColumn("rate", percent(F.col("dead"), F.col("definite")))


_DEAD = "COUNT(CASE WHEN s.status IN ('NOT_FOUND', 'PRIVATE') THEN 1 END)"
_SURE = "COUNT(CASE WHEN s.status IN ('RESOLVES', 'NOT_FOUND', 'PRIVATE', 'RESTRICTED') THEN 1 END)"


@query("agg_dead_rate", " UNION ALL ".join(f"""SELECT '{k}' AS kind, {_DEAD} AS dead, {_SURE} AS definite, 100.0::DOUBLE * {_DEAD} / NULLIF({_SURE}, 0) AS rate
    FROM (SELECT DISTINCT repo, id FROM {{ident}} WHERE role = 'generated' AND cls {op} 'url') i LEFT JOIN {{status}} s ON i.repo = s.repo AND i.id = s.id""" for k, op in (("identifiers", "<>"), ("links", "="))))
def agg_dead_rate(d: Data) -> DataFrame:
    own = d.ident.where("role = 'generated'")
    parts = [
        dead_rate(own.where(c).select("repo", "id").distinct().join(d.status, ["repo", "id"], "left")).select(F.lit(k).alias("kind"), "dead", "definite", "rate")
        for k, c in (("identifiers", "cls <> 'url'"), ("links", "cls = 'url'"))
    ]
    return parts[0].unionByName(parts[1])


@query("agg_repo_papers", "SELECT repo, COUNT(DISTINCT pmid) AS papers FROM {ident} WHERE role = 'generated' GROUP BY repo")
def agg_repo_papers(d: Data) -> DataFrame:
    return d.ident.where("role = 'generated'").groupBy("repo").agg(F.count_distinct("pmid").alias("papers"))


@query("agg_own_distinct", f"""WITH {STUDY_SQL}, o AS (SELECT i.pmid, i.repo, i.id, COALESCE(sg.study_group, i.repo || ':' || i.id) AS study FROM {{ident}} i LEFT JOIN sg ON i.repo = sg.repo AND i.id = sg.id WHERE {OWN} AND NOT is_code)
    SELECT COUNT(DISTINCT repo || '|' || id) AS accessions, COUNT(DISTINCT study) AS studies, COUNT(DISTINCT CASE WHEN repo NOT IN ({MAIN}) THEN repo || '|' || id END) AS outside,
    COUNT(DISTINCT CASE WHEN repo NOT IN ({MAIN}) THEN study END) AS outside_studies, COUNT(DISTINCT pmid) AS papers, COUNT(DISTINCT CASE WHEN repo = 'GEO' THEN pmid || '|' || id END) AS series_pairs,
    (SELECT COUNT(DISTINCT repo || '|' || id) FROM {{ident}} WHERE role = 'generated' AND cls = 'url') AS links FROM o""")
def agg_own_distinct(d: Data) -> DataFrame:
    own = M.own_data(d.ident)
    # each count over rows that are made distinct first, so that no aggregate expands its input
    known = own.select("repo", "id").distinct().join(studies(d), ["repo", "id"], "left").withColumn("study", F.coalesce("study_group", F.concat_ws(":", "repo", "id")))
    out = ~F.col("repo").isin(MAIN_REPOSITORIES)
    ids = known.agg(F.count("*").alias("accessions"), F.count_if(out).alias("outside"))
    groups = known.groupBy("study").agg(F.bool_or(out).alias("out")).agg(F.count("*").alias("studies"), F.count_if("out").alias("outside_studies"))
    papers = own.select("pmid").distinct().agg(F.count("*").alias("papers"))
    pairs = own.where("repo = 'GEO'").select("pmid", "id").distinct().agg(F.count("*").alias("series_pairs"))
    links = d.ident.where("role = 'generated' AND cls = 'url'").select("repo", "id").distinct().agg(F.count("*").alias("links"))
    return ids.crossJoin(groups).crossJoin(papers).crossJoin(pairs).crossJoin(links)  # one row each


@query("agg_only_outside", f"SELECT COUNT(*) AS papers FROM (SELECT pmid FROM {{ident}} WHERE {OWN} AND NOT is_code GROUP BY pmid HAVING MAX(CASE WHEN repo IN ({MAIN}) THEN 1 ELSE 0 END) = 0) t")
def agg_only_outside(d: Data) -> DataFrame:
    per = M.own_data(d.ident).groupBy("pmid").agg(F.bool_and(~F.col("repo").isin(MAIN_REPOSITORIES)).alias("out"))
    return per.where("out").agg(F.count("*").alias("papers"))


@query("agg_harvestable", f"""WITH o AS (SELECT i.id, CASE WHEN CAST(i.pmid AS BIGINT) % 6 = 0 THEN NULL WHEN r.id IS NOT NULL THEN 1 ELSE 0 END AS y FROM {{ident}} i
      LEFT JOIN {{record_pmid}} r ON r.repo = i.repo AND r.id = i.id AND r.pmid = i.pmid WHERE {OWN} AND i.repo = 'GEO')
    SELECT id, COUNT(y) AS checked, CAST(COALESCE(SUM(y), 0) AS BIGINT) AS linked, CASE WHEN MAX(y) = 1 THEN 'yes' WHEN MAX(y) = 0 THEN 'no' ELSE 'unknown' END AS harvestable,
    (SELECT 100.0::DOUBLE * SUM(y) / NULLIF(COUNT(y), 0) FROM o) AS linked_pct FROM o GROUP BY id""")
def agg_harvestable(d: Data) -> DataFrame:
    series = d.record_pmid.where("repo = 'GEO'").select("pmid", "id", F.lit(1).alias("found"))
    own = M.own_identifiers(d.ident).where("repo = 'GEO'").join(series, ["pmid", "id"], "left")
    y = F.when(F.col("pmid").cast("long") % 6 != 0, F.coalesce("found", F.lit(0)))
    g = own.withColumn("y", y).groupBy("id").agg(F.count("y").alias("checked"), F.coalesce(F.sum("y"), F.lit(0)).alias("linked"), F.max("y").alias("best"))
    share = g.agg(percent(F.sum("linked"), F.sum("checked")).alias("linked_pct"))
    g = g.crossJoin(share)  # one row
    return g.select("id", "checked", "linked", F.when(F.col("best") == 1, "yes").when(F.col("best") == 0, "no").otherwise("unknown").alias("harvestable"), "linked_pct")


@query("agg_award_shares", f"""WITH r AS ({_RECEIPT}), g AS (SELECT COUNT(*) AS awards, COUNT(CASE WHEN n_checkable > 0 THEN 1 END) AS with_checkable, COUNT(CASE WHEN any_public_deposit THEN 1 END) AS with_public,
      COUNT(CASE WHEN n_checkable > 0 AND any_public_deposit THEN 1 END) AS c_public, COUNT(CASE WHEN n_checkable > 0 AND n_new_data > 0 THEN 1 END) AS c_new, COUNT(CASE WHEN n_checkable > 0 AND n_code > 0 THEN 1 END) AS c_code,
      COUNT(CASE WHEN n_link_dead > 0 THEN 1 END) AS with_dead_link, COUNT(CASE WHEN n_checkable > 0 AND n_on_request + n_no_statement = n_checkable THEN 1 END) AS only_request FROM r)
    SELECT awards, with_checkable, with_public, with_dead_link, only_request, 100.0::DOUBLE * c_public / NULLIF(with_checkable, 0) AS public_pct, 100.0::DOUBLE * with_public / NULLIF(awards, 0) AS public_pct_all,
    100.0::DOUBLE * c_new / NULLIF(with_checkable, 0) AS new_data_pct, 100.0::DOUBLE * c_code / NULLIF(with_checkable, 0) AS code_pct, 100.0::DOUBLE * only_request / NULLIF(with_checkable, 0) AS only_request_pct FROM g""")
def agg_award_shares(d: Data) -> DataFrame:
    r = receipts(d.award, d.link, d.labelled, d.ident, d.status)
    c = F.col("n_checkable") > 0
    g = r.agg(
        F.count("*").alias("awards"), F.count_if(c).alias("with_checkable"), F.count_if("any_public_deposit").alias("with_public"), F.count_if(F.col("n_link_dead") > 0).alias("with_dead_link"),
        F.count_if(c & F.col("any_public_deposit")).alias("_public"), F.count_if(c & (F.col("n_new_data") > 0)).alias("_new"), F.count_if(c & (F.col("n_code") > 0)).alias("_code"),
        F.count_if(c & (F.col("n_on_request") + F.col("n_no_statement") == F.col("n_checkable"))).alias("only_request"),
    )
    of = lambda x: percent(F.col(x), F.col("with_checkable"))
    return g.select(
        "awards", "with_checkable", "with_public", "with_dead_link", "only_request", of("_public").alias("public_pct"), percent(F.col("with_public"), F.col("awards")).alias("public_pct_all"),
        of("_new").alias("new_data_pct"), of("_code").alias("code_pct"), of("only_request").alias("only_request_pct"),
    )


_BEST = f"""WITH o AS (SELECT i.repo, i.id, MAX(CASE WHEN r.pmid IS NOT NULL THEN 1 ELSE 0 END) AS cites, MAX(CASE WHEN k.id IS NOT NULL THEN 1 ELSE 0 END) AS has FROM {{ident}} i
      LEFT JOIN {{record_pmid}} r ON r.repo = i.repo AND r.id = i.id AND r.pmid = i.pmid LEFT JOIN {{record}} k ON k.repo = i.repo AND k.id = i.id WHERE {OWN} GROUP BY i.repo, i.id)
    SELECT repo, id, CASE WHEN has = 1 AND cites = 1 THEN 'cites_paper' WHEN has = 1 THEN '' ELSE 'not_read' END AS best_tier FROM o"""


_HEADLINE = f"""WITH f AS ({_FLAGS}), x AS ({EARLY}), bt AS ({_BEST}), g AS (SELECT COUNT(*) AS papers, COUNT(CASE WHEN lower(p.pub_type) LIKE '%preprint%' THEN 1 END) AS preprints, COUNT(p.fulltext_source) AS checkable,
      COUNT(CASE WHEN p.fulltext_source = 'epmc' THEN 1 END) AS from_epmc, COUNT(CASE WHEN p.fulltext_source = 'pmc' THEN 1 END) AS from_pmc, COUNT(pmcid) AS with_pmcid, COUNT(CASE WHEN CAST(p.pmid AS BIGINT) % 9 = 0 THEN p.fulltext_source END) AS manuscripts,
      COUNT(CASE WHEN p.fulltext_source IS NOT NULL AND b.label <> 'NO_DATA_GENERATED' THEN 1 END) AS research, COUNT(CASE WHEN CAST(p.pmid AS BIGINT) % 7 < 4 THEN p.fulltext_source END) AS stated,
      COUNT(CASE WHEN nd = 1 THEN p.fulltext_source END) AS new_data, COUNT(CASE WHEN cd = 1 THEN p.fulltext_source END) AS code,
      COUNT(CASE WHEN nd = 1 AND ru = 1 THEN p.fulltext_source END) AS mixed, COUNT(CASE WHEN dl = 1 THEN p.fulltext_source END) AS link_dead FROM {{paper}} p JOIN {{labelled}} b ON p.pmid = b.pmid LEFT JOIN f ON f.pmid = p.pmid)
    SELECT papers, (SELECT COUNT(DISTINCT pmid) FROM (SELECT pmid, bool_or(kept) AS k FROM x GROUP BY pmid) t WHERE NOT k) AS excluded_early, preprints, checkable, from_epmc, from_pmc, with_pmcid, manuscripts, (SELECT COUNT(*) FROM bt WHERE best_tier = 'cites_paper') AS tier_cites_paper, (SELECT COUNT(*) FROM bt WHERE best_tier = '') AS tier_none, (SELECT COUNT(*) FROM bt WHERE best_tier = 'not_read') AS tier_not_read, new_data, code, mixed, link_dead,
    100.0::DOUBLE * checkable / NULLIF(papers, 0) AS checkable_pct, 100.0::DOUBLE * stated / NULLIF(checkable, 0) AS statement_pct, 100.0::DOUBLE * code / NULLIF(checkable, 0) AS code_pct, 100.0::DOUBLE * code / NULLIF(research, 0) AS code_research_pct FROM g"""


@query("agg_headline", _HEADLINE)
def agg_headline(d: Data) -> DataFrame:
    p = d.paper.join(d.labelled.select("pmid", "label"), "pmid").join(statement_cues(d).select("pmid", "statement_kind"), "pmid").join(P.flags(d.ident, d.status), "pmid", "left")
    read = F.col("fulltext_source").isNotNull()
    g = p.agg(
        F.count("*").alias("papers"), F.count_if(F.lower("pub_type").contains("preprint")).alias("preprints"), F.count("fulltext_source").alias("checkable"),
        F.count_if(F.col("fulltext_source") == "epmc").alias("from_epmc"), F.count_if(F.col("fulltext_source") == "pmc").alias("from_pmc"), F.count("pmcid").alias("with_pmcid"), F.count_if(read & (F.col("pmid").cast("long") % 9 == 0)).alias("manuscripts"),
        F.count_if(read & (F.col("label") != "NO_DATA_GENERATED")).alias("_research"), F.count_if(read & (F.col("statement_kind") != "none")).alias("_stated"),
        F.count_if(read & F.col("new_data")).alias("new_data"), F.count_if(read & F.col("code_shared")).alias("code"), F.count_if(read & F.col("mixed")).alias("mixed"), F.count_if(read & F.col("link_dead")).alias("link_dead"),
    )
    early = early_publications(d.link, d.paper, d.award).where("excluded").select("pmid").distinct().agg(F.count("*").alias("excluded_early"))
    best = agg_record_tiers(d).agg(*[F.count_if(F.col("best_tier") == t).alias(f"tier_{n}") for t, n in (("cites_paper", "cites_paper"), ("", "none"), ("not_read", "not_read"))])
    g = g.crossJoin(early).crossJoin(best)  # one row each
    return g.withColumns({
        "checkable_pct": percent(F.col("checkable"), F.col("papers")), "statement_pct": percent(F.col("_stated"), F.col("checkable")),
        "code_pct": percent(F.col("code"), F.col("checkable")), "code_research_pct": percent(F.col("code"), F.col("_research")),
    }).drop("_research", "_stated")


@query("agg_record_tiers", _BEST)
def agg_record_tiers(d: Data) -> DataFrame:
    own = M.own_identifiers(d.ident).select("pmid", "repo", "id")
    cites = d.record_pmid.select("repo", "id", "pmid", F.lit("cites_paper").alias("said"))
    tiers = own.join(d.record.select("repo", "id"), ["repo", "id"], "left_semi").join(cites, ["repo", "id", "pmid"], "left")
    best = R.best_tiers(tiers.select("pmid", "repo", "id", F.coalesce("said", F.lit("")).alias("record_tier")))
    return own.select("repo", "id").distinct().join(best, ["repo", "id"], "left").select("repo", "id", F.coalesce("best_tier", F.lit("not_read")).alias("best_tier"))


_RANKED = "CASE t.record_tier WHEN 'cites_paper' THEN 0 WHEN 'names_award' THEN 1 WHEN 'authors' THEN 2 WHEN 'contradicted' THEN 3 ELSE 4 END"
_CAND = _CHECK + f""", {STUDY_SQL}, o AS (SELECT * FROM {{ident}} WHERE {OWN}),
    w AS (SELECT o.repo, o.id, COUNT(DISTINCT l.coreproject) AS n_awards, string_agg(DISTINCT l.coreproject, ';' ORDER BY l.coreproject) AS awards FROM o JOIN {{link}} l ON o.pmid = l.pmid GROUP BY o.repo, o.id),
    v AS (SELECT o.repo, o.id, arg_min(t.record_tier, {_RANKED} * 10000000000 + CAST(o.pmid AS BIGINT)) AS record_tier, arg_min(CASE WHEN t.record_tier = 'names_award' THEN t.shared ELSE '' END, {_RANKED} * 10000000000 + CAST(o.pmid AS BIGINT)) AS record_note
      FROM o JOIN t ON t.pmid = o.pmid AND t.repo = o.repo AND t.id = o.id GROUP BY o.repo, o.id),
    h AS (SELECT o.id, MAX(CASE WHEN CAST(o.pmid AS BIGINT) % 6 = 0 THEN 0 WHEN r.id IS NOT NULL THEN 2 ELSE 1 END) AS h FROM o LEFT JOIN {{record_pmid}} r ON r.repo = o.repo AND r.id = o.id AND r.pmid = o.pmid WHERE o.repo = 'GEO' GROUP BY o.id),
    q AS (SELECT repo, id, COUNT(*) AS n_papers, string_agg(pmid, ';' ORDER BY CAST(pmid AS BIGINT)) AS pmids, bool_or(in_das AND evidence LIKE 'cue%') AS explicit, arg_min(is_code, CAST(pmid AS BIGINT)) AS is_code FROM o GROUP BY repo, id),
    made AS (SELECT q.repo, q.id, CASE WHEN q.is_code THEN 'code' ELSE 'dataset' END AS type, n_papers, COALESCE(w.n_awards, 0) AS n_awards, COALESCE(s.status, 'NOT_CHECKED') AS status, q.is_code,
      CASE WHEN q.repo <> 'GEO' THEN '' ELSE CASE h.h WHEN 2 THEN 'yes' WHEN 1 THEN 'no' ELSE '' END END AS harvestable, COALESCE(sg.study_group, q.repo || ':' || q.id) AS study_group,
      COALESCE(v.record_tier, 'not_read') AS record_tier, COALESCE(v.record_note, '') AS record_note,
      CASE WHEN COALESCE(s.status, '') = 'RESOLVES' AND v.record_tier IN ('cites_paper', 'names_award', 'authors') THEN 1 WHEN COALESCE(s.status, '') = 'RESOLVES' AND explicit THEN 2 ELSE 3 END AS tier, pmids, COALESCE(w.awards, '') AS awards
      FROM q LEFT JOIN w ON q.repo = w.repo AND q.id = w.id LEFT JOIN v ON q.repo = v.repo AND q.id = v.id LEFT JOIN h ON q.repo = 'GEO' AND q.id = h.id LEFT JOIN sg ON q.repo = sg.repo AND q.id = sg.id LEFT JOIN {{status}} s ON q.repo = s.repo AND q.id = s.id)
    SELECT * FROM made"""


def candidate_rows(d: Data) -> DataFrame:
    awards = d.link.select("pmid", F.col("coreproject").alias("core"))
    # d is landed by the query: a dozen joins read the identifiers
    return P.candidates(d.ident, d.status, tiers(d), awards, join_pubmed_links(d), studies(d), F.col("evidence").startswith("cue"))


@query("agg_candidates", _CAND.replace("SELECT * FROM made", "SELECT * EXCLUDE (pmids, awards) FROM made"))
def agg_candidates(d: Data) -> DataFrame:
    return candidate_rows(d.land("ident")).drop("uuid", "url")


@query("agg_by_repository", "SELECT type, repo, COUNT(*) AS detected, COUNT(CASE WHEN lower(id) IN (SELECT acc FROM {catalog}) THEN 1 END) AS in_catalog FROM {candidate} GROUP BY type, repo")
def agg_by_repository(d: Data) -> DataFrame:
    listed = d.catalog.select("acc").distinct().withColumn("listed", F.lit(True))
    j = d.candidate.withColumn("acc", F.lower("id")).join(listed, "acc", "left")
    return j.groupBy("type", "repo").agg(F.count("*").alias("detected"), F.count("listed").alias("in_catalog"))


@query("agg_catalog_summary", f"""WITH {_ALIAS}, x AS (SELECT *, {_LISTED} AS listed, lower(id) AS acc FROM {{candidate}}),
    p AS (SELECT DISTINCT al.alias AS acc, pmid FROM al JOIN {{catalog_pmid}} c ON al.acc = c.acc),
    y AS (SELECT x.repo, x.id, COUNT(p.pmid) AS n, COUNT(i.pmid) AS mine FROM x LEFT JOIN p ON x.acc = p.acc LEFT JOIN {{ident}} i ON i.repo = x.repo AND i.id = x.id AND i.pmid = p.pmid AND i.role = 'generated' WHERE x.listed AND x.type = 'dataset' GROUP BY x.repo, x.id),
    z AS (SELECT COUNT(*) AS candidates, COUNT(CASE WHEN type = 'dataset' THEN 1 END) AS datasets, COUNT(CASE WHEN type = 'code' THEN 1 END) AS code_deposits, COUNT(CASE WHEN type = 'dataset' AND listed THEN 1 END) AS datasets_listed,
      COUNT(CASE WHEN type = 'dataset' AND NOT listed THEN 1 END) AS datasets_missing, COUNT(CASE WHEN type = 'dataset' AND NOT listed AND status = 'RESOLVES' THEN 1 END) AS missing_resolving,
      COUNT(CASE WHEN type = 'dataset' AND NOT listed AND repo NOT IN ({MAIN}) THEN 1 END) AS missing_outside FROM x),
    w AS (SELECT COUNT(CASE WHEN mine > 0 THEN 1 END) AS same_paper, COUNT(CASE WHEN mine = 0 AND n > 0 THEN 1 END) AS other_papers, COUNT(CASE WHEN n = 0 THEN 1 END) AS no_paper FROM y)
    SELECT z.*, w.*, (SELECT COUNT(DISTINCT acc) FROM {{catalog}}) AS listed, (SELECT COUNT(*) FROM {{catalog_pmid}}) AS pairs,
    (SELECT COUNT(*) FROM {{catalog_pmid}} c JOIN {{paper}} q ON c.pmid = q.pmid WHERE COALESCE(CAST(q.pub_date AS STRING), '9999') < '1996-01-01') AS pairs_before,
    (SELECT COUNT(DISTINCT c.pmid) FROM {{catalog_pmid}} c JOIN {{paper}} q ON c.pmid = q.pmid) AS papers_listed FROM z, w""")
def agg_catalog_summary(d: Data) -> DataFrame:
    key = ["repo", "id"]
    known = K.listed(d.candidate.select(*key), d.catalog, C.landing_url(F.col("repo"), F.col("id"))).withColumn("listed", F.lit(True))
    x = d.candidate.join(known, key, "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    data, gone = F.col("type") == "dataset", (F.col("type") == "dataset") & ~F.col("listed")
    z = x.agg(
        F.count("*").alias("candidates"), F.count_if(data).alias("datasets"), F.count_if(F.col("type") == "code").alias("code_deposits"), F.count_if(data & F.col("listed")).alias("datasets_listed"),
        F.count_if(gone).alias("datasets_missing"), F.count_if(gone & (F.col("status") == "RESOLVES")).alias("missing_resolving"), F.count_if(gone & ~F.col("repo").isin(MAIN_REPOSITORIES)).alias("missing_outside"),
    )
    outcome = join_catalog_papers(d).join(d.candidate.where("type = 'dataset'").select(*key), key, "left_semi")
    w = outcome.agg(*[F.count_if(F.col("outcome") == o).alias(o.replace(" ", "_")) for o in ("same paper", "other papers", "no paper")])
    listed = d.catalog.select("acc").distinct().agg(F.count("*").alias("listed"))
    before = F.coalesce(F.col("pub_date").cast("string"), F.lit("9999")) < "1996-01-01"
    j = d.catalog_pmid.join(d.paper.select("pmid", before.alias("before")), "pmid", "left")
    pairs = j.agg(F.count("*").alias("pairs"), F.count_if("before").alias("pairs_before"))
    papers = j.where("before IS NOT NULL").select("pmid").distinct().agg(F.count("*").alias("papers_listed"))
    return z.crossJoin(w).crossJoin(listed).crossJoin(pairs).crossJoin(papers)  # one row each


_PAIRS = """SELECT c.pmid, c.acc, k.repo, COUNT(i.id) > 0 AS found, COALESCE(bool_or(i.role = 'generated'), FALSE) AS own, COALESCE(bool_or(i.role = 'unknown'), FALSE) AS unclear, COALESCE(bool_and(i.role = 'reused'), FALSE) AS all_reused
    FROM {catalog_pmid} c JOIN (SELECT DISTINCT acc, repo FROM {catalog}) k ON c.acc = k.acc LEFT JOIN {ident} i ON c.pmid = i.pmid AND c.acc = lower(i.id) GROUP BY c.pmid, c.acc, k.repo"""


def pairs_found(d: Data) -> DataFrame:
    """Catalog (paper, dataset) pairs with what the paper's text gave for them."""
    found = d.ident.select("pmid", F.lower("id").alias("acc"), "id", "role")
    j = d.catalog_pmid.join(d.catalog.select("acc", "repo").distinct(), "acc").join(found, ["pmid", "acc"], "left")
    no = F.lit(False)
    return j.groupBy("pmid", "acc", "repo").agg(
        (F.count("id") > 0).alias("found"), F.coalesce(F.bool_or(F.col("role") == "generated"), no).alias("own"),
        F.coalesce(F.bool_or(F.col("role") == "unknown"), no).alias("unclear"), F.coalesce(F.bool_and(F.col("role") == "reused"), no).alias("all_reused"),
    )


@query("agg_recall_dataset", f"""WITH p AS ({_PAIRS}) SELECT repo, COUNT(*) AS pairs, COUNT(CASE WHEN found THEN 1 END) AS found, COUNT(CASE WHEN own THEN 1 END) AS own, COUNT(CASE WHEN unclear AND NOT own THEN 1 END) AS unclear,
    COUNT(CASE WHEN all_reused THEN 1 END) AS all_reused, 100.0::DOUBLE * COUNT(CASE WHEN found THEN 1 END) / COUNT(*) AS found_pct FROM p GROUP BY repo""")
def agg_recall_dataset(d: Data) -> DataFrame:
    g = pairs_found(d).groupBy("repo").agg(
        F.count("*").alias("pairs"), F.count_if("found").alias("found"), F.count_if("own").alias("own"), F.count_if(F.col("unclear") & ~F.col("own")).alias("unclear"), F.count_if("all_reused").alias("all_reused"),
    )
    return g.withColumn("found_pct", percent(F.col("found"), F.col("pairs")))


@query("agg_recall_paper", f"WITH p AS ({_PAIRS}), q AS (SELECT pmid, bool_or(found) AS f, bool_or(own) AS o FROM p GROUP BY pmid) SELECT COUNT(*) AS papers, COUNT(CASE WHEN f THEN 1 END) AS named, COUNT(CASE WHEN o THEN 1 END) AS own FROM q")
def agg_recall_paper(d: Data) -> DataFrame:
    per = pairs_found(d).groupBy("pmid").agg(F.bool_or("found").alias("f"), F.bool_or("own").alias("o"))
    return per.agg(F.count("*").alias("papers"), F.count_if("f").alias("named"), F.count_if("o").alias("own"))


@query("agg_signal", f"""WITH c AS (SELECT DISTINCT acc FROM {{catalog}}), h AS (SELECT DISTINCT acc FROM {{catalog_pmid}}),
    o AS (SELECT i.repo, CASE WHEN c.acc IS NULL THEN 'not listed' WHEN p.pmid IS NOT NULL THEN 'this paper' WHEN h.acc IS NOT NULL THEN 'other papers only' ELSE 'no paper' END AS outcome
      FROM {{ident}} i LEFT JOIN c ON lower(i.id) = c.acc LEFT JOIN h ON lower(i.id) = h.acc LEFT JOIN {{catalog_pmid}} p ON p.acc = lower(i.id) AND p.pmid = i.pmid WHERE {OWN} AND NOT is_code)
    SELECT repo, outcome, COUNT(*) AS n FROM o GROUP BY GROUPING SETS ((repo), (repo, outcome))""")
def agg_signal(d: Data) -> DataFrame:
    s = K.signal(M.own_data(d.ident), d.catalog, d.catalog_pmid)
    return s.groupingSets([["repo"], ["repo", "outcome"]], "repo", "outcome").agg(F.count("*").alias("n"))


@query("agg_added", "SELECT repo, type, COUNT(*) AS n, COUNT(CASE WHEN status = 'RESOLVES' THEN 1 END) AS resolving FROM {candidate} WHERE lower(id) NOT IN (SELECT acc FROM {catalog}) GROUP BY repo, type")
def agg_added(d: Data) -> DataFrame:
    new = d.candidate.withColumn("acc", F.lower("id")).join(d.catalog.select("acc"), "acc", "left_anti")
    return new.groupBy("repo", "type").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "RESOLVES").alias("resolving"))


@query("agg_awards_per_paper", f"""WITH n AS (SELECT p.pmid, GREATEST(COUNT(DISTINCT l.coreproject), 1) AS n FROM {{paper}} p LEFT JOIN {{link}} l ON p.pmid = l.pmid GROUP BY p.pmid),
    m AS (SELECT n.*, n.pmid IN (SELECT pmid FROM {{ident}} WHERE {OWN} AND NOT is_code) AS own FROM n)
    SELECT n AS awards, COUNT(*) AS papers, COUNT(CASE WHEN own THEN 1 END) AS own_data_papers, (SELECT 100.0::DOUBLE * COUNT(CASE WHEN n > 1 THEN 1 END) / COUNT(*) FROM m) AS multi_pct,
    (SELECT 100.0::DOUBLE * COUNT(CASE WHEN n > 1 THEN 1 END) / NULLIF(COUNT(*), 0) FROM m WHERE own) AS multi_own_data_pct FROM m GROUP BY n ORDER BY n LIMIT 10""")
def agg_awards_per_paper(d: Data) -> DataFrame:
    per = d.paper.select("pmid").join(d.link, "pmid", "left").groupBy("pmid").agg(F.greatest(F.count_distinct("coreproject"), F.lit(1)).alias("awards"))
    own = M.own_data(d.ident).select("pmid").distinct().withColumn("own", F.lit(1))
    # one row for each number of awards: the shares are sums over these
    g = per.join(own, "pmid", "left").groupBy("awards").agg(F.count("*").alias("papers"), F.count("own").alias("own_data_papers"))
    w, multi = Window.partitionBy(F.lit(0)), F.col("awards") > 1
    share = lambda c: percent(F.sum(F.when(multi, F.col(c)).otherwise(0)).over(w), F.sum(c).over(w))
    return g.withColumns({"multi_pct": share("papers"), "multi_own_data_pct": share("own_data_papers")}).orderBy("awards").limit(10)


_OF_AWARDS = f"SELECT c.tier, c.type, l.coreproject FROM {{candidate}} c JOIN {{ident}} i ON c.repo = i.repo AND c.id = i.id JOIN {{link}} l ON i.pmid = l.pmid WHERE {OWN.replace('role', 'i.role').replace('cls', 'i.cls')}"


@query("agg_tiers", f"""WITH o AS ({_OF_AWARDS}) SELECT c.tier, c.n, c.n - c.different AS repeated, 100.0::DOUBLE * c.n / (SELECT COUNT(*) FROM {{candidate}}) AS pct, COALESCE(a.n, 0) AS awards, COALESCE(a.d, 0) AS awards_with_dataset,
    c.n::DOUBLE / (SELECT COUNT(*) FROM {{award}}) AS rows_per_award FROM (SELECT tier, COUNT(*) AS n, COUNT(DISTINCT (repo, id)) AS different FROM {{candidate}} GROUP BY tier) c
    LEFT JOIN (SELECT tier, COUNT(DISTINCT coreproject) AS n, COUNT(DISTINCT CASE WHEN type = 'dataset' THEN coreproject END) AS d FROM o GROUP BY tier) a ON c.tier = a.tier""")
def agg_tiers(d: Data) -> DataFrame:
    counts = d.candidate.groupBy("repo", "id", "tier").agg(F.count("*").alias("times")).groupBy("tier").agg(F.sum("times").alias("n"), F.sum(F.col("times") - 1).alias("repeated"))
    counts = counts.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy(F.lit(0)))))
    per = awards_of_candidates(d).groupBy("tier", "coreproject").agg(F.bool_or(F.col("type") == "dataset").alias("data"))
    per = per.groupBy("tier").agg(F.count("*").alias("awards"), F.count_if("data").alias("awards_with_dataset"))
    total = d.award.agg(F.count("*").alias("_awards"))  # one row
    j = counts.join(per, "tier", "left").na.fill(0, ["awards", "awards_with_dataset"]).crossJoin(total)
    return j.withColumn("rows_per_award", F.col("n") / F.col("_awards")).drop("_awards")


def awards_of_candidates(d: Data) -> DataFrame:
    """(tier, type, coreproject), repeated for each paper that names the candidate."""
    own = M.own_identifiers(d.ident).select("repo", "id", "pmid")
    return d.candidate.select("repo", "id", "tier", "type").join(own, ["repo", "id"]).join(d.link.select("pmid", "coreproject"), "pmid").select("tier", "type", "coreproject")


@query("agg_public_summary", f"""WITH o AS ({_OF_AWARDS}), h AS (SELECT i.id, MAX(CASE WHEN r.id IS NOT NULL THEN 1 ELSE 0 END) AS y FROM {{ident}} i LEFT JOIN {{record_pmid}} r ON r.repo = i.repo AND r.id = i.id AND r.pmid = i.pmid
      WHERE {OWN} AND i.repo = 'GEO' GROUP BY i.id)
    SELECT COUNT(*) AS rows_all, COUNT(CASE WHEN type = 'dataset' AND tier = 1 THEN 1 END) AS confirmed, COUNT(CASE WHEN status IN ('RESOLVES', 'NOT_FOUND', 'PRIVATE', 'RESTRICTED') THEN 1 END) AS definite,
    COUNT(CASE WHEN status = 'NOT_FOUND' THEN 1 END) AS dead, COUNT(CASE WHEN status = 'PRIVATE' THEN 1 END) AS private,
    {", ".join(f"COUNT(CASE WHEN tier = {t} THEN 1 END) AS tier_{t}" for t in (1, 2, 3))}, (SELECT COUNT(DISTINCT coreproject) FROM o WHERE type = 'dataset') AS awards_with_dataset,
    (SELECT COUNT(*) FROM h WHERE y = 0) AS series_not_linked FROM {{candidate}}""")
def agg_public_summary(d: Data) -> DataFrame:
    s = F.col("status")
    rows = d.candidate.agg(
        F.count("*").alias("rows_all"), F.count_if((F.col("type") == "dataset") & (F.col("tier") == 1)).alias("confirmed"),
        F.count_if(s.isin("RESOLVES", "NOT_FOUND", "PRIVATE", "RESTRICTED")).alias("definite"), F.count_if(s == "NOT_FOUND").alias("dead"), F.count_if(s == "PRIVATE").alias("private"),
        *[F.count_if(F.col("tier") == t).alias(f"tier_{t}") for t in (1, 2, 3)],
    )
    awards = awards_of_candidates(d).where("type = 'dataset'").select("coreproject").distinct().agg(F.count("*").alias("awards_with_dataset"))
    said = d.record_pmid.where("repo = 'GEO'").select("pmid", "id").distinct().withColumn("y", F.lit(1))
    series = M.own_identifiers(d.ident).where("repo = 'GEO'").join(said, ["pmid", "id"], "left").groupBy("id").agg(F.count("y").alias("y"))
    return rows.crossJoin(awards).crossJoin(series.agg(F.count_if(F.col("y") == 0).alias("series_not_linked")))  # one row each


@query("agg_consensus", """WITH g AS (SELECT tier, COUNT(*) AS judged, COUNT(CASE WHEN role_a = 'generated' AND role_b = 'generated' THEN 1 END) AS both_own,
      COUNT(CASE WHEN role_a = 'generated' OR role_b = 'generated' THEN 1 END) AS any_own FROM {rated} GROUP BY tier),
    p AS (SELECT g.*, COALESCE(c.n, 0) AS population FROM g LEFT JOIN (SELECT tier, COUNT(*) AS n FROM {candidate} WHERE type = 'dataset' GROUP BY tier) c ON g.tier = c.tier)
    SELECT *, ROUND((SELECT 100 * SUM(population * both_own / judged::DOUBLE) / NULLIF(SUM(population), 0) FROM p), 9) AS both_weighted_pct, ROUND((SELECT 100 * SUM(population * any_own / judged::DOUBLE) / NULLIF(SUM(population), 0) FROM p), 9) AS any_weighted_pct FROM p""")
def agg_consensus(d: Data) -> DataFrame:
    a, b = F.col("role_a") == "generated", F.col("role_b") == "generated"
    g = d.rated.groupBy("tier").agg(F.count("*").alias("judged"), F.count_if(a & b).alias("both_own"), F.count_if(a | b).alias("any_own"))
    population = d.candidate.where("type = 'dataset'").groupBy("tier").agg(F.count("*").alias("population"))
    g = g.join(population, "tier", "left").na.fill(0, ["population"])
    return g.withColumns({f"{x}_weighted_pct": F.round(K.weighted_percent(F.col("population"), F.col(f"{x}_own"), F.col("judged")), 9) for x in ("both", "any")})


@query("agg_kappa", """WITH g AS (SELECT COUNT(*) AS n, COUNT(CASE WHEN role_a = role_b THEN 1 END) AS same, COUNT(CASE WHEN role_a = 'generated' THEN 1 END) AS a, COUNT(CASE WHEN role_b = 'generated' THEN 1 END) AS b FROM {rated}),
    r AS (SELECT n, same, same / n::DOUBLE AS o, (a / n::DOUBLE) * (b / n::DOUBLE) + (1 - a / n::DOUBLE) * (1 - b / n::DOUBLE) AS e FROM g) SELECT n, same, o AS agreement, CASE WHEN e <> 1 THEN (o - e) / (1 - e) END AS kappa FROM r""")
def agg_kappa(d: Data) -> DataFrame:
    return K.kappa(d.rated, F.col("role_a") == "generated", F.col("role_b") == "generated")


@query("agg_audit_accuracy", """WITH g AS (SELECT role_a, COUNT(*) AS m, COUNT(CASE WHEN role_a = role_b THEN 1 END) AS k, COUNT(CASE WHEN conf = 'high' THEN 1 END) AS high,
      COUNT(CASE WHEN conf = 'high' AND role_a = role_b THEN 1 END) AS high_same FROM {rated} GROUP BY role_a),
    i AS (SELECT role_a, string_agg(role_b || ' ' || n, ';' ORDER BY role_b) AS instead FROM (SELECT role_a, role_b, CAST(COUNT(*) AS STRING) AS n FROM {rated} WHERE role_a <> role_b GROUP BY role_a, role_b) t GROUP BY role_a),
    p AS (SELECT g.*, COALESCE(i.instead, '') AS instead, COALESCE(c.n, 0) AS population FROM g LEFT JOIN i ON g.role_a = i.role_a LEFT JOIN (SELECT role, COUNT(*) AS n FROM {ident} GROUP BY role) c ON c.role = g.role_a)
    SELECT *, 100.0::DOUBLE * k / m AS pct, ROUND((SELECT 100 * SUM(population * k / m::DOUBLE) / NULLIF(SUM(population), 0) FROM p), 9) AS weighted_pct FROM p""")
def agg_audit_accuracy(d: Data) -> DataFrame:
    # what was said about what: one row for each pair of roles, and all else from these
    n, same = F.col("n"), F.col("role_a") == F.col("role_b")
    pairs = d.rated.groupBy("role_a", "role_b").agg(F.count("*").alias("n"), F.count_if(F.col("conf") == "high").alias("high"))
    other = F.when(~same, F.concat_ws(" ", "role_b", n.cast("string")))
    g = pairs.groupBy("role_a").agg(
        F.sum("n").alias("m"), F.sum(F.when(same, n).otherwise(0)).alias("k"), F.sum("high").alias("high"), F.sum(F.when(same, F.col("high")).otherwise(0)).alias("high_same"),
        F.array_join(F.array_sort(F.collect_list(other)), ";").alias("instead"),
    )
    population = d.ident.groupBy(F.col("role").alias("role_a")).agg(F.count("*").alias("population"))
    g = g.join(population, "role_a", "left").na.fill(0, ["population"])
    return g.withColumn("pct", percent(F.col("k"), F.col("m"))).withColumn("weighted_pct", F.round(K.weighted_percent(F.col("population"), F.col("k"), F.col("m")), 9))


@query("agg_audit_roles", """WITH r AS (SELECT tier, role_b, conf, CASE WHEN doc_id % 4 = 0 THEN 'CODE' ELSE 'DATA' END AS kind FROM {rated}), pop AS (SELECT tier, COUNT(*) AS population FROM {candidate} GROUP BY tier),
    t AS (SELECT r.tier, MAX(pop.population) AS population, COUNT(*) AS judged, COUNT(CASE WHEN role_b = 'generated' THEN 1 END) AS own FROM r JOIN pop ON r.tier = pop.tier GROUP BY r.tier)
    SELECT 'all' AS part, '' AS name, COUNT(*) AS judged, COUNT(CASE WHEN role_b = 'generated' THEN 1 END) AS own, 100.0::DOUBLE * COUNT(CASE WHEN role_b = 'generated' THEN 1 END) / COUNT(*) AS own_pct,
      100.0::DOUBLE * COUNT(CASE WHEN role_b = 'generated' AND kind = 'DATA' THEN 1 END) / COUNT(*) AS own_data_pct FROM r
    UNION ALL SELECT 'role', role_b, COUNT(*), COUNT(CASE WHEN role_b = 'generated' THEN 1 END), 100.0::DOUBLE * COUNT(CASE WHEN role_b = 'generated' THEN 1 END) / COUNT(*), 100.0::DOUBLE * COUNT(CASE WHEN role_b = 'generated' AND kind = 'DATA' THEN 1 END) / COUNT(*) FROM r GROUP BY role_b
    UNION ALL SELECT 'kind', kind, COUNT(*), COUNT(CASE WHEN role_b = 'generated' THEN 1 END), 100.0::DOUBLE * COUNT(CASE WHEN role_b = 'generated' THEN 1 END) / COUNT(*), 100.0::DOUBLE * COUNT(CASE WHEN role_b = 'generated' AND kind = 'DATA' THEN 1 END) / COUNT(*) FROM r GROUP BY kind
    UNION ALL SELECT 'tier', CAST(tier AS STRING), COUNT(*), COUNT(CASE WHEN role_b = 'generated' THEN 1 END), 100.0::DOUBLE * COUNT(CASE WHEN role_b = 'generated' THEN 1 END) / COUNT(*), 100.0::DOUBLE * COUNT(CASE WHEN role_b = 'generated' AND kind = 'DATA' THEN 1 END) / COUNT(*) FROM r GROUP BY tier
    UNION ALL SELECT 'weighted', '', CAST(SUM(judged) AS BIGINT), CAST(SUM(own) AS BIGINT), 100.0::DOUBLE * SUM(population::DOUBLE * own / judged) / SUM(population), NULL FROM t""")
def agg_audit_roles(d: Data) -> DataFrame:
    """Share of own, and of own data, that a reviewer sees: over all, by role, kind and tier, and weighted to the tiers' sizes."""
    kind = F.when(F.col("doc_id") % 4 == 0, "CODE").otherwise("DATA")
    r = d.rated.select("tier", F.col("role_b").alias("role"), kind.alias("kind"))
    own = F.col("role") == "generated"
    parts = []
    for part, by in (("all", F.lit("")), ("role", F.col("role")), ("kind", F.col("kind")), ("tier", F.col("tier").cast("string"))):
        g = r.groupBy(by.alias("name")).agg(F.count("*").alias("judged"), F.count_if(own).alias("own"), F.count_if(own & (F.col("kind") == "DATA")).alias("_data"))
        parts.append(g.select(F.lit(part).alias("part"), "name", "judged", "own", percent(F.col("own"), F.col("judged")).alias("own_pct"), percent(F.col("_data"), F.col("judged")).alias("own_data_pct")))
    size = d.candidate.groupBy("tier").agg(F.count("*").alias("population"))
    t = r.groupBy("tier").agg(F.count("*").alias("judged"), F.count_if(own).alias("own")).join(size, "tier")
    share = 100.0 * F.sum(F.col("population").cast("double") * F.col("own") / F.col("judged")) / F.sum("population")
    parts.append(t.agg(F.sum("judged").alias("judged"), F.sum("own").alias("own"), share.alias("own_pct")).where("judged IS NOT NULL").select(F.lit("weighted").alias("part"), F.lit("").alias("name"), "judged", "own", "own_pct", F.lit(None).cast("double").alias("own_data_pct")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("agg_rescore", """WITH r AS (SELECT CAST(doc_id AS STRING) AS pmid, CASE WHEN quality = 1 THEN 'ON_REQUEST' ELSE 'IN_ARTICLE' END AS said FROM {labels}),
    j AS (SELECT p.label AS now, CASE WHEN CAST(p.pmid AS BIGINT) % 4 = 0 THEN 'ON_REQUEST' ELSE p.label END AS was, r.said FROM {labelled} p JOIN r ON p.pmid = r.pmid)
    SELECT 'outcome' AS part, CASE WHEN was = said AND now <> said THEN 'broken' WHEN was <> said AND now = said THEN 'fixed' WHEN was <> now THEN 'moved' ELSE 'same' END AS name, COUNT(*) AS n, COUNT(CASE WHEN now = said THEN 1 END) AS agree FROM j GROUP BY 2
    UNION ALL SELECT 'label', now, COUNT(*), COUNT(CASE WHEN now = said THEN 1 END) FROM j GROUP BY now
    UNION ALL SELECT 'queue', label, COUNT(*), 0 FROM {labelled} WHERE label = 'NEEDS_REVIEW' AND pmid NOT IN (SELECT pmid FROM r WHERE pmid IS NOT NULL) GROUP BY label""")
def agg_rescore(d: Data) -> DataFrame:
    """Papers by outcome of a change of rules, by their label now, and those to review that nobody has labelled."""
    said = d.labels.select(F.col("doc_id").cast("string").alias("pmid"), F.when(F.col("quality") == 1, "ON_REQUEST").otherwise("IN_ARTICLE").alias("said"))
    old = F.when(F.col("pmid").cast("long") % 4 == 0, "ON_REQUEST").otherwise(F.col("label"))
    j = d.labelled.select("pmid", "label", old.alias("old")).join(said, "pmid")
    was, now = F.col("old") == F.col("said"), F.col("label") == F.col("said")
    outcome = F.when(was & ~now, "broken").when(~was & now, "fixed").when(F.col("old") != F.col("label"), "moved").otherwise("same")
    counts = [F.count("*").alias("n"), F.count_if(now).alias("agree")]
    parts = [j.groupBy(F.lit(part).alias("part"), by.alias("name")).agg(*counts) for part, by in (("outcome", outcome), ("label", F.col("label")))]
    queue = d.labelled.where("label = 'NEEDS_REVIEW'").join(said, "pmid", "left_anti").groupBy(F.lit("queue").alias("part"), F.col("label").alias("name")).agg(F.count("*").alias("n"))
    return parts[0].unionByName(parts[1]).unionByName(queue.withColumn("agree", F.lit(0).cast("long")))


@query("agg_wilson", """WITH g AS (SELECT tier, COUNT(*)::DOUBLE AS n, COUNT(CASE WHEN role_a = 'generated' THEN 1 END) / COUNT(*)::DOUBLE AS p FROM {rated} GROUP BY tier)
    SELECT tier, ROUND((p + 3.8416 / (2 * n) - 1.96 * sqrt((p * (1 - p) + 3.8416 / (4 * n)) / n)) / (1 + 3.8416 / n), 9) AS low, ROUND((p + 3.8416 / (2 * n) + 1.96 * sqrt((p * (1 - p) + 3.8416 / (4 * n)) / n)) / (1 + 3.8416 / n), 9) AS high FROM g""")
def agg_wilson(d: Data) -> DataFrame:
    g = d.rated.groupBy("tier").agg(F.count("*").cast("double").alias("n"), (F.count_if(F.col("role_a") == "generated") / F.count("*")).alias("p"))
    n, p, z2 = F.col("n"), F.col("p"), F.lit(3.8416)
    mid, half = p + z2 / (2 * n), 1.96 * F.sqrt((p * (1 - p) + z2 / (4 * n)) / n)
    return g.select("tier", F.round((mid - half) / (1 + z2 / n), 9).alias("low"), F.round((mid + half) / (1 + z2 / n), 9).alias("high"))
