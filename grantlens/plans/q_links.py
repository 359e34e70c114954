"""Queries of link checks, repository records and the roles that records correct."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.text import people
from ..operators import links as L
from ..operators import records as R
from .base import Data, query

K = "p_partkey"


@query("lnk_url_status", f"""WITH c AS (SELECT {K}, CASE p_size % 6 WHEN 0 THEN NULL WHEN 1 THEN 200 WHEN 2 THEN 403 WHEN 3 THEN 404 WHEN 4 THEN 429 ELSE 301 END AS h, CASE {K} % 4 WHEN 0 THEN NULL WHEN 1 THEN 200 WHEN 2 THEN 410 ELSE 503 END AS g, {K} % 17 = 0 AS u FROM {{part}}),
    d AS (SELECT *, CASE WHEN h IS NULL OR h IN (400, 403, 404, 405, 501) THEN COALESCE(g, h) ELSE h END AS c FROM c)
    SELECT {K}, CASE WHEN u THEN 'NOT_FOUND' WHEN c BETWEEN 200 AND 399 THEN 'RESOLVES' WHEN c IN (404, 410) THEN 'NOT_FOUND' ELSE 'UNVERIFIED' END AS status FROM d""")
def lnk_url_status(d: Data) -> DataFrame:
    s, k = F.col("p_size") % 6, F.col(K) % 4
    head = F.when(s == 1, 200).when(s == 2, 403).when(s == 3, 404).when(s == 4, 429).when(s == 5, 301)
    get = F.when(k == 1, 200).when(k == 2, 410).when(k == 3, 503)
    return d.part.select(K, L.url_status(head, get, F.col(K) % 17 == 0).alias("status"))


@query("lnk_doi_status", f"""SELECT {K}, CASE WHEN p_size % 5 = 0 OR {K} % 4 = 3 THEN 'SKIPPED_API_DOWN' WHEN {K} % 4 = 0 THEN 'RESOLVES' WHEN {K} % 4 = 1 THEN 'NOT_FOUND' ELSE 'UNVERIFIED' END AS status FROM {{part}}""")
def lnk_doi_status(d: Data) -> DataFrame:
    k = F.col(K) % 4
    text = F.when(k == 0, '{"responseCode": 1}').when(k == 1, '{"responseCode":100}').when(k == 2, '{"responseCode":2}').otherwise("<html>")
    code = F.when(F.col("p_size") % 5 == 0, 502).otherwise(200)
    return d.part.select(K, L.doi_status(code, text).alias("status"))


def answers(d: Data) -> DataFrame:
    """Landed answers of repositories, derived from the part's number and size."""
    s = F.col("p_size") % 6
    code = F.when(s == 0, 503).when(s == 1, 404).when(s == 2, 403).otherwise(200)
    private = F.when(F.col("repo") == "GEO", F.lit("is currently private")).otherwise(F.lit("dataset is reserved"))
    found = (
        F.when(F.col("repo") == "GEO", "!Series_title = x").when(F.col("repo") == "SRA/BioProject", '{"count": "3"}')
        .when(F.col("repo") == "dbGaP", '{"study": 1}').otherwise(F.concat(F.lit("record "), "id"))
    )
    text = F.when(s == 3, private).when(s == 4, "nothing").otherwise(found)
    number = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    return d.status.select("repo", "id").withColumn("p_size", (number % 6).cast("int")).select("repo", "id", code.alias("code"), text.alias("text"))


_ANSWERS = """SELECT repo, id, CAST(regexp_extract(id, '(\\d+)$', 1) AS BIGINT) % 6 AS s FROM {status}"""
_API = "CASE WHEN s = 0 THEN 'SKIPPED_API_DOWN' WHEN s = 1 THEN 'NOT_FOUND' WHEN s = 2 THEN CASE repo WHEN 'OSF' THEN 'PRIVATE' ELSE 'RESTRICTED' END WHEN repo NOT IN ('GEO', 'SRA/BioProject', 'dbGaP', 'EGA', 'PRIDE/ProteomeXchange') THEN 'RESOLVES' WHEN s = 3 AND repo IN ('GEO', 'PRIDE/ProteomeXchange') THEN 'PRIVATE' WHEN s IN (3, 4) THEN 'NOT_FOUND' ELSE 'RESOLVES' END"


@query("lnk_api_status", f"WITH a AS ({_ANSWERS}) SELECT repo, id, CASE WHEN repo = 'dbGaP' AND ({_API}) = 'NOT_FOUND' AND s = 4 THEN 'RESOLVES' ELSE {_API} END AS status FROM a")
def lnk_api_status(d: Data) -> DataFrame:
    a = answers(d)
    status = L.api_status(F.col("repo"), F.col("id"), F.col("code"), F.col("text"))
    # a second answer of dbGaP, on another landed row, finds what the first did not name
    second = F.when((F.col("repo") == "dbGaP") & (F.col("text") == "nothing"), L.api_status(F.lit("SRA/BioProject"), F.col("id"), F.lit(200), F.lit('"count": "1"')))
    return a.select("repo", "id", L.with_fallback(status, second).alias("status"))


# an answer of each repository about record number n: repository, identifier, code, text, status, page
ANSWERS = [
    ("GEO", "GSE{n}", 200, "!Series_title = x", "RESOLVES", "https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc=GSE{n}"),
    ("GEO", "GDS{n}", 200, '{"count": "2"}', "RESOLVES", "https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc=GDS{n}"),
    ("GEO", "GDS{n}", 200, '{"count": "0"}', "NOT_FOUND", "https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc=GDS{n}"),
    ("SRA/BioProject", "SRR{n}", 200, '{"count":"1"}', "RESOLVES", "https://www.ncbi.nlm.nih.gov/sra/SRR{n}"),
    ("SRA/BioProject", "PRJNA{n}", 200, '{"count":"0"}', "NOT_FOUND", "https://www.ncbi.nlm.nih.gov/bioproject/PRJNA{n}"),
    ("EGA", "EGAD{n}", 200, "about EGAD{n}", "RESOLVES", "https://ega-archive.org/datasets/EGAD{n}"),
    ("EGA", "EGAC{n}", 404, "EGAC{n}", "NOT_FOUND", "https://ega-archive.org/dacs/EGAC{n}"),
    ("PRIDE/ProteomeXchange", "PXD{n}", 404, "PXD{n} has been reserved", "PRIVATE", "https://proteomecentral.proteomexchange.org/cgi/GetDataset?ID=PXD{n}"),
    ("MassIVE", "MSV{n}", 400, "", "NOT_FOUND", "https://massive.ucsd.edu/ProteoSAFe/QueryMSV?id=MSV{n}"),
    ("MassIVE", "MSV{n}", 200, "MassIVE Private Dataset", "PRIVATE", "https://massive.ucsd.edu/ProteoSAFe/QueryMSV?id=MSV{n}"),
    ("ArrayExpress", "E-MTAB-{n}", 200, '{"accno": 1}', "RESOLVES", "https://www.ebi.ac.uk/biostudies/studies/E-MTAB-{n}"),
    ("BioStudies", "S-BSST{n}", 200, "{}", "NOT_FOUND", "https://www.ebi.ac.uk/biostudies/studies/S-BSST{n}"),
    ("MetaboLights", "MTBLS{n}", 200, "", "RESOLVES", "https://www.ebi.ac.uk/metabolights/MTBLS{n}"),
    ("Metabolomics Workbench", "ST{n}", 200, "[]", "NOT_FOUND", "https://www.metabolomicsworkbench.org/data/DRCCMetadata.php?Mode=Study&StudyID=ST{n}"),
    ("PDB", "1A{n}", 404, "", "NOT_FOUND", "https://www.rcsb.org/structure/1A{n}"),
    ("EMDB", "EMD-{n}", 200, "x", "RESOLVES", "https://www.ebi.ac.uk/emdb/EMD-{n}"),
    ("PDC", "PDC{n}", 200, '{"data": null}', "NOT_FOUND", "https://pdc.cancer.gov/pdc/study/PDC{n}"),
    ("GDC project", "TCGA-{n}", 200, '{"project_id": 1}', "RESOLVES", "https://portal.gdc.cancer.gov/projects/TCGA-{n}"),
    ("GDC project", "TCGA-{n}", 403, "", "RESTRICTED", "https://portal.gdc.cancer.gov/projects/TCGA-{n}"),
    ("Synapse", "syn{n}", 401, "", "RESTRICTED", "https://www.synapse.org/#!Synapse:syn{n}"),
    ("OSF", "osf.io/{n}", 403, "", "PRIVATE", "https://osf.io/{n}"),
    ("OSF", "osf.io/{n}", 410, "", "NOT_FOUND", "https://osf.io/{n}"),
    ("GWAS Catalog", "GCST{n}", 200, "GCST{n}", "RESOLVES", "https://www.ebi.ac.uk/gwas/studies/GCST{n}"),
    ("GWAS Catalog", "GCST{n}", 503, "", "SKIPPED_API_DOWN", "https://www.ebi.ac.uk/gwas/studies/GCST{n}"),
]


def repository_answers(d: Data) -> DataFrame:
    """An answer for each part: which one its number decides."""
    n = F.col(K).cast("string")
    pick = lambda i: F.element_at(F.array(*[F.lit(x[i]) for x in ANSWERS]), (F.col(K) % len(ANSWERS) + 1).cast("int"))
    with_n = lambda c: F.replace(c, F.lit("{n}"), n)
    return d.part.select(K, pick(0).alias("repo"), with_n(pick(1)).alias("id"), pick(2).alias("code"), with_n(pick(3)).alias("text"))


def _said(i: int) -> str:
    whens = " ".join("WHEN {} THEN replace('{}', chr(123) || 'n' || chr(125), CAST({} AS VARCHAR))".format(j, x[i].replace("{n}", "' || chr(123) || 'n' || chr(125) || '"), K) for j, x in enumerate(ANSWERS))
    return f"CASE {K} % {len(ANSWERS)} {whens} END"


@query("lnk_status_by_repository", f"SELECT {K}, {_said(0)} AS repo, {_said(1)} AS id, {_said(4)} AS status, {_said(5)} AS url FROM {{part}}")
def lnk_status_by_repository(d: Data) -> DataFrame:
    a = repository_answers(d)
    status = L.api_status(F.col("repo"), F.col("id"), F.col("code"), F.col("text"))
    return a.select(K, "repo", "id", status.alias("status"), C.landing_url(F.col("repo"), F.col("id")).alias("url"))


@query("lnk_landing_url", """SELECT repo, id, CASE repo WHEN 'GEO' THEN 'https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc=' || id WHEN 'SRA/BioProject' THEN 'https://www.ncbi.nlm.nih.gov/' || CASE WHEN id LIKE 'PRJ%' THEN 'bioproject/' ELSE 'sra/' END || id
    WHEN 'dbGaP' THEN 'https://www.ncbi.nlm.nih.gov/projects/gap/cgi-bin/study.cgi?study_id=' || id WHEN 'EGA' THEN 'https://ega-archive.org/' || CASE id[4] WHEN 'D' THEN 'datasets/' WHEN 'C' THEN 'dacs/' ELSE 'studies/' END || id
    WHEN 'PRIDE/ProteomeXchange' THEN 'https://proteomecentral.proteomexchange.org/cgi/GetDataset?ID=' || id WHEN 'Zenodo' THEN 'https://doi.org/' || id WHEN 'other link' THEN id ELSE 'https://' || id END AS url FROM {status}""")
def lnk_landing_url(d: Data) -> DataFrame:
    return d.status.select("repo", "id", C.landing_url(F.col("repo"), F.col("id")).alias("url"))


@query("lnk_lookup", "SELECT i.pmid, i.repo, i.id, COALESCE(s.status, 'NOT_CHECKED') AS status FROM {ident} i LEFT JOIN {status} s ON i.repo = s.repo AND i.id = s.id")
def lnk_lookup(d: Data) -> DataFrame:
    return d.ident.join(d.status, ["repo", "id"], "left").select("pmid", "repo", "id", F.coalesce("status", F.lit("NOT_CHECKED")).alias("status"))


@query("lnk_down_counts", """SELECT CASE WHEN repo IN ('GEO', 'dbGaP') THEN 'www.ncbi.nlm.nih.gov' WHEN repo = 'SRA/BioProject' THEN 'eutils.ncbi.nlm.nih.gov' WHEN repo = 'Zenodo' THEN 'doi.org'
    WHEN repo = 'other link' THEN split_part(substr(id, 9), '/', 1) ELSE repo END AS host, COUNT(*) AS n FROM {status} WHERE status = 'SKIPPED_API_DOWN' GROUP BY 1""")
def lnk_down_counts(d: Data) -> DataFrame:
    down = d.status.where("status = 'SKIPPED_API_DOWN'")
    return down.groupBy(C.host_key(F.col("repo"), F.col("id")).alias("host")).agg(F.count("*").alias("n"))


def geo_text() -> F.Column:
    k = F.col(K)
    return F.concat(
        F.lit("^SERIES = GSE"), k.cast("string"), F.lit("\n!Series_status = Public on "), F.date_format(F.expr(f"date_add(DATE '2015-01-01', cast({K} % 2000 as int))"), "MMM dd yyyy"),
        F.lit("\n!Series_pubmed_id = "), (k + 7).cast("string"), F.lit("\n!Series_pubmed_id = "), (k + 7 + k % 2).cast("string"), F.lit("\n!Series_contributor = Ana,M,Smith"), (k % 25).cast("string"),
        F.when(k % 3 == 0, F.concat(F.lit("\n!Series_relation = SubSeries of: GSE"), (k * 2).cast("string"))).otherwise(""), F.lit("\n"),
    )


@query("rec_geo", f"""SELECT {K}, DATE '2015-01-01' + CAST({K} % 2000 AS INT) AS record_date, CASE WHEN {K} % 2 = 0 THEN CAST({K} + 7 AS STRING)
      ELSE LEAST(CAST({K} + 7 AS STRING), CAST({K} + 8 AS STRING)) || ';' || GREATEST(CAST({K} + 7 AS STRING), CAST({K} + 8 AS STRING)) END AS pmids,
    'Ana,M,Smith' || CAST({K} % 25 AS STRING) AS contributors, CASE WHEN {K} % 3 = 0 THEN 'GSE' || CAST({K} * 2 AS STRING) ELSE '' END AS superseries FROM {{part}}""")
def rec_geo(d: Data) -> DataFrame:
    r = L.geo_record(geo_text())
    return d.part.select(K, r["record_date"].alias("record_date"), *[F.array_join(r[c], ";").alias(c) for c in ("pmids", "contributors", "superseries")])


@query("rec_bioproject", f"""WITH p AS (SELECT {K} AS k, CASE WHEN {K} % 4 = 0 THEN 2 ELSE 1 END AS hits, DATE '2016-01-01' + CAST({K} % 1000 AS INT) AS dt, CASE WHEN {K} % 3 = 0 THEN 200000000 ELSE 500000000 END + {K} AS uid FROM {{part}})
    SELECT 'PRJNA' || CAST(p.k AS STRING) AS id, CASE WHEN p.k % 3 = 0 THEN LEAST(p.dt, DATE '2015-01-01' + CAST(p.k % 2000 AS INT)) ELSE p.dt END AS record_date,
    CASE WHEN p.k % 3 = 0 THEN LEAST(CAST(p.k AS STRING), CAST(p.k + 7 AS STRING)) || ';' || GREATEST(CAST(p.k AS STRING), CAST(p.k + 7 AS STRING)) ELSE CAST(p.k AS STRING) END AS pmids FROM p WHERE hits = 1""")
def rec_bioproject(d: Data) -> DataFrame:
    k = F.col(K)
    day = lambda start, n: F.expr(f"date_add(DATE '{start}', cast({K} % {n} as int))")
    projects = d.part.select(F.concat(F.lit("PRJNA"), k).alias("id"), day("2016-01-01", 1000).alias("record_date"), F.array(k.cast("string")).alias("pmids"), F.when(k % 4 == 0, 2).otherwise(1).alias("hits"))
    links = d.part.select(F.concat(F.lit("PRJNA"), k).alias("id"), (F.when(k % 3 == 0, 200000000).otherwise(500000000) + k).alias("uid"))
    series = d.part.select(F.concat(F.lit("GSE"), k).alias("id"), day("2015-01-01", 2000).alias("record_date"), F.array((k + 7).cast("string")).alias("pmids"))
    return L.with_mirror(projects, links, series).select("id", "record_date", F.array_join("pmids", ";").alias("pmids"))


@query("rec_proteomics", f"SELECT {K}, CAST({K} AS STRING) AS pmids, '10.1/x' || CAST({K} AS STRING) AS dois, 'Ana Smith' || CAST({K} % 25 AS STRING) AS contacts FROM {{part}}")
def rec_proteomics(d: Data) -> DataFrame:
    k = F.col(K).cast("string")
    text = F.concat(
        F.lit('{"publications":[{"terms":[{"name":"PubMed identifier","value":"'), k, F.lit('"},{"name":"Digital Object Identifier (DOI)","value":"https://doi.org/10.1/X'), k,
        F.lit('"}]}],"contacts":[{"terms":[{"name":"contact name","value":"Ana Smith'), (F.col(K) % 25).cast("string"), F.lit('"},{"name":"contact email","value":"a@b"}]}]}'),
    )
    r = L.proteomics_record(text)
    return d.part.select(K, *[F.array_join(v, ";").alias(c) for c, v in r.items()])


def keys_text(keys: F.Column) -> F.Column:
    return F.array_join(F.array_sort(F.transform(keys, lambda x: F.concat_ws(" ", x["surname"], x["initial"]))), ";")


# answers in the shapes of the two services: every third names no paper, every seventh no grant; some fields are missing
_GRANT = f"CASE WHEN {K} % 7 = 0 THEN '' ELSE 'R01CA' || lpad(CAST({K} % 100 AS STRING), 6, '0') END"


@query("rec_structures", f"""SELECT {K}, CASE WHEN {K} % 2 = 0 THEN 'PDB' ELSE 'EMDB' END AS repo, CASE WHEN {K} % 5 = 0 THEN NULL ELSE DATE '2018-03-04' + CAST({K} % 400 AS INT) END AS record_date, CASE WHEN {K} % 3 = 0 THEN '' ELSE CAST({K} AS STRING) END AS pmids,
    CASE WHEN {K} % 3 = 0 THEN '' ELSE '10.1/x' || CAST({K} AS STRING) END AS dois, {_GRANT} AS grants, CASE WHEN {K} % 3 = 0 THEN 'tamayojaramillo d' WHEN {K} % 2 = 0 THEN 'shen p;tamayojaramillo d' ELSE 'garcia m;tamayojaramillo d' END AS people, {K} % 3 <> 0 AS pubs_complete FROM {{part}}""")
def rec_structures(d: Data) -> DataFrame:
    k = F.col(K)
    pmid, doi = F.when(k % 3 != 0, k), F.when(k % 3 != 0, F.concat(F.lit("https://doi.org/10.1/X"), k.cast("string")))
    day = F.when(k % 5 == 0, "2018").otherwise(F.date_format(F.expr(f"date_add(DATE '2018-03-04', cast({K} % 400 as int))"), "yyyy-MM-dd'T'00:00:00.000+00:00"))
    grant = F.when(k % 7 != 0, F.concat(F.lit("NIH R01 CA-"), F.lpad((k % 100).cast("string"), 6, "0")))
    pdb = F.to_json(F.struct(
        F.struct(day.alias("initial_release_date")).alias("rcsb_accession_info"),
        F.struct(pmid.alias("pdbx_database_id_PubMed"), doi.alias("pdbx_database_id_DOI"), F.when(k % 3 != 0, F.array(F.lit("Tamayo-Jaramillo, D."), F.lit("Shen, P.S."))).alias("rcsb_authors")).alias("rcsb_primary_citation"),
        F.array(F.struct(F.lit("Tamayo-Jaramillo, D.").alias("name"))).alias("audit_author"), F.array(F.struct(grant.alias("grant_number"))).alias("pdbx_audit_support"),
    ))
    ref = lambda kind, value: F.struct(F.lit(kind).alias("type_"), value.cast("string").alias("valueOf_"))
    author = lambda name: F.struct(F.lit(name).alias("valueOf_"))
    cited = F.when(k % 3 != 0, F.struct(F.array(ref("ISSN", F.lit("1")), ref("PUBMED", pmid), ref("DOI", doi)).alias("external_references"), F.array(author("García ML"), author("Tamayo-Jaramillo D")).alias("author")))
    emdb = F.to_json(F.struct(
        F.struct(F.struct(day.alias("header_release")).alias("key_dates"), F.struct(F.array(author("Tamayo-Jaramillo D")).alias("author")).alias("authors_list"), F.struct(F.array(F.struct(grant.alias("code"))).alias("grant_reference")).alias("grant_support")).alias("admin"),
        F.struct(F.struct(F.struct(cited.alias("citation_type")).alias("primary_citation")).alias("citation_list")).alias("crossreferences"),
    ))
    repo = F.when(k % 2 == 0, "PDB").otherwise("EMDB")
    rows = d.part.select(K, repo.alias("repo"), F.when(k % 2 == 0, pdb).otherwise(emdb).alias("text"))
    r = L.structure_record(F.col("repo"), F.col("text"))
    return rows.select(K, "repo", r["record_date"].alias("record_date"), *[F.array_join(r[c], ";").alias(c) for c in ("pmids", "dois", "grants")], keys_text(r["people"]).alias("people"), r["pubs_complete"].alias("pubs_complete"))


@query("rec_datacite", f"""SELECT {K}, repo, CASE WHEN repo = 'Mendeley Data' AND {K} % 2 = 0 THEN DATE '2017-01-01' + CAST({K} % 300 AS INT) WHEN {K} % 5 = 0 THEN DATE '2019-05-05' ELSE DATE '2017-01-01' + CAST({K} % 300 AS INT) END AS record_date,
    '10.1/a' || CAST({K} AS STRING) AS dois, CAST({K} AS STRING) AS pmids, {_GRANT} AS grants, CASE WHEN {K} % 4 = 0 THEN 'park ;xiao y' ELSE 'xiao y' END AS people, {K} % 4 <> 0 AS people_complete
    FROM (SELECT {K}, CASE {K} % 3 WHEN 0 THEN 'Mendeley Data' WHEN 1 THEN 'Zenodo' ELSE 'Synapse' END AS repo FROM {{part}}) t WHERE NOT (repo = 'Zenodo' AND {K} % 11 = 0)""")
def rec_datacite(d: Data) -> DataFrame:
    k, n = F.col(K), F.col(K).cast("string")
    repo = F.when(k % 3 == 0, "Mendeley Data").when(k % 3 == 1, "Zenodo").otherwise("Synapse")
    ids = d.part.select(K, repo.alias("repo"), F.when(k % 3 == 0, F.concat(F.lit("10.17632/"), F.lpad(n, 10, "x"), F.lit(".2"))).when(k % 3 == 1, F.concat(F.lit("10.5281/zenodo."), n)).otherwise(F.concat(F.lit("syn"), n)).alias("id"))
    issued = F.date_format(F.expr(f"date_add(DATE '2017-01-01', cast({K} % 300 as int))"), "yyyy-MM-dd")
    # a year alone is no date; each second dataset of the versioned kind is registered without its version only
    bare = (k % 3 == 0) & (k % 2 == 0)
    date = lambda day, kind: F.struct(day.alias("date"), F.lit(kind).alias("dateType"))
    xiao = F.struct(F.lit("Xiao, Yujie").alias("name"), F.lit("Xiao").alias("familyName"), F.lit("Yujie").alias("givenName"))
    park = F.struct(F.lit("Park laboratory").alias("name"), F.lit("Park laboratory").alias("familyName"), F.lit(None).cast("string").alias("givenName"))
    related = lambda value, kind: F.struct(value.alias("relatedIdentifier"), F.lit(kind).alias("relatedIdentifierType"))
    grant = F.when(k % 7 != 0, F.concat(F.lit("R01CA"), F.lpad((k % 100).cast("string"), 6, "0")))
    text = F.to_json(F.struct(F.struct(F.struct(
        F.lit("2019-05-05T10:00:00Z").alias("created"), F.array(date(F.lit("2016-01-01"), "Updated"), date(F.when(~bare & (k % 5 == 0), "2017").otherwise(issued), "Issued")).alias("dates"),
        F.when(k % 4 == 0, F.array(xiao, park)).otherwise(F.array(xiao)).alias("creators"),
        F.array(related(F.concat(F.lit("DOI:10.1/A"), n), "DOI"), related(F.concat(F.lit("PMID:"), n), "PMID"), related(F.lit("x"), "URL")).alias("relatedIdentifiers"),
        F.array(F.struct(grant.alias("awardNumber"))).alias("fundingReferences"),
    ).alias("attributes")).alias("data")))
    doi = L.record_doi(F.col("repo"), F.col("id"))
    asked = F.when(bare, F.regexp_replace(doi, r"\.\d+$", "")).otherwise(doi)
    answers = ids.where("repo <> 'Zenodo' OR p_partkey % 11 <> 0").select(asked.alias("doi"), text.alias("text"))
    r = L.doi_record(F.col("text"))
    found = L.doi_answers(ids, answers).where("text IS NOT NULL")
    return found.select(K, "repo", r["record_date"].alias("record_date"), *[F.array_join(r[c], ";").alias(c) for c in ("dois", "pmids", "grants")], keys_text(r["people"]).alias("people"), r["people_complete"].alias("people_complete"))


#: Names in all styles, with the surname and initial that are read from them.
NAMES = [
    ("Smithé J", "last_initials", "smithe", "j"), ("van der Berg-Lee AB.", "last_initials", "vanderberglee", "a"), ("Li WEI", "last_initials", "li", "w"), ("Consortium Group", "last_initials", "consortiumgroup", ""),
    ("Ana,M,Smith", "geo", "smith", "a"), ("Hisham,,Mohammed", "geo", "mohammed", "h"), ("Ana Smith", "geo", "smith", "a"), ("Tamayo-Jaramillo, D.", "auto", "tamayojaramillo", "d"), ("Aaron B. Storey", "auto", "storey", "a"),
    ("Park laboratory", "auto", "park", ""), ("The Doe Lab", "auto", "doe", ""), ("bkim6", "auto", "bkim", ""), ("X", "auto", None, None), ("Ødegård, Åse", "auto", "degard", "a"),
]


def _names(column: int) -> str:
    return f"CASE c_custkey % {len(NAMES)} " + " ".join(f"WHEN {i} THEN " + ("NULL" if x[column] is None else f"'{x[column]}'") for i, x in enumerate(NAMES)) + " END"


@query("rec_person", f"SELECT c_custkey, {_names(1)} AS style, {_names(2)} AS surname, {_names(3)} AS initial FROM {{customer}}")
def rec_person(d: Data) -> DataFrame:
    rows = d.customer.select("c_custkey", F.expr(_names(0)).alias("name"), F.expr(_names(1)).alias("style"))
    found = F.coalesce(*[F.when(F.col("style") == x, people(F.array("name"), x)) for x in ("last_initials", "geo", "auto")])
    first = F.get("p", F.lit(0))
    return rows.select("c_custkey", "style", found.alias("p")).select("c_custkey", "style", first["surname"].alias("surname"), first["initial"].alias("initial"))


@query("rec_authors", "SELECT pmid, 'doe b;smith' || CASE WHEN initial IS NULL THEN '' ELSE ' ' || lower(initial) END AS people FROM {paper}")
def rec_authors(d: Data) -> DataFrame:
    # digits are no part of a surname
    keys = people(F.split("authors", ","), "last_initials")
    return d.paper.select("pmid", F.array_join(F.transform(keys, lambda x: F.concat(x["surname"], F.lit(" "), x["initial"])), ";").alias("people"))


@query("rec_grants_in", """SELECT core_project_num, core_project_num || CASE WHEN core_project_num = 'U54HG000001' THEN '' ELSE ';U54HG000001' END AS grants FROM {award}""")
def rec_grants_in(d: Data) -> DataFrame:
    core = F.col("core_project_num")
    text = F.concat(F.lit("Supported by "), F.substring(core, 1, 3), F.lit(" "), F.substring(core, 4, 2), F.lit("-"), F.substring(core, 6, 6), F.lit(" and U54 HG000001, also "), core, F.lit("."))
    return d.award.select("core_project_num", F.array_join(L.grants_in(text), ";").alias("grants"))


@query("rec_doi_norm", "SELECT repo, id, lower(id) AS doi FROM {status} WHERE repo = 'Zenodo'")
def rec_doi_norm(d: Data) -> DataFrame:
    n = F.length("id") % 3
    raw = F.when(n == 0, F.concat(F.lit(" https://doi.org/"), F.upper("id"))).when(n == 1, F.concat(F.lit("doi: "), "id")).otherwise(F.concat(F.lit("http://dx.doi.org/"), "id"))
    return d.status.where("repo = 'Zenodo'").select("repo", "id", C.norm_doi(raw).alias("doi"))


_CHECK = """WITH b AS (SELECT i.pmid, i.repo, i.id, p.pub_date, p.surname, p.initial, r.record_date, r.pubs_complete, r.people_complete FROM {ident} i JOIN {paper} p ON i.pmid = p.pmid JOIN {record} r ON i.repo = r.repo AND i.id = r.id),
    g AS (SELECT i.pmid, i.repo, i.id, MIN(x.core) AS shared FROM {ident} i JOIN {record_grant} x ON i.repo = x.repo AND i.id = x.id JOIN {link} l ON l.pmid = i.pmid AND l.coreproject = x.core GROUP BY 1, 2, 3),
    f AS (SELECT b.*, c.pmid IS NOT NULL AS cites, g.shared, hp.id IS NOT NULL AS has_pubs, hq.id IS NOT NULL AS has_people,
      EXISTS (SELECT 1 FROM {record_person} q WHERE q.repo = b.repo AND q.id = b.id AND q.surname = b.surname AND (q.initial = b.initial OR q.initial = '')) AS same,
      COALESCE(date_diff('day', b.record_date, b.pub_date) > 365, FALSE) AS old
      FROM b LEFT JOIN {record_pmid} c ON c.repo = b.repo AND c.id = b.id AND c.pmid = b.pmid LEFT JOIN g ON g.pmid = b.pmid AND g.repo = b.repo AND g.id = b.id
      LEFT JOIN (SELECT DISTINCT repo, id FROM {record_pmid}) hp ON hp.repo = b.repo AND hp.id = b.id LEFT JOIN (SELECT DISTINCT repo, id FROM {record_person}) hq ON hq.repo = b.repo AND hq.id = b.id),
    t AS (SELECT *, CASE WHEN cites THEN 'cites_paper' WHEN shared IS NOT NULL THEN 'names_award' WHEN old AND pubs_complete AND has_pubs THEN 'contradicted'
      WHEN has_people AND NOT same AND people_complete AND (old OR pubs_complete AND has_pubs) THEN 'contradicted' WHEN has_people AND same AND NOT old THEN 'authors' ELSE '' END AS record_tier FROM f)"""


def tiers(d: Data) -> DataFrame:
    papers = d.ident.select("pmid", "repo", "id").join(d.paper.select("pmid", "pub_date"), "pmid")
    authors = d.paper.select("pmid", "surname", "initial")
    links = d.link.select("pmid", F.col("coreproject").alias("core"))
    return R.check(papers, d.record, d.record_pmid, d.record_grant, d.record_person, links, authors)


@query("rec_check", _CHECK + " SELECT pmid, repo, id, record_tier, CASE WHEN record_tier = 'names_award' THEN shared ELSE '' END AS record_note FROM t")
def rec_check(d: Data) -> DataFrame:
    return tiers(d)


@query("rec_people_match", """SELECT DISTINCT p.pmid, q.repo, q.id FROM {ident} i JOIN {paper} p ON i.pmid = p.pmid JOIN {record_person} q ON i.repo = q.repo AND i.id = q.id
    WHERE q.surname = p.surname AND (q.initial = p.initial OR q.initial = '')""")
def rec_people_match(d: Data) -> DataFrame:
    a = d.ident.select("pmid", "repo", "id").join(d.paper.select("pmid", "surname", F.col("initial").alias("i")), "pmid")
    j = a.join(d.record_person.withColumnRenamed("initial", "j"), ["repo", "id", "surname"])
    return j.where((F.col("i") == F.col("j")) | (F.col("i") == "") | (F.col("j") == "")).select("pmid", "repo", "id").distinct()


def dated(d: Data) -> DataFrame:
    return d.ident.join(d.paper.select("pmid", "pub_date"), "pmid", "left")


@query("xck_demote", """SELECT i.pmid, i.repo, i.id, CASE WHEN i.role IN ('generated', 'unknown') AND COALESCE(date_diff('day', r.record_date, p.pub_date) > 365, FALSE) AND t.id IS NOT NULL AND c.pmid IS NULL THEN 'reused' ELSE i.role END AS role
    FROM {ident} i LEFT JOIN {paper} p ON i.pmid = p.pmid LEFT JOIN {record} r ON i.repo = r.repo AND i.id = r.id LEFT JOIN (SELECT DISTINCT repo, id FROM {record_pmid}) t ON i.repo = t.repo AND i.id = t.id
    LEFT JOIN {record_pmid} c ON c.repo = i.repo AND c.id = i.id AND c.pmid = i.pmid WHERE i.repo = 'GEO'""")
def xck_demote(d: Data) -> DataFrame:
    return R.demote(dated(d).where("repo = 'GEO'"), d.record, d.record_pmid).select("pmid", "repo", "id", F.col("new_role").alias("role"))


@query("xck_promote", """SELECT i.pmid, i.repo, i.id, CASE WHEN c.pmid IS NOT NULL AND (i.role = 'unknown' OR i.role = 'reused' AND i.evidence LIKE 'reused by default%') THEN 'generated' ELSE i.role END AS role
    FROM {ident} i LEFT JOIN {record_pmid} c ON c.repo = i.repo AND c.id = i.id AND c.pmid = i.pmid""")
def xck_promote(d: Data) -> DataFrame:
    return R.promote(d.ident, d.record_pmid).select("pmid", "repo", "id", F.col("new_role").alias("role"))


@query("xck_apply", _CHECK + """ SELECT i.pmid, i.repo, i.id, i.role AS role_before, COALESCE(t.record_tier, '') AS record_tier, CASE WHEN t.record_tier = 'contradicted' AND i.role IN ('generated', 'unknown') THEN 'reused'
    WHEN t.record_tier IN ('cites_paper', 'names_award', 'authors') AND i.role = 'unknown' THEN 'generated' WHEN t.record_tier IN ('cites_paper', 'names_award') AND i.role = 'reused' AND i.evidence LIKE 'reused by default%' THEN 'generated' ELSE i.role END AS role
    FROM {ident} i LEFT JOIN t ON i.pmid = t.pmid AND i.repo = t.repo AND i.id = t.id""")
def xck_apply(d: Data) -> DataFrame:
    return R.apply_checks(d.ident, tiers(d)).select("pmid", "repo", "id", "role_before", "record_tier", "role")


#: Study groups (sg: repo, id, study_group) as common tables of SQL; each seventh series has a superseries.
STUDY_SQL = """sn AS (SELECT pmid, SUM(CASE WHEN id LIKE 'PRJ%' THEN 1 ELSE 0 END) AS np, MIN(CASE WHEN id LIKE 'PRJ%' THEN id END) AS prj, SUM(CASE WHEN id LIKE 'EGAS%' THEN 1 ELSE 0 END) AS ne, MIN(CASE WHEN id LIKE 'EGAS%' THEN id END) AS egas FROM {ident} GROUP BY pmid),
    st AS (SELECT i.repo, i.id, CAST(i.pmid AS BIGINT) AS k, CASE WHEN i.repo = 'SRA/BioProject' AND i.id NOT LIKE 'PRJ%' AND np = 1 THEN i.repo || ':' || prj WHEN i.repo = 'EGA' AND i.id LIKE 'EGAD%' AND ne = 1 THEN i.repo || ':' || egas END AS g FROM {ident} i JOIN sn ON i.pmid = sn.pmid),
    sa AS (SELECT repo, id, arg_min(g, k) FILTER (WHERE g IS NOT NULL) AS g FROM st GROUP BY repo, id), su AS (SELECT id, 'GSE9' || substr(id, 4) AS up FROM {status} WHERE repo = 'GEO' AND id LIKE '%7'),
    sg AS (SELECT sa.repo, sa.id, CASE WHEN sa.repo = 'GEO' AND su.up IS NOT NULL THEN 'GEO:' || su.up ELSE COALESCE(sa.g, sa.repo || ':' || sa.id) END AS study_group FROM sa LEFT JOIN su ON sa.id = su.id)"""


def studies(d: Data) -> DataFrame:
    series = d.status.where("repo = 'GEO' AND id LIKE '%7'").select("id", F.concat(F.lit("GSE9"), F.substring("id", 4, 20)).alias("superseries"))
    return R.study_groups(d.ident, series)


@query("xck_study_groups", f"WITH {STUDY_SQL} SELECT repo, id, study_group FROM sg")
def xck_study_groups(d: Data) -> DataFrame:
    return studies(d)
