"""Awards, papers, mentions, records and catalog derived from the given tables, in SQL that Spark and DuckDB share."""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

#: (repository, class, identifier) of a part key, by its remainder by 8.
_REPO = """CASE {k} % 8 WHEN 0 THEN 'GEO' WHEN 1 THEN 'SRA/BioProject' WHEN 2 THEN 'dbGaP' WHEN 3 THEN 'Zenodo'
 WHEN 4 THEN 'GitHub' WHEN 5 THEN 'PRIDE/ProteomeXchange' WHEN 6 THEN 'EGA' ELSE 'other link' END"""
_CLS = """CASE {k} % 8 WHEN 2 THEN 'controlled' WHEN 3 THEN 'generic' WHEN 4 THEN 'code' WHEN 6 THEN 'controlled'
 WHEN 7 THEN 'url' ELSE 'public' END"""
_ID = """CASE {k} % 8 WHEN 0 THEN 'GSE' || CAST(100000 + {k} AS STRING)
 WHEN 1 THEN CASE WHEN {k} % 16 = 1 THEN 'PRJNA' ELSE 'SRR' END || CAST(1000000 + {k} AS STRING)
 WHEN 2 THEN 'phs' || lpad(CAST({k} AS STRING), 6, '0') WHEN 3 THEN '10.5281/zenodo.' || CAST(10000 + {k} AS STRING)
 WHEN 4 THEN 'github.com/lab' || CAST({k} % 50 AS STRING) || '/tool' || CAST({k} AS STRING)
 WHEN 5 THEN 'PXD' || lpad(CAST({k} AS STRING), 6, '0')
 WHEN 6 THEN CASE WHEN {k} % 16 = 6 THEN 'EGAS' ELSE 'EGAD' END || lpad(CAST({k} AS STRING), 11, '0')
 ELSE 'https://lab' || CAST({k} % 50 AS STRING) || '.example.org/data/' || CAST({k} AS STRING) END"""


def _of(text: str, key: str) -> str:
    return text.replace("{k}", key)


VIEWS = {
    # one row for each yearly project of an award
    "project": """SELECT 'R01CA' || lpad(CAST(s_suppkey AS STRING), 6, '0') AS core_project_num,
        CAST(1 + y AS STRING) || 'R01CA' || lpad(CAST(s_suppkey AS STRING), 6, '0') || '-0' || CAST(y + 1 AS STRING) AS project_num,
        CAST(10000000 + s_suppkey * 10 + y AS BIGINT) AS appl_id, s_name AS title, n_name AS org, r_name AS org_state,
        CAST(2020 + y AS INT) AS fiscal_year, DATE '1993-01-01' + CAST(s_suppkey * 37 % 2000 AS INT) AS start_date,
        DATE '1993-01-01' + CAST(s_suppkey * 37 % 2000 + 1825 AS INT) AS end_date,
        CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(ROUND(s_acctbal * 100) AS BIGINT) END AS amount,
        CASE WHEN s_suppkey % 4 = 0 THEN 'HG' ELSE 'CA' END AS ic, CASE WHEN s_suppkey % 3 = 0 THEN 'U01' ELSE 'R01' END AS activity,
        CAST(1 + y AS STRING) AS award_type
      FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
      CROSS JOIN (SELECT 0 AS y UNION ALL SELECT 1) years WHERE y = 0 OR s_suppkey % 2 = 0""",
    "award": """SELECT core_project_num, MIN(start_date) AS start_date, MIN(title) AS title, MIN(org) AS org,
        MIN(org_state) AS org_state FROM {project} GROUP BY core_project_num""",
    "paper": """SELECT CAST(o_orderkey AS STRING) AS pmid,
        CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'PMC' || CAST(o_orderkey AS STRING) END AS pmcid,
        CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS pub_date,
        CASE o_orderkey % 7 WHEN 0 THEN 'A review of the field' WHEN 1 THEN 'Retrospective chart review' ELSE 'Study ' || CAST(o_orderkey AS STRING) END AS title,
        CASE o_orderkey % 10 WHEN 0 THEN 'Preprint' WHEN 1 THEN 'editorial' WHEN 2 THEN 'review; research-article' ELSE 'research-article' END AS pub_type,
        CASE WHEN o_orderkey % 3 = 0 THEN 'N' ELSE 'Y' END AS open_access, CASE WHEN o_orderkey % 5 = 0 THEN 'N' ELSE 'Y' END AS in_pmc,
        CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 3 = 0 THEN 'pmc' ELSE 'epmc' END AS fulltext_source,
        'Smith' || CAST(c_nationkey AS STRING) || ' ' || substr('ABCDEFGHIJ', CAST(c_custkey % 10 + 1 AS INT), 1) || ', Doe B.' AS authors,
        'Smith' || CAST(c_nationkey AS STRING) AS surname, substr('ABCDEFGHIJ', CAST(c_custkey % 10 + 1 AS INT), 1) AS initial
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "link": """SELECT DISTINCT 'R01CA' || lpad(CAST(l_suppkey AS STRING), 6, '0') AS coreproject, CAST(l_orderkey AS STRING) AS pmid,
        CAST(10000000 + l_suppkey * 10 AS BIGINT) AS applid FROM {lineitem}""",
    "mention": f"""SELECT CAST(l_orderkey AS STRING) AS pmid, CAST(l_linenumber AS INT) AS ord, {_of(_REPO, "l_partkey")} AS repo,
        {_of(_CLS, "l_partkey")} AS cls, {_of(_ID, "l_partkey")} AS id,
        CASE WHEN l_returnflag = 'A' THEN 'generated' WHEN l_returnflag = 'R' THEN 'reused' WHEN l_linenumber % 2 = 0 THEN 'unknown' ELSE 'none' END AS role,
        CASE l_linenumber % 4 WHEN 0 THEN 'das' WHEN 1 THEN 'body' WHEN 2 THEN 'krt' ELSE 'ref' END AS location,
        'cue ' || CAST(l_linenumber AS STRING) AS evidence, 'sentence ' || CAST(l_linenumber AS STRING) || ' of ' || CAST(l_orderkey AS STRING) AS context,
        l_quantity > 40 AS code_context, l_discount > 0.08 AS this_row
      FROM {{lineitem}}""",
    # identifiers of papers: one row for each (paper, repository, identifier)
    "ident": """SELECT pmid, repo, id, MIN(cls) AS cls, MIN(ord) AS ord,
        CASE WHEN MAX(CASE WHEN role = 'generated' THEN 1 ELSE 0 END) = 1 THEN 'generated'
          WHEN MAX(CASE WHEN role = 'reused' THEN 1 ELSE 0 END) = 1 THEN 'reused' ELSE 'unknown' END AS role,
        MAX(CASE WHEN location = 'das' THEN 1 ELSE 0 END) = 1 AS in_das, MIN(cls) = 'code' AS is_code,
        CASE WHEN MIN(ord) % 3 = 0 THEN 'reused by default: no cue' ELSE MIN(evidence) END AS evidence
      FROM {mention} GROUP BY pmid, repo, id""",
    "status": f"""SELECT {_of(_REPO, "p_partkey")} AS repo, {_of(_ID, "p_partkey")} AS id,
        CASE p_size % 7 WHEN 0 THEN 'NOT_FOUND' WHEN 1 THEN 'PRIVATE' WHEN 2 THEN 'UNVERIFIED' WHEN 3 THEN 'SKIPPED_API_DOWN' WHEN 4 THEN 'RESTRICTED' ELSE 'RESOLVES' END AS status
      FROM {{part}} WHERE p_partkey % 13 <> 0""",
    "record": f"""SELECT {_of(_REPO, "p_partkey")} AS repo, {_of(_ID, "p_partkey")} AS id, p_partkey,
        CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE DATE '1992-06-01' + CAST(p_partkey * 31 % 3000 AS INT) END AS record_date,
        p_partkey % 3 <> 0 AS pubs_complete, p_partkey % 4 <> 0 AS people_complete
      FROM {{part}} WHERE p_partkey % 8 IN (0, 1, 3, 5) AND p_partkey % 5 <> 0""",
    "record_pmid": f"""SELECT DISTINCT {_of(_REPO, "l_partkey")} AS repo, {_of(_ID, "l_partkey")} AS id, CAST(l_orderkey AS STRING) AS pmid
      FROM {{lineitem}} WHERE l_linenumber = 1 AND l_partkey % 8 IN (0, 1, 3, 5)""",
    "record_grant": f"""SELECT DISTINCT {_of(_REPO, "p_partkey")} AS repo, {_of(_ID, "p_partkey")} AS id,
        'R01CA' || lpad(CAST(p_partkey % 100 AS STRING), 6, '0') AS core FROM {{part}} WHERE p_partkey % 6 = 0""",
    "record_person": f"""SELECT DISTINCT {_of(_REPO, "p_partkey")} AS repo, {_of(_ID, "p_partkey")} AS id,
        'Smith' || CAST(p_partkey % 25 AS STRING) AS surname, CASE WHEN p_partkey % 4 = 1 THEN '' ELSE substr('ABCDEFGHIJ', CAST(p_partkey % 10 + 1 AS INT), 1) END AS initial
      FROM {{part}} WHERE p_partkey % 2 = 0 OR p_partkey % 7 = 0""",
    "catalog": f"""SELECT lower({_of(_ID, "p_partkey")}) AS acc, {_of(_REPO, "p_partkey")} AS repo,
        'see ' || {_of(_ID, "p_partkey + 1")} || ' and ' || {_of(_ID, "p_partkey + 2")} || '.' AS link_text,
        'HTTPS://www.' || {_of(_ID, "p_partkey + 4")} || '.git/' AS url
      FROM {{part}} WHERE p_partkey % 5 IN (0, 1)""",
    "catalog_pmid": f"""SELECT DISTINCT lower({_of(_ID, "l_partkey")}) AS acc, CAST(l_orderkey AS STRING) AS pmid
      FROM {{lineitem}} WHERE l_partkey % 5 = 0 AND l_linenumber <= 2""",
    # paper labels, as the label rules would leave them
    "labelled": """SELECT pmid, fulltext_source, pub_type,
        CASE WHEN fulltext_source IS NULL THEN 'NOT_CHECKABLE' ELSE CASE CAST(pmid AS BIGINT) % 6 WHEN 0 THEN 'PUBLIC_REPOSITORY'
          WHEN 1 THEN 'CONTROLLED_ACCESS' WHEN 2 THEN 'ON_REQUEST' WHEN 3 THEN 'IN_ARTICLE' WHEN 4 THEN 'NO_STATEMENT' ELSE 'NEEDS_REVIEW' END END AS label,
        CASE WHEN CAST(pmid AS BIGINT) % 8 = 0 THEN 'review' ELSE 'rules' END AS label_source
      FROM {paper}""",
    # candidate rows: one for each own (repository, identifier)
    "candidate": """SELECT i.repo, i.id, MIN(CASE WHEN i.is_code THEN 'code' ELSE 'dataset' END) AS type, COUNT(*) AS n_papers,
        COALESCE(MIN(s.status), 'NOT_CHECKED') AS status,
        CASE WHEN COALESCE(MIN(s.status), '') = 'RESOLVES' AND COUNT(r.pmid) > 0 THEN 1
          WHEN COALESCE(MIN(s.status), '') = 'RESOLVES' AND MAX(CASE WHEN i.in_das THEN 1 ELSE 0 END) = 1 THEN 2 ELSE 3 END AS tier
      FROM {ident} i LEFT JOIN {status} s ON i.repo = s.repo AND i.id = s.id
        LEFT JOIN {record_pmid} r ON i.repo = r.repo AND i.id = r.id AND i.pmid = r.pmid
      WHERE i.role = 'generated' AND i.cls <> 'url' GROUP BY i.repo, i.id""",
    # two reviewers of the same items
    "rated": """SELECT doc_id, CASE WHEN quality = 1 THEN 'generated' ELSE 'reused' END AS role_a,
        CASE WHEN toxic = 1 THEN 'reused' ELSE 'generated' END AS role_b, CAST(1 + doc_id % 3 AS INT) AS tier,
        CASE WHEN doc_id % 9 = 0 THEN 'low' ELSE 'high' END AS conf FROM {labels} WHERE doc_id IS NOT NULL""",
}
VIEWS = {k: v.replace("{{", "{").replace("}}", "}") for k, v in VIEWS.items()}
