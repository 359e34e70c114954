"""Queries of documents, statements, mentions and roles, on template texts whose results follow from their number."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import text as X
from ..operators import mentions as M
from ..operators import statements as S
from ..rules import CUES, IDENTIFIER_RULES, SHORT_FORMS
from .base import Data, query

K = "o_orderkey"
# six sentences about a series, by the remainder of the paper's number: own, own, reused, reused, unclear, own
TEMPLATES = [
    ("The data generated in this study have been deposited in GEO under accession GSE{n}.", "generated"),
    ("We have deposited the reads in GEO (GSE{n}).", "generated"),
    ("Publicly available data sets were downloaded from GEO (GSE{n}).", "reused"),
    ("Data for GSE{n} were generated for a previous study, and have been deposited in GEO.", "reused"),
    ("The data sets analysed during the current study are in GEO (GSE{n}).", "unknown"),
    ("Series GSE{n} is available at GEO.", "generated"),
]


def template(number: F.Column, key: F.Column) -> F.Column:
    out = F.lit("")
    for i, (text, _) in enumerate(TEMPLATES):
        before, _, after = text.partition("{n}")
        out = F.when(key % len(TEMPLATES) == i, F.concat(F.lit(before), number.cast("string"), F.lit(after))).otherwise(out)
    return out


def duck_template() -> str:
    whens = " ".join(f"WHEN {i} THEN '{t.partition('{n}')[0]}' || CAST(100000 + {K} AS STRING) || '{t.partition('{n}')[2]}'" for i, (t, _) in enumerate(TEMPLATES))
    return f"CASE {K} % 6 {whens} END"


def articles(d: Data) -> DataFrame:
    """A full text for each order: front, a body with a table and a citation, a statement, references; each tenth is broken."""
    k = F.col(K)
    n = (100000 + k).cast("string")
    xml = F.concat(
        F.lit('<!DOCTYPE article><article article-type="research-article"><front><article-meta><article-id pub-id-type="manuscript">'), n,
        F.lit("</article-id><title-group><article-title>T</article-title></title-group><abstract><p>Data availability: none here.</p></abstract></article-meta></front><body><sec><title>Methods&nbsp;</title><p>Reads of GSE"), n,
        F.lit('<sup><xref ref-type="bibr" rid="r1">41</xref></sup> were used&#8211;twice. See <ext-link xlink:href="https://github.com/lab/tool" xmlns:xlink="http://www.w3.org/1999/xlink">code</ext-link>.</p>'),
        F.lit("<table-wrap><caption><p>Key resources table</p></caption><table><tr><td>Deposited data</td><td>This paper</td><td>GEO: GSE"), n,
        F.lit('</td></tr></table></table-wrap></sec></body><back><sec sec-type="data-availability"><title>Data availability</title><p>'), template(100000 + k, k),
        F.lit("</p></sec><ref-list><ref id=\"r1\"><mixed-citation>Doe et al. 2019</mixed-citation></ref></ref-list></back></article>"),
    )
    return d.spread("orders", K).select(k.cast("string").alias("pmid"), F.when(k % 10 == 9, "<article><p>open").otherwise(xml).alias("xml"), k.alias(K))


@query("txt_parse_xml", f"""SELECT CAST({K} AS STRING) AS pmid, CASE WHEN {K} % 10 = 9 THEN 0 ELSE 8 END AS passages, CASE WHEN {K} % 10 = 9 THEN 0 ELSE 2 END AS statement, CASE WHEN {K} % 10 = 9 THEN 0 ELSE 1 END AS key_rows,
    {K} % 10 = 9 AS broken, {K} % 10 <> 9 AS manuscript FROM {{orders}}""")
def txt_parse_xml(d: Data) -> DataFrame:
    p = X.parse_passages(articles(d))
    return p.groupBy("pmid").agg(
        F.count("passage_ord").cast("int").alias("passages"), F.count_if("das").cast("int").alias("statement"), F.count_if("krt").cast("int").alias("key_rows"),
        F.bool_or(F.col("error").isNotNull()).alias("broken"), F.bool_or("is_manuscript").alias("manuscript"),
    )


@query("txt_flatten", f"SELECT CAST({K} AS STRING) AS pmid, 'Reads of GSE' || CAST(100000 + {K} AS STRING) || ' 41 were used-twice. See code <https://github.com/lab/tool> .' AS text FROM {{orders}} WHERE {K} % 10 <> 9")
def txt_flatten(d: Data) -> DataFrame:
    p = X.parse_passages(articles(d), ["pmid", "kind", "text"])
    return p.where((F.col("kind") == "p") & F.col("text").startswith("Reads")).select("pmid", "text")


@query("txt_headings", f"SELECT CAST({K} AS STRING) AS pmid, 'Key resources table > ' AS prefix, 'Methods > Key resources table' AS sec FROM {{orders}} WHERE {K} % 10 <> 9")
def txt_headings(d: Data) -> DataFrame:
    p = X.parse_passages(articles(d)).where("kind = 'tr'")
    return p.select("pmid", F.concat(F.get("chain", F.lit(0)), F.lit(" > ")).alias("prefix"), "sec")


#: Sections by title and type, with the first words of their text, and whether their text is a statement.
SECTIONS = [
    ("Data availability", "", "Reads are open", True), ("Availability of data and materials", "", "Reads are open", True), ("Data and code sharing statement", "", "Reads are open", True),
    ("Accession numbers", "", "Reads are open", True), ("Deposited data", "", "Reads are open", True), ("Supplement", "data-availability", "Reads are open", True), ("Notes", "code_availability", "Reads are open", True),
    ("Statement on software", "", "Reads are open", False), ("Conflict of interest statement and data", "", "Reads are open", False), ("Materials availability", "", "Reads are open", False),
    ("Lead contact", "", "Data availability: elsewhere", False), ("Results", "", "Data availability: in GEO", True), ("Results", "", "Data and code availability statement. In GEO", True),
    ("Results", "", "Data were available: all", False), ("Key resources table", "", "Data availability: no", False), ("Results", "", "Reads are open", False),
]
_SECTION = f"CAST(FLOOR({K} / 4) AS BIGINT) % {len(SECTIONS)}"


@query("txt_is_statement", f"""SELECT CAST({K} AS STRING) AS pmid, CASE {_SECTION} {" ".join(f"WHEN {i} THEN '{x[0]}'" for i, x in enumerate(SECTIONS))} END AS heading,
    {_SECTION} IN ({", ".join(str(i) for i, x in enumerate(SECTIONS) if x[3])}) AS das FROM {{orders}}""")
def txt_is_statement(d: Data) -> DataFrame:
    of = F.get(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("title", "type", "text"), x[:3], strict=True)]) for x in SECTIONS]), F.expr(_SECTION).cast("int"))
    rows = d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), of.alias("s"))
    xml = F.concat(F.lit("<article><back><sec sec-type='"), "s.type", F.lit("'><title>"), "s.title", F.lit("</title><p>"), "s.text", F.lit(" and more words follow.</p></sec></back></article>"))
    return X.parse_passages(rows.select("pmid", xml.alias("xml"))).where("kind = 'p'").select("pmid", F.get("chain", F.lit(0)).alias("heading"), "das")


@query("txt_is_key_table", f"SELECT CAST({K} AS STRING) AS pmid, 'Deposited data | This paper | GEO: GSE' || CAST(100000 + {K} AS STRING) AS text FROM {{orders}} WHERE {K} % 10 <> 9")
def txt_is_key_table(d: Data) -> DataFrame:
    return X.parse_passages(articles(d)).where("krt").select("pmid", "text")


_ABBREVIATION = r"(^|[^\p{L}\p{N}_])((?i:" + "|".join("et al" if x == "al" else x.replace(".", r"\.") for x in SHORT_FORMS) + r"))\."


def _twice(text: str, pattern: str, to: str) -> str:
    """Replaced twice, as a match may need the last letter of the one before."""
    return f"regexp_replace(regexp_replace({text}, '{pattern}', '{to}', 'g'), '{pattern}', '{to}', 'g')"


_COVERED = _twice("text", _ABBREVIATION, r"\1\2" + "․")
_CUT = _twice(f"regexp_replace({_COVERED}, '([.;!?])\\s+([A-Z(\\[“\"])', '\\1' || chr(1) || '\\2', 'g')", r"([a-z0-9)]\.)([A-Z][a-z]{2})", r"\1' || chr(1) || '\2")


@query("txt_sentences", f"SELECT doc_id, len(list_filter(string_split({_CUT}, chr(1)), lambda x: regexp_matches(x, '\\S'))) AS sentences FROM {{documents}}")
def txt_sentences(d: Data) -> DataFrame:
    return d.documents.select("doc_id", F.size(X.sentences("text")).cast("long").alias("sentences"))


@query("txt_location", """SELECT m.pmid, m.ord, CASE WHEN m.location = 'ref' AND c.pmid IS NOT NULL THEN 'das' ELSE m.location END AS location FROM {mention} m
    LEFT JOIN (SELECT DISTINCT pmid, ord + 1 AS ord FROM {mention} WHERE location = 'krt') c ON c.pmid = m.pmid AND c.ord = m.ord""")
def txt_location(d: Data) -> DataFrame:
    # the statement cites the reference that follows a table mention
    cited = d.mention.where("location = 'krt'").select("pmid", (F.col("ord") + 1).alias("ord"), F.lit(True).alias("cited")).distinct()
    j = d.mention.join(cited, ["pmid", "ord"], "left")
    return j.select("pmid", "ord", F.when((F.col("location") == "ref") & F.col("cited"), "das").otherwise(F.col("location")).alias("location"))


def template_passages(d: Data) -> DataFrame:
    """A body passage and a template passage for each order; in each fourth the latter is the statement."""
    k = F.col(K)
    row = lambda n, das, text: d.spread("orders", K).select(k.cast("string").alias("pmid"), F.lit(n).alias("passage_ord"), F.lit("p").alias("kind"), das.alias("das"), text.alias("text"))
    return row(0, F.lit(False), F.lit("Cells were grown.")).unionByName(row(1, k % 4 == 0, template(100000 + k, k)))


@query("txt_statement", f"""SELECT CAST({K} AS STRING) AS pmid, CASE WHEN {K} % 4 = 0 OR {K} % 6 IN (0, 3) THEN {duck_template()} ELSE '' END AS statement,
    CASE WHEN {K} % 4 = 0 THEN 'section' WHEN {K} % 6 IN (0, 3) THEN 'inline' ELSE 'none' END AS statement_kind FROM {{orders}}""")
def txt_statement(d: Data) -> DataFrame:
    p = template_passages(d)
    s = p.where("NOT das").select("pmid", "passage_ord", F.posexplode(X.sentences("text")).alias("sent_ord", "s"))
    s = s.select("pmid", "passage_ord", "sent_ord", F.lit("Methods").alias("sec"), F.col("s.text").alias("text"))
    return S.statement_text(p, s)


CUE_NAMES = "on_request in_article no_data will_deposit controlled_gen reuse_in_statement gen_in_statement code_in_statement privacy_restriction".split()
#: Sentences of statements, whether each stands in one of its own, and the cues that it gives.
CUE_TEXTS = [
    ("The data are available from the corresponding author upon reasonable request.", True, ["on_request"]),
    ("All plasmids are available from the authors on request.", True, []),
    ("All data are included in the article and its supplementary files.", True, ["in_article"]),
    ("All data are included in the article and its supplementary files.", False, []),
    ("The images are not available within the paper.", True, []),
    ("Not applicable.", True, ["no_data"]),
    ("No new data were generated.", False, []),
    ("Sequences will be deposited in GEO upon publication.", True, ["will_deposit"]),
    ("Genotypes are under controlled access at dbGaP.", True, ["controlled_gen"]),
    ("Genotypes are under controlled access at dbGaP.", False, []),
    ("Genotypes were downloaded from dbGaP.", True, ["reuse_in_statement"]),
    ("Reads have been deposited in dbGaP.", False, ["controlled_gen", "gen_in_statement"]),
    ("Reads can be downloaded from GEO.", True, []),
    ("The scripts are at https://lab.example/x.", True, ["code_in_statement"]),
    ("The scripts are ours.", True, []),
    ("Patient privacy rules out sharing.", True, ["privacy_restriction"]),
    ("We analysed TCGA.", True, ["reuse_in_statement"]),
]


def _cue(name: str) -> str:
    hits = [str(i) for i, (_, _, cues) in enumerate(CUE_TEXTS) if name in cues]
    n = len(CUE_TEXTS)
    # a paper has two sentences, of its number and of the one after
    return f"CAST(FLOOR({K} / 4) AS BIGINT) % {n} IN ({', '.join(hits)}) OR (CAST(FLOOR({K} / 4) AS BIGINT) * 5 + 3) % {n} IN ({', '.join(hits)})"


@query("txt_cues", f"SELECT CAST({K} AS STRING) AS pmid, {', '.join(f'{_cue(c)} AS {c}' for c in CUE_NAMES)} FROM {{orders}}")
def txt_cues(d: Data) -> DataFrame:
    k = F.floor(F.col(K) / 4)
    texts = F.array(*[F.struct(F.lit(t).alias("text"), F.lit(x).alias("section")) for t, x, _ in CUE_TEXTS])
    n = len(CUE_TEXTS)
    both = F.explode(F.array(F.get(texts, (k % n).cast("int")), F.get(texts, ((k * 5 + 3) % n).cast("int"))))
    return S.paper_cues(d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), both.alias("s")).select("pmid", "s.text", "s.section"))


@query("txt_reuse_resources", f"SELECT CAST({K} AS STRING) AS pmid, CASE {K} % 3 WHEN 0 THEN 'GTEx;TCGA' WHEN 1 THEN 'UK Biobank' ELSE '' END AS resources FROM {{orders}}")
def txt_reuse_resources(d: Data) -> DataFrame:
    k = F.col(K) % 3
    text = F.when(k == 0, "Data of TCGA and GTEx, and again TCGA, were used.").when(k == 1, "We used UK Biobank.").otherwise("None.")
    s = d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), text.alias("statement"))
    return S.reuse_resources(s).select("pmid", F.array_join("resources", ";").alias("resources"))


@query("txt_statement_headings", """SELECT CAST(conv_id AS STRING) AS pmid, string_agg(h, ';' ORDER BY h) FILTER (WHERE n <= 5) AS headings FROM (SELECT conv_id, h, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY h) AS n
    FROM (SELECT DISTINCT conv_id, 'Data availability of ' || role || ' ' || CAST(turn % 9 AS STRING) AS h FROM {conversations} WHERE role <> 'assistant' AND text IS NOT NULL) d) t GROUP BY conv_id""")
def txt_statement_headings(d: Data) -> DataFrame:
    # each turn is a section of a full text: those of assistants are methods, the others statements
    title = F.when(F.col("role") == "assistant", "Methods").otherwise(F.concat(F.lit("Data availability of "), "role", F.lit(" "), (F.col("turn") % 9).cast("string")))
    section = F.concat(F.lit("<sec><title>"), title, F.lit("</title><p>Turn "), F.col("turn").cast("string"), F.lit("</p></sec>"))
    rows = d.conversations.where("text IS NOT NULL").groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list(section)), "").alias("body"))
    xml = F.concat(F.lit("<article><body>"), "body", F.lit("</body></article>"))
    found = S.statement_headings(X.parse_passages(rows.select(F.col("conv_id").cast("string").alias("pmid"), xml.alias("xml"))))
    return found.select("pmid", F.array_join("headings", ";").alias("headings"))


@query("txt_snippet", """SELECT CAST(conv_id AS STRING) AS pmid, string_agg(text, ' ' ORDER BY ord) AS snippet FROM (SELECT conv_id, ord, text, COALESCE(SUM(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
    FROM (SELECT conv_id, text, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS ord FROM {conversations} WHERE text IS NOT NULL) n) t WHERE b < 300 GROUP BY conv_id""")
def txt_snippet(d: Data) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = d.conversations.where("text IS NOT NULL").select(F.col("conv_id").cast("string").alias("pmid"), n.alias("ord"), "text")
    return S.snippet(rows)


@query("txt_evidence_packet", """WITH r AS (SELECT CAST(conv_id AS STRING) AS pmid, turn AS ord, repeat(text, 20) AS t, CASE WHEN contains(text, 'en') THEN 0 WHEN role = 'user' THEN 1 ELSE 2 END AS rank,
      ROW_NUMBER() OVER (PARTITION BY conv_id, text ORDER BY turn) AS n FROM {conversations} WHERE contains(text, 'en') OR regexp_matches(text, '(?i)the|der')),
    u AS (SELECT pmid, ord, rank, SUM(length(t)) OVER (PARTITION BY pmid ORDER BY rank, ord ROWS UNBOUNDED PRECEDING) AS used FROM r WHERE n = 1) SELECT pmid, ord, rank, CAST(used AS BIGINT) AS used FROM u WHERE used <= 14000""")
def txt_evidence_packet(d: Data) -> DataFrame:
    # turns, twenty times as long, are the passages of a paper
    p = d.conversations.where("text IS NOT NULL").select(
        F.col("conv_id").cast("string").alias("pmid"), F.col("turn").alias("ord"), (F.col("role") == "user").alias("das"), F.repeat("text", F.lit(20)).alias("text"), F.lit("en").alias("focus"),
    )
    return S.evidence_packet(p, "the|der").select("pmid", "ord", "rank", "used")


@query("txt_sentences_with_id", f"SELECT CAST({K} AS STRING) AS pmid, 'GSE' || CAST(100000 + {K} AS STRING) AS id, {duck_template()} AS text FROM {{orders}}")
def txt_sentences_with_id(d: Data) -> DataFrame:
    pmid, n = F.col(K).cast("string").alias("pmid"), 100000 + F.col(K)
    s = d.spread("orders", K).select(pmid, F.lit(0).alias("ord"), template(n, F.col(K)).alias("text"))
    s = s.unionByName(d.spread("orders", K).select(pmid, F.lit(1).alias("ord"), F.lit("No identifier here.").alias("text")))
    return S.sentences_with(s, d.spread("orders", K).select(pmid, F.concat(F.lit("GSE"), n.cast("string")).alias("id"))).select("pmid", "id", "text")


# ---------------------------------------------------------------- identifiers and roles


def template_sentences(d: Data) -> DataFrame:
    return d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), template(100000 + F.col(K), F.col(K)).alias("sentence"))


#: A sentence for each rule and shape: repository, class, sentence, what is found in it. {n} is the paper's number with n
#: digits; what stands behind a comma is no part of an identifier.
SHAPES = [
    ("GEO", "public", "Series GSE{6} holds them.", "GSE{6}"),
    ("GEO", "public", "The curated set GDS{4}, of reads.", "GDS{4}"),
    ("SRA/BioProject", "public", "Reads are in PRJNA{6}.", "PRJNA{6}"),
    ("SRA/BioProject", "public", "Reads are in SRP{6}; others are not.", "SRP{6}"),
    ("SRA run", "public", "Run SRR{7} was read.", "SRR{7}"),
    ("dbGaP", "controlled", "Study phs{6}.v2.p1 at dbGaP.", "phs{6}"),
    ("EGA", "controlled", "Study EGAS{11} is locked.", "EGAS{11}"),
    ("PRIDE/ProteomeXchange", "public", "Spectra (PXD{6}).", "PXD{6}"),
    ("MassIVE", "public", "Spectra (MSV{9}).", "MSV{9}"),
    ("ArrayExpress", "public", "Arrays are E-MTAB-{5}.", "E-MTAB-{5}"),
    ("BioStudies", "public", "Images are S-BSST{4}.", "S-BSST{4}"),
    ("MetaboLights", "public", "See MTBLS{4}!", "MTBLS{4}"),
    ("Metabolomics Workbench", "public", "See ST{6}?", "ST{6}"),
    ("PDB", "public", "In the PDB under accession number {4} is one.", None),
    ("PDB", "public", "In the PDB under accession number 6{1}BC is one.", "6{1}BC"),
    ("PDB", "public", "Protein Data Bank entry: 7{1}XY.", "7{1}XY"),
    ("PDB", "public", "The PDB codes 5{1}a1 show it.", "5{1}a1"),
    ("EMDB", "public", "Map EMD-{5}.", "EMD-{5}"),
    ("PDC", "public", "Study PDC{6}.", "PDC{6}"),
    ("GDC project", "controlled", "Cohort TCGA-BRCA, run {6}.", "TCGA-BRCA"),
    ("Zenodo", "generic", "At https://zenodo.org/records/{7} now.", "{7}"),
    ("Figshare", "generic", "At doi:10.6084/m9.figshare.{7}.v1(zip)", "10.6084/m9.figshare.{7}.v1"),
    ("Figshare", "generic", "At https://lab.figshare.com/articles/x/{7}, now.", "lab.figshare.com/articles/x/{7}"),
    ("Dryad", "generic", "At doi.org/10.5061/dryad.q{4}(csv) now.", "10.5061/dryad.q{4}"),
    ("OSF", "generic", "At https://osf.io/a{4} now.", "a{4}"),
    ("Mendeley Data", "generic", "At 10.17632/abcd{6}.2 now.", "abcd{6}.2"),
    ("Synapse", "generic", "At syn{8} now.", "syn{8}"),
    ("Dataverse", "generic", "At https://doi.org/10.7910/DVN/I{5}(csv format).", "10.7910/DVN/I{5}"),
    ("Dataverse", "generic", "The university's Dataverse keeps it as doi:10.18130/V3/{6}.", "10.18130/V3/{6}."),
    ("GWAS Catalog", "public", "Statistics are GCST{8}.", "GCST{8}"),
    ("Code Ocean", "code", "Run 10.24433/CO.{7}.v1 again.", "10.24433/CO.{7}.v1"),
    ("Code Ocean", "code", "Run codeocean.com/capsule/{7}/tree again.", "codeocean.com/capsule/{7}"),
    ("TCIA", "public", "Scans: 10.7937/k9(x) {6}", "10.7937/k9"),
    ("TCIA/IDC link", "public", "Scans: www.cancerimagingarchive.net/collection/c{6}, all.", "www.cancerimagingarchive.net/collection/c{6}"),
    ("CELLxGENE", "public", "At cellxgene.cziscience.com/e/abcdef-0123-4567-89ab-{6}.", "cellxgene.cziscience.com/e/abcdef-0123-4567-89ab-{6}"),
    ("GitHub", "code", "At https://github.com/lab/tool{6} too.", "lab/tool{6}"),
    ("GitHub", "code", "At https://github.com/orgs/lab{6} is a list.", None),
    ("GitLab", "code", "At gitlab.com/lab/tool{6} too.", "lab/tool{6}"),
    ("Bitbucket", "code", "At bitbucket.org/lab/tool{6} too.", "lab/tool{6}"),
]


def _digits(part: str) -> str:
    """SQL, of either engine, for a shape's text with the paper's number in it."""
    out = []
    for i, x in enumerate(re.split(r"\{(\d+)\}", part)):
        if i % 2:
            out.append(f"lpad(CAST({K} % {10 ** int(x)} AS STRING), {x}, '0')")
        elif x:
            out.append("'" + x.replace("'", "''") + "'")
    return " || ".join(out)


def _shape(column: int) -> str:
    """SQL for a column of the shape that a paper's number gives."""
    cases = " ".join(f"WHEN {i} THEN {_digits(x[column]) if x[column] is not None else 'NULL'}" for i, x in enumerate(SHAPES))
    return f"CASE CAST(FLOOR({K} / 4) AS BIGINT) % {len(SHAPES)} {cases} END"


@query("idx_extract", f"""SELECT * FROM (SELECT CAST({K} AS STRING) AS pmid, {_shape(0)} AS repo, {_shape(1)} AS cls, {_shape(3)} AS raw FROM {{orders}}) t WHERE raw IS NOT NULL""")
def idx_extract(d: Data) -> DataFrame:
    sentences = d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), F.expr(_shape(2).replace("''", "\\'")).alias("sentence"))
    return X.find_mentions(sentences).select("pmid", "repo", "cls", "raw")


@query("idx_claim", f"SELECT CAST({K} AS STRING) AS pmid, 'Zenodo' AS repo, CAST(10000 + {K} AS STRING) AS raw FROM {{orders}}")
def idx_claim(d: Data) -> DataFrame:
    # the second rule would match the DOI's inside, too
    text = F.concat(F.lit("Dataverse copy at 10.5281/zenodo."), (10000 + F.col(K)).cast("string"), F.lit(" and PDB 1234."))
    return X.find_mentions(d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), text.alias("sentence"))).where("repo <> 'Dataverse'").select("pmid", "repo", "raw")


@query("idx_canon", """SELECT repo, id, CASE repo WHEN 'GitHub' THEN id WHEN 'Zenodo' THEN id WHEN 'dbGaP' THEN lower(id) ELSE id END AS canon FROM {status} WHERE repo <> 'other link'""")
def idx_canon(d: Data) -> DataFrame:
    tail = F.regexp_replace("id", r"^(github\.com/|10\.5281/zenodo\.)", "")
    raw = F.when(F.col("repo") == "GitHub", F.concat(F.upper(tail), F.lit(".git."))).when(F.col("repo") == "dbGaP", F.concat(F.upper("id"), F.lit(",")))
    # a trailing .git is cut from names in their own case only
    raw = F.when(F.col("repo") == "GitHub", F.concat(F.upper(tail), F.lit("."))).otherwise(F.coalesce(raw, F.concat(tail, F.lit(");"))))
    return d.status.where("repo <> 'other link'").select("repo", "id", C.canonical(F.col("repo"), raw).alias("canon"))


@query("idx_merge_runs", "SELECT pmid, ord, repo, id FROM {mention}")
def idx_merge_runs(d: Data) -> DataFrame:
    runs = F.when(F.col("id").startswith("SRR"), "SRA run").otherwise(F.col("repo"))
    return M.merge_runs(d.mention.withColumn("repo", runs)).select("pmid", "ord", "repo", "id")


@query("idx_other_links", "SELECT pmid, lower(id) AS key, MIN(id) AS url FROM {mention} WHERE cls = 'url' GROUP BY pmid, lower(id)")
def idx_other_links(d: Data) -> DataFrame:
    # statements that name a link, its scheme and host in capitals, with marks behind it
    none = lambda t: F.lit(None).cast(t)
    text = F.concat(F.lit("(See "), F.replace("id", F.lit("https://lab"), F.lit("HTTPS://LAB")), F.lit(")."))
    passages = d.mention.where("cls = 'url'").select(
        "pmid", F.col("ord").alias("passage_ord"), F.lit("p").alias("kind"), F.lit(True).alias("das"), F.lit(False).alias("krt"), F.array().cast("array<string>").alias("xrefs"),
        none("string").alias("ref_id"), none("string").alias("error"), text.alias("text"),
    )
    urls = M.mentions_of(passages).where("repo = 'Other link'")
    return urls.groupBy("pmid", F.lower("id").alias("key")).agg(F.min("id").alias("url"))


@query("idx_role", "SELECT CAST(o_orderkey AS STRING) AS pmid, CASE o_orderkey % 6 " + " ".join(f"WHEN {i} THEN '{r}'" for i, (_, r) in enumerate(TEMPLATES)) + " END AS role FROM {orders}")
def idx_role(d: Data) -> DataFrame:
    m = X.find_mentions(template_sentences(d)).withColumns({"krt": F.lit(False), "previous": F.lit(None).cast("string"), "das": F.lit(True)})
    return X.with_roles(m).select("pmid", "role")


#: Sentences of many wordings, whether they stand in a statement, the sentence before, and the role of the series in them.
WORDINGS = [
    ("Whole-genome reads produced for this project can be accessed on the archive under {n}.", True, "", "generated"),
    ("The scripts that reproduce our figures can be accessed via GitHub ({n}).", True, "", "generated"),
    ("These islet data sets were accessed from GEO: {n}.", True, "", "reused"),
    ("Spectra have been deposited to the ProteomeXchange Consortium via the PRIDE (Perez et al., 2019) partner repository, {n}.", True, "", "generated"),
    ("Imaging data was obtained from Sorel et al. [12] and is available on Zenodo ({n}).", True, "", "reused"),
    ("Raw spectra were deposited in the public proteomics repository MassIVE as {n}.", True, "", "generated"),
    ("The exome data generated in this study are publicly available in dbGaP under {n}.", True, "", "generated"),
    ("Datasets used in this study are publicly available and can be accessed through BioProject: {n}.", True, "", "unknown"),
    ("The codes used in this study are available in the repository {n}.", True, "", "generated"),
    ("The data that support the findings of this study are openly available in Dryad at {n}.", True, "", "generated"),
    ("Genotypes were provided by the Northern Cohort Consortium ({n}).", False, "", "reused"),
    ("We tested the score on existing data ({n}).", False, "", "reused"),
    ("The validation cohort is {n}.", False, "", "reused"),
    ("Reads have been deposited in GEO under {n} (last accessed 12 May 2024).", False, "", "generated"),
    ("Sequences will be deposited under {n}.", False, "", "none"),
    ("See {n}.", True, "Reads have been deposited.", "generated"),
    ("See {n}.", False, "Reads have been deposited.", "none"),
    ("See {n}.", False, "Data were downloaded from GEO.", "reused"),
    ("See {n}.", False, "", "none"),
]
_WORDING = f"CAST(FLOOR({K} / 4) AS BIGINT) % {len(WORDINGS)}"


@query("idx_role_wordings", f"""SELECT CAST({K} AS STRING) AS pmid, CASE {_WORDING} {" ".join(f"WHEN {i} THEN '{x[3]}'" for i, x in enumerate(WORDINGS))} END AS role FROM {{orders}}""")
def idx_role_wordings(d: Data) -> DataFrame:
    """Roles over a second set of sentences, of other wordings than the first."""
    of = F.get(F.array(*[F.struct(F.lit(x[0]).alias("text"), F.lit(x[1]).alias("das"), F.lit(x[2]).alias("previous")) for x in WORDINGS]), F.expr(_WORDING).cast("int"))
    rows = d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), F.concat(F.lit("GSE"), (100000 + F.col(K)).cast("string")).alias("n"), of.alias("s"))
    m = X.find_mentions(rows.select("pmid", F.replace("s.text", F.lit("{n}"), F.col("n")).alias("sentence"), "s.das", "s.previous")).where("repo = 'GEO'")
    return X.with_roles(m.withColumn("krt", F.lit(False))).select("pmid", "role")


@query("idx_strong_reuse", "SELECT CAST(o_orderkey AS STRING) AS pmid, CASE WHEN o_orderkey % 2 = 0 THEN 'generated' ELSE 'reused' END AS role FROM {orders}")
def idx_strong_reuse(d: Data) -> DataFrame:
    n = (100000 + F.col(K)).cast("string")
    text = F.when(F.col(K) % 2 == 0, F.concat(F.lit("Data can be accessed via GEO (GSE"), n, F.lit(")."))).otherwise(F.concat(F.lit("Data were accessed via GEO (GSE"), n, F.lit(").")))
    m = X.find_mentions(d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), text.alias("sentence")))
    return X.with_roles(m.withColumns({"krt": F.lit(False), "previous": F.lit(""), "das": F.lit(True)})).select("pmid", "role")


#: Cues and mentions of real texts: long capitalized words, and numbers.
_CUE, _NUMBER = "[A-Z][a-z]{7,}", "[0-9]+"


def _places(pattern: str, name: str) -> str:
    """SQL for (k, s, e) of a pattern's matches, by the lengths of what is between them."""
    return f"""{name}m AS (SELECT k, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d),
    {name} AS (SELECT k, CAST(list_sum(list_transform(gs[1:i], lambda x: length(x))) + COALESCE(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS INT) AS s, length(ms[i]) AS n FROM (SELECT k, ms, gs, UNNEST(range(1, len(ms) + 1)) AS i FROM {name}m) u)"""


@query("idx_nearest", f"""WITH d AS (SELECT doc_id AS k, COALESCE(text, '') AS t FROM {{documents}}), {_places(_CUE, "cue")}, {_places(_NUMBER, "num")}
    SELECT num.k AS doc_id, num.s AS at, CAST(MIN(CASE WHEN cue.s IS NOT NULL THEN GREATEST(cue.s - num.s, num.s - (cue.s + cue.n), 0) END) AS INT) AS distance FROM num LEFT JOIN cue ON num.k = cue.k GROUP BY num.k, num.s""")
def idx_nearest(d: Data) -> DataFrame:
    points = d.documents.select("doc_id", F.explode(X.spans_of("text", _NUMBER)).alias("p")).select("doc_id", F.col("p.start").alias("at"))
    spans = d.documents.select("doc_id", F.explode(X.spans_of("text", _CUE)).alias("s")).select("doc_id", "s.start", "s.end")
    return M.nearest_spans(points, spans, ["doc_id"])


@query("idx_prev_sentence", f"""SELECT doc_id, i - 1 AS sent_ord, length(ss[i]) AS letters, CASE WHEN i > 1 THEN length(ss[i - 1]) ELSE 0 END AS previous_letters FROM (SELECT doc_id, ss, UNNEST(range(1, len(ss) + 1)) AS i
    FROM (SELECT doc_id, list_filter(string_split({_CUT}, chr(1)), lambda x: regexp_matches(x, '\\S')) AS ss FROM {{documents}}) s) t""")
def idx_prev_sentence(d: Data) -> DataFrame:
    p = d.documents.select("doc_id", "text", F.lit("p").alias("kind"))
    rows = M.passage_sentences(p)
    return rows.select("doc_id", F.col("sent_ord").cast("long").alias("sent_ord"), F.length("sentence").cast("long").alias("letters"), F.length("previous").cast("long").alias("previous_letters"))


_COMBINE = """WITH s AS (SELECT pmid, CAST(pmid AS BIGINT) % 4 = 0 AS own_cue, CAST(pmid AS BIGINT) % 6 = 1 AS reuse_cue FROM {paper}),
    m AS (SELECT *, lower(id) AS k, location IN ('das', 'krt') AND role IN ('generated', 'reused') AS f FROM {mention}),
    g AS (SELECT pmid, repo, k, arg_min(id, ord) AS id, arg_min(cls, ord) AS cls, MIN(ord) AS ord, bool_or(f AND role = 'generated') AS g1, bool_or(f AND role = 'reused') AS r1, bool_or(role = 'generated') AS g, bool_or(role = 'reused') AS r, bool_or(role = 'unknown') AS u,
      arg_min(evidence, ord) FILTER (WHERE f AND role = 'generated') AS eg1, arg_min(evidence, ord) FILTER (WHERE f AND role = 'reused') AS er1, arg_min(evidence, ord) FILTER (WHERE role = 'generated') AS eg, arg_min(evidence, ord) FILTER (WHERE role = 'reused') AS er,
      arg_min(evidence, ord) FILTER (WHERE role = 'unknown') AS eu, bool_or(location = 'das') AS in_das, bool_or(this_row) AS this_row, bool_or(code_context) AS code_context, COUNT(*) AS n_mentions,
      arg_min(context, CASE location WHEN 'das' THEN 0 WHEN 'krt' THEN 1 WHEN 'body' THEN 2 ELSE 3 END * 1000 + ord) AS context FROM m GROUP BY pmid, repo, k),
    c AS (SELECT g.pmid, repo, id, cls, ord, in_das, context, n_mentions, cls = 'code' OR cls IN ('generic', 'url') AND code_context AS is_code,
      CASE WHEN g1 THEN 'generated' WHEN r1 THEN 'reused' WHEN g THEN 'generated' WHEN r THEN 'reused' WHEN u THEN 'unknown' WHEN in_das AND own_cue AND NOT reuse_cue THEN 'generated' WHEN in_das AND reuse_cue AND NOT own_cue THEN 'reused' WHEN in_das THEN 'unknown' WHEN this_row AND cls <> 'code' THEN 'generated' ELSE 'reused' END AS role,
      COALESCE(eg1, er1, eg, er, eu, CASE WHEN in_das THEN CASE WHEN own_cue <> reuse_cue THEN 'cue of the statement' ELSE 'statement without a usable cue' END END, CASE WHEN this_row AND cls <> 'code' THEN 'row names this study' WHEN cls = 'code' THEN 'code link: no cue' END, 'reused by default: no cue') AS evidence FROM g JOIN s ON g.pmid = s.pmid)"""


def combined(d: Data) -> DataFrame:
    k = F.col("pmid").cast("long")
    return M.combine(d.mention, d.paper.select("pmid", (k % 4 == 0).alias("own_cue"), (k % 6 == 1).alias("reuse_cue")))


@query("idx_combine", _COMBINE + " SELECT pmid, repo, id, cls, role, evidence, in_das, n_mentions FROM c")
def idx_combine(d: Data) -> DataFrame:
    return combined(d).select("pmid", "repo", "id", "cls", "role", "evidence", "in_das", "n_mentions")


def cited_articles(d: Data) -> DataFrame:
    """Papers whose statement, for each third, cites the reference with an accession and has two links."""
    k, n = F.col(K), (100000 + F.col(K)).cast("string")
    cites = F.when(k % 3 == 0, '<xref ref-type="bibr" rid="r2">2</xref>').otherwise("")
    xml = F.concat(
        F.lit("<article><body><sec><title>Methods</title><p>Reads of GSE"), n, F.lit(" were grown. Code is at https://github.com/orgs/lab there.</p></sec></body>"),
        F.lit("<back><notes notes-type=\"data-availability\"><p>Links "), cites, F.lit(" lead to https://Lab-X.example/Set"), n,
        F.lit(" and to https://orcid.org/0000.</p></notes><ref-list><ref id=\"r1\"><mixed-citation>Doe GSE1001</mixed-citation></ref><ref id=\"r2\"><mixed-citation>Roe PXD"), n, F.lit("</mixed-citation></ref></ref-list></back></article>"),
    )
    return d.spread("orders", K).select(k.cast("string").alias("pmid"), xml.alias("xml"))


@query("txt_cited_location", f"""SELECT CAST({K} AS STRING) AS pmid, ref_id, CASE WHEN ref_id = 'r2' AND {K} % 3 = 0 THEN 'das' ELSE 'ref' END AS location FROM {{orders}}, (VALUES ('r1'), ('r2')) t(ref_id)""")
def txt_cited_location(d: Data) -> DataFrame:
    return M.with_locations(X.parse_passages(cited_articles(d), ["pmid", "kind", "ref_id", "location"])).where("kind = 'ref'").select("pmid", "ref_id", "location")


@query("idx_of_papers", f"""SELECT CAST({K} AS STRING) AS pmid, repo, replace(id, '#', CAST(100000 + {K} AS STRING)) AS id, CASE WHEN repo LIKE 'PRIDE%' AND {K} % 3 = 0 THEN 'unknown' ELSE role END AS role, CASE WHEN repo LIKE 'PRIDE%' THEN {K} % 3 = 0 ELSE repo = 'Other link' END AS in_das
    FROM {{orders}}, (VALUES ('GEO', 'GSE#', 'reused'), ('GEO', 'GSE1001', 'reused'), ('PRIDE/ProteomeXchange', 'PXD#', 'reused'), ('Other link', 'https://lab-x.example/Set#', 'unknown')) t(repo, id, role)""")
def idx_of_papers(d: Data) -> DataFrame:
    return M.identifiers_of(cited_articles(d)).select("pmid", "repo", "id", "role", "in_das")


@query("idx_context", _COMBINE + " SELECT pmid, repo, id, context FROM c")
def idx_context(d: Data) -> DataFrame:
    return combined(d).select("pmid", "repo", "id", C.clip(F.col("context")).alias("context"))


@query("idx_is_code", _COMBINE + " SELECT pmid, repo, id, is_code FROM c")
def idx_is_code(d: Data) -> DataFrame:
    return combined(d).select("pmid", "repo", "id", "is_code")


@query("idx_cap", """SELECT repo, pmid, id, rank FROM (SELECT repo, pmid, id, CAST(ROW_NUMBER() OVER (PARTITION BY pmid, repo ORDER BY CASE role WHEN 'generated' THEN 0 WHEN 'unknown' THEN 1 ELSE 2 END, id) AS INT) AS rank FROM (SELECT 'p' || CAST(CAST(pmid AS BIGINT) % 40 AS STRING) AS pmid, repo, id, MIN(role) AS role FROM {ident} GROUP BY 1, 2, 3)) t WHERE rank <= 25""")
def idx_cap(d: Data) -> DataFrame:
    # forty papers with very many identifiers
    few = F.concat(F.lit("p"), (F.col("pmid").cast("long") % 40).cast("string"))
    wide = d.ident.groupBy(few.alias("pmid"), "repo", "id").agg(F.min("role").alias("role"))
    return M.cap(wide).select("repo", "pmid", "id", "rank")


def _redacted() -> str:
    out = "COALESCE(text, '')"
    for pattern, to in C.SECRETS:
        out = f"regexp_replace({out}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to.replace('$', chr(92))}', 'g')"
    return out


@query("idx_redact", f"SELECT doc_id, {_redacted()} AS text FROM {{documents}}")
def idx_redact(d: Data) -> DataFrame:
    return d.documents.select("doc_id", C.redact(F.col("text")).alias("text"))


@query("udx_rules", f"SELECT CAST({K} AS STRING) AS pmid, 'Lab store' AS repo, 'LS-' || CAST({K} AS STRING) AS raw FROM {{orders}}")
def udx_rules(d: Data) -> DataFrame:
    text = F.concat(F.lit("Kept as LS-"), F.col(K).cast("string"), F.lit("."))
    rules = [*IDENTIFIER_RULES, ("Lab store", "generic", r"\b(LS-\d+)\b")]
    return X.find_mentions(d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), text.alias("sentence")), rules).select("pmid", "repo", "raw")


@query("udx_cues", f"SELECT CAST({K} AS STRING) AS pmid, 'generated' AS role FROM {{orders}}")
def udx_cues(d: Data) -> DataFrame:
    from dataclasses import replace

    text = F.concat(F.lit("Brewed by us: GSE"), (100000 + F.col(K)).cast("string"), F.lit("."))
    m = X.find_mentions(d.spread("orders", K).select(F.col(K).cast("string").alias("pmid"), text.alias("sentence")))
    m = m.withColumns({"krt": F.lit(False), "previous": F.lit(""), "das": F.lit(False)})
    return X.with_roles(m, replace(CUES, own=r"\bbrewed by us\b")).select("pmid", "role")
