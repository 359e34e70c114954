"""Full texts are parsed once, with no more columns than are asked for, to the same rows as step by step."""

from grantlens import plans
from grantlens.functions import text as X
from grantlens.operators import mentions as M
from grantlens.operators.statements import says_reuse
from grantlens.rules import CUES
from pyspark.sql import functions as F

from test_oracle import SF

STATEMENT = '<sec sec-type="data-availability"><title>Data availability</title><p>{}</p></sec>'
REFS = '<ref-list><ref id="r1"><mixed-citation>Doe GSE1001</mixed-citation></ref><ref id="r2"><mixed-citation>Roe PXD000001</mixed-citation></ref></ref-list>'
TEXTS = [
    "Reads have been deposited in GEO. See GSE7777 and phs000123.v1.p1, https://x.example/Data1.",
    'As before <xref ref-type="bibr" rid="r2">2</xref>. Data were downloaded from GEO (GSE55).',
    "Links: https://orcid.org/0000 and https://github.com/Lab/Tool2. Data generated in this study are in PRIDE.",
    "",
]


def papers(spark):
    rows = [(str(i), "<article><body><sec><title>M</title><p>Code is at github.com/a/b1, SRR1234567.</p></sec></body><back>" + STATEMENT.format(x) + REFS + "</back></article>") for i, x in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, ("8", "<article><p>open"), ("9", None)], "pmid string, xml string")


def pythons(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(plan.count(x) for x in ("MapInArrow", "MapInPandas", "ArrowEvalPython"))


def test_identifiers_are_made_in_one_pass(spark):
    got = M.identifiers_of(papers(spark))
    passages = X.parse_passages(papers(spark)).drop("location")
    s = M.passage_sentences(M.with_locations(passages.where("das")).where("das and kind <> 'title'"))
    own = F.bool_or(F.col("sentence").rlike("(?i)" + CUES.own)).alias("own_cue")
    reuse = F.bool_or(says_reuse(F.col("sentence"), CUES)).alias("reuse_cue")
    want = M.combine(M.mentions_of(passages), s.groupBy("pmid").agg(own, reuse)).select(*got.columns)
    assert pythons(got) == 1
    rows = sorted(map(repr, got.collect()))
    assert len(rows) > 12 and rows == sorted(map(repr, want.collect()))


def test_locations_come_with_the_passages(spark):
    df = plans.QUERIES["txt_cited_location"](spark, SF)
    assert pythons(df) == 1 and "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_only_columns_that_are_asked_for_are_made(spark):
    made = X.parse_passages(papers(spark), ["pmid", "kind", "text"])
    assert made.columns == ["pmid", "kind", "text"]
    assert sorted(map(repr, made.collect())) == sorted(map(repr, X.parse_passages(papers(spark)).select("pmid", "kind", "text").collect()))
    plan = plans.QUERIES["txt_flatten"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "xrefs" not in plan and "chain" not in plan
