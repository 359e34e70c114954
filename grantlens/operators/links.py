"""Statuses of links and the parsing of landed repository records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import full_date, month_date, norm_doi
from ..functions.text import people
from ..rules import STATUS_RULES, StatusRule

AWARD_NUMBER = r"\b([A-Z]\d{2}[ -]?[A-Z]{2}[ -]?\d{6})\b"


def url_status(head: Column, get: Column, unknown_host: Column) -> Column:
    """The status of a link from its HEAD and GET codes; GET answers where HEAD gave none or one of a few codes."""
    again = head.isNull() | head.isin(400, 403, 404, 405, 501)
    code = F.when(again, F.coalesce(get, head)).otherwise(head)
    return (
        F.when(F.coalesce(unknown_host, F.lit(False)), "NOT_FOUND")
        .when(code.between(200, 399), "RESOLVES")
        .when(code.isin(404, 410), "NOT_FOUND")
        .otherwise("UNVERIFIED")
    )


def doi_status(code: Column, text: Column) -> Column:
    """The status of a DOI from the handle server's answer."""
    said = F.get_json_object(text, "$.responseCode").try_cast("int")
    down = code.isNull() | (code >= 500) | said.isNull()
    return F.when(down, "SKIPPED_API_DOWN").when(said == 1, "RESOLVES").when(said.isin(100, 200), "NOT_FOUND").otherwise("UNVERIFIED")


def api_status(repo: Column, ident: Column, code: Column, text: Column, rules: list[StatusRule] = STATUS_RULES) -> Column:
    """The status of a record from its repository's answer, by the rule table; other repositories need a 2xx code."""
    body, ok = F.coalesce(text, F.lit("")), code.between(200, 299)
    found, private, missing = ok, F.lit(False), code.isin(404, 410)
    for rule in reversed(rules):
        fits = (repo == rule.repo) & ident.startswith(rule.prefix)
        hit = ok
        if rule.found:
            hit = ok & (body.contains(ident) if rule.found == "{id}" else body.rlike(rule.found))
        hidden = code.isin(*rule.locked) if rule.locked else F.lit(False)
        if rule.private:
            hidden = hidden | (body.rlike(rule.private) & ~body.contains("assigned to a repository"))
        found = F.when(fits, hit).otherwise(found)
        private = F.when(fits, hidden).otherwise(private)
        missing = F.when(fits, code.isin(*rule.not_found)).otherwise(missing)
    return (
        F.when(code.isNull() | (code >= 500), "SKIPPED_API_DOWN")
        .when(private, "PRIVATE")
        .when(found, "RESOLVES")
        .when(missing | code.isin(200, 400), "NOT_FOUND")
        .when(code.isin(401, 403), "RESTRICTED")
        .otherwise("UNVERIFIED")
    )


def with_fallback(first: Column, second: Column) -> Column:
    """A second answer decides where the first says that there is no such record."""
    return F.when((first == "NOT_FOUND") & second.isNotNull(), second).otherwise(first)


def geo_record(text: Column) -> dict[str, Column]:
    """Fields of a series record in its text form."""
    every = lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(1))
    return {
        "record_date": month_date(F.regexp_extract(text, r"(?m)^!Series_status = Public on (.+)$", 1)),
        "pmids": F.array_sort(F.array_distinct(every(r"(?m)^!Series_pubmed_id = (\d+)"))),
        "contributors": F.array_distinct(every(r"(?m)^!Series_contributor = (.+)$")),
        "superseries": every(r"(?m)^!Series_relation = SubSeries of: (GSE\d+)"),
    }


PDB_ENTRY = """struct<rcsb_accession_info:struct<initial_release_date:string>,
    rcsb_primary_citation:struct<pdbx_database_id_PubMed:string,pdbx_database_id_DOI:string,rcsb_authors:array<string>>,
    audit_author:array<struct<name:string>>,pdbx_audit_support:array<struct<grant_number:string>>>"""
EMDB_ENTRY = """struct<admin:struct<key_dates:struct<header_release:string>,authors_list:struct<author:array<struct<valueOf_:string>>>,grant_support:struct<grant_reference:array<struct<code:string>>>>,
    crossreferences:struct<citation_list:struct<primary_citation:struct<citation_type:struct<external_references:array<struct<type_:string,valueOf_:string>>,author:array<struct<valueOf_:string>>>>>>>"""


def or_none(items: Column) -> Column:
    """A list of texts, without its nulls; none is an empty one."""
    return F.array_compact(F.coalesce(items, F.array().cast("array<string>")))


def structure_record(repo: Column, text: Column) -> dict[str, Column]:
    """Fields of the JSON answers about structures: repo PDB, or EMDB, whose citation lists its numbers by type.

    people are distinct keys of the citation's and the entry's authors; pubs_complete says that a paper is named.
    """
    p, e = F.from_json(text, PDB_ENTRY), F.from_json(text, EMDB_ENTRY)
    pdb, cite = repo == "PDB", p["rcsb_primary_citation"]
    admin, other = e["admin"], e["crossreferences"]["citation_list"]["primary_citation"]["citation_type"]
    of_type = lambda t: or_none(F.transform(F.filter(other["external_references"], lambda x: x["type_"] == t), lambda x: x["valueOf_"]))
    pmids = F.when(pdb, or_none(F.array(cite["pdbx_database_id_PubMed"]))).otherwise(of_type("PUBMED"))
    dois = F.when(pdb, or_none(F.array(cite["pdbx_database_id_DOI"]))).otherwise(of_type("DOI"))
    written = F.concat(or_none(cite["rcsb_authors"]), or_none(F.transform(p["audit_author"], lambda x: x["name"])))
    short = F.concat(or_none(F.transform(other["author"], lambda x: x["valueOf_"])), or_none(F.transform(admin["authors_list"]["author"], lambda x: x["valueOf_"])))
    codes = F.when(pdb, or_none(F.transform(p["pdbx_audit_support"], lambda x: x["grant_number"]))).otherwise(or_none(F.transform(admin["grant_support"]["grant_reference"], lambda x: x["code"])))
    return {
        "record_date": F.when(pdb, full_date(p["rcsb_accession_info"]["initial_release_date"])).otherwise(full_date(admin["key_dates"]["header_release"])),
        "pmids": pmids, "dois": F.transform(dois, norm_doi), "people": F.when(pdb, people(written)).otherwise(people(short, "last_initials")),
        "grants": grants_in(F.array_join(codes, " ; ")), "pubs_complete": F.size(pmids) > 0,
    }


def proteomics_record(text: Column) -> dict[str, Column]:
    """Publications and contacts of a proteomics JSON record: lists of named terms."""
    r = F.from_json(text, "struct<publications:array<struct<terms:array<struct<name:string,value:string>>>>,contacts:array<struct<terms:array<struct<name:string,value:string>>>>>")
    terms = lambda part: F.coalesce(F.flatten(F.transform(r[part], lambda x: x["terms"])), F.array().cast("array<struct<name:string,value:string>>"))
    named = lambda part, name: F.transform(F.filter(terms(part), lambda t: t["name"] == name), lambda t: t["value"])
    return {
        "pmids": F.array_sort(F.array_distinct(named("publications", "PubMed identifier"))),
        "dois": F.array_distinct(F.transform(named("publications", "Digital Object Identifier (DOI)"), norm_doi)),
        "contacts": named("contacts", "contact name"),
    }


DOI_ANSWER = """struct<data:struct<attributes:struct<created:string,dates:array<struct<date:string,dateType:string>>,creators:array<struct<name:string,familyName:string,givenName:string>>,
    relatedIdentifiers:array<struct<relatedIdentifier:string,relatedIdentifierType:string>>,fundingReferences:array<struct<awardNumber:string>>>>>"""


def record_doi(repo: Column, ident: Column) -> Column:
    """The DOI that an identifier's record is kept under; null if it has none."""
    return F.when(repo == "Synapse", F.concat(F.lit("10.7303/"), ident)).when(F.lower(ident).startswith("10."), ident)


def doi_answers(identifiers: DataFrame, answers: DataFrame) -> DataFrame:
    """identifiers (repo, id) with the text of the answer about their DOI (answers: doi, text); null where there is none.

    Where a versioned DOI of Mendeley Data has no answer, the one about the DOI without its version counts.
    """
    asked = identifiers.withColumn("_doi", record_doi(F.col("repo"), F.col("id")))
    bare = F.when((F.col("repo") == "Mendeley Data") & F.col("_doi").rlike(r"\.\d+$"), F.regexp_replace("_doi", r"\.\d+$", ""))
    first = answers.where("text IS NOT NULL").groupBy("doi").agg(F.min("text").alias("text"))
    j = asked.withColumn("_bare", bare).join(first.select(F.col("doi").alias("_doi"), F.col("text").alias("_text")), "_doi", "left")
    j = j.join(first.select(F.col("doi").alias("_bare"), F.col("text").alias("_second")), "_bare", "left")
    return j.withColumn("text", F.coalesce("_text", "_second")).drop("_doi", "_bare", "_text", "_second")


def doi_record(text: Column) -> dict[str, Column]:
    """Fields of the JSON answer about a DOI.

    The date is the earliest full one of issue, creation and availability. Creators with a family and a given name are
    people; one that is free text leaves people incomplete. Related DOIs and papers also name versions and code.
    """
    r = F.from_json(text, DOI_ANSWER)["data"]["attributes"]
    dated = F.filter(r["dates"], lambda x: x["dateType"].isin("Issued", "Created", "Available"))
    days = F.concat(F.coalesce(F.transform(dated, lambda x: full_date(x["date"])), F.array().cast("array<date>")), F.array(full_date(r["created"])))
    kind = lambda k: or_none(F.transform(F.filter(r["relatedIdentifiers"], lambda x: x["relatedIdentifierType"] == k), lambda x: x["relatedIdentifier"]))
    whole = lambda x: (F.coalesce(x["familyName"], F.lit("")) != "") & (F.coalesce(x["givenName"], F.lit("")) != "")
    names = F.transform(r["creators"], lambda x: F.when(whole(x), F.concat_ws(", ", x["familyName"], x["givenName"])).otherwise(x["name"]))
    return {
        "record_date": F.array_min(F.array_compact(days)), "dois": F.array_distinct(F.transform(kind("DOI"), norm_doi)),
        "pmids": F.array_distinct(F.transform(kind("PMID"), lambda x: F.regexp_replace(x, r"\D", ""))), "people": people(or_none(names)),
        "grants": grants_in(F.array_join(or_none(F.transform(r["fundingReferences"], lambda x: x["awardNumber"])), " ; ")),
        "people_complete": F.coalesce(F.forall(r["creators"], whole), F.lit(True)),
    }


def grants_in(text: Column) -> Column:
    """Award numbers in a text, without spaces and hyphens."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(AWARD_NUMBER), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, r"[\s-]", ""))))


def with_mirror(projects: DataFrame, links: DataFrame, series: DataFrame) -> DataFrame:
    """projects (id, record_date, pmids, hits) with the records of series (id, record_date, pmids) that mirror them.

    links: id, uid; a uid between 200 and 300 million stands for a series. A search with other than one hit is no record.
    """
    inside = (F.col("uid") > 200000000) & (F.col("uid") < 300000000)
    gse = links.where(inside).select("id", F.concat(F.lit("GSE"), (F.col("uid") - 200000000).cast("string")).alias("series_id"))
    more = gse.join(series.select(F.col("id").alias("series_id"), F.col("record_date").alias("_d"), F.col("pmids").alias("_p")), "series_id")
    more = more.groupBy("id").agg(F.min("_d").alias("_d"), F.array_distinct(F.flatten(F.collect_list("_p"))).alias("_p"))
    j = projects.where("hits = 1").join(more, "id", "left")
    pmids = F.array_sort(F.array_union("pmids", F.coalesce("_p", F.array().cast("array<string>"))))
    return j.select("id", F.least("record_date", "_d").alias("record_date"), pmids.alias("pmids"))
