"""Availability statements of papers: text, headings, cues, named resources, snippets and evidence packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..rules import CUES, Cues

LONGEST = 4000


def has(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike("(?i)" + pattern), F.lit(False))


def statement_text(passages: DataFrame, sentences: DataFrame, cues: Cues = CUES) -> DataFrame:
    """(pmid, statement, statement_kind): the statement's passages in order, else sentences elsewhere that read like one.

    passages: pmid, passage_ord, kind, das, text; sentences: pmid, passage_ord, sent_ord, sec, text, of passages outside
    the statement. At most 4000 characters; kind is section, inline or none.
    """
    join = lambda rows: F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda x: x["text"]), " ")
    section = passages.where(F.col("das") & (F.col("kind") != "title")).groupBy("pmid").agg(join(F.struct("passage_ord", "text")).alias("_section"))
    t = F.col("text")
    asks = has(t, cues.on_request) & has(t, cues.data_word) & ~has(t, cues.materials_only)
    gives = has(t, cues.own) & (has(t, cues.repository) | has(t, r"https?://|www\.")) & has(t, cues.data_word)
    inline = sentences.where((asks | gives) & ~F.lower(F.coalesce("sec", F.lit(""))).contains("abstract"))
    inline = inline.groupBy("pmid").agg(join(F.struct("passage_ord", "sent_ord", "text")).alias("_inline"))
    j = passages.select("pmid").distinct().join(section, "pmid", "left").join(inline, "pmid", "left")
    kind = F.when(F.col("_section").isNotNull(), "section").when(F.col("_inline").isNotNull(), "inline").otherwise("none")
    text = F.substring(F.coalesce("_section", "_inline", F.lit("")), 1, LONGEST)
    return j.select("pmid", text.alias("statement"), kind.alias("statement_kind"))


def says_reuse(text: Column, cues: Cues = CUES) -> Column:
    """Whether a sentence says where data came from; how a reader gets them, or who described a repository, is left out."""
    left = F.regexp_replace(F.regexp_replace(text, "(?i)(?:" + cues.offered + ")", " "), "(?i)(?:" + cues.cites_repository + ")", " ")
    return has(left, cues.strong_reuse) | has(text, cues.resource)


LINK = r"(?:https?://|www\.)\S"


def paper_cues(sentences: DataFrame, cues: Cues = CUES) -> DataFrame:
    """Nine cues of each paper from its statement's sentences (pmid, text, section).

    section: whether a sentence stands in a statement of its own, not elsewhere in the text; without the column all do.
    Requests for materials are none for data; what an article has itself, and that there are no data, is read in
    statements only; data under controlled access are own if the sentence says so, or is a statement's and names no
    source; code is shared by an own cue or a link.
    """
    t = F.col("text")
    section = F.coalesce("section", F.lit(False)) if "section" in sentences.columns else F.lit(True)
    own, reuse = has(t, cues.own), says_reuse(t, cues)
    flags = {
        "on_request": has(t, cues.on_request) & has(t, cues.data_word) & ~has(t, cues.materials_only),
        "in_article": section & has(t, cues.in_article) & ~has(t, cues.negated),
        "no_data": section & has(t, cues.no_data),
        "will_deposit": has(t, cues.will_deposit),
        "controlled_gen": has(t, cues.controlled) & (own | (section & ~reuse)),
        "reuse_in_statement": reuse,
        "gen_in_statement": own,
        "code_in_statement": has(t, cues.code_word) & (own | has(t, LINK)),
        "privacy_restriction": has(t, cues.privacy),
    }
    return sentences.groupBy("pmid").agg(*[F.bool_or(v).alias(k) for k, v in flags.items()])


def statement_headings(passages: DataFrame, most: int = 5) -> DataFrame:
    """(pmid, headings): the nearest headings of a statement's passages, each once, in order, the first few."""
    near = F.get("chain", F.lit(0))
    rows = passages.where(F.col("das") & (F.col("kind") != "title")).select("pmid", near.alias("heading")).where("heading <> ''").distinct()
    n = F.row_number().over(Window.partitionBy("pmid").orderBy("heading"))
    few = rows.withColumn("_n", n).where(F.col("_n") <= most)
    return few.groupBy("pmid").agg(F.array_sort(F.collect_list("heading")).alias("headings"))


def reuse_resources(statements: DataFrame, cues: Cues = CUES) -> DataFrame:
    """(pmid, resources): named public resources of a statement, distinct, in order, the first ten."""
    found = F.regexp_extract_all("statement", F.lit("(" + cues.resource + ")"), F.lit(1))
    return statements.select("pmid", F.slice(F.array_sort(F.array_distinct(found)), 1, 10).alias("resources"))


def snippet(sentences: DataFrame, limit: int = 300) -> DataFrame:
    """(pmid, snippet): telling sentences (pmid, ord, text) in order while their length, with a space each, fits."""
    w = Window.partitionBy("pmid").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    kept = sentences.withColumn("_before", F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0))).where(F.col("_before") < limit)
    rows = F.array_sort(F.collect_list(F.struct("ord", "text")))
    return kept.groupBy("pmid").agg(F.array_join(F.transform(rows, lambda x: x["text"]), " ").alias("snippet"))


def evidence_packet(passages: DataFrame, keywords: str, focus: str = "focus", limit: int = 14000) -> DataFrame:
    """Passages (pmid, ord, das, text, `focus`) for a reviewer: those with a keyword or the focus, each text once, the
    focus first, then the statement, then the rest, up to `limit` characters; returned with their order."""
    hit = F.coalesce(F.col("text").contains(F.col(focus)), F.lit(False))
    rows = passages.where(hit | has(F.col("text"), keywords))
    once = rows.withColumn("_n", F.row_number().over(Window.partitionBy("pmid", "text").orderBy("ord"))).where("_n = 1")
    ranked = once.withColumn("rank", F.when(hit, 0).when(F.col("das"), 1).otherwise(2))
    w = Window.partitionBy("pmid").orderBy("rank", "ord").rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("used", F.sum(F.length("text")).over(w)).where(F.col("used") <= limit).drop("_n")


def sentences_with(sentences: DataFrame, identifiers: DataFrame, most: int = 4) -> DataFrame:
    """(pmid, id, ord, text): the first distinct sentences that hold the identifier or its last path segment (6 letters or more)."""
    last = F.element_at(F.split("id", "/"), -1)
    j = sentences.join(identifiers.select("pmid", "id").distinct(), "pmid")
    j = j.where(F.col("text").contains(F.col("id")) | ((F.length(last) >= 6) & F.col("text").contains(last)))
    once = j.groupBy("pmid", "id", "text").agg(F.min("ord").alias("ord"))
    n = F.row_number().over(Window.partitionBy("pmid", "id").orderBy("ord", "text"))
    return once.withColumn("_n", n).where(F.col("_n") <= most).drop("_n")
