"""Numbered paragraphs of Markdown texts by section, and the writing entries derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import features, text

# Headings, sections of references, lines that are no prose, captions.
HEADING = r"^(#{1,6})\s+(.+?)\s*$"
REFERENCES = r"(?i)^(references|bibliography|acknowledg(?:e)?ments?)$"
SKIPPED = r"^\s*(?:\||```|<!--)"


def paragraphs(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, section, paragraph, text): paragraphs, numbered anew in each section. Blank lines and headings end one; tables, fences and comments are
    left out; so are sections of references and what comes before the first heading."""
    # an outer explode, since a filter inferred from an inner one would repeat body and split
    lines = docs.select(key, F.posexplode_outer(F.split(F.col(body), r"\r\n|\r|\n")).alias("line", "text")).where("line IS NOT NULL")
    heading = F.col("text").rlike(HEADING)
    blank = F.trim(F.regexp_replace("text", r"(?U)^\s+|\s+$", "")) == ""
    ordered = Window.partitionBy(key).orderBy("line")
    marked = lines.withColumns({"heading": heading, "ends": heading | blank, "skipped": F.col("text").rlike(SKIPPED)})
    marked = marked.withColumns({"section_no": F.sum(F.col("heading").cast("int")).over(ordered), "part": F.sum(F.col("ends").cast("int")).over(ordered)})
    title = F.when(F.col("heading"), F.trim(F.regexp_extract("text", HEADING, 2)))
    marked = marked.withColumn("section", F.last(title, ignorenulls=True).over(ordered))
    prose = marked.where(~F.col("ends") & ~F.col("skipped") & (F.col("section_no") > 0) & ~F.col("section").rlike(REFERENCES))
    said = F.transform(F.array_sort(F.collect_list(F.struct("line", F.regexp_replace("text", r"(?U)^\s+|\s+$", "").alias("t")))), lambda x: x["t"])
    joined = prose.groupBy(key, "section_no", "section", "part").agg(F.array_join(said, " ").alias("text"))
    number = F.row_number().over(Window.partitionBy(key, "section_no").orderBy("part"))
    return joined.select(key, "section_no", "section", number.alias("paragraph"), "text")


def writing_entries(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, section_no, paragraph, family, function, quality, roles, transitions, fingerprint) of paragraphs that are written for a known purpose:
    captions and short ones go, functions, roles and features follow from rules, and of equal texts of a document the last stays."""
    # explodes of one element, so that each rule's many uses of a value don't compute it anew, and the generated code stays within what compiles
    once = lambda c: F.explode_outer(F.array(c))
    own = paragraphs(docs, key, body).select(key, "section_no", "paragraph", once(F.struct(text.section_family(F.col("section")).alias("family"), text.collapsed(F.col("text")).alias("v"))).alias("o")).select(key, "section_no", "paragraph", "o.*")
    kept = own.where(~text.excluded_material(F.col("v"))).select("*", once(text.rhetorical_function(F.col("v"), F.col("family"))).alias("function")).where("function IS NOT NULL")
    kept = kept.withColumns({"fingerprint": F.sha2(F.col("v").cast("binary"), 256), "roles": text.sentence_roles(F.col("v"))})
    last = Window.partitionBy(key, "fingerprint").orderBy(F.desc("section_no"), F.desc("paragraph"))
    kept = kept.withColumn("nth", F.row_number().over(last)).where("nth = 1")
    return kept.select(key, "section_no", "paragraph", "family", "function", F.round(text.rule_quality(F.col("v")), 6).alias("quality"), F.array_join("roles", ",").alias("roles"), F.array_join(text.transitions(F.col("roles")), ",").alias("transitions"), features.writing_pattern(F.col("function"))["pattern"].alias("pattern"), "fingerprint")
