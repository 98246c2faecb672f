"""Snapshots of bibliographic services: JSON messages as item rows. Nothing is fetched; messages are read from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Work types of the registry and the library's item types.
ITEM_TYPES = {
    "journal-article": "journalArticle", "proceedings-article": "conferencePaper", "book": "book", "monograph": "book", "edited-book": "book", "reference-book": "book",
    "book-chapter": "bookSection", "book-section": "bookSection", "dissertation": "thesis", "report": "report", "posted-content": "preprint", "dataset": "dataset", "standard": "report",
}
MESSAGE = (
    "type string, title array<string>, `container-title` array<string>, DOI string, URL string, volume string, issue string, page string, ISSN array<string>, publisher string, "
    "abstract string, published struct<`date-parts`: array<array<int>>>, author array<struct<given: string, family: string, name: string, sequence: string>>"
)


def date_of_parts(parts: Column) -> Column:
    return F.array_join(F.transform(F.get(parts, F.lit(0)), lambda x: x.cast("string")), "-")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).json(path)


def as_items(messages: DataFrame) -> DataFrame:
    types = F.create_map(*[F.lit(x) for pair in ITEM_TYPES.items() for x in pair])
    names = F.transform("author", lambda a: F.coalesce(a["name"], F.concat_ws(", ", a["family"], a["given"])))
    plain = F.trim(F.regexp_replace(F.regexp_replace("abstract", r"<[^>]+>", ""), r"\s+", " "))
    return messages.select(
        F.coalesce(F.try_element_at(types, "type"), F.lit("document")).alias("item_type"), F.get("title", F.lit(0)).alias("title"), F.get("container-title", F.lit(0)).alias("publication"),
        F.col("DOI").alias("doi"), F.col("URL").alias("url"), "volume", "issue", F.col("page").alias("pages"), F.get("ISSN", F.lit(0)).alias("issn"), "publisher", plain.alias("abstract"),
        date_of_parts(F.col("published.date-parts")).alias("date"), F.array_join(names, "; ").alias("creators"),
    )
