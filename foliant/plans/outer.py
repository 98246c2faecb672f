"""Sources and functions around the library: each query makes files of the table's rows, on the executors, and reads them back."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as X
from foliant.functions.geometry import position
from foliant.operators import fuzzy, library
from foliant.operators.library import items, once
from foliant.plans.registry import live_sql, once_sql, query
from foliant.session import table
from foliant.sources import export, files, messages, sqlite

BLANKS = r"[\s\x{00A0}\x{3000}\x{2000}-\x{200A}\x{2028}\x{2029}]+"
ONE_LINE_SQL = f"(SELECT item_id, title, abstract FROM (SELECT item_id, trim(regexp_replace(title, '{BLANKS}', ' ', 'g')) AS title, trim(regexp_replace(abstract, '{BLANKS}', ' ', 'g')) AS abstract FROM {live_sql('title', 'abstract')}) WHERE title <> '' AND abstract <> '')"
#: What a PDF without fonts of its own can hold.
PLAIN_SQL = f"(SELECT * FROM {ONE_LINE_SQL} WHERE regexp_full_match(title, '[ -~]+') AND regexp_full_match(abstract, '[ -~]+'))"


def _one_line(spark, d) -> DataFrame:
    """Items with a title and an abstract, each on one line."""
    flat = lambda c: F.trim(F.regexp_replace(c, BLANKS, " ")).alias(c)
    return items(spark, d, "title", "abstract").select("item_id", flat("title"), flat("abstract")).filter("title <> '' and abstract <> ''")


def _plain(spark, d) -> DataFrame:
    return _one_line(spark, d).filter(F.col("title").rlike("^[ -~]+$") & F.col("abstract").rlike("^[ -~]+$"))


def _made(df: DataFrame, make: Callable[..., bytes], suffix: str, *columns: str) -> DataFrame:
    """(path, content): a file of each row; the path is the item_id with the suffix."""

    @F.pandas_udf(T.BinaryType())
    def content(*values: pd.Series) -> pd.Series:
        return pd.Series([make(*row) for row in zip(*values)], dtype=object)

    return df.select(F.concat(F.col("item_id").cast("string"), F.lit(suffix)).alias("path"), content(*columns).alias("content"))


def _item_id() -> Column:
    return F.split_part("path", F.lit("."), F.lit(1)).cast("long").alias("item_id")


@query("src6_database_rows", f"SELECT item_id, title, abstract FROM {ONE_LINE_SQL}")
def src6(spark, d):
    dbs = _made(_one_line(spark, d), lambda i, t, a: export.sqlite_bytes("items", "item_id INTEGER, title TEXT, abstract TEXT", [(int(i), t, a)]), ".sqlite", "item_id", "title", "abstract")
    return sqlite.rows_of(dbs, "items", "item_id long, title string, abstract string").drop("path")


@query("src12_pdf_texts", f"SELECT item_id, title || chr(10) || abstract AS text FROM {PLAIN_SQL}")
def src12(spark, d):
    pdfs = _made(_plain(spark, d), lambda t, a: export.pdf_bytes([t, a, "A third page"]), ".pdf", "title", "abstract")
    return files.parsed(pdfs, lambda path, content: [(files.extract(path, content, most_pages=2),)], "text string").select(_item_id(), "text")


@query("src19_markdown", f"SELECT item_id, '# ' || title || chr(10) || abstract AS markdown FROM {ONE_LINE_SQL}")
def src19(spark, d):
    pages = _made(_one_line(spark, d), lambda t, a: export.html_page(t, [a]).encode(), ".html", "title", "abstract")
    return files.parsed(pages, lambda path, content: [(files.markdown(path, content),)], "markdown string").select(_item_id(), "markdown")


@query("src20_pdf_outlines", f"SELECT item_id, 0 AS no, 1 AS level, title, 1 AS page FROM {PLAIN_SQL} UNION ALL SELECT item_id, 1, 2, 'Abstract', 2 FROM {PLAIN_SQL} UNION ALL SELECT item_id, 2, 1, 'End', 2 FROM {PLAIN_SQL}")
def src20(spark, d):
    pdfs = _made(_plain(spark, d), lambda t, a: export.pdf_bytes([t, a], [(1, t, 1), (2, "Abstract", 2), (1, "End", 2)]), ".pdf", "title", "abstract")
    return files.outlines_of(pdfs).select(_item_id(), "no", "level", "title", "page")


MARKS_SQL = """(SELECT item_id, annotation_comment AS comment, CAST(json_extract(annotation_position, '$.pageIndex') AS INTEGER) AS page_index, CAST(json_extract(annotation_position, '$.rects[0]') AS DOUBLE[]) AS rect
    FROM (SELECT DISTINCT item_id, annotation_comment, annotation_position FROM item_annotations) WHERE regexp_full_match(annotation_comment, '[ -~]+'))"""


@query("src21_pdf_annotations", f"SELECT item_id, page_index, 'highlight' AS kind, comment, rect FROM {MARKS_SQL} WHERE rect IS NOT NULL AND page_index IS NOT NULL")
def src21(spark, d):
    pos = position(F.col("annotation_position"))
    own = once(spark, d, "item_annotations", "item_id", "annotation_comment", "annotation_position").filter(F.col("annotation_comment").rlike("^[ -~]+$"))
    own = own.select("item_id", "annotation_comment", pos["pageIndex"].alias("page"), F.get(pos["rects"], F.lit(0)).alias("rect")).filter("rect is not null and page is not null")
    pdfs = _made(own, lambda c, n, r: export.pdf_bytes(["page"] * (int(n) + 1), (), [(int(n), "highlight", c, [float(x) for x in r])]), ".pdf", "annotation_comment", "page", "rect")
    return files.annotations_of(pdfs).select(_item_id(), "page_index", "kind", "comment", "rect")


@query("src22_epub_chapters", f"SELECT item_id, 0 AS chapter, title AS text FROM {ONE_LINE_SQL} UNION ALL SELECT item_id, 1, abstract FROM {ONE_LINE_SQL}")
def src22(spark, d):
    books = _made(_one_line(spark, d), lambda t, a: export.epub_bytes([export.html_page(t, []), f"<html><body><p>{export.escape(a)}</p></body></html>"]), ".epub", "title", "abstract")
    return files.chapters_of(books).select(_item_id(), "chapter", "text")


@query("src23_registry_messages", f"SELECT title, doi, 'journalArticle' AS item_type FROM (SELECT title, doi FROM {live_sql('title', 'doi', 'item_type')} WHERE title IS NOT NULL AND item_type = 'journalArticle')")
def src23(spark, d):
    """Messages as the services send them, made of the articles; read by the same schema as files of them."""
    own = items(spark, d, "title", "doi", "item_type").filter("title is not null and item_type = 'journalArticle'")
    sent = own.select(F.to_json(F.struct(F.lit("journal-article").alias("type"), F.array("title").alias("title"), F.col("doi").alias("DOI"))).alias("m"))
    return messages.as_items(sent.select(F.from_json("m", messages.MESSAGE).alias("m")).select("m.*")).select("title", "doi", "item_type")


# ------------------------------------------------------------------------------------- places in books


@query("m11_ranges_in_html", f"SELECT item_id, 'epubcfi(/6/2!/2/2/4,/1:0,/1:' || length(abstract) || ')' AS cfi FROM {ONE_LINE_SQL} WHERE length(abstract) > length(title)")
def m11(spark, d):
    own = _one_line(spark, d).filter(F.length("abstract") > F.length("title"))

    @F.pandas_udf(T.StringType())
    def cfi(titles: pd.Series, abstracts: pd.Series) -> pd.Series:
        found = [files.locate(export.html_page(t, [a]), a) for t, a in zip(titles, abstracts)]
        return pd.Series([files.cfi_range(*f) if f else None for f in found], dtype=object)

    return own.select("item_id", cfi("title", "abstract").alias("cfi"))


@query("m12_text_nodes", f"SELECT item_id, [2, 2, 2, 1] AS steps, title AS text FROM {ONE_LINE_SQL} UNION ALL SELECT item_id, [2, 2, 4, 1], abstract FROM {ONE_LINE_SQL}")
def m12(spark, d):
    pages = _made(_one_line(spark, d), lambda t, a: export.html_page(t, [a]).encode(), ".html", "title", "abstract")
    return files.parsed(pages, lambda _, content: [(list(steps), t) for t, steps in files.text_nodes(content.decode())], "steps array<int>, text string").select(_item_id(), "steps", "text")


@query(
    "m13_places_in_books",
    f"""SELECT item_id, 2 AS chapter, 'book/part 1.xhtml' AS name, 'epubcfi(/6/4!/2/2/2,/1:0,/1:' || length(abstract) || ')' AS value FROM {ONE_LINE_SQL}""",
)
def m13(spark, d):
    """The abstract, without its blanks, found in a book whose second chapter holds it; the whole book is searched."""
    books = _made(_one_line(spark, d), lambda t, a: export.epub_bytes([export.html_page("Cover", []), f"<html><body><p>{export.escape(a)}</p></body></html>"]) + b"\0" + a.encode(), ".epub", "title", "abstract")

    def place(_, content: bytes) -> list[tuple]:
        book, _, wanted = content.rpartition(b"\0")
        found = files.find_in_book(book, wanted.decode().replace(" ", ""), chapter=1)
        return [(found[0], found[1], json.loads(found[2])["value"])] if found else []

    return files.parsed(books, place, "chapter int, name string, value string").select(_item_id(), "chapter", "name", "value")


@query("m7_quotations_on_pages", None)
def m7(spark, d):
    """Annotations sought on the page they name, then up to two pages either way: by anchors, exactly, by ratio."""
    hops = once(spark, d, "item_attachments", "item_id", "parent_item_id").select(F.col("item_id").alias("_a"), F.col("parent_item_id").alias("work_id"))
    marks = once(spark, d, "item_annotations", "item_id", "parent_item_id", "annotation_text", "annotation_position").filter("length(annotation_text) > 0")
    marks = marks.join(hops, F.col("parent_item_id") == F.col("_a")).select("item_id", "work_id", (position(F.col("annotation_position"))["pageIndex"]).alias("page"), X.match_text(F.col("annotation_text")).alias("p"))
    texts = items(spark, d, "fulltext").filter("length(fulltext) > 0").select(F.col("item_id").alias("work_id"), "fulltext")
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length("fulltext") - 1) / 1800).cast("int")), lambda n: F.substring("fulltext", n * 1800 + 1, F.lit(1800)))
    pages = texts.select("work_id", F.posexplode(cut).alias("page", "t")).withColumn("t", X.match_text(F.col("t")))
    return fuzzy.on_pages(marks, pages).select("item_id", "work_id", "page", "way", "start_at", "end_at", F.round("score", 6).alias("score"))


# --------------------------------------------------------------------------------------- citation data

TALLIES_SQL = f"""(SELECT lower(i.doi) AS doi_key, count(DISTINCT CASE WHEN m.annotation_type = 'highlight' THEN m.item_id END) AS supporting, count(DISTINCT CASE WHEN m.annotation_type = 'note' THEN m.item_id END) AS contrasting, count(DISTINCT m.item_id) AS mentioning
    FROM {live_sql('doi')} i JOIN {once_sql('item_attachments', 'item_id', 'parent_item_id')} a ON a.parent_item_id = i.item_id JOIN {once_sql('item_annotations', 'item_id', 'parent_item_id', 'annotation_type')} m ON m.parent_item_id = a.item_id
    WHERE regexp_full_match(i.doi, '10\\.[0-9]{{4,9}}/\\S*[^.,);\\]\\s]') GROUP BY ALL)"""
PAPERS_SQL = f"""(SELECT lower(i.doi) AS doi_key, count(DISTINCT n.item_id) AS n_notices FROM {live_sql('doi')} i JOIN {once_sql('item_notes', 'item_id', 'parent_item_id')} n ON n.parent_item_id = i.item_id WHERE regexp_full_match(i.doi, '10\\.[0-9]{{4,9}}/\\S*[^.,);\\]\\s]') GROUP BY ALL)"""
ENRICHED_SQL = f"""(SELECT i.item_id, t.supporting, t.contrasting, t.mentioning, p.n_notices FROM {live_sql('doi')} i LEFT JOIN {TALLIES_SQL} t ON t.doi_key = lower(i.doi) LEFT JOIN {PAPERS_SQL} p ON p.doi_key = lower(i.doi))"""


def _bare_doi(spark, d) -> DataFrame:
    return items(spark, d, "doi").filter(F.col("doi").rlike(r"^10\.[0-9]{4,9}/\S*[^.,);\]\s]$")).select("item_id", F.lower("doi").alias("doi_key"))


def _enriched(spark, d) -> DataFrame:
    """Items beside the tallies and the papers of their DOI. The two tables are made of annotations and notes, keyed by DOI."""
    works = _bare_doi(spark, d)
    hops = once(spark, d, "item_attachments", "item_id", "parent_item_id").select(F.col("item_id").alias("file"), F.col("parent_item_id").alias("item_id"))
    marks = once(spark, d, "item_annotations", "item_id", "parent_item_id", "annotation_type").select(F.col("item_id").alias("mark"), F.col("parent_item_id").alias("file"), "annotation_type")
    kind = lambda k: F.countDistinct(F.when(F.col("annotation_type") == k, F.col("mark")))
    tallies = works.join(hops, "item_id").join(marks, "file").groupBy("doi_key").agg(kind("highlight").alias("supporting"), kind("note").alias("contrasting"), F.countDistinct("mark").alias("mentioning"))
    notes = once(spark, d, "item_notes", "item_id", "parent_item_id").select(F.col("item_id").alias("note"), F.col("parent_item_id").alias("item_id"))
    papers = works.join(notes, "item_id").groupBy("doi_key").agg(F.countDistinct("note").alias("n_notices"))
    own = items(spark, d, "doi").select("item_id", F.lower("doi").alias("doi_key"))
    return own.join(tallies, "doi_key", "left").join(papers, "doi_key", "left")


@query("j12_tallies_and_papers", f"SELECT item_id, supporting, contrasting, mentioning, n_notices FROM {ENRICHED_SQL}")
def j12(spark, d):
    return _enriched(spark, d).select("item_id", "supporting", "contrasting", "mentioning", "n_notices")


@query("f16_papers_with_notices", f"SELECT item_id, n_notices FROM {ENRICHED_SQL} WHERE n_notices > 0")
def f16(spark, d):
    return _enriched(spark, d).filter("n_notices > 0").select("item_id", "n_notices")


@query("a17_items_with_tallies", f"SELECT count(*) AS n, count(mentioning) AS with_tally FROM {ENRICHED_SQL}")
def a17(spark, d):
    return _enriched(spark, d).agg(F.count("*").alias("n"), F.count("mentioning").alias("with_tally"))


@query("x28_tally_lines", f"SELECT item_id, supporting || ' supporting, ' || contrasting || ' contrasting, ' || mentioning || ' mentioning' AS tally FROM {ENRICHED_SQL} WHERE mentioning IS NOT NULL")
def x28(spark, d):
    return _enriched(spark, d).filter("mentioning is not null").select("item_id", X.tally_line(F.col("supporting"), F.col("contrasting"), F.col("mentioning")).alias("tally"))


# -------------------------------------------------------------------------------- arguments and notations


@query("x15_chapter_texts", f"SELECT item_id, trim(regexp_replace(translate(fulltext, '‘’“”', '''''\"\"'), '\\s+', ' ', 'g')) AS plain FROM {live_sql('fulltext')} WHERE fulltext IS NOT NULL")
def x15(spark, d):
    return items(spark, d, "fulltext").filter("fulltext is not null").select("item_id", X.chapter_text(F.col("fulltext")).alias("plain"))


@query("x21_list_arguments", f"SELECT item_id, list_filter(list_transform(string_split(creators, ','), lambda x: trim(x)), lambda x: x <> '') AS parts FROM {live_sql('creators')} WHERE regexp_full_match(creators, '[^\\[].*') AND NOT regexp_matches(creators, '[^ -~À-ɏ]')")
def x21(spark, d):
    """Comma-separated texts as lists, by the function that takes list arguments."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def parts(values: pd.Series) -> pd.Series:
        return values.map(X.list_argument)

    own = items(spark, d, "creators").filter(F.col("creators").rlike(r"(?s)^[^\[].*") & ~F.col("creators").rlike("[^ -~À-ɏ]"))
    return own.select("item_id", parts("creators").alias("parts"))


@query("x30_split_names", rf"SELECT creator_id, trim(regexp_extract(n, '^(.*) \S+$', 1)) AS first_name, regexp_extract(n, '(\S+)$', 1) AS last_name FROM (SELECT DISTINCT creator_id, trim(full_name) AS n FROM creators WHERE regexp_full_match(full_name, '[!-~À-ɏ ]+'))")
def x30(spark, d):
    own = once(spark, d, "creators", "creator_id", "full_name").filter(F.col("full_name").rlike("^[!-~À-ɏ ]+$"))
    return own.select("creator_id", X.split_name(F.col("full_name")).alias("s")).select("creator_id", "s.first_name", "s.last_name").distinct()


@query("s10_limits", f"SELECT item_id, greatest(1, least(version, 500)) AS n FROM {live_sql('version')} WHERE version IS NOT NULL")
def s10(spark, d):
    @F.pandas_udf(T.IntegerType())
    def limits(values: pd.Series) -> pd.Series:
        return values.map(X.limit_argument).astype("int32")

    return items(spark, d, "version").filter("version is not null").select("item_id", limits("version").alias("n"))


@query("x2_search_variants", None)
def x2(spark, d):
    """The spellings to try for every family name."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def variants(values: pd.Series) -> pd.Series:
        return values.map(X.search_variants)

    return once(spark, d, "creators", "last_name").filter("length(trim(last_name)) > 0").select("last_name", variants("last_name").alias("variants"))


@query("s8_ordered_duplicates", f"""SELECT row_number() OVER (ORDER BY group_key) AS place, group_key, n_items, item_ids FROM
    (SELECT 'doi:' || lower(trim(doi)) AS group_key, count(*) AS n_items, list(item_id ORDER BY item_id) AS item_ids FROM {live_sql('doi')} WHERE trim(doi) <> '' GROUP BY 1 HAVING count(*) > 1) ORDER BY group_key LIMIT 50""")
def s8(spark, d):
    """The first groups by key, with their members."""
    from pyspark.sql import Window

    groups = library.duplicate_groups(items(spark, d, "title", "doi"), "doi").orderBy("group_key").limit(50)
    members = library.duplicate_members(items(spark, d, "title", "doi"), "doi").join(F.broadcast(groups.select("group_key")), "group_key")  # at most 50 groups
    listed = members.groupBy("group_key").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    placed = groups.join(listed, "group_key").withColumn("place", F.row_number().over(Window.orderBy("group_key")).cast("long"))
    return placed.select("place", "group_key", "n_items", "item_ids")


@query("snk9_collection_created", "SELECT collection_key, collection_name, parent_collection FROM zotero_collections UNION ALL SELECT 'NEWKEY', 'New', min(collection_key) FROM zotero_collections")
def snk9(spark, d):
    own = table(spark, d, "zotero_collections").select("collection_key", "collection_name", "parent_collection")
    return own.unionByName(own.agg(F.min("collection_key").alias("parent_collection")).select(F.lit("NEWKEY").alias("collection_key"), F.lit("New").alias("collection_name"), "parent_collection"))


@query(
    "snk12_annotations_created",
    f"""SELECT m.item_id, a.item_id AS parent_item_id, 'highlight' AS annotation_type, m.annotation_text, '00000|' || lpad(CAST(instr(i.fulltext, m.annotation_text) - 1 AS VARCHAR), 8, '0') AS annotation_sort_index
        FROM {once_sql('item_annotations', 'item_id', 'parent_item_id', 'annotation_text')} m JOIN {once_sql('item_attachments', 'item_id', 'parent_item_id')} a ON a.item_id = m.parent_item_id
        JOIN {live_sql('fulltext')} i ON i.item_id = a.parent_item_id WHERE m.annotation_text <> '' AND instr(i.fulltext, m.annotation_text) > 0""",
)
def snk12(spark, d):
    """Highlights made anew where the texts of annotations stand in the full text of their work."""
    works = items(spark, d, "fulltext").filter("length(fulltext) > 0").select(F.col("item_id").alias("work_id"), "fulltext")
    hops = once(spark, d, "item_attachments", "item_id", "parent_item_id").select(F.col("item_id").alias("parent_item_id"), F.col("parent_item_id").alias("work_id"))
    marks = once(spark, d, "item_annotations", "item_id", "parent_item_id", "annotation_text").filter("annotation_text <> ''")
    met = marks.join(hops, "parent_item_id").join(works, "work_id").withColumn("at", F.call_function("locate", F.col("annotation_text"), F.col("fulltext"))).filter("at > 0")
    return met.select("item_id", "parent_item_id", F.lit("highlight").alias("annotation_type"), "annotation_text", F.format_string("00000|%08d", F.col("at") - 1).alias("annotation_sort_index"))
