"""Scans, sources and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.functions.fields import live
from foliant.functions.geometry import position
from foliant.operators import index, library
from foliant.operators.library import CHILD_TYPES, items, once
from foliant.plans.registry import live_sql, once_sql, query
from foliant.session import table


@query("src1_library_scan", f"SELECT item_id, item_key, version, item_type, title FROM {live_sql('item_key', 'version', 'item_type', 'title')}")
def src1(spark, d):
    return items(spark, d, "item_key", "version", "item_type", "title")


@query("src2_second_page", f"SELECT item_id, item_key FROM {live_sql('item_key')} ORDER BY item_id LIMIT 100 OFFSET 100")
def src2(spark, d):
    return items(spark, d, "item_key").orderBy("item_id").offset(100).limit(100)


@query("src3_top_level_items", f"SELECT item_id, item_type FROM {live_sql('item_type')} WHERE item_type NOT IN ('attachment', 'note', 'annotation')")
def src3(spark, d):
    return items(spark, d, "item_type").filter(~F.col("item_type").isin(*CHILD_TYPES))


CREATORS_SQL = f"""
    SELECT l.item_id, string_agg(coalesce(c.full_name, concat_ws(', ', c.last_name, c.first_name)), '; ' ORDER BY l.order_index, l.creator_id) AS creators_text
    FROM {once_sql('item_creators', 'item_id', 'creator_id', 'order_index')} l LEFT JOIN {once_sql('creators')} c USING (creator_id) GROUP BY l.item_id
"""
NOTES_SQL = f"""
    SELECT parent_item_id AS item_id, string_agg(note, ' ' ORDER BY item_id) AS notes_text
    FROM {once_sql('item_notes', 'item_id', 'parent_item_id', 'note')} GROUP BY parent_item_id
"""


@query(
    "src4_items_with_text",
    f"""SELECT i.item_id, i.title, i.doi, n.notes_text, c.creators_text FROM {live_sql('title', 'doi')} i
        LEFT JOIN ({NOTES_SQL}) n USING (item_id) LEFT JOIN ({CREATORS_SQL}) c USING (item_id)""",
)
def src4(spark, d):
    base = items(spark, d, "title", "doi")
    return base.join(library.notes_text(spark, d), "item_id", "left").join(library.creators_text(spark, d), "item_id", "left").select("item_id", "title", "doi", "notes_text", "creators_text")


@query("src5_text_source", f"SELECT item_id, CASE WHEN length(fulltext) > 0 THEN 'fulltext' WHEN length(abstract) > 0 THEN 'abstract' ELSE 'title' END AS text_source FROM {live_sql('fulltext', 'abstract')}")
def src5(spark, d):
    has = lambda c: F.coalesce(F.length(c) > 0, F.lit(False))
    own = table(spark, d, "zotero_items").filter(live(F.col("deleted")))
    return own.select("item_id", F.when(has("fulltext"), "fulltext").when(has("abstract"), "abstract").otherwise("title").alias("text_source")).distinct()


@query("src7_item_by_key", f"SELECT item_id, item_key, title FROM {live_sql('item_key', 'title')} WHERE item_key = (SELECT min(item_key) FROM zotero_items)")
def src7(spark, d):
    first = table(spark, d, "zotero_items").agg(F.min("item_key").alias("item_key"))
    return items(spark, d, "item_key", "title").join(F.broadcast(first), "item_key", "left_semi").select("item_id", "item_key", "title")


@query(
    "src8_items_by_keys",
    f"SELECT item_id, item_key FROM {live_sql('item_key')} WHERE item_id IN (SELECT parent_item_id FROM item_notes)",
)
def src8(spark, d):
    wanted = once(spark, d, "item_notes", "parent_item_id")
    return items(spark, d, "item_key").join(wanted, F.col("item_id") == F.col("parent_item_id"), "left_semi")


@query(
    "src9_children",
    f"""SELECT parent_item_id, item_id, 'attachment' AS kind FROM {once_sql('item_attachments', 'item_id', 'parent_item_id')} WHERE parent_item_id IS NOT NULL
        UNION ALL SELECT parent_item_id, item_id, 'note' AS kind FROM {once_sql('item_notes', 'item_id', 'parent_item_id')} WHERE parent_item_id IS NOT NULL""",
)
def src9(spark, d):
    kinds = [once(spark, d, f"item_{k}s", "item_id", "parent_item_id").select("parent_item_id", "item_id", F.lit(k).alias("kind")) for k in ("attachment", "note")]
    return kinds[0].unionByName(kinds[1]).filter("parent_item_id is not null")


@query("src10_collection_items", f"SELECT item_id, title FROM {live_sql('title', 'collections')} WHERE list_contains(collections, 'C0LL0001')")
def src10(spark, d):
    return items(spark, d, "title", "collections").filter(F.array_contains("collections", "C0LL0001")).select("item_id", "title")


@query(
    "src11_parent_attachments",
    f"""SELECT a.parent_item_id, a.item_id, a.content_type, a.attachment_path FROM {once_sql('item_attachments', 'item_id', 'parent_item_id', 'content_type', 'attachment_path')} a
        JOIN {live_sql('item_key')} i ON i.item_id = a.parent_item_id""",
)
def src11(spark, d):
    files = once(spark, d, "item_attachments", "item_id", "parent_item_id", "content_type", "attachment_path")
    parents = items(spark, d).select(F.col("item_id").alias("_p"))
    return files.join(parents, F.col("parent_item_id") == F.col("_p"), "left_semi").select("parent_item_id", "item_id", "content_type", "attachment_path")


@query("src13_html_text", "SELECT DISTINCT item_id, trim(regexp_replace(regexp_replace(note, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS note_text FROM item_notes")
def src13(spark, d):
    return once(spark, d, "item_notes", "item_id", "note").select("item_id", X.collapsed(F.regexp_replace("note", r"<[^>]+>", " ")).alias("note_text"))


@query(
    "src14_reader_by_suffix",
    f"""SELECT item_id, CASE WHEN lower(filename) LIKE '%.pdf' THEN 'pdf' WHEN lower(filename) LIKE '%.html' OR lower(filename) LIKE '%.htm' THEN 'html'
        WHEN lower(filename) LIKE '%.epub' THEN 'epub' ELSE 'none' END AS reader FROM {once_sql('item_attachments', 'item_id', 'filename')}""",
)
def src14(spark, d):
    low = F.lower("filename")
    reader = F.when(low.endswith(".pdf"), "pdf").when(low.endswith(".html") | low.endswith(".htm"), "html").when(low.endswith(".epub"), "epub").otherwise("none")
    return once(spark, d, "item_attachments", "item_id", "filename").select("item_id", reader.alias("reader"))


@query(
    "src15_attachment_paths",
    f"""SELECT item_id, CASE WHEN starts_with(attachment_path, 'storage:') THEN '/storage/' || item_key || '/' || substr(attachment_path, 9)
        WHEN starts_with(attachment_path, 'attachments:') THEN '/base/' || substr(attachment_path, 13)
        WHEN starts_with(attachment_path, 'file://') THEN url_decode(substr(attachment_path, 8))
        WHEN starts_with(attachment_path, '/') THEN attachment_path END AS path
        FROM {once_sql('item_attachments', 'item_id', 'item_key', 'attachment_path')}""",
)
def src15(spark, d):
    files = once(spark, d, "item_attachments", "item_id", "item_key", "attachment_path")
    return files.select("item_id", library.resolved_path(F.col("item_key"), F.col("attachment_path")).alias("path"))


@query(
    "src16_best_attachment",
    f"""SELECT parent_item_id, item_id, content_type FROM {once_sql('item_attachments', 'item_id', 'parent_item_id', 'content_type')}
        WHERE parent_item_id IS NOT NULL AND content_type IN ('application/pdf', 'text/html')
        QUALIFY row_number() OVER (PARTITION BY parent_item_id ORDER BY content_type, item_id) = 1""",
)
def src16(spark, d):
    files = once(spark, d, "item_attachments", "item_id", "parent_item_id", "content_type").filter("parent_item_id is not null and content_type in ('application/pdf', 'text/html')")
    return library.best_per_parent(files, "parent_item_id", [library.attachment_rank(F.col("content_type")), F.col("item_id")])


@query(
    "src17_preferred_attachment",
    f"""SELECT parent_item_id, item_id, filename FROM {once_sql('item_attachments', 'item_id', 'parent_item_id', 'content_type', 'filename', 'md5')} WHERE parent_item_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY parent_item_id ORDER BY CASE content_type WHEN 'application/pdf' THEN 0 WHEN 'text/html' THEN 1 ELSE 2 END, -length(coalesce(md5, '')), item_id) = 1""",
)
def src17(spark, d):
    files = once(spark, d, "item_attachments", "item_id", "parent_item_id", "content_type", "filename", "md5").filter("parent_item_id is not null")
    order = [library.attachment_rank(F.col("content_type")), -F.length(F.coalesce("md5", F.lit(""))), F.col("item_id")]
    return library.best_per_parent(files, "parent_item_id", order).select("parent_item_id", "item_id", "filename")


@query(
    "src18_index_metadata",
    f"""SELECT item_key, item_type, coalesce(title, '') AS title, coalesce(doi, '') AS doi, coalesce(creators, '') AS creators,
        CASE WHEN has THEN 'ok' WHEN fulltext_source IS NOT NULL THEN 'failed' ELSE 'none' END AS fulltext_state,
        trim(regexp_extract(coalesce(extra, ''), '(?im)^citation ?key:(.*)$', 1)) AS citation_key
        FROM (SELECT DISTINCT item_id, item_key, item_type, title, doi, creators, extra, fulltext_source, coalesce(length(fulltext) > 0, false) AS has FROM zotero_items WHERE NOT coalesce(deleted, false))""",
)
def src18(spark, d):
    own = table(spark, d, "zotero_items").filter(live(F.col("deleted")))
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    state = index.fulltext_state(F.col("fulltext"), F.col("fulltext_source"))
    return own.select("item_id", "item_key", "item_type", blank("title"), blank("doi"), blank("creators"), state.alias("fulltext_state"), X.citation_key(F.col("extra")).alias("citation_key")).distinct().drop("item_id")


# ----------------------------------------------------------------------------------------- projections


@query(
    "pr1_result_rows",
    f"""SELECT item_key, item_type, coalesce(title, 'Untitled') AS title, substr(date_added, 1, 4) AS year,
        CASE WHEN length(abstract) > 200 THEN substr(abstract, 1, 200) || '...' ELSE abstract END AS abstract FROM {live_sql('item_key', 'item_type', 'title', 'date_added', 'abstract')}""",
)
def pr1(spark, d):
    return items(spark, d, "item_key", "item_type", "title", "date_added", "abstract").select(
        "item_key", "item_type", F.coalesce("title", F.lit("Untitled")).alias("title"), F.substring("date_added", 1, 4).alias("year"), X.shortened(F.col("abstract"), 200).alias("abstract")
    )


@query(
    "pr2_metadata_by_type",
    f"""SELECT item_id, item_type, CASE item_type WHEN 'journalArticle' THEN coalesce(doi, '') WHEN 'book' THEN coalesce(extra, '') WHEN 'webpage' THEN coalesce(date_modified, '') ELSE '' END AS detail
        FROM {live_sql('item_type', 'doi', 'extra', 'date_modified')}""",
)
def pr2(spark, d):
    detail = F.when(F.col("item_type") == "journalArticle", F.col("doi")).when(F.col("item_type") == "book", F.col("extra")).when(F.col("item_type") == "webpage", F.col("date_modified"))
    return items(spark, d, "item_type", "doi", "extra", "date_modified").select("item_id", "item_type", F.coalesce(detail, F.lit("")).alias("detail"))


@query("pr3_keys_only", f"SELECT item_key FROM {live_sql('item_key')}")
def pr3(spark, d):
    return items(spark, d, "item_key").select("item_key")


@query(
    "pr4_document_text",
    f"""SELECT item_id, concat_ws(' ', nullif(title, ''), nullif(creators, ''), nullif(abstract, ''), nullif(regexp_replace(notes, '<[^>]+>', '', 'g'), '')) AS document_text
        FROM {live_sql('title', 'creators', 'abstract', 'notes')}""",
)
def pr4(spark, d):
    return items(spark, d, "title", "creators", "abstract", "notes").select("item_id", index.document_text(*map(F.col, ("title", "creators", "abstract", "notes"))).alias("document_text"))


@query(
    "pr5_text_with_fulltext",
    """SELECT DISTINCT item_id, md5(coalesce(title, '') || CASE WHEN length(trim(fulltext)) > 0 THEN chr(10) || chr(10) || fulltext ELSE '' END) AS text_md5
       FROM zotero_items WHERE NOT coalesce(deleted, false)""",
)
def pr5(spark, d):
    own = table(spark, d, "zotero_items").filter(live(F.col("deleted")))
    whole = F.concat(F.coalesce("title", F.lit("")), F.coalesce(F.when(F.length(F.trim("fulltext")) > 0, F.concat(F.lit("\n\n"), "fulltext")), F.lit("")))
    return own.select("item_id", F.md5(whole.cast("binary")).alias("text_md5")).distinct()


@query(
    "pr6_searchable_text",
    """SELECT DISTINCT item_id, md5(concat_ws(chr(10) || chr(10), 'Title: ' || nullif(title, ''), 'Authors: ' || nullif(creators, ''), 'Abstract: ' || nullif(abstract, ''),
       'Full text: ' || nullif(CASE WHEN length(fulltext) > 50000 THEN substr(fulltext, 1, 50000) || '...' ELSE fulltext END, ''))) AS text_md5
       FROM zotero_items WHERE NOT coalesce(deleted, false)""",
)
def pr6(spark, d):
    own = table(spark, d, "zotero_items").filter(live(F.col("deleted")))
    return own.select("item_id", F.md5(index.searchable_text(*map(F.col, ("title", "creators", "abstract", "fulltext"))).cast("binary")).alias("text_md5")).distinct()


@query(
    "pr8_item_struct",
    f"""SELECT item_id, to_json({{'key': item_key, 'itemType': item_type, 'title': title}})::VARCHAR AS item FROM {live_sql('item_key', 'item_type', 'title')} WHERE title IS NOT NULL""",
)
def pr8(spark, d):
    own = items(spark, d, "item_key", "item_type", "title").filter("title is not null")
    return own.select("item_id", F.to_json(F.struct(F.col("item_key").alias("key"), F.col("item_type").alias("itemType"), "title")).alias("item"))


@query(
    "pr9_type_mapping",
    f"""SELECT item_type, coalesce(MAP {{'journalArticle': 'article', 'book': 'book', 'bookSection': 'incollection', 'webpage': 'misc'}}[item_type], 'misc') AS entry_type, count(*) AS n
        FROM {live_sql('item_type')} GROUP BY ALL""",
)
def pr9(spark, d):
    types = F.create_map(*[F.lit(x) for pair in X.ENTRY_TYPES.items() for x in pair])
    return items(spark, d, "item_type").groupBy("item_type").agg(F.count("*").alias("n")).select("item_type", F.coalesce(F.try_element_at(types, "item_type"), F.lit("misc")).alias("entry_type"), "n")


@query(
    "pr10_annotation_shape",
    """SELECT DISTINCT item_key, annotation_type, coalesce(annotation_text, '') AS text, coalesce(annotation_comment, '') AS comment, coalesce(annotation_page_label, '') AS page FROM item_annotations""",
)
def pr10(spark, d):
    blank = lambda c, n: F.coalesce(c, F.lit("")).alias(n)
    return once(spark, d, "item_annotations", "item_id", "item_key", "annotation_type", "annotation_text", "annotation_comment", "annotation_page_label").select(
        "item_key", "annotation_type", blank("annotation_text", "text"), blank("annotation_comment", "comment"), blank("annotation_page_label", "page")
    )


@query("pr11_page_index", "SELECT DISTINCT item_id, CAST(json_extract(annotation_position, '$.pageIndex') AS INTEGER) AS page_index FROM item_annotations")
def pr11(spark, d):
    return once(spark, d, "item_annotations", "item_id", "annotation_position").select("item_id", position(F.col("annotation_position"))["pageIndex"].alias("page_index"))


@query("pr12_last_path_segment", "SELECT DISTINCT item_id, list_extract(string_split(rtrim(attachment_path, '/'), '/'), -1) AS segment FROM item_attachments")
def pr12(spark, d):
    return once(spark, d, "item_attachments", "item_id", "attachment_path").select("item_id", F.element_at(F.split(F.regexp_replace("attachment_path", "/+$", ""), "/"), -1).alias("segment"))


@query(
    "pr13_annotation_type_names",
    f"""SELECT annotation_type, coalesce(MAP {{'highlight': 1, 'note': 2, 'image': 3, 'ink': 4, 'underline': 5}}[annotation_type], 0) AS type_no, count(*) AS n FROM {once_sql('item_annotations', 'item_id', 'annotation_type')} GROUP BY ALL""",
)
def pr13(spark, d):
    names = F.create_map(*[F.lit(x) for k, n in enumerate(("highlight", "note", "image", "ink", "underline"), 1) for x in (n, k)])
    got = once(spark, d, "item_annotations", "item_id", "annotation_type").groupBy("annotation_type").agg(F.count("*").alias("n"))
    return got.select("annotation_type", F.coalesce(F.try_element_at(names, "annotation_type"), F.lit(0)).alias("type_no"), "n")


# Colours of annotations and their names.
COLOURS = {"#ffd400": "yellow", "#ff6666": "red", "#5fb236": "green", "#2ea8e5": "blue", "#a28ae5": "purple", "#e56eee": "magenta", "#f19837": "orange", "#aaaaaa": "gray"}


@query(
    "pr14_colour_names",
    f"""SELECT item_id, coalesce(MAP {{{', '.join(f"'{k}': '{v}'" for k, v in COLOURS.items())}}}[lower(annotation_color)], '') AS colour FROM {once_sql('item_annotations', 'item_id', 'annotation_color')}""",
)
def pr14(spark, d):
    names = F.create_map(*[F.lit(x) for pair in COLOURS.items() for x in pair])
    return once(spark, d, "item_annotations", "item_id", "annotation_color").select("item_id", F.coalesce(F.try_element_at(names, F.lower("annotation_color")), F.lit("")).alias("colour"))
