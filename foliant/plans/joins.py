"""Joins, hierarchies and running sums."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliant.functions.fields import doi_key
from foliant.functions.geometry import position
from foliant.functions.text import squeezed_key
from foliant.operators import library
from foliant.operators.library import items, once
from foliant.plans.registry import live_sql, once_sql, query
from foliant.plans.scans import CREATORS_SQL
from foliant.session import table

ATTACHMENTS = once_sql("item_attachments", "item_id", "parent_item_id", "content_type", "filename", "md5", "title")
ANNOTATIONS = once_sql("item_annotations", "item_id", "parent_item_id", "annotation_text", "annotation_position")
NOTES = once_sql("item_notes", "item_id", "parent_item_id", "title", "note")


@query("j1_item_types", f"SELECT i.item_id, t.item_type AS type_name FROM {live_sql('item_type_id', 'item_type')} i JOIN (SELECT item_type_id, min(item_type) AS item_type FROM zotero_items GROUP BY item_type_id) t USING (item_type_id)")
def j1(spark, d):
    types = table(spark, d, "zotero_items").groupBy("item_type_id").agg(F.min("item_type").alias("type_name"))
    return items(spark, d, "item_type_id").join(types, "item_type_id").select("item_id", "type_name")


@query("j2_fields_pivoted", f"SELECT item_id, title, doi, extra FROM {live_sql('title', 'doi', 'extra')} WHERE title IS NOT NULL OR doi IS NOT NULL OR extra IS NOT NULL")
def j2(spark, d):
    long = library.unpivoted(items(spark, d, "title", "doi", "extra"), "item_id", ["title", "doi", "extra"])
    return library.pivoted(long, "item_id", ["title", "doi", "extra"])


@query("j3_constant_dimension", f"SELECT i.item_id, f.limit_value FROM {live_sql('item_key')} i LEFT JOIN size_limits f ON f.limit_name = 'container'")
def j3(spark, d):
    one = table(spark, d, "size_limits").filter("limit_name = 'container'").select("limit_value")
    return items(spark, d).join(F.broadcast(one), F.lit(True), "left").select("item_id", "limit_value")


@query("j4_parent_or_self", f"SELECT i.item_id, n.item_id AS note_id FROM {live_sql('item_key')} i LEFT JOIN {NOTES} n ON i.item_id = n.parent_item_id OR i.item_id = n.item_id")
def j4(spark, d):
    notes = once(spark, d, "item_notes", "item_id", "parent_item_id").select(F.col("item_id").alias("note_id"), "parent_item_id")
    got = library.either_key_join(items(spark, d).select("item_id"), notes, "item_id", ("parent_item_id", "note_id"), "left")
    return got.select("item_id", "note_id")


@query("j5_item_creators", f"SELECT i.item_id, c.creators_text FROM {live_sql('item_key')} i LEFT JOIN ({CREATORS_SQL}) c USING (item_id)")
def j5(spark, d):
    return items(spark, d).join(library.creators_text(spark, d), "item_id", "left")


@query("j6_libraries", f"SELECT l.library_id, coalesce(n.n, 0) AS n_items FROM (SELECT DISTINCT library_id FROM zotero_items) l LEFT JOIN (SELECT library_id, count(*) AS n FROM {live_sql('library_id')} GROUP BY library_id) n USING (library_id)")
def j6(spark, d):
    counts = items(spark, d, "library_id").groupBy("library_id").agg(F.count("*").alias("n"))
    return table(spark, d, "zotero_items").select("library_id").distinct().join(counts, "library_id", "left").select("library_id", F.coalesce("n", F.lit(0)).alias("n_items"))


@query("j7_note_parents", f"SELECT n.item_id, n.parent_item_id, i.title AS parent_title FROM {NOTES} n LEFT JOIN {live_sql('title')} i ON i.item_id = n.parent_item_id")
def j7(spark, d):
    parents = items(spark, d, "title").select(F.col("item_id").alias("parent_item_id"), F.col("title").alias("parent_title"))
    return once(spark, d, "item_notes", "item_id", "parent_item_id").join(parents, "parent_item_id", "left").select("item_id", "parent_item_id", "parent_title")


@query(
    "j8_annotation_two_hops",
    f"""SELECT x.item_id, a.item_id AS attachment_id, i.item_id AS work_id, i.title FROM {ANNOTATIONS} x
        LEFT JOIN {ATTACHMENTS} a ON a.item_id = x.parent_item_id LEFT JOIN {live_sql('title')} i ON i.item_id = a.parent_item_id""",
)
def j8(spark, d):
    files = once(spark, d, "item_attachments", "item_id", "parent_item_id", "content_type", "filename", "md5", "title").select(F.col("item_id").alias("attachment_id"), F.col("parent_item_id").alias("_w"))
    works = items(spark, d, "title").select(F.col("item_id").alias("work_id"), "title")
    marks = once(spark, d, "item_annotations", "item_id", "parent_item_id", "annotation_text", "annotation_position").select("item_id", F.col("parent_item_id").alias("_a"))
    return marks.join(files, F.col("_a") == F.col("attachment_id"), "left").join(works, F.col("_w") == F.col("work_id"), "left").select("item_id", "attachment_id", "work_id", "title")


@query("j9_parent_title_or_else", f"SELECT n.item_id, coalesce(i.title, '(unknown)') AS parent_title FROM {NOTES} n LEFT JOIN {live_sql('title')} i ON i.item_id = n.parent_item_id")
def j9(spark, d):
    parents = items(spark, d, "title").select(F.col("item_id").alias("parent_item_id"), F.col("title").alias("t"))
    return once(spark, d, "item_notes", "item_id", "parent_item_id").join(parents, "parent_item_id", "left").select("item_id", F.coalesce("t", F.lit("(unknown)")).alias("parent_title"))


@query(
    "j10_work_title_or_file_title",
    f"""SELECT x.item_id, coalesce(i.title, a.title) AS shown_title FROM {ANNOTATIONS} x
        LEFT JOIN (SELECT item_id, min(parent_item_id) AS parent_item_id, min(title) AS title FROM item_attachments GROUP BY item_id) a ON a.item_id = x.parent_item_id
        LEFT JOIN {live_sql('title')} i ON i.item_id = a.parent_item_id""",
)
def j10(spark, d):
    files = table(spark, d, "item_attachments").groupBy(F.col("item_id").alias("_a")).agg(F.min("parent_item_id").alias("_w"), F.min("title").alias("file_title"))
    works = items(spark, d, "title").select(F.col("item_id").alias("_w"), "title")
    marks = once(spark, d, "item_annotations", "item_id", "parent_item_id", "annotation_text", "annotation_position").select("item_id", F.col("parent_item_id").alias("_a"))
    return marks.join(files, "_a", "left").join(works, "_w", "left").select("item_id", F.coalesce("title", "file_title").alias("shown_title"))


@query("j13_feed_items", f"SELECT DISTINCT f.doc_id, f.ingested_at, i.title, i.item_type FROM documents f JOIN {live_sql('item_key', 'title', 'item_type')} i USING (item_key) WHERE f.source = 'feed_item'")
def j13(spark, d):
    feed = table(spark, d, "documents").filter("source = 'feed_item'").select("doc_id", "ingested_at", "item_key")
    return feed.join(items(spark, d, "item_key", "title", "item_type"), "item_key").select("doc_id", "ingested_at", "title", "item_type").distinct()


@query("j14_collection_parents", "SELECT c.collection_key, c.collection_name, p.collection_name AS parent_name FROM zotero_collections c LEFT JOIN zotero_collections p ON p.collection_key = c.parent_collection")
def j14(spark, d):
    own = table(spark, d, "zotero_collections")
    parents = own.select(F.col("collection_key").alias("_p"), F.col("collection_name").alias("parent_name"))
    return own.join(parents, F.col("parent_collection") == F.col("_p"), "left").select("collection_key", "collection_name", "parent_name")


@query("j15_known_ids", f"SELECT item_id FROM {live_sql('item_key')} WHERE item_key IN (SELECT item_key FROM documents)")
def j15(spark, d):
    return items(spark, d, "item_key").join(table(spark, d, "documents").select("item_key"), "item_key", "left_semi").select("item_id")


@query(
    "j16_unmatched_signatures",
    """WITH s AS (SELECT DISTINCT item_id, parent_item_id, coalesce(content_type, '') AS c, coalesce(filename, '') AS f, coalesce(md5, '') AS m FROM item_attachments)
       SELECT item_id FROM s WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.c = s.c AND o.f = s.f AND o.m = s.m AND o.item_id < s.item_id)""",
)
def j16(spark, d):
    sign = ["c", "f", "m"]
    own = once(spark, d, "item_attachments", "item_id", "content_type", "filename", "md5").select("item_id", *[F.coalesce(x, F.lit("")).alias(a) for x, a in zip(("content_type", "filename", "md5"), sign)])
    return own.groupBy(*sign).agg(F.min("item_id").alias("item_id")).select("item_id")


@query(
    "j17_preprints_without_article",
    f"""WITH i AS (SELECT item_id, item_type, nullif(regexp_replace(lower(coalesce(title, '')), '\\s+', '', 'g'), '') AS t, nullif(lower(trim(coalesce(doi, ''))), '') AS d FROM {live_sql('item_type', 'title', 'doi')})
        SELECT item_id FROM i WHERE item_type = 'preprint' AND NOT EXISTS (SELECT 1 FROM i a WHERE a.item_type = 'journalArticle' AND (a.t = i.t)) AND NOT EXISTS (SELECT 1 FROM i a WHERE a.item_type = 'journalArticle' AND a.d = i.d)""",
)
def j17(spark, d):
    own = items(spark, d, "item_type", "title", "doi")
    title = F.nullif(squeezed_key(F.coalesce("title", F.lit(""))), F.lit(""))
    doi = F.nullif(F.lower(F.trim(F.coalesce("doi", F.lit("")))), F.lit(""))
    keyed = own.select("item_id", "item_type", F.explode(F.array_compact(F.array(F.concat(F.lit("t:"), title), F.concat(F.lit("d:"), doi)))).alias("key"))
    articles = keyed.filter("item_type = 'journalArticle'").select("key").distinct()
    met = keyed.filter("item_type = 'preprint'").join(articles, "key", "left_semi").select("item_id")
    return own.filter("item_type = 'preprint'").select("item_id").join(met, "item_id", "left_anti")


RECTS_SQL = """(SELECT DISTINCT item_id, parent_item_id, CAST(json_extract(annotation_position, '$.pageIndex') AS INTEGER) AS page,
    CAST(json_extract(annotation_position, '$.rects[0][1]') AS DOUBLE) AS low, CAST(json_extract(annotation_position, '$.rects[0][3]') AS DOUBLE) AS high FROM item_annotations WHERE annotation_position IS NOT NULL)"""


@query("j19_overlapping_marks", f"SELECT a.item_id AS a_id, b.item_id AS b_id FROM {RECTS_SQL} a JOIN {RECTS_SQL} b ON a.parent_item_id = b.parent_item_id AND a.page = b.page AND a.low < b.high AND a.high > b.low AND a.item_id < b.item_id")
def j19(spark, d):
    pos = position(F.col("annotation_position"))
    own = once(spark, d, "item_annotations", "item_id", "parent_item_id", "annotation_position").select("item_id", "parent_item_id", pos["pageIndex"].alias("page"), pos["rects"][0].alias("r")).filter("r is not null")
    a = own.select(F.col("item_id").alias("a_id"), "parent_item_id", "page", F.col("r")[1].alias("a_low"), F.col("r")[3].alias("a_high"))
    b = own.select(F.col("item_id").alias("b_id"), "parent_item_id", "page", F.col("r")[1].alias("b_low"), F.col("r")[3].alias("b_high"))
    return library.overlapping(a, b, ["parent_item_id", "page"], ("a_low", "a_high"), ("b_low", "b_high"), 100.0).filter("a_id < b_id").select("a_id", "b_id")


@query(
    "j20_containing_over_length",
    """WITH r AS (SELECT collection_key, doc_id, coalesce(sum(length(text)) OVER (PARTITION BY collection_key ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_at, length(text) AS len
         FROM documents WHERE collection_key IS NOT NULL)
       SELECT p.collection_key, p.point, r.doc_id FROM (SELECT DISTINCT collection_key, unnest([start_at + len // 2, start_at // 1800 * 1800]) AS point FROM r) p
       JOIN r ON r.collection_key = p.collection_key AND p.point >= r.start_at AND p.point < r.start_at + r.len""",
)
def j20_over_length(spark, d):
    """The middle of every document and the page starts of w1, so that points lie over the whole length of a collection."""
    docs = table(spark, d, "documents").filter("collection_key is not null")
    ranges = library.running_offsets(docs.select("collection_key", "doc_id", F.length("text").alias("n")), "collection_key", "doc_id", F.col("n")).select("collection_key", "doc_id", "start_at", "end_at")
    middle, page = F.floor((F.col("start_at") + F.col("end_at")) / 2), F.floor(F.col("start_at") / 1800) * 1800
    points = ranges.select("collection_key", F.explode(F.array(middle, page)).alias("point")).distinct()
    return library.containing(points, ranges, "collection_key", "point", 5000).select("collection_key", "point", "doc_id")


@query(
    "s9_collection_tree",
    """WITH RECURSIVE t AS (SELECT collection_key, 0 AS depth, collection_name AS path FROM zotero_collections WHERE parent_collection IS NULL OR parent_collection NOT IN (SELECT collection_key FROM zotero_collections)
         UNION ALL SELECT c.collection_key, t.depth + 1, t.path || ' / ' || c.collection_name FROM zotero_collections c JOIN t ON c.parent_collection = t.collection_key)
       SELECT collection_key, depth, path FROM t""",
)
def s9(spark, d):
    return library.collection_paths(table(spark, d, "zotero_collections")).filter("depth is not null")


@query(
    "w1_running_offsets",
    """SELECT collection_key, doc_id, coalesce(sum(length(text)) OVER w, 0)::BIGINT AS start_at, (coalesce(sum(length(text)) OVER w, 0) // 1800 + 1)::BIGINT AS page
       FROM documents WHERE collection_key IS NOT NULL WINDOW w AS (PARTITION BY collection_key ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def w1(spark, d):
    docs = table(spark, d, "documents").filter("collection_key is not null").select("collection_key", "doc_id", F.length("text").alias("n"))
    return library.running_offsets(docs, "collection_key", "doc_id", F.col("n")).select("collection_key", "doc_id", "start_at", (F.floor(F.col("start_at") / 1800) + 1).alias("page"))


@query(
    "w2_normalised_offsets",
    """SELECT parent_item_id, item_id, coalesce(sum(length(lower(regexp_replace(note, '\\s+', '', 'g')))) OVER (PARTITION BY parent_item_id ORDER BY item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_at
       FROM (SELECT DISTINCT item_id, parent_item_id, note FROM item_notes)""",
)
def w2(spark, d):
    notes = once(spark, d, "item_notes", "item_id", "parent_item_id", "note")
    return library.running_offsets(notes, "parent_item_id", "item_id", F.length(F.regexp_replace("note", r"\s+", ""))).select("parent_item_id", "item_id", "start_at")


@query("w3_numbered_creators", f"SELECT item_id, creator_id, row_number() OVER (PARTITION BY item_id ORDER BY order_index, creator_id) AS n FROM {once_sql('item_creators', 'item_id', 'creator_id', 'order_index')}")
def w3(spark, d):
    w = Window.partitionBy("item_id").orderBy("order_index", "creator_id")
    return once(spark, d, "item_creators", "item_id", "creator_id", "order_index").select("item_id", "creator_id", F.row_number().over(w).cast("long").alias("n"))


@query("w4_first_per_group", f"SELECT library_id, item_type, min(item_id) AS item_id FROM {live_sql('library_id', 'item_type')} GROUP BY ALL")
def w4(spark, d):
    return library.best_per_parent(items(spark, d, "library_id", "item_type").select(F.struct("library_id", "item_type").alias("k"), "item_id"), "k", [F.col("item_id")]).select("k.library_id", "k.item_type", "item_id")


@query(
    "doi_key_groups",
    f"""WITH k AS (SELECT item_id, regexp_replace(regexp_extract(regexp_replace(replace(lower(trim(doi)), '%2f', '/'), '%28|%29', '', 'g'), '(10\\.[0-9]{{4,9}}/[^\\s\"<>]+)', 1), '[.,;:)\\]}}''?!]+$', '') AS doi_key FROM {live_sql('doi')})
        SELECT doi_key, count(*) AS n, min(item_id) AS first_item_id FROM k WHERE length(doi_key) > 8 GROUP BY doi_key""",
)
def doi_groups(spark, d):
    """Works by DOI in any notation (percent escapes, prefixes, case, trailing marks)."""
    own = items(spark, d, "doi").select("item_id", doi_key(F.col("doi")).alias("doi_key")).filter("doi_key is not null")
    return own.groupBy("doi_key").agg(F.count("*").alias("n"), F.min("item_id").alias("first_item_id"))
