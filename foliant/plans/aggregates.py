"""Aggregations, duplicates and writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.functions.fields import live
from foliant.functions.geometry import least_edge, position
from foliant.operators import index, library
from foliant.operators.library import CHILD_TYPES, items, once
from foliant.plans.registry import live_sql, once_sql, query
from foliant.plans.scans import CREATORS_SQL, NOTES_SQL
from foliant.session import table


@query("a1_item_count", f"SELECT count(*) AS n FROM {live_sql('item_type')} WHERE item_type NOT IN ('attachment', 'note', 'annotation')")
def a1(spark, d):
    return items(spark, d, "item_type").filter(~F.col("item_type").isin(*CHILD_TYPES)).agg(F.count("*").alias("n"))


@query("a2_notes_joined", NOTES_SQL)
def a2(spark, d):
    return library.notes_text(spark, d)


@query("a3_creators_joined", CREATORS_SQL)
def a3(spark, d):
    return library.creators_text(spark, d)


@query("a4_items_by_library", f"SELECT library_id, count(*) AS n_items, count(DISTINCT item_type) AS n_types FROM {live_sql('library_id', 'item_type')} GROUP BY library_id")
def a4(spark, d):
    return items(spark, d, "library_id", "item_type").groupBy("library_id").agg(F.count("*").alias("n_items"), F.count_distinct("item_type").alias("n_types"))


@query("a5_items_by_collection", f"SELECT c AS collection_key, count(*) AS n_items FROM (SELECT item_id, unnest(collections) AS c FROM {live_sql('collections')}) GROUP BY c")
def a5(spark, d):
    return items(spark, d, "collections").select("item_id", F.explode("collections").alias("collection_key")).groupBy("collection_key").agg(F.count("*").alias("n_items"))


@query("a6_feed_counts", "SELECT source, count(*) AS n, max(ingested_at) AS latest FROM documents GROUP BY source")
def a6(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.max("ingested_at").alias("latest"))


TITLE_KEY = "regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(lower(trim(coalesce(title, ''))), '[^\\p{L}\\p{N}_\\s]', '', 'g'), '\\s+', ' ', 'g')), '^a ', ''), '^an ', ''), '^the ', '')"


@query(
    "a7_duplicate_groups",
    f"""WITH k AS (SELECT item_id, 'doi:' || lower(trim(doi)) AS group_key FROM {live_sql('doi')} WHERE trim(coalesce(doi, '')) <> '')
        SELECT group_key, count(*) AS n_items, min(item_id) AS first_item_id FROM k GROUP BY group_key HAVING count(*) > 1""",
)
def a7(spark, d):
    return library.duplicate_groups(items(spark, d, "title", "doi"), "doi")


@query("a7_duplicate_titles", f"""SELECT 'title:' || k AS group_key, count(*) AS n_items, min(item_id) AS first_item_id FROM (SELECT item_id, {TITLE_KEY} AS k FROM {live_sql('title')}) WHERE k <> '' GROUP BY k HAVING count(*) > 1""")
def a7_title(spark, d):
    return library.duplicate_groups(items(spark, d, "title", "doi"), "title")


@query(
    "a7_duplicate_members",
    f"""WITH k AS (SELECT item_id, 'doi:' || lower(trim(doi)) AS group_key FROM {live_sql('doi')} WHERE trim(coalesce(doi, '')) <> '' UNION ALL SELECT item_id, 'title:' || k FROM (SELECT item_id, {TITLE_KEY} AS k FROM {live_sql('title')}) WHERE k <> '')
        SELECT group_key, item_id FROM k QUALIFY count(*) OVER (PARTITION BY group_key) > 1""",
)
def a7_members(spark, d):
    """Groups by title and by DOI, with all their members."""
    return library.duplicate_members(items(spark, d, "title", "doi"), "both")


CHILDREN_SQL = f"""SELECT parent_item_id, bool_or(coalesce(content_type = 'application/pdf', false)) AS has_pdf, count(*) FILTER (kind = 'a') AS n_attachments, bool_or(kind = 'n') AS has_notes
    FROM (SELECT parent_item_id, 'a' AS kind, content_type FROM {once_sql('item_attachments', 'item_id', 'parent_item_id', 'content_type')}
          UNION ALL SELECT parent_item_id, 'n', NULL FROM {once_sql('item_notes', 'item_id', 'parent_item_id')}) WHERE parent_item_id IS NOT NULL GROUP BY parent_item_id"""


@query("a8_child_summary", CHILDREN_SQL)
def a8(spark, d):
    return library.child_summary(spark, d)


@query("a9_type_histogram", f"SELECT item_type, count(*) AS n FROM {live_sql('item_type')} GROUP BY item_type ORDER BY n DESC, item_type LIMIT 20")
def a9(spark, d):
    return items(spark, d, "item_type").groupBy("item_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "item_type").limit(20)


@query(
    "a10_fulltext_coverage",
    """SELECT item_type, count(*) AS total, count(*) FILTER (has) AS with_fulltext, count(*) FILTER (has AND fulltext_source = 'pdf') AS from_pdf, count(*) FILTER (has AND fulltext_source = 'html') AS from_html
       FROM (SELECT DISTINCT item_id, item_type, fulltext_source, coalesce(length(fulltext) > 0, false) AS has FROM zotero_items WHERE NOT coalesce(deleted, false)) GROUP BY item_type""",
)
def a10(spark, d):
    own = table(spark, d, "zotero_items").filter(live(F.col("deleted"))).select("item_id", "item_type", "fulltext_source", F.coalesce(F.length("fulltext") > 0, F.lit(False)).alias("has")).distinct()
    return own.groupBy("item_type").agg(
        F.count("*").alias("total"), F.count_if("has").alias("with_fulltext"), F.count_if(F.col("has") & (F.col("fulltext_source") == "pdf")).alias("from_pdf"), F.count_if(F.col("has") & (F.col("fulltext_source") == "html")).alias("from_html")
    )


@query("a11_common_titles", f"SELECT title, count(*) AS n FROM {live_sql('title')} WHERE title <> '' GROUP BY title ORDER BY n DESC, title LIMIT 10")
def a11(spark, d):
    return items(spark, d, "title").filter("title <> ''").groupBy("title").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "title").limit(10)


@query(
    "a12_run_counters",
    f"""SELECT count(*) AS processed, count(*) FILTER (k IS NULL) AS added, count(*) FILTER (k IS NOT NULL) AS updated
        FROM (SELECT i.item_key, d.item_key AS k FROM {live_sql('item_key')} i LEFT JOIN (SELECT DISTINCT item_key FROM documents) d USING (item_key))""",
)
def a12(spark, d):
    known = table(spark, d, "documents").select("item_key").distinct()
    return index.upsert_counts(known, items(spark, d, "item_key").select("item_key"), "item_key")


@query("a13_label_counters", f"SELECT c AS collection_key, count(*) AS n FROM (SELECT unnest(collections) AS c FROM {live_sql('collections', 'item_type')} WHERE item_type = 'book') GROUP BY c")
def a13(spark, d):
    return items(spark, d, "collections", "item_type").filter("item_type = 'book'").select(F.explode("collections").alias("collection_key")).groupBy("collection_key").agg(F.count("*").alias("n"))


@query(
    "a14_best_of_each_doi",
    f"""SELECT d, item_id, item_type FROM (SELECT item_id, item_type, lower(trim(doi)) AS d FROM {live_sql('item_type', 'doi')}) WHERE d <> ''
        QUALIFY row_number() OVER (PARTITION BY d ORDER BY CASE item_type WHEN 'journalArticle' THEN 0 WHEN 'preprint' THEN 1 ELSE 2 END, item_id) = 1""",
)
def a14(spark, d):
    own = items(spark, d, "item_type", "doi").select(F.lower(F.trim("doi")).alias("d"), "item_id", "item_type").filter("d <> ''")
    rank = F.when(F.col("item_type") == "journalArticle", 0).when(F.col("item_type") == "preprint", 1).otherwise(2)
    return library.best_per_parent(own, "d", [rank, F.col("item_id")])


@query("a15_collections_of_type", f"SELECT item_type, list_sort(list_distinct(flatten(list(collections)))) AS collections FROM {live_sql('item_type', 'collections')} GROUP BY item_type")
def a15(spark, d):
    labels = items(spark, d, "item_type", "collections").select("item_type", F.explode_outer("collections").alias("c"))
    return labels.groupBy("item_type").agg(F.array_sort(F.collect_set("c")).alias("collections"))


@query("a16_child_counts", f"SELECT parent_item_id, count(*) AS n FROM {once_sql('item_attachments', 'item_id', 'parent_item_id')} WHERE parent_item_id IS NOT NULL GROUP BY parent_item_id")
def a16(spark, d):
    return once(spark, d, "item_attachments", "item_id", "parent_item_id").filter("parent_item_id is not null").groupBy("parent_item_id").agg(F.count("*").alias("n"))


@query(
    "a18_least_edges",
    """SELECT item_id, list_min(list_transform(r, lambda x: x[1])) AS min_x, list_min(list_transform(r, lambda x: x[2])) AS min_y
       FROM (SELECT DISTINCT item_id, CAST(json_extract(annotation_position, '$.rects') AS DOUBLE[][]) AS r FROM item_annotations) WHERE r IS NOT NULL""",
)
def a18(spark, d):
    rects = position(F.col("annotation_position"))["rects"]
    own = once(spark, d, "item_annotations", "item_id", "annotation_position").select("item_id", rects.alias("r")).filter("r is not null")
    return own.select("item_id", least_edge(F.col("r"), 0).alias("min_x"), least_edge(F.col("r"), 1).alias("min_y"))


@query("a19_vector_counts", "SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def a19(spark, d):
    return table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"))


@query(
    "a20_children_by_kind",
    f"""SELECT parent_item_id, list_sort(list(item_id) FILTER (kind = 'attachment')) AS attachments, list_sort(list(item_id) FILTER (kind = 'note')) AS notes FROM
        (SELECT parent_item_id, item_id, 'attachment' AS kind FROM {once_sql('item_attachments', 'item_id', 'parent_item_id')} UNION ALL SELECT parent_item_id, item_id, 'note' FROM {once_sql('item_notes', 'item_id', 'parent_item_id')})
        WHERE parent_item_id IS NOT NULL GROUP BY parent_item_id""",
)
def a20(spark, d):
    kinds = [once(spark, d, f"item_{k}s", "item_id", "parent_item_id").select("parent_item_id", "item_id", F.lit(k).alias("kind")) for k in ("attachment", "note")]
    both = kinds[0].unionByName(kinds[1]).filter("parent_item_id is not null")
    ids = lambda k: F.nullif(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("item_id")))), F.array().cast("array<long>"))
    return both.groupBy("parent_item_id").agg(ids("attachment").alias("attachments"), ids("note").alias("notes"))


@query("a21_names_by_initial", f"SELECT CASE WHEN coalesce(substr(collection_name, 1, 1), '') = '' THEN '#' ELSE upper(substr(collection_name, 1, 1)) END AS initial, count(*) AS n, min(collection_name) AS first_name FROM zotero_collections GROUP BY 1")
def a21(spark, d):
    return table(spark, d, "zotero_collections").groupBy(X.initial(F.col("collection_name")).alias("initial")).agg(F.count("*").alias("n"), F.min("collection_name").alias("first_name"))


# ---------------------------------------------------------------------------------------------- writes


@query(
    "snk1_upserted_index",
    f"""SELECT d.item_key, 'old' AS origin FROM (SELECT DISTINCT item_key FROM documents WHERE item_key IS NOT NULL) d WHERE d.item_key NOT IN (SELECT item_key FROM {live_sql('item_key', 'item_type')} WHERE item_type = 'book')
        UNION ALL SELECT item_key, 'new' FROM {live_sql('item_key', 'item_type')} WHERE item_type = 'book'""",
)
def snk1(spark, d):
    old = table(spark, d, "documents").filter("item_key is not null").select("item_key", F.lit("old").alias("origin")).distinct()
    new = items(spark, d, "item_key", "item_type").filter("item_type = 'book'").select("item_key", F.lit("new").alias("origin"))
    return index.upsert(old, new, "item_key")


@query("snk2_deleted_keys", f"SELECT DISTINCT doc_id FROM documents WHERE item_key IS NULL OR item_key NOT IN (SELECT item_key FROM {live_sql('item_key', 'item_type')} WHERE item_type = 'webpage')")
def snk2(spark, d):
    gone = items(spark, d, "item_key", "item_type").filter("item_type = 'webpage'")
    return index.delete_keys(table(spark, d, "documents").select("doc_id", "item_key").distinct(), gone, "item_key").select("doc_id").distinct()


@query("snk5_labels_edited", f"SELECT item_id, list_sort(list_filter(list_distinct(list_append(coalesce(collections, []), 'NEW')), lambda x: x <> 'C0LL0001')) AS collections FROM {live_sql('collections', 'item_type')} WHERE item_type = 'document'")
def snk5(spark, d):
    return items(spark, d, "collections", "item_type").filter("item_type = 'document'").select("item_id", library.set_edit("collections", ["NEW"], ["C0LL0001"]).alias("collections"))


@query(
    "snk6_field_changes",
    f"""SELECT item_id, 'title' AS field, title AS old, trim(title) || '!' AS new FROM {live_sql('title', 'item_type')} WHERE item_type = 'webpage' AND title IS DISTINCT FROM trim(title) || '!'
        UNION ALL SELECT item_id, 'doi', doi, lower(trim(doi)) FROM {live_sql('doi', 'item_type')} WHERE item_type = 'webpage' AND doi IS DISTINCT FROM lower(trim(doi))""",
)
def snk6(spark, d):
    own = items(spark, d, "title", "doi", "item_type").filter("item_type = 'webpage'")
    return library.field_changes(own, "item_id", {"title": F.concat(F.trim("title"), F.lit("!")), "doi": F.lower(F.trim("doi"))})


@query(
    "snk7_merged_groups",
    f"""WITH k AS (SELECT item_id, lower(trim(doi)) AS d, collections FROM {live_sql('doi', 'collections')} WHERE trim(coalesce(doi, '')) <> '')
        SELECT min(item_id) AS item_id, list_sort(list_distinct(flatten(list(coalesce(collections, []))))) AS collections, count(*) - 1 AS n_gone FROM k GROUP BY d HAVING count(*) > 1""",
)
def snk7(spark, d):
    own = items(spark, d, "doi", "collections").withColumn("d", F.lower(F.trim("doi"))).filter("d <> ''")
    heads = own.groupBy("d").agg(F.min("item_id").alias("item_id"), (F.count("*") - 1).alias("n_gone")).filter("n_gone > 0")
    labels = own.join(heads.select("d"), "d").select("d", F.explode_outer("collections").alias("c")).groupBy("d").agg(F.array_sort(F.collect_set("c")).alias("collections"))
    return heads.join(labels, "d").select("item_id", "collections", "n_gone")


@query(
    "snk7_moved_attachments",
    f"""WITH k AS (SELECT item_id, lower(trim(doi)) AS d FROM {live_sql('doi')} WHERE trim(coalesce(doi, '')) <> ''), g AS (SELECT item_id, min(item_id) OVER (PARTITION BY d) AS keeper FROM k),
        f AS (SELECT DISTINCT a.item_id, g.keeper, a.parent_item_id, coalesce(content_type, '') AS c, coalesce(filename, '') AS n, coalesce(md5, '') AS m, coalesce(title, '') AS t FROM item_attachments a JOIN g ON g.item_id = a.parent_item_id)
        SELECT min(item_id) AS item_id, keeper FROM f WHERE parent_item_id <> keeper AND NOT EXISTS (SELECT 1 FROM f o WHERE o.keeper = f.keeper AND o.parent_item_id = o.keeper AND o.c = f.c AND o.n = f.n AND o.m = f.m AND o.t = f.t)
        GROUP BY keeper, c, n, m, t""",
)
def snk7_moved(spark, d):
    own = items(spark, d, "doi").select("item_id", F.lower(F.trim("doi")).alias("d")).filter("d <> ''")
    keepers = own.groupBy("d").agg(F.min("item_id").alias("keeper"))
    group = own.join(keepers, "d").select(F.col("item_id").alias("parent_item_id"), "keeper")
    sign = [F.coalesce(c, F.lit("")).alias(a) for c, a in zip(("content_type", "filename", "md5", "title"), "cnmt")]
    files = once(spark, d, "item_attachments", "item_id", "parent_item_id", "content_type", "filename", "md5", "title").join(group, "parent_item_id").select("item_id", "keeper", "parent_item_id", *sign)
    key = ["keeper", "c", "n", "m", "t"]
    moving = files.filter("parent_item_id <> keeper").join(files.filter("parent_item_id = keeper").select(*key).distinct(), key, "left_anti")
    return moving.groupBy(*key).agg(F.min("item_id").alias("item_id")).select("item_id", "keeper")


@query("snk8_memberships", f"SELECT item_id, list_sort(list_distinct(list_concat(coalesce(collections, []), ['C0LL0039', 'C0LL0040']))) AS collections FROM {live_sql('collections')}")
def snk8(spark, d):
    return items(spark, d, "collections").select("item_id", library.set_edit("collections", ["C0LL0039", "C0LL0040"], []).alias("collections"))


@query("snk10_notes_appended", f"SELECT item_id, note || '<p>Seen.</p>' AS note FROM {once_sql('item_notes', 'item_id', 'note')}")
def snk10(spark, d):
    return once(spark, d, "item_notes", "item_id", "note").select("item_id", F.concat("note", F.lit("<p>Seen.</p>")).alias("note"))


@query("snk11_soft_deletes", "SELECT deleted, count(*) AS n FROM (SELECT DISTINCT item_id, coalesce(deleted, false) OR item_type = 'webpage' AS deleted FROM zotero_items) GROUP BY deleted")
def snk11(spark, d):
    flag = F.coalesce("deleted", F.lit(False)) | (F.col("item_type") == "webpage")
    return table(spark, d, "zotero_items").select("item_id", flag.alias("deleted")).distinct().groupBy("deleted").agg(F.count("*").alias("n"))


@query(
    "snk13_refresh_decisions",
    f"""SELECT i.item_key AS key, CASE WHEN s.state IS NULL THEN 'extract' WHEN s.state = 'failed' AND i.date_modified IS NOT DISTINCT FROM s.m THEN 'skip' WHEN s.state = 'failed' THEN 'retry'
          WHEN s.state = 'none' AND a.p IS NOT NULL THEN 'update' ELSE 'skip' END AS decision
        FROM {live_sql('item_key', 'date_modified')} i
        LEFT JOIN (SELECT DISTINCT item_id, date_modified AS m, CASE WHEN length(fulltext) > 0 THEN 'ok' WHEN fulltext_source IS NOT NULL THEN 'failed' ELSE 'none' END AS state FROM zotero_items WHERE NOT coalesce(deleted, false) AND library_id = 1) s USING (item_id)
        LEFT JOIN (SELECT DISTINCT parent_item_id AS p FROM item_attachments) a ON a.p = i.item_id""",
)
def snk13(spark, d):
    own = table(spark, d, "zotero_items").filter(live(F.col("deleted")))
    files = table(spark, d, "item_attachments").select(F.col("parent_item_id").alias("p")).distinct()
    current = items(spark, d, "item_key", "date_modified").join(files, F.col("item_id") == F.col("p"), "left").select(F.col("item_key").alias("key"), "date_modified", F.col("p").isNotNull().alias("has_file"))
    stored = own.filter("library_id = 1").select(F.col("item_key").alias("key"), F.col("date_modified").alias("indexed_modified"), index.fulltext_state(F.col("fulltext"), F.col("fulltext_source")).alias("state")).distinct()
    return index.refresh_decisions(current, stored)
