"""Predicates, sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.functions.geometry import area_is_valid, position
from foliant.operators import search
from foliant.operators.library import CHILD_TYPES, items, once
from foliant.plans.registry import live_sql, once_sql, query
from foliant.session import table

FIELDS = ("item_key", "item_type", "title", "abstract", "creators", "doi", "date_added", "date_modified", "version", "collections")
FROM = live_sql(*FIELDS)
FOLD = "lower(strip_accents(coalesce({}, '')))".format


def _advanced(name: str, conditions: list[dict], where: str, mode: str = "all") -> None:
    @query(name, f"SELECT item_id, title FROM {FROM} WHERE {where}")
    def run(spark, d):
        return search.advanced_search(items(spark, d, *FIELDS), conditions, mode).select("item_id", "title")


def _c(field, operation, value):
    return {"field": field, "operation": operation, "value": value}


_advanced("f3a_is", [_c("itemType", "is", "BOOK")], "lower(item_type) = 'book'")
_advanced("f3b_is_not", [_c("itemType", "isNot", "journalArticle")], "lower(coalesce(item_type, '')) <> 'journalarticle'")
_advanced("f3c_contains", [_c("title", "contains", "Erosion")], f"contains({FOLD('title')}, 'erosion')")
_advanced("f3d_contains_not", [_c("title", "doesNotContain", "the")], f"NOT contains({FOLD('title')}, 'the')")
_advanced("f3e_begins", [_c("title", "beginsWith", "a note")], f"starts_with({FOLD('trim(title)')}, 'a note')")
_advanced("f3f_ends", [_c("title", "endsWith", "revisited")], f"ends_with({FOLD('trim(title)')}, 'revisited')")
_advanced("f3g_greater_number", [_c("version", "isGreaterThan", "300")], "version > 300")
_advanced("f3h_less_number", [_c("version", "isLessThan", "50")], "version < 50")
_advanced("f3i_after_date", [_c("dateAdded", "isAfter", "2022-01-01")], "coalesce(date_added, '') > '2022-01-01'")
_advanced("f3j_before_date", [_c("dateAdded", "isBefore", "2020-01-01")], "coalesce(date_added, '') < '2020-01-01'")
_advanced("f3k_some_value", [_c("collection", "is", "C0LL0002")], "list_contains(collections, 'C0LL0002')")
_advanced("f3l_every_value", [_c("collection", "isNot", "C0LL0002")], "len(collections) > 0 AND NOT list_contains(collections, 'C0LL0002')")
_advanced(
    "f3m_creator", [_c("creator", "beginsWith", "Helena ")],
    "len(list_filter(string_split(coalesce(creators, ''), ';'), lambda x: starts_with(lower(strip_accents(trim(split_part(trim(x), ',', 2)) || ' ' || trim(split_part(trim(x), ',', 1)))), 'helena '))) > 0",
)
_advanced("f3n_year", [_c("year", "is", "2021")], "substr(date_added, 1, 4) = '2021'")
_advanced(
    "f3o_all_of", [_c("itemType", "is", "book"), _c("title", "contains", "dunes"), _c("year", "isGreaterThan", "2019")],
    f"item_type = 'book' AND contains({FOLD('title')}, 'dunes') AND TRY_CAST(substr(date_added, 1, 4) AS DOUBLE) > 2019",
)
_advanced(
    "f3p_any_of", [_c("itemType", "is", "webpage"), _c("title", "contains", "eels")], f"item_type = 'webpage' OR contains({FOLD('title')}, 'eels')", "any"
)


@query("f1_no_child_types", f"SELECT item_type, count(*) AS n FROM {FROM} WHERE item_type NOT IN ('attachment', 'note', 'annotation') GROUP BY item_type")
def f1(spark, d):
    return items(spark, d, "item_type").filter(~F.col("item_type").isin(*CHILD_TYPES)).groupBy("item_type").agg(F.count("*").alias("n"))


@query("f2_not_trashed", "SELECT DISTINCT item_id FROM zotero_items WHERE item_id NOT IN (SELECT item_id FROM zotero_items WHERE deleted)")
def f2(spark, d):
    all_items = table(spark, d, "zotero_items").select("item_id", "deleted")
    return all_items.select("item_id").distinct().join(all_items.filter("deleted").select("item_id"), "item_id", "left_anti")


@query("f4_collection_terms", f"SELECT item_id FROM {FROM} WHERE (list_contains(collections, 'C0LL0001') OR list_contains(collections, 'C0LL0003') OR list_contains(collections, 'C0LL0005')) AND NOT coalesce(list_contains(collections, 'C0LL0002'), false)")
def f4(spark, d):
    return items(spark, d, "collections").filter(search.set_terms("collections", ["C0LL0001 || C0LL0003 OR C0LL0005", "-C0LL0002"])).select("item_id")


@query("f5_keywords", f"SELECT item_id FROM {FROM} WHERE contains(lower(strip_accents(concat_ws(' ', title, creators, substr(date_added, 1, 4)))), 'migration') AND contains(lower(strip_accents(concat_ws(' ', title, creators, substr(date_added, 1, 4)))), '2021')")
def f5(spark, d):
    own = items(spark, d, "title", "creators", "date_added").withColumn("year", X.year(F.col("date_added")))
    return own.filter(search.keyword(["title", "creators", "year"], "Migration 2021")).select("item_id")


@query("f6_text_search", "SELECT DISTINCT item_id FROM zotero_items WHERE NOT coalesce(deleted, false) AND contains(lower(strip_accents(concat_ws(' ', title, abstract, fulltext))), 'pollen counting')")
def f6(spark, d):
    from foliant.functions.fields import live

    own = table(spark, d, "zotero_items").filter(live(F.col("deleted")) & search.keyword(["title", "abstract", "fulltext"], "pollen") & X.search_key(F.concat_ws(" ", "title", "abstract", "fulltext")).contains("pollen counting"))
    return own.select("item_id").distinct()


@query("f7_note_search", "SELECT DISTINCT item_id, parent_item_id FROM item_notes WHERE contains(lower(regexp_replace(note, '<[^>]+>', '', 'g')), 'lagoons')")
def f7(spark, d):
    return once(spark, d, "item_notes", "item_id", "parent_item_id", "note").filter(F.lower(X.note_text(F.col("note"))).contains("lagoons")).select("item_id", "parent_item_id")


@query("f8_annotation_search", "SELECT DISTINCT item_id FROM item_annotations WHERE annotation_text ILIKE '%sediment%' OR annotation_comment ILIKE '%sediment%'")
def f8(spark, d):
    return once(spark, d, "item_annotations", "item_id", "annotation_text", "annotation_comment").filter(F.col("annotation_text").ilike("%sediment%") | F.col("annotation_comment").ilike("%sediment%")).select("item_id")


@query("f9_joined_text_search", "SELECT DISTINCT item_id FROM item_annotations WHERE contains(lower(coalesce(annotation_text, '') || ' ' || coalesce(annotation_comment, '')), 'kilns')")
def f9(spark, d):
    both = F.lower(F.concat_ws(" ", F.coalesce("annotation_text", F.lit("")), F.coalesce("annotation_comment", F.lit(""))))
    return once(spark, d, "item_annotations", "item_id", "annotation_text", "annotation_comment").filter(both.contains("kilns")).select("item_id")


@query("f10_collection_words", "SELECT collection_key, collection_name FROM zotero_collections WHERE contains(lower(collection_name), 'a') AND contains(lower(collection_name), 'be')")
def f10(spark, d):
    words = F.split(F.lit("a be"), " ")
    return table(spark, d, "zotero_collections").filter(F.forall(words, lambda w: F.lower("collection_name").contains(w))).select("collection_key", "collection_name")


@query("f11_collection_by_name", "SELECT w.wanted, c.collection_key FROM (SELECT 'robust taxation' AS wanted UNION ALL SELECT 'SEASONAL BELLS' UNION ALL SELECT 'absent') w LEFT JOIN zotero_collections c ON lower(c.collection_name) = lower(w.wanted)")
def f11(spark, d):
    wanted = spark.createDataFrame([("robust taxation",), ("SEASONAL BELLS",), ("absent",)], "wanted string")
    names = table(spark, d, "zotero_collections").select("collection_key", F.lower("collection_name").alias("_n"))
    return F.broadcast(wanted).join(names, F.lower("wanted") == F.col("_n"), "left").select("wanted", "collection_key")


@query("f12_citation_key", f"SELECT item_id, citation_key FROM (SELECT item_id, trim(regexp_extract(coalesce(extra, ''), '(?im)^citation ?key:(.*)$', 1)) AS citation_key FROM {live_sql('extra')}) WHERE citation_key <> ''")
def f12(spark, d):
    return items(spark, d, "extra").select("item_id", X.citation_key(F.col("extra")).alias("citation_key")).filter("citation_key <> ''")


@query("f14_content_filter", "SELECT DISTINCT doc_id FROM documents WHERE contains(text, 'drainage') AND NOT contains(text, 'erosion')")
def f14(spark, d):
    return table(spark, d, "documents").filter(F.col("text").contains("drainage") & ~F.col("text").contains("erosion")).select("doc_id").distinct()


@query("f15_browse", f"SELECT item_id, title FROM (SELECT item_id, title, creators FROM {live_sql('title', 'creators')} ORDER BY item_id LIMIT 500) WHERE contains(lower(coalesce(title, '')), 'memory') OR contains(lower(coalesce(creators, '')), 'memory')")
def f15(spark, d):
    shown = items(spark, d, "title", "creators").orderBy("item_id").limit(500)
    return shown.filter(F.lower(F.coalesce("title", F.lit(""))).contains("memory") | F.lower(F.coalesce("creators", F.lit(""))).contains("memory")).select("item_id", "title")


@query("f17_annotatable", f"SELECT content_type, count(*) AS n FROM {once_sql('item_attachments', 'item_id', 'content_type')} WHERE content_type IN ('application/pdf', 'application/epub+zip', 'text/html') GROUP BY content_type")
def f17(spark, d):
    return once(spark, d, "item_attachments", "item_id", "content_type").filter(F.col("content_type").isin("application/pdf", "application/epub+zip", "text/html")).groupBy("content_type").agg(F.count("*").alias("n"))


@query("f18_filled_annotations", "SELECT DISTINCT item_id FROM item_annotations WHERE length(annotation_text) > 0 OR length(annotation_comment) > 0")
def f18(spark, d):
    return once(spark, d, "item_annotations", "item_id", "annotation_text", "annotation_comment").filter((F.length("annotation_text") > 0) | (F.length("annotation_comment") > 0)).select("item_id")


AREA_SQL = """
    SELECT item_id, r[1] / 600 AS x, r[2] / 800 AS y, (r[3] - r[1]) / 600 AS w, (r[4] - r[2]) / 800 AS h
    FROM (SELECT DISTINCT item_id, CAST(json_extract(annotation_position, '$.rects[0]') AS DOUBLE[]) AS r FROM item_annotations) WHERE r IS NOT NULL
"""


def areas(spark, d):
    rect = position(F.col("annotation_position"))["rects"][0]
    got = once(spark, d, "item_annotations", "item_id", "annotation_position").select("item_id", rect.alias("r")).filter("r is not null")
    return got.select("item_id", (F.col("r")[0] / 600).alias("x"), (F.col("r")[1] / 800).alias("y"), ((F.col("r")[2] - F.col("r")[0]) / 600).alias("w"), ((F.col("r")[3] - F.col("r")[1]) / 800).alias("h"))


@query("f19_valid_areas", f"SELECT item_id, x >= 0 AND y >= 0 AND w > 0 AND w <= 1 AND h > 0 AND h <= 1 AND x + w <= 1 AND y + h <= 1 AS valid FROM ({AREA_SQL})")
def f19(spark, d):
    return areas(spark, d).select("item_id", area_is_valid(*map(F.col, "xywh")).alias("valid"))


# ------------------------------------------------------------------------------------- sorts and limits


@query("s1_latest_modified", f"SELECT item_id, date_modified FROM {live_sql('date_modified')} WHERE date_modified IS NOT NULL ORDER BY date_modified DESC, item_id LIMIT 25")
def s1(spark, d):
    return items(spark, d, "date_modified").filter("date_modified is not null").orderBy(F.desc("date_modified"), "item_id").limit(25)


@query("s2_recent", f"SELECT item_id, date_added FROM {live_sql('date_added')} ORDER BY date_added DESC NULLS LAST, item_id LIMIT 10")
def s2(spark, d):
    return items(spark, d, "date_added").orderBy(F.desc_nulls_last("date_added"), "item_id").limit(10)


@query("s4_sorted_search", f"SELECT item_id, title FROM {live_sql('title', 'item_type')} WHERE item_type = 'book' ORDER BY lower(coalesce(title, '')) DESC, item_id LIMIT 50")
def s4(spark, d):
    found = search.advanced_search(items(spark, d, "title", "item_type"), [_c("itemType", "is", "book")])
    return found.orderBy(F.desc(F.lower(F.coalesce("title", F.lit("")))), "item_id").limit(50).select("item_id", "title")


@query("s5_library_order", f"SELECT library_id, count(*) AS n FROM {live_sql('library_id')} GROUP BY library_id ORDER BY library_id")
def s5(spark, d):
    return items(spark, d, "library_id").groupBy("library_id").agg(F.count("*").alias("n")).orderBy("library_id")


@query("s6_latest_feed_items", "SELECT doc_id, ingested_at FROM documents WHERE source = 'feed_item' ORDER BY ingested_at DESC, doc_id LIMIT 20")
def s6(spark, d):
    return table(spark, d, "documents").filter("source = 'feed_item'").select("doc_id", "ingested_at").orderBy(F.desc("ingested_at"), "doc_id").limit(20)


@query("s7_labels_in_order", f"SELECT DISTINCT c AS collection FROM (SELECT unnest(collections) AS c FROM {live_sql('collections')}) ORDER BY c LIMIT 30")
def s7(spark, d):
    return items(spark, d, "collections").select(F.explode("collections").alias("collection")).distinct().orderBy("collection").limit(30)


@query("s13_shown_of_all", f"SELECT item_id, count(*) OVER () AS n_all FROM {live_sql('item_type')} WHERE item_type = 'webpage' ORDER BY item_id LIMIT 40")
def s13(spark, d):
    own = items(spark, d, "item_type").filter("item_type = 'webpage'")
    total = own.agg(F.count("*").alias("n_all"))
    return own.orderBy("item_id").limit(40).select("item_id").crossJoin(F.broadcast(total))


# -------------------------------------------------------------------------------------- set operations


@query(
    "u1_variant_union",
    f"""SELECT item_id, CASE WHEN contains(lower(creators), 'jürgen') THEN 0 WHEN contains(lower(creators), 'jurgen') THEN 1 ELSE 2 END AS variant FROM {live_sql('creators')}
        WHERE contains(lower(creators), 'jürgen') OR contains(lower(creators), 'jurgen') OR contains(lower(creators), 'juergen')""",
)
def u1(spark, d):
    return search.with_variants(items(spark, d, "creators"), ["creators"], "Jürgen", "item_id").select("item_id", "variant")


@query(
    "u3_notes_and_annotations",
    """SELECT 'note' AS kind, item_id, note AS text FROM (SELECT DISTINCT item_id, note FROM item_notes) WHERE contains(lower(note), 'bells')
       UNION ALL SELECT 'annotation', item_id, annotation_text FROM (SELECT DISTINCT item_id, annotation_text FROM item_annotations) WHERE contains(lower(annotation_text), 'bells')""",
)
def u3(spark, d):
    notes = once(spark, d, "item_notes", "item_id", "note").select(F.lit("note").alias("kind"), "item_id", F.col("note").alias("text"))
    marks = once(spark, d, "item_annotations", "item_id", "annotation_text").select(F.lit("annotation").alias("kind"), "item_id", F.col("annotation_text").alias("text"))
    return notes.unionByName(marks).filter(F.lower("text").contains("bells"))


@query("u4_new_collections", f"SELECT item_id, list_sort(list_filter(['C0LL0001', 'C0LL0002', 'C0LL0003'], lambda x: NOT list_contains(collections, x))) AS missing FROM {live_sql('collections')} WHERE len(collections) > 0")
def u4(spark, d):
    wanted = F.array(*[F.lit(f"C0LL000{k}") for k in (1, 2, 3)])
    return items(spark, d, "collections").filter("size(collections) > 0").select("item_id", F.array_sort(F.array_except(wanted, "collections")).alias("missing"))


@query("u5_common_keys", "SELECT DISTINCT item_id FROM zotero_items INTERSECT SELECT DISTINCT parent_item_id FROM item_attachments")
def u5(spark, d):
    return table(spark, d, "zotero_items").select("item_id").intersect(table(spark, d, "item_attachments").select(F.col("parent_item_id").alias("item_id")))


@query("u6_annotations_once", "SELECT item_key, min(item_id) AS item_id FROM item_annotations GROUP BY item_key")
def u6(spark, d):
    return table(spark, d, "item_annotations").groupBy("item_key").agg(F.min("item_id").alias("item_id"))


@query(
    "u7_first_strategy",
    f"""WITH s AS (SELECT item_id, CASE WHEN lower(title) = 'no such title' THEN 0 WHEN contains(lower(title), 'cartography') THEN 1 WHEN contains(lower(abstract), 'cartography') THEN 2 END AS k FROM {live_sql('title', 'abstract')})
        SELECT item_id, ['exact', 'title', 'everything'][k + 1] AS strategy FROM s WHERE k = (SELECT min(k) FROM s)""",
)
def u7(spark, d):
    own = items(spark, d, "title", "abstract")
    steps = [("exact", F.lower("title") == "no such title"), ("title", F.lower("title").contains("cartography")), ("everything", F.lower("abstract").contains("cartography"))]
    return search.cascade(own, steps).select("item_id", "strategy")
