import os

import pytest
from pyspark.sql import functions as F

from foliant.api import Library
from foliant.functions import text
from foliant.sources import files

FOLDER = os.environ.get("FOLIANT_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def lib(spark):
    return Library(spark, FOLDER)


def test_search(lib):
    first = lib.items("item_key", "title", "extra").filter("title is not null and extra is not null").orderBy("item_id").first()
    found = lib.search_items(first.title.split()[0], limit=500)
    assert found.filter(f"item_id = {first.item_id}").count() == 1 and {r.strategy for r in found.collect()} == {"words"}
    key = first.extra.split(": ")[1]
    assert lib.search_by_citation_key(key).filter(f"item_id = {first.item_id}").count() == 1
    assert lib.advanced_search([{"field": "itemType", "operation": "is", "value": "book"}], sort_by="title", descending=True).count() > 0
    ranked = lib.semantic_search(first.title, limit=3).collect()
    assert ranked[0].title == first.title and ranked[0].score >= ranked[-1].score
    assert lib.semantic_search("x", filters={"itemType": "book"}).filter("item_type <> 'book'").isEmpty()
    assert lib.search_collections("a").count() >= 0 and lib.connector_search("dunes").first().results.startswith("[")


def test_retrieval(lib):
    key = lib.items("item_key").orderBy("item_id").first().item_key
    assert lib.get_item_metadata(key).count() == 1 and "abstract" not in lib.get_item_metadata(key, False).columns
    assert lib.get_bibtex(key).first().bibtex.startswith("@") and lib.get_item_fulltext(key).count() == 1
    assert lib.connector_fetch(key).first().document.startswith("{")
    paths = lib.get_collections().collect()
    assert len(paths) == 40
    collection = lib.items("collections").selectExpr("explode(collections) c").groupBy("c").count().orderBy("count", ascending=False).first().c
    for detail, n in (("keys_only", 1), ("summary", 5), ("full", 13)):
        assert len(lib.get_collection_items(collection, detail).columns) == n
    with pytest.raises(ValueError):
        lib.get_collection_items(collection, "some")
    assert lib.search_by_tag([collection]).count() > 0 and lib.get_tags().count() > 0 and lib.list_libraries().count() > 0 and lib.list_feeds().count() > 0
    assert lib.get_feed_items(limit=3).count() == 3 and lib.get_recent(5).count() == 5
    parent = lib.get_annotations().filter("work_key is not null").first().work_key
    assert lib.get_annotations(parent).count() > 0 and lib.get_items_children([parent]).count() > 0 and lib.get_item_children(parent).count() > 0
    note = lib.get_notes().filter("parent_key is not null").first()
    assert "<" not in note.text and lib.get_notes(note.parent_key).count() > 0
    assert lib.search_notes(note.text.split()[0]).filter(f"item_id = {note.item_id}").count() == 1
    one = lib.switch_library(1)
    assert one.items("library_id").filter("library_id <> 1").isEmpty()


def test_index(lib):
    stored, counts = lib.update_search_database()
    n = counts.first()
    assert n.added == n.processed and n.updated == 0
    again, counts = lib.update_search_database(stored.limit(5))
    assert counts.first().updated == 5 and lib.get_search_database_status(again).first().n_items == n.processed


def test_changes(spark, lib, tmp_path):
    assert lib.create_note(1, "T & t", "one\n\ntwo", 99, "NEW").filter("item_key = 'NEW'").first().note == "<h1>T &amp; t</h1><p>one</p><p>two</p>"
    key = lib.table("item_notes").first().item_key
    assert lib.update_note(key, "<p>x</p>", append=True).filter(f"item_key = '{key}'").first().note.endswith("<p>x</p>")
    assert lib.delete_note(key).filter("deleted").count() >= 1
    (tmp_path / "lib").mkdir()
    for name in os.listdir(FOLDER):
        os.symlink(f"{FOLDER}/{name}", tmp_path / "lib" / name)
    (tmp_path / "lib" / "item_notes.parquet").unlink()
    Library.put(lib.delete_note(key), str(tmp_path / "lib"), "item_notes")
    assert lib.get_notes().filter(f"item_key = '{key}'").count() > 0 and Library(spark, str(tmp_path / "lib")).get_notes().filter(f"item_key = '{key}'").isEmpty()
    page = spark.createDataFrame([("Some words before the quick brown fox here.",)], "text string")
    mark = lib.create_annotation(5, 3, "the quick  brown fox", page).first()
    assert mark.annotation_sort_index == "00002|00000018" and lib.create_annotation(5, 3, "wholly unlike anything there is", page).count() == 0
    areas = spark.createDataFrame([(0.1, 0.2, 0.3, 0.4, 600.0, 800.0), (0.9, 0.1, 0.2, 0.1, 600.0, 800.0)], "x double, y double, width double, height double, page_width double, page_height double")
    assert [r.annotation_sort_index for r in lib.create_area_annotation(5, 1, areas).collect()] == ["00000|000320|00060"]
    item = lib.items("item_key", "title", "collections").filter("title is not null").orderBy("item_id").first()
    changed, counts = lib.batch_update_tags(item.title.split()[0], add="fresh")
    assert {(r.tag, r.what) for r in counts.collect()} == {("fresh", "added")} and counts.first().n == changed.count()
    assert "fresh" in lib.manage_collections([item.item_key], add=["fresh"]).first().collections
    name = lib.table("zotero_collections").first().collection_name
    assert lib.create_collection("K", "New", name.upper()).filter("collection_key = 'K'").first().parent_collection
    with pytest.raises(ValueError):
        lib.create_collection("K", "New", "no such parent")
    row, diff = lib.update_item(item.item_key, title="Other")
    assert row.first().title == "Other" and [(d.field, d.new) for d in diff.collect()] == [("title", "Other")]
    with pytest.raises(ValueError):
        lib.update_item(item.item_key, nonsense=1)
    assert lib.find_duplicates("doi").columns == ["group_key", "n_items", "first_item_id"]
    kept, moving, gone = lib.merge_duplicates(1, [2])
    assert kept.count() == 1 and moving.count() >= 0 and gone.count() <= 1
    Library.put(lib.table("zotero_collections"), str(tmp_path), "zotero_collections")
    assert spark.read.parquet(f"{tmp_path}/zotero_collections.parquet").count() == 40


def test_outer_sources(spark, lib, tmp_path):
    (tmp_path / "m.json").write_text('{"type": "book", "title": ["T"], "DOI": "10.1234/AB"}')
    assert lib.add_by_doi("https://doi.org/10.1234/ab", str(tmp_path / "m.json")).first().title == "T"
    urls = spark.createDataFrame([("https://doi.org/10.1234/x",), ("https://arxiv.org/abs/2101.00001",), ("https://a.b/c",)], "url string")
    assert [r.kind for r in lib.add_by_url(urls).collect()] == ["doi", "arxiv", "webpage"]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("See 10.1234/abc. for more")
    assert lib.add_from_files(str(tmp_path / "d")).first().doi == "10.1234/abc"
    pdf = b"1 0 obj << /Type /Catalog /Outlines 2 0 R >> endobj 2 0 obj << /First 3 0 R >> endobj 3 0 obj << /Title (One) /Next 5 0 R /First 4 0 R >> endobj 4 0 obj << /Title (One \\(a\\)) >> endobj 5 0 obj << /Title (Two) >> endobj"
    (tmp_path / "d" / "o.pdf").write_bytes(pdf)
    assert [(r.level, r.title) for r in lib.get_pdf_outline(str(tmp_path / "d")).orderBy("no").collect()] == [(1, "One"), (2, "One (a)"), (1, "Two")]
    assert files.html_markdown("<h2>Head</h2><ul><li>a <b>b</b></li></ul>") == "## Head\n- a **b**"
    doi = lib.items("doi").selectExpr("doi").filter("doi like '10.99%' and doi not like '%.'").first().doi
    tallies = spark.createDataFrame([(f"doi:{doi}", 3, 1, 9, ["expression_of_concern"])], "doi string, supporting int, contrasting int, mentioning int, notices array<string>")
    assert lib.enrich(tallies).filter("tally is not null").first().tally == "3 supporting, 1 contrasting, 9 mentioning"
    assert lib.check_retractions(tallies).first().notices == ["Expression Of Concern"] and lib.enrich_search("the", tallies).count() > 0
    names = spark.createDataFrame([("Ann B. Kern",)], "n string").select(text.split_name(F.col("n")).alias("s")).first().s
    assert (names.first_name, names.last_name) == ("Ann B.", "Kern")
