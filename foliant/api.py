"""The library as one object: the questions people ask of it, each a DataFrame, and changes as new states of its tables.

Changes are pure: a method that edits returns the changed table (or a preview) and writes nothing. ``put`` writes a table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.functions.fields import live
from foliant.functions.geometry import area_is_valid, area_rect, position, sort_index
from foliant.operators import fuzzy, index, library, search
from foliant.session import cut_lineage, table
from foliant.sources import files, messages

SHOWN = ("item_id", "item_key", "item_type", "title", "creators", "date_added", "abstract", "collections", "doi", "extra", "date_modified", "library_id")


@dataclass(frozen=True)
class Library:
    spark: SparkSession
    folder: str
    library_id: int | None = None

    # ------------------------------------------------------------------------------------------ tables

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    def items(self, *columns: str) -> DataFrame:
        own = library.items(self.spark, self.folder, *(columns or SHOWN), "library_id")
        own = own if self.library_id is None else own.filter(F.col("library_id") == self.library_id)
        return own if "library_id" in (columns or SHOWN) else own.drop("library_id")

    def switch_library(self, library_id: int | None) -> Library:
        return replace(self, library_id=library_id)

    # ------------------------------------------------------------------------------------------ search

    def search_items(self, query: str, everything: bool = False, item_type: str | None = None, terms=None, collection: str | None = None, limit=10) -> DataFrame:
        """Keyword search by steps: the words in title, creators and year; spellings of the query; everything, full text too."""
        columns = [*SHOWN, "fulltext"] if everything else list(SHOWN)
        own = self.items(*columns).withColumn("year", X.year(F.col("date_added")))
        if item_type:
            wanted = F.col("item_type") == item_type.lstrip("-")
            own = own.filter(~wanted if item_type.startswith("-") else wanted)
        if terms:
            own = own.filter(search.set_terms("collections", X.list_argument(terms)))
        if collection:
            own = own.filter(F.array_contains("collections", collection))
        main, wide = ["title", "creators", "year"], ["title", "creators", "year", "abstract", *(["fulltext"] if everything else [])]
        spelt = F.lower(F.concat_ws(" ", *main))
        any_spelling = F.lit(False)
        for v in X.search_variants(query):
            any_spelling = any_spelling | spelt.contains(v.lower())
        steps = [("words", search.keyword(main, query)), ("spelling", any_spelling), ("everything", search.keyword(wide, query))]
        return search.cascade(own, steps).drop("fulltext").orderBy("item_id").limit(X.limit_argument(limit, 10))

    def search_by_tag(self, terms, item_type: str | None = None, limit=10) -> DataFrame:
        own = self.items().filter(search.set_terms("collections", X.list_argument(terms)))
        return (own.filter(F.col("item_type") == item_type) if item_type else own).orderBy("item_id").limit(X.limit_argument(limit, 10))

    def search_by_citation_key(self, key: str) -> DataFrame:
        return self.items().filter(X.citation_key(F.col("extra")) == key)

    def advanced_search(self, conditions, join_mode: str = "all", sort_by: str | None = None, descending: bool = False, limit=50) -> DataFrame:
        found = search.advanced_search(self.items(*SHOWN, "version"), conditions, join_mode)
        if sort_by:
            value = F.coalesce(F.col(sort_by) if sort_by == "creators" else F.lower(F.col(sort_by).cast("string")), F.lit(""))
            found = found.orderBy(value.desc() if descending else value.asc(), "item_id")
        else:
            found = found.orderBy("item_id")
        return found.limit(X.limit_argument(limit, 50))

    def semantic_search(self, query: str, limit=10, filters: dict | None = None, overfetch: int = 3, stored: DataFrame | None = None, embedder=None, scorer=None) -> DataFrame:
        """Nearest texts by vectors, re-ranked; filters are equalities on item columns.

        ``stored`` is an index made by ``update_search_database`` (item_key, text, embedding); without one the texts of all items
        are embedded now. ``embedder`` must be the one the index was made with. ``scorer`` scores (query, text) pairs in place
        of shared words.
        """
        k = X.limit_argument(limit, 10)
        own = self.items()
        for field, value in (filters or {}).items():
            own = own.filter(F.col(search.ALIASES.get(field.lower(), field)) == value)
        if stored is None:
            text = index.document_text(F.col("title"), F.col("creators"), F.col("abstract"), F.lit(None).cast("string"))
            known = own.withColumn("text", text).withColumn("embedding", index.embedding(F.col("text"), embedder))
        else:
            known = own.join(stored.select("item_key", "text", "embedding"), "item_key")
        asked = self.spark.range(1).select(F.lit(0).cast("long").alias("query_id"), index.embedding(F.lit(query), embedder, query=True).alias("embedding"))
        found = index.nearest(asked, known.select(F.col("item_id").alias("vec_id"), "embedding"), k * overfetch)
        near = known.drop("embedding").join(F.broadcast(found.select(F.col("vec_id").alias("item_id"), "distance")), "item_id")
        score = index.overlap_score(F.lit(query), F.col("text")) if scorer is None else index.model_score(F.lit(query), F.col("text"), scorer)
        return index.reranked(near, score, k, ["distance", "item_id"]).drop("text")

    def search_notes(self, query: str, limit=20) -> DataFrame:
        """Notes and annotations that hold the query, with a snippet and the title of the work."""
        notes = self.get_notes().select(F.lit("note").alias("kind"), "item_id", "parent_title", "text")
        marks = self.get_annotations().select(F.lit("annotation").alias("kind"), "item_id", F.col("work_title").alias("parent_title"), F.concat_ws(" ", "annotation_text", "annotation_comment").alias("text"))
        found = notes.unionByName(marks).filter(F.lower("text").contains(query.lower()))
        return found.withColumn("snippet", X.snippet(F.col("text"), query)).orderBy("kind", "item_id").limit(X.limit_argument(limit, 20))

    def search_collections(self, query: str) -> DataFrame:
        words = [w for w in query.lower().split() if w]
        own = self.table("zotero_collections")
        for w in words:
            own = own.filter(F.lower("collection_name").contains(w))
        parents = self.table("zotero_collections").select(F.col("collection_key").alias("parent_collection"), F.col("collection_name").alias("parent_name"))
        return own.join(parents, "parent_collection", "left")

    # --------------------------------------------------------------------------------------- retrieval

    def get_item_metadata(self, item_key: str, include_abstract: bool = True) -> DataFrame:
        own = self.items().filter(F.col("item_key") == item_key)
        return own if include_abstract else own.drop("abstract")

    def get_bibtex(self, item_key: str) -> DataFrame:
        fields = ("item_key", "item_type", "title", "creators", "date_added", "doi")
        return self.items(*fields).filter(F.col("item_key") == item_key).select("item_key", X.bibtex(*map(F.col, fields)).alias("bibtex"))

    def get_item_fulltext(self, item_key: str) -> DataFrame:
        """The stored full text, else the abstract, with the best attachment to read it from."""
        own = self.items("item_key", "fulltext", "abstract").filter(F.col("item_key") == item_key)
        text = F.coalesce(F.when(F.length("fulltext") > 0, F.col("fulltext")), F.col("abstract"))
        best = self.best_attachments().select(F.col("parent_item_id").alias("item_id"), "attachment_path")
        return own.join(best, "item_id", "left").select("item_key", text.alias("text"), "attachment_path")

    def best_attachments(self) -> DataFrame:
        own = library.once(self.spark, self.folder, "item_attachments", "item_id", "item_key", "parent_item_id", "content_type", "filename", "attachment_path").filter("parent_item_id is not null")
        return library.best_per_parent(own, "parent_item_id", [library.attachment_rank(F.col("content_type")), F.col("item_id")])

    def get_collections(self) -> DataFrame:
        return library.collection_paths(self.table("zotero_collections")).orderBy("path")

    def get_collection_items(self, collection: str, detail: str = "summary", limit=50) -> DataFrame:
        columns = {"keys_only": ("item_key",), "summary": ("item_key", "item_type", "title", "creators", "label"), "full": (*SHOWN, "label")}
        if detail not in columns:
            raise ValueError("detail must be keys_only, summary or full")
        own = self.items().filter(F.array_contains("collections", collection))
        if detail != "keys_only":
            children = library.child_summary(self.spark, self.folder).select(F.col("parent_item_id").alias("item_id"), X.attachment_label(F.col("has_pdf"), F.col("n_attachments"), F.col("has_notes")).alias("label"))
            own = own.join(children, "item_id", "left")
        return own.orderBy("item_id").select(*columns[detail]).limit(X.limit_argument(limit, 50))

    def get_items_children(self, keys) -> DataFrame:
        """(parent_key, kind, item_id, item_key, title) of the children of the given items."""
        wanted = self.items("item_key").filter(F.col("item_key").isin(X.list_argument(keys))).select(F.col("item_id").alias("parent_item_id"), F.col("item_key").alias("parent_key"))
        kinds = [library.once(self.spark, self.folder, f"item_{k}s", "item_id", "item_key", "parent_item_id", "title").select(F.lit(k).alias("kind"), "*") for k in ("attachment", "note")]
        return kinds[0].unionByName(kinds[1]).join(wanted, "parent_item_id").select("parent_key", "kind", "item_id", "item_key", X.shortened(F.col("title"), 150).alias("title"))

    def get_item_children(self, key: str) -> DataFrame:
        return self.get_items_children([key])

    def get_tags(self, limit=None) -> DataFrame:
        """The labels in use with their initials, in the order of their code points."""
        tags = self.items("collections").select(F.explode("collections").alias("tag")).distinct().withColumn("initial", X.initial(F.col("tag"))).orderBy("tag")
        return tags if limit is None else tags.limit(X.limit_argument(limit, 100, 5000))

    def list_libraries(self) -> DataFrame:
        counts = library.items(self.spark, self.folder, "library_id").groupBy("library_id").agg(F.count("*").alias("n_items"))
        return self.table("zotero_items").select("library_id").distinct().join(counts, "library_id", "left").select("library_id", F.coalesce("n_items", F.lit(0)).alias("n_items")).orderBy("library_id")

    def list_feeds(self) -> DataFrame:
        return self.table("documents").filter("source = 'feed_item'").groupBy("collection_key").agg(F.count("*").alias("n_items"), F.max("ingested_at").alias("latest"))

    def get_feed_items(self, feed: str | None = None, limit=20) -> DataFrame:
        own = self.table("documents").filter("source = 'feed_item'")
        own = own if feed is None else own.filter(F.col("collection_key") == feed)
        return own.select("doc_id", "item_key", "ingested_at", X.shortened(X.without_tags(F.col("text")), 300).alias("text")).orderBy(F.desc("ingested_at"), "doc_id").limit(X.limit_argument(limit, 20))

    def get_recent(self, limit=10, collection: str | None = None) -> DataFrame:
        own = self.items()
        own = own if collection is None else own.filter(F.array_contains("collections", collection))
        return own.orderBy(F.desc_nulls_last("date_added"), "item_id").limit(X.limit_argument(limit, 10, 100))

    def get_annotations(self, item_key: str | None = None) -> DataFrame:
        """Annotations with their page and the title of the work, two hops up (else the attachment's title)."""
        marks = library.once(self.spark, self.folder, "item_annotations", "item_id", "item_key", "parent_item_id", "annotation_type", "annotation_text", "annotation_comment", "annotation_color", "annotation_page_label", "annotation_position")
        marks = marks.dropDuplicates(["item_key"])
        files_ = self.table("item_attachments").groupBy(F.col("item_id").alias("_a")).agg(F.min("parent_item_id").alias("_w"), F.min("title").alias("_t"))
        works = self.items("item_key", "title").select(F.col("item_id").alias("_w"), F.col("item_key").alias("work_key"), F.col("title").alias("_wt"))
        got = marks.join(files_, F.col("parent_item_id") == F.col("_a"), "left").join(works, "_w", "left")
        got = got.withColumn("work_title", F.coalesce("_wt", "_t")).withColumn("page_index", position(F.col("annotation_position"))["pageIndex"]).drop("_a", "_w", "_t", "_wt")
        return got if item_key is None else got.filter(F.col("work_key") == item_key)

    def get_notes(self, item_key: str | None = None, raw_html: bool = False) -> DataFrame:
        stored = self.table("item_notes")
        if "deleted" in stored.columns:
            stored = live_rows(stored)
        notes = stored.select("item_id", "item_key", "parent_item_id", "title", "note").distinct()
        parents = self.items("item_key", "title").select(F.col("item_id").alias("parent_item_id"), F.col("item_key").alias("parent_key"), F.col("title").alias("parent_title"))
        shown = F.col("note") if raw_html else X.collapsed(X.without_tags(F.col("note")))
        got = notes.join(parents, "parent_item_id", "left").withColumn("text", shown)
        return got if item_key is None else got.filter(F.col("parent_key") == item_key)

    # ------------------------------------------------------------------------------------------- index

    def update_search_database(self, stored: DataFrame | None = None, embedder=None) -> tuple[DataFrame, DataFrame]:
        """(index, counts): the index rows of all items put over a stored index. Rows: item_key, text, embedding and metadata."""
        own = self.items("item_key", "item_type", "title", "creators", "abstract", "notes", "date_modified", "doi", "extra")
        text = index.document_text(F.col("title"), F.col("creators"), F.col("abstract"), F.col("notes"))
        fresh = own.select("item_key", "item_type", "title", "date_modified", "doi", X.citation_key(F.col("extra")).alias("citation_key"), text.alias("text")).filter("text <> ''")
        fresh = cut_lineage(fresh.withColumn("embedding", index.embedding(F.col("text"), embedder)))
        if stored is None:
            stored = fresh.limit(0)
        return index.upsert(stored, fresh, "item_key"), index.upsert_counts(stored, fresh, "item_key")

    def get_search_database_status(self, stored: DataFrame) -> DataFrame:
        return stored.agg(F.count("*").alias("n_items"), F.max("date_modified").alias("latest"), F.count_distinct("item_type").alias("n_types"))

    def connector_search(self, query: str) -> DataFrame:
        found = self.semantic_search(query, 10).select(F.col("item_key").alias("id"), "title", F.concat(F.lit("library://items/"), "item_key").alias("url"))
        return found.agg(F.to_json(F.collect_list(F.struct("id", "title", "url"))).alias("results"))

    def connector_fetch(self, item_key: str) -> DataFrame:
        own = self.get_item_metadata(item_key)
        return own.select(F.to_json(F.struct(F.col("item_key").alias("id"), "title", F.col("abstract").alias("text"), "doi", "creators")).alias("document"))

    # ----------------------------------------------------------------------------------------- changes

    def create_note(self, parent: int, title: str, text: str, note_id: int, key: str) -> DataFrame:
        one = self.spark.createDataFrame([(note_id, key, parent, title, text)], "item_id long, item_key string, parent_item_id long, title string, _t string")
        return self.table("item_notes").unionByName(one.withColumn("note", X.html_note(F.col("title"), F.col("_t"))).drop("_t"))

    def update_note(self, key: str, html: str, append: bool = False) -> DataFrame:
        new = F.concat("note", F.lit(html)) if append else F.lit(html)
        return self.table("item_notes").withColumn("note", F.when(F.col("item_key") == key, new).otherwise(F.col("note")))

    def delete_note(self, key: str) -> DataFrame:
        return self.table("item_notes").withColumn("deleted", F.col("item_key") == key)

    def create_annotation(self, attachment: int, page: int, quotation: str, page_text: DataFrame, comment: str | None = None, colour: str = "#ffd400") -> DataFrame:
        """A highlight where the quotation lies in ``page_text`` (text): exactly, else by ratio; no row where it is not found."""
        own = page_text.select(X.match_text(F.col("text")).alias("t"), X.match_text(F.lit(quotation)).alias("q"))
        found = own.withColumn("least", fuzzy.threshold_for(F.length("q"))).select(fuzzy.fuzzy_find(F.col("t"), F.col("q"), F.col("least")).alias("m"), "least").filter("m.score >= least")
        return found.select(
            F.lit(attachment).cast("long").alias("parent_item_id"), F.lit("highlight").alias("annotation_type"), F.lit(quotation).alias("annotation_text"), F.lit(comment).cast("string").alias("annotation_comment"),
            F.lit(colour).alias("annotation_color"), F.lit(str(page)).alias("annotation_page_label"), F.format_string("%05d|%08d", F.lit(page - 1), F.col("m.start")).alias("annotation_sort_index"),
            F.to_json(F.struct(F.lit(page - 1).alias("pageIndex"), F.col("m.start").alias("start"), F.col("m.end").alias("end"))).alias("annotation_position"),
        )

    def create_area_annotation(self, attachment: int, page: int, areas: DataFrame, colour: str = "#ffd400") -> DataFrame:
        """Image annotations for normalised areas (x, y, width, height, page_width, page_height); invalid ones are left out."""
        own = areas.filter(area_is_valid(*map(F.col, ("x", "y", "width", "height"))))
        rect = area_rect(*map(F.col, ("x", "y", "width", "height", "page_width", "page_height")))
        own = own.withColumn("r", rect)
        return own.select(
            F.lit(attachment).cast("long").alias("parent_item_id"), F.lit("image").alias("annotation_type"), F.lit(colour).alias("annotation_color"), F.lit(str(page)).alias("annotation_page_label"),
            sort_index(F.lit(page - 1), F.col("r")[1], F.col("r")[0]).alias("annotation_sort_index"), F.to_json(F.struct(F.lit(page - 1).alias("pageIndex"), F.array("r").alias("rects"))).alias("annotation_position"),
        )

    def batch_update_tags(self, query: str, add=None, remove=None) -> tuple[DataFrame, DataFrame]:
        """(changed items, counts per label) for the items whose words match the query."""
        adds, removes = X.list_argument(add), X.list_argument(remove)
        own = self.items("title", "creators", "collections").filter(search.keyword(["title", "creators"], query))
        new = own.select("item_id", F.array_sort(F.coalesce("collections", F.array().cast("array<string>"))).alias("old"), library.set_edit("collections", adds, removes).alias("collections"))
        changed = new.filter("old <> collections")
        counted = changed.select(F.explode(F.concat(F.transform(F.array_except("collections", "old"), lambda t: F.struct(t.alias("tag"), F.lit("added").alias("what"))), F.transform(F.array_except("old", "collections"), lambda t: F.struct(t.alias("tag"), F.lit("removed").alias("what"))))).alias("c"))
        return changed.drop("old"), counted.groupBy("c.tag", "c.what").agg(F.count("*").alias("n"))

    def manage_collections(self, keys, add=None, remove=None) -> DataFrame:
        own = self.items("item_key", "collections").filter(F.col("item_key").isin(X.list_argument(keys)))
        return own.select("item_id", "item_key", library.set_edit("collections", X.list_argument(add), X.list_argument(remove)).alias("collections"))

    def create_collection(self, key: str, name: str, parent: str | None = None) -> DataFrame:
        """The collections with a new one; the parent is given by name, case aside, and must exist."""
        own = self.table("zotero_collections")
        above = None
        if parent is not None:
            found = own.filter(F.lower("collection_name") == parent.lower()).select("collection_key").orderBy("collection_key").first()
            if found is None:
                raise ValueError(f"no collection named {parent}")
            above = found.collection_key
        return own.unionByName(self.spark.createDataFrame([(key, name, above)], "collection_key string, collection_name string, parent_collection string"))

    def update_item(self, key: str, **changes) -> tuple[DataFrame, DataFrame]:
        """(changed row, differences); fields an item does not have are refused."""
        own = self.items().filter(F.col("item_key") == key)
        unknown = sorted(set(changes) - set(own.columns))
        if unknown:
            raise ValueError(f"no such fields: {', '.join(unknown)}")
        new = {f: F.lit(v).cast(dict(own.dtypes)[f]) for f, v in changes.items()}
        return own.withColumns(new), library.field_changes(own, "item_key", new)

    def find_duplicates(self, method: str = "both", collection: str | None = None, limit=50) -> DataFrame:
        own = self.items("title", "doi", "collections")
        own = own if collection is None else own.filter(F.array_contains("collections", collection))
        return library.duplicate_groups(own, method).orderBy("group_key").limit(X.limit_argument(limit, 50))

    def merge_duplicates(self, keeper: int, losers: list[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
        return library.merge_preview(self.items("collections"), library.once(self.spark, self.folder, "item_attachments"), keeper, losers)

    def add_by_doi(self, doi: str, snapshot: str) -> DataFrame:
        """The item row of a DOI, from a snapshot of messages."""
        wanted = X.strict_doi(F.lit(doi))
        return messages.as_items(messages.read_messages(self.spark, snapshot)).filter(F.lower("doi") == F.lower(wanted))

    def add_by_url(self, urls: DataFrame) -> DataFrame:
        """(url, kind, id): where each URL leads: a DOI, an arXiv number, or a web page."""
        doi, arxiv = X.strict_doi(F.col("url")), X.arxiv_id(F.col("url"))
        return urls.select("url", F.when(doi.isNotNull(), "doi").when(arxiv.isNotNull(), "arxiv").otherwise("webpage").alias("kind"), F.coalesce(doi, arxiv, F.col("url")).alias("id"))

    def add_from_files(self, folder: str, item_type: str = "document") -> DataFrame:
        """An item row per readable file, with the first DOI in its first 3000 characters."""
        got = files.read_texts(self.spark, folder).filter("text is not null")
        name = F.element_at(F.split("path", "/"), -1)
        return got.select(F.lit(item_type).alias("item_type"), name.alias("title"), X.doi_in_text(F.col("text"), 3000).alias("doi"), "text", "path")

    def get_pdf_outline(self, folder: str) -> DataFrame:
        return files.read_outlines(self.spark, folder)

    # ------------------------------------------------------------------------------------ citation data

    def enrich(self, tallies: DataFrame, items: DataFrame | None = None) -> DataFrame:
        """Items with their tallies (doi, supporting, contrasting, mentioning, notices) by DOI, in any notation."""
        own = (self.items() if items is None else items).withColumn("_d", F.lower(X.strict_doi(F.col("doi"))))
        right = tallies.select(F.lower(X.strict_doi(F.col("doi"))).alias("_d"), "supporting", "contrasting", "mentioning", "notices")
        got = own.join(right, "_d", "left").drop("_d")
        return got.withColumn("tally", F.when(F.col("supporting").isNotNull(), X.tally_line(F.col("supporting"), F.col("contrasting"), F.col("mentioning"))))

    def enrich_search(self, query: str, tallies: DataFrame, limit=10) -> DataFrame:
        return self.enrich(tallies, self.search_items(query, limit=limit))

    def check_retractions(self, tallies: DataFrame, collection: str | None = None) -> DataFrame:
        """Items whose paper has notices, with the notices in words."""
        own = self.items() if collection is None else self.items().filter(F.array_contains("collections", collection))
        got = self.enrich(tallies, own).filter(F.size("notices") > 0)
        return got.withColumn("notices", F.transform("notices", X.notice_label)).orderBy(F.desc_nulls_last("date_modified"), "item_id")

    @staticmethod
    def put(df: DataFrame, folder: str, name: str) -> None:
        """Write a table's new state; the plan may read the old one."""
        index.write_table(df, f"{folder}/{name}.parquet")


def live_rows(df: DataFrame) -> DataFrame:
    return df.filter(live(F.col("deleted")))
