import difflib
import io
import random
import sqlite3
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from foliant.functions import fields, geometry, text, tokens
from foliant.operators import fuzzy, index, library, search, store
from foliant.plans import catalog, functions
from foliant.sources import export, files, messages, sqlite
from foliant.streaming import refresh


def values(spark, column, *inputs):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(inputs)], "k int, x string")
    return [r.v for r in df.select("k", column(F.col("x")).alias("v")).orderBy("k").collect()]


def test_notations(spark):
    assert values(spark, text.ascii_fold, "Müller", "Cladder–Micus", "Ångström", "Łódź", "ß", None) == ["Muller", "Cladder-Micus", "Angstrom", "Lodz", "ss", None]
    assert values(spark, text.strict_doi, "doi:10.1234/abc.", "https://doi.org/10.1234/x?y", "10.12/abc", "http://a.b/c", None) == ["10.1234/abc", "10.1234/x", None, None, None]
    assert values(spark, fields.doi_key, "https://doi.org/10.1234%2FAbc", "info:doi/10.1234/abc,", "10.", "none", None) == ["10.1234/abc", "10.1234/abc", None, None, None]
    assert values(spark, text.arxiv_id, "arXiv:2101.00001v3", "https://arxiv.org/abs/hep-th/9901001", "nothing") == ["2101.00001v3", "hep-th/9901001", None]
    assert values(spark, text.duplicate_title_key, "The Quick Brown Fox", "quick brown fox", "  QUICK  BROWN  FOX!  ") == ["quick brown fox"] * 3
    assert values(spark, text.citation_key, "a: b\nCitation Key: smith2020\n", "none", None) == ["smith2020", "", ""]
    assert values(spark, text.match_text, "regard-\nless  of “it”") == ['regardless of "it"']
    assert values(spark, lambda x: fields.moment(x).cast("long"), "1970-01-02T00:00:00+01:00", "1970-01-01 00:00:05.5", "0000-00-00 00:00:00", "1577840400", "x", None) == [82800, 5, None, 1577840400, None, None]
    assert text.search_variants("Müller-Kern") == ["Müller-Kern", "Muller-Kern", "Müller Kern", "Muller Kern", "Mueller-Kern"]
    assert text.list_argument('["a", "b"]') == text.list_argument("a, b") == ["a", "b"]
    assert [text.limit_argument(x) for x in (None, "7", 0, 10**6, "x")] == [50, 7, 1, 500, 50]


ROWS = "item_id long, item_type string, title string, creators string, date_added string, version int, collections array<string>, doi string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1, "journalArticle", "A study of quantum things", "Müller, Jürgen; Kern, Ann", "2021-05-01", 7, ["A", "B"], "10.1/a"),
            (2, "book", "Old quantum", None, "2019-01-01", 12, [], None),
            (3, "book", None, "Smith, Bo", "2020", None, None, "10.1/A"),
        ],
        ROWS,
    )


@pytest.mark.parametrize(
    "conditions, mode, expected",
    [
        ([("title", "contains", "QUANTUM"), ("year", "isGreaterThan", "2020")], "all", [1]),
        ([("title", "isNot", "x")], "all", [1, 2, 3]),
        ([("creator", "contains", "muller")], "all", [1]),
        ([("creator", "isNot", "nobody")], "all", [1, 3]),
        ([("collection", "isNot", "C")], "all", [1]),
        ([("version", "isLessThan", "10")], "all", [1, 3]),
        ([("itemType", "is", "Book"), ("title", "endsWith", "things")], "any", [1, 2, 3]),
        ([("dateAdded", "isBefore", "2020-06")], "all", [2, 3]),
    ],
)
def test_conditions(rows, conditions, mode, expected):
    got = search.advanced_search(rows, [{"field": f, "operation": o, "value": v} for f, o, v in conditions], mode)
    assert sorted(r.item_id for r in got.collect()) == expected


@pytest.mark.parametrize("bad", ["{", "[]", [{"field": "a"}], [{"field": "a", "operation": "regex", "value": "x"}], [{"field": " ", "operation": "is", "value": "x"}]])
def test_bad_conditions(bad):
    with pytest.raises(ValueError):
        search.parse_conditions(bad)
    with pytest.raises(ValueError):
        search.parse_conditions([{"field": "a", "operation": "is", "value": "b"}], "some")


def test_filter_reaches_the_scan(spark, tmp_path, rows):
    rows.write.parquet(f"{tmp_path}/r")
    df = spark.read.parquet(f"{tmp_path}/r").select("item_id", "version")
    plan = search.advanced_search(df, [{"field": "version", "operation": "isGreaterThan", "value": "3"}])._jdf.queryExecution().toString()
    assert "title" not in plan.split("ReadSchema")[1]


def test_terms_and_cascade(rows):
    ids = lambda df: sorted(r.item_id for r in df.collect())
    assert ids(rows.filter(search.set_terms("collections", ["A || Z", "-C"]))) == [1]
    assert ids(rows.filter(search.set_terms("collections", ["-A"]))) == [2, 3]
    steps = [("none", F.col("title") == "zzz"), ("some", F.col("title").contains("quantum")), ("all", F.lit(True))]
    assert {(r.item_id, r.strategy) for r in search.cascade(rows, steps).collect()} == {(1, "some"), (2, "some")}


def test_merge_preview(spark, rows):
    attachments = spark.createDataFrame(
        [(11, 1, "pdf", "a", "m", "t"), (12, 3, "pdf", "a", "m", "t"), (13, 3, "pdf", "b", None, "t"), (14, 2, "pdf", "b", None, "t")], "item_id long, parent_item_id long, content_type string, filename string, md5 string, title string"
    )
    kept, moving, gone = library.merge_preview(rows, attachments, 1, [2, 3])
    assert kept.first().collections == ["A", "B"]
    assert [tuple(r) for r in moving.collect()] == [(13, 1)] and sorted(r.item_id for r in gone.collect()) == [2, 3]


def test_collection_paths_end_on_cycles(spark):
    tree = spark.createDataFrame([("a", "A", None), ("b", "B", "a"), ("c", "C", "b"), ("x", "X", "y"), ("y", "Y", "x"), ("o", "O", "missing")], "collection_key string, collection_name string, parent_collection string")
    assert {(r.collection_key, r.depth, r.path) for r in library.collection_paths(tree).collect()} == {("a", 0, "A"), ("b", 1, "A / B"), ("c", 2, "A / B / C"), ("o", 0, "O"), ("x", None, None), ("y", None, None)}


def test_geometry(spark):
    one = spark.range(1)
    got = one.select(
        geometry.area_rect(*map(F.lit, (0.1, 0.2, 0.3, 0.4)), F.lit(600.0), F.lit(800.0)).alias("r"), geometry.sort_index(F.lit(0), F.lit(320.7), F.lit(60.2)).alias("s"),
        geometry.area_is_valid(*map(F.lit, (0.9, 0.1, 0.2, 0.1))).alias("bad"), geometry.area_is_valid(F.lit(float("nan")), F.lit(0.1), F.lit(0.1), F.lit(0.1)).alias("nan"),
    ).first()
    assert got.r == [60.0, 320.0, 240.0, 640.0] and got.s == "00000|000320|00060" and not got.bad and not got.nan


def test_nearest_against_brute_force(spark):
    import numpy as np

    x = np.random.default_rng(1).normal(size=(300, 8)).astype("float32")
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    queries = rows.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    found = index.nearest(queries, rows, 5, query_bytes=2000)
    expected = {(q, int(v)) for q in range(0, 300, 20) for v in np.argsort(((x - x[q]) ** 2).sum(1))[:5]}
    assert {(r.query_id, r.vec_id) for r in found.collect()} == expected
    lists = index.nearest_by_lists(queries, rows, 5, index.fit_lists(rows, lists=8, sample=200))
    assert index.recall(lists, found).first().recall >= 0.9
    vectors = spark.createDataFrame([(1, "old mills"), (2, "")], "k int, t string").select(index.hashed_embedding(F.col("t"), 16).alias("e")).collect()
    assert abs(sum(v * v for v in vectors[0].e) - 1) < 1e-6 and not any(vectors[1].e)


def test_decisions_and_upsert(spark):
    current = spark.createDataFrame([("n", "1", False), ("f", "1", False), ("g", "2", False), ("u", "1", True), ("k", "1", True)], "key string, date_modified string, has_file boolean")
    stored = spark.createDataFrame([("f", "1", "failed"), ("g", "1", "failed"), ("u", "1", "none"), ("k", "1", "ok")], "key string, indexed_modified string, state string")
    assert {r.key: r.decision for r in index.refresh_decisions(current, stored).collect()} == {"n": "extract", "f": "skip", "g": "retry", "u": "update", "k": "skip"}
    old, new = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert {tuple(r) for r in index.upsert(old, new, "k").collect()} == {("a", 1), ("b", 2), ("c", 2)}
    assert index.upsert_counts(old, new, "k").first().asDict() == {"processed": 2, "added": 1, "updated": 1}


def test_fuzzy(spark):
    long = "x" * 3000 + "the quick brown fox jumps" + "y" * 9000
    assert fuzzy.best_window(long, "the quick brown fox jumps") == (3000, 3025, 1.0)
    start, _, score = fuzzy.best_window(long, "the quikc brown fox jumsp")
    assert abs(start - 3000) < 8 and score > 0.8
    assert fuzzy.best_window("", "a")[2] == 0.0


def marked_works(spark, folder, works, marks):
    """Tables of works (id, full text), a file for each (id + 100), and annotations (id, file, text)."""
    spark.createDataFrame([(k, x, False) for k, x in works], "item_id int, fulltext string, deleted boolean").write.parquet(f"{folder}/zotero_items.parquet")
    spark.createDataFrame([(k + 100, k) for k, _ in works], "item_id int, parent_item_id int").write.parquet(f"{folder}/item_attachments.parquet")
    spark.createDataFrame(marks, "item_id int, parent_item_id int, annotation_text string").write.parquet(f"{folder}/item_annotations.parquet")
    return str(folder)


def test_quotations_of_any_length(spark, tmp_path):
    long = " ".join(f"word{k}" for k in range(60))
    works = [(1, f"序言在前。记忆与口述的历史。{long} and the end.")]
    folder = marked_works(spark, tmp_path, works, [(201, 101, "口述的历史"), (202, 101, long), (203, 101, "and the end"), (204, 101, "   "), (205, 101, ""), (206, 101, None)])
    got = {r.item_id: (r.start_at, r.score) for r in functions.m4(spark, folder).collect()}
    assert got == {201: (8, 1.0), 202: (14, 1.0), 203: (14 + len(long) + 1, 1.0), 204: (None, 0.0)}


def test_anchored_annotations(spark, tmp_path):
    quoted = " ".join(f"word{k}" for k in range(30))
    works = [(1, f"Before it. {quoted} after it."), (2, "Nothing of the kind. " * 20)]
    torn = quoted[:45] + "#" * 150 + quoted[-45:]
    slipped = "wond" + quoted[4:]
    marks = [(201, 101, quoted), (202, 101, torn), (203, 101, slipped), (204, 102, quoted), (205, 101, quoted[:100]), (206, 101, " " * 120)]
    folder = marked_works(spark, tmp_path, works, marks)
    got = {r.item_id: (r.way, r.start_at, r.end_at) for r in catalog.queries()["m6_anchored_annotations"](spark, folder).collect()}
    whole = ("anchor", 11, 11 + len(quoted))
    assert got.pop(203)[0] == "fuzzy"
    assert got == {201: whole, 202: whole, 204: (None, None, None), 206: (None, None, None)}


def test_arxiv_ids_of_items(spark, tmp_path):
    rows = [(1, "arXiv: 2101.01234v2", None), (2, "https://arxiv.org/abs/hep-th/9901001", ""), (3, "10.1000/x", "Note: a\narXiv:1706.03762 [cs]"), (4, None, "see https://arxiv.org/pdf/1706.03762v5.pdf"), (5, "10.1000/x", "arXiv: none"), (6, None, None)]
    spark.createDataFrame([(*r, False) for r in rows], "item_id int, doi string, extra string, deleted boolean").write.parquet(f"{tmp_path}/zotero_items.parquet")
    expected = {1: "2101.01234v2", 2: "hep-th/9901001", 3: "1706.03762", 4: "1706.03762v5", 5: None, 6: None}
    assert {r.item_id: r.arxiv_id for r in catalog.queries()["x8_arxiv_ids_of_items"](spark, str(tmp_path)).collect()} == expected
    con = duckdb.connect()
    con.execute(f"create view zotero_items as select * from read_parquet('{tmp_path}/zotero_items.parquet/*.parquet')")
    assert dict(con.execute(catalog.oracle_sql()["x8_arxiv_ids_of_items"]).fetchall()) == expected


def test_points_over_whole_length(spark, tmp_path):
    sizes = {k: 3000 + 37 * k for k in range(40)}
    rows = [(k, "hot", "x" * n) for k, n in sizes.items()] + [(50, "small", "y" * 7), (51, "small", ""), (52, None, "z")]
    spark.createDataFrame(rows, "doc_id int, collection_key string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in catalog.queries()["j20_containing_over_length"](spark, str(tmp_path)).collect()}
    starts = {k: sum(n for j, n in sizes.items() if j < k) for k in sizes}
    points = {p for k in sizes for p in (starts[k] + sizes[k] // 2, starts[k] // 1800 * 1800)}
    expected = {("hot", p, k) for p in points for k in sizes if starts[k] <= p < starts[k] + sizes[k]} | {("small", 0, 50), ("small", 3, 50)}
    assert got == expected and {k for _, _, k in got} == {*sizes, 50}


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "a.sqlite")
    with sqlite3.connect(path) as db:
        db.execute("create table t (id integer primary key, name text, x real)")
        db.executemany("insert into t values (?, ?, ?)", [(i, f"n{i}", i / 2 if i % 3 else None) for i in range(1, 101)])
    df = sqlite.read_table(spark, path, "t", 3)
    assert df.count() == 100 and df.filter("x is null").count() == 33 and df.agg(F.sum("id")).first()[0] == 5050
    with pytest.raises(ValueError):
        sqlite.read_table(spark, path, "missing")


def make_epub() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:x"><rootfiles><rootfile full-path="OEBPS/p.opf"/></rootfiles></container>')
        z.writestr("OEBPS/p.opf", '<package xmlns="urn:y"><manifest><item id="b" href="b.xhtml"/><item id="a" href="a%20a.xhtml"/></manifest><spine><itemref idref="a"/><itemref idref="b"/></spine></package>')
        z.writestr("OEBPS/a a.xhtml", "<html><head><title>t</title></head><body><p>First <i>chapter</i> here.</p></body></html>")
        z.writestr("OEBPS/b.xhtml", "<html><body><p>Second.</p></body></html>")
    return out.getvalue()


def test_files(spark, tmp_path):
    (tmp_path / "b.epub").write_bytes(make_epub())
    (tmp_path / "h.html").write_text("<html><style>x</style><p>One &amp; two</p><p>Three</p></html>")
    (tmp_path / "p.pdf").write_bytes(b"%PDF-1.4\n1 0 obj\n<<>>\nstream\nBT (Hello \\(you\\)) Tj T* (there) Tj ET\nendstream\nendobj")
    (tmp_path / "broken.epub").write_bytes(b"no")
    got = {r.path.rsplit("/", 1)[1]: r.text for r in files.read_texts(spark, str(tmp_path)).collect()}
    assert got == {"b.epub": "First chapter here.\n\nSecond.", "h.html": "One & two\nThree", "p.pdf": "Hello (you)\nthere", "broken.epub": None}
    chapters = files.read_chapters(spark, str(tmp_path)).orderBy("chapter").collect()
    assert [(r.chapter, r.text) for r in chapters if r.error is None] == [(0, "First chapter here."), (1, "Second.")]
    assert [r.path.rsplit("/", 1)[1] for r in chapters if r.error] == ["broken.epub"]
    assert "BadZipFile" in files.read_texts(spark, str(tmp_path), "broken.epub").first().error


def test_pages_outlines_and_annotations_of_a_pdf():
    content = export.pdf_bytes(["One (a)", "Two\\", "Three"], [(1, "First", 1), (2, "Within", 2), (1, "Last", 3)], [(1, "highlight", "a (note)", [1.0, 2.5, 3.0, 4.0]), (2, "text", "end", [0.0, 0.0, 1.0, 1.0])])
    assert files.pdf_pages(content) == ["One (a)", "Two\\", "Three"] and files.extract("x.pdf", content, 2) == "One (a)\nTwo\\"
    assert files.pdf_outline(content) == [(1, "First", 1), (2, "Within", 2), (1, "Last", 3)]
    assert files.pdf_annotations(content) == [(1, "highlight", "a (note)", [1.0, 2.5, 3.0, 4.0]), (2, "text", "end", [0.0, 0.0, 1.0, 1.0])]
    book = export.epub_bytes([export.html_page("Cover", []), export.html_page("İstanbul", ["The mills of the north."])])
    assert (files.kind_of(content), files.kind_of(book), files.kind_of(b"")) == ("pdf", "epub", None)
    assert files.find_in_book(book, "mills  of the")[:2] == (2, "book/part 1.xhtml") and "/2/2/4,/1:4,/1:16" in files.find_in_book(book, "mills of the")[2]
    assert files.find_in_book(book, "absent") is None and files.pdf_pages(b"no") == files.pdf_outline(b"no") == files.pdf_annotations(b"no") == []


def test_quotations_on_pages(spark):
    pages = spark.createDataFrame([(1, n, t) for n, t in enumerate(["Nothing of note here.", "the quick brown fox jumps over it", "x " * 60 + "anchor words stand at the very begin " + "and " * 30 + "the end of the quotation is here now", "far away fox"])], "work_id long, page int, t string")

    marks = [(1, 1, 0, "brown fox jumps"), (2, 1, 1, "the quikc brown fox jumps"), (3, 1, 3, "anchor words stand at the very begin and a middle that was " + "misread " * 4 + "and the end of the quotation is here now"), (4, 1, 0, "wholly unlike anything"), (5, 1, 0, "far away fox")]
    got = {r.item_id: r for r in fuzzy.on_pages(spark.createDataFrame(marks, "item_id long, work_id long, page int, p string"), pages).collect()}
    assert (got[1].page, got[1].way, got[1].start_at) == (1, "exact", 10) and (got[2].page, got[2].way) == (1, "fuzzy") and got[2].score > 0.85
    assert (got[3].page, got[3].way, got[3].start_at) == (2, "anchor", 120) and got[4].way is None and got[5].way is None


def test_tokens_in_parts():
    """A text cut in parts has the tokens of the whole; a cut after some tokens is a beginning of the text."""
    rng = random.Random(2)
    own = tokens.encoding(tokens.VOCABULARY)
    for alphabet in ("ab c.,\n", "字。 漢、x", "don't  we'll 12 3.", "x"):
        text = "".join(rng.choice(alphabet) for _ in range(900))
        assert "".join(tokens.parts(text, 40)) == text
        assert [t for p in tokens.parts(text, 40) for t in own.encode_ordinary(p)] == own.encode_ordinary(text)
        cut = tokens.cut_at_tokens(text, 20)
        assert text.startswith(cut) and len(own.encode_ordinary(cut)) <= 20 and tokens.cut_at_tokens(text, 10**6) == text
    assert tokens.count_tokens(None) == tokens.count_tokens("") == 0 and tokens.cut_at_tokens(None, 3) is None


def test_places_in_html():
    html = "<html><body><p>First <i>chapter</i> here.</p></body></html>"
    start, end = files.locate(html, "chapterhe")
    assert files.cfi_range(start, end, 0) == "epubcfi(/6/2!/2/2/2,/2/1:0,/3:3)"
    assert files.locate(html, "absent") is None


def test_messages(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"type": "book-chapter", "title": ["T"], "container-title": ["B"], "DOI": "10.1/x", "published": {"date-parts": [[2020, 5]]}, "author": [{"given": "A", "family": "B"}, {"name": "Org"}], "abstract": "<jats:p>Hi  there</jats:p>"}\n{"type": "odd"}')
    got = sorted(messages.as_items(messages.read_messages(spark, str(tmp_path / "m.json"))).collect(), key=lambda r: r.item_type)
    assert (got[0].item_type, got[0].date, got[0].creators, got[0].abstract) == ("bookSection", "2020-5", "B, A; Org", "Hi there") and got[1].item_type == "document"


def test_collections_of_any_depth_and_cycles(spark):
    rows = [(f"k{i}", f"n{i}", f"k{i - 1}" if i else None) for i in range(150)] + [("x", "x", "y"), ("y", "y", "x"), ("z", "z", "x"), ("o", "o", "gone")]
    got = {r.collection_key: (r.depth, r.path) for r in library.collection_paths(spark.createDataFrame(rows, "collection_key string, collection_name string, parent_collection string")).collect()}
    assert len(got) == 154 and got["k149"][0] == 149 and got["k149"][1] == " / ".join(f"n{i}" for i in range(150))
    assert got["x"] == got["y"] == got["z"] == (None, None) and got["o"] == (0, "o")


def test_no_window_is_missed():
    """The best ratio of all windows, wherever it reaches the threshold; patterns of every length."""
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(200)]
    for n in (1, 4, 12, 40, 63, 64, 65, 130, 400):
        text = " ".join(rng.choice(words) for _ in range(150))
        at = rng.randrange(len(text) - n)
        pattern = list(text[at : at + n])
        for _ in range(n // 5):
            pattern[rng.randrange(n)] = rng.choice("xyz ")
        pattern, least = "".join(pattern), rng.choice([0.65, 0.75, 0.85])
        if pattern in text:
            continue
        width, full = min(max(1, int(n * 1.2)), len(text)), 0.0
        matcher = difflib.SequenceMatcher(None, autojunk=False)
        matcher.set_seq2(pattern)
        for at in range(len(text) - width + 1):
            matcher.set_seq1(text[at : at + width])
            if matcher.quick_ratio() > full:
                full = max(full, matcher.ratio())
        found = fuzzy.best_window(text, pattern, least)[2]
        assert found == full if full >= least else found < least


def test_streaming_refresh(spark, tmp_path):
    schema = "key string, body string, version long"
    told = []
    run = lambda: refresh.refresh_index(spark, f"{tmp_path}/in", schema, f"{tmp_path}/index", f"{tmp_path}/cp", "key", "version", lambda n, c: told.append(c)).awaitTermination()
    spark.createDataFrame([("a", "one", 1), ("b", "one", 5), ("a", "two", 2)], schema).write.parquet(f"{tmp_path}/in")
    run()
    spark.createDataFrame([("b", "late", 3), ("c", "new", 1), ("a", "three", 3)], schema).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    index_ = store.Store(spark, f"{tmp_path}/index", schema, "key")
    assert {tuple(r) for r in index_.read().collect()} == {("a", "three", 3), ("b", "one", 5), ("c", "new", 1)}
    assert [(c["processed"], c["added"], c["updated"], c["skipped"]) for c in told] == [(2, 2, 0, 0), (2, 1, 1, 1)]
    assert index_.notes()["last_update"]


def test_broken_index_stops_the_stream_and_stays(spark, tmp_path):
    """A file of the index that can't be read is no empty index."""
    schema = "key string, body string, version long"
    run = lambda: refresh.refresh_index(spark, f"{tmp_path}/in", schema, f"{tmp_path}/index", f"{tmp_path}/cp", "key", "version").awaitTermination()
    spark.createDataFrame([("a", "one", 1), ("b", "one", 5)], schema).write.parquet(f"{tmp_path}/in")
    run()
    kept = sorted((tmp_path / "index").rglob("*.parquet"))
    for file in kept:
        file.write_bytes(b"no parquet")
    spark.createDataFrame([("a", "two", 2)], schema).write.mode("append").parquet(f"{tmp_path}/in")
    with pytest.raises(Exception):
        run()
    assert store.Store(spark, f"{tmp_path}/index", schema, "key").manifest()["version"] == 1
    assert all(f.read_bytes() == b"no parquet" for f in kept)
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.csv").write_text("1")
    with pytest.raises(ValueError):
        store.Store(spark, f"{tmp_path}/other", schema, "key").read()


def test_failed_rows_wait_and_are_tried_again(spark, tmp_path):
    schema = "key string, body string, version long"
    told = []

    def prepare(df):
        return df.withColumn("error", F.when((F.col("body") == "bad") | ((F.col("body") == "late") & (F.col("attempts") == 0)), "no"))

    def run(**more):
        refresh.refresh_index(spark, f"{tmp_path}/in", schema, f"{tmp_path}/index", f"{tmp_path}/cp", "key", "version", lambda n, c: told.append(c), prepare, **more).awaitTermination()

    for k, rows in enumerate(([("a", "bad", 1), ("b", "late", 1), ("c", "fine", 1)], [("d", "fine", 1)], [("e", "fine", 1)])):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        run(model="m1")
    assert [(c["total"], c["processed"], c["errors"], c["recovered"]) for c in told] == [(3, 1, 2, 0), (3, 2, 1, 1), (1, 1, 0, 0)]
    own = store.Store(spark, f"{tmp_path}/index", schema, "key")
    assert {r.key for r in own.read().collect()} == {"b", "c", "d", "e"} and own.notes()["model"] == "m1"
    assert own.for_model("m1") is False and own.for_model("m2") is True and own.read().count() == 0
    with pytest.raises(Exception):
        spark.createDataFrame([("f", "bad", 1)], schema).write.mode("append").parquet(f"{tmp_path}/in")
        run(failing_batches=1)


def test_store_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    own = store.Store(spark, f"{tmp_path}/s", "k long, v string", "k", buckets=8)
    own.put(spark.range(100).selectExpr("id as k", "'x' as v"))
    before = own.manifest()["parts"]
    own.put(spark.createDataFrame([(7, "y")], "k long, v string"))
    after = own.manifest()["parts"]
    assert sum(before[b] != after[b] for b in before) == 1 and own.read().filter("v = 'y'").count() == 1 and own.read().count() == 100
    own.delete(spark.range(100).selectExpr("id as k").filter("k <> 7"))
    assert [tuple(r) for r in own.read().collect()] == [(7, "y")]
    own.put(spark.createDataFrame([(8, "z")], "k long, v string"))
    assert len(list((tmp_path / "s").glob("manifest-*"))) == 2 and len(list((tmp_path / "s").glob("part-*/_bucket=*"))) <= 4


def test_event_streams(spark, tmp_path):
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    rows = spark.sql("select id as event_id, timestamp_seconds(1700000000 + id * 600) as ts, id % 3 as user_id, 'click' as event_type, 1.0D as value from range(60)")
    rows.write.parquet(f"{tmp_path}/e")
    stream = lambda: spark.readStream.schema(schema).parquet(f"{tmp_path}/e")

    def drained(df, mode):
        query = df.writeStream.format("memory").queryName("drained").outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.sql("select * from drained").collect()

    assert sum(r.n for r in drained(refresh.windowed_counts(stream()), "complete")) == 60
    assert sum(r.n for r in drained(refresh.session_counts(stream(), "5 hours"), "complete")) == 60
    assert sorted((r.user_id, r.n, r.total) for r in drained(refresh.running_totals(stream()), "update")) == [(0, 20, 20.0), (1, 20, 20.0), (2, 20, 20.0)]


def test_neighbours_in_blocks_and_cells(spark, monkeypatch):
    """Blocks of queries, hot lists cut into cells, and ties, against a scan of all pairs."""
    import numpy as np

    rng = np.random.default_rng(5)
    x = np.round(np.concatenate([rng.normal(size=(150, 6)), np.tile(rng.normal(size=(1, 6)), (60, 1))]), 3)
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    asked = rows.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    exact = {}
    y = x.astype(np.float32).astype(float)
    for q in range(0, len(x), 20):
        d = ((y - y[q]) ** 2).sum(1)
        exact[q] = sorted(range(len(x)), key=lambda i: (round(d[i], 6), i))[:7]
    for size in (10**7, 200):
        got: dict = {}
        for r in index.nearest(asked, rows, 7, query_bytes=size).collect():
            got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
        assert {q: [m[k] for k in sorted(m)] for q, m in got.items()} == exact
    monkeypatch.setattr(index, "CELL_ROWS", 16)
    monkeypatch.setattr(index, "CELL_QUERIES", 2)
    fitted = index.fit_lists(rows, lists=5)
    whole = index.nearest_by_lists(asked, rows, 7, index.Lists(fitted.centres, len(fitted.centres)))
    assert index.recall(whole, index.nearest(asked, rows, 7)).first().recall > 0.8  # all lists: only ties may differ
    assert {r.query_id for r in whole.collect()} == set(exact)
    empty = rows.limit(0)
    assert index.nearest(asked, empty, 3).count() == 0 and index.nearest(asked.limit(0), rows, 3).count() == 0
    assert index.nearest_by_lists(asked, empty, 3, index.fit_lists(empty)).count() == 0


def test_offsets_over_ranges_and_hot_joins(spark):
    df = spark.range(500).selectExpr("if(id % 3 = 0, null, id % 2) as g", "id * id as k", "id % 7 as n")
    got = {r.k: (r.start_at, r.end_at) for r in library.running_offsets(df, "g", "k", F.col("n"), rows=20).collect()}
    at: dict = {}
    for i in range(500):
        g = None if i % 3 == 0 else i % 2
        assert got[i * i] == (at.get(g, 0), at.get(g, 0) + i % 7)
        at[g] = at.get(g, 0) + i % 7
    assert library.running_offsets(df.limit(0), "g", "k", F.col("n")).count() == 0
    big = spark.range(30_000).selectExpr("id", "if(id % 2 = 0, 7, if(id % 5 = 0, null, id)) as k")
    small = spark.createDataFrame([(7, "seven"), (9, "nine")], "k long, v string")
    joined = library.salted_join(big, small, "k", share=0.01)
    assert joined.columns == ["k", "id", "v"] and joined.count() == 30_000 and joined.filter("v = 'seven'").count() == 15_001 and joined.filter("v = 'nine'").count() == 1


def test_a_model_may_take_the_place_of_hashing(spark):
    class Lengths:
        name, batch = "lengths", 2

        def documents(self, texts):
            assert len(texts) <= 2
            return [[len(t), 0.0] for t in texts]

        def queries(self, texts):
            return [[len(t), 1.0] for t in texts]

    df = spark.createDataFrame([("a",), ("bbb",), (None,), ("cc",)], "t string").coalesce(1)
    assert sorted(r.e for r in df.select(index.embedding(F.col("t"), Lengths()).alias("e")).collect()) == [[0, 0], [1, 0], [2, 0], [3, 0]]
    assert df.select(index.embedding(F.col("t"), Lengths(), query=True).alias("e")).first().e == [1, 1]
    scores = df.select(index.model_score(F.lit("x"), F.col("t"), lambda q, t: [len(a) + len(b) for a, b in zip(q, t)]).alias("s")).collect()
    assert sorted(r.s for r in scores) == [1, 2, 3, 4]
