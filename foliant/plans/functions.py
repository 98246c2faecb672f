"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import text as X
from foliant.functions import tokens
from foliant.operators import fuzzy, library
from foliant.operators.library import items, once
from foliant.plans.aggregates import CHILDREN_SQL
from foliant.plans.filters import AREA_SQL, areas
from foliant.plans.registry import live_sql, once_sql, query
from foliant.session import table


def _titles(spark, d):
    return items(spark, d, "title").filter("title is not null")


def _fold_sql(column: str) -> str:
    """The folding table, which is made from the Unicode database by rule, as SQL."""
    seen, plain = X._fold_table()
    out = f"translate({column}, '{seen}{X.DASHES}', '{plain}{'-' * len(X.DASHES)}')"
    for c, spelt in X.SPELT:
        out = f"replace({out}, '{c}', '{spelt}')"
    return f"regexp_replace({out}, '[\\x{{0300}}-\\x{{036F}}]', '', 'g')"


@query("x1_ascii_fold", f"SELECT item_id, {_fold_sql('title')} AS folded FROM {live_sql('title')} WHERE title IS NOT NULL")
def x1(spark, d):
    return _titles(spark, d).select("item_id", X.ascii_fold(F.col("title")).alias("folded"))


@query("x3_without_tags", f"SELECT item_id, trim(regexp_replace(regexp_replace(abstract, '<[^\\n]*?>', '', 'g'), '\\s+', ' ', 'g')) AS plain FROM {live_sql('abstract')} WHERE abstract IS NOT NULL")
def x3(spark, d):
    return items(spark, d, "abstract").filter("abstract is not null").select("item_id", X.collapsed(X.without_tags(F.col("abstract"))).alias("plain"))


@query("x4_note_text", f"SELECT item_id, regexp_replace(note, '<[^>]+>', '', 'g') AS plain FROM {once_sql('item_notes', 'item_id', 'note')}")
def x4(spark, d):
    return once(spark, d, "item_notes", "item_id", "note").select("item_id", X.note_text(F.col("note")).alias("plain"))


@query("x5_creator_names", f"SELECT item_id, list_filter(list_transform(string_split(creators, ';'), lambda x: trim(x)), lambda x: x <> '') AS names FROM {live_sql('creators')} WHERE creators IS NOT NULL")
def x5(spark, d):
    return items(spark, d, "creators").filter("creators is not null").select("item_id", X.creator_names(F.col("creators")).alias("names"))


@query(
    "x6_parsed_creators",
    f"""SELECT item_id, n, CASE WHEN contains(x, ',') THEN trim(split_part(x, ',', 1)) END AS last_name, CASE WHEN contains(x, ',') THEN trim(substr(x, instr(x, ',') + 1)) END AS first_name, CASE WHEN NOT contains(x, ',') THEN x END AS name
        FROM (SELECT item_id, unnest(l) AS x, generate_subscripts(l, 1) AS n FROM (SELECT item_id, list_filter(list_transform(string_split(creators, ';'), lambda x: trim(x)), lambda x: x <> '') AS l FROM {live_sql('creators')}))""",
)
def x6(spark, d):
    rows = items(spark, d, "creators").select("item_id", F.posexplode(X.parsed_creators(F.col("creators"))).alias("n", "c"))
    return rows.select("item_id", (F.col("n") + 1).alias("n"), "c.last_name", "c.first_name", "c.name")


@query(
    "x7_strict_doi",
    f"""WITH x AS (SELECT item_id, regexp_replace(trim(doi), '(?i)^doi:\\s*', '') AS x FROM {live_sql('doi')}),
        y AS (SELECT item_id, regexp_replace(CASE WHEN regexp_matches(x, '(?i)^https?://') THEN regexp_extract(x, '(?i)doi\\.org/(10\\.[0-9]{{4,9}}/[^\\s?#]+)', 1) ELSE x END, '[.,);\\]]+$', '') AS y FROM x)
        SELECT item_id, CASE WHEN regexp_matches(y, '^10\\.[0-9]{{4,9}}/\\S+$') THEN y END AS doi FROM y""",
)
def x7(spark, d):
    return items(spark, d, "doi").select("item_id", X.strict_doi(F.col("doi")).alias("doi"))


ARXIV = "[0-9]{4}\\.[0-9]{4,5}(?:v[0-9]+)?|[a-z-]+/[0-9]{7}(?:v[0-9]+)?"


@query(
    "x8_arxiv_ids_of_items",
    f"""WITH x AS (SELECT item_id, regexp_replace(trim(doi), '(?i)^arxiv:\\s*', '') AS x, nullif(regexp_extract(coalesce(extra, ''), '(?i)(?:arxiv:\\s*|arxiv\\.org/(?:abs|pdf)/)({ARXIV})', 1), '') AS other FROM {live_sql('doi', 'extra')}),
        y AS (SELECT item_id, other, CASE WHEN regexp_matches(x, '(?i)^https?://') THEN regexp_extract(x, '(?i)arxiv\\.org/(?:abs|pdf)/({ARXIV})', 1) ELSE x END AS y FROM x)
        SELECT item_id, CASE WHEN regexp_matches(y, '(?i)^({ARXIV})$') THEN y ELSE other END AS arxiv_id FROM y""",
)
def x8_items(spark, d):
    from_extra = F.nullif(F.regexp_extract(F.coalesce("extra", F.lit("")), rf"(?i)(?:arxiv:\s*|arxiv\.org/(?:abs|pdf)/)({ARXIV})", 1), F.lit(""))
    return items(spark, d, "doi", "extra").select("item_id", F.coalesce(X.arxiv_id(F.col("doi")), from_extra).alias("arxiv_id"))


@query(
    "x9_doi_or_extra",
    f"""WITH x AS (SELECT item_id, trim(coalesce(doi, '')) = '' AS blank, nullif(regexp_extract(coalesce(extra, ''), '(?im)^doi:\\s*(10\\.[0-9]{{4,9}}/\\S+)', 1), '') AS other, regexp_replace(trim(doi), '(?i)^doi:\\s*', '') AS x FROM {live_sql('doi', 'extra')}),
        y AS (SELECT *, regexp_replace(CASE WHEN regexp_matches(x, '(?i)^https?://') THEN regexp_extract(x, '(?i)doi\\.org/(10\\.[0-9]{{4,9}}/[^\\s?#]+)', 1) ELSE x END, '[.,);\\]]+$', '') AS y FROM x)
        SELECT item_id, CASE WHEN blank THEN other WHEN regexp_matches(y, '^10\\.[0-9]{{4,9}}/\\S+$') THEN y END AS doi FROM y""",
)
def x9(spark, d):
    own = items(spark, d, "doi", "extra")
    blank = F.trim(F.coalesce("doi", F.lit(""))) == ""
    from_extra = F.nullif(F.regexp_extract(F.coalesce("extra", F.lit("")), r"(?im)^doi:\s*(10\.[0-9]{4,9}/\S+)", 1), F.lit(""))
    return own.select("item_id", F.when(blank, from_extra).otherwise(X.strict_doi(F.col("doi"))).alias("doi"))


@query("x10_doi_in_text", "SELECT doc_id, nullif(regexp_replace(regexp_extract(text, '(10\\.[0-9]{4,9}/[^\\s]+)', 1), '[.,);\\]]+$', ''), '') AS doi FROM documents")
def x10(spark, d):
    return table(spark, d, "documents").select("doc_id", X.doi_in_text(F.col("text")).alias("doi"))


WHITE = "[\\s\\x{000B}\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"


@query("x12_squeezed_key", f"SELECT item_id, regexp_replace(lower(title), '{WHITE}', '', 'g') AS k FROM {live_sql('title')} WHERE title IS NOT NULL")
def x12(spark, d):
    return _titles(spark, d).select("item_id", X.squeezed_key(F.col("title")).alias("k"))


SPACES = "[ \\t\\n\\x0B\\f\\r]"


def _plain_sql(column: str) -> str:
    """A text for matching as SQL: cut words joined, dashes, quotes and ligatures plain."""
    out = f"regexp_replace({column}, '[\\x{{00AD}}\\x{{2010}}\\x{{2011}}-]{SPACES}*\\n{SPACES}*', '', 'g')"
    plain = "-" * len(X.DASHES) + '""' + "'" * 4  # single quotes doubled for SQL
    out = f"translate({out}, '{X.DASHES}{X.DOUBLE_QUOTES}{X.SINGLE_QUOTES}', '{plain}')"
    for c, spelt in X.LIGATURES:
        out = f"replace({out}, '{c}', '{spelt}')"
    return out


@query("x13_match_text", f"SELECT doc_id, md5(trim(regexp_replace({_plain_sql('text')}, '{SPACES}+', ' ', 'g'), ' ')) AS text_md5 FROM documents")
def x13(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.match_text(F.col("text")).cast("binary")).alias("text_md5"))


@query("x14_match_key", f"SELECT DISTINCT item_id, lower(regexp_replace({_plain_sql('annotation_text')}, '{SPACES}+', '', 'g')) AS k FROM item_annotations WHERE annotation_text IS NOT NULL")
def x14(spark, d):
    own = once(spark, d, "item_annotations", "item_id", "annotation_text").filter("annotation_text is not null")
    return own.select("item_id", X.match_key(F.col("annotation_text")).alias("k"))


@query("x16_plain_entities", f"SELECT item_id, replace(replace(replace(replace(replace(replace(replace(note, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&') AS note FROM {once_sql('item_notes', 'item_id', 'note')}")
def x16(spark, d):
    return once(spark, d, "item_notes", "item_id", "note").select("item_id", X.plain_entities(F.col("note")).alias("note"))


@query("x17_shortened", f"SELECT item_id, CASE WHEN length(title) > 60 THEN substr(title, 1, 60) || '...' ELSE title END AS shown FROM {live_sql('title')}")
def x17(spark, d):
    return items(spark, d, "title").select("item_id", X.shortened(F.col("title"), 60).alias("shown"))


@query(
    "x18_snippets",
    """WITH t AS (SELECT doc_id, text, instr(lower(text), 'taxation') AS p, length(text) AS n FROM documents)
       SELECT doc_id, CASE WHEN p > 0 THEN CASE WHEN p - 100 > 1 THEN '...' ELSE '' END || substr(text, greatest(1, p - 100), least(n, p + 207) - greatest(1, p - 100) + 1) || CASE WHEN least(n, p + 207) < n THEN '...' ELSE '' END
         ELSE substr(text, 1, 500) END AS snippet FROM t""",
)
def x18(spark, d):
    return table(spark, d, "documents").select("doc_id", X.snippet(F.col("text"), "taxation").alias("snippet"))


@query("x19_token_estimates", "SELECT doc_id, length(text) // 4 AS n, length(text) // 4 >= 5000 AS large FROM documents")
def x19(spark, d):
    return table(spark, d, "documents").select("doc_id", X.token_estimate(F.col("text")).alias("n"), (X.token_estimate(F.col("text")) >= 5000).alias("large"))


@query("x20_cut_by_characters", "SELECT doc_id, substr(text, 1, 3 * 256) AS cut FROM documents")
def x20(spark, d):
    return table(spark, d, "documents").select("doc_id", F.substring("text", 1, 3 * 256).alias("cut"))


@query("x20_cut_at_tokens", None)
def x20_exact(spark, d):
    """Documents up to 256 tokens of a public tokenizer, and how many they have."""
    return table(spark, d, "documents").select("doc_id", tokens.first_tokens(F.col("text"), 256).alias("cut"), tokens.n_tokens(F.col("text")).alias("n_tokens"))


@query("x22_citation_keys", f"SELECT trim(regexp_extract(coalesce(extra, ''), '(?im)^citation ?key:(.*)$', 1)) AS citation_key, count(*) AS n FROM {live_sql('extra')} GROUP BY 1")
def x22(spark, d):
    return items(spark, d, "extra").groupBy(X.citation_key(F.col("extra")).alias("citation_key")).agg(F.count("*").alias("n"))


@query("x23_years", f"SELECT CASE WHEN length(trim(date_added)) >= 4 THEN substr(trim(date_added), 1, 4) END AS year, count(*) AS n FROM {live_sql('date_added')} GROUP BY 1")
def x23(spark, d):
    return items(spark, d, "date_added").groupBy(X.year(F.col("date_added")).alias("year")).agg(F.count("*").alias("n"))


@query(
    "x24_first_author",
    f"""SELECT item_id, trim(split_part(names[1], ',', 1)) || CASE WHEN len(names) > 1 THEN ' et al.' ELSE '' END AS author FROM
        (SELECT item_id, list_filter(list_transform(string_split(creators, ';'), lambda x: trim(x)), lambda x: x <> '') AS names FROM {live_sql('creators')}) WHERE len(names) > 0""",
)
def x24(spark, d):
    return items(spark, d, "creators").filter(F.size(X.creator_names(F.col("creators"))) > 0).select("item_id", X.first_author(F.col("creators")).alias("author"))


@query(
    "x25_bibtex",
    f"""WITH i AS (SELECT item_id, item_key, item_type, title, doi, CASE WHEN length(trim(date_added)) >= 4 THEN substr(trim(date_added), 1, 4) END AS y,
          list_filter(list_transform(string_split(creators, ';'), lambda x: trim(x)), lambda x: x <> '') AS names FROM {live_sql('item_key', 'item_type', 'title', 'doi', 'date_added', 'creators')})
        SELECT item_id, concat_ws(',' || chr(10), '@' || coalesce(MAP {{'journalArticle': 'article', 'book': 'book', 'bookSection': 'incollection', 'webpage': 'misc'}}[item_type], 'misc') || '{{' || replace(split_part(coalesce(names[1], ''), ',', 1), ' ', '') || coalesce(y, 'nodate') || '_' || item_key,
          '  title = {{' || replace(replace(nullif(title, ''), '{{', '\\{{'), '}}', '\\}}') || '}}', '  author = {{' || nullif(array_to_string(names, ' and '), '') || '}}', '  year = {{' || y || '}}', '  doi = {{' || nullif(doi, '') || '}}') || chr(10) || '}}' AS entry FROM i""",
)
def x25(spark, d):
    own = items(spark, d, "item_key", "item_type", "title", "creators", "date_added", "doi")
    return own.select("item_id", X.bibtex(*map(F.col, ("item_key", "item_type", "title", "creators", "date_added", "doi"))).alias("entry"))


@query("x26_note_html", f"SELECT item_id, '<h1>' || replace(replace(replace(coalesce(title, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</h1><p>' || replace(replace(replace(replace(replace(coalesce(abstract, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10) || chr(10), '</p><p>'), chr(10), '<br/>') || '</p>' AS html FROM {live_sql('title', 'abstract')}")
def x26(spark, d):
    return items(spark, d, "title", "abstract").select("item_id", X.html_note(F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit(""))).alias("html"))


@query("x27_attachment_labels", f"SELECT parent_item_id, concat_ws(', ', CASE WHEN has_pdf THEN 'PDF' END, CASE WHEN n_attachments > 0 THEN n_attachments || CASE WHEN n_attachments = 1 THEN ' attachment' ELSE ' attachments' END END, CASE WHEN has_notes THEN 'has notes' END) AS label FROM ({CHILDREN_SQL})")
def x27(spark, d):
    return library.child_summary(spark, d).select("parent_item_id", X.attachment_label(F.col("has_pdf"), F.col("n_attachments"), F.col("has_notes")).alias("label"))


@query("x29_date_parts", "SELECT event_id, year(ts) || '-' || month(ts) || '-' || day(ts) AS date FROM events")
def x29(spark, d):
    parts = F.array(*[f("ts").cast("string") for f in (F.year, F.month, F.dayofmonth)])
    return table(spark, d, "events").select("event_id", F.array_join(parts, "-").alias("date"))


@query("x31_json_fields", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def x31(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("x32_refresh_due", "SELECT event_id, ts + INTERVAL 7 DAY < TIMESTAMP '2024-02-01 00:00:00' AS due FROM events")
def x32(spark, d):
    return table(spark, d, "events").select("event_id", (F.col("ts") + F.expr("interval 7 days") < F.lit("2024-02-01 00:00:00").cast("timestamp")).alias("due"))


@query("x33_masked", f"SELECT item_id, substr(item_key, 1, 4) || repeat('*', greatest(length(item_key) - 4, 0)) AS masked FROM {live_sql('item_key')}")
def x33(spark, d):
    return items(spark, d, "item_key").select("item_id", X.masked(F.col("item_key")).alias("masked"))


# -------------------------------------------------------------------------------- geometry and matching


@query("m5_thresholds", f"SELECT item_id, CASE WHEN length(annotation_text) <= 50 THEN 0.85 WHEN length(annotation_text) <= 150 THEN 0.75 ELSE 0.65 END::DOUBLE AS threshold FROM {once_sql('item_annotations', 'item_id', 'annotation_text')} WHERE annotation_text IS NOT NULL")
def m5(spark, d):
    own = once(spark, d, "item_annotations", "item_id", "annotation_text").filter("annotation_text is not null")
    return own.select("item_id", fuzzy.threshold_for(F.length("annotation_text")).alias("threshold"))


@query(
    "m8_flipped_rects",
    """SELECT item_id, list_transform(r, lambda x: [x[1], round(800 - x[4], 4), x[3], round(800 - x[2], 4)]) AS rects
       FROM (SELECT DISTINCT item_id, CAST(json_extract(annotation_position, '$.rects') AS DOUBLE[][]) AS r FROM item_annotations) WHERE r IS NOT NULL""",
)
def m8(spark, d):
    own = once(spark, d, "item_annotations", "item_id", "annotation_position").select("item_id", G.position(F.col("annotation_position"))["rects"].alias("r")).filter("r is not null")
    rounded = F.transform(G.flipped(F.col("r"), F.lit(800.0)), lambda x: F.transform(x, lambda v: F.round(v, 4)))
    return own.select("item_id", rounded.alias("rects"))


@query(
    "m9_sort_indexes",
    """SELECT item_id, lpad(CAST(page AS VARCHAR), 5, '0') || '|' || lpad(CAST(CAST(trunc(r[2]) AS INTEGER) AS VARCHAR), 6, '0') || '|' || lpad(CAST(CAST(trunc(r[1]) AS INTEGER) AS VARCHAR), 5, '0') AS sort_index
       FROM (SELECT DISTINCT item_id, CAST(json_extract(annotation_position, '$.pageIndex') AS INTEGER) AS page, CAST(json_extract(annotation_position, '$.rects[0]') AS DOUBLE[]) AS r FROM item_annotations) WHERE r IS NOT NULL""",
)
def m9(spark, d):
    pos = G.position(F.col("annotation_position"))
    own = once(spark, d, "item_annotations", "item_id", "annotation_position").select("item_id", pos["pageIndex"].alias("page"), pos["rects"][0].alias("r")).filter("r is not null")
    return own.select("item_id", G.sort_index(F.col("page"), F.col("r")[1], F.col("r")[0]).alias("sort_index"))


@query("m10_area_rects", f"SELECT item_id, [round(x * 600, 4), round((1 - y - h) * 800, 4), round((x + w) * 600, 4), round((1 - y) * 800, 4)] AS rect FROM ({AREA_SQL})")
def m10(spark, d):
    return areas(spark, d).select("item_id", G.area_rect(*map(F.col, "xywh"), F.lit(600.0), F.lit(800.0)).alias("rect"))


def _quotations(spark, d, which: str):
    """Annotations for which ``which`` holds, as p, beside the full text of their work (two hops up), as t."""
    files = once(spark, d, "item_attachments", "item_id", "parent_item_id").select(F.col("item_id").alias("_a"), F.col("parent_item_id").alias("work_id"))
    marks = once(spark, d, "item_annotations", "item_id", "parent_item_id", "annotation_text").filter(which)
    texts = items(spark, d, "fulltext").filter("length(fulltext) > 0").select(F.col("item_id").alias("work_id"), X.match_text(F.col("fulltext")).alias("t"))
    met = marks.join(files, F.col("parent_item_id") == F.col("_a")).join(texts, "work_id")
    return met.select("item_id", "work_id", "t", X.match_text(F.col("annotation_text")).alias("p"), fuzzy.threshold_for(F.length("annotation_text")).alias("least"))


@query("m4_fuzzy_quotations", None)
def m4(spark, d):
    """Annotations located in the full text of their work, by ratio where they differ."""
    got = _quotations(spark, d, "length(annotation_text) > 0").select("item_id", "work_id", fuzzy.fuzzy_find(F.col("t"), F.col("p"), F.col("least")).alias("m"), "least")
    return got.select("item_id", "work_id", F.when(F.col("m.score") >= F.col("least"), F.col("m.start")).alias("start_at"), F.round("m.score", 6).alias("score"))


@query("m6_anchored_annotations", None)
def m6_annotations(spark, d):
    """Annotations above 100 characters by their first and last characters; those without both anchors as in m4."""
    own = _quotations(spark, d, "length(annotation_text) > 100")
    own = own.withColumn("a", F.when(F.length("p") >= 80, fuzzy.anchored(F.col("t"), F.col("p")))).withColumn("anchored", F.coalesce(F.col("a.start") >= 0, F.lit(False)))
    got = own.select("item_id", "work_id", "a", "anchored", fuzzy.fuzzy_find(F.col("t"), F.when(~F.col("anchored"), F.col("p")), F.col("least")).alias("m"), "least")
    place = lambda f: F.when(F.col("anchored"), F.col(f"a.{f}")).when(F.col("m.score") >= F.col("least"), F.col(f"m.{f}"))
    way = F.when(F.col("anchored"), "anchor").when(F.col("m.score") >= F.col("least"), F.when(F.col("m.score") == 1, "exact").otherwise("fuzzy"))
    return got.select("item_id", "work_id", way.alias("way"), place("start").alias("start_at"), place("end").alias("end_at"))


MATCH_SQL = """trim(regexp_replace(replace(replace(replace(replace(replace(translate(regexp_replace({c}, '[\\x{{AD}}\\x{{2010}}\\x{{2011}}-]\\s*\\n\\s*', '', 'g'),
    '{seen}', '{plain}'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬀ', 'ff'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), '\\s+', ' ', 'g'))"""


def _match_sql(column: str) -> str:
    return MATCH_SQL.format(c=column, seen=X.DASHES + X.SINGLE_QUOTES + X.DOUBLE_QUOTES, plain="-" * len(X.DASHES) + "''''" + '""')


@query(
    "m6_anchors",
    f"""WITH q AS (SELECT m.item_id, i.item_id AS work_id, {_match_sql('m.annotation_text')} AS p, {_match_sql('i.fulltext')} AS t FROM {once_sql('item_annotations', 'item_id', 'parent_item_id', 'annotation_text')} m
          JOIN {once_sql('item_attachments', 'item_id', 'parent_item_id')} a ON a.item_id = m.parent_item_id JOIN {live_sql('fulltext')} i ON i.item_id = a.parent_item_id WHERE length(i.fulltext) > 0 AND length(m.annotation_text) > 100),
        s AS (SELECT item_id, work_id, p, t, instr(t, substr(p, 1, 40)) AS a FROM q), e AS (SELECT *, instr(substr(t, greatest(a, 1)), right(p, 40)) AS b FROM s)
        SELECT item_id, work_id, CASE WHEN a > 0 AND b > 0 THEN a - 1 ELSE -1 END AS start_at, CASE WHEN a > 0 AND b > 0 THEN greatest(a, 1) + b - 2 + length(right(p, 40)) ELSE -1 END AS end_at FROM e""",
)
def m6(spark, d):
    """Where annotations above 100 characters begin and end in the full text of their work, by their first and last characters."""
    own = _quotations(spark, d, "length(annotation_text) > 100").withColumn("a", fuzzy.anchored(F.col("t"), F.col("p")))
    return own.select("item_id", "work_id", F.col("a.start").alias("start_at"), F.col("a.end").alias("end_at"))
