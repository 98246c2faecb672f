"""Problem 3: one form for text that looks the same.

Words with a character outside ASCII are exploded to positioned code points, joined with a broadcast table of
decompositions and look-alikes, ordered by combining class, recomposed and built up again. The table is made from the
Unicode database over the whole code space and a short list of look-alikes, so its size is fixed. Only distinct words are
exploded: a word's normal form does not depend on where it stands, and repetition costs nothing.

A letter of another alphabet is replaced only where its word (or, for a single letter, its field) is written in the other
alphabet, so Greek symbols and words wholly in their own script stay as they are.

Defined results: null gives null, empty gives empty. Words of any length are handled (a word is rebuilt in one row, as it
arrived). Full-width punctuation stays where it stands beside Chinese, Japanese or Korean characters. Ties of scripts in a
word go to Latin. Repeated rows of an item: the one delivered last. Further columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.fields import live
from foliant.session import cut_lineage, latest_delivery, table

FIELDS = ("title", "creators")

# Letters of other alphabets that look like Latin ones, and the Latin ones they look like.
LOOKS_CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеорсухіјѕԛԝһӏԁ", "ABESIJKMHOPCTYXaeopcyxijsqwhld"))
LOOKS_GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοντικρυϲϳ", "ABEZHIKMNOPTYXovtikpucj"))
ARMENIAN = dict(zip("ՍՕօոսցհ", "UOonugh"))
LATIN_OF = LOOKS_CYRILLIC | LOOKS_GREEK | ARMENIAN
#: For words in Cyrillic or Greek script: the way back.
CYRILLIC_OF = {v: k for k, v in LOOKS_CYRILLIC.items() if k in "АВЕІКМНОРСТУХаеорсухі"}
GREEK_OF = {v: k for k, v in LOOKS_GREEK.items() if k in "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧον"}
#: Characters without width that change nothing about a word.
INVISIBLE = {0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x2070), 0xFEFF, *range(0xFE00, 0xFE10), 0x115F, 0x1160, 0x3164, 0xFFA0}
#: Joiners belong to the spelling in these scripts.
JOINED_SCRIPTS = ((0x600, 0x780), (0x900, 0xE00), (0x1000, 0x10A0))
SPACES = {0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000}
#: Compatibility forms with a meaning of their own (superscripts and the like) and typographic marks stay.
KEPT_TAGS = {"<super>", "<sub>", "<fraction>", "<circle>", "<square>", "<noBreak>"}
KEPT = set("ำຳ…‥′″‴‼⁇⁈⁉№℃℉™℠ªº¨¯´¸µΩ÷") | {chr(c) for c in range(0x2070, 0x20A0)} | {chr(c) for c in range(0xBC, 0xBF)}
CJK_MARKS = set("！＂＇（），．：；？［］｛｝～／－＝＋％＆＃＠＊＜＞｜＿｀＾＄＼")


def script_of(c: str) -> str:
    o = ord(c)
    if c.isascii():
        return "L" if c.isalpha() else ""
    if 0xC0 <= o < 0x250 or 0x1E00 <= o < 0x1F00 or 0xFF21 <= o <= 0xFF5A or 0xFB00 <= o <= 0xFB06:
        return "L" if c.isalpha() else ""
    if 0x400 <= o < 0x530 or 0x1C80 <= o < 0x1C90 or 0x2DE0 <= o < 0x2E00 or 0xA640 <= o < 0xA6A0:
        return "C"
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "G" if c.isalpha() else ""
    if 0x530 <= o < 0x590:
        return "A"
    if 0x1100 <= o < 0x1200 or 0x3040 <= o < 0x3400 or 0x3400 <= o < 0xA000 or 0xAC00 <= o < 0xD7B0 or 0xFF65 <= o < 0xFFDD or 0x20000 <= o < 0x32000 or 0xF900 <= o < 0xFB00:
        return "H"
    return "O" if c.isalpha() or unicodedata.category(c)[0] == "M" else ""


@lru_cache(maxsize=1)
def mapping_rows() -> list[tuple[int, str, int, str, str, str, str]]:
    """(cp, parts, ccc, script, as_latin, as_cyrillic, as_greek) for every code point that needs other than passing through."""
    rows = []
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        if 0xD800 <= cp < 0xE000 or 0x4E00 <= cp < 0xA000 or 0xAC00 <= cp < 0xD7A4 or cp >= 0x32000 and cp < 0xE0000:
            continue
        category = unicodedata.category(c)
        if category in ("Cn", "Co"):
            continue
        decomposition = unicodedata.decomposition(c)
        kind = "pass"
        parts = unicodedata.normalize("NFD", c)
        if cp in INVISIBLE or 0xE0100 <= cp < 0xE01F0:
            kind, parts = "none", ""
        elif cp in SPACES:
            kind, parts = "space", " "
        elif decomposition.startswith("<"):
            tag = decomposition.split(" ", 1)[0]
            if tag not in KEPT_TAGS and c not in KEPT:
                parts = unicodedata.normalize("NFKD", c)
                kind = "mark" if c in CJK_MARKS else "form"
        ccc = unicodedata.combining(c)
        script = script_of(c)
        if kind != "pass" or parts != c or ccc or script in ("C", "G", "A"):
            rows.append((cp, parts, ccc, script or "", LATIN_OF.get(c, ""), kind))
    for c in set(CYRILLIC_OF) | set(GREEK_OF):
        rows.append((ord(c), c, 0, "L", "", "ascii"))
    return rows


TOKENS = r"[\p{L}\p{M}\p{N}\p{Cf}]+|[^\p{L}\p{M}\p{N}\p{Cf}]+"


@F.pandas_udf(T.StringType())
def _recompose(text: pd.Series) -> pd.Series:
    return text.map(lambda x: unicodedata.normalize("NFC", x).replace("\u0e4d\u0e32", "\u0e33").replace("\u0ecd\u0eb2", "\u0eb3"))


def _field_script(col: Column) -> Column:
    """L, C, G or H, whichever letters prevail in the field."""
    count = lambda cls: F.length(F.regexp_replace(col, f"[^{cls}]", ""))
    latin, cyrillic = count("A-Za-z\\u00C0-\\u024F\\uFF21-\\uFF5A"), count("\\u0400-\\u052F")
    greek, cjk = count("\\u0370-\\u03FF"), count("\\u3040-\\u30FF\\u3400-\\u9FFF\\uAC00-\\uD7AF\\u1100-\\u11FF\\uFF66-\\uFFDC")
    return F.when((cjk > 0) & (cjk * 2 >= latin), "H").when((cyrillic > latin) & (cyrillic >= greek), "C").when(greek > latin, "G").otherwise("L")


def mapping(spark: SparkSession) -> DataFrame:
    rows = pd.DataFrame(mapping_rows(), columns=["cp", "parts", "ccc", "script", "latin", "kind"])
    rows["back"] = [CYRILLIC_OF.get(chr(c), "") if k == "ascii" else "" for c, k in zip(rows["cp"], rows["kind"])]
    rows["back_greek"] = [GREEK_OF.get(chr(c), "") if k == "ascii" else "" for c, k in zip(rows["cp"], rows["kind"])]
    return spark.createDataFrame(rows)


def word_forms(words: DataFrame) -> DataFrame:
    """(tok, fscript, symbol, norm) for distinct words (tok, fscript, symbol)."""
    key = ["tok", "fscript", "symbol"]
    points = words.select(*key, F.posexplode(F.split("tok", "")).alias("pos", "ch")).filter("ch <> ''").withColumn("cp", F.expr("ascii(ch)"))
    points = points.join(F.broadcast(mapping(words.sparkSession)), "cp", "left")
    w = Window.partitionBy(*key)
    in_order = w.orderBy("pos")
    ascii_letter = F.col("ch").rlike("[A-Za-z]")
    script = F.when(ascii_letter, "L").otherwise(F.coalesce(F.col("script"), F.lit("")))
    foreign = script.isin("C", "G", "A")
    latin_like = (script == "L") | F.col("ch").rlike("[\\u00C0-\\u024F]")
    joined = lambda c: ((c >= 0x600) & (c < 0x780)) | ((c >= 0x900) & (c < 0xE00)) | ((c >= 0x1000) & (c < 0x10A0))
    points = points.select(
        *key, "pos", "ch", "cp", "parts", "kind", "latin", "back", "back_greek", foreign.alias("foreign"), script.alias("sc"),
        F.coalesce(F.sum((latin_like | (F.col("kind") == "form") & (script == "L")).cast("int")).over(w), F.lit(0)).alias("n_latin"),
        F.sum(foreign.cast("int")).over(w).alias("n_foreign"),
        F.sum((script == "C").cast("int")).over(w).alias("n_cyr"), F.sum((script == "G").cast("int")).over(w).alias("n_greek"),
        F.coalesce(F.min(F.when(foreign, (F.col("latin") != "").cast("int"))).over(w), F.lit(1)).alias("can_latin"),
        F.coalesce(F.min(F.when(latin_like, F.coalesce((F.col("back") != "").cast("int"), F.lit(0)))).over(w), F.lit(1)).alias("can_cyr"),
        F.coalesce(F.min(F.when(latin_like, F.coalesce((F.col("back_greek") != "").cast("int"), F.lit(0)))).over(w), F.lit(1)).alias("can_greek"),
        F.sum((F.col("ch").rlike("\\p{L}")).cast("int")).over(w).alias("n_letters"),
        F.lag("cp").over(in_order).alias("cp_before"), F.lead("cp").over(in_order).alias("cp_after"),
    )
    mixed = (F.col("n_latin") > 0) & (F.col("n_foreign") > 0)
    to_latin_mixed = (F.col("can_latin") == 1) & ((F.col("can_cyr") == 0) | (F.col("n_cyr") == 0) | (F.col("fscript") != "C")) | ((F.col("can_latin") == 0) & (F.col("can_cyr") == 0) & (F.col("n_latin") >= F.col("n_foreign")))
    lone = (F.col("n_letters") == 1) & ~F.col("symbol")
    lone_to_latin = lone & (F.col("n_foreign") == 1) & (F.col("fscript") == "L") & ~F.col("ch").isin(*"νκιρυτχ")
    lone_to_cyr = lone & (F.col("n_latin") == 1) & (F.col("fscript") == "C") & F.col("ch").isin(*"acoeiyACOBKHM")
    keeps_mark = (F.col("kind") == "mark") & (F.col("fscript") == "H") | (F.col("cp") == 0x3000) & (F.col("fscript") == "H")
    joiner = F.col("cp").isin(0x200C, 0x200D) & joined(F.coalesce("cp_before", F.lit(0))) & joined(F.coalesce("cp_after", F.lit(0)))
    shown = (
        F.when(F.col("foreign") & (F.coalesce("latin", F.lit("")) != "") & ((mixed & to_latin_mixed) | lone_to_latin), F.col("latin"))
        .when((F.coalesce("back", F.lit("")) != "") & (F.col("n_cyr") > 0) & mixed & ~to_latin_mixed, F.col("back"))
        .when((F.coalesce("back_greek", F.lit("")) != "") & (F.col("n_greek") > 0) & (F.col("n_cyr") == 0) & mixed & ~to_latin_mixed, F.col("back_greek"))
        .when(lone_to_cyr & (F.coalesce("back", F.lit("")) != ""), F.col("back"))
        .when(keeps_mark | joiner, F.col("ch"))
        .otherwise(F.coalesce("parts", "ch"))
    )
    parts = points.select(*key, "pos", F.posexplode(F.split(shown, "")).alias("sub", "ch")).filter("ch <> ''")
    classes = mapping(words.sparkSession).filter("ccc > 0").select("cp", "ccc")
    parts = parts.withColumn("cp", F.expr("ascii(ch)")).join(F.broadcast(classes), "cp", "left").withColumn("ccc", F.coalesce("ccc", F.lit(0)))
    cluster = F.sum((F.col("ccc") == 0).cast("int")).over(Window.partitionBy(*key).orderBy("pos", "sub"))
    placed = parts.select(*key, F.struct(cluster.alias("cluster"), "ccc", "pos", "sub", "ch").alias("p"))
    built = placed.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["ch"]), "").alias("raw"))
    made = words.join(built, key, "left").select(*key, _recompose(F.coalesce("raw", F.lit(""))).alias("norm"))
    return made


def _fields(items: DataFrame) -> DataFrame:
    """(item_id, field_name, text, tokens, fscript) of live items whose field has anything beyond plain ASCII."""
    own = items.filter(live(F.col("deleted")) & F.col("item_id").isNotNull())
    long = own.select("item_id", F.explode(F.create_map(*[x for f in FIELDS for x in (F.lit(f), F.col(f))])).alias("field_name", "text"))
    odd = long.filter(F.col("text").rlike("[^\\x00-\\x7F]"))
    return odd.select("item_id", "field_name", "text", F.regexp_extract_all("text", F.lit(TOKENS), 0).alias("tokens"), _field_script(F.col("text")).alias("fscript"))


def _marked(fields: DataFrame) -> DataFrame:
    """Exploded tokens that may change: (item_id, field_name, at, tok, fscript, symbol)."""
    toks = fields.select("item_id", "field_name", "fscript", "tokens", F.posexplode("tokens").alias("at", "tok"))
    nxt, nxt2 = F.get("tokens", F.col("at") + 1), F.get("tokens", F.col("at") + 2)
    symbol = F.col("tok").rlike("^[\\u0370-\\u03FF]$") & F.coalesce(nxt.rlike("^[-\\u2010\\u2011\\u2013]$"), F.lit(False)) & F.coalesce(F.length(nxt2) >= 2, F.lit(False))
    toks = toks.select("item_id", "field_name", "fscript", "at", "tok", symbol.alias("symbol"))
    return toks.filter(F.col("tok").rlike("[^\\x00-\\x7F]") | ((F.col("fscript") == "C") & F.col("tok").rlike("^[A-Za-z]$")))


def changed_words(fields: DataFrame) -> DataFrame:
    """(tok, fscript, symbol, norm) of the words whose normal form differs."""
    words = _marked(fields).select("tok", "fscript", "symbol").distinct()
    return word_forms(cut_lineage(words)).filter("norm <> tok")


def odd_fields(items: DataFrame) -> DataFrame:
    """(item_id, field_name) of the fields that are not in normal form."""
    marked = _marked(_fields(items)).select("item_id", "field_name", "tok", "fscript", "symbol")
    return marked.join(changed_words(_fields(items)).select("tok", "fscript", "symbol"), ["tok", "fscript", "symbol"], "left_semi").select("item_id", "field_name").distinct()


def normal_forms(items: DataFrame) -> DataFrame:
    """(item_id, title, creators) of live items in normal form."""
    fields = _fields(items)
    marked = _marked(fields).join(changed_words(fields), ["tok", "fscript", "symbol"])
    swaps = marked.dropDuplicates(["item_id", "field_name", "at"]).groupBy("item_id", "field_name").agg(F.map_from_entries(F.collect_list(F.struct("at", "norm"))).alias("swap"))
    last = latest_delivery(items, "item_id", "synced_at", ["item_id", "deleted", *FIELDS]).filter(live(F.col("deleted")))
    wide = swaps.groupBy("item_id").agg(*[F.first(F.when(F.col("field_name") == f, F.col("swap")), ignorenulls=True).alias(f"swap_{f}") for f in FIELDS])
    out = last.join(wide, "item_id", "left")

    def rebuilt(f: str) -> Column:
        tokens = F.regexp_extract_all(f, F.lit(TOKENS), 0)
        swap = F.col(f"swap_{f}")
        return F.when(swap.isNull(), F.col(f)).otherwise(F.array_join(F.transform(tokens, lambda t, i: F.coalesce(F.element_at(swap, i), t)), "")).alias(f)

    return out.select("item_id", *[rebuilt(f) for f in FIELDS])


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return odd_fields(table(spark, folder, "zotero_items"))


def p3_normal(spark: SparkSession, folder: str) -> DataFrame:
    return normal_forms(table(spark, folder, "zotero_items"))


QUERIES = {"p3_found": p3_found, "p3_normal": p3_normal}
SQL: dict[str, str] = {}
