"""Problem 7: cutting long texts at natural boundaries, with an overlap.

Every position has a boundary strength (paragraph, sentence, line, clause, word, none). A sparse table over the strengths
answers in constant time where the strongest boundary of a window lies; ties go to the right, so a piece is as long as
it may be. The window of a cut reaches from half the limit to the limit; the next piece begins exactly the overlap before
the cut. Tables are built over stretches of a few windows, so a text's length does not matter for memory.

Defined results: null texts give no pieces, empty texts neither; texts within the limit are one piece. Where there is no
boundary at all, the cut is at the limit. Pieces always exceed the overlap. Repeated rows of an item: the one delivered
last. Offsets and lengths are in code points.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.fields import live
from foliant.session import table

PARAGRAPH, SENTENCE, LINE, CLAUSE, WORD = 5, 4, 3, 2, 1
_END = np.zeros(0x3100, dtype=bool)
_END[[ord(c) for c in ".!?…。।؟۔॥"]] = True
_WIDE_END = np.array([ord(c) for c in "！？｡．"])
_CLAUSE = [ord(c) for c in ",;:،؛、，；：—–"]
_CLOSE = [ord(c) for c in "\"”’»)]」』）"]


def strengths(text: str) -> np.ndarray:
    """Strength of a cut before each position 0..len (so behind the character before it)."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(cp)
    space = (cp == 32) | (cp == 9) | (cp == 0xA0) | (cp == 0x3000) | (cp == 10) | (cp == 13)
    newline = cp == 10
    low = np.minimum(cp, 0x30FF)
    end = _END[low] & (cp < 0x3100) | np.isin(cp, _WIDE_END)
    close = np.isin(cp, _CLOSE)
    sentence = end.copy()
    for _ in range(2):  # closing quotes and brackets behind the end belong to it
        sentence[1:] |= sentence[:-1] & close[1:]
    out = np.zeros(n + 1, dtype=np.int8)
    # cuts come behind the white space that follows
    after = np.zeros(n, dtype=np.int8)
    after[np.isin(cp, _CLAUSE)] = CLAUSE
    after[sentence] = SENTENCE
    spaceless_end = sentence & ~space & ((cp >= 0x3000) | (cp == 0x964))
    out[1:][spaceless_end] = SENTENCE
    here = np.flatnonzero(space)
    if len(here):
        first = here[np.concatenate([[True], np.diff(here) > 1])]
        last = here[np.concatenate([np.diff(here) > 1, [True]])]
        lines = np.concatenate([[0], np.cumsum(newline)])
        count = lines[last + 1] - lines[first]
        before = np.where(first > 0, after[np.maximum(first - 1, 0)], 0)
        strength = np.where(count >= 2, PARAGRAPH, np.where(before == SENTENCE, SENTENCE, np.where(count == 1, LINE, np.where(before == CLAUSE, CLAUSE, WORD))))
        np.maximum.at(out, last + 1, strength.astype(np.int8))
    out[n] = PARAGRAPH
    return out


class RangeMaximum:
    """Sparse table: the rightmost greatest value of any range in constant time."""

    def __init__(self, values: np.ndarray, widest: int):
        keyed = values.astype(np.int64) * (len(values) + 1) + np.arange(len(values))
        self.size = len(values) + 1
        self.levels = [keyed]
        span = 1
        while 2 * span <= min(widest, len(values)):
            last = self.levels[-1]
            self.levels.append(np.maximum(last[:-span], last[span:]))
            span *= 2

    def at(self, low: int, high: int) -> int:
        """Position of the rightmost maximum in [low, high]."""
        k = (high - low + 1).bit_length() - 1
        level = self.levels[k]
        return int(max(level[low], level[high - (1 << k) + 1]) % self.size)


def cut_points(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of consecutive pieces of at most ``limit`` characters; each starts ``overlap`` before the last end."""
    if limit <= 0 or not 0 <= overlap < limit:
        raise ValueError("limit must be positive and exceed the overlap")
    n = len(text)
    if n == 0:
        return []
    if n <= limit:
        return [(0, n)]
    values = strengths(text)
    least = min(limit, max(limit // 2, overlap + 1))
    out, start = [], 0
    base, index = 0, None
    stretch = 16 * limit
    while n - start > limit:
        low, high = start + least, start + limit
        if index is None or high >= base + stretch:
            base = start
            index = RangeMaximum(values[base : base + stretch + 1], limit)
        cut = base + index.at(low - base, high - base)
        if values[cut] == 0:
            cut = high
        out.append((start, cut))
        start = cut - overlap
    out.append((start, n))
    return out


PIECES = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _cut_column(text: Column, limit: int, overlap: int) -> Column:
    @F.pandas_udf(PIECES)
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": a, "end": b} for a, b in cut_points(t, limit, overlap)])

    return cut(text)


def _ranges(texts: DataFrame, limit: int, overlap: int) -> DataFrame:
    short = texts.filter(F.length("text") <= limit).select("item_id", "text", F.lit(0).alias("piece_no"), F.struct(F.lit(0).alias("start"), F.length("text").alias("end")).alias("_p"))
    long = texts.filter(F.length("text") > limit).select("item_id", "text", _cut_column(F.col("text"), limit, overlap).alias("_c")).select("item_id", "text", F.posexplode("_c").alias("piece_no", "_p"))
    return short.unionByName(long)


def pieces(texts: DataFrame, limit: int, overlap: int) -> DataFrame:
    """(item_id, piece_no, piece_start, piece_end, piece) of texts (item_id, text)."""
    rows = _ranges(texts.filter(F.length("text") > 0), limit, overlap)
    return rows.select("item_id", "piece_no", F.col("_p.start").alias("piece_start"), F.col("_p.end").alias("piece_end"), F.expr("substring(text, _p.start + 1, _p.end - _p.start)").alias("piece"))


def limits(spark: SparkSession, folder: str, name: str = "fulltext_piece") -> tuple[int, int]:
    row = table(spark, folder, "size_limits").filter(F.col("limit_name") == name).first()
    if row is None:
        raise ValueError(f"size_limits has no row {name}")
    return int(row.limit_value), int(row.overlap_value or 0)


def _fulltexts(items: DataFrame, at_least: int = 1) -> DataFrame:
    own = items.filter(live(F.col("deleted")) & F.col("item_id").isNotNull() & (F.length("fulltext") >= at_least))
    return own.select("item_id", "synced_at", F.col("fulltext").alias("text"))


def p7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    limit, overlap = limits(spark, folder)
    rows = _fulltexts(table(spark, folder, "zotero_items"))
    once = rows.groupBy("item_id").agg(F.max_by("text", F.coalesce(F.col("synced_at"), F.lit(0).cast("timestamp"))).alias("text"))
    return pieces(once, limit, overlap)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    limit, overlap = limits(spark, folder)
    cut = pieces(_fulltexts(table(spark, folder, "zotero_items")), limit, overlap)
    return cut.filter("piece_no = 1").select("item_id").distinct()


def p7_rejoined(spark: SparkSession, folder: str) -> DataFrame:
    """(item_id, within, overlapping, text_md5): whether all pieces keep to the limit and to the overlap, and the texts put together again."""
    limit, overlap = limits(spark, folder)
    cut = p7_pieces(spark, folder).select("item_id", F.struct("piece_no", "piece_start", "piece_end", "piece").alias("p"))
    whole = cut.groupBy("item_id").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    fresh = F.transform("ps", lambda p: F.when(p["piece_no"] == 0, p["piece"]).otherwise(F.substring(p["piece"], F.lit(overlap + 1), F.length(p["piece"]))))
    steps = F.forall(F.sequence(F.lit(1), F.size("ps")), lambda k: (k == F.size("ps")) | (F.get("ps", k)["piece_start"] == F.get("ps", k - 1)["piece_end"] - overlap))
    return whole.select("item_id", F.forall("ps", lambda p: F.length(p["piece"]) <= limit).alias("within"), steps.alias("overlapping"), F.md5(F.array_join(fresh, "").cast("binary")).alias("text_md5"))


QUERIES = {"p7_found": p7_found, "p7_pieces": p7_pieces, "p7_rejoined": p7_rejoined}
SQL = {
    "p7_found": """
        SELECT DISTINCT item_id FROM zotero_items
        WHERE NOT coalesce(deleted, false)
          AND length(fulltext) > (SELECT limit_value FROM size_limits WHERE limit_name = 'fulltext_piece')
    """,
    "p7_rejoined": """
        SELECT item_id, true AS within, true AS overlapping, md5(arg_max(fulltext, coalesce(synced_at, TIMESTAMP '1970-01-01'))) AS text_md5
        FROM zotero_items WHERE NOT coalesce(deleted, false) AND length(fulltext) > 0 GROUP BY item_id
    """,
}
