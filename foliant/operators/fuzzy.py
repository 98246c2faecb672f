"""Finding a quotation in a text that differs in blanks, dashes or single letters."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MATCH = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])


def threshold_for(length: Column) -> Column:
    """Longer quotations may differ more."""
    return F.when(length <= 50, 0.85).when(length <= 150, 0.75).otherwise(0.65)


#: Longer patterns than so many words of 64 bits are aligned one place at a time, with whole numbers of any length.
LANE_WORDS = 6


def common_lengths(codes: np.ndarray, starts: np.ndarray, width: int, pattern: np.ndarray) -> np.ndarray:
    """For each start, the length of the longest common subsequence of ``pattern`` and the ``width`` characters from there.

    Bit-parallel: a row of the dynamic program is one number of as many bits as the pattern has characters, and all starts go
    through it side by side. ``codes`` must reach ``width`` beyond the last start.
    """
    size, kinds = len(pattern), np.unique(pattern)
    slot = np.searchsorted(kinds, codes)
    slot = np.where((slot < len(kinds)) & (kinds[np.minimum(slot, len(kinds) - 1)] == codes), slot, len(kinds))
    words = -(-size // 64)
    if words > LANE_WORDS:
        masks = [sum(1 << int(i) for i in np.flatnonzero(pattern == k)) for k in kinds] + [0]
        full, out = (1 << size) - 1, []
        for at in starts.tolist():
            row = full
            for c in slot[at : at + width].tolist():
                met = row & masks[c]
                row = ((row + met) | (row - met)) & full
            out.append(size - row.bit_count())
        return np.array(out, dtype=np.int64)
    masks = np.zeros((words, len(kinds) + 1), dtype=np.uint64)
    for i, k in enumerate(np.searchsorted(kinds, pattern)):
        masks[i // 64, k] |= np.uint64(1) << np.uint64(i % 64)
    rows = [np.full(len(starts), ~np.uint64(0)) for _ in range(words)]
    for step in range(width):
        own = slot[starts + step]
        carry = None
        for w in range(words):
            row = rows[w]
            met = row & masks[w][own]
            total = row + met
            over = total < row
            if carry is not None:
                more = total + carry
                over |= more < total
                total = more
            rows[w] = total | (row ^ met)
            carry = over.astype(np.uint64)
    ones = sum(np.bitwise_count(r if w < words - 1 or size % 64 == 0 else r & np.uint64((1 << size % 64) - 1)).astype(np.int64) for w, r in enumerate(rows))
    return size - ones


def best_window(text: str, pattern: str, least: float = 0.0, widen: float = 1.2) -> tuple[int, int, float]:
    """The window of ``text`` most like ``pattern`` by matching-block ratio: (start, end, ratio). Windows are a little wider
    than the pattern and start anywhere.

    No window that reaches ``least`` is missed: matching blocks are a common subsequence, so the longest one bounds the ratio.
    It is found for stretches of windows, then for the windows of the stretches whose bound reaches ``least``, and ratios are
    measured from the greatest bound down until none can be better. Ties: the greatest bound, then the first. Where no window
    reaches ``least``, the ratio is that of a window with the greatest bound.
    """
    if not text or not pattern:
        return 0, 0, 0.0
    exact = text.find(pattern)
    if exact >= 0:
        return exact, exact + len(pattern), 1.0
    size = len(pattern)
    width = min(max(1, int(size * widen)), len(text))
    last = len(text) - width + 1
    stride = max(1, width // 4)
    codes = np.frombuffer((text + "\0" * stride).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    own = np.frombuffer(pattern.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    firsts = np.arange(0, last, stride)
    bounds = 2 * common_lengths(codes, firsts, width + stride - 1, own) / (width + size)
    matcher = SequenceMatcher(None, autojunk=False)
    matcher.set_seq2(pattern)

    def ratio(at: int) -> float:
        matcher.set_seq1(text[at : at + width])
        return matcher.ratio()

    best = (0, 0, 0.0)
    order = np.argsort(-bounds, kind="stable")
    groups = [order[:1], *np.array_split(order[1:], range(7, len(order), 64))] if len(order) > 1 else [order]
    for group in groups:  # stretches of like bounds at a time
        group = group[bounds[group] >= max(least, best[2])]
        if not len(group):
            break
        places = np.sort((firsts[group][:, None] + np.arange(stride)).ravel())
        places = places[places < last]
        reach = 2 * common_lengths(codes, places, width, own) / (width + size)
        for k in np.argsort(-reach, kind="stable"):
            if reach[k] <= best[2] or reach[k] < least:
                break
            value = ratio(int(places[k]))
            if value > best[2]:
                best = (int(places[k]), int(places[k]) + width, value)
    if best[2] == 0.0:
        at = int(firsts[order[0]])
        best = (at, at + width, ratio(at))
    return best


def fuzzy_find(text: Column, pattern: Column, least: Column) -> Column:
    """Start, end and ratio of the window of ``text`` most like ``pattern``; exact wherever the ratio reaches ``least``."""

    @F.pandas_udf(MATCH)
    def find(texts: pd.Series, patterns: pd.Series, leasts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_window(t or "", p or "", x) for t, p, x in zip(texts, patterns, leasts.fillna(0.0))], columns=["start", "end", "score"])

    return find(text, pattern, least)


def anchored(text: Column, pattern: Column, size: int = 40) -> Column:
    """For long quotations: where its first and last characters stand in order; -1 where they do not."""
    head, tail = F.substring(pattern, F.lit(1), F.lit(size)), F.right(pattern, F.lit(size))
    start = F.call_function("locate", head, text)
    end = F.call_function("locate", tail, text, F.greatest(start, F.lit(1)))
    return F.when((start > 0) & (end > 0), F.struct((start - 1).alias("start"), (end - 1 + F.length(tail)).alias("end"))).otherwise(F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end")))


def on_pages(marks: DataFrame, pages: DataFrame, around: int = 2) -> DataFrame:
    """(item_id, work_id, page, way, start_at, end_at, score): each quotation on the page it names, else on the nearest of the pages
    up to ``around`` before and behind; on a page by its first and last characters where it is long, exactly, by ratio.

    ``marks``: item_id, work_id, page, p (the quotation); ``pages``: work_id, page, t. Not found: null page and way, and the best ratio.
    A quotation meets its own pages only, by an equi-join on work and page.
    """
    least = threshold_for(F.length("p"))
    near = F.sequence(F.greatest(F.lit(0), F.col("page") - around), F.col("page") + around)
    asked = marks.filter("page is not null").withColumn("named", F.col("page")).withColumn("page", F.explode(near))
    met = asked.join(pages, ["work_id", "page"]).withColumn("least", least)
    placed = met.withColumn("a", F.when(F.length("p") > 100, anchored(F.col("t"), F.col("p")))).withColumn("at", F.call_function("locate", F.col("p"), F.col("t")))
    plain = (F.coalesce(F.col("a.start"), F.lit(-1)) < 0) & (F.col("at") == 0)
    tried = placed.withColumn("m", fuzzy_find(F.col("t"), F.when(plain, F.col("p")), F.col("least")))
    way = F.when(F.col("a.start") >= 0, "anchor").when(F.col("at") > 0, "exact").when(plain & (F.col("m.score") >= F.col("least")), "fuzzy")
    place = lambda anchor, exact, fuzzy: F.when(F.col("a.start") >= 0, anchor).when(F.col("at") > 0, exact).when(F.col("m.score") >= F.col("least"), fuzzy)
    start = place(F.col("a.start"), F.col("at") - 1, F.col("m.start"))
    end = place(F.col("a.end"), F.col("at") - 1 + F.length("p"), F.col("m.end"))
    score = F.when(plain, F.col("m.score")).otherwise(1.0)
    rows = tried.select("item_id", "work_id", "page", way.alias("way"), start.alias("start_at"), end.alias("end_at"), score.alias("score"), F.abs(F.col("page") - F.col("named")).alias("far"))
    found = F.struct(F.col("way").isNull().alias("missed"), F.when(F.col("way").isNull(), -F.col("score")).otherwise(0.0).alias("s"), "far", "page", "way", "start_at", "end_at", "score")
    best = rows.groupBy("item_id", "work_id").agg(F.min(found).alias("f"))
    return best.select("item_id", "work_id", F.when(~F.col("f.missed"), F.col("f.page")).alias("page"), "f.way", "f.start_at", "f.end_at", "f.score")
