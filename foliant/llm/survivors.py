"""Problem 1: one surviving record for the entries of one work.

Entries are grouped by DOI; where chapters share the DOI of their book, also by title. A group's fields are
settled by token consensus: its distinct values are aligned progressively, every column of the alignment is
voted by weight, and the existing value nearest to the winning tokens is put out.

Large groups: entries are first folded to cells (DOI, title, chapter or not) with partial aggregates, and values
to distinct values with summed weights, both combined before the shuffle. Alignments are merged as a tree of
profiles, at most about ``BLOCK`` to a task's row, so no group is ever gathered whole.

Defined results: null or placeholder DOI: in no group. Null title: an empty title. Null dates come last; if no
date is known, the smallest item_id survives. No abstract in the group: abstract_item_id is null. Ties: the
nearest to the consensus (case aside; values all in one case last), the weightiest, the smallest item_id. Repeated rows of an item_id: the one delivered last counts.
Empty table: no rows. Columns beyond those named are ignored.
"""

from __future__ import annotations

import json
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.fields import doi_key, is_placeholder, live, moment, plain_text, title_key
from foliant.functions.text import LIGATURES, ascii_fold
from foliant.llm.charforms import LATIN_OF
from foliant.session import cut_lineage, latest_delivery, table

BLOCK = 24
FIELDS = ("title", "creators", "abstract")


# ---------------------------------------------------------------------------------------------- alignment


def profile_of(value: str, weight: float) -> list[dict[str, float]]:
    return [{t: weight} for t in value.lower().split()]


def merge_profiles(a: list[dict[str, float]], wa: float, b: list[dict[str, float]], wb: float) -> list[dict[str, float]]:
    """Global alignment of two profiles; a column's missing weight (to ``wa`` or ``wb``) is its gap weight."""
    head = 0
    n = min(len(a), len(b))
    top = lambda c: max(c, key=lambda t: (c[t], t))
    ta, tb = [top(c) for c in a], [top(c) for c in b]
    while head < n and ta[head] == tb[head]:
        head += 1
    tail = 0
    while tail < n - head and ta[-1 - tail] == tb[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    pairs = [(i, i) for i in range(head)]
    if x and y:
        score = [[0.0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(1, len(x) + 1):
            score[i][0] = -0.4 * i
        for j in range(1, len(y) + 1):
            score[0][j] = -0.4 * j
        for i, cx in enumerate(x, 1):
            above, here = score[i - 1], score[i]
            for j, cy in enumerate(y, 1):
                small, large = (cx, cy) if len(cx) < len(cy) else (cy, cx)
                same = sum(cx[t] / wa * cy[t] / wb for t in small if t in large)
                here[j] = max(above[j - 1] + 2 * same - 0.6, above[j] - 0.4, here[j - 1] - 0.4)
        i, j, back = len(x), len(y), []
        while i or j:
            if i and j:
                cx, cy = x[i - 1], y[j - 1]
                same = sum(cx[t] / wa * cy[t] / wb for t in cx if t in cy)
                if abs(score[i][j] - (score[i - 1][j - 1] + 2 * same - 0.6)) < 1e-9:
                    back.append((head + i - 1, head + j - 1))
                    i, j = i - 1, j - 1
                    continue
            if i and (not j or abs(score[i][j] - (score[i - 1][j] - 0.4)) < 1e-9):
                back.append((head + i - 1, None))
                i -= 1
            else:
                back.append((None, head + j - 1))
                j -= 1
        pairs += back[::-1]
    else:
        pairs += [(head + k, None) for k in range(len(x))] + [(None, head + k) for k in range(len(y))]
    pairs += [(len(a) - tail + k, len(b) - tail + k) for k in range(tail)]
    out = []
    for i, j in pairs:
        column: dict[str, float] = defaultdict(float)
        for side, k in ((a, i), (b, j)):
            if k is not None:
                for t, w in side[k].items():
                    column[t] += w
        out.append(dict(column))
    return out


def merge_all(profiles: list[tuple[float, list[dict[str, float]]]]) -> tuple[float, list[dict[str, float]]]:
    """Progressive alignment, the weightiest first. Columns that hardly anyone has are kept: later levels vote."""
    order = sorted(profiles, key=lambda p: (-p[0], json.dumps(p[1], sort_keys=True)))
    weight, out = order[0]
    for w, p in order[1:]:
        out = merge_profiles(out, weight, p, w)
        weight += w
    return weight, out


def vote(weight: float, profile: list[dict[str, float]]) -> list[str]:
    """Per column the weightiest token; a column drops out where the gap weighs more."""
    out = []
    for c in profile:
        token = max(c, key=lambda t: (c[t], t))
        if c[token] >= weight - sum(c.values()):
            out.append(token)
    return out


def token_distance(a: list[str], b: list[str]) -> float:
    """Edit distance over tokens by the longer length."""
    if a == b:
        return 0.0
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    row = list(range(len(y) + 1))
    for i, s in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (s != t))
    return row[-1] / max(len(a), len(b), 1)


@F.pandas_udf(T.StringType())
def _merge_udf(parts: pd.Series) -> pd.Series:
    def one(values):
        if len(values) == 1:
            return values[0]
        w, p = merge_all([tuple(json.loads(v)) for v in values])
        return json.dumps([w, p], ensure_ascii=False)

    return parts.map(one)


@F.pandas_udf(T.StringType())
def _start_udf(value: pd.Series, weight: pd.Series) -> pd.Series:
    return pd.Series([json.dumps([w, profile_of(v, w)], ensure_ascii=False) for v, w in zip(value, weight)], dtype=object)


@F.pandas_udf(T.DoubleType())
def _distance_udf(value: pd.Series, profile: pd.Series) -> pd.Series:
    out, cache = [], {}
    for v, p in zip(value, profile):
        if p not in cache:
            if len(cache) > 64:
                cache.clear()
            cache[p] = vote(*json.loads(p))
        out.append(token_distance(v.lower().split(), cache[p]))
    return pd.Series(out, dtype=float)


# ------------------------------------------------------------------------------------------------ groups


def compared_title(col: Column) -> Column:
    """A title as a key: look-alike and wide letters as the ordinary ones, no marks, no invisible characters."""
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
    seen, plain = "".join(LATIN_OF), "".join(LATIN_OF.values())
    x = F.translate(col, wide + seen, "".join(chr(ord(c) - 0xFEE0) for c in wide) + plain)
    x = F.regexp_replace(x, r"[\u00AD\u034F\u200B-\u200F\u202A-\u202E\u2060-\u2064\uFEFF\uFE00-\uFE0F]", "")
    for a, b in LIGATURES:
        x = F.replace(x, F.lit(a), F.lit(b))
    return title_key(ascii_fold(x))


def _deletion_keys(title: str) -> list[str]:
    """Keys that two titles share when they are equal but for one typing slip in one word, or a word more."""
    words = title.split()
    keys = {title}
    for i, w in enumerate(words):
        rest = " ".join(words[:i] + ["\x01"] + words[i + 1 :])
        if len(w) >= 4 and not w.isdigit():
            keys.update(f"{rest}\x02{w[:k]}{w[k + 1 :]}" for k in range(len(w)))
            keys.add(f"{rest}\x02{w}")
            keys.update(f"{rest}\x02{w[:k]}{w[k + 1]}{w[k]}{w[k + 2 :]}" for k in range(len(w) - 1))
    return sorted(keys)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _deletion_udf(title: pd.Series) -> pd.Series:
    return title.map(_deletion_keys)


def works(cells: DataFrame) -> DataFrame:
    """Give each cell (doi, title_key, chapter) its work: ``work`` is one title_key of the work's cells.

    Titles that are not chapters' are one work per DOI. A chapter belongs to the cells whose titles equal its own but
    for slips of typing, over any chain of such titles.
    """
    chapters = cells.filter("has_chapter")
    plain = cells.filter("not has_chapter").select("doi", "title_key", "chapter", F.lit("").alias("work"))
    nodes = chapters.groupBy("doi", "title_key").agg(F.min("chapter").alias("only_chapter"))
    keyed = nodes.select(
        "doi", "title_key", F.explode(F.concat(_deletion_udf("title_key"), F.when(F.col("only_chapter"), F.array().cast("array<string>")).otherwise(F.array(F.lit("\x03works"))))).alias("key")
    ).select("doi", "title_key", F.xxhash64("key").alias("key"))
    shared = keyed.groupBy("doi", "key").agg(F.count("*").alias("n"), F.min("title_key").alias("least")).filter("n > 1")
    keyed = cut_lineage(keyed.join(shared.select("doi", "key").hint("merge"), ["doi", "key"]))
    labels = nodes.select("doi", "title_key", F.col("title_key").alias("work"))
    while True:
        least = keyed.hint("merge").join(labels, ["doi", "title_key"]).groupBy("doi", "key").agg(F.min("work").alias("least"))
        better = keyed.hint("merge").join(least, ["doi", "key"]).groupBy("doi", "title_key").agg(F.min("least").alias("least"))
        labels = cut_lineage(
            labels.join(better, ["doi", "title_key"], "left").select(
                "doi", "title_key", F.least("work", F.coalesce("least", "work")).alias("work"), (F.coalesce("least", "work") < F.col("work")).alias("moved")
            )
        )
        if labels.filter("moved").isEmpty():
            break
        labels = labels.drop("moved")
    # explosions make the planner's size estimates too small, hence the merge hints
    named = chapters.join(labels.select("doi", "title_key", F.concat(F.lit("t:"), "work").alias("work")), ["doi", "title_key"])
    return plain.unionByName(named.select("doi", "title_key", "chapter", "work"))


def best_records(items: DataFrame) -> DataFrame:
    """One row per group of two or more live items of one work.

    Columns: group_item_id, n_items, survivor_item_id, abstract_item_id, doi, and for title, creators and abstract the
    chosen value and the smallest item_id that has it.
    """
    plain_abstract = plain_text(F.col("abstract"))
    slim = latest_delivery(
        items.select(
            "item_id", "deleted", "synced_at", doi_key(F.col("doi")).alias("doi"), moment(F.col("date_modified")).alias("at"),
            (F.coalesce("item_type", F.lit("")) == "bookSection").alias("chapter"), F.coalesce(compared_title(F.col("title")), F.lit("")).alias("title_key"),
            F.when(is_placeholder(plain_abstract), 0).otherwise(F.length(plain_abstract)).alias("readable"),
            F.when(F.col("doi").isNotNull(), F.col("title")).alias("title"), F.when(F.col("doi").isNotNull(), F.col("creators")).alias("creators"),
        ),
        "item_id", "synced_at", ["item_id", "deleted", "doi", "at", "chapter", "title_key", "readable", "title", "creators"],
    ).filter(live(F.col("deleted")) & F.col("doi").isNotNull())
    slim = cut_lineage(slim.drop("deleted"))
    cells = slim.groupBy("doi", "title_key", "chapter").agg(F.count("*").alias("n"))
    per_doi = cells.groupBy("doi").agg(F.sum("n").alias("n"), F.max("chapter").alias("has_chapter")).filter("n > 1").drop("n")
    cells = cut_lineage(cells.join(per_doi.hint("merge"), "doi"))
    member_cells = works(cells)
    # the number of entries of a work, from cells alone
    sizes = member_cells.join(cells.select("doi", "title_key", "chapter", "n"), ["doi", "title_key", "chapter"])
    several = sizes.groupBy("doi", "work").agg(F.sum("n").alias("n_items")).filter("n_items > 1")
    member_cells = member_cells.join(several.hint("merge"), ["doi", "work"])
    members = cut_lineage(slim.join(member_cells.hint("merge"), ["doi", "title_key", "chapter"]))

    newest = F.struct(F.coalesce(F.col("at").isNotNull(), F.lit(False)).alias("known"), F.coalesce(F.unix_micros("at"), F.lit(0)).alias("at"), (-F.col("item_id")).alias("neg"))
    heads = members.groupBy("doi", "work").agg(
        F.min("item_id").alias("group_item_id"), F.first("n_items").alias("n_items"), F.max(newest).alias("newest"), F.max("readable").alias("longest")
    )
    heads = cut_lineage(heads.select("doi", "work", "group_item_id", "n_items", (-F.col("newest.neg")).alias("survivor_item_id"), "longest"))

    # values of the members' fields; abstracts are fetched only for members
    abstracts = (
        items.select("item_id", "abstract", "synced_at")
        .filter(F.col("abstract").isNotNull())
        .join(members.filter("readable > 0").select("item_id"), "item_id")
        .groupBy("item_id").agg(F.max_by("abstract", F.coalesce(F.col("synced_at"), F.lit(0).cast("timestamp"))).alias("abstract"))
    )
    trust = (F.lit(1.0) + F.when(F.col("at").isNotNull(), 0.5).otherwise(0) + F.when(F.col("readable") > 0, 0.25).otherwise(0)).cast("double")
    base = members.select("doi", "work", "item_id", "readable", trust.alias("w"), "title", "creators")
    rows = base.select("doi", "work", "item_id", "readable", "w", F.explode(F.create_map(F.lit("title"), plain_text(F.col("title")), F.lit("creators"), plain_text(F.col("creators")))).alias("field", "value"))
    rows = rows.unionByName(base.join(abstracts, "item_id").select("doi", "work", "item_id", "readable", "w", F.lit("abstract").alias("field"), plain_text(F.col("abstract")).alias("value")))
    values = cut_lineage(
        rows.filter("value is not null and value <> ''")
        .groupBy("doi", "work", "field", "value")
        .agg(F.sum("w").alias("w"), F.min("item_id").alias("item_id"), F.max("readable").alias("readable"))
    )
    consensus = _consensus(values)
    scored = values.join(consensus.hint("merge"), ["doi", "work", "field"]).select(
        "doi", "work", "field", "value", "item_id", "w", F.when(F.col("field") == "abstract", F.col("readable")).otherwise(0).alias("readable"), _distance_udf("value", "profile").alias("distance")
    )
    shouted = (F.col("value") == F.upper("value")) | (F.col("value") == F.lower("value"))
    nearest = F.struct("distance", shouted.alias("shouted"), (-F.col("w")).alias("nw"), "item_id", "value")
    longest = F.struct((-F.col("readable")).alias("nr"), "distance", "item_id")
    picked = scored.groupBy("doi", "work", "field").agg(F.min(nearest).alias("v"), F.min(longest).alias("l"))
    wide = picked.groupBy("doi", "work").agg(
        *[F.max(F.when(F.col("field") == f, F.col("v.value"))).alias(f) for f in FIELDS],
        *[F.max(F.when(F.col("field") == f, F.col("v.item_id"))).alias(f"{f}_from") for f in FIELDS],
        F.max(F.when(F.col("field") == "abstract", F.col("l.item_id"))).alias("abstract_item_id"),
    )
    return heads.join(wide.hint("merge"), ["doi", "work"], "left").select(
        "group_item_id", "n_items", "survivor_item_id", "abstract_item_id", "doi", *FIELDS, *[f"{f}_from" for f in FIELDS]
    )


def _consensus(values: DataFrame) -> DataFrame:
    """(doi, work, field) -> profile, by a tree of merges of at most about BLOCK profiles each."""
    key = ["doi", "work", "field"]
    level = values.select(*key, F.xxhash64("value").alias("h"), _start_udf("value", "w").alias("profile"))
    while True:
        counts = level.groupBy(*key).agg(F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= BLOCK:
            merged = level.groupBy(*key).agg(F.sort_array(F.collect_list("profile")).alias("parts"))
            return merged.select(*key, _merge_udf("parts").alias("profile"))
        blocks = level.join(counts, key).withColumn("block", F.pmod("h", F.ceil(F.col("n") / (BLOCK // 2))))
        level = blocks.groupBy(*key, "block").agg(F.sort_array(F.collect_list("profile")).alias("parts"))
        level = cut_lineage(level.select(*key, F.xxhash64(F.lit(0), "block").alias("h"), _merge_udf("parts").alias("profile")))


def p1_records(spark: SparkSession, folder: str) -> DataFrame:
    return best_records(table(spark, folder, "zotero_items"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_records(spark, folder).select("group_item_id", "survivor_item_id", "abstract_item_id")


QUERIES = {"p1_found": p1_found, "p1_records": p1_records}
SQL: dict[str, str] = {}
