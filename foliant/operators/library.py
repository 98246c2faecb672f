"""The library's records: views without deletions and repetitions, hierarchies, duplicates, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions.fields import live
from foliant.functions.text import duplicate_title_key
from foliant.session import cut_lineage, table

CHILD_TYPES = ("attachment", "note", "annotation")


def items(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Live items, each once, with the given columns. Deliveries of one item differ in nothing but the time, so this is a
    distinct over what is asked for: it combines before the shuffle and needs no sort."""
    own = table(spark, folder, "zotero_items").filter(live(F.col("deleted")))
    return own.select("item_id", *[c for c in columns if c != "item_id"]).distinct()


def once(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = table(spark, folder, name)
    return (df.select(*columns) if columns else df).distinct()


def creators_text(spark: SparkSession, folder: str) -> DataFrame:
    """(item_id, creators_text): names in their order, joined by semicolons. Aggregated before any join with items."""
    names = once(spark, folder, "creators", "creator_id", "first_name", "last_name", "full_name")
    shown = F.coalesce("full_name", F.concat_ws(", ", "last_name", "first_name"))
    links = once(spark, folder, "item_creators", "item_id", "creator_id", "order_index")
    joined = salted_join(links, names.select("creator_id", shown.alias("shown")), "creator_id")
    ordered = F.sort_array(F.collect_list(F.struct("order_index", "creator_id", "shown")))
    return joined.groupBy("item_id").agg(F.array_join(F.transform(ordered, lambda c: c["shown"]), "; ").alias("creators_text"))


def notes_text(spark: SparkSession, folder: str) -> DataFrame:
    notes = once(spark, folder, "item_notes", "item_id", "parent_item_id", "note")
    ordered = F.sort_array(F.collect_list(F.struct("item_id", "note")))
    return notes.groupBy(F.col("parent_item_id").alias("item_id")).agg(F.array_join(F.transform(ordered, lambda n: n["note"]), " ").alias("notes_text"))


def unpivoted(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field, value) of the values that are not null."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(key, pairs.alias("p")).select(key, "p.field", "p.value").filter("value is not null")


def pivoted(long: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key from field-value rows, in one aggregation."""
    return long.groupBy(key).agg(*[F.max(F.when(F.col("field") == c, F.col("value"))).alias(c) for c in columns])


def either_key_join(left: DataFrame, right: DataFrame, left_key: str, right_keys: tuple[str, str], how: str = "inner") -> DataFrame:
    """Join on ``left_key = first OR left_key = second`` as two equi-joins; a pair that meets twice comes once."""
    first, second = right_keys
    a = left.join(right, F.col(left_key) == F.col(first), how)
    b = left.join(right.filter(~F.col(first).eqNullSafe(F.col(second))), F.col(left_key) == F.col(second), "inner")
    return a.unionByName(b)


def best_per_parent(df: DataFrame, parent: str, order: list[Column]) -> DataFrame:
    """The first row per parent in the given order, by a partial aggregation of the least sort key (no window, no sort)."""
    rest = [c for c in df.columns if c != parent]
    keys = [o.alias(f"_o{k}") for k, o in enumerate(order)]
    return df.groupBy(parent).agg(F.min(F.struct(*keys, F.struct(*rest).alias("row"))).alias("_m")).select(parent, *[F.col(f"_m.row.{c}").alias(c) for c in rest])


def attachment_rank(content_type: Column) -> Column:
    return F.when(content_type == "application/pdf", 0).when(content_type == "text/html", 1).otherwise(2)


def resolved_path(item_key: Column, path: Column, storage: str = "/storage", base: str = "/base") -> Column:
    """Where an attachment lies: stored, linked under a base folder, a file URL or an absolute path; null for other schemes."""
    x = F.coalesce(path, F.lit(""))
    return (
        F.when(x.startswith("storage:"), F.concat(F.lit(storage + "/"), item_key, F.lit("/"), F.substring(x, 9, 10**6)))
        .when(x.startswith("attachments:"), F.concat(F.lit(base + "/"), F.substring(x, 13, 10**6)))
        .when(x.startswith("file://"), F.expr("url_decode(replace(substring(coalesce(attachment_path, ''), 8), '+', '%2B'))"))
        .when(x.startswith("/"), x)
    )


def child_summary(spark: SparkSession, folder: str) -> DataFrame:
    """(parent_item_id, has_pdf, n_attachments, has_notes) in one pass over both kinds of children."""
    files = once(spark, folder, "item_attachments", "item_id", "parent_item_id", "content_type").select("parent_item_id", F.lit("a").alias("kind"), "content_type")
    notes = once(spark, folder, "item_notes", "item_id", "parent_item_id").select("parent_item_id", F.lit("n").alias("kind"), F.lit(None).cast("string").alias("content_type"))
    both = files.unionByName(notes).filter("parent_item_id is not null")
    pdf = F.coalesce(F.col("content_type") == "application/pdf", F.lit(False))
    return both.groupBy("parent_item_id").agg(F.bool_or(pdf).alias("has_pdf"), F.count_if(F.col("kind") == "a").alias("n_attachments"), F.bool_or(F.col("kind") == "n").alias("has_notes"))


def collection_paths(collections: DataFrame) -> DataFrame:
    """(collection_key, depth, path): where each collection stands below its top one, at any depth.

    Every row points to an ancestor and knows the way down from it; a round lets it take over its ancestor's own pointer, so
    ways double in length and a tree of any depth is done in the logarithm of it. Rows on a cycle, or below one, never get to a
    top: they come out with null depth and path.
    """
    base = collections.select("collection_key", "collection_name", "parent_collection").dropDuplicates(["collection_key"])
    known = base.select(F.col("collection_key").alias("above"))
    linked = base.join(known, F.col("parent_collection") == F.col("above"), "left")
    ways = cut_lineage(linked.select("collection_key", "above", F.col("above").isNotNull().cast("int").alias("depth"), F.col("collection_name").alias("path")))
    for _ in range(ways.count().bit_length() + 1):
        if ways.filter("above is not null").isEmpty():
            break
        up = ways.select(F.col("collection_key").alias("above"), F.col("above").alias("_above"), F.col("depth").alias("_depth"), F.col("path").alias("_path"))
        joined = ways.join(up, "above", "left")
        ways = cut_lineage(joined.select("collection_key", F.col("_above").alias("above"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), F.concat_ws(" / ", "_path", "path").alias("path")))
    done = F.col("above").isNull()
    return ways.select("collection_key", F.when(done, F.col("depth")).alias("depth"), F.when(done, F.col("path")).alias("path"))


def duplicate_groups(df: DataFrame, method: str = "both") -> DataFrame:
    """(group_key, n_items, first_item_id): items that share a title key or a DOI, groups of two and more. Their members, which
    may be any number, are rows of ``duplicate_members``."""
    keyed = _duplicate_keys(df, method)
    return keyed.groupBy("group_key").agg(F.count("*").alias("n_items"), F.min("item_id").alias("first_item_id")).filter("n_items > 1")


def duplicate_members(df: DataFrame, method: str = "both") -> DataFrame:
    """(group_key, item_id): the members of the groups of two and more. A hot group is spread over tasks."""
    keyed = _duplicate_keys(df, method)
    groups = keyed.groupBy("group_key").agg(F.count("*").alias("n")).filter("n > 1").select("group_key")
    return salted_join(keyed, groups, "group_key", "inner").select("group_key", "item_id")


def _duplicate_keys(df: DataFrame, method: str) -> DataFrame:
    if method not in ("title", "doi", "both"):
        raise ValueError("method must be title, doi or both")
    title = duplicate_title_key(F.coalesce("title", F.lit("")))
    doi = F.lower(F.trim(F.coalesce("doi", F.lit(""))))
    keys = []
    if method != "doi":
        keys.append(F.when(title != "", F.concat(F.lit("title:"), title)))
    if method != "title":
        keys.append(F.when(doi != "", F.concat(F.lit("doi:"), doi)))
    return df.select("item_id", F.explode(F.array_compact(F.array(*keys))).alias("group_key"))


def merge_preview(items_: DataFrame, attachments: DataFrame, keeper: int, losers: list[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What merging would do: the keeper with the union of the collections, the attachments that move, the items that go.

    An attachment moves unless one with the same type, name, checksum and title is at the keeper, or moves already.
    """
    group = items_.filter(F.col("item_id").isin(keeper, *losers))
    union = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("collections", F.array().cast("array<string>"))))))
    kept = group.agg(union.alias("collections")).select(F.lit(keeper).cast("long").alias("item_id"), "collections")
    sign = [F.coalesce(c, F.lit("")).alias(f"s{k}") for k, c in enumerate(("content_type", "filename", "md5", "title"))]
    files = attachments.filter(F.col("parent_item_id").isin(keeper, *losers)).select("item_id", "parent_item_id", *sign)
    own = files.filter(F.col("parent_item_id") == keeper).select("s0", "s1", "s2", "s3").distinct()
    moving = files.filter(F.col("parent_item_id") != keeper).join(own, ["s0", "s1", "s2", "s3"], "left_anti")
    moving = moving.groupBy("s0", "s1", "s2", "s3").agg(F.min("item_id").alias("item_id")).select("item_id", F.lit(keeper).cast("long").alias("parent_item_id"))
    gone = group.filter(F.col("item_id") != keeper).select("item_id", F.lit(True).alias("deleted"))
    return kept, moving, gone


def set_edit(column: str, add: list[str], remove: list[str]) -> Column:
    """An array as a set with values added and removed; sorted."""
    own = F.coalesce(column, F.array().cast("array<string>"))
    new = F.array_union(own, F.array(*[F.lit(x) for x in add]).cast("array<string>"))
    return F.array_sort(F.array_except(new, F.array(*[F.lit(x) for x in remove]).cast("array<string>")))


def field_changes(df: DataFrame, key: str, changes: dict[str, Column]) -> DataFrame:
    """(key, field, old, new) for the fields that the changes would alter."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("old"), new.cast("string").alias("new")) for f, new in changes.items()]))
    return df.select(key, pairs.alias("c")).select(key, "c.field", "c.old", "c.new").filter(~F.col("old").eqNullSafe(F.col("new")))


def running_offsets(df: DataFrame, group: str, order: str, length: Column, rows: int = 65_536) -> DataFrame:
    """Each row's start and end when the rows of a group stand one behind the other, in the order of a whole number.

    A group is cut into ranges of that number, of about ``rows`` rows; each range is summed by itself, and what comes before it is
    the running sum of the ranges' sums. So a group of any size is spread over tasks.
    """
    sized = df.withColumn("_len", length.cast("long"))
    low, high, n = df.agg(F.min(order), F.max(order), F.count("*")).first()
    if low is None:
        return sized.withColumn("start_at", F.lit(0).cast("long")).withColumn("end_at", F.col("_len")).drop("_len")
    width = max(rows, -(-(high - low + 1) * rows // n))
    ranged = sized.withColumn("_range", F.expr(f"coalesce(({order} - {low}) div {width}, -1)"))
    inside = Window.partitionBy(group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_r")).agg(F.sum("_len").alias("_sum"))
    earlier = Window.partitionBy("_group").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_group", "_r", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_in", F.coalesce(F.sum("_len").over(inside), F.lit(0))).join(sums, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_r")))
    return placed.withColumn("start_at", F.col("_before") + F.col("_in")).withColumn("end_at", F.col("start_at") + F.coalesce("_len", F.lit(0))).drop("_len", "_range", "_in", "_group", "_r", "_before")


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "left", share: float = 0.005, salts: int = 64) -> DataFrame:
    """``big`` joined with ``small`` on ``key`` where few values hold much of ``big``: their rows are spread over ``salts`` tasks and
    their rows of ``small`` are repeated. Values above ``share`` of the rows are hot, so there are at most 1 / share of them."""
    n = big.count()
    hot = [r[0] for r in big.groupBy(key).count().filter(F.col("count") > max(share * n, 10_000)).filter(F.col(key).isNotNull()).collect()]
    if not hot:
        return big.join(small, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    spread = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*big.columns), F.lit(salts))).otherwise(0).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")


def containing(points: DataFrame, ranges: DataFrame, group: str, point: str, step: int) -> DataFrame:
    """Points in the range [start_at, end_at) of their group that holds them: an equi-join on the group and coarse cells, so
    that a point meets only the ranges of its cell."""
    cells = F.explode(F.sequence(F.floor(F.col("start_at") / step), F.floor(F.greatest(F.col("end_at") - 1, F.col("start_at")) / step)))
    celled = ranges.filter("end_at > start_at").withColumn("_cell", cells)
    return points.withColumn("_cell", F.floor(F.col(point) / step)).join(celled, [group, "_cell"]).filter((F.col(point) >= F.col("start_at")) & (F.col(point) < F.col("end_at"))).drop("_cell")


def overlapping(a: DataFrame, b: DataFrame, group: list[str], a_range: tuple[str, str], b_range: tuple[str, str], step: float) -> DataFrame:
    """Pairs whose ranges overlap: an equi-join on group and coarse cells; a pair that shares several cells comes once, in
    the first cell both have."""
    cell = lambda r: F.sequence(F.floor(F.col(r[0]) / step), F.floor(F.col(r[1]) / step))
    left = a.withColumn("_cell", F.explode(cell(a_range)))
    right = b.withColumn("_cell", F.explode(cell(b_range)))
    met = left.join(right, [*group, "_cell"]).filter((F.col(a_range[0]) < F.col(b_range[1])) & (F.col(a_range[1]) > F.col(b_range[0])))
    first = F.greatest(F.floor(F.col(a_range[0]) / step), F.floor(F.col(b_range[0]) / step))
    return met.filter(F.col("_cell") == first).drop("_cell")
