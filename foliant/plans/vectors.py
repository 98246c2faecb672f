"""Search in the vector table, and the stream-shaped queries run as batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions.geometry import cosine_distance
from foliant.operators import index
from foliant.operators.library import items
from foliant.plans.registry import live_sql, query
from foliant.session import table

DISTANCE = "list_sum(list_transform(list_zip(q.embedding, r.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))"


def _queries(spark, d, where: str = "vec_id % 20 = 0"):
    """The stated query set: every row whose id is divisible by 20."""
    return table(spark, d, "embeddings").filter(where).select(F.col("vec_id").alias("query_id"), "embedding")


@query(
    "m1_nearest",
    f"""SELECT q.vec_id AS query_id, r.vec_id, round({DISTANCE}, 4) AS distance FROM embeddings q, embeddings r WHERE q.vec_id % 20 = 0
        QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round({DISTANCE}, 6), r.vec_id) <= 10""",
)
def m1(spark, d):
    found = index.nearest(_queries(spark, d), table(spark, d, "embeddings").select("vec_id", "embedding"), 10)
    return found.select("query_id", "vec_id", F.round("distance", 4).alias("distance"))


@query(
    "f13_nearest_of_label",
    f"""SELECT q.vec_id AS query_id, r.vec_id FROM embeddings q, embeddings r WHERE q.vec_id % 20 = 0 AND r.label = 1
        QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round({DISTANCE}, 6), r.vec_id) <= 5""",
)
def f13(spark, d):
    return index.nearest(_queries(spark, d), table(spark, d, "embeddings").filter("label = 1").select("vec_id", "embedding"), 5).select("query_id", "vec_id")


@query("m1_nearest_by_lists", None)
def m1_lists(spark, d):
    """Approximate neighbours by an inverted-list index that holds every row."""
    rows = table(spark, d, "embeddings").select("vec_id", "embedding")
    return index.nearest_by_lists(_queries(spark, d), rows, 10, index.fit_lists(rows))


@query("m1_recall", None)
def m1_recall(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", "embedding")
    return index.recall(index.nearest_by_lists(_queries(spark, d), rows, 10, index.fit_lists(rows)), index.nearest(_queries(spark, d), rows, 10))


@query(
    "m2_similarities",
    f"""SELECT q.vec_id AS query_id, r.vec_id, round(list_inner_product(q.embedding::DOUBLE[], r.embedding::DOUBLE[])
          / sqrt(list_inner_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) / sqrt(list_inner_product(r.embedding::DOUBLE[], r.embedding::DOUBLE[])), 4) AS similarity
        FROM embeddings q, embeddings r WHERE q.vec_id % 20 = 0 QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round({DISTANCE}, 6), r.vec_id) <= 5""",
)
def m2(spark, d):
    """Similarity as one less the cosine distance, of each query and its neighbours."""
    rows, asked = table(spark, d, "embeddings").select("vec_id", "embedding"), _queries(spark, d)
    found = index.nearest(asked, rows, 5).join(asked.withColumnRenamed("embedding", "q"), "query_id").join(rows, "vec_id")
    return found.select("query_id", "vec_id", F.round(1 - cosine_distance(F.col("q"), F.col("embedding")), 4).alias("similarity"))


@query(
    "j11_neighbours_with_items",
    f"""SELECT n.query_id, n.vec_id, i.title FROM (SELECT q.vec_id AS query_id, r.vec_id FROM embeddings q, embeddings r WHERE q.vec_id % 20 = 0
        QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round({DISTANCE}, 6), r.vec_id) <= 3) n LEFT JOIN {live_sql('title')} i ON i.item_id = n.vec_id""",
)
def j11(spark, d):
    found = index.nearest(_queries(spark, d), table(spark, d, "embeddings").select("vec_id", "embedding"), 3)
    titles = items(spark, d, "title").select(F.col("item_id").alias("vec_id"), "title")
    return found.join(titles, "vec_id", "left").select("query_id", "vec_id", "title")


@query(
    "m3_reranked",
    f"""WITH w AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(lower(title), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '')) AS t FROM {live_sql('title')} WHERE contains(lower(title), 'memory'))
        SELECT item_id, round(len(list_intersect(['memory', 'and', 'syntax', 'in'], t)) / 4.0, 6) AS score FROM w ORDER BY score DESC, item_id LIMIT 10""",
)
def m3(spark, d):
    own = items(spark, d, "title").filter(F.lower("title").contains("memory"))
    best = index.reranked(own, index.overlap_score(F.lit("memory and syntax in"), F.col("title")), 10, ["item_id"])
    return best.select("item_id", F.round("score", 6).alias("score"))


@query("m14_hashed_embeddings", None)
def m14(spark, d):
    """Vectors of titles by feature hashing: no model."""
    return items(spark, d, "title").filter("title is not null").select("item_id", index.hashed_embedding(F.col("title"), 32).alias("embedding"))


@query("t1_event_windows", "SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS hour, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def t1(spark, d):
    counted = table(spark, d, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return counted.select("event_type", F.col("w.start").alias("hour"), "n", "total")


@query(
    "t2_event_sessions",
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
       s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS started, count(*) AS n FROM s GROUP BY user_id, k""",
)
def t2(spark, d):
    counted = table(spark, d, "events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return counted.select("user_id", F.col("w.start").alias("started"), "n")


@query(
    "t3_as_of",
    """SELECT e.event_id, p.event_id AS before_id FROM (SELECT * FROM events WHERE event_type = 'error') e ASOF LEFT JOIN (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click') p ON e.user_id = p.user_id AND e.ts >= p.ts""",
)
def t3(spark, d):
    """The click before each error of the same user: a union and a running last value, one shuffle."""
    from pyspark.sql import Window

    own = table(spark, d, "events").filter("event_type in ('error', 'click')").select("event_id", "user_id", "ts", (F.col("event_type") == "error").cast("int").alias("is_error"))
    w = Window.partitionBy("user_id").orderBy("ts", "is_error", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    before = F.last(F.when(F.col("is_error") == 0, F.col("event_id")), ignorenulls=True).over(w)
    return own.withColumn("before_id", before).filter("is_error = 1").select("event_id", "before_id")
