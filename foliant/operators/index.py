"""The text and vector index: what is stored, what is refreshed, how it is written and searched."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.text import note_text
from foliant.session import hashed_sample

CUT = 50_000


def _filled(col: Column) -> Column:
    return F.when(F.length(col) > 0, col)


def document_text(title: Column, creators: Column, abstract: Column, note: Column) -> Column:
    """The filled ones of title, creators, abstract and note without tags, joined by blanks."""
    return F.concat_ws(" ", _filled(title), _filled(creators), _filled(abstract), _filled(note_text(note)))


def searchable_text(title: Column, creators: Column, abstract: Column, fulltext: Column) -> Column:
    """Labelled sections; the full text is cut at ``CUT`` characters."""
    cut = F.when(F.length(fulltext) > CUT, F.concat(F.substring(fulltext, 1, CUT), F.lit("..."))).otherwise(fulltext)
    part = lambda label, c: F.when(F.length(c) > 0, F.concat(F.lit(f"{label}: "), c))
    return F.concat_ws("\n\n", part("Title", title), part("Authors", creators), part("Abstract", abstract), part("Full text", cut))


def fulltext_state(fulltext: Column, source: Column) -> Column:
    return F.when(F.length(fulltext) > 0, "ok").when(source.isNotNull(), "failed").otherwise("none")


def refresh_decisions(current: DataFrame, index: DataFrame) -> DataFrame:
    """What to do with each item: (key, decision).

    ``current``: key, date_modified, has_file. ``index``: key, indexed_modified, state (ok, failed, none). New items are
    extracted; failed ones again once they changed; those without text where there is a file now are updated; else skip.
    """
    both = current.join(index, "key", "left")
    decision = (
        F.when(F.col("state").isNull(), "extract")
        .when((F.col("state") == "failed") & F.col("date_modified").eqNullSafe(F.col("indexed_modified")), "skip")
        .when(F.col("state") == "failed", "retry")
        .when((F.col("state") == "none") & F.col("has_file"), "update")
        .otherwise("skip")
    )
    return both.select("key", decision.alias("decision"))


def upsert(index: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The index with the rows of ``changes`` put in place of those with their keys."""
    return index.join(changes.select(key), key, "left_anti").unionByName(changes, allowMissingColumns=True)


def upsert_counts(index: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """One row: processed, added, updated."""
    known = index.select(F.col(key)).distinct().withColumn("_known", F.lit(True))
    return changes.join(known, key, "left").agg(F.count("*").alias("processed"), F.count_if(F.col("_known").isNull()).alias("added"), F.count_if(F.col("_known")).alias("updated"))


#: What is broadcast of a query set at once, and the cells in which distances are taken.
QUERY_BYTES, CELL_QUERIES, CELL_ROWS = 16_000_000, 1024, 4096


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T)


def _vectors(column) -> np.ndarray:
    return np.array(list(column), dtype=np.float64)


def _least(ids: np.ndarray, distances: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k least of each row of ``distances`` and some more, so that ties at the end can be settled later."""
    if distances.shape[1] <= k:
        return ids, distances
    at = np.argpartition(distances, k - 1, axis=1)[:, :k]
    return np.take_along_axis(ids, at, 1), np.take_along_axis(distances, at, 1)


def nearest(queries: DataFrame, rows: DataFrame, k: int, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Exact k nearest rows (squared Euclidean) of each query: (query_id, vec_id, distance, rank).

    ``queries``: query_id, embedding; ``rows``: vec_id, embedding. Queries are broadcast in blocks of at most ``query_bytes``, and
    each block goes once past all rows where they lie: rows are never shuffled, each task keeps k rows a query, and only
    those are.
    """
    count = queries.count()
    if not count:
        return queries.sparkSession.createDataFrame([], "query_id long, vec_id long, distance double, rank int")
    dims = queries.agg(F.max(F.size("embedding"))).first()[0] or 1
    blocks = max(1, -(-count * (dims + 1) * 8 // query_bytes))
    own = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    found = [_nearest_of_block(queries.filter(own == b) if blocks > 1 else queries, rows, k) for b in range(blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return top_per_query(out, k)


def _nearest_of_block(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    got = queries.select("query_id", "embedding").toPandas()
    keep = k + 8
    shared = queries.sparkSession.sparkContext.broadcast((got["query_id"].to_numpy(dtype=np.int64), _vectors(got["embedding"])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, asked = shared.value
        if not len(names):
            return
        best = [(np.empty((min(CELL_QUERIES, len(names) - q), 0), dtype=np.int64), np.empty((min(CELL_QUERIES, len(names) - q), 0))) for q in range(0, len(names), CELL_QUERIES)]
        for pdf in batches:
            for at in range(0, len(pdf), CELL_ROWS):
                part = pdf.iloc[at : at + CELL_ROWS]
                ids, vectors = part["vec_id"].to_numpy(dtype=np.int64), _vectors(part["embedding"])
                for n, q in enumerate(range(0, len(names), CELL_QUERIES)):
                    d = _squared(asked[q : q + CELL_QUERIES], vectors)
                    near = _least(np.broadcast_to(ids, d.shape), d, keep)
                    best[n] = _least(np.hstack([best[n][0], near[0]]), np.hstack([best[n][1], near[1]]), keep)
        for n, q in enumerate(range(0, len(names), CELL_QUERIES)):
            ids, d = best[n]
            if ids.size:
                yield pd.DataFrame({"query_id": np.repeat(names[q : q + CELL_QUERIES], ids.shape[1]), "vec_id": ids.ravel(), "distance": d.ravel()})

    return rows.select("vec_id", "embedding").mapInPandas(run, "query_id long, vec_id long, distance double")


def top_per_query(found: DataFrame, k: int, parts: int = 64) -> DataFrame:
    """The k nearest of each query with their rank; ties go to the smaller id. In two steps, so that no list holds all that the
    tasks found of a query."""
    # distances are rounded so that equal ones tie whatever the order of the sums
    ordered = F.slice(F.sort_array(F.collect_list(F.struct(F.round("distance", 6).alias("r"), "vec_id", "distance"))), 1, k)
    first = found.groupBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("_part")).agg(ordered.alias("n")).select("query_id", F.explode("n").alias("n")).select("query_id", "n.vec_id", "n.distance")
    rows = first.groupBy("query_id").agg(ordered.alias("n")).select("query_id", F.posexplode("n").alias("rank", "n"))
    return rows.select("query_id", F.col("n.vec_id").alias("vec_id"), F.col("n.distance").alias("distance"), (F.col("rank") + 1).alias("rank"))


@dataclass(frozen=True)
class Lists:
    """Centres of an inverted-list index, and how many lists a query has to look into."""

    centres: np.ndarray
    probes: int


#: The bounds of the fitting sample, and of the lists (their centres are broadcast).
FIT_ROWS, MOST_LISTS = 32_768, 4096


def fit_lists(rows: DataFrame, lists: int | None = None, sample: int = FIT_ROWS, rounds: int = 12, k: int = 10, target: float = 0.98) -> Lists:
    """An inverted-list index fitted on at most ``sample`` rows (those with the smallest hashes of their id).

    Centres by k-means, by default about the square root of the number of rows, with at least eight rows of the sample to each. The
    number of probes is the least at which, among the sample, the lists of ``target`` of the ``k`` nearest neighbours are
    looked into; neighbours are farther apart in a sample than in all rows, so this errs to more.
    """
    lists = lists or min(MOST_LISTS, max(1, round(rows.count() ** 0.5)))
    got = hashed_sample(rows.select("vec_id", "embedding"), "vec_id", sample)
    if not got:
        return Lists(np.zeros((1, 0)), 1)  # no rows: one list, wherever a query lies
    x = _vectors(r.embedding for r in got)
    lists = max(1, min(lists, len(x) // 8))
    centres = x[np.linspace(0, len(x) - 1, lists).astype(int)].copy()

    def owners(vectors: np.ndarray) -> np.ndarray:
        return np.concatenate([_squared(vectors[i : i + CELL_ROWS], centres).argmin(1) for i in range(0, len(vectors), CELL_ROWS)])

    for _ in range(rounds):
        own = owners(x)
        order = np.argsort(own, kind="stable")
        names, starts = np.unique(own[order], return_index=True)
        centres[names] = np.add.reduceat(x[order], starts, axis=0) / np.diff(np.append(starts, len(x)))[:, None]
    asked = x[:: max(1, len(x) // 250)]
    rank_of = np.argsort(np.argsort(_squared(asked, centres), axis=1), axis=1)  # rank of each list for each query
    near = np.argsort(_squared(asked, x), axis=1)[:, : k + 1]
    ranks = np.sort(np.take_along_axis(rank_of, owners(x)[near], axis=1).ravel())
    return Lists(centres, int(ranks[min(len(ranks) - 1, int(target * len(ranks)))]) + 1)


def nearest_by_lists(queries: DataFrame, rows: DataFrame, k: int, fitted: Lists) -> DataFrame:
    """Approximate k nearest: every row is in the list of its nearest centre; a query joins its ``probes`` nearest lists.

    The centres (a bounded number) are all that is broadcast. A list is kept in cells of at most about ``CELL_ROWS`` rows, its queries
    in cells of ``CELL_QUERIES``; each pair of cells of a list is one matrix product that keeps k rows a query, so neither a hot
    list nor a hot query meets in one task. Distances of the rows met are exact.
    """
    shared = rows.sparkSession.sparkContext.broadcast(fitted.centres)

    def assigned(df: DataFrame, key: str, n: int, size: int) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            c = shared.value
            for pdf in batches:
                if len(pdf):
                    d = _squared(_vectors(pdf["embedding"]), c) if c.shape[1] else np.zeros((len(pdf), 1))
                    pdf["lists"] = list(np.argsort(d, axis=1)[:, :n].astype(np.int32) if n > 1 else d.argmin(1)[:, None].astype(np.int32))
                    yield pdf[[key, "embedding", "lists"]]

        out = df.select(key, "embedding").mapInPandas(run, f"{key} long, embedding array<float>, lists array<int>")
        out = out.select(key, "embedding", F.explode("lists").alias("list"))
        sizes = out.groupBy("list").agg(F.ceil(F.count("*") / size).cast("int").alias("cells"))
        celled = out.join(F.broadcast(sizes), "list").withColumn("cell", F.pmod(F.xxhash64(key), F.col("cells")))  # as many rows as lists
        return celled.groupBy("list", "cell").agg(F.collect_list(F.col(key)).alias(f"{key}s"), F.collect_list("embedding").alias(f"{key}_vectors")).drop("cell")

    q = assigned(queries, "query_id", min(fitted.probes, len(fitted.centres)), CELL_QUERIES)
    met = q.join(assigned(rows, "vec_id", 1, CELL_ROWS).hint("merge"), "list")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for qs, qv, ids, vectors in zip(pdf["query_ids"], pdf["query_id_vectors"], pdf["vec_ids"], pdf["vec_id_vectors"]):
                d = _squared(_vectors(qv), _vectors(vectors))
                near, d = _least(np.broadcast_to(np.asarray(ids), d.shape), d, k + 8)
                yield pd.DataFrame({"query_id": np.repeat(np.asarray(qs), near.shape[1]), "vec_id": near.ravel(), "distance": d.ravel()})

    return top_per_query(met.select("query_ids", "query_id_vectors", "vec_ids", "vec_id_vectors").mapInPandas(run, "query_id long, vec_id long, distance double"), k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of the exact neighbours that were found."""
    hit = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return hit.agg((F.sum(F.coalesce("hit", F.lit(0))) / F.count("*")).alias("recall"))


def overlap_score(query: Column, text: Column) -> Column:
    """A plain re-ranking score: the share of the query's words that stand in the text. ``model_score`` may take its place."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"(?U)\W+"), lambda w: w != ""))
    q = words(query)
    return F.size(F.array_intersect(q, words(text))) / F.greatest(F.size(q), F.lit(1))


def reranked(candidates: DataFrame, score: Column, k: int, keys: list[str]) -> DataFrame:
    """The best k of over-fetched candidates by score; ties by the given keys."""
    return candidates.withColumn("score", score).orderBy(F.desc("score"), *keys).limit(k)


_WORDS = re.compile(r"\w+")


def hashed_vector(text: str | None, dims: int = 64, known: dict | None = None) -> np.ndarray:
    """A text as a vector without a model: words hashed to signed dimensions, scaled to length one."""
    out = np.zeros(dims, dtype=np.float64)
    known = {} if known is None else known
    for w in _WORDS.findall((text or "").lower()):
        place = known.get(w)
        if place is None:
            h = zlib.crc32(w.encode())
            place = known[w] = (h % dims, 1.0 if h >> 31 else -1.0)
            if len(known) > 200_000:
                known.clear()
        out[place[0]] += place[1]
    length = np.sqrt((out * out).sum())
    return (out / length if length else out).astype(np.float32)


class HashedEmbedder:
    """The embedder used where no model is handed in. Any object with these members takes its place: ``name`` goes into the
    index's notes, texts come in lists of at most ``batch``, and documents and queries may be treated differently."""

    name, batch = "hashed-words", 256

    def __init__(self, dims: int = 64):
        self.dims = dims

    def documents(self, texts: list[str]) -> np.ndarray:
        known: dict = {}
        return np.array([hashed_vector(t, self.dims, known) for t in texts])

    def queries(self, texts: list[str]) -> np.ndarray:
        return self.documents(texts)


def embedding(text: Column, embedder=None, query: bool = False) -> Column:
    """Vectors of texts by ``embedder``, in Arrow batches; the embedder is sent to the workers once a task."""
    own = embedder or HashedEmbedder()

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(texts: pd.Series) -> pd.Series:
        out: list[np.ndarray] = []
        all_texts = texts.fillna("").tolist()
        for at in range(0, len(all_texts), own.batch):
            part = all_texts[at : at + own.batch]
            out += list(np.asarray(own.queries(part) if query else own.documents(part), dtype=np.float32))
        return pd.Series(out, dtype=object)

    return embed(text)


def model_score(query: Column, text: Column, scorer, batch: int = 64) -> Column:
    """Scores of (query, text) pairs by ``scorer``, a function of two lists of texts such as a cross-encoder."""

    @F.pandas_udf(T.DoubleType())
    def score(queries: pd.Series, texts: pd.Series) -> pd.Series:
        q, t = queries.fillna("").tolist(), texts.fillna("").tolist()
        return pd.Series([float(x) for at in range(0, len(q), batch) for x in scorer(q[at : at + batch], t[at : at + batch])], dtype=float)

    return score(query, text)


def hashed_embedding(text: Column, dims: int = 64) -> Column:
    """``hashed_vector`` over a column, in Arrow batches."""
    return embedding(text, HashedEmbedder(dims))


def delete_keys(index: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return index.join(keys.select(key).distinct(), key, "left_anti")


def write_table(df: DataFrame, path: str) -> None:
    """Replace a stored table that the plan itself may read: written whole beside it, then put in its place by renaming."""
    spark = df.sparkSession
    fresh, former = f"{path}.fresh", f"{path}.former"
    df.write.mode("overwrite").parquet(fresh)
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(at(former), True)
    if fs.exists(at(path)) and not fs.rename(at(path), at(former)):
        raise RuntimeError(f"{path} can't be put aside; the new state is at {fresh}")
    if not fs.rename(at(fresh), at(path)):
        raise RuntimeError(f"{fresh} can't be put in place; the former state is at {former}")
    fs.delete(at(former), True)
