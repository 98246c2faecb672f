"""Problem 8: documents into containers of fixed capacity with little space left over.

Documents are spread over blocks by hash, each of about ``PER_BLOCK`` containers; a block is packed by Karmarkar-Karp
differencing in several ways: partial partitions are merged, the least balanced first, the heaviest part of the one with
the lightest of the other, until one partition into near-equal containers is left. The number of containers starts at
the least that could do and rises whenever one exceeds the capacity.

A document that alone exceeds the capacity is cut at token counts: full containers of its own, and a rest that is packed
like a document.

Defined results: null and empty texts count zero tokens and are packed. A doc_id that comes several times counts once (its
smallest text). Equal sizes are told apart by doc_id. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.tokens import VOCABULARY, n_tokens
from foliant.session import cut_lineage, table

#: A block has about so many containers, and so at most this times the capacity of documents that have a token.
PER_BLOCK = 96


def difference(sizes: list[int], ways: int) -> list[tuple[int, list[int]]]:
    """Partition into ``ways`` parts by largest differencing: (total, positions) of each part.

    A partial partition keeps its non-empty parts only, heaviest first; the rest are zero.
    """
    heap = []
    for i, s in enumerate(sizes):
        parts = [(s, (i, None, None))]
        heap.append((-(s if ways > 1 else 0), i, parts))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # a: heaviest first; b: lightest first, so that zeros of one meet weights of the other
        merged = []
        na, nb = len(a), len(b)
        free = ways - na
        if nb <= free:
            merged = a + b
        else:
            # b's heaviest parts take the free places, the others join a's from its lightest on
            merged = list(b[:free])
            for (wa, ta), (wb, tb) in zip(reversed(a), b[free:]):
                merged.append((wa + wb, (None, ta, tb)))
            merged += a[: na - (nb - free)]
        merged.sort(key=lambda p: -p[0])
        least = merged[-1][0] if len(merged) == ways else 0
        heapq.heappush(heap, (-(merged[0][0] - least), serial, merged))
        serial += 1
    out = []
    for total, tree in heap[0][2] if heap else []:
        found, stack = [], [tree]
        while stack:
            i, left, right = stack.pop()
            if i is not None:
                found.append(i)
            else:
                stack += [left, right]
        out.append((total, sorted(found)))
    return out


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Positions by container; every size is at most the capacity."""
    if not sizes:
        return []
    ways = max(1, math.ceil(sum(sizes) / capacity))
    while True:
        parts = difference(sizes, ways)
        if not parts or parts[0][0] <= capacity:
            return [p for _, p in parts]
        ways += max(1, ways // 200)


def sizes_of(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, n_words), one row per document."""
    words = F.size(F.filter(F.split("text", r"[\s 　]+"), lambda w: w != ""))
    rows = documents.filter("doc_id is not null").select("doc_id", n_tokens(F.col("text"), path).alias("n_tokens"), F.when(F.col("text").isNull(), 0).otherwise(words).alias("n_words"))
    return rows.groupBy("doc_id").agg(F.min(F.struct("n_tokens", "n_words")).alias("s")).select("doc_id", "s.n_tokens", "s.n_words")


def containers(sizes: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece_no, n_pieces, token_start, n_tokens, n_words, container): a row per document, or piece of one that is too large."""
    if capacity <= 0:
        raise ValueError("capacity must be positive")
    own_full = F.when(F.col("n_tokens") > capacity, F.floor((F.col("n_tokens") - 1) / capacity)).otherwise(0).cast("int")
    sized = sizes.withColumn("n_full", own_full).withColumn("n_pieces", F.col("n_full") + 1)
    full = sized.filter("n_full > 0").select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n_full") - 1)).alias("piece_no"), "n_pieces", "n_words").select(
        "doc_id", "piece_no", "n_pieces", (F.col("piece_no").cast("long") * capacity).alias("token_start"), F.lit(capacity).cast("long").alias("n_tokens"), "n_words",
        F.concat_ws("-", F.lit("f"), "doc_id", "piece_no").alias("container"),
    )
    rest = sized.select("doc_id", F.col("n_full").alias("piece_no"), "n_pieces", (F.col("n_full").cast("long") * capacity).alias("token_start"), (F.col("n_tokens") - F.col("n_full").cast("long") * capacity).alias("n_tokens"), "n_words")
    rest = cut_lineage(rest)
    total = rest.agg(F.sum("n_tokens")).first()[0]
    blocks = max(1, math.ceil((total or 0) / (capacity * PER_BLOCK)))

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for block, ids, sizes_, in zip(pdf["block"], pdf["ids"], pdf["sizes"]):
                ids, own = list(ids), [int(s) for s in sizes_]
                rows = []
                for k, members in enumerate(pack(own, capacity)):
                    rows += [(ids[i], f"{block}-{k}") for i in members]
                yield pd.DataFrame(rows, columns=["doc_id", "container"])

    blocked = rest.select("doc_id", "n_tokens", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"))
    empty = blocked.filter("n_tokens = 0").select("doc_id", F.concat("block", F.lit("-0")).alias("container"))  # they fit anywhere
    gathered = blocked.filter("n_tokens > 0").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("doc_id", "n_tokens"))).alias("m")).select("block", F.col("m.doc_id").alias("ids"), F.col("m.n_tokens").alias("sizes"))
    placed = gathered.mapInPandas(run, "doc_id long, container string").unionByName(empty)
    return full.unionByName(rest.join(placed, "doc_id").select(*full.columns))


def capacity_of(spark: SparkSession, folder: str) -> int:
    row = table(spark, folder, "size_limits").filter("limit_name = 'container'").first()
    if row is None:
        raise ValueError("size_limits has no row container")
    return int(row.limit_value)


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    sizes = sizes_of(table(spark, folder, "documents").select("doc_id", "text"))
    return containers(cut_lineage(sizes), capacity_of(spark, folder))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    packed = p8_packed(spark, folder)
    return packed.filter((F.col("n_pieces") > 1) & (F.col("n_words") > capacity_of(spark, folder))).select("doc_id").distinct()


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """One row: containers, tokens, and the share of their space that is used."""
    capacity = capacity_of(spark, folder)
    used = p8_packed(spark, folder).groupBy("container").agg(F.sum("n_tokens").alias("tokens"))
    return used.agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest")).withColumn("fill", F.col("tokens") / (F.col("containers") * capacity))


def p8_placed(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, begins, gapless, overfull): how often a document begins, whether its pieces follow one another to its end, and whether
    a container it is in holds more than it can."""
    capacity = capacity_of(spark, folder)
    packed = cut_lineage(p8_packed(spark, folder))
    used = packed.groupBy("container").agg(F.sum("n_tokens").alias("used"))
    each = packed.join(used, "container").groupBy("doc_id").agg(
        F.count_if(F.col("token_start") == 0).alias("begins"),
        ((F.max(F.col("token_start") + F.col("n_tokens")) == F.sum("n_tokens")) & (F.count("*") == F.max("n_pieces"))).alias("gapless"), F.bool_or(F.col("used") > capacity).alias("overfull"),
    )
    return each.select("doc_id", "begins", "gapless", "overfull")


QUERIES = {"p8_found": p8_found, "p8_packed": p8_packed, "p8_fill": p8_fill, "p8_placed": p8_placed}
SQL = {
    "p8_found": r"""
        SELECT doc_id FROM documents
        WHERE len(list_filter(string_split_regex(text, '[\s\x{00A0}\x{3000}]+'), lambda w: w <> ''))
              > (SELECT limit_value FROM size_limits WHERE limit_name = 'container')
    """,
    "p8_placed": "SELECT DISTINCT doc_id, 1 AS begins, true AS gapless, false AS overfull FROM documents WHERE doc_id IS NOT NULL",
}
