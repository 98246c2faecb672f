"""Problem 9: a mix of sources at target shares.

Tokens are summed by source and hash bucket (2**12 buckets at a time, whatever the data's size). From the histogram
the bucket in which a source's budget runs out is found; only that bucket is summed again by the next 12 bits of the hash,
until it holds a single document. A document is taken if its hash lies below its source's threshold: a filter, no sort.
Budgets are nested: a larger total takes all documents that a smaller one takes. A source that is needed more than once
over contributes all its documents in whole rounds and the part below the threshold once more.

The total is, where none is given, the largest at which every source that has documents reaches its share within its
allowed repeats. Shares of sources without documents go to the others in proportion. Where a total is given and a
source is too small for it, the source contributes all it may and the shares really reached are reported.

Defined results: source names match in any spelling of case, hyphen, underscore and outer blanks; documents of sources
without a target, or without a source, are not in the mix. Null and empty texts have no tokens and are not in the mix.
A doc_id that comes several times counts once. No documents at all: an empty mix, and shares of zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.tokens import VOCABULARY, n_tokens
from foliant.session import cut_lineage, table

STEP = 12
TOP = 60


@dataclass(frozen=True)
class Share:
    """What a source gives: ``rounds`` whole copies and, once more, the documents with a hash below ``threshold``."""

    source_name: str
    target: float
    max_repeats: int
    available: int
    budget: float
    rounds: int
    threshold: int


def source_key(col: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(col)), r"[\s\-]+", "_")


def sized_documents(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, source_name, n_tokens, h): one row per document with tokens; h is a hash of 60 bits."""
    rows = documents.filter("doc_id is not null").select("doc_id", source_key(F.col("source")).alias("source_name"), n_tokens(F.col("text"), path).alias("n_tokens"))
    once = rows.groupBy("doc_id").agg(F.min(F.struct("source_name", "n_tokens")).alias("r")).select("doc_id", "r.source_name", "r.n_tokens")
    return once.filter("n_tokens > 0 and source_name is not null").withColumn("h", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - TOP))


def _bucket(bits_done: int) -> Column:
    return F.shiftright("h", TOP - bits_done - STEP).bitwiseAND((1 << STEP) - 1)


def _thresholds(sized: DataFrame, wanted: dict[str, float]) -> dict[str, int]:
    """Per source the hash below which the documents sum up to about the wanted tokens."""
    done: dict[str, int] = {}
    prefix = {s: 0 for s in wanted}
    left = dict(wanted)
    bits = 0
    while prefix and bits < TOP:
        at = None
        for s, p in prefix.items():
            own = (F.col("source_name") == s) & (F.shiftright("h", TOP - bits) == p) if bits else F.col("source_name") == s
            at = own if at is None else at | own
        sums = sized.filter(at).groupBy("source_name", _bucket(bits).alias("b")).agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.max("h").alias("h")).collect()
        by: dict[str, list] = {}
        for r in sums:
            by.setdefault(r.source_name, []).append(r)
        bits += STEP
        for s in list(prefix):
            base, chosen = prefix[s] << STEP, None
            for r in sorted(by.get(s, []), key=lambda r: r.b):
                if r.t > left[s]:
                    chosen = r
                    break
                left[s] -= r.t
            if chosen is None:
                done[s] = ((prefix[s] + 1) << (TOP - bits + STEP))
                del prefix[s]
            elif chosen.n == 1:  # a single document: in if that is nearer to the budget
                done[s] = int(chosen.h) + (1 if chosen.t - left[s] < left[s] else 0)
                del prefix[s]
            else:
                prefix[s] = base + int(chosen.b)
    for s, p in prefix.items():
        done[s] = p
    return done


def plan(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> list[Share]:
    goal = {r.source_name: (float(r.target_share or 0), int(r.max_repeats or 1)) for r in targets.select(source_key(F.col("source_name")).alias("source_name"), "target_share", "max_repeats").collect() if r.source_name}
    have = {r.source_name: int(r.t) for r in sized.filter(F.col("source_name").isin(*goal)).groupBy("source_name").agg(F.sum("n_tokens").alias("t")).collect()} if goal else {}
    alive = sum(goal[s][0] for s in have)
    if alive <= 0:
        return [Share(s, g, m, 0, 0.0, 0, 0) for s, (g, m) in goal.items()]
    share = {s: goal[s][0] / alive for s in have}
    largest = min(have[s] * goal[s][1] / share[s] for s in have if share[s] > 0)
    total = largest if total_tokens is None else float(total_tokens)
    budget = {s: min(total * share[s], float(have[s] * goal[s][1])) for s in have}
    rounds = {s: min(int(budget[s] // have[s]), goal[s][1]) for s in have}
    part = {s: budget[s] - rounds[s] * have[s] if rounds[s] < goal[s][1] else 0.0 for s in have}
    below = _thresholds(sized, {s: p for s, p in part.items() if p > 0})
    return [Share(s, g, m, have.get(s, 0), budget.get(s, 0.0), rounds.get(s, 0), below.get(s, 0)) for s, (g, m) in goal.items()]


def _with_copies(sized: DataFrame, shares: list[Share]) -> DataFrame:
    copies = F.lit(0)
    for s in shares:
        copies = F.when(F.col("source_name") == s.source_name, F.lit(s.rounds) + (F.col("h") < s.threshold).cast("int")).otherwise(copies)
    return sized.withColumn("copies", copies).filter("copies > 0")


def mix(sized: DataFrame, shares: list[Share]) -> DataFrame:
    """(doc_id, source_name, n_tokens, copies)."""
    return _with_copies(sized, shares).select("doc_id", "source_name", "n_tokens", "copies")


def reached(sized: DataFrame, shares: list[Share]) -> DataFrame:
    """A row per target: target_share, available, tokens taken, actual_share, documents, most copies of one."""
    spark = sized.sparkSession
    rows = spark.createDataFrame([(s.source_name, s.target, s.max_repeats, s.available) for s in shares], "source_name string, target_share double, max_repeats int, available_tokens long")
    got = _with_copies(sized, shares).groupBy("source_name").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    whole = got.agg(F.sum("mixed_tokens").alias("whole"))
    return rows.join(got, "source_name", "left").crossJoin(F.broadcast(whole)).select(
        "source_name", "target_share", "max_repeats", "available_tokens", F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
        F.coalesce(F.col("mixed_tokens") / F.col("whole"), F.lit(0.0)).alias("actual_share"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
    )


def _prepared(spark: SparkSession, folder: str) -> tuple[DataFrame, list[Share]]:
    sized = cut_lineage(sized_documents(table(spark, folder, "documents").select("doc_id", "source", "text")))
    return sized, plan(sized, table(spark, folder, "mix_targets"))


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(*_prepared(spark, folder))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return reached(*_prepared(spark, folder))


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
SQL: dict[str, str] = {}
