"""Problem 5: items entered more than once with small edits, grouped by work.

An item is the set of the words of its title and abstract. Items with the same set are one class. A class gets 140 minima
of hashed words. Groups of five minima name the shards it belongs to (28 of them): classes that share 0.7 of their words
meet in a shard with a chance of 0.994, with 0.8 of 0.99998. Its fingerprint has 120 bits. For sets of up to ``SMALL`` words
each word flips one of them: two fingerprints then differ in no more bits than there are words in one set only, so the
radius that follows from the two sizes loses no pair, and sets with a third of their words in common hardly ever lie within
it. For larger sets the bits are the low ones of 120 minima. Sets of a size whose partners may be of either sort are in shards
of both. In each shard a BK-tree over the fingerprints (children keyed by the Hamming distance to their parent) answers
which ones lie within the radius, following only edges within it. An exact comparison of the word sets follows.

Words are written once. A set goes by a hash through the search, so no shuffle of words brings equal sets together; only sets
that lie in a pair are sent on with their words, told by a bit field from the others.

Shards are runs of rows sorted by their key. A shard with more than ``HOT`` classes is cut into blocks; the tree of each block meets the members of every block, so no
shard is held in one task and no partner is left out. Shards are never broadcast: a shard's tree is built where its
rows meet.

Defined results: items without a real abstract take no part; a null title is empty. Repeated rows of an item count once.
Empty tables give no rows. Texts of any length count whole. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.fields import ABSTRACT_PLACEHOLDERS, is_placeholder, live, plain_text
from foliant.session import cut_lineage, table

THRESHOLD = 0.7
ROWS, BANDS, BITS = 5, 28, 120
#: Bits in which fingerprints from minima differ at most, and the largest set whose words flip bits themselves.
RADIUS, SMALL = 35, 140
HOT, BLOCK = 2000, 1000
#: The bit field of the sets in pairs has 16 bits a set, within these powers of two (1 to 32 MB).
FIELD_LEAST, FIELD_MOST = 23, 28
_SEEDS = np.random.default_rng(20240501)
_MULTIPLY = (_SEEDS.integers(1, 2**63, size=ROWS * BANDS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = _SEEDS.integers(0, 2**63, size=ROWS * BANDS, dtype=np.uint64)
_BAND_MULTIPLY = (_SEEDS.integers(1, 2**63, size=ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def word_sets(items: DataFrame) -> DataFrame:
    """(item_id, words) of live items with a real abstract: sorted hashes of the distinct words of title and abstract."""
    abstract = plain_text(F.col("abstract"))
    own = items.filter(live(F.col("deleted")) & F.col("item_id").isNotNull() & F.col("abstract").isNotNull()).select("item_id", F.coalesce(plain_text(F.col("title")), F.lit("")).alias("t"), abstract.alias("a"))
    own = own.filter(~is_placeholder(F.col("a")))
    words = F.regexp_extract_all(F.lower(F.concat_ws(" ", "t", "a")), F.lit(r"[\p{L}\p{M}]+|\p{Nd}+"), 0)
    return own.select("item_id", F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))).alias("words")).filter(F.size("words") > 0)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band keys (items by BANDS) of word-hash sets and their fingerprints (items by 2 words of 64 bits) by flips and by minima.
    The low byte of a fingerprint is the size of the set, or 0 where it is by minima."""
    lengths = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    flat = _mix(np.concatenate(sets).astype(np.int64).view(np.uint64))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    minima = np.empty((len(sets), ROWS * BANDS), dtype=np.uint64)
    for k in range(ROWS * BANDS):
        h = flat * _MULTIPLY[k]
        h += _ADD[k]
        h ^= h >> np.uint64(32)
        minima[:, k] = np.minimum.reduceat(h, starts)
    mixed = _mix(minima)
    by_minima = _packed((mixed[:, :BITS] >> np.uint64(17)) & np.uint64(1), np.zeros(len(sets), dtype=np.uint64))
    places = np.repeat(np.arange(len(sets)) * BITS, lengths) + (_mix(flat) >> np.uint64(20)).astype(np.int64) % BITS
    flips = np.bincount(places, minlength=len(sets) * BITS).reshape(len(sets), BITS) & 1
    by_flips = _packed(flips.astype(np.uint64), np.minimum(lengths, 255).astype(np.uint64))
    keys = np.zeros((len(sets), BANDS), dtype=np.uint64)
    by_band = mixed.reshape(len(sets), BANDS, ROWS)
    for r in range(ROWS):
        keys = _mix(keys ^ by_band[:, :, r] * _BAND_MULTIPLY[r])
    keys ^= np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    return keys.view(np.int64), by_flips, by_minima


def _packed(bits: np.ndarray, low: np.ndarray) -> np.ndarray:
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    return np.stack([(bits[:, :64] * powers).sum(axis=1), (bits[:, 64:] * powers[8:]).sum(axis=1) | low], axis=1).astype(np.uint64).view(np.int64)


def _sign(batches: Iterator[pd.DataFrame], threshold: float = THRESHOLD) -> Iterator[pd.DataFrame]:
    """Keys and fingerprints; a set that may have partners of either sort comes with both. Of equal sets in a batch one."""
    for pdf in batches:
        pdf = pdf.drop_duplicates("class_id")
        for part in range(0, len(pdf), 2000):
            own = pdf.iloc[part : part + 2000]
            ids, sizes = own["class_id"].to_numpy(), own["words"].map(len).to_numpy()
            keys, by_flips, by_minima = signatures(list(own["words"]))
            for sel, its_keys, prints in ((sizes <= SMALL, keys, by_flips), (sizes > int(SMALL * threshold), ~keys, by_minima)):
                if sel.any():
                    yield pd.DataFrame({"class_id": ids[sel], "keys": list(its_keys[sel]), "hi": prints[sel, 0], "lo": prints[sel, 1]})


class BKTree:
    """Fingerprints by Hamming distance: a child hangs on the edge that equals its distance to the parent."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    def add(self, print_: int, name: int) -> None:
        if self.root is None:
            self.root = (print_, [name], {})
            return
        node = self.root
        while True:
            d = (node[0] ^ print_).bit_count()
            if d == 0:
                node[1].append(name)
                return
            child = node[2].get(d)
            if child is None:
                node[2][d] = (print_, [name], {})
                return
            node = child

    def within(self, print_: int, radius: int) -> list[int]:
        if self.root is None:
            return []
        out: list[int] = []
        stack = [self.root]
        while stack:
            own, names, children = stack.pop()
            d = (own ^ print_).bit_count()
            if d <= radius:
                out += names
            for edge, child in children.items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)
        return out


def _apart(words: int, threshold: float) -> int:
    """Words in one set only, at most, where two sets of so many words together share ``threshold`` of them."""
    return int((1 - threshold) / (1 + threshold) * words + 1e-9)


class _Shard:
    """A BK-tree of named fingerprints that answers with the names that can share ``threshold`` of their words."""

    def __init__(self, ids: list[int], his: list[int], los: list[int], threshold: float):
        mask = (1 << 64) - 1
        self.ids, self.threshold, self.tree = ids, threshold, BKTree()
        self.prints = [((h & mask) << 56) | ((lo & mask) >> 8) for h, lo in zip(his, los)]
        self.sizes = [lo & 255 for lo in los]

    def add(self, k: int) -> None:
        self.tree.add(self.prints[k], k)

    def ask(self, k: int, left: list[int], right: list[int]) -> None:
        print_, size, name = self.prints[k], self.sizes[k], self.ids[k]
        radius = _apart(size + int(size / self.threshold + 1e-9), self.threshold) if size else RADIUS
        for other in self.tree.within(print_, radius):
            if size:
                most = _apart(size + self.sizes[other], self.threshold)
                if abs(size - self.sizes[other]) > most or (print_ ^ self.prints[other]).bit_count() > most:
                    continue
            if (b := self.ids[other]) != name:
                left.append(min(name, b))
                right.append(max(name, b))


def _meet(batches: Iterator[pd.DataFrame], threshold: float = THRESHOLD) -> Iterator[pd.DataFrame]:
    """Each row is a meeting: members of a tree's block and those that ask it (the same, within a block)."""
    for pdf in batches:
        left, right = [], []
        for same, ids, his, los, asks in zip(pdf["same"], pdf["ids"], pdf["his"], pdf["los"], pdf["asks"]):
            shard = _Shard(*(list(map(int, x)) for x in (ids, his, los)), threshold)
            if same:
                for k in range(len(ids)):
                    shard.ask(k, left, right)
                    shard.add(k)
                continue
            for k, ask in enumerate(asks):
                if not ask:
                    shard.add(k)
            for k, ask in enumerate(asks):
                if ask:
                    shard.ask(k, left, right)
        if left:
            yield pd.DataFrame({"a": left, "b": right}, dtype="int64").drop_duplicates()


def _meet_runs(batches: Iterator[pd.DataFrame], most: int = HOT, threshold: float = THRESHOLD) -> Iterator[pd.DataFrame]:
    """Shards as runs of rows sorted by key and class: pairs within the radius as (a, b, null, null, null); members of shards above
    ``most`` as (class_id, null, key, hi, lo). Rows of one class in a run count once. No more than one batch and ``most`` rows are held."""
    keys = ids = his = los = np.empty(0, dtype=np.int64)
    hot: int | None = None

    def through(sel: slice) -> pd.DataFrame:
        n = len(ids[sel])
        return pd.DataFrame({"a": ids[sel], "b": pd.array([None] * n, dtype="Int64"), "key": keys[sel], "hi": his[sel], "lo": los[sel]})

    def matched(bounds: np.ndarray) -> tuple[pd.DataFrame | None, list[slice]]:
        left, right, large = [], [], []
        starts, ends = bounds[:-1], bounds[1:]
        several = np.flatnonzero(ends - starts > 1)
        for s, e in zip(starts[several].tolist(), ends[several].tolist()):
            if e - s > most:
                large.append(slice(s, e))
                continue
            shard = _Shard(ids[s:e].tolist(), his[s:e].tolist(), los[s:e].tolist(), threshold)
            for k in range(e - s):
                shard.ask(k, left, right)
                shard.add(k)
        if not left:
            return None, large
        n = len(left)
        nulls = pd.array([None] * n, dtype="Int64")
        return pd.DataFrame({"a": left, "b": pd.array(right, dtype="Int64"), "key": nulls, "hi": nulls, "lo": nulls}).drop_duplicates(["a", "b"]), large

    for pdf in batches:
        if not len(pdf):
            continue
        keys, ids, his, los = (np.concatenate([x, pdf[c].to_numpy(dtype=np.int64)]) for x, c in ((keys, "key"), (ids, "class_id"), (his, "hi"), (los, "lo")))
        new = np.concatenate([[True], (np.diff(keys) != 0) | (np.diff(ids) != 0)])
        keys, ids, his, los = keys[new], ids[new], his[new], los[new]
        if hot is not None:
            n = int(np.argmax(keys != hot)) if (keys != hot).any() else len(keys)
            if n:
                yield through(slice(0, n))
            keys, ids, his, los = keys[n:], ids[n:], his[n:], los[n:]
            if not len(keys):
                continue
            hot = None
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
        found, large = matched(bounds)
        if found is not None:
            yield found
        for sel in large:
            yield through(sel)
        tail = int(bounds[-1])
        if len(keys) - tail > most:
            yield through(slice(tail, len(keys)))
            hot, tail = int(keys[-1]), len(keys)
        keys, ids, his, los = keys[tail:], ids[tail:], his[tail:], los[tail:]
    if len(keys):
        found, large = matched(np.array([0, len(keys)]))
        if found is not None:
            yield found
        for sel in large:
            yield through(sel)


def candidate_pairs(classes: DataFrame, most: int = HOT, block: int = BLOCK, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b), a < b: classes that lie within the radius in some shard. ``classes`` has class_id and words; a class may come again."""
    signed = classes.select("class_id", "words").mapInPandas(lambda rows: _sign(rows, threshold), "class_id long, keys array<long>, hi long, lo long")
    entries = signed.select("class_id", "hi", "lo", F.explode("keys").alias("key"))
    met = entries.repartition("key").sortWithinPartitions("key", "class_id").mapInPandas(lambda rows: _meet_runs(rows, most, threshold), "a long, b long, key long, hi long, lo long")
    met = cut_lineage(met)
    pairs = met.filter("b is not null").select("a", "b")
    left_over = met.filter("b is null").select(F.col("a").alias("class_id"), "key", "hi", "lo")
    if left_over.isEmpty():
        return pairs.distinct()
    sized = left_over.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    blocked = left_over.join(sized.hint("merge"), "key").withColumn("own", own)
    # a block's members are the tree of its meetings with later blocks and ask the trees of earlier ones
    sent = blocked.select("key", "own", "class_id", "hi", "lo", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class_id", "hi", "lo", (F.col("own") > F.col("other")).alias("ask")
    )
    meetings = sent.groupBy("key", "i", "j").agg(F.collect_list(F.struct("class_id", "hi", "lo", "ask")).alias("m")).filter(F.size("m") > 1)
    arrays = meetings.select((F.col("i") == F.col("j")).alias("same"), F.col("m.class_id").alias("ids"), F.col("m.hi").alias("his"), F.col("m.lo").alias("los"), F.col("m.ask").alias("asks"))
    return pairs.unionByName(arrays.mapInPandas(lambda rows: _meet(rows, threshold), "a long, b long")).distinct()


def named_sets(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (item_id, class_id) and sets (item_id, h1, h2, words); a class is named by its smallest item_id."""
    sets = cut_lineage(_hashed(word_sets(items)))
    keys = sets.select("item_id", "h1", "h2").distinct()
    names = keys.groupBy("h1", "h2").agg(F.min("item_id").alias("class_id"))
    return cut_lineage(keys.join(names, ["h1", "h2"]).select("item_id", "class_id")), sets


def _hashed(sets: DataFrame) -> DataFrame:
    # the name stands for the whole set, so two hashes of it make a key of 96 bits
    return sets.select("item_id", F.xxhash64("words").alias("h1"), F.hash("words", F.size("words")).alias("h2"), "words")


def _in_field(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``sets`` whose h1 is among ``ids``, and some others: a bit field passes over most."""
    size = 1 << min(FIELD_MOST, max(FIELD_LEAST, (16 * ids.count()).bit_length()))
    bits = ids.select(F.pmod("h1", F.lit(size)).alias("bit"))
    slots = bits.groupBy(F.shiftright("bit", 5).cast("int").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(bit, 32) as int))")).alias("bits")).toPandas()
    field = np.zeros(size // 32, dtype=np.uint32)
    field[slots["slot"].to_numpy(dtype=np.int64)] = slots["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    shared = sets.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("boolean")
    def known(h: pd.Series) -> pd.Series:
        bit = h.to_numpy(dtype=np.int64) % size
        return pd.Series((shared.value[bit >> 5] >> (bit & 31).astype(np.uint32) & np.uint32(1)).astype(bool))

    return sets.filter(known("h1"))


def similar_sets(sets: DataFrame, threshold: float = THRESHOLD, most: int = HOT, block: int = BLOCK) -> DataFrame:
    """(a, b, similarity) of the classes whose word sets are similar enough, checked exactly. ``sets`` as from ``named_sets``."""
    pairs = cut_lineage(candidate_pairs(sets.select(F.col("h1").alias("class_id"), "words"), most, block, threshold))
    in_pairs = pairs.select(F.col("a").alias("h1")).union(pairs.select("b")).distinct()
    words = _in_field(sets, in_pairs).join(in_pairs, "h1", "left_semi").groupBy("h1", "h2").agg(F.min("item_id").alias("class_id"), F.first("words").alias("words"))
    words = cut_lineage(words)
    left, right = (words.select(F.col("h1").alias(x), F.col("class_id").alias(f"c{x}"), F.col("words").alias(f"w{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("wa", "wb"))
    measured = both.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), common.alias("common"), (F.size("wa") + F.size("wb") - common).alias("either"))
    return measured.filter(F.col("common") >= F.col("either") * threshold).select("a", "b", (F.col("common") / F.col("either")).alias("similarity"))


def similar_classes(classes: DataFrame, threshold: float = THRESHOLD, most: int = HOT, block: int = BLOCK) -> DataFrame:
    """The same for ``classes`` with class_id and words."""
    return similar_sets(_hashed(classes.select(F.col("class_id").alias("item_id"), "words")), threshold, most, block)


def pairs_within(members: DataFrame, key: str, group: str, block: int = 1000) -> DataFrame:
    """(key_a, key_b), a < b: all pairs of a group's members. A large group's pairs are spread over tasks: each member of a block
    of ``block`` goes once past every block."""
    members = cut_lineage(members.select(F.col(key), F.col(group)))
    sizes = members.groupBy(group).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"), F.count("*").alias("_n")).filter("_n > 1")
    sized = members.join(sizes.drop("_n"), group)
    a = sized.select(group, F.col(key).alias(f"{key}_a"), F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int").alias("_block"))
    b = sized.select(group, F.col(key).alias(f"{key}_b"), F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
    return a.join(b, [group, "_block"]).filter(F.col(f"{key}_a") < F.col(f"{key}_b")).select(f"{key}_a", f"{key}_b")


def near_copies(items: DataFrame) -> DataFrame:
    """(item_id_a, item_id_b) of all pairs, within classes and between similar ones."""
    members, sets = named_sets(items)
    links = cut_lineage(similar_sets(sets).select("a", "b"))
    left = members.select(F.col("item_id").alias("x"), F.col("class_id").alias("a"))
    right = members.select(F.col("item_id").alias("y"), F.col("class_id").alias("b"))
    between = links.join(left, "a").join(right, "b").select(F.least("x", "y").alias("item_id_a"), F.greatest("x", "y").alias("item_id_b"))
    return between.unionByName(pairs_within(members, "item_id", "class_id"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component, by repeated min over links and jumps to labels."""
    edges = cut_lineage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).select(F.col("a").alias("node"), "label"))
    while True:
        around = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near")).select(F.col("a").alias("node"), "near")
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = labels.join(around, "node").join(jump, "label", "left").select("node", F.least("label", "near", F.coalesce("up", "label")).alias("new"), "label")
        new = cut_lineage(new)
        if new.filter("new <> label").isEmpty():
            break
        labels = new.select("node", F.col("new").alias("label"))
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def groups(items: DataFrame) -> DataFrame:
    """One row per item: item_id, class_id (equal word sets), group_id (smallest item of the work), n_links of its class."""
    members, sets = named_sets(items)
    links = cut_lineage(similar_sets(sets).select("a", "b"))
    degree = links.select(F.col("a").alias("class_id")).union(links.select("b")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    named = components(members.select(F.col("class_id").alias("node")).distinct(), links).select(F.col("node").alias("class_id"), F.col("label").alias("group_id"))
    return members.join(named, "class_id").join(degree, "class_id", "left").select("item_id", "class_id", "group_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "zotero_items"))


def p5_groups(spark: SparkSession, folder: str) -> DataFrame:
    return groups(table(spark, folder, "zotero_items"))


def _plain_sql(column: str) -> str:
    out = f"regexp_replace({column}, '(?s)<!--.*?-->|</?[A-Za-z][^<>]*>', ' ', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return rf"trim(regexp_replace({out}, '[\s\x{{A0}}\x{{2000}}-\x{{200B}}\x{{202F}}\x{{3000}}]+', ' ', 'g'))"


_PLACEHOLDERS = ", ".join("'" + x.replace("'", "''") + "'" for x in ABSTRACT_PLACEHOLDERS)

QUERIES = {"p5_found": p5_found, "p5_groups": p5_groups}
#: Brute force: all pairs that share a word, with how many they share.
SQL = {
    "p5_found": rf"""
        WITH own AS (SELECT DISTINCT item_id, coalesce({_plain_sql('title')}, '') AS t, {_plain_sql('abstract')} AS a FROM zotero_items WHERE NOT coalesce(deleted, false) AND abstract IS NOT NULL),
        sets AS (SELECT item_id, list_distinct(regexp_extract_all(lower(t || ' ' || a), '[\p{{L}}\p{{M}}]+|\p{{Nd}}+')) AS w FROM own
                 WHERE lower(regexp_replace(a, '^[\s\p{{P}}]+|[\s\p{{P}}]+$', '', 'g')) NOT IN ('', {_PLACEHOLDERS})),
        words AS (SELECT item_id, len(w) AS n, unnest(w) AS x FROM sets),
        pairs AS (SELECT a.item_id AS item_id_a, b.item_id AS item_id_b, min(a.n) + min(b.n) AS total, count(*) AS common FROM words a JOIN words b ON a.x = b.x AND a.item_id < b.item_id GROUP BY ALL)
        SELECT item_id_a, item_id_b FROM pairs WHERE common >= 0.7::DOUBLE * (total - common)
    """
}
