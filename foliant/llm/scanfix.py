"""Problem 4: repair of texts from scanned pages.

Lines are first sorted into text, tables, page numbers and running headers. Words cut at a line end are joined where the
corpus knows the joined word better than the hyphenated one. Misread characters are corrected by a noisy channel:
candidates for a word come from character confusions, their prior from corpus counts of words and word pairs, and the
best reading of a line is decoded by Viterbi over the candidates of its words. Readings that hold only at the rate of
misreadings of a noisy text count in texts that have a sure one.

Counts cover every abstract and full text of live items. A word meets its corrections by one key: letters are broken up into
the parts that misreadings swap (m is r and n, h is l and i, i is l), so any number of misreadings leaves the key as it is, in
words of any length. What is broadcast is a bit field of bounded size, to pass over lines in which no word has a correction.

Defined results: null and empty texts, and texts not of source ``pdf``, give no noise. A text without noise comes out with
its paragraphs unwrapped. Ties between readings keep the word as it stands. Repeated rows of an item count once in the
results (in the corpus counts each delivery counts). Texts of any length are read whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.fields import live
from foliant.llm.scanlines import classify_lines, cut_words
from foliant.session import cut_lineage, table

#: The bit field of suspect words is at least 1 MB, and at most 32 MB.
BITS_LEAST, BITS_MOST = 23, 28
#: In a text with a sure correction misreadings are this much likelier than in the corpus.
NOISY = 3.0
#: What is read in place of what, with the chance of that misreading (fixed values of the channel).
CONFUSIONS = (
    ("rn", "m", 0.03), ("li", "h", 0.03), ("cl", "d", 0.03), ("vv", "w", 0.03), ("c", "e", 0.03), ("f", "t", 0.02), ("l", "i", 0.01),
    ("m", "rn", 0.01), ("h", "li", 0.005), ("d", "cl", 0.005), ("e", "c", 0.005), ("t", "f", 0.004), ("i", "l", 0.005), ("ii", "u", 0.01), ("u", "ii", 0.002),
    ("0", "o", 0.04), ("1", "l", 0.04), ("1", "i", 0.01), ("$", "s", 0.04), ("5", "s", 0.02), ("9", "g", 0.04), ("6", "b", 0.02), ("8", "b", 0.01), ("|", "l", 0.02), ("3", "e", 0.01), ("4", "a", 0.01),
)
SYMBOLS = set("01$59683|4")
#: The chance of the likeliest symbols.
SYMBOL_READ = max(q for seen, _, q in CONFUSIONS if seen in SYMBOLS)
#: No misreading of letters alone is likelier.
MOST_LIKELY = max(q for seen, _, q in CONFUSIONS if seen not in SYMBOLS)
TOKEN = re.compile(r"[^\W_][\w$|]*")
COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
ODD = re.compile(r"[^\W\d_]{2,}[01$9][^\W\d_]{2,}|[^\W\d_]{4,}[01$9][^\W\d_]|[^\W\d_][01$9][^\W\d_]{4,}")
FLUSH = 2_500_000


def tokens(line: str) -> list[str]:
    return TOKEN.findall(line.lower())


class Codes(dict):
    """Words as 64-bit numbers, each computed once."""

    def __missing__(self, word: str) -> int:
        raw = word.encode()
        code = zlib.crc32(raw) | zlib.crc32(b"~" + raw) << 32
        code = self[word] = code - (1 << 64) if code >> 63 else code
        return code


_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pair_codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The numbers of word pairs from the numbers of their words."""
    x = first.view(np.uint64) * _FIRST
    return ((x ^ (x >> np.uint64(29))) + second.view(np.uint64) * _SECOND).view(np.int64)


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(key, word, n): counts of words and hyphenated words, and, with a null word, of word pairs. Keys are 64-bit codes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Codes()
        held: list[np.ndarray] = []
        size = 0

        def out() -> pd.DataFrame:
            whole = np.concatenate(held)
            between = whole[1:] != 0  # a zero stands between texts
            between &= whole[:-1] != 0
            pairs, n_pairs = np.unique(pair_codes(whole[:-1][between], whole[1:][between]), return_counts=True)
            words, n_words = np.unique(whole[whole != 0], return_counts=True)
            by_code = {c: w for w, c in codes.items()}
            n = len(words) + len(pairs)
            spelt = np.empty(n, dtype=object)
            spelt[: len(words)] = [by_code[c] for c in words.tolist()]
            return pd.DataFrame({"key": np.concatenate([words, pairs]), "word": spelt, "n": np.concatenate([n_words, n_pairs])})

        for pdf in batches:
            for text in pdf["text"]:
                low = text.lower()
                found = TOKEN.findall(low)
                if "-" in low:
                    found.append("#")  # keeps hyphenated words, which follow for themselves, apart
                    for w in COMPOUND.findall(low):
                        found += (w, "#")
                held.append(np.fromiter(map(codes.__getitem__, found), dtype=np.int64, count=len(found)))
                held.append(np.zeros(1, dtype=np.int64))
                size += len(found)
            if size > FLUSH:
                yield out()
                held.clear()
                size = 0
                if len(codes) > FLUSH:
                    codes.clear()
        if size:
            yield out()

    return texts.mapInPandas(run, "key long, word string, n long").groupBy("key", "word").agg(F.sum("n").alias("n"))


#: What each character is made of, so that a text and all its misreadings are made of the same (from CONFUSIONS).
ATOMS_ONE, ATOMS_TWO = ("i1|e3t0$59684", "lllccfossgbba"), (("m", "rn"), ("h", "ll"), ("u", "ll"), ("d", "cl"), ("w", "vv"))
_BY_FIRST: dict[str, list[tuple[str, str, float]]] = {}
for _seen, _true, _q in CONFUSIONS:
    _BY_FIRST.setdefault(_seen[0], []).append((_seen, _true, _q))


def atoms(word: Column) -> Column:
    """The key under which a word meets whatever it may have been read as, however many characters are misread."""
    x = F.translate(word, *ATOMS_ONE)
    for whole, parts in ATOMS_TWO:
        x = F.replace(x, F.lit(whole), F.lit(parts))
    return F.xxhash64(x)


def misreading(seen_word: str, true_word: str) -> float:
    """The chance of reading ``true_word`` as ``seen_word``: the best alignment by confusions; 0.0 where there is none.

    Every further confusion of letters counts half; where a symbol shows that the word is misread, each counts threefold, and
    further symbols count as in a word that is known to be misread.
    """
    symbol = any(c in SYMBOLS for c in seen_word)
    letters = 3.0 if symbol else 0.5
    n, m = len(seen_word), len(true_word)
    rows: list[dict[int, float]] = [{} for _ in range(n + 2)]
    rows[0][0] = 1.0
    for i in range(n):
        for j, p in rows[i].items():
            if j < m and seen_word[i] == true_word[j] and p > rows[i + 1].get(j + 1, 0.0):
                rows[i + 1][j + 1] = p
            for seen, true, q in _BY_FIRST.get(seen_word[i], ()):
                if seen_word.startswith(seen, i) and true_word.startswith(true, j):
                    k, at, value = i + len(seen), j + len(true), p * q * (1 / SYMBOL_READ if seen in SYMBOLS else letters)
                    if value > rows[k].get(at, 0.0):
                        rows[k][at] = value
    p = rows[n].get(m, 0.0)
    return p * SYMBOL_READ if symbol else p if seen_word == true_word else 2 * p


@F.pandas_udf(T.DoubleType())
def _misreading_udf(seen: pd.Series, true: pd.Series) -> pd.Series:
    return pd.Series([misreading(a, b) for a, b in zip(seen, true)], dtype=float)


def corrections(counts: DataFrame) -> DataFrame:
    """(word, c, p, n_word, n_c): words of the corpus that are likely enough a misreading of a word with higher count.

    Words made of the same parts meet by one key each. Only a word common enough for the greatest chance of any misreading
    is aligned with a rarer one.
    """
    words = counts.filter(r"word is not null and not contains(word, '-') and word <> '#'").select("word", "n", atoms(F.col("word")).alias("key"))
    symbol = F.col("word").rlike(r"[0-9$|]")
    enough = (symbol & (F.col("n_c") >= F.col("n_word") * 0.5)) | (F.col("n_c") * NOISY * F.when(symbol, 1.0).otherwise(MOST_LIKELY) > F.col("n_word") * 0.6)
    tried = words.filter(F.col("word").rlike(r"(?U)[^\W\d_].*[^\W\d_]")).select("key", "word", F.col("n").alias("n_word"))
    known = words.filter(~F.col("word").rlike(r"[0-9$|]") & (F.length("word") >= 2)).select("key", F.col("word").alias("c"), F.col("n").alias("n_c"))
    met = tried.join(known.hint("merge"), "key").filter((F.col("word") != F.col("c")) & enough).select("word", "c", "n_word", "n_c")
    scored = met.withColumn("p", _misreading_udf("word", "c")).filter("p > 0")
    return scored.filter((symbol & (F.col("n_c") >= F.col("n_word") * 0.5)) | (F.col("n_c") * F.col("p") * NOISY > F.col("n_word") * 0.6)).select("word", "c", "p", "n_word", "n_c")


def _bit_field(words: DataFrame) -> np.ndarray:
    """Bits of the given words, two each: 16 bits a word, within 2**BITS_LEAST and 2**BITS_MOST. Beyond that more lines pass for
    nothing; none is passed over."""
    size = 1 << min(BITS_MOST, max(BITS_LEAST, (16 * words.count()).bit_length()))
    both = words.select(F.explode(F.array(F.crc32(F.col("word").cast("binary")), F.crc32(F.concat(F.lit("~"), "word").cast("binary")))).alias("h"))
    slots = both.select(F.pmod("h", F.lit(size)).alias("bit")).groupBy((F.col("bit") / 32).cast("int").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(bit, 32) as int))")).alias("bits"))
    field = np.zeros(size // 32, dtype=np.uint32)
    got = slots.toPandas()
    field[got["slot"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    return field


SCAN = "item_id long, what string, line int, rest_line int, tokens array<string>"


def scan(texts: DataFrame, field: np.ndarray) -> DataFrame:
    """One pass over the texts: rows ``header``, ``page_number``, ``cut`` (tokens: left, right) and ``line`` (its words)."""
    shared = texts.sparkSession.sparkContext.broadcast(field)
    size = 32 * len(field)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        known: dict[str, bool] = {}

        def suspect(w: str) -> bool:
            hit = known.get(w)
            if hit is None:
                if len(known) > 300_000:
                    known.clear()
                a, b = zlib.crc32(w.encode()) % size, zlib.crc32(b"~" + w.encode()) % size
                hit = known[w] = bool(bits[a >> 5] >> np.uint32(a & 31) & 1) and bool(bits[b >> 5] >> np.uint32(b & 31) & 1) or bool(ODD.fullmatch(w))
            return hit

        for pdf in batches:
            rows = []
            for item, text in zip(pdf["item_id"], pdf["text"]):
                lines, marks = classify_lines(text)
                kinds = set("".join(marks))
                if "h" in kinds:
                    rows.append((item, "header", 0, 0, None))
                if "p" in kinds:
                    rows.append((item, "page_number", 0, 0, None))
                joined = {}
                for i, k, left, right in cut_words(lines, marks):
                    rows.append((item, "cut", i, k, [left.lower(), right.lower()]))
                    joined[i] = (left, right)
                skip_first: dict[int, bool] = {}
                for i, line in enumerate(lines):
                    if marks[i] in ("b", "t", "p"):
                        continue
                    words = tokens(line)
                    if skip_first.pop(i, False):
                        words = words[1:]
                    if i in joined and words:
                        left, right = joined[i]
                        words[-1] = (left + right).lower()
                        k = next((k for k in range(i + 1, len(lines)) if marks[k] == ""), None)
                        if k is not None:
                            skip_first[k] = True
                    if any(map(suspect, words)):
                        rows.append((item, "line", i, 0, words))
            if rows:
                yield pd.DataFrame(rows, columns=["item_id", "what", "line", "rest_line", "tokens"])

    return texts.mapInPandas(run, SCAN)


def _pair_code(codes: Codes, a: str, b: str) -> int:
    x = codes[a] * 0x9E3779B97F4A7C15 & _MASK
    x = (x ^ (x >> 29)) + (codes[b] * 0xC2B2AE3D27D4EB4F & _MASK) & _MASK
    return x - (1 << 64) if x >> 63 else x


_MASK = (1 << 64) - 1


@F.pandas_udf(T.ArrayType(T.LongType()))
def _pairs_udf(words: pd.Series, cands: pd.Series) -> pd.Series:
    """The codes of the word pairs whose counts the decoding of a line needs."""
    codes = Codes()

    def one(toks, entries):
        options = _options(toks, entries)
        out = set()
        for (a, b) in zip(options, options[1:]):
            if len(a) > 1 or len(b) > 1:
                out.update(_pair_code(codes, x[0], y[0]) for x in a for y in b)
        return sorted(out)

    return pd.Series([one(t, c) for t, c in zip(words, cands)], dtype=object)


def _options(toks, entries) -> list[list[tuple[str, float, float]]]:
    """Per word (candidate, log of the channel, count); the word itself first."""
    out = [[(w, 0.0, -1.0)] for w in toks]
    for e in entries:
        pos, c, p, n_word, n_c = e.split("\t")
        own = out[int(pos)]
        own[0] = (own[0][0], 0.0, max(0.0, float(n_word) - 1))
        own.append((c, math.log(min(0.3, NOISY * float(p))), float(n_c)))
    return out


def decode(toks: list[str], entries: list[str], pair_counts: dict[int, float], total: float, codes: Codes) -> list[tuple[int, str, str]]:
    """Viterbi over the candidates of a line; returns (position, word, reading) where the reading differs."""
    options = _options(toks, entries)
    best: list[tuple[float, int]] = [(0.0, -1)]
    back: list[list[int]] = []
    before = [("", 0.0, -1.0)]
    for own in options:
        scores, links = [], []
        for w, channel, n in own:
            base = math.log((n + 0.1) / total) if n >= 0 else 0.0
            top, link = -math.inf, 0
            for k, (v, _, nv) in enumerate(before):
                step = base
                if n >= 0 or nv >= 0:
                    together = pair_counts.get(_pair_code(codes, v, w), 0.0)
                    if n >= 0 and channel == 0.0 or nv >= 0 and before[k][1] == 0.0 and len(before) > 1:
                        together = max(0.0, together - 1)
                    uni = (n + 0.1) / total if n >= 0 else 1e-4
                    step = math.log(0.5 * min(1.0, together / max(nv, together, 50.0)) + 0.5 * uni)
                value = best[k][0] + step + channel
                if value > top + 1e-12:
                    top, link = value, k
            scores.append((top, link))
            links.append(link)
        best = scores
        back.append(links)
        before = own
    k = max(range(len(best)), key=lambda i: (best[i][0], -i))
    out = []
    for i in range(len(options) - 1, -1, -1):
        if k > 0:
            out.append((i, options[i][0][0], options[i][k][0]))
        k = back[i][k]
    return out[::-1]


FIXES = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("reading", T.StringType()), T.StructField("sure", T.BooleanType())]))


def _sure(entries: list[str]) -> set[tuple[int, str]]:
    """The (position, candidate) pairs that hold at the corpus' own rate of misreadings, or undo a symbol."""
    out = set()
    for e in entries:
        pos, c, p, n_word, n_c = e.split("\t")
        if float(n_c) * float(p) > 0.6 * float(n_word):
            out.add((int(pos), c))
    return out


def _readings(lines: DataFrame, counts: DataFrame, fixes: DataFrame) -> DataFrame:
    """(item_id, line, pos, word, reading) for the words of the lines that are read differently."""
    spark = lines.sparkSession
    placed = lines.select("item_id", "line", F.posexplode("tokens").alias("pos", "word"))
    odd = placed.filter(F.col("word").rlike(r"^[\p{L}\p{M}]+[01$9][\p{L}\p{M}]+$")).select("item_id", "line", "pos", "word")
    entry = F.concat_ws("\t", "pos", "c", "p", "n_word", "n_c")
    hits = placed.join(fixes.hint("merge"), "word").select("item_id", "line", "pos", "word", entry.alias("entry"))
    per_line = cut_lineage(hits.groupBy("item_id", "line").agg(F.sort_array(F.collect_set("entry")).alias("cands")).join(lines.dropDuplicates(["item_id", "line"]), ["item_id", "line"]))
    needed = per_line.select("item_id", "line", F.explode(_pairs_udf("tokens", "cands")).alias("key"))
    got = needed.join(counts.filter("word is null").select("key", "n").hint("merge"), "key").groupBy("item_id", "line").agg(F.collect_list(F.concat_ws("\t", "key", "n")).alias("pairs"))
    total = float(counts.filter("word is not null").agg(F.sum("n")).first()[0] or 1)

    @F.pandas_udf(FIXES)
    def read(words: pd.Series, cands: pd.Series, pairs: pd.Series) -> pd.Series:
        out = []
        codes = Codes()
        for t, c, p in zip(words, cands, pairs):
            have = dict((int(k), float(n)) for k, n in (x.rsplit("\t", 1) for x in (p if p is not None else ())))
            sure = _sure(c)
            found = decode(list(t), list(c), have, total, codes)
            out.append([{"pos": i, "word": w, "reading": r, "sure": (i, r) in sure or not w.isalpha()} for i, w, r in found])
        return pd.Series(out, dtype=object)

    decoded = per_line.join(got, ["item_id", "line"], "left").select("item_id", "line", F.explode(read("tokens", "cands", "pairs")).alias("_f"))
    decoded = decoded.select("item_id", "line", F.col("_f.pos").alias("pos"), F.col("_f.word").alias("word"), F.col("_f.reading").alias("reading"), F.col("_f.sure").alias("sure"))
    # a symbol inside a word that the corpus knows in no form: the likeliest letter
    plain = F.translate("word", "01$9", "olsg")
    unknown = odd.filter(F.col("word").rlike(r"^[\p{L}\p{M}]{2,}[01$9][\p{L}\p{M}]{2,}$") | (F.length("word") >= 6)).join(decoded, ["item_id", "line", "pos"], "left_anti")
    whole = decoded.unionByName(unknown.select("item_id", "line", "pos", "word", plain.alias("reading"), F.lit(True).alias("sure")))
    # unsure readings stand in texts that have a sure one
    whole = cut_lineage(whole)
    return whole.join(whole.filter("sure").select("item_id").distinct(), "item_id", "left_semi").drop("sure")


def _cut_decisions(cuts: DataFrame, counts: DataFrame) -> DataFrame:
    """(left, right, joins): whether the hyphen at a line end does not belong to the word."""
    pairs = cuts.select(F.col("tokens")[0].alias("left"), F.col("tokens")[1].alias("right")).distinct()
    keys = pairs.select(
        "left", "right",
        F.explode(F.create_map(
            F.lit("j"), F.concat("left", "right"), F.lit("h"), F.concat_ws("-", "left", "right"), F.lit("l"), F.col("left"), F.lit("r"), F.col("right"),
        )).alias("form", "key"),
    )
    n = lambda form: F.max(F.when(F.col("form") == form, F.col("n"))).alias(f"n_{form}")
    known = counts.filter("word is not null").select(F.col("word").alias("key"), "n")
    got = keys.join(known, "key").groupBy("left", "right").agg(n("j"), n("h"), n("l"), n("r"))
    j, h, left, right = (F.coalesce(F.col(c), F.lit(0)) for c in ("n_j", "n_h", "n_l", "n_r"))
    compound = F.when((j > 0) | (h > 0), h > j).otherwise((left >= 20) & (right >= 20) & (F.length("left") >= 4) & (F.length("right") >= 4))
    return pairs.join(got, ["left", "right"], "left").select("left", "right", (~compound).alias("joins"))


def analyse(items: DataFrame, source: str = "pdf") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scan rows, cut decisions, readings) of the full texts of live items of the given source."""
    own = items.filter(live(F.col("deleted")) & F.col("item_id").isNotNull())
    corpus = own.select(F.explode(F.array("abstract", "fulltext")).alias("text")).filter("text is not null and text <> ''")
    counts = cut_lineage(corpus_counts(corpus))
    fixes = cut_lineage(corrections(counts))
    texts = own.filter((F.lower(F.trim("fulltext_source")) == source) & (F.length("fulltext") > 0)).select("item_id", F.col("fulltext").alias("text"))
    rows = cut_lineage(scan(texts, _bit_field(fixes.select("word").distinct())))
    decisions = _cut_decisions(rows.filter("what = 'cut'"), counts)
    return rows, decisions, _readings(rows.filter("what = 'line'").select("item_id", "line", "tokens"), counts, fixes)


def noise_kinds(items: DataFrame, source: str = "pdf") -> DataFrame:
    """(item_id, noise) with noise one of hyphenation, characters, header, page_number."""
    rows, decisions, readings = analyse(items, source)
    lines = rows.filter("what in ('header', 'page_number')").select("item_id", F.col("what").alias("noise"))
    cuts = rows.filter("what = 'cut'").select("item_id", F.col("tokens")[0].alias("left"), F.col("tokens")[1].alias("right"))
    cuts = cuts.join(decisions.filter("joins"), ["left", "right"]).select("item_id", F.lit("hyphenation").alias("noise"))
    return lines.unionByName(cuts).unionByName(readings.select("item_id", F.lit("characters").alias("noise"))).distinct()


_ENDS = re.compile(r"[.!?…。！？।؟:\"”»)\]]\s*$")


def _rebuild(text: str, joins: dict[int, tuple[int, bool]], readings: dict[int, list[tuple[int, str, str]]]) -> str:
    """Paragraphs without page traces, with cut words joined and misread words replaced.

    ``joins``: line -> (line of the rest, whether the hyphen goes). A blank line ends a paragraph where a sentence ends; in
    texts that are not wrapped (lines beyond 130 characters) every line is a paragraph.
    """
    lines, marks = classify_lines(text)
    lines = [x.strip() if m == "" else x for x, m in zip(lines, marks)]
    for i, (k, drop) in sorted(joins.items()):
        first, _, rest = lines[k].partition(" ")
        lines[i] = (lines[i][:-1] if drop else lines[i]) + first
        lines[k] = rest
    for i, fixes in readings.items():
        for _, word, reading in fixes:
            lines[i] = re.sub(rf"(?<![\w$]){re.escape(word)}(?![\w$])", lambda m, r=reading: _case_like(m.group(), r), lines[i], flags=re.IGNORECASE)
    unwrapped = any(len(x) > 130 for x in lines)
    paragraphs: list[str] = []
    words: list[str] = []
    rows: list[str] = []

    def close() -> None:
        if words:
            paragraphs.append(" ".join(words))
            words.clear()

    for line, mark in zip(lines, marks):
        if mark == "t":
            rows.append(line.strip())
            continue
        if rows:
            close()
            paragraphs.append("\n".join(rows))
            rows.clear()
        if mark == "":
            if line:
                words.append(line)
            if unwrapped:
                close()
        elif mark == "b" and words and _ENDS.search(words[-1]):
            close()
    close()
    if rows:
        paragraphs.append("\n".join(rows))
    return "\n\n".join(paragraphs)


def _case_like(seen: str, reading: str) -> str:
    letters = [c for c in seen if c.isalpha()]
    if len(letters) > 1 and sum(c.isupper() for c in letters) > 0.6 * len(letters):
        return reading.upper()
    return reading[:1].upper() + reading[1:] if seen[:1].isupper() else reading


def repair(items: DataFrame, source: str = "pdf") -> DataFrame:
    """(item_id, text, n_fixes): the full texts as clean paragraphs."""
    rows, decisions, readings = analyse(items, source)
    cuts = rows.filter("what = 'cut'").select("item_id", "line", "rest_line", F.col("tokens")[0].alias("left"), F.col("tokens")[1].alias("right"))
    cuts = cuts.join(decisions, ["left", "right"]).groupBy("item_id").agg(F.collect_set(F.concat_ws("\t", "line", "rest_line", "joins")).alias("cuts"))
    reads = readings.groupBy("item_id").agg(F.collect_set(F.concat_ws("\t", "line", "pos", "word", "reading")).alias("reads"))
    own = items.filter(live(F.col("deleted")) & F.col("item_id").isNotNull() & (F.lower(F.trim("fulltext_source")) == source) & (F.length("fulltext") > 0))

    @F.pandas_udf(T.StringType())
    def build(text: pd.Series, cut: pd.Series, read: pd.Series) -> pd.Series:
        out = []
        for t, c, r in zip(text, cut, read):
            joins = {int(a): (int(b), x == "true") for a, b, x in (v.split("\t") for v in (c if c is not None else ()))}
            reading: dict[int, list[tuple[int, str, str]]] = {}
            for v in r if r is not None else ():
                line, pos, word, better = v.split("\t")
                reading.setdefault(int(line), []).append((int(pos), word, better))
            out.append(_rebuild(t, joins, reading))
        return pd.Series(out, dtype=object)

    base = own.select("item_id", "fulltext").join(cuts, "item_id", "left").join(reads, "item_id", "left")
    out = base.select("item_id", build("fulltext", "cuts", "reads").alias("text"), F.coalesce(F.size("reads"), F.lit(0)).alias("n_fixes"))
    return out.dropDuplicates(["item_id"])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return noise_kinds(table(spark, folder, "zotero_items"))


def p4_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return repair(table(spark, folder, "zotero_items"))


QUERIES = {"p4_found": p4_found, "p4_repaired": p4_repaired}
SQL: dict[str, str] = {}
