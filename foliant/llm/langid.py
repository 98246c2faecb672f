"""Problem 2: the languages of a field and of its segments, with a confidence.

Hierarchical: a sentence's script and, within Latin script, a linear support vector machine give its family; within the
family one-versus-one linear support vector machines separate the close languages (en/de/nl, fr/es/it, zh/ja). The
machines are fitted here, on at most ``TRAIN_ROWS`` labelled rows of documents (the ones with the smallest hashes of
their id, and ``TRAIN_SENTENCES`` of their sentences). Labels there are noisy, so a first fit removes the rows it contradicts and a second fit stands. Weights sit
in 2**15 hashed features (words and their letter trigrams), so what is broadcast has a fixed size.

A sentence's score is the mean over its words, and a word's score is looked up once per worker and kept, so each text
costs one tokenisation and array arithmetic.

For ``label_conflicts`` a field is first scored in coarse pieces. Only where a piece disagrees with the label, or the
label names nothing, is it cut into exact sentences.

Defined results: null, empty and placeholder fields give no rows; sentences of fewer than three words (or five
letters in scripts without spaces), tables and headings in capitals take no part unless the field has nothing else.
Texts are scored whole. Repeated rows count once. Empty tables give no rows; an empty training table leaves scripts
and a fixed list of function words to decide. Labels in unknown spellings name no language.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.fields import is_placeholder, live, plain_text
from foliant.llm.scanlines import classify_lines
from foliant.llm.sentences import split_sentences
from foliant.session import table

#: The bounds of the training sample: labelled rows, pieces of each row and of all rows that are fitted. The pieces of a row
#: are spread evenly over its whole text.
TRAIN_ROWS, ROW_SENTENCES, TRAIN_SENTENCES = 4000, 200, 8000
#: A piece without a sentence end counts by so many of its characters in the fit.
PIECE_CHARS = 2000
BITS = 15
FAMILIES = {"germanic": ("en", "de", "nl"), "romance": ("fr", "es", "it")}
LATIN = FAMILIES["germanic"] + FAMILIES["romance"]
#: Column order of the machines for Latin script: the family, then the pairs within each family.
PAIRS = [("germanic", "romance"), ("en", "de"), ("en", "nl"), ("de", "nl"), ("fr", "es"), ("fr", "it"), ("es", "it")]
HAN_PAIR = ("zh", "ja")

# Spellings of language labels. Codes with a region lose it first.
LABELS = {
    "en": "en eng english englisch anglais inglés ingles inglese engels английский",
    "de": "de deu ger german deutsch allemand alemán aleman tedesco duits немецкий",
    "fr": "fr fra fre french français francais französisch francés francese frans французский",
    "es": "es spa spanish español espanol spanisch espagnol castellano spagnolo spaans испанский",
    "it": "it ita italian italiano italienisch italien italiaans итальянский",
    "nl": "nl nld dut dutch nederlands niederländisch néerlandais flemish vlaams olandese",
    "ru": "ru rus russian русский russisch russe ruso russo",
    "zh": "zh zho chi cmn chinese 中文 汉语 漢語 普通话 简体中文 繁體中文 chinesisch chinois chino cinese",
    "ja": "ja jpn jp japanese 日本語 japanisch japonais japonés giapponese",
    "ko": "ko kor kr korean 한국어 조선말 koreanisch coréen coreano",
    "ar": "ar ara arabic العربية عربي arabisch arabe árabe arabo",
    "hi": "hi hin hindi हिन्दी हिंदी",
    "th": "th tha thai ไทย ภาษาไทย thailändisch thaï",
}
LABEL_OF = {spelling: code for code, spellings in LABELS.items() for spelling in spellings.split()}
# Function words, for the case that there is nothing to learn from.
SEED = {
    "en": "the of and to in that is was for with by on are from this which these at we not",
    "de": "der die das und ist nicht von mit den im zu auf ein eine wir sich des dem für wie",
    "nl": "de het een en van is niet met op zijn dat te wij bij voor deze dit nog om aan",
    "fr": "le la les des et est une dans pour que du sur nous pas par cette avec ces au ce",
    "es": "el la los las de y en que un una por con se para del no al este más estas",
    "it": "il lo la gli di e che un una per con del non della nel sono dei alla questo le",
}
WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
COARSE = re.compile(r"(?<=[.!?…。！？।؟])[\"”»’)\]]*\s+|(?<=[。！？।؟])|\n\s*\n|(?<=[.!?”»\"])\n")
SCRIPTS = (
    ("ru", re.compile(r"[Ѐ-ԯ]"), 1.0), ("ar", re.compile(r"[؀-ۿݐ-ݿࢠ-ࣿﭐ-﷿ﹰ-﻿]"), 1.0), ("hi", re.compile(r"[ऀ-ॿ]"), 1.0),
    ("th", re.compile(r"[฀-๿]"), 1.0), ("ko", re.compile(r"[가-힯ᄀ-ᇿ㄰-㆏]"), 2.0), ("kana", re.compile(r"[぀-ヿㇰ-ㇿ]"), 2.0), ("han", re.compile(r"[㐀-䶿一-鿿]"), 2.0),
)
CJK = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]")
NON_LATIN = re.compile(r"[Ѐ-ԯ؀-ۿݐ-ݿऀ-ॿ฀-๿ᄀ-ᇿ぀-ヿ㄰-㆏㐀-䶿一-鿿가-힯ﭐ-﷿ﹰ-﻿]")
LATIN_LETTER = re.compile(r"[A-Za-zÀ-ɏ]")


def label_code(label: str | None) -> str | None:
    """The language a label names in any spelling; None for empty, meaningless and unknown ones."""
    if not label:
        return None
    x = label.strip().lower()
    return LABEL_OF.get(x) or LABEL_OF.get(re.split(r"[-_ (/]", x, maxsplit=1)[0])


def _word_features(word: str) -> list[int]:
    padded = f"^{word}$"
    names = [padded] + [padded[i : i + 3] for i in range(len(padded) - 2)]
    mask = (1 << BITS) - 1
    return [zlib.crc32(x.encode()) & mask for x in names]


class Machines:
    """Linear support vector machines over mean word features: ``weights`` is features by machines."""

    def __init__(self, weights: np.ndarray, han: dict[str, float]):
        self.weights, self.han = weights, han
        self._slot: dict[str, int] = {"": 0}
        self._rows = np.zeros((1 << 12, weights.shape[1]), dtype=np.float32)

    def __getstate__(self):
        return {"weights": self.weights, "han": self.han}

    def __setstate__(self, state):
        self.__init__(state["weights"], state["han"])

    def slots(self, words: list[str]) -> np.ndarray:
        get = self._slot.get
        out = [get(w, -1) for w in words]
        if -1 in out:
            if len(self._slot) > 300_000:  # a word's score can be had again at any time
                self._slot = {"": 0}
                return self.slots(words)
            for i, s in enumerate(out):
                if s < 0:
                    out[i] = self._learn(words[i])
        return np.asarray(out, dtype=np.int64)

    def _learn(self, word: str) -> int:
        known = self._slot.get(word)
        if known is not None:
            return known
        k = self._slot[word] = len(self._slot)
        if k >= len(self._rows):
            self._rows = np.vstack([self._rows, np.zeros_like(self._rows)])
        f = _word_features(word)
        self._rows[k] = self.weights[f].sum(axis=0) / np.sqrt(len(f))
        return k

    def score(self, pieces: list[list[str]]) -> np.ndarray:
        """Mean score of each piece, given as words; pieces are not empty."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        slots = self.slots([w for p in pieces for w in p])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        return np.add.reduceat(self._rows[slots], starts, axis=0) / lengths[:, None]

    def latin(self, pieces: list[list[str]]) -> list[tuple[str, float]]:
        """Family first, then the votes of the pairs within it; the confidence is the weaker of both."""
        s = self.score(pieces)
        sure = 1 / (1 + np.exp(-4.0 * np.abs(s)))
        out = []
        for x, p in zip(s, sure):
            names, first = (FAMILIES["germanic"], 1) if x[0] > 0 else (FAMILIES["romance"], 4)
            a, b, c = x[first], x[first + 1], x[first + 2]  # 0-1, 0-2, 1-2
            total = (a + b, c - a, -b - c)
            k = int(np.argmax(total))
            own = ((first, first + 1), (first, first + 2), (first + 1, first + 2))[k]
            out.append((names[k], float(min(p[0], p[own[0]], p[own[1]]))))
        return out


def _fit_linear(slots: np.ndarray, rows: np.ndarray, values: np.ndarray, targets: np.ndarray, n: int) -> np.ndarray:
    """Squared hinge loss with L2 penalty by accelerated gradient steps, all machines at once.

    ``targets`` is rows by machines with 1, -1, or 0 where a row takes no part.
    """
    dims, m = 1 << BITS, targets.shape[1]
    used, slot = np.unique(slots, return_inverse=True)
    order = np.argsort(slot, kind="stable")
    by_slot_rows, by_slot_values = rows[order], values[order]
    slot_starts = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=len(used)))[:-1]])
    row_starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))[:-1]])
    w = np.zeros((len(used), m), dtype=np.float32)
    ahead, t = w.copy(), 1.0
    counts = np.maximum(1, (targets != 0).sum(axis=0)).astype(np.float32)
    penalty = 2e-4
    part = (targets != 0).astype(np.float32) / counts
    v = np.random.default_rng(1).random(w.shape).astype(np.float32)
    for _ in range(7):  # the greatest curvature of each machine, for the longest safe step
        v /= np.linalg.norm(v, axis=0) + 1e-12
        forth = part * np.add.reduceat(v[slot] * values[:, None], row_starts, axis=0)
        v = np.add.reduceat(forth[by_slot_rows] * by_slot_values[:, None], slot_starts, axis=0)
    step = 1 / (1.15 * np.linalg.norm(v, axis=0) + penalty)
    for _ in range(40):
        margin = targets * np.add.reduceat(ahead[slot] * values[:, None], row_starts, axis=0)
        slack = np.where(targets != 0, np.maximum(0, 1 - margin), 0)
        pull = (slack * targets / counts).astype(np.float32)
        grad = -np.add.reduceat(pull[by_slot_rows] * by_slot_values[:, None], slot_starts, axis=0) + penalty * ahead
        new = ahead - step * grad
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + ((t - 1) / t2) * (new - w)
        w, t = new, t2
    out = np.zeros((dims, m), dtype=np.float32)
    out[used] = w
    return out


def fit(labelled: list[tuple[str, str]]) -> Machines:
    """Machines from (text, language) rows whose labels may be wrong."""
    texts: list[list[str]] = []
    langs: list[str] = []
    han: list[tuple[list[str], int]] = []
    for text, lang in labelled:
        if lang in HAN_PAIR:
            for piece in COARSE.split(text):
                chars = CJK.findall(piece)
                if len(chars) >= 4:
                    han.append((chars, 1 if lang == HAN_PAIR[0] else -1))
        if lang in LATIN:
            for piece in COARSE.split(text):
                words = [w.lower() for w in WORDS.findall(piece)] if not NON_LATIN.search(piece) else []
                if len(words) >= 4:
                    texts.append(words)
                    langs.append(lang)
    for lang, words in SEED.items():
        texts.append(words.split())
        langs.append(lang)
    if len(texts) > TRAIN_SENTENCES:
        keep = np.linspace(0, len(texts) - 1, TRAIN_SENTENCES).astype(int)
        texts, langs = [texts[i] for i in keep], [langs[i] for i in keep]

    def once(keep: list[int]) -> np.ndarray:
        slots, rows, values = [], [], []
        targets = np.zeros((len(keep), len(PAIRS)), dtype=np.float32)
        for r, i in enumerate(keep):
            per = 1.0 / len(texts[i])
            for w in texts[i]:
                f = _word_features(w)
                slots += f
                rows += [r] * len(f)
                values += [per / np.sqrt(len(f))] * len(f)
            lang = langs[i]
            for k, (a, b) in enumerate(PAIRS):
                targets[r, k] = 1 if lang in FAMILIES.get(a, (a,)) else -1 if lang in FAMILIES.get(b, (b,)) else 0
        scale = 4.0  # brings margins of mean features to about one
        return scale * _fit_linear(np.asarray(slots), np.asarray(rows), scale * np.asarray(values, dtype=np.float32), targets, len(keep))

    # the scaled features and weights cancel into plain means times scaled weights
    first = Machines(once(list(range(len(texts)))), {})
    said = first.latin(texts)
    keep = [i for i, (lang, _) in enumerate(said) if lang == langs[i]]
    missing = set(LATIN) - {langs[i] for i in keep}
    if missing:
        keep += [i for i, lang in enumerate(langs) if lang in missing]
    return Machines(once(keep), _fit_han(han))


def _fit_han(pieces: list[tuple[list[str], int]]) -> dict[str, float]:
    """Weights of characters of the machine that tells Chinese (above zero) from Japanese."""
    if len({side for _, side in pieces}) < 2:
        return {}
    if len(pieces) > TRAIN_SENTENCES:
        pieces = [pieces[i] for i in np.linspace(0, len(pieces) - 1, TRAIN_SENTENCES).astype(int)]
    known = {c: k for k, c in enumerate(sorted({c for chars, _ in pieces for c in chars}))}
    slots = np.array([known[c] for chars, _ in pieces for c in chars if c in known])
    rows = np.array([r for r, (chars, _) in enumerate(pieces) for c in chars if c in known])
    values = np.array([4.0 / len(chars) for chars, _ in pieces for c in chars if c in known], dtype=np.float32)
    targets = np.array([[side] for _, side in pieces], dtype=np.float32)
    weights = 4.0 * _fit_linear(slots, rows, values, targets, len(pieces))[:, 0]
    return {c: float(weights[k]) for c, k in known.items()}


def spread_pieces(text: str, most: int = ROW_SENTENCES) -> str:
    """At most ``most`` coarse pieces of a text, evenly spread over it, a paragraph each."""
    pieces = COARSE.split(text)
    return "\n\n".join(p[:PIECE_CHARS] for p in pieces[:: max(1, -(-len(pieces) // most))])


@F.pandas_udf(T.StringType())
def _spread_udf(texts: pd.Series) -> pd.Series:
    return texts.map(spread_pieces)


def train(documents: DataFrame, rows: int = TRAIN_ROWS) -> Machines:
    """Fit on the ``rows`` labelled documents with the smallest hashes of their ids."""
    labelled = documents.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    hashed = labelled.select(F.xxhash64("doc_id").alias("h"), "lang", "text")
    n = labelled.count()
    if 1.1 * rows < n:  # a threshold, not a sort: no partition sends more than its part of the sample
        hashed = hashed.filter(F.col("h") < int(-(2**63) + 2**64 * (1.1 * rows / n)))
    got = sorted(((r.h, r.lang, r.text) for r in hashed.withColumn("text", _spread_udf("text")).collect()), key=lambda r: (r[0], r[2]))[:rows]
    pairs = [(text, code) for _, lang, text in got if (code := label_code(lang))]
    return fit(pairs)


def script_language(piece: str, machines: Machines) -> tuple[str | None, float]:
    """The language by script, or (None, share) where Latin letters prevail."""
    weight = {name: w * len(pattern.findall(piece)) for name, pattern, w in SCRIPTS}
    latin = len(LATIN_LETTER.findall(piece))
    kana, han = weight.pop("kana"), weight.pop("han")
    weight["cjk"] = kana + han
    name = max(weight, key=lambda k: weight[k])
    total = sum(weight.values()) + latin
    if weight[name] <= latin or not total:
        return None, latin / max(1, total)
    share = weight[name] / total
    if name != "cjk":
        return name, share
    if kana >= 0.12 * (kana + han):
        return "ja", share
    chars = CJK.findall(piece)
    lean = sum(machines.han.get(c, 0.0) for c in chars) / max(1, len(chars)) - 0.5 * (kana > 0)
    return ("zh" if lean >= 0 else "ja"), share * float(1 / (1 + np.exp(-4 * abs(lean) - 0.5)))


def classify(pieces: list[str], machines: Machines) -> list[tuple[str | None, float, int]]:
    """(language, confidence, number of words) of each piece; None where there is too little to tell."""
    out: list[tuple[str | None, float, int]] = [(None, 0.0, 0)] * len(pieces)
    latin_at, latin_words = [], []
    for i, piece in enumerate(pieces):
        if not piece.isascii() and NON_LATIN.search(piece):
            lang, share = script_language(piece, machines)
            if lang:
                letters = len(NON_LATIN.findall(piece))
                out[i] = (lang, share, letters // 2)
                continue
        words = WORDS.findall(piece.lower())
        if words:
            latin_at.append(i)
            latin_words.append(words)
    if latin_words:
        for i, words, (lang, sure) in zip(latin_at, latin_words, machines.latin(latin_words)):
            out[i] = (lang, sure, sum(len(w) > 1 for w in words))
    return out


def _unwrap(text: str) -> str:
    """Line ends within sentences become blanks of the same length, so offsets hold."""
    return re.sub(r"(?<=[^\n.!?…:”»\"])\n(?=[^\n])", " ", text)


def _without_page_lines(text: str) -> str:
    """Running headers, page numbers and tables of scanned pages become blanks of the same length: they are no sentences."""
    if "\n" not in text:
        return text
    _, marks = classify_lines(text)
    if not any(m in ("h", "p", "hp", "t") for m in marks):
        return text
    lines = text.split("\n")
    ends = ["\n" if m != "h" and m != "p" and m != "hp" else " " for m in marks[1:]] + [""]
    return "".join((line if m in ("", "b") else " " * len(line)) + end for line, m, end in zip(lines, marks, ends))


def is_sentence(piece: str, words: int) -> bool:
    """Whole sentences only: no headings in capitals, tables or page lines."""
    if words < 3:
        return False
    letters = [c for c in piece if c.isalpha()]
    if LATIN_LETTER.search(piece) and sum(c.isupper() for c in letters) > 0.6 * len(letters):
        return False
    return True


def segments(text: str, machines: Machines) -> list[tuple[int, int, str, float]]:
    """(start, end, language, confidence) of each run of sentences in one language."""
    flat = _unwrap(_without_page_lines(text))
    spans = split_sentences(flat)
    if not spans:
        return []
    said = classify([flat[a:b] for a, b in spans], machines)
    whole = [bool(lang) and is_sentence(flat[a:b], n) for (a, b), (lang, _, n) in zip(spans, said)]
    if not any(whole):
        whole = [bool(lang) for lang, _, _ in said]
        if not any(whole):
            return []
    mass: dict[str, float] = {}
    for ok, (lang, sure, n) in zip(whole, said):
        if ok:
            mass[lang] = mass.get(lang, 0.0) + n * (sure - 0.4)
    main = max(mass, key=lambda k: mass[k])
    named: list[tuple[str | None, float, int]] = []
    for ok, (lang, sure, n) in zip(whole, said):
        if ok and lang in LATIN and lang != main and (n < 4 or sure < (0.8 if n >= 6 else 0.85)):
            named.append((main, 1 - sure, n))  # too weak to stand against the field
        else:
            named.append((lang if ok else None, sure, n))
    out: list[list] = []
    current = next(lang for lang, _, _ in named if lang)
    for (a, b), (lang, sure, n) in zip(spans, named):
        lang = lang or current
        current = lang
        if out and out[-1][2] == lang:
            out[-1][1] = b
            out[-1][3] += sure * n
            out[-1][4] += n
        else:
            out.append([a, b, lang, sure * n, n])
    return [(a, b, lang, round(total / max(1, n), 4)) for a, b, lang, total, n in out]


def agrees(text: str, label: str, machines: Machines) -> bool:
    """True where every coarse piece of the text is in the labelled language. Pieces are at least as long as the sentences in
    them, and a piece with three words or more in another script or language always speaks, so that a foreign sentence that
    counts (see ``segments``) is never passed over for being short."""
    pieces = [p for p in COARSE.split(_unwrap(text)) if p]
    return all(lang in (label, None) or n < 3 for lang, _, n in classify(pieces, machines))


def _fields(items: DataFrame) -> DataFrame:
    """item_id, label, field_name, text of the real fields of live items; a row per delivery."""
    abstract = plain_text(F.col("abstract"))
    cut = items.filter(live(F.col("deleted")) & F.col("item_id").isNotNull())
    return cut.select(
        "item_id", F.col("language").alias("label"),
        F.when(~is_placeholder(abstract), abstract).alias("abstract"), F.when(F.length(F.trim("fulltext")) > 0, F.col("fulltext")).alias("fulltext"),
    ).filter("abstract is not null or fulltext is not null")


def field_segments(items: DataFrame, machines: Machines) -> DataFrame:
    """item_id, field_name, seg_no, seg_start, seg_end, lang, confidence for every field. Abstract offsets refer to its plain text."""
    shared = items.sparkSession.sparkContext.broadcast(machines)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for pdf in batches:
            rows = []
            for item, abstract, fulltext in zip(pdf["item_id"], pdf["abstract"], pdf["fulltext"]):
                for name, text in (("abstract", abstract), ("fulltext", fulltext)):
                    if text:
                        rows += [(item, name, k, *s) for k, s in enumerate(segments(text, own))]
            if rows:
                yield pd.DataFrame(rows, columns=["item_id", "field_name", "seg_no", "seg_start", "seg_end", "lang", "confidence"])

    schema = "item_id long, field_name string, seg_no int, seg_start int, seg_end int, lang string, confidence double"
    return _fields(items).mapInPandas(run, schema).dropDuplicates(["item_id", "field_name", "seg_no"])


def label_conflicts(items: DataFrame, machines: Machines) -> DataFrame:
    """item_id, field_name, lang for the fields whose languages are not exactly the labelled one."""
    shared = items.sparkSession.sparkContext.broadcast(machines)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for pdf in batches:
            rows = []
            for item, label, abstract, fulltext in zip(pdf["item_id"], pdf["label"], pdf["abstract"], pdf["fulltext"]):
                code = label_code(label)
                for name, text in (("abstract", abstract), ("fulltext", fulltext)):
                    if not text or code and agrees(text, code, own):
                        continue
                    found = {s[2] for s in segments(text, own)}
                    if found and found != {code}:
                        rows += [(item, name, lang) for lang in sorted(found)]
            if rows:
                yield pd.DataFrame(rows, columns=["item_id", "field_name", "lang"])

    return _fields(items).mapInPandas(run, "item_id long, field_name string, lang string").distinct()


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return label_conflicts(table(spark, folder, "zotero_items"), train(table(spark, folder, "documents")))


def p2_segments(spark: SparkSession, folder: str) -> DataFrame:
    return field_segments(table(spark, folder, "zotero_items"), train(table(spark, folder, "documents")))


QUERIES = {"p2_found": p2_found, "p2_segments": p2_segments}
SQL: dict[str, str] = {}
