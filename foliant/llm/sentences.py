"""Problem 10: sentences in any language or script.

Candidate gaps are terminators (with closing quotes and brackets), line ends and, in scripts without spaces, the
spaces and the places between a polite ending and an opening word. Each gap gets a score for being a boundary; a path through the lattice of gaps with the greatest total is
taken, where a piece too small to be a sentence costs. Quotations and brackets inside a sentence are closed regions.
In scripts without spaces between words the text beside a gap is cut into words by a dictionary lattice, and the gap is
judged by final particles and opening words.

Nothing depends on a language label, as texts mix languages.

Defined results: null, empty or blank text: no sentences. Pieces without a letter or digit: no sentence. Texts of any
length are cut whole. Repeated rows give their sentences once per doc_id in p10_found. Further columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.session import table

# Abbreviations with a full stop, lower case, without it.
#: A name or title follows: never the end.
BEFORE_NAMES = frozenset(
    "dr prof mr mrs ms mme mlle st sr sra srta dott dottssa sig sigra ing hr fr ir drs mag dipl rev hon gen col capt lt sgt messrs mgr mons "
    "dna avv arch geb gest verh д-р проф акад им ул г-н г-жа डॉ प्रो श्री د أ م app ee jan feb apr aug sept oct nov dec".split()
)
#: A number or short label follows.
BEFORE_NUMBERS = frozenset(
    "no nos nr núm num n vol vols bd abb tab fig figs pp p pag pág págs s sec sect §§ eq eqs ref refs vers ver ch chap kap cap art ca approx aprox "
    "env circa cca c blz afb hfst rd рис табл с стр гл т № ок прибл par para ed eds ser suppl ff kl pt bl f".split()
)
#: More of the sentence always follows.
CONTINUING = frozenset(
    "e.g i.e ex cf vs viz bzw vgl sog inkl exkl evtl ggf bzgl resp bijv bv d.w.z o.a m.n d.h z.b u.a p.ex av apr cfr ad es per см напр т.е ср e.v ma mw dhr ds "
    "zgn incl excl esp ibid op cit al.s z.t u.u i.d.r v.a s.o s.u p.e c.-à-d c.à.d".split()
)
#: May close a sentence: decided by what follows.
MAYBE_FINAL = frozenset("etc usw ecc enz al p.m a.m jr sr inc ltd co corp bros uu г гг в вв др пр т.д т.п n.chr v.chr a.c d.c j.-c".split())
MONTHS_DE = re.compile(
    r"(Januar|Jänner|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Jahrhundert\w*|Jh|Jhs|Jahrtausend\w*|Auflage|Band|Kapitel|"
    r"Klasse|Tag|Teil|Grad\w*|Weltkrieg\w*|Internationale\w*|Kongress\w*|Geburtstag\w*|januari|februari|maart|mei|juni|juli|augustus|oktober|eeuw)\b"
)
# Words beside gaps in scripts without spaces.
OPENERS = tuple(
    "สุดท้าย ท้ายที่สุด เรา ผู้วิจัย ผู้เขียน ผลการศึกษา ผล บทความนี้ บทความ งานวิจัย ความรู้ หอจดหมายเหตุ ค่า อย่างไรก็ตาม ดังนั้น นอกจากนี้ จากนั้น ในขณะ ต่อมา เขา พวกเขา การ "
    "最后 然而 目前 本文 结果 借助 我们 据 但是 因此 此外 这 その結果 最後に 一方 本稿 しかし また そして 私たち これ".split()
)
#: Openers that begin a sentence right behind a polite ending, without a mark or a blank between them.
BEHIND_FINALS = tuple("次に それから しかし そして また その後 その結果 さらに 最後に 一方 ところが したがって これは それは".split())
POLITE = ("です", "ます", "でした", "ました")
FINALS = tuple(
    "อะไร หรือ ไหม มาก ไว้ ต่อไป เดิม ประกอบ แล้ว ครับ ค่ะ คะ นะ เลย ด้วย เท่านั้น ได้ กัน "
    "吗 呢 吧 了 的 啊 です ます でした ました だ た る か よ ね ない".split()
)
JOINERS_LEFT = tuple("และ หรือ คือ ว่า เช่น ได้แก่ ของ ที่ ใน จาก กับ 和 与 或 と や は が".split())
JOINERS_RIGHT = tuple("ที่ ซึ่ง และ หรือ เพื่อ โดย เมื่อ แต่ละ 和 与 或 と".split())

OPEN_QUOTES = {"“": "”", "«": "»", "„": "“”", "「": "」", "『": "』", "‹": "›", "‚": "‘’", "‘": "’", '"': '"', "»": "«"}
CLOSERS = "\"”’»“‘«)]）」』】›"
TERMINATORS = ".!?。！？…।॥؟۔｡"
GAP = re.compile(
    rf"[{TERMINATORS}]+(?:[   ]?[»]|[{re.escape(CLOSERS)}])*|[\n\r  \x0b\x0c]\s*|(?<=[฀-๿぀-ヿ一-鿿0-9%]) +(?=[฀-๿぀-ヿ一-鿿])"
    rf"|(?=[{''.join(sorted({w[0] for w in BEHIND_FINALS}))}])(?:{'|'.join(f'(?<={w})' for w in POLITE)})(?={'|'.join(BEHIND_FINALS)})"
)
QUOTE = re.compile(r"[“«„「『‹‘‚\"]")
#: A token is known by its last characters: no abbreviation, label or number of a heading is as long.
LOOK = 60
ENDS_TOKEN = frozenset("([{“„«‘\"—–/")
RUN, INK = re.compile(r"\S+"), re.compile(r"\S")
WORD = re.compile(r"[^\W_]")
SPACELESS = re.compile(r"[฀-๿぀-ヿ一-鿿]")
CASELESS = re.compile(r"[֐-ࣿऀ-෿฀-໿ᄀ-ᇿ぀-ヿ㐀-鿿가-힯]")
SURE = 9.0
#: Pieces of up to so many characters may be too small for a sentence; gaps above this score (in tenths) are always boundaries.
TINY, STRONG = 12, 35


@lru_cache(maxsize=1)
def _lexicon() -> tuple[frozenset[str], int]:
    words = frozenset(OPENERS + FINALS + JOINERS_LEFT + JOINERS_RIGHT + BEHIND_FINALS)
    return words, max(map(len, words))


def lattice_words(run: str) -> list[str]:
    """Cut a run of a spaceless script into dictionary words and unknown stretches: the path of least cost."""
    words, longest = _lexicon()
    n = len(run)
    cost, back = [0.0] + [1e9] * n, [0] * (n + 1)
    for i in range(n):
        c = cost[i]
        if c + 1.0 < cost[i + 1]:
            cost[i + 1], back[i + 1] = c + 1.0, i
        for k in range(1, min(longest, n - i) + 1):
            if run[i : i + k] in words and c + 0.9 < cost[i + k]:
                cost[i + k], back[i + k] = c + 0.9, i
    out, j = [], n
    while j:
        i = back[j]
        piece = run[i:j]
        if out and piece not in words and out[-1] not in words:
            out[-1] = piece + out[-1]
        else:
            out.append(piece)
        j = i
    return out[::-1]


def _spaceless_score(text: str, left: int, start: int, end: int) -> float:
    """Of a space in a spaceless script: final particle before, opening word behind, digits and joiners beside."""
    m = RUN.match(text, end)
    after = m.group() if m else ""
    at = start
    while at > left and not text[at - 1].isspace():
        at -= 1
    run = text[at:start]
    score = 1.0
    if run and (run[-1].isdigit() or run[-1] == "%" or run[-1] in ",;:、，；："):
        score -= 2.5
    wb, wa = lattice_words(run), lattice_words(after)
    if wb and wb[-1] in JOINERS_LEFT and wb[-1] not in FINALS:
        score -= 2.5
    elif wb and wb[-1] in FINALS:
        score += 1.0
    if wa and wa[0] in JOINERS_RIGHT:
        score -= 2.5
    elif wa and wa[0] in OPENERS:
        score += 1.2
    if "一" <= after[:1] <= "鿿" or "぀" <= after[:1] <= "ヿ":
        score -= 1.2
    return score


def _regions(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Quotations and brackets, each closed on its own line, as (position of opener, of closer)."""
    quotes, i, n = [], 0, len(text)
    open_until: dict[str, int] = {}  # marks that are known to stay open up to the end of their line
    if QUOTE.search(text):
        while True:
            m = QUOTE.search(text, i)
            if not m:
                break
            at, mark = m.start(), m.group()
            i = at + 1
            if mark in "‘\"" and at and text[at - 1].isalnum() or at < open_until.get(mark, 0):
                continue
            line_end = text.find("\n", at)
            line_end = n if line_end < 0 else line_end
            close = -1
            for j in range(at + 1, line_end):
                if text[j] in OPEN_QUOTES[mark]:
                    if mark in "‘‚" and j + 1 < n and text[j + 1].isalnum():
                        continue
                    close = j
                    break
            if close > 0:
                quotes.append((at, close))
                i = close + 1
            else:
                open_until[mark] = line_end
    brackets = []
    if "(" in text or "（" in text or "[" in text:
        stack: list[int] = []
        for m in re.finditer(r"[()（）\[\]\n]", text):
            c = m.group()
            if c == "\n":
                stack.clear()
            elif c in "(（[":
                stack.append(m.start())
            elif stack:
                at = stack.pop()
                if not stack:
                    brackets.append((at, m.start()))
    return quotes, brackets


def is_wrapped(block: list[str]) -> bool:
    """Lines cut by width alone: of even length, and hardly any ends a sentence."""
    if len(block) < 3:
        return False
    full = block[:-1]
    longest = max(map(len, full))
    if not 20 <= longest <= 120:
        return False
    even = sum(len(x) >= 0.72 * longest for x in full)
    open_end = sum(x.rstrip()[-1:] not in TERMINATORS + CLOSERS for x in full)
    if even < 0.8 * len(full) or open_end < 0.5 * len(full):
        return False
    starts = [x.lstrip()[:2] for x in block[1:]]
    cased = [x for x in starts if x[:1].lower() != x[:1].upper()]
    if not cased:
        return even >= 0.95 * len(full)
    return sum(x[:1].islower() and not x[1:].isupper() for x in cased) >= 0.3 * len(cased)


def _wrapped_breaks(text: str) -> set[int]:
    """Positions of single line ends that only wrap a line."""
    out: set[int] = set()
    if text.count("\n") < 2:
        return out
    at = 0
    for para in re.split(r"(\n[ \t]*\n\s*)", text):
        if "\n" in para and para.strip():
            lines = para.split("\n")
            if is_wrapped([x for x in lines if x.strip()]):
                p = at
                for line in lines[:-1]:
                    p += len(line)
                    out.add(p)
                    p += 1
        at += len(para)
    return out


def _score(text: str, s: int, e: int, left: int, quotes, brackets, wraps: set[int]) -> float:
    """Log-odds that the gap from ``s`` to ``e`` ends a sentence; ``left`` is the last sure boundary."""
    first = text[s]
    n = len(text)
    if s == e:  # no mark and no blank: a polite ending and an opener, as the lattice cuts them, outside quotations and brackets
        if any(a < s <= b for a, b in (*quotes, *brackets)):
            return -SURE
        at, after = s, RUN.match(text, s).group()
        while at > left and SPACELESS.match(text[at - 1]):
            at -= 1
        return 2.0 if lattice_words(text[at:s])[-1] in FINALS and lattice_words(after)[0] in BEHIND_FINALS else -SURE
    if first in "\n\r  \x0b\x0c":
        if s in wraps:
            return -SURE
        return SURE
    if first == " ":
        return _spaceless_score(text, left, s, e)
    mark_end = s
    while mark_end < e and text[mark_end] in TERMINATORS:
        mark_end += 1
    inside = None
    for q0, q1 in quotes:
        if q0 < s <= q1:
            if mark_end <= q1 < e or text[mark_end : q1 + 1].strip() == text[q1]:
                inside = (q0, q1)
            else:
                return -SURE
    closing_bracket = None
    for b0, b1 in brackets:
        if b0 < s < b1:
            if mark_end <= b1 < e:
                closing_bracket = (b0, b1)
            elif INK.search(text, left, b0):
                return -SURE
    k = e
    while k < n and text[k] in " \t   　​":
        k += 1
    if k >= n or text[k] in "\n\r ":
        return 3.0 if k >= n or text[k : k + 1] in "\n\r" and k not in wraps else _word_score(text, s, mark_end, e, k + 1)
    nxt, spaced = text[k], k > e
    if inside:
        q0, _ = inside
        leads = not text[left:q0].strip(" \t\n 　")
        if nxt in ",;:，、；：)—–-":
            return -SURE
        if nxt.islower() and not (k + 1 < n and text[k + 1].isupper()):
            return -SURE
        if nxt in OPEN_QUOTES:
            return 2.0
        if CASELESS.match(nxt):
            if "぀" <= nxt <= "ヿ":
                return -3.0
            if leads or (not spaced and "가" <= nxt <= "힯"):
                return -3.0
            return 2.0
        return 2.0 if spaced else 1.0
    if closing_bracket:
        if nxt.islower() or nxt in ",;:":
            return -SURE
        return 2.0
    return _word_score(text, s, mark_end, e, k)


def _word_score(text: str, s: int, mark_end: int, e: int, k: int) -> float:
    n = len(text)
    while k < n and text[k] in " \t\n":
        k += 1
    nxt = text[k] if k < n else "A"
    spaced = k > e
    mark = text[s:mark_end]
    if mark[-1] in "。！？।॥۔｡" or "؟" in mark:
        return 4.0 if nxt not in ",，、;；" else -4.0
    if nxt in ",;:،，、" or (nxt in ")]" and not spaced):
        return -SURE
    second_upper = k + 1 < n and text[k + 1].isupper()
    if nxt.islower() and not second_upper:
        return -4.0
    if mark != ".":
        if mark == ".." or spaced or nxt in OPEN_QUOTES or CASELESS.match(nxt):
            return 2.5
        return 1.0 if nxt.isupper() and mark[-1] in "!?" else -1.0
    if e > mark_end:  # closed by a quote or bracket that was not opened here
        return 2.0 if spaced else -1.0
    at, least = s, max(0, s - LOOK)
    while at > least and text[at - 1] not in ENDS_TOKEN and not text[at - 1].isspace():
        at -= 1
    token = text[at:s]
    low = token.lower().lstrip("(\"'«„“")
    last = low.rsplit(".", 1)[-1] if "." in low and low not in CONTINUING and low not in MAYBE_FINAL else low
    if not spaced:
        if "/" in token or "@" in token or "www" in low or not token:
            return -SURE
        if nxt.isupper() and k + 1 < n and text[k + 1].islower() and len(token) >= 3 and token[-1].islower():
            return 1.5
        if nxt in OPEN_QUOTES and len(token) >= 3:
            return 1.0
        if CASELESS.match(nxt) and CASELESS.match(token[-1:]) and len(token) >= 3:
            return 1.0
        return -SURE
    if low in CONTINUING or last in CONTINUING:
        return -4.0
    if last in BEFORE_NAMES:
        return -4.0
    if last in BEFORE_NUMBERS:
        if nxt.isdigit() or (nxt.isupper() and (k + 1 >= n or not text[k + 1].isalpha())):
            return -4.0
        if len(last) > 1 and last not in ("ca", "approx", "aprox", "env", "ок", "no", "fig", "vol"):
            return 0.5
        return -2.0
    if low in MAYBE_FINAL or last in MAYBE_FINAL:
        return 1.5 if nxt.isupper() or nxt in OPEN_QUOTES or nxt.isdigit() or nxt in "¿¡([" or CASELESS.match(nxt) else -3.0
    core = last.strip("()[]")
    if len(core) == 1 and core.isalpha():
        if core in "дп" and text.endswith(("т. " + core, "т." + core), 0, s):
            return 1.5
        if token[-1:].isupper() or token[-1:].islower() or CASELESS.match(core):
            return -3.0
    if core.isdigit() or re.fullmatch(r"[\d.,:/-]+", core or "x"):
        if MONTHS_DE.match(text, k):
            return -4.0
        if len(core) <= 3 and text[text.rfind("\n", 0, s) + 1 : s].strip() == token:
            return -2.0
        return 2.0
    if nxt.isdigit() or nxt.isupper() or second_upper or nxt in OPEN_QUOTES or nxt in "¿¡([" or CASELESS.match(nxt):
        return 2.5
    return 0.8


def split_sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each sentence, in code points, end exclusive, without outer white space."""
    if not text or not text.strip():
        return []
    quotes, brackets = _regions(text)
    wraps = _wrapped_breaks(text) if "\n" in text else set()
    gaps: list[tuple[int, float]] = []
    left, qi, bi = 0, 0, 0
    spans: list[tuple[int, int]] = []

    def close_block(upto: int) -> None:
        start = left_sure[0]
        spans.extend(_best_path(text, start, upto, gaps))
        gaps.clear()
        left_sure[0] = upto

    left_sure = [0]
    for m in GAP.finditer(text):
        s, e = m.span()
        while qi < len(quotes) and quotes[qi][1] < s - 1:
            qi += 1
        while bi < len(brackets) and brackets[bi][1] < s - 1:
            bi += 1
        # quotations follow one another: at most one ends at s - 1 and one holds s before the next one begins
        for q0, _ in quotes[qi : qi + 3]:  # a mark that opens the next quotation closes nothing here
            if s < q0 < e:
                e = q0
                break
        score = _score(text, s, e, left, quotes[qi : qi + 2], brackets[bi : bi + 2], wraps)
        if score >= SURE:
            close_block(e)
            left = e
        elif score > -SURE:
            gaps.append((e, score))
            if score > 0:
                left = e
    close_block(len(text))
    return spans


def _best_path(text: str, start: int, end: int, gaps: list[tuple[int, float]]) -> list[tuple[int, int]]:
    """The boundaries with the greatest total score; a piece of hardly any letters costs, and so does passing over a gap that
    looks like a boundary. A gap with a score above ``STRONG`` is never passed over.

    With S the running sum of what passing over costs, a piece from i to j is worth best[i] + S[i] - S[j - 1] + score[j]. Only
    pieces of up to ``TINY`` characters cost anything of their own, so the best start of all longer ones is one running value,
    however many gaps there are. Scores are tenths, so sums are exact.
    """
    points = [start, *[g for g, _ in gaps if g < end], end]
    scores = [0, *[round(10 * x) for g, x in gaps if g < end], 0]
    n = len(points)
    if n == 2:
        chosen = [0, 1]
    else:
        best, back = [0] * n, [0] * n
        passed = [0] * n  # S
        far, first_near = -1, 0  # the best start farther than TINY, and the first start nearer
        for j in range(1, n):
            at = points[j]
            while first_near < j and at - points[first_near] > TINY:
                if far < 0 or best[first_near] + passed[first_near] >= best[far] + passed[far]:
                    far = first_near
                first_near += 1
            top, link = (best[far] + passed[far], far) if far >= 0 else (-(10**9), -1)
            for i in range(first_near, j):
                letters = sum(map(str.isalnum, text[points[i] : at]))
                value = best[i] + passed[i] - (22 if letters < 2 else 6 if letters < 3 else 0)
                if value >= top:
                    top, link = value, i
            best[j], back[j] = top - passed[j - 1] + scores[j], link
            passed[j] = passed[j - 1] + max(0, scores[j])
            if scores[j] > STRONG:
                far, first_near = -1, j
        chosen, j = [n - 1], n - 1
        while j:
            j = back[j]
            chosen.append(j)
        chosen.reverse()
    out = []
    for i, j in zip(chosen, chosen[1:]):
        a, b = points[i], points[j]
        piece = text[a:b]
        lead = len(piece) - len(piece.lstrip(" \t\n\r   　​﻿\x0b\x0c  "))
        piece = piece.strip()
        if piece and WORD.search(piece):
            out.append((a + lead, a + lead + len(piece)))
    return out


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


@F.pandas_udf(SPAN)
def sentence_spans(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [{"start": a, "end": b} for a, b in split_sentences(t)])


def sentences(documents: DataFrame) -> DataFrame:
    """One row per sentence: doc_id, sent_no (from 0), sent_start, sent_end (offsets in code points) and the text."""
    cut = documents.select("doc_id", "text", sentence_spans("text").alias("_spans"))
    rows = cut.select("doc_id", "text", F.posexplode("_spans").alias("sent_no", "_s"))
    return rows.select(
        "doc_id", "sent_no", F.col("_s.start").alias("sent_start"), F.col("_s.end").alias("sent_end"),
        F.expr("substring(text, _s.start + 1, _s.end - _s.start)").alias("sentence"),
    )


def p10_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return sentences(table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    cut = documents.select("doc_id", F.explode(F.transform(sentence_spans("text"), lambda s: s["start"])).alias("sent_start"))
    return cut.distinct()


QUERIES = {"p10_found": p10_found, "p10_sentences": p10_sentences}
SQL: dict[str, str] = {}
