"""Lines of a scanned page: page numbers, running headers, and words cut at line ends. Plain functions on one text."""

from __future__ import annotations

import re

# Shapes of page numbers.
PAGE = r"(?:(?:page|seite|pagina|página|pag\.|pág\.|p\.|s\.|стр\.)\s*\d{1,4}|[-–—]\s*\d{1,4}\s*[-–—]|\[\s*\d{1,4}\s*\]|\d{1,4}\s*/\s*\d{1,4}|\d{1,4})"
PAGE_LINE = re.compile(rf"{PAGE}", re.IGNORECASE)
PAGE_LEFT = re.compile(rf"(?P<page>{PAGE})\s{{2,}}(?P<rest>\S.*)", re.IGNORECASE)
PAGE_RIGHT = re.compile(rf"(?P<rest>\S.*?)\s{{2,}}(?P<page>{PAGE})", re.IGNORECASE)
CAPTION = re.compile(r"(?:table|tab\.|tabla|tabelle|tableau|tabella|tabel|figure|fig\.|figura|abb\.|year|jahr|año|année|anno|jaar|таблица|表|図)\b[\s.:]*[\dIVX]*\.?", re.IGNORECASE)
CELL = re.compile(r"[\d\s.,%–-]+|(?=.*\d)[A-Za-z0-9 .-]{1,24}")
ENDED = re.compile(r"[.!?…。！？।؟:;][\"”»’)\]」』]*\s*$")
LETTER = re.compile(r"[^\W\d_]")
HYPHEN = re.compile(r"([^\W\d_][\w$]*(?:[-'’][\w$]+)*)[-‐­]$")


def _shape(line: str) -> str:
    return re.sub(r"[^a-z]", "", line.lower().replace("0", "o").replace("1", "l").replace("$", "s").replace("9", "g").replace("lh", "h"))


def _alike(a: str, b: str) -> bool:
    """Equal but for a few misread characters."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 3 or min(len(a), len(b)) < 4:
        return False
    same = sum(x == y for x, y in zip(a, b))
    back = sum(x == y for x, y in zip(a[::-1], b[::-1]))
    pairs = lambda x: {x[i : i + 2] for i in range(len(x) - 1)}
    return max(same, back, len(pairs(a) & pairs(b))) >= 0.7 * max(len(a), len(b))


def classify_lines(text: str) -> tuple[list[str], list[str]]:
    """The lines and a mark for each: '' text, 'b' blank, 't' table, 'p' page number, 'h' header, 'hp' both."""
    lines = [x.strip("\x0c\r ") if "\x0c" in x or "\r" in x else x.rstrip() for x in text.split("\n")]
    n = len(lines)
    marks = ["" if x.strip() else "b" for x in lines]
    parts: dict[int, tuple[str, str]] = {}
    for i, line in enumerate(lines):
        s = line.strip()
        if not s or len(s) > 80:
            continue
        if PAGE_LINE.fullmatch(s):
            parts[i] = (s, "")
        elif m := PAGE_LEFT.fullmatch(s) or PAGE_RIGHT.fullmatch(s):
            rest = m["rest"].strip()
            if not ENDED.search(rest) or rest.endswith(("al.", "a1.", "aI.")):
                parts[i] = (m["page"], rest)
    # tables: a caption and the cells below it, or a run of cells
    i = 0
    while i < n:
        s = lines[i].strip()
        if s and CAPTION.fullmatch(s):
            j = i + 1
            while j < n and lines[j].strip() and len(lines[j]) < 40 and CELL.fullmatch(lines[j].strip()):
                j += 1
            if j > i + 1:
                marks[i:j] = ["t"] * (j - i)
                i = j
                continue
        if s and s.isdigit():
            j = i
            while j < n and lines[j].strip().isdigit():
                j += 1
            numbers = [int(lines[k]) for k in range(i, j)]
            if len(numbers) >= 2 and any(b - a != 1 for a, b in zip(numbers, numbers[1:])):
                marks[i:j] = ["t"] * (j - i)
                i = j
                continue
            i = j
            continue
        i += 1
    for i, (page, rest) in parts.items():
        if marks[i] == "":
            marks[i] = "hp" if rest else "p"
    body = [x for x, m in zip(lines, marks) if m == "" and x.strip()]
    widths = sorted(map(len, body))
    width = widths[int(0.95 * (len(widths) - 1))] if widths else 0
    wrapped = len(body) >= 3 and width <= 130
    candidates = []
    shapes: list[tuple[int, str]] = [(i, _shape(rest)) for i, (p, rest) in parts.items() if rest and marks[i] == "hp"]
    for i, line in enumerate(lines):
        s = line.strip()
        if marks[i] or not LETTER.search(s) or len(s) > 70 or s[0].islower() and not re.search(r"[A-Z]{3}", s):
            continue
        et_al = re.search(r"\bet\s+a[l1I]\.?$", s)
        if ENDED.search(s) and not et_al:
            continue
        words = s.split()
        upper = sum(w.isupper() or sum(c.isupper() for c in w) >= 0.6 * len(w) for w in words if sum(map(str.isalpha, w)) >= 4)
        caps = upper >= 2 or (upper == 1 and len(words) <= 2)
        nxt = next((lines[k].strip() for k in range(i + 1, n) if marks[k] in ("", "t") and lines[k].strip()), "")
        first = nxt.split()[0] if nxt else ""
        short = len(s) + 1 + len(first) <= width - 1 and len(s) <= 0.7 * width if wrapped else len(words) <= 8
        if HYPHEN.search(s) or s.endswith("-"):
            continue
        if not (short or caps):
            continue
        shapes.append((i, _shape(s)))
        candidates.append((i, s, caps, bool(et_al), len(words), short))
    for i, s, caps, et_al, count, short in candidates:
        shape = _shape(s)
        again = any(j != i and len(shape) >= 4 and _alike(shape, other) for j, other in shapes)
        prev = next((lines[k].strip() for k in range(i - 1, -1, -1) if marks[k] == "" and lines[k].strip()), "")
        nxt = next((lines[k].strip() for k in range(i + 1, n) if marks[k] == "" and lines[k].strip()), "")
        cuts = bool(prev) and not ENDED.search(prev) and nxt[:1].islower()
        at_edge = i == 0 or marks[i - 1] in ("b", "p") or (i + 1 < n and marks[i + 1] in ("b", "p"))
        name = count <= 3 and s[0].isupper() and (et_al or ":" in s or count == 1)
        if i == n - 1 and not (caps or again or et_al):
            continue  # a text may break off in mid-sentence
        if caps or again or et_al or (short and (cuts or (name and (at_edge or i == 0 or ENDED.search(prev))))):
            marks[i] = "h"
    return lines, marks


def cut_words(lines: list[str], marks: list[str]) -> list[tuple[int, int, str, str]]:
    """(line, line of the rest, left part, right part) of words with a hyphen at the line end; noise lines are passed over."""
    out = []
    for i, line in enumerate(lines):
        if marks[i] != "" or not line or line[-1] not in "-‐­":
            continue
        m = HYPHEN.search(line)
        if not m:
            continue
        k = i + 1
        while k < len(lines) and marks[k] in ("h", "p", "hp", "b"):
            k += 1
        if k < len(lines) and marks[k] == "":
            r = re.match(r"[^\W\d_][\w$]*(?:['’][\w$]+)?", lines[k].strip())
            if r:
                left = re.split(r"['’]", m.group(1))[-1]
                out.append((i, k, left, r.group()))
    return out
