"""Cases beyond every former bound: they come out like the short ones."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest

from foliant.llm import langid, nearcopies, registry, sentences

from .conftest import item
from .test_problems import SAMPLE


@pytest.mark.parametrize("n", [5, 45, 100, 3000])
def test_a_sentence_with_many_initials_stays_whole(n):
    text = "Seen by " + " ".join(f"{random.Random(k).choice('ABCDEFGHKLMN')}." for k in range(n)) + " Smith in May. Then it rained."
    assert [text[a:b] for a, b in sentences.split_sentences(text)][1:] == ["Then it rained."]


def test_path_against_all_paths():
    """The running best gives the same total as trying every set of boundaries."""
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice("ab .") for _ in range(rng.randint(5, 60)))
        places = sorted(rng.sample(range(1, len(text)), rng.randint(1, min(9, len(text) - 1))))
        gaps = [(g, rng.choice([-4.0, -3.0, -1.0, 0.5, 0.8, 1.0, 1.5, 2.0, 2.5, 4.0])) for g in places]

        def total(chosen):
            points = [0, *[gaps[k][0] for k in chosen], len(text)]
            value = sum(round(10 * gaps[k][1]) for k in chosen)
            value -= sum(max(0, round(10 * gaps[k][1])) for k in range(len(gaps)) if k not in chosen)
            for a, b in itertools.pairwise(points):
                letters = sum(map(str.isalnum, text[a:b]))
                if b - a <= sentences.TINY:
                    value -= 22 if letters < 2 else 6 if letters < 3 else 0
            return value

        sets = [c for r in range(len(gaps) + 1) for c in itertools.combinations(range(len(gaps)), r) if all(k in c for k in range(len(gaps)) if gaps[k][1] > 3.5)]
        best = max(map(total, sets))
        wanted = {tuple(x for x in spans_of(text, [0, *[gaps[k][0] for k in c], len(text)])) for c in sets if total(c) == best}
        assert tuple(sentences._best_path(text, 0, len(text), gaps)) in wanted


def spans_of(text, points):
    for a, b in itertools.pairwise(points):
        piece = text[a:b]
        if piece.strip() and sentences.WORD.search(piece):
            lead = len(piece) - len(piece.lstrip())
            yield a + lead, a + lead + len(piece.strip())


# --- 6: names of any length


def test_spellings_of_short_names(spark, library):
    people = [
        (1, "Ute", "Kühn"), (2, "Ute", "Kuehn"), (3, "Paul", "Böhm"), (4, "Paul", "Boehm"), (5, "U.", "Kuehn"), (6, "Jørn", "Åsen"), (7, "Joern", "Aasen"), (8, "Michael", "Kern"), (9, "Michal", "Kern"),
        *[(100 + i, "Zoe", f"Family{chr(97 + i)}") for i in range(20)], (20, "Zoe", "Kazimal"), (21, "Zo", "Kazimal"), *[(200 + i, "Daniel", f"Other{chr(97 + i)}") for i in range(20)], *[(300 + i, "Daniela", f"Other{chr(97 + i)}") for i in range(20)],
    ]
    rows = [dict(zip(("creator_id", "first_name", "last_name"), p)) for p in people]
    folder = library(creators=rows)
    groups = {r.creator_id: r.group_id for r in registry.queries()["p6_groups"](spark, folder).collect()}
    assert groups[1] == groups[2] == groups[5] == 1 and groups[3] == groups[4] == 3 and groups[6] == groups[7] == 6
    assert groups[8] != groups[9] and groups[20] == groups[21] == 20
    assert all(groups[200 + i] != groups[300 + i] for i in range(20))
    links = registry.queries()["p6_links"](spark, folder).collect()
    assert {r.rule for r in links} == {"full", "short", "slip"} and all(r.score >= 8 / 9 for r in links)


def test_a_hot_group_gives_all_its_pairs(spark):
    members = spark.range(40).selectExpr("id", "if(id < 30, 0, id) as g")
    got = {tuple(r) for r in nearcopies.pairs_within(members, "id", "g", block=4).collect()}
    assert got == set(itertools.combinations(range(30), 2))


# --- 5: what meets in a shard


def test_sets_with_a_third_in_common_are_no_candidates(spark):
    """Texts made of the same phrases meet in shards ever more often as they grow in number, and must not be sent on in pairs."""
    rng = np.random.default_rng(11)
    phrases, own = (rng.integers(-(2**62), 2**62, size=n).tolist() for n in (30, 400 * 30))
    rows = [(i, sorted([*phrases, *own[30 * i : 30 * i + 30]])) for i in range(400)]
    rows += [(1000 + i, sorted([*rows[i][1][:-3], i, -i - 1])) for i in range(40)]
    classes = spark.createDataFrame(rows + rows[:100], "class_id long, words array<long>")
    got = {tuple(r) for r in nearcopies.candidate_pairs(classes).collect()}
    true = {(i, 1000 + i) for i in range(40)}
    assert true <= got and len(got - true) < 10 and all(a < b for a, b in got)


def test_no_similar_sets_are_lost_in_a_shard():
    """Of every size around the bound between the two sorts of fingerprints; rows of one class count once."""
    rng = np.random.default_rng(5)
    sets = []
    for n in [*range(3, 30), 60, *range(94, 104), *range(132, 150), 200, 600]:
        base = rng.integers(-(2**62), 2**62, size=n)
        for fewer, more in ((0, 0), (0.15, 0), (0.29, 0), (0, 0.42), (0.1, 0.15), (0.17, 0.17)):
            sets.append(np.sort(np.concatenate([base[int(n * fewer) :], rng.integers(-(2**62), 2**62, size=int(n * more))])))
    words = [set(w.tolist()) for w in sets]
    signed = pd.concat(list(nearcopies._sign(iter([pd.DataFrame({"class_id": range(len(sets)), "words": sets})]))))
    rows = signed.assign(key=(signed["lo"] & 255 == 0).astype("int64")).drop(columns="keys").sort_values(["key", "class_id"], ignore_index=True)
    rows = rows.loc[rows.index.repeat(2)]
    found = pd.concat(list(nearcopies._meet_runs(iter([rows]), most=len(sets))))
    found = set(zip(found["a"], found["b"]))
    similar = {(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if len(words[a] & words[b]) >= 0.7 * len(words[a] | words[b])}
    assert len(similar) > 400 and {p for p in similar if words[p[0]] != words[p[1]]} <= found
    assert all(a < b for a, b in found)


# --- 4: any number of misreadings, in words of any length


def test_words_with_many_misreadings(spark, library):
    clean = "The modern observation of the mill, the town and the water was modern. An observation of the old mill. " * 600
    scan = "The rnodcrn 0bs3rv4t10n of the town\nand the water was of the rnill and\nthe old town and the old mill too."
    rows = [item(1, fulltext=scan, fulltext_source="pdf"), item(2, fulltext=clean, fulltext_source="html")]
    text = {r.item_id: r.text for r in registry.queries()["p4_repaired"](spark, library(zotero_items=rows)).collect()}[1]
    assert text == "The modern observation of the town and the water was of the mill and the old town and the old mill too."


# --- 10: scripts without spaces


def test_sentences_without_marks():
    text = "これは本です次に行きますそれから帰りました"
    assert [text[a:b] for a, b in sentences.split_sentences(text)] == ["これは本です", "次に行きます", "それから帰りました"]
    kept = "「これは本です次に行きます」と言いますが、それは本ですから大丈夫です。"
    assert [kept[a:b] for a, b in sentences.split_sentences(kept)] == [kept]


# --- 2: the short way to the conflicts gives what the segments say


def test_conflicts_are_those_of_the_segments(spark, library):
    own = list(SAMPLE.items())
    documents = [{"doc_id": i, "text": t, "lang": c} for i, (c, t) in enumerate(own * 4)]
    rng = random.Random(6)
    short = ["这是很短的句子。", "川は浅い夏だった。", "Река мелкая. ", "นี่คือประโยคสั้น", "Nous partons. ", "Danke sehr dafür. ", "여름에 강은 얕다."]
    rows = []
    for k in range(90):
        code, text = rng.choice(own)
        extra = rng.choice(["", rng.choice(short), rng.choice(own)[1]])
        rows.append(item(k, abstract=text + " " + extra, fulltext=extra + "\n\n" + rng.choice(own)[1] if k % 3 else None, language=rng.choice([code, code, "en", "", "?", None])))
    folder = library(zotero_items=rows, documents=documents)
    labels = {r["item_id"]: langid.label_code(r["language"]) for r in rows}
    by: dict = {}
    for r in registry.queries()["p2_segments"](spark, folder).collect():
        by.setdefault((r.item_id, r.field_name), set()).add(r.lang)
    wanted = {(i, f, c) for (i, f), langs in by.items() if langs != {labels[i]} for c in langs}
    assert {tuple(r) for r in registry.queries()["p2_found"](spark, folder).collect()} == wanted


def test_training_pieces_lie_over_the_whole_text():
    text = " ".join(f"Sentence number {k}." for k in range(5000))
    kept = langid.spread_pieces(text, 50).split("\n\n")
    assert len(kept) <= 50 and kept[0] == "Sentence number 0." and int(kept[-1].split()[-1].strip(".")) > 4800
