"""Small cases with known answers for each problem."""

import itertools
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import charforms, langid, mixing, names, nearcopies, packing, pieces, registry, scanfix, scanlines, sentences, survivors, tokens

from .conftest import item

Q = registry.queries()


def got(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# --- 1: survivors


def test_survivors(spark, library):
    rows = [
        item(10, doi="10.9999/AB.1", title="Kilns of the north", abstract="A long abstract about kilns.", date_modified="2020-01-01 00:00:00"),
        item(11, doi="https://doi.org/10.9999%2Fab.1", title="Kilns of the nroth", abstract="<p>Short   text</p>", date_modified="2020-01-01T00:30:00+01:00"),
        item(12, doi="doi:10.9999/ab.1.", title="KILNS OF THE NORTH", abstract="n/a", date_modified="1577840400"),
        item(13, doi="n/a", title="Kilns of the north", abstract="x"),
        item(20, doi="10.9999/book.1", title="Dunes and their grass", item_type="bookSection", date_modified=None),
        item(21, doi="10.9999/book.1", title="Eels and their rivers", item_type="bookSection"),
        item(22, doi="10.9999/BOOK.1", title="Eels and thier rivers", item_type="bookSection", date_modified="0000-00-00 00:00:00"),
        item(30, doi="10.9999/gone", title="a", deleted=True), item(31, doi="10.9999/gone", title="a"),
    ]
    folder = library(zotero_items=rows)
    assert got(Q["p1_found"](spark, folder), "group_item_id", "survivor_item_id") == [(10, 12), (21, 21)]
    assert {r.group_item_id: r.abstract_item_id for r in Q["p1_found"](spark, folder).collect()} == {10: 10, 21: None}
    titles = {r.group_item_id: r.title for r in Q["p1_records"](spark, folder).collect()}
    assert titles[10].lower() == "kilns of the north"


def test_large_group_goes_through_a_tree(spark, library):
    rows = [item(i, doi="10.9999/hot", title=f"The same title here {i % 70 if i % 3 else ''}".strip()) for i in range(1, 211)]
    out = Q["p1_records"](spark, library(zotero_items=rows)).collect()
    assert len(out) == 1 and out[0].n_items == 210 and out[0].title == "The same title here"


def test_alignment_votes_out_a_slip():
    texts = ["the old mill by the river", "the old mil by the river", "old mill by the river", "the old mill by a river"]
    weight, profile = survivors.merge_all([(1.0, survivors.profile_of(t, 1.0)) for t in texts])
    assert survivors.vote(weight, profile) == texts[0].split()


# --- 2: languages

SAMPLE = {
    "en": "The results of the survey show that the river was low in summer. We thank the staff of the museum for their help.",
    "de": "Die Ergebnisse der Studie zeigen, dass der Fluss im Sommer niedrig war. Wir danken den Mitarbeitern des Museums für ihre Hilfe.",
    "nl": "De resultaten van het onderzoek laten zien dat de rivier in de zomer laag stond. Wij danken de medewerkers van het museum voor hun hulp.",
    "fr": "Les résultats de l’enquête montrent que la rivière était basse en été. Nous remercions le personnel du musée pour son aide.",
    "es": "Los resultados de la encuesta muestran que el río estaba bajo en verano. Damos las gracias al personal del museo por su ayuda.",
    "it": "I risultati della ricerca mostrano che il fiume era basso in estate. Ringraziamo il personale del museo per il suo aiuto.",
    "ru": "Результаты показывают, что река летом была мелкой. Мы благодарим сотрудников музея за помощь.",
    "zh": "结果表明，河流在夏天很浅。我们感谢博物馆的工作人员。", "ja": "その結果、川は夏に浅かったことが分かった。博物館の職員に感謝する。", "ko": "그 결과 강은 여름에 얕았다. 박물관 직원에게 감사한다.",
    "ar": "تبين النتائج أن النهر كان منخفضا في الصيف. نشكر موظفي المتحف على مساعدتهم.", "hi": "परिणाम बताते हैं कि नदी गर्मी में नीची थी। हम संग्रहालय के कर्मचारियों को धन्यवाद देते हैं।", "th": "ผลการศึกษาแสดงว่าแม่น้ำตื้นในฤดูร้อน เราขอบคุณเจ้าหน้าที่พิพิธภัณฑ์",
}


@pytest.fixture(scope="module")
def machines():
    return langid.fit([(t, c) for c, t in SAMPLE.items()] * 3 + [(SAMPLE["en"], "de")])


@pytest.mark.parametrize("code", sorted(SAMPLE))
def test_language_of_each(machines, code):
    assert {s[2] for s in langid.segments(SAMPLE[code], machines)} == {code}


def test_mixed_field(machines):
    text = SAMPLE["en"] + " " + SAMPLE["fr"] + "\n\n" + SAMPLE["ru"]
    assert [s[2] for s in langid.segments(text, machines)] == ["en", "fr", "ru"]


def test_labels():
    assert [langid.label_code(x) for x in ("en-US", "en_GB", " ENGLISH ", "français", "ger", "日本語", "und", "", None, "unknown")] == ["en", "en", "en", "fr", "de", "ja", None, None, None, None]


def test_label_conflicts(spark, library):
    documents = [{"doc_id": i, "text": t, "lang": c} for i, (c, t) in enumerate(list(SAMPLE.items()) * 4)]
    rows = [
        item(1, abstract=SAMPLE["en"], language="English"), item(2, abstract=SAMPLE["de"], language="en"), item(3, abstract=SAMPLE["en"], language=None),
        item(4, abstract=SAMPLE["en"] + " " + SAMPLE["es"], language="en"), item(5, abstract="No abstract.", language="de"), item(6, fulltext=SAMPLE["it"], language="it"),
    ]
    out = got(Q["p2_found"](spark, library(zotero_items=rows + rows[:2], documents=documents)), "item_id", "field_name", "lang")
    assert out == [(2, "abstract", "de"), (3, "abstract", "en"), (4, "abstract", "en"), (4, "abstract", "es")]


# --- 3: characters


def test_look_alikes(spark, library):
    rows = [
        item(1, title="Plain title", creators="Müller, Zoë"), item(2, title="Ｗｉｄｅ title", creators="Ιrina"), item(3, title="zero​width", creators="émigré"),
        item(4, title="α-type voles", creators="Η. Kern"), item(5, title="CO₂ and “quotes” – dashes", creators="Иванов, А."), item(6, title="论口述：记忆", creators="гоpода"),
        item(7, title="no break", creators="ﬁne"), item(8, title="Α-TYPE", creators="น้ำ"),
    ]
    folder = library(zotero_items=rows)
    assert got(Q["p3_found"](spark, folder), "item_id", "field_name") == [(2, "creators"), (2, "title"), (3, "creators"), (3, "title"), (4, "creators"), (6, "creators"), (7, "creators"), (7, "title")]
    out = {r.item_id: r for r in Q["p3_normal"](spark, folder).collect()}
    assert (out[2].title, out[2].creators, out[3].title, out[3].creators, out[4].creators) == ("Wide title", "Irina", "zerowidth", "émigré", "H. Kern")
    assert (out[6].creators, out[7].title, out[7].creators, out[1].creators, out[8].creators) == ("города", "no break", "fine", "Müller, Zoë", "น้ำ")


def test_normal_form_agrees_with_the_standard(spark):
    """For decomposed text alone the operator does what canonical composition does, marks in any order."""
    words = ["ộx", "Ångström", "한국", "ą́"]
    df = spark.createDataFrame([(w, "L", False) for w in words], "tok string, fscript string, symbol boolean")
    assert {r.tok: r.norm for r in charforms.word_forms(df).collect()} == {w: unicodedata.normalize("NFC", w) for w in words}


# --- 4: scans

PAGE = "We clo$e with a view of the whole survey and its many old re-\nsults from the north. JOURNAL\nPage 12\nof the river, the mill and the\nwhole survey were in the old town."


def test_lines_and_noise(spark, library):
    scan = "The whole survey of the river and its mills was sugges-\ntive of an older town by the\nJOURNAL OF RIVER STUDIES   - 12 -\nwater, and tlie mills were old.\nThe town was of wood and the\n[13]\nmills were of stone in tlie town."
    clean = "The suggestive survey of the river and the mills. The town and the water, the mills and the town. " * 40
    rows = [item(1, fulltext=scan, fulltext_source="pdf"), item(2, fulltext=clean, fulltext_source="html"), item(3, fulltext="A time-\nlapse of the town.", fulltext_source="pdf"), item(4, fulltext="Table 2\n1937\n294\n96\nThe town.", fulltext_source="pdf"), item(5, abstract="time-lapse and time-lapse of the town")]
    folder = library(zotero_items=rows)
    assert got(Q["p4_found"](spark, folder), "item_id", "noise") == [(1, n) for n in ("characters", "header", "hyphenation", "page_number")]
    text = {r.item_id: r.text for r in Q["p4_repaired"](spark, folder).collect()}
    assert text[1] == "The whole survey of the river and its mills was suggestive of an older town by the water, and the mills were old. The town was of wood and the mills were of stone in the town."
    assert text[3] == "A time-lapse of the town."


def test_misreadings_meet_the_truth(spark):
    pairs = [("tlie", "the"), ("ab0ut", "about"), ("frorn", "from"), ("di$cuss", "discuss"), ("svvifts", "swifts"), ("inclicatc", "indicate"), ("rnodcrn", "modern"), ("0bs3rv4t10n", "observation")]
    assert all(scanfix.misreading(*p) > 0 for p in pairs) and scanfix.misreading("mill", "hall") == 0
    assert scanfix.misreading("tlie", "the") == 0.03 and scanfix.misreading("rnodcrn", "modern") == pytest.approx(0.03 * 0.03 * 0.5)
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.filter(scanfix.atoms(F.col("a")) != scanfix.atoms(F.col("b"))).isEmpty()
    assert scanlines.classify_lines("Table 5\n1937\n294\nText here.")[1] == ["t", "t", "t", ""]


# --- 5: near copies


def _similar(a, b):
    return len(a & b) / len(a | b)


def test_near_copies_against_brute_force(spark, library):
    rng = random.Random(7)
    vocabulary = [f"w{''.join(rng.choices('abcdefgh', k=5))}" for _ in range(900)]
    texts = []
    for _ in range(60):
        base = rng.sample(vocabulary, 40)
        texts.append(base)
        for edits in (0, 2, 5, 9):
            texts.append([rng.choice(vocabulary) if i < edits else w for i, w in enumerate(base)])
    rows = [item(i, title=" ".join(t[:5]), abstract=" ".join(t[5:])) for i, t in enumerate(texts, 1)]
    sets = {i: set(t) for i, t in enumerate(texts, 1)}
    expected = sorted((a, b) for a, b in itertools.combinations(sets, 2) if _similar(sets[a], sets[b]) >= 0.7)
    folder = library(zotero_items=rows + rows[:3])
    assert got(Q["p5_found"](spark, folder), "item_id_a", "item_id_b") == expected
    groups = {r.item_id: r.group_id for r in Q["p5_groups"](spark, folder).collect()}
    assert all(groups[a] == groups[b] for a, b in expected)


def test_hot_shards_meet_in_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**62), 2**62, size=60)
    rows = [(i, sorted([*map(int, base[1:]), i])) for i in range(1, 41)]
    classes = spark.createDataFrame(rows, "class_id long, words array<long>")
    assert nearcopies.similar_classes(classes, most=10, block=4).count() == 40 * 39 // 2


def test_runs_over_batches():
    """Runs that lie across batches, at every length around the bound, whole or passed through whole."""
    import pandas as pd

    for length in (1, 2, 9, 10, 11, 25):
        keys = [1] * 3 + [2] * length + [3] * 2
        rows = pd.DataFrame({"class_id": range(len(keys)), "key": keys, "hi": 7, "lo": 9})
        for size in (1, 3, 4, 100):
            out = pd.concat(list(nearcopies._meet_runs((rows[i : i + size] for i in range(0, len(rows), size)), most=10)))
            found = {(a, b) for a, b in zip(out["a"], out["b"]) if not pd.isna(b)}
            passed = sorted(out["a"][out["b"].isna()])
            run = list(range(3, 3 + length))
            expected = {(0, 1), (0, 2), (1, 2), (3 + length, 4 + length)}
            assert found == (expected if length > 10 else expected | set(itertools.combinations(run, 2)))
            assert passed == (run if length > 10 else [])


def test_bk_tree_against_scan():
    rng = random.Random(1)
    prints = [rng.getrandbits(128) for _ in range(60)]
    prints += [p ^ (1 << rng.randrange(128)) ^ (1 << rng.randrange(128)) for p in prints]
    tree = nearcopies.BKTree()
    for k, p in enumerate(prints):
        tree.add(p, k)
    for p in prints[:30]:
        assert sorted(tree.within(p, 36)) == [k for k, q in enumerate(prints) if (p ^ q).bit_count() <= 36]


# --- 6: names


def test_name_variants(spark, library):
    people = [
        (1, "Jürgen", "Kazimal", None), (2, "jurgen", "KAZIMAL", None), (3, None, None, "Dr. Jürgen Kazimal"), (4, "J.", "Kazimal", None), (5, "Kazimal", "Jürgen", None), (6, None, None, "Kazimal J"),
        (7, "Patricia", "Kazimal", None), (8, "Trish", "Kazimal, PhD", None), (9, "Karl-Heinz T.", "Bonovar", None), (10, "K.-H. T.", "Bonovar", None), (11, None, None, "Bonovar KT."),
        (12, None, None, "The Kivul Institute for Old Mills Research"), (13, None, None, "Kivul Inst. of Old Mills Res."), (14, None, None, "Institute for Old Mills Research, Kivul"), (15, None, None, "Kivul IOMR"),
        (16, "Anna", "Zabarin", None), (17, "Amélie", "Zabarin", None), (18, "A.", "Zabarin", None),
        *[(100 + i, "Jürgen", f"Family{c}", None) for i, c in enumerate("abcdefghijklmnop")], (150, "Jügren", "Kazimal", None),
    ]
    rows = [dict(zip(("creator_id", "first_name", "last_name", "full_name"), p)) for p in people]
    groups = {r.creator_id: r.group_id for r in Q["p6_groups"](spark, library(creators=rows)).collect()}
    by: dict = {}
    for c, g in groups.items():
        if c < 100 or c == 150:
            by.setdefault(g, set()).add(c)
    assert sorted(map(sorted, by.values())) == [[1, 2, 3, 4, 5, 6, 150], [7, 8], [9, 10, 11], [12, 13, 14, 15], [16], [17], [18]]
    assert names.organisation_form("Kivul Soc. for Mills") == ("kivul society mills", "kivul", "sm")


# --- 7: pieces


@pytest.mark.parametrize("seed", range(6))
def test_pieces(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["word ", "longerword", ". ", ", ", "\n", "\n\n", "字。", "x" * 30]) for _ in range(rng.choice([3, 50, 900])))
    limit, overlap = rng.choice([(50, 10), (120, 0), (200, 30)])
    cuts = pieces.cut_points(text, limit, overlap)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    assert all(b - a <= limit for a, b in cuts) and all(c == b - overlap for (_, b), (c, _) in zip(cuts, cuts[1:]))
    strength = pieces.strengths(text)
    for a, b in cuts[:-1]:
        low = a + min(limit, max(limit // 2, overlap + 1))
        window = strength[low : a + limit + 1]
        best = max(k for k in range(len(window)) if window[k] == window.max())
        assert b == (low + best if window.max() else a + limit)
    assert text == text[: cuts[0][1]] + "".join(text[a + overlap : b] for a, b in cuts[1:])


def test_pieces_found(spark, library):
    rows = [item(1, fulltext="a" * 100), item(2, fulltext="b" * 101), item(3, fulltext="c" * 500, deleted=True), item(4, fulltext="é" * 250)]
    assert got(Q["p7_found"](spark, library(zotero_items=rows)), "item_id") == [(2,), (4,)]


# --- 8: containers


def test_packing_keeps_to_the_capacity():
    rng = random.Random(2)
    for _ in range(5):
        sizes = [min(1000, int(rng.lognormvariate(4.5, 1))) for _ in range(400)]
        parts = packing.pack(sizes, 1000)
        assert sorted(i for p in parts for i in p) == list(range(400))
        assert max(sum(sizes[i] for i in p) for p in parts) <= 1000
        assert sum(sizes) / (1000 * len(parts)) > 0.95
    assert packing.pack([], 10) == [] and sorted(packing.pack([10, 10, 10], 10)) == [[0], [1], [2]]


def test_containers(spark, library):
    documents = [{"doc_id": i, "text": "one two three four five"} for i in range(40)] + [{"doc_id": 99, "text": "word " * 130}, {"doc_id": 100, "text": None}]
    folder = library(documents=documents)
    rows = Q["p8_packed"](spark, folder).collect()
    used: dict = {}
    for r in rows:
        used[r.container] = used.get(r.container, 0) + r.n_tokens
    assert max(used.values()) <= 50 and {r.doc_id for r in rows} == {*range(40), 99, 100}
    assert got(Q["p8_found"](spark, folder), "doc_id") == [(99,)]
    own = sorted((r.token_start, r.n_tokens) for r in rows if r.doc_id == 99)
    assert own[0] == (0, 50) and sum(n for _, n in own) == tokens.count_tokens("word " * 130)


# --- 9: mixing


def test_mix_reaches_its_shares(spark, library):
    rng = random.Random(4)
    documents = [{"doc_id": i, "text": "word " * rng.randint(5, 60), "source": rng.choice(["big", "Big ", "big", "small", None])} for i in range(900)]
    targets = [{"source_name": "big", "target_share": 0.4, "max_repeats": 1}, {"source_name": "small", "target_share": 0.5, "max_repeats": 3}, {"source_name": "none", "target_share": 0.1, "max_repeats": 2}]
    folder = library(documents=documents, mix_targets=targets)
    shares = {r.source_name: r for r in Q["p9_shares"](spark, folder).collect()}
    assert abs(shares["big"].actual_share - 0.4 / 0.9) < 0.01 and abs(shares["small"].actual_share - 0.5 / 0.9) < 0.01
    assert shares["none"].actual_share == 0 and shares["small"].most_copies <= 3 and shares["big"].most_copies == 1
    mixed = Q["p9_mix"](spark, folder).collect()
    assert sum(r.n_tokens * r.copies for r in mixed if r.source_name == "big") == shares["big"].mixed_tokens


def test_budgets_are_nested(spark):
    sized = spark.range(2000).selectExpr("id as doc_id", "'a' as source_name", "1 + id % 50 as n_tokens", "shiftrightunsigned(xxhash64(id), 4) as h")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source_name string, target_share double, max_repeats int")
    taken = [{r.doc_id for r in mixing.mix(sized, mixing.plan(sized, targets, t)).collect()} for t in (1000, 20000, 40000)]
    assert taken[0] < taken[1] < taken[2]


# --- 10: sentences

CASES = [
    ("Dr. Smith saw e.g. vol. 3 at 3 p.m. in St. Mary. He left, etc. Then it rained.", ["Dr. Smith saw e.g. vol. 3 at 3 p.m. in St. Mary.", "He left, etc.", "Then it rained."]),
    ('Prof. Ab called it "a dead end. Nothing more." and left. "Is it so?" asks Bo. (See App. B, Sect. 1.2.) Next.', ['Prof. Ab called it "a dead end. Nothing more." and left.', '"Is it so?" asks Bo.', "(See App. B, Sect. 1.2.)", "Next."]),
    ("Am 3. Mai 1857 kam sie z. B. um 40,2 % im 18. Jahrhundert. Man fand Salz usw. Das war alles.", ["Am 3. Mai 1857 kam sie z. B. um 40,2 % im 18. Jahrhundert.", "Man fand Salz usw.", "Das war alles."]),
    ("« Rien ne change. Rien du tout. », notait le Dr Bo. On compte p. ex. 12 fiches.", ["« Rien ne change. Rien du tout. », notait le Dr Bo.", "On compte p. ex. 12 fiches."]),
    ("А. Б. Иванов описал 375 листов и т. д. По данным 1898 г. значение упало. «Неужели это налог?» — спрашивает автор.", ["А. Б. Иванов описал 375 листов и т. д.", "По данным 1898 г. значение упало.", "«Неужели это налог?» — спрашивает автор."]),
    ("信中写道：“一切如旧。什么也没有发生。”“这还是吗？”作者问道。下降了5.1%。", ["信中写道：“一切如旧。什么也没有发生。”", "“这还是吗？”作者问道。", "下降了5.1%。"]),
    ("手紙には「何も変わらない。静かだ。」とある。驚くべき資料である！", ["手紙には「何も変わらない。静かだ。」とある。", "驚くべき資料である！"]),
    ("“정말인가?”라고 묻는다. 값은 7.5% 줄었다.", ["“정말인가?”라고 묻는다.", "값은 7.5% 줄었다."]),
    ("เรารวบรวมข้อมูล 265 รายการใกล้เขาหมอกน้อย สุดท้ายเราเสนอคำถามใหม่", ["เรารวบรวมข้อมูล 265 รายการใกล้เขาหมอกน้อย", "สุดท้ายเราเสนอคำถามใหม่"]),
    ("“कुछ नहीं बदला। सब वैसा है।” ऐसा लिखा है। डॉ. राम आए।", ["“कुछ नहीं बदला। सब वैसा है।” ऐसा लिखा है।", "डॉ. राम आए।"]),
    ("«هل هذا حقا؟» يسأل المؤلف. يقول د. فلان ذلك.", ["«هل هذا حقا؟» يسأل المؤلف.", "يقول د. فلان ذلك."]),
    ("A line without end\nAnother line. pH fell to 4.1 at once.Then it rose", ["A line without end", "Another line.", "pH fell to 4.1 at once.", "Then it rose"]),
]


@pytest.mark.parametrize("text, expected", CASES)
def test_sentences(text, expected):
    assert [text[a:b] for a, b in sentences.split_sentences(text)] == expected


def test_sentence_edges():
    assert sentences.split_sentences(None) == sentences.split_sentences("  \n ") == sentences.split_sentences("...") == []
    assert len(sentences.split_sentences("One two three. " * 20000)) == 20000
