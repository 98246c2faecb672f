"""Problem 6: variant spellings of the names of people and organisations.

Every distinct name is rewritten to its canonical forms: letters folded, umlauts as one letter and as two, titles and suffixes
dropped, both orders of the parts, nicknames as the names they stand for, initials, abbreviated words of organisations spelt
out, legal forms dropped, acronyms, and one letter left out (typing slips). Forms are exploded and joined on equality, and what a
form is worth is its rarity:

* A form with all parts in full links by itself (score 1).
* An initial, a nickname or an acronym scores the share that the commonest full name with this form has among all that have
  it, full names weighted by how many families carry the first name; it links from ``SHARE`` on, that is where the form
  leaves one name, misspellings of it aside.
* Two first names (or family names) that agree but for one letter score the bits by which they meet under the same family
  name (first name) more often than names as common as they are would by chance; they link from ``BITS`` on, first names
  where one is also at least ``RARER`` times as common. So Daniel and Daniela stay apart however large the table is, and a
  slip links however short the name is.

All of this runs on distinct names, and each form is settled by one aggregation that combines before the shuffle: no
short form meets all names of its family, and a name held by very many rows costs as much as any other. Texts that share a
form with one letter left out are as many as there are letters to put in, whatever the size of the table, so lists of them are
bounded. Links are closed to groups by repeated minima with checkpoints.

Defined results: a row without any name is a group of its own. Rows with equal names are linked. Ambiguous initials stay
alone. Repeated creator_ids count once (smallest values). Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.nearcopies import components, pairs_within
from foliant.session import cut_lineage, table

#: The share from which a short form means its commonest full name.
SHARE = 8 / 9
#: The bits of evidence from which a differing letter is a slip.
BITS = 1.0
#: How much commoner than its slip a first name is.
RARER = 8
#: The chance of two rows to share a family name (first name) is taken from the table, but not above this: few rows say little.
MOST_CHANCE = 0.01

# Nicknames and the names they stand for.
NICKNAMES = {
    "al": "albert alan alexander", "alex": "alexander alexandra", "andy": "andrew", "ann": "anna", "annie": "anna anne", "art": "arthur", "barb": "barbara",
    "ben": "benjamin", "benny": "benjamin", "bert": "albert robert", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert",
    "bobby": "robert", "cathy": "catherine", "charlie": "charles", "chris": "christopher christine", "chuck": "charles", "cindy": "cynthia", "dan": "daniel",
    "danny": "daniel", "dave": "david", "deb": "deborah", "debbie": "deborah", "dick": "richard", "dirk": "dietrich", "don": "donald", "dot": "dorothy", "dottie": "dorothy",
    "ed": "edward edmund", "eddie": "edward", "eliza": "elizabeth", "fred": "frederick alfred", "freddy": "frederick", "fritz": "friedrich", "gabe": "gabriel", "gaby": "gabriele",
    "gerry": "gerald", "greg": "gregory", "hal": "harold", "hank": "henry", "hans": "johannes", "harry": "harold henry", "jack": "john", "jake": "jacob",
    "jan": "johannes", "jeff": "jeffrey", "jen": "jennifer", "jenny": "jennifer", "jerry": "gerald jerome", "jim": "james", "jimmy": "james", "joe": "joseph",
    "joey": "joseph", "johnny": "john", "jon": "jonathan", "kate": "katherine catherine", "kathy": "katherine", "katie": "katherine", "ken": "kenneth", "kim": "kimberly", "kit": "christopher",
    "larry": "lawrence", "len": "leonard", "lenny": "leonard", "leo": "leonard", "liz": "elizabeth", "lizzie": "elizabeth", "maggie": "margaret", "mandy": "amanda", "marge": "margaret", "matt": "matthew",
    "max": "maximilian", "meg": "margaret", "mel": "melanie", "mike": "michael", "mick": "michael", "mickey": "michael", "molly": "mary", "nancy": "anne", "nat": "nathaniel",
    "nate": "nathan nathaniel", "ned": "edward", "nell": "helen eleanor", "nick": "nicholas", "nicky": "nicholas", "nico": "nicholas", "pam": "pamela", "pat": "patricia patrick", "patty": "patricia",
    "peggy": "margaret", "pepe": "jose", "pete": "peter", "phil": "philip", "ray": "raymond", "rich": "richard", "rick": "richard", "rob": "robert", "robbie": "robert", "ron": "ronald", "sam": "samuel samantha",
    "sandy": "alexander sandra", "sasha": "alexander", "sepp": "josef", "steve": "stephen steven", "sue": "susan", "susie": "susan", "ted": "theodore edward", "teddy": "theodore", "theo": "theodore theodora", "thea": "theodora dorothea",
    "tilly": "matilda", "tim": "timothy", "toby": "tobias", "tom": "thomas", "tommy": "thomas", "tony": "anthony", "trish": "patricia", "vic": "victor", "vicky": "victoria", "wally": "walter", "walt": "walter",
    "will": "william", "willy": "william", "xavi": "xavier",
}
TITLES = frozenset("dr prof mr mrs ms sir dame herr frau mme m professor doctor dott ing dipl".split())
SUFFIXES = frozenset("phd jr sr md msc bsc ma mba esq ii iii iv dphil dsc junior senior".split())
PARTICLES = frozenset("von van de der den di da del della la le ten ter zu zur dos du of el al bin ibn".split())
# Words of organisations in full; abbreviations and legal forms.
WORDS_IN_FULL = {
    "inst": "institute", "institut": "institute", "instituto": "institute", "soc": "society", "assoc": "association", "assn": "association", "ass": "association", "dep": "department", "dept": "department",
    "lab": "laboratory", "labs": "laboratory", "cent": "centre", "ctr": "centre", "center": "centre", "acad": "academy", "comm": "commission", "com": "commission", "cons": "consortium", "res": "research", "hist": "history",
    "stud": "studies", "univ": "university", "fdn": "foundation", "found": "foundation", "coll": "college", "natl": "national", "nat": "national", "intl": "international", "int": "international", "tech": "technology", "sci": "science",
    "grp": "group", "mus": "museum", "lib": "library", "bur": "bureau", "off": "office", "min": "ministry", "corp": "", "inc": "", "ltd": "", "gmbh": "", "ag": "", "llc": "", "co": "", "plc": "", "ev": "", "sa": "", "bv": "",
}
ORGANISATION = frozenset(
    "institute society association department laboratory centre academy commission consortium university foundation college group museum library bureau office ministry "
    "council committee agency union federation company school faculty network project team trust authority observatory archive".split()
)
LINKING = frozenset("the of for and on in & at".split())
SPECIAL = str.maketrans({"ø": "o", "ß": "ss", "ı": "i", "ł": "l", "æ": "ae", "œ": "oe", "đ": "d", "ð": "d", "þ": "th", "’": "'", "‐": "-", "–": "-"})


#: Letters that are also spelt with two (fixed values).
TWO_LETTERS = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ø": "oe", "å": "aa"})


def fold(text: str, two: bool = False) -> str:
    """Lower case without marks; umlauts as one letter or as two."""
    if two:
        text = unicodedata.normalize("NFC", text).lower().translate(TWO_LETTERS)
    x = unicodedata.normalize("NFKD", text).lower().translate(SPECIAL)
    return "".join(c for c in x if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")


def _initials(token: str) -> list[str] | None:
    """The letters of a token of initials such as K.-H., YJ or H; None for a word."""
    core = token.replace(".", "").replace("-", "").replace(" ", "")
    if not core.isalpha():
        return None
    if len(core) == 1 or ("." in token and len(core) <= 4 and re.fullmatch(r"(\w\.?-?){1,4}", token) and all(len(p) <= 1 for p in re.split(r"[.-]", token))):
        return list(core)
    if core.isupper() and len(core) <= 3:
        return list(core)
    return None


def organisation_form(text: str) -> tuple[str, str, str] | None:
    """(canonical words, first word, acronym of the rest) of an organisation's name; None for other names."""
    x = re.sub(r"\([^)]*\)", " ", text)
    if x.count(",") == 1:
        a, b = x.split(",")
        if len(b.split()) <= 3 and len(a.split()) >= 3:
            x = f"{b} {a}"
    words = [w for w in re.findall(r"[^\W_]+(?:['-][^\W_]+)*|&", fold(x))]
    full = [WORDS_IN_FULL.get(w, w) for w in words]
    full = [w for w in full if w and w not in LINKING]
    if len(full) < 3 or not (set(full) & ORGANISATION):
        return None
    return " ".join(full), full[0], "".join(w[0] for w in full[1:])


def person_forms(first: str | None, last: str | None, full: str | None) -> list[tuple[str, str, str, str]]:
    """(kind, family, first, middle): kind ``full`` with a first name, ``turned`` with the parts in the other order than they
    are in, ``init`` with initials, ``nick`` with a nickname. Family names with umlauts come in both spellings; ``spelt`` is a full
    form with the first name's umlauts as two letters."""
    out: set[tuple[str, str, str, str]] = set()

    def words_of(text: str) -> list[str]:
        text = re.sub(r"\s(?:PhD|Ph\.\s?D|Jr|Sr)\b\.?|(?i:[,;]\s*(?:Ph\.?\s?D|Jr|Sr|M\.?D|M\.?A|M\.?Sc|II|III|IV|Esq)\b\.?)", " ", text)
        kept = [w for w in re.split(r"[\s,]+", text.strip()) if w]
        while kept and fold(kept[0]).strip(".") in TITLES and len(kept) > 1 and (len(kept[0].strip(".")) > 1):
            kept = kept[1:]
        while len(kept) > 2 and fold(kept[-1]).replace(".", "") in SUFFIXES:
            kept = kept[:-1]
        return kept

    def put(givens: list[str], family: list[str], whole: str = "full") -> None:
        fams = {fold(" ".join(family), two).replace(".", "").strip() for two in (False, True)} - {""}
        if not fams:
            return

        def add(kind: str, given: str, mid: str) -> None:
            out.update((kind, fam, given, mid) for fam in fams)

        shouting = all(w.isupper() for w in givens + family)
        head, spelt, middle = "", "", ""
        letters: list[str] = []
        if fold(givens[0]).strip(".") in PARTICLES and len(givens) > 1:  # the parts stand in the other order
            add(whole, fold(" ".join(givens)), "")
            add("spelt", fold(" ".join(givens), True), "")
            return
        for w in givens:
            ini = _initials(w)
            if ini and (not shouting or len(ini) == 1 or "." in w):
                if "-" in w and not head:
                    letters += [c for c in ini[:1]]
                else:
                    letters += ini
            elif not head and not letters:
                head, spelt = fold(w).strip(".'"), fold(w, True).strip(".'")
            else:
                middle += fold(w)[:1]
        if head:
            middle += fold("".join(letters))
            for name in NICKNAMES.get(head, "").split():
                add("nick", fold(name), middle)
            add(whole, head, middle)
            if spelt != head:
                add("spelt", spelt, middle)
        elif letters:
            low = fold("".join(letters))
            add("init", low[0], low[1:])

    if full and not (first or last):
        if full.count(",") == 1 and fold(full.split(",")[1]).strip(" .") not in SUFFIXES:
            a, b = full.split(",")
            put(words_of(b), words_of(a))
            return sorted(out)
        w = words_of(full)
        if len(w) == 1:
            out.update(("full", fold(w[0], two), "", "") for two in (False, True))
        elif w:
            tail = _initials(w[-1])
            if tail and (len(w) == 2 or w[-1].endswith(".") or w[-1].isupper()) and not all(x.isupper() for x in w):
                put([w[-1]], w[:-1])
            else:
                k = 1
                while k < len(w) - 1 and (_initials(w[k]) or (fold(w[k]) not in PARTICLES and len(w) - k > 2)):
                    k += 1
                put(w[:k], w[k:])
                if len(w) == 2 and not _initials(w[0]):
                    put(w[1:], w[:1], "turned")
        return sorted(out)
    f, fam = words_of(first or ""), words_of(last or "")
    if f and fam:
        put(f, fam)
        if len(f) == 1 and not _initials(f[0]):
            put(fam, f, "turned")
        if len(fam) == 1 and _initials(fam[0]) and f:
            put(fam, f)
        if len(fam) >= 2 and all(_initials(x) for x in fam[1:]) and len(f) == 1:
            put(fam, f)
    elif fam or f:
        out.update(("full", fold(" ".join(fam or f), two), "", "") for two in (False, True))
    return sorted(out)


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for name_id, first, last, full in zip(pdf["name_id"], pdf["first_name"], pdf["last_name"], pdf["full_name"]):
            text = full if full and not (first or last) else " ".join(x for x in (first, last) if x)
            org = organisation_form(text)
            if org:
                rows.append((name_id, "org", org[1], org[0], org[2]))
                continue
            for kind, family, given, middle in person_forms(first or None, last or None, full or None):
                rows.append((name_id, kind, family, given, middle))
            words = text.split()
            if len(words) == 2 and words[1].strip(".").isupper() and words[1].strip(".").isalpha() and 3 <= len(words[1].strip(".")) <= 8:
                rows.append((name_id, "acro", fold(words[0]), "", fold(words[1].strip("."))))
        if rows:
            yield pd.DataFrame(rows, columns=["name_id", "kind", "family", "given", "middle"])


def _one_left_out(column: str):
    """The text and the text with each of its letters left out."""
    c = F.col(column)
    cut = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))
    return F.when(F.length(c) > 1, F.array_distinct(F.concat(F.array(c), cut))).otherwise(F.array(c))


def _slipped(nodes: DataFrame) -> DataFrame:
    """(side, partner, part, other, score): parts that agree but for a letter with a commoner one of the same partner.

    ``nodes`` are distinct (side, part, partner): first names with the family name as partner, and the other way round. The
    score is log2(met / expected): under how many partners both stand, and under how many of its partners a value would meet
    one as common as the other by chance.
    """
    total = max(2, nodes.count()) / 2
    rarer = F.when(F.col("side") == "given", RARER).otherwise(1)
    chance = nodes.groupBy("side", "partner").agg(F.least(F.lit(MOST_CHANCE), F.count("*") / total).alias("chance"))
    common = nodes.join(chance, ["side", "partner"]).groupBy("side", "part").agg(F.count("*").alias("n"), F.sum("chance").alias("spread"))
    entries = nodes.join(common, ["side", "part"]).select("side", "partner", F.struct("n", "part", "spread").alias("v"), F.explode(_one_left_out("part")).alias("form"))
    met = entries.groupBy(F.xxhash64("side", "partner", "form").alias("key"), "side", "partner").agg(F.collect_set("v").alias("vs"), F.min(F.length("form")).alias("kept")).filter(F.size("vs") > 1)
    best = met.withColumn("top", F.array_max("vs")).select("side", "partner", "top", "kept", F.explode("vs").alias("v")).filter((F.col("v.part") != F.col("top.part")) & (F.col("v.n") * rarer <= F.col("top.n")))
    changed = F.length("v.part") + F.length("top.part") - 2 * F.col("kept")  # 1: a letter too many or missing, 2: another letter
    pairs = best.groupBy("side", "partner", F.col("v.part").alias("part"), F.col("top.part").alias("other")).agg(F.min(changed).alias("changed"), F.first(F.col("top.n") * F.col("v.spread")).alias("expected"), F.first("top.n").alias("n_other"))
    pairs = cut_lineage(pairs)
    scored = pairs.groupBy("side", "part", "other").agg(F.log2(F.count("*") / F.first("expected")).alias("score")).filter(F.col("score") >= BITS)
    # among first names about as common, a letter too many or missing comes before another letter
    able = cut_lineage(pairs.join(scored, ["side", "part", "other"]))
    own = ["side", "partner", "part"]
    firsts = able.filter("side = 'given'")
    firsts = firsts.join(firsts.groupBy(*own).agg(F.max("n_other").alias("most")), own).filter(F.col("n_other") * RARER > F.col("most"))
    firsts = firsts.join(firsts.groupBy(*own).agg(F.min("changed").alias("changed")), [*own, "changed"]).select(*own, "other", "score")
    return firsts.unionByName(able.filter("side = 'family'").select(*own, "other", "score"))


def name_links(creators: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows (creator_id, name_id), links (a, b, rule, score) between name_ids)."""
    cols = ["first_name", "last_name", "full_name"]
    one = creators.filter(F.col("creator_id").isNotNull()).groupBy("creator_id").agg(F.min(F.struct(*[F.coalesce(c, F.lit("")).alias(c) for c in cols])).alias("n"))
    named = one.select("creator_id", *[F.col(f"n.{c}").alias(c) for c in cols])
    blank = F.concat_ws("", *[F.trim(c) for c in cols]) == ""
    names = cut_lineage(named.groupBy(*cols).agg(F.min("creator_id").alias("name_id")))
    rows = named.join(names, cols).select("creator_id", F.when(blank, F.col("creator_id")).otherwise(F.col("name_id")).alias("name_id"))
    forms = cut_lineage(names.filter(~blank).mapInPandas(_forms, "name_id long, kind string, family string, given string, middle string"))
    links = []

    def link(df: DataFrame, rule: str, score=None) -> None:
        links.append(df.select("a", "b", F.lit(rule).alias("rule"), (F.lit(1.0) if score is None else F.col(score)).alias("score")))

    # forms with all parts: one node for a family and a first name; with middle initials that differ, one for each of them
    full = forms.filter("kind in ('full', 'turned', 'spelt')")
    middles = full.groupBy("family", "given").agg(F.min("name_id").alias("node"), F.min(F.nullif("middle", F.lit(""))).alias("least"), F.max(F.nullif("middle", F.lit(""))).alias("most"), F.bool_or(F.col("kind") != "spelt").alias("own"))
    parted = F.coalesce(F.col("least") < F.col("most"), F.lit(False))
    placed = full.join(middles, ["family", "given"])
    link(placed.filter(~parted).select(F.col("name_id").alias("a"), F.col("node").alias("b")), "full")
    by_middle = placed.filter(parted).groupBy("family", "given", "middle").agg(F.min("name_id").alias("node"), F.bool_or("own").alias("own"))
    link(full.join(by_middle, ["family", "given", "middle"]).select(F.col("name_id").alias("a"), F.col("node").alias("b")), "full")
    whole = middles.filter(~parted).select("family", "given", "node", F.coalesce("least", F.lit("")).alias("middle"), "own")
    heads = whole.unionByName(by_middle.select("family", "given", "node", "middle", "own")).filter("own and given <> ''")
    # how many family names carry a first name: its standing as a first name
    standing = heads.groupBy("given").agg(F.countDistinct("family").alias("standing"))
    heads = cut_lineage(heads.join(standing, "given"))

    # initials and nicknames: every full name puts out the short forms it has; a short name asks for those it is
    asked = forms.filter("kind in ('init', 'nick')")
    key = lambda kind, middle: F.xxhash64(F.lit(kind), "family", "short", middle)
    any_middle, no_middle = F.lit("*"), F.lit("-")
    asks = asked.withColumn("short", F.col("given")).select(
        "name_id", "kind", "family", "given", "middle",
        F.explode(
            F.when(F.col("middle") == "", F.array(F.when(F.col("kind") == "init", key("init", any_middle)).otherwise(key("nick", any_middle))))
            .when(F.col("kind") == "init", F.array(key("init", F.col("middle"))))
            .otherwise(F.array(key("nick", F.col("middle")), key("nick", no_middle)))
        ).alias("form"),
    )
    asks = cut_lineage(asks)
    second = F.nullif(F.regexp_extract("given", "-(.)", 1), F.lit(""))
    initials = heads.withColumn("short", F.substring("given", 1, 1)).select("node", "standing", F.explode(F.array_distinct(F.array_compact(F.array(
        key("init", any_middle), F.when(F.col("middle") != "", key("init", F.col("middle"))), F.when(second.isNotNull(), key("init", second)),
    )))).alias("form"))
    nicknames = heads.withColumn("short", F.col("given")).select("node", "standing", F.explode(F.array(key("nick", any_middle), F.when(F.col("middle") == "", key("nick", no_middle)).otherwise(key("nick", F.col("middle"))))).alias("form"))
    meant = initials.unionByName(nicknames).groupBy("form").agg(F.max(F.struct("standing", -F.col("node"))).alias("top"), F.sum("standing").alias("among"))
    answers = asks.join(meant, "form").groupBy("name_id", "family", "given").agg(F.max("top").alias("top"), F.sum("among").alias("among"))
    answers = answers.groupBy("name_id").agg(F.max(F.struct((F.col("top.standing") / F.col("among")).alias("score"), F.col("top.col2").alias("b"))).alias("r"))
    answers = cut_lineage(answers.select(F.col("name_id").alias("a"), (-F.col("r.b")).alias("b"), F.col("r.score").alias("score")))
    link(answers.filter(F.col("score") >= SHARE), "short", "score")
    unmet = asked.filter("kind = 'init'").join(answers.select(F.col("a").alias("name_id")), "name_id", "left_anti")
    same_short = unmet.groupBy("family", "given", "middle").agg(F.min("name_id").alias("b"))
    link(unmet.join(same_short, ["family", "given", "middle"]).select(F.col("name_id").alias("a"), "b"), "short")

    # typing slips in the first name, and in the family name, of nodes whose first name stands as one at least as often as not
    roles = forms.filter("kind = 'full'").select(F.explode(F.array(F.struct(F.col("given").alias("given"), F.lit(1).alias("w")), F.struct(F.col("family").alias("given"), F.lit(-1).alias("w")))).alias("r"))
    firsts = roles.groupBy("r.given").agg(F.sum("r.w").alias("lean")).filter("lean >= 0").select("given")
    sides = lambda: F.explode(F.array(F.struct(F.lit("given").alias("side"), F.col("given").alias("part"), F.col("family").alias("partner")), F.struct(F.lit("family").alias("side"), F.col("family").alias("part"), F.col("given").alias("partner")))).alias("s")
    people = cut_lineage(heads.select("family", "given").distinct().join(firsts, "given").select(sides()).select("s.*"))
    ends = heads.select("middle", "node", sides()).select("middle", "node", "s.*")
    others = ends.select("side", "partner", F.col("part").alias("other"), F.col("middle").alias("middle_b"), F.col("node").alias("node_b"))
    fits = (F.col("middle") == F.col("middle_b")) | (F.col("middle") == "") | (F.col("middle_b") == "")
    slips = _slipped(people).join(ends, ["side", "partner", "part"]).join(others, ["side", "partner", "other"]).filter(fits)
    link(cut_lineage(slips.select(F.col("node").alias("a"), F.col("node_b").alias("b"), "score")), "slip", "score")

    # organisations: the words in full; a slip; an acronym after the first word
    orgs = forms.filter("kind = 'org'").select("name_id", F.col("family").alias("head"), F.col("given").alias("words"), F.col("middle").alias("acro"))
    org_nodes = cut_lineage(orgs.groupBy("words", "head", "acro").agg(F.min("name_id").alias("node")))
    link(orgs.join(org_nodes, ["words", "head", "acro"]).select(F.col("name_id").alias("a"), F.col("node").alias("b")), "full")
    slip_org = org_nodes.select("node", F.explode(_one_left_out("words")).alias("form")).groupBy(F.xxhash64("form").alias("form")).agg(F.collect_set("node").alias("nodes")).filter(F.size("nodes") > 1)
    org_slips = cut_lineage(slip_org.select(F.array_min("nodes").alias("b"), F.explode("nodes").alias("a")).filter("a <> b").distinct())
    link(org_slips, "slip")
    # an acronym's full names are counted once where they are slips of one another
    least = org_slips.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    rooted = org_nodes.join(least, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_acro = rooted.groupBy("head", "acro").agg((1 / F.countDistinct("root")).alias("score"), F.min("root").alias("b"))
    acro = forms.filter("kind = 'acro'").select(F.col("name_id").alias("a"), F.col("family").alias("head"), F.col("middle").alias("acro"))
    link(acro.join(by_acro.filter(F.col("score") >= SHARE), ["head", "acro"]), "short", "score")
    lone_acro = acro.join(by_acro, ["head", "acro"], "left_anti").groupBy("head", "acro").agg(F.min("a").alias("b"))
    link(acro.join(lone_acro, ["head", "acro"]), "short")

    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return rows, out.filter("a <> b").groupBy("a", "b", "rule").agg(F.max("score").alias("score"))


def name_groups(creators: DataFrame) -> DataFrame:
    """(creator_id, group_id): rows of one person or organisation share the group_id, the smallest creator_id among them."""
    rows, links = name_links(creators)
    rows = cut_lineage(rows)
    labels = components(rows.select(F.col("name_id").alias("node")).distinct(), links)
    grouped = cut_lineage(rows.join(labels.select(F.col("node").alias("name_id"), F.col("label")), "name_id").select("creator_id", "label"))
    least = grouped.groupBy("label").agg(F.min("creator_id").alias("group_id"))
    return grouped.join(least, "label").select("creator_id", "group_id")


def p6_groups(spark: SparkSession, folder: str) -> DataFrame:
    return name_groups(table(spark, folder, "creators"))


def p6_links(spark: SparkSession, folder: str) -> DataFrame:
    """The links between distinct names, each named by its smallest creator_id, with the rule and its score."""
    return name_links(table(spark, folder, "creators"))[1].select(F.col("a").alias("creator_id_a"), F.col("b").alias("creator_id_b"), "rule", F.round("score", 6).alias("score"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs_within(p6_groups(spark, folder), "creator_id", "group_id")


QUERIES = {"p6_found": p6_found, "p6_groups": p6_groups, "p6_links": p6_links}
SQL: dict[str, str] = {}
