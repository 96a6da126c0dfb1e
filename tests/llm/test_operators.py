"""Training-data operators: brute force, round trips, held-out accuracy, and the odd inputs."""

import os
import random
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenloom.llm import abuse, blocking, characters, consensus, leakage, names, nearduplicates, sketches, titles, tokenization, truncation
from screenloom.session import ensure_checkpoint_dir

LONG = "word " * 60_000


# ---- blocking ----
def test_key_pairs_and_components(spark):
    rows = spark.createDataFrame([(k % 3, k) for k in range(60)] + [(None, 99), (7, 100)], "k int, id bigint")
    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if a % 3 == b % 3}
    for chunk in (1_000, 6):
        got = [tuple(r) for r in blocking.key_pairs(rows, "k", "id", chunk).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    chain = spark.createDataFrame([(k, k + 1) for k in range(12)] + [(20, 21), (5, 5)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in blocking.components(chain).collect()}
    assert got == {k: 0 for k in range(13)} | {20: 20, 21: 20}
    assert blocking.components(chain.limit(0)).count() == 0


# ---- near-duplicates ----
def test_sketch_estimates_likeness():
    a = sketches.mix(np.arange(300, dtype=np.uint64))
    b = np.concatenate([a[:200], sketches.mix(np.arange(1000, 1100, dtype=np.uint64))])
    same = np.mean(sketches.prob_min_hash(a, 2000) == sketches.prob_min_hash(b, 2000))
    assert abs(same - 0.5) < 0.05
    heavy = np.where(np.arange(300) < 200, 10.0, 1.0)
    assert np.mean(sketches.prob_min_hash(a, 2000, heavy) == sketches.prob_min_hash(b, 2000, heavy)) > 0.85
    assert len(sketches.prob_min_hash(a[:0], 16)) == 0


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefghijklmnopqrst") * 3 + str(rng.randrange(40)) for _ in range(60)) for _ in range(12)]
    texts = []
    for t in base:
        for cut in (0, 3, 12):
            w = t.split()
            for _ in range(cut):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    texts += [base[0], base[0].upper() + "!", "", None, "two words", LONG]
    rows = [(k, t, 0) for k, t in enumerate(texts)]
    found = nearduplicates.NearDuplicates(spark.createDataFrame(rows, "row_no bigint, text string, id int"), "row_no", F.col("text"), 3, 0.5)
    sets = [set(map(int, sketches.shingles(t or "", 3))) for t in texts]
    want = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}
    got = [tuple(r) for r in found.pairs().collect()]
    assert set(got) == want and len(got) == len(want)
    groups = {r["id"]: r for r in found.groups().collect()}
    assert groups[0]["group"] == groups[36]["group"] and groups[0]["n_copies"] == 3 and 38 not in groups
    monkeypatch.setattr(blocking, "CHUNK_ROWS", 2)
    assert {tuple(r) for r in found.pairs().collect()} == want  # hot classes split
    # weighted shingles: the links are those of the probability Jaccard likeness
    rare = nearduplicates.NearDuplicates(spark.createDataFrame(rows[:36], "row_no bigint, text string, id int"), "row_no", F.col("text"), 3, 0.5, nearduplicates.rarity)
    holders = {e: sum(e in s for s in {frozenset(s) for s in sets[:36]}) for s in sets[:36] for e in s}
    total = len({frozenset(s) for s in sets[:36]})
    weight = {e: 1 + np.log(total / n) for e, n in holders.items()}
    like = lambda s, t: sum(1 / sum(max(weight[f] / weight[e] if f in s else 0, weight[f] / weight[e] if f in t else 0) for f in s | t) for e in s & t)
    heavy = {(a, b) for a in range(36) for b in range(a + 1, 36) if sets[a] == sets[b] or like(sets[a], sets[b]) >= 0.5}
    assert {tuple(r) for r in rare.pairs().collect()} == heavy and heavy
    empty = nearduplicates.NearDuplicates(spark.createDataFrame([], "row_no bigint, text string"), "row_no", F.col("text"))
    assert empty.pairs().count() == 0 and empty.groups().count() == 0


# ---- titles ----
T = "Costs and effects of brief problem-solving therapy for anxiety in Zoudrabei: a cohort study with rural weavers"


def test_title_forms_and_slips():
    same = ["<i>Costs</i> &amp; effects of the brief problem solving therapy for anxiety in Zoudrabei - a cohort study with rural weavers [Internet]", T.upper(), "A cohort study with rural weavers: Costs and effects of brief problem-solving therapy for anxiety in Zoudrabei"]
    forms = titles.title_forms(T)
    for t in same:
        assert titles.title_forms(t)[0] == forms[0], t
    assert titles.word_slips(forms[0], titles.title_forms(T.replace("weavers", "weavres"))[0]) == [("weavers", "weavres")]
    assert titles.word_slips(titles.title_forms(T + " (part 1)")[0], titles.title_forms(T + " (part 2)")[0]) is None
    assert titles.title_forms(None) == titles.title_forms("NA") == titles.title_forms(" ?!") == []
    assert titles.edit_distance("abcd", "abdc", 2) == 1 and titles.edit_distance("abc", "xyz", 2) == 3


def _records(spark):
    rows = [
        (1, "a", T, 0), (2, "b", T.replace("Zoudrabei", "Zoudrabie"), 1), (3, "c", T.replace("rural", "urban"), 1), (4, "a", "Something else", 2), (5, "d", None, 1), (6, "e", None, 2),
        (7, "f", "Other title of a report on quiet villages", 1), (8, "g", "Other title of a report on quiet villages", 1), (9, None, T, None), (10, None, "", 3), (11, "h", LONG + "ending", 1), (12, "i", LONG + "endnig", 2),
        (13, "j", T.replace("rural", "urban"), 2), (14, "k", "No", 0), (15, "l", "No", 1),
    ]
    urban = [(100 + k, f"u{k}", f"Notes from urban weavers, volume {w}", 0) for k, w in enumerate("alpha beta gamma delta".split())]
    rural = [(200 + k, f"r{k}", f"Notes from rural weavers, volume {w}", 0) for k, w in enumerate("kappa lambda omega sigma".split())]
    return spark.createDataFrame([(*r, "clash") for r in rows + urban + rural], "row_no bigint, record_id string, title string, batch_no int, form string")


def test_batches_against_history(spark, tmp_path):
    df = _records(spark)
    got = {r["row_no"] for r in titles.already_there(df).collect()}
    assert got == {2, 4, 12, 13, 15}
    history = titles.TitleHistory(spark, str(tmp_path))
    step = set()
    for b in range(4):
        step |= {r["row_no"] for r in history.accept(df.filter(F.col("batch_no") == b), b).collect()}
    assert step == got
    again = {r["row_no"] for r in history.accept(df.filter("batch_no = 2"), 2).collect()}
    assert again == {4, 12, 13}
    assert titles.already_there(df.limit(0)).count() == 0


def _edited(rng, text, edits):
    w = list(text)
    for _ in range(edits):
        k = rng.randrange(len(w) - 1)
        rng.choice((lambda: w.__setitem__(k, "z"), lambda: w.insert(k, "y"), lambda: w.pop(k), lambda: w.__setitem__(slice(k, k + 2), w[k : k + 2][::-1])))()  # noqa: B023
    return "".join(w)


def _plain_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
        last = row
    return last[-1]


def test_segment_join_loses_no_close_title(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(9, 60))).strip() for _ in range(40)] + ["cohort study with rural weavers in the far north of " + w for w in "ab cd ef gh".split()]
    forms = list(dict.fromkeys([*base, *(_edited(rng, t, rng.randrange(1, 4)) for t in base for _ in range(3)), "", "abc", "abd", "word " * 5000, "word " * 4999 + "wrod "]))
    df = spark.createDataFrame([(k, f, None) for k, f in enumerate(forms)], "class bigint, form string, other string")
    known = titles.Filter()
    for r in titles.filter_words(df).collect():
        known.words[r["kind"], r["word"]] |= np.int64(r["bits"]).view(np.uint64)
    threes = titles.threes_of(df)
    close = {(a, b) for a in range(len(forms)) for b in range(len(forms)) if a != b and len(forms[a]) < 999 and len(forms[b]) < 999 and _plain_distance(forms[a], forms[b]) <= titles.edits_allowed(min(len(forms[a]), len(forms[b])))}
    close |= {(len(forms) - 2, len(forms) - 1), (len(forms) - 1, len(forms) - 2)}
    full = titles.Filter()
    full.words[:] = ~np.uint64(0)
    for own in (known, full):  # a full filter loses nothing either
        got = {tuple(r) for r in titles.candidates(titles.probes_of(df, spark.sparkContext.broadcast(own)), threes).collect()}
        assert len(close) >= 200 and close <= got
    for a, b in close:  # a swap counts as two edits
        if len(forms[a]) < 999:
            assert titles.edit_distance(forms[a], forms[b], 5, swap=2) == _plain_distance(forms[a], forms[b])


def test_history_reads_itself_again(spark, tmp_path):
    df = _records(spark)
    one, other = titles.TitleHistory(spark, str(tmp_path / "a")), titles.TitleHistory(spark, str(tmp_path / "b"))
    for b in range(3):
        want = {tuple(r) for r in one.accept(df.filter(F.col("batch_no") == b), b).collect()}
        got = {tuple(r) for r in titles.TitleHistory(spark, other.path).accept(df.filter(F.col("batch_no") == b), b).collect()}
        assert got == want  # a new process knows what the files tell


def test_waiting_batches_are_told_what_each_is_told_alone(spark, tmp_path, monkeypatch):
    other = [(300, "x", "Keepers of heron colonies near Zoudrabei and their pay", 0), (301, "y", "Keepers of herom colonies near Zoudrabei and their pay", 1)]
    other += [(310 + k, f"z{k}", f"A {w} of {bird} watching along the {place} coast", 2) for k, (w, place) in enumerate((("survey", "northern"), ("memoir", "rocky"), ("catalogue", "distant"), ("dream", "frozen"))) for bird in ("heron", "herom")]
    other += [(320, "v", "Songs for heron nests in winter and in early spring", 0), (321, "w", "Songs for herom nests in winter and in early spring", 3), (322, "w", "An entry without any like it", 4), (323, "q", None, 4), (324, "q2", "An entry without any like it", 5)]
    df = _records(spark).drop("form").unionByName(spark.createDataFrame(other, "row_no bigint, record_id string, title string, batch_no int"))
    one, many = titles.TitleHistory(spark, str(tmp_path / "a")), titles.TitleHistory(spark, str(tmp_path / "b"))
    alone = {tuple(r) for b in range(6) for r in one.accept(df.filter(F.col("batch_no") == b), b).collect()}
    told = {r[0] for r in alone}
    assert {301, 322, 324} <= told and 321 not in told  # by batch 3, both spellings are words of their own
    together = lambda first, last: {tuple(r) for r in many.accept_all(df.filter(F.col("batch_no").between(first, last)), first, last).collect()}
    got = together(0, 0) | together(1, 4)
    assert together(1, 4) <= got  # tried again
    assert got | together(5, 5) == alone
    staged = []
    monkeypatch.setattr(titles, "stage", lambda d, stage=titles.stage: staged.append(1) or stage(d))
    assert {tuple(r) for r in titles.already_there(df).collect()} == alone
    assert len(staged) <= 3 * 4  # the driver keeps something of every job: there are as many as a history doubles, not as there are batches


def test_runs_of_batches():
    assert titles.runs([(7, 9), (0, 10), (2, 4), (3, 3), (5, 9)]) == [(0, 0), (2, 3), (5, 5), (7, 7)]
    assert titles.runs([]) == [] and len(titles.runs([(k, 100) for k in range(1_000)])) == 11


def test_shifts_that_take_too_many_edits_are_no_probe():
    full = titles.Filter()
    full.words[:] = ~np.uint64(0)
    form = "costs and effects of brief problem solving therapy for anxiety in zoudrabei"
    mine = set(titles.own_threes(form).tolist())
    assert len(mine) == 20
    for other in (form, "x" + form[:30] + form[32:], form[:20] + "abc" + form[20:50] + form[52:]):  # 0, 3 and 5 edits
        assert mine & set(titles.probe_threes(other, full).tolist())
    moved = "abcd" + form[:36] + form[40:]  # 8 edits: its segments stand where others may stand, but not together
    assert len(mine & set(titles.probe_threes(moved, full).tolist())) < len(mine)


# ---- names ----
def test_name_parts():
    person = names.parse_person
    assert person("Dekvaglub, Emmanuel K.") == ("dekvaglub", "emmanuel", "k") and person("Dekvaglub EK") == ("dekvaglub", "e", "k")
    assert person("K. van Hullashad") == ("van hullashad", "k", "") and person("Manny Dekvaglub")[1] == "emmanuel" and person("GOLNOB T.") == ("golnob", "t", "")
    assert person("...") is None and names.parse_periodical("—") is None
    assert names.parse_periodical("Village Health, Bo Journal of: Series B") == names.parse_periodical("The Bo Journal of Village Health: Series B (Online)")


def test_entities(spark):
    people = ["Nabreggil, Thomas B.", "T. B. Nabreggil", "Nabregil, Thomas", "NABREGGIL, Thomas", "Nabreggil, Michael", "Nabreggil, Mike", "Nabreggil, Michael"]
    papers = ["Bodrai Annals of Mood Care", "Bodrai Ann. Mood Care", "Bodrai Annals of Mood Care: Series B", "Bodrai Bulletin of Mood Care", "Bodrai Anals of Mood Care"]
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)).capitalize()
    fill = [("authors", f"{word()}, {word()}") for _ in range(150)] + [("publication", f"{word()} Letters on {word()} Health") for _ in range(150)]  # rarity needs a collection
    rows = fill + [("authors", n) for n in people] + [("publication", n) for n in [*papers, papers[0], papers[0]]] + [("authors", None), ("authors", " "), ("publication", "???"), ("authors", LONG[:3000])]
    found = names.entities(spark.createDataFrame([(*r, 1) for r in rows], "field string, name string, class int"))
    got = {(r["field"], frozenset((r["name_a"], r["name_b"]))) for r in names.spelling_pairs(found).collect()}
    want = {("authors", frozenset((a, b))) for g in (people[:4], people[4:6]) for a in g for b in g if a != b}
    want |= {("publication", frozenset((a, b))) for g in ([papers[0], papers[1], papers[4]],) for a in g for b in g if a != b}
    assert got == want
    assert names.spelling_pairs(names.entities(spark.createDataFrame([], "field string, name string"))).count() == 0


def test_links_lose_nothing(spark):
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(k)).capitalize()
    people = [(word(4), rng.choice(["Emmanuel", "Katherine", "Thomas", "Rania", "Kofi"])) for _ in range(120)]
    spelt = []
    for family, given in people:
        k = rng.randrange(1, len(family) - 2)
        swapped = family[:k] + family[k + 1] + family[k] + family[k + 2 :]
        spelt += [f"{family}, {given}", f"{swapped}, {given}", f"{given[0]}. {family}", family, f"{family}, X{given[1:]}"]
    spelt += ["de la Torrepan, Ana", "dela Torrepan, Ana", "K. Katzomil", "Catherine Katzomil", "", "...", LONG[:2000]]
    vecs = names.vectors(names.classes_of(spark.createDataFrame([("authors", n) for n in spelt], "field string, name string")).dropDuplicates(["class"])).cache()
    got = {(r["a"], r["b"]): r["likeness"] for r in names.links(vecs).collect()}
    rows = [(r["class"], r["base"], r["first"], r["middle"], {t["gram"]: t["w"] for t in r["terms"]}) for r in vecs.collect()]
    want = {}
    for k, a in enumerate(rows):
        for b in rows[k + 1 :]:
            agree = names.given_likeness(a[2:4], b[2:4])
            if agree and names._same_family(a[1], b[1]):
                cosine = sum(w * b[4].get(g, 0.0) for g, w in a[4].items())
                want[min(a[0], b[0]), max(a[0], b[0])] = (cosine + 2 * agree) / 3 if cosine >= names.MIN_COSINE else None
    kept = {p: v for p, v in want.items() if v is not None}
    assert set(got) <= set(want) and len(set(got) & set(kept)) >= 0.98 * len(kept) and len(kept) >= 0.97 * len(want) and len(kept) > 800
    assert all(abs(got[p] - kept[p]) < 1e-9 for p in set(got) & set(kept))


def test_linkage_never_stops_unfinished(spark):
    n = 6  # each round merges one class with the hub
    found = spark.createDataFrame([(a, b, 1 - 0.005 * b) for b in range(n) for a in range(b)], "a bigint, b bigint, likeness double").coalesce(1)
    counts = spark.range(n).select(F.col("id").alias("class"), F.lit(1).cast("bigint").alias("n")).coalesce(1)
    assert {tuple(r) for r in names.average_linkage(found, counts).select("class", "group").collect()} == {(k, 0) for k in range(n)}
    with pytest.raises(RuntimeError):
        names.average_linkage(found, counts, rounds=2)


# ---- characters ----
def test_consistent_form(spark):
    cases = {"ｆｕｌｌ １": "full 1", "ﬁt": "fit", "café": "café", "a​b": "ab", "a b": "a b", "pаper": "paper", "𝐛𝐨𝐥𝐝": "bold", "　": " "}
    plain = ["“quotes” – … − é", "депрессия χ-square άγχος 抑郁", "", "line\nbreak", "🙂 ok", LONG]
    rows = [("f", k, t, "x") for k, t in enumerate([*cases, *plain])] + [("f", 99, None, "x"), ("f", 0, "ﬁt", "x")]
    got = characters.consistent_form(spark.createDataFrame(rows, "field string, row_key bigint, text string, is_case string")).collect()
    by = {r["row_key"]: r for r in got if r["row_key"]}
    for k, want in enumerate(list(cases.values())[1:], 1):
        assert by[k]["is_case"] and by[k]["text"] == want
    for k, t in enumerate(plain, len(cases)):
        assert not by[k]["is_case"] and by[k]["text"] == t
    assert by[99]["text"] is None and not by[99]["is_case"] and len(got) == len(rows)


# ---- consensus ----
def test_consensus_finds_who_to_trust(spark):
    rng = random.Random(5)
    votes, truth = [], {}
    for k in range(300):
        truth[f"r{k}"] = t = rng.random() < 0.3
        for model, right in (("good1", 0.95), ("good2", 0.95), ("weak", 0.6), ("contrary", 0.15)):
            v = t if rng.random() < right else not t
            votes.append((f"r{k}", model, rng.choice(("include", " INCLUDE\n") if v else ("EXCLUDE", "exclude "))))
        votes.append((f"r{k}", "yes", "Include"))
    votes += [("hot", m, "EXCLUDE") for m in ("good1", "good2", "weak") for _ in range(2000)] + [("few", "good1", "INCLUDE"), ("odd", "good1", None), (None, "good1", "INCLUDE"), ("odd", "good2", " ")]
    labels = spark.createDataFrame([("r1", "INCLUDE on x"), ("r2", None), ("r3", "Screen on")], "record_id string, current_gt_label string")
    texts = spark.createDataFrame([("r1", "words here"), ("r2", None)], "item string, text string")
    fit = consensus.Consensus(spark.createDataFrame(votes, "record_id string, model string, screening_decision string"), labels, texts)
    got = {r["item"]: r["decision"] for r in fit.items().collect()}
    assert set(got) == {*truth, "hot"} and got["hot"] == "EXCLUDE"
    assert np.mean([(got[k] == "INCLUDE") == t for k, t in truth.items()]) > 0.95
    trust = {r["annotator"]: r["reliability"] for r in fit.annotators().collect()}
    assert trust["model:good1"] > 0.9 and trust["model:contrary"] < 0.3 and abs(trust["model:yes"] - 0.5) < 0.05
    assert fit.agreement().collect()[0]["n_items"] == 301
    none = consensus.Consensus(spark.createDataFrame([], "record_id string, model string, screening_decision string"), labels.limit(0), texts)
    assert none.items().count() == 0 and none.annotators().count() == 0


# ---- truncation ----
def test_truncation(spark):
    rng = random.Random(2)
    who, what = ["nurses", "teachers", "drivers", "weavers"], ["anxiety", "loneliness", "burnout"]
    full = [f"The study looked at {rng.choice(who)} with {rng.choice(what)}. Each session was rated by two independent observers." for _ in range(300)]
    rows = [("f", k, "s", t) for k, t in enumerate(full)]
    rows += [("f", 1000, "s", full[0][:-25]), ("f", 1001, "s", full[1][:-14] + "..."), ("f", 1002, "s", full[2] + " (see title)"), ("f", 1003, "s", full[3][:-1]), ("f", 1004, None, None), ("f", 1005, "s", ""), ("f", 1006, "s", LONG)]
    rows += [("f", 2000 + k, "s", f"{t} (see title)") for k, t in enumerate(full[:40])]
    found = {r["row_key"]: r["cut"] for r in truncation.judged(spark.createDataFrame([(*r, 1) for r in rows], "field string, row_key bigint, source string, text string, length int")).collect()}
    assert found[1000] and found[1001] and not found[1002] and not found[1003] and 1004 not in found and 1005 not in found
    assert not any(found[k] for k in range(300))
    assert truncation.judged(spark.createDataFrame([], "field string, row_key bigint, source string, text string")).count() == 0


def test_broken_tags_are_marks(spark):
    for end in ("<br", "<br ", "</", "<", "<br/", '<span class="x', "<br>", "<br...", "...<br"):
        assert truncation.tail_parts(f"Each session was rated by two indep{end}") == ("each session was rated by two indep".split(), True, False), end
    assert truncation.tail_parts("It was rated.<br>")[1:] == truncation.tail_parts("<p>It was rated.</p>")[1:] == (False, True)
    assert truncation.tail_parts("It was rated with p < 0.05")[1] is truncation.tail_parts("The <i>aim</i> was met")[1] is False
    rng = random.Random(2)
    full = [f"The study looked at {rng.choice(['nurses', 'drivers'])} with {rng.choice(['anxiety', 'burnout'])}. Each session was rated by two independent observers." for _ in range(300)]
    rows = [("f", k, "s", t) for k, t in enumerate(full)] + [("f", 1000 + k, "s", f"{full[k][: -12 - k]}<br") for k in range(30)]
    found = {r["row_key"]: r["cut"] for r in truncation.judged(spark.createDataFrame(rows, "field string, row_key bigint, source string, text string")).collect()}
    assert all(found[1000 + k] for k in range(30)) and not any(found[k] for k in range(300))


def test_copies_of_a_cut_text_do_not_vouch_for_it(spark):
    rng = random.Random(2)
    full = [f"The study {rng.choice('abcdefgh') * 3} looked at {rng.choice(['nurses', 'drivers'])} with {rng.choice(['anxiety', 'burnout'])}. Each session was rated by two independent observers." for _ in range(300)]
    rows = [("f", k, "s", t) for k, t in enumerate(full)]
    word, sentence, whole = full[0][:-5], "Nobody knew it. Each session was rated by two", "All was well. Each session was rated by two independent observers"
    for copies in (1, 150):
        more = [("f", 1000 * n + k, f"s{k % 3}", t) for n, t in enumerate((word, sentence, whole), 1) for k in range(copies)]
        found = {r["row_key"]: r["cut"] for r in truncation.judged(spark.createDataFrame(rows + more, "field string, row_key bigint, source string, text string")).collect()}
        assert all(found[1000 + k] and found[2000 + k] and not found[3000 + k] for k in range(copies)), copies
        assert not any(found[k] for k in range(300)) and len(found) == 300 + 3 * copies


# ---- tokenization ----
def test_tokens_round_trip(spark):
    texts = ["Hello world", "", None, "naïve 抑郁 🙂\x00\t", "<|endoftext|>", "ｆｕｌｌ é", "a" * 5000, LONG]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(0, "Hello world", "y")], "doc_id bigint, text string, ids string")
    ids = tokenization.encode(df)
    got = ids.collect()
    assert len(got) == 9 and all(r["ids"] == [] for r in got if r["doc_id"] in (1, 2)) and all(len(r["ids"]) for r in got if r["doc_id"] == 4 for _ in [0])
    back = {r["doc_id"]: r["text"] for r in tokenization.decode(ids).collect()}
    assert back == {k: t or "" for k, t in enumerate(texts)}
    spans = {r["doc_id"]: r for r in tokenization.encode_with_offsets(df).collect()}[3]
    raw = texts[3].encode()
    assert spans["byte_start"][0] == 0 and spans["byte_start"][-1] < len(raw) and max(spans["char_end"]) == len(texts[3])
    assert tokenization.decode_ids(spans["ids"][:-1]) != texts[3]
    assert tokenization.encode(df.limit(0)).count() == 0


# ---- leakage ----
def test_leaks(spark):
    a = "A 40-year-old baker from Norabei keeps checking the door since a long strike. The lodger hides the tally book before breakfast. An aunt repairs the noisy fan and counts three blue buckets with shaking hands."
    b = "A 31-year-old welder from Tuvoria misses prayers after a failed examination. The stepson sells cold porridge on market days. A godmother avoids the church ledger until the kettle boils and jokes about it."
    lead, ask = "Read the case and answer.", "Which step comes first? Check the date."
    items = spark.createDataFrame([(1, f"{lead} {a} {ask}"), (2, f"{lead} {b} {ask}"), (3, None), (4, "")], "item_id bigint, text string")
    w = a.split()
    edited = " ".join("changed" if k % 9 == 8 else x for k, x in enumerate(w))
    docs = [(10, f"Intro text here. {a.upper()} More."), (11, edited), (12, " ".join(w[:8])), (13, f"{lead} {ask} nothing else"), (14, None), (15, ""), (16, LONG + " ".join(w[5:25])), (17, b.replace(" ", "\n").replace(".", " [3]."))]
    found = leakage.leaked(leakage.leaks(spark.createDataFrame([(*d, 0) for d in docs], "doc_id bigint, text string, item_id int"), items))
    assert {(r["item_id"], r["doc_id"]) for r in found.collect()} == {(1, 10), (1, 11), (1, 16), (2, 17)}
    assert {r["item_id"]: r["n_docs"] for r in leakage.item_report(items, found).collect()} == {1: 3, 2: 1, 3: 0, 4: 0}
    assert leakage.leaks(found.select("doc_id", F.lit("x").alias("text")), items.limit(0)).count() == 0


def _brute_leaks(accounts, docs):
    """All pairs by alignment over whole texts, without seeds."""
    out = set()
    for k, account in accounts:
        ids = {}
        a = np.array([ids.setdefault(w, len(ids)) for w in leakage.words(account)], dtype=np.int32)
        for d, text in docs:
            t = np.array([ids.get(w, -1) for w in leakage.words(text)], dtype=np.int32)
            spans = leakage.passages(a, t) if len(t) else []
            if sum(y - x + 1 for x, y in spans) * 3 >= len(a) and spans:
                out.add((k, d))
    return out


def test_edited_ten_word_passages_are_found(spark, monkeypatch):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(400)]
    texts = [" ".join(rng.sample(vocabulary, 30)).capitalize() + "." for _ in range(24)]
    items = spark.createDataFrame([(k, f"Read the case. {t} Which step comes first? None.") for k, t in enumerate(texts)], "item_id bigint, text string")
    docs = []
    for k, t in enumerate(texts):
        w = t.rstrip(".").split()
        for n, changed in enumerate(((2, 7), (3, 6), (1, 8), (), (0, 9), (4, 5))):
            own = ["zz" if p in changed else x for p, x in enumerate(w[:10])]
            docs.append((10 * k + n, " ".join(rng.sample(vocabulary, 15) + own + rng.sample(vocabulary, 15))))
        docs.append((10 * k + 7, " ".join(w[:11] + rng.sample(vocabulary, 4) + w[17:28])))  # two passages, words of the account left out between them
        docs.append((10 * k + 8, " ".join(x if p % 4 else "zz" for p, x in enumerate(w))))  # a changed word in four
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    own = [(r["item_id"], r["account"]) for r in leakage.accounts(items).collect()]
    want = _brute_leaks(own, docs)
    got = {(r["item_id"], r["doc_id"]) for r in leakage.leaked(leakage.leaks(df, items)).collect()}
    assert got == want and len(want) == 24 * 6  # two changed words in a row end a passage, and nine words are none
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 500)
    monkeypatch.setattr(leakage, "SCAN_CHARS", 1_000)
    assert {(r["item_id"], r["doc_id"]) for r in leakage.leaked(leakage.leaks(df, items)).collect()} == want  # blocks change nothing


# ---- abuse ----
def test_abuse_on_held_out_sentences(spark):
    rng = random.Random(4)
    calm = ["The nurses delivered nine sessions in the clinic.", "My sister says the waiting list is long.", "Sexual violence was reported by some patients.", "Does the app work offline at all?", "Costs were collected and valued at prices."]
    rude = ["You are a {a} {b} and everybody here knows it!", "Shut your mouth, you {a} {b}, nobody asked you.", "Crawl back under your rock you {a} {b}."]
    words = (["worthless", "stupid", "filthy", "brainless"], ["moron", "clown", "liar", "creep"])
    fill = lambda: rng.choice(rude).format(a=rng.choice(words[0]), b=rng.choice(words[1]))
    doc = lambda bad: " ".join(rng.sample(calm, 3) + ([fill()] if bad else []))
    rows = [(k, doc(k % 3 == 0), "s", int(k % 3 == 0)) for k in range(240)]
    df = spark.createDataFrame([r[:3] for r in rows] + [(900, None, "s"), (901, "", "s"), (902, LONG + "you are a w0rthl3ss m*ron and everybody here knows it!", "s"), (903, LONG, "s")], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(r[0], 1 - r[3] if r[0] in (7, 8) else r[3]) for r in rows[:120]], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in abuse.scores(df, labels).collect()}
    assert np.mean([got[r[0]]["flagged"] == bool(r[3]) for r in rows[120:]]) > 0.95
    assert got[900]["score"] is None and not got[901]["flagged"] and got[902]["flagged"] and not got[903]["flagged"]
    assert not any(r["flagged"] for r in abuse.scores(df, labels.filter("toxic = 0")).collect())


def test_keys_meet_under_a_condition(spark):
    rows = [(k % 7, k, "a" if k % 3 else "b") for k in range(60)] + [(99, 1, "a"), (None, 2, "a")]
    df = spark.createDataFrame(rows, "key int, id bigint, kind string")
    for chunk in (4, 1000):
        got = [tuple(r) for r in blocking.key_pairs(df, "key", "id", chunk, carry=("kind",), keep=lambda x, y: F.col(f"kind{x}") == F.col(f"kind{y}")).collect()]
        assert sorted(got) == [(a, b) for a in range(60) for b in range(a + 1, 60) if a % 7 == b % 7 and (a % 3 > 0) == (b % 3 > 0)]


def test_near_duplicates_keep_neither_shingles_nor_bands(spark):
    """Shingles, kept twice, and bands of eight bytes took some 3,000 bytes a text."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(5000)]
    texts = [(k, " ".join(rng.choices(words, k=130))) for k in range(400)]
    texts += [(400 + k, t + " more") for k, t in texts[:5]] + [(500 + k, t) for k, t in texts[:3]]
    folder = urlparse(ensure_checkpoint_dir(spark)).path
    size = lambda: sum(os.path.getsize(os.path.join(p, f)) for p, _, fs in os.walk(folder) for f in fs if not f.startswith("."))
    before = size()
    found = nearduplicates.NearDuplicates(spark.createDataFrame(texts, "id int, text string"), "id", F.col("text"), 3, 0.5)
    pairs = {tuple(r) for r in found.pairs().collect()}
    assert pairs == {(k, 400 + k) for k in range(5)} | {(k, 500 + k) for k in range(3)} | {(400 + k, 500 + k) for k in range(3)}
    assert size() - before < 400 * len(texts)


def test_bands_are_sorted_once_and_no_pair_is_lost(spark):
    """Bands in several Arrow batches, repeats of a class, and bands of more classes than a chunk; classes used to be written three times before they met."""
    rng = random.Random(11)
    rows = [(c, [rng.randrange(40 if p else 4) for p in range(nearduplicates.REGISTERS // nearduplicates.BAND_ROWS)]) for c in range(300)]
    rows = [(c, [v if p < 2 else c * 1000 + p for p, v in enumerate(b)]) for c, b in rows]
    wanted = {(a, b) for a, x in rows for b, y in rows if a < b and (x[0] == y[0] or x[1] == y[1])}
    chunk, batch = nearduplicates.CHUNK_ROWS, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    nearduplicates.CHUNK_ROWS = 30  # bands of the first place have more
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = nearduplicates.band_pairs(spark.createDataFrame(rows + rows[:50], "class bigint, bands array<int>")).collect()
    finally:
        nearduplicates.CHUNK_ROWS = chunk
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert len(got) == len(wanted) and {tuple(r) for r in got} == wanted


def test_sketches_are_written_once(spark, monkeypatch):
    """Bands and marks are larger than their texts on disk; a second copy of them (and a shuffle for it) took the disk of large tables."""
    written, plain = [], nearduplicates.stage
    monkeypatch.setattr(nearduplicates, "stage", lambda df: written.append(df.columns) or plain(df))
    rows = [(k, f"one two three four five {k % 3} six seven eight nine ten {k % 3}") for k in range(12)]
    found = nearduplicates.NearDuplicates(spark.createDataFrame(rows, "id bigint, text string"), "id", F.col("text"), 3, 0.5)
    assert sum("bands" in c for c in written) == 1 and found.pairs().count() == 18
