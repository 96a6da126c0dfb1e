"""Variant spellings of people and periodicals.

Each distinct spelling is parsed into a class. The name of a class (family name of a person without blanks, words of a
periodical) becomes a vector of character n-grams weighted by rarity. A distributed sparse join, exact for MIN_COSINE (so it keeps
all partners and not the best n), gives pairs; those whose words and given names agree become links, whose likeness is made of the cosine
and of that agreement, and average linkage groups them. Linkage runs on tables of links, merging mutual best neighbours in
rounds, so no group is ever collected.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.llm.blocking import key_pairs
from screenloom.llm.titles import edit_distance
from screenloom.session import cut, stage

GRAMS = (2, 3)
#: Single slips in family names, swaps among them, leave a cosine of 0.399 at least (measured over 8,269 families).
MIN_COSINE = 0.36
#: Two family names further apart than this in plain edits are never one: two slips that are swaps.
FAMILY_EDITS = 4
#: Given names of so many letters are also joined on their last two: the first letter may be a slip.
ENDING_FROM = 4
#: Average likeness of all pairs across two groups from which they are one.
MIN_LINKAGE = 0.5

# Short forms of given names and the names they stand for.
NICKNAMES = {
    "abigail": "abby abbie gail", "alexander": "alex sandy sasha xander", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs",
    "benjamin": "ben benny benji", "catherine": "cathy kate katie kathy katherine kat", "charles": "charlie chuck", "christopher": "chris kit", "daniel": "dan danny",
    "david": "dave davy", "deborah": "deb debbie debby", "dorothy": "dot dolly", "edward": "ed eddie ted ned", "elizabeth": "liz beth betty lizzie eliza bess libby",
    "emmanuel": "manny manu", "francisco": "paco pancho", "frederick": "fred freddy", "gabriel": "gabe gabi", "gregory": "greg", "guadalupe": "lupe lupita", "henry": "harry hank",
    "ignacio": "nacho", "isabel": "izzy bella", "jacqueline": "jackie", "james": "jim jimmy jamie", "jennifer": "jen jenny jenn", "jonathan": "jon jonny", "joseph": "joe joey", "jose": "pepe",
    "josephine": "jo josie", "kenneth": "ken kenny", "lawrence": "larry", "leonard": "len lenny leo", "margaret": "peggy maggie meg peg", "matthew": "matt", "michael": "mike mick micky",
    "nathaniel": "nate nat nathan", "nicholas": "nick nicky", "oliver": "ollie", "patricia": "pat patty trish tricia", "penelope": "penny", "peter": "pete", "philippa": "pippa pip", "rebecca": "becky becca",
    "richard": "rick dick rich", "robert": "rob bob bobby", "ronald": "ron ronnie", "samuel": "sam sammy", "stephen": "steve", "susannah": "sue susie susan", "theodore": "theo teddy",
    "thomas": "tom tommy", "timothy": "tim", "victoria": "vicky vic tori", "vincent": "vince", "walter": "walt", "william": "will bill billy", "zachary": "zach zack zac",
}
SHORT = {short: full for full, shorts in NICKNAMES.items() for short in shorts.split()}
#: First letters under which a full name and its short forms are written.
INITIALS = {full: sorted({full[0], *(short[0] for short in shorts.split())}) for full, shorts in NICKNAMES.items()}
# Particles of family names, words of a periodical's name that carry nothing, and additions to it.
PARTICLES = frozenset("van von der den de la le el al bin ibn da dos di del ter ten".split())
EMPTY_WORDS = frozenset("the of on for in and a an".split())
ADDITIONS = re.compile(r"\s*(?:\((?:online|print|electronic|internet)\)|,?\s*peer[- ]reviewed)\s*$", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")
_GIVEN = re.compile(r"[^\W\d_]+(?:-[^\W\d_]{2,})*")
_INVERTED = re.compile(r"^(?P<topic>[^,:]+),\s*(?P<head>[^,:]+\s(?:of|on|for|in))\s*(?P<rest>:.*)?$", re.I)


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def parse_person(spelling: str) -> tuple[str, str, str] | None:
    """(family, first, middle initials); first is a name or an initial, '' if there is none. None without letters."""
    text = plain(spelling)
    if "," in text:
        family, given = text.split(",", 1)
        given_words, family_words = _GIVEN.findall(given), _LETTERS.findall(family)
    else:
        words = [w for w in re.split(r"[\s.]+", text) if _LETTERS.search(w)]
        initial = [len(w) <= 3 and w.isupper() and w.lower() not in PARTICLES for w in words]
        if len(words) > 1 and initial[-1] and not all(initial):
            n = len(words)
            while n > 1 and initial[n - 1]:
                n -= 1
            family_words, given_words = words[:n], words[n:]
        else:
            n = 0
            while n < len(words) - 1 and (n == 0 or (initial[n] and len(words[n]) == 1)):
                n += 1
            family_words, given_words = words[n:], words[:n]
        family_words = [w for x in family_words for w in _LETTERS.findall(x)]
        given_words = [w for x in given_words for w in _GIVEN.findall(x)]
    if not family_words:
        family_words, given_words = given_words, []
    if not family_words:
        return None
    if given_words and len(given_words[0]) <= 3 and given_words[0].isupper():  # initials, joined or apart
        given_words = [c for w in given_words for c in w]
    first = given_words[0].lower() if given_words else ""
    return " ".join(family_words).lower(), SHORT.get(first, first), "".join(w[0].lower() for w in given_words[1:])


def parse_periodical(spelling: str) -> tuple[str, str, str] | None:
    """(words, '', ''): the words that carry the name, without additions. None without a word."""
    text = spelling
    while (shorter := ADDITIONS.sub("", text)) != text:
        text = shorter
    if turned := _INVERTED.match(text):  # "Topic, Bulletin of" for "Bulletin of Topic"
        text = f"{turned['head']} {turned['topic']}{turned['rest'] or ''}"
    words = [w for w in re.findall(r"[^\W_]+", plain(text).lower()) if w not in EMPTY_WORDS]
    return (" ".join(words), "", "") if words else None


def _same_word(a: str, b: str) -> bool:
    short = min(len(a), len(b))
    return a == b or edit_distance(a, b, 2) <= (0 if short < 4 else 1 if short < 7 else 2)


def _same_family(a: str, b: str) -> bool:
    """Whether two family names are one but for slips, blanks and hyphens apart ('de la' and 'dela')."""
    x, y = a.split(), b.split()
    return _same_word("".join(x), "".join(y)) or (len(x) == len(y) and all(_same_word(p, q) for p, q in zip(x, y, strict=True)))


def _near_word(a: str, b: str) -> bool:
    """Two slips of one word may be two edits apart."""
    return min(len(a), len(b)) >= 5 and edit_distance(a, b, 2) <= 2


def given_likeness(a: tuple[str, str], b: tuple[str, str]) -> float:
    """Likeness of (first, middle) of two people with like family names; 0 if they can't be one."""
    (f, m), (g, n) = a, b
    if m and n and m != n and not (m.startswith(n) or n.startswith(m)):
        return 0.0
    if not f or not g:
        return 0.3
    if len(f) == 1 or len(g) == 1:
        own = f[0] == g[0]
        return 0.8 if own else 0.7 if f in INITIALS.get(g, ()) or g in INITIALS.get(f, ()) else 0.0
    return 1.0 if f == g else 0.9 if _same_word(f, g) else 0.6 if _near_word(f, g) else 0.0


def periodical_likeness(a: str, b: str) -> float:
    """1 less a little for every word that is abbreviated or misspelt; 0 if a word is another one or missing."""
    x, y = a.split(), b.split()
    if len(x) != len(y):
        return 0.0
    off = 0.0
    for p, q in zip(x, y, strict=True):
        if p == q:
            continue
        short, long = sorted((p, q), key=len)
        if any(c.isdigit() for c in p + q) or len(p) == len(q) == 1:
            return 0.0
        if _same_word(p, q) or (len(short) < len(long) and long.startswith(short) and len(x) > 1):
            off += 1
        elif _near_word(p, q):
            off += 1.5
        else:
            return 0.0
    return 1.0 - 0.3 * off / len(x)


def grams(name: str) -> list[str]:
    text = f" {name} "
    return sorted({text[i : i + n] for n in GRAMS for i in range(len(text) - n + 1)} - {" "})


def classes_of(spellings: DataFrame) -> DataFrame:
    """(field, name) -> (field, name, n, class, base, first, middle, initials, grams) of distinct spellings that can be
    parsed; n is how often the spelling occurs, initials are those of the given name and its short forms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for field, name, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = (parse_person if field == "authors" else parse_periodical)(name)
                if parts:
                    out.append((field, name, n, *parts, INITIALS.get(parts[1], [*parts[1][:1]]), grams(parts[0].replace(" ", "") if field == "authors" else parts[0])))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["field", "name", "n", "base", "first", "middle", "initials", "grams"])

    parsed = spellings.groupBy("field", "name").agg(F.count("*").alias("n")).mapInArrow(run, "field string, name string, n bigint, base string, first string, middle string, initials array<string>, grams array<string>")
    return parsed.withColumn("class", F.xxhash64("field", "base", "first", "middle"))


def vectors(classes: DataFrame) -> DataFrame:
    """(class, ..., terms, prefix): unit vectors as arrays of (gram, weight), rarest gram first, and the shortest
    prefix of grams without which no vector can reach MIN_COSINE with this one."""
    exploded = classes.select("class", "field", F.explode("grams").alias("gram"))
    total = classes.groupBy("field").agg(F.count("*").alias("total"))
    rarity = exploded.groupBy("field", "gram").agg(F.count("*").alias("df")).join(total, "field").select("field", "gram", (F.log((F.col("total") + 1) / F.col("df")) + 0.1).alias("idf"))
    weighted = exploded.join(rarity, ["field", "gram"]).groupBy("class").agg(F.sort_array(F.collect_list(F.struct((-F.col("idf")).alias("neg"), "gram"))).alias("own"))  # one name's grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, terms, prefixes = [], [], []
            for key, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                norm = sum(t["neg"] ** 2 for t in own) ** 0.5
                unit = [(t["gram"], -t["neg"] / norm) for t in own]
                rest, n = 1.0, 0
                while n < len(unit) and rest >= MIN_COSINE**2 - 1e-9:
                    rest -= unit[n][1] ** 2
                    n += 1
                keys.append(key)
                terms.append([{"gram": g, "w": w} for g, w in unit])
                prefixes.append([g for g, _ in unit[:n]])
            kind = pa.list_(pa.struct([("gram", pa.string()), ("w", pa.float64())]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(terms, kind), pa.array(prefixes, pa.list_(pa.string()))], names=["class", "terms", "prefix"])

    made = weighted.mapInArrow(run, "class bigint, terms array<struct<gram:string,w:double>>, prefix array<string>")
    return classes.drop("grams").join(made, "class")


def _tags() -> F.Column:
    """What two classes must share besides a gram. Periodicals: nothing. People: an initial of the given name, or its ending; who
    has no given name shares every initial (``every``, an array of those that occur)."""
    first = F.col("first")
    ending = F.when(F.length(first) >= ENDING_FROM, F.concat(F.lit("e"), F.substring(first, -2, 2)))
    marked = lambda c: F.transform(c, lambda x: F.concat(F.lit("i"), x))
    own = F.when(first == "", F.array_append(marked("every"), "i")).otherwise(F.array_compact(F.array_append(marked("initials"), ending)))
    return F.when(F.col("field") == "authors", own).otherwise(F.array(F.lit("")))


def links(vecs: DataFrame) -> DataFrame:
    """(a, b, likeness) of classes that may be one entity. The join is on prefix grams (no pair with the cosine is
    lost) and, for people, on the given name's initial or ending. Cheap tests come first, in generated code where two rows meet, so that the many pairs
    of common grams are never written, then those of words in Arrow batches; vectors are only fetched for the few pairs that pass both."""
    # initials are letters, so the set is as small as the alphabets in use
    every = vecs.filter("field = 'authors'").select(F.explode("initials").alias("x")).agg(F.coalesce(F.collect_set("x"), F.array().cast("array<string>")).alias("every"))
    tagged = vecs.select("class", "field", "base", "first", "initials", "prefix").crossJoin(F.broadcast(every))  # one row
    tags = tagged.select("class", "field", "base", F.explode(_tags()).alias("tag"), "prefix")
    keyed = tags.select("class", "field", "base", "tag", F.explode("prefix").alias("gram")).select("class", "field", "base", F.xxhash64("field", "gram", "tag").alias("key"))

    def near(x: str, y: str) -> Column:
        words = [F.size(F.split(f"base{s}", " ")) for s in (x, y)]
        people = F.levenshtein(*[F.replace(f"base{s}", F.lit(" "), F.lit("")) for s in (x, y)], FAMILY_EDITS) >= 0
        return (F.col(f"field{x}") == F.col(f"field{y}")) & F.when(F.col(f"field{x}") == "authors", people | (words[0] == words[1]) & (words[0] > 1)).otherwise(words[0] == words[1])

    pairs = key_pairs(keyed, "key", "class", carry=("field", "base"), keep=near)
    side = ["class", "field", "base", "first", "middle"]
    left = vecs.select(*[F.col(c).alias(f"{c}_a") for c in side])
    right = vecs.select(*[F.col(c).alias(f"{c}_b") for c in side])
    full = pairs.join(left, F.col("a") == F.col("class_a")).join(right, F.col("b") == F.col("class_b")).drop("class_a", "class_b", "field_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, field, base_a, first_a, middle_a, base_b, first_b, middle_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if field == "authors":
                    agree = given_likeness((first_a, middle_a), (first_b, middle_b))
                    agree = agree if agree and _same_family(base_a, base_b) else 0.0
                else:
                    agree = periodical_likeness(base_a, base_b)
                if agree:
                    out.append((a, b, agree))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.float64())], names=["a", "b", "agree"])

    columns = ["a", "b", "field_a", "base_a", "first_a", "middle_a", "base_b", "first_b", "middle_b"]
    likely = stage(full.select(*columns).mapInArrow(run, "a bigint, b bigint, agree double"))
    terms = vecs.select("class", F.map_from_entries("terms").alias("terms"))
    both = likely.join(terms.withColumnsRenamed({"class": "a", "terms": "ta"}), "a").join(terms.withColumnsRenamed({"class": "b", "terms": "tb"}), "b")
    cosine = F.aggregate(F.map_entries("tb"), F.lit(0.0), lambda s, t: s + t["value"] * F.coalesce(F.try_element_at("ta", t["key"]), F.lit(0.0)))
    return both.select("a", "b", "agree", cosine.alias("cosine")).filter(F.col("cosine") >= MIN_COSINE).select("a", "b", ((F.col("cosine") + 2 * F.col("agree")) / 3).alias("likeness"))


def average_linkage(found: DataFrame, counts: DataFrame, least: float = MIN_LINKAGE, rounds: int | None = None) -> DataFrame:
    """(class, group) of every class with a link. Groups merge while their average likeness is at least ``least``:
    the average over all pairs of occurrences (``counts``: class, n), pairs without a link counting as 0. Mutual best neighbours merge together in a round, which gives the same
    groups as one merge at a time, as average linkage is reducible; ties go to the smaller ids. Rounds go on until
    none merges; each round with a merge leaves fewer groups, so they end. If ``rounds`` is given and runs out, it raises."""
    weighed = found.join(counts.select(F.col("class").alias("a"), F.col("n").alias("na")), "a").join(counts.select(F.col("class").alias("b"), F.col("n").alias("nb")), "b")
    edges = cut(weighed.select("a", "b", (F.col("likeness") * F.col("na") * F.col("nb")).alias("s")))
    linked = edges.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    groups = cut(linked.join(counts, "class").select("class", F.col("class").alias("group"), "n"))
    for done in itertools.count():
        sizes = groups.groupBy("group").agg(F.sum("n").alias("n"))
        scored = edges.join(sizes.select(F.col("group").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("group").alias("b"), F.col("n").alias("nb")), "b")
        scored = scored.select("a", "b", F.round(F.col("s") / (F.col("na") * F.col("nb")), 9).alias("avg")).filter(F.col("avg") >= least)
        rank = F.struct("avg", (-F.col("a")).alias("x"), (-F.col("b")).alias("y"))
        ends = scored.select("a", "b", rank.alias("rank"), F.explode(F.array("a", "b")).alias("g"))
        best = ends.groupBy("g").agg(F.max("rank").alias("rank"))
        merges = cut(best.groupBy("rank").agg(F.count("*").alias("sides")).filter("sides = 2").select((-F.col("rank.x")).alias("keep"), (-F.col("rank.y")).alias("gone")))
        if merges.isEmpty():
            break
        if done == rounds:
            raise RuntimeError(f"groups still merge after {rounds} rounds")
        to = merges.select(F.col("gone").alias("group"), "keep")
        groups = cut(groups.join(to, "group", "left").select("class", F.coalesce("keep", "group").alias("group"), "n"))
        new = edges.join(merges.select(F.col("gone").alias("a"), F.col("keep").alias("ka")), "a", "left").join(merges.select(F.col("gone").alias("b"), F.col("keep").alias("kb")), "b", "left")
        new = new.select(F.coalesce("ka", "a").alias("p"), F.coalesce("kb", "b").alias("q"), "s").filter("p <> q")
        edges = cut(new.groupBy(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).agg(F.sum("s").alias("s")))
    return groups


def entities(spellings: DataFrame) -> DataFrame:
    """(field, name, entity): every distinct spelling with its entity, a hash. ``spellings``: (field, name).

    Null and blank names, and names without a letter, are no spellings; repeated rows count once.
    """
    parsed = stage(classes_of(spellings.filter("name IS NOT NULL AND trim(name) <> ''")))
    classes = parsed.select("field", "class", "base", "first", "middle", "initials", "grams").dropDuplicates(["class"])
    vecs = stage(vectors(classes))
    groups = average_linkage(stage(links(vecs)), parsed.groupBy("class").agg(F.sum("n").alias("n"))).select("class", "group")
    return parsed.select("field", "name", "class").join(groups, "class", "left").select("field", "name", F.coalesce("group", "class").alias("entity"))


def spelling_pairs(found: DataFrame) -> DataFrame:
    """(field, name_a, name_b), name_a < name_b by code point: pairs of spellings of one entity."""
    keyed = found.select("field", "name", F.xxhash64("field", "entity").alias("key"))
    ids = keyed.withColumn("id", F.xxhash64("field", "name"))
    pairs = key_pairs(ids, "key", "id")
    names = ids.select("id", "field", "name")
    both = pairs.join(names.withColumnsRenamed({"id": "a", "name": "x"}), "a").join(names.select(F.col("id").alias("b"), F.col("name").alias("y")), "b")
    return both.select("field", F.least("x", "y").alias("name_a"), F.greatest("x", "y").alias("name_b"))
