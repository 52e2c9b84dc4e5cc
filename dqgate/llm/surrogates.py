r"""Surrogates for personal data.

Entities are found by pattern, reduced to a canonical form (digits of a phone number, an
address in lower case, a name with its gender), and each distinct entity of the corpus gets
one keyed surrogate of the same type: digits for digits, letters for letters, a valid
number where the original is valid, a name of the same gender and script. So all mentions
of an entity stay recognizable as one. Entities whose surrogates collide with each
other, or with an entity that really occurs, draw again until none does: different
entities stay different. Names and addresses get longer with each draw. Phone and social security
numbers can't: where a quarter or more of the numbers of one type, length and first digit occur, these are
moved by a keyed permutation of all such numbers that leaves none in place. Its results are
distinct without a redraw, but may be numbers that occur elsewhere. A mention takes the
surrogate in its own notation.

Defined results: a null or empty text has no entities and stays as it is. Documents without
entities pass unchanged. Repeated rows are treated alike. Only `doc_id` and `text` are read
or changed, and `n_chars` if present.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqgate.llm.common import let, written

# A deployment brings its own key.
KEY = "surrogate-key"
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Señora", "г-жа")
MALE = ("Mr", "Herr", "Señor", "г-н")
NEUTRAL = ("Dr", "Prof")
_TITLES = "|".join((*FEMALE, *MALE, *NEUTRAL))
# A part of a name: several letters, or fewer with more behind a hyphen or apostrophe.
_PART = r"\p{Lu}(?:[\p{Ll}\p{Lu}]+|(?=[\-'’]\p{Lu}))(?:[\-'’]\p{Lu}[\p{Ll}\p{Lu}]+)*"
# In order of precedence where they begin at one place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?|\([0-9]{2,4}\)[ .\-]?)[0-9]{2,4}(?:[ .\-]?[0-9]{2,5}){1,4}(?![0-9])",
    "card": r"(?<![0-9A-Za-z.])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3})(?![0-9A-Za-z])",
    "credential": r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,64}(?![0-9A-Za-z])",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? {_PART}(?: {_PART}){{0,2}}",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_DIGITS = ("ssn", "phone", "card")
_LOWER = "abcdefghijklmnopqrstuvwxyz"
# Syllables of made names, and what ends a female one.
_SYLLABLES = {
    "latin": ("ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "tu", "va", "ke", "li", "no", "ra", "mi"),
    "cyrillic": ("ба", "де", "фи", "го", "лу", "ма", "не", "ри", "со", "ту", "ва", "ке", "ли", "но", "ра", "ми"),
}
_ENDS = {"latin": ("lia", "ron"), "cyrillic": ("лия", "рон")}


def _type_of(mention: Column) -> Column:
    kinds = list(PATTERNS)
    found = F.when(mention.rlike(f"^(?:{PATTERNS[kinds[0]]})$"), kinds[0])
    for kind in kinds[1:]:
        found = found.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return found


_NAME = rf"^({_TITLES})(\.? )(.*)$"


def _canonical(kind: Column, mention: Column) -> Column:
    title, name = F.regexp_extract(mention, _NAME, 1), F.regexp_extract(mention, _NAME, 3)
    gender = F.when(title.isin(*FEMALE), "f").when(title.isin(*MALE), "m").otherwise("n")
    return (
        F.when(kind.isin(*_DIGITS), F.regexp_replace(mention, "[^0-9]", ""))
        .when(kind == "person", F.concat(gender, F.lit("|"), F.lower(name)))
        .otherwise(F.lower(mention))
    )


def mentions(docs: DataFrame) -> DataFrame:
    """`(doc_id, digest, pos, type, mention, canon)`; pos counts a document's mentions."""
    found = docs.where(may_hold(F.col("text"))).select(
        "doc_id", F.xxhash64("text").alias("digest"), F.posexplode(F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))).alias("pos", "mention")
    )
    typed = found.withColumn("type", _type_of(F.col("mention")))
    return typed.select("doc_id", "digest", "pos", "type", "mention", _canonical(F.col("type"), F.col("mention")).alias("canon"))


def may_hold(text: Column) -> Column:
    """A cheap necessary condition for any entity."""
    return text.rlike("[0-9@]") | reduce(or_, [text.contains(f"{t}{end}") for t in (*FEMALE, *MALE, *NEUTRAL) for end in (" ", ".")])


# ---- surrogates of canonical forms -------------------------------------------


def _bytes(kind: Column, canon: Column, attempt: Column) -> Column:
    """Keyed pseudorandom numbers 0..255, at least one per character and eight."""
    seed = lambda k: F.sha2(F.concat_ws("\x00", F.lit(KEY), kind, canon, attempt.cast("string"), k.cast("string")).cast("binary"), 256)
    rounds = F.sequence(F.lit(0), F.floor((F.length(canon) + 8) / 32).cast("int"))
    text = F.array_join(F.transform(rounds, seed), "")
    at = lambda t: F.transform(
        F.sequence(F.lit(0), (F.length(t) / 2).cast("int") - 1),
        lambda i: F.conv(F.substring(t, i * 2 + 1, F.lit(2)), 16, 10).cast("int"),
    )
    return let(text, at)


def _drawn_char(c: Column, b: Column) -> Column:
    pick = lambda letters: F.substring(F.lit(letters), F.pmod(b, F.lit(len(letters))) + 1, F.lit(1))
    return (
        F.when(c.rlike("[0-9]"), pick("0123456789"))
        .when(c.rlike("[a-z]"), pick(_LOWER))
        .when(c.rlike("[\\p{IsCyrillic}]"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
        .when(c.rlike("\\p{L}"), pick(_LOWER))
        .otherwise(c)
    )


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _redrawn(text: Column, rnd: Column, keep_first: int = 0) -> Column:
    new = lambda c, i: F.when(i < keep_first, c).otherwise(_drawn_char(c, F.get(rnd, i)))
    return F.array_join(F.transform(_chars(text), new), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a number whose check digit is still to be appended."""
    def add(acc: Column, d: Column) -> Column:
        v = F.when(acc["twice"], d * 2).otherwise(d)
        return F.struct((acc["sum"] + F.when(v > 9, v - 9).otherwise(v)).alias("sum"), (~acc["twice"]).alias("twice"))

    values = F.transform(F.reverse(_chars(digits)), lambda c: c.cast("int"))
    zero = F.struct(F.lit(0).alias("sum"), F.lit(True).alias("twice"))
    return F.aggregate(values, zero, add, lambda acc: acc["sum"])


def _check_digit(body: Column) -> Column:
    return F.pmod(10 - F.pmod(_luhn_sum(body), F.lit(10)), F.lit(10)).cast("string")


def _card(canon: Column, rnd: Column) -> Column:
    body = F.expr("substring(canon, 1, length(canon) - 1)")
    valid = F.substring(canon, -1, 1) == _check_digit(body)
    drawn = _redrawn(body, rnd, keep_first=1)
    free = F.substring(F.lit("0123456789"), F.pmod(F.get(rnd, F.length(canon)), F.lit(10)) + 1, F.lit(1))
    return let(drawn, lambda d: F.concat(d, F.when(valid, _check_digit(d)).otherwise(free)))


def _person(canon: Column, rnd: Column) -> Column:
    name = F.expr("substring(canon, 3)")
    cyrillic = name.rlike("\\p{IsCyrillic}")

    def made(script: str) -> Column:
        syllables = F.array(*map(F.lit, _SYLLABLES[script]))
        female, male = _ENDS[script]
        end = F.when(F.substring(canon, 1, 1) == "f", female).when(F.substring(canon, 1, 1) == "m", male).otherwise("")
        # A draw has a syllable more than the one before, so there are more names than entities at last.
        n_each = F.col("attempt") + 4
        syllable = lambda i, k: F.get(syllables, F.pmod(F.get(rnd, F.pmod(i * n_each + k, F.size(rnd))), F.lit(16)))
        word = lambda i: F.array_join(F.transform(F.sequence(F.lit(0), n_each - 1), lambda k: syllable(i, k)), "")
        n = F.size(F.split(name, " "))
        return F.array_join(
            F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(word(i), F.when(i == 0, end).otherwise(""))), " "
        )

    surrogate = F.when(cyrillic, made("cyrillic")).otherwise(made("latin"))
    return F.concat(F.substring(canon, 1, 2), surrogate)


def _surrogate() -> Column:
    kind, canon = F.col("type"), F.col("canon")

    def drawn(rnd: Column) -> Column:
        tld = F.regexp_extract(canon, r"\.\p{L}{2,}$", 0)
        front = F.expr("regexp_replace(canon, '[.]\\\\p{L}{2,}$', '')")
        octet = lambda k: (F.pmod(F.get(rnd, F.lit(k)), F.lit(254)) + 1).cast("string")
        hexed = F.array_join(
            F.transform(_chars(canon), lambda c, i: F.substring(F.lit("0123456789abcdef"), F.pmod(F.get(rnd, i), F.lit(16)) + 1, F.lit(1))), ""
        )
        # Like a name, an address gets longer with each draw.
        letter = lambda k: F.substring(F.lit(_LOWER), F.pmod(F.get(rnd, F.pmod(-k, F.size(rnd))), F.lit(26)) + 1, F.lit(1))
        more = F.filter(F.sequence(F.lit(0), F.col("attempt")), lambda k: k > 0)
        longer = F.array_join(F.transform(more, letter), "")
        return (
            F.when(kind == "email", F.concat(longer, _redrawn(front, rnd), tld))
            .when(kind == "ip", F.concat_ws(".", *[octet(k) for k in range(4)]))
            .when(kind == "card", _card(canon, rnd))
            .when(kind.isin("phone", "ssn"), _redrawn(canon, rnd, keep_first=1))
            .when(kind == "credential", hexed)
            .otherwise(_person(canon, rnd))
        )

    return let(_bytes(kind, canon, F.col("attempt")), drawn)


# Types whose surrogates can't grow, and the share of all numbers from which they are permuted.
_FIXED = ("phone", "ssn")
_DENSE = 0.25


def _moved(canon: Column, kind: Column) -> Column:
    """The number behind the first digit, one step on in a keyed cycle through all of its length.

    Halves of the digits are shifted by a hash of each other in turn, the outcome is raised by
    one, and the shifts are taken back: a permutation of one single cycle.
    """
    k = F.length(canon) - 1
    power = lambda e: F.pow(F.lit(10.0), e).cast("long")
    a, b = power(F.floor(k / 2)), power(F.ceil(k / 2))
    shift = lambda x, i: F.xxhash64(F.lit(KEY), kind, F.length(canon), F.substring(canon, 1, 1), F.lit(i), x)

    def turn(s: Column, i: int, back: bool) -> Column:
        sign = -1 if back else 1
        left, right = s["l"], s["r"]
        if i % 2:
            left = F.pmod(left + sign * F.pmod(shift(right, i), a), a)
        else:
            right = F.pmod(right + sign * F.pmod(shift(left, i), b), b)
        return F.struct(left.alias("l"), right.alias("r"))

    def turns(s: Column, order: tuple[int, ...], back: bool) -> Column:
        if not order:
            return s
        return let(turn(s, order[0], back), lambda t: turns(t, order[1:], back))

    def halves(x: Column) -> Column:
        return F.struct(F.pmod(x, a).alias("l"), F.floor(x / a).cast("long").alias("r"))

    whole = lambda s: s["r"] * a + s["l"]
    number = F.expr("cast(substring(canon, 2) as long)")
    there = let(turns(halves(number), (1, 2, 3, 4), False), lambda s: F.pmod(whole(s) + 1, a * b))
    back = let(there, lambda x: turns(halves(x), (4, 3, 2, 1), True))
    return F.concat(F.substring(canon, 1, 1), let(back, lambda s: F.lpad(whole(s).cast("string"), k, "0")))


def _crowded(entities: DataFrame) -> DataFrame:
    """`(type, length, lead)` of the fixed types that hold too many numbers to draw among."""
    group = entities.where(F.col("type").isin(*_FIXED) & F.col("canon").rlike("^[0-9]{2,18}$")).groupBy(
        "type", F.length("canon").alias("length"), F.substring("canon", 1, 1).alias("lead")
    )
    return group.count().where(F.col("count") >= _DENSE * F.pow(F.lit(10.0), F.col("length") - 1)).drop("count")


def surrogate_table(entities: DataFrame, draw: Column | None = None) -> DataFrame:
    """`(type, canon, surrogate)` for distinct `(type, canon)`, all surrogates distinct and unused.

    Of entities that collide the one with the smallest canonical form keeps its surrogate;
    the others, and those whose surrogate is itself an entity, draw again. Numbers that crowd
    their space are permuted instead. `draw` may give another surrogate from `type`, `canon`
    and `attempt`.
    """
    if draw is None:
        draw = _surrogate()
        entities = written(entities.select("type", "canon").distinct(), "entities")
        # At most one row per type, length up to 18 and digit.
        crowded = F.broadcast(_crowded(entities))
        same = ["type", "length", "lead"]
        keyed = entities.withColumn("length", F.length("canon")).withColumn("lead", F.substring("canon", 1, 1))
        moved = keyed.join(crowded, same).select("type", "canon", _moved(F.col("canon"), F.col("type")).alias("surrogate"))
        rest = keyed.join(crowded, same, "left_anti").select("type", "canon")
        return surrogate_table(rest, draw).unionByName(moved)
    now = written(entities.select("type", "canon").distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", draw), "surrogates")
    real = now.select("type", F.col("canon").alias("surrogate"))
    while True:
        first = now.groupBy("type", "surrogate").agg(F.min("canon").alias("keeper"), F.count("*").alias("n"))
        shared = first.where("n > 1").select("type", "surrogate", "keeper")
        used = now.join(real, ["type", "surrogate"], "left_semi").select("type", "surrogate").distinct()
        bad = shared.unionByName(used.withColumn("keeper", F.lit(None).cast("string")))
        bad = written(bad.groupBy("type", "surrogate").agg(F.min(F.struct(F.col("keeper").isNotNull(), "keeper"))["keeper"].alias("keeper")), "clashes")
        if bad.isEmpty():
            return now.select("type", "canon", "surrogate")
        marked = now.join(bad.withColumn("bad", F.lit(True)), ["type", "surrogate"], "left")
        again = F.coalesce(F.col("bad") & ~F.coalesce(F.col("canon") == F.col("keeper"), F.lit(False)), F.lit(False))
        moved = marked.select("type", "canon", (F.col("attempt") + again.cast("int")).alias("attempt"), again.alias("again"), F.col("surrogate").alias("old"))
        now = written(moved.withColumn("surrogate", F.when(F.col("again"), draw).otherwise(F.col("old"))).drop("again", "old"), "surrogates")


# ---- back into the text ------------------------------------------------------


def _in_notation(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate as the mention writes its entity."""

    def filled(acc: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(acc["out"], F.when(digit, F.substring(surrogate, acc["k"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["k"] + digit.cast("int")).alias("k"),
        )

    zero = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    digits = F.aggregate(_chars(mention), zero, filled, lambda acc: acc["out"])
    cased = F.array_join(
        F.zip_with(_chars(mention), _chars(surrogate), lambda m, s: F.when((m == F.upper(m)) & (m != F.lower(m)), F.upper(s)).otherwise(s)), ""
    )
    name = F.regexp_extract(mention, _NAME, 3)
    bare = F.expr("substring(surrogate, 3)")
    person = F.concat(
        F.regexp_extract(mention, _NAME, 1), F.regexp_extract(mention, _NAME, 2), F.when(name == F.upper(name), F.upper(bare)).otherwise(F.initcap(bare))
    )
    return F.when(kind.isin(*_DIGITS), digits).when(kind == "person", person).when(kind == "ip", surrogate).otherwise(cased)


def replace_entities(docs: DataFrame) -> DataFrame:
    """`docs` with all entities replaced, and `n_entities`; other columns as given."""
    found = written(mentions(docs), "mentions")
    table = surrogate_table(found)
    new = found.join(table, ["type", "canon"]).select(
        "doc_id", "digest", "pos", _in_notation(F.col("type"), F.col("mention"), F.col("surrogate")).alias("new")
    )
    per_doc = written(new.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set(F.struct("pos", "new")))["new"].alias("new")), "replacements")
    per_doc = per_doc.withColumnsRenamed({"doc_id": "i", "digest": "d"})
    packed = docs.select(F.struct("*").alias("doc"), "doc_id", F.xxhash64("text").alias("digest"), F.coalesce(may_hold(F.col("text")), F.lit(False)).alias("some"))
    same = packed["doc_id"].eqNullSafe(per_doc["i"]) & (packed["digest"] == per_doc["d"])
    joined = packed.where("some").join(per_doc, same, "left").select("doc", "new")
    text = F.array_join(
        F.flatten(F.zip_with(F.split("doc.text", _ANY), F.col("new"), lambda piece, n: F.array(piece, F.coalesce(n, F.lit(""))))), ""
    )
    done = joined.select("doc", F.when(F.col("new").isNull(), F.col("doc.text")).otherwise(text).alias("text"), F.coalesce(F.size("new"), F.lit(0)).alias("n"))
    rest = packed.where("NOT some").select("doc", F.col("doc.text").alias("text"), F.lit(0).alias("n"))
    fresh = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    columns = [fresh.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns if c != "n_entities"]
    return done.unionByName(rest).select(*columns, F.col("n").cast("long").alias("n_entities"))
