"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is any run of at least `MIN_LENGTH` key characters inside a word, holding a digit
or at least `LONG` characters; a word may hold several. Three or more long parts joined by
dots are one run. What is assigned to a name such as password or token is a candidate from
`SHORT` characters on if it has a letter and a digit, whatever its other characters. The forest sees its length, changes between kinds of
characters, how much of it a dictionary covers, whether it lies in a path, and the words
around it. It is trained on all labelled findings, plus a few made examples, so both labels
always occur. The dictionary, the `MAX_WORDS` most frequent words, is counted over all documents.

Where no labels are given, findings label themselves where the case is plain: a mixed
value assigned to a name such as token or password is a secret; plain numbers, plain
words and parts of addresses are not. All others are left to the forest.

Defined results: a null or empty text has no candidates. Repeated rows and repeated values
are findings of their own. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate.llm.common import let, words, written

MIN_LENGTH, LONG = 16, 24
CANDIDATE = rf"(?:[A-Za-z0-9_\-]{{10,}}\.){{2,}}[A-Za-z0-9_\-]{{10,}}|[A-Za-z0-9_+/=\-]{{{MIN_LENGTH},}}"
# Stands in every candidate that is a run, and is found fast.
_LONG_RUN = rf"[A-Za-z0-9_+/=.\-]{{{MIN_LENGTH}}}"
_WORTH = rf"(?=[A-Za-z_+/=\-]*[0-9]|.{{{LONG},}}).*"
NAMES = "token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer"
# Names whose values are candidates at any length from SHORT on, alone and as assigned in a word.
SHORT = 6
_KEYED = "(?i)(?:token|secret|passw|passphrase|pwd|api.?key|access.?key|private.?key|auth(?!or)|credential)[A-Za-z0-9_.\\-]*[\"']?"
_SIGN = "(?:=>|:=|={1,3}|:)[\"'`]?"
_SHORT_VALUE = rf"""([^\s"'`,;<>(){{}}\[\]=:][^\s"'`,;<>(){{}}\[\]]{{{SHORT - 2},}}[^\s"'`,;<>(){{}}\[\].?])"""
MAX_WORDS = 200
# Findings for each task that the forest is trained in.
TRAINED = 20_000
TREES, DEPTH, SEED = 20, 6, 7
MASK = "[SECRET]"
# A name in the word itself and the sign after it.
_IN_WORD = r"""(?:^|["'{\[,;&?(])[A-Za-z_.\-]+["']?[=:]"""
FEATURES = (
    "length", "kinds", "changes", "digits", "distinct", "vowel_runs", "covered", "path", "named", "assigned", "quoted",
)


def may_hold(text: Column) -> Column:
    """A cheap necessary condition for any candidate."""
    small = F.lower(text)
    named = reduce(or_, [small.contains(x) for x in ("token", "secret", "pass", "pwd", "key", "auth", "credential")])
    return text.rlike(_LONG_RUN) | (named & text.rlike("[=:]"))


def candidates(docs: DataFrame) -> DataFrame:
    """`(doc_id, digest, word_index, run_index, value, word, before, name, after)` per candidate.

    `word` is the word, or of one with several runs the part from the run before to the next.
    """

    def around(w: Column, i: Column) -> Column:
        near = lambda k: F.coalesce(F.when(i + k >= 0, F.get(w, i + k)), F.lit(""))
        return F.struct(
            i.alias("word_index"), F.get(w, i).alias("whole"), near(-1).alias("before"), near(-2).alias("name"), near(1).alias("after")
        )

    def found(w: Column) -> Column:
        # What a name's value needs is looked at in the second step.
        mixed = lambda x: (F.octet_length(x) >= SHORT) & x.rlike("[0-9]") & x.rlike("[A-Za-z]")
        sign = lambda x, i: x.rlike("[=:]") | F.coalesce(F.when(i > 0, F.get(w, i - 1)).rlike("[=:][\"'`]?$|^[=:]+>?$"), F.lit(False))
        run = lambda x: (F.octet_length(x) >= MIN_LENGTH) & x.rlike(_LONG_RUN)
        fits = lambda x, i: F.when(run(x) | (mixed(x) & sign(x, i)), i)
        hits = F.filter(F.transform(w, fits), lambda i: i.isNotNull())
        return F.transform(hits, lambda i: around(w, i))

    some = docs.where(may_hold(F.col("text")))
    near = some.select(
        F.col("doc_id"), F.xxhash64("text").alias("digest"), F.explode(let(words(F.col("text")), found)).alias("c")
    ).select("doc_id", "digest", "c.*")
    given = near.withColumns(
        {
            "runs": F.regexp_extract_all("whole", F.lit(CANDIDATE), F.lit(0)),
            "gaps": F.split("whole", CANDIDATE),
            "named_values": _named_values(),
        }
    )
    part = lambda k: F.concat(
        F.coalesce(F.when(k > 0, F.get("runs", k - 1)), F.lit("")), F.get("gaps", k), F.get("runs", k), F.get("gaps", k + 1)
    )
    runs = F.transform("runs", lambda v, k: F.struct(v.alias("value"), part(k).alias("word")))
    worth = F.filter(runs, lambda s: s["value"].rlike(f"^{_WORTH}$"))
    more = F.filter("named_values", lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~F.array_contains("runs", v))
    every = F.concat(worth, F.transform(more, lambda v: F.struct(v.alias("value"), F.col("whole").alias("word"))))
    return given.select(
        "doc_id", "digest", "word_index", F.posexplode(every).alias("run_index", "r"), "before", "name", "after"
    ).select("doc_id", "digest", "word_index", "run_index", "r.*", "before", "name", "after")


def _named_values() -> Column:
    """What the word assigns to names of secrets, or the words before assign to one."""
    inside = F.regexp_extract_all("whole", F.lit(f"{_KEYED}{_SIGN}{_SHORT_VALUE}"), F.lit(1))
    sign_before = F.col("before").rlike(f"{_KEYED}{_SIGN}$") | (F.col("before").rlike(f"^{_SIGN}$") & F.col("name").rlike(f"{_KEYED}$"))
    first = F.regexp_extract_all("whole", F.lit(f"""^["'`(]*{_SHORT_VALUE}"""), F.lit(1))
    return F.array_distinct(F.concat(inside, F.when(sign_before, first).otherwise(F.array().cast("array<string>"))))


def weak_labels(found: DataFrame) -> DataFrame:
    """`found` with `label` 1 or 0 where the case is plain, else null."""
    value = F.col("value")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    assigned = _assigned() & _named()
    plain = value.rlike("^[0-9]+$") | value.rlike("^[A-Za-z]+$") | F.col("word").rlike("@|://")
    return found.withColumn("label", F.when(assigned & mixed, 1.0).when(plain, 0.0))


def _assigned() -> Column:
    return F.col("before").rlike("^[=:]+>?$|[=:]$") | F.col("word").rlike(rf"""{_IN_WORD}["']?[A-Za-z0-9]""")


def _named() -> Column:
    return F.lower(F.concat_ws(" ", "name", "before", F.regexp_extract("word", _IN_WORD, 0))).rlike(NAMES)


def features(found: DataFrame, dictionary: list[str]) -> DataFrame:
    """`found` with the forest's inputs."""
    value, size = F.col("value"), F.length("value")
    share = lambda pattern: (size - F.length(F.regexp_replace(value, pattern, ""))) / size
    flag = lambda c: c.cast("double")
    known = F.lit(0.0)
    if dictionary:
        rest = F.regexp_replace(F.lower(value), "|".join(sorted(dictionary, key=lambda w: (-len(w), w))), "")
        known = (size - F.length(rest)) / size
    kinds = [flag(value.rlike(p)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")]
    return found.withColumns(
        {
            "length": size.cast("double"),
            "kinds": kinds[0] + kinds[1] + kinds[2] + kinds[3],
            "changes": F.regexp_count(value, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")) / size,
            "digits": share("[0-9]+"),
            "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.least(size, F.lit(40)),
            "vowel_runs": F.regexp_count(F.lower(value), F.lit("[aeiouy]+")) / size,
            "covered": known.cast("double"),
            "path": flag(F.col("word").rlike(r"[/\\].*[/\\]|\.[a-z]{2,4}$|://")),
            "named": flag(_named()),
            "assigned": flag(_assigned()),
            "quoted": flag(F.col("word").rlike("""["'`]""")),
        }
    )


def _made_examples(spark: SparkSession) -> DataFrame:
    """Secrets from digests in several contexts; numbers, paths and joined words as their opposite."""
    n = F.col("id")
    digest = F.sha2(n.cast("string").cast("binary"), 256)
    key = F.when(n % 3 == 0, F.substring(digest, 1, 40)).when(n % 3 == 1, F.substring(F.base64(digest), 1, 32)).otherwise(
        F.substring(digest, 1, 24)
    )
    said = F.when(n % 2 == 0, "token").otherwise("")
    good = spark.range(60).select(
        key.alias("value"),
        F.concat(F.lit('"'), key, F.lit('"')).alias("word"),
        F.when(n % 2 == 0, "=").otherwise("is").alias("before"),
        said.alias("name"),
        F.lit(1.0).alias("label"),
    )
    # Short values after a name, as people choose them.
    chosen = F.concat(F.substring(F.base64(F.unhex(digest)), 1, 3), F.lit("!"), F.substring(digest, 9, 6))
    short = spark.range(60).select(
        chosen.alias("value"), chosen.alias("word"), F.when(n % 2 == 0, "=").otherwise("password:").alias("before"),
        F.when(n % 2 == 0, "password").otherwise("").alias("name"), F.lit(1.0).alias("label"),
    )
    number = F.lpad(F.pmod(F.xxhash64("id"), F.lit(10**16)).cast("string"), 16, "7")
    joined = F.concat(*[F.element_at(F.array(*map(F.lit, ("tion", "ing", "the", "ment", "and"))), (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(5)) + 1).cast("int")) for k in range(7)])
    wrong = F.when(n % 3 == 0, number).when(n % 3 == 1, joined).otherwise(F.concat(F.lit("path/to/"), joined, F.lit("/2")))
    bad = spark.range(60).select(
        wrong.alias("value"), wrong.alias("word"), F.lit("of").alias("before"), F.lit("").alias("name"), F.lit(0.0).alias("label")
    )
    return good.unionByName(short).unionByName(bad)


def dictionary(docs: DataFrame) -> list[str]:
    """The most frequent plain words of all documents."""
    plain = docs.select(F.explode(words(F.col("text"))).alias("w")).where(F.col("w").rlike("^[a-z]{3,8}$"))
    return [r.w for r in plain.groupBy("w").count().orderBy(F.desc("count"), "w").limit(MAX_WORDS).collect()]


def train(docs: DataFrame, labelled: DataFrame) -> tuple[RandomForestClassificationModel, list[str]]:
    """The forest and its dictionary; `labelled` has the columns of `candidates` and `label`."""
    columns = ["value", "word", "before", "name", "label"]
    given = written(labelled.where("label IS NOT NULL").select(columns), "labelled")
    known = dictionary(docs)
    rows = features(given.unionByName(_made_examples(docs.sparkSession)), known)
    # The same rows in the same order for each task give the same forest in every run.
    dealt = rows.repartition(-(-(given.count() + 1) // TRAINED), *columns).sortWithinPartitions(*columns)
    inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(dealt).select("x", "label")
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt"
    )
    return forest.fit(inputs), known


def classify(found: DataFrame, model: RandomForestClassificationModel, known: list[str]) -> DataFrame:
    """`found` with the probability that it is a secret, and the verdict."""
    names = found.columns
    inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(features(found, known))
    model = model.copy().setFeaturesCol("x")
    p = vector_to_array(F.col("probability"))[1]
    judged = model.transform(inputs).select(*names, F.round(p, 6).alias("probability"))
    return judged.withColumn("is_secret", F.col("probability") >= 0.5)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of every document with its verdict."""
    found = written(candidates(docs), "candidates")
    model, known = train(docs, weak_labels(found) if labelled is None else labelled)
    return classify(found, model, known)


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every secret masked wherever it stands in its document but inside longer words; columns as given."""
    secrets = scan(docs).where("is_secret").groupBy("doc_id", "digest").agg(F.collect_set("value").alias("values"))
    secrets = written(secrets, "secrets").withColumnsRenamed({"doc_id": "i", "digest": "d"})
    packed = docs.select(F.struct("*").alias("doc"), "doc_id", F.xxhash64("text").alias("digest"), may_hold(F.col("text")).alias("some"))
    same = packed["doc_id"].eqNullSafe(secrets["i"]) & (packed["digest"] == secrets["d"])
    joined = packed.where("some").join(secrets, same, "left").select("doc", "values")
    # Longer values first: one may be part of another.
    longest = F.reverse(F.array_sort(F.transform("values", lambda v: F.struct(F.length(v).alias("n"), v.alias("v")))))
    # Not inside other words: every value stood between other characters than letters and digits.
    quoted = lambda v: F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), F.replace(v, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![A-Za-z0-9])"))
    masked = F.aggregate(longest, F.col("doc.text"), lambda t, s: F.regexp_replace(t, quoted(s["v"]), F.lit(MASK)))
    touched = F.col("values").isNotNull()
    fresh = {
        "text": F.when(touched, masked).otherwise(F.col("doc.text")),
        "n_chars": F.when(touched, F.length(masked).cast("long")).otherwise(F.col("doc.n_chars") if "n_chars" in docs.columns else F.lit(None)),
    }
    out = joined.select(*[fresh.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
    return out.unionByName(packed.where("some IS NULL OR NOT some").select("doc.*"))
