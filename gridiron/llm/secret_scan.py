"""Secret scan with a random forest against false positives, in DataFrame and ML pipeline functions only."""

from __future__ import annotations

import string

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridiron.llm.common import hash128, lower_ascii, others, unpack, written

#: Characters of keys, tokens, paths and words; names and long runs are looked for at the start of a run of these only.
RUN = r"[\w+/\-]"
NAME = r"(?i:token|key|secret|passw(?:or)?d|passwd|passphrase|pwd|credentials?|auth)"
OPERATOR = r"[\"']?[ \t]{0,4}(?:=>|:=|[=:])[ \t]{0,4}"
#: A run that ends with a name of secrets, and what follows it up to its value; whether an operator follows is looked up first.
ASSIGN = rf"(?<!{RUN})(?={RUN}++[\"']?[ \t]{{0,4}}[=:]){RUN}*?{NAME}[\w\-]{{0,16}}(?!{RUN}){OPERATOR}"
BEARER = r"(?i:bearer)[ \t]{1,4}"
VALUE = r"(?![ \t=:>]|(?i:bearer)[ \t])[^\s\"'<>,;]*[^\s\"'<>,;.)\]}]"
#: A candidate, with what goes before it: a value of any length and punctuation after a name of secrets (in quotes up to
#: the closing one) or after `Bearer`, a whole JWT, or sixteen or more characters of RUN, which `=` only ends.  Nothing is
#: tried behind a word's first character, and no group is repeated but possessively, so that neither time nor the
#: matcher's stack grow with the length of a run more than they must.
CANDIDATE = (
    r"(?:(?<!\w)|\G)(?:"
    rf"({ASSIGN})(?:([\"'])([^\"'\r\n]+)(?=[\"'])|([\"']?)({VALUE}))"
    rf"|({BEARER})({VALUE})"
    r"|(eyJ[\w\-]++(?:\.[\w\-]++)++"
    rf"|(?:\G|(?<!{RUN})){RUN}{{16,}}+(?:={{1,2}}(?!{RUN}))?))"
)
#: The groups of CANDIDATE before a value, and those of values.
BEFORE, VALUES = "$1$2$4$6", "$3$5$7$8"
LETTERS, DIGITS = string.ascii_lowercase, string.digits
NEAR = 48
NUMBERS = ["length", "changes", "digits", "uppers", "symbols", "distinct", "hex", "coverage", "likelihood", "in_path", "assigned", "quoted"]


def _parts(text: Column) -> Column:
    """The text in pieces, those at odd places its candidates: one pass that sets marks, and a split at the marks.

    The mark is a code point that is no character; a text that holds it gets one made from its own hash.
    """
    mark = F.when(F.contains(text, F.lit("\uffff")), F.concat(F.lit("\uffff"), F.sha1(text.cast("binary")))).otherwise(F.lit("\uffff"))
    return F.transform(
        F.array(mark),  # as a variable
        lambda m: F.split(F.regexp_replace(text, F.lit(CANDIDATE), F.concat(F.lit(BEFORE), m, F.lit(VALUES), m)), m),
    )[0]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, t1, t2, nth, value, before, after, path of every candidate in the whole texts."""
    text = F.coalesce("text", F.lit(""))
    path = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")

    def beside(parts: Column) -> Column:
        each = F.transform(
            parts,
            lambda x, i: F.struct(
                i.alias("at"),
                x.alias("value"),
                F.right(F.coalesce(F.get(parts, i - 1), F.lit("")), F.lit(NEAR)).alias("before"),
                F.left(F.coalesce(F.get(parts, i + 1), F.lit("")), F.lit(NEAR)).alias("after"),
            ),
        )
        return F.filter(each, lambda c: c["at"] % 2 == 1)

    found = F.transform(F.array(_parts(text)), beside)[0]  # the parts are a variable, made once
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *hash128(text, "t"), path.alias("path"), found.alias("found"))
    each = rows.select("doc_id", "t1", "t2", "path", F.explode("found").alias("c"))
    nth = F.floor((F.col("c.at") - 1) / 2).cast("int")
    return each.select(
        "doc_id", "t1", "t2", nth.alias("nth"), F.col("c.value").alias("value"), F.col("c.before").alias("before"),
        F.col("c.after").alias("after"), "path",
    )


def dictionary(docs: DataFrame, least_docs: int = 5) -> DataFrame:
    """word, n: lower-cased runs of three ASCII letters or more and the number of documents that have them, from all texts."""
    words = F.split(F.regexp_replace(lower_ascii(F.col("text")), "[^a-z]+", " "), " ")
    each = docs.where("text is not null").select(F.explode(F.array_distinct(words)).alias("word"))
    counted = each.where(F.length("word") >= 3).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_docs)


def transitions(words: DataFrame) -> DataFrame:
    """pair, weight: the log of how likely a letter follows another in the dictionary, at most 26 x 26 rows."""
    pairs = words.select("n", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("i"), "word")
    pairs = pairs.groupBy(F.substr("word", F.col("i"), F.lit(2)).alias("pair")).agg(F.sum("n").alias("n"))
    firsts = pairs.groupBy(F.left("pair", F.lit(1)).alias("one")).agg(F.sum("n").alias("all"))
    joined = pairs.join(firsts, F.left("pair", F.lit(1)) == F.col("one"))
    return joined.select("pair", F.log(F.col("n") / F.col("all")).alias("weight"))


def _classes(value: Column) -> Column:
    known = LETTERS + LETTERS.upper() + DIGITS + "_+/=-"
    return F.translate(value, known, "a" * 26 + "A" * 26 + "0" * 10 + "-" * 5)


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the numbers a forest looks at, and `near`, the neighbouring words and those of the path."""
    value, kinds = F.col("value"), _classes(F.col("value"))
    share = lambda part: F.length(F.regexp_replace(value, f"[^{part}]", "")) / F.length(value)
    lowered = lower_ascii(value)
    distinct = found.select(value, lowered.alias("lowered")).distinct()
    parts = distinct.select(
        "value", F.explode(F.array_remove(F.split(F.regexp_replace("lowered", "[^a-z]+", " "), " "), "")).alias("word")
    )
    covered = parts.join(words.select("word"), "word").groupBy("value").agg(F.sum(F.length("word")).alias("known"))
    runs = distinct.select(
        "value", "lowered", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("lowered") - 1))).alias("i")
    ).select("value", F.substr("lowered", F.col("i"), F.lit(2)).alias("pair"))
    likely = (
        runs.join(F.broadcast(transitions(words)), "pair", "left")  # at most 676 rows
        .groupBy("value")
        .agg(F.avg(F.coalesce("weight", F.lit(-12.0))).alias("likelihood"))
    )
    of_value = covered.select(F.col("value").alias("v1"), "known")
    of_pairs = likely.select(F.col("value").alias("v2"), "likelihood")
    joined = found.join(of_value, value == F.col("v1"), "left").join(of_pairs, value == F.col("v2"), "left")
    beside = F.lower(F.concat_ws(" ", "before", "after"))
    path_words = F.transform(
        F.array_remove(F.split(F.lower("path"), "[^a-z]+"), ""), lambda w: F.concat(F.lit("path:"), w)
    )
    near = F.concat(F.array_remove(F.split(F.regexp_replace(beside, r"[^\p{L}]+", " "), " "), ""), path_words)
    return joined.select(
        *found.columns,
        F.length(value).cast("double").alias("length"),
        (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1).cast("double").alias("changes"),
        share("0-9").alias("digits"),
        share("A-Z").alias("uppers"),
        share(r"_+/=\-").alias("symbols"),
        F.size(F.array_distinct(F.split(value, ""))).cast("double").alias("distinct"),
        share("0-9a-fA-F").alias("hex"),
        (F.coalesce("known", F.lit(0)) / F.length(value)).alias("coverage"),
        F.coalesce("likelihood", F.lit(-12.0)).alias("likelihood"),
        (F.col("value").contains("/") | F.col("before").rlike(r"[/.:]$")).cast("double").alias("in_path"),
        F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        (F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")).cast("double").alias("quoted"),
        near.alias("near"),
    )


def train(labelled: DataFrame, most: int = 20_000, trees: int = 20, seed: int = 7) -> PipelineModel:
    """Fits the forest to findings with features and a `label` of 0 or 1.

    Takes the `most` findings with the smallest hashes, half for each label, so that the
    sample is bounded and the same on each run.
    """
    pick = F.xxhash64("value", "before")
    sample = None
    for label in (0, 1):
        part = labelled.where(F.col("label") == label).orderBy(pick, "doc_id", "nth").limit(most // 2)
        sample = part if sample is None else sample.unionByName(part)
    stages = [
        HashingTF(inputCol="near", outputCol="near_counts", numFeatures=64),
        VectorAssembler(inputCols=[*NUMBERS, "near_counts"], outputCol="features"),
        RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=6, seed=seed),
    ]
    sample = written(sample.withColumn("label", F.col("label").cast("double")), "findings")
    return Pipeline(stages=stages).fit(sample)


def by_rule(found: DataFrame, keep_all: bool = False) -> DataFrame:
    """Weak labels where no findings are labelled by hand; no label looks at quotes.

    1: eight characters or more with a digit, assigned to a name such as token, key or
    secret or after `Bearer`, or a JWT; no URL.  0: none of these names stands before the
    value, and it has the shape of a URL or path, or no letters, or at least 0.8 of it are
    words of the dictionary.  Others stay out, or have a null label if all are kept.
    """
    value = F.col("value")
    named = F.col("before").rlike(rf"(?:{NAME}[\w\-]{{0,16}}{OPERATOR}[\"']?|(?<!\w){BEARER})$")
    token = value.rlike(r"^eyJ[A-Za-z0-9_\-]+\.")
    url = value.contains("://")
    path = url | (F.col("in_path") > 0) & value.rlike(r"^[/.]|[A-Za-z]{3,}/[A-Za-z]{2,}|/[a-z]{3,}")
    plain = path | ~value.rlike("[A-Za-z]") | (F.col("coverage") >= 0.8)
    secret = (token | named & (F.length(value) >= 8) & (F.col("digits") > 0)) & ~url
    label = F.when(secret, 1).when(~named & ~token & plain, 0)
    labelled = found.withColumn("label", label)
    return labelled if keep_all else labelled.where("label is not null")


def classify(found: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    scored = model.transform(found).withColumn("probability", vector_to_array("probability")[1])
    return scored.select(*found.columns, "probability", (F.col("probability") >= threshold).alias("is_secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Finds secrets in whole texts.

    Candidates are described by length, changes between kinds of characters, how likely
    their letters follow each other, the share covered by words of the corpus' dictionary,
    the path and the neighbouring words.  A random forest fitted to labelled findings
    (doc_id, nth, label, or also t1, t2 as returned) removes the false positives; without any, those that `by_rule`
    labels in documents with crc32(doc_id as text) mod 5 other than 0 are taken.

    Returns doc_id, nth (from 0 within the text), value, probability, is_secret, one row per
    candidate of each input row.  Null and empty texts have none; repeated rows give
    repeated findings; rows without doc_id are scanned but not learned from; without
    findings of both labels the rule's own label is the probability, and what it leaves
    unlabelled has probability null and is_secret false.
    """
    words = written(dictionary(docs), "dictionary")
    found = written(features(written(candidates(docs), "candidates"), words), "featured")
    if labelled is None:
        known = by_rule(found).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    else:
        place = [c for c in ("doc_id", "t1", "t2", "nth") if c in labelled.columns]  # with t1 and t2, texts of one doc_id are told apart
        known = found.join(labelled.select(*place, "label"), place)
    if known.where("label = 0").isEmpty() or known.where("label = 1").isEmpty():
        ruled = by_rule(found, keep_all=True).withColumn("probability", F.col("label").cast("double"))
        judged = ruled.withColumn("is_secret", F.coalesce(F.col("probability") >= threshold, F.lit(False)))
    else:
        judged = classify(found, train(known), threshold)
    return judged.select("doc_id", "t1", "t2", "nth", "value", "probability", "is_secret")


def redact(docs: DataFrame, findings: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The documents with the values of findings that are secrets replaced by `mask`."""
    secret = findings.where("is_secret").groupBy("doc_id", "t1", "t2").agg(F.collect_set("nth").alias("hits"))
    base = docs.select(
        others(docs, "doc_id", "text").alias("rest"),
        F.col("doc_id").alias("id"),
        "text",
        *hash128(F.coalesce("text", F.lit("")), "t"),
    )
    same = [base.id.cast("long") == secret.doc_id, base.t1 == secret.t1, base.t2 == secret.t2]
    joined = base.join(secret, same, "left").select(base["*"], "hits")
    hit = lambda i: (i % 2 == 1) & F.array_contains("hits", F.floor((i - 1) / 2).cast("int"))
    pieces = F.transform(_parts(F.col("text")), lambda x, i: F.when(hit(i), F.lit(mask)).otherwise(x))
    cleaned = F.when(F.col("hits").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    return unpack(joined, docs.columns, {"doc_id": F.col("id"), "text": cleaned})
