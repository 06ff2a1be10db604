"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of at least ``MIN_LENGTH`` characters of keys and tokens that holds a
digit. Its features are length, shares of digits and capitals, changes between kinds of
characters, distinct characters, cover by dictionary words, whether it is hexadecimal, a
path, quoted or assigned, and which words stand next to it. A forest trained on labelled
findings gives the probability of a secret; findings below ``threshold`` are
false positives.

Scanning is per row and DataFrame functions only; nothing is shuffled. ``labelled_texts``
makes training findings of fixed bounded size; a user's own labelled texts can take
their place.

Defined results: null and blank texts have no findings; a candidate that occurs several times
is found each time; rows that repeat and null ids are scanned like others; columns but id
and text are ignored. Texts of any length are scanned whole. No rows give no findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.llm.shared import table

MIN_LENGTH = 16
THRESHOLD = 0.5
TRAINING_TEXTS = 6000
_CANDIDATE = "([A-Za-z0-9+/_=.-]{%d,})" % MIN_LENGTH

# Words that a key or a token rarely spells.
DICTIONARY = (
    "access", "account", "and", "article", "backup", "build", "chapter", "client", "config", "data", "date", "document", "example",
    "file", "final", "for", "house", "image", "index", "ing", "introduction", "item", "local", "name", "order", "page", "part",
    "placeholder", "product", "project", "report", "section", "server", "service", "summary", "table", "test", "text", "the",
    "tion", "update", "user", "value", "version", "with", "your",
)
KEY_WORDS = "(?i)(token|secret|key|passw|pwd|auth|credential|bearer)"
DIGEST_WORDS = "(?i)(sha|md5|checksum|digest|commit|hash|revision|etag|uuid|trace)"
PLACEHOLDERS = "(?i)(example|test|dummy|changeme|xxxx|placeholder|your|sample)"


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per candidate: the columns ``keep``, position (word number), before, finding, near."""
    words = F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+")
    at = F.array_compact(F.transform("_words", lambda w, i: F.when(
        (F.length(w) >= MIN_LENGTH) & w.rlike("[0-9]") & w.rlike(_CANDIDATE), i)))
    near = F.transform(at, lambda i: F.struct(
        i.alias("position"), F.get("_words", i).alias("word"),
        F.coalesce(F.get("_words", i - 1), F.lit("")).alias("previous"),
        F.concat_ws(" ", F.get("_words", i - 3), F.get("_words", i - 2), F.get("_words", i - 1)).alias("near"),
    ))
    rows = docs.select(*keep, words.alias("_words")).select(*keep, F.explode(near).alias("_c")).select(*keep, "_c.*")
    rows = rows.withColumn("finding", F.explode(F.regexp_extract_all("word", F.lit(_CANDIDATE), F.lit(1))))
    rows = rows.where(F.col("finding").rlike("[0-9]"))
    before = F.call_function("substring_index", F.col("word"), F.col("finding"), F.lit(1))
    return rows.select(
        *keep, F.col("position").cast("long").alias("position"), "previous", "near", "word", before.alias("before"), "finding"
    )


def _feature_columns() -> dict:
    finding, length = F.col("finding"), F.length("finding")
    share = lambda pattern: F.regexp_count(finding, F.lit(pattern)) / length
    left = F.regexp_replace(F.lower(finding), "|".join(DICTIONARY), "")
    flag = lambda condition: condition.cast("double")
    context = F.concat_ws(" ", "near", "before")
    return {
        "length": length.cast("double"),
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "marks": share("[^A-Za-z0-9]"),
        "changes": share("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"),
        "distinct": F.size(F.array_distinct(F.split(finding, ""))) / F.least(length, F.lit(64)),
        "dictionary": 1 - F.length(left) / length,
        "hexadecimal": flag(finding.rlike("^[0-9a-fA-F]+$")),
        "only_digits": flag(finding.rlike("^[0-9+.-]+$")),
        "uuid": flag(finding.rlike("(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}")),
        "path": flag(finding.rlike("/[a-z]+[/.]|^/|[.][a-z]{2,4}$") | F.col("before").rlike("://|/$")),
        "quoted": flag(F.col("before").rlike("[\"'`]$")),
        "assigned": flag(F.col("before").rlike("[=:]\\s*[\"'`]?$") | F.col("previous").rlike("[=:]$")),
        "near_key": flag(context.rlike(KEY_WORDS)),
        "near_digest": flag(context.rlike(DIGEST_WORDS)),
        "placeholder": flag(finding.rlike(PLACEHOLDERS)),
    }


FEATURES = (
    "length", "digits", "capitals", "marks", "changes", "distinct", "dictionary", "hexadecimal", "only_digits", "uuid", "path",
    "quoted", "assigned", "near_key", "near_digest", "placeholder",
)


def with_features(found: DataFrame) -> DataFrame:
    found = found.withColumns({f"f_{name}": column for name, column in _feature_columns().items()})
    return VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(found)


# Forms of labelled findings: text around a value, the value, and whether it is a secret.
_HEX40, _HEX64 = "sha1(CAST(id AS STRING))", "sha2(CAST(id AS STRING), 256)"
_BASE = "substring(translate(base64(unhex(sha2(CAST(id AS STRING), 256))), '/=', 'ab'), 1, 20 + CAST(id % 24 AS INT))"
_UUID = ("concat_ws('-', substring(sha1(CAST(id AS STRING)), 1, 8), substring(sha1(CAST(id AS STRING)), 9, 4),"
         " substring(sha1(CAST(id AS STRING)), 13, 4), substring(sha1(CAST(id AS STRING)), 17, 4), substring(md5(CAST(id AS STRING)), 1, 12))")
_FORMS = (
    (f"concat('set token = \"', {_HEX40}, '\" here')", 1),
    (f"concat('api_key: ', {_BASE}, ' and on')", 1),
    (f"concat('password=\"', {_BASE}, '\"')", 1),
    (f"concat('the secret is ', {_BASE})", 1),
    (f"concat('Authorization: Bearer ', {_BASE}, '.', {_HEX40})", 1),
    (f"concat('aws_access_key_id = AKIA', upper(substring({_HEX40}, 1, 16)))", 1),
    (f"concat('client_secret=', {_HEX64})", 1),
    (f"concat('fixed in commit ', {_HEX40}, ' today')", 0),
    (f"concat('sha256: ', {_HEX64})", 0),
    (f"concat('checksum = \"', md5(CAST(id AS STRING)), '\"')", 0),
    (f"concat('see https://www.example.com/item/', {_UUID})", 0),
    (f"concat('trace id ', {_UUID}, ' ended')", 0),
    ("concat('open chapter', id, 'introduction and go on')", 0),
    ("concat('set api_key = \"your_api_key_here_', id, '\"')", 0),
    ("concat('password: example_password_', id)", 0),
    ("concat('card ', 4000000000000000 + id * 7919, ' paid')", 0),
    ("concat('at 2024-01-02T03:04:', lpad(id % 60, 2, '0'), '.', lpad(id, 6, '0'), ' it ended')", 0),
    ("concat('saved as images/report_', id, '_final_version.html')", 0),
    ("concat('write to first.last', id, '.office.example.com now')", 0),
    ("concat('a long order-item-number-', id, ' in text')", 0),
)


def labelled_texts(spark: SparkSession, n: int = TRAINING_TEXTS) -> DataFrame:
    """Labelled findings to train on: (text, label), ``n`` rows over all forms in turn."""
    cases = " ".join(f"WHEN {k} THEN {form}" for k, (form, _) in enumerate(_FORMS))
    secret = ", ".join(str(k) for k, (_, label) in enumerate(_FORMS) if label)
    kind = f"id % {len(_FORMS)}"
    return spark.range(n).selectExpr(
        f"CASE {kind} {cases} END AS text", f"CAST(CAST({kind} AS INT) IN ({secret}) AS DOUBLE) AS label")


def train(labelled: DataFrame, trees: int = 40, depth: int = 8, seed: int = 7) -> RandomForestClassificationModel:
    """A forest on labelled texts (text, label); the label holds for every candidate of its text."""
    found = with_features(candidates(labelled, "label")).select("features", "label").coalesce(1)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(found)


def scan(docs: DataFrame, model: RandomForestClassificationModel, threshold: float = THRESHOLD) -> DataFrame:
    """All findings: doc_id, position, finding, probability, secret."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    judged = model.transform(with_features(candidates(texts, "doc_id")))
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return judged.select("doc_id", "position", "finding", probability.alias("probability")).withColumn(
        "secret", F.col("probability") > threshold)


def op10_secret_scan(spark, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"), train(labelled_texts(spark)))
