"""Secret scans with a random forest that removes false positives.

Candidates are long tokens with a digit in whole texts, and the values of assignments such as
``password=`` or ``"db_password":`` (``MIN_VALUE`` characters or more without white space, with or
without a digit; a token that overlaps one is left out). Rules with a known answer label part of them: formats of providers and values of
secret-like keys are true findings; identifiers, card numbers, version strings, addresses,
placeholders and assigned values that are one short plain word or a reference in code are false ones. Labelled findings of the user's own (``labels``) are added. A
random forest is trained on at most ``TRAIN_ROWS`` labelled candidates, half of them of each class
(reviewed ones first, then the lowest hashes), and scores every candidate by length, character
transitions, dictionary coverage, path and the words beside it. Findings keep candidates with a
score of one half or more. A reviewed label is the score, and so is a provider's format.

Everything is DataFrame built-ins and the JVM's own random forest; no Python runs on executors.
Texts are read once; candidates are written.

Nulls, empties and ties: a null or empty text has no candidate; a null path is an empty one; when
labels of one class only exist in the whole table, no forest can be trained and rules alone decide (a candidate
without a label is then kept for review with score one half); repeated rows are scanned each.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import whole
from starloom.llm.pii import apart, cut, matches, pieces
from starloom.session import stage

TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 6, 7
NEAR = 32
MIN_VALUE = 4
FEATURES = ["length", "transitions", "digit_share", "upper_share", "distinct_share", "dictionary", "hex", "path_test", "path_code", "cue_before", "assigned", "quoted", "cue_false"]

_TOKEN = r"(?:(?<![A-Za-z0-9_+/=.-])|\G)(?=[A-Za-z_+/=.-]{0,64}[0-9])[A-Za-z0-9_+/=.-]{16,}+"
# Formats of providers, keys, placeholders, and words of a small dictionary.
_PROVIDERS = r"^(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{16,}|AIza[A-Za-z0-9_-]{30,}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_.-]+)$"
_KEYS = "password|passwd|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth"
_NAME = rf"(?i:{_KEYS})(?:[0-9]{{1,4}}|[_.-][A-Za-z0-9_-]{{1,16}}|[A-Z][A-Za-z0-9]{{1,16}})?[\"'`]?[\x20\t]{{0,4}}(?::=|=>|[=:]{{1,2}})[\x20\t]{{0,4}}[\"'`]?"
_ASSIGNED = (
    rf"{_NAME}(?:(?<=\")[^\s\"]{{{MIN_VALUE},}}+|(?<=')[^\s']{{{MIN_VALUE},}}+|(?<=`)[^\s`]{{{MIN_VALUE},}}+"
    rf"|(?<![\"'`])[^\s\"'`=:>][^\s\"'`<>]{{{MIN_VALUE - 1},}}+)"
)
_WORD_OR_CODE = r"^(?:(?:[A-Z]?[a-z]{1,11}|[A-Z]{1,11})[.,:;!?)]*|(?i:none|null|true|false|self\.|os\.|env|process\.|\$\{|\$\(|\{\{|%s).*)$"
_PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0000000|1234567890|abcdef0123"
_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
_DICTIONARY = "the|and|for|with|that|this|from|was|are|tion|ing|ment|der|die|und|ein|les|des|que|ent|con|los|para|test|user|name|page|file|data|image|index|html|http|www|com|org|net|version"


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str = "source") -> DataFrame:
    """One row per candidate of each whole text: place, digest, features and the rules' label."""
    t = F.col("_text")
    source = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    tokens = matches(t, _TOKEN, "token", t.rlike("[0-9]"))
    assigned = matches(t, _ASSIGNED, "assigned", t.rlike(_NAME))
    alone = apart(F.col("_tokens"), F.col("_assigned"))
    found = F.when(F.size("_assigned") == 0, F.col("_tokens")).otherwise(F.concat(alone, F.col("_assigned")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), source.alias("_path"), whole(text).alias("_text"))
    rows = rows.withColumn("_tokens", tokens).withColumn("_assigned", assigned).withColumn("_found", found).where(F.size("_found") > 0)
    rows = rows.withColumn("_parts", pieces(t))
    parts = F.col("_parts")

    def around(c: Column) -> Column:
        before = cut(parts, F.greatest(c["s"] - NEAR, F.lit(0)), F.least(c["s"], F.lit(NEAR)))
        return F.struct(c["s"].alias("begin"), c["e"].alias("end"), c["m"].alias("raw"), (c["kind"] == "assigned").alias("named"), before.alias("before"), cut(parts, c["e"], NEAR).alias("after"))

    rows = rows.select("doc_id", "_path", F.explode(F.transform("_found", around)).alias("c")).select("doc_id", "_path", "c.*")
    # key=value in one token: the value is the candidate and the key a word beside it.
    key = F.when(F.col("named"), F.regexp_extract("raw", rf"^{_NAME}", 0)).otherwise(F.regexp_extract("raw", rf"^((?i:{_KEYS}))=+(?=.)", 0))
    rows = rows.withColumn("key", key).withColumn("begin", F.col("begin") + F.length("key"))
    rows = rows.withColumn("value", F.expr("substring(raw, length(key) + 1)"))
    quoted = F.col("named") & F.col("key").rlike(r"[\"'`]$")
    loose = F.when(F.col("named"), F.regexp_replace("value", r"[.,;)\]}]+$", "")).otherwise(F.regexp_replace("value", r"[.=]+$", ""))
    rows = rows.withColumn("value", F.when(quoted, F.col("value")).otherwise(loose))
    rows = rows.withColumn("end", F.col("begin") + F.length("value")).withColumn("before", F.concat("before", "key"))
    least = F.when(F.col("named"), MIN_VALUE).otherwise(12)
    return rows.where(F.length("value") >= least).select("doc_id", "begin", "end", F.sha2("value", 256).alias("digest"), *_features(), _label().alias("label"), F.col("value").rlike(_PROVIDERS).alias("provider"))


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("value", pattern, "")) / F.length("value")


def _features() -> list[Column]:
    value = F.col("value")
    # A change of class between neighbours, counted by marking runs of one class.
    runs = F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "\u0001"), "[a-z]+", "\u0002"), "[A-Z]+", "\u0003"))
    near = F.concat(F.col("before"), F.lit(" "), F.col("after"))
    cols = {
        "length": F.length(value).cast("double"),
        "transitions": (runs - 1) / F.length(value),
        "digit_share": _share("[^0-9]"), "upper_share": _share("[^A-Z]"),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "dictionary": 1 - _share(f"(?i)(?:{_DICTIONARY})"),
        "hex": value.rlike("^[0-9a-f]+$").cast("double"),
        "path_test": F.col("_path").rlike("(?i)test|example|doc").cast("double"),
        "path_code": F.col("_path").rlike(r"(?i)src|code|\.(?:py|js|java|go|env|ya?ml|json)$").cast("double"),
        "cue_before": F.col("before").rlike(f"(?i)(?:{_KEYS})").cast("double"),
        "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
        "quoted": F.col("before").rlike(r"[\"']$").cast("double"),
        "cue_false": near.rlike("(?i)commit|sha1|sha256|md5|uuid|checksum|version|isbn|build").cast("double"),
    }
    return [cols[name].cast("double").alias(name) for name in FEATURES]


def _label() -> Column:
    value, before = F.col("value"), F.col("before")
    false = (
        value.rlike(_PLACEHOLDER) | value.rlike(_UUID) | value.rlike("^[0-9.+/=_-]+$") | value.rlike(r"(?i)\.(?:com|org|net)$|^www\.")
        | (F.col("named") & value.rlike(_WORD_OR_CODE)) | F.col("after").startswith("@") | before.endswith("@") | F.concat("before", F.lit(" ")).rlike(r"(?i)(?:commit|sha1|sha256|md5|checksum)[\s:=]+$")
    )
    true = value.rlike(_PROVIDERS) | before.rlike(rf"(?i)(?:{_KEYS})[\"']?\s*[:=]+\s*[\"']?$")
    return F.when(false, 0.0).when(true, 1.0)


def scan(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str = "source", labels: DataFrame | None = None
) -> DataFrame:
    """All candidates with ``score`` and ``kept``. ``labels``: digest, label (0 or 1) of reviewed findings."""
    found = candidates(docs, text, doc_id, path).withColumn("known", F.lit(None).cast("double"))
    if labels is not None:
        known = labels.groupBy("digest").agg(F.max(F.col("label").cast("double")).alias("_known"))
        found = found.join(known, "digest", "left").withColumn("known", F.col("_known")).drop("_known")
    # A provider's format is certain unless the rules know it as a placeholder or the like.
    sure = F.coalesce("known", F.when(F.col("provider") & (F.col("label") == 1), 1.0))
    found = found.withColumn("label", F.coalesce("known", "label")).withColumn("sure", sure).drop("provider")
    found = stage(found, "secret_candidates")
    unique = found.where("label is not null").groupBy(*FEATURES, "label").agg(F.min("digest").alias("digest"), F.max(F.col("known").isNotNull()).alias("reviewed"))
    order = [F.col("reviewed").desc(), F.xxhash64("digest"), *FEATURES]
    halves = [unique.where(F.col("label") == y).orderBy(*order).limit(TRAIN_ROWS // 2) for y in (0.0, 1.0)]
    sample = stage(halves[0].unionByName(halves[1]), "secret_labels")
    classes = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(classes) < 2:
        score = F.coalesce("label", F.lit(0.5))
        return found.withColumn("score", score).withColumn("kept", F.col("score") >= 0.5).drop("known", "sure")
    inputs = VectorAssembler(inputCols=FEATURES, outputCol="_v")
    forest = RandomForestClassifier(featuresCol="_v", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="_p", rawPredictionCol="_r", predictionCol="_y")
    model = forest.fit(inputs.transform(sample))
    scored = model.transform(inputs.transform(found))
    score = F.coalesce("sure", F.get(vector_to_array("_p"), F.lit(1)))
    return scored.withColumn("score", score).withColumn("kept", F.col("score") >= 0.5).drop("_v", "_p", "_r", "_y", "known", "sure")


def findings(docs: DataFrame, **columns) -> DataFrame:
    """Findings that the forest keeps: ``doc_id``, ``begin``, ``end`` (code points), ``digest``, ``score``."""
    return scan(docs, **columns).where("kept").select("doc_id", "begin", "end", "digest", F.round("score", 6).alias("score"))
