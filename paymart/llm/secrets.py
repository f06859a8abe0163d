"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

Candidates are assigned values (token = "...") and long runs with digits. The
forest sees length, character classes and transitions, how much of a value is
made of words of the corpus, the path, and the words beside it. It learns from
labelled findings; without any, from findings that plain rules can judge. All
of it is DataFrame operations and the forest of Spark's own library.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm.shared import broadcast_if_small, free_names, staged

KEYWORD = r"(?:token|secret|passw(?:or)?d|passwd|passphrase|pwd|credentials?|bearer|(?:api|access|auth|private|secret|signing|encryption)[_-]?key)"
ASSIGNED = rf"(?i:{KEYWORD}\w*[\"']?\s{{0,3}}(?:=>|:=|=|:)\s{{0,3}}[\"']?)"
BREAK = r"(?:\s|\\[nr]){1,8}+"  # of lines, also escaped ones
# A whole key up to its end mark; without one, its header lines and base64 lines.
PEM = (
    r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY(?: BLOCK)?-----"
    r"(?:[^-]*+(?:-{1,4}(?!-)[^-]++){0,64}+-----END [A-Z ]{0,32}PRIVATE KEY(?: BLOCK)?-----"
    rf"|(?:{BREAK}[A-Za-z-]{{1,32}}: [^\n]{{0,256}}){{0,8}}(?:{BREAK}[A-Za-z0-9+/]{{16,}}+={{0,2}}(?:{BREAK}[A-Za-z0-9+/]{{1,15}}+={{0,2}}(?=\s|\\|[\"']|$))?)*+)"
)
CANDIDATE = (
    rf"{PEM}"
    rf"|{ASSIGNED}(?!-----BEGIN )[^\s\"'<>]{{6,}}+"
    # a run of any length with a digit in it, from its begin on: what another candidate ends at, or no such letter stands before
    r"|(?:\G|(?<![A-Za-z0-9+/_-]))(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}"
)
PLACEHOLDER = r"(?i)example|sample|dummy|fake|placeholder|change_?me|your[_-]|x{6,}|\*{6,}|1234567890"  # in a value
# beside it, and not as part of an address such as name@example.com
PLACEHOLDER_NEAR = r"(?i)(?<![@./\w-])(?:example|sample|dummy|fake|placeholder)(?![.\w-])[^\n]{0,24}$"
TEST_PATH = r"(?i)test|spec|example|sample|fixture|mock|docs?/"
CONFIG_PATH = r"(?i)\.env|config|settings|secret|credential|\.pem|\.ya?ml|\.properties"
TRAINING_ROWS = 20_000  # most labelled findings that the forest is fitted on, half of each kind
TREES, DEPTH, SEED = 20, 6, 7
DECISION = 0.5
MASK = "[SECRET]"

FEATURES = [
    "log_length", "digits", "uppers", "lowers", "others", "switches", "distinct", "transitions", "coverage", "path_depth", "path_test",
    "path_config", "keyword", "assigned", "quoted", "keyword_near", "placeholder_near", "before", "after",
]


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, text_hash, path, start, value, lead, tail, opening): ``start`` counts code points, lead and tail are what stands beside."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col(path).cast("string").alias("path"),
        text.alias("text"),
    )
    found = found.withColumn("hits", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).where(F.size("hits") > 0)
    gaps = F.split("text", CANDIDATE, -1)
    found = found.select("doc_id", "text_hash", "path", "hits", gaps.alias("gaps"))
    lengths = F.zip_with("gaps", "hits", lambda g, h: F.length(g) + F.coalesce(F.length(h), F.lit(0)))
    found = found.withColumn("lengths", lengths)
    found = found.select("doc_id", "text_hash", "path", "gaps", "lengths", F.posexplode("hits").alias("i", "hit"))
    before = F.aggregate(F.slice("lengths", F.lit(1), F.col("i")), F.lit(0), lambda total, n: total + n)
    gap, after = F.element_at("gaps", F.col("i") + 1), F.element_at("gaps", F.col("i") + 2)
    opening = F.regexp_extract("hit", rf"^(?:{ASSIGNED})?", 0)
    found = found.select(
        "doc_id",
        "text_hash",
        "path",
        (before + F.length(gap) + F.length(opening)).alias("start"),
        F.substring("hit", F.length(opening) + 1, F.length("hit")).alias("value"),
        F.concat(F.substring(gap, F.greatest(F.lit(1), F.length(gap) - 79), F.lit(80)), opening).alias("lead"),
        F.substring(after, F.lit(1), F.lit(80)).alias("tail"),
        opening.alias("opening"),
    )
    # a closing mark belongs to the text around
    value = F.regexp_replace("value", r"[.,;:!?)\]}]+$", "")
    return found.withColumn("value", value).where("value <> ''")


def _share(value: Column, letters: str) -> Column:
    return (F.length(value) - F.length(F.regexp_replace(value, f"[{letters}]", ""))) / F.greatest(F.length(value), F.lit(1))


def _classes(value: Column) -> Column:
    """Each character as its class."""
    shape = value
    for pattern, letter in ((r"[a-z]", "a"), (r"[A-Z]", "A"), (r"[0-9]", "0"), (r"[^aA0]", "_")):
        shape = F.regexp_replace(shape, pattern, letter)
    return shape


def _pairs(value: Column) -> Column:
    """Neighbouring characters, letters made small."""
    small = F.lower(value)
    places = F.when(F.length(value) > 1, F.sequence(F.lit(1), F.length(value) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substring(small, i, F.lit(2)))


def plain_label(found: DataFrame) -> Column:
    """1 or 0 where a rule is sure, else null: random-looking assigned values against numbers, words and placeholders."""
    value = F.col("value")
    random_like = value.rlike(r"^[0-9a-fA-F]{32,}$") | (
        (F.length(value) >= 16) & value.rlike(r"[0-9]") & value.rlike(r"[A-Za-z]") & (_share(value, "0-9") >= 0.15)
    )
    known = value.rlike(r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-|sk-[A-Za-z0-9]{20,}|-----BEGIN)")
    placeholder = (value.rlike(PLACEHOLDER) | F.col("lead").rlike(PLACEHOLDER_NEAR)) & ~known
    return (
        F.when(placeholder | value.rlike(r"^[0-9]+$") | value.rlike(r"^[a-z]+$"), 0.0)
        .when(known | ((F.col("opening") != "") & random_like), 1.0)
        .when((F.col("opening") == "") & ~random_like, 0.0)
    )


def dictionary_coverage(found: DataFrame, docs: DataFrame, least: int = 3) -> DataFrame:
    """(value, coverage): the share of each distinct value that words of the corpus make up.

    A word is a run of at least three ASCII letters that stands at least
    ``least`` times in all texts.
    """
    runs = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z]{3,}"), F.lit(0))
    values = found.select("value").distinct()
    parts = staged(values.select("value", F.explode(runs(F.col("value"))).alias("word")), "value-words")
    wanted = broadcast_if_small(staged(parts.select("word").distinct(), "wanted-words"), row_bytes=64)
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).where(F.length("word") >= 3)
    known = words.join(wanted, "word", "left_semi").groupBy("word").count()
    # a value's own words stand in the texts as well
    known = staged(known.where(F.col("count") >= least).select("word"), "known-words")
    covered = parts.join(known, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    return covered.select("value", F.least(F.col("covered") / F.length("value"), F.lit(1.0)).alias("coverage"))


def _log_odds(training: DataFrame, items: Column) -> str:
    """JSON of item: log odds of a secret, smoothed, from the training rows alone."""
    counts = training.select("label", F.explode(F.array_distinct(items)).alias("item"))
    rows = counts.groupBy("item").agg(F.sum("label").alias("yes"), F.count("label").alias("n")).collect()
    yes, n = (sum(r[c] for r in rows) for c in ("yes", "n"))
    base = (yes + 1) / (n - yes + 1)
    odds = {r["item"]: round(math.log((r["yes"] + 0.5) / (r["n"] - r["yes"] + 0.5) / base), 3) for r in rows}
    return json.dumps(dict(sorted(odds.items())))


def _mean_odds(table: str, items: Column) -> Column:
    odds = F.from_json(F.lit(table), "map<string,double>")
    total = F.aggregate(items, F.lit(0.0), lambda total, item: total + F.coalesce(F.element_at(odds, item), F.lit(0.0)))
    return total / F.greatest(F.size(items), F.lit(1))


def _beside(name: str, pattern: str) -> Column:
    """The word next to the value, as an array of one; empty for none."""
    word = F.lower(F.regexp_extract(name, pattern, 1))
    return F.when(word != "", F.array(word)).otherwise(F.array().cast("array<string>"))


LAST_WORD, FIRST_WORD = r"([A-Za-z_]+)[^A-Za-z_]*$", r"^[^A-Za-z_]*([A-Za-z_]+)"


def _plain_features(found: DataFrame) -> DataFrame:
    value, lead = F.col("value"), F.col("lead")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    shape = F.regexp_replace(_classes(value), r"(.)\1+", "$1")
    return found.withColumns(
        {
            "log_length": F.ln(F.length(value)),
            "digits": _share(value, "0-9"),
            "uppers": _share(value, "A-Z"),
            "lowers": _share(value, "a-z"),
            "others": _share(value, "^0-9A-Za-z"),
            "switches": F.length(shape) / F.length(value),
            "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
            "path_depth": F.coalesce(F.size(F.split("path", "[/\\\\]")) - 1, F.lit(0)).cast("double"),
            "path_test": flag(F.col("path").rlike(TEST_PATH)),
            "path_config": flag(F.col("path").rlike(CONFIG_PATH)),
            "keyword": flag(F.col("opening") != ""),
            "assigned": flag(lead.rlike(r"[=:]\s{0,3}[\"']?$")),
            "quoted": flag(lead.rlike(r"[\"']$")),
            "keyword_near": flag(lead.rlike(rf"(?i){KEYWORD}")),
            "placeholder_near": flag(value.rlike(PLACEHOLDER) | lead.rlike(PLACEHOLDER_NEAR)),
        }
    )


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source", training_rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per candidate: doc_id, text_hash, start, length, value, probability, is_secret.

    ``docs`` has doc_id, text and the column ``path``. ``labelled`` has doc_id,
    start and is_secret (boolean) of known findings; without it, or where it
    has only one kind, plain rules label what they are sure of. The forest is
    fitted on at most ``training_rows`` of them, half of each kind, the first
    by a hash. With labels of one kind only, the rules decide alone, and what
    they do not know is no secret.

    Null and empty texts have no candidates; a null path has no features. Rows
    with null or repeated ids are rows like others (equal rows give equal
    findings, which tie and are judged alike). Texts and runs of any length are
    searched whole; of a private key without an end mark at most eight header lines
    of 256 characters, and with one at most 64 dashes that end nothing, belong to
    it. Extra columns are not read, whatever their names. An empty table gives no
    rows. text_hash tells rows that share an id apart.
    """
    found = staged(candidates(docs, path), "candidates")
    coverage = staged(dictionary_coverage(found, docs), "coverage")
    found = _plain_features(found.join(coverage, "value", "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0))))
    label = plain_label(found)
    if labelled is not None:
        known = labelled.select("doc_id", "start", F.col("is_secret").cast("double").alias("known")).dropDuplicates(["doc_id", "start"])
        found = found.join(broadcast_if_small(known, row_bytes=24), ["doc_id", "start"], "left")
        label = F.coalesce("known", label)
    found = staged(found.withColumn("label", label), "findings")

    order = F.xxhash64("doc_id", "start", "value")
    half = [found.where(F.col("label") == kind).orderBy(order, "doc_id", "start").limit(training_rows // 2) for kind in (0.0, 1.0)]
    training = staged(half[0].unionByName(half[1]).repartition(1), "training")
    kinds = {r["label"] for r in training.select("label").distinct().collect()}
    out = F.col("doc_id"), F.col("text_hash"), F.col("start"), F.length("value").alias("length"), F.col("value")
    if len(kinds) < 2:
        probability = F.coalesce("label", F.lit(0.0))
        return found.select(*out, probability.alias("probability"), (probability >= DECISION).alias("is_secret"))

    items = {
        "transitions": _pairs(F.col("value")),
        "before": _beside("lead", LAST_WORD),
        "after": _beside("tail", FIRST_WORD),
    }
    tables = {name: _log_odds(training, column) for name, column in items.items()}

    def featured(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({name: _mean_odds(tables[name], column) for name, column in items.items()})
        return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(rows)

    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    model = forest.fit(featured(training).select("features", "label"))
    judged = model.transform(featured(found))
    chance = vector_to_array("probability")[1]
    probability = F.when(F.col("value").startswith("-----BEGIN"), F.coalesce("label", F.lit(1.0))).otherwise(chance)  # its mark says it all
    return judged.select(*out, probability.alias("chance")).select(
        "doc_id", "text_hash", "start", "length", "value", F.col("chance").alias("probability"), (F.col("chance") >= DECISION).alias("is_secret")
    )


def masked(docs: DataFrame, findings: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret value in a document replaced; all rows and columns stay.

    Of values that begin or hold one another the longest is replaced first, so
    no rest of it stays. n_chars, where there is such a column, follows the text.

    - Findings belong to rows of the same id (null included) and the same text, so of
      rows that share an id each is masked by its own. Repeated rows are masked alike.
    - A null or empty text stays, and so does a text of any length without findings.
    - Columns of any name stay as they are. Empty tables give no rows.
    """
    id_name, hash_name, values_name, masked_name = free_names(docs, "in_doc", "in_text", "found_secrets", "masked_text")
    secrets = findings.where("is_secret").groupBy("doc_id", "text_hash").agg(F.collect_set("value").alias("values"))
    longest_first = F.transform(
        F.array_sort(F.transform("values", lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v")))), lambda x: x["v"]
    )
    secrets = staged(secrets.select("doc_id", "text_hash", longest_first.alias("values")), "secrets")
    size = F.aggregate(values_name, F.lit(0).cast("long"), lambda n, v: n + F.octet_length(v) + 16)
    secrets = broadcast_if_small(secrets.toDF(id_name, hash_name, values_name), row_bytes=32, extra=size)
    own = F.col("doc_id").cast("long").eqNullSafe(F.col(id_name)) & (F.xxhash64(F.col("text").cast("string")) == F.col(hash_name))
    joined = docs.join(secrets, own, "left")
    text = F.aggregate(values_name, F.col("text").cast("string"), lambda text, value: F.replace(text, value, F.lit(mask)))
    joined = joined.withColumn(masked_name, F.when(F.col(values_name).isNotNull(), text))
    columns = []
    for c in docs.columns:
        kept = F.col(f"`{c}`")
        if c == "text":
            kept = F.coalesce(masked_name, F.col("text"))
        elif c == "n_chars":
            kept = F.coalesce(F.length(masked_name), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        columns.append(kept.alias(c))
    return joined.select(*columns)
