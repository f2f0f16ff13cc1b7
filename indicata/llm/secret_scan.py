"""Secret scan with a random forest that removes false positives (DataFrame functions only).

Candidates are taken from the white-space separated words of every whole text:
runs of 16 or more token characters, every match of an issuer format, and every
value that follows a credential name and = or :, whatever its length and
characters (without the marks around it; a quoted value that goes over several
words gives its first word and the whole, joined by single spaces). A value or
match that is also a run of its word is one candidate. Each gets features of its own characters
(length, transitions between letters, digits and cases, distinct characters),
of a dictionary (how much of it frequent corpus words cover), of its path
(source and place in the text) and of its neighbouring words. A random forest
(pyspark.ml, in the JVM) learns from labelled findings and scores all
candidates.

Labelled findings: no table of reviewed findings exists, so a finding in a
document that ``labels`` covers is labelled a secret by issuer formats
(``ISSUERS``) or the assignment rule, and harmless if it is a number without a
name, a plain path, or letters that dictionary words cover. Other findings, as
runs of high entropy that no format names, do not teach: the forest judges
them. A finding in an issuer format is a secret whatever the forest says. At
most ``TRAIN_ROWS`` findings of each label teach, by hash order. The dictionary
is counted over all documents.

Defined results: null and empty texts have no candidates. Without labelled
findings of both labels the label rule itself decides (score 0 or 1). Rows
with a null id are scanned; null paths are the empty path. Repeated rows
repeat their findings. An empty table gives an empty result. Extra columns are
not used.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import stage, text_or_empty

LEAST = 16
CORE = "[A-Za-z0-9_+/\\-]{16,}"
#: Values that count as assigned credentials, formats of issued credentials, and names that credentials are assigned to.
RULES = {"assigned": "^(?=.*[0-9])(?:[A-Za-z0-9_+/\\-]{16,}|(?!.*://)(?=.*[A-Za-z])\\S{8,})$"}
ISSUERS = {
    "access_key": "A(?:KIA|SIA|GPA|IDA|ROA|NPA)[0-9A-Z]{16}",
    "github": "gh[pousr]_[A-Za-z0-9]{36,255}|github_pat_[A-Za-z0-9_]{36,255}",
    "gitlab": "glpat-[A-Za-z0-9_\\-]{20,}",
    "slack": "xox[abeoprs]-[A-Za-z0-9\\-]{10,}",
    "stripe": "[rs]k_(?:live|test)_[A-Za-z0-9]{16,}",
    "google": "AIza[0-9A-Za-z_\\-]{35}",
    "google_oauth": "ya29\\.[0-9A-Za-z_\\-]{20,}",
    "sendgrid": "SG\\.[A-Za-z0-9_\\-]{16,32}\\.[A-Za-z0-9_\\-]{16,64}",
    "twilio": "SK[0-9a-f]{32}",
    "npm": "npm_[A-Za-z0-9]{36}",
    "pypi": "pypi-[A-Za-z0-9_\\-]{50,}",
    "digitalocean": "do[oprt]_v1_[a-f0-9]{64}",
    "sk": "sk-(?=[A-Za-z_\\-]{0,255}[0-9])[A-Za-z0-9_\\-]{20,}",
    "jwt": "eyJ[A-Za-z0-9_\\-]{8,4096}+\\.eyJ[A-Za-z0-9_\\-]{8,}\\.[A-Za-z0-9_\\-]*",
}
#: Findings that teach as harmless: numbers without a name, plain paths, and letters that dictionary words cover to this share.
NUMBER, PATH, LETTERS, COVERED = "^[0-9+/\\-]+$", "^/?(?:[a-z]{1,15}+/)++[a-z]{0,15}+$", "^[A-Za-z_/\\-]+$", 0.5
NAMES = "(?i)(password|passwd|pwd|secret|token|api_?key|auth|credential)"
DICTIONARY = 256
TRAIN_ROWS = 5_000
TREES, DEPTH, SEED = 24, 8, 11
THRESHOLD = 0.5
FEATURES = ["length", "letter_digit", "digit_letter", "lower_upper", "upper_lower", "digits", "uppers", "vowels", "distinct", "coverage", "path", "place", "named", "assigned", "before_coverage", "after_coverage", "after_length"]


#: A run of word characters that holds a credential name, with the marks behind it, the sign behind them, and a value:
#: quoted, or up to the next assignment in the word. A run is tried once, from its start, and never given back.
NAMED = f"(?<![\\w.\\-])(?=[\\w.\\-]*?{NAMES})[\\w.\\-]++[\"')\\]]*+"
SIGN = "(?:[=:]+>?)"
VALUE = "(\"[^\"]*\"?|'[^']*'?|(?:(?![,;&][\\w.\\-]++[\"']?[=:])\\S)++)"
ISSUED = "(?<![A-Za-z0-9])(?:" + "|".join(ISSUERS.values()) + ")(?![A-Za-z0-9])"


def _bare(value: Column) -> Column:
    """A value without the marks around it."""
    return F.rtrim(F.ltrim(value, F.lit("\"'([{<")), F.lit("\"')]}>,;."))


def _named_values(rows: DataFrame) -> DataFrame:
    """(id, path, n_words, words, place, secret): the values that follow a credential name."""
    word = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    i = F.col("at")
    named = rows.select("*", F.explode(F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).rlike(NAMES))).alias("at"))
    # The value in the word itself, in the next word, or behind a sign of its own.
    ends = word(i).rlike(NAMED + "$")
    values = F.filter(F.regexp_extract_all(word(i), F.lit(NAMED + SIGN + VALUE), 2), lambda v: ~v.isin('"', "'"))
    inside = F.transform(values, lambda v: F.struct(i.alias("place"), v.alias("value")))
    behind = (
        F.when(word(i).rlike(NAMED + SIGN + "[\"']?$"), F.struct((i + 1).alias("place"), F.concat(F.regexp_extract(word(i), "[\"']?$", 0), word(i + 1)).alias("value")))
        .when(ends & word(i + 1).rlike(f"^{SIGN}[\"']?$"), F.struct((i + 2).alias("place"), F.concat(F.regexp_extract(word(i + 1), "[\"']?$", 0), word(i + 2)).alias("value")))
        .when(ends & word(i + 1).rlike(f"^{SIGN}"), F.struct((i + 1).alias("place"), F.regexp_replace(word(i + 1), f"^{SIGN}", "").alias("value")))
    )
    found = named.select("id", "path", "n_words", "words", F.explode(F.concat(inside, F.filter(F.array(behind), lambda b: b.isNotNull()))).alias("v"))
    found = found.select("id", "path", "n_words", "words", F.col("v.place").alias("place"), F.col("v.value").alias("value"))
    # A quote that the word leaves open: up to the first later word that closes it.
    quote = F.substring("value", 1, 1)
    rest = F.when(F.col("value").rlike("^(\"[^\"]*|'[^']*)$"), F.slice("words", F.col("place") + 2, F.col("n_words")))
    found = found.withColumn("rest", rest).withColumn("closing", F.array_position(F.transform("rest", lambda w: F.contains(w, quote)), True))
    last = F.call_function("substring_index", F.element_at("rest", F.col("closing").cast("int")), quote, F.lit(1))
    whole = F.when(F.col("closing") > 0, F.concat_ws(" ", F.expr("substring(value, 2)"), F.expr("slice(rest, 1, int(closing) - 1)"), last))
    # The first word may hold the quote's end and more: only what the quotes hold.
    first = F.when(F.col("value").rlike("^(\"[^\"]+\"|'[^']+')"), F.regexp_extract("value", "^(?:\"([^\"]+)\"|'([^']+)')", 0)).otherwise(F.col("value"))
    secrets = F.array_distinct(F.filter(F.array(_bare(first), F.trim(whole)), lambda v: v.isNotNull() & (v != "")))
    return found.select("id", "path", "n_words", "words", "place", F.explode(secrets).alias("secret"))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(id, path, place, n_words, word, before2, before, after, secret, valued): one row per candidate, ``place`` counts words from 0; ``valued``: found by a credential name only."""
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col in docs.columns else F.lit("")
    rows = docs.select(F.col(id_col).alias("id"), path.alias("path"), F.split(F.trim(text_or_empty(text_col)), "\\s+").alias("words"))
    runs = lambda w: F.when(F.length(w) >= LEAST, F.regexp_extract_all(w, F.lit(f"({CORE})"), 1)).otherwise(F.array().cast("array<string>"))
    spread = lambda pattern, least: F.explode(F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (F.length(F.get("words", i)) >= least) & F.get("words", i).rlike(pattern))).alias("place")
    word = F.get("words", F.col("place"))
    bare = rows.select("id", "path", F.size("words").alias("n_words"), "words", spread(CORE, LEAST)).select("*", F.explode(runs(word)).alias("secret"))
    issued = rows.select("id", "path", F.size("words").alias("n_words"), "words", spread(ISSUED, 0)).select("*", F.explode(F.regexp_extract_all(word, F.lit(f"({ISSUED})"), 1)).alias("secret"))
    named = _named_values(rows.select("id", "path", F.size("words").alias("n_words"), "words"))
    # What is a run of its word is there already, and a value in an issuer format is there by it.
    issued = issued.filter(~F.array_contains(runs(word), F.col("secret")))
    named = named.filter(~F.array_contains(F.concat(runs(word), F.regexp_extract_all(word, F.lit(f"({ISSUED})"), 1)), F.col("secret")))

    def around(found: DataFrame, valued: bool) -> DataFrame:
        return found.select("id", "path", "place", "n_words", word.alias("word"), *[F.coalesce(F.get("words", F.col("place") + k), F.lit("")).alias(name) for k, name in ((-2, "before2"), (-1, "before"), (1, "after"))], "secret", F.lit(valued).alias("valued"))

    return around(bare, False).unionByName(around(issued, False)).unionByName(around(named, True))


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent words of 3 to 8 plain letters over all documents."""
    words = F.filter(F.split(F.lower(text_or_empty(text_col)), "\\s+"), lambda w: F.length(w).between(3, 8))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").count()
    return [r.word for r in counts.filter(F.col("word").rlike("^[a-z]+$")).orderBy(F.col("count").desc(), "word").limit(size).collect()]


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _coverage(text: Column, words: list[str]) -> Column:
    """Share of the characters that dictionary words cover, longest words first."""
    if not words:
        return F.lit(0.0)
    either = "|".join(sorted(words, key=lambda w: (-len(w), w)))
    low = F.lower(text)
    return F.when(F.length(low) > 0, 1 - F.length(F.regexp_replace(low, either, "")) / F.length(low)).otherwise(0.0)


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    s, n = F.col("secret"), F.length("secret").cast("double")
    lead = F.concat_ws(" ", "before2", "before", F.call_function("substring_index", F.col("word"), F.col("secret"), F.lit(1)))
    assigned = F.concat(F.col("before"), F.call_function("substring_index", F.col("word"), F.col("secret"), F.lit(1))).rlike("[=:][\"']?$")
    return found.select(
        "*",
        n.alias("length"),
        (_count(s, "[A-Za-z](?=[0-9])") / n).alias("letter_digit"),
        (_count(s, "[0-9](?=[A-Za-z])") / n).alias("digit_letter"),
        (_count(s, "[a-z](?=[A-Z])") / n).alias("lower_upper"),
        (_count(s, "[A-Z](?=[a-z])") / n).alias("upper_lower"),
        (_count(s, "[0-9]") / n).alias("digits"),
        (_count(s, "[A-Z]") / n).alias("uppers"),
        (_count(s, "(?i)[aeiou]") / n).alias("vowels"),
        (F.size(F.array_distinct(F.split(s, ""))) / n).alias("distinct"),
        _coverage(s, words).alias("coverage"),
        F.pmod(F.xxhash64("path"), F.lit(16)).cast("double").alias("path_bucket"),
        (F.col("place") / F.col("n_words")).alias("place_share"),
        (lead.rlike(NAMES) | F.col("valued")).cast("double").alias("named"),
        (assigned | F.col("valued")).cast("double").alias("assigned"),
        _coverage(F.col("before"), words).alias("before_coverage"),
        _coverage(F.col("after"), words).alias("after_coverage"),
        F.length("after").cast("double").alias("after_length"),
    )


def issuer() -> Column:
    """Name of the issuer format that the whole candidate has, or null."""
    return F.coalesce(*[F.when(F.col("secret").rlike(f"^(?:{pattern})$"), name) for name, pattern in ISSUERS.items()])


def rule() -> Column:
    """Name of the issuer format a candidate has, "assigned" by the assignment rule, or null."""
    return F.coalesce(issuer(), F.when((F.col("named") == 1) & (F.col("assigned") == 1) & F.col("secret").rlike(RULES["assigned"]), "assigned"))


def label() -> Column:
    """1 for a finding with a rule, 0 for a harmless one, null for one that does not teach."""
    s = F.col("secret")
    harmless = (s.rlike(NUMBER) & (F.col("named") == 0)) | s.rlike(PATH) | (s.rlike(LETTERS) & (F.col("coverage") >= COVERED))
    return F.when(F.col("rule").isNotNull(), 1.0).when(harmless, 0.0)


def scan(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per candidate: id, place, secret, rule, score (0 to 1, higher: likelier a secret), is_secret.

    ``labelled``: ids (column ``id``) of the documents whose findings teach.
    """
    found = stage(candidates(docs, id_col, text_col, path_col), "secret-candidates")
    scored = with_features(found, dictionary(docs, text_col)).withColumn("rule", rule())
    columns = ["path_bucket" if f == "path" else "place_share" if f == "place" else f for f in FEATURES]
    rows = stage(scored.select("id", "place", "secret", "rule", *columns), "secret-features")

    known = rows.join(labelled.select("id").distinct(), "id", "left_semi").withColumn("label", label())
    order = F.xxhash64("id", "place", "secret")
    train = known.filter("label = 1").orderBy(order).limit(train_rows).unionByName(known.filter("label = 0").orderBy(order).limit(train_rows))
    train = stage(train, "secret-training")
    both = train.select("label").distinct().count() == 2
    if both:
        assembler = VectorAssembler(inputCols=columns, outputCol="features")
        forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(assembler.transform(train))
        judged = forest.transform(assembler.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    else:
        judged = rows.withColumn("score", F.col("rule").isNotNull().cast("double"))
    return judged.select(F.col("id").alias(id_col), F.col("place").cast("long").alias("place"), "secret", "rule", "score", ((F.col("score") >= THRESHOLD) | F.coalesce(F.col("rule") != "assigned", F.lit(False))).alias("is_secret"))
