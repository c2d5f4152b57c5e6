"""Secret scanning with a random forest that removes false positives, in DataFrame expressions only (operator 2).

Candidates are long runs of token characters; a run ends at an equals sign before a long value, so ``name=value`` gives the
value, with the name as its neighbour. Each is described by its length, its character transitions, the part of it
that dictionary words cover, signs of a path, and its neighbouring words. A random forest, fitted to labelled findings,
tells secrets from other candidates. Findings are written once; texts are read once.

Defined cases. Null and empty texts have no candidates. A repeated row gives repeated findings. Without labelled findings
of both kinds no forest can be fitted: then all findings get the only label there is as score, or 0.5. An empty table
gives an empty result. Extra columns of the table are not looked at.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.session import materialise

from .quality import let

MIN_LENGTH = 16
CONTEXT = 48               # characters kept before and after a candidate
TREES, DEPTH, SEED = 40, 8, 17
MAX_LABELLED = 200_000     # labelled findings the forest is fitted to, about half of each label if there are as many, chosen by a
                           # hash; scoring covers all findings
PLACES = 1 << 40
THRESHOLD = 0.5

_VALUE = "[A-Za-z0-9+/_-]"
#: The first part only skips short words fast; the possessive repetition needs no stack, however long a run is.
RUN = f"(?=[A-Za-z0-9+/_=-]{{{MIN_LENGTH}}})(?:{_VALUE}|=(?!{_VALUE}{{{MIN_LENGTH}}})){{{MIN_LENGTH},}}+"

# Names that secrets are assigned to, and frequent words and word parts of texts, code and paths.
SECRET_NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "access_key", "secret_key", "auth",
                "credential", "private_key", "key")
DICTIONARY = (
    "about", "access", "after", "also", "and", "api", "app", "are", "bin", "build", "but", "cache", "class", "client", "code",
    "com", "config", "content", "data", "date", "default", "der", "des", "die", "docs", "ein", "end", "error", "est", "false",
    "file", "for", "from", "function", "get", "has", "have", "home", "html", "http", "https", "image", "index", "info", "ing",
    "int", "json", "key", "lib", "like", "line", "list", "local", "log", "main", "más", "ment", "message", "model", "name", "new",
    "nicht", "not", "null", "number", "object", "one", "out", "page", "para", "path", "por", "pour", "private", "public", "que",
    "query", "read", "request", "response", "result", "return", "sch", "server", "set", "sich", "source", "src", "string",
    "system", "test", "text", "that", "the", "this", "time", "tion", "title", "true", "type", "und", "url", "user", "usr", "value",
    "var", "version", "was", "web", "with", "world", "www", "you",
)

FEATURES = ("length", "transitions", "digits", "capitals", "hex", "distinct", "vowel_steps", "coverage", "path", "assigned",
            "quoted", "named", "word_before", "word_after")


def findings(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, number, begin, end, candidate, before, after): every candidate with its place and surroundings."""
    whole = F.col("whole")
    rows = df.select(F.col(id_col).alias("doc"), F.col(text).alias("whole")).filter(whole.rlike(RUN))
    parts = rows.select("doc", F.regexp_extract_all(whole, F.lit(f"({RUN})"), F.lit(1)).alias("runs"),
                        F.split(whole, RUN).alias("gaps"))
    lengths = F.zip_with("gaps", "runs", lambda g, r: F.struct(
        F.char_length(g).alias("gap"), F.coalesce(F.char_length(r), F.lit(0)).alias("run")))
    begins = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda s, x: F.struct(
        (s["at"] + x["gap"] + x["run"]).alias("at"), F.concat(s["all"], F.array(s["at"] + x["gap"])).alias("all")))["all"]
    # The context is cut from the neighbouring gaps and runs: so many runs are as long as the context.
    near = range(-(-CONTEXT // MIN_LENGTH))
    part = lambda name, i, cut: cut(F.coalesce(F.get(name, i), F.lit("")), F.lit(CONTEXT))
    before = lambda i: F.right(F.concat(*[part(name, i - k - int(name == "runs"), F.right)
                                          for k in reversed(near) for name in ("runs", "gaps")]), F.lit(CONTEXT))
    after = lambda i: F.left(F.concat(*[part(name, i + k + 1, F.left)
                                        for k in near for name in ("gaps", "runs")]), F.lit(CONTEXT))
    each = let(begins, lambda b: F.transform("runs", lambda r, i: F.struct(
        i.alias("number"), b[i].alias("begin"), (b[i] + F.char_length(r)).alias("end"), r.alias("candidate"),
        before(i).alias("before"), after(i).alias("after"))))
    return parts.select("doc", F.explode(each).alias("f")).select("doc", "f.*")


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def features() -> list[Column]:
    """The columns named in FEATURES, from ``candidate``, ``before`` and ``after``."""
    run, before, after = F.col("candidate"), F.col("before"), F.col("after")
    lower, size = F.lower(run), F.char_length(run)
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        run, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9")
    sounds = F.regexp_replace(F.regexp_replace(F.regexp_replace(lower, "[^a-z]", ""), "[aeiou]", "1"), "[a-z]", "0")
    steps = lambda c: F.char_length(F.regexp_replace(c, r"(.)\1+", "$1")) - 1
    known = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    name = F.lower(F.regexp_extract(before, r"([A-Za-z_-]+)[\s\"'`:=(]*$", 1))
    found = {
        "length": size,
        "transitions": _share(steps(kinds), size),
        "digits": _share(size - F.char_length(F.regexp_replace(run, "[0-9]", "")), size),
        "capitals": _share(size - F.char_length(F.regexp_replace(run, "[A-Z]", "")), size),
        "hex": run.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "distinct": _share(F.size(F.array_distinct(F.split(run, ""))), size),
        "vowel_steps": _share(steps(sounds), F.char_length(sounds)),
        "coverage": _share(size - F.char_length(F.regexp_replace(lower, known, "")), size),
        "path": F.size(F.split(run, "/")) - 1 + before.rlike(r"(://|[/\\.])[^\s]*$").cast("int"),
        "assigned": before.rlike(r"[:=]\s*[\"'`(]*$"),
        "quoted": before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]"),
        "named": name.rlike("(" + "|".join(SECRET_NAMES) + ")$"),
        "word_before": F.char_length(F.regexp_extract(before, r"(\p{L}+)[^\p{L}]*$", 1)),
        "word_after": F.char_length(F.regexp_extract(after, r"^[^\p{L}]*(\p{L}+)", 1)),
    }
    return [F.coalesce(found[n].cast("double"), F.lit(0.0)).alias(n) for n in FEATURES]


def described(found: DataFrame) -> DataFrame:
    """``found`` with the forest's ``features`` vector."""
    return found.withColumn("features", array_to_vector(F.array(*features())))


def fit(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, max_rows: int = MAX_LABELLED):
    """A forest for findings with a ``label`` of 0 or 1, or the only label there is (0.5 without any)."""
    sizes = {int(r["label"]): r["count"] for r in labelled.filter("label IS NOT NULL").groupBy("label").count().collect()}
    if len(sizes) < 2:
        return float(next(iter(sizes), 0.5))
    rare, other = sorted(sizes, key=lambda k: (sizes[k], k))
    wanted = {rare: min(sizes[rare], max_rows // 2)}
    wanted[other] = min(sizes[other], max_rows - wanted[rare])
    bounds = {k: wanted[k] * PLACES // n for k, n in sizes.items()}          # a label taken whole has the bound PLACES
    place = F.pmod(F.xxhash64("doc", "number", "candidate"), F.lit(PLACES))
    sample = labelled.filter(F.col("label").isin(rare, other) & (place < F.when(F.col("label") == rare, bounds[rare]).otherwise(bounds[other])))
    drawn = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    weight = {k: sum(drawn.values()) / (2 * max(drawn.get(k, 0), 1)) for k in sizes}
    weighted = described(sample).select("features", F.col("label").cast("double").alias("label"), F.when(
        F.col("label") == rare, weight[rare]).otherwise(weight[other]).alias("weight"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, weightCol="weight").fit(weighted)


def score(found: DataFrame, forest) -> DataFrame:
    """``found`` with ``score``, the forest's probability of a secret."""
    if isinstance(forest, float):
        return found.withColumn("score", F.lit(forest))
    return forest.transform(described(found)).withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def rule_label(found: DataFrame) -> DataFrame:
    """``found`` with a ``label``: 1 for an assignment of digits and letters to a secret's name, 0 for digits or letters only
    that nothing is assigned to and that assign nothing themselves, null (not labelled) for all others."""
    mixed = F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")
    assigned = F.col("before").rlike(r"(?i)(" + "|".join(SECRET_NAMES) + r")[\"'`]?\s*[:=]\s*[\"'`]*$")
    value = F.col("before").rlike(r"[:=]\s*[\"'`]*$") | F.col("candidate").rlike(f"[A-Za-z0-9_-]={_VALUE}")
    return found.withColumn("label", F.when(assigned & mixed, 1).when(~mixed & ~value, 0))


def secret_rows(df: DataFrame) -> DataFrame:
    """Per candidate: doc_id, number, begin, end, sha256, label, score, secret; the rule's findings train the forest."""
    found = materialise(rule_label(findings(df)), "findings")
    scored = score(found, fit(found))
    return scored.select(F.col("doc").alias("doc_id"), F.col("number").cast("long").alias("number"), F.col("begin").cast("long").alias("begin"),
                         F.col("end").cast("long").alias("end"), F.sha2("candidate", 256).alias("sha256"), "label", "score",
                         (F.col("score") > THRESHOLD).alias("secret"))
