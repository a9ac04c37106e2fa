"""Secret scan with false-positive removal by a random forest, in DataFrame functions and Spark ML.

Candidates are runs of twelve or more characters of keys and digests that hold a digit. Each gets
features of its length, its character classes and transitions, how much of it dictionary words
cover, its path, and the words beside it. The forest learns from labelled findings and keeps the
candidates that it takes for secrets. ``labelled`` findings can be given; without them ``seeds``
labels what is beyond doubt (issuer formats and assignments to credential words on one side,
plain numbers, ordinary words, placeholders and digests named as such on the other).

The dictionary and the usual letter pairs come from exact counts over all texts: the most frequent
words, at most ``WORDS``, of at least one occurrence in ``WORD_TEXTS`` texts. The forest learns from all
labelled findings. All texts are scanned whole. Positions count characters from 0.

Cases: a null or empty text has no findings; if one label has no finding there is no forest, and
seeds decide alone; equal rows give equal findings; an empty table gives no rows; columns other
than id, text and path are kept by ``redact`` and not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import col_of, fresh
from tabwright.sources.tables import stage

WORD_TEXTS, WORDS = 1_000, 20_000
TREES, DEPTH = 20, 6
NEAR = 96

#: A run begins where none of its characters stand before it, so a long run is looked at once.
RUN = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{12,}+"
CLASSES = r"[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+"
#: Every two neighbouring letters.
PAIR = "(?=([a-z][a-z]))"
CREDENTIAL = r"(?i)(passw(or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth)"
ASSIGNED = CREDENTIAL + r"[\w\-]{0,16}[\"']?\s{0,3}(:=|=>|=|:)\s{0,3}[\"']?$"
ISSUED = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^(sk|rk|pk)_(live|test)_[A-Za-z0-9]{16,}$|^xox[abprs]-"
DIGEST = r"(?i)\b(commit|revision|sha-?\d*|md5|checksum|digest|uuid|etag|hash|build|version)\W{0,3}$"
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|(.)\1{5,}|0123456|123456789|abcdefg"
FEATURES = (
    "length", "digits", "uppers", "marks", "switches", "distinct", "pairs", "covered", "config_path",
    "test_path", "path_bucket", "assigned", "credential_near", "quoted", "after_equals", "digest_near",
    "issued", "placeholder", "word_bucket",
)


def candidates(docs: DataFrame) -> DataFrame:
    """``row, doc_id, path, run, start`` and the text on both sides. Reads ``row, doc_id, path, text``."""
    near = F.transform(
        F.split("text", RUN, -1),
        lambda g: F.struct(
            F.char_length(g).alias("n"), F.right(g, F.lit(NEAR)).alias("tail"), F.left(g, F.lit(NEAR)).alias("head")
        ),
    )
    cut = docs.select(
        "row", "doc_id", "path", F.regexp_extract_all("text", F.lit(RUN), 0).alias("runs"), near.alias("gaps")
    ).where(F.size("runs") > 0)
    items = F.transform(
        "runs",
        lambda r, i: F.struct(
            r.alias("run"),
            F.get("gaps", i)["n"].alias("gap"),
            F.get("gaps", i)["tail"].alias("before"),
            F.get("gaps", i + 1)["head"].alias("after"),
        ),
    )
    found = cut.select("row", "doc_id", "path", F.posexplode(items).alias("at", "item"))
    order = Window.partitionBy("row").orderBy("at")
    past = F.sum(F.char_length("item.run")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    start = F.sum("item.gap").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(past, F.lit(0))
    found = found.withColumn("start", start.cast("long"))
    return found.select("row", "doc_id", "path", "start", "item.run", "item.before", "item.after")


def lexicon(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Frequent words and letter pairs, counted over all texts.

    A run of random letters repeats by chance in a large corpus; a word's least count grows with the texts.
    """
    found = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{4,}"), 0)).alias("word"))
    least = max(2, docs.count() // WORD_TEXTS)
    words = found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    words = words.orderBy(F.desc("n"), "word").limit(WORDS)
    words = stage(words, "secret-words")
    letters = F.regexp_replace("word", r"[^a-z]", "")
    pairs = words.select(
        "n",
        F.explode(F.regexp_extract_all(letters, F.lit(PAIR), 1)).alias("pair"),
    )
    pairs = pairs.groupBy("pair").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pair").limit(200)
    return words.select("word"), sorted(r["pair"] for r in pairs.collect())


def _share(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)) / F.char_length(c)


def described(found: DataFrame, words: DataFrame, pairs: list[str]) -> DataFrame:
    """The candidates with all ``FEATURES``."""
    run, path = F.col("run"), F.lower(F.coalesce("path", F.lit("")))
    parts = found.select("run").distinct().withColumn(
        "word", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("run"), F.lit("[a-z]{4,}"), 0)))
    )
    # at most WORDS words
    covered = parts.join(F.broadcast(words), "word").groupBy("run").agg(F.sum(F.char_length("word")).alias("known"))
    low = F.regexp_replace(F.lower(run), "[^a-z]", "")
    two = F.regexp_extract_all(low, F.lit(PAIR), 1)
    usual = F.array(*map(F.lit, pairs)).cast("array<string>")
    last_word = F.lower(F.regexp_extract("before", r"(\p{L}+)[^\p{L}]*$", 1))
    near = F.right("before", F.lit(40))
    values = {
        "length": F.char_length(run),
        "digits": _share(run, "[0-9]"),
        "uppers": _share(run, "[A-Z]"),
        "marks": _share(run, "[^A-Za-z0-9]"),
        "switches": (F.regexp_count(run, F.lit(CLASSES)) - 1) / F.char_length(run),
        "distinct": F.size(F.array_distinct(F.split(run, ""))) / F.char_length(run),
        "pairs": F.when(
            F.size(two) > 0, F.size(F.filter(two, lambda p: F.array_contains(usual, p))) / F.size(two)
        ).otherwise(0),
        "covered": F.coalesce("known", F.lit(0)) / F.char_length(run),
        "config_path": path.rlike(r"\.(env|ya?ml|json|toml|cfg|conf|ini|pem|key|properties)$"),
        "test_path": path.rlike(r"test|example|fixture|doc"),
        "path_bucket": F.pmod(F.xxhash64(path), F.lit(16)),
        "assigned": near.rlike(ASSIGNED),
        "credential_near": near.rlike(CREDENTIAL),
        "quoted": near.rlike("[\"']$") & F.col("after").rlike("^[\"']"),
        "after_equals": near.rlike(r"[=:]\s*[\"']?$"),
        "digest_near": near.rlike(DIGEST),
        "issued": run.rlike(ISSUED),
        "placeholder": run.rlike(PLACEHOLDER),
        "word_bucket": F.pmod(F.xxhash64(last_word), F.lit(32)),
    }
    out = found.join(covered, "run", "left")
    return out.withColumns({k: v.cast("double") for k, v in values.items()}).drop("known")


def seeds(described_rows: DataFrame) -> Column:
    """1, 0, or null where nothing is beyond doubt."""
    no = (
        (F.col("placeholder") > 0)
        | (F.col("digits") == 1)
        | (F.col("digest_near") > 0)
        | (F.col("covered") >= 0.5)
        | ((F.col("pairs") > 0.8) & (F.col("digits") < 0.2) & (F.col("switches") < 0.15))
    )
    yes = (F.col("issued") > 0) | ((F.col("assigned") > 0) & (F.col("switches") > 0))
    return F.when(no, 0.0).when(yes, 1.0)


def learn(rows: DataFrame, label: str = "label") -> RandomForestClassificationModel | None:
    """A forest from all labelled, described findings; equal runs count once. None if a label is missing."""
    known = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), "run", *FEATURES)
    known = known.groupBy("run", "label").agg(F.min(F.struct(*FEATURES)).alias("f")).select("run", "label", "f.*")
    known = stage(known, "labelled-findings")
    if known.select("label").distinct().count() < 2:
        return None
    known = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(known)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, labelCol="label", featuresCol="features")
    return forest.fit(known)


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """Every candidate: its document, place, run, probability, and whether it is kept as a secret.

    ``labelled`` has ``path, before, run, after, label``, as reviewed findings would.
    """
    rows = docs.select(
        (col_of(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        col_of(id_col).alias("doc_id"),
        F.coalesce(col_of(text_col), F.lit("")).alias("text"),
        (col_of(path_col) if path_col in docs.columns else F.lit(None)).cast("string").alias("path"),
    )
    words, pairs = lexicon(rows)
    found = stage(described(stage(candidates(rows), "candidates"), words, pairs), "findings")
    found = found.withColumn("seed", seeds(found))
    model = learn(found, "seed") if labelled is None else learn(described(labelled, words, pairs))
    if model is None:
        judged = found.withColumn("probability", F.coalesce("seed", F.lit(0.0)))
    else:
        judged = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found))
        judged = judged.withColumn("probability", F.get(vector_to_array("probability"), F.lit(1)))
    return judged.select(
        "row", "doc_id", "start", "run", F.char_length("run").alias("length"), "probability",
        (F.col("probability") >= 0.5).alias("secret"),
    )


def redact(
    docs: DataFrame, mark: str = "[secret]", text_col: str = "text", chars_col: str | None = None, **columns: str
) -> DataFrame:
    """The documents with every secret replaced by ``mark``; all columns and rows are kept.

    ``chars_col``, if given, is set to the new length where a text changed.
    """
    row, spans, base = fresh(docs, "row_number"), fresh(docs, "spans"), docs.columns
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "secret-input")
    secrets = scan(numbered, text_col=text_col, row_col=row, **columns).where("secret")
    # the spans of one text
    places = secrets.groupBy(F.col("row").alias(row)).agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias(spans)
    )
    joined = numbered.join(places, row, "left")
    text = col_of(text_col)
    begin = lambda i: F.when(  # noqa: E731  where the text after span i - 1 begins
        i > 0, F.get(spans, i - 1)["start"] + F.get(spans, i - 1)["length"]
    ).otherwise(0)
    pieces = F.transform(
        F.col(spans),
        lambda s, i: F.substring(text, (begin(i) + 1).cast("int"), (s["start"] - begin(i)).cast("int")),
    )
    tail = F.substring(text, (begin(F.size(spans)) + 1).cast("int"), F.char_length(text))
    changed = F.array_join(F.concat(pieces, F.array(tail)), mark)
    out = {text_col: F.when(F.col(spans).isNull(), text).otherwise(changed)}
    if chars_col:
        length = F.char_length(out[text_col]).cast(docs.schema[chars_col].dataType)
        out[chars_col] = F.when(F.col(spans).isNull(), col_of(chars_col)).otherwise(length)
    return joined.select(*(out.get(c, col_of(c)).alias(c) for c in base))
