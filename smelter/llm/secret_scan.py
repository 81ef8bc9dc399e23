"""Secret scans: candidates from text, and a random forest that removes false positives.

A candidate is a run of letters, digits and ``_+/=.@-``: every one of at least 16 that
holds a digit, and any that is assigned to a credential's name.  Its features are its length, how its characters change class from one to
the next, how much of it common words cover, whether it looks like a path or an
address, and the words beside it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import saved, whole_text

MIN_LENGTH = 16
# Words that are a sign of assignment alone.
SIGNS = ("=", ":", ":=", "=>")
# The dictionary: so many of the corpus's most frequent words of four letters or more.
DICTIONARY_WORDS = 500
# Labelled findings the forest is grown from, at most; taken by hash.
TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 24, 6, 7

CREDENTIAL = r"(?i)(token|secret|passw|pwd|api_?key|apikey|access|auth|bearer|credential|private)"
_RUN = r"[A-Za-z0-9_+/=.@-]"
_OPENED = r"[\"'(\[<{]*"
# An optional name and sign of assignment inside the token, then the value.
_VALUE = rf"(?:([A-Za-z_]{{2,20}})[\"']?[=:])?{_OPENED}({_RUN}{{16,}})"
# A credential's name, up to the sign behind it; with the value inside the token, at most 20 letters on each side.
_NAME_END = r"[A-Za-z0-9_-]{0,20}[\"']?"
_GIVEN = rf"([A-Za-z_]{{0,20}}{CREDENTIAL.replace('(token', '(?:token')}[A-Za-z0-9_-]{{0,20}})[\"']?(?::=|=>|[=:]){_OPENED}({_RUN}+)"

FEATURES = [
    "length",
    "digits",
    "upper",
    "lower_case",
    "changes",
    "repeats",
    "distinct",
    "hex_only",
    "digits_only",
    "covered",
    "slashes",
    "dots",
    "at_signs",
    "credential_before",
    "assigned",
    "quoted",
    "number_before",
    "number_after",
]


# Matches in the column ``word``, with the place of the value and whether it is a credential's.
_FIND = """aggregate(
    arrays_zip(regexp_extract_all(word, {p}, 0), regexp_extract_all(word, {p}, 1), regexp_extract_all(word, {p}, 2)),
    named_struct('next', 1, 'all', cast(array() as array<struct<offset:int,value:string,name:string,given:boolean>>)),
    (s, m) -> named_struct(
        'next', locate(m['0'], word, s.next) + char_length(m['0']),
        'all', s.all || array(named_struct(
            'offset', locate(m['0'], word, s.next) + char_length(m['0']) - 1 - char_length(m['2']),
            'value', m['2'], 'name', m['1'], 'given', {given}))),
    s -> s.all)"""


def _matches(pattern: str, given: bool) -> Column:
    """(offset, value, name, given) of every match of ``pattern``, a name and a value, in the column ``word``."""
    quoted = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr(_FIND.format(p=quoted, given=str(given).lower()))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, at, offset, value, name, before, after, quoted, assigned) per candidate of (doc_id, text).

    ``at`` counts the document's tokens from 0, ``offset`` the characters of the token
    before the value; ``before`` and ``after`` are the neighbouring words, past a lone
    sign of assignment.  Null texts have none.
    """
    words = docs.select("doc_id", F.split(whole_text(), r"\s+").alias("words"))
    empty = F.lit("")

    def beside(at: Column) -> Column:
        return F.coalesce(F.get("words", at), empty)

    def look(word: Column, at: Column) -> Column:
        first, second = beside(at - 1), beside(at - 2)
        long = (F.char_length(word) >= MIN_LENGTH) & word.rlike("[0-9]")
        inside = (word.contains("=") | word.contains(":")) & word.rlike(CREDENTIAL)
        ended = first.endswith(":") | first.endswith("=") | first.endswith("=>")
        sign = first.isin(*SIGNS)
        behind = ended & ~sign & first.rlike(CREDENTIAL + _NAME_END + "(:=|=>|[=:])$")
        behind = behind | (sign & second.rlike(CREDENTIAL + _NAME_END + "$"))
        found = F.struct(
            at.alias("at"),
            word.alias("word"),
            second.alias("second"),
            first.alias("first"),
            beside(at + 1).alias("after"),
            behind.alias("behind"),
        )
        return F.when(long | inside | behind, found)

    looked = F.filter(F.transform("words", look), lambda f: f.isNotNull())
    flat = words.select("doc_id", F.explode_outer(looked).alias("f")).where("f is not null").select("doc_id", "f.*")
    behind = F.filter(_matches(rf"^{_OPENED}()({_RUN}+)", True), lambda m: F.col("behind"))
    plain = F.filter(_matches(_VALUE, False), lambda m: m["value"].rlike("[0-9]"))
    flat = flat.withColumn("plain", plain).withColumn("more", F.concat(_matches(_GIVEN, True), behind))

    # A value that both ways find is one candidate.
    def new(m: Column) -> Column:
        return ~F.exists("plain", lambda p: (p["offset"] == m["offset"]) & (p["value"] == m["value"]))

    every = flat.select("*", F.explode(F.concat("plain", F.array_distinct(F.filter("more", new)))).alias("m"))
    sign = F.col("first").isin(*SIGNS)
    return every.select(
        "doc_id",
        F.col("at").cast("long").alias("at"),
        F.col("m.offset").cast("long").alias("offset"),
        F.col("m.value").alias("value"),
        F.col("m.name").alias("name"),
        F.when(sign, F.col("second")).otherwise(F.col("first")).alias("before"),
        "after",
        F.col("word").rlike("[\"']").alias("quoted"),
        (sign | F.col("m.given") | (F.col("m.name") != "")).alias("assigned"),
    )


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent plain words of all documents, ties by the word."""
    words = docs.select(F.explode_outer(F.split(whole_text(), " ")).alias("word"))
    plain = words.where(F.char_length("word").between(4, 20)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = plain.where(F.col("word").rlike("^[a-z]+$")).orderBy(F.desc("n"), "word").limit(size)
    return [r["word"] for r in top.collect()]


def featured(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with the columns of FEATURES."""
    value = F.col("value")

    def count(pattern: str) -> Column:
        return (F.char_length(value) - F.char_length(F.regexp_replace(value, pattern, ""))).cast("double")

    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d")
    runs = F.char_length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    size = F.char_length(value)
    listed = "|".join(sorted(words, key=lambda w: (-len(w), w)))
    covered = size - F.char_length(F.regexp_replace(F.lower(value), listed, "")) if listed else F.lit(0)
    flag = lambda test: F.coalesce(test, F.lit(False)).cast("double")
    return found.withColumns(
        {
            "length": size.cast("double"),
            "digits": count("[0-9]") / size,
            "upper": count("[A-Z]") / size,
            "lower_case": count("[a-z]") / size,
            "changes": (runs - 1) / size,
            "repeats": (size - F.char_length(F.regexp_replace(value, r"(.)\1+", "$1"))) / size,
            "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
            "hex_only": flag(value.rlike("^[0-9a-fA-F]+$")),
            "digits_only": flag(value.rlike("^[0-9]+$")),
            "covered": covered / size,
            "slashes": count("/"),
            "dots": count("[.]"),
            "at_signs": count("@"),
            "credential_before": flag(F.concat_ws(" ", "name", "before").rlike(CREDENTIAL)),
            "assigned": flag(F.col("assigned")),
            "quoted": flag(F.col("quoted")),
            "number_before": flag(F.col("before").rlike("^[^A-Za-z]*[0-9]")),
            "number_after": flag(F.col("after").rlike("^[^A-Za-z]*[0-9]")),
        }
    )


def audited(found: DataFrame) -> DataFrame:
    """Findings with a label, where an auditor's plain rules decide.

    1: the key format ``AKIA`` and 16 capitals or digits, or a value of hex digits
    assigned to a credential's name.  0: addresses, digits alone, paths, and hex
    digits that nothing is assigned to.  Others stay without a label and are left out.
    """
    value = F.col("value")
    credential = F.concat_ws(" ", "name", "before").rlike(CREDENTIAL)
    good = value.rlike("^AKIA[0-9A-Z]{16}$") | (value.rlike("^[0-9a-f]{16,}$") & credential & F.col("assigned").cast("boolean"))
    bad = value.rlike("@|^[0-9]+$|^[a-z.]*/") | (value.rlike("^[0-9a-f]+$") & ~credential)
    label = F.when(good, 1.0).when(bad, 0.0)
    return found.withColumn("label", label).where("label is not null")


def scored(found: DataFrame, findings: DataFrame) -> DataFrame:
    """``found`` with ``score``, the forest's probability of a secret.

    ``findings`` are rows with features and a label of 0 or 1; at most TRAINING_ROWS
    of them are used, the first by hash.  With labels of one kind that kind is every
    score; without any it is 0.5.
    """
    order = [F.xxhash64("doc_id", "at"), F.col("doc_id"), F.col("at"), F.col("offset"), F.col("value")]
    sample = saved(findings.select(*FEATURES, "label", "doc_id", "at", "offset", "value").orderBy(*order).limit(TRAINING_ROWS), "findings")
    kinds = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return found.withColumn("score", F.lit(kinds[0] if kinds else 0.5).cast("double"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    # A copy has no training summary.  That refers to the session, which cannot go to tasks once something was observed in it.
    model = forest.fit(assembler.transform(sample)).copy()
    out = model.transform(assembler.transform(found))
    return out.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """Scored candidates of ``docs`` (doc_id, text; other columns are ignored).

    ``findings`` as in ``scored``; by default the candidates that ``audited`` labels
    in the documents whose crc32(doc_id) mod 5 is not 0, so that the rest can judge
    the forest.  Null and empty texts give no rows, an empty table no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = saved(featured(candidates(rows), dictionary(rows)), "candidates")
    if findings is None:
        kept = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) != 0
        findings = audited(found).where(kept)
    return scored(found, findings)
