"""Benchmark decontamination by template canonicalisation.

Text is cut into tokens at white space.  A token's canonical form is a typed
placeholder for a number (#n), a capitalised word (#p) or a unit behind a number
(#u), else its letters and digits in lower case.  Windows of eight canonical
tokens are joined by hash with those of the benchmark, compared token by token, and
kept if one word of the item always stands for one word of the passage: a
question with other numbers or names has the same template and a consistent map.

Windows of plain lower-case words are joined beside them, for copies whose capitals
have gone, and whole items stand for those that are too short for a window or too
dense in numbers and names.

Documents are cut into pieces of a few hundred tokens first.  Spark holds all matches of
a row at once, so these keep the tokens of their window only: with those of the row, what
a task holds would grow with the square of a text's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import whole_text, with_row_key

WINDOW = 8
SHORT = 4  # tokens of the shortest item
PASSAGE = 20  # tokens in a row that are a leak, however long the item
MIN_WORDS = 5  # of a benchmark window that are no placeholders; fewer say too little
MIN_COVERAGE = 0.5  # of an item's canonical windows
# Tokens of a document whose windows stand in one row; more if an item's window is over a quarter of that.
PIECE = 512
# Up to so many benchmark windows are sent to every task; more are met through a shuffle.
FEW_WINDOWS = 100_000

UNITS = (
    "kg|g|mg|lb|lbs|oz|t|km|m|cm|mm|mile|miles|ft|feet|inch|inches|yards|l|ml|litres|liters|gallons|s|sec|seconds|"
    "minutes|min|h|hours|hour|days|day|weeks|week|months|month|years|year|dollars|euros|pounds|cents|percent|degrees"
)


def tidy_text(text: Column) -> Column:
    """One space between tokens, and no # of its own."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "#", ""), r"\s+", " "))


def canonical_text(tidy: Column) -> Column:
    """Canonical forms, a space apart, one for each token of ``tidy`` (some may be empty)."""
    named = F.regexp_replace(tidy, r"(^| )[^\p{L}\p{N} ]*[A-Z][\p{L}'-]+", "$1#p")
    numbered = F.regexp_replace(named, r"(^| )[^\p{L}\p{N}# ]*[0-9][0-9.,:/%-]*", "$1#n")
    measured = F.regexp_replace(numbered, rf"(#n )({UNITS})([^\p{{L}}\p{{N}}]|$)", "$1#u$3")
    return F.regexp_replace(F.lower(measured), r"[^\p{L}\p{N}# ]", "")


def _cut(tidy: DataFrame, keys: list[str], size: int, after: int) -> DataFrame:
    """Texts ``tidy`` in pieces that begin every ``size`` tokens, at ``start``, and hold ``after`` tokens more; tokens ``raw``.

    All but the first begin with the token before, ``lead`` of them: a unit is one only behind a number.
    """
    tokens = tidy.select(*keys, "tidy", F.split("tidy", " ").alias("tokens"))
    starts = F.sequence(F.lit(0), F.size("tokens") - 1, F.lit(size))
    begun = tokens.select(*keys, "tidy", "tokens", F.explode(starts).alias("start"))
    lead = F.least("start", F.lit(1))
    part = F.slice("tokens", F.col("start") + 1 - lead, lead + size + after)
    whole = F.when(F.size("tokens") <= size, F.col("tidy"))
    parts = begun.select(*keys, "start", lead.alias("lead"), part.alias("raw"), whole.alias("whole"))
    return parts.select(*keys, "start", "lead", "raw", F.coalesce("whole", F.array_join("raw", " ")).alias("tidy"))


def _forms(rows: DataFrame, keys: list[str], text: str, short: bool, longest: int = 0) -> DataFrame:
    """``keys``, tokens ``raw``, canonical ``words``, ``plain`` words, and ``hashes`` of windows.

    ``hashes`` has a window from each position on: ``many`` canonical ones, as many plain
    ones, and with ``short`` plain ones of four tokens.  Hashes of 1, 2, 4 words give those
    of 2, 4, 8.  With ``longest``, the tokens of the longest window that will be compared,
    texts come in pieces: ``start`` is the position of a piece's first window, and ``lead``
    tokens stand before it.
    Each array is a column of its own before it is used twice, or it would be computed twice.
    """
    tidy = rows.select(*keys, tidy_text(whole_text(text)).alias("tidy"))
    if longest:
        size = max(PIECE, 4 * longest)
        cut = _cut(tidy, keys, size, longest - 1)
    else:
        size = None
        cut = tidy.select(*keys, F.lit(0).alias("start"), F.lit(0).alias("lead"), F.split("tidy", " ").alias("raw"), "tidy")
    plain = F.regexp_replace(F.lower("tidy"), r"[^\p{L}\p{N} ]", "")
    kept = [*keys, "start", "lead", "raw", "words", "plain"]
    forms = [canonical_text(F.col("tidy")), plain]
    split = cut.select(*kept[:-2], *(F.split(f, " ").alias(c) for f, c in zip(forms, kept[-2:])))
    hashed = split.select(
        *kept,
        F.transform("words", lambda w: F.xxhash64(w)).alias("canonical"),
        F.transform("plain", lambda w: F.xxhash64(w, F.lit(1))).alias("folded"),
    )
    few = F.array().cast("array<bigint>")
    width = 1
    while width < WINDOW:
        later = [F.slice(c, F.lit(width + 1), F.size("words")) for c in ("canonical", "folded")]
        pair = lambda one, two: F.xxhash64(one, two)
        wider = [F.zip_with(c, t, pair).alias(c) for c, t in zip(("canonical", "folded"), later)]
        if width == SHORT:
            few = F.slice("folded", F.col("lead") + 1, _places(SHORT, size)) if short else few
            hashed = hashed.select(*kept, *wider, few.alias("few"))
        else:
            hashed = hashed.select(*kept, *wider, *(["few"] if "few" in hashed.columns else []))
        width *= 2
    many = _places(WINDOW, size)
    whole = [F.slice(c, F.col("lead") + 1, many) for c in ("canonical", "folded")]
    return hashed.select(*kept, many.alias("many"), F.concat(*whole, "few").alias("hashes"))


def _places(width: int, size: int | None) -> Column:
    """How many windows of ``width`` tokens there are, at most ``size``."""
    there = F.greatest(F.size("words") - F.col("lead") - (width - 1), F.lit(0))
    return there if size is None else F.least(there, F.lit(size))


def _placed(forms: DataFrame) -> DataFrame:
    """One row per window: ``hash``, ``kind`` (0 canonical, 1 plain, 2 plain of four) and ``pos`` in the text."""
    kept = [c for c in forms.columns if c != "hashes"]
    # Outer, since for an inner one Spark would compute the whole array once more to drop texts without windows.
    found = forms.select(*kept, F.posexplode_outer("hashes").alias("at", "hash"))
    many = F.col("many")
    kind = F.when(F.col("at") < many, 0).when(F.col("at") < 2 * many, 1).otherwise(2)
    return found.select(*kept, "hash", kind.alias("kind"), (F.col("start") + F.col("at") - kind * many).alias("pos"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """What is looked for: windows of the items (item_id, text), or items as a whole.

    Canonical windows need five words that are no placeholders; an item that has none
    stands as one window over all its tokens if these hold five.  Plain windows need
    five words with a letter or digit; an item of four to seven such tokens is one
    window.  Items of fewer tokens, null texts and null ids are never found.  Columns:
    item_id, form (0 canonical, 1 plain), kind and hash of the window to look up,
    item_pos, item_raw, item_words, item_windows (how many the item has of that form).
    """
    items = benchmark.where("item_id is not null").select("item_id", "text").distinct()
    windows = _placed(_forms(items, ["item_id"], "text", short=True)).where("hash is not null")
    tokens, kind = F.size("words"), F.col("kind")
    cut = lambda c, size: F.slice(c, F.col("pos") + 1, size)
    said = lambda c: F.size(F.filter(c, lambda w: (w != "") & ~w.startswith("#")))
    filled = F.when(kind == 0, cut("words", WINDOW)).otherwise(cut("plain", WINDOW))
    plenty = said(filled) >= F.when(kind == 2, SHORT).otherwise(MIN_WORDS)
    ready = windows.select("*", plenty.alias("plenty"), (kind > 0).cast("int").alias("form"))
    dense = ready.where("kind = 0").groupBy("item_id").agg((~F.bool_or("plenty")).alias("dense"))
    marked = ready.join(dense, "item_id", "left")
    whole = (kind == 0) & F.col("dense") & (F.col("pos") == 0) & (said("words") >= MIN_WORDS)
    wanted = marked.select("*", whole.alias("whole")).where(
        F.col("whole") | ((kind < 2) & F.col("plenty")) | ((kind == 2) & F.col("plenty") & (F.col("pos") == 0) & (tokens < WINDOW))
    )
    size = F.when(F.col("whole") | (kind == 2), tokens).otherwise(WINDOW)
    kept = wanted.select(
        "item_id",
        "form",
        "kind",
        "hash",
        F.col("pos").alias("item_pos"),
        cut("raw", size).alias("item_raw"),
        F.when(kind == 0, cut("words", size)).otherwise(cut("plain", size)).alias("item_words"),
    )
    counts = kept.groupBy("item_id", "form").agg(F.count_distinct("item_pos").alias("item_windows"))
    return kept.join(counts, ["item_id", "form"])


def _slots(item_words: Column, item_raw: Column, doc_raw: Column) -> Column:
    """(item's word, document's word) behind each placeholder of a window."""
    bare = lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]", "")
    zipped = F.arrays_zip(item_words.alias("w"), item_raw.alias("i"), doc_raw.alias("d"))
    filled = F.filter(zipped, lambda z: z["w"].startswith("#"))
    return F.transform(filled, lambda z: F.struct(bare(z["i"]).alias("i"), bare(z["d"]).alias("d")))


def _meetings(forms: DataFrame, windows: DataFrame, few: bool) -> DataFrame:
    """Windows of ``forms`` beside the benchmark windows of the same hash.

    Few benchmark windows are sent to every task.  Else only hashes and places go
    through a shuffle, and the texts are read again for the places found.
    """
    if few:
        return _placed(forms).join(F.broadcast(windows), ["hash", "kind"])
    hashes = windows.select("hash", "kind").distinct()
    place = {"row_id": "spot_id", "row_hash": "spot_hash", "start": "spot_start"}
    spots = _placed(forms).select(*place, "hash", "kind", "pos").join(hashes, ["hash", "kind"]).distinct()
    found = spots.join(windows, ["hash", "kind"]).withColumnsRenamed(place)
    same = (F.col("row_hash") == F.col("spot_hash")) & F.col("row_id").eqNullSafe(F.col("spot_id"))
    return forms.drop("hashes").join(found, same & (F.col("start") == F.col("spot_start")))


def _matches(docs: DataFrame, windows: DataFrame, short: bool, few: bool, longest: int) -> DataFrame:
    met = _meetings(_forms(docs, ["row_id", "row_hash"], "text", short, longest), windows, few)
    begin = F.col("pos") - F.col("start") + F.col("lead") + 1
    cut = lambda c: F.slice(c, begin, F.size("item_words"))
    doc_words = F.when(F.col("form") == 0, cut("words")).otherwise(cut("plain"))
    # Not written as an equality, which would become a part of the join key, computed for every window.
    met = met.where((doc_words <= F.col("item_words")) & (doc_words >= F.col("item_words")))
    # Only the window's own tokens, cut in the code that joins; what is made of them would run behind it, on whole rows.
    return met.select(
        "row_id", "row_hash", "item_id", "form", "item_windows", "item_pos", "pos", "item_words", "item_raw", cut("raw").alias("doc_raw")
    ).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Leaks of benchmark items (item_id, text) in documents (doc_id, text), one row per document and item.

    A leak is half of an item's canonical windows, or all of its plain ones, or a
    passage of 20 tokens in a row in either form.  Columns: row_id and row_hash (the
    document's id and the hash of its text), item_id, matched and item_windows,
    coverage, first_pos (token), changed (how many words behind placeholders differ from
    the item's; 0 for a plain copy), all of the form with the greater coverage, the
    canonical one if equal.  Rows that repeat count once; null texts have no leaks;
    without leaks, or with an empty table on either side, no rows.
    """
    windows = benchmark_windows(benchmark)
    size = windows.agg(F.count(F.lit(1)), F.max("kind"), F.max(F.size("item_words"))).first()
    rows = with_row_key(docs.select("doc_id", "text"), "row")
    found = _matches(rows, windows, short=size[1] == 2, few=size[0] <= FEW_WINDOWS, longest=max(WINDOW, size[2] or 0))
    pair = ["row_id", "row_hash", "item_id", "form", "item_windows"]
    lines = found.groupBy(*pair, (F.col("pos") - F.col("item_pos")).alias("shift"))
    slots = _slots(F.col("item_words"), F.col("item_raw"), F.col("doc_raw"))
    passages = lines.agg(
        F.sort_array(F.collect_set("item_pos")).alias("places"),
        F.min("pos").alias("first_pos"),
        F.array_distinct(F.flatten(F.collect_set(slots))).alias("slots"),
    )
    sources = F.size(F.array_distinct(F.transform("slots", lambda s: s["i"])))
    row = PASSAGE - WINDOW + 1  # windows of a passage
    ahead = F.slice("places", F.lit(row), F.greatest(F.size("places"), F.lit(1)))
    in_a_row = F.exists(F.zip_with("places", ahead, lambda a, b: b - a), lambda gap: F.coalesce(gap == row - 1, F.lit(False)))
    hits = passages.where(sources == F.size("slots")).select("*", in_a_row.alias("passage")).groupBy(*pair).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("matched"),
        F.min("first_pos").cast("long").alias("first_pos"),
        F.size(
            F.filter(F.array_distinct(F.flatten(F.collect_list("slots"))), lambda s: s["i"] != s["d"])
        ).cast("long").alias("changed"),
        F.bool_or("passage").alias("passage"),
    )
    coverage = F.col("matched") / F.col("item_windows")
    least = F.when(F.col("form") == 0, MIN_COVERAGE).otherwise(1.0)
    leaks = hits.withColumn("coverage", coverage).where(F.col("passage") | (F.col("coverage") >= least))
    values = ["matched", "item_windows", "coverage", "first_pos", "changed"]
    better = F.struct("coverage", -F.col("form"))
    best = leaks.groupBy("row_id", "row_hash", "item_id").agg(F.max_by(F.struct(*values), better).alias("best"))
    return best.select("row_id", "row_hash", "item_id", "best.*")


LEAKS_SQL = rf"""
WITH tidy AS (
    SELECT doc_id, text AS body, trim(regexp_replace(replace(coalesce(text, ''), '#', ''), '\s+', ' ', 'g')) AS t
    FROM (SELECT DISTINCT doc_id, text FROM documents)
), tidy_items AS (
    SELECT item_id, trim(regexp_replace(replace(coalesce(text, ''), '#', ''), '\s+', ' ', 'g')) AS t
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), named AS (
    SELECT doc_id AS id, body, t, regexp_replace(t, '(^| )[^\p{{L}}\p{{N}} ]*[A-Z][\p{{L}}''-]+', '\1#p', 'g') AS c, 0 AS kind FROM tidy
    UNION ALL
    SELECT item_id, NULL, t, regexp_replace(t, '(^| )[^\p{{L}}\p{{N}} ]*[A-Z][\p{{L}}''-]+', '\1#p', 'g'), 1 FROM tidy_items
), numbered AS (
    SELECT id, body, kind, t, regexp_replace(c, '(^| )[^\p{{L}}\p{{N}}# ]*[0-9][0-9.,:/%-]*', '\1#n', 'g') AS c FROM named
), measured AS (
    SELECT id, body, kind, t, regexp_replace(c, '(#n )({UNITS})([^\p{{L}}\p{{N}}]|$)', '\1#u\3', 'g') AS c FROM numbered
), tokens AS (
    SELECT id, body, kind, string_split(t, ' ') AS raw,
           string_split(regexp_replace(lower(c), '[^\p{{L}}\p{{N}}# ]', '', 'g'), ' ') AS words,
           string_split(regexp_replace(lower(t), '[^\p{{L}}\p{{N}} ]', '', 'g'), ' ') AS plain
    FROM measured
), forms AS (
    SELECT id, body, kind, 0 AS form, raw, words FROM tokens UNION ALL SELECT id, body, kind, 1, raw, plain FROM tokens
), cut AS (
    SELECT id, form, pos, raw[pos:pos + {WINDOW} - 1] AS raw, words[pos:pos + {WINDOW} - 1] AS words
    FROM (SELECT *, unnest(range(1, len(words) - {WINDOW} + 2)) AS pos FROM forms WHERE kind = 1 AND id IS NOT NULL)
), eligible AS (
    SELECT * FROM cut WHERE len(list_filter(words, lambda w: w <> '' AND NOT starts_with(w, '#'))) >= {MIN_WORDS}
), wanted AS (
    SELECT * FROM eligible
    UNION ALL
    SELECT id, form, 1, raw, words FROM forms
    WHERE kind = 1 AND form = 0 AND len(words) >= {WINDOW} AND id NOT IN (SELECT id FROM eligible WHERE form = 0)
      AND len(list_filter(words, lambda w: w <> '' AND NOT starts_with(w, '#'))) >= {MIN_WORDS}
    UNION ALL
    SELECT id, form, 1, raw, words FROM forms
    WHERE kind = 1 AND form = 1 AND id IS NOT NULL AND len(words) < {WINDOW}
      AND len(list_filter(words[1:{WINDOW}], lambda w: w <> '')) >= {SHORT}
), counted AS (
    SELECT id, form, count(DISTINCT pos) AS item_windows FROM wanted GROUP BY ALL
), sizes AS (
    SELECT DISTINCT form, len(words) AS size FROM wanted
), windows AS (
    SELECT id, body, form, pos, raw[pos:pos + size - 1] AS raw, words[pos:pos + size - 1] AS words
    FROM (SELECT f.*, s.size, unnest(range(1, len(words) - s.size + 2)) AS pos
          FROM forms f JOIN sizes s ON f.form = s.form WHERE f.kind = 0)
), met AS (
    SELECT DISTINCT d.id AS doc_id, d.body, i.id AS item_id, i.form, c.item_windows, d.pos, i.pos AS item_pos, d.pos - i.pos AS shift,
           i.words, i.raw AS item_raw, d.raw AS doc_raw
    FROM windows d JOIN wanted i ON d.form = i.form AND d.words = i.words JOIN counted c ON c.id = i.id AND c.form = i.form
), slots AS (
    SELECT DISTINCT doc_id, body, item_id, form, shift, i, d
    FROM (SELECT doc_id, body, item_id, form, shift, unnest(words) AS w,
                 regexp_replace(unnest(item_raw), '[^\p{{L}}\p{{N}}]', '', 'g') AS i,
                 regexp_replace(unnest(doc_raw), '[^\p{{L}}\p{{N}}]', '', 'g') AS d
          FROM met)
    WHERE starts_with(w, '#')
), odd AS (
    SELECT doc_id, body, item_id, shift FROM slots GROUP BY ALL HAVING count(DISTINCT i) <> count(*)
), good AS (
    SELECT m.* FROM met m WHERE m.form = 1 OR NOT EXISTS (
        SELECT 1 FROM odd o WHERE o.doc_id IS NOT DISTINCT FROM m.doc_id AND o.body = m.body
                              AND o.item_id = m.item_id AND o.shift = m.shift)
), changes AS (
    SELECT s.doc_id, s.body, s.item_id, s.form, count(DISTINCT (s.i, s.d)) AS changed
    FROM slots s JOIN (SELECT DISTINCT doc_id, body, item_id, form, shift FROM good) g
      ON s.doc_id IS NOT DISTINCT FROM g.doc_id AND s.body = g.body AND s.item_id = g.item_id AND s.shift = g.shift AND s.form = g.form
    WHERE s.i <> s.d GROUP BY ALL
), steps AS (
    SELECT *, item_pos - dense_rank() OVER (PARTITION BY doc_id, body, item_id, form, shift ORDER BY item_pos) AS step FROM good
), passages AS (
    SELECT DISTINCT doc_id, body, item_id, form FROM (
        SELECT doc_id, body, item_id, form FROM steps
        GROUP BY doc_id, body, item_id, form, shift, step HAVING count(DISTINCT item_pos) > {PASSAGE} - {WINDOW})
), hits AS (
    SELECT doc_id, body, item_id, form, item_windows, count(DISTINCT item_pos) AS matched, min(pos) - 1 AS first_pos FROM good GROUP BY ALL
), leaks AS (
    SELECT h.*, h.matched / h.item_windows AS coverage, coalesce(c.changed, 0) AS changed,
           row_number() OVER (PARTITION BY h.doc_id, h.body, h.item_id ORDER BY h.matched / h.item_windows DESC, h.form) AS best
    FROM hits h
    LEFT JOIN changes c ON c.doc_id IS NOT DISTINCT FROM h.doc_id AND c.body = h.body AND c.item_id = h.item_id AND c.form = h.form
    LEFT JOIN passages p ON p.doc_id IS NOT DISTINCT FROM h.doc_id AND p.body = h.body AND p.item_id = h.item_id AND p.form = h.form
    WHERE p.item_id IS NOT NULL OR h.matched >= CASE WHEN h.form = 0 THEN {MIN_COVERAGE} ELSE 1 END * h.item_windows
)
SELECT doc_id, item_id, matched, item_windows, coverage, first_pos, changed FROM leaks WHERE best = 1
"""
