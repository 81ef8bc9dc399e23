"""Substring dedup: runs of consecutive sentences that occurred before are removed.

A run is grown from every sentence, forward and backward, until it holds a least
number of words: one long sentence or as many short ones as that takes.  So every
sentence of a repeated stretch with that many words lies in a run of the stretch.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.llm.common import whole_text

# Words a run must hold (spaces plus one, sentence by sentence): half of a passage of fifty, whose ends
# may lie within sentences.  Fewer meet by chance, or are phrases that many texts share.
LEAST_WORDS = 25

BLANK = " \t\n\f\r"
# Up to a full stop before white space, or a newline, with the white space behind it.
SENTENCE = r"(?:[^.!?\n]+|[.!?]+[^ \t\n\f\r.!?])*[.!?]*[ \t\n\f\r]*"
_SENTENCE = re.compile(SENTENCE)
LAST_ID = 2**63 - 1


def sentences(text: str) -> list[str]:
    """Pieces whose concatenation is the text, each with the white space behind it."""
    return [s for s in _SENTENCE.findall(text) if s]


def runs(words: list[int], least: int) -> np.ndarray:
    """(first, last) of the shortest run of at least ``least`` words that begins at, or ends with, each sentence; sorted."""
    upto = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    # Runs that begin at i end where the words before i plus ``least`` are reached; likewise backward.
    ends = np.searchsorted(upto, upto[:-1] + least)
    forward = np.flatnonzero(ends < len(upto))
    starts = np.searchsorted(upto, upto[1:] - least, side="right") - 1
    backward = np.flatnonzero(starts >= 0)
    both = np.concatenate([np.stack([forward, ends[forward] - 1], axis=1), np.stack([starts[backward], backward], axis=1)])
    return np.unique(both, axis=0)


def _run_hashes(pieces: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of a text, and the high and low hash of each."""
    bare = [p.strip(BLANK) for p in pieces]
    found = runs([b.count(" ") + 1 for b in bare], least)
    digests = b"".join(xxhash.xxh3_128_digest("\x1f".join(bare[i : j + 1])) for i, j in found.tolist())
    both = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
    return found, both[:, 0], both[:, 1]


def _runs(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, highs, lows = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, high, low = _run_hashes(sentences(text.as_py()), least)
                _, once = np.unique(low, return_index=True)
                docs.append(np.full(len(once), doc, dtype=np.int64))
                highs.append(high[once])
                lows.append(low[once])
            if docs:
                columns = [pa.array(np.concatenate(x)) for x in (highs, lows, docs)]
                yield pa.RecordBatch.from_arrays(columns, ["high", "low", "doc"])

    return extract


def _without_runs(least: int, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed = [], [], []
            for text, later in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                text, later = text.as_py(), later.as_py()
                pieces = sentences(text or "")
                found, _, lows = _run_hashes(pieces, least)
                known, seen, gone = set(later or ()), set(), set()
                for (first, last), low in zip(found.tolist(), lows.tolist()):
                    if low in known or low in seen:
                        gone.update(range(first, last + 1))
                    seen.add(low)
                texts.append("".join(p for i, p in enumerate(pieces) if i not in gone) if gone else text)
                counts.append(len(pieces))
                removed.append(len(gone))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, type=batch.column(at).type)
            names = batch.schema.names[:-1] + ["sentences", "removed_sentences"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names)

    return rewrite


def drop_repeated_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``text`` shortened, and the counts ``sentences``, ``removed_sentences``.

    From each sentence the shortest run of at least ``least_words`` words is taken
    forward and backward, hashed (128 bits) and joined over all documents.  Its first
    occurrence, by doc_id and place, stays; the sentences of any other are removed.  So
    no sentence stays of a later stretch that repeats that many words or more, and
    shorter repeats stay.  Rows that
    share a doc_id count as one document and do not remove from each other; a null
    id comes last.  Null and empty texts stay as they are.  Columns of ``docs``
    named like the two counts are replaced; others pass through.
    """
    docs = docs.drop("sentences", "removed_sentences")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    rows = docs.select(key.alias("doc"), whole_text().alias("text"))
    runs = rows.mapInArrow(_runs(least_words), "high long, low long, doc long")
    repeated = runs.groupBy("high", "low").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = runs.join(repeated, ["high", "low"]).where("doc > first")
    lists = later.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set("low").alias("__later"))
    known = docs.join(lists, key == F.col("__doc"), "left").select(*[docs[c] for c in docs.columns], "__later")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("sentences", T.LongType()), T.StructField("removed_sentences", T.LongType())]
    )
    return known.mapInArrow(_without_runs(least_words, docs.columns.index("text")), schema)


REPEATS_SQL = rf"""
WITH pieces AS (
    SELECT doc_id, text, list_filter(regexp_extract_all(coalesce(text, ''), '{SENTENCE}'), lambda p: p <> '') AS p FROM documents
), bare AS (
    SELECT doc_id, text, p, list_transform(p, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(12) || chr(13))) AS b FROM pieces
), placed AS (
    SELECT doc_id, unnest(range(1, len(b) + 1)) AS i, unnest(list_transform(b, lambda x: len(x) - len(replace(x, ' ', '')) + 1)) AS words
    FROM bare
), counted AS (
    SELECT doc_id, i, sum(words) OVER w - words AS before, sum(words) OVER w AS upto
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), ends AS (
    SELECT a.doc_id, a.i AS first, z.i AS last FROM counted a ASOF JOIN counted z ON a.doc_id = z.doc_id AND a.before + {LEAST_WORDS} <= z.upto
    UNION
    SELECT z.doc_id, a.i, z.i FROM counted z ASOF JOIN counted a ON z.doc_id = a.doc_id AND z.upto - {LEAST_WORDS} >= a.before
), ranked AS (
    SELECT doc_id, first, last, row_number() OVER (PARTITION BY array_to_string(b[first:last], chr(31)) ORDER BY doc_id, first) AS rn
    FROM ends JOIN bare USING (doc_id)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM ranked WHERE rn > 1
), kept AS (
    SELECT doc_id, string_agg(piece, '' ORDER BY i) AS text
    FROM (SELECT doc_id, unnest(p) AS piece, unnest(range(1, len(p) + 1)) AS i FROM bare) ANTI JOIN gone USING (doc_id, i)
    GROUP BY doc_id
), counts AS (SELECT doc_id, count(*) AS removed FROM gone GROUP BY doc_id)
SELECT bare.doc_id, CASE WHEN removed IS NULL THEN bare.text ELSE coalesce(kept.text, '') END AS text,
       CAST(len(bare.p) AS BIGINT) AS sentences, coalesce(removed, 0) AS removed_sentences
FROM bare LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""
