"""Ranked lexical search by the Best Position Algorithm over impact lists.

Documents are dealt into shards of bounded size.  In a shard every term has a list of
its documents by falling impact.  A query reads its terms' lists in step; whatever
document comes up has its impacts in all lists fetched by direct access, which also
marks its positions there as seen.  A list's best position is the end of the seen
positions that are contiguous from its start, so no unseen document has more impact
than stands there.  Reading stops once the sum over the lists lies strictly below the
kth best score.  The best of all shards are then merged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from smelter.llm.common import saved

# Terms: maximal runs of ASCII letters and digits and all non-ASCII characters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of distinct query terms that go to every task; more queries are run in blocks.
BLOCK_BYTES = 4 << 20
# (document, term) pairs in a shard, on average.
SHARD_POSTINGS = 1 << 21
# Shards whose results one task of the first merge sees.
MERGE_SHARDS = 256
# Positions read at first from each list between two checks of the threshold.
FIRST_READ = 16

_SPACED = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_FOLDED = _SPACED.translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_FOLDED).split()


def query_terms(text: Column) -> Column:
    """Distinct terms of a text, in the order of their first occurrence."""
    folded = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0)))


def _indexed(vocabulary: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents with a term: their length, the query terms in them and how often each occurs."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, ends, found, times = [], [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms(text.as_py() or "")
                if words:
                    hits = [(vocabulary[w], n) for w, n in Counter(words).items() if w in vocabulary]
                    ids.append(doc_id)
                    lengths.append(len(words))
                    found += [t for t, _ in hits]
                    times += [n for _, n in hits]
                    ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (found, times)]
            columns = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "times"])

    return index


class ImpactLists:
    """One shard: the postings of each term by falling impact, and by document for direct access."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int, vocabulary: int):
        order = np.lexsort((doc, -impact, term))
        self.docs, self.terms, self.impacts = doc[order], term[order], impact[order]
        self.starts = np.searchsorted(self.terms, np.arange(vocabulary + 1))
        self.by_doc = np.argsort(self.docs, kind="stable")
        self.doc_starts = np.searchsorted(self.docs[self.by_doc], np.arange(documents + 1))

    def direct(self, docs: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of each document over the wanted terms (a mask), and the places of its wanted postings."""
        counts = self.doc_starts[docs + 1] - self.doc_starts[docs]
        ends = np.cumsum(counts)
        places = self.by_doc[np.arange(ends[-1]) + np.repeat(self.doc_starts[docs] - ends + counts, counts)]
        hit = wanted[self.terms[places]]
        sums = np.concatenate([[0], np.cumsum(np.where(hit, self.impacts[places], 0))])
        return sums[ends] - sums[ends - counts], places[hit]


def best_positions(lists: ImpactLists, wanted: np.ndarray, k: int, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best documents for the wanted terms, their scores, and how many documents were accessed.

    ``ties`` orders documents of equal score.  Scores of 0 do not count.
    """
    mask = np.zeros(len(lists.starts) - 1, bool)
    mask[wanted] = True
    begins, ends = lists.starts[wanted], lists.starts[wanted + 1]
    begins, ends = begins[ends > begins], ends[ends > begins]
    top_docs, top_scores = np.empty(0, np.int64), np.empty(0, np.int64)
    met, seen = np.zeros(len(ties), bool), np.zeros(len(lists.docs), bool)
    best = begins.copy()  # the first position of each list not known to be seen
    read, step, accessed = 0, FIRST_READ, 0
    longest = int((ends - begins).max(initial=0))
    while read < longest:
        fresh = np.unique(np.concatenate([lists.docs[b + read : min(b + read + step, e)] for b, e in zip(begins, ends)]))
        fresh = fresh[~met[fresh]]
        read, step = read + step, step * 2
        if len(fresh):
            met[fresh] = True
            accessed += len(fresh)
            scores, places = lists.direct(fresh, mask)
            seen[places] = True
            top_docs, top_scores = np.concatenate([top_docs, fresh]), np.concatenate([top_scores, scores])
            kept = np.lexsort((ties[top_docs], -top_scores))[:k]
            top_docs, top_scores = top_docs[kept], top_scores[kept]
        bound = 0
        for i, end in enumerate(ends):
            rest = seen[best[i] : end]
            gap = int(rest.argmin()) if len(rest) else 0
            best[i] = best[i] + gap if len(rest) and not rest[gap] else end
            if best[i] < end:
                bound += int(lists.impacts[max(best[i] - 1, begins[i])])
        if len(top_docs) == k and top_scores[-1] > bound:
            break
    return top_docs, top_scores, accessed


def _searched(
    queries: list[np.ndarray], weights: np.ndarray, documents: int, occurrences: int, k: int
) -> Callable[[pa.Table], pa.Table]:
    def search(shard: pa.Table) -> pa.Table:
        ids = shard.column("doc_id").combine_chunks()
        lengths = shard.column("n").to_numpy()
        found, times = shard.column("terms").combine_chunks(), shard.column("times").combine_chunks()
        doc = np.repeat(np.arange(len(ids)), np.diff(found.offsets.to_numpy()))
        term = found.flatten().to_numpy().astype(np.int64)
        tf = times.flatten().to_numpy().astype(np.int64)
        scale = 50 + (50 * lengths * documents) // occurrences
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * scale[doc]))
        some = impact > 0
        lists = ImpactLists(doc[some], term[some], impact[some], len(ids), len(weights))
        null = np.asarray(ids.is_null())
        ties = np.empty(len(ids), np.int64)
        ties[np.lexsort((ids.fill_null(0).to_numpy(), null))] = np.arange(len(ids))
        at, docs, scores = [], [], []
        for i, wanted in enumerate(queries if some.any() else []):
            best, score, _ = best_positions(lists, wanted, k, ties)
            at.append(np.full(len(best), i, np.int64))
            docs.append(best)
            scores.append(score)
        empty = [np.empty(0, np.int64)]
        columns = [pa.array(np.concatenate(at or empty)), ids.take(pa.array(np.concatenate(docs or empty))), pa.array(np.concatenate(scores or empty))]
        return pa.table(columns, names=["query", "doc_id", "score"])

    return search


def _best(rows: DataFrame, within: list[Column], k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query", *within).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def _block_results(docs: DataFrame, items: list[Row], k: int) -> DataFrame:
    """(query, rank, doc_id, score) for the items of one block; ``query`` is the place in the list."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    for item in items:
        for term in item.terms:
            vocabulary.setdefault(term.encode(), len(vocabulary))
    queries = [np.array([vocabulary[t.encode()] for t in item.terms], np.int64) for item in items]
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = saved(text.mapInArrow(_indexed(vocabulary), "doc_id long, n long, terms array<int>, times array<int>"), "index")
    documents, occurrences, postings = index.agg(F.count("n"), F.sum("n"), F.sum(F.size("terms"))).first()
    schema = "query long, doc_id long, score long"
    if not postings:
        return _best(spark.createDataFrame([], schema), [], k)
    holding = index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for row in holding:
        weights[row.term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["count"] + 1)))
    shards = -(-postings // SHARD_POSTINGS)
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    dealt = index.where(F.size("terms") > 0).withColumn("shard", place)
    search = _searched(queries, weights, documents, occurrences, k)

    def of_shard(key: tuple[pa.Scalar, ...], shard: pa.Table) -> pa.Table:
        found = search(shard)
        return found.append_column("shard", pa.array(np.full(len(found), key[0].as_py(), np.int64)))

    found = dealt.groupBy("shard").applyInArrow(of_shard, f"{schema}, shard long")
    nearly = _best(found, [F.expr(f"shard div {MERGE_SHARDS}")], k).drop("rank")
    return _best(nearly, [], k)


def best_matches(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, equal scores by ascending doc_id (null last).

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored.
    Terms, weights and scores are those of the module's query.  A null or empty text
    has no terms: such documents count nowhere, such items get no rows, as do items
    none of whose terms occurs.  Every row of ``docs`` is a document of its own, also
    one that repeats another; rows of ``items`` equal in id and text count as one, and
    an id with several texts gets a list for each.

    All terms of the items go to every task, at most ``BLOCK_BYTES`` of them at a time:
    more items are searched in blocks, a pass over the documents each.  Shards are
    dealt by a row's place, so neither an id nor a group of copies fills one; a task
    holds one shard's postings of the block's terms.
    """
    spark = docs.sparkSession
    wanted = items.select("item_id", query_terms(F.col("text")).alias("terms")).where(F.size("terms") > 0).distinct()
    wanted = saved(wanted, "items")
    size = wanted.select(F.sum(F.octet_length(F.array_join("terms", " "))).alias("size")).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    id_type = wanted.schema["item_id"].dataType.simpleString()
    results = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block
        held = wanted.where(mine).collect()
        if held:
            found = _block_results(docs, held, k)
            names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(held)], f"query long, item_id {id_type}")
            results = results.union(found.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    return results


MATCHES_SQL = f"""
WITH words AS (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS ts FROM documents
), lengths AS (
    SELECT d, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM words WHERE len(ts) > 0
), totals AS (
    SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS occurrences FROM lengths
), postings AS (
    SELECT d, doc_id, n, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, doc_id, n, unnest(ts) AS t FROM lengths) GROUP BY ALL
), weights AS (
    SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, totals GROUP BY t, docs
), items AS (
    SELECT DISTINCT item_id, list_distinct(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS ts, text FROM benchmark
), queries AS (
    SELECT item_id, text, unnest(ts) AS t FROM items
), scored AS (
    SELECT item_id, text, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // occurrences)))) AS BIGINT) AS score
    FROM queries JOIN postings USING (t) JOIN weights USING (t), totals GROUP BY item_id, text, d, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
