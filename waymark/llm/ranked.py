"""Ranked search of a set of queries: impact-ordered postings, processed score at a time.

Documents are counted once into a table of the queries' terms (doc_id, n, terms, tfs); the whole
collection's statistics follow from it by aggregates. The index is partitioned by documents: a task
takes its documents in blocks, and a block's postings are grouped by term and exact impact, highest
first. Each query walks the groups of its terms in descending order of impact and adds them to the
block's accumulators. What a document can still gain is at most the sum of the next impact of every
term. Where the k-th best score found so far exceeds that bound, no document without an accumulator
can enter any more, and of the others only those whose own score and the bound reach it; their scores
are completed from the documents' own terms. A task keeps k documents a query, and the k-th best score
of its earlier blocks bounds the later ones; Spark merges the tasks' results by a window with a limit.

The queries are sent to the tasks in blocks of at most TERMS distinct terms (more only if one query
alone has more), each block being a pass over the documents, so what is broadcast is bounded. A block
of documents is bounded by DOCS and by POSTINGS. Nothing is shuffled but the counts by term and
the k results of each task.

Weights use doubles, all else is 64-bit integers: impact = w * ((10^9 tf) div (1000 tf + 20 m)).

Defined cases: null and empty texts have no terms and are not counted; a query without terms has no
rows; a query's repeated terms count once; repeated rows are documents (queries) of their own; equal
scores are in order of doc_id, null first; empty tables give no rows; a term of weight 0 adds
nothing, and scores of 0 are left out; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import persisted

TERMS, DOCS, POSTINGS = 1 << 18, 8192, 1 << 21
#: Where a walk over a query's postings looks at its bounds, as shares of their number.
LOOKS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 1)
NO_ID = -(1 << 63)  # stands for a null id, which comes first
#: ASCII letters in lower case and digits as they are, the rest of ASCII as blanks, other bytes as they are.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or b >= 97 and b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats."""
    return text.translate(_FOLD).split()


def _counted(wanted: dict[bytes, int]):
    def run(batches):
        for batch in batches:
            sizes, ends, found, tfs = [], [0], [], []
            for text in batch.column(1):
                words = terms(text.as_py() or b"")
                own = [(wanted[w], c) for w, c in Counter(words).items() if w in wanted]
                sizes.append(len(words))
                found += [t for t, _ in own]
                tfs += [c for _, c in own]
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((found, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    return run


class Block:
    """Documents' postings, by term and descending impact, and by document."""

    def __init__(self, docs: np.ndarray, n: np.ndarray, counts: np.ndarray, found: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n_docs: int, length: int) -> None:
        self.docs, self.found = docs, found
        m = 50 + 50 * n * n_docs // length
        doc = np.repeat(np.arange(len(docs)), counts)
        self.impacts = weights[found] * (10**9 * tfs // (1000 * tfs + 20 * m[doc]))
        self.begins = np.cumsum(counts) - counts
        self.counts = counts
        order = np.lexsort((-self.impacts, found))
        self.by_term, self.impact, self.doc = found[order], self.impacts[order], doc[order]
        self.first = np.searchsorted(self.by_term, np.arange(len(weights) + 1))

    def best(self, own: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, documents) of a query's terms, all of the block's k best that reach least among them."""
        spans = [(a, b) for a, b in zip(self.first[own].tolist(), self.first[own + 1].tolist(), strict=True) if a < b]
        if not spans:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        impact, doc = (np.concatenate([x[a:b] for a, b in spans]) for x in (self.impact, self.doc))
        sizes = np.array([b - a for a, b in spans])
        term = np.repeat(np.arange(len(spans)), sizes)
        begins = np.cumsum(sizes) - sizes
        down = np.argsort(-impact, kind="stable")
        falling, docs_down, term_down = impact[down], doc[down], term[down]
        scores, at, walked = np.zeros(len(self.docs)), 0, np.zeros(len(spans), np.int64)
        for share in LOOKS:
            to = int(np.searchsorted(-falling, -falling[max(at, math.ceil(share * len(down)) - 1)], "right"))  # to the end of a group of one impact
            scores += np.bincount(docs_down[at:to], falling[at:to], len(scores))
            walked += np.bincount(term_down[at:to], minlength=len(spans))
            at = to
            if at == len(down):
                bound = 0
                break
            left = walked < sizes
            bound = int(impact[(begins + walked)[left]].sum())
            kth = int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0
            if max(kth, least) > bound:
                break
        kth = int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0
        found = np.flatnonzero((scores > 0) & (scores + bound >= max(kth, least)))
        if at == len(down):
            return scores[found].astype(np.int64), self.docs[found]
        member = np.zeros(len(self.first), bool)
        member[own] = True
        sizes = self.counts[found]
        place = np.repeat(self.begins[found] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        whole = np.bincount(np.repeat(np.arange(len(found)), sizes), np.where(member[self.found[place]], self.impacts[place], 0), len(found))
        return whole.astype(np.int64), self.docs[found]


def _search(queries: list[tuple[int, int | None, np.ndarray]], weights: np.ndarray, n_docs: int, length: int, k: int):
    """queries: (number, id, terms). Exact in doubles, as no score reaches 2^53: a query would need 360,000 terms of the greatest weight."""

    def blocks(batches) -> Iterator[Block]:
        held, docs, postings = [], 0, 0

        def made() -> Block:
            return Block(*(np.concatenate(x) for x in zip(*held, strict=True)), weights, n_docs, length)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found, tfs = part.column(2), part.column(3)
                counts = np.diff(found.offsets.to_numpy())
                held.append((part.column(0).fill_null(NO_ID).to_numpy(), part.column(1).to_numpy(), counts.astype(np.int64), found.flatten().to_numpy(), tfs.flatten().to_numpy()))
                docs, postings = docs + part.num_rows, postings + int(counts.sum())
                if docs >= DOCS or postings >= POSTINGS:
                    yield made()
                    held, docs, postings = [], 0, 0
        if held:
            yield made()

    def run(batches):
        kept = {number: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for number, *_ in queries}
        for block in blocks(batches):
            for number, _, own in queries:
                scores, docs = kept[number]
                more, new = block.best(own, k, int(scores[-1]) if len(scores) == k else 1)
                scores, docs = np.concatenate([scores, more]), np.concatenate([docs, new])
                order = np.lexsort((docs, -scores))[:k]
                kept[number] = scores[order], docs[order]
        for number, item, _ in queries:
            scores, docs = kept[number]
            if len(docs):
                ids = pa.array(docs, pa.int64(), mask=docs == NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(docs), pa.int64()), pa.array([item] * len(docs), pa.int64()), ids, pa.array(scores, pa.int64())], names=["number", "item_id", "doc_id", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, int | None, list[bytes]]]]:
    """Queries (number, id, distinct terms), as many at a time as have TERMS terms together."""
    block, seen = [], set()
    for number, row in enumerate(items.toLocalIterator()):
        own = sorted(set(terms(row.text or b"")))
        if block and len(seen | set(own)) > TERMS:
            yield block
            block, seen = [], set()
        block.append((number, row.item_id, own))
        seen |= set(own)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each query, best first."""
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"))
    asked = items.select(items[item_col].cast("long").alias("item_id"), items[query_col].cast("string").cast("binary").alias("text"))
    results = [_pass(source, block, k) for block in _blocks(asked)]
    found = reduce(DataFrame.unionByName, results) if results else docs.sparkSession.createDataFrame([], "number long, item_id long, doc_id long, score long")
    ranks = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    return found.withColumn("rank", ranks).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _pass(source: DataFrame, block: list[tuple[int, int | None, list[bytes]]], k: int) -> DataFrame:
    wanted = {w: i for i, w in enumerate(sorted({w for *_, own in block for w in own}))}
    queries = [(number, item, np.array([wanted[w] for w in own], np.int64)) for number, item, own in block if own]
    counted = persisted(source.mapInArrow(_counted(wanted), "doc_id long, n long, terms array<int>, tfs array<long>"), "counted")
    n_docs, length = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(wanted), np.int64)
    for t, df in counted.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():  # at most TERMS rows
        weights[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return counted.where("size(terms) > 0").mapInArrow(_search(queries, weights, n_docs, length, k), "number long, item_id long, doc_id long, score long")
