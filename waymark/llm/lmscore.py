"""Cross-entropy difference: a target and a background bigram model over one vocabulary.

The vocabulary is all words of the corpus, lower-cased, and both models hold exact counts of its
words, contexts and bigrams. The target model counts the documents labelled good, the background
model all documents. Probabilities interpolate the bigram's with an add-one unigram's. Each token's
loss under the target less its loss under the background is averaged over the document: lower is
nearer the target.

A word is known by 47 bits of its hash and a bigram by 64, so n distinct words share an id in about
n * n / 2^48 cases. Documents are dealt into buckets of some BUCKET bytes by id. A bucket counts
its distinct words, contexts and bigrams and sends their keys, sorted and packed, to shards by the
keys' upper bits. A shard adds up the counts of all buckets and sends back the sums in the order in
which a bucket asked, and its documents are scored there. Nothing that grows with the corpus is
broadcast, held by the driver or capped.

Defined cases: a null or empty text has no tokens and null losses; a null id or a document without
a label counts for the background only; several labels for an id: the greatest counts; an empty
corpus gives no rows; repeated rows count again; texts of any length are taken whole; other columns,
also such as are named like ours, are ignored. Rows of one id meet in
one bucket, those without an id are dealt by text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import arrow, id_column

#: VOCAB is the least number of words that add-one smoothing assumes, and the context of a text's first word.
VOCAB, BIGRAMS, WEIGHT = 1 << 16, 1 << 64, 0.7
#: Bytes of text in a bucket and, above 2^LEAST_SHARDS shards, in a shard; words that a task holds before it sends them.
BUCKET, SHARD, LEAST_SHARDS, HELD = 8 << 20, 64 << 20, 10, 1 << 20
SCHEMA = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
_COUNTS = "bucket long, shard long, keys binary, target binary, background binary"
_SUMS = "bucket long, shard long, target binary, background binary"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def token_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the lower-cased words and the row bounds."""
    text = tv.LOWER[data]
    start, end, bounds = tv.words(text, offsets)
    return (tv.span_hash(tv.prefix_hash(text), start, end) >> np.uint64(17)).astype(np.int64), bounds


def cells(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context (the id before, or VOCAB at a start) and bigram key of each token."""
    context = np.empty_like(ids)
    if len(ids):
        context[1:] = ids[:-1]
        starts = bounds[:-1][np.diff(bounds) > 0]
        context[starts] = VOCAB
    return context, tv.mix(context.astype(np.uint64) * np.uint64(VOCAB + 1) + ids.astype(np.uint64))


def losses(pair: np.ndarray, single: np.ndarray, seen: np.ndarray, total: np.ndarray, vocab: int) -> np.ndarray:
    """-log p of tokens from the counts of their bigram, word, context and all tokens."""
    single = (single + 1) / (total + vocab)
    double = pair / np.maximum(seen, 1)
    return -np.log(np.where(seen > 0, WEIGHT * double, 0) + np.where(seen > 0, 1 - WEIGHT, 1) * single)


def extent(own: DataFrame) -> tuple[int, int]:
    """The number of distinct words and of bytes."""

    def run(batches):
        parts, held, size = [], 0, 0
        for batch in batches:
            for _, _, data, offsets in tv.slices(batch):
                parts.append(np.unique(token_ids(data, offsets)[0]))
                held, size = held + len(parts[-1]), size + len(data)
                if held > HELD:
                    words = np.unique(np.concatenate(parts))
                    parts, held = [words], len(words)
                    if held > HELD // 2:
                        yield arrow("word long, bytes long", word=words, bytes=np.zeros(held, np.int64))
                        parts, held = [], 0
        words = np.unique(np.concatenate([*parts, np.zeros(0, np.int64)]))
        yield arrow("word long, bytes long", word=pa.array(words), bytes=np.zeros(len(words), np.int64))
        yield arrow("word long, bytes long", word=[None], bytes=[size])

    found = own.select("text").mapInArrow(run, "word long, bytes long").groupBy("word").agg(F.sum("bytes").alias("bytes"))
    row = found.agg(F.count("word").alias("words"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return row.words, row.bytes


def _keys(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of the bigram, the word, the context and the sum of all tokens, for each token; and the row bounds."""
    ids, bounds = token_ids(data, offsets)
    context, pair = cells(ids, bounds)
    salt = np.uint64(1 << 62)
    return [pair, tv.mix(ids.astype(np.uint64) | salt), tv.mix(context.astype(np.uint64) | salt << np.uint64(1)), np.zeros(len(ids), np.uint64)], bounds


def _count(docs: pa.Table, good: pa.Table, bits: int) -> pa.Table:
    """The counts of a bucket's documents, a row for each shard; good are its ids labelled so."""
    out = [arrow(_COUNTS, bucket=[], shard=[], keys=[], target=[], background=[])]
    parts, owns = [[] for _ in range(4)], []
    for batch in docs.to_batches():
        target = pc.is_in(id_column(batch, "doc_id"), value_set=good.column("good_id").combine_chunks()).to_numpy(zero_copy_only=False)
        for first, end, data, offsets in tv.slices(batch):
            keys, bounds = _keys(data, offsets)
            owns.append(target[first:end][tv.rows_of(bounds)])
            for part, key in zip(parts, keys, strict=True):
                part.append(key)
    found = []
    for part in parts if owns else []:
        keys, place = np.unique(np.concatenate(part), return_inverse=True)
        found.append((keys, np.bincount(place[np.concatenate(owns)], minlength=len(keys)), np.bincount(place, minlength=len(keys))))
    if found and len(found[0][0]):
        keys, ours, all_ = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(keys)
        keys, ours, all_ = keys[order], ours[order], all_[order]
        shard = (keys >> np.uint64(64 - bits)).astype(np.int64)
        edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])).tolist()
        spans = list(zip(edges, edges[1:], strict=False))
        steps = [pack(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in spans]
        out.append(arrow(_COUNTS, bucket=[docs.column("bucket")[0].as_py()] * len(spans), shard=shard[edges[:-1]], keys=steps, target=[pack(ours[a:b]) for a, b in spans], background=[pack(all_[a:b]) for a, b in spans]))
    return pa.Table.from_batches(out)


def _add(asked: pa.Table) -> pa.Table:
    """The sums over all buckets of a shard, for each bucket in the order of its keys."""
    keys = [np.cumsum(unpack(x), dtype=np.uint64) for x in asked.column("keys").to_pylist()]
    edges = np.cumsum([0, *map(len, keys)]).tolist()
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = {}
    for name in ("target", "background"):
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, place, np.concatenate([unpack(x) for x in asked.column(name).to_pylist()]).astype(np.int64))
        sums[name] = [pack(total[place[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]
    return pa.Table.from_batches([arrow(_SUMS, bucket=asked.column("bucket").combine_chunks(), shard=asked.column("shard").combine_chunks(), **sums)])


def _places(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where keys stand in a sorted array; each distinct key is looked for once, in order."""
    distinct, back = np.unique(keys, return_inverse=True)
    return np.searchsorted(known, distinct)[back]


def _score(docs: pa.Table, sums: pa.Table, vocab: int) -> pa.Table:
    """Scores of a bucket's documents from the corpus counts of its keys."""
    out = [arrow(SCHEMA, doc_id=[], n_tokens=[], target_loss=[], background_loss=[], score=[])]
    parts = [(id_column(batch, "doc_id").slice(first, end - first), *_keys(data, offsets)) for batch in docs.to_batches() for first, end, data, offsets in tv.slices(batch)]
    known = np.unique(np.concatenate([np.unique(np.concatenate([p[1][k] for p in parts])) for k in range(4)])) if parts else []
    order = np.argsort(sums.column("shard").to_numpy())
    models = []
    for name in ("target", "background"):
        packed = sums.column(name).to_pylist()
        models.append(np.concatenate([np.zeros(0, np.uint64), *(unpack(packed[k]) for k in order)]).astype(np.float64))
    assert all(len(m) == len(known) for m in models)
    for doc, keys, bounds in parts:
        n = np.diff(bounds)
        places = [_places(known, key) for key in keys]
        means = []
        for model in models:
            total = np.concatenate([[0.0], np.cumsum(losses(*(model[p] for p in places), vocab))])
            means.append((total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(n, 1))
        t, b = ([x if k else None for x, k in zip(m.tolist(), n.tolist(), strict=True)] for m in means)
        out.append(arrow(SCHEMA, doc_id=doc, n_tokens=n, target_loss=t, background_loss=b, score=[None if x is None else x - y for x, y in zip(t, b, strict=True)]))
    return pa.Table.from_batches(out)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """One row per document: tokens, mean loss under either model, and their difference."""
    good = labels.groupBy(F.col("doc_id").cast("long").alias("good_id")).agg(F.max(F.col(label_col).cast("int")).alias("q")).where("q = 1 and good_id is not null").select("good_id")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words, size = extent(own)
    vocab, n = max(VOCAB, words), F.lit(-(-size // BUCKET) or 1)
    # the same exchange of the texts serves both passes
    dealt = own.select(F.pmod(F.when(F.isnull("doc_id"), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), n).alias("bucket"), "doc_id", "text").groupBy("bucket")
    marked = good.select(F.pmod(F.xxhash64("good_id"), n).alias("bucket"), "good_id").groupBy("bucket")
    bits = max(LEAST_SHARDS, (size // SHARD).bit_length())

    def count(texts: pa.Table, found: pa.Table) -> pa.Table:
        return _count(texts, found, bits)

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        return _score(texts, found, vocab)

    sums = dealt.cogroup(marked).applyInArrow(count, _COUNTS).groupBy("shard").applyInArrow(_add, _SUMS)
    return dealt.cogroup(sums.groupBy("bucket")).applyInArrow(score, SCHEMA)
