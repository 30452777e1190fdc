"""Quality rules: compression bands beside counts of words, symbols and repeats.

A text is compressed with zstandard as a whole and in fixed chunks. A ratio (bytes / compressed
bytes) above the upper limit of its length band means repetition; one below the lower limit means
noise that does not compress. Bands are by bytes, because short texts compress badly whatever
they say: the frame header alone is a dozen bytes. Texts mostly of one-byte characters have lower
limits of their own, between those of random words and of documents labelled good: a-z words are
told apart from 1 KB on, words of letters and digits from 256 bytes on.

Defined cases: a null or empty text has no words and fails; a null id is kept as null; repeated
rows are judged one by one, so ties get the same verdict; a text of any length is judged whole, chunk
by chunk; an empty table gives no rows; other columns of any name are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import textvec as tv
from .common import arrow, id_column

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, worst_chunk_high double, worst_chunk_low double"
#: (bytes below this, least ratio, greatest ratio) for whole texts.
BANDS = ((256, 0.70, 3.5), (1024, 0.95, 4.0), (4096, 1.15, 5.0), (16384, 1.25, 7.0), (1 << 62, 1.30, 9.0))
#: (bytes below this, least ratio) where fewer than WIDE of the bytes are above 127. Random alphanumeric words reach
#: 1.25, 1.33, 1.37, 1.39, 1.40 and 1.40 in these bands from 256 on, random a-z words 1.53, 1.63, 1.68, 1.70, 1.72 and
#: 1.73; documents labelled good in sf0.1 have 1.34, 1.47, 1.72, 1.92, 2.12 and 2.34 at least.
NARROW_LEAST = ((256, 0.70), (512, 1.28), (1024, 1.40), (2048, 1.69), (4096, 1.75), (1 << 62, 1.80))
WIDE = 0.3
#: Fixed chunks of this many bytes; the last one ends with the text and overlaps the one before it.
CHUNK = 4096
#: Least ratio of chunks in texts of wide and of narrow characters, greatest ratio. Good chunks have 2.07 to 2.26, random a-z words 1.72.
CHUNK_LEAST, CHUNK_NARROW_LEAST, CHUNK_MOST = 1.05, 1.80, 5.0
LEVEL = 3
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"[#*$%&|<>]"[1:-1])] = True


def _dup_lines(data: np.ndarray, offsets: np.ndarray, prefix: np.ndarray, solid: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    newline = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], newline + 1])
    ends_of = np.concatenate([newline, offsets[1:]])
    row = np.concatenate([np.arange(rows), np.searchsorted(offsets, newline, "right") - 1])
    order_s = np.lexsort((starts, row))
    row_e = np.concatenate([np.searchsorted(offsets, newline, "right") - 1, np.arange(rows)])
    order_e = np.lexsort((ends_of, row_e))
    start, end, row = starts[order_s], ends_of[order_e], row[order_s]
    seen = np.concatenate([[0], np.cumsum(solid)])
    has = seen[end] > seen[start]
    start, end, row = start[has], end[has], row[has]
    _, bounds = tv.distinct(tv.span_hash(prefix, start, end), row, rows)
    return np.bincount(row, minlength=rows) - np.diff(bounds)


def _repeat_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    rows = len(bounds) - 1
    out = np.zeros(rows, np.int64)
    value, row = tv.windows(hashes, bounds, 3)
    if not len(value):
        return out
    count = np.diff(bounds)
    at = np.arange(len(value)) + 2 * np.cumsum(count >= 3)[row] - 2 + np.cumsum(np.where(count < 3, count, 0))[row]
    order = np.lexsort((value, row))
    v, r = value[order], row[order]
    same = (v[1:] == v[:-1]) & (r[1:] == r[:-1])
    twice = np.zeros(len(v), bool)
    twice[1:] |= same
    twice[:-1] |= same
    found = at[order[twice]]
    hit = np.zeros(len(hashes), bool)
    for k in range(3):
        hit[found + k] = True
    total = np.concatenate([[0], np.cumsum(hit)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _ratio(codec: zstandard.ZstdCompressor, raw: memoryview) -> float:
    return len(raw) / len(codec.compress(raw))


def _wide(raw: memoryview) -> bool:
    return (np.frombuffer(raw, np.uint8) > 127).mean() >= WIDE


def compression(codec: zstandard.ZstdCompressor, raw: memoryview) -> tuple[float, float, float, bool]:
    """Ratio of the whole, greatest and least of the chunks, and whether all stay in their bands."""
    if not len(raw):
        return 0.0, 0.0, 0.0, False
    whole = _ratio(codec, raw)
    low, high = next((a, b) for size, a, b in BANDS if len(raw) < size)
    if not _wide(raw):
        low = next(a for size, a in NARROW_LEAST if len(raw) < size)
    parts = [raw[i : i + CHUNK] for i in range(0, len(raw) - CHUNK + 1, CHUNK)] if len(raw) > CHUNK else []
    if parts and len(raw) % CHUNK:
        parts.append(raw[len(raw) - CHUNK :])
    chunks = [_ratio(codec, p) for p in parts]
    most, least = max(chunks, default=whole), min(chunks, default=whole)
    inside = low <= whole <= high and all((CHUNK_LEAST if _wide(p) else CHUNK_NARROW_LEAST) <= c <= CHUNK_MOST for p, c in zip(parts, chunks, strict=True))
    return whole, most, least, inside


def _measure(batch: pa.RecordBatch, id_name: str, text_name: str):
    ids = id_column(batch, id_name)
    codec = zstandard.ZstdCompressor(level=LEVEL)
    for first, end, data, offsets in tv.slices(batch, text_name):
        start, stop, bounds = tv.words(data, offsets)
        prefix = tv.prefix_hash(data)
        points = tv.code_points(data)
        solid = ~tv.SPACE[data]
        n_words = np.diff(bounds)
        chars = np.concatenate([[0], np.cumsum(points[stop] - points[start])])
        symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
        repeats = _repeat_words(tv.span_hash(prefix, start, stop), bounds)
        failed = (n_words < 50) | (100 * repeats > 50 * n_words)
        raw = memoryview(data)
        measured = [compression(codec, raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        inside = np.array([m[3] for m in measured], bool)
        yield arrow(SCHEMA, doc_id=ids.slice(first, end - first), n_words=n_words, word_chars=chars[bounds[1:]] - chars[bounds[:-1]], n_symbols=symbols[offsets[1:]] - symbols[offsets[:-1]], n_dup_lines=_dup_lines(data, offsets, prefix, solid), n_repeat_words=repeats, base_failed=failed, kept=~failed & inside, ratio=[m[0] for m in measured], worst_chunk_high=[m[1] for m in measured], worst_chunk_low=[m[2] for m in measured])


def quality_signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with the counts, the ratios and the verdict; a map without a shuffle."""

    def run(batches):
        for batch in batches:
            yield from _measure(batch, "doc_id", "text")

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text passes, with all their columns as they came."""

    def run(batches):
        for batch in batches:
            own = pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), batch.column(batch.schema.get_field_index(text_col))], names=["doc_id", "text"])
            good = [v for part in _measure(own, "doc_id", "text") for v in part.column("kept").to_pylist()]
            if any(good):
                yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
