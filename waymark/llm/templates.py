"""Benchmark decontamination by templates: typed placeholders, hash-joined windows, consistent slots.

Words lose their outer punctuation and case; numbers, names (capitalised words) and units after a
number become placeholders, so a question asked again with other numbers or names has the same
template. A capitalised word that opens a sentence may be a name or not: one variant of the template
takes it for a word, another for a name, and either may match. Windows of WINDOW template tokens are hashed; windows of documents meet those of
the benchmark by a hash join. For every alignment (document, item, offset) the values in matching
slots must agree: a value of the item stands for one value of the document throughout. The windows
of consistent alignments count; an item whose windows are covered to COVERAGE is a leak.

Documents send only windows whose hash is set in a bit map of the benchmark's windows (BITS bits,
whatever the benchmark's size), so the shuffle carries little but true matches.

Defined cases: a null text or item has no tokens and matches nothing; an item shorter than a window
is one window, looked for inside documents too if it has LEAST_WORDS tokens, and as a whole document
if it has fewer; windows mostly of placeholders match by their exact values only; null ids are kept and documents are told apart by id and text; equal rows are one; of several alignments of a document and
an item each is judged by itself and the windows of all sound ones count once; texts of any length
are taken whole; an empty table gives no rows; other columns of any name are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import Scratch, arrow, id_column

WINDOW, LEAST_WORDS, COVERAGE, BITS = 8, 4, 0.5, 1 << 22
#: Fixed lists.
UNITS = "mm cm m km mg g kg t ml cl dl l km2 m2 m3 cm2 cm3 s sec min h hr hrs ms hz khz mhz ghz w kw mw kwh v mv a ma j kj n pa kpa c f k mph kmh kph in ft yd mi oz lb lbs gal pt eur usd gbp percent second seconds minute minutes hour hours day days week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters litre litres mile miles inch inches foot feet yard yards pound pounds ounce ounces dollar dollars euro euros cent cents degree degrees".split()
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
WORD, NUMBER, NAME, UNIT = range(4)
_SCHEMA = "w long, id long, of long, variant int, at int, size int, slots array<long>, n_windows int"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;")] = True


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return tv.span_hash(tv.prefix_hash(data), ends - [len(w) for w in words], ends)


_UNIT_HASH, _NUMBER_HASH = _hashes(UNITS), _hashes(NUMBER_WORDS)
_KIND_HASH = tv.mix(np.arange(11, 15, dtype=np.uint64))
_EXACT = np.uint64(0x5851F42D4C957F2D)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind and value hash of each template token, whether it is a capitalised word that opens a sentence, and the row bounds."""
    start, end, bounds = tv.words(data, offsets)
    core = np.flatnonzero(_LETTER[data] | _DIGIT[data])
    low, high = np.searchsorted(core, start), np.searchsorted(core, end)
    has = high > low
    row = tv.rows_of(bounds)
    opens = np.ones(len(start), bool)
    if len(start) > 1:
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        closed = _STOP[data[end[:-1] - 1]] | (_STOP[data[np.maximum(end[:-1] - 2, start[:-1])]] & ~(_LETTER | _DIGIT)[data[end[:-1] - 1]])
        opens[1:] = (row[1:] != row[:-1]) | closed | (breaks[start[1:]] > breaks[end[:-1]])
    start, end, row, opens = core[low[has]], core[high[has] - 1] + 1, row[has], opens[has]
    value = tv.span_hash(tv.prefix_hash(tv.LOWER[data]), start, end)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    first = data[start]
    upper = (first >= 65) & (first <= 90)
    two = (first == 0xC3) & (end - start > 2)
    upper[two] |= data[start[two] + 1] <= 0x9E
    kind = np.zeros(len(start), np.int64)
    kind[upper & ~opens & (end - start > 1)] = NAME
    unit = np.isin(value, _UNIT_HASH)
    number = (_DIGIT[first] | np.isin(value, _NUMBER_HASH) | (_DIGIT[data[end - 1]] & (letters[end] == letters[start])))
    kind[1:][unit[1:] & number[:-1] & (row[1:] == row[:-1])] = UNIT
    kind[number] = NUMBER
    return kind, value, upper & opens & (end - start > 1) & (kind == WORD), np.searchsorted(row, np.arange(len(offsets)))


def _short(code: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of fewer than WINDOW tokens, equal to those of texts of so many tokens, and their first tokens."""
    pieces = np.flatnonzero(np.diff(bounds) >= size)
    counts = np.diff(bounds)[pieces] - size + 1
    begin = np.arange(counts.sum()) + np.repeat(bounds[pieces] - np.cumsum(counts) + counts, counts)
    ends = np.arange(0, len(begin) * size + 1, size)
    value, _ = tv.windows(code[(begin[:, None] + np.arange(size)).ravel()], ends, WINDOW, whole=True)
    return value, begin


def _windows(batch: pa.RecordBatch, bits: np.ndarray | None, sizes: list[int]):
    ids, ofs = id_column(batch, "id"), id_column(batch, "of")
    for first, _, data, offsets in tv.slices(batch):
        kind, value, opener, bounds = tokens(data, offsets)
        if not len(kind):
            continue
        count = np.diff(bounds)
        n_windows = np.maximum(count - WINDOW + 1, 1)
        exact = tv.mix(value ^ _EXACT)
        for variant in range(2):
            kinds = np.where(opener, NAME, kind) if variant else kind
            plain = np.concatenate([[0], np.cumsum(kinds == WORD)])
            code = np.where(kinds == WORD, value, _KIND_HASH[kinds])
            w, row = tv.windows(code, bounds, WINDOW, whole=True)
            begin = np.arange(len(w)) - np.searchsorted(row, row) + bounds[row]
            size = np.minimum(WINDOW, count[row])
            usable = 2 * (plain[begin + size] - plain[begin]) >= np.minimum(size, 2 * LEAST_WORDS)
            # those mostly of placeholders, and short ones, by their values
            other = (~usable | (size < WINDOW)) if not variant else np.zeros(len(w), bool)
            found = [(w[usable], begin[usable], size[usable])]
            if other.any():
                found.append((tv.windows(exact, bounds, WINDOW, whole=True)[0][other], begin[other], size[other]))
            for n in sizes:
                v, at = _short(code, bounds, n)
                many = plain[at + n] - plain[at] >= LEAST_WORDS
                found.append((v[many], at[many], np.full(int(many.sum()), n)))
                if not variant:
                    v, at = _short(exact, bounds, n)
                    found.append((v, at, np.full(len(at), n)))
            w, begin, size = (np.concatenate(x) for x in zip(*found, strict=True))
            if bits is not None:
                spot = (w & np.uint64(BITS - 1)).astype(np.int64)
                use = (bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)
                w, begin, size = w[use], begin[use], size[use]
            if not len(w):
                continue
            row = np.searchsorted(bounds, begin, "right") - 1
            slots = [value[b : b + n][kinds[b : b + n] != WORD].view(np.int64).tolist() for b, n in zip(begin.tolist(), size.tolist(), strict=True)]
            own = pa.array(first + row)
            yield arrow(_SCHEMA, w=w.view(np.int64), id=ids.take(own), of=ofs.take(own), variant=np.full(len(w), variant), at=begin - bounds[row], size=size, slots=slots, n_windows=n_windows[row])


def template_windows(texts: DataFrame, bits: np.ndarray | None = None, sizes: list[int] | None = None) -> DataFrame:
    """Rows (w, id, of, variant, at, size, slots, n_windows) of texts (id, of, text); sizes: those of short windows that are wanted besides."""
    shared = None if bits is None else texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            yield from _windows(batch, None if shared is None else shared.value, sizes or [])

    return texts.select("id", "of", "text").mapInArrow(run, _SCHEMA)


def _bit_map(windows: DataFrame) -> np.ndarray:
    """The set bits; at most BITS numbers reach the driver, one block of bytes at a time."""
    bits = np.zeros(BITS // 8, np.uint8)
    for row in windows.select(F.col("w").bitwiseAND(BITS - 1).alias("b")).distinct().toLocalIterator():
        bits[row.b >> 3] |= 1 << (row.b & 7)
    return bits


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(df[id_col].cast("long").alias("id"), F.xxhash64(df[text_col].cast("string")).alias("of"), df[text_col].cast("string").alias("text"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", coverage: float = COVERAGE) -> DataFrame:
    """One row per document and leaked item: doc_id, of (hash of the text), item_id, n_matched, n_windows, n_slots."""
    items = template_windows(_keyed(benchmark, item_col, text_col)).distinct()
    sizes = sorted(r["size"] for r in items.where(F.col("size").between(LEAST_WORDS, WINDOW - 1)).select("size").distinct().collect())
    found = template_windows(_keyed(docs, id_col, text_col), _bit_map(items), sizes).distinct()
    theirs = items.select("w", "variant", F.col("size").alias("item_size"), F.col("id").alias("item_id"), F.col("of").alias("item_of"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), F.col("n_windows").alias("item_windows"))
    met = found.join(theirs, ["w", "variant"]).where("size = item_size").withColumn("shift", F.col("at") - F.col("item_at"))
    met = Scratch(docs.sparkSession).keep(met, "met")  # both aggregates below read it, so the documents are scanned once
    line = ["id", "of", "variant", "item_id", "item_of", "item_windows", "shift"]
    pairs = met.select(*line, "item_at", F.explode_outer(F.arrays_zip(F.col("item_slots").alias("theirs"), F.col("slots").alias("ours"))).alias("slot"))
    values = pairs.groupBy(*line, F.col("slot.theirs").alias("theirs")).agg((F.max("slot.ours") != F.min("slot.ours")).alias("clash"))
    sound = values.groupBy(*line).agg(F.coalesce(F.bool_or("clash"), F.lit(False)).alias("clash"), F.count("theirs").alias("n_slots"))
    matched = met.select(*line, "item_at").distinct()
    good = sound.where("not clash").select(*(F.col(c).alias(f"_{c}") for c in line), "n_slots")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in line]
    joined = matched.join(good, on).groupBy("id", "of", "variant", "item_id", "item_of", "item_windows").agg(F.countDistinct("item_at").alias("n_matched"), F.max("n_slots").alias("n_slots"))
    out = joined.where(F.col("n_matched") >= coverage * F.col("item_windows"))
    return out.groupBy(F.col("id").alias("doc_id"), "of", "item_id").agg(F.max("n_matched").alias("n_matched"), F.max("item_windows").cast("long").alias("n_windows"), F.max("n_slots").alias("n_slots"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with no leaked item; columns as they came."""
    bad = leaks(docs, benchmark, id_col, text_col, **options).select("doc_id", "of").distinct()
    return docs.join(bad, docs[id_col].cast("long").eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs[text_col].cast("string")) == bad["of"]), "left_anti")
