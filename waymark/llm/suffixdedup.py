"""Exact repeats of LENGTH bytes by difference-cover suffix sorting, one block of suffix buckets at a time.

1. Anchors. In every string of LENGTH bytes the GRAM-gram with the least hash (the leftmost of
   equals) is its anchor, so equal strings have equal anchors at the same place. Strings with one
   anchor are consecutive; the bytes under them are the anchor's context, some 130. A row of an
   anchor carries the hashes of the gram and of the context, not the bytes.
2. Equal contexts. Those that are equal inside a slice of a task are compared byte by byte there;
   the later ones are repeats and need not meet their anchor's bucket, so a passage in a third of
   all rows makes no hot bucket. The others meet by anchor, sorted, as a stream; those of one hash
   are a class, and all but its first are repeats. Every class is checked by the BLAKE2 digests of
   its members' bytes; the anchors of a class that fails go to the sort as a whole.
3. Buckets. An anchor with different contexts is a suffix bucket to be sorted: the first of each
   class sends its bytes.
4. Sorting. A task takes whole buckets until BLOCK bytes are held and sorts the suffixes in them:
   by their first and last bytes, and, where these tie, by the ranks of a difference cover's
   samples. The cover D modulo V has for any two positions i, j a shift d < V such that i + d and
   j + d are both samples; ranks of DEPTH bytes at samples are computed once a block, so a tie of
   any length is one comparison of two numbers. A bucket of more than HOT contexts, which would not
   fit a block, is spread instead: its single strings meet by the digests of their bytes, and the
   first of each is an aggregate. So memory is bounded by BLOCK and HOT contexts.
5. Every string but the first of its class marks its bytes; marks are merged by document.

Defined cases: a null text is an empty one; texts shorter than LENGTH lose nothing; null ids come
before all others; rows with equal id and text are one document; other columns, also such as are
named like ours, are ignored; an empty table gives no rows; a text of any length is one slice, with
memory in proportion to it; one of more than 1 GiB raises an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import Scratch, arrow, id_column

LENGTH, GRAM, HOT = 100, 24, 8192
#: Bytes of a slice in which equal contexts are found at once.
SLICE = 1 << 20
#: A perfect difference set modulo 31 (a fixed value): every difference occurs.
V, COVER = 31, (0, 1, 3, 8, 12, 18)
DEPTH = LENGTH - V + 1
BLOCK = 2 << 20
_PLACE = np.uint64((1 << 30) - 1)
#: Kinds of rows: found again in its slice or in its bucket; to be sorted; first of a class with repeats; both; a string of a large bucket.
LOCAL, AGAIN, SORT, FIRST, BOTH, STRING = range(6)
#: A negative width tells a repeat found in its slice, whose h is any number to deal it by.
_SPOTS = "h long, c long, id long, of long, lo int, width int"
#: c names a class for AGAIN, FIRST and BOTH, h an anchor for all but LOCAL and AGAIN; where they tell nothing they are zero.
_FOUND = "kind int, h long, c long, id long, of long, lo int, width int"
_BYTES = "kind int, h long, c long, id long, of long, lo int, width int, digest long, bytes binary"
_NAMES = [x.split()[0] for x in _BYTES.split(", ")]
_MARKS = "id long, of long, lo int, hi int"
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every `width` consecutive ones, by doubling."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place in data, first and last start of the strings that it anchors), over all rows, in order."""
    none = (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    if len(data) < LENGTH:
        return none
    if len(data) > int(_PLACE):
        raise ValueError("a text of more than 1 GiB")
    prefix = tv.prefix_hash(data)
    value = (prefix[GRAM:] - prefix[:-GRAM]) * tv.powers(len(data))[1][: len(data) - GRAM + 1]
    value ^= value >> np.uint64(31)
    value *= np.uint64(0x9FB21C651E98DF25)
    # the upper bits are the hash, the lower ones the place: the least number is the leftmost of the least hashes
    code = value & ~_PLACE
    code |= np.arange(len(code), dtype=np.uint64)
    least = _window_min(code, LENGTH - GRAM + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[: len(least)] == row[LENGTH - 1 :]
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    end = inside
    end[:-1] &= (least[1:] != least[:-1]) | ~inside[1:]
    first = np.flatnonzero(new)
    pos = (least[first] & _PLACE).astype(np.int64)
    return tv.mix(value[pos]), pos, first, np.flatnonzero(end)


def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a big-endian number; zeros follow the text."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k : k + len(text)]
    return out


def word_at(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    return words[at] >> np.uint64(64 - 8 * width)


def rank(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of rows of keys, the first key leading."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    order = np.lexsort(keys[::-1])
    step = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        step[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def _shift_table() -> np.ndarray:
    table = np.zeros((V, V), np.int64)
    for a in range(V):
        for b in range(V):
            table[a, b] = next(d for d in range(V) if (a + d) % V in COVER and (b + d) % V in COVER)
    return table


SHIFT = _shift_table()


def sample_ranks(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Ranks of the DEPTH bytes from each sample on; the text ends in at least DEPTH + V spare bytes."""
    n = len(text) - DEPTH - V
    at = np.arange(n)
    at = at[np.isin(at % V, COVER)]
    index = np.full(len(text), -1, np.int64)
    # ranks of V bytes, doubled along the samples: a sample plus V is a sample
    first = rank(*(word_at(words, at + k, min(8, V - k)) for k in range(0, V, 8)))
    index[at] = first
    after = np.where(at + V < n, index[np.minimum(at + V, len(text) - 1)], -1)
    both = rank(first, after)
    out = np.full(len(text), -1, np.int64)
    out[at] = rank(both, word_at(words, at + 2 * V, DEPTH - 2 * V)) if DEPTH > 2 * V else both
    return out


def classes(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Class numbers of the strings of LENGTH bytes at these places, equal only for equal strings.

    Suffixes are sorted by their first V and last LENGTH - DEPTH bytes; ties are parted around a
    pivot by the samples' ranks at the shift that suits both positions, all ties at once, until
    each group is of one string.
    """
    words = words_of(text)
    samples = sample_ranks(text, words)
    ends = [word_at(words, at + k, w) for base, size in ((0, V), (DEPTH, LENGTH - DEPTH)) for k, w in ((base + j, min(8, size - j)) for j in range(0, size, 8))]
    group = rank(*ends)
    open_ = np.arange(len(at))
    done = np.zeros(len(at), np.int64)
    next_class = 0
    while len(open_):
        order = np.argsort(group[open_], kind="stable")
        members = open_[order]
        g = group[members]
        head = np.concatenate([[True], g[1:] != g[:-1]])
        pivot = members[np.flatnonzero(head)[np.cumsum(head) - 1]]
        shift = SHIFT[at[members] % V, at[pivot] % V]
        mine, theirs = samples[at[members] + shift], samples[at[pivot] + shift]
        equal = mine == theirs
        local = np.cumsum(head) - 1
        done[members[equal]] = next_class + local[equal]
        next_class += int(head.sum())
        left = members[~equal]
        group[left] = rank(local[~equal], (mine > theirs)[~equal])
        open_ = left
    return done


def repeats(ids: np.ndarray, ofs: np.ndarray, lo: np.ndarray, widths: np.ndarray, blob: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts (the bytes under strings lo ... lo + width - 1): for every string not first of its class, its context and start; in order."""
    text = np.concatenate([blob, np.zeros(DEPTH + 2 * V + LENGTH, np.uint8)])
    owner = np.repeat(np.arange(len(widths)), widths)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(widths) - widths, widths)
    number = classes(text, bounds[:-1][owner] + step)
    start = lo[owner] + step
    order = np.lexsort((start, ofs[owner], ids[owner], number))
    later = np.concatenate([[False], number[order][1:] == number[order][:-1]]) if len(order) else np.zeros(0, bool)
    # rows of one document that came twice are one: the same place is no earlier place
    o, s = owner[order], start[order]
    if len(order):
        leader = np.flatnonzero(~later)[np.cumsum(~later) - 1]
        same = (ids[o] == ids[o[leader]]) & (ofs[o] == ofs[o[leader]]) & (s == s[leader])
        later &= ~same
    back = np.sort(order[later])
    return owner[back], start[back], number[back]


def _mark_rows(ids, ofs, owner, start):
    """Runs of consecutive starts as byte spans."""
    if not len(owner):
        return
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = np.append(cut[1:], len(owner)) - 1
    yield arrow(_MARKS, id=ids[owner[cut]], of=ofs[owner[cut]], lo=start[cut], hi=start[last] + LENGTH)


def _local_repeats(h: np.ndarray, c: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, raw: bytes) -> np.ndarray:
    """Whether a context repeats an earlier one of its slice byte by byte; order: by id, text and place."""
    by = np.lexsort((order, c, h))
    new = np.concatenate([[True], (h[by][1:] != h[by][:-1]) | (c[by][1:] != c[by][:-1])])
    first = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
    again = np.zeros(len(h), bool)
    for k, f in zip(by[~new].tolist(), first[~new].tolist(), strict=True):
        again[k] = raw[starts[k] : starts[k] + sizes[k]] == raw[starts[f] : starts[f] + sizes[f]]
    return again


def _spots(docs: DataFrame, bits: int) -> DataFrame:
    """All anchors of documents, each of which comes once."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches):
        for batch in batches:
            ids, ofs = id_column(batch, "id").to_numpy(), id_column(batch, "of").to_numpy()
            for first, _, data, offsets in tv.slices(batch, limit=SLICE):
                value, _, lo, hi = anchors(data, offsets)
                if not len(lo):
                    continue
                row = np.searchsorted(offsets, lo, "right") - 1
                h, c = value.view(np.int64), (tv.span_hash(tv.prefix_hash(data), lo, hi + LENGTH) & mask).view(np.int64)
                own, of, at = ids[first + row], ofs[first + row], lo - offsets[row]
                order = np.empty(len(h), np.int64)
                order[np.lexsort((at, of, own))] = np.arange(len(h))
                local = _local_repeats(h, c, order, lo, hi - lo + LENGTH, data.tobytes())
                deal = np.where(local, tv.mix((own ^ at).astype(np.uint64)).view(np.int64), h)
                width = hi - lo + 1
                yield arrow(_SPOTS, h=deal, c=np.where(local, 0, c), id=own, of=of, lo=at, width=np.where(local, -width, width))

    return docs.mapInArrow(run, _SPOTS)


def _found(spots: DataFrame) -> DataFrame:
    """LOCAL and AGAIN: contexts that occurred before; SORT: the first of each class of an anchor with several; FIRST: of a class with repeats; BOTH: of such a class of an anchor with several.

    A stream over sorted rows that holds back one row, however large an anchor's group is.
    """

    def rows_of(kind, h, c, ids, ofs, lo, width):
        classed, anchored = np.isin(kind, (AGAIN, FIRST, BOTH)), np.isin(kind, (SORT, FIRST, BOTH))
        key = tv.mix((h.view(np.uint64) * np.uint64(3)) ^ c.view(np.uint64)).view(np.int64)
        return arrow(_FOUND, kind=kind, h=np.where(anchored, h, 0), c=np.where(classed, key, 0), id=ids, of=ofs, lo=lo, width=np.abs(width))

    def run(batches):
        # the last leading row waits until its class and its anchor are known to be over, or to have others
        leader, before, many = None, False, False  # whether its anchor had classes before it, whether its class has repeats
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            own = cols[5] < 0
            if own.any():
                yield rows_of(np.full(int(own.sum()), LOCAL), *(x[own] for x in cols))
            cols = [x[~own] for x in cols]
            if not len(cols[0]):
                continue
            if leader is not None:
                cols = [np.concatenate([[x], c]) for x, c in zip(leader, cols, strict=True)]
            h, c = cols[:2]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
            lead = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            again = np.flatnonzero(~new)
            repeated = np.bincount(group[again], minlength=len(lead)) > 0
            repeated[0] |= many
            same = h[lead[1:]] == h[lead[:-1]]
            several = np.concatenate([[before], same]) | np.concatenate([same, [False]])
            kind = np.where(several & repeated, BOTH, np.where(several, SORT, np.where(repeated, FIRST, -1)))[:-1]
            rows = np.concatenate([again, lead[:-1][kind >= 0]])
            if len(rows):
                yield rows_of(np.concatenate([np.full(len(again), AGAIN), kind[kind >= 0]]), *(x[rows] for x in cols))
            leader, before, many = [x[lead[-1]] for x in cols], bool(several[-1]), bool(repeated[-1])
        if leader is not None and (before or many):
            yield rows_of(np.array([BOTH if before and many else SORT if before else FIRST]), *(np.array([x]) for x in leader))

    return spots.repartition("h").sortWithinPartitions("h", "c", "id", "of", "lo").mapInArrow(run, _FOUND)


def _digest(raw: bytes, size: int) -> bytes:
    return hashlib.blake2b(raw, digest_size=size).digest()


def _bytes_of(joined: DataFrame) -> DataFrame:
    """Of rows (id, of, text, spots): digests of classes' members (kind FIRST), bytes of contexts to be sorted (SORT), digests of single strings of large buckets (STRING)."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for i, of, text, spots in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                raw, table = text.as_py().encode(), spots.values
                for kind, h, c, lo, width in zip(*(table.field(k).to_pylist() for k in ("kind", "h", "c", "lo", "width")), strict=True):
                    context = raw[lo : lo + width + LENGTH - 1]
                    found = []
                    if c:
                        found.append((FIRST, 0, c, 0, 0, 0, 0, int.from_bytes(_digest(context, 8), "little", signed=True), None))
                    if kind in (SORT, BOTH):
                        found.append((SORT, h, 0, i, of, lo, width, 0, context))
                    if kind == STRING:
                        found += [(STRING, 0, 0, i, of, lo + j, 1, 0, _digest(context[j : j + LENGTH], 16)) for j in range(width)]
                    for row in found:
                        for column, x in zip(out, row, strict=True):
                            column.append(x)
                if len(out[0]) > 20_000:
                    yield arrow(_BYTES, **dict(zip(_NAMES, out, strict=True)))
                    out = [[] for _ in range(9)]
            if out[0]:
                yield arrow(_BYTES, **dict(zip(_NAMES, out, strict=True)))

    return joined.select("id", "of", "text", "spots").mapInArrow(run, _BYTES)


def _sorted_marks(contexts: DataFrame, block: int) -> DataFrame:
    """Marks of the strings that repeat an earlier one of their bucket; a bucket has HOT contexts at most."""

    def solve(rows: pa.Table):
        rows = rows.sort_by([("h", "ascending"), ("id", "ascending"), ("of", "ascending"), ("lo", "ascending")])
        ids, ofs, lo, widths = (rows.column(k).to_numpy() for k in ("id", "of", "lo", "width"))
        blob, widths = b"".join(rows.column("bytes").to_pylist()), widths.astype(np.int64)
        owner, start, _ = repeats(ids, ofs, lo.astype(np.int64), widths, np.frombuffer(blob, np.uint8), np.concatenate([[0], np.cumsum(widths + LENGTH - 1)]))
        yield from _mark_rows(ids, ofs, owner, start)

    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(pa.Table.from_batches([batch]))
            if sum(t.nbytes for t in held) > block:
                table = pa.concat_tables(held)
                h = table.column("h").to_numpy()
                cut = int(np.searchsorted(h, h[-1]))  # the last bucket may go on
                if cut:
                    yield from solve(table.slice(0, cut))
                held = [table.slice(cut)]
        if held:
            yield from solve(pa.concat_tables(held))

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, _MARKS)


def _string_marks(strings: DataFrame) -> DataFrame:
    """Marks of single strings (id, of, lo, bytes: their digest) but the first of each digest."""
    place = F.struct("id", "of", "lo")
    firsts = strings.groupBy("bytes").agg(F.min(place).alias("first"))
    later = strings.join(firsts, "bytes").where(place != F.col("first"))
    return later.select("id", "of", "lo", (F.col("lo") + LENGTH).alias("hi"))


def _with_bytes(own: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes and digests of wanted contexts; those of anchors with more than HOT contexts to sort go string by string."""
    sort = F.col("kind").isin(SORT, BOTH)
    hot = wanted.where(sort).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("h", F.lit(True).alias("hot"))
    kind = F.when(F.coalesce("hot", F.lit(False)), F.lit(STRING)).otherwise(F.col("kind"))
    known = wanted.where(sort).join(hot, "h", "left").unionByName(wanted.where(~sort).withColumn("hot", F.lit(False)))
    spots = known.groupBy("id", "of").agg(F.collect_list(F.struct(kind.alias("kind"), "h", "c", "lo", "width")).alias("spots"))
    return _bytes_of(own.join(spots, ["id", "of"]))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = True, bits: int = 64, block: int = BLOCK) -> DataFrame:
    """One row per document with counts, the digest of what stays and, if wanted, its bytes. bits: of the hash that makes classes of contexts; block: bytes that a sorting task holds."""
    scratch = Scratch(docs.sparkSession)
    own = docs.select(docs[id_col].cast("long").alias("raw_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    # ids that are unique need no hash of the text beside them
    unique = own.groupBy("raw_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    own = own.select("raw_id", F.coalesce("raw_id", F.lit(-(2**63))).alias("id"), (F.lit(0).cast("long") if unique else F.xxhash64("text")).alias("of"), "text")
    once = own.select("id", "of", "text") if unique else own.select("id", "of", "text").distinct()
    found = scratch.keep(_found(_spots(once, bits)), "found")
    scratch.sweep()
    bytes_ = scratch.keep(_with_bytes(once, found.where(F.col("kind") != LOCAL)), "bytes")
    scratch.sweep()
    digests = bytes_.where(F.col("kind") == FIRST).groupBy("c").agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
    mixed = scratch.keep(digests.where("a <> b").select("c"), "mixed")
    again, sort, extra = found.where(F.col("kind").isin(LOCAL, AGAIN)), bytes_, []
    if not mixed.isEmpty():
        # different bytes under one hash: all members of such classes are sorted, with the other contexts of their anchors
        classes = found.where(F.col("kind").isin(FIRST, BOTH)).join(mixed, "c").select("c", "h").distinct()
        members = found.where(F.col("kind") == AGAIN).drop("h").join(classes, "c").select("h", "id", "of", "lo", "width")
        firsts = found.where(F.col("kind").isin(SORT, FIRST, BOTH)).join(classes.select("h").distinct(), "h", "left_semi").select("h", "id", "of", "lo", "width")
        everyone = members.unionByName(firsts).select(F.lit(SORT).alias("kind"), "h", F.lit(0).cast("long").alias("c"), "id", "of", "lo", "width")
        extra = [scratch.keep(_with_bytes(once, everyone), "mixed-bytes")]
        again = again.join(mixed, "c", "left_anti")
        sort = bytes_.where(F.col("kind") != STRING).join(classes.select("h").distinct(), "h", "left_anti").unionByName(bytes_.where(F.col("kind") == STRING))
    again = again.select("id", "of", "lo", (F.col("lo") + F.col("width") + LENGTH - 1).alias("hi"))
    marks = again
    for rows in (sort, *extra):
        contexts = rows.where(F.col("kind") == SORT).select("h", "id", "of", "lo", "width", "bytes")
        marks = marks.unionByName(_sorted_marks(contexts, block)).unionByName(_string_marks(rows.where(F.col("kind") == STRING)))
    marks = scratch.keep(marks, "marks")
    scratch.drop(found, bytes_, mixed, *extra)
    scratch.sweep()
    spans = marks.groupBy("id", "of").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))

    def run(batches):
        for batch in batches:
            rows = []
            for i, text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = text.encode()
                gone = merge([(x["lo"], x["hi"]) for x in found or ()])
                kept = b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(raw)], strict=True))
                rows.append((i, len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
            if rows:
                yield arrow(SCHEMA, **dict(zip([x.split()[0] for x in SCHEMA.split(", ")], map(list, zip(*rows, strict=True)), strict=True)))

    return own.join(spans, ["id", "of"], "left").select("raw_id", "text", "spans").mapInArrow(run, SCHEMA)
