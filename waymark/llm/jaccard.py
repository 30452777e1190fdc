"""N-gram Jaccard join: rare-first prefixes, length, positional and suffix filters, one verification a pair.

A document's set is its distinct word shingles as 64-bit hashes. Documents with equal sets are one
class at once (a 128-bit checksum of the set) and go on as one node, so copies need no join. All
sets are sorted by one order, rare shingles first: corpus counts are kept in a table of SKETCH
cells, counted over every document, and ties go by hash. Any order gives the same links; a better
one gives fewer candidates. Two sets that reach the threshold share a shingle among the first
n - ceil(0.8 n) + 1 of each, so only these prefixes are shuffled, and only shingles found in two
prefixes go on.

Pairs are made in rounds, because a group of near copies would otherwise give all its pairs. In
the first rounds a shingle's documents are compared with a few of them, more in each round, taken
from the largest component; verified links join components; pairs inside a component are not made,
and shingles whose documents are all in one component are finished. The last
round makes every pair left between different components, dealt by classes of length too, except
those verified before; so no link between components is missed.

Filters before verification: length (100 * min >= 80 * max), position (the overlap that can still
follow the shared shingle), suffix (below). Only documents of pairs that pass them fetch their
texts; a pivot's text is sent once for GROUP of its pairs.

Suffix filter: each set is parted around fixed hash values, and its parts again, to a depth that
leaves two to four shingles a part. The differences of the parts' sizes add up to a lower bound of
the sets' Hamming distance, which the threshold bounds from above. Parts of sets of different depth
are compared at the lesser one. As the values are fixed, a document's parts are counted once, not
once a pair.

Defined cases: a null text, an empty one or one without words has an empty set and links with
nothing; rows of one id are one node: it has the greatest set size among them and all their links;
rows with a null id are left out of joins and returned with a null component; other columns, also
such as are named like ours, are ignored; an empty table gives no rows; texts of any length are
taken whole, with memory in proportion to the longest one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import Scratch, arrow, id_column
from .components import components, merged

WIDTH, PERCENT, SKETCH = 5, 80, 1 << 18
#: Documents that the others of a shingle are compared with, by round.
PIVOTS = (4, 128)
#: Bytes of text that a verifying step holds; pairs that share one copy of their pivot's text.
STEP, GROUP = 1 << 19, 64
_SETS = "doc_id long, n long, low long, high long, prefix array<long>, parts binary"
_SKETCH = "block int, turn int, counts binary"
_BLOCK, _TURNS = 1 << 11, 16


def needed(nx, ny, percent: int = PERCENT):
    """The least overlap with which sets of these sizes link."""
    return -(-percent * (nx + ny) // (100 + percent))


def prefix_length(n, percent: int = PERCENT):
    return n - -(-percent * n // 100) + 1


def _own(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def shingle_counts(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """Documents by cell of the sketch, over the whole corpus: an array of SKETCH numbers.

    Counts go block by block through two levels of reducers, SKETCH / _BLOCK * _TURNS and SKETCH / _BLOCK.
    """

    def count(batches):
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for _, _, data, offsets in tv.slices(batch):
                value, _ = tv.shingles(data, offsets, width)
                total += np.bincount((value & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        if total.any():
            kind = "<i4" if total.max() < 2**31 else "<i8"
            turn = TaskContext.get().partitionId() % _TURNS
            for b in range(SKETCH // _BLOCK):
                yield arrow(_SKETCH, block=[b], turn=[turn], counts=[total[b * _BLOCK : (b + 1) * _BLOCK].astype(kind).tobytes()])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                part = np.frombuffer(raw, "<i4" if len(raw) == 4 * _BLOCK else "<i8")
                sums[b] = sums.get(b, 0) + part.astype(np.int64)
        for b, part in sums.items():
            yield arrow(_SKETCH, block=[b], turn=[0], counts=[part.tobytes()])

    out = np.zeros(SKETCH, np.int64)
    rows = docs.select("text").mapInArrow(count, _SKETCH).repartition("block", "turn").mapInArrow(add, _SKETCH).repartition("block").mapInArrow(add, _SKETCH)
    for row in rows.toLocalIterator():
        out[row.block * _BLOCK : (row.block + 1) * _BLOCK] = np.frombuffer(row.counts, "<i8")
    return out


def part_sizes(value: np.ndarray, row: np.ndarray, n: np.ndarray) -> pa.Array:
    """For each row the sizes of 2^k parts of its set by upper bits of the hash; k leaves two to four in a part."""
    depth = np.maximum(np.floor(np.log2(np.maximum(n, 1))).astype(np.int64) - 1, 4)
    bounds = np.concatenate([[0], np.cumsum(1 << depth)])
    at = bounds[row] + (value >> (64 - depth[row]).astype(np.uint64)).astype(np.int64)
    sizes = np.bincount(at, minlength=bounds[-1]).clip(max=255).astype(np.uint8)
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(sizes)])


def far_apart(x: pa.Array, y: pa.Array, most: np.ndarray) -> np.ndarray:
    """Whether the parts' sizes show for each pair that more than `most` shingles are in one set only."""

    def flat(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = parts.cast(pa.large_binary())
        bounds = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1]
        return np.frombuffer(parts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]

    (a, start_a), (b, start_b) = flat(x), flat(y)
    size = np.minimum(np.diff(start_a), np.diff(start_b))
    bounds = np.concatenate([[0], np.cumsum(size)])
    row = tv.rows_of(bounds)
    step = np.arange(bounds[-1]) - bounds[row]
    sums = [np.add.reduceat(cells, start[row] + step * (np.diff(start) // size)[row], dtype=np.int64) for cells, start in ((a, start_a), (b, start_b))]
    lost = np.add.reduceat(np.abs(sums[0] - sums[1]), bounds[:-1])
    full = [np.logical_or.reduceat(cells == 255, start[:-1]) for cells, start in ((a, start_a), (b, start_b))]
    return (lost > most) & ~full[0] & ~full[1]


def set_rows(docs: DataFrame, counts: np.ndarray, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: set size, checksum, rare-first prefix, and the sizes of the set's parts."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        for batch in batches:
            ids = id_column(batch, "doc_id")
            for first, end, data, offsets in tv.slices(batch):
                value, bounds = tv.shingles(data, offsets, width)
                n, row = np.diff(bounds), tv.rows_of(bounds)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(tv.mix(value ^ np.uint64(salt)))]) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                low, high = ((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums)
                order = np.lexsort((value, shared.value[(value & np.uint64(SKETCH - 1)).astype(np.int64)], row))
                place = np.arange(len(value)) - bounds[row]
                length = np.where(n > 0, prefix_length(n, percent), 0)
                chosen = value[order[place < length[row]]].view(np.int64)
                prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(chosen))
                yield arrow(_SETS, doc_id=ids.slice(first, end - first), n=n, low=low, high=high, prefix=prefix, parts=part_sizes(value, row, n))

    return docs.mapInArrow(run, _SETS)


def _shared_only(entries: DataFrame) -> DataFrame:
    """Entries whose shingle stands in two prefixes or more; streams over sorted rows and holds none back but one."""
    schema = "h long, d long, pos int, n long"

    def run(batches):
        held, twice = None, False
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            h = table.column(0).to_numpy()
            same = h[1:] == h[:-1]
            keep = np.zeros(len(h), bool)
            keep[1:] |= same
            keep[:-1] |= same
            if twice:
                keep[0] = True
            held, twice = table.slice(len(h) - 1), bool(keep[-1])
            yield from table.slice(0, len(h) - 1).filter(pa.array(keep[:-1])).combine_chunks().to_batches()
        if held is not None and twice:
            yield from held.combine_chunks().to_batches()

    return entries.repartition("h").sortWithinPartitions("h").mapInArrow(run, schema)


def _likely(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y, turned, nx, ny, rx, ry, cx, cy) that pass the suffix filter; ids with several texts pass as they are."""

    def run(batches):
        for batch in batches:
            if len(batch):
                nx, ny = batch.column(3).to_numpy(), batch.column(4).to_numpy()
                keep = ~far_apart(batch.column(5), batch.column(6), nx + ny - 2 * needed(nx, ny, percent))
                keep |= (batch.column(7).to_numpy() > 1) | (batch.column(8).to_numpy() > 1)
                yield batch.select([0, 1, 2]).filter(pa.array(keep))

    return pairs.select("x", "y", "turned", "nx", "ny", "rx", "ry", "cx", "cy").mapInArrow(run, "x long, y long, turned boolean")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (pivot, other) with linked, by comparing whole sets. Rows stream by pivot, its text first, GROUP others to a copy of it."""
    crowd = pairs.groupBy("pivot").agg(F.count("*").alias("n"))
    dealt = pairs.join(crowd, "pivot").select("pivot", "other", F.pmod(F.xxhash64("other"), F.ceil(F.col("n") / GROUP)).alias("part"))
    heads = dealt.select("pivot", "part").distinct().join(texts, F.col("pivot") == F.col("d")).select("pivot", "part", F.lit(None).cast("long").alias("other"), "text")
    tails = dealt.join(texts, F.col("other") == F.col("d")).select("pivot", "part", "other", "text")
    rows = heads.unionByName(tails).repartition("pivot", "part").sortWithinPartitions("pivot", "part", F.asc_nulls_first("other"))

    def run(batches):
        key, pivots = None, []
        for batch in batches:
            for first, end, data, offsets in tv.slices(batch, "text", STEP):
                value, bounds = tv.shingles(data, offsets, width)
                own = batch.slice(first, end - first)
                pivot, part = own.column(0).to_numpy(), own.column(1).to_numpy()
                lead = own.column(2).is_null().to_numpy(zero_copy_only=False)
                edges = np.flatnonzero(np.concatenate([[True], (pivot[1:] != pivot[:-1]) | (part[1:] != part[:-1]), [True]])).tolist()
                linked = np.zeros(end - first, bool)
                for a, b in zip(edges, edges[1:], strict=False):
                    if key != (pivot[a], part[a]):
                        key, pivots = (pivot[a], part[a]), []
                    while a < b and lead[a]:
                        pivots.append(value[bounds[a] : bounds[a + 1]].copy())
                        a += 1
                    size, theirs = np.diff(bounds[a : b + 1]), value[bounds[a] : bounds[b]]
                    for mine in pivots if a < b and len(theirs) else ():
                        hit = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
                        overlap = np.bincount(tv.rows_of(bounds[a : b + 1])[hit], minlength=b - a)
                        linked[a:b] |= 100 * overlap >= percent * (len(mine) + size - overlap)
                tail = np.flatnonzero(~lead)
                yield arrow("pivot long, other long, linked boolean", pivot=pivot[tail], other=own.column(2).take(pa.array(tail)), linked=linked[tail])

    return rows.mapInArrow(run, "pivot long, other long, linked boolean")


def _fits(x: tuple, y: tuple, percent: int):
    """Length and position: (pos, n) of a shared shingle in two sets that may still reach the threshold."""
    (px, nx), (py, ny) = x, y
    return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & (F.least(nx - px, ny - py) * (100 + percent) >= (nx + ny) * percent)


def _candidates(active: DataFrame, labels: DataFrame | None, turn: int, few: int, percent: int) -> DataFrame:
    """Pairs (x, y, turned) with x < y of different components that share a prefix shingle; turned: y is the pivot.

    With few, a shingle's documents are compared with so many of them; without, all that are of different components are.
    """
    here = active.withColumn("label", F.col("d")).withColumn("members", F.lit(1).cast("long"))
    if labels is not None:
        here = active.join(labels.withColumnRenamed("node", "d"), "d", "left").select(*active.columns, F.coalesce("label", "d").alias("label"), F.coalesce("members", F.lit(1)).alias("members"))
    # the larger components' documents lead a shingle's list, in another order each round
    order = Window.partitionBy("h").orderBy(F.col("members").desc(), F.xxhash64(F.lit(turn), "label"), "label", F.xxhash64(F.lit(turn), "d"), "d")
    heads = here.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= max(few, 1)).select("h", *(F.col(c).alias(f"p_{c}") for c in ("d", "pos", "n", "label")))
    if few:
        joined = here.join(heads, "h").where("label <> p_label")
        own, pivot = ("d", "pos", "n"), ("p_d", "p_pos", "p_n")
    else:
        # two lengths that fit are in one band or in neighbouring ones, with one hundredth to spare for rounding
        # of each shingle's documents those outside its leading component, with all others of the same or the next class of length
        lone = here.join(heads.select("h", F.col("p_label").alias("lead")), "h").where("label <> lead")
        band = lambda n: F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(101.0 / percent))).cast("int")
        lone = lone.select("*", band("n").alias("band"))
        near = lone.select("*", F.explode(F.array(*(F.col("band") + k for k in (-1, 0, 1)))).alias("at"))
        others = here.select("h", *(F.col(c).alias(f"p_{c}") for c in ("d", "pos", "n", "label")), band("n").alias("at"))
        joined = near.join(others, ["h", "at"]).where("label <> p_label and (p_label = lead or d < p_d)")
        own, pivot = ("d", "pos", "n"), ("p_d", "p_pos", "p_n")
    (x, px, nx), (y, py, ny) = ([F.col(c) for c in cols] for cols in (own, pivot))
    pairs = joined.where(_fits((px, nx), (py, ny), percent)).select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"), (y > x).alias("turned"))
    return pairs.groupBy("x", "y").agg(F.max("turned").alias("turned"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, pivots: tuple[int, ...] = PIVOTS) -> DataFrame:
    """One row per id: doc_id, n_shingles, component_id."""
    scratch = Scratch(docs.sparkSession)
    own = _own(docs, id_col, text_col)
    sets = scratch.keep(set_rows(own, shingle_counts(own, width), width, percent), "sets")
    known = sets.where("doc_id is not null and n > 0")
    # one node per class: its least id and that id's prefix and parts
    reps = known.groupBy("low", "high", "n").agg(F.min("doc_id").alias("d"), F.min_by(F.struct("prefix", "parts"), "doc_id").alias("s")).select("d", "low", "high", "n", "s.prefix", "s.parts")
    reps = scratch.keep(reps, "classes")
    sizes = scratch.keep(sets.groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.count_if(F.col("n") > 0).alias("texts")), "sizes")
    # ids with several texts join the classes of these; all others have one class and need no link
    members = scratch.keep(known.select("doc_id", "low", "high", "n").join(reps.select("d", "low", "high", "n"), ["low", "high", "n"]).where("doc_id <> d").select("doc_id", "d"), "members")
    scratch.drop(sets)
    edges = members.join(sizes.where("texts > 1").select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("d").alias("b"))

    entries = reps.select("d", "n", F.posexplode("prefix").alias("pos", "h")).select("h", "d", "pos", "n")
    active = scratch.keep(_shared_only(entries), "active")
    wide = reps.join(active.select("d").distinct(), "d", "left_semi").groupBy("d").agg(F.max("n").alias("n"), F.max_by("parts", "n").alias("r"), F.count("*").alias("c"))
    parts = scratch.keep(wide, "parts")
    scratch.drop(reps)
    texts, tried, labels, fetched = None, None, None, []
    for turn, few in enumerate((*pivots, 0)):
        pairs = _candidates(active, labels, turn, few, percent)
        if tried is not None:
            pairs = pairs.join(tried.select(F.least("pivot", "other").alias("x"), F.greatest("pivot", "other").alias("y")), ["x", "y"], "left_anti")
        side = lambda k: parts.select(F.col("d").alias(k), *(F.col(c).alias(f"{c}{k}") for c in ("n", "r", "c")))
        pairs = _likely(pairs.join(side("x"), "x").join(side("y"), "y"), percent)
        pairs = scratch.keep(pairs.select(F.expr("if(turned, y, x)").alias("pivot"), F.expr("if(turned, x, y)").alias("other")), "pairs")
        ends = pairs.select(F.col("pivot").alias("d")).unionByName(pairs.select(F.col("other").alias("d"))).distinct()
        if texts is not None:
            ends = ends.join(texts.select("d"), "d", "left_anti")
        # Spark broadcasts the ids while they are few and shuffles beyond its threshold
        new = own.join(scratch.keep(ends, "ends"), own.doc_id == F.col("d"), "left_semi").select(F.col("doc_id").alias("d"), "text")
        new = scratch.keep(new, "texts")
        fetched.append(new)
        texts = new if texts is None else texts.unionByName(new)
        checked = scratch.keep(_verified(pairs, texts, width, percent), "checked")
        scratch.drop(pairs)
        tried = checked if tried is None else tried.unionByName(checked)
        links = edges.unionByName(checked.where("linked").select(F.col("pivot").alias("a"), F.col("other").alias("b")))
        if few:
            found, edges = merged(links, scratch)
            scratch.drop(labels)
            labels = scratch.keep(found.join(found.groupBy("label").agg(F.count("*").alias("members")), "label"), "labels")
        else:
            scratch.drop(labels)
            labels = scratch.keep(components(links, scratch), "labels")
    scratch.drop(active, parts, *fetched)
    named = labels.select(F.col("node").alias("d"), "label")
    theirs = members.join(named, "d", "left").groupBy("doc_id").agg(F.min(F.coalesce("label", "d")).alias("rep_label"))
    rows = sizes.join(theirs, "doc_id", "left").join(named.withColumnRenamed("d", "doc_id"), "doc_id", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce(F.least("label", "rep_label"), "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of the smallest id of each component, and all rows without an id; columns as they came."""
    others = jaccard_join(docs, id_col, text_col, **options).where("doc_id <> component_id").select("doc_id").alias("others")
    return docs.join(others, docs[id_col].cast("long") == others["doc_id"], "left_anti")
