"""Harmonic packing of documents into token sequences.

Lengths fall into reciprocal-capacity classes: class i holds pieces longer than C/(i+1) and at
most C/i tokens, and every bin of class i takes exactly i of them, so any worker can tell a
piece's bin from the piece's number in its class alone. Cutting is free, so a document gives
pieces of C tokens and a rest; a rest that would waste more than TOLERANCE of its bins is cut at
the largest C/j that fits, again and again, until what is left is small.

Workers number their pieces by class; one count per worker and class, added up by class, makes
these numbers global. The pieces of each class's last, unfilled bin (fewer than the bin takes,
so a constant in all, whatever the input) are packed together by first fit.

Defined cases: a null or empty text is the end token alone; a null id stays null; repeated rows
are packed one by one; a text of any length is cut into as many pieces as it takes, one document
being in memory at a time; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow, id_column, persisted

CAPACITY, SMALL, TOLERANCE, END = 2048, 64, 0.02, 1
#: The splitting rule of byte-level BPE vocabularies of this kind (a fixed value).
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker long, class long, number long"


class Encoder:
    """Token ids of a byte-level BPE file of `tokenizers`, run by tiktoken's merges, which are five times as fast."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        to_byte = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
        self._bpe = tiktoken.Encoding("byte-level", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._special = tuple(special)

    def __call__(self, text: str) -> np.ndarray:
        if any(x in text for x in self._special):
            return np.array(self._bpe.encode(text, allowed_special="all"), np.uint32)
        return np.array(self._bpe.encode_ordinary(text), np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(length: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        if rest < SMALL or capacity - capacity // rest * rest <= TOLERANCE * capacity:
            out.append(rest)
            break
        out.append(capacity // -(-capacity // rest))
        rest -= out[-1]
    return out


def _pieces(path: str, capacity: int):
    def run(batches):
        encode, worker, number = encoder(path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            ids, texts = id_column(batch, "doc_id").to_pylist(), batch.column(1)
            rows: list[tuple] = []
            for doc, text in zip(ids, texts, strict=True):
                tokens = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
                start = 0
                for length in cuts(len(tokens), capacity):
                    kind = capacity // length
                    rows.append((doc, start, length, zlib.crc32(tokens[start : start + length].tobytes()), len(tokens), worker, kind, number[kind]))
                    number[kind] += 1
                    start += length
            if rows:
                yield arrow(SCHEMA, **dict(zip([x.split()[0] for x in SCHEMA.split(", ")], map(list, zip(*rows, strict=True)), strict=True)))

    return run


def _fit(capacity: int):
    """First fit, longest first, for the few pieces of unfilled bins."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "class", "place"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        room: list[int] = []
        bins = []
        for length in pdf["length"]:
            k = next((k for k, r in enumerate(room) if r >= length), len(room))
            if k == len(room):
                room.append(capacity)
            room[k] -= length
            bins.append(k)
        return pdf.assign(bin=bins)

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document, place there, checksum, and its sequence and offset in it."""
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    pieces = persisted(source.mapInArrow(_pieces(tokenizer, capacity), SCHEMA), "pieces")
    by_class = Window.partitionBy("class")
    counts = pieces.groupBy("class", "worker").agg((F.max("number") + 1).alias("n"))
    counts = counts.select("class", "worker", (F.sum("n").over(by_class.orderBy("worker")) - F.col("n")).alias("before"), F.sum("n").over(by_class).alias("total"))
    placed = pieces.join(counts, ["class", "worker"]).withColumn("place", F.col("before") + F.col("number")).withColumn("filled", F.floor(F.col("total") / F.col("class")) * F.col("class"))
    own = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "place"]
    full = placed.where("place < filled").select(*own, F.floor(F.col("place") / F.col("class")).alias("bin"))
    rest = placed.where("place >= filled").select(*own, F.lit(0).cast("long").alias("bin"))
    last = rest.groupBy(F.lit(0).alias("all")).applyInPandas(_fit(capacity), rest.schema).withColumn("class", F.lit(0).cast("long"))
    # sequence ids: the bins of class 0 (the rest) come first, then those of each class; there are few classes
    sizes = pieces.groupBy("class").agg(F.floor(F.count("*") / F.col("class")).alias("bins"))
    bases = sizes.select("class", F.coalesce(F.sum("bins").over(Window.partitionBy(F.lit(0)).orderBy("class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    limit = F.lit(capacity * 16)  # more than the bins that the rest can need
    numbered = full.join(F.broadcast(bases), "class").withColumn("sequence_id", limit + F.col("base") + F.col("bin")).drop("base").unionByName(last.withColumn("sequence_id", F.col("bin")))
    inside = Window.partitionBy("sequence_id").orderBy("place", "length", "doc_id", "start").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"))
