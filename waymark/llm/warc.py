"""WARC archives: written as one gzip stream a file, normalised to one member a record, read by index.

Executors share no local files and the store may be one that only Spark reads, so an archive is one
binary value of a table in the shared folder, of ARCHIVE bytes of records and one more at most.
`write_monolithic` makes archives whose records sit in a single gzip stream, so no record can be
reached without inflating all before it. `normalise` inflates each stream once, in steps of fixed
size, finds the records as they pass and writes each as a gzip member of its own into a new archive.
A sidecar index (archive, record, offset, length) is a table of its own. `read_records` takes a
record's bytes by archive, offset and length alone, inflates that member, and computes the size
and digest of every stored payload anew; a record that is not what its head says raises an error.

Of pages with equal payloads of at least MIN_PAYLOAD bytes the one with the smallest id is stored
and the others are revisit records without a payload; rows of the smallest id are all stored.

Defined cases: a null html is an empty payload; a null url an empty target; a null page id is
kept and is never the one that others refer to unless all ids of that payload are null;
repeated ids are written again; a record longer than ARCHIVE has an archive of its own; an empty
table gives no archives; other columns, also such as are named like ours, are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from itertools import accumulate

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow

MIN_PAYLOAD = 100
#: Bytes of records after which a new archive begins; a larger record has one of its own.
ARCHIVE = 4 << 20
STEP = 256 << 10
_STREAMS = "archive string, data binary"
_ARCHIVES = "archive string, data binary, offset array<long>, length array<long>"
_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, html binary"
_LINE = b"\r\n"


def record(page_id, url, html: bytes, size: int, digest: str, kind: str, refers) -> bytes:
    """A WARC/1.1 record with its head, block and end."""
    block = html if kind == "response" else b""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>", "WARC-Target-URI": "".join((url or "").splitlines()), "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Payload-Length": size}
    if kind == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:page:{'' if refers is None else refers}>"}
    head["Content-Length"] = len(block)
    return b"WARC/1.1" + _LINE + b"".join(f"{k}: {v}".encode() + _LINE for k, v in head.items()) + _LINE + block + _LINE + _LINE


def parse(raw: bytes) -> dict:
    head, _, rest = raw.partition(_LINE + _LINE)
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    number = lambda s: int(s[len("<urn:page:") : -1]) if len(s) > len("<urn:page:>") else None
    block = rest[: int(fields["Content-Length"])]
    size, digest = int(fields["WARC-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (size, digest) != (len(block), hashlib.sha256(block).hexdigest()):
        raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
    return {"page_id": number(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None, "url": fields["WARC-Target-URI"], "html": block}


def plan_records(pages: DataFrame) -> DataFrame:
    """Pages with their payload's size and digest, and whether they are stored or revisit another page.

    The first page of each digest is found by a pre-aggregated minimum over (digest, id) pairs;
    digests seen once need no join, so only repeated payloads meet again.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("html"))
    base = base.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", F.sha2("html", 256))
    firsts = base.where(F.col("payload_bytes") >= MIN_PAYLOAD).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
    repeats = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return base.join(firsts, "payload_digest", "left").select("page_id", "url", "html", "payload_bytes", "payload_digest", F.when(repeats, "revisit").otherwise("response").alias("record_type"), F.when(repeats, F.col("first_id")).alias("refers_to"))


def write_monolithic(planned: DataFrame, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Rows (archive, data): each archive is a single gzip stream over many records."""

    def run(batches):
        task, number, held = TaskContext.get().partitionId(), 0, 0
        pack, out = zlib.compressobj(6, zlib.DEFLATED, 31), []
        for batch in batches:
            for row in batch.to_pylist():
                raw = record(row["page_id"], row["url"], row["html"] or b"", row["payload_bytes"], row["payload_digest"], row["record_type"], row["refers_to"])
                out.append(pack.compress(raw))
                held += len(raw)
                if held >= archive_bytes:
                    yield arrow(_STREAMS, archive=[f"{task:06d}-{number:06d}.warc.gz"], data=[b"".join([*out, pack.flush()])])
                    pack, out, held, number = zlib.compressobj(6, zlib.DEFLATED, 31), [], 0, number + 1
        if held:
            yield arrow(_STREAMS, archive=[f"{task:06d}-{number:06d}.warc.gz"], data=[b"".join([*out, pack.flush()])])

    return planned.mapInArrow(run, _STREAMS)


def split_stream(data: bytes) -> Iterator[bytes]:
    """Raw records of a gzip stream of any number of members, inflated once, STEP bytes at a time."""
    inflate, buffer, need, rest = zlib.decompressobj(31), bytearray(), None, data
    while True:
        while True:
            if need is None:
                if (end := buffer.find(_LINE + _LINE)) < 0:
                    break
                length = next(int(x.split(b":")[1]) for x in bytes(buffer[:end]).split(_LINE) if x.lower().startswith(b"content-length:"))
                need = end + 4 + length + 4
            if len(buffer) < need:
                break
            yield bytes(buffer[:need])
            del buffer[:need]
            need = None
        if inflate.eof:
            rest = inflate.unused_data
            if not rest:
                break
            inflate = zlib.decompressobj(31)
        elif not rest:
            raise ValueError("the gzip stream is cut short")
        buffer += inflate.decompress(rest, STEP)
        rest = inflate.unconsumed_tail
    if buffer:
        raise ValueError("bytes after the last record")


def normalise(streams: DataFrame) -> DataFrame:
    """Rows (archive, data, offset, length): archives of one member a record, and where their records lie, in order."""

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1), strict=True):
                members = [gzip.compress(raw, 6, mtime=0) for raw in split_stream(data.as_py())]
                sizes = [len(m) for m in members]
                yield arrow(_ARCHIVES, archive=[name.as_py()], data=[b"".join(members)], offset=[[0, *accumulate(sizes)][:-1]], length=[sizes])

    return streams.mapInArrow(run, _ARCHIVES)


def sidecar(archives: DataFrame) -> DataFrame:
    """The index (archive, record, offset, length) of normalised archives."""
    spots = F.arrays_zip("offset", "length")
    return archives.select("archive", F.posexplode(spots).alias("record", "s")).select("archive", F.col("record").cast("long").alias("record"), "s.offset", "s.length")


def read_records(archives: DataFrame, index: DataFrame) -> DataFrame:
    """The records at the index's places, each inflated by itself from its archive (archive, data)."""
    # the index grows with the pages, so it is never broadcast
    wanted = index.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("spots")).hint("shuffle_merge")

    def run(batches):
        for batch in batches:
            for data, spots in zip(batch.column(0), batch.column(1), strict=True):
                whole = memoryview(data.as_buffer())
                spots = spots.as_py()
                for k in range(0, len(spots), 256):
                    rows = [parse(gzip.decompress(whole[s["offset"] : s["offset"] + s["length"]])) for s in spots[k : k + 256]]
                    yield arrow(_RECORDS, **{c: [r[c] for r in rows] for c in rows[0]})

    return archives.join(wanted, "archive").select("data", "spots").mapInArrow(run, _RECORDS)


def archive_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records read back, normalised archives, sidecar index); archives and index are tables of the shared folder."""
    scratch = Scratch(pages.sparkSession)
    streams = scratch.keep(write_monolithic(plan_records(pages)), "monolithic")
    scratch.sweep()
    archives = scratch.keep(normalise(streams), "archives")
    index = scratch.keep(sidecar(archives.select("archive", "offset", "length")), "index")
    scratch.drop(streams)
    archives = archives.select("archive", "data")
    return read_records(archives, index), archives, index
