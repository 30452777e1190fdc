import gzip
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from waymark.llm import common, components, linededup, lmscore, templates, textvec, warc


# --- WARC ---


def test_warc_round_trip(spark):
    body = "<p>" + "é" * 60 + "</p>"
    rows = [(1, "http://a/1", body), (2, "http://a/2", body), (3, None, "short"), (4, "u\r\nx", "short"), (5, "http://b", None), (None, "http://n", body), (7, "http://c", "\r\n\r\nWARC/1.1\r\n" * 40), (7, "http://c", "\r\n\r\nWARC/1.1\r\n" * 40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit(1)).repartition(3)
    records, archives, index = warc.archive_pages(pages)
    got = sorted(((r.page_id if r.page_id is not None else -1), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.html)) for r in records.collect())
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        again = html == body and i != 1
        want.append((i if i is not None else -1, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 1 if again else None, b"" if again else raw))
    assert got == sorted(want, key=lambda x: x[:2])
    assert index.columns == ["archive", "record", "offset", "length"]
    whole = {r.archive: bytes(r.data) for r in archives.collect()}
    spots = index.orderBy("archive", "record").collect()
    for name, data in whole.items():
        own = [s for s in spots if s.archive == name]
        assert [s.offset for s in own] == [0, *np.cumsum([s.length for s in own])[:-1].tolist()] and own[-1].offset + own[-1].length == len(data)
    # archive, offset and length alone give the record
    read = [warc.parse(gzip.decompress(whole[s.archive][s.offset : s.offset + s.length])) for s in spots]
    assert sorted((r["page_id"] if r["page_id"] is not None else -1, r["record_type"]) for r in read) == sorted((i, kind) for i, _, _, kind, _, _ in got)
    assert warc.archive_pages(pages.where("false"))[0].count() == 0


def test_record_longer_than_an_archive_and_damage(spark):
    rows = [(k, None, str(k) * 3000) for k in range(6)]
    planned = warc.plan_records(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    streams = warc.write_monolithic(planned, 1000)
    archives = warc.normalise(streams)
    assert archives.count() == 6
    assert sorted((r.page_id, bytes(r.html).decode()) for r in warc.read_records(archives, warc.sidecar(archives)).collect()) == [(k, h) for k, _, h in rows]
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "u", b"abc", 3, hashlib.sha256(b"abd").hexdigest(), "response", None))


def test_split_stream_reads_any_members():
    records = [warc.record(k, "u", bytes([k]) * k * 1000, k * 1000, "d", "response", None) for k in range(30)]
    streams = [gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records)), gzip.compress(b"".join(records[:7])) + gzip.compress(b"".join(records[7:]))]
    for s in streams:
        assert list(warc.split_stream(s)) == records
    with pytest.raises(ValueError):
        list(warc.split_stream(streams[0][:-30]))


# --- line dedup ---


def line_brute(rows):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[i] = (None, 0)
            continue
        lines = text.split("\n")
        rolled = [md5(md5(a) + md5(b)) for a, b in zip(lines, lines[1:], strict=False)]
        cuts = [k + 1 for k in range(1, len(rolled) - 1) if rolled[k] < rolled[k - 1] and rolled[k] < rolled[k + 1]]
        kept, gone = [], 0
        for a, b in zip([0, *cuts], [*cuts, len(lines)], strict=True):
            chunk = "\n".join(lines[a:b])
            if b - a > 1 and re.search(r"[^\s]", chunk, re.A):
                if chunk in seen:
                    gone += 1
                    continue
                seen.add(chunk)
            kept.append(chunk)
        out[i] = ("\n".join(kept), gone)
    return out


def test_line_dedup_matches_brute_force(documents):
    r = random.Random(6)
    passage = [prose(k, 8) for k in range(12)]
    texts = []
    for k in range(60):
        lines = [prose(1000 + 50 * k + j, 6) for j in range(r.randint(0, 9))]
        if k % 2:
            at = r.randint(0, len(lines))
            lines[at:at] = passage[: r.choice([3, 6, 12])]
        texts.append("\n".join(lines))
    texts += [texts[1], texts[3], "\n\n\n", "\n\n\n", None, "", "same\n" * 9, "same\n" * 9]
    rows = list(enumerate(texts))
    got = {r.row.doc_id: (r.kept, len(r.removed)) for r in linededup.dedup_lines(documents(rows)).collect()}
    assert got == line_brute(rows)
    assert sum(n for _, n in got.values()) > 20


def test_line_dedup_is_native_and_keeps_columns(documents):
    docs = documents([(1, "a\nb"), (None, "a\nb"), (2, "a\nb"), (2, "a\nb"), (3, None)]).withColumnsRenamed({"lang": "removed", "source": "id"})
    out = linededup.without_repeats(docs)
    assert out.columns == docs.columns
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in out.collect()) == [(False, 3, None), (True, 0, "a\nb")]
    assert linededup.dedup_lines(docs.where("false")).count() == 0


# --- language models ---


def test_scores_match_brute_force(documents, spark, corpus):
    texts = [t for t in corpus if len(t or "") < 5000]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(0, 60)] + [(None, 1, 0), (0, 0, 1)], "doc_id long, quality int, toxic int")
    vocab = lmscore.VOCAB

    def ids(t):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        return lmscore.token_ids(raw, np.array([0, len(raw)]))[0].tolist()

    def cell(a, b):
        return int(textvec.mix(np.array([a * (vocab + 1) + b], np.uint64))[0]) % lmscore.BIGRAMS

    counts = [[Counter(), Counter(), Counter()] for _ in range(2)]
    for k, t in enumerate(texts):
        own = ids(t)
        for m in ([0, 1] if k < 60 and k % 2 else [1]):
            for a, b in zip([vocab, *own], own, strict=False):
                counts[m][0][b] += 1
                counts[m][1][a] += 1
                counts[m][2][cell(a, b)] += 1

    def loss(m, own):
        uni, ctx, pair = counts[m]
        total = 0.0
        for a, b in zip([vocab, *own], own, strict=False):
            p = (uni[b] + 1) / (sum(uni.values()) + vocab)
            if ctx[a]:
                p = lmscore.WEIGHT * min(1, pair[cell(a, b)] / ctx[a]) + (1 - lmscore.WEIGHT) * p
            total -= math.log(p)
        return total / len(own)

    for r in lmscore.cross_entropy_difference(documents(texts), labels).collect():
        own = ids(texts[r.doc_id])
        assert r.n_tokens == len(own)
        if own:
            assert math.isclose(r.target_loss, loss(0, own), rel_tol=1e-9) and math.isclose(r.background_loss, loss(1, own), rel_tol=1e-9)
        else:
            assert r.score is None


def test_scores_part_held_out_documents(documents, spark):
    good = [prose(k, 80, 300) for k in range(60)]
    bad = [prose(k, 80, 300).replace("w", "v") for k in range(60, 120)]
    labels = spark.createDataFrame([(k, int(k < 60)) for k in range(120) if k % 3], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in lmscore.cross_entropy_difference(documents(good + bad), labels).collect()}
    assert max(got[k] for k in range(0, 60, 3)) < min(got[k] for k in range(60, 120, 3))
    assert lmscore.cross_entropy_difference(documents(["x"]).where("false"), labels).count() == 0


# --- templates ---


ITEM = "A train leaves Zagreb at 9 and travels 120 km to Split with 3 stops; after that it goes back to Zagreb at 80 km per hour. How long does the whole trip of the train take?"


def test_leaks(documents, spark):
    bench = spark.createDataFrame([(1, ITEM), (2, prose(5, 40)), (3, None), (4, "only three words"), (None, prose(6, 30))], "item_id long, text string")
    again = ITEM.replace("Zagreb", "Rome").replace("Split", "Milan").replace("120", "300").replace("9", "7").replace("80", "95")
    clash = again.replace("back to Rome", "back to Paris")
    docs = documents([f"{prose(1, 50)}. {ITEM} {prose(2, 50)}", f"{prose(3, 50)}\n{again}\n{prose(4, 9)}", f"{prose(8, 20)}. {clash}", prose(9, 200), prose(5, 40), "see Only three words!", None, prose(7, 10) + " " + " ".join(prose(5, 40).split()[:12])])
    found = templates.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(0, 1), (1, 1), (4, 2)}
    kept = templates.without_leaks(docs.withColumnsRenamed({"lang": "of", "source": "id"}), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7]
    assert templates.leaks(docs.where("false"), bench).count() == 0 and templates.leaks(docs, bench.where("false")).count() == 0


def test_bit_map_has_no_false_negatives(documents, spark):
    items = [prose(k, 25) for k in range(50)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = documents([f"{prose(100 + k, 30)} {t}" for k, t in enumerate(items)])
    assert {(r.doc_id, r.item_id) for r in templates.leaks(docs, bench).collect()} == {(k, k) for k in range(50)}


# --- components ---


def test_components(spark):
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 150)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)] + [(None, 3), (5, 5)]
    got = {x.node: x.label for x in components.components(spark.createDataFrame(edges, "a long, b long"), common.Scratch(spark)).collect()}
    label = {}
    nodes = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    near = {n: {b for a, b in edges if a == n and b is not None} | {a for a, b in edges if b == n and a is not None} for n in nodes}
    for n in sorted(nodes):
        stack = [n]
        while stack:
            if (x := stack.pop()) not in label:
                label[x] = n
                stack += near[x]
    assert got == label
    assert components.components(spark.createDataFrame([], "a long, b long"), common.Scratch(spark)).count() == 0
