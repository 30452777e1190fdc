"""Very long texts, empty tables and columns named like the operators' own."""

from collections import Counter

from waymark.llm import linededup, lmscore, packing, quality, secrets
from waymark.llm.queries import tokenizer_path

from .conftest import prose
from .test_rest import line_brute

LONG = prose(21, 60_000)


def test_long_lines_are_deduplicated_whole(documents):
    passage = [prose(50 + k, 8) for k in range(30)]
    lines = [prose(2000 + k, 12) for k in range(3000)]
    rows = [(1, "\n".join([*lines, *passage])), (2, "\n".join([*passage, *lines[:9]])), (3, LONG), (4, "\n" * 5000), (5, "\n".join(lines))]
    got = {r.row.doc_id: (r.kept, len(r.removed)) for r in linededup.dedup_lines(documents(rows)).collect()}
    assert got == line_brute(rows)
    assert got[5][1] > 300 and len(got[5][0]) < len(rows[4][1]) // 20


def test_scores_of_long_texts_and_clashing_columns(documents, spark):
    labels = spark.createDataFrame([(0, 1, "x"), (1, 0, None)], "doc_id long, quality int, bucket string")
    docs = documents([LONG, "w1 w2", None, (None, "w1 w2")])
    renamed = docs.withColumnsRenamed({"lang": "bucket", "source": "shard", "n_chars": "good_id"})
    plain = lmscore.cross_entropy_difference(docs, labels.drop("bucket"))
    rows = sorted(lmscore.cross_entropy_difference(renamed, labels).collect(), key=str)
    assert rows == sorted(plain.collect(), key=str) and len(rows) == 4
    assert {r.doc_id: r.n_tokens for r in rows} == {0: 60_000, 1: 2, 2: 0, None: 2}
    assert lmscore.cross_entropy_difference(renamed.where("false"), labels).count() == 0
    assert {r.target_loss is None for r in lmscore.cross_entropy_difference(docs.where("doc_id = 0"), labels.where("false")).collect()} == {False}


def test_quality_of_long_texts_and_clashing_columns(documents):
    texts = [LONG, (prose(3, 40) + "\n") * 2000, "a" * 100_000, None]
    docs = documents(texts).withColumnsRenamed({"lang": "kept", "source": "n_words", "n_chars": "base_failed"})
    got = {r.doc_id: r for r in quality.quality_signals(docs).collect()}
    for k, t in enumerate(texts):
        words = (t or "").split()
        grams = list(zip(words, words[1:], words[2:], strict=False))
        often = Counter(grams)
        hit = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(3)}
        assert (got[k].n_words, got[k].word_chars, got[k].n_repeat_words) == (len(words), sum(map(len, words)), len(hit))
        assert got[k].base_failed == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
    assert [got[k].n_dup_lines for k in range(4)] == [0, 1999, 0, 0]
    assert not (got[1].kept or got[2].kept or got[3].kept)


def test_secrets_and_pieces_with_clashing_columns(documents):
    docs = documents(["token: abcdef123 " + LONG, None]).withColumnsRenamed({"lang": "spans", "source": "sequence_id", "n_chars": "length"})
    assert {r.doc_id: r.n_assign for r in secrets.scan_secrets(docs).collect()} == {0: 1, 1: 0}
    pieces = sorted((r.doc_id, r.start, r.length, r.doc_tokens) for r in packing.pack(docs, tokenizer_path()).collect())
    for k in (0, 1):
        own = [p for p in pieces if p[0] == k]
        assert [p[1] for p in own] == [sum(q[2] for q in own[:n]) for n in range(len(own))] and sum(p[2] for p in own) == own[0][3]
    assert packing.pack(docs.where("false"), tokenizer_path()).count() == 0
    assert secrets.scan_secrets(docs.where("false")).count() == 0
