"""The queries opN_<name> over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, jaccard, linededup, lmscore, merkle, packing, pii, quality, ranked, secrets, suffixdedup, templates, warc
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan_pii(_docs(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir), tokenizer_path())


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(_docs(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.leaks(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("of")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))[0].select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup_substrings(_docs(spark, sf_dir), with_bytes=False).drop("kept")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_docs(spark, sf_dir))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.cross_entropy_difference(_docs(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_signals(_docs(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(_docs(spark, sf_dir))
    gone = F.expr("cast(aggregate(removed, 0, (n, p) -> n + p.e - p.s) as bigint)")
    return done.select(F.col("row.doc_id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_chunks_removed"), gone.alias("n_lines_removed"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op11_tokenization_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(_docs(spark, sf_dir), tokenizer_path(), decode=True))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(_docs(spark, sf_dir))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_pii, op2_packing, op3_ngram_jaccard, op4_decontamination, op5_warc, op6_suffix_dedup, op7_secrets, op8_lm_scoring, op9_quality, op10_line_dedup, op11_tokenization_automaton, op12_merkle_manifest, op13_ranked_search, pipeline)}

#: A payload is the html in UTF-8; records are read back as they were written.
_WARC_SQL = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest, min(page_id) as first_id from p where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes::bigint as payload_bytes, p.payload_digest,
  case when first_id is not null and page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from p left join f on p.payload_digest = f.payload_digest
"""

_LINES_SQL = r"""
with l as (select doc_id, text, string_split(text, chr(10)) as lines from documents),
e as (select doc_id, lines, generate_subscripts(lines, 1) as k, unnest(lines) as line from l),
r as (select doc_id, k, line, md5(md5(line) || md5(lead(line) over (partition by doc_id order by k))) as r from e),
c as (select doc_id, k, line, case when r < lag(r) over w and r < lead(r) over w then 1 else 0 end as cut from r window w as (partition by doc_id order by k)),
s as (select doc_id, k, line, coalesce(sum(cut) over (partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0) as chunk from c),
t as (select doc_id, chunk, min(k) as k, count(*) as n, string_agg(line, chr(10) order by k) as body from s group by doc_id, chunk),
d as (select *, row_number() over (partition by body order by doc_id, k) as nth, regexp_matches(body, '[^\s]') and n > 1 as counts from t),
o as (select doc_id, sum(n)::bigint as n_lines, count(*) filter (where counts and nth > 1) as n_chunks_removed,
  coalesce(sum(n) filter (where counts and nth > 1), 0)::bigint as n_lines_removed,
  coalesce(string_agg(body, chr(10) order by k) filter (where not (counts and nth > 1)), '') as kept from d group by doc_id)
select doc_id, n_lines, n_chunks_removed::bigint as n_chunks_removed, n_lines_removed, sha256(kept) as kept_sha256 from o
"""

_field = "coalesce(octet_length(encode({0}::varchar)) || ':' || {0}::varchar, '-')".format

#: The checksum is worked out bit by bit (3988292384 is its reversed polynomial), as SQL has no function for it.
_MERKLE_SQL = f"""
with recursive d as (select doc_id, lang, {" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} as head, text,
    list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ord(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, b: case when b >= 0 then xor(a, b) when a & 1 = 1 then xor(a >> 1, 3988292384::bigint) else a >> 1 end) as crc from documents),
h as (select doc_id, lang, sha256(head || {_field("text")}) as leaf, case when xor(crc, 4294967295::bigint) % 3 = 0 then sha256(head || {_field("translate(text, '" + merkle.UPPER + "', '" + merkle.UPPER.lower() + "')")}) end as changed from d),
leaves as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as size, dense_rank() over (order by lang nulls first) - 1 as tree from h),
n_trees as (select count(distinct tree) as n from leaves),
below as (select tree, 0 as level, idx, size, leaf as hash from leaves
  union all select tree, level + 1, idx // 8, any_value((size + 7) // 8), sha256(string_agg(hash, '' order by idx)) from below where size > 1 group by tree, level, idx // 8),
subroots as (select tree, hash as subroot from below where size = 1),
above as (select -1::bigint as tree, 0 as level, tree as idx, n as size, subroot as hash from subroots, n_trees
  union all select tree, level + 1, idx // 8, any_value((size + 7) // 8), sha256(string_agg(hash, '' order by idx)) from above where size > 1 group by tree, level, idx // 8),
nodes as (select * from below union all select * from above),
asked as (select tree as of_tree, idx as of_idx, tree, idx, size, 0 as base from leaves union all select tree, idx, -1, tree, n, 64 from leaves, n_trees),
levels as (select *, unnest(range(0, 20)) as level from asked),
steps as (select of_tree, of_idx, base + l.level as rung, coalesce(string_agg(n.hash, '' order by n.idx) filter (n.idx < l.idx // (8 ** l.level)::bigint), '') as a,
    coalesce(string_agg(n.hash, '' order by n.idx) filter (n.idx > l.idx // (8 ** l.level)::bigint), '') as b
  from levels l join nodes n on n.tree = l.tree and n.level = l.level and n.idx // 8 = l.idx // (8 ** (l.level + 1))::bigint where l.size > 8 ** l.level group by all),
proofs as (select of_tree, of_idx, string_agg(a || b, '' order by rung) as proof, list(a || ',' || b order by rung) as sides from steps group by all),
root as (select hash as root from above where size = 1),
folded as (select doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) as proof_sha256,
    list_reduce(list_prepend(coalesce(changed, leaf), coalesce(sides, [])), lambda x, s: sha256(string_split(s, ',')[1] || x || string_split(s, ',')[2])) as folded_root
  from leaves join subroots using (tree) cross join root left join proofs on of_tree = leaves.tree and of_idx = leaves.idx)
select *, folded_root = root as verified from folded
"""

_terms = ("regexp_extract_all(translate({0}, '" + merkle.UPPER + "', '" + merkle.UPPER.lower() + r"'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')").format
_SEARCH_SQL = f"""
with d as (select doc_id, {_terms("text")} as terms from documents), s as (select count(*) filter (len(terms) > 0) as docs, sum(len(terms))::bigint as length from d),
p as (select doc_id, len(terms)::bigint as n, unnest(terms) as term from d), c as (select doc_id, n, term, count(*)::bigint as tf from p group by all),
w as (select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w from c, s group by term),
i as (select distinct item_id, unnest({_terms("text")}) as term from benchmark),
f as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::bigint as score from i join w using (term) join c using (term), s group by all)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from f where score > 0 qualify rank <= 50
"""

ORACLE = {"op5_warc": _WARC_SQL, "op10_line_dedup": _LINES_SQL, "op12_merkle_manifest": _MERKLE_SQL, "op13_ranked_search": _SEARCH_SQL}
