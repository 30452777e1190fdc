"""Queries over the stored index, global row numbers and identities over loads, each with SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import index, merge
from ..operators.numbering import shared_path
from ..sources import registry
from .catalogue import _TOKENS, Tables, query

_RENEWED = _TOKENS.replace("from documents", "from (select doc_id, case when doc_id % 10 = 0 then 'renewed ' || reverse(text) else text end as text from documents)")


@query(f"""with {_RENEWED}, w as (select * from (values ('the and', 'the'), ('the and', 'and'), ('renewed', 'renewed'), ('renewed eht*', 'renewed'), ('th* le', 'le')) v(q, token)),
h as (select q, doc_id from w join tk using (token) union all select distinct 'renewed eht*', doc_id from tk where starts_with(token, 'eht') union all select distinct 'th* le', doc_id from tk where starts_with(token, 'th'))
select q as query, doc_id from h group by q, doc_id having count(*) = case when q = 'renewed' then 1 else 2 end""")
def stored_search(t: Tables) -> DataFrame:
    """Searches of an index that was stored in two loads, the second of which brings a tenth of the documents anew, reversed and with one more word."""
    docs = t.documents.select("doc_id", "text")
    stored = index.build(docs, "doc_id", ["text"])
    stored.add(docs.where("doc_id % 10 = 0").withColumn("text", F.concat(F.lit("Renewed "), F.reverse("text"))), ["text"])
    asked = ("the and", "renewed", "renewed eht*", "th* le")
    return reduce(DataFrame.unionByName, (stored.search(q).select(F.lit(q).alias("query"), "doc_id") for q in asked))


@query(f"with {_RENEWED} select token, count(*) as n from tk where token <> '' group by token")
def stored_frequencies(t: Tables) -> DataFrame:
    """Document frequencies of the same index after it was compacted."""
    docs = t.documents.select("doc_id", "text")
    stored = index.build(docs, "doc_id", ["text"])
    stored.add(docs.where("doc_id % 10 = 0").withColumn("text", F.concat(F.lit("Renewed "), F.reverse("text"))), ["text"])
    return stored.compact().terms().select("token", "n")


_LOADS = """with n as (select n_nationkey, replace(replace(lower(n_name), ' ', '-'), '_', '-') as town from nation),
one as (select s_suppkey as id, case when s_suppkey % 2 = 0 then 'x' || s_suppkey end as oib, s_suppkey as registry_id, s_suppkey % 3 || '-' || town as wish from supplier join n on s_nationkey = n_nationkey),
first as (select *, row_number() over (partition by wish order by id) as n from one), known as (select *, wish || case when n > 1 then '-' || n else '' end as slug from first),
two as (select c_custkey as id, case when c_custkey % 2 = 0 then 'x' || c_custkey end as oib, case when c_custkey % 7 = 0 then -1 - c_custkey else c_custkey end as registry_id, c_custkey % 3 || '-' || town as wish from customer join n on c_nationkey = n_nationkey),
found as (select two.*, known.slug as had from two left join known on case when two.oib is not null then known.oib = two.oib else known.registry_id = two.registry_id end),
last as (select wish, max(n) as n from first group by wish), fresh as (select f.*, coalesce(l.n, 0) + row_number() over (partition by f.wish order by f.id) as n from found f left join last l using (wish) where had is null)"""


@query(f"{_LOADS} select id, had as slug from found where had is not null union all select id, wish || case when n > 1 then '-' || n else '' end from fresh")
def stable_slugs(t: Tables) -> DataFrame:
    """The second of two loads: persons known by national or registry number keep their slugs though their names and towns changed; slugs of new ones that collide are numbered on."""

    def load(df: DataFrame, key: str, nation: str, registry: str) -> DataFrame:
        met = df.join(t.nation, F.col(nation) == F.col("n_nationkey"))
        wish = text.slug(F.concat(F.lit("Župa "), F.col(key) % 3), F.col("n_name"), F.lit(None).cast("string"))
        return met.select(F.col(key).alias("id"), F.when(F.col(key) % 2 == 0, F.concat(F.lit("x"), key)).alias("oib"), F.expr(registry).alias("registry_id"), wish.alias("slug"))

    nobody = t.spark.createDataFrame([], "oib string, registry_id bigint, slug string")
    first = merge.resolve_identities(nobody, load(t.supplier, "s_suppkey", "s_nationkey", "s_suppkey"), "id")
    second = load(t.customer, "c_custkey", "c_nationkey", "case when c_custkey % 7 = 0 then -1 - c_custkey else c_custkey end")
    return merge.resolve_identities(first, second, "id").select("id", "slug")


@query("""select s_suppkey as id, lower(s_name) as slug, s_name as name, 45.5::double as lat, null::bigint as duplicate_of from supplier
union all select 1000000 + c_custkey, lower(c_name), c_name, null, case when c_custkey % 3 = 0 then c_custkey end from customer""")
def versions_as_one(t: Tables) -> DataFrame:
    """A table stored under two versions of its schema, suppliers under the first and customers under the second, read as one."""
    root, table, k = shared_path(t.spark, "tables"), registry.TABLES["parishes"], F.col("c_custkey")
    table.write(t.supplier.select(F.col("s_suppkey").alias("id"), F.lower("s_name").alias("slug"), F.col("s_name").alias("name"), F.lit("45.5").alias("lat")), root, 1)
    table.write(t.customer.select((k + 1_000_000).alias("id"), F.lower("c_name").alias("slug"), F.col("c_name").alias("name"), F.when(k % 3 == 0, k).alias("duplicate_of")), root)
    return table.read(t.spark, root).select("id", "slug", "name", "lat", "duplicate_of")
