"""Queries over formats, ladders, shapes and records, each with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import linking, merge, stats, territory
from ..sources import readers
from .catalogue import CUSTOMERS, SUPPLIERS, Tables, customers, query, suppliers
from .linked import _PLANE, _SPOTS, _saint, _spots


@query(f"""select o_orderkey, case when o_orderkey % 10 = 0 then null when o_orderkey % 10 = 1 then 'oko 1900.' else day(o_orderdate) || '. ' || {list(text.MONTHS)}[month(o_orderdate)] || ' ' || year(o_orderdate) || '.' end as shown from orders""")
def long_dates(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    date = F.when(k % 10 == 0, "").when(k % 10 == 1, "oko 1900.").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", text.long_date(date).alias("shown"))


@query("""select o_orderkey, translate(format('{:,}', o_orderkey * 37), ',', '.') as whole, translate(format('{:,}', (o_orderkey * 1237 + 5) // 10), ',', '.') || ' km²' as area, replace(format('{:.1f}', (o_orderkey % 1000) / 7.0::double), '.', ',') || ' %' as share,
translate(format('{:,}', o_orderkey), ',', '.') || case when o_orderkey % 100 between 11 and 14 then ' crkava' when o_orderkey % 10 = 1 then ' crkva' when o_orderkey % 10 between 2 and 4 then ' crkve' else ' crkava' end as churches from orders""")
def local_numbers(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", text.local_number(k * 37).alias("whole"), text.square_kilometres(k * 1237 / F.lit(10.0)).alias("area"), text.local_percent(k % 1000 / F.lit(7.0)).alias("share"), text.counted(k, "crkva", "crkve", "crkava").alias("churches"))


@query("""with a as (select s_suppkey as k, case when s_suppkey % 4 > 0 then 'Ulica ' || s_suppkey || case when s_suppkey % 4 > 1 then ', 10 ' || (100 + s_suppkey % 900) || ' Grad' else '' end || case when s_suppkey % 4 > 2 then ', HRVATSKA' else '' end else '' end as address, case when s_suppkey % 5 > 0 then 'Grad ' || s_suppkey % 7 else '' end as city, case when s_suppkey % 3 > 0 then 'C' || s_suppkey % 9 else '' end as county from supplier),
l as (select k, list_distinct(list_filter([nullif(address, ''), case when k % 4 > 1 then '10' || (100 + k % 900) end, case when city <> '' and county <> '' then city || ', ' || county end, nullif(city, '')], lambda x: x is not null)) as steps,
 list_filter([nullif(address, ''), case when k % 4 > 1 then '10' || (100 + k % 900) end, case when city <> '' and county <> '' then city || ', ' || county end, nullif(city, '')], lambda x: x is not null) as ordered from a)
select k as s_suppkey, array_to_string(list_transform(ordered, lambda x: x || ', Hrvatska'), ' | ') as ladder from l""")
def address_ladders(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    address = F.when(k % 4 > 0, F.concat(F.lit("Ulica "), k, F.when(k % 4 > 1, F.concat(F.lit(", 10 "), k % 900 + 100, F.lit(" Grad"))).otherwise(""), F.when(k % 4 > 2, ", HRVATSKA").otherwise(""))).otherwise("")
    city, county = F.when(k % 5 > 0, F.concat(F.lit("Grad "), k % 7)).otherwise(""), F.when(k % 3 > 0, F.concat(F.lit("C"), k % 9, F.lit(" županija"))).otherwise("")
    return t.supplier.select("s_suppkey", F.array_join(text.address_ladder(county, address, city), " | ").alias("ladder"))


@query(f"with {CUSTOMERS}, {SUPPLIERS} select c_custkey, round({_PLANE.format(a='c', b='s')}, 6) as km from c join s on c_custkey % (select count(*) from supplier) = s_suppkey")
def plane_distances(t: Tables) -> DataFrame:
    s = suppliers(t).select("s_suppkey", F.col("lat").alias("b_lat"), F.col("lng").alias("b_lng"))
    met = customers(t).join(s, F.col("c_custkey") % t.supplier.count() == F.col("s_suppkey"))
    return met.select("c_custkey", F.round(geo.plane_km(F.col("lat"), F.col("lng"), F.col("b_lat"), F.col("b_lng")), 6).alias("km"))


@query("select c_custkey, round(c_custkey / 7.0::double, 6) as lng, round(45 + c_custkey / 11.0::double, 6) as lat from customer")
def rounded_points(t: Tables) -> DataFrame:
    ring = F.array(F.array(F.col("c_custkey") / 7.0, F.lit(45) + F.col("c_custkey") / 11.0))
    first = F.get(F.get(F.get(geo.rounded(F.array(F.array(ring))), F.lit(0)), F.lit(0)), F.lit(0))
    return t.customer.select("c_custkey", first.alias("p")).select("c_custkey", F.col("p")[0].alias("lng"), F.col("p")[1].alias("lat"))


@query("select 'B' || s_suppkey as name, 1::int as n_rings, (1 + s_suppkey % 5)::double as square_degrees from supplier where s_suppkey % 4 > 0")
def polygonized(t: Tables) -> DataFrame:
    """Borders of two outer ways that run against each other, with an inner way that does not count; every fourth border stays open and is no polygon."""
    k, w = F.col("s_suppkey"), (F.col("s_suppkey") % 5 + 1).cast("double")
    point = lambda x, y: F.struct(F.lit(float(y)).alias("lat"), (x if not isinstance(x, (int, float)) else F.lit(float(x))).alias("lon"))
    way = lambda role, *points: F.struct(F.lit("way").alias("type"), F.lit(role).alias("role"), F.array(*points).alias("geometry"))
    lower, upper = way("outer", point(0, 1), point(0, 0), point(w, 0), point(w, 1)), way("", point(0, 1), point(w, 1))
    inner = way("inner", point(0.1, 0.1), point(0.2, 0.1), point(0.2, 0.2), point(0.1, 0.1))
    relations = t.supplier.select(F.lit("relation").alias("type"), F.struct(F.concat(F.lit("B"), k).alias("name")).alias("tags"), F.when(k % 4 > 0, F.array(lower, inner, upper)).otherwise(F.array(lower, inner)).alias("members"))
    found = territory.polygonize(relations)
    return found.select("name", F.size("rings").alias("n_rings"), F.round(F.aggregate("rings", F.lit(0.0), lambda s, r: s + geo.ring_area(r)), 6).alias("square_degrees"))


@query("""select coalesce(case when p_partkey % 3 > 0 then 'Z-' || p_partkey end, 'ID-' || p_partkey) as heritage_id, trim(regexp_replace(p_name, ' +', ' ', 'g')) as name, 'Mjesto ' || p_partkey % 9 as settlement from part where p_partkey % 4 < 2 and p_partkey % 11 > 0""")
def heritage_records(t: Tables) -> DataFrame:
    """Records of the two sacral classes, in whatever case, with a code made from the id where there is none."""
    k = F.col("p_partkey")
    kinds = F.when(k % 4 == 0, "Sakralna  graditeljska baština").when(k % 4 == 1, "sakralno-profana graditeljska baština ").when(k % 4 == 2, "profana graditeljska baština")
    text_ = lambda c: c.cast("string")
    rows = t.part.select(k.alias("id"), F.when(k % 3 > 0, F.concat(F.lit("Z-"), k)).alias("Oznaka_dobra"), kinds.alias("Klasifikacija"), F.when(k % 11 > 0, F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("\t ")))).alias("Naziv"), F.concat(F.lit("Mjesto \n"), k % 9).alias("Mjesto_smjestaja"), *(text_(F.lit(None)).alias(c) for c in ("Opcina_grad", "Zupanija", "Pravni_status", "Vrijeme_nastanka", "Opis_dobra")))
    return readers.heritage(rows).select("heritage_id", "name", "settlement")


@query("""select c_custkey as id, case when c_custkey % 5 = 0 then 'own' when c_custkey % 3 = 0 then 'church' when c_custkey % 2 = 0 then 'centroid' when c_custkey % 7 = 0 then 'geocoder' end as geo_source, case when c_custkey % 5 = 0 then 1.0::double when c_custkey % 3 = 0 then 2.0 when c_custkey % 2 = 0 then 3.0 when c_custkey % 7 = 0 then 4.0 end as lat from customer""")
def geocoder_ladder(t: Tables) -> DataFrame:
    """The whole ladder: own point, church, settlement's centre, and landed answers of a geocoder last."""
    k = F.col("c_custkey")
    at = lambda by, v: t.customer.where(k % by == 0).select(k.alias("id"), F.lit(v).alias("lat"), F.lit(v).alias("lng"))
    seats = t.customer.select(k.alias("id"), F.when(k % 5 == 0, 1.0).alias("lat"), F.when(k % 5 == 0, 1.0).alias("lng"))
    return linking.geocode(seats, at(3, 2.0), at(2, 3.0), at(7, 4.0)).select("id", "geo_source", "lat")


@query(f"""with {_SPOTS}, p as (select c.id as rec_id, min(s.id) as cand_id from c join s using (nk, saint) where c.id % 3 <> 1 group by c.id having count(*) = 1),
n as (select rec_id, cand_id from p join c on c.id = rec_id join s on s.id = cand_id where c.lat is null or {_PLANE.format(a="c", b="s")} <= 25)
select min(rec_id) as rec_id, cand_id from n group by cand_id""")
def church_owners(t: Tables) -> DataFrame:
    """Only kinds of legal persons that may own a church are given one."""
    parishes, pool = _spots(t)
    kind = F.element_at(F.array(F.lit("zupa"), F.lit("caritas"), F.lit("samostan")), (F.col("id") % 3 + 1).cast("int"))
    parishes = parishes.withColumn("name", F.concat(F.lit("ŽUPA SV. "), F.upper(_saint(F.col("id"))))).withColumn("kind", kind)
    pool = pool.withColumn("name", F.concat(F.lit("Crkva sv. "), _saint(F.col("id")))).withColumn("settlement", F.lit(None).cast("string")).withColumn("municipality", F.lit(None).cast("string"))
    return linking.link_parish_churches(parishes, pool).select("rec_id", "cand_id")


@query("select c_custkey, c_mktsegment from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def queue_left(t: Tables) -> DataFrame:
    """What is left of a queue when the matched rows are taken out."""
    return merge.without_consumed(t.customer.select("c_custkey", "c_mktsegment"), t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""select n_name, count(s_suppkey) filter (where s_suppkey % 7 < 5 and s_suppkey % 9 > 0) as active from nation left join supplier on s_nationkey = n_nationkey group by n_name""")
def active_per_parent(t: Tables) -> DataFrame:
    """Active, distinct persons of each parent, none being a count too."""
    k = F.col("s_suppkey")
    rows = t.supplier.select("s_nationkey", k, F.when(k % 7 < 2, None).when(k % 7 < 5, "AKTIVAN").otherwise("PRESTANAK").alias("status"), F.when(k % 9 == 0, k).alias("duplicate_of"))
    active = rows.where(merge.active_distinct(F.col("status"), F.col("duplicate_of")))
    return stats.child_counts(t.nation, active, "n_nationkey", "s_nationkey", "active").select("n_name", "active")
