"""Queries over the linking chain: scores near the threshold, unique candidates, heritage records, parish churches, filials, enrichment, territories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import linking, match, territory
from ..sources import readers
from .catalogue import _MATCH, SUPPLIERS, Tables, _records, _towns, query, sql_lcs, sql_metres, suppliers

_SAINTS = ("Marka", "Jurja", "Ane", "Nikole", "Roka", "Vida", "Luke", "Petra")


def _saint(key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, _SAINTS)), (key % 8 + 1).cast("int"))


_RATIO = f"""w as (select *, list_distinct(string_split(asked, ' ')) as wa, list_distinct(string_split(name, ' ')) as wb from met),
s as (select *, array_to_string(list_sort(list_intersect(wa, wb)), ' ') as i, array_to_string(list_sort(list_filter(wa, lambda x: not list_contains(wb, x))), ' ') as da, array_to_string(list_sort(list_filter(wb, lambda x: not list_contains(wa, x))), ' ') as db from w),
xy as (select *, trim(i || ' ' || da) as x, trim(i || ' ' || db) as y from s),
r as (select rec_id, cand_id, case when i <> '' and (da = '' or db = '') then 100.0::double else greatest(200.0::double * {sql_lcs("x", "y")} / (length(x) + length(y)), case when i <> '' then 200.0::double * length(i) / (length(i) + length(x)) else 0 end, case when i <> '' then 200.0::double * length(i) / (length(i) + length(y)) else 0 end) end as score from xy)"""


@query(f"""with kinds as (select p_type, row_number() over (order by p_type) - 1 as nth from (select distinct p_type from part)),
b as (select p_partkey as cand_id, p_brand as brand, p_type, p_name || ['', 's', ' old', 'ish'][p_partkey % 4 + 1] as name from part),
q as (select c_custkey as rec_id, 'Brand#' || (c_custkey % 25 + 1) as brand, p.p_type as of_part, k.p_type, p.p_name || 'ly' as asked from customer join part p on p.p_partkey = c_custkey * 7 % (select count(*) from part) join kinds k on k.nth = c_custkey % 6),
met as (select rec_id, cand_id, asked, name from q join b using (brand, p_type)), {_RATIO},
o as (select *, lead(score) over (partition by rec_id order by score desc, cand_id) as next from r qualify row_number() over (partition by rec_id order by score desc, cand_id) = 1),
d as (select rec_id, cand_id, score, case when score < 82 then 'score' when next >= 82 and score - next < 6 then 'ambiguous' else 'matched' end as reason from o)
select rec_id, case when reason = 'matched' then cand_id end as cand_id, case when reason = 'matched' then round(score, 6) end as score, coalesce(reason, 'no candidates') as reason from q left join d using (rec_id)""")
def near_matches(t: Tables) -> DataFrame:
    """Names that are alike but not equal: scores on both sides of the threshold, and seconds within the margin."""
    kinds = t.part.agg(F.slice(F.array_sort(F.collect_set("p_type")), 1, 6).alias("kinds")).select(F.posexplode("kinds").alias("_kind", "_type"))
    place = F.concat_ws(" ", F.concat(F.lit("Brand#"), F.col("_brand") + 1), F.col("_type"))
    places = kinds.crossJoin(t.spark.range(25).toDF("_brand")).select("_brand", "_kind", F.array(text.place_keys(place)).alias("tiers"))  # 150 rows at most
    names = t.part.select(F.col("p_partkey").alias("_p"), F.col("p_name").alias("_name"))
    n = t.part.count()
    asked = t.customer.select(F.col("c_custkey").alias("rec_id")).join(names, F.col("rec_id") * 7 % n == F.col("_p"))
    met = asked.join(F.broadcast(places), (F.col("rec_id") % 25 == F.col("_brand")) & (F.col("rec_id") % 6 == F.col("_kind")))
    queries = met.select("rec_id", F.concat("_name", F.lit("ly")).alias("name"), "tiers")
    ends = F.element_at(F.array(*map(F.lit, ("", "s", " old", "ish"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    pool = t.part.select(F.col("p_partkey").alias("id"), F.concat("p_name", ends).alias("name"), F.concat_ws(" ", "p_brand", "p_type").alias("city"))
    return match.best_match(queries, match.candidate_index(pool, ["city"])).select("rec_id", "cand_id", F.round("score", 6).alias("score"), "reason")


@query("""with b as (select s_nationkey as nk, count(*) as n, count(*) filter (where s_suppkey % 3 = 0) as m, min(s_suppkey) filter (where s_suppkey % 3 = 0) as one from supplier group by 1)
select c_custkey as rec_id, case when m = 1 then one end as cand_id, case when n is null then 'no candidates' when m = 0 then 'saint' when m = 1 then 'unique' else 'score' end as reason from customer left join b on c_nationkey = nk""")
def unique_candidates(t: Tables) -> DataFrame:
    """Names too far apart to score, but of one kind and dedication: linked where a place has one such building only."""
    towns = t.nation.select("n_nationkey", F.col("n_name").alias("city"))
    name = F.when(F.col("s_suppkey") % 3 == 0, "Katedrala Presvetog Trojstva i sjedište svih starih bratovština na gornjem trgu").otherwise("Crkva sv. Marka")
    pool = t.supplier.join(towns, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), name.alias("name"), "city")
    asked = t.customer.join(towns, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("rec_id"), F.lit("Sklop katedrale Presvetoga Trojstva").alias("name"), F.array(text.place_keys(F.col("city"))).alias("tiers"))
    return match.best_match(asked, match.candidate_index(pool, ["city"])).select("rec_id", "cand_id", "reason")


@query(_MATCH + ", l as (select min(rec_id) as rec_id, cand_id from f group by cand_id) select rec_id, cand_id from q left join l using (rec_id)")
def heritage_links(t: Tables) -> DataFrame:
    """Heritage records linked in two tiers, each building once, and the queue that is left."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    records = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.concat(F.lit("Crkva sv. "), _saint(F.col("c_custkey")), F.lit(" Evanđelista")).alias("name"), F.col("n_name").alias("settlement"), F.col("r_name").alias("municipality"))
    pool = t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.concat(F.lit("Crkva sv. "), _saint(F.col("s_suppkey"))).alias("name"), F.lit(None).cast("string").alias("city"), F.col("n_name").alias("settlement"), F.col("r_name").alias("municipality"))
    links, queue = linking.link_heritage(records, pool)
    return links.select("rec_id", "cand_id").unionByName(queue.select(F.col("id").alias("rec_id"), F.lit(None).cast("bigint").alias("cand_id")))


_SPOTS = """c as (select c_custkey as id, c_nationkey as nk, c_custkey % 8 as saint, case when c_custkey % 4 > 0 then 42.5::double + c_nationkey / 10.0::double + c_custkey % 10 * 0.041::double end as lat, case when c_custkey % 4 > 0 then 14.0::double + c_nationkey / 10.0::double end as lng from customer),
s as (select s_suppkey as id, s_nationkey as nk, s_suppkey % 8 as saint, 42.5::double + s_nationkey / 10.0::double + s_suppkey % 7 * 0.053::double as lat, 14.02::double + s_nationkey / 10.0::double as lng from supplier)"""
_PLANE = "111.32::double * sqrt(pow({b}.lat - {a}.lat, 2) + pow(({b}.lng - {a}.lng) * cos(radians(({a}.lat + {b}.lat) / 2)), 2))"


def _spots(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers, a quarter of them without a place, and suppliers, some kilometres apart along their nations' meridians."""
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    known = lambda v: F.when(k % 4 > 0, v)
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(k.alias("id"), F.col("n_name").alias("city"), known(F.lit(42.5) + F.col("c_nationkey") / 10.0 + k % 10 * 0.041).alias("lat"), known(F.lit(14.0) + F.col("c_nationkey") / 10.0).alias("lng"))
    b = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(s.alias("id"), F.col("n_name").alias("city"), (F.lit(42.5) + F.col("s_nationkey") / 10.0 + s % 7 * 0.053).alias("lat"), (F.lit(14.02) + F.col("s_nationkey") / 10.0).alias("lng"))
    return c, b


@query(f"""with {_SPOTS}, p as (select c.id as rec_id, min(s.id) as cand_id from c join s using (nk, saint) group by c.id having count(*) = 1),
n as (select rec_id, cand_id, coalesce(c.lat, s.lat) as lat, coalesce(c.lng, s.lng) as lng from p join c on c.id = rec_id join s on s.id = cand_id where c.lat is null or {_PLANE.format(a="c", b="s")} <= 25)
select rec_id, cand_id, round(lat, 6) as lat, round(lng, 6) as lng from n qualify row_number() over (partition by cand_id order by rec_id) = 1""")
def parish_churches(t: Tables) -> DataFrame:
    """A church too far from the parish's seat is refused before it goes to the first of those that want it; a parish without a seat takes the church's."""
    parishes, pool = _spots(t)
    parishes = parishes.withColumn("name", F.concat(F.lit("ŽUPA SV. "), F.upper(_saint(F.col("id"))), F.lit(" EVANĐELISTA")))
    pool = pool.withColumn("name", F.concat(F.lit("Crkva sv. "), _saint(F.col("id")))).withColumn("settlement", F.lit(None).cast("string")).withColumn("municipality", F.lit(None).cast("string"))
    return linking.link_parish_churches(parishes, pool).select("rec_id", "cand_id", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))


@query(f"""with {_SPOTS}, p as (select c.id as building, min(s.id) as parish from c join s on c.nk = s.nk and c.id % 3 = s.id % 3 group by c.id having count(distinct s.id) = 1)
select building, parish from p join c on c.id = building join s on s.id = parish where c.lat is null or {_PLANE.format(a="c", b="s")} <= 25""")
def filial_links(t: Tables) -> DataFrame:
    """Buildings whose place one parish alone has, unless it is more than 25 km away."""
    buildings, parishes = _spots(t)
    places = F.array(F.concat_ws("-", "city", F.col("id") % 3))
    return linking.link_filials(buildings.withColumn("places", places), parishes.withColumn("places", places))


@query(f"""with {SUPPLIERS}, n as (select count(*) as n from supplier),
b as (select s_suppkey as id, lat, lng, case when s_suppkey % 5 > 0 then s_suppkey % 8 end as saint, case when s_suppkey % 3 = 0 then 'Q' || s_suppkey end as wikidata from s),
i as (select 'Q' || c_custkey as qid, c_custkey as k, s.lat + c_custkey % 5 * 0.0004::double as lat, s.lng, case when c_custkey % 4 > 0 then c_custkey % 8 end as saint from customer, n join s on s_suppkey = c_custkey % n),
near as (select i.qid, b.id from i join b on abs(i.lat - b.lat) < 0.01 and abs(i.lng - b.lng) < 0.01 where coalesce(i.saint = b.saint, true) and {sql_metres("i", "b")} <= 150 qualify row_number() over (partition by i.qid order by {sql_metres("i", "b")}, b.id) = 1)
select i.qid, coalesce(w.id, near.id) as building, case when w.id is not null then 'id' when near.id is not null then 'place' else 'new' end as how from i left join b w on w.wikidata = i.qid left join near on near.qid = i.qid and w.id is null""")
def enriched(t: Tables) -> DataFrame:
    """Items met by identifier, else by the nearest building within 150 m whose dedication does not differ."""
    s = suppliers(t)
    key, k = F.col("s_suppkey"), F.col("c_custkey")
    saint = lambda c, every: F.when(c % every > 0, F.concat(F.lit("Crkva sv. "), _saint(c))).otherwise("Zgrada")
    buildings = s.select(key.alias("id"), "lat", "lng", saint(key, 5).alias("name"), F.when(key % 3 == 0, F.concat(F.lit("Q"), key)).alias("wikidata"))
    items = t.customer.join(s, k % t.supplier.count() == key).select(F.concat(F.lit("Q"), k).alias("qid"), (F.col("lat") + k % 5 * 0.0004).alias("lat"), "lng", saint(k, 4).alias("name"))
    return linking.enrich(buildings, items)


_ASSIGNED = f"""with {SUPPLIERS}, w as (select n_nationkey as idx, n_regionkey as jls, 13.4::double + n_nationkey % 5 * 1.2::double as x, 42.3::double + n_nationkey // 5 * 0.8::double as y from nation),
p as (select s_suppkey as id, 'D' || s_suppkey % 4 as diocese, 42.3::double + (s_suppkey * 6151 % 2100) / 1000.0::double as lat, lng from s),
i as (select idx, jls, id, diocese from p join w on lng >= x and lng < x + 1.2 and lat >= y and lat < y + 0.8), v as (select idx, diocese, count(*) as n from i group by idx, diocese),
b as (select idx, diocese from v qualify row_number() over (partition by idx order by n desc, diocese desc) = 1),
e as (select w.idx, p.diocese, case when i.jls = w.jls then 0 when i.jls is not null then 1 else 2 end as circle, p.id, pow(p.lat - (w.y + 0.4), 2) + pow((p.lng - (w.x + 0.6)) * cos(radians((p.lat + w.y + 0.4) / 2)), 2) as d from w, p left join i using (id) where w.idx not in (select idx from b)),
a as (select idx, diocese, true as direct from b union all select idx, diocese, false from e qualify row_number() over (partition by idx order by circle, d, id) = 1)"""


def _parishes(t: Tables) -> DataFrame:
    """Seats in the southern half only, so that settlements in the north have none."""
    return suppliers(t).select(F.col("s_suppkey").alias("id"), F.concat(F.lit("D"), F.col("s_suppkey") % 4).alias("diocese"), (F.lit(42.3) + F.col("s_suppkey") * 6151 % 2100 / F.lit(1000.0)).alias("lat"), "lng")


@query(f"{_ASSIGNED} select idx::bigint as idx, diocese, direct from a")
def assigned_settlements(t: Tables) -> DataFrame:
    """Settlements by the votes of their seats, the others by the nearest seat of their municipality, else county."""
    return territory.assign(_towns(t), _parishes(t))


@query(f"""{_ASSIGNED}, c as (select 'D' || (c_custkey % (select count(*) from supplier)) % 4 as diocese, count(*) as churches from customer group by 1), n as (select diocese, count(*) as parishes from p group by 1)
select a.diocese, count(*) as settlements, sum(100 + idx)::bigint as population, round(sum(idx * 1.5::double), 3) as area_km2, coalesce(any_value(parishes), 0) as parishes, coalesce(any_value(churches), 0) as churches from a left join n using (diocese) left join c using (diocese) group by a.diocese""")
def territory_sums(t: Tables) -> DataFrame:
    """Per diocese what its settlements add up to, with its parishes and the churches linked to them."""
    parishes = _parishes(t)
    towns = _towns(t).withColumn("population", F.col("idx") + 100).withColumn("area_km2", F.col("idx") * 1.5)
    churches = t.customer.select((F.col("c_custkey") % t.supplier.count()).alias("parish_id"))
    out = territory.rollup(towns, territory.assign(towns, parishes).select("idx", "diocese"), parishes, churches)
    return out.select("diocese", "settlements", "population", F.round("area_km2", 3).alias("area_km2"), "parishes", "churches")


def _elements(t: Tables) -> DataFrame:
    """Orders as tagged map objects: some without a name of their own, some with empty ones."""
    k = F.col("o_orderkey")
    tag = lambda name, value: F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))
    pairs = F.array(
        tag("amenity", F.when(k % 2 == 0, "place_of_worship")), tag("building", F.when(k % 3 == 0, "chapel")), tag("name", F.when(k % 4 == 1, F.concat(F.lit("N"), k)).when(k % 4 == 2, "")), tag("official_name", F.when(k % 5 < 3, F.concat(F.lit("O"), k % 10))), tag("alt_name", F.when(k % 7 == 0, F.concat(F.lit("A"), k % 10))),
        tag("addr:city", F.when(k % 6 == 0, "")), tag("addr:place", F.when(k % 2 == 0, F.concat(F.lit("P"), k % 9))), tag("addr:street", F.when(k % 4 < 2, "S")), tag("addr:housenumber", F.when(k % 8 == 0, k % 100)), tag("phone", F.when(k % 9 == 0, "1")), tag("contact:phone", F.when(k % 2 == 0, "2")), tag("old_name", F.when(k % 5 == 4, F.concat(F.lit("N"), k))),
    )
    tags = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return t.orders.select(F.lit("node").alias("type"), k.alias("id"), F.lit(45.0).alias("lat"), F.lit(16.0).alias("lng"), tags.alias("tags"))


_TAGS = """with o as (select o_orderkey as k from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0),
g as (select k, case when k % 4 = 1 then 'N' || k end as name, case when k % 5 < 3 then 'O' || k % 10 end as official, case when k % 7 = 0 then 'A' || k % 10 end as alt, case when k % 5 = 4 then 'N' || k end as old, case when k % 2 = 0 then 'P' || k % 9 end as city, case when k % 4 < 2 then 'S' end as street, case when k % 8 = 0 then (k % 100)::varchar end as number from o),
m as (select *, coalesce(name, official, alt) as picked from g)"""


@query(f"""{_TAGS} select 'n' || k as osm_id, picked as name, city, nullif(array_to_string(list_filter([nullif(trim(coalesce(street, '') || ' ' || coalesce(number, '')), ''), city], lambda x: x is not null), ', '), '') as address,
case when k % 9 = 0 then '1' when k % 2 = 0 then '2' end as phone from m where picked is not null""")
def picked_tags(t: Tables) -> DataFrame:
    """The reader's picks by precedence, over the objects that its filter keeps; those without any name get one by kind and are left to the labels' queries."""
    out = readers.buildings(readers.sacral_elements(_elements(t)))
    named = F.exists(F.array("name", "official_name", "alt_name"), lambda v: F.coalesce(v, F.lit("")) != "")
    tag = lambda k: F.try_element_at("tags", F.lit(k)).alias(k)
    return out.select("osm_id", F.col("name").alias("_picked"), "city", "address", "phone", tag("name"), tag("official_name"), tag("alt_name")).where(named).select("osm_id", F.col("_picked").alias("name"), "city", "address", "phone")


@query(f"""{_TAGS}, f as (select k, name, official, alt, old, picked from m where picked is not null), u as (select k, picked, unnest([alt, old, official]) as alias, unnest(['alt_name', 'old_name', 'official_name']) as source from f)
select 'n' || k as osm_id, alias, source from u where alias is not null and alias <> picked""")
def picked_aliases(t: Tables) -> DataFrame:
    """The reader's other names of the same objects."""
    rows = readers.buildings(readers.sacral_elements(_elements(t)))
    named = F.exists(F.array(*(F.try_element_at("tags", F.lit(k)) for k in ("name", "official_name", "alt_name"))), lambda v: F.coalesce(v, F.lit("")) != "")
    return readers.aliases(rows.where(named))


_SEATS = """with w as (select n_nationkey as idx, case when n_nationkey = 24 then 'town 7' else 'town ' || n_nationkey % 7 || case when n_nationkey >= 14 then ' gornji' else '' end end as key, (n_nationkey % 5)::varchar as jls, 'c' || n_nationkey % 3 as county, 13.4::double + n_nationkey % 5 * 1.2::double as x, 42.3::double + n_nationkey // 5 * 0.8::double as y from nation),
p as (select c_custkey as id, 'town ' || c_custkey % 8 as city, c_custkey % 8 as saint, case when c_custkey % 11 > 0 then 'D' || c_custkey % 3 end as diocese, case when c_custkey % 13 > 0 then 42.3::double + ((c_custkey * 7919) % 4300) / 1000.0::double end as lat, case when c_custkey % 13 > 0 then 13.4::double + ((c_custkey * 104729) % 6100) / 1000.0::double end as lng from customer),
g as (select p.id, o.idx as o_idx, o.county as o_county, lng >= x and lng < x + 1.2 and lat >= y and lat < y + 0.8 as at_goal from p left join w o on o.key = 'town ' || p.id % 7 and o.jls = (p.id % 5)::varchar where p.id % 17 = 0),
nm as (select p.id, diocese, w.idx, county, key = city as exact, coalesce(lng >= x and lng < x + 1.2 and lat >= y and lat < y + 0.8, false) as inside, 111.32::double * sqrt(pow(y + 0.4 - lat, 2) + pow((x + 0.6 - lng) * cos(radians((lat + y + 0.4) / 2)), 2)) as km from p join w on key = city or starts_with(key, city || ' ')),
nc as (select id, arg_min(county, case when exact then idx else 100 + idx end) as n_county from nm where inside group by id),
al as (select diocese, coalesce(o_county, n_county) as county from p left join g using (id) left join nc using (id) where diocese is not null and coalesce(o_county, n_county) is not null group by all having count(*) >= (select count(*) // 83 from customer)),
t as (select id, bool_or(inside) as inside, min(km) as km, count(*) filter (exact) as n_exact, count(*) as n_all, max(idx) filter (exact) as one_exact, max(idx) as one_any, count(*) filter (exact and a.county is not null) as ok_exact, count(*) filter (a.county is not null) as ok_all,
  max(idx) filter (exact and a.county is not null) as ok_exact_idx, max(idx) filter (a.county is not null) as ok_idx from nm left join al a on a.diocese = nm.diocese and a.county = nm.county group by id),
h as (select id, min(county) as here from p join w on lng >= x and lng < x + 1.2 and lat >= y and lat < y + 0.8 group by id),
v as (select p.*, g.id is not null as has, o_idx, coalesce(at_goal, false) as at_goal, coalesce(not t.inside and t.km > 30, false) as far, case when n_exact > 0 then n_exact else n_all end as few, case when n_exact > 0 then one_exact else one_any end as one, ok_exact, ok_all, ok_exact_idx, ok_idx,
  p.diocese not in (select diocese from al) or p.diocese is null or here is null or exists (select 1 from al where al.diocese = p.diocese and al.county = here) as fine from p left join g using (id) left join t using (id) left join h using (id)),
d as (select id, lat, lng, saint, case when has and o_idx is not null and not at_goal then ['fix', o_idx::varchar, 'override'] when has or lat is null then ['keep', null, 'settled'] when far and few = 1 then ['fix', one::varchar, 'far'] when far then ['drop', null, 'far'] when fine then ['keep', null, 'settled']
  when ok_exact = 1 then ['fix', ok_exact_idx::varchar, 'county'] when ok_all = 1 then ['fix', ok_idx::varchar, 'county'] else ['keep', null, 'unclear'] end as verdict from v)"""


def _register(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Settlements whose names recur, parishes registered in them with points that are often elsewhere, and overrides of some."""
    n, k = F.col("idx"), F.col("c_custkey")
    towns = _towns(t).select("idx", F.when(n == 24, "Town 7").otherwise(F.concat(F.lit("Town "), n % 7, F.when(n >= 14, " Gornji").otherwise(""))).alias("name"), (n % 5).cast("string").alias("jls"), F.concat(F.lit("c"), n % 3).alias("county"), "lat", "lng", "polygons")
    known = lambda c: F.when(k % 13 > 0, c)
    parishes = t.customer.select(k.alias("registry_id"), F.concat(F.lit("Crkva sv. "), _saint(k)).alias("name"), F.concat(F.lit("Town "), k % 8).alias("city"), F.when(k % 11 > 0, F.concat(F.lit("D"), k % 3)).alias("diocese"), known(F.lit(42.3) + k * 7919 % 4300 / F.lit(1000.0)).alias("lat"), known(F.lit(13.4) + k * 104729 % 6100 / F.lit(1000.0)).alias("lng"))
    overrides = t.customer.where(k % 17 == 0).select(k.alias("registry_id"), F.concat(F.lit("Town "), k % 7).alias("settlement"), (k % 5).cast("string").alias("municipality"))
    return towns, parishes, overrides


def _resolved(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    towns, parishes, overrides = _register(t)
    allowed = linking.settled_counties(parishes, towns, overrides, t.customer.count() // 83)
    return towns, parishes, linking.resolve_seats(parishes, towns, towns.limit(0), overrides, allowed)


@query(f"{_SEATS} select diocese, county from al")
def settled_counties(t: Tables) -> DataFrame:
    towns, parishes, overrides = _register(t)
    return linking.settled_counties(parishes, towns, overrides, t.customer.count() // 83)


@query(f"{_SEATS} select id as registry_id, verdict[1] as action, verdict[2]::bigint as target, verdict[3] as reason from d")
def resolved_seats(t: Tables) -> DataFrame:
    """Seats kept, moved or dropped, by overrides, distance and the dioceses' settled counties."""
    return _resolved(t)[2].select("registry_id", "action", "target", "reason")


@query(f"""{_SEATS}, {SUPPLIERS[SUPPLIERS.index("s as"):]}, f as (select id, saint, verdict[2]::int as target from d where verdict[1] = 'fix'),
c as (select f.id, arg_min(s.lat, s_suppkey) as lat, arg_min(s.lng, s_suppkey) as lng from f join w on idx = target join s on s_suppkey % 8 = saint and w.key = 'town ' || s_suppkey % 7 and s.lng >= x and s.lng < x + 1.2 and s.lat >= y and s.lat < y + 0.8 group by f.id)
select d.id as registry_id, round(case verdict[1] when 'drop' then null when 'fix' then coalesce(c.lat, w.y + 0.4) else d.lat end, 6) as lat, round(case verdict[1] when 'drop' then null when 'fix' then coalesce(c.lng, w.x + 0.6) else d.lng end, 6) as lng
from d left join c using (id) left join f using (id) left join w on w.idx = f.target""")
def moved_seats(t: Tables) -> DataFrame:
    """The corrected points: the church of the same dedication in the settlement moved to, else a point inside it."""
    towns, parishes, resolved = _resolved(t)
    s = F.col("s_suppkey")
    churches = suppliers(t).select(s.alias("id"), F.concat(F.lit("Crkva sv. "), _saint(s)).alias("name"), F.concat(F.lit("Town "), s % 7).alias("settlement"), "lat", "lng")
    return linking.apply_fixes(parishes, resolved, towns, churches).select("registry_id", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))
