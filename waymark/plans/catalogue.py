"""The catalogue's operators over the driver's tables, each with SQL that gives the same rows.

Customers and suppliers stand for buildings and legal persons, nations for settlements, regions for
municipalities; points are made from keys by integer arithmetic, the same in both engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, rules, text
from ..operators import linking, match, merge, search, spatial, stats, territory
from ..sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def sql_point(key: str, a: int = 7919, b: int = 104729) -> str:
    return f"42.3::double + (({key} * {a}) % 4300) / 1000.0::double as lat, 13.4::double + (({key} * {b}) % 6100) / 1000.0::double as lng"


def with_point(df: DataFrame, key: str, a: int = 7919, b: int = 104729) -> DataFrame:
    return df.withColumn("lat", F.lit(42.3) + F.col(key) * a % 4300 / F.lit(1000.0)).withColumn("lng", F.lit(13.4) + F.col(key) * b % 6100 / F.lit(1000.0))


CUSTOMERS = f"c as (select c_custkey, c_nationkey, c_name, {sql_point('c_custkey')} from customer)"
SUPPLIERS = f"s as (select s_suppkey, s_nationkey, s_name, {sql_point('s_suppkey', 6151, 3571)} from supplier)"


def customers(t: Tables) -> DataFrame:
    return with_point(t.customer.select("c_custkey", "c_nationkey", "c_name"), "c_custkey")


def suppliers(t: Tables) -> DataFrame:
    return with_point(t.supplier.select("s_suppkey", "s_nationkey", "s_name"), "s_suppkey", 6151, 3571)


def sql_metres(a: str, b: str) -> str:
    return f"2 * 6371000.0::double * asin(sqrt(least(1.0::double, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lng - {a}.lng) / 2), 2))))"


_FOLD = f"translate({{}}, '{text.ACCENTED}', '{text.PLAIN}')"


def sql_fold(c: str) -> str:
    return f"lower({_FOLD.format(c)})"


def sql_key(c: str) -> str:
    return f"trim(regexp_replace({sql_fold(c)}, '[^a-z0-9]+', ' ', 'g'))"


# --- text functions ---


@query(f"select doc_id, {sql_key('text')} as folded from documents")
def fold_key(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.fold_key(F.col("text")).alias("folded"))


@query(f"""select c_custkey, trim(regexp_replace(case when strpos({sql_fold('c_name')}, {sql_fold('n_name')}) > 0 then {sql_fold('c_name')} else {sql_fold('c_name')} || '-' || {sql_fold('n_name')} end || '-w' || c_custkey, '[^a-z0-9]+', '-', 'g'), '-') as slug
from customer join nation on c_nationkey = n_nationkey""")
def slugs(t: Tables) -> DataFrame:
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", text.slug(F.col("c_name"), F.col("n_name"), F.concat(F.lit("w"), F.col("c_custkey"))).alias("slug"))


@query(f"""select p_partkey, trim(regexp_replace(regexp_replace({sql_key("'Crkva sv. ' || p_name")}, '^crkva ', ''), ' +', ' ', 'g')) as name_key from part""")
def name_keys(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.norm_key(F.concat(F.lit("Crkva sv. "), F.col("p_name"))).alias("name_key"))


@query("""select p_partkey, array_to_string(list_transform(string_split(upper(p_name) || ' I XXIV BDM', ' '), lambda w, i: case when i > 1 and lower(w) in ('i', 'u', 'na', 'od', 'za', 'sa', 's', 'iz', 'te', 'ili') then lower(w)
 when w in ('BDM', 'HR') or regexp_matches(w, '^[IVXLCDM]{2,}$') then w else upper(left(w, 1)) || lower(substr(w, 2)) end), ' ') as titled from part""")
def title_case(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.title_case(F.concat(F.upper("p_name"), F.lit(" I XXIV BDM"))).alias("titled"))


@query(f"""with k as (select n_nationkey, {sql_key("'Grad ' || n_name")} as a, {sql_key('r_name')} as b from nation join region on n_regionkey = r_regionkey)
select distinct n_nationkey, unnest([a, regexp_replace(a, '^grad ', ''), b]) as place from k""")
def place_keys(t: Tables) -> DataFrame:
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_nationkey", F.explode(text.place_keys(F.concat(F.lit("Grad "), F.col("n_name")), F.col("r_name"))).alias("place"))


@query("""select s_suppkey, nullif(trim(array_to_string(list_transform(string_split(seat, ','), lambda x: trim(x))[2:], ', ')), '') as street, nullif(trim(string_split(seat, ',')[1]), '') as city
from (select s_suppkey, case s_suppkey % 3 when 0 then n_name when 1 then n_name || ', Street ' || s_suppkey else n_name || ' , Old Road, ' || s_suppkey end as seat from supplier join nation on s_nationkey = n_nationkey)""")
def seats(t: Tables) -> DataFrame:
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey")
    seat = F.when(key % 3 == 0, F.col("n_name")).when(key % 3 == 1, F.concat("n_name", F.lit(", Street "), key)).otherwise(F.concat("n_name", F.lit(" , Old Road, "), key))
    split = text.split_seat(seat)
    return joined.select("s_suppkey", split["street"].alias("street"), split["city"].alias("city"))


@query(r"select doc_id, nullif(trim(regexp_replace(text, '[ \t\n\v\f\r]+', ' ', 'g')), '') as cleaned from documents")
def clean_space(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.clean(F.col("text")).alias("cleaned"))


@query("""select page_id, string_split(url, '/')[-1] as last_part, regexp_replace(url, '^http://', 'https://') as url_https, left(md5(url), 8) as tag from pages""")
def addresses(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.last_segment(F.col("url")).alias("last_part"), text.https(F.col("url")).alias("url_https"), F.left(F.md5("url"), F.lit(8)).alias("tag"))


@query("""select o_orderkey, nullif(regexp_extract(strftime(o_orderdate, '%Y-%m-%d'), '^(-?[0-9]{1,4})-', 1), '') as order_year, strftime(o_orderdate, '%Y-%m-%d') as order_day from orders""")
def years(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select("o_orderkey", text.year_of(day).alias("order_year"), day.alias("order_day"))


@query("""select n, case when n % 100 between 11 and 14 then 'kupaca' when n % 10 = 1 then 'kupac' when n % 10 between 2 and 4 then 'kupca' else 'kupaca' end as word, c_nationkey
from (select c_nationkey, count(*) as n from customer group by c_nationkey)""")
def plurals(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n")).withColumn("word", text.plural(F.col("n"), "kupac", "kupca", "kupaca"))


# --- rules ---


@query("""select p_partkey, case when regexp_matches(name, '(^|[^a-z])(katedral|stolna crkva)') then 'katedrala' when regexp_matches(name, 'bazilik') then 'bazilika' when regexp_matches(name, 'samostan') then 'samostan' when regexp_matches(name, 'kapel') then 'kapela'
 when regexp_matches(name, 'crkv') then 'crkva' else 'ostalo' end as kind
from (select p_partkey, case p_partkey % 6 when 0 then 'katedrala ' when 1 then 'bazilika ' when 2 then 'samostan ' when 3 then 'kapela ' when 4 then 'crkva ' else '' end || p_name as name from part)""")
def kinds(t: Tables) -> DataFrame:
    head = reduce(lambda c, k: c.when(F.col("p_partkey") % 6 == k[0], k[1]), enumerate(("katedrala ", "bazilika ", "samostan ", "kapela ", "crkva ")), F.when(F.lit(False), "")).otherwise("")
    return t.part.select("p_partkey", rules.kind_of_name(F.concat(head, "p_name")).alias("kind"))


@query("""select o_orderkey, case when regexp_matches(o_orderpriority, '(?i)urgent') then 'now' when regexp_matches(o_orderpriority, '(?i)high|medium') then 'soon' else 'later' end as pace,
 case when regexp_matches(o_orderpriority, '(?i)urgent') then 1 when regexp_matches(o_orderpriority, '(?i)high|medium') then 2 else 3 end as pace_rank from orders""")
def pair_labels(t: Tables) -> DataFrame:
    found = rules.first_match(F.col("o_orderpriority"), (("urgent", ("now", 1)), ("high|medium", ("soon", 2))), ("later", 3))
    return t.orders.select("o_orderkey", found["c0"].alias("pace"), found["c1"].alias("pace_rank"))


@query("""select event_id, coalesce(nullif(json_extract_string(props, '$.name'), ''), nullif(json_extract_string(props, '$.k'), ''), event_type) as label, (select count(*) from unnest(json_keys(props)))::bigint as n_tags from events""")
def tag_picks(t: Tables) -> DataFrame:
    tags = F.from_json("props", "map<string,string>")
    pick = lambda k: text.empty_to_null(F.try_element_at(tags, F.lit(k)))
    return t.events.select("event_id", F.coalesce(pick("name"), pick("k"), "event_type").alias("label"), F.size(tags).cast("bigint").alias("n_tags"))


@query("""select event_id, k as alias_key, json_extract_string(props, '$."' || k || '"') as alias from (select event_id, props, event_type, unnest(json_keys(props)) as k from events)
where coalesce(json_extract_string(props, '$."' || k || '"'), '') <> '' and json_extract_string(props, '$."' || k || '"') <> event_type""")
def aliases(t: Tables) -> DataFrame:
    tags = F.map_filter(F.from_json("props", "map<string,string>"), lambda k, v: (F.coalesce(v, F.lit("")) != "") & (v != F.col("event_type")))
    return t.events.select("event_id", F.explode(tags).alias("alias_key", "alias"))


_STATUS = "case when o_orderkey % 7 = 0 then null when o_orderkey % 7 < 4 then 'Aktivan' else 'Brisan' end"


@query(f"select o_orderkey from orders where (({_STATUS}) is null or ({_STATUS}) ilike 'AKTIV%') and nullif(o_orderkey % 5, 0) is null")
def active_distinct(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.when(key % 7 == 0, None).when(key % 7 < 4, "Aktivan").otherwise("Brisan")
    return t.orders.where(merge.active_distinct(status, F.nullif(key % 5, F.lit(0)))).select("o_orderkey")


# --- joins ---


@query("select d.doc_id, lang, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id")
def left_labels(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


@query("""select c_custkey, o_orderkey as first_order from customer left join (select * from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as n from orders) where n = 1) on c_custkey = o_custkey""")
def first_child(t: Tables) -> DataFrame:
    first = stats.first_child(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("first_order"))
    return t.customer.join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "first_order")


@query("select c_custkey, count(o_orderkey) as n_filled from customer left join orders on c_custkey = o_custkey and o_orderstatus = 'F' group by c_custkey")
def left_with_condition(t: Tables) -> DataFrame:
    on = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("o_orderstatus") == "F")
    return t.customer.join(t.orders, on, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_filled"))


@query("select c_custkey, 'any' as gap from customer where not exists (select 1 from orders where o_custkey = c_custkey) union all select c_custkey, 'filled' from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')")
def gaps(t: Tables) -> DataFrame:
    none = stats.without_children(t.customer, t.orders, "c_custkey", "o_custkey")
    unfilled = stats.without_children(t.customer, t.orders, "c_custkey", "o_custkey", F.col("o_orderstatus") == "F")
    return none.select("c_custkey", F.lit("any").alias("gap")).unionByName(unfilled.select("c_custkey", F.lit("filled").alias("gap")))


@query("select c_custkey, e.event_id from customer join (select user_id, max(event_id) as event_id from events group by user_id) e on c_custkey = e.user_id")
def last_wins(t: Tables) -> DataFrame:
    last = t.events.groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    return t.customer.join(last, F.col("c_custkey") == F.col("user_id")).select("c_custkey", "event_id")


@query("select o_custkey, n_orders, coalesce(n_events, 0) as n_events from (select o_custkey, count(*) as n_orders from orders group by o_custkey) left join (select user_id, count(*) as n_events from events group by user_id) on o_custkey = user_id")
def counts_kept_at_zero(t: Tables) -> DataFrame:
    heads = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    return stats.child_counts(heads, t.events, "o_custkey", "user_id", "n_events")


@query("""with k as (select s_suppkey, r_name, n_name from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select r_name, count(*) as n_suppliers, string_agg(lpad(s_suppkey::varchar, 9, '0'), ',' order by s_suppkey) as suppliers from k group by r_name""")
def children_by_name(t: Tables) -> DataFrame:
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.count("*").alias("n_suppliers"), F.array_join(F.array_sort(F.collect_list(F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))), ",").alias("suppliers"))


# --- spatial ---

RADIUS_KM = 25.0


@query(f"with {CUSTOMERS}, {SUPPLIERS}, m as (select c_custkey, s_suppkey, {sql_metres('c', 's')} as metres from c, s) select c_custkey, s_suppkey as supplier, round(metres, 1) as metres from m where metres <= 25000 qualify row_number() over (partition by c_custkey order by metres, s_suppkey) = 1")
def nearest_in_radius(t: Tables) -> DataFrame:
    near = spatial.nearest_within(customers(t), suppliers(t), "c_custkey", "s_suppkey", RADIUS_KM)
    return near.select("c_custkey", F.col("r_s_suppkey").alias("supplier"), F.round("metres", 1).alias("metres"))


@query(f"select c_custkey, lat between 43.5 and 45.5 and lng between 14 and 17 as inside from (select c_custkey, {sql_point('c_custkey')} from customer) where lat between 42.3 and 46.6 and lng between 13.4 and 19.5")
def country_box(t: Tables) -> DataFrame:
    c = customers(t).where(geo.in_country(F.col("lat"), F.col("lng")))
    return c.select("c_custkey", (F.col("lat").between(43.5, 45.5) & F.col("lng").between(14, 17)).alias("inside"))


# constant polygons: outer ring first, then holes; the second overlaps the first and has a hole
POLYGONS = [
    (1, "A", [[[14.0, 43.0], [16.0, 43.0], [16.5, 45.0], [15.0, 44.2], [14.0, 45.0]]]),
    (2, "B", [[[15.5, 43.5], [18.0, 43.5], [18.0, 46.0], [15.5, 46.0]], [[16.5, 44.0], [17.0, 44.0], [17.0, 45.0], [16.5, 45.0]]]),
]
WIDE = [(1, "W1", [[[13.4, 42.3], [16.4, 42.3], [16.4, 46.6], [13.4, 46.6]]]), (2, "W2", [[[16.4, 42.3], [19.6, 42.3], [19.6, 46.6], [16.4, 46.6]]])]


def layer(spark: SparkSession, polygons: list) -> DataFrame:
    return spark.createDataFrame([(i, n, "m" + n, "c" + n, [p]) for i, n, p in polygons], f"idx bigint, name string, jls string, county string, polygons {geo.POLYGONS}")


def sql_edges(polygons: list) -> str:
    sides = [(i, *ring[k], *ring[(k + 1) % len(ring)]) for i, _, rings in polygons for ring in rings for k in range(len(ring))]
    return "(values " + ", ".join("(" + ", ".join([str(s[0]), *(f"{v!r}::double" for v in s[1:])]) + ")" for s in sides) + ") e(idx, x1, y1, x2, y2)"


def sql_inside(points: str, key: str, polygons: list) -> str:
    return f"(select {key}, min(idx) as idx from (select {key}, idx from {points}, {sql_edges(polygons)} where (y1 > lat) <> (y2 > lat) and lng < (x2 - x1) * (lat - y1) / nullif(y2 - y1, 0) + x1 group by {key}, idx having count(*) % 2 = 1) group by {key})"


@query(f"with {CUSTOMERS} select c_custkey, idx::bigint as idx from {sql_inside('c', 'c_custkey', POLYGONS)}")
def containment(t: Tables) -> DataFrame:
    return spatial.contained(customers(t), layer(t.spark, POLYGONS), "c_custkey")


@query(f"""with {CUSTOMERS}, a as {sql_inside('c', 'c_custkey', POLYGONS)}, b as {sql_inside('c', 'c_custkey', WIDE)}
select c_custkey, ['A', 'B'][a.idx] as settlement, coalesce(['mA', 'mB'][a.idx], ['W1', 'W2'][b.idx]) as municipality, coalesce(['cA', 'cB'][a.idx], ['cW1', 'cW2'][b.idx]) as county from c left join a using (c_custkey) left join b using (c_custkey)""")
def layered_location(t: Tables) -> DataFrame:
    return spatial.locate(customers(t), layer(t.spark, POLYGONS), layer(t.spark, WIDE), "c_custkey")


@query(f"""with {CUSTOMERS}, a as {sql_inside('c', 'c_custkey', POLYGONS)}
select ['A', 'B'][idx] as name, count(*) filter (where c_nationkey % 2 + 1 = idx) as hit, count(*) as total, round(count(*) filter (where c_nationkey % 2 + 1 = idx) / count(*), 4) as share from a join c using (c_custkey) group by idx""")
def agreement(t: Tables) -> DataFrame:
    c = customers(t)
    places = c.select(F.col("c_custkey").alias("idx"), "lat", "lng")
    assigned = c.select(F.col("c_custkey").alias("idx"), F.when(F.col("c_nationkey") % 2 == 0, "A").otherwise("B").alias("diocese"))
    limits = layer(t.spark, POLYGONS).select("idx", "name", "polygons")
    out = territory.agreement(places, assigned, limits)
    return out.select("name", "hit", "total", F.round(F.col("hit") / F.col("total"), 4).alias("share"))


def _shapes(t: Tables) -> DataFrame:
    """Suppliers' territories: a small triangle first and then a unit square, or a U of 3 by 3 whose centre lies in its notch."""
    p = lambda x, y: F.array((F.col("lng") + x).alias("x"), (F.col("lat") + y).alias("y"))
    ring = lambda *points: F.array(*(p(x, y) for x, y in points))
    square, u = ring((0, 0), (1, 0), (1, 1), (0, 1)), ring((0, 0), (3, 0), (3, 3), (2.2, 3), (2.2, 1), (1, 1), (1, 3), (0, 3))
    small = F.array(ring((0, 0), (-0.5, 0), (0, -0.5)))
    return suppliers(t).select("s_suppkey", "lat", "lng", F.array(small, F.array(F.when(F.col("s_suppkey") % 2 == 0, square).otherwise(u))).alias("polygons"))


@query(f"with {SUPPLIERS} select s_suppkey, case when s_suppkey % 2 = 0 then 1.0::double else 6.6::double end as square_degrees, round(case when s_suppkey % 2 = 0 then 1.0 else 6.6 end * 111.32::double * 111.32::double * cos(radians(lat)), 3) as km2 from s")
def polygon_area(t: Tables) -> DataFrame:
    area = geo.ring_area(F.get(geo.biggest(F.col("polygons")), F.lit(0)))
    return _shapes(t).select("s_suppkey", "lat", area.alias("a")).select("s_suppkey", F.round("a", 6).alias("square_degrees"), F.round(geo.area_km2(F.col("a"), F.col("lat")), 3).alias("km2"))


@query(f"with {SUPPLIERS} select s_suppkey, round(lng + case when s_suppkey % 2 = 0 then 0.5::double else 9.66::double / 6.6 end, 6) as lng, round(lat + case when s_suppkey % 2 = 0 then 0.5::double else 8.7::double / 6.6 end, 6) as lat from s")
def polygon_centre(t: Tables) -> DataFrame:
    c = geo.ring_centroid(F.get(geo.biggest(F.col("polygons")), F.lit(0)))
    return _shapes(t).select("s_suppkey", c.alias("c")).select("s_suppkey", F.round("c.lng", 6).alias("lng"), F.round("c.lat", 6).alias("lat"))


@query(f"with {SUPPLIERS} select s_suppkey, round(lng + 0.5, 6) as lng, round(lat + case when s_suppkey % 2 = 0 then 0.5 else 1.5 end, 6) as lat, true as inside from s")
def inner_point(t: Tables) -> DataFrame:
    """The centre of a square; in a U, whose centre lies outside, the middle of the wider of two spans."""
    r = _shapes(t).select("s_suppkey", "polygons", geo.representative_point(F.col("polygons")).alias("r"))
    return r.select("s_suppkey", F.round("r.lng", 6).alias("lng"), F.round("r.lat", 6).alias("lat"), geo.in_polygons(F.col("r.lng"), F.col("r.lat"), F.col("polygons")).alias("inside"))


@query("select s_suppkey, round((2 - s_suppkey % 10 / 10.0) / (2 + s_suppkey % 10 / 10.0), 6)::double as iou from supplier")
def overlap_ratio(t: Tables) -> DataFrame:
    """Two squares of side 2, one moved to the right."""
    rect = lambda x: F.array(F.array(*(F.array(F.lit(float(a)) + x, F.lit(float(b))) for a, b in ((0, 0), (2, 0), (2, 2), (0, 2)))))
    return t.supplier.select("s_suppkey", F.round(territory.iou(rect(F.lit(0.0)), rect(F.col("s_suppkey") % 10 / F.lit(10.0))), 6).alias("iou"))


def _grid(t: Tables, side: str) -> DataFrame:
    """Nations as unit squares, five in a row."""
    x, y = (F.col("n_nationkey") % 5).cast("double"), F.floor(F.col("n_nationkey") / 5).cast("double")
    square = F.array(*(F.array(x + a, y + b) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))))
    return t.nation.select(F.col("n_nationkey").cast("bigint").alias("idx"), F.expr(side).cast("string").alias("side"), F.array(F.array(square)).alias("polygons"))


@query("""with c as (select n_nationkey % 5 as x, n_nationkey // 5 as y, n_nationkey * 7 % 3 as side from nation),
e as (select side, x as ax, y as ay, 0 as up from c union all select side, x, y + 1, 0 from c union all select side, x, y, 1 from c union all select side, x + 1, y, 1 from c),
o as (select side, ax, ay, up from e group by all having count(*) = 1) select side::varchar as side, count(*)::double as border_length, count(*) as n_sides from o group by side""")
def dissolved_border(t: Tables) -> DataFrame:
    sides = territory.border(_grid(t, "n_nationkey * 7 % 3"), "idx", "side")
    return sides.groupBy("side").agg(F.round(F.sum(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1"))), 6).alias("border_length"), F.count("*").alias("n_sides"))


@query("select (n_nationkey % 5)::varchar as side, 1::int as n_rings, 4::int as n_points, count(*)::double as square_degrees from nation group by 1")
def dissolved_outline(t: Tables) -> DataFrame:
    out = territory.dissolve(_grid(t, "n_nationkey % 5"), "idx", "side")
    return out.select("side", F.size("rings").alias("n_rings"), F.size(F.col("rings")[0]).alias("n_points"), F.round("square_degrees", 6).alias("square_degrees"))


_POOL_SQL = f"""with {CUSTOMERS}, {SUPPLIERS}, p as (select s.*, n_regionkey as rk from s join nation on s_nationkey = n_nationkey ), a as (select c.*, n_regionkey as rk from c join nation on c_nationkey = n_nationkey),
d as (select c_custkey, s_suppkey, s_nationkey = c_nationkey as same, p.rk = a.rk as wide, pow(p.lat - a.lat, 2) + pow((p.lng - a.lng) * cos(radians((a.lat + p.lat) / 2)), 2) as d from a, p)
select c_custkey, s_suppkey as supplier, case when same then 0 else 1 end as circle from d where same or wide qualify row_number() over (partition by c_custkey order by case when same then 0 else 1 end, d, s_suppkey) = 1"""


@query(_POOL_SQL)
def concentric_nearest(t: Tables) -> DataFrame:
    nation = t.nation.select("n_nationkey", F.col("n_regionkey").alias("rk"))
    asked = customers(t).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("nk", F.col("c_nationkey"))
    pool = suppliers(t).join(nation, F.col("s_nationkey") == F.col("n_nationkey")).withColumn("nk", F.col("s_nationkey"))
    return spatial.concentric(asked.select("c_custkey", "lat", "lng", "nk", "rk"), pool.select("s_suppkey", "lat", "lng", "nk", "rk"), "c_custkey", "s_suppkey", ["nk", "rk"]).where("circle < 2").select("c_custkey", F.col("p_s_suppkey").alias("supplier"), "circle")


@query(f"with {CUSTOMERS}, {SUPPLIERS} select c_custkey, case when metres <= 10000 then 'verified' when metres > 20000 then 'conflict' else 'undecided' end as verdict from (select c_custkey, {sql_metres('c', 's')} as metres from c join s on c_custkey % (select count(*) from supplier) = s_suppkey)")
def verification(t: Tables) -> DataFrame:
    s = suppliers(t).select("s_suppkey", F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng"))
    joined = customers(t).join(s, F.col("c_custkey") % t.supplier.count() == F.col("s_suppkey"))
    return joined.select("c_custkey", spatial.verification(geo.haversine_m(F.col("lat"), F.col("lng"), F.col("s_lat"), F.col("s_lng")), 10_000, 20_000).alias("verdict"))


@query(f"""with {SUPPLIERS}, m as (select a.s_suppkey as id, b.s_suppkey as other, b.s_nationkey % 4 as vote, {sql_metres('a', 'b')} as metres from s a, s b where a.s_suppkey <> b.s_suppkey),
k as (select * from m where metres <= 150000 qualify row_number() over (partition by id order by metres, other) <= 5), v as (select id, vote, count(*) as n from k group by id, vote)
select id as s_suppkey, vote, n as votes from v qualify row_number() over (partition by id order by n desc, vote desc) = 1""")
def neighbours_vote(t: Tables) -> DataFrame:
    s = suppliers(t)
    near = spatial.k_nearest(s, "s_suppkey", 5, 150.0).groupBy("s_suppkey", (F.col("r_s_nationkey") % 4).alias("vote")).agg(F.count("*").alias("votes"))
    return near.groupBy("s_suppkey").agg(F.max_by("vote", F.struct("votes", "vote")).alias("vote"), F.max("votes").alias("votes"))


_OWN = f"with {CUSTOMERS}, {SUPPLIERS}, m as (select s_suppkey, {sql_metres('c', 's')} / 1000 as km from s join c on c_custkey % (select count(*) from supplier) = s_suppkey)"


def _own_km(t: Tables) -> DataFrame:
    c = customers(t).select("c_custkey", F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"))
    joined = suppliers(t).join(c, F.col("c_custkey") % t.supplier.count() == F.col("s_suppkey"))
    return joined.select("s_suppkey", (geo.haversine_m(F.col("c_lat"), F.col("c_lng"), F.col("lat"), F.col("lng")) / 1000).alias("km"))


@query(_OWN + " select s_suppkey, round(median(km), 4) as median_km from m group by s_suppkey")
def median_distance(t: Tables) -> DataFrame:
    return _own_km(t).groupBy("s_suppkey").agg(F.round(F.median("km"), 4).alias("median_km"))


@query(_OWN + " select v as limit_km, count(*) filter (where km > v) as n from m, (values (50::double), (100::double), (200::double), (300::double)) l(v) group by v")
def distance_histogram(t: Tables) -> DataFrame:
    return stats.distance_histogram(_own_km(t), "km", [50, 100, 200, 300])


# --- names and claims ---


@query("""with l as (select n_nationkey, n_regionkey, 'N' || n_nationkey % 18 as name from nation), a as (select s_suppkey, 'N' || s_suppkey % 20 as name, case when s_suppkey % 4 = 0 then null else s_nationkey % 5 end as county from supplier),
m as (select s_suppkey, count(*) as n, count(*) filter (where n_regionkey = county) as k, max(n_nationkey) as one, max(n_nationkey) filter (where n_regionkey = county) as own from a join l using (name) group by s_suppkey)
select s_suppkey, (case when k = 1 then own when k = 0 and n = 1 then one end)::double as found from m where k = 1 or (k = 0 and n = 1)""")
def unique_lookup(t: Tables) -> DataFrame:
    """Names that one settlement has, or two; the latter are told apart by their county where it is known."""
    key = F.col("s_suppkey")
    asked = t.supplier.select("s_suppkey", F.concat(F.lit("N"), key % 20).alias("name"), F.when(key % 4 != 0, (F.col("s_nationkey") % 5).cast("string")).alias("county"))
    named = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey") % 18).alias("name"), F.col("n_regionkey").cast("string").alias("county"), F.col("n_nationkey").cast("double").alias("lat"), F.lit(0.0).alias("lng"))
    return spatial.unique_by_name(asked, named, "s_suppkey").select("s_suppkey", F.col("lat").alias("found"))


@query("""with w as (select distinct string_split(p_name, ' ')[1] as name from part), n as (select distinct p_name from part)
select name, p_name, p_name = name as exact from w join n on p_name = name or starts_with(p_name, name || ' ') or ends_with(p_name, ' ' || name)""")
def affix_candidates(t: Tables) -> DataFrame:
    names = t.part.select("p_name").distinct()
    asked = names.select(F.substring_index("p_name", " ", 1).alias("city")).distinct()
    found = spatial.name_candidates(asked.withColumn("name", F.col("city")), names.select(F.col("p_name").alias("name"), "p_name"), "name", "city", "p_name")
    return found.select("name", "p_name", "exact")


@query("""with n as (select count(*) as n from supplier), cl as (select distinct c_custkey, s_suppkey from customer, n join supplier on s_suppkey % (n - n // 3) in (c_custkey % n, (c_custkey * 7) % n))
select c_custkey, min(s_suppkey) as s_suppkey from cl group by c_custkey having count(distinct s_suppkey) = 1""")
def only_claimant(t: Tables) -> DataFrame:
    """Two thirds as many places as suppliers, so some places have two; a customer asks for two places, which may have none."""
    n = t.supplier.count()
    asked = t.customer.select("c_custkey", F.explode(F.array_distinct(F.array(F.col("c_custkey") % n, F.col("c_custkey") * 7 % n))).alias("place"))
    claims = asked.join(t.supplier.select("s_suppkey", (F.col("s_suppkey") % (n - n // 3)).alias("place")), "place")
    return match.only_claimant(claims, "c_custkey", "s_suppkey")


@query("""with v as (select o_custkey, o_orderpriority as p, count(*) as n from orders group by all) select o_custkey, p as priority, n as votes from v qualify row_number() over (partition by o_custkey order by n desc, p desc) = 1""")
def majority(t: Tables) -> DataFrame:
    votes = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    return votes.groupBy("o_custkey").agg(F.max_by("o_orderpriority", F.struct("n", "o_orderpriority")).alias("priority"), F.max("n").alias("votes"))


@query("""select r_name, string_agg(n_name, ',' order by n_name) as nations from (select r_name, n_name, count(*) as n from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by all having count(*) >= 3) group by r_name""")
def supported_sets(t: Tables) -> DataFrame:
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    kept = joined.groupBy("r_name", "n_name").agg(F.count("*").alias("n")).where("n >= 3")
    return kept.groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_set("n_name")), ",").alias("nations"))


# --- statistics ---


@query("""select (select count(*) from customer) as customers, (select count(*) filter (where c_acctbal < 0) from customer) as overdrawn, (select count(*) filter (where c_mktsegment = 'BUILDING') from customer) as building, (select count(*) from orders) as orders, (select count(*) filter (where o_orderstatus = 'F') from orders) as filled""")
def coverage(t: Tables) -> DataFrame:
    c = stats.coverage(t.customer, {"customers": F.lit(True), "overdrawn": F.col("c_acctbal") < 0, "building": F.col("c_mktsegment") == "BUILDING"})
    o = stats.coverage(t.orders, {"orders": F.lit(True), "filled": F.col("o_orderstatus") == "F"})
    return c.crossJoin(o)  # one row each


@query("select coalesce(nullif(c_mktsegment, 'MACHINERY'), '?') as label, count(*) as n from customer group by 1")
def label_counts(t: Tables) -> DataFrame:
    return stats.by_label(t.customer.withColumn("segment", F.nullif("c_mktsegment", F.lit("MACHINERY"))), "segment")


@query("select p_type as label, count(*) as n from part group by p_type order by n desc, label limit 15")
def top_labels(t: Tables) -> DataFrame:
    return stats.by_label(t.part, "p_type", 15)


@query("with b as (select p_brand as label, count(*) as n from part group by p_brand order by n desc, label limit 10) select label, n, round(greatest(2.0, 100.0 * n / max(n) over ()), 4) as share from b")
def bars(t: Tables) -> DataFrame:
    return stats.bars(stats.by_label(t.part, "p_brand"), 10).withColumn("share", F.round("share", 4))


@query("""with f as (select *, min(doc_id) over (partition by lang, text) as keeper from documents) select doc_id, case when keeper <> doc_id then keeper end as duplicate_of from f""")
def duplicates(t: Tables) -> DataFrame:
    keyed = t.documents.select("doc_id", "lang", F.sha2("text", 256).alias("same"))
    first = keyed.groupBy("lang", "same").agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(first, ["lang", "same"], "left").select("doc_id", F.when(F.col("keeper") != F.col("doc_id"), F.col("keeper")).alias("duplicate_of"))


@query("""with r as (select s_suppkey as registry_id, s_nationkey as kind, case when s_suppkey % 3 = 0 then '1' end as oib, case s_suppkey % 4 when 0 then null when 3 then 'Brisan' else 'aktivan' end as st, (s_suppkey * 37) % 11 as registered_at from supplier),
a as (select *, row_number() over (partition by kind order by registered_at, registry_id) as n, first_value(registry_id) over (partition by kind order by registered_at, registry_id) as f from r where oib is null and (st is null or st ilike 'AKTIV%'))
select r.registry_id, case when n > 1 then f end as duplicate_of from r left join a using (registry_id)""")
def registry_duplicates(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    persons = t.supplier.select(key.alias("registry_id"), F.col("s_nationkey").alias("kind"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("city"), F.lit("x").alias("address"), F.when(key % 3 == 0, "1").alias("oib"), F.when(key % 4 == 0, None).when(key % 4 == 3, "Brisan").otherwise("aktivan").alias("registry_status"), (key * 37 % 11).alias("registered_at"), F.lit(None).cast("string").alias("registry_no"))
    return merge.mark_duplicates(persons).select("registry_id", "duplicate_of")


@query("select conv_id, count(*) as n_turns, string_agg(turn::varchar || ':' || role, '|' order by turn) as outline from conversations group by conv_id")
def ordered_children(t: Tables) -> DataFrame:
    turns = t.conversations.withColumn("main", F.lit(0))
    items = stats.child_list(turns, "conv_id", "main", "turn", ["turn", "role"]).select("conv_id", F.size("items").cast("bigint").alias("n_turns"), F.col("items").alias("i"))
    return items.select("conv_id", "n_turns", F.array_join(F.transform("i", lambda x: F.concat_ws(":", x["turn"].cast("string"), x["role"])), "|").alias("outline"))


@query("select 'lang' as facet, lang as value, count(*) as n from documents group by lang union all select 'source', source, count(*) from documents group by source")
def facets(t: Tables) -> DataFrame:
    return search.facets(t.documents, ["lang", "source"])


@query("select floor(p_size / 10)::bigint * 10 as bucket, count(*) as n from part group by 1")
def deciles(t: Tables) -> DataFrame:
    return stats.deciles(t.part, "p_size")


@query("select o_orderkey, row_number() over (order by (o_orderstatus = 'F') desc, o_orderkey) as place from orders qualify place > 60 and place <= 180")
def second_page(t: Tables) -> DataFrame:
    rows = search.page(t.orders.select("o_orderkey", "o_orderstatus"), [(F.col("o_orderstatus") == "F").desc(), F.col("o_orderkey")], 1)
    return search.ranked_pages(rows, [(F.col("o_orderstatus") == "F").desc(), F.col("o_orderkey")]).select("o_orderkey", (F.col("place") + 60).alias("place"))


@query("select string_split(p_name, ' ')[1] as first_word, count(*) as n from part group by 1")
def first_words(t: Tables) -> DataFrame:
    return t.part.groupBy(F.substring_index("p_name", " ", 1).alias("first_word")).agg(F.count("*").alias("n"))


@query("""select r_name, sum(case when c_acctbal > 0 then 1 else 0 end)::bigint as positive, count(*) as customers, round(100.0 * sum(case when c_acctbal > 0 then 1 else 0 end) / count(*), 1) as share from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name""")
def territory_rollup(t: Tables) -> DataFrame:
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    out = joined.groupBy("r_name").agg(F.count_if(F.col("c_acctbal") > 0).alias("positive"), F.count("*").alias("customers"))
    return out.withColumn("share", F.round(100.0 * F.col("positive") / F.col("customers"), 1))


# --- set algebra, sinks ---


@query("""with k as (select n_nationkey, list_distinct([left(n_name, 1), right(n_name, 1), left(r_name, 1)]) as a, [left(r_name, 1), right(r_name, 1)] as b from nation join region on n_regionkey = r_regionkey)
select n_nationkey, len(list_distinct(list_concat(a, b)))::bigint as n_union, list_has_any(a, b) as overlap from k""")
def key_sets(t: Tables) -> DataFrame:
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    a = F.array_distinct(F.array(F.left("n_name", F.lit(1)), F.right("n_name", F.lit(1)), F.left("r_name", F.lit(1))))
    b = F.array(F.left("r_name", F.lit(1)), F.right("r_name", F.lit(1)))
    return joined.select("n_nationkey", F.size(F.array_union(a, b)).cast("bigint").alias("n_union"), F.arrays_overlap(a, b).alias("overlap"))


@query("""select 'https://x.org/' as url union all select 'https://x.org/r/' || lower(replace(r_name, ' ', '-')) from region union all select 'https://x.org/s/' || s_suppkey || '&amp;a' from supplier""")
def sitemap(t: Tables) -> DataFrame:
    regions = t.region.select(F.lower(F.replace("r_name", F.lit(" "), F.lit("-"))).alias("slug"))
    return sinks.sitemap("https://x.org/", ["/"], ("r", regions), ("s", t.supplier.select(F.concat("s_suppkey", F.lit("&a")).alias("slug"))))


@query(f"""select s_suppkey, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || printf('%.1f', lng) || ',' || printf('%.1f', lat) || ']}},"properties":{{"s_suppkey":' || s_suppkey || case when s_suppkey % 3 = 0 then '' else ',"note":"n' || s_suppkey % 3 || '"' end || case when s_suppkey % 2 = 0 then '' else ',"is_parish_church":1' end || ',"church_count":' || s_suppkey % 2 || '}}}}' as feature
from (select s_suppkey, 42 + s_suppkey % 4 + 0.5 as lat, 13 + s_suppkey % 6 + 0.5 as lng from supplier)""")
def point_features(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    rows = t.supplier.select("s_suppkey", (F.lit(42.5) + key % 4).alias("lat"), (F.lit(13.5) + key % 6).alias("lng"), F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("n"), key % 3)).alias("note"), (key % 2).cast("int").alias("is_parish_church"), (key % 2).cast("int").alias("church_count"))
    return sinks.point_features(rows).select(F.get_json_object("feature", "$.properties.s_suppkey").cast("bigint").alias("s_suppkey"), "feature")


@query("""select s_suppkey, s_suppkey || ',' || case when s_suppkey % 2 = 0 then '"a, ' || s_suppkey || '"' else s_name end || ',' || s_nationkey as line from supplier""")
def csv_lines(t: Tables) -> DataFrame:
    name = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("a, "), "s_suppkey")).otherwise(F.col("s_name"))
    lines = sinks.csv_rows(t.supplier.select("s_suppkey", name.alias("name"), "s_nationkey"))
    return lines.select(F.substring_index("line", ",", 1).cast("bigint").alias("s_suppkey"), "line")


@query("select l_returnflag, l_linestatus, sum(l_quantity)::double as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem group by all")
def rollup_lines(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


# --- merge policies ---

_OLD = "o as (select c_custkey as id, c_name as name, case when c_custkey % 3 = 0 then null else c_nationkey end as nation, c_mktsegment as segment from customer where c_custkey % 5 <> 0)"
_NEW = "n as (select c_custkey as id, case when c_custkey % 2 = 0 then null else upper(c_name) end as name, c_nationkey + 100 as nation, case when c_custkey % 4 = 0 then null else 'NEW' end as segment from customer where c_custkey % 7 <> 0)"


def _old_new(t: Tables) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    old = t.customer.where(k % 5 != 0).select(k.alias("id"), F.col("c_name").alias("name"), F.when(k % 3 == 0, None).otherwise(F.col("c_nationkey")).alias("nation"), F.col("c_mktsegment").alias("segment"))
    new = t.customer.where(k % 7 != 0).select(k.alias("id"), F.when(k % 2 == 0, None).otherwise(F.upper("c_name")).alias("name"), (F.col("c_nationkey") + 100).alias("nation"), F.when(k % 4 == 0, None).otherwise(F.lit("NEW")).alias("segment"))
    return old, new


def _merged(values: str) -> str:
    return f"with {_OLD}, {_NEW} select coalesce(o.id, n.id) as id, {values} from o full join n on o.id = n.id"


@query(_merged("coalesce(n.name, o.name) as name, coalesce(n.nation, o.nation) as nation, coalesce(n.segment, o.segment) as segment"))
def merge_latest(t: Tables) -> DataFrame:
    return merge.merge(*_old_new(t), ["id"])


@query(_merged("coalesce(o.name, n.name) as name, coalesce(o.nation, n.nation) as nation, coalesce(o.segment, n.segment) as segment"))
def merge_existing(t: Tables) -> DataFrame:
    return merge.merge(*_old_new(t), ["id"], default=merge.EXISTING)


@query(_merged("case when n.id is not null then n.name else o.name end as name, coalesce(o.nation, n.nation) as nation, case when o.id is not null then o.segment else n.segment end as segment"))
def merge_by_column(t: Tables) -> DataFrame:
    return merge.merge(*_old_new(t), ["id"], {"name": merge.OVERWRITE, "nation": merge.EXISTING, "segment": merge.KEEP})


@query(f"with {_OLD}, {_NEW}, f as (select * from (select *, row_number() over (partition by id % 1000 order by id) as r from n) where r = 1) select id, name, nation, segment from o union all select id, name, nation, segment from f where id not in (select id from o)")
def insert_ignore(t: Tables) -> DataFrame:
    old, new = _old_new(t)
    first = new.withColumn("r", F.row_number().over(Window.partitionBy(F.col("id") % 1000).orderBy("id"))).where("r = 1").drop("r")
    return merge.insert_ignore(old, first, ["id"], ["id"])


@query("""select c_custkey, case when c_custkey % 3 = 0 then '["wiki"]' when c_custkey % 3 = 1 then '["osm","wiki"]' else '["wiki","osm"]' end as source from customer""")
def provenance(t: Tables) -> DataFrame:
    old = F.when(F.col("c_custkey") % 3 == 0, "not json").when(F.col("c_custkey") % 3 == 1, '["osm"]').otherwise('["wiki","osm"]')
    return t.customer.select("c_custkey", merge.provenance(old, F.lit("wiki")).alias("source"))


@query("""select coalesce('oib:' || nullif(trim(case when s_suppkey % 2 = 0 then 'x' || s_suppkey % 10 else ' ' end), ''), 'reg:' || s_suppkey % 20) as person, count(*) as n, min(s_suppkey) as first_key from supplier group by 1""")
def identities(t: Tables) -> DataFrame:
    oib = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("x"), F.col("s_suppkey") % 10)).otherwise(" ")
    return t.supplier.groupBy(merge.identity(oib, F.col("s_suppkey") % 20).alias("person")).agg(F.count("*").alias("n"), F.min("s_suppkey").alias("first_key"))


@query("""select user_id, arg_min(kind, event_id) filter (where kind is not null) as kind, arg_min(v, event_id) filter (where v is not null) as v from (select user_id, event_id, nullif(event_type, 'view') as kind, case when event_id % 3 = 0 then null else event_id * 2 end as v from events) group by user_id""")
def collapsed(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", F.nullif("event_type", F.lit("view")).alias("kind"), F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("event_id") * 2).alias("v"))
    return merge.collapse(rows, ["user_id"], "event_id", ["kind", "v"])


# --- search ---

_TOKENS = f"tk as (select distinct doc_id, unnest(regexp_split_to_array(lower(translate(text, '{search._FROM}', '{search._TO}')), '[^\\p{{L}}\\p{{N}}]+')) as token from documents)"


@query(f"with {_TOKENS} select doc_id from tk where token in ('the', 'and', 'that') group by doc_id having count(distinct token) = 3")
def token_search(t: Tables) -> DataFrame:
    return search.search_rows(t.documents, "doc_id", ["text"], "the  And THAT")


@query(f"with {_TOKENS} select token, count(*) as n from tk where token <> '' group by token")
def token_index(t: Tables) -> DataFrame:
    return search.token_index(t.documents, "doc_id", ["text"]).groupBy("token").agg(F.count("*").alias("n"))


@query(f"with tk as (select distinct p_partkey, unnest(string_split(lower(p_name || ' ' || p_type), ' ')) as token from part) select p_partkey from tk group by p_partkey having bool_or(token = 'red') and bool_or(starts_with(token, 'wid'))")
def index_search(t: Tables) -> DataFrame:
    return search.search_all(search.token_index(t.part, "p_partkey", ["p_name", "p_type"]), "p_partkey", "RED wid*")


@query(f"select p_partkey, p_name from part where strpos({sql_fold('p_name')}, 'ed') > 0 or strpos({sql_fold('p_type')}, 'brass') > 0")
def text_search(t: Tables) -> DataFrame:
    return search.search_text(t.part, ["p_name"], "ED").unionByName(search.search_text(t.part, ["p_type"], "Bráss")).select("p_partkey", "p_name").distinct()


@query("""select s_suppkey, count(o.c_custkey) as n_children, coalesce(string_agg(lpad(o.c_custkey::varchar, 9, '0'), ',' order by o.c_custkey), '') as children from supplier left join customer o on o.c_custkey % (select count(*) from supplier) = s_suppkey group by s_suppkey""")
def detail(t: Tables) -> DataFrame:
    children = t.customer.select((F.col("c_custkey") % t.supplier.count()).alias("parent"), F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("k"))
    docs = search.detail(t.supplier.select("s_suppkey"), children, "s_suppkey", "parent", ["k"])
    return docs.select("s_suppkey", F.size("items").cast("bigint").alias("n_children"), F.array_join(F.transform("items", lambda i: i["k"]), ",").alias("children"))


@query("select word, row_number() over (order by word collate hr, word) as place from (select distinct unnest(string_split(text, ' ')) as word from documents)")
def locale_order(t: Tables) -> DataFrame:
    words = t.documents.select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return search.ranked_pages(words, [search.locale_order(F.col("word")), "word"])


# --- matching ---


def sql_lcs(a: str, b: str) -> str:
    row = f"list_reduce(list_prepend([0::bigint], list_transform(range(1, length({b}) + 1), lambda j: [j::bigint])), lambda acc, j: list_append(acc, (case when ord(substr({b}, j[1]::int, 1)) = ca[1] then prev[j[1]] + 1 else greatest(prev[j[1] + 1], acc[-1]) end)::bigint))"
    return f"list_reduce(list_prepend(list_transform(range(0, length({b}) + 1), lambda j: 0::bigint), list_transform(string_split({a}, ''), lambda ch: [ord(ch)::bigint])), lambda prev, ca: {row})[-1]"


def _names(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_name").alias("name")).distinct()


@query(f"""with n as (select distinct p_name as name from part), w as (select a.name as a, b.name as b, list_distinct(string_split(a.name, ' ')) as wa, list_distinct(string_split(b.name, ' ')) as wb from n a join n b on a.name < b.name and list_has_any(string_split(a.name, ' '), string_split(b.name, ' '))),
p as (select a, b, array_to_string(list_sort(list_intersect(wa, wb)), ' ') as i, array_to_string(list_sort(list_filter(wa, lambda x: not list_contains(wb, x))), ' ') as da, array_to_string(list_sort(list_filter(wb, lambda x: not list_contains(wa, x))), ' ') as db from w),
q as (select *, trim(i || ' ' || da) as x, trim(i || ' ' || db) as y from p)
select a, b, round(case when i <> '' and (da = '' or db = '') then 100 else greatest(200.0 * {sql_lcs('x', 'y')} / (length(x) + length(y)), case when i <> '' then 200.0 * length(i) / (length(i) + length(x)) else 0 end, case when i <> '' then 200.0 * length(i) / (length(i) + length(y)) else 0 end) end, 6) as ratio from q""")
def name_ratios(t: Tables) -> DataFrame:
    """Names that share a word; they meet by an equi join on their words."""
    from ..functions import similarity

    words = _names(t).select("name", F.explode(F.array_distinct(F.split("name", " "))).alias("word"))
    a, b = words.withColumnRenamed("name", "a"), words.withColumnRenamed("name", "b")
    met = a.join(b, "word").where("a < b").select("a", "b").distinct()
    return met.withColumn("ratio", F.round(similarity.ratio(F.col("a"), F.col("b")), 6))


def _records(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers look for buildings of suppliers' nations: a narrow tier by nation, a wide one by region."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name", F.array(text.place_keys(F.col("n_name")), text.place_keys(F.col("r_name"))).alias("tiers"))
    saints = F.element_at(F.array(*(F.lit(s) for s in ("Marka", "Jurja", "Ane", "Nikole", "Roka", "Vida", "Luke", "Petra"))), (F.col("k") % 8 + 1).cast("int"))
    named = lambda df, key, nation: df.select(F.col(key).alias("k"), F.col(nation).alias("nk")).join(places, F.col("nk") == F.col("n_nationkey"))
    buildings = named(t.supplier, "s_suppkey", "s_nationkey").select(F.col("k").alias("id"), F.concat(F.lit("Crkva sv. "), saints).alias("name"), F.col("n_name").alias("city"), F.col("r_name").alias("municipality"))
    queries = named(t.customer, "c_custkey", "c_nationkey").select(F.col("k").alias("rec_id"), F.concat(F.lit("ŽUPA SV. "), F.upper(saints), F.lit(" EVANĐELISTA")).alias("name"), "tiers")
    return queries, match.candidate_index(buildings, ["city", "municipality"])


_MATCH = """with b as (select s_suppkey as id, s_suppkey % 8 as saint, s_nationkey as nk, n_regionkey as rk from supplier join nation on s_nationkey = n_nationkey),
q as (select c_custkey as rec_id, c_custkey % 8 as saint, c_nationkey as nk, n_regionkey as rk from customer join nation on c_nationkey = n_nationkey),
p as (select rec_id, 0 as tier, id from q join b using (nk, saint) union all select rec_id, 1, id from q join b on q.rk = b.rk and q.saint = b.saint),
u as (select rec_id, tier, min(id) as cand_id from p group by rec_id, tier having count(*) = 1), f as (select rec_id, arg_min(cand_id, tier) as cand_id, min(tier)::int as tier from u group by rec_id)"""


@query(_MATCH + " select rec_id, cand_id, tier from q left join f using (rec_id)")
def best_match(t: Tables) -> DataFrame:
    """Names agree but for the epithet, so a tier decides exactly when one building of the saint is in it."""
    return match.best_match(*_records(t)).select("rec_id", "cand_id", "tier")


@query(_MATCH + " select min(rec_id) as rec_id, cand_id from f group by cand_id")
def exclusive_match(t: Tables) -> DataFrame:
    return match.exclusive(match.best_match(*_records(t))).select("rec_id", "cand_id")


@query("""select c_custkey as rec_id, case when c_nationkey % 3 = 0 and c_nationkey in (select s_nationkey from supplier) then 'narrow' when n_regionkey <> 4 and n_regionkey in (select n_regionkey from supplier join nation on s_nationkey = n_nationkey) then 'wide' else 'none' end as block
from customer join nation on c_nationkey = n_nationkey""")
def block_diagnosis(t: Tables) -> DataFrame:
    """Only every third nation is written as buildings' city, and the last region is not written at all."""
    queries, _ = _records(t)
    placed = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    buildings = placed.select(F.col("s_suppkey").alias("id"), F.lit("Crkva").alias("name"), F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).alias("city"), F.when(F.col("r_regionkey") != 4, F.col("r_name")).alias("municipality"))
    return match.block_diagnosis(queries, match.candidate_index(buildings, ["city", "municipality"]))


@query(_MATCH + """, c as (select rec_id, tier, count(*) as n from p group by rec_id, tier), n as (select rec_id, max(n) filter (where tier = 0) as narrow, max(n) filter (where tier = 1) as wide,
 (select count(*) from b where b.nk = q.nk) as any_narrow, (select count(*) from b where b.rk = q.rk) as any_wide from q left join c using (rec_id) group by rec_id, q.nk, q.rk),
r as (select case when narrow = 1 or wide = 1 then 'matched' when any_narrow > 0 then case when narrow > 1 then 'ambiguous' else 'saint' end when any_wide > 0 then case when wide > 1 then 'ambiguous' else 'saint' end else 'no candidates' end as reason from n)
select reason, count(*) as n from r group by reason""")
def exit_reasons(t: Tables) -> DataFrame:
    queries, index = _records(t)
    return match.best_match(queries, index).groupBy("reason").agg(F.count("*").alias("n"))


# --- rules against stored expectations: part k takes case k modulo their number ---


def _literal(v: object) -> str:
    return "null" if v is None else "'" + str(v).replace("'", "''") + "'"


def expectations(name: str, cases: list[tuple], use: Callable[..., Column]) -> None:
    """Registers a query that applies a function to the cases' inputs; the last entry of a case is what must come out."""
    n, width = len(cases), len(cases[0]) - 1
    sql = f"select p_partkey, ([{', '.join(_literal(c[-1]) for c in cases)}])[p_partkey % {n} + 1] as found from part"

    @query(sql)
    def run(t: Tables) -> DataFrame:
        as_map = lambda v: F.create_map(*(F.lit(x) for kv in v.items() for x in kv)) if v else F.create_map().cast("map<string,string>")
        column = lambda k: F.array(*(as_map(c[k]) if isinstance(c[k], dict) else F.lit(c[k]).cast("string") for c in cases))
        inputs = [F.element_at(column(k), (F.col("p_partkey") % n + 1).cast("int")).alias(f"i{k}") for k in range(width)]
        return t.part.select("p_partkey", *inputs).select("p_partkey", use(*(F.col(f"i{k}") for k in range(width))).alias("found"))

    QUERIES[name], ORACLE[name] = QUERIES.pop("run"), ORACLE.pop("run")


expectations("dedications", [("Kapela Navještenja Gospodnjeg", "Navještenje Gospodnje"), ("Crkva Gospe Karmelske", "Gospa Karmelska"), ("ŽUPA SRCA ISUSOVA", "Presveto Srce Isusovo"), ("Crkva Žalosne BDM", "Žalosna Gospa"), ("Kapela Majke Božje Lurdske", "Majka Božja"), ("Crkva Uznesenja BDM i sv. Luke", "Uznesenje BDM"),
    ("Crkva Svih svetih", "Svi Sveti"), ("Kapela sv. Luke", "sv. Luka"), ("ŽUPA SV. TOME APOSTOLA, KOTAR", "sv. Toma Apostol"), ("Crkva svete Barbare na brdu", "sv. Barbara"), ("Samostan", None), (None, None)], rules.dedication)
expectations("dedication_heads", [("Crkva sv. Luke Evanđelista", "sv luka"), ("ŽUPA SV. IVANA KRSTITELJA, ZAGREB", "sv ivan"), ("Crkva Presvetog Trojstva", "presveto trojstvo"), ("Kapela", None)], rules.dedication_head)
expectations("tagged_kinds", [({"building": "mosque"}, "Crkva", "dzamija"), ({"building": "church", "denomination": "orthodox"}, "Crkva sv. Save", "pravoslavna-crkva"), ({"church:type": "basilica", "building": "chapel"}, None, "bazilika"), ({"building": "church"}, "Kapelica na putu", "kapela"),
    ({"religion": "jewish"}, None, "sinagoga"), ({"amenity": "monastery"}, "Crkva sv. Klare", "samostan"), ({}, "Kip sv. Nikole", "poklonac"), ({}, None, "ostalo")], rules.kind)
expectations("religions", [({"religion": "buddhist"}, "crkva", "buddhist"), ({}, "dzamija", "muslim"), ({}, "sinagoga", "jewish"), ({}, "kapela", "christian"), ({}, "ostalo", None)], rules.religion)
expectations("denominations", [("greek_catholic", "grkokatolička"), ("Baptist", "baptistička"), ("new_apostolic", "new apostolic"), ("", None), (None, None)], rules.denomination_label)
expectations("registry_kinds", [("ŽUPA SV. LUKE", "zupa"), ("ĐAKOVAČKA NADBISKUPIJA", "biskupija"), ("OPATIJA SV. KRŠEVANA", "samostan"), ("FRANJEVAČKA PROVINCIJA", "provincija"), ("CARITAS SPLIT", "caritas"), ("udruga", "ostalo"), (None, "ostalo")], rules.registry_kind)
expectations("community_faiths", [("BUGARSKA PRAVOSLAVNA CRKVA", None, "christian/bulgarian_orthodox"), ("x", "ŽIDOVSKA OPĆINA", "jewish/jewish"), ("BAPTISTIČKA CRKVA", "ISLAMSKA", "christian/baptist"), ("x", "y", None)], lambda c, o: (lambda f: F.when(f.isNotNull(), F.concat_ws("/", f["c0"], f["c1"])))(rules.community_faith(c, o)))
expectations("organisation_kinds", [("PAROHIJA SPLIT", "parohija"), ("MEDŽLIS RIJEKA", "dzemat"), ("CRKVENA OPĆINA ILOK", "crkvena-opcina"), ("EPARHIJA", "eparhija"), ("MANASTIR KRKA", "samostan"), ("ured", "ostalo")], rules.organisation_kind)
expectations("diocese_kinds", [("Riječka nadbiskupija", "nadbiskupija"), ("Krčka biskupija", "biskupija"), ("ZADARSKA NADBISKUPIJA", "nadbiskupija")], rules.diocese_kind)
expectations("error_labels", [("IP address restriction applies", "ip-restricted"), ("the referer is not allowed", "referer-restricted"), ("Service has not been used before", "api-disabled"), ("boom", "unknown"), (None, "unknown")], rules.error_class)
expectations("short_names", [("ŽUPA SV. LUKE", "sv. Luke"), ("župa PRESVETOG SRCA", "Presvetog Srca"), ("CARITAS", "Caritas"), (None, "")], text.short_name)
expectations("wiki_addresses", [("en:Big Ben", "https://en.wikipedia.org/wiki/Big_Ben"), ("http://a.b/c", "http://a.b/c"), ("plain", None), (None, None)], text.wikipedia_url)
expectations("points_of_text", [("Point(15.5 45.25)", "45.25/15.5"), ("POINT ( -1.5 2 )", "2.0/-1.5"), ("Line(1 2)", None)], lambda c: (lambda w: F.when(w["lat"].isNotNull(), F.concat_ws("/", w["lat"].cast("string"), w["lng"].cast("string"))))(text.wkt_point(c)))
expectations("query_ladders", [("ŽUPA SV. LUKE", "Pula", "Ulica 2", "Župa sv. Luke, Ulica 2, Pula|Župa sv. Luke, Pula|Crkva sv. Luke, Pula"), ("CARITAS", "Pula", None, "Caritas, Pula"), ("CARITAS", None, "Ulica 2", "")], lambda n, c, a: F.array_join(text.query_ladder(n, c, a), "|"))


# --- seats, search answers, territories ---


@query("""select c_custkey as id, case when c_custkey % 5 = 0 then 'own' when c_custkey % 3 = 0 then 'church' when c_custkey % 2 = 0 then 'centroid' end as geo_source, (case when c_custkey % 5 = 0 then 1 when c_custkey % 3 = 0 then 2 when c_custkey % 2 = 0 then 3 end)::double as lat from customer""")
def geocoded(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    at = lambda by, v: t.customer.where(k % by == 0).select(k.alias("id"), F.lit(v).alias("lat"), F.lit(v).alias("lng"))
    seats_ = t.customer.select(k.alias("id"), F.when(k % 5 == 0, 1.0).alias("lat"), F.when(k % 5 == 0, 1.0).alias("lng"))
    return linking.geocode(seats_, at(3, 2.0), at(2, 3.0)).select("id", "geo_source", "lat")


@query("""with r as (select o_custkey as rec_id, (o_orderkey % 3)::int as query_no, ((o_orderkey // 3) % 7)::int as result_no, o_orderkey % 5 = 0 as sacral, o_orderkey % 2 = 0 as alike, o_orderkey % 4 = 1 as far, o_orderkey % 7 = 2 as abroad from orders)
select rec_id, arg_min(query_no, query_no * 10 + result_no) as query_no, arg_min(result_no, query_no * 10 + result_no) as result_no from r where (sacral or alike) and not far and not abroad group by rec_id""")
def first_answers(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(
        F.col("o_custkey").alias("rec_id"), (k % 3).cast("int").alias("query_no"), (F.floor(k / 3) % 7).cast("int").alias("result_no"), F.lit("Crkva sv. Luke").alias("person_name"), F.when(k % 2 == 0, "sv. Luka sv. Luke").otherwise("Trgovina 123").alias("result_name"),
        (k % 5 == 0).alias("is_sacral"), F.lit(45.0).alias("lat"), F.lit(16.0).alias("lng"), F.when(k % 4 == 1, 46.0).when(k % 4 == 2, 45.01).alias("anchor_lat"), F.when(k % 4 == 1, 16.0).when(k % 4 == 2, 16.01).alias("anchor_lng"), F.when(k % 7 == 2, "B").when(k % 3 == 0, "").otherwise("A").alias("county"), F.lit("A").alias("found_county"),
    )
    return linking.first_acceptable(rows)


def _towns(t: Tables) -> DataFrame:
    """Nations as tiles of 1.2 by 0.8 degrees, five in a row, from the country's south-west corner."""
    x, y = F.lit(13.4) + F.col("n_nationkey") % 5 * 1.2, F.lit(42.3) + F.floor(F.col("n_nationkey") / 5) * 0.8
    ring = F.array(*(F.array(x + a, y + b) for a, b in ((0.0, 0.0), (1.2, 0.0), (1.2, 0.8), (0.0, 0.8))))
    return t.nation.select(F.col("n_nationkey").cast("bigint").alias("idx"), F.col("n_regionkey").cast("string").alias("jls"), F.lit("c").alias("county"), (y + 0.4).alias("lat"), (x + 0.6).alias("lng"), F.array(F.array(ring)).alias("polygons"))


@query(f"""with {SUPPLIERS}, w as (select n_nationkey as idx, n_regionkey as jls, 13.4::double + n_nationkey % 5 * 1.2::double as x, 42.3::double + n_nationkey // 5 * 0.8::double as y from nation),
p as (select s_suppkey as id, 'D' || s_suppkey % 4 as diocese, lat, lng from s),
i as (select idx, jls, id, diocese from p join w on lng >= x and lng < x + 1.2 and lat >= y and lat < y + 0.8), v as (select idx, diocese, count(*) as n from i group by idx, diocese),
b as (select idx, diocese from v qualify row_number() over (partition by idx order by n desc, diocese desc) = 1)
select idx::bigint as idx, diocese, true as direct from b""")
def direct_votes(t: Tables) -> DataFrame:
    """Settlements with seats of their own, which vote; any without one would follow a neighbour and is left out here."""
    seats_ = suppliers(t).select(F.col("s_suppkey").alias("id"), F.concat(F.lit("D"), F.col("s_suppkey") % 4).alias("diocese"), "lat", "lng")
    return territory.assign(_towns(t), seats_).where("direct").select("idx", "diocese", "direct")


@query("""select n_nationkey as slug_key, case when n_nationkey % 6 = 5 then null else count(s_suppkey) end as n_children from nation left join supplier on s_nationkey = n_nationkey group by n_nationkey""")
def looked_up(t: Tables) -> DataFrame:
    """Detail documents by route and slug; every sixth asked for is not there."""
    slug = lambda c: F.concat(F.lit("n-"), F.col(c))
    docs = search.detail_documents(t.nation.select("n_nationkey", slug("n_nationkey").alias("slug")), "n_nationkey", "nation", "slug", {"suppliers": (t.supplier, "s_nationkey", ["s_suppkey", "s_name"])})
    asked = t.nation.select("n_nationkey", F.lit("nation").alias("route"), F.when(F.col("n_nationkey") % 6 == 5, "none").otherwise(slug("n_nationkey")).alias("slug"))
    found = search.by_slug(docs, asked)
    return found.select(F.col("n_nationkey").alias("slug_key"), F.json_array_length(F.get_json_object("document", "$.suppliers")).cast("bigint").alias("n_children"))


@query("select p_partkey from part where strpos(p_name, 'ing') > 0 and p_type in ('ECONOMY', 'SMALL') and p_brand = 'Brand#2'")
def browsed(t: Tables) -> DataFrame:
    return search.browse(t.part, ["p_name"], "ING", search.toggled(["ECONOMY"], "SMALL"), {"p_brand": "Brand#2"}, kind="p_type").select("p_partkey")


@query("""with m as (select s_nationkey, min(s_suppkey) filter (where s_suppkey % 3 = 0) as main, count(*) as n from supplier group by s_nationkey) select s_suppkey, main, n - 1 as n_others from supplier join m using (s_nationkey)""")
def mother_and_others(t: Tables) -> DataFrame:
    rows = t.supplier.withColumn("main_flag", (F.col("s_suppkey") % 3 == 0).cast("int"))
    own = search.families(rows, "s_nationkey", "s_suppkey", ["s_name"], "main_flag")
    return rows.join(own.select("s_nationkey", "main", (F.size("members") - 1).cast("bigint").alias("n_others")), "s_nationkey").select("s_suppkey", "main", "n_others")


@query("""with a as (select s_suppkey, s_nationkey from supplier where s_acctbal > (select quantile_cont(s_acctbal, 0.5) from supplier)), m as (select s_nationkey, min(s_suppkey) filter (where s_suppkey % 3 = 0) as main from supplier group by s_nationkey)
select a.s_suppkey, main, coalesce(string_agg(o.s_name, ',' order by o.s_name) filter (o.s_suppkey <> a.s_suppkey), '') as others from a join m using (s_nationkey) join supplier o on o.s_nationkey = a.s_nationkey group by all""")
def siblings_asked(t: Tables) -> DataFrame:
    """Pages of the suppliers above the median balance, each with the others of its nation."""
    rows = t.supplier.withColumn("main_flag", (F.col("s_suppkey") % 3 == 0).cast("int"))
    asked = rows.crossJoin(t.supplier.agg(F.median("s_acctbal").alias("m"))).where("s_acctbal > m")  # one row
    return search.siblings(rows, asked, "s_nationkey", "s_suppkey", ["s_name"], "main_flag").select("s_suppkey", "main", F.array_join(F.transform("others", lambda o: o["s_name"]), ",").alias("others"))


@query("select s_suppkey, case s_suppkey % 4 when 0 then 'city' when 1 then 'town' when 2 then 'wide' end as place from supplier")
def listed_place(t: Tables) -> DataFrame:
    k = F.col("s_suppkey") % 4
    return t.supplier.select("s_suppkey", search.indexed_place(F.when(k == 0, " city ").otherwise(""), F.when(k <= 1, "town"), F.when(k <= 2, "wide").otherwise(" ")).alias("place"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a supplier within 25 km, by region."""
    t = Tables(spark, sf_dir)
    near = spatial.nearest_within(customers(t), suppliers(t), "c_custkey", "s_suppkey", RADIUS_KM).select("c_custkey", F.col("r_s_suppkey").alias("supplier"))
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    joined = t.customer.join(near, "c_custkey", "left").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("r_name").agg(F.count("supplier").alias("linked"), F.count("*").alias("customers")).orderBy("r_name")


QUERIES["coverage_by_region"] = flagship
ORACLE["coverage_by_region"] = f"""with {CUSTOMERS}, {SUPPLIERS}, l as (select distinct c_custkey from c, s where {sql_metres('c', 's')} <= 25000)
select r_name, count(l.c_custkey) as linked, count(*) as customers from customer x left join l on x.c_custkey = l.c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name"""
