"""Rule functions over names, tags and messages that are put together from the tables' columns; the SQL works out the labels by rules of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text
from .catalogue import Tables, query


def _of(words: Sequence[str | None], k: Column) -> Column:
    return F.element_at(F.array(*(F.lit(w) for w in words)), (k % len(words) + 1).cast("int"))


def _sql_of(words: Sequence[str | None], k: str) -> str:
    return "[" + ", ".join("null" if w is None else f"'{w}'" for w in words) + f"][({k}) % {len(words)} + 1]"


def _words(words: Sequence[str]) -> Column:
    """A name of one of the words, the part's name in capitals, and another of the words."""
    k = F.col("p_partkey")
    return F.concat_ws(" ", _of(words, k), F.upper("p_name"), _of(words, F.floor(k / len(words))))


def _sql_words(words: Sequence[str]) -> str:
    return f"select p_partkey, upper(p_name) as p, {_sql_of(words, 'p_partkey')} as a, {_sql_of(words, f'p_partkey // {len(words)}')} as b from part"


_REGISTER = ("ŽUPA", "NADBISKUPIJA", "SAMOSTAN", "PROVINCIJA", "CARITAS", "SVETIŠTE", "UDRUGA")


@query(f"""with n as ({_sql_words(_REGISTER)}) select p_partkey, case when a = 'ŽUPA' then 'zupa' when 'NADBISKUPIJA' in (a, b) then 'biskupija' when 'SAMOSTAN' in (a, b) then 'samostan' when 'PROVINCIJA' in (a, b) or list_contains(string_split(p, ' '), 'RED') then 'provincija'
when 'CARITAS' in (a, b) then 'caritas' when 'SVETIŠTE' in (a, b) then 'svetiste' else 'ostalo' end as kind from n""")
def register_labels(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", rules.registry_kind(_words(_REGISTER)).alias("kind"))


_FORMS = ("PAROHIJA", "MEDŽLIS", "CRKVENA OPĆINA", "EPARHIJA", "MANASTIR", "URED")


@query(f"""with n as ({_sql_words(_FORMS)}) select p_partkey, case when 'PAROHIJA' in (a, b) then 'parohija' when 'MEDŽLIS' in (a, b) then 'dzemat' when 'CRKVENA OPĆINA' in (a, b) then 'crkvena-opcina' when 'EPARHIJA' in (a, b) then 'eparhija' when 'MANASTIR' in (a, b) then 'samostan' else 'ostalo' end as kind from n""")
def organisation_labels(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", rules.organisation_kind(_words(_FORMS)).alias("kind"))


_FAITHS = ("SRPSKA PRAVOSLAVNA", "ISLAMSKA", "ŽIDOVSKA", "BAPTISTIČKA", "METODISTIČKA", "UDRUGA")


@query(f"""with n as ({_sql_words(_FAITHS)}), l as (select p_partkey, unnest([a, b]) as w, unnest([1, 2]) as nth from n),
f as (select p_partkey, nth, case w when 'SRPSKA PRAVOSLAVNA' then 'christian/serbian_orthodox' when 'ISLAMSKA' then 'muslim/sunni' when 'ŽIDOVSKA' then 'jewish/jewish' when 'BAPTISTIČKA' then 'christian/baptist' when 'METODISTIČKA' then 'christian/methodist' end as faith from l)
select p_partkey, arg_min(faith, nth) filter (faith is not null) as faith from f group by p_partkey""")
def faith_labels(t: Tables) -> DataFrame:
    """By the community's name, else by the own one."""
    k = F.col("p_partkey")
    found = rules.community_faith(F.concat_ws(" ", _of(_FAITHS, k), F.upper("p_name")), F.concat_ws(" ", F.upper("p_name"), _of(_FAITHS, F.floor(k / len(_FAITHS)))))
    return t.part.select("p_partkey", found.alias("f")).select("p_partkey", F.when(F.col("f").isNotNull(), F.concat_ws("/", "f.c0", "f.c1")).alias("faith"))


@query("select n_nationkey, case when n_nationkey % 3 = 0 then 'nadbiskupija' else 'biskupija' end as kind from nation")
def diocese_labels(t: Tables) -> DataFrame:
    name = F.concat_ws(" ", "n_name", F.when(F.col("n_nationkey") % 3 == 0, "NadBiskupija").otherwise("Biskupija"))
    return t.nation.select("n_nationkey", rules.diocese_kind(name).alias("kind"))


_PARTS = ("IP address restriction", "Referer blocked", "has not been used", "not enabled", "timeout")


@query(f"""with n as (select o_orderkey, {_sql_of(_PARTS, 'o_orderkey')} as a, {_sql_of(_PARTS, 'o_orderkey // 5')} as b from orders)
select o_orderkey, case when 'IP address restriction' in (a, b) then 'ip-restricted' when 'Referer blocked' in (a, b) then 'referer-restricted' when 'has not been used' in (a, b) or 'not enabled' in (a, b) then 'api-disabled' else 'unknown' end as label from n""")
def message_labels(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", rules.error_class(F.concat_ws(": ", _of(_PARTS, k), F.upper("o_orderpriority"), _of(_PARTS, F.floor(k / 5)))).alias("label"))


_CODES, _LABELS = ("greek_catholic", " Baptist", "SUNNI ", "old_catholic", None, ""), ("grkokatolička", "baptistička", "sunitska", "starokatolička", None, None)


@query(f"select p_partkey, case when p_partkey % 2 = 0 then {_sql_of(_LABELS, 'p_partkey // 2')} else lower(p_name) end as label from part")
def denomination_labels(t: Tables) -> DataFrame:
    """Known codes by their label, others by their words."""
    k = F.col("p_partkey")
    return t.part.select("p_partkey", rules.denomination_label(F.when(k % 2 == 0, _of(_CODES, F.floor(k / 2))).otherwise(F.replace(F.initcap("p_name"), F.lit(" "), F.lit("_")))).alias("label"))


_TAG_SQL = """with g as (select o_orderkey as k, case when o_orderkey % 11 = 0 then 'basilica' when o_orderkey % 11 = 1 then 'other' end as ct, ['church', 'chapel', 'mosque', null, 'house'][o_orderkey % 5 + 1] as b, o_orderkey % 7 = 0 as shrine, o_orderkey % 13 = 0 as monastery, o_orderkey % 3 = 0 as orthodox,
 ['Crkva', 'Kapela', 'Sinagoga', null][o_orderkey % 4 + 1] as w, ['christian', 'muslim', null, ' '][o_orderkey // 2 % 4 + 1] as f from orders),
n as (select *, case w when 'Crkva' then 'crkva' when 'Kapela' then 'kapela' when 'Sinagoga' then 'sinagoga' end as named from g),
x as (select k, f, coalesce(case when ct = 'basilica' then 'bazilika' end, case b when 'chapel' then 'kapela' when 'mosque' then 'dzamija' end, case when shrine then 'poklonac' when monastery then 'samostan' end, case when named = 'crkva' and orthodox then 'pravoslavna-crkva' else named end,
 case when orthodox then 'pravoslavna-crkva' end, case when b = 'church' then 'crkva' end, case f when 'muslim' then 'dzamija' when 'christian' then 'crkva' end, 'ostalo') as kind from n)"""


@query(f"{_TAG_SQL} select k as o_orderkey, kind, coalesce(nullif(trim(f), ''), case when kind = 'dzamija' then 'muslim' when kind = 'sinagoga' then 'jewish' when kind <> 'ostalo' then 'christian' end) as religion from x")
def tag_labels(t: Tables) -> DataFrame:
    """Kind and religion by special tags, the name, general tags and the faith, in that order."""
    k = F.col("o_orderkey")
    pairs = {
        "church:type": F.when(k % 11 == 0, "basilica").when(k % 11 == 1, "other"), "building": _of(("church", "chapel", "mosque", None, "house"), k), "historic": F.when(k % 7 == 0, "wayside_shrine"), "amenity": F.when(k % 13 == 0, "monastery"),
        "denomination": F.when(k % 3 == 0, "serbian_orthodox"), "religion": _of(("christian", "muslim", None, " "), F.floor(k / 2)),
    }
    tags = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(n).alias("key"), c.alias("value")) for n, c in pairs.items())), lambda p: p["value"].isNotNull()))
    word = _of(("Crkva", "Kapela", "Sinagoga", None), k)
    rows = t.orders.select("o_orderkey", tags.alias("tags"), F.when(word.isNotNull(), F.concat_ws(" ", word, F.lit("br."), k)).alias("name"))
    kinds = rows.withColumn("kind", rules.kind(F.col("tags"), F.col("name")))
    return kinds.select("o_orderkey", "kind", rules.religion(F.col("tags"), F.col("kind")).alias("religion"))


_GENITIVES, _NAMED = ("Luke", "Marka", "Ane", "Ivana", "Petra", "Nikole"), ("Luka", "Marko", "Ana", "Ivan", "Petar", "Nikola")


@query(f"""with n as (select s_suppkey, {_sql_of(_NAMED, 's_suppkey')} as saint, s_suppkey % 3 as form from supplier) select s_suppkey, 'sv. ' || saint as dedication, 'sv ' || lower(saint) as head from n""")
def saint_labels(t: Tables) -> DataFrame:
    """Saints in the genitive, after several types and marks and before a place, in the nominative."""
    k = F.col("s_suppkey")
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    start = F.element_at(F.array(F.lit("Crkva sv. "), F.lit("KAPELA SVETOG "), F.lit("Župa sv. ")), (k % 3 + 1).cast("int"))
    saint = _of(_GENITIVES, k)
    name = F.concat(start, F.when(k % 3 == 1, F.upper(saint)).otherwise(saint), F.when(k % 2 == 0, F.concat(F.lit(", "), "n_name")).otherwise(F.concat(F.lit(" u "), "n_name")))
    return rows.select("s_suppkey", rules.dedication(name).alias("dedication"), rules.dedication_head(name).alias("head"))


@query("select p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') as short from part")
def parish_short_names(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.short_name(F.concat(_of(("ŽUPA ", " župa  "), F.col("p_partkey")), F.upper("p_name"))).alias("short"))


@query("""select p_partkey, case p_partkey % 4 when 0 then 'https://hr.wikipedia.org/wiki/' || replace(p_name, ' ', '_') when 1 then 'http://x.org/' || p_name end as url from part""")
def wiki_links(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    value = F.when(k % 4 == 0, F.concat(F.lit("hr:"), "p_name")).when(k % 4 == 1, F.concat(F.lit("http://x.org/"), "p_name")).when(k % 4 == 2, F.col("p_name"))
    return t.part.select("p_partkey", text.wikipedia_url(value).alias("url"))


@query("""select o_orderkey, case when o_orderkey % 5 < 4 then ((o_orderkey % 90) || '.' || (o_orderkey % 7))::double end as lat, case when o_orderkey % 5 < 4 then ('-' || (o_orderkey % 180) || '.' || (o_orderkey % 9))::double end as lng from orders""")
def points_read(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    lat, lng = F.concat(k % 90, F.lit("."), k % 7), F.concat(F.lit("-"), k % 180, F.lit("."), k % 9)
    shape = F.when(k % 5 < 2, F.concat(F.lit("Point("), lng, F.lit(" "), lat, F.lit(")"))).when(k % 5 < 4, F.concat(F.lit("POINT ( "), lng, F.lit("  "), lat, F.lit(" )"))).otherwise(F.concat(F.lit("Line("), lng, F.lit(" "), lat, F.lit(")")))
    point = text.wkt_point(shape)
    return t.orders.select("o_orderkey", point["lat"].alias("lat"), point["lng"].alias("lng"))


@query("""with n as (select p_partkey as k, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') as core, case when p_partkey % 3 > 0 then p_brand else '' end as town, case when p_partkey % 2 > 0 then p_type else '' end as street, p_partkey % 5 > 0 as parish from part)
select k as p_partkey, case when town = '' then '' else array_to_string(list_filter([case when street <> '' then case when parish then 'Župa ' else '' end || core || ', ' || street || ', ' || town end, case when parish then 'Župa ' else '' end || core || ', ' || town, case when parish then 'Crkva ' || core || ', ' || town end], lambda x: x is not null), '|') end as ladder from n""")
def name_ladders(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    name = F.concat(F.when(k % 5 > 0, "ŽUPA ").otherwise(""), F.upper("p_name"))
    return t.part.select("p_partkey", F.array_join(text.query_ladder(name, F.when(k % 3 > 0, F.concat(F.lit(" "), "p_brand")), F.when(k % 2 > 0, F.col("p_type"))), "|").alias("ladder"))
