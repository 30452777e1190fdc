import pytest
from pyspark.sql import functions as F

from waymark.functions import rules, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + schema).select("k", *columns).orderBy("k").drop("k").collect()]


#: One case a rule of our tables, then conflicts between rules, saints, and names without a patron.
DEDICATIONS = [
    ("Crkva Velike Gospe", "Velika Gospa"), ("Kapela Pohoda BDM", "Pohod BDM"), ("Crkva Rođenja Blažene Djevice Marije", "Rođenje BDM"), ("ŽUPA BEZGREŠNOG ZAČEĆA BDM", "Bezgrešno začeće BDM"), ("Crkva Bezgrešnog srca Marijina", "Bezgrešno Srce Marijino"),
    ("Kapela Navještenja Gospodnjeg", "Navještenje Gospodnje"), ("Crkva Gospe Karmelske", "Gospa Karmelska"), ("PRESVETO TROJSTVO", "Presveto Trojstvo"), ("ŽUPA SRCA ISUSOVA", "Presveto Srce Isusovo"), ("Crkva Imena Marijina", "Ime Marijino"),
    ("Crkva Žalosne BDM", "Žalosna Gospa"), ("Kapela Majke Božje Lurdske", "Majka Božja"), ("Tijelovska kapela Tijelova", "Tijelovo"), ("Kapela Uzvišenja Svetog Križa", "Sveti Križ"), ("Crkva Svetog Duha", "Duh Sveti"), ("Krist Kralj", "Krist Kralj"),
    ("Kapela Uskrsnuća Isusova", "Uskrsnuće Isusovo"), ("Crkva Svih svetih", "Svi Sveti"), ("Crkva Uznesenja BDM i sv. Luke", "Uznesenje BDM"), ("Crkva Gospe Karmelske i Majke Božje", "Gospa Karmelska"),
    ("Kapela sv. Luke", "sv. Luka"), ("Crkva svete Barbare na brdu", "sv. Barbara"), ("ŽUPA SV. TOME APOSTOLA, KOTAR", "sv. Toma Apostol"), ("Kapela sv. Vinka kod rijeke", "sv. Vinko"), ("sv. Izmišljenog", "sv. Izmišljenog"), ("Samostan", None), ("  ", None), (None, None),
]


def test_dedications(spark):
    got = values(spark, [(n,) for n, _ in DEDICATIONS], "n string", rules.dedication(F.col("n")))
    assert [g for g, in got] == [want for _, want in DEDICATIONS]


def test_dedication_keys(spark):
    names = ["Crkva sv. Jurja", "ŽUPA SV. JURJA, LOVRAN", "Crkva svetog Jurja", "Crkva sv. Petra", "Crkva sv. Pavla", "Crkva sv. Ante", "Crkva sv. Ante Padovanskog", "ŽUPA SV. ANTUNA PADOVANSKOG, ZAGREB", "Crkva sv. Antuna"]
    got = values(spark, [(n,) for n in names], "n string", rules.dedication_key(F.col("n")), rules.dedication_head(F.col("n")))
    key, head = zip(*got, strict=True)
    assert key[0] == key[1] == key[2] and key[3] != key[4] and head[3] != head[4]
    assert head[5] == head[6] and key[5] != key[6] and head[7] == head[8]


def test_slugs(spark):
    rows = [("Crkva sv. Marka", "Zagreb", None), ("ŽUPA SV. ANE", "Osijek", None), ("Crkva sv. Đurđa", "Đakovo", None), ("Crkva sv. Marka", "Zagreb", "w123"), ("", None, None), ("...", None, None), ("Zagreb dom", "Zagreb", None), (None, None, None)]
    got = values(spark, rows, "n string, c string, s string", text.slug(F.col("n"), F.col("c"), F.col("s")))
    assert [g for g, in got] == ["sv-marka-zagreb", "sv-ane-osijek", "sv-durda-dakovo", "sv-marka-zagreb-w123", "crkva", "crkva", "zagreb-dom", "crkva"]


def test_prefix_keys_and_titles(spark):
    got = values(spark, [("Crkva sv. Marka",), ("ŽUPA SV. ANE, OSIJEK",), ("Franjevački samostan",), ("Kapela",)], "n string", text.strip_type_prefix(F.col("n")))
    assert [g for g, in got] == ["sv. Marka", "SV. ANE, OSIJEK", "Franjevački samostan", "Kapela"]
    keys = values(spark, [("Crkva svetog Jurja",), ("Crkva sv. Jurja",), ("Crkva sv. Ane",), ("Kapela svete Ane",)], "n string", text.norm_key(F.col("n")))
    assert keys[0] == keys[1] and keys[2] == keys[3]
    titles = {"BISKUPIJA POREČKA I PULSKA": "Biskupija Porečka i Pulska", "ZAGREBAČKA NADBISKUPIJA": "Zagrebačka Nadbiskupija", "ŽUPA BL. ALOJZIJA STEPINCA": "Župa bl. Alojzija Stepinca", "ŽUPA UZNESENJA BDM": "Župa Uznesenja BDM", "PAPA IVAN XXIII": "Papa Ivan XXIII"}
    got = values(spark, [(k,) for k in titles], "n string", text.title_case(F.col("n")))
    assert [g for g, in got] == list(titles.values())


#: Special tags before names, names before general tags, tags before the religion's kind.
KINDS = [
    ({"church:type": "shrine", "building": "chapel"}, "Crkva", "svetiste"), ({"building": "basilica"}, "Kapela sv. Luke", "bazilika"), ({"building": "temple"}, "Sinagoga", "sinagoga"), ({"building": "temple"}, None, "crkva"),
    ({"historic": "wayside_shrine"}, "Crkva sv. Klare", "poklonac"), ({"amenity": "monastery"}, "Kapela", "samostan"), ({"denomination": "orthodox"}, "Crkva sv. Save", "pravoslavna-crkva"), ({"denomination": "orthodox"}, "Kapela sv. Save", "kapela"),
    ({"denomination": "russian_orthodox"}, None, "pravoslavna-crkva"), ({"religion": "christian"}, "Hram mira", "crkva"), ({"religion": "jewish"}, "Zgrada", "sinagoga"), ({}, "Islamski centar", "dzamija"), ({}, "Stara opatija", "samostan"), ({}, "Raspelo", "poklonac"), ({}, "Kuća", "ostalo"),
]


def test_kinds_and_religions(spark):
    got = values(spark, [(t, n) for t, n, _ in KINDS], "t map<string,string>, n string", rules.kind(F.col("t"), F.col("n")))
    assert [g for g, in got] == [k for *_, k in KINDS]
    rows = [({}, "samostan"), ({}, "dzamija"), ({"religion": "hindu"}, "ostalo"), ({}, "ostalo")]
    assert [g for g, in values(spark, rows, "t map<string,string>, kind string", rules.religion(F.col("t"), F.col("kind")))] == ["christian", "muslim", "hindu", None]
    labels = values(spark, [("roman_catholic",), ("serbian_orthodox",), ("some_new_thing",), (None,)], "d string", rules.denomination_label(F.col("d")))
    assert [g for g, in labels] == ["rimokatolička", "srpska pravoslavna", "some new thing", None]


def test_registry_rules(spark):
    names = ["ŽUPA SV. ANE", "ZAGREBAČKA NADBISKUPIJA", "KAPUCINSKI SAMOSTAN", "DRUŽBA SESTARA", "CARITAS ZAGREB", "SVETIŠTE", "nešto"]
    assert [g for g, in values(spark, [(n,) for n in names], "n string", rules.registry_kind(F.col("n")))] == ["zupa", "biskupija", "samostan", "provincija", "caritas", "svetiste", "ostalo"]
    faith = values(spark, [("Srpska pravoslavna crkva", None), ("x", "MEDŽLIS ISLAMSKE ZAJEDNICE"), ("x", "y")], "c string, o string", rules.community_faith(F.col("c"), F.col("o")))
    assert [tuple(f) if f else None for f, in faith] == [("christian", "serbian_orthodox"), ("muslim", "sunni"), None]


def test_small_functions(spark):
    seats = values(spark, [("Zagreb, Kaptol 31",), ("Split",), ("Pula, Trg, 3",), (None,), ("",)], "s string", text.split_seat(F.col("s")))
    assert [tuple(s) for s, in seats] == [("Kaptol 31", "Zagreb"), (None, "Split"), ("Trg, 3", "Pula"), (None, None), (None, None)]
    point = values(spark, [("Point(16.4 43.5)",), ("nothing",), (None,)], "p string", text.wkt_point(F.col("p")))
    assert [tuple(p) for p, in point] == [(43.5, 16.4), (None, None), (None, None)]
    urls = values(spark, [("hr:Crkva sv. Ane",), ("https://x",), ("abc",), (None,)], "u string", text.wikipedia_url(F.col("u")))
    assert [u for u, in urls] == ["https://hr.wikipedia.org/wiki/Crkva_sv._Ane", "https://x", None, None]
    years = values(spark, [("1901-02-03",), ("-50-01-01",), ("x",)], "d string", text.year_of(F.col("d")))
    assert [y for y, in years] == ["1901", "-50", None]
    words = values(spark, [(n,) for n in (1, 2, 5, 11, 21, 112)], "n int", text.plural(F.col("n"), "a", "b", "c"))
    assert [w for w, in words] == ["a", "b", "c", "c", "a", "c"]
    keys = values(spark, [("Grad Zagreb", "Zagreb", None)], "a string, b string, c string", text.place_keys(F.col("a"), F.col("b"), F.col("c")))
    assert sorted(keys[0][0]) == ["grad zagreb", "zagreb"]
    ladder = values(spark, [("ŽUPA SV. ANE", "Osijek", "Trg 1"), ("ŽUPA SV. ANE", "", "Trg 1")], "n string, c string, a string", text.query_ladder(F.col("n"), F.col("c"), F.col("a")))
    assert ladder[0][0] == ["Župa sv. Ane, Trg 1, Osijek", "Župa sv. Ane, Osijek", "Crkva sv. Ane, Osijek"] and ladder[1][0] == []
    zips = values(spark, [("10 000 Zagreb",), ("1234567",), (None,)], "z string", text.zip_code(F.col("z")))
    assert [z for z, in zips] == ["10000", None, None]
    steps = values(spark, [("Zagrebačka županija", "Trg 1, 10000 Zagreb, Centar, Hrvatska", "Zagreb")], "c string, a string, t string", text.address_ladder(F.col("c"), F.col("a"), F.col("t")))
    assert steps[0][0] == ["Trg 1, 10000 Zagreb, Centar, Hrvatska, Hrvatska", "10000 Zagreb, Centar, Hrvatska", "10000, Hrvatska", "Zagreb, Zagrebačka, Hrvatska", "Zagreb, Hrvatska"]
    assert values(spark, [("a<b & 'c'",)], "x string", text.escape_xml(F.col("x"))) == [("a&lt;b &amp; &apos;c&apos;",)]


@pytest.mark.parametrize("message,label", [("requests blocked: API_KEY_IP_ADDRESS_BLOCKED", "ip-restricted"), ("Requests from referer empty", "referer-restricted"), ("API has not been used", "api-disabled"), ("other", "unknown")])
def test_error_classes(spark, message, label):
    assert values(spark, [(message,)], "m string", rules.error_class(F.col("m"))) == [(label,)]


def test_house_numbers_of_five_digits_are_no_zip_codes(spark):
    houses = values(spark, [("Ulica 12345",), ("Ulica 12345, 10 100 Grad",), ("Ulica bb 10000 Zagreb",), ("10 000",), (None,)], "a string", text.address_ladder(F.lit(""), F.col("a"), F.lit("")))
    assert [[x.split(",")[0] for x in steps if x[0].isdigit()] for steps, in houses] == [[], ["10100"], ["10000"], ["10 000", "10000"], []]
