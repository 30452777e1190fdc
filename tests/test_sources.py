import json

from waymark.operators.merge import EXISTING
from waymark.sources import readers, sinks
from waymark.streaming import incremental


def put(folder, name, data):
    path = folder / name
    path.write_text(json.dumps(data), encoding="utf-8")
    return str(path)


def test_elements_to_buildings(spark, tmp_path):
    tags = {"name": "", "official_name": "Crkva sv. Ane", "alt_name": "Sv. Ana", "amenity": "place_of_worship", "addr:street": "Trg", "addr:housenumber": "1", "addr:city": "Zadar", "wikipedia": "hr:Sv. Ana", "contact:phone": "1"}
    path = put(tmp_path, "a.json", {"elements": [{"type": "way", "id": 5, "center": {"lat": 44.1, "lon": 15.2}, "tags": tags}, {"type": "node", "id": 6, "lat": 44.0, "lon": 15.0, "tags": {"historic": "wayside_shrine"}}, {"type": "node", "id": 7, "lat": 1.0, "lon": 1.0, "tags": {"shop": "x"}}]})
    rows = {r.osm_id: r for r in readers.buildings(readers.sacral_elements(readers.elements(spark, path))).collect()}
    assert set(rows) == {"w5", "n6"}
    a = rows["w5"]
    assert (a.name, a.city, a.address, a.lat, a.phone, a.dedication, a.wikipedia, a.slug) == ("Crkva sv. Ane", "Zadar", "Trg 1, Zadar", 44.1, "1", "sv. Ana", "https://hr.wikipedia.org/wiki/Sv._Ana", "sv-ane-zadar-w5")
    assert rows["n6"].name == "Poklonac"
    names = readers.aliases(readers.buildings(readers.sacral_elements(readers.elements(spark, path)))).collect()
    assert [(r.osm_id, r.alias, r.source) for r in names] == [("w5", "Sv. Ana", "alt_name")]


def test_registers(spark, tmp_path):
    path = put(tmp_path, "r.json", [{"NAZIV": "ŽUPA SV. ANE", "SJEDISTE": "Zadar, Trg 1", "OIB": "", "SBT_ID": 12, "STATUS": "AKTIVAN", "DATUM_UPISA": "2003-01-02T00:00", "BISKUPIJA_NADBISKUPIJA": "Z", "EVIDENCIJSKI_BROJ": "1", "SLUZBA_OSOBE": "x"}, {"NAZIV": " "}])
    row = readers.registry(readers.dataset(spark, path, "NAZIV string, SJEDISTE string, OIB string, SBT_ID bigint, STATUS string, DATUM_UPISA string, BISKUPIJA_NADBISKUPIJA string, EVIDENCIJSKI_BROJ string, SLUZBA_OSOBE string")).collect()
    assert len(row) == 1 and (row[0].kind, row[0].city, row[0].address, row[0].slug, row[0].registered_at, row[0].oib, row[0].short_name) == ("zupa", "Zadar", "Trg 1", "sv-ane-zadar-12", "2003-01-02", None, "sv. Ane")
    path = put(tmp_path, "h.json", [{"id": 3, "Klasifikacija": " sakralna  graditeljska baština ", "Naziv": " Crkva \n sv. Ane ", "Mjesto_smjestaja": "Zadar"}, {"id": 4, "Klasifikacija": "ostalo", "Naziv": "x"}])
    row = readers.heritage(readers.dataset(spark, path, "id bigint, Klasifikacija string, Oznaka_dobra string, Naziv string, Mjesto_smjestaja string, Opcina_grad string, Zupanija string, Pravni_status string, Vrijeme_nastanka string, Opis_dobra string")).collect()
    assert [(r.heritage_id, r.name, r.settlement, r.municipality) for r in row] == [("ID-3", "Crkva sv. Ane", "Zadar", None)]


def test_bindings_places_features(spark, tmp_path):
    v = lambda **k: {a: {"value": b} for a, b in k.items()}
    path = put(tmp_path, "b.json", {"results": {"bindings": [v(item="http://x/entity/Q1", itemLabel="", coord="Point(16 45)", inception="1800-01-01"), v(item="http://x/entity/Q1", itemLabel="Crkva", image="http://i")]}})
    row = readers.items(readers.bindings(spark, path)).collect()
    assert [(r.qid, r.name, r.lat, r.image, r.year_built) for r in row] == [("Q1", "Crkva", 45.0, "https://i", "1800")]
    found = [{"id": "p", "displayName": {"text": "Crkva"}, "formattedAddress": "Zadar, Hrvatska", "location": {"latitude": 44.1, "longitude": 15.2}, "types": ["church"], "addressComponents": [{"types": ["locality"], "longText": "Zadar"}, {"types": ["postal_code"], "longText": "23000"}, {"types": ["administrative_area_level_1"], "longText": "Z"}]}, {"id": "q", "formattedAddress": "Mostar, Bosna i Hercegovina", "location": {"latitude": 43.3, "longitude": 17.8}, "types": ["church"]}]
    row = readers.places(spark, put(tmp_path, "p.json", {"places": found})).collect()
    assert [(r.place_id, r.city, r.county, r.postal_code, r.is_sacral) for r in row] == [("p", "Zadar", "Z", "23000", True)]
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    shapes = [{"geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": {"name": "A", "stanovnistvo": 5}}, {"geometry": {"type": "Point", "coordinates": [0, 0]}, "properties": {"name": "B"}}, {"geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}, "properties": {"name": "C"}}]
    row = readers.features(spark, put(tmp_path, "f.json", {"features": shapes})).orderBy("idx").collect()
    assert [(r.idx, r.name, len(r.polygons), r.population) for r in row] == [(0, "A", 1, 5), (2, "C", 2, 0)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", "", 0, 0, 44.12345678, 15.0, '["osm"]'), (2, None, "x", 1, 2, None, None, "bad")], "id int, name string, note string, is_parish_church int, church_count int, lat double, lng double, source string")
    n = sinks.write_geojson(sinks.point_features(df), str(tmp_path / "a.geojson"))
    out = json.loads((tmp_path / "a.geojson").read_text(encoding="utf-8"))
    assert n == 1 and out["features"][0]["geometry"]["coordinates"] == [15.0, 44.123457]
    assert out["features"][0]["properties"] == {"id": 1, "name": "a,b", "church_count": 0, "source": ["osm"]}
    assert sinks.write_geojson(sinks.point_features(df.where("false")), str(tmp_path / "b.geojson")) == 0 and not (tmp_path / "b.geojson").exists()
    assert sinks.write_bom_csv(df.select("id", "name").orderBy("id"), str(tmp_path / "a.csv"), {"name": "naziv"}) == 2
    assert (tmp_path / "a.csv").read_bytes() == b'\xef\xbb\xbfid,naziv\r\n1,"a,b"\r\n2,\r\n'
    sinks.write_bom_csv(df.where("false"), str(tmp_path / "c.csv"))
    assert (tmp_path / "c.csv").read_bytes() == b"\xef\xbb\xbf"
    docs = df.selectExpr("'crkve' as route", "id", "name")
    sinks.write_documents(docs, str(tmp_path / "docs"))
    sinks.write_documents(docs.where("id = 1"), str(tmp_path / "docs"))
    assert spark.read.json(str(tmp_path / "docs")).count() == 1
    assert sorted(r.url for r in sinks.sitemap("https://x/", ["/"], ("a", spark.createDataFrame([("b&c",)], "slug string"))).collect()) == ["https://x/", "https://x/a/b&amp;c"]
    assert sinks.manifest(spark.createDataFrame([(3,)], "n int")).columns == ["schema_version", "generated_at", "n"]
    assert readers.landing_name("q") == readers.landing_name("q") != readers.landing_name("r")


def test_stream_merges_each_record_once(spark, tmp_path):
    landed, table, mark = (tmp_path / n for n in ("in", "table", "mark"))
    landed.mkdir()
    schema = "id bigint, name string, city string"

    def run():
        stream = spark.readStream.schema(schema + ", seq int").json(str(landed))
        incremental.merge_stream(stream, str(table), schema, ["id"], "seq", str(mark), {"city": EXISTING}).awaitTermination()
        return {r.id: (r.name, r.city) for r in incremental.latest(spark, str(table), schema).collect()}

    (landed / "1.json").write_text('{"id":1,"name":"a","city":"x","seq":1}\n{"id":1,"name":"b","city":"y","seq":2}\n{"id":2,"name":"c","seq":1}\n')
    assert run() == {1: ("b", "y"), 2: ("c", None)}
    (landed / "2.json").write_text('{"id":1,"name":null,"city":"z","seq":3}\n{"id":3,"name":"d","seq":1}\n')
    assert run() == {1: ("b", "y"), 2: ("c", None), 3: ("d", None)}
    assert run() == {1: ("b", "y"), 2: ("c", None), 3: ("d", None)}
    (landed / "3.json").write_text('{"id":4,"name":"e","seq":1}\n')
    assert run() == {1: ("b", "y"), 2: ("c", None), 3: ("d", None), 4: ("e", None)}
    # the last batch wrote the one bucket of its key
    assert len(list(table.glob("version=00000002/bucket=*"))) == 1
    for n in range(4, 8):
        (landed / f"{n}.json").write_text(f'{{"id":1,"name":"n{n}","seq":{n}}}\n')
        assert run()[1] == (f"n{n}", "y")
    first = [p.parent.name for p in sorted(table.glob("version=*/bucket=*")) if "00000006" in {q.parent.name.split("=")[1] for q in table.glob(f"version=*/{p.name}")}]
    assert first == ["version=00000005", "version=00000006"]
