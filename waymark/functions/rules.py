"""Ordered rule tables as chained CASE expressions: the first rule that matches decides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as tx
from .binding import let

# Patterns by priority. All are matched without case, with Unicode classes.
_BDM = r"(?:blažen\w*\s+djevic\w*\s+marij\w*|b\.?\s*d\.?\s*marij\w*|bdm|marijin\w*|gospin\w*)"
_PRESV = r"(?:presv\.?|presvet\w*)"
_BEZGR = r"(?:bezgr\.?|bezgrešn\w*|bezgresn\w*)"
# Labels of mysteries by pattern, first match first.
MYSTERIES = (
    (rf"uznesenj\w*\s+{_BDM}|{_BDM}\s+uznesenj\w*", "Uznesenje BDM"),
    (r"velik\w*\s+gosp[aoe]\w*", "Velika Gospa"),
    (rf"pohod\w*\s+{_BDM}|pohođenj\w*\s*{_BDM}?|pohodenj\w*\s*{_BDM}?", "Pohod BDM"),
    (rf"rođenj\w*\s+{_BDM}|rodenj\w*\s+{_BDM}", "Rođenje BDM"),
    (rf"{_BEZGR}\s+začeć\w*|{_BEZGR}\s+zaceć\w*", "Bezgrešno začeće BDM"),
    (rf"{_BEZGR}\s+srca?\s+{_BDM}", "Bezgrešno Srce Marijino"),
    (r"navještenj\w*|navjestenj\w*|blagovijest", "Navještenje Gospodnje"),
    (rf"(gospe|gospa|{_BDM})\s+karmelsk\w*|karmelsk\w*\s+gospe", "Gospa Karmelska"),
    (rf"{_PRESV}\s+trojstv\w*", "Presveto Trojstvo"),
    (rf"{_PRESV}\s+srca?\s+isusov\w*|srca?\s+isusov\w*", "Presveto Srce Isusovo"),
    (rf"preslavn\w*\s+imen\w*\s+{_BDM}|imen\w*\s+{_BDM}", "Ime Marijino"),
    (rf"žalosn\w*\s+{_BDM}|{_BDM}\s+žalosn\w*", "Žalosna Gospa"),
    (r"majk\w*\s+božj\w*|gospa\s+od|gospe\s+od|gospa\s+|gospe\s+|marij\w*\s+pomoćnic\w*", "Majka Božja"),
    (r"tijel\w*\s+i\s+krvi\s+kristov\w*|tijelov\w*", "Tijelovo"),
    (r"(uzvišenj\w*\s+)?(sv\.?|svet\w*)\s+križ\w*", "Sveti Križ"),
    (r"duh\w*\s+svet\w*|(sv\.?|svet\w*)\s+duh\w*", "Duh Sveti"),
    (r"krist\w*\s+kralj\w*", "Krist Kralj"),
    (r"uskrsnuć\w*\s+isusov\w*|uskrsnuc\w*\s+isusov\w*", "Uskrsnuće Isusovo"),
    (r"svih\s+svetih", "Svi Sveti"),
    (r"pokoj?\w*\s+duš\w*|dušn\w*\s+dan", "Duše u čistilištu"),
)
# The saint's mark, words after which a place follows, and locatives.
SAINT_MARK = r"\b(?:sv\.|sv\b|svet[iaoe]?[gm]?a?\b|svetih\b|bl\.|bl\b|blažen[iaoe]?[gm]?a?\b)\.?\s*"
PLACE_AFTER = r"\s*[,(]|\s+u\s+|\s+na\s+|\s+kod\s+|\s+pri\s+|\s+–\s+|\s+-\s+"
LOCATIVES = ("u", "na", "kod", "iz")
# saints' names in the genitive and what they are in the nominative.
NOMINATIVES = {
    "marka": "Marko", "ivana": "Ivan", "petra": "Petar", "pavla": "Pavao", "jurja": "Juraj", "mihovila": "Mihovil", "mihaela": "Mihael", "nikole": "Nikola", "antuna": "Antun", "josipa": "Josip",
    "franje": "Franjo", "roka": "Rok", "vida": "Vid", "duje": "Duje", "dujma": "Dujam", "blaža": "Blaž", "martina": "Martin", "jakova": "Jakov", "filipa": "Filip", "kuzme": "Kuzma", "damjana": "Damjan",
    "stjepana": "Stjepan", "lovre": "Lovro", "lovrenca": "Lovrenac", "andrije": "Andrija", "barbare": "Barbara", "katarine": "Katarina", "ane": "Ana", "marije": "Marija", "magdalene": "Magdalena",
    "lucije": "Lucija", "agate": "Agata", "klare": "Klara", "cecilije": "Cecilija", "elizabete": "Elizabeta", "terezije": "Terezija", "helene": "Helena", "margarete": "Margareta", "doroteje": "Doroteja", "jelene": "Jelena",
    "leopolda": "Leopold", "florijana": "Florijan", "fabijana": "Fabijan", "sebastijana": "Sebastijan", "vinka": "Vinko", "dominika": "Dominik", "benedikta": "Benedikt", "bartola": "Bartol", "šimuna": "Šimun",
    "tome": "Toma", "matije": "Matija", "mateja": "Matej", "luke": "Luka", "grgura": "Grgur", "jeronima": "Jeronim", "ambrozija": "Ambrozije", "augustina": "Augustin", "alojzija": "Alojzije", "ignacija": "Ignacije",
    "križa": "Križ", "duha": "Duh", "obitelji": "Obitelj",
}
# Epithets likewise.
EPITHETS = {
    "krstitelja": "Krstitelj", "evanđelista": "Evanđelist", "evanđeliste": "Evanđelist", "evandelista": "Evanđelist", "apostola": "Apostol", "biskupa": "Biskup", "mučenika": "Mučenik", "mucenika": "Mučenik",
    "prvomučenika": "Prvomučenik", "opata": "Opat", "kralja": "Kralj", "arkanđela": "Arkanđel", "arkandela": "Arkanđel", "djevice": "Djevica", "udovice": "Udovica", "pustinjaka": "Pustinjak",
    "ispovjedatelja": "Ispovjedatelj", "padovanskog": "Padovanski", "asiškog": "Asiški", "asiskog": "Asiški", "sijenske": "Sijenska", "aleksandrijske": "Aleksandrijska", "labudske": "Labudska", "bosanske": "Bosanska",
}
# Kinds of buildings.
KINDS = ("katedrala", "bazilika", "svetiste", "samostan", "dzamija", "sinagoga", "pravoslavna-crkva", "kapela", "poklonac", "crkva", "ostalo")
MINOR_KINDS = ("poklonac",)
# Kinds by words of a name, first match first.
NAME_RULES = (
    (r"\bkatedral|\bstolna\s+crkva|\bprvostolnic", "katedrala"),
    (r"\bbazilik", "bazilika"),
    (r"\bsvetišt|\bsvetist|\bmarijansk\w*\s+svet", "svetiste"),
    (r"\bsamostan|\bopatij|\bmanastir|\bfranjevačk\w*\s+samost", "samostan"),
    (r"\bdžamij|\bdzamij|\bmesdžid|\bislamsk\w*\s+centar", "dzamija"),
    (r"\bsinagog", "sinagoga"),
    (r"\bpoklonac|\bpil\b|\braspelo|\bkalvarij|\bkip\s+sv", "poklonac"),
    (r"\bkapel|\bkapelic", "kapela"),
    (r"\bcrkv|\bhram\b", "crkva"),
)
# Kinds, faiths and labels by tags.
BUILDING_KINDS = {"cathedral": "katedrala", "basilica": "bazilika", "chapel": "kapela", "mosque": "dzamija", "synagogue": "sinagoga", "monastery": "samostan", "church": "crkva", "temple": "crkva", "shrine": "poklonac", "wayside_shrine": "poklonac"}
GENERIC_BUILDINGS = ("church", "temple")
CHURCH_TYPES = {"cathedral": "katedrala", "basilica": "bazilika", "chapel": "kapela", "shrine": "svetiste", "monastery": "samostan"}
ORTHODOX = ("serbian_orthodox", "orthodox", "eastern_orthodox", "macedonian_orthodox", "russian_orthodox", "bulgarian_orthodox", "romanian_orthodox")
RELIGION_KINDS = {"muslim": "dzamija", "jewish": "sinagoga", "christian": "crkva"}
CHRISTIAN_KINDS = ("crkva", "kapela", "katedrala", "bazilika", "svetiste", "samostan", "pravoslavna-crkva", "poklonac")
# Labels of denominations.
DENOMINATIONS = {
    "roman_catholic": "rimokatolička", "catholic": "katolička", "greek_catholic": "grkokatolička", "serbian_orthodox": "srpska pravoslavna", "orthodox": "pravoslavna", "eastern_orthodox": "pravoslavna",
    "macedonian_orthodox": "makedonska pravoslavna", "protestant": "protestantska", "evangelical": "evangelička", "lutheran": "luteranska", "reformed": "reformirana", "calvinist": "kalvinistička", "baptist": "baptistička",
    "pentecostal": "pentekostna", "adventist": "adventistička", "jehovahs_witness": "Jehovini svjedoci", "sunni": "sunitska", "jewish": "židovska", "old_catholic": "starokatolička",
}
# Kinds of legal persons in the register, first match first.
REGISTRY_RULES = (
    (r"^\s*ŽUPA\b", "zupa"),
    (r"^\s*(NAD)?BISKUPIJA\b|\bNADBISKUPIJA\s*$|\bBISKUPIJA\s*$", "biskupija"),
    (r"\bSAMOSTAN|\bREZIDENCIJA\b|\bKARMEL\b|\bOPATIJA\b", "samostan"),
    (r"\bPROVINCIJA\b|\bDRUŽBA\b|\bKUSTODIJA\b|\bRED\b", "provincija"),
    (r"\bCARITAS\b", "caritas"),
    (r"\bSVETIŠTE\b", "svetiste"),
)
# Faiths of communities, first match first.
COMMUNITY_RULES = (
    (r"SRPSKA\s+PRAVOSLAVNA", ("christian", "serbian_orthodox")), (r"MAKEDONSKA\s+PRAVOSLAVNA", ("christian", "macedonian_orthodox")), (r"BUGARSKA\s+PRAVOSLAVNA", ("christian", "bulgarian_orthodox")),
    (r"PRAVOSLAVN", ("christian", "orthodox")), (r"ISLAMSK|MUSLIMANSK", ("muslim", "sunni")), (r"ŽIDOVSK|JEVREJSK|IZRAELITSK", ("jewish", "jewish")), (r"EVANGELIČK|LUTERANSK", ("christian", "evangelical")),
    (r"REFORM|KALVIN", ("christian", "reformed")), (r"BAPTIST", ("christian", "baptist")), (r"ADVENTIST", ("christian", "adventist")), (r"PENTEKOST|DUHOVN\w*\s+CRKV", ("christian", "pentecostal")),
    (r"JEHOVIN", ("christian", "jehovahs_witness")), (r"GRKOKATOLIČK|KRIŽEVAČK", ("christian", "greek_catholic")), (r"STAROKATOLIČK", ("christian", "old_catholic")), (r"METODIST", ("christian", "methodist")),
    (r"KRIST|CRKV|EVANĐEO|EVANDEO", ("christian", "protestant")), (r"BUDIST", ("buddhist", "buddhist")), (r"HINDU|VAIŠNAV|VAISNAV", ("hindu", "hindu")),
)
# Kinds of organisational forms, first match first.
ORGANISATION_RULES = (
    (r"\bPAROHIJA\b|\bCRKVEN\w*\s+OPĆIN\w*\b.*PRAVOSLAV", "parohija"),
    (r"\bDŽEMAT\b|\bMEDŽLIS\b|\bMEDZLIS\b", "dzemat"),
    (r"\bCRKVEN\w*\s+OPĆIN|\bŽUPA\b|\bZBOR\b|\bOPĆINA\b", "crkvena-opcina"),
    (r"\bEPARHIJA\b|\bMITROPOLIJA\b", "eparhija"),
    (r"\bMANASTIR\b|\bSAMOSTAN\b", "samostan"),
)
# Dedications that are too common to decide.
GENERIC_DEDICATIONS = ("majka bozja",)
# Classes of error messages.
ERROR_RULES = (("ip address restriction", "ip-restricted"), ("api_key_ip_address_blocked", "ip-restricted"), ("referer", "referer-restricted"), ("has not been used", "api-disabled"), ("disabled", "api-disabled"), ("not enabled", "api-disabled"))


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(f"(?iU){pattern}")


def first_match(c: Column, rules: Sequence[tuple[str, object]], default: object = None) -> Column:
    """The value of the first rule whose pattern is found; values are literals or structs of literals."""

    def value(v: object) -> Column:
        return F.struct(*(F.lit(x).alias(f"c{k}") for k, x in enumerate(v))) if isinstance(v, tuple) else F.lit(v)

    out = None
    for pattern, v in rules:
        hit = matches(c, pattern)
        out = F.when(hit, value(v)) if out is None else out.when(hit, value(v))
    return out if default is None else out.otherwise(value(default))


def lookup(c: Column, table: Mapping[str, str]) -> Column:
    """table[c], null where there is none."""
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.try_element_at(pairs, c)


def _tag(tags: Column, name: str) -> Column:
    return F.lower(F.coalesce(F.try_element_at(tags, F.lit(name)), F.lit("")))


def kind(tags: Column, name: Column) -> Column:
    """What a building is: special tags, then its name, then general tags, then its religion."""
    church, building, faith = _tag(tags, "church:type"), _tag(tags, "building"), _tag(tags, "religion")
    historic, amenity = F.try_element_at(tags, F.lit("historic")), F.try_element_at(tags, F.lit("amenity"))
    orthodox = _tag(tags, "denomination").isin(*ORTHODOX)
    named = first_match(name, NAME_RULES)
    return F.coalesce(
        lookup(church, CHURCH_TYPES),
        F.when(~building.isin(*GENERIC_BUILDINGS), lookup(building, BUILDING_KINDS)),
        F.when(historic == "wayside_shrine", "poklonac").when(amenity == "monastery", "samostan"),
        F.when((named == "crkva") & orthodox, "pravoslavna-crkva").otherwise(named),
        F.when(orthodox, "pravoslavna-crkva"),
        lookup(building, BUILDING_KINDS),
        lookup(faith, RELIGION_KINDS),
        F.lit("ostalo"),
    )


def kind_of_name(name: Column) -> Column:
    return first_match(name, NAME_RULES, "ostalo")


def religion(tags: Column, kind_: Column) -> Column:
    tagged = tx.empty_to_null(F.trim(_tag(tags, "religion")))
    return F.coalesce(tagged, F.when(kind_ == "dzamija", "muslim").when(kind_ == "sinagoga", "jewish").when(kind_.isin(*CHRISTIAN_KINDS), "christian"))


def denomination_label(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(tx.empty_to_null(c).isNotNull(), F.coalesce(lookup(low, DENOMINATIONS), F.replace(low, F.lit("_"), F.lit(" "))))


def registry_kind(name: Column) -> Column:
    return first_match(F.coalesce(name, F.lit("")), REGISTRY_RULES, "ostalo")


def organisation_kind(name: Column) -> Column:
    return first_match(F.coalesce(name, F.lit("")), ORGANISATION_RULES, "ostalo")


def community_faith(community: Column, own: Column | None = None) -> Column:
    """struct(c0 religion, c1 denomination) by the community's name, else by the own one; null if neither tells."""
    found = first_match(community, COMMUNITY_RULES)
    return found if own is None else F.coalesce(found, first_match(own, COMMUNITY_RULES))


def diocese_kind(name: Column) -> Column:
    return F.when(F.contains(F.lower(name), F.lit("nadbiskupija")), "nadbiskupija").otherwise("biskupija")


def error_class(message: Column) -> Column:
    low, out = F.lower(F.coalesce(message, F.lit(""))), None
    for part, label in ERROR_RULES:
        hit = F.contains(low, F.lit(part))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise("unknown")


def _bare(w: Column) -> Column:
    return F.regexp_replace(F.lower(w), r"^[.,]+|[.,]+$", "")


def _nominative(w: Column) -> Column:
    folded = {"".join(tx.PLAIN[tx.ACCENTED.index(c)] if c in tx.ACCENTED else c for c in k): v for k, v in reversed(NOMINATIVES.items())}
    return F.coalesce(lookup(_bare(w), NOMINATIVES), lookup(tx.strip_diacritics(_bare(w)), folded), tx.capitalize(w))


def _epithet(w: Column) -> Column:
    return F.coalesce(lookup(_bare(w), EPITHETS), F.when((w == F.upper(w)) & (w != F.lower(w)), tx.capitalize(w)).otherwise(w))


def _saint(core: Column) -> Column:
    """'sv. Name Epithet' from the words after the saint's mark, up to a locative."""
    rest = F.regexp_replace(F.regexp_extract(core, rf"(?iUs){SAINT_MARK}(.*)$", 1), r"^[ .,\-]+|[ .,\-]+$", "")
    words = F.slice(F.filter(F.split(rest, r"(?U)\s+"), lambda w: w != ""), 1, 4)

    def up_to_place(ws: Column) -> Column:
        stop = F.array_position(F.transform(ws, lambda w: F.lower(tx.strip_diacritics(w)).isin(*LOCATIVES)), True).cast("int")
        return F.when(stop == 0, ws).otherwise(F.slice(ws, 1, F.greatest(stop - 1, F.lit(0))))

    def label(ws: Column) -> Column:
        named = F.concat_ws(" ", F.concat(F.lit("sv. "), _nominative(F.get(ws, F.lit(0)))), F.transform(F.slice(ws, 2, 4), _epithet))
        return F.when(F.size(ws) > 0, F.trim(F.regexp_replace(named, r"\s+", " ")))

    return let(let(words, up_to_place), label)


def dedication(name: Column) -> Column:
    """The patron or mystery in a name: a mystery's label, 'sv. Name Epithet' in the nominative, or null."""
    core = tx.empty_to_null(F.trim(F.get(F.split(tx.strip_type_prefix(F.trim(name)), f"(?iU){PLACE_AFTER}", 2), F.lit(0))))
    return let(core, lambda c: F.coalesce(first_match(c, MYSTERIES), F.when(matches(c, SAINT_MARK), _saint(c))))


def _key_of(label: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(tx.strip_diacritics(label)), "[^a-z0-9 ]+", ""))


def dedication_key(name: Column) -> Column:
    return _key_of(dedication(name))


def dedication_head(name: Column) -> Column:
    """The key of the saint alone, without epithets; mysteries whole."""
    saint = lambda c: F.concat(F.lit("sv. "), F.substring_index(F.substring(c, 5, 1 << 20), " ", 1))
    return _key_of(let(dedication(name), lambda c: F.when(F.startswith(c, F.lit("sv. ")), saint(c)).otherwise(c)))
