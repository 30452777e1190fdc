"""Text normalisation as Column expressions: all run inside the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters and what they fold to. đ has no decomposition and is mapped like the rest.
ACCENTED = "ÀÁÂÃÄÅàáâãäåÇçÈÉÊËèéêëÌÍÎÏìíîïÑñÒÓÔÕÖòóôõöÙÚÛÜùúûüÝýÿĀāĂăĄąĆćČčĎďĐđĒēĘęĚěĞğĪīĹĺĽľŁłŃńŇňŌōŐőŔŕŘřŚśŞşŠšŢţŤťŪūŮůŰűŹźŻżŽž"
PLAIN = "AAAAAAaaaaaaCcEEEEeeeeIIIIiiiiNnOOOOOoooooUUUUuuuuYyyAaAaAaCcCcDdDdEeEeEeGgIiLlLlLlNnNnOoOoRrRrSsSsSsTtTtUuUuUuZzZzZz"
# What is taken off the front of a name, and the saint's marks that are one.
TYPE_PREFIX = (
    r"^\s*(rimokatolička\s+|grkokatolička\s+|pravoslavna\s+|srpska\s+pravoslavna\s+)?"
    r"(župa|zupa|crkva|crkve|kapela|katedrala|bazilika|svetište|svetiste|samostan|opatija|hram|džamija|dzamija|sinagoga|poklonac|pil)\b\.?\s*"
)
SAINT_FORMS = r"\b(sv\.?|svetog|svetoga|svete|sveti|sveta|svetom|svetih|st\.)\b\.?"
UPPER_WORDS = ("BDM", "OFM", "OP", "SJ", "OSB", "OCD", "SDB", "HR", "RH")
SMALL_WORDS = ("i", "u", "na", "od", "za", "sa", "s", "iz", "te", "ili")
SAINT_ABBREVIATIONS = ("SV.", "SV", "BL.", "BL")

PREFIX_PATTERN = f"(?iU){TYPE_PREFIX}"


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _plain(text: str) -> str:
    """Compatibility decomposition without its combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _letters() -> tuple[str, str, str]:
    """Characters of the basic plane that decompose to one letter, those letters, and characters that are marks alone."""
    plain = {chr(k): _plain(chr(k)) for k in range(0x80, 0x10000) if not 0xD800 <= k < 0xE000 and chr(k) not in ACCENTED}
    one = {c: p for c, p in plain.items() if len(p) == 1 and p != c}
    return "".join(one), "".join(one.values()), "".join(c for c, p in plain.items() if not p)


# By rule: Vietnamese, Greek, Cyrillic and all other letters that decompose, beside the fixed ones; marks are last and drop out.
_FROM, _TO, _MARKS = _letters()
FOLDED_FROM, FOLDED_TO = ACCENTED + _FROM + _MARKS, PLAIN + _TO


def strip_diacritics(c: Column) -> Column:
    """Letters without their marks, in the JVM; what decomposes to several letters stays (see decomposed)."""
    return F.translate(c, FOLDED_FROM, FOLDED_TO)


def decomposed(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the column without diacritics, ligatures and other compatibility characters in full.

    Only distinct texts that the JVM's fold leaves with characters beyond ASCII reach Python, and meet the rows again by a join.
    """
    folded = df.withColumn(out, strip_diacritics(F.col(column)))
    rest = folded.where(F.col(out).rlike(r"[^\x00-\x7F]")).select(F.col(out).alias("_text")).distinct()
    full = F.pandas_udf(lambda texts: texts.map(_plain), "string")
    known = rest.select("_text", full("_text").alias("_full"))
    return folded.join(known, F.col(out) == F.col("_text"), "left").withColumn(out, F.coalesce("_full", out)).drop("_text", "_full")


def strip_type_prefix(c: Column) -> Column:
    """Takes one leading type noun off; a name of nothing else stays as it is."""
    text = F.coalesce(c, F.lit(""))
    return F.coalesce(empty_to_null(F.trim(F.regexp_replace(text, PREFIX_PATTERN, ""))), F.trim(text))


def alnum_key(c: Column, gap: str = " ") -> Column:
    """Folded, lower-case words of [a-z0-9], joined by gap."""
    return F.trim(F.regexp_replace(F.lower(strip_diacritics(c)), "[^a-z0-9]+", " ")) if gap == " " else F.regexp_replace(alnum_key(c), " ", gap)


def slug(name: Column, place: Column | None = None, suffix: Column | None = None, default: str = "crkva") -> Column:
    """name, then the place unless the name contains it, then the suffix."""
    base = F.trim(F.lower(strip_diacritics(strip_type_prefix(name))))
    if place is not None:
        town = F.trim(F.lower(strip_diacritics(F.coalesce(place, F.lit("")))))
        base = F.when((town != "") & ~F.contains(base, town), F.concat(base, F.lit("-"), town)).otherwise(base)
    if suffix is not None:
        base = F.when(F.coalesce(suffix, F.lit("")) != "", F.concat(base, F.lit("-"), F.lower(strip_diacritics(suffix)))).otherwise(base)
    return F.coalesce(empty_to_null(F.regexp_replace(F.regexp_replace(base, "[^a-z0-9]+", "-"), "^-+|-+$", "")), F.lit(default))


def norm_key(name: Column, place: Column | None = None) -> Column:
    """Comparison key: no type noun, one form of the saint's mark, words of [a-z0-9]."""
    base = F.lower(strip_diacritics(strip_type_prefix(name)))
    base = F.regexp_replace(base, SAINT_FORMS, " sv ")
    base = F.trim(F.regexp_replace(base, "[^a-z0-9]+", " "))
    if place is not None:
        base = F.trim(F.concat_ws(" ", base, empty_to_null(alnum_key(place))))
    return base


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 20)))


def title_case(c: Column) -> Column:
    """Register capitals to readable case: small connectives, kept acronyms, Roman numerals of two letters and more."""

    def word(w: Column, k: Column) -> Column:
        up = F.upper(w)
        return (
            F.when((k > 0) & F.lower(w).isin(*SMALL_WORDS), F.lower(w))
            .when(up.isin(*UPPER_WORDS) | up.rlike(r"^[IVXLCDM]{2,}\.?$"), up)
            .when(up.isin(*SAINT_ABBREVIATIONS), F.concat(F.lower(F.regexp_replace(w, r"\.$", "")), F.lit(".")))
            .otherwise(capitalize(w))
        )

    words = F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, word), " ")


def place_keys(*parts: Column) -> Column:
    """Distinct folded keys of place names, each also without a leading 'grad'."""
    keys = F.array(*(alnum_key(F.coalesce(p, F.lit(""))) for p in parts))
    both = F.flatten(F.transform(keys, lambda k: F.array(k, F.regexp_replace(k, "^grad ", ""))))
    return F.array_distinct(F.filter(both, lambda k: k != ""))


def fold_key(c: Column) -> Column:
    """The key by which two spellings of a settlement's name are equal."""
    return alnum_key(F.coalesce(c, F.lit("")))


def clean(c: Column) -> Column:
    """White space collapsed; nothing left is null."""
    return empty_to_null(F.trim(F.regexp_replace(c, r"\s+", " ")))


def split_seat(c: Column) -> Column:
    """struct(street, city) of 'city, street ...': the first comma parts them; one part is the city alone."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda p: F.trim(p))
    street = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), ", ")
    return F.struct(empty_to_null(F.trim(street)).alias("street"), empty_to_null(F.get(parts, F.lit(0))).alias("city"))


def search_fold(c: Column) -> Column:
    """The fold of the browse search: case and all accents, đ too."""
    return F.lower(strip_diacritics(F.coalesce(c, F.lit(""))))


def short_name(c: Column) -> Column:
    return title_case(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?iU)^\s*ŽUPA\s+", ""))


def query_ladder(name: Column, city: Column, address: Column) -> Column:
    """Search texts for a legal person, most specific first; none without a city."""
    readable = title_case(name)
    core = strip_type_prefix(readable)
    town, street = F.trim(F.coalesce(city, F.lit(""))), F.trim(F.coalesce(address, F.lit("")))
    texts = F.array(
        F.when((street != "") & (town != ""), F.concat_ws(", ", readable, street, town)),
        F.when(town != "", F.concat_ws(", ", readable, town)),
        F.when((town != "") & (core != "") & (core != readable), F.concat(F.lit("Crkva "), core, F.lit(", "), town)),
    )
    return F.array_distinct(F.filter(texts, lambda q: q.isNotNull()))


def _joined_digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"([0-9])\s+(?=[0-9])", "$1")


def zip_code(c: Column) -> Column:
    """A number of exactly five digits, digits parted by spaces joined first."""
    return empty_to_null(F.regexp_extract(_joined_digits(c), r"(?<![0-9])([0-9]{5})(?![0-9])", 1))


def address_zip(c: Column) -> Column:
    """The zip code of an address: it begins a part or stands before a town's name; a house number of five digits does neither."""
    return empty_to_null(F.regexp_extract(_joined_digits(c), r"(?:(?:^|,)\s*|(?<![0-9])(?=[0-9]{5}\s+\p{L}{2}))([0-9]{5})(?![0-9])", 1))


def address_ladder(county: Column, address: Column, city: Column, country: str = "Hrvatska") -> Column:
    """Geocoder queries from the whole address down to the city."""
    region = F.trim(F.regexp_replace(F.coalesce(county, F.lit("")), " županija", ""))
    street, town = F.trim(F.coalesce(address, F.lit(""))), F.trim(F.coalesce(city, F.lit("")))
    parts = F.filter(F.transform(F.split(street, ","), lambda p: F.trim(p)), lambda p: p != "")
    parts = F.when(F.lower(F.element_at(F.concat(F.array(F.lit("")), parts), -1)) == country.lower(), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    tail = F.when(F.size(parts) >= 3, F.concat_ws(", ", F.slice(parts, -2, 2)))
    code = F.coalesce(address_zip(street), zip_code(town))
    out = F.array(F.when(street != "", street), F.when(street != "", tail), code, F.when((town != "") & (region != ""), F.concat_ws(", ", town, region)), F.when(town != "", town))
    return F.array_distinct(F.transform(F.filter(out, lambda q: q.isNotNull()), lambda q: F.concat(q, F.lit(f", {country}"))))


def escape_xml(c: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def plural(n: Column, one: str, few: str, many: str) -> Column:
    """Agreement by the last digit; 11 to 14 take the third form."""
    last, two = F.pmod(n, F.lit(10)), F.pmod(n, F.lit(100))
    return F.when(two.between(11, 14), many).when(last == 1, one).when(last.between(2, 4), few).otherwise(many)


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def https(url: Column) -> Column:
    return F.regexp_replace(url, "^http://", "https://")


def year_of(date: Column) -> Column:
    return empty_to_null(F.regexp_extract(date, r"^(-?[0-9]{1,4})-", 1))


# The months' names as they stand in dates.
MONTHS = ("siječnja", "veljače", "ožujka", "travnja", "svibnja", "lipnja", "srpnja", "kolovoza", "rujna", "listopada", "studenoga", "prosinca")


def long_date(c: Column) -> Column:
    """'12. studenoga 2004.' of an ISO date or time; anything else stays as it is, nothing is null."""
    day = c.try_cast("date")
    month = F.element_at(F.array(*map(F.lit, MONTHS)), F.month(day))
    return F.when(empty_to_null(c).isNull(), None).otherwise(F.coalesce(F.concat(F.dayofmonth(day).cast("string"), F.lit(". "), month, F.lit(" "), F.year(day).cast("string"), F.lit(".")), c))


def local_number(n: Column, digits: int = 0) -> Column:
    """A number with points between thousands and a decimal comma."""
    return F.translate(F.format_number(n, digits), ",.", ".,")


def square_kilometres(n: Column) -> Column:
    return F.concat(local_number(F.round(n)), F.lit(" km²"))


def local_percent(n: Column) -> Column:
    return F.concat(F.replace(F.format_string("%.1f", n.cast("double")), F.lit("."), F.lit(",")), F.lit(" %"))


def counted(n: Column, one: str, few: str, many: str) -> Column:
    """A number with its noun in the right form."""
    return F.concat(local_number(n), F.lit(" "), plural(n, one, few, many))


def wkt_point(text: Column) -> Column:
    """struct(lat, lng) of 'Point(lng lat)'; nulls where there is none."""
    pattern = r"(?i)Point\s*\(\s*(-?[0-9.]+)\s+(-?[0-9.]+)\s*\)"
    part = lambda k: empty_to_null(F.regexp_extract(text, pattern, k)).try_cast("double")
    return F.struct(part(2).alias("lat"), part(1).alias("lng"))


def wikipedia_url(value: Column) -> Column:
    """'lang:title' to an address; addresses pass, anything else is null."""
    lang = F.substring_index(value, ":", 1)
    title = F.replace(F.regexp_replace(value, "^[^:]*:", ""), F.lit(" "), F.lit("_"))
    return F.when(value.rlike("^https?://"), value).when(F.contains(value, F.lit(":")), F.concat(F.lit("https://"), lang, F.lit(".wikipedia.org/wiki/"), title))
