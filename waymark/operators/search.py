"""Search and browse: a token index, folded substrings, facets, pages, detail documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.binding import let
from .numbering import numbered

# The index folds accents but keeps đ, the browse search folds it too.
_KEPT = "đĐ"
_FROM = "".join(c for c in text.ACCENTED if c not in _KEPT)
_TO = "".join(p for c, p in zip(text.ACCENTED, text.PLAIN, strict=True) if c not in _KEPT)


def index_fold(c: Column) -> Column:
    return F.lower(F.translate(F.coalesce(c, F.lit("")), _FROM, _TO))


def token_index(df: DataFrame, id_: str, columns: Sequence[str]) -> DataFrame:
    """(id, token): distinct folded words of all indexed columns."""
    return df.select(id_, F.explode(tokens(columns)).alias("token"))


def tokens(columns: Sequence[str]) -> Column:
    """Distinct folded words of all indexed columns of a row."""
    return F.array_distinct(_tokens(columns))


def _tokens(columns: Sequence[str]) -> Column:
    words = F.split(F.concat_ws(" ", *(index_fold(F.col(c)) for c in columns)), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: w != "")


def _words_of(spark, query: str) -> list[str]:
    """The folded words of a query; nothing of a table is read."""
    row = spark.range(1).select(index_fold(F.lit(query.strip())).alias("q")).first()
    return list(dict.fromkeys(w for w in row.q.split() if w))


def _is_word(token: Column, word: str) -> Column:
    return F.startswith(token, F.lit(word[:-1])) if word.endswith("*") else token == word


def _is_begun(word: str) -> Callable[[Column], Column]:
    return lambda token: _is_word(token, word)


def search_all(index: DataFrame, id_: str, query: str) -> DataFrame:
    """Ids of an index (id, token) with every word of the query; a word that ends in * is a beginning."""
    wanted = _words_of(index.sparkSession, query)
    if not wanted:
        return index.select(id_).limit(0)
    hits = [_is_word(F.col("token"), w) for w in wanted]
    found = index.where(reduce(or_, hits)).groupBy(id_).agg(*(F.bool_or(h).alias(f"h{k}") for k, h in enumerate(hits)))
    return found.where(" and ".join(f"h{k}" for k in range(len(wanted)))).select(id_)


def search_rows(df: DataFrame, id_: str, columns: Sequence[str], query: str) -> DataFrame:
    """The same ids straight from the rows: each row's words are tested in place, without an index or a shuffle."""
    wanted = _words_of(df.sparkSession, query)
    if not wanted:
        return df.select(id_).limit(0)
    whole, begun = [w for w in wanted if not w.endswith("*")], [w for w in wanted if w.endswith("*")]

    def has_all(words: Column) -> Column:
        tests = [F.size(F.array_intersect(words, F.array(*map(F.lit, whole)))) == len(whole)] if whole else []
        return reduce(and_, [*tests, *(F.exists(words, _is_begun(w)) for w in begun)])

    return df.where(let(_tokens(columns), has_all)).select(id_)


def search_text(df: DataFrame, columns: Sequence[str], part: str) -> DataFrame:
    """Rows with a folded part of text in any of the columns."""
    want = text.search_fold(F.lit(part))
    return df.where(F.exists(F.array(*(text.search_fold(F.col(c)) for c in columns)), lambda c: F.contains(c, want)))


def facets(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(facet, value, n) of several columns in one pass over the rows."""
    pairs = F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))


def page(df: DataFrame, order: Sequence[Column | str], number: int, size: int = 60, step: int = 120) -> DataFrame:
    """The first page has size rows, later ones step more each."""
    rows = df.orderBy(*order)
    return rows.limit(size) if number == 0 else rows.offset(size + (number - 1) * step).limit(step)


def ranked_pages(df: DataFrame, order: Sequence[Column | str], group: str | None = None) -> DataFrame:
    """The rows with their place in the order, within the group if one is named; numbered by ranges and prefix sums, in no single task."""
    return numbered(df, order, [group] if group else [])


def locale_order(c: Column, locale: str = "hr") -> Column:
    return F.collate(c, locale)


def detail(parents: DataFrame, children: DataFrame, key: str, foreign: str, fields: Sequence[str], main: str | None = None) -> DataFrame:
    """One document a parent: its columns, its children in order and, if a flag column is named, has_main: whether a child has it set."""
    found = [F.array_sort(F.collect_list(F.struct(*fields))).alias("items"), *([F.bool_or(F.coalesce(F.col(main).cast("boolean"), F.lit(False))).alias("has_main")] if main else [])]
    items = children.groupBy(F.col(foreign).alias(key)).agg(*found)
    out = parents.join(items, key, "left").withColumn("items", F.coalesce("items", F.array().cast(items.schema["items"].dataType)))
    return out.na.fill(False, ["has_main"]) if main else out


def detail_documents(parents: DataFrame, key: str, route: str, slug: str, children: dict[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """(route, slug, document): a JSON document for each row by which a page is looked up, with a list for each kind of child."""
    out = parents
    for name, (df, foreign, fields) in children.items():
        out = detail(out, df, key, foreign, fields).withColumnRenamed("items", name)
    return out.select(F.lit(route).alias("route"), F.col(slug).alias("slug"), F.to_json(F.struct(*out.columns)).alias("document"))


def by_slug(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """Documents (route, slug, document) of the (route, slug) asked for; unknown ones have none."""
    return asked.join(documents, ["route", "slug"], "left")


def browse(df: DataFrame, columns: Sequence[str], part: str = "", kinds: Sequence[str] = (), equal: dict[str, str] | None = None, kind: str = "kind") -> DataFrame:
    """The browse filters together: folded text in any column, one of the kinds (none: all), and columns of one value."""
    out = search_text(df, columns, part) if part.strip() else df
    if kinds:
        out = out.where(F.col(kind).isin(*kinds))
    for column, value in (equal or {}).items():
        out = out.where(F.col(column) == value)
    return out


def toggled(kinds: Sequence[str], kind: str) -> list[str]:
    """The chosen kinds with one more, or without it if it was chosen; in their order."""
    return [k for k in kinds if k != kind] if kind in kinds else [*kinds, kind]


def indexed_place(city: Column, settlement: Column, municipality: Column) -> Column:
    """The place that a building is listed under: the first of its address, settlement and municipality that is filled."""
    return F.coalesce(*(text.empty_to_null(F.trim(c)) for c in (city, settlement, municipality)))


def families(df: DataFrame, group: str, id_: str, fields: Sequence[str], flag: str) -> DataFrame:
    """(group, main, members): each group once, with its flagged row's id (least one) and all its rows in order."""
    return df.groupBy(group).agg(F.min(F.when(F.col(flag).cast("boolean"), F.col(id_))).alias("main"), F.array_sort(F.collect_list(F.struct(*fields, F.col(id_)))).alias("members"))


def siblings(df: DataFrame, asked: DataFrame, group: str, id_: str, fields: Sequence[str], flag: str) -> DataFrame:
    """(id, main, others) of the pages asked for (id): the flagged row of their group and its other rows in order. Only the groups asked for are gathered."""
    own = asked.select(id_).join(df.select(id_, group), id_)
    found = families(df.join(own.select(group).distinct(), group, "left_semi"), group, id_, fields, flag)
    return own.join(found, group).select(id_, "main", F.filter("members", lambda x: x[id_] != F.col(id_)).alias("others"))
