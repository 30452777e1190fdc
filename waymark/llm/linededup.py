"""Line dedup by content-defined chunks of lines, in DataFrame expressions only.

Each line is hashed; a rolling hash covers every two neighbouring lines; a boundary falls where
that hash is smaller than both its neighbours', so boundaries follow the lines around them and
shift with them, and inner chunks have two lines at least. A chunk of several lines that is found
again anywhere, byte by byte, is removed but for its first occurrence (smallest id, then place).

Only (hash, document, place) of chunks is counted over the whole corpus; texts of chunks are
fetched and compared just for hashes seen twice. Counting and comparing pre-aggregate before the
shuffle, so a chunk in a third of all documents costs one row per task; the joins can be split
by Spark where they are skewed.

Defined cases: a null text has no lines and stays null; an empty text is one empty line; chunks
without a visible character are never removed; null ids come first; rows with equal id and text
are one document and all get the same result; a text of any length is one row, its lines an array; an
empty table gives no rows; other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_chunks(base: DataFrame) -> DataFrame:
    """Adds lines and spans (start, end in lines) of the chunks to rows with a `text`."""
    lined = base.withColumn("lines", F.split("text", "\n", -1)).withColumn("hashed", F.expr("transform(lines, x -> md5(x))"))
    rolled = lined.withColumn("rolled", F.expr("transform(zip_with(hashed, slice(hashed, 2, greatest(size(hashed), 1)), (a, b) -> concat(a, b)), x -> md5(x))"))
    cut = rolled.withColumn("zipped", F.arrays_zip(F.col("rolled"), F.expr("concat(array(cast(null as string)), rolled)").alias("before"), F.expr("slice(rolled, 2, greatest(size(rolled), 1))").alias("after")))
    cut = cut.withColumn("starts", F.expr("filter(transform(zipped, (z, k) -> if(z.rolled < z.before and z.rolled < z.after, cast(k + 1 as int), null)), x -> x is not null)")).drop("zipped")
    return cut.withColumn("spans", F.expr("zip_with(concat(array(0), starts), concat(starts, array(size(lines))), (s, e) -> struct(s, e))")).drop("hashed", "rolled", "starts")


def _chunk_text(span: str = "p") -> str:
    return f"array_join(slice(lines, {span}.s + 1, {span}.e - {span}.s), '\\n', '')"


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: row (the input row), lines, removed (spans of lines, in order), kept (the text that stays), n_chunks."""
    base = docs.select(F.struct("*").alias("row"), docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).withColumn("of", F.xxhash64("text"))
    spans = with_chunks(base.select("id", "of", "text").where("text is not null"))
    keyed = spans.select("id", "of", F.expr(f"transform(filter(spans, p -> p.e - p.s > 1), p -> struct(p.s as s, p.e as e, {_chunk_text()} as chunk))").alias("c"))
    keyed = keyed.select("id", "of", F.explode(F.expr(r"transform(filter(c, x -> x.chunk rlike '[^\\s]'), x -> struct(x.s, x.e, xxhash64(x.chunk) as h))")).alias("c")).select("id", "of", "c.*")
    twice = keyed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    found = keyed.join(twice, "h").select("id", "of", "s", "e")
    listed = found.groupBy("id", "of").agg(F.collect_set(F.struct("s", "e")).alias("wanted"))

    def same(a: str, b: str) -> Column:
        return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.of") == F.col(f"{b}.of"))

    texts = base.select("id", "of", "text").alias("d").join(listed.alias("l"), same("d", "l")).select("d.id", "d.text", "l.of", "wanted").withColumn("lines", F.split("text", "\n", -1))
    texts = texts.select("id", "of", F.explode(F.expr(f"transform(wanted, p -> struct(p.s as s, p.e as e, {_chunk_text()} as chunk))")).alias("c")).select("id", "of", "c.*")
    firsts = texts.groupBy("chunk").agg(F.min(F.struct("id", "of", "s")).alias("f")).select("f.*")
    gone = found.alias("g").join(firsts.alias("f"), same("g", "f") & (F.col("g.s") == F.col("f.s")), "left_anti").groupBy("id", "of").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("removed"))
    # the text is taken from the row after the join, so it is shuffled once
    out = base.select("row", "id", "of").alias("d").join(gone.alias("g"), same("d", "g"), "left").select("d.row", F.coalesce("removed", F.expr("cast(array() as array<struct<s:int,e:int>>)")).alias("removed"))
    out = out.withColumn("text", F.col("row").getField(text_col).cast("string")).withColumn("lines", F.split("text", "\n", -1))
    kept = F.expr("""if(size(removed) = 0, text, array_join(zip_with(concat(array(0), removed.e), concat(removed.s, array(size(lines))),
                     (a, b) -> if(b > a, array_join(slice(lines, a + 1, b - a), '\n', ''), null)), '\n'))""")
    return out.withColumn("kept", kept).drop("text")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated chunks taken out; those of which nothing is left go. Columns as they came."""
    done = dedup_lines(docs, id_col, text_col)
    left = done.where("size(removed) = 0 or trim(kept) <> ''")
    return left.select(*(F.col("kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))
