"""Line dedup over content-defined chunks of lines, in DataFrame operations only.

A hash of each line tells whether the line ends a chunk, so the same run of lines is cut alike
wherever it stands; a chunk has two lines at least and shares one with the chunk before where it
would be shorter. Chunks that occur again anywhere are anchors: each is extended line by line both
ways as far as it equals its first occurrence, and removed after its lines were compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import carried, staged, unpacked

#: A line ends a chunk if the hexadecimal digits of its MD5 are below these: seven lines of eight.
ENDS_BELOW = "e"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas in it use it many times."""
    return F.transform(F.array(value), body)[0]


def _part(array: Column, first: Column, size: Column) -> Column:
    return F.slice(array, first + 1, size)


def line_chunks(docs: DataFrame, ends_below: str = ENDS_BELOW) -> DataFrame:
    """rk, doc_id and first, size, key, back, on of each chunk of each text (columns rk, doc_id, text).

    A chunk ends where a line does by its own hash, or at the last line of the text; it starts behind
    the end before, or at the line before its own end if that is earlier. ``back`` counts the lines
    from the start of the chunk before up to it, ``on`` those behind it to the next end. Chunks of one
    line (a text's first one) or without a word are left out.
    """
    def chunks(lines: Column, ends: Column) -> Column:
        def first(k: Column) -> Column:
            return F.greatest(F.lit(0), F.least(F.coalesce(F.get(ends, k - 1) + 1, F.lit(0)), F.get(ends, k) - 1))
        return F.transform(ends, lambda e, k: _let(first(k), lambda at: _let(_part(lines, at, e - at + 1), lambda own: F.struct(
            at.alias("first"), F.size(own).alias("size"), F.xxhash64(own).alias("key"),
            F.exists(own, lambda x: F.trim(x) != "").alias("worded"),
            F.when(k == 0, F.lit(0)).otherwise(at - first(k - 1)).alias("back"),
            (F.coalesce(F.get(ends, k + 1), e) - e).alias("on")))))

    def cut(lines: Column) -> Column:
        last = F.size(lines) - 1
        return _let(F.filter(F.transform(lines, lambda x, i: F.when(
            (i == last) | (F.md5(x.cast("binary")) < ends_below), i)), lambda i: i.isNotNull()), lambda ends: chunks(lines, ends))

    rows = docs.filter("text is not null").select("rk", "doc_id", F.inline(_let(F.split("text", "\n", -1), cut)))
    return rows.filter("size > 1 and worded").drop("worded")


def _shared(a: Column, b: Column) -> Column:
    """How many elements two arrays share from their start on."""
    n = F.least(F.size(a), F.size(b))
    differ = F.transform(F.slice(a, 1, n), lambda x, i: x != F.get(b, i))
    return F.coalesce(F.nullif(F.array_position(differ, True), F.lit(0)) - 1, n).cast("int")


def without_repeated_lines(docs: DataFrame, ends_below: str = ENDS_BELOW) -> DataFrame:
    """Removes every chunk that repeats an earlier one, and the lines around it that do so too.

    Returns the columns of ``docs`` with the kept ``text``, n_lines and n_removed packed as
    ``row``, ``kept``, ``n_lines`` and ``n_removed``. Of equal chunks, that with the least
    (doc_id, row key, first line) stays; null ids come first. A repeated one goes with the lines
    before and behind it, as far as these equal the first one's up to its neighbouring chunks. A null
    text has no lines and stays null, an empty one has one. Rows equal in id and text count as one
    document and share their fate.
    """
    named = F.concat(F.length(F.col("doc_id").cast("string")), F.lit(":"), F.col("doc_id").cast("string"))
    key = F.unhex(F.md5(F.concat(F.coalesce(named, F.lit("")), F.lit("|"), F.col("text")).cast("binary")))
    own = docs.select(key.alias("rk"), "doc_id", "text")
    chunks = staged(line_chunks(own, ends_below), "chunks")
    # The first of each repeated key: aggregated before the shuffle, stored, then joined back,
    # so that a chunk of very many documents is split like any skewed join side.
    firsts = staged(chunks.groupBy("key").agg(F.min(F.struct("doc_id", "rk", "first", "size", "back", "on")).alias("f"),
                                              F.max(F.struct("doc_id", "rk", "first")).alias("z"))
                    .filter("not (f.rk <=> z.rk and f.first = z.first)").select("key", "f"), "firsts")
    # The texts are dealt by rk once and meet the wanted chunks and the listed ones there: both joins
    # name the whole row and are merge joins at any size, so that Spark reuses the one exchange. A null
    # text has an empty key, equal to none: a key that may be null is filtered before the inner join only.
    rows = carried(docs, rk=F.coalesce(key, F.lit(b"")))

    # Of each first chunk its lines with those around it. One row of each key, so that repeated rows
    # are not joined with each other.
    wanted = firsts.groupBy(F.col("f.rk").alias("f_rk")).agg(F.collect_list(F.struct("key", "f")).alias("wanted"))
    found = (rows.join(wanted.hint("merge"), F.col("rk") == F.col("f_rk")).groupBy("rk")
             .agg(F.first("row").alias("whole"), F.first("wanted").alias("wanted"))
             .select(F.inline(_let(F.split("whole.text", "\n", -1), lambda lines: F.transform("wanted", lambda w: F.struct(
                 w["key"].alias("f_key"), w["f"]["back"].alias("back"), _part(
                     lines, w["f"]["first"] - w["f"]["back"], w["f"]["back"] + w["f"]["size"] + w["f"]["on"]).alias("around")))))))
    later = chunks.join(firsts, "key").filter("rk != f.rk or first != f.first").select("key", F.col("rk").alias("l_rk"), "first", "size")
    # Both sides come straight from an exchange, so that a chunk of very many documents is split.
    listed = (later.join(found, F.col("key") == F.col("f_key")).groupBy("l_rk")
              .agg(F.collect_set(F.struct("first", "size", "back", "around")).alias("listed")))

    def places(lines: Column) -> Column:
        """Lines of all chunks that are equal to the first ones, and of what is equal around them."""
        same = F.filter(F.coalesce("listed", F.array()), lambda c: _part(lines, c["first"], c["size"]) == _part(c["around"], c["back"], c["size"]))

        def reach(c: Column) -> Column:
            back, behind = F.least(c["back"], c["first"]), c["first"] + c["size"]
            left = _shared(F.reverse(_part(lines, c["first"] - back, back)), F.reverse(F.slice(c["around"], 1, c["back"])))
            rest = F.size(c["around"]) - c["back"] - c["size"]
            right = _shared(_part(lines, behind, rest), _part(c["around"], c["back"] + c["size"], rest))
            return F.sequence(c["first"] - left, behind + right - 1)

        return F.array_distinct(F.flatten(F.transform(same, reach)))

    rows = rows.join(listed.hint("merge"), F.col("rk") == F.col("l_rk"), "left")
    cut = _let(F.split("row.text", "\n", -1), lambda lines: _let(places(lines), lambda gone: F.struct(
        F.when(F.size(gone) > 0, F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)), "\n")).alias("kept"),
        F.size(lines).alias("n_lines"), F.size(gone).alias("n_removed"))))
    rows = rows.select("row", F.when(F.col("row.text").isNotNull(), cut).alias("cut"))
    return rows.select("row", F.coalesce("cut.kept", "row.text").alias("kept"), *[
        F.coalesce(F.col(f"cut.{c}"), F.lit(0)).cast("long").alias(c) for c in ("n_lines", "n_removed")])


def line_report(docs: DataFrame, ends_below: str = ENDS_BELOW) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed and the SHA-256 of the kept text (null: of none)."""
    rows = without_repeated_lines(docs.select("doc_id", "text"), ends_below)
    return rows.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed",
                       F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def dedup_lines(docs: DataFrame, ends_below: str = ENDS_BELOW) -> DataFrame:
    """Documents without their repeated lines, all columns kept (``n_chars`` follows, where there is one).

    A document that lost lines and has no word left goes; so a copy of a text of two lines or more
    does. Null and empty texts and texts of one line are left as they are, repeated or not.
    """
    rows = without_repeated_lines(docs, ends_below).filter(F.expr(r"n_removed = 0 or kept rlike '\\S'"))
    replaced = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(
            F.length("kept").cast(docs.schema["n_chars"].dataType))
    return unpacked(rows, docs.columns, **replaced)
