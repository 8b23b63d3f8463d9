"""Graphs as N-Triples text and as Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tripleloom.functions import terms as t
from tripleloom.operators.lift import StoredGraph, as_set, union_all

# One line: subject, predicate and object, each IRI without its brackets, a literal without its
# quotes. Every loop is possessive, so long texts neither backtrack nor deepen the stack.
LINE = (
    r"^\s*+(?:<([^>]*+)>|(_:\S*[^\s.]))\s*+<([^>]*+)>\s*+"
    r"(?:<([^>]*+)>|(_:\S*[^\s.])"
    r'|(")([^"\\]*+(?:\\.[^"\\]*+)*+)"(?:\^\^<([^>]*+)>|@([A-Za-z0-9\-]++))?)'
    r"\s*+\.\s*+(?:#.*)?$"
)
MARK = "\x01"
PARTS = MARK.join(["$1$2", "$3", "$6", "$8", "$9", "$4$5$7"])


def _escape(x: Column) -> Column:
    for raw, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        x = F.replace(x, F.lit(raw), F.lit(written))
    return x


# An escape that N-Triples has, and one of more than four digits, which stands for two UTF-16 units.
ESCAPE = r"\\(?:[tbnrf\"'\\]|u[0-9A-Fa-f]{4}|U00(?:0[0-9A-Fa-f]|10)[0-9A-Fa-f]{4})"
WIDE = r"\\U00([01][0-9A-Fa-f]{5})"


def _pairs(x: Column) -> Column:
    """\\UXXXXXXXX as the one or two \\uXXXX that JSON has for it; a pair of backslashes is no such escape."""
    pieces = F.split(F.regexp_replace(x, r"(\\\\)|" + WIDE, "$1\x02$2\x02"), "\x02")
    offset = lambda p: F.conv(p, 16, 10).cast("long") - 0x10000
    unit = lambda n: F.concat(F.lit("\\u"), F.lpad(F.hex(n), 4, "0"))
    high = lambda p: unit(F.lit(0xD800) + F.shiftright(offset(p), 10))
    low = lambda p: unit(F.lit(0xDC00) + offset(p).bitwiseAND(F.lit(0x3FF)))
    wide = lambda p: F.when(p == "", "").when(F.startswith(p, F.lit("00")), F.concat(F.lit("\\u"), F.substring(p, 3, 4)))
    # every second piece is the six digits of a wide escape, or nothing after a pair of backslashes
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 0, p).otherwise(wide(p).otherwise(F.concat(high(p), low(p))))), "")


def _unescape(x: Column) -> Column:
    """The short escapes and \\uXXXX are those of JSON. Any other escape is an error."""
    bad = F.raise_error(F.concat(F.lit("not an N-Triples escape: "), x))
    sound = F.regexp_replace(x, ESCAPE, "")
    wide = F.when(F.contains(x, F.lit("\\U")), _pairs(x)).otherwise(x)
    decoded = F.from_json(
        F.concat(F.lit('["'), wide, F.lit('"]')),
        "array<string>",
        {"allowBackslashEscapingAnyCharacter": "true", "allowUnquotedControlChars": "true"},
    )[0]
    read = F.when(F.contains(sound, F.lit("\\")), bad).otherwise(F.coalesce(decoded, bad))
    return F.when(F.contains(x, F.lit("\\")), read).otherwise(x)


def _resource(value: Column) -> Column:
    return F.when(F.startswith(value, F.lit("_:")), value).otherwise(F.concat(F.lit("<"), value, F.lit(">")))


def to_lines(triples: DataFrame) -> DataFrame:
    """One line of text per triple, column `value`."""
    quoted = F.concat(F.lit('"'), _escape(F.col("o")), F.lit('"'))
    literal = (
        F.when(F.col("o_lang") != "", F.concat(quoted, F.lit("@"), F.col("o_lang")))
        .when(F.col("o_dt").isin("", t.XSD_STRING), quoted)
        .otherwise(F.concat(quoted, F.lit("^^<"), F.col("o_dt"), F.lit(">")))
    )
    obj = F.when(F.col("o_kind") == "lit", literal).otherwise(_resource(F.col("o")))
    predicate = F.concat(F.lit("<"), F.col("p"), F.lit(">"))
    return triples.select(F.concat_ws(" ", _resource(F.col("s")), predicate, obj, F.lit(".")).alias("value"))


def from_lines(lines: DataFrame) -> DataFrame:
    """Triples from lines of N-Triples (column `value`). A line that is none is an error.

    One regular expression per line; the text of the object comes last and may hold the mark.
    """
    parts = F.split(F.regexp_replace("value", LINE, PARTS), MARK, 6)
    bare = F.ltrim("value")
    rows = lines.where((bare != "") & ~F.startswith(bare, F.lit("#"))).select("value", parts.alias("part"))
    bad = F.raise_error(F.concat(F.lit("not an N-Triples line: "), F.col("value")))
    names = ["s", "p", "quote", "dt", "lang", "o"]
    rows = rows.select(F.when(F.size("part") == 6, F.col("part")).otherwise(bad).alias("part")).select(
        *[F.col("part")[i].alias(n) for i, n in enumerate(names)]
    )
    literal = F.col("quote") != ""
    plain = literal & (F.col("dt") == "") & (F.col("lang") == "")
    return rows.select(
        _unescape(F.col("s")).alias("s"),
        _unescape(F.col("p")).alias("p"),
        _unescape(F.col("o")).alias("o"),
        F.when(literal, "lit").when(F.startswith("o", F.lit("_:")), "bnode").otherwise("iri").alias("o_kind"),
        F.when(plain, t.XSD_STRING).otherwise(F.col("dt")).alias("o_dt"),
        F.col("lang").alias("o_lang"),
    )


def read_ntriples(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return from_lines(spark.read.text(paths))


def load_graph(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several files as one graph: equal triples are one triple."""
    return as_set(read_ntriples(spark, paths))


def read_graphs(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Files kept apart by `g`, each a set of its own."""
    parts = [read_ntriples(spark, path).withColumn("g", F.lit(g)) for g, path in files.items()]
    return union_all(parts).dropDuplicates(["g", *t.TERM])


def write_ntriples(triples: DataFrame, path: str, counted: Observation | None = None, compression: str | None = None) -> None:
    """Lines of text, in parallel. `counted` gets the number of `triples`, and the `bytes` of their lines before any
    compression, from the same pass. Compressed files ("gzip") are read like others; lines repeat their name spaces, so
    they take about a twentieth of the disk."""
    lines = to_lines(triples)
    if counted is not None:
        size = F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).cast("long")
        lines = lines.observe(counted, F.count(F.lit(1)).alias("triples"), size.alias("bytes"))
    (lines.write if compression is None else lines.write.option("compression", compression)).text(path)


def write_table(triples: DataFrame, path: str) -> None:
    """Parquet by predicate, so that a pattern with a given predicate reads only its folder.

    Rebalancing by predicate lets adaptive execution split a predicate that holds a large part of
    all triples over many tasks and join small ones, so files come out even.
    """
    triples.select(*t.TERM).hint("rebalance", "p").write.partitionBy("p").parquet(path)


def read_table(spark: SparkSession, path: str) -> StoredGraph:
    """A stored graph; the predicate of a pattern prunes the folders to read."""
    return StoredGraph(spark.read.parquet(path).select(*t.TERM))
