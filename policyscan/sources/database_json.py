"""Reading compact database documents ``{v, t, c, g, s}``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policyscan import fixed

COMPACT = "v string, t string, c bigint, g string, s map<string,string>"


def parse_compact(documents: DataFrame, source: str = "path", value: str = "value") -> DataFrame:
    """Parse one JSON document per row; missing keys get their defaults.

    ``error`` is set where the text is not a JSON object; such a row has no mappings.
    """
    broken = F.try_parse_json(value).isNull() | ~F.startswith(F.ltrim(value), F.lit("{"))
    return documents.select(source, F.from_json(value, COMPACT).alias("d"), broken.alias("broken")).select(
        source,
        F.when(F.coalesce("broken", F.lit(True)), "Not a JSON object").alias("error"),
        F.coalesce("d.v", F.lit(fixed.DATABASE_VERSION)).alias("version"),
        # An ISO time with or without a trailing Z; anything else is NULL.
        F.try_to_timestamp("d.t").alias("timestamp"),
        F.coalesce("d.g", F.lit(fixed.GENERATOR_VERSION)).alias("generator_version"),
        F.map_filter(
            F.coalesce("d.s", F.create_map().cast("map<string,string>")),
            lambda _, level: level.isin(fixed.SEVERITIES),
        ).alias("mappings"),
    )


def compact_metadata(parsed: DataFrame) -> DataFrame:
    """Metadata of every document; the count is that of the entries kept."""
    return parsed.withColumn("total_mappings", F.size("mappings").cast("bigint")).drop("mappings")


def compact_mappings(parsed: DataFrame, source: str = "path") -> DataFrame:
    """(source, checkov_id, severity) of the entries with a valid severity."""
    return parsed.select(source, F.explode("mappings").alias("checkov_id", "severity"))


def read_compact(spark, path: str) -> DataFrame:
    """Parse every file below ``path`` as one document each."""
    texts = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )
    return parse_compact(texts)


ENTRY = r'^,?("(?:[^"\\]|\\.)*"):("(?:[^"\\]|\\.)*")$'


def read_compact_lines(spark, path: str) -> DataFrame:
    """(checkov_id, severity) of a compact document that was written as lines in parts.

    Every entry is a line of its own, so the parts are read in parallel and no row holds
    a whole database.
    """
    lines = spark.read.text(path).select(
        F.regexp_extract("value", ENTRY, 1).alias("key"), F.regexp_extract("value", ENTRY, 2).alias("level")
    )
    entries = lines.filter("key <> ''").select(
        F.get_json_object(F.concat(F.lit('{"x":'), "key", F.lit("}")), "$.x").alias("checkov_id"),
        F.get_json_object(F.concat(F.lit('{"x":'), "level", F.lit("}")), "$.x").alias("severity"),
    )
    return entries.filter(F.col("severity").isin(fixed.SEVERITIES))


PAIR = r'"((?:[^"\\]|\\.)*+)"\s*+:\s*+"((?:[^"\\]|\\.)*+)(?:"|\z)'


def read_compact_pieces(spark, path: str) -> DataFrame:
    """(path, checkov_id, severity) of compact documents of one line each, read in pieces.

    The files are cut after every quoted value that a comma follows, so a document is read
    by as many tasks as it has splits and a row holds one entry.  Such a cut lies inside a
    string only behind an escaped quote; files with such a cut are parsed whole instead.
    Entries are not resolved: a repeated identifier is repeated, in no order.  Only entries
    have a severity as value, so the other fields need no place in the document.
    """
    pieces = spark.read.text(path, lineSep='",').select(F.col("_metadata.file_path").alias("path"), "value")
    escaped = F.length(F.regexp_extract("value", r"(\\*+)\z", 1)) % 2 == 1
    unsafe = pieces.filter(escaped).select("path").distinct()
    keys = F.regexp_extract_all("value", F.lit(PAIR), F.lit(1))
    levels = F.regexp_extract_all("value", F.lit(PAIR), F.lit(2))
    pairs = pieces.select("path", F.explode(F.arrays_zip(keys.alias("key"), levels.alias("severity"))).alias("p"))
    entries = pairs.select("path", "p.key", "p.severity").filter(F.col("severity").isin(fixed.SEVERITIES))
    quoted = F.concat(F.lit('{"x":"'), F.col("key"), F.lit('"}'))
    cut = entries.join(unsafe, "path", "left_anti").select(
        "path", F.get_json_object(quoted, "$.x").alias("checkov_id"), "severity"
    )
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    parsed = parse_compact(whole.join(unsafe, "path", "left_semi"))
    return cut.unionByName(compact_mappings(parsed))
