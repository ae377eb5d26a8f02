"""Licence scan: canonical digests of entire texts, joined to those of known licences.

A line is canonical without case, punctuation and repeated blanks and with one spelling of equivalent words;
copyright lines and empty lines fall away. Looked up are a document's whole text, without lines that only name a
licence, and each of its lines, since a notice is a line. How a text is wrapped does not matter. Everything is
DataFrame operations; the known texts go through the same ones, and their fixed number bounds the broadcast.

A copyright line begins with ``copyright`` and a year, a sign or a name, or is a sign or a reservation; a wrapped line of
a licence that begins with ``copyright notice`` is none.

Defined results: a null, empty or blank text has no lines and no licence; a text of titles alone is no licence; a line
that occurs twice counts twice in ``n_lines`` and names its licence once; equal rows are scanned alike; an empty table
gives an empty table. Columns of the input other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import written
from tidewell.llm.licence_texts import SPELLINGS, TEXTS, TITLES

# Lines of holders and years, and what a line looks like that is text although it begins like one.
COPYRIGHT = r"^[ \t*#/-]*(([Cc]opyright|COPYRIGHT)[ \t]*(\([Cc]\)|©|:|<|\[|[0-9]{4}|[Bb]y[ \t]|[A-Z][a-z])|\([Cc]\)[ \t]*(<|\[|[0-9]{4}|[Cc]opyright)|©|[Aa]ll rights reserved)"
NO_HOLDER = r"^[ \t*#/-]*Copyright[ \t]+(Holder|Owner|Notice|Law|License|Licence|Act|Disclaimer)"


def _spaced(words: str) -> str:
    """Words as they stand in a line whose every word has a blank of its own on either side."""
    return f" {words.replace(' ', '  ')} "


def _canonical(line: Column) -> Column:
    lowered = F.translate(line, string.ascii_uppercase, string.ascii_lowercase)
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, r"[^a-z0-9]+", "  ")), F.lit(" "))
    for spelling, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(_spaced(spelling)), F.lit(_spaced(usual)))
    return F.trim(F.replace(plain, F.lit("  "), F.lit(" ")))


def lines(text: Column) -> Column:
    """The canonical lines of a text."""
    kept = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~x.rlike(COPYRIGHT) | x.rlike(NO_HOLDER))
    return F.filter(F.transform(kept, _canonical), lambda x: x != "")


def body(lines_: Column) -> Column:
    """The canonical lines as one text, without titles; NULL if there is nothing else. Spellings of several words may
    have stood on two lines, so they are made equal once more."""
    joined = F.concat(F.lit(" "), F.replace(F.array_join(F.filter(lines_, lambda x: ~x.isin(TITLES)), " "), F.lit(" "), F.lit("  ")), F.lit(" "))
    for spelling, usual in SPELLINGS:
        if " " in spelling:
            joined = F.replace(joined, F.lit(_spaced(spelling)), F.lit(_spaced(usual)))
    return F.nullif(F.trim(F.replace(joined, F.lit("  "), F.lit(" "))), F.lit(""))


def known(spark: SparkSession, texts: list[tuple[str, str]] = TEXTS) -> DataFrame:
    """``license, digest`` of the known texts."""
    rows = spark.createDataFrame(texts, "license string, text string")
    return rows.select("license", F.unhex(F.md5(body(lines(F.col("text"))))).alias("digest")).distinct()


def scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """``doc_id, n_lines, whole_license, line_licenses`` (sorted, with commas) of every document.

    Texts are read once: what is written and joined are 16 bytes for each of their lines.
    """
    digest = lambda x: F.unhex(F.md5(x))
    split = docs.select("doc_id", lines(F.col("text")).alias("_lines"))
    rows = written(
        split.select(
            F.monotonically_increasing_id().alias("_row"), "doc_id", F.size("_lines").cast("long").alias("n_lines"),
            digest(body(F.col("_lines"))).alias("_whole"), F.transform(F.array_distinct("_lines"), digest).alias("_each"),
        ),
        "licence-lines",
    )
    units = F.concat(
        F.array(F.struct(F.col("_whole").alias("digest"), F.lit(True).alias("whole"))),
        F.transform("_each", lambda x: F.struct(x.alias("digest"), F.lit(False).alias("whole"))),
    )
    found = rows.select("_row", F.explode(units).alias("_u")).select("_row", "_u.*").join(F.broadcast(licences), "digest")
    found = found.groupBy("_row").agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("whole_license"),
        F.array_join(F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",").alias("line_licenses"),
    )
    met = rows.select("_row", "doc_id", "n_lines").join(found, "_row", "left")
    return met.select("doc_id", "n_lines", "whole_license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"))


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return scan(docs, known(spark))


def _lines_sql(text: str) -> str:
    kept = f"list_filter(string_split(COALESCE({text}, ''), chr(10)), lambda x: NOT regexp_matches(x, '{COPYRIGHT}') OR regexp_matches(x, '{NO_HOLDER}'))"
    lowered = f"translate(x, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    plain = f"' ' || trim(regexp_replace({lowered}, '[^a-z0-9]+', '  ', 'g')) || ' '"
    for spelling, usual in SPELLINGS:
        plain = f"replace({plain}, '{_spaced(spelling)}', '{_spaced(usual)}')"
    plain = f"trim(replace({plain}, '  ', ' '))"
    return f"list_filter(list_transform({kept}, lambda x: {plain}), lambda x: x <> '')"


def _body_sql(lines_: str) -> str:
    titles = ", ".join(_quoted(t) for t in TITLES)
    joined = f"' ' || replace(array_to_string(list_filter({lines_}, lambda x: x NOT IN ({titles})), ' '), ' ', '  ') || ' '"
    for spelling, usual in SPELLINGS:
        if " " in spelling:
            joined = f"replace({joined}, '{_spaced(spelling)}', '{_spaced(usual)}')"
    return f"trim(replace({joined}, '  ', ' '))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP6_SQL = f"""
WITH raw(license, text) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in TEXTS)}),
known AS (SELECT DISTINCT license, {_body_sql(_lines_sql("text"))} AS words FROM raw),
split AS (SELECT row_number() OVER () AS row, doc_id, {_lines_sql("text")} AS lines FROM documents),
whole AS (
    SELECT row, MIN(license) AS license FROM split JOIN known ON {_body_sql("lines")} <> '' AND {_body_sql("lines")} = words
    GROUP BY row
), each AS (SELECT DISTINCT row, license FROM (SELECT row, unnest(lines) AS line FROM split) JOIN known ON line = words),
listed AS (SELECT row, string_agg(license, ',' ORDER BY license) AS licenses FROM each GROUP BY row)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, whole.license AS whole_license, COALESCE(licenses, '') AS line_licenses
FROM split LEFT JOIN whole USING (row) LEFT JOIN listed USING (row)
"""
