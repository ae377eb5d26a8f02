from __future__ import annotations

import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.compare import differences
from tests.llm import brute
from tidewell.llm import licences
from tidewell.llm.licence_texts import FILES, TEXTS

SHORT = {name: text for name, text in TEXTS if name in ("MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause") and len(text) > 300}
HEADS = {
    "MIT": "The MIT License (MIT)\n\nCopyright (c) 2020 Some One <some@one.org>\n\n", "ISC": "ISC License:\n\nCopyright 2004-2010 by Internet People\n\n",
    "0BSD": "BSD Zero Clause License\n\n(c) 2019 X\n\n", "BSD-2-Clause": "BSD 2-Clause License\n\nCopyright Jane Doe\nAll rights reserved.\n\n",
    "BSD-3-Clause": "The 3-Clause BSD License\n\nCopyright © 1999, The Owners\n\n",
}


def _wrapped(text: str, width: int) -> str:
    """The text with its paragraphs wrapped anew; lines of holders stay lines."""
    out, held = [], []
    for line in [*text.split("\n"), ""]:
        own = line.lower().strip().startswith(("copyright (c)", "copyright [", "copyright ©", "<one line"))
        if not line.strip() or own:
            out += textwrap.wrap(" ".join(held), width, break_long_words=False, break_on_hyphens=False)
            out, held = [*out, line], []
        else:
            held.append(line.strip())
    return "\n".join(out)


def _whole(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.whole_license for r in licences.scan(docs, licences.known(spark)).orderBy("doc_id").collect()]


def test_whole_licences_with_titles_and_holders(spark):
    texts = [HEADS[n] + t for n, t in SHORT.items()] + [_wrapped(HEADS[n] + t, 50) for n, t in SHORT.items()]
    assert _whole(spark, texts) == [*SHORT, *SHORT]
    # A text with more than the licence, a title alone, and half a licence are none.
    mit = SHORT["MIT"]
    assert _whole(spark, [mit + "\nand more", "MIT License\n", mit[:400], "", None]) == [None] * 5


@pytest.mark.parametrize("width", [60, 100])
def test_whole_files_however_wrapped(spark, width):
    given = {identifier: next(t for n, t in TEXTS if n == identifier and len(t) > 1_400) for identifier in FILES.values() if identifier != "BSD-3-Clause"}
    filled = given["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2021 The Authors")
    assert filled != given["Apache-2.0"]
    found = _whole(spark, [*given.values(), *[_wrapped(t, width) for t in given.values()], filled, given["GPL-3.0"].upper()])
    assert found == [*given, *given, "Apache-2.0", "GPL-3.0"]


def test_lines_that_begin_like_a_holder_are_text(spark):
    kept = ["Copyright notice, this list of conditions", "copyright holders and contributors", "COPYRIGHT HOLDERS BE LIABLE", "(c) You must retain all", "Copyright Holder means"]
    gone = ["Copyright (c) 2020 X", "  copyright 1999 Y", "COPYRIGHT (C) Z", "# Copyright Acme Inc.", "© 2001", "(c) 2020 me", "All rights reserved.", "Copyright by me"]
    rows = spark.createDataFrame([(x,) for x in kept + gone], "t string").select("t", F.size(licences.lines(F.col("t"))).alias("n"))
    assert {r.t for r in rows.collect() if r.n} == set(kept)


def test_scan_equals_its_sql_on_awkward_rows(spark):
    more = [(50, "MIT License\n\n" + SHORT["MIT"]), (50, "MIT License\n\n" + SHORT["MIT"]), (51, "x\n" * 20_000 + "Released under the MIT Licence!"), (52, "MIT License")]
    rows = [(r[0], r[1]) for r in brute.awkward()] + more
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("z") for c in ("_row", "digest", "license", "n_lines")})
    found = licences.scan(docs, licences.known(spark))
    db = duckdb.connect()
    db.register("documents", docs.select("doc_id", "text").toPandas())
    result = db.execute(licences.OP6_SQL)
    got = (found.columns, [tuple(r) for r in found.collect()])
    assert differences(got, ([c[0] for c in result.description], result.fetchall())) is None
    assert licences.scan(brute.empty(spark), licences.known(spark)).isEmpty()
