"""License scans: canonical digests of whole texts and of single lines, joined to known ones.

A text is taken line by line. Lines that only say whose the rights are go, comment marks and
numbers of list items go, and what is left is lower case, with one spelling of each word that
licences spell in several ways and every run of other characters than letters and digits made
one space. The canonical text is its canonical lines in a row; lines with an SPDX identifier
count as lines, and not as part of the text they stand above. The SHA-256 of text and lines is
looked up by a hash join; nothing is searched for inside a text, so the work is one pass
whatever the number of known licences.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import named, written

# Spellings that count as the same word, in canonical (lower case) text.
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("organisation", "organization"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("whilst", "while"),
    ("ver", "version"),
    ("v", "version"),
]

# Known texts by licence.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("proprietary", "All rights reserved."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
]

# Complete texts, <license>.txt or <license>~<wording>.txt, that count besides KNOWN, with the
# titles they may come under.
WHOLE_TEXTS = Path(__file__).parent / "known_licenses"
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License"],
}
END_OF_TERMS = "END OF TERMS AND CONDITIONS"  # what follows tells how to apply the licence

KNOWN_SCHEMA = "license string, text string"

# What may stand before the words of a line: comment marks and other signs.
_MARKS = r"^[^\p{L}\p{N}]*"
# Lines that only say whose the rights are: "Copyright (c) 2020 Name", "(c) Name", "© Name", with
# a sign or a year behind, or a name. In wrapped wording "copyright" may begin a line too
# ("copyright notice and this"), and "(c)" an item of a list. All patterns are for lower case
# and mean the same in Spark and in SQL.
_SIGN = r"\(c\)|©|\b(19|20)[0-9][0-9]\b|[\[<{(]y{2,4}|[\[<{(]year"
_WORDING = (
    "notices?|holders?|owners?|laws?|licen[sc]es?|licen[sc]ors?|statements?|disclaimers?|interests?|protections?|treaty|doctrines?|"
    "and|or|in|is|are|to|on|of|for|as|with|without|that|which|this|these|any|you|your|if|permission|status|rights?|patents?|trademarks?"
)
SIGNED = rf"{_MARKS}(copyright[^\n]*({_SIGN})|©)"
NAMED = rf"{_MARKS}(copyright|\(c\))[ \t]*:?[ \t]+[^\n]*[\p{{L}}\p{{N}}]"
WORDED = rf"{_MARKS}(copyright|\(c\))[ \t]*:?[ \t]+({_WORDING})\b"
# Goes with such a line when it stands right behind one; alone it is a line of its own.
RESERVED = rf"{_MARKS}all rights reserved[^\p{{L}}\p{{N}}]*$"
ITEM = rf"{_MARKS}[0-9]{{1,2}}[.)][ \t]+"
OTHER = r"[^\p{L}\p{N}]+"
SPDX = "spdx license identifier "


def whole_texts() -> list[tuple[str, str]]:
    """``license, text`` of the complete texts, with and without titles and what follows the terms."""
    rows = []
    for path in sorted(WHOLE_TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        cuts = [text]
        if END_OF_TERMS in text:
            terms = text.split(END_OF_TERMS)[0]
            cuts += [terms, terms + END_OF_TERMS]
        cuts += [t.replace("https://", "http://") for t in cuts if "https://" in t]
        name = path.stem.partition("~")[0]
        rows += [(name, f"{title}\n\n{t}") for t in cuts for title in ("", *TITLES.get(name, ()))]
    return rows


def spelled(text: Column) -> Column:
    """One spelling for each word; words are one space apart."""
    plain = F.concat(F.lit(" "), text, F.lit(" "))
    for odd, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {odd} "), F.lit(f" {usual} "))
    return F.trim(plain)


def with_canonical(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``canonical_lines``, the canonical form of each line that stays, and
    ``canonical``, that of the whole text. Null counts as empty; empty lines stay as such.

    Lines are cut and told apart once: Catalyst copies no expression over a one-row explode.
    """

    def once(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.select("*", F.explode(F.array(value)).alias(name))

    def rights(line: Column) -> Column:
        return line.rlike(SIGNED) | (line.rlike(NAMED) & ~line.rlike(WORDED))

    def kind(line: Column) -> Column:
        return F.when(line.contains("copyright") | line.contains("(c)") | line.contains("©"), F.when(rights(line), 2).otherwise(0)).otherwise(
            F.when(line.contains("all rights reserved") & line.rlike(RESERVED), 1).otherwise(0)
        )

    def plain(line: Column) -> Column:
        return spelled(F.trim(F.regexp_replace(F.regexp_replace(line, ITEM, ""), OTHER, " ")))

    cut = once(df, "__lines", F.split(F.lower(F.coalesce(text, F.lit(""))), "\n"))
    cut = once(cut, "__kinds", F.transform("__lines", kind))
    kept = F.expr("filter(__lines, (l, i) -> __kinds[i] = 0 or (__kinds[i] = 1 and (i = 0 or __kinds[i - 1] <> 2)))")
    lined = once(cut, "canonical_lines", F.transform(kept, plain)).drop("__lines", "__kinds")
    filled = F.filter("canonical_lines", lambda line: line != "")
    whole = F.filter("canonical_lines", lambda line: (line != "") & ~line.startswith(SPDX))
    return lined.withColumn("canonical", spelled(F.array_join(F.when(F.size(whole) > 0, whole).otherwise(filled), " ")))


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """``digest, license``, once each; texts that are canonically empty are nobody's licence."""
    known = spark.createDataFrame([*KNOWN, *whole_texts()], KNOWN_SCHEMA) if known is None else known
    found = with_canonical(known.select("license", "text")).where("canonical <> ''")
    return found.groupBy(F.sha2("canonical", 256).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per document the licence its whole text is, and those its lines name.

    Adds ``whole_license`` (null if the whole text is none), ``line_licenses`` (sorted,
    comma-separated, empty if none) and ``n_license_lines``, replacing input columns of those
    names. A null text is empty and carries no licence, and so does a text without letters and
    digits; a text known under two licences counts as the first by name; rows are answered
    alike however often they occur, and texts that share an id each for itself. No known texts
    leave every row without licence, and no rows give no rows.

    The known digests, one short row each, are the small side of both joins: Spark broadcasts
    them while their bytes allow it and otherwise splits a line that most documents share.
    """
    digests = written(known_digests(docs.sparkSession, known), "license-digests")
    added = ("whole_license", "line_licenses", "n_license_lines")
    kept = [c for c in docs.columns if c not in added]
    own = docs.select(F.struct(*map(named, kept)).alias("row"), docs["doc_id"].alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("hash"))
    made = with_canonical(docs.select(F.col("doc_id").alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("hash"), "text"))
    # A document as one row for its whole text, at place 0, and one for each line.
    lines = F.filter("canonical_lines", lambda line: line != "")
    cut = made.select("id", "hash", F.posexplode(F.concat(F.array("canonical"), lines)).alias("at", "part"))
    met = cut.select("id", "hash", "at", F.sha2("part", 256).alias("digest")).join(digests, "digest")
    of_line = F.when(F.col("at") > 0, F.col("license"))
    found = (
        met.dropDuplicates(["id", "hash", "at"])  # repeated rows have the same lines
        .groupBy(F.col("id").alias("found_id"), F.col("hash").alias("found_hash"))
        .agg(
            F.min(F.when(F.col("at") == 0, F.col("license"))).alias("whole_license"),
            F.concat_ws(",", F.array_sort(F.collect_set(of_line))).alias("line_licenses"),
            F.count(of_line).alias("n"),
        )
    )
    return own.join(found, own["id"].eqNullSafe(F.col("found_id")) & (own["hash"] == F.col("found_hash")), "left").select(
        "row.*",
        "whole_license",
        F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_license_lines"),
    )
