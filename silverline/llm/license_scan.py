"""Operator 7: licence scans by sentence rules.

A text is split into sentences; a sentence is normalised (lower case, comment
marks and punctuation to single spaces) and looked up among the known licence
sentences, whose identifiers are short strings. A licence rule is an ordered list
of identifiers; it matches where its identifiers stand in that order, each with
at most ``max_gap`` other sentences, known or not, between neighbours. Of matches with one
last sentence, the one that starts last is reported. Everything is built-in
array work on one row, so nothing is shuffled; the catalogues are small fixed
values and can be replaced by the caller's own.

Texts wrapped at a margin have line breaks within sentences, and headings or
tables have sentences that only a line break ends. So rules of several sentences are matched
in the text cut at sentence ends, and rules of one sentence, the mentions, in the
text cut at every line break as well; a mention that both cuttings have is one.

Result per match: doc_id, licence, rule, the numbers of its first and last sentence
in that cutting (of a mention, cut at every line break if that has it), and ``complete`` (false for a mention). Mentions of a licence
are not reported where a complete rule of that licence matches.

Defined results: null and empty texts have no match; repeated rows are scanned
alike; each occurrence of a rule is reported once. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import let, read, text_or_empty

# Normalised sentences of public licence texts and notices.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to "
    "the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-as-is",
    "released under the mit license": "mit-mention",
    "licensed under the mit license": "mit-mention",
    "licensed under the apache license version 2 0": "apache-mention",
    "licensed under the apache license version 2 0 the license": "apache-mention",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is "
    "distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "this work is licensed under the gnu general public license version 3": "gpl3-mention",
    "licensed under the gnu general public license version 2": "gpl2-mention",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 3 of the license or at your option "
    "any later version": "gpl3-grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose": "gpl-no-warranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "licensed under cc by nc 4 0": "cc-by-nc-mention",
    "licensed under cc by 4 0": "cc-by-mention",
    "licensed under cc by sa 4 0": "cc-by-sa-mention",
}
# Rule, licence, complete, identifiers in order.
RULES = [
    ("mit-full", "MIT", True, ["mit-grant", "mit-notice", "mit-as-is"]),
    ("mit-mention", "MIT", False, ["mit-mention"]),
    ("apache-header", "Apache-2.0", True, ["apache-mention", "apache-compliance", "apache-copy", "apache-as-is"]),
    ("apache-mention", "Apache-2.0", False, ["apache-mention"]),
    ("gpl3-header", "GPL-3.0", True, ["gpl3-grant", "gpl-no-warranty"]),
    ("gpl3-mention", "GPL-3.0", False, ["gpl3-mention"]),
    ("gpl2-mention", "GPL-2.0", False, ["gpl2-mention"]),
    ("bsd2-full", "BSD-2-Clause", True, ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("cc-by-nc-mention", "CC-BY-NC-4.0", False, ["cc-by-nc-mention"]),
    ("cc-by-mention", "CC-BY-4.0", False, ["cc-by-mention"]),
    ("cc-by-sa-mention", "CC-BY-SA-4.0", False, ["cc-by-sa-mention"]),
]
MAX_GAP = 2
# A sentence ends at a mark before white space, at a line that is empty or ends
# with a mark or colon, and before a line that starts like a list item.
WRAPPED_END = r"(?<=[.!?;:])\s+|\n\s*\n|\n(?=\s*(?:[-*]|\(?[0-9a-z]\))\s)"
LINE_END = r"(?<=[.!?;:])\s+|\n"
# Cheap test: a text without any of these words holds no known sentence.
HINT = r"(?i)licen[sc]e|permission|copyright|redistribut|warrant|free software"


def sentences(text: Column, end: str) -> Column:
    """Normalised sentences; the empty ones between marks stay, as places."""
    return F.transform(
        F.split(text, end, -1),
        lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")),
    )


def _identified(parts: Column, catalogue: dict[str, str]) -> Column:
    """Array of (n, id): the known ones of the sentences ``parts`` and their numbers, in order."""
    known = F.create_map(*[F.lit(x) for kv in sorted(catalogue.items()) for x in kv])
    return F.filter(
        F.transform(parts, lambda s, n: F.struct(n.alias("n"), F.try_element_at(known, s).alias("id"))),
        lambda x: x["id"].isNotNull(),
    )


def _matches(ids: Column, rule: tuple, max_gap: int) -> Column:
    """Array of (first, last, rule, licence, complete) for one rule."""
    name, licence, complete, wanted = rule

    def ends(at: Column, want: list[str]) -> Column:
        """From places ``at``, those where all of ``want`` have been found in order."""
        if not want:
            return at
        following = F.filter(
            ids, lambda y: (y["id"] == want[0]) & F.exists(at, lambda p: (y["n"] > p) & (y["n"] - p - 1 <= max_gap))
        )
        return let(F.transform(following, lambda y: y["n"]), lambda found: ends(found, want[1:]))

    starts = F.transform(
        F.filter(ids, lambda x: x["id"] == wanted[0]),
        lambda x: F.struct(
            x["n"].alias("first"),
            F.array_min(ends(F.array(x["n"]), wanted[1:])).alias("last"),
            F.lit(name).alias("rule"),
            F.lit(licence).alias("licence"),
            F.lit(complete).alias("complete"),
        ),
    )
    # A later start never ends earlier, so equal ends stand side by side.
    return let(
        F.filter(starts, lambda m: m["last"].isNotNull()),
        lambda found: F.filter(
            found, lambda m, i: F.coalesce(F.get(found, i + 1)["last"] != m["last"], F.lit(True))
        ),
    )


def _letters(parts: Column, n: Column) -> Column:
    """How many letters and digits the first ``n`` sentences hold: the same place in any cutting."""
    return F.aggregate(
        F.slice(parts, 1, n), F.lit(0), lambda total, s: total + F.length(F.replace(s, F.lit(" "), F.lit("")))
    )


def scan(
    docs: DataFrame,
    catalogue: dict[str, str] = SENTENCES,
    rules: list[tuple] = RULES,
    max_gap: int = MAX_GAP,
    hint: str | None = None,
) -> DataFrame:
    """One row per match of a rule: doc_id, licence, rule, first, last, complete.

    ``hint`` is a pattern without which a text can hold no sentence of ``catalogue``; the
    built-in catalogue has its own, another is looked for in every text if none is given. An
    empty one leaves no text out.
    """
    if hint is None and catalogue is SENTENCES:
        hint = HINT
    rows = docs.select("doc_id", text_or_empty().alias("t"))
    if hint is not None:
        rows = rows.where(F.col("t").rlike(hint))

    def matches(parts: Column, mine: list[tuple]) -> Column:
        none = F.expr(
            "cast(array() as array<struct<first:int,last:int,rule:string,licence:string,complete:boolean>>)"
        )
        return let(
            _identified(parts, catalogue),
            lambda ids: F.concat(none, *[_matches(ids, r, max_gap) for r in mine]),
        )

    def placed(parts: Column) -> Column:
        """The matches (m) of the one-sentence rules, and where they start (a) and end (b) in the text."""
        return F.transform(
            matches(parts, [r for r in rules if len(r[3]) == 1]),
            lambda m: F.struct(
                m.alias("m"), _letters(parts, m["first"]).alias("a"), _letters(parts, m["last"] + 1).alias("b")
            ),
        )

    def merged(by_line: Column, by_mark: Column) -> Column:
        def there(x: Column) -> Column:
            return F.exists(
                by_line, lambda y: (y["m"]["rule"] == x["m"]["rule"]) & (y["a"] < x["b"]) & (x["a"] < y["b"])
            )

        return F.transform(F.concat(by_line, F.filter(by_mark, lambda x: ~there(x))), lambda x: x["m"])

    def with_mentions(long: Column, short: Column) -> Column:
        return F.concat(long, F.filter(short, lambda m: ~F.exists(long, lambda o: o["licence"] == m["licence"])))

    def all_of(by_mark: Column, by_line: Column) -> Column:
        long = matches(by_mark, [r for r in rules if len(r[3]) > 1])
        short = let(placed(by_line), lambda x: let(placed(by_mark), lambda y: merged(x, y)))
        return let(long, lambda x: let(short, lambda y: with_mentions(x, y)))

    found = let(
        sentences(F.col("t"), WRAPPED_END), lambda x: let(sentences(F.col("t"), LINE_END), lambda y: all_of(x, y))
    )
    rows = rows.select("doc_id", F.explode(found).alias("m"))
    return rows.select(
        "doc_id", *[F.col("m")[c].alias(c) for c in ("licence", "rule", "first", "last", "complete")]
    )


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every match over the whole texts of ``documents``."""
    found = scan(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "licence", "rule", F.col("first").cast("bigint").alias("first_sentence"),
        F.col("last").cast("bigint").alias("last_sentence"), "complete",
    )
