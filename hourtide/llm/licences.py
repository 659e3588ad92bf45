"""Licence recognition by sentences and rules, with DataFrame functions only.

A text is normalised to words with marks where a sentence may begin or end. Known licence sentences are
searched between such marks, and the numbers of those found, in order, are matched against rules: sequences
of sentence numbers. Line ends, colons and semicolons are marks that a sentence may also run across, since
notices are wrapped and have them inside; the ends of sentences are not. Longer rules go first and use up
what they match, so a full licence is not reported again as a part of it. All of it happens within the
row: nothing is shuffled, and a row needs no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, normalised (letters and digits, lower case, single blanks).
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the apache license version 2 0",
    3: "this work is licensed under the gnu general public license version 3",
    4: "licensed under cc by nc 4 0",
    5: "all rights reserved",
    6: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
    " files the software to deal in the software without restriction including without limitation the rights to use copy modify"
    " merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is"
    " furnished to do so subject to the following conditions",
    7: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    8: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties"
    " of merchantability fitness for a particular purpose and noninfringement",
    9: "licensed under the apache license version 2 0 the license",
    10: "you may not use this file except in compliance with the license",
    11: "you may obtain a copy of the license at http www apache org licenses license 2 0",
    12: "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
    " conditions are met",
    13: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    14: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
    " disclaimer in the documentation and or other materials provided with the distribution",
    15: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission",
    16: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"
    " as published by the free software foundation either version 3 of the license or at your option any later version",
    17: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty"
    " of merchantability or fitness for a particular purpose",
    18: "see the gnu general public license for more details",
    19: "this work is licensed under a creative commons attribution 4 0 international license",
    20: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    21: "this work is dedicated to the public domain",
    22: "mit license",
    23: "spdx license identifier mit",
    24: "spdx license identifier apache 2 0",
    25: "spdx license identifier gpl 3 0 or later",
}
# Fixed values: (licence, the sentences that state it, in order).
RULES = (
    ("Apache-2.0", (2,)),
    ("Apache-2.0", (9, 10, 11)),
    ("Apache-2.0", (9, 10)),
    ("Apache-2.0", (24,)),
    ("BSD-2-Clause", (12, 13, 14)),
    ("BSD-3-Clause", (12, 13, 14, 15)),
    ("CC-BY-4.0", (19,)),
    ("CC-BY-NC-4.0", (4,)),
    ("CC-BY-SA-4.0", (20,)),
    ("GPL-3.0", (3,)),
    ("GPL-3.0", (25,)),
    ("GPL-3.0", (16, 17, 18)),
    ("GPL-3.0", (16,)),
    ("MIT", (1,)),
    ("MIT", (6, 7, 8)),
    ("MIT", (6, 7)),
    ("MIT", (22, 6, 7, 8)),
    ("MIT", (23,)),
    ("proprietary", (5,)),
    ("public-domain", (21,)),
)
#: Where the SQL cuts: no sentence of its runs across a line end, a colon or a semicolon.
END_OF_SENTENCE = r"([.!?;:]|\*/)[ \t\r\n]+"
NOT_WORD = "[^A-Za-z0-9]+"
#: The marks: a sentence ends here, and one may end here.
HARD, SOFT = "\x01", "\x02"
HARD_END = r"(?:[.!?]|\*/)[ \t\r\n]+"
SOFT_END = r"[:;][ \t\r\n]+|\n"


def longest_first(rules=RULES) -> list[tuple[str, str]]:
    """(licence, pattern) with the pattern as it appears in the joined sequence."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r))
    return [(name, "," + ",".join(str(n) for n in numbers) + ",") for name, numbers in ordered]


def sentence_numbers(text: Column, sentences: dict[int, str] = SENTENCES) -> Column:
    """The numbers of the known sentences of a text, in order, as an array. Of sentences that begin at the
    same place the longest counts. The table of known sentences is a parameter of bounded size, held in
    the plan."""
    if not sentences:
        return F.array().cast("array<int>")
    # The marks' own characters are neither words nor blanks where a text has them.
    marked = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit(HARD), F.lit(",")), F.lit(SOFT), F.lit(","))
    marked = F.regexp_replace(F.regexp_replace(marked, HARD_END, HARD), SOFT_END, SOFT)
    words = F.lower(F.regexp_replace(marked, f"[^A-Za-z0-9{HARD}{SOFT}]+", " "))
    between = f"[ {SOFT}]+"
    longest = sorted(sentences.values(), key=lambda w: (-len(w), w))
    pattern = (
        f"(?<=(?:^|[{HARD}{SOFT}]) ?)(?:{'|'.join(w.replace(' ', between) for w in longest)})(?= ?(?:[{HARD}{SOFT}]|\\z))"
    )
    known = F.create_map(*[F.lit(x) for number, words in sentences.items() for x in (words, number)])
    found = F.regexp_extract_all(words, F.lit(pattern), F.lit(0))
    return F.transform(found, lambda s: F.element_at(known, F.regexp_replace(s, between, " ")))


def scan_licences(df: DataFrame, id: str = "doc_id", text: str = "text", sentences: dict[int, str] = SENTENCES, rules=RULES) -> DataFrame:
    """One row per row of ``df``: doc_id, n_sentences, sentence_ids, licences.

    ``sentence_ids`` and ``licences`` are comma-joined, the licences sorted and named once each. A rule
    needs its sentences next to each other among those recognised, whatever stands between them in the
    text. Null and empty texts have no sentences and empty lists. Repeated rows are repeated in the result.
    The query's SQL reads each line and each part between colons or semicolons alone: where no known
    sentence runs across one, both agree.
    """
    found = df.select(df[f"`{id}`"].alias("doc_id"), sentence_numbers(df[f"`{text}`"], sentences).alias("numbers"))
    # Commas doubled, so that neighbouring matches do not share one.
    joined = F.concat(F.lit(","), F.array_join(F.transform("numbers", lambda n: n.cast("string")), ",,"), F.lit(","))
    rest, names = joined, []
    for name, pattern in longest_first(rules):
        wide = pattern[:-1].replace(",", ",,")[1:] + ","
        names.append(F.when(F.contains(rest, F.lit(wide)), name))
        rest = F.replace(rest, F.lit(wide), F.lit(",;,"))
    licences = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))), ",")
    return found.select(
        "doc_id",
        F.size("numbers").cast("bigint").alias("n_sentences"),
        F.array_join(F.transform("numbers", lambda n: n.cast("string")), ",").alias("sentence_ids"),
        licences.alias("licences"),
    )


def _sql() -> str:
    known = ", ".join(f"('{words}', {number})" for number, words in SENTENCES.items())
    steps, previous = [], "joined"
    names = []
    for i, (name, pattern) in enumerate(longest_first()):
        wide = pattern[:-1].replace(",", ",,")[1:] + ","
        steps.append(f"step{i} as (select *, contains({previous}, '{wide}') as hit{i}, replace({previous}, '{wide}', ',;,') as rest{i} from "
                     + (f"step{i - 1}" if i else "sequences") + ")")
        names.append(f"case when hit{i} then '{name}' end")
        previous = f"rest{i}"
    return f"""
with known(words, number) as (values {known}
), lines as (
  select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as place from (
    select doc_id, string_split(regexp_replace(coalesce(text, ''), '{END_OF_SENTENCE}', '\\1\n', 'g'), '\n') as lines from documents)
), found as (
  select doc_id, number, place from lines join known on words = lower(trim(regexp_replace(line, '{NOT_WORD}', ' ', 'g')))
), sequences as (
  select d.doc_id, count(number) as n, coalesce(string_agg(number, ',' order by place), '') as ids,
    ',' || coalesce(string_agg(number, ',,' order by place), '') || ',' as joined
  from documents d left join found f on d.doc_id = f.doc_id group by d.doc_id
), {", ".join(steps)}
select doc_id, n as n_sentences, ids as sentence_ids,
  array_to_string(list_sort(list_distinct(list_filter([{", ".join(names)}], lambda x: x is not null))), ',') as licences
from step{len(steps) - 1}
"""


SQL = _sql()
