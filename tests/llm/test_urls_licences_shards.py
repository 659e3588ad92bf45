import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from hourtide.llm import hilbert, host_reputation, licences


def judged(spark, urls, **how):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    return [tuple(r) for r in host_reputation.judge(df, **how).orderBy("page_id").select("host", "path", "rule", "verdict").collect()]


def test_hosts_paths_and_rules(spark):
    urls = [
        "https://WWW.Example.com/en/x?q#f", "http://a.example.com/en/", "http://other.com", "http://x.net/es/1", "//no.scheme/", None, "",
        "a://b://c/d", "http://notexample.com/en/", "http://exampleénet.org?x=/en/", "http://h#://i/", "http://net/fr/",
    ]
    found = judged(spark, urls)
    assert found[0] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert found[1] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert found[2] == ("other.com", "", None, found[2][3])
    assert found[3][2:] == ("net/es/", "block") and found[4][:3] == ("", "", None) == found[5][:3] == found[6][:3]
    assert found[7][:2] == ("b:", "//c/d") and found[8][2:] == ("com/", "allow")
    assert found[9][:2] == ("exampleénet.org", "") and found[10][:2] == ("h", "") and found[11][2] == "net/fr/"


def test_evidence_outweighs_relatives_and_none_does_not(spark):
    """A host with many good pages in a bad domain is allowed, one without labels follows its domain."""
    rows = [(f"bad{i}.evil.org", 1) for i in range(20) for _ in range(10)] + [("good.evil.org", 0)] * 200 + [("new.evil.org", None)]
    rows += [(f"site{i}.fair.org", 0) for i in range(20) for _ in range(10)] + [("new.fair.org", None), ("new.unknown.info", None)]
    df = spark.createDataFrame([(i, f"http://{h}/", b) for i, (h, b) in enumerate(rows)], "page_id bigint, url string, bad int")
    found = {r["host"]: r for r in host_reputation.judge(df, label="bad", rules=()).collect()}
    assert found["bad3.evil.org"]["verdict"] == "block" and found["good.evil.org"]["verdict"] == "allow"
    assert found["new.evil.org"]["bad_share"] > 0.4 > found["new.fair.org"]["bad_share"] and found["new.fair.org"]["verdict"] == "allow"
    assert found["new.unknown.info"]["verdict"] == "allow"


def test_long_suffixes(spark):
    row = spark.range(1).select(*[f(F.lit("a.b.co.uk")) for f in (host_reputation.domain_of, host_reputation.suffix_of)]).first()
    assert tuple(row) == ("b.co.uk", "co.uk")


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_curve_visits_every_cell_by_single_steps(spark, dims, bits):
    cells = [(list(p),) for p in itertools.product(range(1 << bits), repeat=dims)]
    df = spark.createDataFrame(cells, "p array<int>").select("p", hilbert.curve_index(F.col("p"), dims, bits).alias("i"))
    path = [r["p"] for r in sorted(df.collect(), key=lambda r: r["i"])]
    assert sorted(r["i"] for r in df.collect()) == list(range(1 << dims * bits))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(path, path[1:]))


def test_shards_are_gapless_near_equal_and_narrow(spark, documents):
    found = [r.asDict() for r in hilbert.shard_by_curve(documents, shards=8).collect()]
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in found} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
    total, largest = sum(r["size"] for r in found), max(r["size"] for r in found)
    for shard in range(8):
        own = [r for r in found if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 8) <= largest
    in_order = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in in_order] == sorted(r["curve"] for r in found)


def test_licences_by_rules(spark):
    mit = licences.SENTENCES[6].capitalize() + ":\n\n" + licences.SENTENCES[7] + ".\n" + licences.SENTENCES[8] + "."
    texts = ["MIT License\n" + mit, mit, "Prose.  Released under the\tMIT License. More. All rights reserved.", "Licensed under CC BY-NC 4.0.", None,
             "released under the mit licenses", " ".join(licences.SENTENCES[i] + "." for i in (12, 13, 14)), " ".join(licences.SENTENCES[i] + "." for i in (12, 14, 13)),
             "All rights reserved. All rights reserved."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = [(r["sentence_ids"], r["licences"]) for r in licences.scan_licences(df).orderBy("doc_id").collect()]
    assert found == [("22,6,7,8", "MIT"), ("6,7,8", "MIT"), ("1,5", "MIT,proprietary"), ("4", "CC-BY-NC-4.0"), ("", ""), ("", ""),
                     ("12,13,14", "BSD-2-Clause"), ("12,14,13", ""), ("5,5", "proprietary")]


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
APACHE = """# Copyright 2020 Somebody
#
# Licensed under the Apache License, Version 2.0
# (the "License"); you may not use this file except in compliance
# with the License. You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, ...
"""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details. */
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_standard_notices_as_they_are_wrapped(spark):
    texts = [MIT, APACHE, GPL, BSD, BSD[: BSD.index("3.")], "x = 1\n// SPDX-License-Identifier: MIT\ny = 2", "# SPDX-License-Identifier: Apache-2.0",
             "/* SPDX-License-Identifier: GPL-3.0-or-later */", MIT.replace("\n", "\r\n"), "SPDX-License-Identifier: MIT OR Apache-2.0",
             "All. Rights reserved.", "all\x02rights reserved", "We keep not all rights reserved.", "Mind: all rights\nreserved; thanks"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = [(r["sentence_ids"], r["licences"]) for r in licences.scan_licences(df).orderBy("doc_id").collect()]
    assert found == [("22,6,7,8", "MIT"), ("9,10,11", "Apache-2.0"), ("16,17,18", "GPL-3.0"), ("12,13,14,15", "BSD-3-Clause"), ("12,13,14", "BSD-2-Clause"),
                     ("23", "MIT"), ("24", "Apache-2.0"), ("25", "GPL-3.0"), ("22,6,7,8", "MIT"), ("", ""), ("", ""), ("5", "proprietary"), ("", ""), ("5", "proprietary")]


def test_unruled_pages_speak_for_their_host(spark):
    """Hosts under a suffix whose rules only block: one in four pages blocked leaves the others allowed, nearly all blocks them.
    Null, repeated and clashing rows come back as often as they are given; an empty table gives none."""
    few = [(i, f"http://a.net/{'es/' if i % 4 == 0 else 'it/'}{i}", "x", 1) for i in range(40)]
    many = [(100 + i, f"http://b.net/{'es/' if i < 60 else 'it/'}{i}", "x", 1) for i in range(62)]
    rows = [*few, *many, few[0], few[1], (None, None, None, None), (7, None, "y", 2), (None, "no address", "y", 2)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, host string, bad int")
    found = host_reputation.judge(frame).collect()
    assert sorted(str(r["page_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    unruled = {host: {r["verdict"] for r in found if r["host"] == host and r["rule"] is None} for host in ("a.net", "b.net", "")}
    assert unruled == {"a.net": {"allow"}, "b.net": {"block"}, "": {"allow"}}
    assert {r["verdict"] for r in found if r["rule"]} == {"block"}
    assert host_reputation.judge(frame.where("false")).count() == 0
