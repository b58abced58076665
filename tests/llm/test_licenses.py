import random
import re
from collections import Counter

from pyspark.sql import functions as F

from conftest_helpers import DOCS, prose
from conftest_helpers import lower
from sparkcurate.llm import licenses as L

WORDS = re.compile(L.WORDS)
LINES = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: BSD-3-Clause", "the Mozilla Public License 2.0", "MIT License MIT license", "apache\nlicense", "general-public license",
    "Copyright (c) 2019 Somebody Inc. All rights reserved.", "placed into the public domain", "LGPL: GNU Lesser General Public License v2.1", "no licence here", "mitlicense",
]


def base(text):
    w = WORDS.findall(lower(text))
    found = [(i, label) for i in range(len(w)) for phrase, label in L.BASE if tuple(w[i : i + len(phrase)]) == phrase]
    return len(w), found


def plain_detections(text):
    """The rules one by one and the suppression, in plain Python."""
    if not any(g in text.lower() for g in L.GENERAL):
        return []
    joined = " " + " ".join(WORDS.findall(lower(text))) + " "
    hits = []
    for r in L.rules():
        if r["keyword"] in joined:
            for m in re.finditer(r["pattern"], joined):
                start = joined[: m.start()].count(" ") - 1
                hits.append((start, start + 1 + m[0].count(" "), r))
    return [
        (a, b, r["label"], r["number"]) for a, b, r in hits
        if not any(x <= a and y >= b and (q["priority"] > r["priority"] or (q["priority"] == r["priority"] and (y - x > b - a or (y - x == b - a and q["number"] < r["number"]))))
                   for x, y, q in hits)]


def texts():
    rng = random.Random(6)
    out = [None, "", "   ", "é license", *LINES, "\n".join(LINES)]
    for _ in range(30):
        out.append(prose(rng, 30) + "\n" + rng.choice(LINES) + "\n" + prose(rng, 10) + " " + rng.choice(LINES).upper())
    out.append(" ".join(["Licensed under the MIT License."] * 60))
    return out


def test_against_brute_force(spark, tmp_path):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts())] + [(4, LINES[0], None, None, None), (None, LINES[1], None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = L.op7_license_rules(spark, str(tmp_path)).collect()

    def want(i, t):
        n, found = base(t or "")
        labels = {label for _, label in found}
        every = labels | {d[2] for d in plain_detections(t or "")}
        at = [a for a, _ in found]
        return (i, n, len(found), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(every)))

    assert Counter(tuple(r)[:7] for r in got) == Counter(want(i, t) for i, t, *_ in rows)
    assert all(0 <= r.score <= 1 for r in got)


def test_one_statement_is_one_detection(spark):
    df = spark.createDataFrame([("x", LINES[0]), ("y", LINES[2])], "doc_id string, text string").withColumn("joined", F.lit(1)).withColumn("found", F.lit(2))
    got = {r.doc_id: [(d.start, d.end, d.label) for d in r.found] for r in L.scan(df).collect()}
    assert got == {"x": [(0, 8, "apache-2.0")], "y": [(3, 12, "gpl-3.0")]}


def test_rules_and_empty(none):
    found = L.rules()
    assert len(found) > 300 and all(re.compile(r["pattern"]) for r in found)
    assert L.scan(none).collect() == []


def ungated(text):
    """Labels of the rules without any gate or keyword."""
    joined = " " + " ".join(WORDS.findall(lower(text))) + " "
    return {r["label"] for r in L.rules() if re.search(r["pattern"], joined)}


def test_rules_across_gaps_without_any_gate(spark):
    lines = ["Creative\nCommons Attribution 4.0", "given into the public-domain", "MIT No Attribution", "creative--commons\tATTRIBUTION share-alike 3.0",
             "to the\nPublic\nDomain", "Under MIT-No-Attribution", "CC0", "wtfpl", "copyright\n2020", "domain of commons", "x" * 20]
    wants = [ungated(t) for t in lines]
    assert all(wants[:9]) and not any(wants[9:])
    got = {r.doc_id: {d.label for d in r.found} for r in L.scan(spark.createDataFrame(list(enumerate(lines)), "doc_id int, text string")).collect()}
    for i, want in enumerate(wants):  # suppression may hide a weaker label, never all
        assert got[i] <= want and bool(got[i]) == bool(want)
    assert [got[i] for i in range(3)] == [{"cc-by"}, {"public-domain"}, {"mit-0"}]


def test_every_rule_has_a_general_keyword_in_one_word():
    for r in L.rules():
        needed, before = r["pattern"].replace("(?<= )", "").replace("(?= )", ""), None
        while needed != before:
            needed, before = re.sub(r"\(\?:[^()]*\)\?", "", needed), needed
        needed = re.sub(r"\(\?:[^()]*\|[^()]*\)", "", needed)  # no keyword out of alternatives
        assert any(g in needed for g in L.GENERAL), r
    assert not any(" " in g for g in L.GENERAL)


# Written by hand: what stands in files, and the labels that must be found.
RECALL = [
    ("Apache License v2.0", "apache-2.0"), ("Apache License V2", "apache-2.0"), ("Apache Software License, Version 1.1", "apache-1.1"),
    ("GNU General Public License v3.0", "gpl-3.0"), ("GNU General Public License, v 2", "gpl-2.0"), ("licensed under GPLv3", "gpl-3.0"),
    ("License: GPL-2.0-or-later", "gpl-2.0"), ("GPL v2 or later", "gpl-2.0"), ("LGPLv2.1", "lgpl-2.1"), ("distributed under the GNU LGPL version 3", "lgpl-3.0"),
    ("AGPL-3.0", "agpl-3.0"), ("GNU AGPLv3", "agpl-3.0"), ("Mozilla Public License v2.0", "mpl-2.0"), ("Eclipse Public License v1.0", "epl-1.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\n of this software and associated documentation files (the \"Software\")", "mit"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted", "isc"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that", "bsd"),
    ("* Neither the name of the copyright holder nor the names of its\n contributors may be used to endorse or promote products derived from\n this software", "bsd-3-clause"),
    ("Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,", "apache-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by\n"
     "# the Free Software Foundation, either version 3 of the License, or", "gpl-3.0"),
    ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1", "lgpl-2.1"),
    ("Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.", "gpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("In no event will the authors be held liable for any damages\narising from the use of this software.", "zlib"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by", "bsl-1.0"),
]
CLEAN = ["He was held for a while and granted nothing.", "permission was granted to the person", "version 2.0 of the program", "a general public, licensed drivers", "redistribute the wealth",
         "The authors endorse no product.", "gplus 3", "x GPL"]


def test_recall_of_written_statements(spark):
    rows = [(i, t) for i, (t, _) in enumerate(RECALL)] + [(1000 + i, "before. " + t + " after") for i, (t, _) in enumerate(RECALL)] + [(-1 - i, t) for i, t in enumerate(CLEAN)]
    got = {r.doc_id: {d.label for d in r.found} for r in L.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i, (_, label) in enumerate(RECALL):
        assert label in got[i] and label in got[1000 + i], RECALL[i]
    assert not any(got[-1 - i] for i in range(len(CLEAN)))
