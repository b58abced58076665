"""License scans by ordered signature rules.

A text becomes its words (lower case, letters and digits), joined by single blanks, so
signatures hold across punctuation and line ends; positions are word numbers. A rule has a
regular expression over that form, a keyword that every match contains, a label, a priority and a
confidence. Rules are built from license names (``NAMES``) and statement forms (``FORMS``); short names with
versions and sentences of the license texts themselves are rules of their own (``SHORT``, ``BODIES``).

1. Prefilter: only texts with one of the few general keywords are turned into words and looked
   at, and of the rules only those whose own keyword occurs.
2. Each of these rules finds its intervals.
3. An interval inside another one of higher priority, or of the same priority and longer, is
   dropped; of equal intervals and priorities the first rule wins. So "licensed under the Apache
   License, Version 2.0" is one detection and no plain mention besides.

The base phrases (``BASE``) are reported apart and never suppressed. All on the document's own row,
with DataFrame functions: no shuffle.

Edge cases: null and empty texts have no words, null positions, empty labels and score 0. Repeated rows
and null doc_ids are reported as they come. Other columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import let
from .common import table

# The base phrases and their labels.
BASE = [(("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl")]
BASE_SCORE = 0.9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Label, keyword that every form of the name contains, name as a regular expression over blank-joined words,
# and the identifier as words.
# What may stand before a version number: "version 2", "v 2", "v2" or the number alone.
_V = r"(?: version| v)? v?"
NAMES = [
    ("mit", "mit", r"(?:the )?mit(?: x11)?(?: open source)? license", "mit"),
    ("mit-0", "mit", r"mit no attribution(?: license)?", "mit 0"),
    ("x11", "x11", r"x11 license", "x11"),
    ("isc", "isc", r"isc license", "isc"),
    ("0bsd", "bsd", r"(?:bsd zero clause|zero clause bsd) license", "0bsd"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd) license", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd) license", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd) license", "bsd 4 clause"),
    ("bsd", "bsd", r"bsd(?: style)? license", "bsd"),
    ("apache-1.1", "apache", rf"apache(?: software)? license{_V}1 1", "apache 1 1"),
    ("apache-2.0", "apache", rf"apache(?: software)? license{_V}2(?: 0)?", "apache 2 0"),
    ("apache", "apache", r"apache(?: software)? license", "apache"),
    ("gpl-1.0", "general public", rf"(?:gnu )?general public license{_V}1(?: 0)?", "gpl 1 0"),
    ("gpl-2.0", "general public", rf"(?:gnu )?general public license{_V}2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "general public", rf"(?:gnu )?general public license{_V}3(?: 0)?", "gpl 3 0"),
    ("gpl", "general public", r"(?:gnu )?general public license", "gpl"),
    ("lgpl-2.1", "general public", rf"(?:gnu )?(?:lesser|library) general public license{_V}2(?: 1)?", "lgpl 2 1"),
    ("lgpl-3.0", "general public", rf"(?:gnu )?lesser general public license{_V}3(?: 0)?", "lgpl 3 0"),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public license", "lgpl"),
    ("agpl-3.0", "general public", rf"(?:gnu )?affero general public license(?:{_V}3(?: 0)?)?", "agpl 3 0"),
    ("gfdl-1.3", "documentation", rf"(?:gnu )?free documentation license(?:{_V}1 3)?", "gfdl 1 3"),
    ("mpl-1.1", "mozilla", rf"mozilla public license{_V}1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", rf"mozilla public license(?:{_V}2(?: 0)?)?", "mpl 2 0"),
    ("epl-1.0", "eclipse", rf"eclipse public license{_V}1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", rf"eclipse public license(?:{_V}2(?: 0)?)?", "epl 2 0"),
    ("eupl-1.2", "european", rf"european union public license(?:{_V}1 2)?", "eupl 1 2"),
    ("cddl-1.0", "common development", rf"common development and distribution license(?:{_V}1 0)?", "cddl 1 0"),
    ("ms-pl", "microsoft", r"microsoft public license", "ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", "ms rl"),
    ("bsl-1.0", "boost", rf"boost software license(?:{_V}1 0)?", "bsl 1 0"),
    ("zlib", "zlib", r"zlib(?: libpng)? license", "zlib"),
    ("artistic-1.0", "artistic", rf"artistic license{_V}1(?: 0)?", "artistic 1 0"),
    ("artistic-2.0", "artistic", rf"artistic license(?:{_V}2(?: 0)?)?", "artistic 2 0"),
    ("osl-3.0", "open software", rf"open software license(?:{_V}3 0)?", "osl 3 0"),
    ("afl-3.0", "academic free", rf"academic free license(?:{_V}3 0)?", "afl 3 0"),
    ("ofl-1.1", "font", rf"(?:sil )?open font license(?:{_V}1 1)?", "ofl 1 1"),
    ("odbl-1.0", "database", rf"open (?:data commons open )?database license(?:{_V}1 0)?", "odbl 1 0"),
    ("pddl-1.0", "public domain dedication", r"public domain dedication and license", "pddl 1 0"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "commons attribution", r"creative commons attribution(?: (?:2|3|4) \d)?(?: international)?(?: license)?", "cc by 4 0"),
    ("cc-by-sa", "commons attribution", r"creative commons attribution share ?alike(?: (?:2|3|4) \d)?(?: international)?(?: license)?", "cc by sa 4 0"),
    ("cc-by-nc", "commons attribution", r"creative commons attribution non ?commercial(?: (?:2|3|4) \d)?(?: international)?(?: license)?", "cc by nc 4 0"),
    ("cc-by-nd", "commons attribution", r"creative commons attribution no ?deriv\w*(?: (?:2|3|4) \d)?(?: international)?(?: license)?", "cc by nd 4 0"),
    ("unlicense", "unlicense", r"unlicense", "unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl"),
    ("postgresql", "postgresql", r"postgresql license", "postgresql"),
    ("python-2.0", "python", r"python(?: software foundation)? license(?: 2 0)?", "python 2 0"),
    ("php-3.01", "php", rf"php license(?:{_V}3 01)?", "php 3 01"),
    ("ruby", "ruby", r"ruby license", "ruby"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license", "ncsa"),
    ("openssl", "openssl", r"openssl license", "openssl"),
    ("w3c", "w3c", r"w3c(?: software(?: notice and)?)? license", "w3c"),
]

# Priority, confidence, and the form of the statement around a name {n} or an identifier {i}.
FORMS = [
    (5, 1.0, r"spdx license identifier {i}(?: (?:only|or later))?"),
    (4, 0.98, r"(?:licensed|released|distributed|available|published|provided|covered|dual licensed) (?:under|by) (?:the )?(?:terms of )?(?:the )?{n}(?: (?:only|or later|or any later version))?"),
    (4, 0.95, r"(?:subject to|governed by|under) (?:the )?terms (?:and conditions )?of (?:the )?{n}"),
    (3, 0.9, r"license {i}"),
    (3, 0.85, r"under (?:the )?{n}"),
    (2, 0.6, r"{n}"),
]
# A text without any of these, as written or in capitals, has no license statement. Each is part of one word, so
# punctuation and line ends between words do not hide it, and every rule has one outside its optional parts.
GENERAL = ("licen", "cc0", "commons", "attribution", "wtfpl", "copyright", "domain", "gpl", "hereby", "redistribut", "endorse", "liable")
# Short names: label and expression; the keyword is "gpl".
SHORT = [
    ("agpl-3.0", r"(?:gnu )?agpl ?(?:version )?v? ?3(?: 0)?"),
    ("lgpl-2.1", r"(?:gnu )?lgpl ?(?:version )?v? ?2 1"),
    ("lgpl-3.0", r"(?:gnu )?lgpl ?(?:version )?v? ?3(?: 0)?"),
    ("gpl-1.0", r"(?:gnu )?gpl ?(?:version )?v? ?1(?: 0)?"),
    ("gpl-2.0", r"(?:gnu )?gpl ?(?:version )?v? ?2(?: 0)?"),
    ("gpl-3.0", r"(?:gnu )?gpl ?(?:version )?v? ?3(?: 0)?"),
]
# Sentences of the license texts and of their usual headers: label, keyword, expression.
BODIES = [
    ("mit", "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?"),
    ("bsl-1.0", "hereby granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("isc", "hereby granted", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", r"neither the names? of (?:\S+ ){1,24}may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "endorse or promote", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment(?: \S+){1,60} endorse or promote"),
    ("apache-2.0", "applicable law", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl-2.0", "free software foundation", r"you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation (?:either )?version 2"),
    ("gpl-3.0", "free software foundation", r"you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation (?:either )?version 3"),
    ("lgpl-2.1", "free software foundation", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation (?:either )?version 2(?: 1)?"),
    ("lgpl-3.0", "free software foundation", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation (?:either )?version 3"),
    ("agpl-3.0", "free software foundation", r"you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation (?:either )?version 3"),
    ("gpl", "everyone is permitted", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0"),
    ("zlib", "held liable", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "what the", r"do what the fuck you want to public license"),
    ("cc0-1.0", "dedicated the work", r"has dedicated the work to the public domain by waiving all of (?:his or her|their) rights"),
    ("ofl-1.1", "font software", r"this font software is licensed under the sil open font license"),
]
# Signatures of their own: priority, confidence, label, keyword, expression.
OTHERS = [
    (3, 0.7, "copyright-notice", "copyright", r"copyright(?: c)? (?:19|20)\d\d"),
    (3, 0.8, "proprietary", "copyright", r"copyright(?: \S+){1,8} all rights reserved"),
    (3, 0.8, "public-domain", "public domain", r"(?:in|into|to) the public domain"),
]


def rules() -> list[dict]:
    """All rules, the most telling first."""
    made = [
        {"priority": p, "confidence": c, "label": label, "keyword": label_key if "{n}" in form else ident,
         "pattern": "(?<= )" + form.format(n=f"(?:{name})", i=ident) + "(?= )"}
        for p, c, form in FORMS for label, label_key, name, ident in NAMES
    ]
    more = [(3, 0.85, label, "gpl", rf"{x}(?: (?:only|or later|or any later version))?") for label, x in SHORT]
    more += [(6, 0.99, label, k, x) for label, k, x in BODIES]
    made += [{"priority": p, "confidence": c, "label": label, "keyword": k, "pattern": f"(?<= ){x}(?= )"} for p, c, label, k, x in [*OTHERS, *more]]
    made.sort(key=lambda r: -r["priority"])
    return [r | {"number": i} for i, r in enumerate(made)]


def _table(found: list[dict]) -> Column:
    return F.array(*[F.struct(*[F.lit(r[k]).alias(k) for k in ("number", "priority", "confidence", "label", "keyword", "pattern")]) for r in found])


def _hits(text: Column, rule: Column) -> Column:
    """array of (first word, word after the last, ...) for one rule: gaps between matches give the positions."""
    gaps = F.split(text, rule["pattern"], -1)
    found = F.regexp_extract_all(text, rule["pattern"], F.lit(0))

    def blanks(s: Column) -> Column:
        return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))

    def walk(both: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + blanks(F.get(both["gaps"], i))
            inner = blanks(F.get(both["found"], i))
            hit = F.struct(
                (start - 1).alias("start"), (start + inner).alias("end"), rule["priority"].alias("priority"), rule["number"].alias("number"),
                rule["label"].alias("label"), rule["confidence"].alias("confidence"))
            return F.struct((start + inner).alias("at"), F.array_append(acc["hits"], hit).alias("hits"))

        empty = F.array().cast("array<struct<start:int,end:int,priority:int,number:int,label:string,confidence:double>>")
        return F.aggregate(
            F.sequence(F.lit(0), F.size(both["found"]) - 1), F.struct(F.lit(0).alias("at"), empty.alias("hits")), step, lambda a: a["hits"])

    none = F.array().cast("array<struct<start:int,end:int,priority:int,number:int,label:string,confidence:double>>")
    return F.when(F.rlike(text, rule["pattern"]), let(F.struct(gaps.alias("gaps"), found.alias("found")), walk)).otherwise(none)


def _suppressed(d: Column, e: Column) -> Column:
    """Interval d lies inside e, and e comes first."""
    inside = (e["start"] <= d["start"]) & (e["end"] >= d["end"])
    longer = (e["end"] - e["start"]) > (d["end"] - d["start"])
    first = (e["priority"] > d["priority"]) | ((e["priority"] == d["priority"]) & (longer | (~longer & (e["number"] < d["number"]))))
    return inside & first


def detections(text: Column) -> Column:
    """The detections in blank-joined words with a blank at both ends: start, end (words), rule, label, confidence."""
    def search(t: Column) -> Column:
        fit = F.filter(_table(rules()), lambda r: F.contains(t, r["keyword"]))
        hits = F.flatten(F.transform(fit, lambda r: _hits(t, r)))
        return let(hits, lambda h: F.filter(h, lambda d: ~F.exists(h, lambda e: _suppressed(d, e))))

    return let(text, search)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, places, found) of every row: base places and detections."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lowered = F.lower(text)
    gate = lowered.contains(GENERAL[0])
    for k in GENERAL[1:]:
        gate = gate | lowered.contains(k)
    # The word pattern leaves out capitals; on a text as written it must let them in.
    either = WORDS.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    rows = docs.select("doc_id", text.alias("text"), F.regexp_count(text, F.lit(either)).cast("bigint").alias("n_words"), gate.alias("gate"))
    plain = F.concat(F.lit(" "), F.regexp_replace(F.translate("text", _UPPER, _LOWER), GAPS, " "), F.lit(" "))
    joined = F.when(F.col("gate"), F.regexp_replace(plain, " +", " "))

    def places(words: Column) -> Column:
        def label(i: Column) -> Column:
            out = F.lit(None).cast("string")
            for phrase, name in BASE:
                here = F.get(words, i) == phrase[0]
                for k, w in enumerate(phrase[1:], 1):
                    here = here & F.coalesce(F.get(words, i + k) == w, F.lit(False))
                out = F.when(here, F.lit(name)).otherwise(out)
            return out

        marked = F.transform(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.struct(i.alias("word"), label(i).alias("label")))
        return F.filter(marked, lambda p: p["label"].isNotNull())

    none = F.array().cast("array<struct<word:int,label:string>>")
    base = F.when(F.col("joined").contains(" license "), let(F.split(F.trim("joined"), " "), places)).otherwise(none)
    found = F.when(F.col("joined").isNotNull(), detections(F.col("joined"))).otherwise(
        F.array().cast("array<struct<start:int,end:int,priority:int,number:int,label:string,confidence:double>>"))
    return rows.withColumn("joined", joined).select("doc_id", "n_words", base.alias("places"), found.alias("found"))


def op7_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, own = F.transform("places", lambda p: p["word"]), F.transform("places", lambda p: p["label"])
    every = F.concat(own, F.transform("found", lambda d: d["label"]))
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(words).cast("bigint").alias("first_word"), F.array_max(words).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.greatest(F.when(F.size("places") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)),
                   F.coalesce(F.array_max(F.transform("found", lambda d: d["confidence"])), F.lit(0.0))).alias("score"),
        F.size("found").alias("n_found"))


QUERIES = {"op7_license_rules": op7_license_rules}
ORACLES: dict[str, str] = {}
