"""License scan by ordered signature rules.

A text is reduced to its words (letters and digits, A-Z lowered), each followed by one space. A keyword gate finds texts worth a look;
in those, rules whose keywords occur are matched. Every match of a rule holds one keyword of each of the rule's groups, and the gate is made of the
first groups of all rules, so neither loses a match. A detection is a span of words; it is dropped when a rule of the same or a higher
priority has already claimed a span that contains it. Everything happens inside a document's row: no shuffle, no join.

A null or empty text has no words and no labels. Phrases may meet any punctuation between words, and all their places count, in texts
of any length. Rows are judged each by itself, so repeated ids and rows need no care; other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm import text as T

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Hand-written signatures: label, the names a license goes by, and the versions it comes in (words as they stand after reduction).
FAMILIES = [
    ("apache", "apache(?: software(?: foundation)?)?", ["1 0", "1 1", "2 0"]),
    ("gpl", "(?:gnu )?(?:gpl|general public)", ["1", "2", "3", "1 0", "2 0", "3 0"]),
    ("lgpl", "(?:gnu )?(?:lgpl|lesser general public|library general public)", ["2", "2 1", "3", "3 0"]),
    ("agpl", "(?:gnu )?(?:agpl|affero general public)", ["1", "3", "3 0"]),
    ("gfdl", "(?:gnu )?(?:gfdl|fdl|free documentation)", ["1 1", "1 2", "1 3"]),
    ("mpl", "(?:mpl|mozilla public)", ["1 0", "1 1", "2 0"]),
    ("epl", "(?:epl|eclipse public)", ["1 0", "2 0"]),
    ("cddl", "(?:cddl|common development and distribution)", ["1 0", "1 1"]),
    ("cpl", "(?:cpl|common public)", ["1 0"]),
    ("artistic", "(?:perl )?artistic", ["1 0", "2 0"]),
    ("bsl", "(?:bsl|boost software|boost)", ["1 0"]),
    ("afl", "(?:afl|academic free)", ["2 1", "3 0"]),
    ("osl", "(?:osl|open software)", ["2 1", "3 0"]),
    ("eupl", "(?:eupl|european union public)", ["1 1", "1 2"]),
    ("ofl", "(?:sil )?(?:ofl|open font)", ["1 0", "1 1"]),
    ("psf", "(?:psf|python software foundation)", ["2", "2 0"]),
    ("php", "php", ["3 0", "3 01"]),
    ("zpl", "(?:zpl|zope public)", ["2 0", "2 1"]),
    ("lppl", "(?:lppl|latex project public)", ["1 2", "1 3"]),
    ("ms-pl", "(?:ms pl|microsoft public)", []),
    ("ms-rl", "(?:ms rl|microsoft reciprocal)", []),
    ("mit", "(?:mit|expat|x11)", []),
    ("isc", "isc", []),
    ("zlib", "(?:zlib|zlib libpng)", []),
    ("ncsa", "(?:ncsa|university of illinois(?: ncsa)?(?: open source)?)", []),
    ("postgresql", "postgresql", []),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to(?: public)?)", ["2"]),
    ("unlicense", "unlicense", []),
    ("openssl", "openssl", []),
    ("ruby", "ruby", []),
    ("vim", "vim", []),
    ("bsd-0", "(?:0bsd|zero clause bsd|bsd zero clause)", []),
    ("bsd-2", "(?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd)", []),
    ("bsd-3", "(?:3 clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd)", []),
    ("bsd-4", "(?:4 clause bsd|bsd 4 clause|original bsd)", []),
    ("bsd", "bsd", []),
    ("odbl", "(?:odbl|open database)", ["1 0"]),
    ("odc-by", "(?:odc by|open data commons attribution)", ["1 0"]),
    ("cc-by-nc-nd", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:nd|noderivs|noderivatives|no derivatives)", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:sa|sharealike|share alike)", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial)", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "(?:cc|creative commons) (?:by|attribution) (?:nd|noderivs|noderivatives|no derivatives)", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "(?:cc|creative commons) (?:by|attribution) (?:sa|sharealike|share alike)", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by", "(?:cc by|creative commons attribution)", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc0", "(?:cc0|cc zero|creative commons zero)", ["1 0"]),
]
#: Hand-written signatures of whole clauses: label, keyword, pattern, priority, score.
CLAUSES = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 0, 1.0),
    ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose", 0, 1.0),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms", 0, 0.95),
    ("bsd-3", "neither the name", "neither the name of [^ ]+(?: [^ ]+){0,8} nor the names of its contributors may be used", 0, 0.95),
    ("zlib", "this software is provided as is", "this software is provided as is without any express or implied warranty in no event will the authors", 0, 0.95),
    ("gpl", "redistribute it and or modify it", "redistribute it and or modify it under the terms of the gnu general public license", 0, 1.0),
    ("lgpl", "redistribute it and or modify it", "redistribute it and or modify it under the terms of the gnu lesser general public license", 0, 1.0),
    ("unlicense", "released into the public domain", "free and unencumbered software released into the public domain", 0, 1.0),
    ("public-domain", "public domain", "(?:in|into|to) the public domain", 2, 0.6),
    ("all-rights-reserved", "rights reserved", "all rights reserved", 2, 0.5),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}", 3, 0.3),
    ("copyright", "copyright", "copyright (?:c )?(?:by|holder|holders|owner|notice)", 3, 0.2),
]
SEPARATOR = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
RULE = "id int, label string, keywords array<array<string>>, pattern string, priority int, score double, base boolean"


def names(pattern: str) -> list[str]:
    """Words that each match of a family's name holds one of, as they stand between spaces."""
    stem = re.match(r"\(\?:cc\|creative commons\) \(\?:by\|attribution\)", pattern)
    least = stem[0] if stem else pattern
    while (short := re.sub(r"\(\?:[^()]*\)\?", "", least)) != least:
        least = short
    choices = [x.split("|") for x in re.split(r"\(\?:([^()]*)\)", least)]
    return sorted({f" {''.join(x)} " for x in itertools.product(*choices)})


def rules() -> list[dict]:
    """Base phrases, whole clauses, and each family's names in every form it is referred to; 0 is the highest priority."""
    found = [(label, [[f" {phrase} "]], phrase, 1, 0.8, True) for phrase, label in BASE.items()]
    found += [(label, [[f" {keyword}"]], *clause, False) for label, keyword, *clause in CLAUSES]
    for label, name, versions in FAMILIES:
        key, spdx, licen = names(name), [" spdx "], [" license", " licence"]
        for version in versions:
            exact = f"{label}-{version.replace(' ', '.')}"
            form = f"(?:v|v |version |ver )?{version}(?: or later| only)?"
            found.append((exact, [key, [f"{version} "]], f"{name}(?: (?:international|unported|public))?(?: licen[cs]e)? {form}(?: licen[cs]e)?(?: international| unported)?", 0, 0.95, False))
            found.append((exact, [spdx, [f"{version} "]], f"spdx licen[cs]e identifier (?:{name}|{label.replace('-', ' ')}) {form}", 0, 1.0, False))
        found.append((label, [spdx], f"spdx licen[cs]e identifier (?:{name}|{label.replace('-', ' ')})", 1, 0.9, False))
        found.append((label, [[" licensed under "], key], f"(?:dual )?licensed under (?:the )?(?:terms of (?:the )?)?(?:a |an )?{name}(?: licen[cs]e)?", 1, 0.9, False))
        found.append((label, [licen, key], f"{name} licen[cs]e", 1, 0.8, False))
        found.append((label, [licen, key], f"licen[cs]e (?:is )?(?:the )?{name}", 2, 0.6, False))
        if label.startswith("cc"):
            found.append((label, [key], name, 1, 0.7, False))
    return [dict(zip(("id", "label", "keywords", "pattern", "priority", "score", "base"), (i, x[0], x[1], f"(?<![^ ]){x[2]} ", *x[3:]), strict=True)) for i, x in enumerate(found)]


def gate() -> str:
    """A pattern found in every text that holds one of the first keywords of any rule, by their first letters."""
    letters: dict[str, list[str]] = {}
    for keyword in sorted({k for rule in rules() for k in rule["keywords"][0]}):
        whole = f"(?![^{SEPARATOR}])" if keyword.endswith(" ") else ""
        letters.setdefault(keyword[1], []).append(keyword.strip()[1:].replace(" ", f"[{SEPARATOR}]+") + whole)
    return f"(?i)(?<![^{SEPARATOR}])(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in letters.items()) + ")"


def detections(words: str, spaced: str, found: str) -> str:
    """SQL: sorted array of start, back (minus the end), priority, id, label, score, base of all matches of the rules in `found`; spaced is
    the words after a space.

    A match's start is marked in the text, so that its word number is the number of the marked word.
    """
    return f"""array_sort(flatten(transform(filter({found}, r -> forall(r.keywords, k -> exists(k, x -> contains({spaced}, x))) AND regexp_like({words}, r.pattern)), r ->
        zip_with(
            filter(transform(split(regexp_replace({words}, r.pattern, '\\u0001$0'), ' '), (w, i) -> if(startswith(w, '\\u0001'), i, -1)), i -> i >= 0),
            transform(regexp_extract_all({words}, r.pattern, 0), m -> length(m) - length(replace(m, ' ', ''))),
            (i, n) -> named_struct('start', i, 'back', -(i + n), 'priority', r.priority, 'id', r.id, 'label', r.label, 'score', r.score, 'base', r.base)))))"""


#: SQL: labels and score that are left of sorted detections `d`; reach holds the furthest end so far for each priority.
RESOLVED = """aggregate(d, named_struct('reach', array(-1, -1, -1, -1), 'labels', cast(array() AS array<string>), 'score', cast(0 AS double), 'kept', cast(0 AS bigint)),
    (a, x) -> if(exists(slice(a.reach, 1, x.priority + 1), e -> e >= -x.back), a,
        named_struct('reach', transform(a.reach, (e, i) -> if(i = x.priority, greatest(e, -x.back), e)), 'labels', array_union(a.labels, array(x.label)),
            'score', greatest(a.score, x.score), 'kept', a.kept + 1)))"""


def reduced(text: Column) -> Column:
    return F.concat(F.trim(F.regexp_replace(T.lower_ascii(text), f"[{SEPARATOR}]+", " ")), F.lit(" "))


def scan(docs: DataFrame, gated: bool = True) -> DataFrame:
    """doc_id, n_words, the base phrases' places and labels, detections (spans of words that rules match, before suppression),
    labels, n_kept (detections that stand) and score of every row. Without the gate and the keywords the same, at a higher cost."""
    known = F.from_json(F.lit(json.dumps(rules() if gated else [rule | {"keywords": []} for rule in rules()])), f"array<struct<{RULE}>>")
    text = F.col("text")
    worth = text.rlike(gate()) if gated else text.isNotNull()
    words = F.struct(reduced(text).alias("words"), F.concat(F.lit(" "), reduced(text)).alias("spaced"), known.alias("rules"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count(text, F.lit(f"[^{SEPARATOR}]+")), F.lit(0)).cast("long").alias("n_words"),
        F.when(worth, F.array(words)).otherwise(F.array()).alias("gated"),
    )
    found = rows.withColumn("d", F.expr(f"coalesce(get(transform(gated, g -> {detections('g.words', 'g.spaced', 'g.rules')}), 0), array())")).drop("gated")
    named = found.withColumn("base", F.filter("d", lambda x: x["base"])).withColumn("resolved", F.expr(RESOLVED))
    labels = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    return named.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["start"])).cast("long").alias("last_word"),
        labels.alias("base_labels"), F.array_sort(F.array_union(labels, F.col("resolved.labels"))).alias("labels"),
        F.col("d").alias("detections"), F.col("resolved.kept").alias("n_kept"), F.col("resolved.score").alias("score"),
    )
