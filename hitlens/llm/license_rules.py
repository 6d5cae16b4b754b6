"""License scan: ordered signature rules behind a keyword prefilter, with overlapping detections resolved.

A text becomes its lower-cased words joined by single spaces. A text without any gate word is done after that. In the
others each word that can start a rule gives a place; the words from there on are tried by the rules whose keyword
they contain. Of the rules that match at one place the longest counts, then the one of higher priority; a detection
inside another's interval is suppressed, and of two that overlap in part the lower priority (then the later) goes.
Detections span at most ``SPAN`` words, so each is compared with its nearest neighbours only.

DataFrame functions only, nothing is shuffled, and the work on a long text grows with its length.

Defined results: a null or wordless text has no words, no labels and score 0; repeated rows are scanned one by one;
an empty table gives an empty result; extra columns pass, a clashing one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm.common import lower_ascii, others, register, table
from hitlens.rules import settled

# fixed values: phrases and labels of the base count
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# names as they appear in running words, versions as separate words
NAMES: dict[str, str] = {
    "mit": r"(?:expat )?mit",
    "mit-0": r"mit (?:no attribution|0)",
    "apache-1.1": r"apache(?: software)?(?: license)? (?:version |v)?1 1",
    "apache-2.0": r"apache(?: software)?(?: license)? (?:version |v)?2(?: 0)?",
    "apache": r"apache(?: software)?",
    "gpl-1.0": r"(?:gnu )?(?:general public license|gpl)(?: version| v)? ?1(?: 0)?",
    "gpl-2.0": r"(?:gnu )?(?:general public license|gpl)(?: version| v)? ?2(?: 0)?",
    "gpl-3.0": r"(?:gnu )?(?:general public license|gpl)(?: version| v)? ?3(?: 0)?",
    "gpl": r"(?:gnu general public|gnu gpl|gpl)",
    "lgpl-2.1": r"(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?2 1",
    "lgpl-3.0": r"(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?3(?: 0)?",
    "lgpl": r"(?:gnu (?:lesser|library) general public|gnu lgpl|lgpl)",
    "agpl-3.0": r"(?:gnu )?(?:affero general public license|agpl)(?: version| v)? ?3(?: 0)?",
    "agpl": r"(?:gnu affero general public|gnu agpl|agpl)",
    "gfdl-1.3": r"(?:gnu )?(?:free documentation license|gfdl)(?: version| v)? ?1 3",
    "gfdl": r"(?:gnu free documentation|gfdl)",
    "bsd-2-clause": r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)",
    "bsd-3-clause": r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)",
    "bsd-4-clause": r"(?:bsd 4 clause|4 clause bsd|original bsd)",
    "0bsd": r"(?:0bsd|zero clause bsd|bsd zero clause)",
    "bsd": r"bsd(?: style)?",
    "isc": r"isc",
    "zlib": r"zlib(?: libpng)?",
    "libpng": r"libpng(?: 2 0)?",
    "mpl-1.1": r"(?:mozilla public license|mpl)(?: version| v)? ?1 1",
    "mpl-2.0": r"(?:mozilla public license|mpl)(?: version| v)? ?2(?: 0)?",
    "mpl": r"(?:mozilla public|mpl)",
    "epl-1.0": r"(?:eclipse public license|epl)(?: version| v)? ?1(?: 0)?",
    "epl-2.0": r"(?:eclipse public license|epl)(?: version| v)? ?2(?: 0)?",
    "cddl-1.0": r"(?:common development and distribution license|cddl)(?: version| v)? ?1(?: 0)?",
    "cpl-1.0": r"(?:common public license|cpl)(?: version| v)? ?1(?: 0)?",
    "eupl-1.2": r"(?:european union public license|eupl)(?: version| v)? ?1 2",
    "artistic-1.0": r"artistic(?: license)? 1(?: 0)?",
    "artistic-2.0": r"artistic(?: license)? 2(?: 0)?",
    "artistic": r"artistic",
    "bsl-1.0": r"boost software(?: license)?(?: version)?(?: 1(?: 0)?)?",
    "unlicense": r"(?:the )?unlicense",
    "wtfpl": r"wtfpl(?: version)?(?: 2)?",
    "ofl-1.1": r"(?:sil )?open font(?: license)?(?: version)? ?(?:1 1)?",
    "psf-2.0": r"(?:python software foundation|psf)(?: license)?(?: version)?(?: 2)?",
    "postgresql": r"postgresql",
    "openssl": r"openssl",
    "odbl-1.0": r"(?:open database|odbl)(?: license)?(?: v?1 0)?",
    "cc0-1.0": r"(?:cc0|cc zero|creative commons zero)(?: 1 0)?(?: universal)?",
    "cc-by-3.0": r"(?:cc by|creative commons attribution)(?: version)? 3 0",
    "cc-by-4.0": r"(?:cc by|creative commons attribution)(?: version)? 4 0",
    "cc-by-sa-3.0": r"(?:cc by sa|creative commons attribution share ?alike)(?: version)? 3 0",
    "cc-by-sa-4.0": r"(?:cc by sa|creative commons attribution share ?alike)(?: version)? 4 0",
    "cc-by-nc-4.0": r"(?:cc by nc|creative commons attribution non ?commercial)(?: version)? 4 0",
    "cc-by-nd-4.0": r"(?:cc by nd|creative commons attribution no ?derivatives)(?: version)? 4 0",
    "cc-by-nc-sa-4.0": r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: version)? 4 0",
    "cc-by-nc-nd-4.0": r"(?:cc by nc nd|creative commons attribution non ?commercial no ?derivatives)(?: version)? 4 0",
    "proprietary": r"(?:proprietary|commercial)",
}
# a licence's own wording, without its name: keyword, pattern, label, weight; these go before the forms of notices
BODIES = [
    ("permission is hereby", r"permission is hereby granted free of charge to any person or organization(?: obtaining a copy(?: of the software)?)?", "bsl-1.0", 1.0),
    ("permission is hereby", r"permission is hereby granted free of charge(?: to any person(?: obtaining a copy(?: of this software)?)?)?", "mit", 0.95),
    ("above copyright notice", r"the above copyright notice and this permission notice shall be included(?: in all copies)?", "mit", 0.9),
    ("permission to use", r"permission to use copy modify (?:and or|and|or) distribute this software(?: and its documentation)?(?: for any purpose(?: with or without fee)?)?", "isc", 0.9),
    ("redistribution and use", r"redistribution and use in source and binary forms(?: with or without modification(?: are permitted)?)?", "bsd", 0.95),
    ("redistributions", r"redistributions (?:of source code must retain|in binary form must reproduce) the above copyright notice", "bsd", 0.9),
    ("neither the name", r"neither the names? of (?:[^ ]+ ){1,8}?nor the names of (?:its|their|any) contributors", "bsd-3-clause", 0.95),
    ("all advertising materials", r"all advertising materials mentioning features or use of this software", "bsd-4-clause", 0.95),
    ("express or implied warranty", r"this software is provided as is without any express or implied warranty", "zlib", 0.9),
    ("origin of this software", r"the origin of this software must not be misrepresented", "zlib", 0.95),
    ("in compliance with the license", r"you may not use this file except in compliance with the license", "apache", 0.9),
    ("is free software", r"this (?:program|library|file|software) is free software you can redistribute it and or modify it", "gnu-notice", 0.9),
    ("verbatim copies", r"everyone is permitted to copy and distribute verbatim copies of this license document", "gnu-notice", 0.95),
    ("this source code form", r"this source code form is subject to the terms of the mozilla public license(?: v 2 0)?", "mpl-2.0", 1.0),
    ("unencumbered", r"this is free and unencumbered software(?: released into the public domain)?", "unlicense", 1.0),
    ("you want to", r"do what the fuck you want to public license", "wtfpl", 1.0),
    ("as is", r"(?:the|this) software is provided (?:by (?:[^ ]+ ){1,8}?)?as is(?: without warranty of any kind)?", "warranty-disclaimer", 0.5),
    ("implied warrant", r"(?:any )?express or implied warranties including but not limited to", "warranty-disclaimer", 0.5),
    ("implied warranty", r"without any warranty without even the implied warranty of merchantability", "warranty-disclaimer", 0.5),
    ("all rights reserved", r"all rights reserved", "all-rights-reserved", 0.3),
]
# form of a notice: keyword, pattern around the name, weight; the order is the priority
FORMS = [
    ("spdx", r"spdx license identifier {name}(?: only| or later)?", 1.0),
    ("licens", r"licensed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{name}(?: license)?(?: version [0-9]+(?: 0)?)?", 0.95),
    ("released", r"released under (?:the )?(?:terms of (?:the )?)?{name}(?: license)?", 0.95),
    ("distributed", r"distributed under (?:the )?(?:terms of (?:the )?)?{name}(?: license)?", 0.9),
    ("terms", r"(?:subject to|under) the terms of (?:the )?{name}(?: license)?", 0.85),
    ("licens", r"{name} licensed?", 0.6),
]
GATES = ["licens", "spdx", "released under", "distributed under", "the terms of"]
GATES += ["permission is hereby", "permission to use", "above copyright notice", "redistribution and use", "neither the name", "all advertising materials"]
GATES += ["software is provided", "origin of this software", "is free software", "implied warrant", "unencumbered", "you want to public", "all rights reserved"]
STARTS = ["spdx", "licensed", "released", "distributed", "subject", "under"]
STARTS += "permission redistribution redistributions neither all this the you everyone do any express without".split()
SPAN = 20  # words of the longest match
_FIRST_WORDS = (
    "expat mit apache gnu general gpl lesser lgpl affero agpl free gfdl bsd 2 3 4 0bsd zero simplified freebsd new modified "
    "revised original isc zlib libpng mozilla mpl eclipse epl common cddl cpl european eupl artistic boost the unlicense "
    "wtfpl sil open python psf postgresql openssl odbl cc0 cc creative proprietary commercial library"
).split()


def rule_table() -> list[tuple[str, str, str, int, float]]:
    """The bodies, then every form with every name: keyword, anchored pattern, label, priority, weight."""
    bodies = [(keyword, f"^{pattern}(?= )", label, k, weight) for k, (keyword, pattern, label, weight) in enumerate(BODIES)]
    return bodies + [
        (keyword, f"^{form.replace('{name}', name)}(?= )", label, len(BODIES) + rank * len(NAMES) + k, weight)
        for rank, (keyword, form, weight) in enumerate(FORMS)
        for k, (label, name) in enumerate(NAMES.items())
    ]


def _rules() -> Column:
    def struct(keyword: str, pattern: str, label: str, priority: int, weight: float) -> Column:
        return F.struct(
            F.lit(keyword).alias("keyword"), F.lit(pattern).alias("pattern"), F.lit(label).alias("label"),
            F.lit(priority).alias("priority"), F.lit(weight).alias("weight"),
        )

    return F.array(*[struct(*rule) for rule in rule_table()])


_DETECTION = "array<struct<start:int,size:int,priority:int,label:string,weight:double>>"
PRODUCED = ["n_words", "base", "detections"]


def _places(phrase: str, label: str) -> Column:
    """Where the words from a place on start with a phrase."""
    at = F.filter("views", lambda p: p["view"].startswith(f"{phrase} "))
    return F.transform(at, lambda p: F.struct(p["start"].alias("start"), F.lit(label).alias("label")))


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``base`` (word and label of each base phrase) and ``detections`` that survive."""
    kept = others(docs, PRODUCED)
    joined = F.btrim(F.regexp_replace(lower_ascii(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), F.lit(" "))
    df = docs.select(F.struct(*kept).alias("row"), F.struct(joined.alias("t")).alias("a"))
    t = F.col("a.t")
    gated = F.lit(False)
    for gate in GATES:
        gated |= t.contains(gate)
    words = F.when(gated, F.split(t, " ")).otherwise(F.array().cast("array<string>"))
    n = F.when(t == "", 0).otherwise(F.char_length(t) - F.char_length(F.replace(t, F.lit(" "), F.lit(""))) + 1)
    df = df.select("row", n.cast("bigint").alias("n_words"), words.alias("words"))
    starts = F.array(*[F.lit(w) for w in dict.fromkeys([*STARTS, *_FIRST_WORDS])])
    places = F.filter(F.transform("words", lambda w, i: F.when(F.array_contains(starts, w), i)), lambda i: i.isNotNull())
    views = F.transform(
        places,
        lambda i: F.struct(i.alias("start"), F.concat(F.array_join(F.slice("words", i + 1, SPAN), " "), F.lit(" ")).alias("view")),
    )
    df = settled(df, {"views": views}, ["row", "n_words"]).withColumn("rules", _rules())

    def size(view: Column, pattern: Column) -> Column:
        return F.char_length(F.regexp_replace(F.regexp_substr(view, pattern), "[^ ]+", "")) + 1

    def detect(place: Column) -> Column:
        tried = F.filter("rules", lambda r: place["view"].contains(r["keyword"]))
        tried = F.filter(tried, lambda r: F.regexp_like(place["view"], r["pattern"]))
        found = F.transform(
            tried,
            lambda r: F.struct(
                (-size(place["view"], r["pattern"])).alias("minus"), r["priority"].alias("priority"),
                r["label"].alias("label"), r["weight"].alias("weight"),
            ),
        )
        best = F.array_min(found)  # the longest, then the highest priority
        return F.when(F.size(found) > 0, F.struct(
            place["start"].alias("start"), (-best["minus"]).alias("size"), best["priority"].alias("priority"),
            best["label"].alias("label"), best["weight"].alias("weight"),
        ))

    base = F.array().cast("array<struct<start:int,label:string>>")
    for phrase, label in BASE.items():
        base = F.concat(base, _places(phrase, label))
    found = F.filter(F.transform("views", detect), lambda d: d.isNotNull()).cast(_DETECTION)
    df = settled(df, {"base": base, "found": found}, ["row", "n_words"])

    def loses(d: Column, o: Column) -> Column:
        end, other = d["start"] + d["size"], o["start"] + o["size"]
        apart = (o["start"] >= end) | (d["start"] >= other) | (o["start"] == d["start"])
        inside = (o["start"] <= d["start"]) & (other >= end)
        around = (d["start"] <= o["start"]) & (end >= other)
        better = (o["priority"] < d["priority"]) | ((o["priority"] == d["priority"]) & (o["start"] < d["start"]))
        return ~apart & (inside | (~around & better))

    # one detection for each start, so no more than SPAN neighbours on either side can overlap
    near = F.filter(
        "found",
        lambda d, k: ~F.exists(F.slice("found", F.greatest(k - SPAN + 1, F.lit(1)), 2 * SPAN + 1), lambda o: loses(d, o)),
    )
    out = settled(df, {"base": F.col("base"), "detections": near}, ["row", "n_words"])
    names = [c for c in docs.columns if c.lower() not in PRODUCED]
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], *PRODUCED)


@register("op10_license_scans")
def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda b: b["start"].cast("bigint"))
    base = F.transform("base", lambda b: b["label"])
    own = F.transform("detections", lambda d: d["label"])
    best = F.array_max(F.transform("detections", lambda d: d["weight"]))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"), listed(F.concat(base, own)).alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("base") > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"),
    )
