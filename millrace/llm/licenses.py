"""License scans: ordered signature rules over a text's words.

A text becomes its words in lower case (A-Z), with one space between. A rule is a regular expression
over that, a literal keyword without which it cannot match, a label and a priority
(:func:`signature_rules` writes some hundreds from names, versions and phrasings, short identifiers, and
the licenses' own notices and texts). Texts without any
anchor, a few literals of which every keyword holds one, are done; in the others the rules whose
keyword occurs are searched for at every place. A detection whose words lie within those of another with at least its
priority is suppressed. The base phrases are rules as well, and their labels stay even if suppressed.

All of it is one expression per row: no shuffle, no Python. Defined results: a NULL text is empty and
has no word and no label; rows are judged one by one, so repeated rows give repeated results; further
columns pass through :func:`scanned`.
"""

from __future__ import annotations

import json
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.staging import fresh_name

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOP_PRIORITY = 4

# Phrases and labels of the base.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, names, versions.
FAMILIES = (
    ("agpl", ("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"), ("3", "1")),
    ("apache", ("apache license", "apache software license", "apache public license"), ("2 0", "1 1", "1 0")),
    ("artistic", ("artistic license",), ("2 0", "1 0")),
    ("afl", ("academic free license",), ("3 0", "2 1")),
    ("boost", ("boost software license",), ("1 0",)),
    ("bsd", ("bsd license", "berkeley software distribution license"), ()),
    ("bsd-2-clause", ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "freebsd license"), ()),
    ("bsd-3-clause", ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"), ()),
    ("cc-by", ("cc by", "creative commons attribution"), ("4 0", "3 0", "2 0")),
    ("cc-by-nc", ("cc by nc", "creative commons attribution noncommercial"), ("4 0", "3 0", "2 0")),
    ("cc-by-nc-nd", ("cc by nc nd", "creative commons attribution noncommercial noderivatives"), ("4 0", "3 0")),
    ("cc-by-nc-sa", ("cc by nc sa", "creative commons attribution noncommercial sharealike"), ("4 0", "3 0")),
    ("cc-by-nd", ("cc by nd", "creative commons attribution noderivatives"), ("4 0", "3 0")),
    ("cc-by-sa", ("cc by sa", "creative commons attribution sharealike"), ("4 0", "3 0", "2 0")),
    ("cc0", ("cc0", "creative commons zero"), ("1 0",)),
    ("cddl", ("common development and distribution license", "cddl"), ("1 1", "1 0")),
    ("cecill", ("cecill license", "cecill free software license agreement"), ("2 1", "2 0")),
    ("epl", ("eclipse public license",), ("2 0", "1 0")),
    ("eupl", ("european union public license", "european union public licence", "eupl"), ("1 2", "1 1")),
    ("gfdl", ("gnu free documentation license", "gfdl"), ("1 3", "1 2")),
    ("gpl", ("gnu general public license", "gnu general public licence", "gnu gpl", "gpl"), ("3", "2", "1")),
    ("isc", ("isc license", "internet systems consortium license"), ()),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"), ("3", "2 1", "2")),
    ("mit", ("mit license", "expat license", "mit licence"), ()),
    ("mpl", ("mozilla public license",), ("2 0", "1 1", "1 0")),
    ("ms-pl", ("microsoft public license",), ()),
    ("ms-rl", ("microsoft reciprocal license",), ()),
    ("odbl", ("open database license", "odbl"), ("1 0",)),
    ("odc-by", ("open data commons attribution license",), ("1 0",)),
    ("ofl", ("sil open font license", "open font license"), ("1 1", "1 0")),
    ("openssl", ("openssl license",), ()),
    ("osl", ("open software license",), ("3 0", "2 1")),
    ("pddl", ("open data commons public domain dedication", "pddl"), ("1 0",)),
    ("postgresql", ("postgresql license",), ()),
    ("public-domain", ("dedicated to the public domain", "public domain dedication"), ()),
    ("python", ("python software foundation license", "psf license"), ("2",)),
    ("unlicense", ("the unlicense", "unlicense org"), ()),
    ("vim", ("vim license",), ()),
    ("wtfpl", ("do what the fuck you want to public license", "wtfpl"), ("2",)),
    ("zlib", ("zlib license", "zlib libpng license"), ()),
)
GRANT = "(?:licensed|released|distributed|available|published|provided) under (?:the |a )?(?:terms of (?:the )?)?"
GNU = ("agpl", "gfdl", "gpl", "lgpl")
# Between a GNU license's name and its version in its own notice.
PUBLISHED = "(?: as published by the free software foundation(?: inc)?)?(?: either)?"
LATER = "(?: of the licen[sc]e)? or (?:at your option )?(?:any )?later(?: version)?"
# Label, short name, versions; the version stands apart or, with v, is joined to the name.
SHORT = (
    ("afl", "afl", ("3 0", "2 1")), ("agpl", "agpl", ("3", "1")), ("apache", "apache", ("2 0", "1 1", "1 0")), ("apache", "asl", ("2 0", "1 1")),
    ("artistic", "artistic", ("2 0", "1 0")), ("boost", "bsl", ("1 0",)), ("epl", "epl", ("2 0", "1 0")), ("gfdl", "gfdl", ("1 3", "1 2")), ("gpl", "gpl", ("3", "2", "1")),
    ("lgpl", "lgpl", ("3", "2 1", "2")), ("mpl", "mpl", ("2 0", "1 1", "1 0")), ("ofl", "ofl", ("1 1", "1 0")), ("osl", "osl", ("3 0", "2 1")), ("python", "psf", ("2",)),
)
# Keyword, pattern, label, priority of texts and of short names without a version.
_BSD = "redistribution and use in source and binary forms with or without modification are permitted"
_FREELY = "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"
TEXTS = (
    ("spdx license identifier mit 0", "spdx license identifier mit 0", "mit-0", 4),
    ("bsd 2 clause", "bsd 2 clause", "bsd-2-clause", 2), ("bsd 3 clause", "bsd 3 clause", "bsd-3-clause", 2), ("2 clause bsd", "2 clause bsd", "bsd-2-clause", 2),
    ("3 clause bsd", "3 clause bsd", "bsd-3-clause", 2), ("ms pl", "ms pl", "ms-pl", 2), ("ms rl", "ms rl", "ms-rl", 2),
    ("under mit", GRANT + "mit", "mit", 3), ("under the mit", GRANT + "mit", "mit", 3), ("terms of the mit", GRANT + "mit", "mit", 3),
    ("permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?", "mit", 4),
    ("permission is hereby granted", "permission is hereby granted free of charge to any person or organi[sz]ation obtaining a copy of the software and accompanying documentation", "boost-1.0", 4),
    ("without fee is hereby granted", _FREELY, "isc", 3), ("without fee is hereby granted", f"{_FREELY} provided that the above copyright notice", "isc", 4),
    ("without fee is hereby granted", f"{_FREELY} the software is provided", "0bsd", 4),
    ("source and binary forms", "redistribution and use in source and binary forms", "bsd", 2), ("source and binary forms", _BSD, "bsd", 3),
    ("source and binary forms", _BSD + "(?:(?! endorse | advertising ) [^ ]+){0,160}? this software is provided", "bsd-2-clause", 4),
    ("source and binary forms", _BSD + "(?:(?! advertising ) [^ ]+){0,200}? endorse or promote products", "bsd-3-clause", 4),
    ("source and binary forms", _BSD + "(?: [^ ]+){0,160}? all advertising materials mentioning features", "bsd-4-clause", 4),
    ("without any express or implied warranty", "this software is provided as is without any express or implied warranty in no event will the authors? be held liable", "zlib", 4),
    ("into the public domain", "this is free and unencumbered software released into the public domain", "unlicense", 4),
    ("what the fuck you want to", "you just do what the fuck you want to", "wtfpl", 3),
)
# Every keyword holds one of these.
ANCHORS = (
    " license", " licence", " unlicense", "agpl ", "gpl ", " cc by ", "creative commons", " cc0 ", " cddl ",
    " eupl ", " gfdl ", " odbl ", " pddl ", "public domain", " wtfpl ",
    "gplv", "gpl1 ", "gpl2 ", "gpl3 ", " apache ", " asl ", " artistic ", " bsl ", " epl ", " mpl ", " mplv", " eplv", " apachev", " apache1 ", " apache2 ", " ofl ", " afl ", " osl ", " psf ",
    " aflv", " aslv", " artisticv", " bslv", " gfdlv", " oflv", " oslv", " psfv",
    " bsd ", " ms pl ", " ms rl ", " under mit ", " under the mit ", " terms of the mit ", " is hereby granted ", " source and binary forms ",
    " without any express or implied warranty ", " what the fuck you want to ",
)


def signature_rules() -> list[dict]:
    """The rules in their order: keyword, pattern, label, priority, base."""
    rules = [{"keyword": p, "pattern": p, "label": label, "priority": 1, "base": True} for p, label in BASE.items()]

    def add(keyword, pattern, label, priority):
        rules.append({"keyword": keyword, "pattern": pattern, "label": label, "priority": priority, "base": False})

    for label, names, versions in FAMILIES:
        for name in names:
            add(name, name, label, 1)
            add(name, GRANT + name, label, 3)
            for version in versions:
                major = version.removesuffix(" 0")
                number = f"(?: license| licence| international| unported)?(?: version| v)? (?:v)?{major}(?: 0)?"
                numbered = f"{label}-{version.replace(' ', '.')}"
                add(name, f"{name}{number}", numbered, 2)
                add(name, f"{GRANT}{name}{number}", numbered, 4)
                add(name, f"{name}{number} or (?:any )?later(?: version)?", f"{numbered}-or-later", 4)
                published = PUBLISHED if label in GNU else ""
                add(name, f"{name}{published}{number}{LATER}", f"{numbered}-or-later", 4)
                if published:
                    add(name, f"{name}{published}{number}", numbered, 3)
                add(name, f"(?:version|v) {major}(?: 0)? of (?:the )?{name}", numbered, 3)
                add(name, f"(?:version|v) {major}(?: 0)?{LATER} of (?:the )?{name}", f"{numbered}-or-later", 4)
        for version in versions or ("",):
            identifier = f"{label.replace('-', ' ')} {version}".strip()
            tagged = "-".join(filter(None, [label, version.replace(" ", ".")]))
            add("spdx license identifier", f"spdx license identifier {identifier}", tagged, 4)
            if label in GNU:
                add("spdx license identifier", f"spdx license identifier {identifier}(?: 0)? or later", f"{tagged}-or-later", 4)
    for label, name, versions in SHORT:
        for version in versions:
            major, numbered = version.removesuffix(" 0"), f"{label}-{version.replace(' ', '.')}"
            first = major.split(" ")[0]
            # a number apart must be whole: "apache 2 4" is no license
            whole = f"{major}(?: 0)?" if name in ("agpl", "gpl", "lgpl") else version
            forms = ((name, f"{name} {whole}"), (f"{name}v{first}", f"{name}v{major}(?: 0)?"), (f"{name} v{first}", f"{name} v{major}(?: 0)?"))
            if name in ("agpl", "gpl", "lgpl", "apache"):
                forms += ((f"{name}{first}", f"{name}{major}(?: 0)?"),)
            for keyword, pattern in forms:
                add(keyword, f"{pattern}(?! [0-9])", numbered, 2)
                add(keyword, f"{pattern}{LATER}", f"{numbered}-or-later", 4)
    for rule in TEXTS:
        add(*rule)
    return rules


def word_line(text: str) -> Column:
    """A space, then each word and a space."""
    lowered = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    line = F.regexp_replace(F.concat(F.lit(" "), lowered, F.lit(" ")), GAP, " ")
    return line


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(line: Column, rule: Column) -> Column:
    """Every place of one rule as (start, -end, -priority, number, label, base), in words.

    The line is cut in front of each match, so the words before a match are those of the parts before.
    """
    parts = F.split(line, F.concat(F.lit("(?<= )(?=(?:"), rule["pattern"], F.lit(") )")))
    kind = "array<struct<start:int,end:int,priority:int,number:int,label:string,base:boolean>>"
    begin = F.struct((_spaces(F.get(parts, F.lit(0))) - 1).alias("at"), F.expr(f"cast(array() as {kind})").alias("found"))

    def step(state, part):
        size = _spaces(F.regexp_substr(part, F.concat(F.lit("^(?:"), rule["pattern"], F.lit(")(?= )")))) + 1
        one = F.struct(
            state["at"].alias("start"), (-(state["at"] + size)).alias("end"), (-rule["priority"]).alias("priority"),
            rule["number"].alias("number"), rule["label"].alias("label"), rule["base"].alias("base"),
        )
        return F.struct((state["at"] + _spaces(part)).alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    return F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), begin, step, lambda s: s["found"])


def _unsuppressed(detections: Column) -> Column:
    """Labels and highest priority of the detections that no other suppresses.

    In order of start, longest and most important first, a detection is within an earlier one if it
    ends no later than the furthest end so far of those with at least its priority.
    """
    begin = F.struct(*[F.lit(-1).alias(f"end{p}") for p in range(1, TOP_PRIORITY + 1)], F.expr("cast(array() as array<string>)").alias("labels"), F.lit(0).alias("best"))

    def step(state, one):
        end, priority = -one["end"], -one["priority"]
        reached = state["end1"]
        for p in range(2, TOP_PRIORITY + 1):
            reached = F.when(priority >= p, state[f"end{p}"]).otherwise(reached)
        stays = end > reached
        ends = [F.when(priority >= p, F.greatest(state[f"end{p}"], end)).otherwise(state[f"end{p}"]).alias(f"end{p}") for p in range(1, TOP_PRIORITY + 1)]
        labels = F.when(stays, F.array_union(state["labels"], F.array(one["label"]))).otherwise(state["labels"])
        return F.struct(*ends, labels.alias("labels"), F.when(stays, F.greatest(state["best"], priority)).otherwise(state["best"]).alias("best"))

    return F.aggregate(detections, begin, step, lambda s: F.struct(s["labels"].alias("labels"), s["best"].alias("best")))


def scanned(docs: DataFrame, text: str = "text", rules: Sequence[dict] | None = None) -> tuple[DataFrame, str]:
    """The rows with a struct of the counts, base labels, labels and score, and its name."""
    rules = signature_rules() if rules is None else rules
    listed = json.dumps([r | {"number": i} for i, r in enumerate(rules)])
    table = F.from_json(F.lit(listed), "array<struct<keyword:string,pattern:string,label:string,priority:int,base:boolean,number:int>>")
    name = fresh_name(docs, "license")
    line = F.col(f"`{name}`")
    anchored = F.lit(False)
    for anchor in ANCHORS:
        anchored = anchored | F.contains(line, F.lit(anchor))
    hits = F.filter(table, lambda r: F.contains(line, r["keyword"]))
    found = F.when(anchored, F.array_sort(F.flatten(F.transform(hits, lambda r: _detections(line, r)))))
    out = docs.withColumn(name, word_line(text))
    # the detections are used several times: a generator in between has them made once
    out = out.withColumn(name, F.explode(F.array(F.struct((_spaces(line) - 1).cast("bigint").alias("n_words"), found.alias("found")))))
    found = F.coalesce(F.col(f"`{name}`.found"), F.expr("cast(array() as array<struct<start:int,end:int,priority:int,number:int,label:string,base:boolean>>)"))
    base = F.filter(found, lambda d: d["base"])
    result = F.struct(
        F.col(f"`{name}`.n_words").alias("n_words"), F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["start"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["start"])).cast("bigint").alias("last_word"),
        F.array_distinct(F.transform(base, lambda d: d["label"])).alias("base_labels"),
        _unsuppressed(found).alias("others"),
    )
    out = out.withColumn(name, F.explode(F.array(result)))
    of = lambda field: F.col(f"`{name}`.{field}")
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    verdict = F.struct(
        of("n_words").alias("n_words"), of("n_base").alias("n_base"), of("first_word").alias("first_word"), of("last_word").alias("last_word"),
        joined(of("base_labels")).alias("base_labels"),
        joined(F.array_union(of("base_labels"), of("others.labels"))).alias("labels"),
        (of("others.best") / TOP_PRIORITY).alias("score"),
    )
    return out.withColumn(name, verdict), name


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows, verdict = scanned(docs)
    return rows.select("doc_id", f"`{verdict}`.*")
