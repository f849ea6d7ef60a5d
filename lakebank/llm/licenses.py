"""License scan: ordered signature rules behind a keyword prefilter, containment settles overlaps."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebank.llm.common import ascii_lower, table

#: Separators between words, after A-Z are lower-cased and before.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Fixed phrases: consecutive words and their label.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Families: label -> regex of its names. Texts are words with single blanks: "BSD-3-Clause" reads "bsd 3 clause",
#: "2.0" reads "2 0".
FAMILIES = {
    "0bsd": r"0 ?bsd|bsd zero clause|zero clause bsd",
    "afl-3": r"academic free license(?: v| version)? ?3 0|afl 3 0",
    "agpl-3": r"agpl ?v?3(?: 0)?|gnu affero general public license(?: v| version)? ?3(?: 0)?",
    "agpl": r"agpl|gnu affero general public license|affero gpl",
    "apache-1.1": r"apache(?: software)?(?: license)?(?: version)? 1 1",
    "apache-2": r"apache(?: software)?(?: license)?(?: v| version)? ?2(?: 0)?",
    "apache": r"apache",
    "apsl-2": r"apple public source license(?: version)? 2 0|apsl 2 0",
    "artistic-1": r"artistic(?: license)?(?: version)? 1 0",
    "artistic-2": r"artistic(?: license)?(?: version)? 2 0",
    "artistic": r"artistic",
    "beerware": r"beer ?ware",
    "bsd-1-clause": r"bsd 1 clause|1 clause bsd",
    "bsd-2-clause": r"bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd",
    "bsd-3-clause": r"bsd (?:3|three) clause|(?:3|three) clause bsd|(?:new|revised|modified) bsd",
    "bsd-4-clause": r"bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd",
    "bsd": r"bsd",
    "bsl-1": r"boost software license(?: version)?(?: 1 0)?|bsl 1 0",
    "busl-1.1": r"business source license(?: 1 1)?|busl 1 1",
    "cc0-1": r"cc0(?: 1 0)?(?: universal)?",
    "cc-by-nc-nd": r"cc by nc nd(?: [1-4] 0)?|creative commons attribution noncommercial noderivatives(?: [1-4] 0)?",
    "cc-by-nc-sa": r"cc by nc sa(?: [1-4] 0)?|creative commons attribution non ?commercial share ?alike(?: [1-4] 0)?",
    "cc-by-nc": r"cc by nc(?: [1-4] 0)?|creative commons attribution non ?commercial(?: [1-4] 0)?",
    "cc-by-nd": r"cc by nd(?: [1-4] 0)?|creative commons attribution no ?deriv(?:ative)?s(?: [1-4] 0)?",
    "cc-by-sa": r"cc by sa(?: [1-4] 0)?|creative commons attribution share ?alike(?: [1-4] 0)?",
    "cc-by": r"cc by(?: [1-4] 0)?|creative commons attribution(?: [1-4] 0)?",
    "cddl-1": r"cddl 1 [01]|common development and distribution license(?: version)?(?: 1 [01])?",
    "cecill-2": r"cecill 2(?: [01])?",
    "cecill": r"cecill(?: [bc])?",
    "clear-bsd": r"clear bsd|bsd 3 clause clear",
    "cpl-1": r"common public license(?: version)?(?: 1 0)?|cpl 1 0",
    "ecl-2": r"educational community license(?: version)?(?: 2 0)?|ecl 2 0",
    "efl-2": r"eiffel forum license(?: version)?(?: 2)?|efl 2 0",
    "elastic-2": r"elastic(?: license)?(?: version)? 2 0|elv2",
    "epl-1": r"eclipse public license(?: v| version)? ?1 0|epl 1 0",
    "epl-2": r"eclipse public license(?: v| version)? ?2 0|epl 2 0",
    "eupl": r"eupl(?: 1 [0-2])?|european union public licen[cs]e(?: v| version)?(?: ?1 [0-2])?",
    "gfdl": r"gnu free documentation license(?: version)?(?: 1 [1-3])?|gfdl",
    "gpl-2": r"gpl ?v?2(?: 0)?|gnu general public license(?: v| version)? ?2(?: 0)?",
    "gpl-3": r"gpl ?v?3(?: 0)?|gnu general public license(?: v| version)? ?3(?: 0)?",
    "gpl": r"gnu gpl|gpl|gnu general public license",
    "hpnd": r"historical permission notice and disclaimer|hpnd",
    "intel": r"intel open source",
    "ipl-1": r"ibm public license(?: version)?(?: 1 0)?",
    "isc": r"isc",
    "lgpl-2": r"lgpl ?v?2(?: 0)?|gnu library general public license(?: version)?(?: 2)?",
    "lgpl-2.1": r"lgpl ?v?2 1|gnu lesser general public license(?: v| version)? ?2 1",
    "lgpl-3": r"lgpl ?v?3(?: 0)?|gnu lesser general public license(?: v| version)? ?3(?: 0)?",
    "lgpl": r"gnu lgpl|lgpl|gnu (?:lesser|library) general public license",
    "lppl": r"latex project public license(?: version)?(?: 1 [0-3]c?)?|lppl",
    "mit-0": r"mit no attribution|mit 0",
    "mit": r"mit|expat",
    "mpl-1.1": r"mozilla public license(?: v| version)? ?1 1|mpl 1 1",
    "mpl-2": r"mozilla public license(?: v| version)? ?2 0|mpl 2 0",
    "mpl": r"mozilla public license",
    "ms-pl": r"microsoft public license|ms pl",
    "ms-rl": r"microsoft reciprocal license|ms rl",
    "mulan-2": r"mulan ?psl(?: v| version)?(?: ?2)?",
    "ncsa": r"university of illinois ncsa open source license|ncsa",
    "odbl": r"open database license(?: v| version)?(?: ?1 0)?|odbl",
    "odc-by": r"open data commons attribution(?: license)?(?: v1 0)?|odc by",
    "ofl-1.1": r"sil open font license(?: version)?(?: 1 1)?|ofl 1 1",
    "openssl": r"openssl",
    "osl-3": r"open software license(?: version)?(?: 3 0)?|osl 3 0",
    "php-3": r"php license(?: version)? 3(?: 0)?1?|php 3 01",
    "postgresql": r"postgresql",
    "python-2": r"python software foundation(?: license)?(?: version)?(?: 2)?|psf 2 0",
    "qpl-1": r"q public license(?: version)?(?: 1 0)?|qpl 1 0",
    "ruby": r"ruby",
    "sspl-1": r"server side public license(?: v| version)?(?: ?1)?|sspl 1 0",
    "unicode": r"unicode",
    "unlicense": r"unlicense",
    "upl-1": r"universal permissive license(?: v| version)?(?: ?1 0)?|upl 1 0",
    "vim": r"vim",
    "w3c": r"w3c software(?: notice and)?|w3c",
    "wtfpl": r"wtfpl|do what the f[a-z]* you want to public license",
    "x11": r"x11",
    "zlib": r"zlib(?: libpng)?",
    "zpl-2": r"zope public license(?: version)?(?: 2 [01])?|zpl 2 [01]",
}
#: Families whose name is a word of its own meaning: they need "license" beside them in a grant too.
COMMON_WORDS = {"artistic", "intel", "isc", "mit", "openssl", "postgresql", "ruby", "unicode", "vim", "x11", "apache", "bsd"}

#: Signatures written one by one: tier (notices, addresses and grants, mentions), label, regex.
NOTICES = [
    (1, "mit", r"permission is hereby granted free of charge to any person obtaining a copy"),
    (1, "isc", r"permission to use copy modify and or distribute this software for any purpose"),
    (1, "bsd", r"redistributions? and use in source and binary forms"),
    (1, "bsd-4-clause", r"all advertising materials mentioning features or use of this software"),
    (1, "bsd-3-clause", r"may be used to endorse or promote products derived"),
    (1, "zlib", r"this software is provided as is without any express or implied warranty"),
    (1, "gpl", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    (1, "lgpl", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    (1, "agpl", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    (1, "unlicense", r"this is free and unencumbered software released into the public domain"),
    (1, "mpl-2", r"this source code form is subject to the terms of the mozilla public license(?: v| version)? ?2 0"),
    (1, "bsl-1", r"distributed under the boost software license(?: version)? 1 0"),
    (1, "cc0-1", r"has waived all copyright and related or neighbou?ring rights"),
    (2, "apache-2", r"apache org licenses license 2 0"),
    (2, "mit", r"opensource org licenses mit"),
    (2, "gpl", r"gnu org licenses (?:old licenses )?gpl(?: [23] 0)?"),
    (2, "lgpl", r"gnu org licenses (?:old licenses )?lgpl(?: [23] [01])?"),
    (2, "cc-by", r"creativecommons org licenses by(?: [1-4] 0)"),
    (2, "cc-by-sa", r"creativecommons org licenses by sa(?: [1-4] 0)"),
    (2, "cc-by-nc", r"creativecommons org licenses by nc(?: [1-4] 0)"),
    (2, "cc-by-nd", r"creativecommons org licenses by nd(?: [1-4] 0)"),
    (2, "cc-by-nc-sa", r"creativecommons org licenses by nc sa(?: [1-4] 0)"),
    (2, "cc-by-nc-nd", r"creativecommons org licenses by nc nd(?: [1-4] 0)"),
    (2, "cc0-1", r"creativecommons org publicdomain zero 1 0"),
    (2, "public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    (3, "proprietary", r"all rights reserved"),
    (3, "proprietary", r"proprietary and confidential|confidential and proprietary"),
    (3, "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?"),
    (1, "mit", r"the above copyright notice and this permission notice shall be included in all copies"),
    (1, "ncsa", r"documentation files the software to deal with the software without restriction"),
    (1, "bsd", r"redistributions of source code must retain the above copyright notice"),
    (1, "bsd", r"redistributions in binary form must reproduce the above copyright notice"),
    (1, "bsd-4-clause", r"this product includes software developed by the university of california"),
    (1, "apache-1.1", r"this product includes software developed by the apache software foundation"),
    (1, "openssl", r"this product includes software developed by the openssl project"),
    (1, "openssl", r"this product includes cryptographic software written by eric young"),
    (1, "php-3", r"this product includes php software"),
    (1, "clear-bsd", r"no express or implied licenses to any party s patent rights are granted"),
    (1, "apache-2", r"you may not use this file except in compliance with the license"),
    (1, "apache-2", r"software distributed under the license is distributed on an as is basis"),
    (1, "gpl-2", r"the licenses for most software are designed to take away your freedom"),
    (1, "gpl-3", r"the gnu general public license is a free copyleft license"),
    (1, "gpl-2", r"gnu general public license as published by the free software foundation either version 2"),
    (1, "gpl-3", r"gnu general public license as published by the free software foundation either version 3"),
    (1, "lgpl-2.1", r"gnu lesser general public license as published by the free software foundation either version 2 1"),
    (1, "lgpl-3", r"gnu lesser general public license as published by the free software foundation either version 3"),
    (1, "agpl-3", r"gnu affero general public license as published by the free software foundation either version 3"),
    (1, "lgpl-3", r"gnu lesser general public license incorporates the terms and conditions of version 3"),
    (1, "gpl", r"you should have received a copy of the gnu general public license"),
    (1, "lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license"),
    (1, "agpl", r"you should have received a copy of the gnu affero general public license"),
    (1, "gfdl", r"gnu free documentation license version 1 [1-3] or any later version"),
    (1, "gfdl", r"a copy of the license is included in the section entitled gnu free documentation license"),
    (1, "mpl-2", r"if a copy of the mpl was not distributed with this file"),
    (1, "mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1"),
    (1, "epl-1", r"eclipse public license v1 0 which accompanies this distribution"),
    (1, "epl-2", r"eclipse public license (?:v2 0|2 0) which is available at"),
    (1, "cddl-1", r"the contents of this file are subject to the terms of the common development and distribution license"),
    (1, "artistic-1", r"the intent of this document is to state the conditions under which a package may be copied"),
    (1, "artistic-2", r"this license establishes the terms under which a given free software package may be copied"),
    (1, "zlib", r"altered source versions must be plainly marked as such"),
    (1, "zlib", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    (1, "unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    (1, "wtfpl", r"permitted to copy and distribute verbatim or modified copies of this license document"),
    (1, "beerware", r"you think this stuff is worth it you can buy me a beer"),
    (1, "cc0-1", r"associated a work with this deed has dedicated the work to the public domain"),
    (1, "ofl-1.1", r"this font software is licensed under the sil open font license"),
    (1, "python-2", r"psf is making python available to licensee"),
    (1, "hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose"),
    (1, "postgresql", r"documentation for any purpose without fee and without a written agreement is hereby granted"),
    (1, "x11", r"shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    (1, "ms-pl", r"this license governs use of the accompanying software"),
    (1, "apsl-2", r"subject to the apple public source license version 2 0"),
    (1, "busl-1.1", r"the licensor hereby grants you the right to copy modify create derivative works"),
    (1, "elastic-2", r"you may not provide the software to third parties as a hosted or managed service"),
    (1, "cecill", r"governed by the cecill(?: [bc])? license under french law"),
    (1, "upl-1", r"permission is hereby granted free of charge to any person obtaining a copy of this software associated documentation and or data"),
    (1, "unicode", r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    (1, "lppl", r"distributed and or modified under the conditions of the latex project public license"),
    (1, "ruby", r"redistribute it and or modify it under either the terms of the (?:2 clause bsdl|gpl)"),
    (1, "eupl", r"eupl 1 2 or as soon they will be approved by the european commission"),
    (2, "apache-2", r"under the apache 2 0 licen[cs]e"),
    (2, "apache", r"www apache org licenses"),
    (2, "mpl-2", r"mozilla org mpl 2 0|mozilla org en us mpl 2 0"),
    (2, "epl-1", r"eclipse org legal epl v10"),
    (2, "epl-2", r"eclipse org legal epl (?:v20|2 0)"),
    (2, "cpl-1", r"eclipse org legal cpl v10"),
    (2, "bsl-1", r"boost org license 1 0"),
    (2, "unlicense", r"unlicense org"),
    (2, "wtfpl", r"www wtfpl net"),
    (2, "ofl-1.1", r"scripts sil org ofl|openfontlicense org"),
    (2, "php-3", r"php net license 3 0"),
    (2, "bsd-2-clause", r"opensource org licenses bsd 2 clause|opensource org licenses bsd license"),
    (2, "bsd-3-clause", r"opensource org licenses bsd 3 clause"),
    (2, "isc", r"opensource org licenses isc"),
    (2, "artistic-2", r"opensource org licenses artistic 2 0"),
    (2, "cddl-1", r"opensource org licenses cddl"),
    (2, "osl-3", r"opensource org licenses osl 3 0"),
    (2, "afl-3", r"opensource org licenses afl 3 0"),
    (2, "zlib", r"opensource org licenses zlib"),
    (2, "agpl", r"gnu org licenses agpl(?: 3 0)?"),
    (2, "gfdl", r"gnu org licenses fdl(?: 1 [1-3])?|gnu org copyleft fdl"),
    (2, "elastic-2", r"elastic co licensing elastic license"),
    (2, "sspl-1", r"mongodb com licensing server side public license"),
    (2, "busl-1.1", r"mariadb com bsl11"),
    (2, "cecill", r"www cecill info"),
    (2, "upl-1", r"oracle com licenses upl"),
    (2, "unicode", r"unicode org copyright"),
    (2, "odbl", r"opendatacommons org licenses odbl"),
    (2, "odc-by", r"opendatacommons org licenses by"),
    (2, "pddl", r"opendatacommons org licenses pddl"),
    (2, "mulan-2", r"license coscl org cn mulanpsl2"),
    (2, "lppl", r"latex project org lppl"),
    (2, "eupl", r"joinup ec europa eu (?:software page|collection) eupl"),
    (2, "artistic", r"under the same terms as perl itself"),
    (2, "public-domain", r"creativecommons org publicdomain mark 1 0|public domain mark 1 0"),
    (2, "llama", r"llama [2-4](?: [0-9])? community license"),
    (2, "openrail", r"creativeml open ?rail m|bigscience (?:bloom )?rail|openrail m? ?license"),
    (2, "gemma", r"gemma terms of use license|gemma license agreement"),
    (3, "proprietary", r"unauthori[sz]ed (?:copying|reproduction|distribution|use) of this"),
    (3, "proprietary", r"no part of this (?:publication|book|document|work) may be reproduced"),
    (3, "proprietary", r"end user licen[cs]e agreement"),
    (3, "non-commercial", r"non ?commercial licen[cs]e|licen[cs]ed? for non ?commercial use"),
    (3, "evaluation", r"evaluation licen[cs]e|licen[cs]ed? for evaluation"),
]
#: Confidence of a detection by tier: tags and notices, grants and addresses, mentions.
CONFIDENCE = {1: 1.0, 2: 0.9, 3: 0.5}

#: What a tag opens with.
TAG = "spdx license identifier"

#: Words that a grant opens with.
GRANTS = r"(?:licensed|released|distributed|available|published|provided|covered|governed|redistributed)"

#: Plain texts, one of which is in whatever the gate below lets through (or "cc", looked at on its own): they are
#: looked for first, in the lower-cased text, since a regex with many branches costs ten times as much.
GATE_WORDS = ("licen", "released", "distribut", "available", "published", "provided", "covered", "governed", "copyright", "spdx", "commons", "domain", "rights",
              "confidential", "warranty", "permi", "advertising", "endorse", "waived", "unencumbered", "product", "gnu", "mozilla", "eclipse", "mpl", "package",
              "altered", "anyone", "buy", "managed", "agreement", "apple", "latex", "europ", "wtfpl", "sil", "bsl11", "cecill", "perl", "rail", "unauthori",
              "reproduced", "restriction")
#: A text without any of these holds no detection: every rule below needs one of them.
GATE = (rf"(?i)licen[cs]|{GRANTS}[^0-9a-z]+(?:under|by)|"
        r"copyright|spdx|creative[^0-9a-z]{0,9}commons|public[^0-9a-z]+domain|all[^0-9a-z]+rights|confidential|warranty|"
        r"redistribut|permi(?:ssion|tted)|advertising|endorse|waived|unencumbered|"
        r"product[^0-9a-z]+includes|gnu[^0-9a-z]|mozilla|eclipse|mpl[^0-9a-z]|package|altered[^0-9a-z]+source|anyone[^0-9a-z]+is[^0-9a-z]+free|buy[^0-9a-z]+me|"
        r"managed[^0-9a-z]+service|written[^0-9a-z]+agreement|apple[^0-9a-z]+public|latex|european[^0-9a-z]+commission|europa[^0-9a-z]|wtfpl|sil[^0-9a-z]+org|"
        r"bsl11|cecill|perl[^0-9a-z]+itself|open[^0-9a-z]*rail|bigscience|without[^0-9a-z]+restriction|unauthori[sz]ed|reproduced|(?<![0-9a-z])cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by(?![0-9a-z])")


@dataclass(frozen=True)
class Rule:
    """A signature: lower ``order`` goes first among equal spans; one of the ``keywords`` is in every match."""

    order: int
    tier: int
    label: str
    keywords: tuple[str, ...]
    pattern: str


def alternatives(pattern: str) -> list[str]:
    """The parts of a pattern between the bars that stand in no group."""
    out, depth = [""], 0
    for c in pattern:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def literal(alternative: str) -> str:
    """The longest text that is in every match of a pattern without bars outside its groups, which don't nest."""
    fixed = re.sub(r"(?:\([^()]*\)|\[[^\]]*\]|[a-z0-9 ](?=[?*]))[?*+]?", "\0", alternative)
    return max(fixed.split("\0"), key=len)


def keywords(pattern: str, before: str = "", after: str = "") -> tuple[str, ...]:
    """A literal for each alternative of the pattern, without those that contain another. Where one is a plain text,
    what stands before and after the pattern is part of its literal."""
    found = {before + a + after if literal(a) == a else literal(a) for a in alternatives(pattern)}
    return tuple(sorted(k for k in found if not any(o != k and o in k for o in found)))


def rules() -> list[Rule]:
    """All signatures in order: those written one by one, then for each family its tag, its grant and its mention."""
    grant = rf"{GRANTS} (?:under|by)(?: the terms of)?(?: the| a| an)?"
    out = [(tier, label, keywords(pattern), pattern) for tier, label, pattern in NOTICES]
    for label, names in FAMILIES.items():
        ending = " licen[cs]e" if label in COMMON_WORDS else ""
        out.append((1, label, (TAG,), rf"{TAG} (?:{names})(?: only| or later)?"))
        out.append((2, label, keywords(names, " ", ending[:6]), rf"{grant} (?:{names}){ending or '(?: licen[cs]e)?'}"))
        out.append((3, label, keywords(names, "", " licen"), rf"(?:{names}) licen[cs]e"))
    return [Rule(i, tier, label, words, rf"(?<= )(?:{pattern})(?= )") for i, (tier, label, words, pattern) in enumerate(out)]


def gate(text: Column, low: Column) -> Column:
    """Whether a text may hold a detection; ``low`` is the text in lower case, a column of its own since it is read often."""
    return (reduce(or_, [F.contains(low, F.lit(w)) for w in GATE_WORDS]) | F.contains(low, F.lit("cc"))) & text.rlike(GATE)


HIT = "array<struct<start:int,back:int,tier:int,rule:int,label:string>>"


def places(words: Column, rule: Column) -> Column:
    """A rule's matches in the word text, as (start, -stop, tier, order, label); places in code points."""
    pattern = rule["pattern"]
    hits = F.regexp_extract_all(words, pattern, F.lit(0))
    pairs = F.arrays_zip(F.slice(F.split(words, pattern, -1), F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"))

    def add(acc, x):
        start = acc["at"] + F.length(x["gap"])
        stop = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), (-stop).alias("back"), rule["tier"].alias("tier"), rule["rule"].alias("rule"), rule["label"].alias("label"))
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(one)).cast(HIT).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(HIT).alias("out"))
    return F.when(F.rlike(words, pattern), F.aggregate(pairs, first, add, lambda acc: acc["out"])).otherwise(F.array().cast(HIT))


def survivors(found: Column) -> Column:
    """Detections that are not within another of the same or a stronger tier. In order of start and
    falling stop, a detection lies in an earlier one if that one's stop is not smaller: one pass."""
    first = F.struct(*[F.lit(-1).alias(f"t{t}") for t in CONFIDENCE], F.array().cast(HIT).alias("out"))

    def step(acc, x):
        stop = -x["back"]
        reach = F.when(x["tier"] == 1, acc["t1"]).when(x["tier"] == 2, acc["t2"]).otherwise(acc["t3"])
        ends = [F.when(x["tier"] <= t, F.greatest(acc[f"t{t}"], stop)).otherwise(acc[f"t{t}"]).alias(f"t{t}") for t in CONFIDENCE]
        return F.struct(*ends, F.when(reach >= stop, acc["out"]).otherwise(F.concat(acc["out"], F.array(x)).cast(HIT)).alias("out"))

    return F.aggregate(F.array_sort(found), first, step, lambda acc: acc["out"])


def scan(docs: DataFrame, ruleset: list[Rule] | None = None) -> DataFrame:
    """Per document: words, base phrases, labels, score and detections (array of start, stop, tier, label in code points of the word text).

    The text becomes lower-case words with single blanks. Texts that the gate
    passes try the rules of which they hold a keyword; a detection within another of
    the same or a stronger tier gives way, of equal spans the first rule stays.
    Rules of the same keywords are looked for once. The base phrases always count. ``score`` is the confidence of the strongest
    tier found, 0 without any. All in the row: no shuffle, no Python.

    Null text is empty: no words, no labels. Empty table: empty result. Very long texts are scanned whole.
    Repeated rows give equal results; other columns are not read.
    """
    by_keywords: dict[tuple[str, ...], list[Rule]] = {}
    for rule in rules() if ruleset is None else ruleset:
        by_keywords.setdefault(rule.keywords, []).append(rule)
    one = lambda r: F.struct(F.lit(r.order).alias("rule"), F.lit(r.tier).alias("tier"), F.lit(r.label).alias("label"), F.lit(r.pattern).alias("pattern"))
    listed = F.array(*[F.struct(F.array(*map(F.lit, words)).alias("keywords"), F.array(*map(one, some)).alias("rules")) for words, some in by_keywords.items()])
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("_text"), F.lower(text).alias("_low"))
    line = F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(F.col("_text")), GAP, " ")), F.lit(" "))
    rows = rows.select("doc_id", F.size(F.array_remove(F.split("_text", SPLIT), "")).cast("long").alias("n_words"),
                       F.when(gate(F.col("_text"), F.col("_low")), line).alias("_words"))
    words = F.col("_words")
    base = [F.struct(F.lit(-1 - i).alias("rule"), F.lit(2).alias("tier"), F.lit(label).alias("label"), F.lit(f"(?<= ){phrase}(?= )").alias("pattern"))
            for i, (phrase, label) in enumerate(PHRASES.items())]
    rows = rows.withColumn("_base", F.when(words.isNotNull(), F.concat(*[places(words, b) for b in base])))
    tried = F.flatten(F.transform(F.filter(listed, lambda g: F.exists(g["keywords"], lambda k: F.contains(words, k))), lambda g: g["rules"]))
    rows = rows.withColumn("_found", F.when(words.isNotNull(), survivors(F.flatten(F.transform(tried, lambda r: places(words, r))))))
    rows = rows.withColumn("_base", F.coalesce("_base", F.array().cast(HIT))).withColumn("_found", F.coalesce("_found", F.array().cast(HIT)))
    # a match starts behind a blank, and one blank stands before the first word
    index = lambda at: (at - F.length(F.replace(F.substring("_words", F.lit(1), at), F.lit(" "), F.lit(""))) - 1).cast("long")
    starts = F.transform("_base", lambda x: x["start"])
    names = F.transform("_base", lambda x: x["label"])
    both = F.concat("_base", "_found")
    strength = F.element_at(F.array(*map(F.lit, CONFIDENCE.values())), F.array_min(F.transform(both, lambda x: x["tier"])))
    return rows.select(
        "doc_id", "n_words", F.size("_base").cast("long").alias("n_base"),
        index(F.array_min(starts)).alias("first_word"), index(F.array_max(starts)).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(both, lambda x: x["label"]))), ",").alias("labels"),
        F.when(F.size(both) > 0, strength).otherwise(0.0).alias("score"),
        F.transform("_found", lambda x: F.struct(x["start"], (-x["back"]).alias("stop"), x["tier"], x["label"])).alias("detections"))


def op6_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("detections")
