"""License scans by ordered signature rules, in DataFrame functions only.

A text is brought to its words (A-Z lower-cased, runs of digits, letters and
characters outside ASCII) with single blanks between. Several hundred rules, each
a regular expression over the words with a keyword, a label and a priority, come
from a table of license names put into phrase templates, from a table of SPDX
identifiers (after their tag, or joined by "or" or "and" to another one in a text
that names SPDX), and from sentences of well-known license texts. A rule runs only on texts that hold its keyword as a
word, and all of them only on texts that hold one of a few words (the ``gates``), of
which every match of a rule holds one.

Detections are intervals. One that lies within another of higher priority (of
equal priority: within a longer one, or an equal one of an earlier rule) is
suppressed, so that "licensed under the gnu lesser general public license" is
no detection of the general public license.

``detect`` appends the kept detections with their word places; ``summarise`` adds
labels and a score, the highest priority among them as a share of 100.

Cases: null and empty texts have no words and no detections, score 0; repeated
detections count once per place; texts of any length are scanned whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# License label, keyword, and the names it goes by, in words.
LICENSES = """
gpl | general | gnu general public license( version [0-9]+( [0-9])?)?( or later)?
lgpl | general | gnu (lesser|library) general public license( version [0-9]+( [0-9])?)?
agpl | affero | (gnu )?affero general public license( version [0-9]+)?
gfdl | documentation | gnu free documentation license
apache | apache | apache (software )?license( version [0-9]( [0-9])?)?
mit | mit | mit license
bsd | bsd | (new |modified |simplified |revised |original )?bsd( [0-4] clause)? license
isc | isc | isc license
mpl | mozilla | mozilla public license( version [0-9]( [0-9])?)?
epl | eclipse | eclipse public license( version [0-9]( [0-9])?)?
cddl | distribution | common development and distribution license
cddl | cddl | cddl( version)?( [0-9] [0-9])?
cpl | common | common public license
edl | eclipse | eclipse distribution license
eupl | european | european union public license
artistic | artistic | artistic license( [0-9]( [0-9])?)?
zlib | zlib | zlib( libpng)? license
libpng | libpng | libpng license
boost | boost | boost software license
unlicense | unlicense | the unlicense
wtfpl | wtfpl | wtfpl( version [0-9])?
python | python | python software foundation license( version [0-9])?
php | php | php license( version [0-9]( [0-9]+)?)?
ruby | ruby | ruby license
perl | perl | same terms as perl( itself)?
postgresql | postgresql | postgresql license
openssl | openssl | openssl license
curl | curl | curl license
x11 | x11 | x11 license
ofl | font | (sil )?open font license( version [0-9]( [0-9])?)?
odbl | database | open (data commons open )?database license
odc-by | commons | open data commons attribution license
pddl | domain | open data commons public domain dedication and license
ms-pl | microsoft | microsoft public license
ms-rl | microsoft | microsoft reciprocal license
osl | open | open software license( version [0-9]( [0-9])?)?
afl | academic | academic free license( version [0-9]( [0-9])?)?
ecl | educational | educational community license
upl | universal | universal permissive license
ncsa | ncsa | (university of illinois )?ncsa open source license
w3c | w3c | w3c software (notice and )?license
zpl | zope | zope public license
qpl | q | q public license
ipl | ibm | ibm public license
spl | sun | sun public license
apsl | apple | apple public source license
npl | netscape | netscape public license
rpl | reciprocal | reciprocal public license
cecill | cecill | cecill( b| c)?( free software)? license
vim | vim | vim license
tcl | tcl | tcl tk license
json | json | json license
beerware | beer | beer ware license
icu | icu | icu license
unicode | unicode | unicode (data files and software )?license
sleepycat | sleepycat | sleepycat license
sspl | server | server side public license
busl | business | business source license
elastic | elastic | elastic license( [0-9]( [0-9])?)?
cc-by | cc | cc by( [0-9] [0-9])?
cc-by-sa | cc | cc by sa( [0-9] [0-9])?
cc-by-nd | cc | cc by nd( [0-9] [0-9])?
cc-by-nc | cc | cc by nc( [0-9] [0-9])?
cc-by-nc-sa | cc | cc by nc sa( [0-9] [0-9])?
cc-by-nc-nd | cc | cc by nc nd( [0-9] [0-9])?
cc0 | cc0 | cc0( 1 0)?( universal)?
cc-by | attribution | creative commons attribution( [0-9] [0-9])?( international)?( license)?
cc-by-sa | attribution | creative commons attribution (sharealike|share alike)( [0-9] [0-9])?
cc-by-nc | attribution | creative commons attribution (noncommercial|non commercial)( [0-9] [0-9])?
cc-by-nd | attribution | creative commons attribution (noderivatives|no derivatives)( [0-9] [0-9])?
public-domain | domain | public domain( dedication)?
proprietary | proprietary | proprietary license
"""

# Label, keyword, priority and a sentence of the license's text, in words.
SENTENCES = """
mit | hereby | 90 | permission is hereby granted free of charge to any person obtaining a copy
mit | notice | 70 | the above copyright notice and this permission notice shall be included
bsd | redistribution | 90 | redistribution and use in source and binary forms with or without modification are permitted
bsd | endorse | 75 | may be used to endorse or promote products derived from this software
isc | fee | 90 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
gpl | redistribute | 85 | this program is free software you can redistribute it and or modify it
gpl | merchantability | 60 | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
lgpl | redistribute | 88 | this library is free software you can redistribute it and or modify it
apache | compliance | 90 | you may not use this file except in compliance with the license
apache | basis | 80 | distributed on an as is basis without warranties or conditions of any kind
mpl | subject | 90 | this source code form is subject to the terms of the mozilla public license
zlib | misrepresented | 90 | the origin of this software must not be misrepresented
boost | organization | 90 | permission is hereby granted free of charge to any person or organization obtaining a copy
unlicense | unencumbered | 90 | this is free and unencumbered software released into the public domain
wtfpl | fuck | 90 | do what the fuck you want to public license
cc0 | deed | 85 | the person who associated a work with this deed has dedicated the work to the public domain
cc0 | waived | 85 | has waived all copyright
public-domain | placed | 70 | placed in(to)? the public domain
proprietary | reserved | 40 | all rights reserved
proprietary | unauthorized | 70 | unauthorized (copying|use|reproduction|distribution) .{0,60}is (strictly )?prohibited
mit | substantial | 85 | shall be included in all copies or substantial portions of the software
mit | noninfringement | 75 | merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable
bsd | redistributions | 85 | redistributions of source code must retain the above copyright notice this list of conditions
bsd | redistributions | 85 | redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd | exemplary | 60 | direct indirect incidental special exemplary or consequential damages
bsd | acknowledgement | 85 | all advertising materials mentioning features or use of this software must display the following acknowledgement
isc | disclaims | 75 | the author disclaims all warranties with regard to this software
gpl | verbatim | 70 | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
gpl | verbatim | 80 | you may convey verbatim copies of the program s source code as you receive it
gpl | transferring | 80 | you may charge a fee for the physical act of transferring a copy
gpl | received | 75 | you should have received a copy of the gnu general public license
lgpl | received | 85 | you should have received a copy of the gnu (lesser|library) general public license
agpl | received | 88 | you should have received a copy of the gnu affero general public license
agpl | remotely | 85 | all users interacting with it remotely through a computer network
gfdl | invariant | 85 | with no invariant sections no front cover texts and no back cover texts
apache | perpetual | 80 | hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache | prominent | 75 | you must cause any modified files to carry prominent notices stating that you changed the files
apache | unless | 70 | unless required by applicable law or agreed to in writing software distributed under the license
mpl | obtain | 88 | if a copy of the mpl was not distributed with this file you can obtain one
epl | accompanying | 85 | this program and the accompanying materials are made available under the terms of the eclipse public license
cddl | contents | 85 | the contents of this file are subject to the terms of the common development and distribution license
npl | contents | 85 | the contents of this file are subject to the netscape public license
artistic | intent | 85 | the intent of this document is to state the conditions under which a package may be copied
zlib | altered | 85 | altered source versions must be plainly marked as such
zlib | arising | 70 | in no event will the authors be held liable for any damages arising from the use of this software
boost | processor | 85 | solely in the form of machine executable object code generated by a source language processor
unlicense | anyone | 85 | anyone is free to copy modify publish use compile sell or distribute this software
unlicense | heirs | 85 | for the benefit of the public at large and to the detriment of our heirs and successors
python | psf | 85 | psf hereby grants licensee a nonexclusive royalty free world wide license
php | php | 80 | products derived from this software may not be called php
openssl | openssl | 80 | this product includes software developed by the openssl project
openssl | cryptographic | 80 | this product includes cryptographic software written by eric young
x11 | consortium | 80 | the name of the x consortium shall not be used in advertising
ofl | font | 85 | this font software is licensed under the sil open font license
ofl | font | 80 | no modified version of the font software may use the reserved font name
ms-pl | infringed | 80 | if you bring a patent claim against any contributor over patents that you claim are infringed by the software
sspl | functionality | 85 | if you make the functionality of the program or a modified version available to third parties as a service
busl | production | 85 | redistribute and make non production use of the licensed work
elastic | hosted | 85 | you may not provide the software to third parties as a hosted or managed service
cc-by | redistribute | 75 | copy and redistribute the material in any medium or format
cc-by | credit | 75 | you must give appropriate credit provide a link to the license and indicate if changes were made
cc-by-sa | remix | 85 | if you remix transform or build upon the material you must distribute your contributions under the same license as the original
cc-by-nc | commercial | 75 | you may not use the material for commercial purposes
cc-by-nd | remix | 85 | if you remix transform or build upon the material you may not distribute the modified material
cc0 | neighboring | 80 | copyright and related or neighboring rights
public-domain | domain | 70 | (dedicated to|released into) the public domain
proprietary | reproduced | 70 | may not be (copied or )?reproduced .{0,60}without (the )?(prior )?(express )?written (permission|consent)
proprietary | reproduced | 65 | no part of this (publication|work|document) may be reproduced
vim | charityware | 85 | vim is charityware
beerware | beer | 85 | you can buy me a beer in return
json | evil | 85 | the software shall be used for good not evil
w3c | royalty | 80 | with or without modification for any purpose and without fee or royalty is hereby granted
cecill | french | 85 | governed by the cecill( b| c)? license under french law
eupl | eupl | 85 | licensed under the eupl
postgresql | agreement | 85 | for any purpose without fee and without a written agreement is hereby granted
sleepycat | accompanied | 85 | redistributions in any form must be accompanied by information on how to obtain complete source code
perl | perl | 85 | modify it under the same terms as perl itself
ruby | restriction | 70 | you may make and give away verbatim copies of the source form of the software without restriction
proprietary | confidential | 60 | proprietary and confidential
"""

# License label and its SPDX identifiers, in words.
IDENTIFIERS = """
gpl | gpl( [0-9]( [0-9])?)?( only| or later)?
lgpl | lgpl( [0-9]( [0-9])?)?( only| or later)?
agpl | agpl( [0-9]( [0-9])?)?( only| or later)?
gfdl | gfdl( [0-9] [0-9])?( no invariants| invariants)?( only| or later)?
apache | apache( [0-9] [0-9])?
mit | mit( 0| advertising| cmu| enna| feh| festival| modern variant| open group| testregex| wu)?
bsd | 0bsd|bsd( [1-4] clause)?( attribution| clear| lbnl| modification| open mpi| patent| shortened| uc| views| protection| source code)?
isc | isc( veillard)?
mpl | mpl( [0-9] [0-9])?( no copyleft exception)?
epl | epl( [0-9] [0-9])?
cddl | cddl( [0-9] [0-9])?
cpl | cpl 1 0
eupl | eupl( [0-9] [0-9])?
artistic | artistic( [0-9] [0-9])?( perl| cl8)?
zlib | zlib( acknowledgement)?
libpng | libpng( 2 0)?
boost | bsl 1 0
unlicense | unlicense
wtfpl | wtfpl
python | psf 2 0|python 2 0( 1)?|cnri python
php | php 3 [0-9]+
ruby | ruby
postgresql | postgresql
openssl | openssl( standalone)?
curl | curl
x11 | x11( distribute modifications variant)?
ofl | ofl 1 [01]( no rfn| rfn)?
odbl | odbl 1 0
odc-by | odc by 1 0
pddl | pddl 1 0
ms-pl | ms pl
ms-rl | ms rl
osl | osl [0-9] [0-9]
afl | afl [0-9] [0-9]
ecl | ecl [0-9] [0-9]
upl | upl 1 0
ncsa | ncsa
w3c | w3c( 19980720| 20150513)?
zpl | zpl [0-9] [0-9]
qpl | qpl 1 0( inria 2004)?
ipl | ipl 1 0
spl | spl 1 0
apsl | apsl [0-9] [0-9]
npl | npl [0-9] [0-9]
rpl | rpl [0-9] [0-9]
cecill | cecill( [0-9] [0-9]| b| c)?
vim | vim
tcl | tcl
json | json
beerware | beerware
icu | icu
unicode | unicode (3 0|dfs 2015|dfs 2016|tou)
sleepycat | sleepycat
sspl | sspl 1 0
busl | busl 1 1
elastic | elastic 2 0
cc-by | cc by( [0-9] [0-9])?
cc-by-sa | cc by sa( [0-9] [0-9])?
cc-by-nd | cc by nd( [0-9] [0-9])?
cc-by-nc | cc by nc( [0-9] [0-9])?
cc-by-nc-sa | cc by nc sa( [0-9] [0-9])?
cc-by-nc-nd | cc by nc nd( [0-9] [0-9])?
cc0 | cc0 1 0
public-domain | cc pddc
"""

#: Phrases around a license name, with the priority of the detection.
TEMPLATES = (
    (50, "{name}"),
    (80, "(is |are )?licen[sc]ed under( the)?( terms of( the)?)?( a| an)? {name}"),
    (80, "(released|distributed|available|published|provided|redistributed|offered|shared) under( the)?( terms of( the)?)?( a| an)? {name}"),
    (75, "(subject to|covered by|governed by)( the)?( terms of( the)?)? {name}"),
    (65, "see( the)? {name} for( more)?( details)?"),
)

#: The phrases that are always reported, with their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def rules() -> list[tuple[int, str, str, int, str]]:
    """(number, keyword, label, priority, pattern over blank-bounded words)."""
    out = []
    for line in LICENSES.strip().splitlines():
        label, keyword, name = line.split(" | ")
        out += [(keyword, label, priority, " " + t.format(name=f"({name})") + "(?= )") for priority, t in TEMPLATES]
    # a tag, and the later licenses of its expression ("MIT OR Apache-2.0"), each with the one before it
    named = [line.split(" | ") for line in IDENTIFIERS.strip().splitlines()]
    before = f"({'|'.join(ids for _, ids in named)})( with( [a-z0-9]+){{1,8}}?)? (and|or)"
    for label, ids in named:
        out.append(("spdx", label, 100, f" spdx license identifier ({ids})(?= )"))
        out.append(("spdx", label, 100, f" {before} ({ids})(?= )"))
    for line in SENTENCES.strip().splitlines():
        label, keyword, priority, text = line.split(" | ")
        out.append((keyword, label, int(priority), f" ({text})(?= )"))
    return [(i, *r) for i, r in enumerate(out)]


def gates() -> list[str]:
    """Words of which every match of any rule holds one: "license", or a rule's keyword."""
    names = [line.split(" | ") for line in LICENSES.strip().splitlines()]
    always = {keyword for _, keyword, name in names if not re.search(r"(\A| |\))(un)?license(\(|\Z)", name)}
    return sorted({"license", "unlicense", "spdx"} | always | {line.split(" | ")[1] for line in SENTENCES.strip().splitlines()})


def normal(text: Column) -> Column:
    """The words with one blank around each; two blanks if there are none.

    ``lower`` serves for A-Z: no character outside ASCII becomes a letter of a
    phrase or leaves its word by it.
    """
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS, " "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _running(sizes: Column) -> Column:
    """Sums of an array's first 1, 2, ... elements."""
    step = lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["all"], F.array(s["sum"] + x)).alias("all"))
    zero = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(sizes, zero, step, lambda s: s["all"])


def _places(words: Column, rule: Column) -> Column:
    """Word places of a rule's matches: the text cut at them, and the blanks counted."""
    marked = F.concat(F.lit("."), words)
    inner = F.transform(F.regexp_extract_all(marked, rule["pattern"], F.lit(0)), _blanks)
    outer = F.transform(F.split(marked, rule["pattern"]), _blanks)

    def placed(cut: Column) -> Column:
        before = F.transform(cut["inner"], lambda _, i: F.get(cut["outer"], i) + F.coalesce(F.get(cut["inner"], i - 1), F.lit(0)))
        return F.zip_with(_running(before), cut["inner"], lambda s, n: F.struct(
            s.alias("start"), (s + n).alias("end"), rule["priority"].alias("priority"),
            rule["label"].alias("label"), rule["number"].alias("number")))

    # a one-element array binds both cuts, so that each is made once
    return F.flatten(F.transform(F.array(F.struct(inner.alias("inner"), outer.alias("outer"))), placed))


def _hidden(a: Column, b: Column) -> Column:
    """Is detection ``a`` suppressed by ``b``?"""
    inside = (b["start"] <= a["start"]) & (b["end"] >= a["end"]) & (b["number"] != a["number"])
    longer = b["end"] - b["start"] > a["end"] - a["start"]
    same = (b["end"] - b["start"] == a["end"] - a["start"]) & (b["number"] < a["number"])
    return inside & ((b["priority"] > a["priority"]) | (b["priority"] == a["priority"]) & (longer | same))


def detect(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Appends ``normal_text``, ``may_hold`` and ``detections`` (start, end in words, priority, label, number)."""
    table = rules()
    keywords = sorted({r[1] for r in table})
    literal = F.array(*[
        F.struct(F.lit(n).alias("number"), F.lit(k).alias("keyword"), F.lit(label).alias("label"),
                 F.lit(p).alias("priority"), F.lit(pattern).alias("pattern"))
        for n, k, label, p, pattern in table])
    gate = F.arrays_overlap(F.split("normal_text", " "), F.array(*[F.lit(w) for w in gates()]))
    known = F.array(*[F.lit(k) for k in keywords])

    def found(words: Column) -> Column:
        own = F.array_intersect(F.split(words, " "), known)
        due = F.transform(F.array(own), lambda o: F.filter(literal, lambda r: F.array_contains(o, r["keyword"])))
        held = F.filter(F.flatten(due), lambda r: F.rlike(words, r["pattern"]))
        return F.flatten(F.transform(held, lambda r: _places(words, r)))

    # one-element arrays bind a value once for the functions below
    every = F.flatten(F.transform(F.array("normal_text"), found))
    kept = F.flatten(F.transform(F.array("every"), lambda all_: F.filter(all_, lambda a: ~F.exists(all_, lambda b: _hidden(a, b)))))
    out = docs.withColumn("normal_text", normal(F.col(text_col))).withColumn("may_hold", gate)
    out = out.withColumn("every", F.when(F.col("may_hold"), every))
    return out.withColumn("detections", F.when(F.col("may_hold"), kept)).drop("every")


def summarise(detected: DataFrame) -> DataFrame:
    """Appends ``n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    words = F.col("normal_text")
    base = "(?= (?:" + "|".join(p for p, _ in BASE) + ") )"
    pieces = F.when(F.col("may_hold") & words.rlike(base), F.split(F.concat(F.lit("."), words), base))
    blanks = F.transform(F.col("pieces"), _blanks)
    base_labels = F.filter(F.array(*[F.when(words.contains(f" {p} "), F.lit(label)) for p, label in BASE]), lambda x: x.isNotNull())
    no_labels = F.array().cast("array<string>")
    n = F.when(words == "  ", F.lit(0)).otherwise(_blanks(words) - 1).cast("long")
    sums = F.aggregate(F.slice(blanks, 1, F.size(blanks) - 1), F.lit(0), lambda s, x: s + x)
    out = detected.withColumn("pieces", pieces).withColumns({
        "n_words": n,
        "n_base": F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(F.size("pieces") - 1).cast("long"),
        "first_word": F.get(blanks, F.lit(0)).cast("long"),
        "last_word": sums.cast("long"),
        "base": F.when(F.col("pieces").isNull(), no_labels).otherwise(base_labels),
        "own": F.coalesce(F.transform("detections", lambda x: x["label"]), no_labels),
        "score": F.coalesce(F.array_max(F.transform("detections", lambda x: x["priority"])) / F.lit(100.0), F.lit(0.0)),
    })
    joined = lambda c: F.array_join(F.sort_array(F.array_distinct(c)), ",")
    out = out.withColumn("base_labels", joined(F.col("base"))).withColumn("labels", joined(F.concat("base", "own")))
    return out.drop("pieces", "base", "own")
