"""Base phrases and rule detections against a direct reading in Python."""

import re

import pytest

from tidepool.llm import licenses as L

SF = "/root/testdata/sf0.001"

TEXTS = [
    None, "", "...", "MIT License mit license", "The MIT-License and the apache license, Version 2.0.",
    "This work is licensed under the GNU Lesser General Public License version 2 1", "CC BY 4.0 cc by cc-by-sa",
    "SPDX-License-Identifier: Apache License 2.0", "mit licenses are not the phrase", "Été gnu general public license É",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this",
    "a " * 3000 + "Released under the MIT License " + "b " * 3000, "mit license " * 200, "nothing", "nothing",
    "placed in the public domain; all rights reserved", "unauthorized copying of this file is strictly prohibited",
]


def _words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _base(text):
    ws, found = _words(text), []
    for phrase, label in L.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(ws)) if ws[i : i + len(p)] == p]
    return len(ws), sorted(found)


def _detections(text):
    """Every rule on the whole text, without keywords or gates."""
    norm = "." + " " + " ".join(_words(text)) + " "
    found = []
    for number, _, label, priority, pattern in L.rules():
        for m in re.finditer(pattern, norm):
            start = norm[: m.start()].count(" ")
            found.append((start, start + m[0].count(" "), priority, label, number))
    kept = [a for a in found if not any(
        b[0] <= a[0] and b[1] >= a[1] and a[4] != b[4]
        and (b[2] > a[2] or b[2] == a[2] and (b[1] - b[0] > a[1] - a[0] or b[1] - b[0] == a[1] - a[0] and b[4] < a[4])) for b in found)]
    return sorted(kept)


def _expected(text):
    n, base = _base(text)
    kept = _detections(text)
    join = lambda labels: ",".join(sorted(set(labels)))
    places = [i for i, _ in base]
    return (
        n, len(base), min(places, default=None), max(places, default=None), join(x for _, x in base),
        join([x for _, x in base] + [d[3] for d in kept]), max((d[2] for d in kept), default=0) / 100,
    )


def _row(r):
    return tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))


def test_texts(spark):
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(TEXTS)], "doc_id long, text string, label string")
    detected = L.detect(df)
    rows = {r["doc_id"]: r for r in L.summarise(detected).collect()}
    assert len(rows) == len(TEXTS) and rows[0]["label"] == "own"
    for i, t in enumerate(TEXTS):
        assert _row(rows[i]) == _expected(t), t
    for r in detected.collect():
        own = sorted((d["start"], d["end"], d["priority"], d["label"], d["number"]) for d in r["detections"] or [])
        assert own == _detections(TEXTS[r["doc_id"]])


def test_query(spark):
    from tidepool.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op8_licenses"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert _row(r) == _expected(texts[r["doc_id"]])


def test_the_plan_runs_no_python(spark):
    from tidepool.llm.queries import QUERIES

    plan = QUERIES["op8_licenses"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("line", [x for x in L.LICENSES.strip().splitlines() + L.SENTENCES.strip().splitlines()])
def test_every_match_holds_keyword_and_gate(line):
    """Each choice of a rule's name, its optional parts left out, holds the keyword and a gate."""
    parts = line.split(" | ")
    keyword, name = parts[1], parts[-1]
    while re.search(r"\([^()]*\)\?", name):  # without what may be missing
        name = re.sub(r"\([^()]*\)\?", "", name)
    for choice in re.split(r"\|(?![^(]*\))", name):
        ws = set(re.findall("[a-z0-9]+", choice))
        assert keyword in ws
        assert ws & set(L.gates())


def test_empty_table(spark):
    assert L.summarise(L.detect(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_several_hundred_rules():
    assert len(L.rules()) > 300


TAGS = [
    ("MIT", "mit"), ("Apache-2.0", "apache"), ("GPL-3.0-or-later", "gpl"), ("GPL-2.0+", "gpl"), ("BSD-3-Clause", "bsd"), ("LGPL-2.1-only", "lgpl"),
    ("0BSD", "bsd"), ("CC-BY-SA-4.0", "cc-by,cc-by-sa"), ("(MIT OR Apache-2.0)", "apache,mit"), ("MPL-2.0 AND ISC AND Zlib", "isc,mpl,zlib"),
    ("GPL-2.0 WITH Linux-syscall-note OR BSD-2-Clause", "bsd,gpl"),
]


def test_identifiers_and_alternatives_are_found(spark):
    rows = [(f"x\n// SPDX-License-Identifier: {tag}\nint main", labels) for tag, labels in TAGS]
    rows += [("the GNU Library General Public License version 2", "lgpl"), ("tools and json", "")]
    df = spark.createDataFrame(rows, "text string, expected string")
    for r in L.summarise(L.detect(df)).collect():
        assert r["labels"] == r["expected"], r["text"]
        assert r["labels"] == _expected(r["text"])[5]


def _choices(pattern):
    """Every text of a name without sets and repeats, its optional parts left out or in."""
    group = re.search(r"\(([^()]*)\)(\??)", pattern)
    if not group:
        return set(pattern.split("|"))
    put = group[1].split("|") + [""] * bool(group[2])
    return {c for p in put for c in _choices(pattern[: group.start()] + p + pattern[group.end() :])}


def test_every_alternative_holds_its_keyword():
    for line in L.LICENSES.strip().splitlines():
        _, keyword, name = line.split(" | ")
        for choice in _choices(name):
            assert keyword in re.findall("[a-z0-9]+", choice), (choice, keyword)
