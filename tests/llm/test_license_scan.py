import re

import pytest
from fixtures import SMALL, edge_rows, empty_docs, edge_docs, rows_of, with_clashes

from ledgerlens.llm import license_scan
from ledgerlens.llm.common import read_table
from ledgerlens.llm.license_rules import BASE, STEMS, all_rules

RULES = [(r, re.compile(f"( (?:{r.pattern}))(?= )")) for r in all_rules()]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    norm = " " + " ".join(words) + " "
    base = [(i, label) for label, p in BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    found = sorted((m.start(), -m.end(), -r.priority, k, r.label) for k, (r, c) in enumerate(RULES) if r.keyword in norm
                   for m in c.finditer(norm))
    standing, kept = None, []
    for d in found:
        if standing is None or d[0] >= -standing[1]:
            kept += [standing] if standing else []
            standing = d
        elif -d[1] > -standing[1] and d[2] < standing[2]:
            standing = d
    kept += [standing] if standing else []
    labels = sorted({label for _, label in base})
    starts = [i for i, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(labels),
            ",".join(sorted({d[4] for d in kept} | set(labels))), len(kept), max((-d[2] for d in kept), default=0) / 100)


NOTICES = [
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "This is under the MIT License.", "CC BY-NC 4.0, cc by",
    "GNU General Public License, version 3 or later; GNU GENERAL PUBLIC LICENSE", "SPDX-License-Identifier: GPL-2.0-only",
    "the GNU Lesser General Public License version 2.1", "mit license mit license MIT LICENSE", "All rights reserved. Copyright 2019",
    "https://creativecommons.org/licenses/by-sa/4.0/", "x mit licenses y", "gnu general public licensee", "ccby", "CC\nBY",
    "Redistribution and use in source and binary forms, with or without modification, are permitted. The BSD 3-Clause License",
    "MITK License", "Public domain; CC0 1.0 Universal", "MİT License"]


def check(spark, rows):
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(found) == sorted(((i, *slow(t)) for i, t in rows), key=repr)


def test_matches_brute_force(spark):
    rows = list(enumerate(NOTICES)) + [(100 + i, f"{a} und {b}") for i, (a, b) in enumerate(zip(NOTICES, NOTICES[1:]))]
    check(spark, rows + [(200, " ".join(NOTICES) * 3)])


def test_documents(spark):
    check(spark, [tuple(r) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect()])


def test_edges(spark):
    check(spark, [(r[0], r[1]) for r in edge_rows()])
    assert license_scan.scan(empty_docs(spark)).count() == 0
    assert license_scan.scan(with_clashes(edge_docs(spark))).count() == len(edge_rows())


def test_very_many_detections(spark):
    text = "mit license, apache license 2.0; " * 4000
    found = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (found["n_base"], found["n_kept"], found["first_word"]) == (8000, 8000, 0)


def test_suppression(spark):
    found = license_scan.scan(spark.createDataFrame([(1, "the GNU Lesser General Public License, version 2.1")], "doc_id long, text string"))
    assert found.first()["labels"] == "lgpl-2.1"  # the plain gpl and lgpl names lie inside


def test_rules():
    rules = all_rules()
    assert len(rules) >= 300
    for rule in rules:
        assert rule.keyword == rule.keyword.lower() and " " not in rule.keyword and 0 < rule.priority <= 100


@pytest.mark.parametrize("phrase", BASE.values())
def test_every_base_phrase_passes_the_gate(phrase):
    assert any(stem in phrase for stem in STEMS)


def test_native_and_without_shuffle(spark):
    plan = license_scan.scan(read_table(spark, SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "Exchange"))


def test_line_ends_of_unicode_within_words(spark):
    texts = ["one two\u2028three mit license four cc by five"] + [
        f"a{c}b mit license c{c}d, cc by {c} e mit licensed; neither the name of x{c}y nor the names of its contributors "
        f"may be used to endorse or promote products {c} apache license 2.0" for c in "\x85\u2028\u2029"]
    check(spark, list(enumerate(texts)))


def sample(tree, most):
    """A text that a parsed pattern matches, without its options or (``most``) with them."""
    out = ""
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "ANY":
            out += "x"
        elif name == "IN":
            out += chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0])
        elif name == "BRANCH":
            out += sample(arg[1][-1 if most else 0], most)
        elif name == "SUBPATTERN":
            out += sample(arg[3], most)
        else:
            low, high, part = arg
            out += sample(part, most) * max(low, min(high, 1) if most else low)
    return out


def test_every_rule_with_its_notice_alone(spark):
    rows = []
    for rule, whole in RULES:
        said = [sample(re._parser.parse(rule.pattern), most) for most in (False, True)]
        assert all(whole.search(f" {t} ") for t in said)
        said = [t for t in said if rule.keyword in t]
        assert said, rule
        rows += said
    rows = list(enumerate(dict.fromkeys(rows)))
    assert all(slow(t)[6] for _, t in rows)
    check(spark, rows)


def test_texts_beside_the_gate(spark):
    texts = ["creative commons", "Apache 2.0", "BSD 3 clause", "0BSD", "bsd zero clause license", "MIT No Attribution", "wtfpl", "EUPL",
             "same terms as Perl", "used for good, not evil", "for research use only", "nothing of the kind"]
    check(spark, list(enumerate(texts)))
