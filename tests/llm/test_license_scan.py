"""Automata against regular expressions; base places against a plain search."""

import random
import re

import pytest

from tidemark.llm.license_scan import PHRASES, TEMPLATES, compile_template, scan_licenses
from tidemark.llm.queries import op2_license_scan

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def pattern(template):
    out = ""
    for mark, word in re.findall(r"<<(/?optional|var:\d+)>>|([^\s<>]+)", template):
        out += (re.escape(word) + " ") if word else {"optional": "(?:", "/optional": ")?"}.get(mark) or f"(?:[^ ]+ ){{0,{mark[4:]}}}"
    return re.compile(r"(?:^|(?<= ))" + out)


def test_automata_equal_patterns():
    rng = random.Random(2)
    for label, template in TEMPLATES.items():
        made, expected = compile_template(label, template), pattern(template)
        fixed = [w for _, w in re.findall(r"<<(/?optional|var:\d+)>>|([^\s<>]+)", template) if w]
        hits = 0
        for _ in range(400):
            text = []
            for part in re.split(r"(<<optional>>.*?<</optional>>)", template):
                if part.startswith("<<optional") and rng.random() < 0.5:
                    continue
                text += [w for w in re.sub(r"<<.*?>>", " filler ", part).split()]
            for _ in range(rng.randrange(3)):
                i = rng.randrange(len(text) + 1)
                text[i:i + rng.randrange(2)] = [rng.choice([*fixed, "zz"])] * rng.randrange(2)
            joined = " ".join(text) + " "
            found = list(made.matches([w.encode() for w in text]))
            hits += bool(found)
            assert bool(found) == bool(expected.search(joined)), (label, text)
        assert hits > 5, label


def test_bad_templates():
    for bad in ("<<optional>>a<</optional>>", "<<optional>> a", "<<var:3>>"):
        with pytest.raises(ValueError):
            compile_template("x", bad)


def test_planted(spark):
    rows = [(1, None), (2, ""), (3, "x Under the MIT-License. under the mit license"), (4, "CC BY-NC cc by nc by nc"),
            (5, "This work is licensed under the GNU General Public License, version 3."), (6, "Released under the MIT License."),
            (6, "Released under the MIT License."), (7, "Copyright (c) 2020 Some Body Inc. All rights reserved"),
            (8, "licensed under the apache license, version 2.0 " + "word " * 50000), (9, "licensed under the gnu public license version 3"),
            (10, "under the mit\x00license")]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, n_base int, labels string").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in scan_licenses(df).collect()}
    assert got == {
        1: (0, 0, None, None, "", "", 0.0), 2: (0, 0, None, None, "", "", 0.0), 3: (9, 2, 1, 5, "mit", "mit", 0.5),
        4: (8, 2, 0, 3, "cc-by-nc", "cc-by-nc", 0.5), 5: (12, 0, None, None, "", "gpl-3", 1.0),
        6: (5, 1, 1, 1, "mit", "mit", 1.0), 7: (9, 0, None, None, "", "all-rights-reserved", 1.0),
        8: (50008, 1, 3, 3, "apache-2", "apache-2", 1.0), 9: (8, 0, None, None, "", "", 0.0), 10: (4, 1, 0, 0, "mit", "mit", 0.5)}
    assert scan_licenses(df).count() == len(rows) and scan_licenses(df.where("false")).count() == 0


def test_query(spark):
    got = {r.doc_id: r for r in op2_license_scan(spark, SF_DIR).collect()}
    for doc in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        w, r = words(doc.text), got.pop(doc.doc_id)
        base = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        labels = {label for _, label in base}
        own = {label for label, t in TEMPLATES.items() if pattern(t).search(" ".join(w) + " ")}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(w), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None))
        assert (r.base_labels, r.labels) == (",".join(sorted(labels)), ",".join(sorted(labels | own)))
    assert not got
