"""Licence scans against plain Python, and the automaton against regular expressions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from textforge.llm import licenses
from textforge.llm.queries import REGISTRY

FOLDER = "/root/testdata/sf0.01"
MIT = re.sub(r"<<.*?>>", "", licenses.TEXTS["mit-text"]).replace("(including the next paragraph)", "").replace("MIT License", "", 1).replace("In no event shall ", "In no event shall the authors ")


def _base(text):
    words = brute.words(text)
    out = []
    for phrase, label in licenses.BASE.items():
        parts = phrase.split(" ")
        out += [(label, i, i + len(parts)) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return words, out


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    rows = REGISTRY["op13_license_scan"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words, base = _base(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (len(words), len(base))
        starts = [b[1] for b in base]
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({b[0] for b in base}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert {x for r in rows for x in r.labels.split(",")} >= {"gpl", "gpl-3.0-notice", "apache-2.0-notice", "cc-by-nc-4.0-notice", "mit-notice"}


def test_edge_rows(edge_docs, no_docs, edge_rows):
    found = licenses.add_licenses(edge_docs, "result").select("doc_id", "text", "result.*").collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(x[0]) for x in edge_rows)
    for r in found:
        words, base = _base(r.text)
        assert r.n_words == len(words) and [(p.label, p.start, p.stop) for p in r.places if p.base] == base
    assert licenses.add_licenses(edge_docs, "result").columns == [*edge_docs.columns, "result"]
    assert licenses.add_licenses(edge_docs, "found").columns == edge_docs.columns
    assert licenses.add_licenses(no_docs, "result").count() == 0


def _labels(text):
    return {p["label"] for p in licenses.scan(text.encode())["places"] if not p["base"]}


def test_mandatory_wording():
    assert _labels(MIT) == {"mit-text"}
    assert _labels("before " + MIT + " after") == {"mit-text"}
    assert _labels(MIT.replace("this permission notice", "this permission notice (including the next paragraph)")) == {"mit-text"}
    assert _labels(MIT.upper().replace(" ", "\n * ")) == {"mit-text"}
    assert _labels(MIT.replace("the authors", "ACME Inc or anyone who works there")) == {"mit-text"}
    words = MIT.split()
    for i in range(0, len(words), 7):  # a mandatory word that is missing, changed or new
        for other in ([], ["xyz"], [words[i], "xyz"]):
            changed = " ".join([*words[:i], *other, *words[i + 1 :]])
            held = "event shall" in changed and ("shall the authors" not in changed or other[1:])
            assert "mit-text" not in _labels(changed) or held or i >= len(words) - 1 or (i == 0 and other[1:]), (i, other)
    assert _labels(MIT.replace("the authors", "a " * 21)) == set()
    assert _labels("Licensed under CC BY-NC 4.0.") == {"cc-by-nc-4.0-notice"}
    assert _labels("under the terms of the MIT Licence; GNU General Public License, either version 3") == {"mit-notice", "gpl-3.0-notice"}
    assert _labels("under the MIT, License 2") == {"mit-notice"} and _labels("underthe MIT License") == set()


def test_places_and_score():
    found = licenses.scan("x Mit License mit-license MIT License".encode())
    assert [(p["start"], p["stop"]) for p in found["places"]] == [(1, 3), (3, 5), (5, 7)] and found["score"] == 0.5
    assert licenses.scan(b"released under the mit license")["score"] == 0.8 and licenses.scan(MIT.encode())["score"] == 1.0
    assert licenses.scan(b"") == {"n_words": 0, "places": [], "score": 0.0}


def test_automaton_equals_regular_expression():
    draw = random.Random(4)
    markups = [
        'a <<beginOptional>>b <<beginOptional>>c<<endOptional>> a<<endOptional>> <<var;name="x";words="0-2">> d',
        'a b <<var;name="x";match="c|c d|a">> <<var;name="y";words="1-3">> a',
        'a a <<beginOptional>>a b<<endOptional>> <<var;name="x";match="b|a b">>',
    ]
    for markup in markups:
        automaton = licenses.Automaton.of("x", markup)
        pattern = re.compile(" " + licenses._regex(licenses.parse(markup)))
        hits = 0
        for _ in range(4000):
            words = draw.choices("abcd", k=draw.randrange(1, 12))
            text = licenses.spaced(" ".join(words).encode())
            ends = [i for i in range(len(words)) if pattern.match(" " + " ".join(words[i:]) + " ")]
            assert [lo for lo, _ in automaton.find(text)] == ends, (markup, words)
            hits += bool(ends)
        assert hits > 50


@pytest.mark.parametrize("markup", ["<<beginOptional>>a", '<<var;name="x";words="0-2">>', "a <<odd>>"])
def test_bad_markup(markup):
    with pytest.raises(ValueError):
        licenses.Automaton.of("x", markup)


def test_long_text():
    text = ("under the terms of the mit licence " * 100_000 + "é" * 1_000_000).encode()
    found = licenses.scan(text)
    assert found["n_words"] == 700_001 and len(found["places"]) == 100_000


def test_narrow(spark):
    plan = REGISTRY["op13_license_scan"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan
