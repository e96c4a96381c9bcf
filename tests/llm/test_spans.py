"""Personal data and secrets against plain Python."""

import random
import re
import string
import time

from tests.llm import brute
import pytest
from pyspark.sql import functions as F

from textforge.llm import pii, secrets
from textforge.llm.queries import REGISTRY

FOLDER = "/root/testdata/sf0.01"


def _texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


def _spans(df):
    return [(r.doc_id, r.text, [(s.kind, s.start, s.stop) for s in r.result]) for r in df.select("doc_id", "text", "result").collect()]


@pytest.mark.parametrize("add, want", [(pii.add_pii, brute.pii), (secrets.add_secrets, brute.secrets)])
def test_edge_rows(edge_docs, no_docs, edge_rows, add, want):
    found = _spans(add(edge_docs, "result"))
    assert sorted(str(x[0]) for x in found) == sorted(str(x[0]) for x in edge_rows)
    for doc_id, text, spans in found:
        assert spans == want(text), doc_id
    assert sum(len(x[2]) for x in found) > 5
    assert add(edge_docs, "result").columns == [*edge_docs.columns, "result"]
    assert add(no_docs, "result").count() == 0


def test_pii_query(spark):
    texts = _texts(spark)
    rows = REGISTRY["op2_pii"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute.pii(texts[r.doc_id])
        base = [s for s in spans if s[0] in pii.BASE]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE]
        assert r.base_sha256 == brute.sha(brute.joined(base)) and r.spans == brute.joined(spans)
    assert sum(r.n_email + r.n_phone for r in rows) > 0


def test_secrets_query(spark):
    texts = _texts(spark)
    rows = REGISTRY["op8_secrets"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute.secrets(texts[r.doc_id])
        base = [s for s in spans if s[0] in secrets.BASE]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in base) for k in secrets.BASE]
        assert r.base_sha256 == brute.sha(brute.joined(base)) and r.spans == brute.joined(spans)
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows) > 0


def test_native(spark):
    for name in ("op2_pii", "op8_secrets"):
        plan = REGISTRY[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def test_best_entropy(spark):
    draw = random.Random(5)
    values = ["ab" * 10, "0123456789abcdef0123", "0123456789abcdef0123zzz", "Zx9Lq2Wm7Rt4Vb1Ny6Uc3Pd", "short", "ABCD2345" * 4 + "abc" * 9, "a" * 50]
    values += ["".join(draw.choices("aAbB19z+/_=-", k=draw.randrange(20, 90))) for _ in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", secrets.best_entropy(F.col("v")).alias("e")).collect():
        windows = [r.v[i : i + 20] for i in range(len(r.v) - 19)]
        for kind, (pattern, _) in secrets.CLASSES.items():
            own = [brute.entropy(w) for w in windows if re.search(pattern, w)]
            assert (r.e[kind] is None) == (not own) and (not own or abs(r.e[kind] - max(own)) < 1e-8), (r.v, kind)


def test_long_candidates(spark):
    """A run of a million characters takes seconds: the time grows with its length, not with the square."""
    draw = random.Random(6)
    alphabet = string.ascii_letters + string.digits + "+/"
    texts = ["".join(draw.choices(alphabet, k=1_000_000)), "g1" * 500_000, "data:" + "".join(draw.choices("0123456789abcdef", k=300_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    begin = time.monotonic()
    found = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.result] for r in secrets.add_secrets(df, "result").collect()}
    assert time.monotonic() - begin < 60
    assert found[0] == [("entropy", 0, 1_000_000)] and found[1] == []
    assert found[2] == [("hex", 5, 300_005), ("entropy", 5, 300_005)]


def test_random_strings_of_each_class(spark):
    draw = random.Random(3)
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    alphabets = {"base32": upper + "234567", "base36": lower + digits, "base36 upper": upper + digits, "base62": lower + upper + digits}
    rows = [(kind, size, "".join(draw.choices(a, k=size))) for kind, a in alphabets.items() for size in (20, 32) for _ in range(300)]
    rows = [r for r in rows if not r[2].isalpha()]  # the allow-list takes what has no digit
    df = spark.createDataFrame(rows, "kind string, size int, v string")
    found = df.groupBy("kind", "size").agg(F.avg(secrets.random_looking(F.col("v")).cast("int")).alias("share")).collect()
    assert len(found) == 8 and all(r.share > 0.96 for r in found), found
    names = ["my-long-report-name-2024-12-01", "path/to/some/file/2024/page/12", "GB82WEST12345698765432", "aaaaaaaaaaaaaaaaaaaa1"]
    df = spark.createDataFrame([(v,) for v in names], "v string")
    assert [r.found for r in df.select("v", secrets.random_looking(F.col("v")).alias("found")).collect()] == [False] * 4


def test_very_many_matches(spark):
    text = "mail a@b.cd, " * 20_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.monotonic()
    spans = pii.add_pii(df, "result").first().result
    assert time.monotonic() - begin < 60
    assert [(s.kind, s.start, s.stop) for s in spans] == [("email", 13 * i + 5, 13 * i + 11) for i in range(20_000)]


def test_iban_ends_where_its_country_says(spark):
    de, gb = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    texts = [f"{de} BIC COBADEFFXXX", "DE89370400440532013000 2024-01-01", f"{gb} EUR 50", f"{de} {gb} AND 12", f"EU22 {de}", f"x{gb}", f"{gb}1"]
    want = [[de], ["DE89370400440532013000"], [gb], [de, gb], [de], [], []]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.add_pii(df, "result").orderBy("doc_id").collect()
    assert [[r.text[s.start : s.stop] for s in r.result if s.kind == "iban"] for r in rows] == want
