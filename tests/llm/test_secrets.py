"""Secrets against a plain scan; the ledger scans a blob and rule version once."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kymora.llm import queries, secrets
from tests.conftest import SF

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
PLAIN = (("assign", ASSIGN, 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24))
TEXTS = [
    "", None, "token: token: abcdef", "xxxAKIA" + "A" * 16 + "deadbeef" * 4, "🙂password = 'hunter22é' é " + "ab" * 15 + " token=abc", "Secret=ſecret api-key:zzzzzzz APIKEY:zzzzzzz",
    "password:" + "a" * 20_000, "token=abcdef " * 1000, "pass\nAKIA1 AKIAAKIA" + "B" * 14, "plain words", "plain words", "token=" + "0123456789abcdef" * 2,
]


def brute(text):
    spans = [(m.start(), i, m.end(), kind) for i, (kind, p, group, least) in enumerate(PLAIN) for m in p.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


@pytest.fixture(scope="module")
def few(spark):
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], 1, "x"), (2, TEXTS[3], 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, start long, blob string")


def test_spans(spark, few):
    got = secrets.span_digest(secrets.scan(few)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.spans) for r in got) == sorted((d is None, d or 0, brute(t)) for d, t in [*enumerate(TEXTS), (None, TEXTS[3]), (2, TEXTS[3])])
    assert all(r.n_assign + r.n_access + r.n_hex == (r.spans.count(",") + 1 if r.spans else 0) for r in got)


def test_documents(spark):
    docs = queries.documents(spark, SF)
    got = {r.doc_id: r.spans for r in secrets.span_digest(secrets.scan(docs)).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_ledger_is_incremental(spark, few):
    ledger = secrets.Ledger(spark)
    secrets.scan(few.filter("doc_id < 6"), ledger, secrets.RULES[:1])
    assert ledger.rows().count() == 5  # null and empty are one blob
    secrets.scan(few, ledger, secrets.RULES[:1])
    added = ledger.rows().count()
    assert added == len({t or "" for t in TEXTS})
    secrets.scan(few, ledger, secrets.RULES[:1])
    assert ledger.rows().count() == added
    again = secrets.scan(few, ledger)
    assert ledger.rows().filter(F.size("rules") == 2).count() == added  # the two new rules only
    whole = secrets.scan(few)
    shape = lambda df: sorted(map(str, secrets.span_digest(df).collect()))
    assert shape(again) == shape(whole)


def test_redaction(spark, few):
    once = few.filter("doc_id <> 2 and text is not null")
    joined = secrets.scan(once).join(once, "doc_id")
    for r in joined.select("text", "spans", secrets.redact(F.col("text"), F.col("spans")).alias("clean")).collect():
        hidden = [False] * len(r.text)
        for s in r.spans:
            hidden[s.start : s.end] = [True] * (s.end - s.start)
        want, before = "", False
        for c, h in zip(r.text, hidden):
            want += c if not h else "" if before else secrets.MARK
            before = h
        assert r.clean.replace(secrets.MARK * 2, secrets.MARK) == want.replace(secrets.MARK * 2, secrets.MARK)
        assert brute(r.clean) == ""


def test_empty(spark, empty):
    assert secrets.scan(empty).count() == 0


def test_a_second_run_of_the_query_scans_nothing(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    first = sorted(map(tuple, queries.op3_secrets(spark, SF, folder).collect()))
    n = spark.read.parquet(folder).count()
    again = sorted(map(tuple, queries.op3_secrets(spark, SF, folder).collect()))
    assert again == first == sorted(map(tuple, queries.op3_secrets(spark, SF).collect())) and spark.read.parquet(folder).count() == n
    docs = queries.documents(spark, SF)
    corpus_pipeline.secret_scans(spark, docs.unionByName(docs.limit(1).selectExpr("doc_id", "'password = hunter2x' AS text", "lang", "source", "n_chars")), SF, folder).count()
    assert spark.read.parquet(folder).count() == n + 1
