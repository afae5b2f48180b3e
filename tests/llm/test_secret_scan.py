import hashlib
import random
import re

from tessera.llm import secret_scan as ss

from .util import ODD_TEXTS, docs

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    line = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
    count = [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]
    return *count, hashlib.sha256(line.encode()).hexdigest(), line


BITS = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "abc", "x1+/_.=-",
        "AKIA", "ABCDEFGH0123456789", "a1b2c3d4e5f6a7b8", "0123456789abcdef", "é", "😀", "\n", "zzz", ";", "A"]


def test_base_spans_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(BITS) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    rows += [(1000, "secret=token: abcdef"), (1001, "token==abcdef"), (1002, "AKIAAKIA" + "A" * 15),
             (1003, "password: " + "x" * 70_000 + " token=abc secret='q1w2e3'")]
    got = {r.doc_id: r for r in ss.scan(docs(spark, rows), versions=[1]).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) == brute(t), t


def test_method_adds_spans_and_keeps_base_ones(spark):
    t = "password = hunter22 ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY----- xoxb-1234567890-abc"
    r = ss.scan(docs(spark, [(1, t)])).first()
    assert r.base_sha256 == brute(t)[3]
    assert {s.split(":")[0] for s in r.spans.split(",")} >= {"assign", "github", "private_key", "slack"}
    assert [int(s.split(":")[1]) for s in r.spans.split(",")] == sorted(int(s.split(":")[1]) for s in r.spans.split(","))


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = [(1, "token=abcdef"), (2, "token=abcdef"), (3, None)]
    ss.scan(docs(spark, first), ledger, versions=[1]).collect()
    scans, findings = ss.read_ledger(spark, ledger)
    assert scans.count() == 2 and findings.count() == 1
    more = first + [(4, "secret: zzzzzzz"), (5, "token=abcdef")]
    got = {r.doc_id: r.spans for r in ss.scan(docs(spark, more), ledger, versions=[1]).collect()}
    scans, findings = ss.read_ledger(spark, ledger)
    assert scans.count() == 3 and findings.count() == 2  # one new blob only
    assert got == {i: brute(t)[4] for i, t in more}
    ss.scan(docs(spark, more), ledger, versions=[1, 2]).collect()
    scans, findings = ss.read_ledger(spark, ledger)
    assert sorted((r.version, r["count"]) for r in scans.groupBy("version").count().collect()) == [(1, 3), (2, 3)]
    assert findings.count() == 2


def test_a_broken_update_is_repeated_without_double_findings(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    df = docs(spark, [(1, "token=abcdef")])
    blobs = df.selectExpr("text").select(ss.blob_of(df.text).alias("blob"), "text").selectExpr("*", "array(1) AS todo")
    ss.scan_blobs(blobs, [1]).write.parquet(f"{ledger}/findings")  # broke before the scans were written
    assert ss.scan(df, ledger, versions=[1]).first().n_assign == 1


def test_edge_cases(spark):
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "token=abcdef"), (3, "token=abcdef"), (3, "token=abcdef")]
    df = docs(spark, rows).selectExpr("*", "1 AS blob", "2 AS kind", "3 AS version")
    got = ss.scan(df).collect()
    assert sorted(map(str, ((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in got))) == sorted(
        map(str, ((i, *brute(t)) for i, t in rows)))
    assert ss.scan(docs(spark, [])).count() == 0
