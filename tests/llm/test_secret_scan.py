import hashlib

import duckdb
from pyspark.sql import functions as F

from rivalry.llm import secret_scan as ss
from tests.llm.conftest import ODD_TEXTS

KEY = "AKIA" + "Q" * 16
TEXTS = [
    f"password: token = abcdefgh {KEY} and {KEY}x, AKIAshort",
    "Api_Key=\"abc123==\" APIKEY : 'zzzzzz' tokenpassword=secret=12345678",
    "é🙂 passwd=éé secret='x' secret=\"abcdef\" " + "0123456789abcdef" * 3 + " " + "ABCDEF" * 8,
    "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18 + " xoxb-1234567890-ab eyJab.eyJcd.ef_-",
    "token=" + "f" * 30 + "g", "kAKIA" + "A" * 30, "pass word: abcdefgh", "PASSWORD\t=abcdefgh", "password  =  \"" + "a" * 3000,
]


def test_trigram_queries():
    assert ss.trigram_query("AKIA[A-Z0-9]+") == [[["aki", "kia"]]]
    assert ss.trigram_query("[0-9a-f]{24,}") == []
    assert ss.trigram_query("(?i:(ab|cde))x") == [[["abx"], ["cde", "dex"]]]
    assert ["api", "ike", "key", "pik"] in ss.trigram_query(ss.RULES[0].pattern)[0]
    assert ss.trigram_query("abc(d|e+)fgh") == [[["abc"]], [["fgh"]]]


def test_spans_equal_brute_force(spark, docs_of):
    texts = TEXTS + ODD_TEXTS
    got = {r.doc_id: [tuple(s) for s in r.secrets] for r in ss.scan(docs_of(texts)).collect()}
    assert got == {i: ss.brute_force(t) for i, t in enumerate(texts)}
    assert sum(map(len, got.values())) > 12


def test_repeated_null_ids_and_empty(spark):
    rows = [(1, TEXTS[0], 3), (1, TEXTS[0], 3), (1, "clean", 3), (None, TEXTS[1], 3), (None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rules int")
    got = sorted((r.doc_id or 0, r.text or "", len(r.secrets), r.rules) for r in ss.scan(docs).collect())
    assert got == sorted((a or 0, b or "", len(ss.brute_force(b)), c) for a, b, c in rows)
    assert ss.scan(docs.limit(0)).collect() == []


def test_query_equals_sql(spark):
    small_dir = "/root/testdata/sf0.01"
    sql = ss.oracle().replace("FROM documents", f"FROM read_parquet('{small_dir}/documents.parquet')")
    con = duckdb.connect()
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    df = ss.op9_secret_scan(spark, small_dir)
    assert sorted(df.columns) == sorted(names)
    want = sorted(want.fetchall())
    assert sorted(tuple(r) for r in df.select(*names).collect()) == want
    assert any(r[names.index("n_assign")] for r in want)
    assert all(r[names.index("base_sha256")] != hashlib.sha256(b"").hexdigest() for r in want if r[names.index("n_hex")])


def test_redact(spark, docs_of):
    out = {r.doc_id: r for r in ss.redact(docs_of(TEXTS[:2] + [None, "clean"]).withColumn("n_chars", F.lit(5))).collect()}
    assert KEY not in out[0].text and "[access]" in out[0].text and out[0].n_chars == len(out[0].text)
    assert out[1].text.startswith("[assign]") and "abc123" not in out[1].text
    assert out[2].text is None and out[3].text == "clean" and out[3].n_chars == 5


def test_redact_leaves_nothing_of_a_private_key(spark, docs_of):
    lines = [hashlib.sha512(bytes([i])).hexdigest().upper()[:64].replace("0", "+") for i in range(25)] + ["Qk9EWQ=="]
    body, label = "\n".join(lines), "RSA PRIVATE KEY-----"
    begin, end = f"-----BEGIN {label}", f"-----END {label}"
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-256-CBC," + "0A" * 16 + "\n\n"
    keys = [
        f"{begin}\n{body}\n{end}", f"{begin}\r\n{head}{body}\r\n{end}", f"{begin}{body}{end}",
        f"{begin}\n{body}", f"{begin}\n{head}{body}", f"{begin}\n{body}\n-----END RSA PRIV",
        begin + "\\n" + "\\n".join(lines) + "\\n" + end, begin + "\\r\\n" + "\\r\\n".join(lines),
        f"-{begin}\n-" + "\n-".join(lines) + f"\n-{end}", f"> {begin}\n> " + "\n> ".join(lines),
        f"-{begin}\n-" + "\n-".join(lines), f"{begin}\n" + "\n".join(lines * 400) + f"\n{end}", f"{begin}\n" + "\n".join(lines * 400),
        f"{begin}\n{body}\n\n{begin}\n{body}\n{end}", f'"{begin}\\n" +\n"' + '\\n" +\n"'.join(lines) + '"',
    ]
    texts = [f"é🙂 before. {k}\n(after - all)" for k in keys]
    out = {r.doc_id: r.text for r in ss.redact(docs_of(texts)).collect()}
    for i, text in out.items():
        assert not any(x in text for x in lines) and "BEGIN" not in text, text
        assert text.startswith("é🙂 before. ") and text.endswith("(after - all)") and "[pem]" in text
    assert {r.doc_id: [tuple(s) for s in r.secrets] for r in ss.scan(docs_of(texts)).collect()} == {
        i: ss.brute_force(t) for i, t in enumerate(texts)}


def test_a_private_key_header_alone_takes_no_prose(spark, docs_of):
    rule = next(r for r in ss.RULES if r.kind == "pem")
    begin = "-----BEGIN PRIVATE KEY-----"
    assert ss.trigram_query(rule.pattern) == ss.trigram_query(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
    texts = [f"The line {begin} marks the start, and " + "a - b " * 5000, f"{begin} -----BEGIN CERTIFICATE-----\nQUJD",
             f"{begin}\n-----END CERTIFICATE----- -----END PRIVATE KEY-----"]
    out = {r.doc_id: r.text for r in ss.redact(docs_of(texts)).collect()}
    assert out == {i: t.replace(begin, "[pem]") for i, t in enumerate(texts)}
    con = duckdb.connect()
    for t in [*texts, f"{begin}\n{'QUJD' * 16}\nQUI=\n-----END PRIVATE KEY----- x", f"{begin}\n{'QUJD' * 16}\nQUI= (x"]:
        found = con.execute("SELECT regexp_extract_all(?, ?)", [t, rule.pattern]).fetchone()[0]
        assert [(len(x),) for x in found] == [(e - s,) for s, _, e, k in ss.brute_force(t) if k == "pem"]
