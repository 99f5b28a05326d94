import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp
from rivalry.llm import decontaminate as dc
from rivalry.llm import secret_scan as ss
from rivalry.llm.store import staged
from tests.llm.conftest import ODD_TEXTS
from tests.llm.test_jaccard_tree import brute_force


def redacted(text):
    out, at = "", 0
    for start, _, end, kind in ss.brute_force(text):
        if start >= at:
            out += text[at:start] + f"[{kind}]"
        at = max(at, end)
    return out + text[at:]


def expected(docs, bench):
    """Rows by id after each stage, by brute force."""
    docs = {d: t for d, t in docs.items() if any(c.isalpha() for c in t or "")}
    ids = sorted(docs)
    _, roots = brute_force([docs[d] for d in ids], cp.SHINGLE, cp.NUM, cp.DEN)
    docs = {d: docs[d] for i, d in enumerate(ids) if roots[i] == i}
    items = [p for p in map(dc.normalise, bench) if p]

    def holds(text, p):
        k = int(dc.EDIT_RATE * len(p))
        return dc.myers(p, dc.normalise(text), k)[0] <= k
    docs = {d: t for d, t in docs.items() if not any(holds(t, p) for p in items)}
    return {d: redacted(t) for d, t in docs.items()}


def test_whole_table_equals_brute_force(spark, small_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    bench = [r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    want = expected(docs, bench)
    assert len(want) < len(docs)
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(cp.TOKENIZER))
    got = {r.doc_id: (r.n_tokens, r.ids) for r in cp.run(spark, small_dir).collect()}
    assert got == {d: (len(ids), ids) for d, t in want.items() for ids in [lib.encode(t)]}


def test_stages_take_odd_rows_and_keep_columns(spark, small_dir):
    rows = [(i, t, "en", "s", len(t or ""), 1, 2.0) for i, t in enumerate(ODD_TEXTS)]
    rows += [(4, ODD_TEXTS[4], "en", "s", 1, 1, 2.0), (None, "null id here", None, None, None, None, None),
             (None, "null id here", None, None, None, None, None), (90, "password = hunter2222", "en", "s", 3, 1, 1.0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key int, score double"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in cp.STAGES[:-1]:
        out = staged(stage(spark, docs, small_dir), "odd")
        assert out.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), small_dir).count() == 0
        docs = out
    texts = [r.text for r in docs.collect()]
    assert "[assign]" in texts and texts.count("null id here") == 1 and texts.count(ODD_TEXTS[4]) == 1
    assert all(any(c.isalpha() for c in t) for t in texts)
    assert cp.tokens(spark, docs, small_dir).filter(F.size("ids") != F.col("n_tokens")).count() == 0


def test_stages_keep_the_values_of_clashing_columns(spark, small_dir):
    """Columns with names that the operators use themselves come out as they went in."""
    names = ["lang_pred", "score", "secrets", "_own", "_doc", "_key", "_rules", "key", "root", "n", "h", "seg", "ids", "rules", "first"]
    rows = [(i, t, "en", "s", len(t or "")) + tuple(f"{n} {i}" for n in names) for i, t in enumerate(ODD_TEXTS)]
    rows += [(i, "the same words in two rows, twice", "en", "s", 33) + tuple(f"{n} {i}" for n in names) for i in (95, 96)]
    rows += [(97, "password = hunter2222 and more", "en", "s", 30) + tuple(f"{n} 97" for n in names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{n}` string" for n in names))
    for name, stage in cp.STAGES[:-1]:
        docs = staged(stage(spark, docs, small_dir), "clash")
        got = docs.collect()
        assert len(got) > 5, name
        assert all(r[n] == f"{n} {r.doc_id}" for r in got for n in names), name
    assert {95, 97} <= {r.doc_id for r in got} and 96 not in {r.doc_id for r in got}
    assert [r.text for r in got if r.doc_id == 97] == ["[assign] and more"]
    assert cp.tokens(spark, docs, small_dir).count() == len(got)


def test_unlabelled_texts_with_letters_pass(spark, small_dir):
    rows = [(i, t, None, "s", len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r.doc_id for r in cp.identify(spark, docs, small_dir).collect())
    assert kept == [i for i, t in enumerate(ODD_TEXTS) if any(c.isalpha() for c in t or "")]


def test_stages_and_registration():
    import __spark_entry__ as entry
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontaminate", "secrets", "tokens"]
    names = entry.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
