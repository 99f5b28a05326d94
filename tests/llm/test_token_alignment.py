import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from rivalry.llm import token_alignment as ta
from tests.llm.conftest import ODD_TEXTS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLS = ["doc_id", *ta.COUNTS, "groups_sha256"]


def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    chars = ta.byte_level()
    token = {i: t for t, i in a.get_vocab().items()}

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return (lambda text: [(i, bytes(chars[c] for c in token[i])) for i in a.encode(" " + text, add_special_tokens=False).ids],
            lambda text: [(i, of_b(i)) for i in b.encode(text)])


def brute_force(docs):
    """Whole texts encoded by the libraries; offsets, groups and counts token by token."""
    both, found, held = encoders(), [], Counter()
    for doc, text in docs:
        sides = [one(text) if text else [] for one in both]
        if not text or any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
            found.append((doc, None))
            continue
        at = []
        for side in sides:
            end, own = 0, []
            for i, x in side:
                end += len(x)
                own.append((end, i))
            at.append(own)
        cuts = sorted({e for e, _ in at[0]} & {e for e, _ in at[1]})
        groups, low = [], 0
        where = [defaultdict(list), defaultdict(list)]
        for k in (0, 1):
            g = 0
            for end, i in at[k]:
                while end > cuts[g]:
                    g += 1
                where[k][g].append(i)
        groups = [(where[0][g], where[1][g]) for g in range(len(cuts))]
        links = Counter((a, b) for x, y in groups for a in x for b in y)
        held.update(links.keys())
        found.append((doc, (len(at[0]), len(at[1]), groups, links)))
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for doc, x in found:
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = x
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc, n_a, n_b, len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    assert set(df.columns) == set(COLS)
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=str)


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert got(ta.op12_token_alignment(spark, d)) == brute_force(docs)


SPECIAL = ["<s> </s> <unk> <|endoftext|>", "a▁b", "▁", " lead and trail ", "two  spaces   three", "\n new\nline \n", "1,5 x 2", "\x00 z",
           "nb sp 　 wide　", "x " * 40, "don't we'll 's 'S", "ﬀ ﬁ Ａ é é", "0 " * 300 + "▁", "🙂" * 90, "aaa" * 120]


def frame(spark, docs, parts=3):
    rows = [(i, t, "x", i, None) for i, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, unit string, k long, long_key string").repartition(parts)


def test_odd_texts(spark):
    docs = [*enumerate(ODD_TEXTS + SPECIAL), (None, "no id"), (3, "one id twice"), (3, "one id twice")]
    assert got(ta.align(frame(spark, docs), A, B)) == brute_force(docs)
    assert ta.align(frame(spark, docs).limit(0), A, B).collect() == []


@pytest.mark.parametrize("fan", [2, 8])
def test_long_texts_by_ranges(spark, monkeypatch, fan):
    """Texts of many ranges whose borders fall into tokens, groups and characters, with and without spaces to cut at."""
    for name, value in (("LONG", 150), ("RANGE", 37), ("FAN", fan), ("PLAIN", 3)):
        monkeypatch.setattr(ta, name, value)
    rng = random.Random(4)
    words = ["the", "Straße", "漢字かな", "🙂🙂", "x" * 50, "1234567", "a b", "étude", "--", "\n\n", "", "it's", "qzxv" * 9, "ÿþ"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice((30, 60, 200))))) for i in range(25)]
    docs += [(100 + i, "".join(rng.choices("abcé漢🙂 .=-qZ", k=700))) for i in range(6)]
    docs += [(200, "q" * 900), (201, "".join(rng.choices("abcdefghij0123456789+/", k=2000))), (201, docs[0][1]), (None, docs[1][1]),
             (202, "漢" * 500), (203, "word " * 100 + "a▁b" + " word" * 100), (204, "short"), *enumerate(ODD_TEXTS, 300)]
    assert got(ta.align(frame(spark, docs), A, B)) == brute_force(docs)


def test_composition_is_associative():
    rng = random.Random(1)

    def one(k):
        cut = k if rng.random() < 0.6 else None
        return ta.Fragment(cut, [bytes([65 + k]), bytes([97 + k])], [b"", b""] if cut is None else [b"+%d" % k, b"-%d" % k])

    def fold(parts):
        """(fragment, closed groups) by a random tree."""
        if len(parts) == 1:
            return parts[0], []
        m = rng.randrange(1, len(parts))
        (x, left), (y, right) = fold(parts[:m]), fold(parts[m:])
        z, group = x.then(y)
        return z, left + ([group] if group else []) + right

    for _ in range(30):
        parts = [one(k) for k in range(9)]
        trees = [fold(parts) for _ in range(6)]
        assert len({str((vars(z), sorted(groups))) for z, groups in trees}) == 1


def test_models_that_do_not_fit_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, open(B, "rb") as m:
        with pytest.raises((ValueError, KeyError)):
            ta.Aligner(f.read(), m.read())
