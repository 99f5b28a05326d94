import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts, **more):
        rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return make


#: Texts that every operator on documents has to take: null, empty, white space, odd code points, repeats, long ones.
ODD_TEXTS = [None, "", "   \n\t ", "a", "One two  three\tfour\x0bfive.", "ÉCOLE Ünder-Straße it's 'sauf don't", "été été, ﬁ １２  x　y",
             "<|endoftext|> abc<|endoftext|>, <|ENDOFTEXT|> abc|>", "漢字 かな 🙂🙂 x🙂!", "x" * 5000, "word " * 3000, "a", "a", "--- ... !!! abc!!! abc**", "ΣΑΣ İstanbul Ǆ ǆ ß ÿ Ÿ",
             "tail', tail's, 's, ''s abc's. 12,3 a1! ́x ≮ a̸."]
