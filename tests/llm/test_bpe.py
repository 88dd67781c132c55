import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from evalyard.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
OURS = bpe.ByteBpe(open(PATH, encoding="utf-8").read())
REF = Tokenizer.from_file(PATH)
REF.no_truncation()
REF.no_padding()
ODD = ["", " ", "  a", "a  b\n c", "it's  we'LL 've", "x<|endoftext|> y<|endoftext|>", " a   b", "a\x1cb \x85 c", "é́ ñ漢字 123,456", "a" * 700 + "ab" * 300, "퟿\U0001f600 ok", "\t\n\x0b\x0c\r x", " \n a", "a \n", "²³ ¼", "​ 　"]


def ids(text):
    return np.frombuffer(OURS.encode(text), np.int32).tolist()


def check(text):
    want = REF.encode(text, add_special_tokens=False).ids
    assert ids(text) == want
    assert OURS.decode(np.array(want, np.int32)) == REF.decode(want, skip_special_tokens=False)


def test_odd_texts():
    for t in ODD:
        check(t)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab 'stréE1²\n\t  ,.<|>漢\x1c\x85"), max_size=40))
def test_any_text(text):
    check(text)


def test_long_word_is_the_same_as_short():
    w = ("the" * 80 + "ing" * 20).encode()
    assert OURS._long([OURS.byte_id[b] for b in w]) == _slow(w)


def _slow(w):
    keep, bpe.SHORT = bpe.SHORT, 1 << 30
    try:
        return OURS.word(w)
    finally:
        bpe.SHORT = keep


def test_query_against_library(spark, tmp_path):
    rows = [(i, t, 9) for i, t in enumerate(ODD)] + [(None, "null id", 1), (3, None, 1), (3, "dup", 1), (3, "dup", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op10_bpe"](spark, str(tmp_path)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, _ in rows:
        x = REF.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(x), sha(",".join(map(str, x))), sha(REF.decode(x, skip_special_tokens=False))))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def test_round_trip_and_empty(spark):
    df = spark.createDataFrame([(1, "a b  c"), (2, None)], "doc_id bigint, text string")
    back = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted(map(tuple, back)) == [(1, "a b  c"), (2, "")]
    assert bpe.encode(df.limit(0), PATH).count() == 0
