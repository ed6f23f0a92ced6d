import zlib

import numpy as np
import public_tokenizers as P
from claimlens.llm import dac, tokens
from hypothesis import given, settings
from hypothesis import strategies as st

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r'<|>_.!2²éÉß×ªº¡\x0b\x0c\x1c\x85\xa0aAbtsd"), st.characters(codec="utf-8")), max_size=60)
_counter = tokens.Counter(BYTE, tokens.prove_whole_tokens(BYTE))
_encoder = dac.Encoder(WORD)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_counts_are_the_librarys(text):
    assert _counter.count(text) == len(tokens.load(BYTE).encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_ids_are_the_librarys(text):
    assert np.frombuffer(_encoder.ids(text), "<u4").tolist() == tokens.load(WORD).encode(text, add_special_tokens=False).ids


def test_proof_covers_single_tokens_only():
    tok = tokens.load(BYTE)
    proven = tokens.prove_whole_tokens(BYTE)
    assert len(proven) > 40_000
    assert all(len(tok.encode(s, add_special_tokens=False).ids) == 1 for s in proven[::997])


def test_memo_generations(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 5)
    memo, made = tokens.Memo(lambda k: made.append(k) or len(k), {"a": 1}), []
    for k in ["bb", "cc", "dd", "ee", "ff", "gg"]:
        assert memo[k] == 2
    memo.trim()
    assert dict(memo) == {"a": 1} and memo["bb"] == 2 and made.count("bb") == 1
    assert memo["x" * 100] == 100 and "x" * 100 not in memo


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500), st.data())
def test_codes_round_trip(values, data):
    ids = np.array(values, np.uint32)
    file = dac.Reader(dac.encode(ids, np.array([5, dac.NULL_ID]), np.array([0, len(ids) // 2, len(ids)])))
    assert len(file) == len(ids) and file.slice(0, len(ids)).tolist() == values
    if values:
        i = data.draw(st.integers(0, len(ids) - 1))
        j = data.draw(st.integers(i, len(ids)))
        assert file.get(i) == values[i] and file.slice(i, j).tolist() == values[i:j]


def expected(rows, end=1):
    tok, out = tokens.load(WORD), []
    for doc_id, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    return sorted(out, key=key)


def checked(rows):
    """Rows without their starts, once these are the sums of all ids before them in doc_id order."""
    rows = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    order = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert order == sorted(order)
    return sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=key)


def key(r):
    return (r[0] is not None, r[0] or 0, r[1], r[2])


def test_files_of_odd_rows(spark, odd_docs, no_docs, tmp_path):
    path = str(tmp_path / "ids")
    dac.write(odd_docs, path, WORD, file_tokens=50)
    assert checked(dac.read(spark, path).collect()) == expected([(r.doc_id, r.text) for r in odd_docs.collect()])
    dac.write(no_docs, str(tmp_path / "none"), WORD)
    assert dac.read(spark, str(tmp_path / "none")).count() == 0


def test_queries_equal_the_library(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert checked(dac.op4_token_id_output(spark, sf).collect()) == expected(docs)
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.op7_token_counts(spark, sf).collect()}
    for i, t in docs:
        n = len(tokens.load(BYTE).encode(t or "", add_special_tokens=False).ids)
        assert counts[i] == (len((t or "").encode()), n, n > 1024)


def test_counts_of_odd_rows(odd_docs, no_docs):
    rows = tokens.token_counts(odd_docs, BYTE).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(tokens.load(BYTE).encode(r.text or "", add_special_tokens=False).ids) for r in odd_docs.collect())
    assert {r.n_bytes for r in rows if r.doc_id in (3, 4)} == {0}
    assert tokens.token_counts(no_docs, BYTE).count() == 0


def test_every_plain_letter_gets_the_librarys_ids():
    tok = tokens.load(WORD)
    for text in ["Ɓarawo ya shiga gida", *(f"a{chr(c)}b {chr(c)}a" for c in range(0x20, 0x250))]:
        assert np.frombuffer(_encoder.ids(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 40)
    monkeypatch.setattr(dac, "PIECE", 40)
    byte, word = tokens.load(BYTE), tokens.load(WORD)
    for odd in ("Ⱥbc Ⱦx", "中文。汉字！かな", "<|endoftext|>", "a᠎ b", "é́  \n\n 's", "\x1c x", "   y", ""):
        text = "It's a plain line, with 12 words.\n\n  And  more " * 5 + odd + " and 3 tails\t\n end." * 7 + odd
        assert list(tokens.pieces("ab cd", 3)) == ["ab cd"] and "".join(tokens.pieces(text)) == text
        assert _counter.count(text) == len(byte.encode(text, add_special_tokens=False).ids), odd
        assert np.frombuffer(_encoder.ids(text), "<u4").tolist() == word.encode(text, add_special_tokens=False).ids, odd


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\n  '.,。！字か᠎​́sa1"), st.characters(codec="utf-8")), min_size=30, max_size=120))
def test_pieces_keep_pre_tokens(text):
    for tok in (tokens.load(BYTE), tokens.load(WORD)):
        parts = [i for p in tokens.pieces(text, 5) for i in tok.encode(p, add_special_tokens=False).ids]
        assert parts == tok.encode(text, add_special_tokens=False).ids


def test_ids_beside_null_stay_longs(spark, tmp_path):
    big = 2**53 + 1
    docs = spark.createDataFrame([(big, "one"), (None, "two"), (big + 1, None)], "doc_id long, text string").coalesce(1)
    dac.write(docs, str(tmp_path / "ids"), WORD)
    assert {r.doc_id for r in dac.read(spark, str(tmp_path / "ids")).collect()} == {big, big + 1, None}
