import hashlib
import random
import struct

import pytest
import sentencepiece

from spanloom.llm import catalog, common, pieces

ODD = [
    "", " ", "  a  b ", "a\tb\nc", "\x00a", "<s>hi</s>", "<0x41> <unk>", "▁x▁▁y", "日本語の文 ﬁ",
    "e\u0301\ufeff\u200b", "🙂🙃 mixed🙂", " " * 70 + "x" + " " * 33, "a" * 3000, "\r\n\r\n",
    "trailing ", "ÀÉÎ õü ß", "x\u2581", "\u2047 ⁇",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=catalog.vocabulary_path())


def test_encoding_and_decoding_match_the_library(library):
    encoder = pieces.Encoder(catalog.vocabulary_path(), memory=50)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab ▁é\n.,ö漢🙂<|") for _ in range(rng.randrange(60))) for _ in range(500)]
    encoded = encoder.encode_batch(texts)
    encoder.check_texts(texts, encoded)
    for text, ids in zip(texts, encoded, strict=True):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_rows_of_words_are_encoded_like_single_words():
    vocabulary = pieces.Vocabulary(catalog.vocabulary_path())
    rng = random.Random(9)
    words = ["▁" + "".join(rng.choice("abeinrst▁é\n.,漢🙂") for _ in range(rng.randrange(70))) for _ in range(3000)]
    words += ["▁" * n for n in range(1, 60)]
    for word, ids in zip(words, vocabulary.encode_words(words), strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == vocabulary.encode_word(word)


def _expected(library, i, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    raw = b"".join(struct.pack("<I", x) for x in ids)
    decoded = library.decode(ids)
    return (i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_query_is_the_library(spark, sf_dir, library):
    rows = common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    found = [tuple(r) for r in catalog.queries()["op5_pieces"](spark, sf_dir).collect()]
    assert sorted(found) == sorted(_expected(library, r.doc_id, r.text) for r in rows)


def test_edge_rows(make_docs, clashing, library):
    docs = make_docs((1, None), (2, ""), (2, ""), (None, "x"), *((10 + i, t) for i, t in enumerate(ODD)))
    found = [tuple(r) for r in pieces.encode_decode(clashing(docs), catalog.vocabulary_path(), check_texts=True).collect()]
    expected = [_expected(library, r.doc_id, r.text) for r in docs.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert pieces.encode_decode(docs.limit(0), catalog.vocabulary_path()).count() == 0


def test_ids_and_texts_go_round(make_docs):
    docs = make_docs((1, "plain text here"), (2, "tabs\tand\nlines"))
    for r in pieces.encode_decode(docs, catalog.vocabulary_path(), with_ids=True).collect():
        assert r.decoded == ("plain text here" if r.doc_id == 1 else "tabs\tand\nlines")
        assert len(r.ids) == r.n_tokens
