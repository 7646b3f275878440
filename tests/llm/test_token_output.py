import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagweave.llm import token_output as T
from tests_llm_rows import SCHEMA, doc_rows, docs, no_docs  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=300), st.integers(1, 40))
def test_payload_round_trip(ids, copies):
    ids = np.array(ids * copies, np.uint32)
    payload = T.pack(ids)
    assert (T.unpack(payload) == ids).all()
    a, b = len(ids) // 3, len(ids) // 2
    assert (T.unpack(payload, a, b) == ids[a:b]).all()


def test_outliers_go_to_exceptions():
    ids = np.array([7] * 4000 + [2**31] * 96, np.uint32)
    assert len(T.pack(ids)) < 1000


def test_files_hold_every_document(spark, docs, tmp_path):
    T.write_token_files(docs, str(tmp_path / "t"), PATH, 2, segment_ids=500)
    full = T.read_token_files(spark, str(tmp_path / "t")).collect()
    digest = T.read_token_files(spark, str(tmp_path / "t"), digest=True).collect()
    coder = Tokenizer.from_file(PATH)
    want = {}
    for r in doc_rows():
        ids = coder.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.setdefault(r[0], []).append(ids)
    assert len(full) == len(digest) == len(doc_rows())
    for r in full:
        assert r["ids"] in want[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
    at, order = 0, sorted(full, key=lambda r: r["start"])
    for r in order:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in order]
    assert ids[-1] is None and ids[:-1] == sorted(ids[:-1])
    crc = {r["start"]: zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in full}
    assert all(crc[r["start"]] == r["ids_crc32"] for r in digest)


@pytest.mark.parametrize("text", ["it's don't <|endoftext|> a<|startoftext|>b", "ΑΣ ας́ é x y  z", "100% of\tit\x0b, '' 'S"])
def test_words_alone_encode_as_whole_texts(text):
    import pyarrow as pa
    ids, sizes = T.encoder(PATH)(pa.array([text, None, text]))
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want * 2 and sizes.tolist() == [len(want), 0, len(want)]


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not T.drops_space(path) and T.drops_space(PATH)
    import pyarrow as pa
    ids, _ = T.encoder(path)(pa.array(["two  words"]))
    assert ids.tolist() == Tokenizer.from_file(path).encode("two  words", add_special_tokens=False).ids


def test_empty(spark, no_docs, tmp_path):
    T.write_token_files(no_docs, str(tmp_path / "t"), PATH, 2)
    assert T.read_token_files(spark, str(tmp_path / "t"), digest=True).collect() == []
    assert SCHEMA
