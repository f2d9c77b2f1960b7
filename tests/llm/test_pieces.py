"""Encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from rivulet.llm import pieces


@pytest.fixture(scope="module")
def model():
    return pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@pytest.fixture(scope="module")
def own(model):
    return pieces.Pieces(model)


def texts(own):
    rng = random.Random(5)
    signs = "aabbceehtr nost \n\t ▁0123.,ée中文字漢ßÄ🙂\x00日本語Привет  "
    known = sorted(own._ids)
    for _ in range(3000):
        yield "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        yield "".join(rng.choice(known) for _ in range(rng.randint(0, 12)))
        yield "".join(rng.choice(known) for _ in range(rng.randint(0, 12))).replace("▁", "")


def test_encodes_and_decodes_like_the_library(own, library):
    for text in texts(own):
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert own.encode(text).tolist() == ids, text
        assert own.decode(np.array(ids)).decode() == library.decode(ids), text
        assert own.encode(text, bos=False, eos=False).tolist() == ids[1:-1]


@pytest.mark.parametrize("text", ["a" * 40_000, "ab" * 30_000, "中" * 9000, "word " * 300_000, " " * 70_001, "\n" * 9000, "<s></s><0x41><unk>"])
def test_long_and_odd_texts(own, library, text):
    assert own.encode(text).tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_decodes_any_ids(own, library):
    rng = random.Random(6)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 28705, 259, 1, 2, 0]) for _ in range(rng.randint(0, 8))]
        assert own.decode(np.array(ids, dtype=np.int64)).decode() == library.decode(ids), ids


def test_neighbours_agree_as_by_merging(own, library):
    """The check of two pieces says what the library says of their texts."""
    rng = random.Random(7)
    known = sorted(i for i in own._ids.values() if "▁" not in library.id_to_piece(i))
    for _ in range(20000):
        a, b = rng.choice(known), rng.choice(known)
        # The blank in front is one more piece unless something merges with it.
        whole = own._search(library.id_to_piece(a) + library.id_to_piece(b))
        assert own._agree((a, b)) == (whole == [a, b])


def test_steps_back_and_forgets(own, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    monkeypatch.setattr(pieces, "WINDOW", 7)
    monkeypatch.setattr(pieces, "PART", 11)
    small = pieces.Pieces(pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model")))
    for text in list(texts(own))[:600]:
        assert small.encode(text).tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_other_models_are_refused(model):
    proto = pieces.format.ModelProto.FromString(model)
    proto.trainer_spec.model_type = pieces.format.TrainerSpec.UNIGRAM
    with pytest.raises(ValueError):
        pieces.Pieces(proto.SerializeToString())


def test_tables(spark, odd_docs, odd_rows, no_docs, model, library):
    rows = sorted((tuple(r) for r in pieces.round_trip(odd_docs, model).collect()), key=str)
    told = []
    for doc_id, text in odd_rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        told.append((doc_id, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert rows == sorted(told, key=str)
    ids = pieces.encoded(odd_docs, model)
    back = sorted(((r.doc_id, r.text) for r in pieces.decoded(ids, model).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t in odd_rows), key=str)
    assert pieces.round_trip(no_docs, model).count() == 0 and pieces.encoded(no_docs, model).count() == 0


def test_query_on_whole_table(spark, sf_dir, library):
    from rivulet.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op12_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
