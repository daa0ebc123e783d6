"""Rebuilt models against ``sentencepiece`` on whole texts; unigram models are put together by hand."""

import math
import os
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from glyphvec.llm import sentencepieces

P = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
SF = "/root/testdata/sf0.001"
BPE = P.path("piece_bpe_32k.model")
MARK = sentencepieces.MARK


def _number(value):
    out = b""
    while True:
        value, low = value >> 7, value & 0x7F
        out += bytes([low | (0x80 if value else 0)])
        if not value:
            return out


def _field(number, value):
    if isinstance(value, int):
        return _number(number << 3) + _number(value)
    if isinstance(value, float):
        return _number(number << 3 | 5) + struct.pack("<f", value)
    return _number(number << 3 | 2) + _number(len(value)) + value


def _model(path, pieces, byte_fallback=False, trainer=b"", normaliser=b""):
    """A unigram model file with the given (piece, score) rows."""
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] if byte_fallback else []
    rows += [(p, s, 1) for p, s in pieces]
    data = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, k)) for p, s, k in rows)
    data += _field(2, _field(3, 1) + (_field(35, 1) if byte_fallback else b"") + trainer)
    data += _field(3, _field(1, b"identity") + normaliser)
    path.write_bytes(data)
    return str(path)


def _texts():
    import pyarrow.parquet as pq

    given = pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist() if os.path.isdir(SF) else []
    return [t or "" for t in given] + ["", " ", "a", "  two  spaces ", "日本語 text", "é🙂\0", "x" * 3000, "a$$$", "<s> <unk>"]


def _pieces(texts):
    """Letters and frequent beginnings and syllables, scored by how often they occur."""
    counts = Counter()
    for text in texts[:60]:
        for word in text.split():
            word = MARK + word
            for size in range(1, 6):
                counts.update(word[i : i + size] for i in range(len(word) - size + 1))
    kept = {p: n for p, n in counts.items() if len(p) == 1 or (n >= 8 and MARK not in p[1:])}
    total = sum(kept.values())
    return [(p, math.log(n / total)) for p, n in sorted(kept.items())]


@pytest.fixture(scope="module", params=[False, True])
def unigram(request, tmp_path_factory):
    path = tmp_path_factory.mktemp("unigram") / "model.model"
    return _model(path, _pieces(_texts()), byte_fallback=request.param)


def _compare(path):
    texts = _texts()
    own, reference = sentencepieces.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    flat, counts, agree = own.encode(texts)
    ids = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    expected = reference.encode(texts)
    assert agree == [a == b for a, b in zip(ids, expected)]
    assert own.decode(expected) == reference.decode(expected)
    return sum(agree) / len(texts)


def test_unigram_whole_texts(unigram):
    assert _compare(unigram) >= 0.97


def test_bpe_whole_texts():
    assert _compare(BPE) == 1.0


def test_ties_are_told(tmp_path):
    """Splits of equal score may differ from the original's; parity says so for the whole text."""
    path = _model(tmp_path / "ties.model", [(MARK, -1.0), ("a", -3.0), ("$", -2.0), ("$$", -4.0), (MARK + "a", -3.0)])
    own, reference = sentencepieces.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["a" + "$" * n for n in range(8)] + ["a$$$ a$$$", "$$$a$$$"]
    flat, counts, agree = own.encode(texts)
    ids = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert agree == [a == b for a, b in zip(ids, reference.encode(texts))]
    assert own.decode(ids) == texts


def test_wrong_normaliser_is_seen(monkeypatch):
    own = sentencepieces.Codec(BPE)
    monkeypatch.setattr(own, "_marked", lambda text: MARK + text.replace(" ", ""))
    assert own.encode(["one two", "one"])[2] == [False, True]


@pytest.mark.parametrize(
    "trainer, normaliser, message",
    [(_field(24, 1), b"", "suffixes"), (b"", _field(5, 0), "spaces"), (_field(3, 3), b"", "neither")],
)
def test_unsupported_models_are_refused(tmp_path, trainer, normaliser, message):
    path = _model(tmp_path / "odd.model", [(MARK, -1.0), ("a", -1.0)], trainer=trainer, normaliser=normaliser)
    with pytest.raises(ValueError, match=message):
        sentencepieces.Codec(path)


def test_cache_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(sentencepieces, "REMEMBERED_BYTES", 10_000)
    own = sentencepieces.Codec(BPE, verify=False)
    first = [own.encode([f"word{i} other{i} {'long' * 40}{i}"])[0].tolist() for i in range(500)]
    assert len(own.cache) < 100 and max(map(len, own.cache)) <= sentencepieces.LONGEST
    assert [own.encode([f"word{i} other{i} {'long' * 40}{i}"])[0].tolist() for i in range(500)] == first


def test_decoding_needs_no_verifier():
    assert sentencepieces.codec(BPE, verify=False).reference is None


def test_columns_of_clashing_names_stay(spark):
    df = spark.createDataFrame([(1, "a b", 7, "k")], "doc_id BIGINT, text STRING, encoded INT, decoded STRING")
    row = sentencepieces.decode(sentencepieces.encode(df, BPE), BPE, into="back").collect()[0]
    assert (row.encoded, row.decoded, row.back) == (7, "k", "a b")


def test_verified(spark):
    rows = [(1, "a b"), (2, None), (3, ""), (None, "é🙂"), (1, "a b"), (4, "word " * 5000)]
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id BIGINT, text STRING, ids STRING, parity BOOLEAN")
    reference = sentencepiece.SentencePieceProcessor(model_file=BPE)

    def row(doc_id, text):
        ids = reference.encode(text or "")
        crc = None if text is None else zlib.crc32(struct.pack(f"<{len(ids)}i", *ids))
        return (doc_id, len(ids), crc, True, True)

    found = sentencepieces.verified(df.repartition(3), BPE)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([row(*r) for r in rows], key=str)
    assert found.columns == ["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip"]
    assert sentencepieces.verified(df.limit(0), BPE).count() == 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_frequent_parts_are_encoded_once(monkeypatch):
    monkeypatch.setattr(sentencepieces, "REMEMBERED_BYTES", 10_000)
    own, encoded = sentencepieces.Codec(BPE, verify=False), []
    encode = own.tokenizer.encode_batch_fast

    class Counting:
        def encode_batch_fast(self, parts, **options):
            encoded.extend(parts)
            return encode(parts, **options)

    own.tokenizer = Counting()
    for i in range(40):
        own.encode([f"often seen words {i} and {' '.join(f'w{i}x{j}' for j in range(20))}"])
    assert encoded.count(f"{MARK}often") == 1 and len(own.cache) < 100


def test_repeated_parts_are_looked_up_once():
    """Work beside the tokenizer grows with the distinct parts of a portion, not with all of its words."""

    class Counting(dict):
        lookups = 0

        def get(self, part, other=None):
            self.lookups += 1
            return super().get(part, other)

        def __contains__(self, part):
            self.lookups += 1
            return super().__contains__(part)

        def __getitem__(self, part):
            self.lookups += 1
            return super().__getitem__(part)

    own, texts = sentencepieces.Codec(BPE), ["often seen words " * 1000, "", "words  often seen", "seen▁often "]
    own.cache = Counting()
    flat, counts, agree = own.encode(texts)
    expected = sentencepiece.SentencePieceProcessor(model_file=BPE).encode(texts)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == expected and all(agree)
    assert own.cache.lookups <= 20


def test_parts_that_pause_are_remembered(monkeypatch):
    monkeypatch.setattr(sentencepieces, "REMEMBERED_BYTES", 20_000)
    own, encoded = sentencepieces.Codec(BPE, verify=False), []
    encode = own.tokenizer.encode_batch_fast

    class Counting:
        def encode_batch_fast(self, parts, **options):
            encoded.extend(parts)
            return encode(parts, **options)

    own.tokenizer = Counting()
    for i in range(60):
        word = "often" if i % 2 else "seldom"
        own.encode([f"{word} {' '.join(f'w{i}x{j}' for j in range(20 + i % 3))}"])
    assert encoded.count(f"{MARK}often") == encoded.count(f"{MARK}seldom") == 1
    assert len(own.cache) + len(own.older) < 200


def test_portions_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(sentencepieces, "PORTION_BYTES", 10)
    texts = pa.array(["é" * 3, "abcd", None, "x" * 30, "", "y"])
    assert [p.to_pylist() for p in sentencepieces._portions(texts, texts)] == [["ééé", "abcd", None], ["x" * 30], ["", "y"]]
