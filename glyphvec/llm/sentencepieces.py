"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model file is parsed here and rebuilt: normaliser, word marker, pieces with their scores, byte
fallback. No piece of such a vocabulary holds a marker behind another character, so a text falls apart
before its markers. Arrow finds the distinct parts of a portion of texts; a task encodes each once per cache,
all new ones together, and one gather puts the ids of the texts together. To verify parity ``sentencepiece``
encodes whole raw texts, its own normaliser included.

Unigram and BPE models are rebuilt. Models with what the rebuild lacks are refused: user-defined pieces,
markers as suffixes, spaces left as they are.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphvec.llm.common import free_name, portions, slices, table

MARK = "▁"
#: Bytes of texts encoded at a time (a longer text stands alone), and texts decoded at a time.
PORTION_BYTES, PORTION = 2 << 20, 256
#: Bytes of parts that a worker remembers, what an entry takes besides its part, and the longest part worth it.
REMEMBERED_BYTES, ENTRY_BYTES, LONGEST = 64 << 20, 240, 64

#: Kinds of pieces and of models in the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Fixed value: what stands for an unknown piece in a decoded text, unless the model says otherwise.
UNKNOWN_TEXT = " \u2047 "

_loaded: dict[tuple[str, bool], Codec] = {}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class ModelFile:
    """What a model file says; the numbers in ``parse`` are those of its public format."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool
    unknown_text: str

    @classmethod
    def parse(cls, data: bytes) -> ModelFile:
        pieces, scores, kinds = [], [], []
        trainer: dict[int, int | bytes] = {}
        normaliser: dict[int, int | bytes] = {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        lacking = {
            "a model that is neither unigram nor BPE": trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE),
            "word markers as suffixes": trainer.get(24, 0),
            "spaces that are left as they are": not normaliser.get(5, 1),
            "user-defined pieces": USER in kinds,
        }
        if any(lacking.values()):
            raise ValueError(f"cannot be rebuilt: {', '.join(k for k, v in lacking.items() if v)}")
        return cls(
            pieces, scores, kinds, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)),
            normaliser.get(2, b""), bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)),
            trainer.get(44, UNKNOWN_TEXT.encode()).decode(),
        )


class Codec:
    """Encoder and decoder rebuilt from a model file."""

    def __init__(self, path: str, verify: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, decoders, normalizers

        with open(path, "rb") as file:
            self.file = ModelFile.parse(file.read())
        self.normaliser = normalizers.Precompiled(self.file.charsmap) if self.file.charsmap else None
        self.tokenizer = Tokenizer(self._model())
        strip = [decoders.Strip(" ", 1, 0)] if self.file.dummy_prefix else []
        self.tokenizer.decoder = decoders.Sequence(
            [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip]
        )
        #: Whether a piece holds a marker behind another character; texts stay whole then.
        self.inner = any(MARK in p.lstrip(MARK) for p, k in zip(self.file.pieces, self.file.kinds) if k == NORMAL)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cached = 0
        self.control = [i for i, k in enumerate(self.file.kinds) if k == CONTROL]
        self.bytes = pa.array(
            [self._bytes(p, k) for p, k in zip(self.file.pieces, self.file.kinds)], pa.large_binary()
        )
        self.reference = None
        if verify:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_file=path)

    def _bytes(self, piece: str, kind: int) -> bytes:
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return self.file.unknown_text.encode()
        return bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(MARK, " ").encode()

    def _model(self):
        from tokenizers import models

        file = self.file
        unknown = file.kinds.index(UNKNOWN)
        if file.model == UNIGRAM:
            # Control pieces match no text: a noncharacter keeps them out. Byte pieces must keep their
            # names, and their score must not make a text of that name cheap.
            least = min((x for x, k in zip(file.scores, file.kinds) if k == NORMAL), default=0.0)
            rows = [
                (p, x) if k == NORMAL else (p, least) if k == BYTE else (f"\uffff{p}", least)
                for p, x, k in zip(file.pieces, file.scores, file.kinds)
            ]
            return models.Unigram(rows, unknown, file.byte_fallback)
        vocabulary = {p: i for i, p in enumerate(file.pieces)}
        usable = {p for p, k in zip(file.pieces, file.kinds) if k == NORMAL}
        ranked = sorted(usable, key=lambda p: (-file.scores[vocabulary[p]], vocabulary[p]))
        merges = [
            (p[:i], p[i:]) for p in ranked for i in range(1, len(p)) if p[:i] in usable and p[i:] in usable
        ]
        # Without a cache of its own: it sees each part once.
        return models.BPE(
            vocabulary, merges, cache_capacity=0, unk_token=file.pieces[unknown], fuse_unk=True,
            byte_fallback=file.byte_fallback,
        )

    def _marked(self, text: str) -> str:
        """The normalised text with its spaces as word markers."""
        if self.normaliser:
            text = self.normaliser.normalize_str(text)
        if self.file.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.file.dummy_prefix else "") + text.replace(" ", MARK)

    def _parts(self, marked: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The parts of all texts in a row, and the first part of each text (and the number of parts)."""
        encoded = [m.encode() for m in marked]
        data = b"".join(encoded)
        bounds = np.cumsum([0, *map(len, encoded)])
        starts = np.zeros(len(data) + 1, bool)
        if not self.inner:
            held, mark = np.frombuffer(data, np.uint8), MARK.encode()
            marks = np.flatnonzero(held == mark[0])
            for i in range(1, len(mark)):  # the other bytes of a character follow its first
                marks = marks[held[marks + i] == mark[i]]
            starts[marks[np.diff(marks, prepend=-len(mark) - 1) != len(mark)]] = True
        starts[bounds] = True
        offsets = np.flatnonzero(starts)
        parts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
        return parts, np.searchsorted(offsets, bounds)

    def _known(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts; what is not remembered is encoded."""
        found = list(map(self.cache.get, parts))
        lacking = [i for i, f in enumerate(found) if f is None]
        kept = [i for i in lacking if parts[i] in self.older]
        for i in kept:
            found[i] = self.older[parts[i]]
        new = [i for i in lacking if found[i] is None]
        encoded = self.tokenizer.encode_batch_fast([parts[i] for i in new], add_special_tokens=False)
        for i, e in zip(new, encoded):
            found[i] = array("i", e.ids).tobytes()
        if self.cached > REMEMBERED_BYTES // 2:
            # What is asked for again before the next time stays.
            self.older, self.cache, self.cached = self.cache, {}, 0
        for i in lacking:
            if len(parts[i]) <= LONGEST:
                self.cache[parts[i]] = found[i]
                self.cached += ENTRY_BYTES + 4 * len(parts[i])
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """Ids of all texts in a row, how many each text has, and whether ``sentencepiece`` gives the same."""
        parts, firsts = self._parts(list(map(self._marked, texts)))
        coded = parts.dictionary_encode()
        which = coded.indices.to_numpy()
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.array([len(k) // 4 for k in known], np.int64)
        flat = _lists(np.frombuffer(b"".join(known), "<i4"), sizes).take(coded.indices).flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[which])])[firsts]
        agree = [True] * len(texts)
        if self.reference is not None:
            expected = self.reference.encode(texts, num_threads=1)
            agree = [array("i", e).tobytes() == flat[a:b].tobytes() for e, a, b in zip(expected, ends, ends[1:])]
        return flat, np.diff(ends), agree

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of lists of ids; control pieces are left out, ids outside the vocabulary are refused."""
        flat = np.array([i for own in ids for i in own], np.int64)
        return self.decode_flat(flat, np.array([len(own) for own in ids], np.int64))

    def decode_flat(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of ids in a row, of which each text has so many; see ``decode``.

        The bytes of the pieces, put together, are the text. Where they are no UTF-8, the decoder of
        ``tokenizers`` says what stands for the bytes that are left over.
        """
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.bytes)):
            raise ValueError("an id is not in the vocabulary")
        found = self.bytes.take(pa.array(flat))
        _, offsets, data = found.buffers()
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.frombuffer(offsets, np.int64)[ends].tolist() if len(flat) else [0] * len(ends)
        data = memoryview(data or b"")
        texts = []
        for i, (start, end) in enumerate(zip(places, places[1:])):
            try:
                text = str(data[start:end], "utf-8")
                texts.append(text[1:] if self.file.dummy_prefix and text[:1] == " " else text)
            except UnicodeDecodeError:
                own = flat[ends[i] : ends[i + 1]]
                kept = own[~np.isin(own, self.control)].tolist()
                texts.append(self.tokenizer.decode(kept, skip_special_tokens=False))
        return texts


def codec(path: str, verify: bool = True) -> Codec:
    """One codec for each model file in a worker; a verifier only where one is asked for."""
    key = (path, verify)
    if key not in _loaded:
        _loaded[key] = Codec(path, verify=verify)
    return _loaded[key]


def _lists(flat: np.ndarray, counts: np.ndarray, mask: pa.Array | None = None) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()), mask=mask)


def _portions(rows, texts: pa.Array) -> Iterator:
    """Consecutive parts of an Arrow array or batch; ``texts`` of its rows are bounded in bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    return (rows.slice(start, end - start) for start, end in slices(sizes, PORTION_BYTES))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>) and ``parity``; old columns of these names are replaced.

    ``parity`` says whether ``sentencepiece`` gives the same ids for the whole raw text. Null texts have
    null ids and parity true; empty texts have no ids. Rows are encoded one by one, so repeated rows and
    null keys do not matter. ``path`` is read on the executors.
    """

    @F.arrow_udf("struct<ids: array<int>, parity: boolean>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path)
        for batch in batches:
            values, counts, parity = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], []
            for some in _portions(batch, batch):
                flat, n, same = own.encode([t or "" for t in some.to_pylist()])
                values.append(flat)
                counts.append(n)
                parity += same
            ids = _lists(np.concatenate(values), np.concatenate(counts), batch.is_null())
            yield pa.StructArray.from_arrays([ids, pa.array(parity, pa.bool_())], names=["ids", "parity"])

    name = free_name(docs, "encoded")
    found = docs.withColumn(name, encoded(F.col(f"`{text}`")))
    return found.withColumns({"ids": F.col(name)["ids"], "parity": F.col(name)["parity"]}).drop(name)


def decode(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` in column ``into``; null ids give null, no ids an empty text."""

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, verify=False)
        for batch in batches:
            texts = []
            for some in portions(batch, PORTION):
                lists = some.to_pylist()
                found = own.decode([i or [] for i in lists])
                texts += [None if i is None else t for i, t in zip(lists, found)]
            yield pa.array(texts, pa.string())

    return docs.withColumn(into, decoded(F.col(f"`{ids}`")))


def verified(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, parity, round_trip): what encoding and decoding each text comes to.

    ``ids_crc32`` is over the ids as little-endian 32-bit numbers; ``round_trip`` says whether decoding
    gives the text back. Null texts have no tokens, a null checksum and keep both promises. One Python
    worker does it all, so a task holds one codec; ids and decoded texts never leave it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for some in _portions(batch, batch.column("text")):
                texts = some.column("text").to_pylist()
                flat, counts, parity = own.encode([t or "" for t in texts])
                ends = np.cumsum(counts)
                lists = [flat[b - n : b] for b, n in zip(ends, counts)]
                sums = [None if t is None else zlib.crc32(i.tobytes()) for t, i in zip(texts, lists)]
                back = own.decode_flat(flat, counts)
                columns = [
                    some.column("doc_id"), pa.array(counts), pa.array(sums, pa.int64()), pa.array(parity, pa.bool_()),
                    pa.array([t is None or t == b for t, b in zip(texts, back)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    names = ["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip"]
    kinds = [given.schema["doc_id"].dataType, T.LongType(), T.LongType(), T.BooleanType(), T.BooleanType()]
    return given.mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, their checksum, parity and whether decoding gives the text back."""
    import public_tokenizers

    return verified(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op4_sentencepiece": op4_sentencepiece}
