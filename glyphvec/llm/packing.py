"""Best-fit packing of tokenised documents, improved by a swap-based local search.

Tasks tokenise and cut; only lengths and checksums travel. Pieces are dealt at random into groups of some
thousand, and each group is packed on its own: it needs at most about one sequence more than its tokens,
so the loss does not grow with the corpus.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import free_name, portions, table
from glyphvec.session import materialise

CAPACITY = 2048
SEPARATOR = 0
GROUP = 4096
#: Bins that a search pass tries to empty, and the largest bin whose pairs of items it looks at.
TRIES, PAIRS = 48, 16

#: Fixed value: how the byte-level vocabulary splits text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters beyond these may belong to other classes in other Unicode versions.
SETTLED = 0x530

_loaded: dict[str, ByteTokenizer] = {}


def _byte_characters() -> dict[str, int]:
    """The printable character by which a byte-level vocabulary writes each byte."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokenizer:
    """Ids of a ``tokenizers`` file of the byte-level kind.

    The vocabulary of the file also runs in ``tiktoken``, four times as fast. It takes the texts for
    which both are known to agree: characters of long-settled classes, none of the added tokens. The
    rest, or all if a probe of those characters differs, goes through ``tokenizers`` itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = [t["content"] for t in spec["added_tokens"]]
        bytes_of = _byte_characters()
        ranks = {
            bytes(bytes_of[c] for c in piece): rank
            for piece, rank in spec["model"]["vocab"].items()
            if piece not in added
        }
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.odd = re.compile("|".join([f"[^\0-{chr(SETTLED - 1)}]", *map(re.escape, added)]))
        probe = "".join(f"a{chr(i)}{chr(i)} {chr(i)}1 " for i in range(SETTLED))
        if self.fast.encode_ordinary(probe) != self._exact(probe).tolist():
            self.odd = re.compile("")

    def _exact(self, text: str) -> np.ndarray:
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        """Ids of ``text`` and the separator."""
        if self.odd.search(text):
            found = self._exact(text)
        else:
            found = np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
        return np.append(found, np.uint32(SEPARATOR))


def _tokenizer(path: str) -> ByteTokenizer:
    if path not in _loaded:
        _loaded[path] = ByteTokenizer(path)
    return _loaded[path]


def cut(length: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """(start, end) of the pieces of a document; all but the first are full."""
    start, end = 0, length % capacity or min(length, capacity)
    while start < length:
        yield start, end
        start, end = end, end + capacity


def pieces(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row; null texts are empty.

    An empty text is one piece that holds the separator. Each row is cut by itself, repeated ones too;
    null ids stay null. ``ids`` adds the token ids.
    """

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in (some for whole in batches for some in portions(whole)):
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = tokenizer.ids(body or "")
                for k, (start, end) in enumerate(cut(len(found))):
                    part = found[start:end]
                    values = (name, k, start, end - start, zlib.crc32(part.astype("<u4").tobytes()), part if ids else None)
                    for column, value in zip(rows, values):
                        column.append(value)
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            width = 6 if ids else 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(rows[:width], kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:width],
            )

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids
    return rows.mapInArrow(tokenise, schema)


def best_fit(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers by bin: each item, largest first, goes to the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room for r more
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fitting = rooms >> sizes[i]
        if fitting:
            room = sizes[i] + (fitting & -fitting).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        room -= sizes[i]
        if room:
            by_room[room].append(k)
            rooms |= 1 << room
    return bins


class LocalSearch:
    """Empties bins by moves and exchanges, each of which increases the sum of squared fills.

    An exchange gives a fuller bin more tokens than it takes from it. As fills are whole numbers and
    bounded, the search ends.
    """

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int) -> None:
        self.sizes, self.capacity = np.array(sizes, np.int64), capacity
        self.bins = bins
        self.fill = np.array([self.sizes[b].sum() for b in bins], np.int64)

    def run(self) -> list[list[int]]:
        fewest = -(-int(self.sizes.sum()) // self.capacity)
        while len(self.bins) > fewest and self._empty_one():
            kept = [k for k, b in enumerate(self.bins) if b]
            self.bins, self.fill = [self.bins[k] for k in kept], self.fill[kept]
        return self.bins

    def _empty_one(self) -> bool:
        for k in np.argsort(self.fill, kind="stable")[:TRIES]:
            while self.bins[k] and self._step(int(k)):
                pass
            if not self.bins[k]:
                return True
        return False

    def _step(self, k: int) -> bool:
        """One move or exchange between bin ``k`` and a bin at least as full; False if there is none."""
        room = np.where(self.fill >= self.fill[k], self.capacity - self.fill, 0)
        room[k] = 0
        own = sorted(self.bins[k], key=lambda i: -self.sizes[i])
        for i in own:
            fits = np.flatnonzero(room >= self.sizes[i])
            if len(fits):
                self._exchange(k, [i], int(fits[room[fits].argmin()]), [])
                return True
        open_bins = np.flatnonzero(room)
        if not len(open_bins):
            return False
        owner = np.repeat(open_bins, [len(self.bins[b]) for b in open_bins])
        items = np.array([i for b in open_bins for i in self.bins[b]], np.int64)
        for mine in [(i,) for i in own] + self._pairs(own):
            given = self._best(sum(int(self.sizes[i]) for i in mine) - self.sizes[items], room[owner])
            if given is not None:
                self._exchange(k, list(mine), int(owner[given]), [int(items[given])])
                return True
        pairs = [(b, *p) for b in open_bins for p in self._pairs(self.bins[b])]
        if pairs:
            table = np.array(pairs, np.int64)
            both = self.sizes[table[:, 1]] + self.sizes[table[:, 2]]
            for i in own:
                given = self._best(self.sizes[i] - both, room[table[:, 0]])
                if given is not None:
                    self._exchange(k, [i], int(table[given, 0]), [int(x) for x in table[given, 1:]])
                    return True
        return False

    def _pairs(self, items: list[int]) -> list[tuple[int, int]]:
        return [(a, b) for n, a in enumerate(items) for b in items[:n]] if len(items) <= PAIRS else []

    @staticmethod
    def _best(gain: np.ndarray, room: np.ndarray) -> int | None:
        allowed = np.where((gain > 0) & (gain <= room), gain, 0)
        best = int(allowed.argmax())
        return best if allowed[best] else None

    def _exchange(self, a: int, given: list[int], b: int, taken: list[int]) -> None:
        self.bins[a] = [i for i in self.bins[a] if i not in given] + taken
        self.bins[b] = [i for i in self.bins[b] if i not in taken] + given
        moved = int(self.sizes[given].sum() - self.sizes[taken].sum()) if taken else int(self.sizes[given].sum())
        self.fill[a] -= moved
        self.fill[b] += moved


def pack_sizes(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers by bin; no size may exceed ``capacity``."""
    return LocalSearch(sizes, best_fit(sizes, capacity), capacity).run()


def _pack_group(rows: pa.Table, name: str = "group") -> pa.Table:
    sizes = rows["length"].to_pylist()
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for k, items in enumerate(pack_sizes(sizes)):
        at = 0
        for i in sorted(items):
            sequence[i], offset[i] = k, at
            at += sizes[i]
    group = rows[name].to_numpy()
    out = rows.drop_columns([name])
    out = out.append_column("sequence_id", pa.array(group * GROUP * 4 + sequence))
    return out.append_column("offset", pa.array(offset))


def pack(found: DataFrame) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; existing columns of these names are replaced.

    Every row lies in one sequence of at most 2048 tokens, gapless from 0. Without rows: no rows.
    """
    found = materialise(found.drop("sequence_id", "offset"), "pieces")
    groups = max(1, -(-found.count() // GROUP))
    name = free_name(found, "group")
    dealt = found.withColumn(name, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return dealt.groupBy(name).applyInArrow(lambda rows: _pack_group(rows, name), f"{schema}, sequence_id bigint, offset bigint")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(pieces(table(spark, sf_dir, "documents"), path))


QUERIES = {"op7_best_fit_packing": op7_best_fit_packing}
