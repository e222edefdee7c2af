"""Hierarchical packing of documents into training sequences of several lengths.

A document is cut into whole windows of the longest tier; the rest goes to the shortest tier that
holds it. A rest of the longest tier opens a window whose gap is filled from the shorter tiers,
whole pieces first, then one cut to fit. Shorter tiers that hold more than their windows can use
are packed into sequences of their own length. Lengths are powers of two, so nothing is padded.

Packing is done within each partition of the input, without a shuffle: what is left over at its
end is cut into powers of two (at most one of each), so no padding is paid for that. The same
partition always gives the same sequences, so a task may run again on another executor.

Cases: null and empty texts are documents of one token, the closing id. Rows that repeat are
documents of their own. A null key is kept. Only the key and text columns are read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (512, 1024, 2048, 4096)
CLOSING_ID = 2
STEP_TOKENS = 1 << 16  # of one training step
POOL = 64  # sequences' worth of tokens that a shorter tier holds back to fill gaps
OPEN_WINDOWS = 64  # windows with gaps that are held back
CACHED_BYTES = 112 << 20  # of words and parts that a worker remembers
ENTRY_BYTES = 200  # of one remembered word besides its letters and ids: two objects and a place in a dictionary

LATIN = "À-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[!-~{LATIN}]+")
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^a-z0-9{LATIN}]+")


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Words(dict):
    """Ids of words between blanks, as little-endian bytes; the tokenizer never joins across blanks.

    Words of ASCII and Latin letters are lowered and cut here, so that only the merges are left to
    the model; all other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}
        self.held = 0

    def hold(self, memory: dict, word: str, ids: bytes) -> None:
        """Remember a short word; beyond CACHED_BYTES all are forgotten."""
        if len(word) >= 64:
            return
        self.held += ENTRY_BYTES + len(word) + len(ids)
        if self.held > CACHED_BYTES:
            self.clear()
            self.parts.clear()
            self.held = 0
        memory[word] = ids

    def part(self, part: str, keep: bool = True) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            text = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
            if keep:
                self.hold(self.parts, part, ids)
        return ids

    def __missing__(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            found = _PARTS.findall(word.lower())
            ids = self.part(found[0], keep=False) if len(found) == 1 else b"".join([self.part(p) for p in found])
        else:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self.hold(self, word, ids)
        return ids

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


_loaded: dict[str, Words] = {}


def words_of(path: str) -> Words:
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]


class Packer:
    """Packs one partition. A piece is [document, first token, tokens]; documents are opaque."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, first: int):
        self.tiers, self.top, self.step_tokens = tiers, tiers[-1], step_tokens
        self.pools: dict[int, deque] = {t: deque() for t in tiers[:-1]}
        self.held = dict.fromkeys(self.pools, 0)
        self.open: deque = deque()
        self.next = self.next_step = first
        self.step: dict[int, tuple[int, int]] = {}
        self.done: list[tuple] = []

    def add(self, document, tokens: int) -> None:
        whole = tokens - tokens % self.top
        for start in range(0, whole, self.top):
            self.emit([[document, start, self.top]])
        if tokens > whole:
            self.route([document, whole, tokens - whole])

    def route(self, piece: list) -> None:
        if self.open and piece[2] <= self.tiers[-2]:
            window, gap = self.open[0]
            window.append([piece[0], piece[1], min(gap, piece[2])])
            self.open[0][1] = gap - window[-1][2]
            if not self.open[0][1]:
                self.open.popleft()
                self.emit(window)
            if piece[2] > gap:
                self.route([piece[0], piece[1] + gap, piece[2] - gap])
            return
        tier = next(t for t in self.tiers if t >= piece[2])
        if tier == self.top:
            self.fill([piece], self.top - piece[2])
            return
        self.pools[tier].append(piece)
        self.held[tier] += piece[2]
        if self.held[tier] >= POOL * tier:
            self.emit(self.take(tier, tier))

    def take(self, tier: int, tokens: int) -> list:
        """Pieces of exactly so many tokens from the head of a tier; the last one may be cut."""
        pool, pieces = self.pools[tier], []
        self.held[tier] -= tokens
        while tokens:
            piece = pool.popleft()
            if piece[2] > tokens:
                pool.appendleft([piece[0], piece[1] + tokens, piece[2] - tokens])
                piece = [piece[0], piece[1], tokens]
            pieces.append(piece)
            tokens -= piece[2]
        return pieces

    def fill(self, window: list, gap: int) -> None:
        for tier in reversed(self.pools):
            pool = self.pools[tier]
            while pool and pool[0][2] <= gap:
                gap -= pool[0][2]
                window += self.take(tier, pool[0][2])
        for tier in reversed(self.pools):
            if gap and self.held[tier]:
                size = min(gap, self.held[tier])
                window += self.take(tier, size)
                gap -= size
        if not gap:
            self.emit(window)
            return
        self.open.append([window, gap])
        if len(self.open) >= OPEN_WINDOWS:
            left = self.join([piece for w, _ in self.open for piece in w])
            self.open.clear()
            if left:
                self.open.append([left, self.top - sum(p[2] for p in left)])

    def join(self, pieces: list) -> list:
        """Emit whole windows of the pieces in their order; return what is left."""
        window, room = [], self.top
        for document, start, tokens in pieces:
            while tokens:
                size = min(room, tokens)
                window.append([document, start, size])
                start, tokens, room = start + size, tokens - size, room - size
                if not room:
                    self.emit(window)
                    window, room = [], self.top
        return window

    def finish(self) -> None:
        for tier in self.pools:
            while self.held[tier] >= tier:
                self.emit(self.take(tier, tier))
        left = [piece for w, _ in self.open for piece in w]
        left += [piece for tier in reversed(self.pools) for piece in self.pools[tier]]
        left = deque(self.join(left))
        tokens = sum(p[2] for p in left)
        while tokens:
            size = 1 << (tokens.bit_length() - 1)
            tokens -= size
            window = []
            while size:
                document, start, length = left.popleft()
                if length > size:
                    left.appendleft([document, start + size, length - size])
                    length = size
                window.append([document, start, length])
                size -= length
            self.emit(window)

    def emit(self, pieces: list) -> None:
        tokens = sum(p[2] for p in pieces)
        tier = next(t for t in self.tiers if t >= tokens)
        step, used = self.step.get(tier, (0, self.step_tokens))
        if used + tokens > self.step_tokens:
            step, used, self.next_step = self.next_step, 0, self.next_step + 1
        self.step[tier] = (step, used + tokens)
        offset = 0
        for document, start, length in pieces:
            self.done.append((document, start, length, self.next, offset, tier, step))
            offset += length
        self.next += 1


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    tiers: tuple[int, ...] = TIERS,
    closing_id: int = CLOSING_ID,
    step_tokens: int = STEP_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, ids.

    ``tiers`` are powers of two. Sequences of one step group have the same tier and, but for the
    last groups of a partition, ``step_tokens`` tokens together.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)) or step_tokens % tiers[-1]:
        raise ValueError("tiers must be ascending powers of two that divide step_tokens")
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
    types = [pa.int64()] * 6 + [pa.int32(), pa.int64()]
    closing = array("I", [closing_id]).tobytes()

    def rows(packer: Packer) -> Iterator[pa.RecordBatch]:
        if not packer.done:
            return
        docs_, starts, lengths, sequences, offsets, tiers_, steps = zip(*packer.done)
        packer.done = []
        parts = [d[1][4 * s : 4 * (s + n)] for d, s, n in zip(docs_, starts, lengths)]
        columns = [starts, lengths, [zlib.crc32(p) for p in parts], [len(d[1]) // 4 for d in docs_], sequences, offsets, tiers_, steps]
        arrays = [pa.array([d[0] for d in docs_], keys_type)] + [pa.array(c, t) for c, t in zip(columns, types)]
        if with_ids:
            ends = [0]
            for n in lengths:
                ends.append(ends[-1] + n)
            values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(parts))])
            arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
        yield pa.RecordBatch.from_arrays(arrays, [key, *names] + ["ids"] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer)
        packer = Packer(tuple(tiers), step_tokens, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.ids(t.as_py() or "") + closing
                packer.add((k, ids), len(ids) // 4)
                if len(packer.done) >= 2000:
                    yield from rows(packer)
        packer.finish()
        yield from rows(packer)

    source = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    kind = source.schema[key].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    keys_type = to_arrow_type(kind)
    schema = f"`{key}` {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
    return source.mapInArrow(run, schema + ", ids array<int>" * with_ids)
