"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The trellis has one node per boundary between characters. A node keeps the best piece that ends
there and where that piece began. Only the last nodes, as many as the longest piece has characters,
can still be extended; once the paths of all of these pass through one boundary, the ids before it
are final and are given out, and the nodes before it are dropped.

Two kinds of models are read. In a unigram model a path's weight is the sum of its piece scores. In
a merge (BPE) model the scores are merge ranks, and a path is allowed only if each two neighbouring
pieces are what the merges make of their joined text; exactly one such path ends at any boundary,
and it is the library's own encoding. Characters that no piece holds become byte pieces.

No piece holds a blank mark behind another character (checked when a model is loaded), so all paths
converge before each word, and a bounded memory of encoded words saves repeated work.

Cases: null and empty texts have no ids. Rows that repeat are encoded each. A blank mark written in a
text is read as a blank, as in the library.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CACHED_WORDS = 800_000
PAIRS = 2_000_000  # remembered neighbours
SLICE = 2000  # documents encoded together
SUFFIX = 4  # last characters by which the lengths of pieces are looked up
UNIGRAM, MERGES = "unigram", "merges"
UNKNOWN_PENALTY = 10.0


class Sizes(dict):
    """Lengths, longest first, of the pieces that may end with given last characters."""

    def __init__(self, pieces):
        self.pieces = pieces
        self.long: dict[str, set[int]] = {}
        for piece in pieces:
            if len(piece) > SUFFIX:
                self.long.setdefault(piece[-SUFFIX:], set()).add(len(piece))

    def __missing__(self, last: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        short = {k for k in range(1, len(last) + 1) if last[-k:] in self.pieces}
        sizes = self[last] = tuple(sorted({1} | short | self.long.get(last, set()), reverse=True))
        return sizes


class Model:
    """Pieces of a model file. ``kind`` says whether scores are log probabilities or merge ranks."""

    def __init__(self, path: str, kind: str = MERGES):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        self.normalize, self.kind = library.normalize, kind
        ids = range(library.get_piece_size())
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        skip = {i for i in ids if library.is_control(i) or library.is_unknown(i) or library.is_unused(i) or library.is_byte(i)}
        self.ids = {library.id_to_piece(i): i for i in ids if i not in skip}
        self.score = {p: library.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.bytes = [b"" if i in skip else library.id_to_piece(i).replace(MARK, " ").encode() for i in ids]
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        self.words_apart = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.lines_apart = not any("\n" in p for p in self.ids)
        self.sizes = Sizes(self.ids)
        self.unknown = min(self.score.values()) - UNKNOWN_PENALTY
        self.allowed: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self.pairs = 0
        self.words: dict[str, bytes] = {}
        self.most_kept = 0

    def merged(self, text: str) -> list[str]:
        """What the merges make of a short text: the best-scored pair first, leftmost among equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, 0
            for i, pair in enumerate(map(add, parts, parts[1:])):
                own = score.get(pair)
                if own is not None and (best is None or own > best):
                    best, at = own, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether ``right`` may follow ``left`` (nothing: at the start) on a path of merges."""
        if self.pairs >= PAIRS:
            self.allowed.clear()
            self.pairs = 0
        self.pairs += 1
        fits = len(right) == 1 or right in self.ids
        if fits:
            fits = self.merged(left + right) == ([left, right] if left else [right])
            fits = fits and (not left or self.fits("", right))
        self.allowed[left][right] = fits
        return fits

    def grow(self, best: list, text: str, base: int, end: int) -> None:
        """Extend the trellis of text[base:] up to ``end``.

        best[i] is (weight, piece) of the best path over the first i characters behind ``base``, or
        None where no path ends.
        """
        score, merges, allowed, sizes = self.score, self.kind == MERGES, self.allowed, self.sizes
        for to in range(base + len(best), end + 1):
            at, found = to - base, None
            for size in sizes[text[max(base, to - SUFFIX) : to]]:
                if size > at:
                    continue
                before = best[at - size]
                if before is None:
                    continue
                piece = text[to - size : to]
                if merges:
                    fits = allowed[before[1]].get(piece)
                    if fits or fits is None and self.fits(before[1], piece):
                        found = (0.0, piece)
                        break
                    continue
                own = score.get(piece, self.unknown if size == 1 else None)
                if own is not None and (found is None or before[0] + own > found[0]):
                    found = (before[0] + own, piece)
            best.append(found)

    def stream(self, text: str) -> Iterator[list[str]]:
        """Pieces of ``text`` in order, in lists, each given out as soon as it is final."""
        best: list = [(0.0, "")]
        base, end = 0, 0
        while end < len(text):
            end = min(len(text), end + 2 * self.longest)
            self.grow(best, text, base, end)
            self.most_kept = max(self.most_kept, len(best))
            keep = self.converged(best) if end < len(text) else 0
            if keep:
                yield self.path(best, keep)
                weight = best[keep][0]
                best = [(b[0] - weight, b[1]) if b else None for b in best[keep:]]
                base += keep
        yield self.path(best, len(text) - base)

    def converged(self, best: list) -> int:
        """The last boundary that the paths of all nodes that can still be extended pass through."""
        last = len(best) - 1
        ends = {i for i in range(max(0, last - self.longest + 1), last + 1) if best[i]}
        while len(ends) > 1:
            end = max(ends)
            ends.remove(end)
            ends.add(end - len(best[end][1]))
        return ends.pop()

    @staticmethod
    def path(best: list, end: int) -> list[str]:
        pieces = []
        while end:
            pieces.append(best[end][1])
            end -= len(pieces[-1])
        return pieces[::-1]

    def coded(self, pieces: list[str]) -> array:
        out, ids = array("i"), self.ids
        for p in pieces:
            i = ids.get(p)
            if i is None:
                out.extend([self.byte_ids[b] for b in p.encode()])
            else:
                out.append(i)
        return out

    def learn(self, words: set[str]) -> None:
        """Encode new words. In their order, each goes on from the trellis of what it shares with the last."""
        best, last = [(0.0, "")], ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :]
            self.grow(best, word, 0, len(word))
            self.words[word] = self.coded(self.path(best, len(word))).tobytes()
            last = word

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers, in bytes."""
        spans = [[t] if t else [] for t in map(self.normalize, texts)]
        if self.words_apart:
            pattern = f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if self.lines_apart else f"{MARK}*[^{MARK}]+|{MARK}+"
            spans = [re.findall(pattern, t[0]) if t else t for t in spans]
        if len(self.words) >= CACHED_WORDS:
            self.words.clear()
        words = self.words
        self.learn({w for span in spans for w in span if w not in words and len(w) <= 64})
        out = []
        for span in spans:
            coded = [words.get(w) for w in span]
            for i, ids in enumerate(coded):
                if ids is None:
                    coded[i] = b"".join([self.coded(p).tobytes() for p in self.stream(span[i])])
            out.append(b"".join(coded))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text, without the blank put in front of it; broken bytes become replacement marks."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_loaded: dict[tuple[str, str], Model] = {}


def model_of(path: str, kind: str) -> Model:
    if (path, kind) not in _loaded:
        _loaded[path, kind] = Model(path, kind)
    return _loaded[path, kind]


def encode(docs: DataFrame, model: str, kind: str = MERGES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (array of int), n_ids, round_trip: whether decoding the ids gives the text again."""
    from pyspark.sql.pandas.types import to_arrow_type

    source = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind_of_key = source.schema[key].dataType
    names = [key, "ids", "n_ids", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(model, kind)
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE):
                batch = whole.slice(first, SLICE)
                same, ends = [], [0]
                texts = batch.column(1).to_pylist()
                coded = m.encode(texts)
                for t, ids in zip(texts, coded):
                    ends.append(ends[-1] + len(ids) // 4)
                    same.append(m.decode(memoryview(ids).cast("i").tolist()) == t.replace(MARK, " "))
                values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(coded))])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), ids, pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array(same)], names
                )

    assert to_arrow_type(kind_of_key) is not None
    return source.mapInArrow(run, f"`{key}` {kind_of_key.simpleString()}, ids array<int>, n_ids long, round_trip boolean")


def decode(docs: DataFrame, model: str, kind: str = MERGES, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text: the text of the ids; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(model, kind)
        for batch in batches:
            texts = [None if x is None else m.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    source = docs.select(F.col(key), F.col(ids).alias("ids"))
    return source.mapInArrow(run, f"`{key}` {source.schema[key].dataType.simpleString()}, text string")
