"""SentencePiece encoding and decoding with merge-type (BPE) models.

The library merges the best-scored pair of neighbours until none is left. The same result is found by
backtracking: an Aho-Corasick automaton over the pieces tells the matches; from left to right the
longest is taken that goes with the piece before it, that is, if merging both anew gives back these
two pieces. Pieces that go together pairwise are the encoding of what they cover, so a position from
which no way leads on fails for good; a bitfield remembers it.

Two characters that stand next to each other in no piece part the text exactly, so what lies between
such places (words, mostly) is encoded on its own and remembered up to a bound. The model file (half
a megabyte, whatever the input) travels with the job; tables are built once per worker. Nothing is
shuffled.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as format

# What stands for a space inside pieces.
BLANK = "▁"

# Entries that a worker remembers of each kind before it starts anew; longer words are not kept.
REMEMBERED = 1 << 18
LONG_WORD = 64

# Characters that the automaton runs over, and that are cut into words, at a time.
WINDOW = 1 << 12
PART = 1 << 20

# Ids that leave a task as one batch.
BATCH_IDS = 1 << 20

codecs.register_error("rivulet-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class Remembered(dict):
    """Results of a function by argument; forgets all when it is full."""

    def __init__(self, function):
        self._function = function

    def __missing__(self, key):
        value = self._function(key)
        if len(self) >= REMEMBERED:
            self.clear()
        self[key] = value
        return value


class Pieces:
    """A merge-type model: `encode` a text to ids, `decode` ids to a text."""

    def __init__(self, model: bytes):
        proto = format.ModelProto.FromString(model)
        kinds = format.ModelProto.SentencePiece
        used = {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
        trainer, normal = proto.trainer_spec, proto.normalizer_spec
        plain = normal.add_dummy_prefix and normal.escape_whitespaces and not normal.remove_extra_whitespaces
        self._texts = [p.piece for p in proto.pieces]
        self._ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        longer = [piece for piece in self._ids if len(piece) > 1]
        if (
            trainer.model_type != format.TrainerSpec.BPE
            or normal.precompiled_charsmap
            or not (plain and trainer.byte_fallback)
            or trainer.treat_whitespace_as_suffix
            or any(p.type not in used for p in proto.pieces)
            or not set().union(*longer) <= self._ids.keys()
        ):
            raise ValueError("only merge-type models with byte pieces that leave texts as they are")
        self._rank = {p.piece: -p.score for p in proto.pieces if p.type == kinds.NORMAL}
        named = {text: i for i, text in enumerate(self._texts)}
        self._bytes = [named[f"<0x{b:02X}>"] for b in range(256)]
        self.bos, self.eos = named[trainer.bos_piece], named[trainer.eos_piece]
        self._longest = max(map(len, self._ids))
        self._matcher = ahocorasick.Automaton()
        for piece, i in self._ids.items():
            self._matcher.add_word(piece, (len(piece), i))
        self._matcher.make_automaton()
        self._words = Remembered(self._word)
        self._steps = Remembered(self._merges)
        self._goes = Remembered(self._agree)

        inside = sorted(set().union(*longer))
        self._class = np.zeros(0x110000, dtype=np.uint16)
        self._class[list(map(ord, inside))] = np.arange(1, len(inside) + 1)
        self._meet = np.zeros((len(inside) + 1,) * 2, dtype=bool)
        for piece in longer:
            at = self._class[list(map(ord, piece))]
            self._meet[at[:-1], at[1:]] = True

        surfaces = [self._surface(p, kinds, trainer) for p in proto.pieces]
        self._flat = np.frombuffer(b"".join(surfaces), dtype=np.uint8)
        self._sizes = np.array([len(t) for t in surfaces])
        self._ends = np.cumsum(self._sizes)
        self._blank = np.array([p.type == kinds.NORMAL and p.piece.startswith(BLANK) for p in proto.pieces])

    def _surface(self, piece, kinds, trainer) -> bytes:
        if piece.type == kinds.CONTROL:
            return b""
        if piece.type == kinds.UNKNOWN:
            return trainer.unk_surface.encode()
        if piece.type == kinds.BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        return piece.piece.replace(BLANK, " ").encode()

    def _merges(self, piece: int) -> tuple[bool, list[tuple[float, str, str]]]:
        """Whether merging the characters of a piece gives the piece, and the merges in their order (the best
        pair, the leftmost of equals): rank, and the first and last part after it. The first entry holds
        the parts before any merge."""
        parts = list(self._texts[piece])
        steps = [(0.0, parts[0], parts[-1])]
        while True:
            best, at = None, 0
            for k in range(len(parts) - 1):
                rank = self._rank.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                return len(parts) == 1, steps
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))

    def _agree(self, pair: tuple[int, int]) -> bool:
        """Whether merging the texts of two pieces gives these two: their merges run side by side, and no merge
        over the edge may be the best at any time. The left one goes first among equals."""
        (whole_a, a), (whole_b, b) = self._steps[pair[0]], self._steps[pair[1]]
        if not (whole_a and whole_b):
            return False
        i = j = 0
        while True:
            next_a = a[i + 1][0] if i + 1 < len(a) else math.inf
            next_b = b[j + 1][0] if j + 1 < len(b) else math.inf
            over = self._rank.get(a[i][2] + b[j][1])
            if over is not None and over < next_a and over <= next_b:
                return False
            if next_a == next_b == math.inf:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def _matches(self, word: str, first: int) -> list[list[tuple[int, int]]]:
        """Size and id of the pieces that start at each of the next WINDOW places, shortest first."""
        found = [[] for _ in range(min(WINDOW, len(word) - first))]
        for end, match in self._matcher.iter(word[first : first + WINDOW + self._longest - 1]):
            start = end + 1 - match[0]
            if start < len(found):
                found[start].append(match)
        return found

    def _greedy(self, word: str) -> list[int] | None:
        """The longest match after the other, if all go together."""
        taken, last = [], None
        at = 0
        for end, (size, piece) in self._matcher.iter_long(word):
            if end + 1 - size != at or not (self._steps[piece][0] if last is None else self._goes[last, piece]):
                return None
            taken.append(piece)
            last, at = piece, end + 1
        return taken if at == len(word) else None

    def _search(self, word: str) -> list[int]:
        n, at, taken = len(word), 0, []
        failed = bytearray((n >> 3) + 1)
        windows: dict[int, list[list[tuple[int, int]]]] = {}
        while at < n:
            window = at // WINDOW
            if window not in windows:
                # Steps back are few, so the window before this one is all that may be needed again.
                windows = {k: v for k, v in windows.items() if k == window - 1}
                windows[window] = self._matches(word, window * WINDOW)
            for size, piece in reversed(windows[window][at % WINDOW]):
                end = at + size
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                if self._goes[taken[-1], piece] if taken else self._steps[piece][0]:
                    taken.append(piece)
                    at = end
                    break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(self._texts[taken.pop()])
        return taken

    def _word(self, word: str) -> tuple[int, ...]:
        if len(word) == 1 and word not in self._ids:
            return tuple(self._bytes[b] for b in word.encode())
        return tuple(self._greedy(word) or self._search(word))

    def _words_of(self, text: str) -> Iterator[list[str]]:
        """The parts of a text that no piece reaches out of, those of about PART characters at a time."""
        at, size = 0, PART
        while at < len(text):
            part = text[at : at + size]
            kinds = self._class[np.frombuffer(part.encode("utf-32-le"), dtype=np.uint32)]
            cuts = [0, *(np.flatnonzero(~self._meet[kinds[:-1], kinds[1:]]) + 1).tolist()]
            if at + size >= len(text):
                cuts.append(len(part))
            elif len(cuts) == 1:
                # One word fills the part: take more of it.
                size *= 2
                continue
            yield [part[a:b] for a, b in zip(cuts, cuts[1:])]
            at, size = at + cuts[-1], PART

    def encode(self, text: str, bos: bool = True, eos: bool = True) -> np.ndarray:
        """Ids of a whole text."""
        found = [np.array([self.bos] * bos, dtype=np.uint32)]
        if text:
            for words in self._words_of(BLANK + text.replace(" ", BLANK)):
                # A long word is not kept: one would take the room of many.
                ids = (self._words[word] if len(word) <= LONG_WORD else self._word(word) for word in words)
                found.append(np.fromiter(chain.from_iterable(ids), np.uint32))
        found.append(np.array([self.eos] * eos, dtype=np.uint32))
        return np.concatenate(found)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, in UTF-8: control ids have none but part a run of bytes, bytes that are no UTF-8
        become U+FFFD each, and the blank that encoding puts in front goes."""
        silent = np.flatnonzero(self._sizes[ids] == 0)
        # Begin and end part nothing; only ids between others do.
        silent = silent[(silent > 0) & (silent < len(ids) - 1)]
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = self._flat[np.repeat(self._ends[ids] - ends, sizes) + np.arange(total)].tobytes()
        front = int(total > 0 and self._blank[ids[np.argmax(sizes > 0)]])
        cuts = [front, *np.maximum(ends[silent], front).tolist(), total]
        parts = (data[a:b].decode(errors="rivulet-each-byte") for a, b in zip(cuts, cuts[1:]))
        return "".join(parts).encode()


@functools.lru_cache(maxsize=2)
def _pieces_of(model: bytes) -> Pieces:
    return Pieces(model)


def _rows(batch: pa.RecordBatch, column: int) -> Iterator[str]:
    return (value.as_py() or "" for value in batch.column(column))


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoded(docs: DataFrame, model: bytes, bos: bool = True, eos: bool = True) -> DataFrame:
    """doc_id and `ids` of every row's whole text. Null texts count as empty, rows that repeat are encoded
    each, other columns are not read; an empty table gives no rows."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces_of(model)
        for batch in batches:
            first, held, size = 0, [], 0
            for k, text in enumerate(_rows(batch, 1)):
                held.append(pieces.encode(text, bos, eos))
                size += len(held[-1])
                if size >= BATCH_IDS or k + 1 == batch.num_rows:
                    offsets = np.cumsum([0, *map(len, held)])
                    ids = pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(np.concatenate(held).astype(np.int32))
                    )
                    of = batch.column(0).slice(first, len(held))
                    yield pa.RecordBatch.from_arrays([of, ids], names=["doc_id", "ids"])
                    first, held, size = k + 1, [], 0

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decoded(rows: DataFrame, model: bytes) -> DataFrame:
    """doc_id and `text` of rows with `ids`. Null ids count as none."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces_of(model)
        for batch in batches:
            texts = [
                pieces.decode(np.array(ids.values.to_numpy() if ids.is_valid else [], dtype=np.int64)).decode()
                for ids in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: its text encoded with begin and end, and
    these ids decoded, as digests. Cases as for `encoded`; ids and texts do not leave the task."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces_of(model)
        for batch in batches:
            rows = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in _rows(batch, 1):
                ids = pieces.encode(text)
                rows["n_tokens"].append(len(ids))
                rows["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(pieces.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows.values())], names=["doc_id", *rows])

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
