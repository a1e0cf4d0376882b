"""SentencePiece BPE encoding by a table over prefixes, and decoding.

The encoding of every prefix of a text ends with one token, which depends only on the token
before it: of the vocabulary's pieces that end at a place (automaton matches), just one is
compatible with the last token of the prefix before it, that is, encoding the two pieces alone
gives the two. The table of these last tokens is filled from left to right, and the ids are
read from its end backwards: linear in the text, without a queue of merges.
"""

from __future__ import annotations

import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.tables import chunks, give_back

SPACE = "▁"
MEMO_UNITS = 100_000
MEMO_CHARACTERS = 64
PAIRS = 200_000


class PrefixTable:
    """Encoder and decoder of one BPE model with byte fallback and a space put before the text."""

    def __init__(self, model: str, memo_units: int = MEMO_UNITS):
        self.memo_units = memo_units
        library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = library.get_piece_size()
        self.ids, self.scores, self.byte_ids = {}, {}, {}
        self.shown: list[bytes] = []
        self.raw: set[int] = set()
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.raw.add(i)
                self.shown.append(bytes([int(piece[1:-1], 16)]))
            elif library.is_unknown(i):
                self.unknown = i
                self.shown.append(" ⁇ ".encode())
            elif library.is_control(i):
                self.shown.append(b"")
            else:
                self.ids[piece] = i
                self.scores[piece] = library.get_score(i)
                self.shown.append(piece.replace(SPACE, " ").encode())
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        self.control = {i for i in range(size) if library.is_control(i)}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, (self.ids[piece] + 1, len(piece)))
        self.automaton.make_automaton()
        # No piece goes on from a word into a space or over a line end: texts are cut there.
        if any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in self.ids):
            self.units = re.compile(r"(?s).+")
        else:
            self.units = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        # Pieces are numbered by id + 1, other characters from there on; 0 is the empty prefix.
        self.names = ["", *(library.id_to_piece(i) for i in range(size))]
        self.numbers: dict[str, int] = {}
        self.lengths = {i + 1: len(p) for p, i in self.ids.items()}
        self.odd = re.compile("[^" + re.escape("".join(p for p in self.ids if len(p) == 1)) + "]")
        self.pairs: dict[int, bool] = {}
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        # Ids of units and parts, in two generations of bounded size each.
        self.memo: dict[str, bytes] = {}
        self.units_before: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.parts_before: dict[str, bytes] = {}

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the last merge of a piece joins; None if merges never give the piece.

        A piece of one character has two empty parts.
        """
        found = self.splits.get(piece, 0)
        if found == 0:
            parts = list(piece)
            while len(parts) > 2 and (i := self._next(parts)) is not None:
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if len(parts) == 1:
                found = ("", "")
            else:
                found = tuple(parts) if len(parts) == 2 and piece in self.scores else None
            self.splits[piece] = found
        return found

    def _next(self, parts: list[str]) -> int | None:
        """Where the next merge is: the best score first, of equal ones the leftmost."""
        best = max(
            ((self.scores[p], -i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.scores),
            default=None,
        )
        return best and -best[1]

    def fit(self, before: str, piece: str) -> bool:
        """Do the merges of the two texts together give just the two, so that none crosses their border?

        Merges are undone from the last one. A piece never scores better than its parts, so the
        undone merge came before any of a worse score: a join over the border stands in the way
        only if its score beats the merges undone so far; at equal scores the left one came first.
        """
        left, right = self.split(before), self.split(piece)
        if right is None or (before and left is None):
            return False
        if not before:
            return True
        scores, limit, place = self.scores, float("-inf"), 0
        while True:
            joined = scores.get(before + piece)
            # place: the undone merge lies left (-1) or right (1) of the border.
            if joined is not None and (joined > limit or (joined == limit and place > 0)):
                return False
            ours = scores[before] if left[0] else float("inf")
            theirs = scores[piece] if right[0] else float("inf")
            if ours == theirs == float("inf"):
                return True
            if ours < theirs:
                limit, place, before = ours, -1, left[1]
                left = self.split(before)
            else:
                limit, place, piece = theirs, 1, right[0]
                right = self.split(piece)

    def _compatible(self, pair: int) -> bool:
        fits = self.fit(self.names[pair >> 32], self.names[pair & 0xFFFFFFFF])
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[pair] = fits
        return fits

    def _named(self, piece: str) -> int:
        """A number for a character that is no piece."""
        found = self.numbers.get(piece)
        if found is None:
            found = self.numbers[piece] = len(self.names)
            self.names.append(piece)
        return found

    def _part(self, part: str) -> bytes:
        """Ids of a text that no piece reaches into or out of."""
        n = len(part)
        last = [0] * (n + 1)
        pairs = self.pairs
        matches = self.automaton.iter(part)
        if self.odd.search(part):
            known = list(matches)
            ends = {end for end, _ in known}
            known += [(i, (self._named(part[i]), 1)) for i in range(n) if i not in ends]
            matches = sorted(known, key=lambda match: match[0])
        for end, (piece, length) in matches:
            end += 1
            if not last[end]:
                pair = last[end - length] << 32 | piece
                fits = pairs.get(pair)
                if fits or (fits is None and self._compatible(pair)):
                    last[end] = piece
        ids: list[int] = []
        end, lengths = n, self.lengths
        while end:
            piece = last[end]
            if not piece:
                raise ValueError(f"no piece of {part[:end]!r} fits the prefix before it")
            if piece in lengths:
                ids.append(piece - 1)
                end -= lengths[piece]
            else:
                ids += [self.byte_ids[b] for b in reversed(self.names[piece].encode())]
                end -= 1
        ids.reverse()
        return array("i", ids).tobytes()

    def _unit(self, unit: str) -> bytes:
        """Ids of a unit, from those of its parts: it is cut where no piece holds the two characters."""
        found = self.units_before.get(unit)
        if found is None:
            inside, parts, start = self.inside, [], 0
            for i, two in enumerate(map("".join, zip(unit, unit[1:])), 1):
                if two not in inside:
                    parts.append(unit[start:i])
                    start = i
            parts.append(unit[start:])
            ids = []
            for part in parts:
                known = self.parts.get(part)
                if known is None:
                    known = self.parts_before.get(part) or self._part(part)
                    if len(part) <= MEMO_CHARACTERS:
                        if len(self.parts) >= self.memo_units:
                            self.parts, self.parts_before = {}, self.parts
                        self.parts[part] = known
                ids.append(known)
            found = b"".join(ids)
        if len(unit) <= MEMO_CHARACTERS:
            if len(self.memo) >= self.memo_units:
                self.memo, self.units_before = {}, self.memo
            self.memo[unit] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit integers."""
        if not text:
            return b""
        unit = self._unit
        return b"".join([self.memo.get(u) or unit(u) for u in self.units.findall(SPACE + text.replace(" ", SPACE))])

    def decode(self, ids: list[int]) -> str:
        """The text of ids; a space before the first piece goes, bytes that are no UTF-8 become U+FFFD each."""
        shown = self.shown
        first = next((k for k, i in enumerate(ids) if i not in self.control), None)
        out = b"".join(map(shown.__getitem__, ids))
        if first is not None and ids[first] not in self.raw and ids[first] != self.unknown and out[:1] == b" ":
            out = out[1:]
        try:
            return out.decode()
        except UnicodeDecodeError:
            return out.decode(errors="each_byte")


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def encode_decode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", memo_units: int = MEMO_UNITS) -> DataFrame:
    """``key``, ``ids`` (array of int, no begin or end id) and ``decoded`` of every whole text.

    ``model`` is a file that every executor has. A null or empty text has no ids and decodes to
    an empty text; repeated rows come out as often as they came in; a text of any length is
    encoded in time and memory linear in it. A worker remembers the ids of up to four times ``memo_units`` units; fewer
    cost time and change nothing.
    """

    def coded(batches):
        import codecs

        codecs.register_error("each_byte", _each_byte)
        # What the worker's earlier tasks have freed.
        give_back()
        bpe = PrefixTable(model, memo_units)
        for keys, texts in chunks(batches, "key", "text"):
            ids = [bpe.encode(t.decode()) for t in texts]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
            decoded = [bpe.decode(np.frombuffer(x, np.int32).tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(decoded, pa.string())],
                ["key", "ids", "decoded"],
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(coded, "key long, ids array<int>, decoded string").withColumnRenamed("key", key)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")).cast("binary"), 256)


