"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled once per model, from what its file specifies: the normaliser (rewrite rules, extra spaces, spaces to the space
mark, the mark that is put in front), the pieces (arcs over their characters, with an id and a weight) and byte fallback (a character that
is no piece goes to its UTF-8 bytes). A text is composed with it, which gives a lattice of pieces over the text's
positions, and the shortest path in the tropical semiring (weights add along a path, the least wins) is its
encoding. Decoding is the inverse transduction.

For a unigram model the weight of a piece is its negative score, and a character that no piece spells alone has an arc
that weighs ten more than the heaviest piece. Weights are added in single precision, as the library does, so that ties
go the same way; unknown characters side by side are one id. A merge (BPE) model is compiled into arcs for
pairs of pieces: a pair has a finite weight only where the merges, applied to the two pieces together, leave
them apart. A path all of whose pairs are finite is the one the merges give, so that the shortest path is
exactly the library's encoding.

No piece reaches across a space mark that follows another character (checked when compiling), nor between two
characters that no piece has side by side, so the path is found for the parts in between. These repeat and
begin alike, and are kept in tables of bounded size per Python worker.

Defined results:
- A null text is empty and has no pieces. Repeated rows are encoded alike.
- ``decoded`` is the normalised text: a literal space mark comes back as a space.
- An empty table gives an empty result. Other columns are never read, whatever their names.
- A model file with what is not compiled (a table of rewritten characters, pieces of the user or out of use, marks behind
  words, models of words or characters) raises.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
from pyspark.sql import DataFrame

from quern.llm.common import map_columns

MARK = "▁"
FALLBACK = 10.0  # how much more than the heaviest piece an arc for an unknown character weighs
KEPT = 1_000_000  # stretches, and beginnings of stretches, whose encoding a worker keeps
LONGEST_KEPT = 64  # characters of such a stretch


_SPACES = re.compile("  +")


class Transducer:
    """pieces: text -> (id, score); byte_ids: the ids of the 256 bytes; merges: whether scores rank merges (BPE)."""

    def __init__(
        self,
        pieces: dict[str, tuple[int, float]],
        byte_ids: list[int] | None,
        merges: bool,
        rules: dict[str, str] | None = None,
        dummy_prefix: bool = True,
        unknown: int = 0,
        extra_spaces: bool = True,
    ):
        self.pieces, self.byte_ids, self.merges, self.unknown = pieces, byte_ids, merges, unknown
        self.rules = {" ": MARK} | (rules or {})
        self.dummy_prefix, self.extra_spaces = dummy_prefix, extra_spaces
        self.fallback = float(np.float32(min((s for _, s in pieces.values()), default=0.0) - FALLBACK))
        self._rewrites = re.compile("|".join(re.escape(r) for r in sorted(self.rules, key=len, reverse=True)))
        # The pieces are the transducer's arcs over spans of the text; none is longer than this.
        self.longest = max(map(len, pieces), default=1)
        self.inside = {text[i : i + 2] for text in pieces for i in range(len(text) - 1)}
        self.alphabet = {c for text in pieces for c in text}
        crossing = any(MARK in text.lstrip(MARK) for text in pieces)
        apart = "".join(re.escape(c) for c in "\n\r\t" if c not in self.alphabet)
        alone = f"[{apart}]|" if apart else ""
        self._stretch = re.compile(r"(?s:.+)" if crossing else f"{alone}{MARK}*[^{MARK}{apart}]+|{MARK}+")
        # The inverse: ids to bytes.
        self.output = {number: text.replace(MARK, " ").encode() for text, (number, _) in pieces.items()}
        self.output |= {number: bytes([i]) for i, number in enumerate(byte_ids or [])}
        self.output.setdefault(unknown, " ⁇ ".encode())
        self._pairs: dict[tuple[str, str], bool] = {}
        self._known: dict[str, bytes] = {}
        self._ends: dict[str, str] = {}
        self._splits: dict[str, tuple[str, str] | None] = {}

    def normalise(self, text: str) -> str:
        if not self.extra_spaces:
            text = _SPACES.sub(" ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.dummy_prefix else "") + self._rewrites.sub(lambda m: self.rules[m.group()], text)

    def merged(self, text: str, leave: int = 1) -> list[str]:
        """What the merges leave of a text: the best-scored neighbours are joined first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > leave:
            best = max(
                ((self.pieces[p][1], -i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.pieces),
                default=None,
            )
            if best is None:
                break
            at = -best[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes this one, or None where merges never make it; a character is its own."""
        found = self._splits.get(piece, "")
        if found == "":
            found = (piece, piece)
            if len(piece) > 1:
                parts = self.merged(piece, leave=2)
                found = tuple(parts) if len(parts) == 2 and self.merged(piece) == [piece] else None
            self._splits[piece] = found
        return found

    def _apart(self, left: str, right: str) -> bool:
        """Whether the arc for this pair has a finite weight: no merge across the border comes before those that make the two."""
        pair = (left, right)
        found = self._pairs.get(pair)
        if found is None:
            if len(self._pairs) > KEPT:
                self._pairs.clear()
            found = self._pairs[pair] = self._stay_apart(left, right)
        return found

    def _stay_apart(self, left: str, right: str) -> bool:
        if self._split(left) is None or self._split(right) is None:
            return False
        pieces, limit = self.pieces, float("inf")
        while True:
            joined = pieces.get(left + right)
            if joined is not None and -joined[1] < limit:
                return False
            made_left = -pieces[left][1] if len(left) > 1 else -1.0
            made_right = -pieces[right][1] if len(right) > 1 else -1.0
            if made_left > made_right:  # what stood at the border before the later of the two was made
                limit, left = made_left, self._split(left)[1]
            elif len(right) > 1:  # of merges that rank alike the leftmost comes first, which is the one across
                limit, right = made_right + 0.5, self._split(right)[0]
            else:
                return True

    def shortest_path(self, text: str) -> list[int]:
        """The ids on the least-weight path of this text's lattice."""
        return self._merge_path(text) if self.merges else self._least_path(text)

    def _fallback(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode()] if self.byte_ids else [self.unknown]

    def _least_path(self, text: str) -> list[int]:
        """Positions are settled from left to right by the arcs that end there; of paths that weigh alike, by the longest arc."""
        score, back = [0.0], [(-1, [])]  # of a path, the negative of its weight
        for end in range(1, len(text) + 1):
            best = None
            for start in range(max(0, end - self.longest), end):
                arc = self.pieces.get(text[start:end])
                if arc is not None:
                    total = _single(score[start] + arc[1])
                    if best is None or total > best[0]:
                        best = total, start, [arc[0]]
            if text[end - 1] not in self.pieces:
                total = _single(score[end - 1] + self.fallback)
                if best is None or total > best[0]:
                    best = total, end - 1, self._fallback(text[end - 1])
            score.append(best[0])
            back.append(best[1:])
        out, at = [], len(text)
        while at > 0:
            at, ids = back[at]
            out.append(ids)
        return [i for ids in reversed(out) for i in ids]

    def _merge_path(self, text: str) -> list[int]:
        """The same where arcs weigh nothing or cannot be taken.

        All finite paths to a position agree on their last piece, so that the first finite arc settles it, the
        longest piece first. What settles a position depends on the text before it alone, so that texts which
        begin alike share it.
        """
        pieces, ends = self.pieces, self._ends
        kept = len(text) <= LONGEST_KEPT
        last = [""]  # the piece on the path's last arc; none at the start and after bytes
        for end in range(1, len(text) + 1):
            found = ends.get(text[:end]) if kept else None
            if found is None:
                found = ""
                for start in range(max(0, end - self.longest), end):
                    piece = text[start:end]
                    if piece in pieces:
                        before = last[start]
                        if self._apart(before, piece) if before else self._split(piece) is not None:
                            found = piece
                            break
                if kept:
                    if len(ends) >= KEPT:
                        ends.clear()
                    ends[text[:end]] = found
            last.append(found)
        out, at = [], len(text)
        while at > 0:
            piece = last[at]
            out.append([pieces[piece][0]] if piece else self._fallback(text[at - 1]))
            at -= len(piece) or 1
        return [i for ids in reversed(out) for i in ids]

    def _parts(self, stretch: str) -> list[str]:
        """A stretch cut between characters that no piece has side by side: paths go through all of these points."""
        inside, out, start = self.inside, [], 0
        for at in range(1, len(stretch)):
            if stretch[at - 1 : at + 1] not in inside:
                out.append(stretch[start:at])
                start = at
        out.append(stretch[start:])
        return out

    def _ids(self, part: str) -> bytes:
        known = self._known
        ids = known.get(part)
        if ids is None:
            ids = np.array(self.shortest_path(part), "<u4").tobytes()
            if len(part) <= LONGEST_KEPT:
                if len(known) >= KEPT:
                    known.clear()
                known[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if self.merges:
            ids = self._by_stretch(text)
        else:  # sums run on through the whole text
            ids = np.array(self.shortest_path(self.normalise(text)), "<u4").tobytes()
        if self.byte_ids:
            return ids
        found = np.frombuffer(ids, "<u4")
        again = np.zeros(len(found), bool)
        again[1:] = (found[1:] == self.unknown) & (found[:-1] == self.unknown)
        return found[~again].tobytes()

    def _by_stretch(self, text: str) -> bytes:
        known, out = self._known, []
        for stretch in self._stretch.findall(self.normalise(text)):
            ids = known.get(stretch)
            if ids is None:
                parts = self._parts(stretch)
                ids = self._ids(stretch) if len(parts) == 1 else b"".join(map(self._ids, parts))
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.output.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def _single(x: float) -> float:
    return float(np.float32(x))


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffers message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield number, message[at : at + size]
        at += size


# Fixed values of the model format: messages, fields and kinds of pieces.
PIECE, TRAINER, NORMALISER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
MODEL_TYPE, MARK_BEHIND = 3, 24
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_EXTRA_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2


def parsed(model: bytes) -> Transducer:
    """The transducer of a SentencePiece model, by its own specification; what cannot be compiled raises."""
    pieces: dict[str, tuple[int, float]] = {}
    byte_ids: dict[int, int] = {}
    trainer, normaliser, unknown, number = {}, {}, 0, 0
    for field, value in _fields(model):
        if field == TRAINER:
            trainer = dict(_fields(value))
        elif field == NORMALISER:
            normaliser = dict(_fields(value))
        elif field == PIECE:
            piece = dict(_fields(value))
            text, kind = piece.get(PIECE_TEXT, b"").decode(), piece.get(PIECE_KIND, NORMAL)
            if kind == NORMAL:
                pieces[text] = number, struct.unpack("<f", piece.get(PIECE_SCORE, bytes(4)))[0]
            elif kind == BYTE:
                byte_ids[int(text[3:5], 16)] = number
            elif kind == UNKNOWN:
                unknown = number
            elif kind != CONTROL:
                raise ValueError(f"piece {text!r}: pieces of the user and pieces out of use are not compiled")
            number += 1
    kind = trainer.get(MODEL_TYPE, UNIGRAM)
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and merge models are compiled")
    if normaliser.get(CHARACTER_MAP):
        raise ValueError("the model rewrites characters by a table, which is not compiled")
    if not normaliser.get(ESCAPE_SPACES, 1) or trainer.get(MARK_BEHIND, 0):
        raise ValueError("spaces must become marks in front of words")
    return Transducer(
        pieces,
        [byte_ids[i] for i in range(256)] if byte_ids else None,
        merges=kind == BPE,
        dummy_prefix=bool(normaliser.get(DUMMY_PREFIX, 1)),
        unknown=unknown,
        extra_spaces=not normaliser.get(REMOVE_EXTRA_SPACES, 1),
    )


@functools.cache
def compiled(model_path: str) -> Transducer:
    """The transducer of a SentencePiece model file, once per worker."""
    with open(model_path, "rb") as file:  # on the executor's own disk, like the libraries that read it
        return parsed(file.read())


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _encode(model_path: str | None, batches: Iterator[list]) -> Iterator[list]:
    transducer = compiled(model_path or public_model())
    for keys, texts in batches:
        yield [keys, [np.frombuffer(transducer.encode(t.as_py() or ""), "<u4").astype(np.int32) for t in texts]]


def _digest(model_path: str | None, batches: Iterator[list]) -> Iterator[list]:
    transducer = compiled(model_path or public_model())
    for keys, texts in batches:
        rows = []
        for text in texts:
            text = text.as_py() or ""
            ids = transducer.encode(text)
            decoded = transducer.decode(ids)
            rows.append(
                (
                    len(ids) // 4,
                    zlib.crc32(ids),
                    hashlib.sha256(decoded.encode()).hexdigest(),
                    decoded == text.replace(MARK, " "),
                )
            )
        yield [keys, *(zip(*rows, strict=True) if rows else [[]] * 4)]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model_path: str | None = None) -> DataFrame:
    """key, ids per row. ``model_path``: a model file; by default the public one of the executor's machine."""
    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs.select(key, text), partial(_encode, model_path), f"`{key}` {kind}, ids array<int>")


def _decode(model_path: str | None, batches: Iterator[list]) -> Iterator[list]:
    transducer = compiled(model_path or public_model())
    for keys, ids in batches:
        yield [keys, [transducer.decode(np.array(i.as_py() or [], "<u4").tobytes()) for i in ids]]


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", model_path: str | None = None) -> DataFrame:
    """key, decoded per row of what :func:`encode` gives."""
    kind = encoded.schema[key].dataType.simpleString()
    return map_columns(encoded.select(key, ids), partial(_decode, model_path), f"`{key}` {kind}, decoded string")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", model_path: str | None = None) -> DataFrame:
    """key, n_pieces, ids_crc32, decoded_sha256 and whether decoding gives the text back, in one pass over the rows."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, round_trip boolean"
    return map_columns(docs.select(key, text), partial(_digest, model_path), schema)
