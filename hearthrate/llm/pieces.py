"""SentencePiece encoding with source offsets, and decoding.

A text is normalised by the model's compiled character map: at each place the
longest prefix in the map is replaced, anything else is copied, and for every
byte of the result the source byte it came from is recorded. Pieces tile the
normalised text, so each piece is projected to a span of source bytes.

No piece of the supported models joins a letter to a following space mark, so
merges never cross the start of a run of marks. A text is therefore encoded in
units of marks and what follows, and a unit seen before is looked up.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T
from sentencepiece import sentencepiece_model_pb2 as proto
from xxhash import xxh3_64_intdigest

from hearthrate.llm.batches import append, slices, with_names
from hearthrate.llm.words import hash_spans

MARK = "▁"
_MARK = MARK.encode()
_UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
# Units remembered by a task before it starts anew; bounds its memory.
_KNOWN_UNITS = 100_000


class CharacterMap:
    """A compiled map of byte strings: a double-array trie over the keys and their replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], dtype="<u4").tolist()
        self.strings = blob[4 + size:]

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key at ``start``."""
        shift = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        node, found = shift(self.units[0]), None
        for end in range(start, len(text)):
            node ^= text[end]
            unit = self.units[node] if node < len(self.units) else 0
            if unit & 0x800000FF != text[end]:
                break
            node ^= shift(unit)
            if unit & 0x100:
                found = end + 1 - start, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1]:self.strings.index(b"\0", found[1])]


@dataclass
class Encoded:
    """Ids of some texts, each piece's span of source bytes, and where each text's ids begin."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    cuts: np.ndarray


class Codec:
    """One model: normalisation, encoding, spans and decoding of single texts."""

    def __init__(self, model: bytes):
        spec = proto.ModelProto.FromString(model)
        normal, kinds = spec.normalizer_spec, proto.ModelProto.SentencePiece
        if not spec.trainer_spec.byte_fallback or spec.trainer_spec.treat_whitespace_as_suffix or not normal.escape_whitespaces:
            raise ValueError("the model must have byte fallback and escaped, leading white space")
        crossing = re.compile(f"[^{MARK}]{MARK}")
        if any(crossing.search(p.piece) or p.type == kinds.USER_DEFINED for p in spec.pieces):
            raise ValueError("pieces that cross a space mark or are set by the user are not supported")
        self.prefix, self.squeeze = normal.add_dummy_prefix, normal.remove_extra_whitespaces
        self.map = CharacterMap(normal.precompiled_charsmap)
        self.lengths = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in spec.pieces], dtype=np.int64)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        # Units are given to the library as they are: its own normalisation is switched off.
        normal.precompiled_charsmap, normal.add_dummy_prefix, normal.remove_extra_whitespaces = b"", False, False
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.forget()

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text; for each of its bytes, and its end, the source byte."""
        source = text.encode("utf-8", "replace")
        if not source:
            return "", np.zeros(1, dtype=np.int64)
        if not self.map and not self.squeeze:
            raw = np.frombuffer(source, dtype=np.uint8)
            align = np.repeat(np.arange(len(raw)), np.where(raw == 0x20, 3, 1))
            head = [np.zeros(3, dtype=np.int64)] if self.prefix else []
            return MARK * self.prefix + text.replace(" ", MARK), np.concatenate([*head, align, [len(raw)]])
        parts = list(self._replaced(source))
        if self.squeeze:
            parts = self._squeezed(parts)
        if not parts:
            return "", np.zeros(1, dtype=np.int64)
        out, align = bytearray(), []
        if self.prefix:
            out += _MARK
            align += [parts[0][1]] * len(_MARK)
        for piece, start, _ in parts:
            piece = piece.replace(b" ", _MARK)
            out += piece
            align += [start] * len(piece)
        return out.decode(), np.array([*align, parts[-1][2]], dtype=np.int64)

    def _replaced(self, source: bytes) -> Iterator[tuple[bytes, int, int]]:
        at = 0
        while at < len(source):
            hit = self.map.longest(source, at) if self.map else None
            first = source[at]
            wide = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
            length, out = hit or (wide, source[at:at + wide])
            yield out, at, at + length
            at += length

    @staticmethod
    def _squeezed(parts: list[tuple[bytes, int, int]]) -> list[tuple[bytes, int, int]]:
        """Without leading, trailing and repeated spaces; each part keeps its source."""
        kept, blank = [], True
        for out, start, end in parts:
            if blank:
                out = out.lstrip(b" ")
            if out:
                kept.append((out, start, end))
                blank = out.endswith(b" ")
        while kept and kept[-1][0].endswith((b" ", _MARK)):
            out, start, end = kept.pop()
            if out := out.removesuffix(b" ").removesuffix(_MARK):
                kept.append((out, start, end))
        return kept

    def forget(self) -> None:
        """Forget the units seen; a worker that is used again starts its next task without them."""
        self.known: dict[int, int] = {}
        self.flat, self.bounds = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _ids(self, keys: np.ndarray, spell: Callable[[int], str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units given by their hashes, one after the other, and how many each has.

        ``spell`` gives the text of the unit at a place; it is asked for new units only.
        """
        if len(self.known) > _KNOWN_UNITS:
            self.forget()
        known = self.known
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        names = distinct.tolist()
        fresh = [k for k, name in enumerate(names) if name not in known]
        if fresh:
            coded = self.merges.encode([spell(int(first[k])) for k in fresh], num_threads=1)
            known.update(zip([names[k] for k in fresh], range(len(known), len(known) + len(fresh))))
            sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(coded), dtype=np.int32, count=sizes.sum())])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        at = np.fromiter(map(known.__getitem__, names), dtype=np.int64, count=len(names))[back]
        start, counts = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        before = np.cumsum(counts) - counts
        return self.flat[np.repeat(start - before, counts) + np.arange(counts.sum())], counts

    def encode(self, texts: list[str]) -> Encoded:
        """Ids of all texts; an identity map is applied to all bytes at once, others text by text."""
        raw = [text.encode("utf-8", "replace") for text in texts]
        if self.map or self.squeeze or any(_MARK in r for r in raw):
            return self._encode_each(texts)
        head = b" " if self.prefix else b""
        joined = b"".join(head + r if r else r for r in raw)
        data = np.frombuffer(joined, dtype=np.uint8)
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        heads = np.where(sizes > 0, len(head), 0)
        offsets = np.concatenate([[0], np.cumsum(sizes + heads)])
        blank = data == 0x20
        opens = blank.copy()
        opens[1:] &= ~blank[:-1]
        opens[offsets[:-1][sizes > 0]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(data))[:len(starts)]
        ids, counts = self._ids(hash_spans(data, starts, ends), lambda k: joined[starts[k]:ends[k]].decode().replace(" ", MARK))
        per_unit = np.concatenate([[0], np.cumsum(counts)])
        cuts = per_unit[np.searchsorted(starts, offsets)]
        source = np.arange(len(data)) - np.repeat(offsets[:-1] + heads, sizes + heads)
        align = np.repeat(np.maximum(source, 0), np.where(blank, len(_MARK), 1))
        ends = np.cumsum(self.lengths[ids])
        if len(ids) and ends[-1] != len(align):
            raise ValueError("pieces do not tile the normalised text")
        first = align[ends - self.lengths[ids]].astype(np.int32)
        last = np.append(first[1:], 0)[:len(first)]
        filled = np.diff(cuts) > 0
        last[cuts[1:][filled] - 1] = sizes[filled]
        return Encoded(ids, first, last.astype(np.int32), cuts)

    def _encode_each(self, texts: list[str]) -> Encoded:
        parts, cuts = [], [0]
        for text in texts:
            normal, align = self.normalise(text)
            units = _UNIT.findall(normal)
            keys = np.fromiter((xxh3_64_intdigest(u.encode()) for u in units), dtype=np.uint64, count=len(units))
            ids, _ = self._ids(keys, lambda k: units[k])
            ends = np.cumsum(self.lengths[ids])
            if len(ends) and ends[-1] != len(align) - 1:
                raise ValueError("pieces do not tile the normalised text")
            parts.append((ids, align[ends - self.lengths[ids]], align[ends]))
            cuts.append(cuts[-1] + len(ids))
        joined = [np.concatenate([p[k] for p in parts] or [[]]).astype(np.int32) for k in range(3)]
        return Encoded(*joined, np.array(cuts))

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


@lru_cache(maxsize=1)
def _codec(model: bytes) -> Codec:
    """One codec for all tasks of a Python worker."""
    return Codec(model)


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_pieces(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """Add ``ids``, ``piece_starts``, ``piece_ends`` and ``decoded`` to every row of ``docs``.

    ``model`` is the content of the model file, some hundred kilobytes, sent with
    the task. Null and empty texts have no ids and decode to an empty text. A
    column of ``docs`` with one of the four names is replaced. Rows keep their
    columns and number; repeated rows are encoded each. There is no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in slices(batches, text):
            coded = codec.encode([value or "" for value in batch.column(text).to_pylist()])
            decoded = [codec.decode(coded.ids[i:j]) for i, j in zip(coded.cuts[:-1], coded.cuts[1:])]
            lists = [pa.ListArray.from_arrays(coded.cuts.astype(np.int32), pa.array(v)) for v in (coded.ids, coded.starts, coded.ends)]
            yield append(batch, **dict(zip(("ids", "piece_starts", "piece_ends"), lists)), decoded=pa.array(decoded, pa.string()))
        codec.forget()

    numbers = T.ArrayType(T.IntegerType(), False)
    added = {"ids": numbers, "piece_starts": numbers, "piece_ends": numbers, "decoded": T.StringType()}
    base = docs.drop(*added)
    return base.mapInArrow(run, with_names(base, added))
