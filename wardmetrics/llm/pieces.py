"""SentencePiece encoding and decoding with the place of every piece in the original bytes."""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardmetrics.llm.texts import per_block

# A task remembers the pieces of at most so many segments and so many characters of them, then starts anew: texts
# without spaces are one segment each.
REMEMBERED = 600_000
REMEMBERED_CHARACTERS = 16 << 20
_MARK = "▁"
_SEGMENT = re.compile("▁+[^▁]*|[^▁]+")


class CharacterMap:
    """The compiled character map of a model: a double-array trie over byte prefixes, and the texts it maps to.

    Layout (little-endian): byte length of the trie, its 32-bit units, then
    zero-ended replacement texts that the trie's values point into. Text is
    normalised from left to right: the longest prefix in the trie is replaced,
    otherwise one character is copied.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.texts = compiled[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, int]:
        """Length of the longest prefix at ``at`` and its value, or (0, -1)."""
        units, found = self.units, (0, -1)
        node = self._offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:  # the label of a leaf has its highest bit set and never fits
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    def apply(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end the original byte its stretch begins at."""
        if not self.units:
            return data, np.arange(len(data) + 1)
        out, place, at = bytearray(), [], 0
        while at < len(data):
            length, value = self.longest(data, at)
            if length:
                new = self.texts[value : self.texts.index(b"\0", value)]
            else:
                length = 1
                while at + length < len(data) and data[at + length] & 0xC0 == 0x80:
                    length += 1
                new = data[at : at + length]
            out += new
            place += [at] * len(new) if self.units and len(new) != length else range(at, at + length)
            at += length
        return bytes(out), np.array([*place, len(data)], np.int64)


class PieceModel:
    """A model file, loaded once in a task: encoding whole texts by segments, with spans, and decoding."""

    def __init__(self, serialized: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=serialized)
        spec = proto.ModelProto()
        spec.ParseFromString(serialized)
        rules = spec.normalizer_spec
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.trim, self.lead, self.mark = rules.remove_extra_whitespaces, rules.add_dummy_prefix, rules.escape_whitespaces
        suffix = spec.trainer_spec.treat_whitespace_as_suffix
        byte, own, unknown, kinds = 6, 4, 2, [p.type for p in spec.pieces]
        # Bytes of normalised text that a piece covers; 0: the unknown piece, whose length its text tells.
        self.width = np.array([1 if k == byte else 0 if k in (unknown, 3) else len(p.piece.encode()) for p, k in zip(spec.pieces, kinds)], np.int64)
        inner = any(_MARK in p.piece.lstrip(_MARK) for p, k in zip(spec.pieces, kinds) if k in (1, own))
        # Merges never reach over the border before a space mark if no piece does: then texts can be cut there.
        self.cuts = spec.trainer_spec.model_type == 2 and byte in kinds and self.lead and self.mark and not (self.trim or suffix or inner or rules.precompiled_charsmap or own in kinds)
        self._forget()

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes as the model sees them, with the original byte of each (one more entry than bytes)."""
        data = text.encode()
        if not data:
            return b"", np.zeros(1, np.int64)
        out, place = self.map.apply(data)
        raw = np.frombuffer(out, np.uint8)
        keep = np.ones(len(raw), bool)
        if self.trim:
            blank = raw == 0x20
            keep = ~(blank & np.concatenate(([True], blank[:-1])))
            if keep.any() and blank[np.flatnonzero(keep)[-1]]:
                keep[np.flatnonzero(keep)[-1]] = False
        raw, begin = raw[keep], place[:-1][keep]
        end = place[-1] if keep.all() or not len(begin) else int(place[np.flatnonzero(keep)[-1] + 1])
        if not len(raw):
            return b"", np.zeros(1, np.int64)
        if self.lead:
            raw, begin = np.concatenate(([np.uint8(0x20)], raw)), np.concatenate(([begin[0]], begin))
        if self.mark:
            blank = raw == 0x20
            size = np.where(blank, 3, 1)
            first = np.concatenate(([0], np.cumsum(size)))
            wide = np.repeat(raw, size)
            at = first[:-1][blank]
            wide[at], wide[at + 1], wide[at + 2] = 0xE2, 0x96, 0x81
            raw, begin = wide, np.repeat(begin, size)
        return raw.tobytes(), np.concatenate((begin, [end]))

    @staticmethod
    def segments(text: str) -> list[str]:
        """Stretches of the marked text that begin at a space mark, without that mark (the library puts it back)."""
        if not text:
            return []
        parts = text.replace(_MARK, " ").split(" ")
        if "" in parts:  # runs of spaces belong to the segment behind them
            parts = [s[1:] for s in _SEGMENT.findall(_MARK + text.replace(" ", _MARK))]
        return parts

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # number of a segment; its ids are flat[start:start + count]
        self.flat, self.start, self.count = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.held = 0  # characters of the known segments

    def _learn(self, fresh: list[str]) -> None:
        coded = [own if s else [self.processor.piece_to_id(_MARK)] for s, own in zip(fresh, self.processor.encode(fresh, num_threads=1))]
        count = np.fromiter(map(len, coded), np.int64, len(coded))
        self.held += sum(map(len, fresh))
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(count) - count))
        self.count = np.concatenate((self.count, count))
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(coded), np.int64, int(count.sum()))))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts as the library gives them, without begin and end; each new segment is encoded once."""
        if not self.cuts:
            return [np.array(i, np.int64) for i in self.processor.encode(texts, num_threads=1)]
        parts = [self.segments(t) for t in texts]
        needed = set().union(*parts)
        if len(self.known) + len(needed) > REMEMBERED or self.held > REMEMBERED_CHARACTERS:
            self._forget()
        self._learn(list(needed - self.known.keys()))
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64)
        count = self.count[number]
        upto = np.concatenate(([0], np.cumsum(count)))
        flat = self.flat[np.repeat(self.start[number] - upto[:-1], count) + np.arange(upto[-1])]
        edges = upto[list(accumulate(map(len, parts), initial=0))]
        return [flat[a:b] for a, b in zip(edges[:-1], edges[1:])]

    def spans(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Begin and end of each piece in the original bytes; pieces are laid end to end over the normalised text."""
        normal, place = self.normalise(text)
        width = self.width[ids]
        if (width == 0).any():
            for k, piece in enumerate(self.processor.encode(text, out_type=str)):
                width[k] = width[k] or len(piece.encode())
        edge = np.concatenate(([0], np.cumsum(width)))
        if edge[-1] != len(normal):
            raise ValueError(f"pieces cover {edge[-1]} bytes of {len(normal)}")
        return np.stack((place[edge[:-1]], place[edge[1:]]), axis=1)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids with begin and end, and spans; begin and end are empty spans at both ends of the text."""
        out, begin, end = [], self.processor.bos_id(), self.processor.eos_id()
        for text, own in zip(texts, self.ids(texts)):
            size = len(text.encode())
            spans = np.concatenate(([[0, 0]], self.spans(text, own).reshape(-1, 2), [[size, size]])).astype(np.int64)
            out.append((np.concatenate(([begin], own, [end])), spans))
        return out

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver (a vocabulary, of fixed size) and sent along with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encode_texts(docs: DataFrame, serialized: bytes, keep: list[str], text: str = "text", digests: bool = False) -> DataFrame:
    """``keep`` and for every whole text its ``ids``, ``begins`` and ``ends`` (original bytes) and ``decoded`` text.

    With ``digests`` the same is returned as ``n_tokens``, ``n_bytes``, and the
    SHA-256 of the ids (little-endian, 32 bits), of the spans (begin and end of
    each piece, likewise) and of the decoded text in UTF-8. A null text counts as
    empty: begin and end only, decoded as the empty text. Equal texts agree, a
    text of any length is encoded whole, and an empty table gives no rows.
    """
    model: list[PieceModel] = []

    def work(block):
        if not model:
            model.append(PieceModel(serialized))
        m = model[0]
        coded = [(ids, spans, m.decode(ids.tolist())) for ids, spans in m.encode([block.text(i).decode() for i in range(len(block))])]
        if not digests:
            return {
                "ids": pa.array([c[0] for c in coded], pa.list_(pa.int32())),
                "begins": pa.array([c[1][:, 0] for c in coded], pa.list_(pa.int64())),
                "ends": pa.array([c[1][:, 1] for c in coded], pa.list_(pa.int64())),
                "decoded": pa.array([c[2] for c in coded], pa.string()),
            }
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        return {
            "n_tokens": pa.array([len(c[0]) for c in coded], pa.int64()),
            "n_bytes": pa.array(block.sizes, pa.int64()),
            "ids_sha256": pa.array([sha(c[0].astype("<u4").tobytes()) for c in coded]),
            "spans_sha256": pa.array([sha(c[1].astype("<u4").tobytes()) for c in coded]),
            "decoded_sha256": pa.array([sha(c[2].encode()) for c in coded]),
        }

    schema = "n_tokens long, n_bytes long, ids_sha256 string, spans_sha256 string, decoded_sha256 string" if digests else "ids array<int>, begins array<long>, ends array<long>, decoded string"
    return per_block(docs, work, schema, keep, text)
