"""SentencePiece (merge type) encoding and decoding by a table of each prefix's last token.

Two facts about merge-type encodings carry the method. A run of tokens inside an encoding is itself
the encoding of its own characters; and a token sequence is an encoding as soon as every two
neighbours, taken alone, are. So each prefix of a text has exactly one last token: the only piece
ending there that is compatible with the last token of the prefix before it. One pass with an
Aho-Corasick automaton offers the pieces that end at each character, a memoised test of the pair picks
the one that fits, and the ids are read off backwards from the last prefix.

Two neighbouring characters that no piece holds side by side always lie in different tokens. A text
therefore falls into segments that encode independently (cut before space marks, around line feeds and before
punctuation, as far as the model's pieces allow, which is worked out when it is loaded); segments repeat, so
their ids are kept in a bounded table per Python worker.

Null text counts as empty: no ids, empty decoded text. Very long texts need memory in proportion to the
text itself. Rows are independent, so ties, repeated rows, empty tables and further columns need no rule; a clash of
names is settled by the caller's choice of ``columns``.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ledgerline.llm.common import map_batches, on_change_of_owner, own_worker

SPACE = "▁"  # the space mark of the library
SEGMENTS_KEPT = 400_000  # segments in each of the two tables whose ids a worker keeps
PAIRS_KEPT = 500_000  # pairs whose compatibility a worker keeps
LONGEST_KEPT = 64  # characters of the longest segment that is kept


class PieceCodec:
    """Encoder and decoder of one merge-type model with byte fallback and identity normalisation."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(library.serialized_model_proto())
        spec, kinds = proto.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("a merge-type model with byte fallback is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("a model with identity normalisation is needed")
        if any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise ValueError("a model without user-defined pieces is needed")
        self.lead = SPACE if spec.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.rank = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.bytes_of_byte_id = {i: b for b, i in self.byte_ids.items()}
        self.pieces = [p.piece if p.type == kinds.NORMAL else "" for p in proto.pieces]
        self.special = {i: "" for i, p in enumerate(proto.pieces) if p.type == kinds.CONTROL}
        self.special |= {i: proto.trainer_spec.unk_surface for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN}
        self.raw = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for i, b in self.bytes_of_byte_id.items():
            self.raw[i] = bytes([b])
        self.number = [str(i) for i in range(len(proto.pieces))]
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:  # a piece that the merges never make ends no prefix
            if self.merge(piece) == [piece]:
                self.automaton.add_word(piece, (piece, len(piece)))
        self.automaton.make_automaton()
        self.segments = re.compile(_segment_pattern([p for p in self.ids if len(p) > 1])).findall
        self.fits = lru_cache(PAIRS_KEPT)(self._fits)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """The library's own rule: merge the best-scored neighbours, the leftmost of equals, to the end."""
        parts, nxt, prv = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if 0 <= i and nxt[i] < len(text) and (score := self.rank.get(parts[i] + parts[nxt[i]])) is not None:
                heapq.heappush(heap, (-score, i, parts[i] + parts[nxt[i]]))

        for i in range(len(text)):
            offer(i)
        while heap:
            _, i, made = heapq.heappop(heap)
            if not parts[i] or nxt[i] >= len(text) or parts[i] + parts[nxt[i]] != made:
                continue
            j = nxt[i]
            parts[i], parts[j], nxt[i] = made, "", nxt[j]
            if nxt[j] < len(text):
                prv[nxt[j]] = i
            offer(prv[i])
            offer(i)
        return [p for p in parts if p]

    def _fits(self, left: str, right: str) -> bool:
        """True if the two pieces, side by side, are the encoding of their characters."""
        return self.merge(left + right) == [left, right]

    def encode_segment(self, segment: str) -> list[int]:
        """Ids of one segment: the last token of each prefix forwards, then the ids backwards."""
        last = [""] + [None] * len(segment)
        fits = self.fits
        for at, (piece, size) in self.automaton.iter(segment):  # at each end the longest piece first
            if last[at + 1] is None:
                start = at + 1 - size
                if start and last[start] is None:  # no piece fits there: a character without a piece
                    last[start] = segment[start - 1]
                if not start or fits(last[start], piece):
                    last[at + 1] = piece
        found: list[int] = []
        end = len(segment)
        while end:
            piece = last[end] or segment[end - 1]
            own = self.ids.get(piece)
            if own is not None:
                found.append(own)
            else:
                found.extend([self.byte_ids[b] for b in reversed(piece.encode())])
            end -= len(piece)
        found.reverse()
        return found

    def _segment(self, segment: str) -> tuple[int, ...]:
        """Ids of a segment that isn't in the newer of the two tables; a full table becomes the older one."""
        ids = self.older.get(segment) or tuple(self.encode_segment(segment))
        if len(segment) <= LONGEST_KEPT:
            if len(self.known) >= SEGMENTS_KEPT:
                self.older, self.known = self.known, {}
            self.known[segment] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        segments = self.segments(self.lead + text.replace(" ", SPACE))
        found = list(map(self.known.get, segments))
        for k in [k for k, ids in enumerate(found) if ids is None]:
            found[k] = self.known.get(segments[k]) or self._segment(segments[k])
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, space marks as spaces, without the one the encoder put first."""
        if not self.special.keys().isdisjoint(ids):
            return self._decode_special(ids)
        raw = b"".join(map(self.raw.__getitem__, ids))
        if self.lead and ids and self.pieces[ids[0]].startswith(SPACE):
            raw = raw[1:]
        return _characters(raw)

    def _decode_special(self, ids: list[int]) -> str:
        """Ids among which are control or unknown ones, which end a run of bytes."""
        parts, run = [], b""
        for i in ids:
            if i in self.special:
                parts += [_characters(run), self.special[i]]
                run = b""
            else:
                run += self.raw[i]
        text = "".join([*parts, _characters(run)])
        first = next((i for i in ids if i not in self.special or self.special[i]), None)
        return text[1:] if self.lead and first is not None and self.pieces[first].startswith(SPACE) else text

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids in decimal joined by commas, SHA-256 of the decoded text)."""
        ids = self.encode(text)
        joined = ",".join(map(self.number.__getitem__, ids))
        return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest()


def _characters(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:  # bytes that make no character: one replacement character for each
        return raw.decode(errors="surrogateescape").translate({0xDC00 + b: 0xFFFD for b in range(128, 256)})


def _segment_pattern(pieces: list[str]) -> str:
    """A pattern of segments that encode independently: no piece holds the two characters around a cut.

    Cuts lie before a space mark, around a line feed, and between a word and one of the marks that no
    piece has behind a letter; the whole text is one segment where the model's pieces allow none.
    """
    pairs = {piece[i : i + 2] for piece in pieces for i in range(len(piece) - 1)}
    if any(b == SPACE and a != SPACE for a, b in pairs) or any("\n" in pair for pair in pairs):
        return "(?s).+"
    letter = re.compile(r"[^\W\d_]")
    joined = {b for a, b in pairs if letter.match(a)}
    marks = "".join(re.escape(c) for c in "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~" if c not in joined)
    return f"{SPACE}+[^\\W\\d_]++(?![^{SPACE}\n{marks}])|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n"


@lru_cache(2)
def codec(model_file: str) -> PieceCodec:
    """One codec per worker and model."""
    return PieceCodec(model_file)


on_change_of_owner(codec.cache_clear)


def encode(df: DataFrame, model_file: str, text_col: str = "text", columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``df`` and ``ids`` (array of int) of every whole text."""
    fields = [f for f in df.select(*[f"`{c}`" for c in columns]).schema.fields]
    schema = df.select(*[f"`{c}`" for c in columns]).schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("piece_codec")
        own = codec(model_file)
        for batch in batches:
            ids = pa.array([own.encode(t.as_py()) for t in batch.column(len(fields))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*columns, "ids"])

    return map_batches(df.select(*[f"`{c}`" for c in columns], F.col(f"`{text_col}`").cast("string").alias("__text")), run, schema)


def decode(df: DataFrame, model_file: str, ids_col: str = "ids", columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``df`` and the ``text`` that its ids stand for; null ids give an empty text."""
    schema = df.select(*[f"`{c}`" for c in columns]).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("piece_codec")
        own = codec(model_file)
        for batch in batches:
            text = pa.array([own.decode(i.as_py() or []) for i in batch.column(batch.num_columns - 1)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], text], [*columns, "text"])

    return map_batches(df.select(*[f"`{c}`" for c in columns], F.col(f"`{ids_col}`").alias("__ids")), run, schema)


def encode_digests(df: DataFrame, model_file: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256; encodes and decodes in one pass, rows never move."""
    schema = df.select(F.col(f"`{id_col}`").alias(id_col)).schema
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("piece_codec")
        own = codec(model_file)
        for batch in batches:
            rows = [own.digests(t.as_py()) for t in batch.column(1)]
            found = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], schema.names)

    return map_batches(df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("__text")), run, schema)
