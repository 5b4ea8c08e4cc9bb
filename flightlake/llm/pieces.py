"""SentencePiece encoding and decoding: Viterbi over the matches of an Aho-Corasick automaton.

The automaton holds all pieces of the model.  One pass over a chunk of text reports, at
each position, every piece that ends there (the automaton follows its output links); each
relaxes the best score at that position.  A character that no piece covers costs a fixed
penalty and is written as its UTF-8 byte pieces.

Text is cut before each run of spaces.  No piece of such a model goes on past a space
marker that follows another character (checked when the model is read), so the best
segmentation of a text is the best of its chunks, one after the other.  Chunks repeat
much, so a task keeps those it has seen, at most CACHE of them.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = os.path.join("/opt/tokenizers", "piece_bpe_32k.model")
MARK = "▁"
CACHE = 1 << 18
_CHUNK = re.compile(r" *[^ ]+| +")


class Pieces:
    """Pieces and scores of a model whose byte pieces make every text encodable."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int]):
        """`byte_ids` names the piece of each of the 256 bytes; those and control pieces never match text."""
        skip = set(byte_ids)
        self.byte_ids = byte_ids
        self.bytes_of: list[bytes] = [p.replace(MARK, " ").encode() for p in pieces]
        for value, piece in enumerate(byte_ids):
            self.bytes_of[piece] = bytes([value])
        automaton = ahocorasick.Automaton()
        lowest = 0.0
        for i, piece in enumerate(pieces):
            if piece and i not in skip and np.isfinite(scores[i]):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} goes on past a space; chunks would not be independent")
                automaton.add_word(piece, (len(piece), scores[i], i))
                lowest = min(lowest, scores[i])
        if len(automaton):
            automaton.make_automaton()
        self.automaton = automaton
        self.missing = lowest - 10.0  # a byte piece is worse than any piece of text
        self._seen: dict[str, bytes] = {}

    def segment(self, chunk: str) -> list[int]:
        """Ids of the best segmentation of marked text; of equal scores the shortest last piece wins."""
        missing, nothing = self.missing, (0, 0.0, -1)
        best, back = [0.0], [nothing]  # of the positions that are final
        done, top, last = 0, -np.inf, nothing  # the position after those, as its matches relax it
        end_of_chunk = [(len(chunk), nothing)]
        for end, match in chain(self.automaton.iter(chunk) if len(self.automaton) else (), end_of_chunk):
            while done < end:  # every position before this match's end is final: fill gaps by bytes
                score = best[done] + missing
                if score > top:
                    top, last = score, nothing
                best.append(top)
                back.append(last)
                done += 1
                top, last = -np.inf, nothing
            length = match[0]
            if length:
                score = best[done + 1 - length] + match[1]
                if score > top or (score == top and length < last[0]):
                    top, last = score, match
        ids: list[int] = []
        at = len(chunk)
        while at > 0:
            length, _, piece = back[at]
            if length:
                ids.append(piece)
                at -= length
            else:
                at -= 1
                ids += [self.byte_ids[b] for b in reversed(chunk[at].encode("utf-8", "surrogatepass"))]
        ids.reverse()
        return ids

    def encode(self, text: str) -> array:
        """Ids of a text; a space is put before it, as the model was made."""
        seen, chunks, out = self._seen, _CHUNK.findall(" " + text), array("i")
        parts = list(map(seen.get, chunks))
        if None in parts:
            for i, ids in enumerate(parts):
                if ids is None and (ids := seen.get(chunks[i])) is None:
                    if len(seen) >= CACHE:
                        seen.clear()
                    ids = seen[chunks[i]] = array("i", self._chunk(chunks[i])).tobytes()
                parts[i] = ids
        out.frombytes(b"".join(parts))
        return out

    def _chunk(self, chunk: str) -> list[int]:
        if MARK not in chunk:
            return self.segment(chunk.replace(" ", MARK))
        # a marker that stands in the text itself is kept apart from a space: bytes
        ids: list[int] = []
        for part in re.split(f"({MARK})", chunk):
            if part == MARK:
                ids += [self.byte_ids[b] for b in MARK.encode()]
            elif part:
                ids += self.segment(part.replace(" ", MARK))
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        """The text again, without the space put before it."""
        table = self.bytes_of
        return b"".join(map(table.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


def read_model(path: str = MODEL) -> tuple[list[str], list[float], list[int]]:
    """Pieces, scores (minus infinity for control pieces) and byte pieces of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    off = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(n)]
    scores = [-np.inf if off[i] else model.get_score(i) for i in range(n)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return pieces, scores, byte_ids


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_chars, n_pieces, ids, text_sha256, decoded_sha256) for every row of `docs`.

    `ids` is the whole text's encoding; the digests are those of the text and of what
    the ids decode to, so equal digests are an exact round trip.  Null text counts as
    empty and has no ids.  Repeated rows come out as often as they went in; other columns
    are ignored; an empty table gives an empty result.  The model is read on the driver
    and travels with the tasks.
    """
    import hashlib

    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))
    names = ["doc_id", "n_chars", "n_pieces", "ids", "text_sha256", "decoded_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(*shared.value)
        for batch in batches:
            texts = batch.column("text")
            for at in range(0, batch.num_rows, 500):  # the ids of a few hundred texts at a time
                part = texts.slice(at, 500).to_pylist()
                ids = [pieces.encode(t) if t else array("i") for t in part]
                sizes = np.array([len(x) for x in ids], np.int64)
                flat = np.concatenate([np.frombuffer(x, np.int32) for x in ids]) if len(ids) else np.zeros(0, np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                back = [pieces.decode(x) if len(x) else "" for x in ids]
                digest = [[hashlib.sha256((t or "").encode()).hexdigest() for t in side] for side in (part, back)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, 500), pa.array([len(t or "") for t in part], pa.int64()),
                     pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array(digest[0]), pa.array(digest[1])], names=names)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n_chars long, n_pieces long, ids array<int>, text_sha256 string, decoded_sha256 string"
    return texts.mapInArrow(run, schema)
