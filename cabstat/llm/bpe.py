"""Byte-level BPE through a sentencepiece model written straight from the vocabulary.

A rank file's tokens become sentencepiece BPE pieces: every byte is mapped to
one printable character, a piece's score is its negative rank and the
normaliser is the identity. Sentencepiece merges the best-scored neighbouring
pair first, leftmost on ties, which is the rank order. Each pre-token is
encoded by itself; ids map back to bytes by the inverse table.

Defined results: null text counts as empty (no ids); an empty table gives an
empty result; a row gives a row, repeated or not; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import batches, map_arrow

#: Distinct pre-tokens a worker remembers; beyond it the memory starts afresh.
REMEMBERED = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def byte_map() -> dict[int, str]:
    """One printable character for every byte: itself where printable in Latin-1,
    else the next free character from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model; ids are the ranks, one more id is unknown."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    chars, proto = byte_map(), pb.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = proto.pieces.add()
        piece.piece, piece.score = "".join(chars[b] for b in token), -float(rank)
        piece.type = pb.ModelProto.SentencePiece.NORMAL
    unknown = proto.pieces.add()
    unknown.piece, unknown.score, unknown.type = "<unk>", 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    spec = proto.trainer_spec
    spec.model_type, spec.vocab_size = pb.TrainerSpec.BPE, len(proto.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(ranks), -1, -1, -1
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = False
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.normalizer_spec.escape_whitespaces = False
    return proto.SerializeToString()


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: bytes, pieces: list[bytes], pattern: str, ascii_pattern: str | None):
        import regex
        import sentencepiece

        self.split = regex.compile(pattern).findall
        self.split_ascii = re.compile(ascii_pattern, re.ASCII).findall if ascii_pattern else self.split
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chars = byte_map()
        self.pieces = pieces
        self.known: dict[str, bytes] = {}

    def pretokens(self, text: str) -> list[str]:
        return (self.split_ascii if text.isascii() else self.split)(text)

    def _mapped(self, token: str) -> str:
        return token.encode().decode("latin-1").translate(self.chars)

    def learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(tokens)
        for token, ids in zip(new, self.model.encode([self._mapped(t) for t in new], out_type=int, num_threads=1)):
            self.known[token] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        cut = [self.pretokens(t) for t in texts]
        self.learn(set().union(*cut) if cut else set())
        return [b"".join(map(self.known.__getitem__, tokens)) for tokens in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def ascii_form(pattern: str) -> str | None:
    """The pattern for texts of ASCII characters only, which need no property classes.

    In ASCII the letters, digits and white space are these fixed classes.
    """
    out = (pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\x09-\x0D\x20A-Za-z0-9]")
           .replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
           .replace(r"\S", r"[^\x09-\x0D\x20]").replace(r"\s", r"[\x09-\x0D\x20]"))
    return None if r"\p" in out else out


def unicode_form(pattern: str) -> str:
    """White space as the property White_Space, whatever the library takes for \\s."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(
        r"\s", r"\p{White_Space}")


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, position: Column | None = None) -> DataFrame:
    """Per row: doc_id, ids (binary, little-endian unsigned 32-bit), decoded (binary),
    and, if given, position; the text itself is read whole."""
    ranks = read_ranks(ranks_path)
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((sentencepiece_model(ranks), sorted(ranks, key=ranks.get)))  # the size of the vocabulary
    wide, narrow = unicode_form(pattern), ascii_form(pattern)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value, wide, narrow)
        for batch in batches(stream):
            ids = codec.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()),
                 pa.array([codec.decode(x) for x in ids], pa.binary()), *[batch.column(c) for c in more]],
                ["doc_id", "ids", "decoded", *more])

    more = [] if position is None else ["position"]
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                                 *([] if position is None else [position.cast("long").alias("position")])),
                     run, ", ".join(["doc_id long, ids binary, decoded binary", *(f"{c} long" for c in more)]))


def digests(docs: DataFrame, ranks_path: str, pattern: str, position: Column | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if given, position."""
    coded = encode_decode(docs, ranks_path, pattern, position)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
                        *([] if position is None else ["position"]))
