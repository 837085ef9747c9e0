"""Fill-in-middle: texts cut into prefix, middle and suffix, which are written out of order.

Cuts fall between tokens and are needed twice, as bytes of the UTF-8 text (to
slice it) and as code points (to report them). A sparse exception index joins
the two: it holds only the multibyte characters, their positions and the bytes
by which they and those before exceed one a character. Between two exceptions
a position differs by a constant, so an ASCII span is plain arithmetic and one
``searchsorted`` over the exceptions converts any number of cuts.

Defined results: null text counts as empty, and an empty text stays plain; a
null doc_id draws its numbers from the bare seed; each row is cut by itself,
repeated or not; an empty table gives an empty result; extra columns are
ignored; a text of any length is cut whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import batches, map_arrow, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, those that are transformed, and of these those with the suffix first.
RATE, SPM_RATE = 90, 20
SEED = "1"


@dataclass(frozen=True)
class ExceptionIndex:
    """Multibyte characters of UTF-8 bytes: where they start (byte and code point), where
    they end, and the excess bytes up to and with each."""

    starts: np.ndarray
    points: np.ndarray
    ends: np.ndarray
    excess: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> ExceptionIndex:
        starts = np.flatnonzero(data >= 0xC0)
        lead = data[starts]
        over = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        excess = np.cumsum(over)
        return cls(starts, starts - (excess - over), starts + over + 1, excess)

    def _before(self, k: np.ndarray) -> np.ndarray:
        """Excess bytes of the first k exceptions."""
        return np.concatenate([[0], self.excess])[k]

    def to_points(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before byte positions, which lie between characters."""
        return cuts - self._before(np.searchsorted(self.ends, cuts, side="right"))

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Byte positions of code-point positions."""
        return cuts + self._before(np.searchsorted(self.points, cuts, side="left"))


def token_starts(data: np.ndarray, points: ExceptionIndex) -> np.ndarray:
    """Code-point positions where tokens ``[A-Za-z]+|[^A-Za-z]`` of UTF-8 bytes start."""
    letter = ((data | 0x20) - 0x61).astype(np.uint8) < 26
    opens = (data & 0xC0) != 0x80            # first byte of a character
    opens[1:] &= ~(letter[1:] & letter[:-1])
    return points.to_points(np.flatnonzero(opens))


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """Four unsigned 32-bit numbers from the seed and the document's id."""
    made = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(made[k: k + 4], "big") for k in range(0, 16, 4)]


def transform(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Per row: doc_id, n (tokens), form (plain, psm, spm), prefix_chars and middle_chars
    (code points; null if plain) and output, the text as it is trained on."""
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def cut(doc_id: int | None, text: bytes) -> tuple[int, str, int | None, int | None, bytes]:
        data = np.frombuffer(text, np.uint8)
        index = ExceptionIndex.of(data)
        starts = token_starts(data, index)
        n = len(starts)
        h1, h2, h3, h4 = draws(doc_id, seed)
        if not text or h3 % 100 >= rate or any(m in text for m in marks):
            return n, "plain", None, None, text
        end = int(index.to_points(np.array([len(data)]))[0])
        points = np.append(starts, end)[sorted((h1 % (n + 1), h2 % (n + 1)))]
        a, b = index.to_bytes(points).tolist()
        form = "spm" if h4 % 100 < spm_rate else "psm"
        before, after = marks[0] + text[:a], marks[1] + text[b:]
        output = (after + before if form == "spm" else before + after) + marks[2] + text[a:b]
        return n, form, int(points[0]), int(points[1] - points[0]), output

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            ids = batch.column("doc_id").to_pylist()
            n, form, prefix, middle, output = zip(*map(cut, ids, text_bytes(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text, from the output and its form alone: a text that was cut holds no marks,
    so the marks of its output are the three that were put in."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    in_turn = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    turned = [F.when(form == f, F.concat(*[F.get(part, k) for k in order])) for f, order in in_turn.items()]
    return F.coalesce(*turned, output)


def digests(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """What was cut, and digests of the output and of the text restored from it."""
    return transform(docs, seed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
