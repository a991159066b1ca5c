"""Token counts of whole texts by a BPE vocabulary, with overlapping chunks for texts of any length.

A long text is encoded in chunks that overlap, each a call of the library. A chunk starts at a boundary between two tokens of
the chunk before, well before that chunk's end, and token offsets say where the two encodings meet: at a token that covers the same
characters in both. The encodings are spliced there.

Why the splice is right: byte-pair merges are done in a fixed order of rank, then place. Tokens t1..tn are the encoding of
their text exactly if each neighbouring pair (ti, ti+1) is the encoding of its own text. (No merge of the whole crosses a boundary
before the best one that does; until then each pair has seen the same merges in the same order as by itself.) A token common to both
chunks has its left neighbour's pair proven by the left chunk and its right neighbour's by the right one, so every pair of the spliced
sequence is proven. Where the overlap holds no common token, it is doubled; where it reaches the chunk's start, the chunk is.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginbook.llm.frames import raw

#: Texts longer than this many characters are encoded in chunks.
CHUNK = 16_384
OVERLAP = 256
#: Ends the space that the library puts before a text: no piece holds it, so nothing merges across it.
GUARD = "\n"
BATCH_CHARACTERS = 4 << 20


class Encoder:
    """A sentencepiece BPE model with the characters that each of its tokens covers."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        self.width = np.zeros(size, np.int64)
        # A token that may be compared by its characters; parts of one character may not.
        self.whole = np.zeros(size, bool)
        scores = []
        for i in range(size):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                value = int(piece[3:5], 16)
                self.width[i] = value & 0xC0 != 0x80
                self.whole[i] = value < 0x80
            elif not (self.model.is_control(i) or self.model.is_unknown(i)):
                self.width[i], self.whole[i] = len(piece), True
                scores.append(self.model.get_score(i))
                if GUARD in piece:
                    raise ValueError("a piece of the model holds a line break, which guards the starts of chunks")
        if not self.width[[i for i in range(size) if self.model.is_byte(i)]].any():
            raise ValueError("the model has no pieces for bytes: runs of unknown characters would be one token")
        # Ranks, unlike the log probabilities of a unigram model; equal ranks go by place.
        if any(score != int(score) for score in scores):
            raise ValueError("the scores of the model's pieces are no ranks of merges: it is no BPE model")
        probe = " a\t b  ﬁ é "
        if self.model.normalize(probe) != "▁" + probe.replace(" ", "▁"):
            raise ValueError("the model changes characters before encoding, so offsets can't be followed")
        self.lead = len(self.model.encode(GUARD))

    def tokens(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the part from ``start`` to ``end``, encoded by itself, and the places where they begin."""
        if start == 0:
            ids = np.array(self.model.encode(text[:end]), np.int64)
            # The space put before the text is in front of its first character.
            places = np.cumsum(self.width[ids]) - self.width[ids] - 1
            places[0] = 0
            return ids, places
        ids = np.array(self.model.encode(GUARD + text[start:end])[self.lead:], np.int64)
        return ids, start + np.cumsum(self.width[ids]) - self.width[ids]

    def common(self, left: tuple, right: tuple) -> tuple[int, int] | None:
        """Positions in both of the first token that covers the same characters in both; not the very first of a text."""
        at_left = np.flatnonzero(self.whole[left[0]] & (left[1] >= right[1][0]) & (left[1] > 0))
        at_right = np.flatnonzero(self.whole[right[0]])
        _, i, j = np.intersect1d(left[1][at_left], right[1][at_right], assume_unique=True, return_indices=True)
        same = np.flatnonzero(left[0][at_left[i]] == right[0][at_right[j]])
        return (int(at_left[i[same[0]]]), int(at_right[j[same[0]]])) if len(same) else None

    def count_long(self, text: str, chunk: int, overlap: int) -> tuple[int, int]:
        """Tokens of a text encoded in chunks, and how often an overlap was widened."""
        done, widened, size = 0, 0, chunk
        start, end = 0, min(len(text), chunk)
        left = self.tokens(text, start, end)
        while end < len(text):
            back, joined = overlap, None
            while joined is None and back < end - start:
                # The last boundary at least so far back; the first token of the chunk is no boundary to start from.
                begin = int(np.searchsorted(left[1], end - back, side="right")) - 1
                while begin > 0 and not self.whole[left[0][begin]]:
                    begin -= 1
                if begin <= 0 or left[1][begin] <= start:
                    break
                place = int(left[1][begin])
                stop = min(len(text), end + size)
                right = self.tokens(text, place, stop)
                joined = self.common(left, right)
                if joined is None:
                    widened, back = widened + 1, 2 * back
            if joined is None:
                widened, size = widened + 1, 2 * (end - start)
                end = min(len(text), start + size)
                left = self.tokens(text, start, end)
                continue
            done += joined[0]
            left = right[0][joined[1]:], right[1][joined[1]:]
            start, end, size = int(left[1][0]), stop, chunk
        return done + len(left[0]), widened


def _count(model: bytes, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            held, total = [], 0
            sizes, counts, widened = [], np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)

            def settle():
                for i, ids in zip((i for i, _ in held), encoder.model.encode([t for _, t in held], num_threads=1), strict=True):
                    counts[i] = len(ids)
                held.clear()

            for i, text in enumerate(raw(batch.column(batch.schema.get_field_index("_text")))):
                sizes.append(len(text or b""))
                text = (text or b"").decode()
                if len(text) > chunk:
                    counts[i], widened[i] = encoder.count_long(text, chunk, overlap)
                    continue
                held.append((i, text))
                total += len(text)
                if total > BATCH_CHARACTERS:
                    settle()
                    total = 0
            settle()
            columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "_text"]
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(counts), pa.array(widened)],
                                             names=[*names, "n_bytes", "n_tokens", "n_widened"])
    return run


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", limit: int = 4096, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """``docs`` without its text, with ``n_bytes`` (UTF-8), ``n_tokens``, ``n_widened`` (overlaps widened) and ``over_limit``.

    ``model_path`` is a sentencepiece BPE model that leaves characters as they are; its bytes (under a megabyte) travel with the tasks.
    Counts are those of the library over the whole text, without begin, end or added tokens; names of special tokens in a text are
    ordinary text. A null text is empty and has 0 tokens. Rows are counted one by one, so repeated rows and null ids stay
    as they are; an empty table gives an empty result; columns of ``docs`` named like the added ones are replaced.

    No shuffle: memory is a text, its chunk and a batch of short texts. A lost task is run again from its input.
    """
    if chunk < 1 or overlap < 1:
        raise ValueError("chunk and overlap are at least one character")
    model = Path(model_path).read_bytes()
    added = ["n_bytes", "n_tokens", "n_widened", "over_limit"]
    kept = [c for c in docs.columns if c not in (*added, text)]
    rows = docs.select(*kept, F.col(text).cast("string").alias("_text"))
    schema = T.StructType([*rows.drop("_text").schema.fields, *[T.StructField(n, T.LongType()) for n in added[:3]]])
    return rows.mapInArrow(_count(model, chunk, overlap), schema).withColumn("over_limit", F.col("n_tokens") > limit)
