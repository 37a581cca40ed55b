"""Harmonic packing of tokenised documents into training sequences.

A document is cut into pieces whose lengths are the reciprocal-capacity sizes
`capacity // j`: the largest that fits, then the largest that fits the rest.
Class j takes j pieces to a sequence, so a sequence of it is full but for fewer
than j tokens. What is left of a document under `capacity // CLASSES` tokens is
the last class; like the unfilled bins of all classes at the end of a worker's
rows, it is filled in order and cut where a sequence ends. A worker's very last
sequence is cut into powers of two, which need no padding. Every worker packs
its own rows, so nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tables import small_batches

CAPACITY = 2048
#: Pieces shorter than `CAPACITY // CLASSES` are filled in order.
CLASSES = 32
END_OF_TEXT = 1
TOKENIZER = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
WORKER_BITS = 36

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "class_pieces int, ids array<int>"
)

Encode = Callable[[str], np.ndarray]


def encoder(name: str = TOKENIZER, folder: str | None = None) -> Encode:
    """Text to ids of a public byte-level vocabulary.

    The rank file and the tokenizer file hold the same vocabulary, and the rank
    form is several times faster. Texts that spell a special token, and texts
    that the fast form refuses, go through the tokenizer file itself.
    """
    import base64
    import os

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    def path(file: str) -> str:
        return os.path.join(folder, file) if folder else public_tokenizers.path(file)

    with open(path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow: list[Tokenizer] = []

    def by_file(text: str) -> np.ndarray:
        if not slow:
            slow.append(Tokenizer.from_file(path(f"{name}.json")))
        return np.asarray(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            return by_file(text)
        try:
            return np.asarray(fast.encode_ordinary(text), dtype=np.uint32)
        except Exception:  # noqa: BLE001  the pattern engine gives up on some very long runs
            return by_file(text)

    return encode


def cuts(tokens: int, capacity: int = CAPACITY, classes: int = CLASSES) -> tuple[list[int], int]:
    """Class (pieces per sequence) of each piece from the front, and the length of the rest."""
    found = []
    while tokens >= capacity // classes and tokens:
        pieces = -(-capacity // tokens) if tokens < capacity else 1
        found.append(pieces)
        tokens -= capacity // pieces
    return found, tokens


class Worker:
    """The open bins of one worker; `add` gives the pieces of sequences that are full."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, classes: int = CLASSES):
        self.capacity, self.classes, self.next = capacity, classes, first_sequence
        self.open: dict[int, list[tuple]] = {}
        self.tail: list[tuple] = []
        self.tail_length = 0

    def _close(self, pieces: list[tuple], kind: int) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, ids, total, self.next, offset, kind
            offset += len(ids)
        self.next += 1

    def _fill(self, piece: tuple) -> Iterator[tuple]:
        doc, start, ids, total = piece
        while len(ids):
            room = self.capacity - self.tail_length
            part = ids[:room]
            self.tail.append((doc, start, part, total))
            self.tail_length += len(part)
            start, ids = start + len(part), ids[room:]
            if self.tail_length == self.capacity:
                full, self.tail, self.tail_length = self.tail, [], 0
                yield from self._close(full, 0)

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[tuple]:
        kinds, _ = cuts(len(ids), self.capacity, self.classes)
        start = 0
        for kind in kinds:
            stop = start + self.capacity // kind
            bin_ = self.open.setdefault(kind, [])
            bin_.append((doc, start, ids[start:stop], len(ids)))
            if len(bin_) == kind:
                yield from self._close(self.open.pop(kind), kind)
            start = stop
        if start < len(ids):
            yield from self._fill((doc, start, ids[start:], len(ids)))

    def finish(self) -> Iterator[tuple]:
        for kind in sorted(self.open):
            for piece in self.open[kind]:
                yield from self._fill(piece)
        self.open = {}
        left, size = self.tail, self.capacity
        while left:
            total = sum(len(p[2]) for p in left)
            while size > total:
                size //= 2
            taken, room, rest = [], size, []
            for doc, start, ids, whole in left:
                if room:
                    taken.append((doc, start, ids[:room], whole))
                    ids, start, room = ids[room:], start + min(room, len(ids)), room - min(room, len(ids))
                if len(ids):
                    rest.append((doc, start, ids, whole))
            yield from self._close(taken, 0)
            left = rest
        self.tail, self.tail_length = [], 0


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    classes: int = CLASSES,
    end_id: int = END_OF_TEXT,
    tokenizer: str = TOKENIZER,
    folder: str | None = None,
) -> DataFrame:
    """One row per piece: where it comes from, its ids, and its place in a sequence.

    NULL and empty texts give the end token alone. Repeated rows are packed each
    for itself; a NULL id stays NULL. Other columns are not looked at. An empty
    table gives no rows. A worker holds at most one open bin per class.
    """
    if not 0 < classes <= capacity or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two and not under the number of classes")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, folder)
        worker = Worker(TaskContext.get().partitionId() << WORKER_BITS, capacity, classes)
        for batch in source:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                rows += worker.add(doc, ids)
            if rows:
                yield as_batch(rows)
        if rows := list(worker.finish()):
            yield as_batch(rows)

    return small_batches(docs).select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(batches, SCHEMA)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, ids, total, sequence, offset, kind = zip(*rows, strict=True)
    lengths = [len(x) for x in ids]
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    flat = np.concatenate(ids).astype(np.int32)
    arrays = [
        pa.array(doc, pa.int64()),
        pa.array(start, pa.int64()),
        pa.array(lengths, pa.int64()),
        pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
        pa.array(total, pa.int64()),
        pa.array(sequence, pa.int64()),
        pa.array(offset, pa.int64()),
        pa.array(kind, pa.int32()),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
    ]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class_pieces", "ids"]
    return pa.RecordBatch.from_arrays(arrays, names=names)
