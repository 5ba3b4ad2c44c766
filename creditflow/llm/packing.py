"""Vector bin packing of token examples into sequences, under three limits at once.

An example asks for tokens, one segment and loss-bearing tokens (those behind its
prompt).  A sequence is filled by the dot-product rule: of the waiting examples
that fit whole, the one whose demand has the largest product with what is left
of the limits, each in shares of its limit.  What no whole example fills, a cut
one does, so a sequence ends short only at a limit of segments or loss-bearing
tokens, or when nothing waits.  Examples over a whole sequence are cut first.

Each scan partition packs its own documents in one pass, with at most ``WAITING``
examples in memory; no text is shuffled.  The one short sequence that a partition
may end with is packed again together with those of ``LOT`` partitions.  Given
the same input splits, a repeated task packs alike.

Defined results: a null or empty text is an example of the end id alone.  Every
row is an example, also with a null or repeated doc_id.  Other columns are
ignored.  An empty table gives an empty result.  Very long texts are encoded and
cut as a whole, one at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm.cuts import Cuts
from creditflow.llm.word_ids import worker_ids

LIMITS = (2048, 256, 2048)  # tokens, segments, loss-bearing tokens
END = 1
WAITING = 512
LOT = 256
OUT_ROWS = 8192
_ID = np.dtype("<u4")


class Packer:
    """Fills one sequence after the other from a bounded pool of waiting examples.

    ``out`` gets (sequence, offset, tag, start, length, loss, ids) of each piece.
    A tag goes with an example's pieces; ``start`` counts from the example's first id.
    """

    def __init__(self, limits: tuple[int, int, int], out: Callable, waiting: int = WAITING):
        self.limits, self.out, self.sequence = np.array(limits, np.int64), out, 0
        self.need = np.zeros((waiting, 3), np.int64)
        self.held: list = [None] * waiting  # tag, ids, start, free: ids from ``start`` on wait; the first ``free`` ids carry no loss
        self.free_slots = list(range(waiting))

    @staticmethod
    def _loss(start: int, end: int, free: int) -> int:
        return max(0, end - max(start, free))

    def _prefix(self, start: int, end: int, free: int, tokens: int, loss: int) -> int:
        """Longest prefix of [start, end) within the tokens and loss-bearing tokens left."""
        return min(end - start, tokens, max(0, free - start) + loss)

    def _wait(self, tag, ids: np.ndarray, start: int, free: int) -> None:
        slot = self.free_slots.pop()
        self.held[slot] = (tag, ids, start, free)
        self.need[slot] = len(ids) - start, 1, self._loss(start, len(ids), free)

    def add(self, tag, ids: np.ndarray, free: int = 0) -> None:
        start, (tokens, _, loss) = 0, self.limits
        while len(ids) - start > tokens or self._loss(start, len(ids), free) > loss:
            n = self._prefix(start, len(ids), free, tokens, loss)
            if n < tokens:
                break  # loss-bound: others without loss may still fill it up
            self.out(self.sequence, 0, tag, start, n, self._loss(start, start + n, free), ids[start:start + n])
            self.sequence, start = self.sequence + 1, start + n
        if start == len(ids):
            return
        if not self.free_slots:
            self._fill()
        self._wait(tag, ids, start, free)

    def finish(self) -> int:
        """Fills sequences until nothing waits; the last one's number."""
        while len(self.free_slots) < len(self.held):
            self._fill()
        return self.sequence - 1

    def _place(self, slot: int, n: int, offset: int) -> np.ndarray:
        tag, ids, start, free = self.held[slot]
        loss = self._loss(start, start + n, free)
        self.out(self.sequence, offset, tag, start, n, loss, ids[start:start + n])
        if start + n < len(ids):
            self.held[slot] = (tag, ids, start + n, free)
            self.need[slot] = len(ids) - start - n, 1, self._loss(start + n, len(ids), free)
        else:
            self.held[slot] = None
            self.need[slot] = 0
            self.free_slots.append(slot)
        return np.array([n, 1, loss], np.int64)

    def _fill(self) -> None:
        left, offset = self.limits.copy(), 0
        weights = 1.0 / self.limits.astype(float) ** 2
        while left[0] and left[1]:
            fits = (self.need[:, 0] > 0) & (self.need <= left).all(1)
            if fits.any():
                slot = int(np.argmax(np.where(fits, self.need @ (left * weights), -1.0)))
                n = int(self.need[slot, 0])
            else:
                slot, n = -1, 0
                for s in np.argsort(-self.need[:, 0], kind="stable")[:8].tolist():  # the largest ones; cut where most of it fits
                    if self.held[s] is not None:
                        _, ids, start, free = self.held[s]
                        m = self._prefix(start, len(ids), free, int(left[0]), int(left[2]))
                        slot, n = (s, m) if m > n else (slot, n)
                if not n:
                    break
            left -= self._place(slot, n, offset)
            offset += n
        self.sequence += 1


COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def _batches(doc_id: pa.DataType, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [doc_id, *[pa.int64()] * 7, pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens", "lot", "free", "ids"]


def _first(source, end: int, limits: tuple[int, int, int], with_ids: bool) -> Callable:
    """Packs a partition; pieces of its last, short sequence keep their ids for the second packing (lot not null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_ids(source.value), TaskContext.get().partitionId()
        last = np.array([end], _ID).tobytes()
        rows: list[tuple] = []
        open_rows: list[tuple] = []  # of the newest sequence: it may be the last
        kind = None

        def out(sequence, offset, tag, start, n, loss, ids):
            nonlocal open_rows
            if open_rows and open_rows[0][5] != part << 32 | sequence:
                rows.extend(open_rows if with_ids else (r[:-1] + (None,) for r in open_rows))
                open_rows = []
            doc_id, total, free = tag
            raw = ids.tobytes()
            open_rows.append((doc_id, start, n, zlib.crc32(raw), total, part << 32 | sequence, offset, loss, None, max(0, free - start), raw))

        packer = Packer(limits, out)
        for batch in batches:
            column = batch.column("doc_id")
            kind = column.type
            for doc_id, prompt, text in zip(column.to_pylist(), batch.column("prompt").to_pylist(), batch.column("text").to_pylist(), strict=True):
                head = np.frombuffer(encoder.ids(prompt), _ID) if prompt else np.empty(0, _ID)
                ids = np.frombuffer(head.tobytes() + encoder.ids(text or "") + last, _ID)
                packer.add((doc_id, len(ids), len(head)), ids, len(head))
                if len(rows) >= OUT_ROWS:
                    yield _batches(kind, rows, NAMES)
                    rows = []
        packer.finish()
        if open_rows:
            short = sum(r[2] for r in open_rows) < limits[0]
            rows += [r[:8] + (part // LOT, *r[9:]) if short else r if with_ids else r[:-1] + (None,) for r in open_rows]
        if rows:
            yield _batches(kind, rows, NAMES)
    return run


def _second(limits: tuple[int, int, int], with_ids: bool) -> Callable:
    """Packs the pieces of one lot's short sequences again."""
    def run(key, table):
        kind = table.schema.field("doc_id").type
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        lot, rows = key[0].as_py(), []

        def out(sequence, offset, tag, start, n, loss, ids):
            doc_id, first, total, free = tag
            raw = ids.tobytes()
            rows.append((doc_id, first + start, n, zlib.crc32(raw), total, 1 << 62 | lot << 32 | sequence, offset, loss, None, max(0, free - start), raw if with_ids else None))

        packer = Packer(limits, out)
        for r in table.to_pylist():
            packer.add((r["doc_id"], r["start"], r["doc_tokens"], r["free"]), np.frombuffer(r["ids"], _ID), r["free"])
        packer.finish()
        return pa.Table.from_batches([_batches(kind, rows, NAMES)])
    return run


def pack(docs: DataFrame, tokenizer: str, prompt: str | None = None, limits: tuple[int, int, int] = LIMITS, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document: where it lies in its document and in its sequence.

    ``tokenizer`` is the path, on the driver, of a tokenizers file.  ``prompt`` names
    a column whose ids come before the text's and carry no loss.  ``with_ids`` adds
    each piece's ids (little-endian 32-bit).
    """
    with open(tokenizer, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {COLUMNS}, lot long, free long, ids binary"
    given = docs.select("doc_id", (F.col(prompt) if prompt else F.lit(None)).cast("string").alias("prompt"), "text")
    pieces = Cuts().write(given.mapInArrow(_first(source, end, limits, with_ids), schema))
    again = pieces.where("lot is not null").groupBy("lot").applyInArrow(_second(limits, with_ids), schema)
    out = pieces.where("lot is null").unionByName(again)
    return out.select("doc_id", *(c.split()[0] for c in COLUMNS.split(", ")), *(["ids"] if with_ids else []))
