"""Vector bin packing of training examples.

A sequence has limits on tokens, segments and loss-bearing tokens at once. Among the pieces that
fit, the one whose demand has the largest dot product with what is left of the limits goes in, both
as shares of the limits. The last gap of a sequence is closed by cutting a longer piece.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import slices, texts
from annualis.llm.word_tokens import load

MAX_TOKENS = 2048
MAX_SEGMENTS = 128
POOL = 512  # open pieces a task chooses from
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long")
NAMES = [c.split()[0] for c in PIECE.split(", ")]


class Packer:
    """Packs a stream of examples; what it holds is bounded by the pool."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, first_id: int, cut: bool = True):
        self.limits = np.array([max_tokens, max_segments, max_loss], dtype=np.float64)
        self.cut, self.next_id = cut, first_id
        self.pieces: list[tuple] = []  # (doc_id, start, ids, loss prefix sums or None, doc_tokens)
        self.demand = np.empty((0, 3))
        self.out: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes, loss: np.ndarray | None = None) -> None:
        """An example; loss marks the tokens that bear loss (None: all)."""
        n, most = len(ids) // 4, int(self.limits[0])
        sums = None if loss is None else np.concatenate([[0], np.cumsum(loss)])
        if self.cut or n > most:
            start = 0
            while n - start >= most:  # full sequences, as far as the loss limit lets them be full
                length = self._loss_prefix(sums, start, most)
                self._emit([(doc_id, start, ids[4 * start:4 * (start + length)], None, n)])
                start += length
        else:
            start = 0
        if start < n:
            self._hold([(doc_id, start, ids[4 * start:], None if sums is None else sums[start:], n)])
        if len(self.pieces) >= POOL:
            while len(self.pieces) >= POOL // 2:
                self._sequence(most)

    def _loss_prefix(self, sums, start: int, most: int) -> int:
        if sums is None:
            return min(most, int(self.limits[2]))
        fits = int(np.searchsorted(sums[start:start + most + 1], sums[start] + self.limits[2], "right")) - 1
        return max(1, fits)

    def _hold(self, pieces: list[tuple]) -> None:
        rows = [(len(p[2]) // 4, 1, len(p[2]) // 4 if p[3] is None else p[3][-1] - p[3][0]) for p in pieces]
        self.pieces += pieces
        self.demand = np.vstack([self.demand, np.array(rows, dtype=np.float64)])

    def _take(self, k: int) -> tuple:
        piece = self.pieces[k]
        self.pieces[k] = self.pieces[-1]
        self.demand[k] = self.demand[-1]
        self.pieces.pop()
        self.demand = self.demand[:-1]
        return piece

    def _sequence(self, target: int) -> None:
        """Close one sequence of `target` tokens, or fewer if nothing fits any more."""
        left = self.limits.copy()
        left[0] = target
        left[2] = min(left[2], self.limits[2])
        chosen = []
        while self.pieces and left[0] > 0 and left[1] > 0:
            fits = (self.demand <= left).all(axis=1)
            if left[1] == 1 and self.cut:  # the last segment should close the gap
                fits &= self.demand[:, 0] == left[0]
            if fits.any():
                worth = (self.demand / self.limits) @ (left / self.limits)
                k = int(np.argmax(np.where(fits, worth, -1)))
                left -= self.demand[k]
                chosen.append(self._take(k))
                continue
            if not self.cut:
                break
            k = int(np.argmax(self.demand[:, 0]))
            doc_id, start, ids, sums, n = self.pieces[k]
            length = int(min(left[0], len(ids) // 4))
            if sums is None:
                length = int(min(length, left[2]))
            else:
                length = min(length, int(np.searchsorted(sums[:length + 1], sums[0] + left[2], "right")) - 1)
            if length < 1:
                break
            self._take(k)
            head = (doc_id, start, ids[:4 * length], sums, n)
            if 4 * length < len(ids):
                self._hold([(doc_id, start + length, ids[4 * length:],
                             None if sums is None else sums[length:], n)])
            chosen.append(head)
            left -= [length, 1, length if sums is None else sums[length] - sums[0]]
        if not chosen:  # a limit lets nothing in: one piece goes alone
            chosen = [self._take(0)]
        self._emit(chosen)

    def _emit(self, chosen: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, _, n in chosen:
            length = len(ids) // 4
            self.out.append((doc_id, start, length, zlib.crc32(ids), n, self.next_id, offset))
            offset += length
        self.next_id += 1

    def finish(self) -> None:
        """Pack what is left. The end, less than a full sequence, is cut into powers of two, which
        need no padding."""
        while self.pieces:
            total = int(self.demand[:, 0].sum())
            most = int(self.limits[0])
            self._sequence(most if total >= most or not self.cut else 1 << (total.bit_length() - 1))

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [()] * len(NAMES)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)


def _packer(limits: tuple[int, int, int], cut: bool) -> Packer:
    # A task numbers its own sequences; a task that runs again gets the same rows and numbers.
    return Packer(*limits, first_id=TaskContext.get().partitionId() << 33, cut=cut)


def pack_documents(docs: DataFrame, tokenizer: bytes, end_id: int = 1, max_tokens: int = MAX_TOKENS,
                   max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Token ids of each text, then end_id, packed into sequences; every token bears loss.

    tokenizer: content of a `tokenizers` file. Returns one row per piece: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset. Texts are cut freely; an empty or null text is its
    end token. Each task packs the rows it reads with a pool of bounded size, without a shuffle.
    Repeated rows are packed each for itself; null ids come back as they are.
    """
    limits = (max_tokens, max_segments, max_tokens if max_loss is None else max_loss)
    end = np.array([end_id], dtype="<u4").tobytes()

    def pack(batches):
        packer, words = _packer(limits, True), load(tokenizer)
        for batch in batches:
            for part in slices(batch):
                column = part.column("text").to_pylist()
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), words.encode(column)):
                    packer.add(doc_id, ids + end)
            yield packer.drain()
        packer.finish()
        yield packer.drain()
    return texts(docs, id_col, text_col).mapInArrow(pack, PIECE)


def pack_examples(examples: DataFrame, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
                  max_loss: int = MAX_TOKENS, cut: bool = False, id_col: str = "doc_id",
                  ids_col: str = "ids", loss_col: str = "loss") -> DataFrame:
    """Packs examples that are encoded already: ids (array<int>) and loss (array<boolean>, the
    tokens that bear loss; null: all). Without cut, only an example longer than max_tokens is cut.
    An example without ids gives no piece. Returns the columns of pack_documents."""
    limits = (max_tokens, max_segments, max_loss)
    rows = examples.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"),
                           F.col(loss_col).alias("loss"))

    def pack(batches):
        packer = _packer(limits, cut)
        for batch in batches:
            for doc_id, ids, loss in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "loss"))):
                if ids:
                    marks = None if loss is None else np.array([bool(x) for x in loss], dtype=np.int64)
                    packer.add(doc_id, np.array(ids, dtype="<u4").tobytes(), marks)
            yield packer.drain()
        packer.finish()
        yield packer.drain()
    return rows.mapInArrow(pack, PIECE)
