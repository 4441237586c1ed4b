"""SentencePiece encoding and decoding by a Viterbi pass over batches of words.

Words of equal length advance together: at each position the hashes of all substrings that end
there are probed in the sorted hashes of the pieces, and vectorised maxima keep, for every word,
the best score and a backpointer. For a unigram model all pieces compete by score. For a BPE model
a piece may only follow one beside which it stays as it is, which leaves the model's own encoding.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import memory, slices, texts
from annualis.llm.pieces import SPACE, UNKNOWN, Pieces, load

BASE = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 20
PAIR_BITS = 20
SCALAR_BELOW = 4  # words of one length that are not worth a vector
MAX_WORDS = 400_000  # distinct words a worker remembers; results don't depend on it
UNKNOWN_PENALTY = 10.0


class Viterbi:
    def __init__(self, pieces: Pieces, unigram: bool = False):
        self.pieces, self.unigram = pieces, unigram
        names = sorted(pieces.rank) if unigram else sorted(pieces.ids)
        self.codes = np.zeros((len(names), max(map(len, names))), dtype=np.uint32)
        for k, name in enumerate(names):
            self.codes[k, :len(name)] = [ord(c) for c in name]
        self.powers = BASE ** np.arange(self.codes.shape[1] + 1, dtype=np.uint64)
        self.sizes = np.array([len(p) for p in names])
        hashes = np.array([self._hash(p) for p in names], dtype=np.uint64)
        order = np.argsort(hashes)
        self.sorted, self.place = hashes[order], order
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces have the same hash")
        self.lengths = sorted(set(self.sizes.tolist()))
        self.maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.maybe[self._low(hashes)] = True
        self.names = names
        self.id_of = [pieces.all_ids[p] for p in names]
        self.scores = np.array([-pieces.rank[p] for p in names])
        self.unknown_score = self.scores.min() - UNKNOWN_PENALTY
        self.pair_keys = np.full(1 << PAIR_BITS, -1, dtype=np.int64)
        self.pair_stays = np.zeros(1 << PAIR_BITS, dtype=bool)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # words not met since known was last full

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def _low(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def _stays(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pieces (places) stay side by side, from a direct-mapped table of known pairs."""
        key = left * (1 << 21) + right
        slot = ((key.astype(np.uint64) * BASE) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        free = left >= UNKNOWN  # nothing merges with a character without a piece
        missing = ~free & (self.pair_keys[slot] != key)
        out = free | self.pair_stays[slot]
        if missing.any():
            asked, back = np.unique(key[missing], return_inverse=True)
            found = np.array([self.pieces.stays(self.names[k >> 21], self.names[k & 0x1FFFFF])
                              for k in asked.tolist()])
            out[missing] = found[back]
            at = slot[missing]
            self.pair_keys[at], self.pair_stays[at] = key[missing], found[back]
            # Two pairs of this batch may share a slot: the last one written holds it.
            self.pair_stays[at] = self._consistent(at, key[missing], found[back])
        return out

    def _consistent(self, at: np.ndarray, key: np.ndarray, found: np.ndarray) -> np.ndarray:
        held = dict(zip(key.tolist(), found.tolist()))
        return np.array([held[k] for k in self.pair_keys[at].tolist()])

    def batch(self, codes: np.ndarray) -> list[list[int]]:
        """Ids of words of equal length, given as a matrix of code points."""
        n, length = codes.shape
        codes = np.ascontiguousarray(codes.T)  # position by position
        h = np.zeros((length + 1, n), dtype=np.uint64)
        for i in range(length):
            h[i + 1] = h[i] * BASE + codes[i] + np.uint64(1)
        last = np.zeros((length + 1, n), dtype=np.int64)
        back = np.ones((length + 1, n), dtype=np.int64)
        score = np.full((length + 1, n), -np.inf)
        score[0] = 0
        sizes = np.array(self.lengths)
        for end in range(1, length + 1):
            tried = sizes[sizes <= end]
            sub = h[end] - h[end - tried] * self.powers[tried][:, None]
            k, word = np.nonzero(self.maybe[self._low(sub)])
            probe = np.minimum(np.searchsorted(self.sorted, sub[k, word]), len(self.sorted) - 1)
            hit = self.sorted[probe] == sub[k, word]
            word, size, piece = word[hit], tried[k[hit]], self.place[probe[hit]]
            start = end - size
            same = self._spelled(codes, word, start, piece)
            if not self.unigram:
                inner = np.flatnonzero(same & (start > 0))
                same[inner] = self._stays(last[start[inner], word[inner]], piece[inner])
            word, size, piece, start = word[same], size[same], piece[same], start[same]
            total = score[start, word] + self.scores[piece]
            np.maximum.at(score[end], word, total)
            best = total == score[end, word]
            last[end, word[best]], back[end, word[best]] = piece[best], size[best]
            lone = score[end] == -np.inf
            if self.unigram:
                lone |= (score[end - 1] + self.unknown_score > score[end]) & self._unknown(codes[end - 1])
            at = np.flatnonzero(lone)
            score[end, at] = score[end - 1, at] + (self.unknown_score if self.unigram else 0)
            last[end, at] = UNKNOWN + codes[end - 1, at].astype(np.int64)
            back[end, at] = 1
        return [self._trace(x, y) for x, y in zip(last.T.tolist(), back.T.tolist())]

    def _spelled(self, codes: np.ndarray, word: np.ndarray, start: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether the pieces really stand there: equal hashes are compared by character."""
        same = np.ones(len(word), dtype=bool)
        sizes = self.sizes[piece]
        for k in range(int(sizes.max(initial=0))):
            at = np.flatnonzero(sizes > k)
            same[at] &= self.codes[piece[at], k] == codes[start[at] + k, word[at]]
        return same

    def _unknown(self, chars: np.ndarray) -> np.ndarray:
        return np.array([chr(c) not in self.pieces.rank for c in chars.tolist()], dtype=bool)

    def _trace(self, last: list[int], back: list[int]) -> list[int]:
        out, end, id_of = [], len(last) - 1, self.id_of
        while end:
            piece = last[end]
            if piece >= UNKNOWN:
                out += self.pieces.bytes_of(chr(piece - UNKNOWN))[::-1]
            else:
                out.append(id_of[piece])
            end -= back[end]
        return out[::-1]

    def _one(self, word: str) -> list[int]:
        """A single word, by the same recursion without vectors."""
        last, out, end = self.pieces.last_pieces(word), [], len(word)
        while end:
            piece = last[end]
            known = piece in self.pieces.ids
            out += [self.pieces.ids[piece]] if known else self.pieces.bytes_of(piece)[::-1]
            end -= len(piece)
        return out[::-1]

    def learn(self, words: set[str]) -> None:
        """Encode words and remember them as little-endian 32-bit ids."""
        cut = {w: self.pieces.parts(w) if not self.unigram else [w] for w in words}
        by_length: dict[int, list[str]] = {}
        for part in {p for parts in cut.values() for p in parts}:
            by_length.setdefault(len(part), []).append(part)
        ids: dict[str, bytes] = {}
        for length, same in by_length.items():
            if len(same) < SCALAR_BELOW and not self.unigram:
                found = [self._one(w) for w in same]
            else:
                codes = np.frombuffer("".join(same).encode("utf-32-le"), np.uint32)
                found = self.batch(codes.reshape(len(same), length))
            for word, x in zip(same, found):
                ids[word] = np.array(x, dtype="<i4").tobytes()
        for word, parts in cut.items():
            self.known[word] = b"".join(ids[p] for p in parts)

    def encode(self, column: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        split = [self.pieces.words(t) for t in column]
        if len(self.known) > MAX_WORDS:
            self.known, self.older = {}, self.known
        new = set().union(*split).difference(self.known)
        again = {w for w in new if w in self.older}
        self.known.update((w, self.older[w]) for w in again)
        self.learn(new - again)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        spelled = self.pieces.spelled
        text = b"".join([spelled[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


_CODERS: dict[bytes, Viterbi] = memory({})


def coder(model: bytes) -> Viterbi:
    if model not in _CODERS:
        _CODERS[model] = Viterbi(load(model))
    return _CODERS[model]


def _lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(e) // 4 for e in encoded)], dtype=np.int32)
    values = np.frombuffer(b"".join(encoded), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids: the encoding of each text by a SentencePiece BPE model with byte fallback,
    without begin and end. A null or empty text has no ids; repeated rows come back repeated."""
    def run(batches):
        kept = coder(model)
        for batch in batches:
            for part in slices(batch):
                ids = _lists(kept.encode(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])
    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of ids. Null or empty ids give an empty text; ids without a spelling (begin,
    end) give nothing."""
    def run(batches):
        kept = coder(model)
        for batch in batches:
            rows = [kept.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.string())],
                                             ["doc_id", "text"])
    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text back (round_trip).

    A null text counts as empty, which has no ids and comes back. Repeated rows each come back, a null
    doc_id as such; an empty table gives none. A text with U+2581 itself does not come back.
    """
    def run(batches):
        kept = coder(model)
        for batch in batches:
            for part in slices(batch):
                column = part.column("text").to_pylist()
                encoded = kept.encode(column)
                same = [kept.decode(np.frombuffer(e, dtype="<i4").tolist()) == t
                        for e, t in zip(encoded, column)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(e) // 4 for e in encoded], pa.int64()),
                     _lists(encoded), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "ids", "round_trip"])
    return texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")
