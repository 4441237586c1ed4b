"""Token counts by dynamic programming over prefixes.

count[i] = count[i - length of the last piece of the encoding of prefix i] + cost of that piece: one
pass over a text gives the exact count of every prefix (see pieces.py for why the last piece is
determined), so that truncation and budget questions need no second encoding. Words encode
independently: a worker keeps the prefix counts of distinct words, and a text's are sums of them.
"""

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from annualis.llm.common import memory, slices, texts
from annualis.llm.pieces import LONG_WORD, Pieces, load

MAX_WORDS = 400_000  # distinct words a worker remembers; results don't depend on it


def word_counts(pieces: Pieces, word: str) -> list[int]:
    """Exact token counts of the prefixes of a word, by length in characters from 0."""
    counts = [0]
    for part in pieces.parts(word):
        base = len(counts) - 1
        for end, piece in enumerate(pieces.last_pieces(part)[1:], 1):
            cost = 1 if piece in pieces.ids else len(pieces.bytes_of(piece))
            counts.append(counts[base + end - len(piece)] + cost)
    return counts


class PrefixCounter:
    """Answers for one text at a time, from the totals of words kept between texts."""

    def __init__(self, pieces: Pieces, max_words: int = MAX_WORDS):
        self.pieces, self.max_words = pieces, max_words
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}  # words not met since known was last full

    def learn(self, words: set[str]) -> None:
        """Totals of words. In sorted order, a word goes on from the prefix it shares with the one
        before: last pieces and counts of a prefix don't depend on what follows."""
        missing = []
        for word in words:
            if word in self.older:
                self.known[word] = self.older[word]
            elif len(word) > LONG_WORD:
                self.known[word] = word_counts(self.pieces, word)[-1]
            else:
                missing.append(word)
        before, last, counts, ids = "", [""], [0], self.pieces.ids
        for word in sorted(missing):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del last[shared + 1:], counts[shared + 1:]
            self.pieces.last_pieces(word, last)
            for end in range(shared + 1, len(word) + 1):
                piece = last[end]
                counts.append(counts[end - len(piece)]
                              + (1 if piece in ids else len(self.pieces.bytes_of(piece))))
            self.known[word] = counts[-1]
            before = word

    def totals(self, column: list[str]) -> list[tuple[list[str], list[int]]]:
        """Words of each text and their running totals."""
        split = [self.pieces.words(t) for t in column]
        if len(self.known) > self.max_words:
            self.known, self.older = {}, self.known
        self.learn(set().union(*split).difference(self.known))
        get = self.known.__getitem__
        return [(words, list(accumulate(map(get, words)))) for words in split]

    def prefixes(self, text: str) -> list[int]:
        """Token count of every prefix of the text, by length in characters from 0."""
        out, base = [0], 0
        for k, word in enumerate(self.pieces.words(text)):
            counts = word_counts(self.pieces, word)
            out += [base + c for c in counts[1 + (k == 0):]]  # the space in front is no character
            base += counts[-1]
        return out

    def within(self, words: list[str], ends: list[int], budget: int) -> int:
        """Characters of the longest prefix with `budget` tokens at most. ends: the running totals
        by word, which never fall; only the word that passes the budget is looked into."""
        k = next((k for k, n in enumerate(ends) if n > budget), None)
        whole = words if k is None else words[:k]
        chars = sum(map(len, whole))
        if k is not None:
            base = ends[k - 1] if k else 0
            chars += max(i for i, n in enumerate(word_counts(self.pieces, words[k]))
                         if base + n <= budget)
        return max(0, chars - 1)  # without the space in front


_COUNTERS: dict[bytes, PrefixCounter] = memory({})


def counter(model: bytes) -> PrefixCounter:
    if model not in _COUNTERS:
        _COUNTERS[model] = PrefixCounter(load(model))
    return _COUNTERS[model]


def count_tokens(docs: DataFrame, model: bytes, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Exact token counts of a SentencePiece BPE model, without begin or end.

    model: content of the model file. Returns doc_id, n_bytes (UTF-8), n_tokens, over_limit and
    chars_within, the characters of the longest prefix of at most `limit` tokens. A null text
    counts as empty: no tokens. Repeated rows and null ids come back as they are.
    """
    def count(batches):
        kept = counter(model)
        for batch in batches:
            for part in slices(batch):
                rows = []
                column = part.column("text").to_pylist()
                for text, (words, ends) in zip(column, kept.totals(column)):
                    n = ends[-1] if ends else 0
                    rows.append((len(text.encode()), n, n > limit,
                                 len(text) if n <= limit else kept.within(words, ends, limit)))
                n_bytes, n_tokens, over, chars = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                     pa.array(over, pa.bool_()), pa.array(chars, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit", "chars_within"])
    return texts(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chars_within long")


def prefix_counts(docs: DataFrame, model: bytes, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id and counts: the token count of every prefix, by its length in characters from 0."""
    def count(batches):
        kept = counter(model)
        for batch in batches:
            for part in slices(batch):
                counts = [kept.prefixes(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "counts"])
    return texts(docs, id_col, text_col).mapInArrow(count, "doc_id long, counts array<int>")
