"""Pieces of a SentencePiece BPE model, and when two of them may stand side by side.

The model merges, again and again, the pair of neighbours whose concatenation is the best piece.
A sequence of pieces is the encoding of a text if and only if every two neighbours are the encoding
of their own concatenation: merges inside a piece don't depend on what stands beside it, until a
merge crosses a border, and the first one to cross does so in the pair alone too. So the encoding of
every prefix has exactly one possible last piece, which makes encoding a dynamic program.
"""

import hashlib
import re

import numpy as np
import sentencepiece

from annualis.llm.common import memory

SPACE = "▁"
UNKNOWN = 1 << 21  # ids from here on stand for a character (its code point added) without a piece
LONG_WORD = 24
MAX_PAIRS = 1 << 20

_LOADED: dict[bytes, "Pieces"] = memory({})


def load(model: bytes) -> "Pieces":
    """The pieces of a model file's content; a worker keeps them."""
    key = hashlib.sha256(model).digest()
    if key not in _LOADED:
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


class Pieces:
    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i)
                                             or sp.is_unused(i))]
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in plain}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unk_id = sp.unk_id()
        self.byte_fallback = sp.is_byte(self.byte_ids[0])
        self.spelled: list[bytes] = [b""] * n  # what an id decodes to, before spaces are restored
        for i in plain:
            self.spelled[i] = sp.id_to_piece(i).encode()
        if self.byte_fallback:
            for b, i in enumerate(self.byte_ids):
                self.spelled[i] = bytes([b])
        self.spelled[self.unk_id] = " ⁇ ".encode()
        self._steps: dict[str, tuple[list[float], list[str], list[str]]] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        # A piece that its own characters don't merge into never occurs.
        self.ids = {sp.id_to_piece(i): i for i in plain if self._merged(sp.id_to_piece(i))}
        self.names = {i: p for p, i in self.ids.items()}
        self.all_ids = {sp.id_to_piece(i): i for i in plain}
        self.longest = max(map(len, self.ids))
        # Sizes of the pieces that may end a text, longest first, by its last three characters (two
        # or one, where no piece ends with more of them).
        long_ends: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) >= 3:
                long_ends.setdefault(p[-3:], set()).add(len(p))
        self.sizes = {p: [len(p)] + [1] * (len(p) == 2 and p[1] in self.ids)
                      for p in self.ids if len(p) < 3}
        self.sizes |= {e: sorted(n, reverse=True) + self.sizes.get(e[1:], self.sizes.get(e[2:], []))
                       for e, n in long_ends.items()}
        self.pairs_inside = {p[k:k + 2] for p in self.rank for k in range(len(p) - 1)}
        # Words end where no piece can reach across: before a space, and around a line feed.
        self.spaces_lead = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.rank)
        feed = "" if "\n" in self.rank or any("\n" in p for p in self.rank) else "\n"
        self._word = re.compile(f"{SPACE}*[^{SPACE}{feed}]+|{SPACE}+" + (f"|{feed}" if feed else ""))

    def words(self, text: str) -> list[str]:
        """The text in parts that encode independently, with spaces made visible and one in front."""
        if not text:
            return []
        norm = SPACE + text.replace(" ", SPACE)
        return self._word.findall(norm) if self.spaces_lead else [norm]

    def parts(self, word: str) -> list[str]:
        """A long word, cut wherever two neighbouring characters stand in no piece together."""
        if len(word) <= LONG_WORD:
            return [word]
        cuts = [0, *(k for k in range(1, len(word)) if word[k - 1:k + 1] not in self.pairs_inside),
                len(word)]
        return [word[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _merged(self, piece: str) -> bool:
        ranks, _, _ = self._history(piece)
        return len(ranks) == len(piece) - 1

    def _history(self, piece: str):
        """Ranks of the merges inside a piece, in order, and its first and last symbol before and
        after each."""
        if piece not in self._steps:
            symbols, ranks = list(piece), []
            firsts, lasts = [symbols[0]], [symbols[-1]]
            while len(symbols) > 1:
                best = min(range(len(symbols) - 1),
                           key=lambda k: self.rank.get(symbols[k] + symbols[k + 1], np.inf))
                rank = self.rank.get(symbols[best] + symbols[best + 1], np.inf)
                if rank == np.inf:
                    break
                symbols[best:best + 2] = [symbols[best] + symbols[best + 1]]
                ranks.append(rank)
                firsts.append(symbols[0])
                lasts.append(symbols[-1])
            self._steps[piece] = ranks, firsts, lasts
        return self._steps[piece]

    def stays(self, left: str, right: str) -> bool:
        """Whether merging the characters of left + right leaves these two pieces (or a character
        without a piece beside one)."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= MAX_PAIRS:
                self._pairs.clear()
            known = left not in self.ids or self._simulate(left, right)
            self._pairs[left, right] = known
        return known

    def _simulate(self, left: str, right: str) -> bool:
        ranks_l, _, lasts = self._history(left)
        ranks_r, firsts, _ = self._history(right)
        i = j = 0
        while True:
            inside_l = ranks_l[i] if i < len(ranks_l) else np.inf
            inside_r = ranks_r[j] if j < len(ranks_r) else np.inf
            across = self.rank.get(lasts[i] + firsts[j], np.inf)
            if across < inside_l and across <= inside_r and across < np.inf:
                return False  # of equal ranks the leftmost merges first
            if inside_l == inside_r == np.inf:
                return True
            if inside_l <= inside_r:
                i += 1
            else:
                j += 1

    def bytes_of(self, char: str) -> list[int]:
        """Ids of a character without a piece."""
        if not self.byte_fallback:
            return [self.unk_id]
        return [self.byte_ids[b] for b in char.encode()]

    def last_pieces(self, word: str, last: list[str] | None = None) -> list[str]:
        """For every prefix of the word, the last piece of its encoding ("" for the empty one).
        last: the answer for some first prefixes, which is extended."""
        last = [""] if last is None else last
        ids, sizes, pairs = self.ids, self.sizes, self._pairs
        for end in range(len(last), len(word) + 1):
            ending = word[max(0, end - 3):end]
            for size in sizes.get(ending) or sizes.get(ending[1:]) or sizes.get(ending[2:]) or ():
                if size > end:
                    continue
                piece = word[end - size:end]
                if piece in ids:
                    before = last[end - size]
                    if not before:
                        break
                    fits = pairs.get((before, piece))
                    if fits is None:
                        fits = self.stays(before, piece)
                    if fits:
                        break
            else:
                piece = word[end - 1]  # a character without a piece
            last.append(piece)
        return last
