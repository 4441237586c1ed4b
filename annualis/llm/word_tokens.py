"""Token ids by a `tokenizers` file, with the ids of distinct words kept between texts.

Spaces and line feeds separate words for the pre-tokenizer, so words encode independently. In Latin-1
texts without apostrophes and special tokens, runs of letters and of other characters do too, and
their case is folded anyway; that makes far fewer distinct words. In other texts that holds for the
words of plain ASCII; a word with other characters stays whole and as it is, as they may compose.
"""

import hashlib
import os
import re

import numpy as np
from tokenizers import Tokenizer

from annualis.llm.common import memory

MAX_WORDS = 400_000  # distinct words a worker remembers; results don't depend on it

_LOADED: dict[bytes, "WordTokens"] = memory({})
_LETTERS = "a-zªµºß-öø-ÿ"  # small letters of Latin-1
_RUNS = re.compile(rf"[{_LETTERS}]+|[^{_LETTERS} \n]+")
_WORDS = re.compile(r"(?<![^ \n])[^ \n]*[^\x00-&(-\x7f][^ \n]*|[A-Za-z]+|[^A-Za-z \n]+")  # whole with ' or beyond ASCII


def load(model: bytes) -> "WordTokens":
    key = hashlib.sha256(model).digest()
    if key not in _LOADED:
        _LOADED[key] = WordTokens(model)
    return _LOADED[key]


class WordTokens:
    """For lower-casing BPE models whose pre-tokenizer drops white space and splits at letter runs."""

    def __init__(self, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core; threads would only wait
        self.tokenizer = Tokenizer.from_buffer(model)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def words(text: str) -> list[str]:
        if "<|" in text:  # special tokens have a case
            return [w for w in text.replace("\n", " ").split(" ") if w]
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return _WORDS.findall(text)
        return (_WORDS if "'" in text else _RUNS).findall(text.lower())

    def encode(self, column: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.known) > MAX_WORDS:
            self.known, self.older = {}, self.known
        split = [self.words(t) for t in column]
        new = set().union(*split).difference(self.known)
        again = {w for w in new if w in self.older}
        self.known.update((w, self.older[w]) for w in again)
        fresh = sorted(new - again)
        if fresh:
            found = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)
            self.known.update((w, np.array(e.ids, dtype="<u4").tobytes()) for w, e in zip(fresh, found))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]
