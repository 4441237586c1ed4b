"""A suffix automaton over words that grows by texts in ascending document order."""


class Automaton:
    """Holds the substrings of inserted word sequences; each state knows the smallest document that
    one of its substrings occurs in (documents are inserted in ascending order)."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [None]

    def insert(self, words: list[int], doc: int) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word, doc)

    def _extend(self, last: int, word: int, doc: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._clone(last, word, known)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.first.append(doc)
        at = last
        while at >= 0 and word not in nxt[at]:
            nxt[at][word] = new
            at = link[at]
        if at >= 0:
            to = nxt[at][word]
            link[new] = to if length[to] == length[at] + 1 else self._clone(at, word, to)
        return new

    def _clone(self, at: int, word: int, to: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[to]))
        link.append(link[to])
        length.append(length[at] + 1)
        self.first.append(self.first[to])
        link[to] = clone
        while at >= 0 and nxt[at].get(word) == to:
            nxt[at][word] = clone
            at = link[at]
        return clone

    def matches(self, words: list[int], size: int) -> list[int | None]:
        """Matching statistics against `size`: for each position, the smallest document that holds
        the `size` words ending there, or None."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        out: list[int | None] = []
        state = matched = 0
        for word in words:
            to = nxt[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(word)
            if to is None:
                out.append(None)
                continue
            state, matched = to, matched + 1
            if matched >= size:
                matched = size
                while length[link[state]] >= size:  # the state of the last `size` words alone
                    state = link[state]
                out.append(first[state])
            else:
                out.append(None)
        return out
