"""Merging sorted streams with a tree of losers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class LoserTree:
    """The rows of sorted streams as one sorted stream.

    Each inner node keeps the loser of the match played there. After the winner's stream moved
    on, only the matches on its own path are played again: one comparison for each level.
    Equal rows come in the order of their streams.
    """

    def __init__(self, streams: Sequence[Iterator[tuple]]):
        self.streams = list(streams)
        self.heads: list[tuple | None] = [next(s, None) for s in self.streams]
        self.losers = [-1] * len(self.streams)
        self.winner = -1
        for leaf in range(len(self.streams)):
            self._play(leaf, first=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return x < y or (x == y and a < b)

    def _play(self, leaf: int, first: bool = False) -> None:
        node, best = (leaf + len(self.streams)) // 2, leaf
        while node:
            other = self.losers[node]
            if other == -1 and first:
                # The first to come waits here for its match.
                self.losers[node] = best
                return
            if self._beats(other, best):
                self.losers[node], best = best, other
            node //= 2
        self.winner = best

    def __iter__(self) -> Iterator[tuple]:
        while self.streams and (row := self.heads[self.winner]) is not None:
            yield row
            leaf = self.winner
            self.heads[leaf] = next(self.streams[leaf], None)
            self._play(leaf)
