"""Merging sorted, front-coded runs of strings without comparing known prefixes again."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the common prefix; the first ``known`` bytes are known to be equal."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_coded(strings: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """For each of the sorted strings what it shares with the one before, and its rest."""
    before = b""
    for string in strings:
        shared = common(before, string)
        yield shared, string[shared:]
        before = string


def merge(runs: list[Iterator[tuple[int, bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """All strings of the runs in order: (shared with the one before, string, payload).

    The runs give (shared with the run's string before, rest, payload). Every string in
    the tree is known by how much it shares with the last winner. Of two, the one that
    shares more is the smaller; only if both share the same are bytes compared, from
    there on, and the loser then knows what it shares with the winner.
    """
    k = 1
    while k < len(runs):
        k *= 2
    strings: list[bytes | None] = [None] * k
    shared = [0] * k
    payload = [0] * k

    def advance(i: int) -> None:
        """The run's next string; what it shares with the one before it, the last winner."""
        item = next(runs[i], None)
        if item is None:
            strings[i], shared[i] = None, -1
        else:
            n, rest, payload[i] = item
            strings[i], shared[i] = (strings[i] or b"")[:n] + rest, n

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs."""
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = strings[a], strings[b]
        if x is None:
            return a, b
        n = common(x, y, shared[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    losers = [0] * k
    winners = [0] * (2 * k)
    for i in range(k):
        if i < len(runs):
            advance(i)
        else:
            shared[i] = -1
        winners[k + i] = i
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    winner = winners[1]
    while strings[winner] is not None:
        yield shared[winner], strings[winner], payload[winner]
        advance(winner)
        node = (k + winner) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
