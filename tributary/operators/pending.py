"""The list of waiting debits of one account, with fast release.

Debits wait in insertion order.  A credit releases, from the front on, every
debit that fits the balance left by the releases before it.  Scanning the list
for that costs a credit as much as there are debits waiting.  Here the amounts
stand in a binary tree whose inner nodes hold the least amount below them, so
the next debit that fits is found in a logarithm of the list's length, and a
credit that can release nothing is known to at the root.
"""

from __future__ import annotations

from collections.abc import Iterator

_GONE = float("inf")


class PendingList:
    """Entries in insertion order, each with an amount (a whole number)."""

    def __init__(self) -> None:
        self._items: list = []
        self._least: list = [_GONE, _GONE]     # of a tree with one leaf per slot; node 1 is the root
        self._leaves = 1
        self._front = 0                        # slots before it are gone
        self._alive = 0

    def __len__(self) -> int:
        return self._alive

    def append(self, item, amount: int) -> None:
        if len(self._items) == self._leaves:
            self._rebuild()
        slot = len(self._items)
        self._items.append((item, amount))
        self._set(slot, amount)
        self._alive += 1

    def front(self):
        """The entry that waits longest."""
        self._skip()
        return self._items[self._front][0]

    def pop_front(self):
        item = self.front()
        self._remove(self._front)
        return item

    def release(self, balance: int) -> Iterator[tuple]:
        """Take out, in insertion order, every entry that fits what the ones before leave: (entry, balance after)."""
        at = 0
        while self._least[1] <= balance:
            at = self._next(at, balance)
            if at < 0:
                return
            item, amount = self._items[at]
            balance -= amount
            self._remove(at)
            yield item, balance

    def drain(self) -> Iterator:
        """Take out all entries in insertion order."""
        while self._alive:
            yield self.pop_front()

    def entries(self) -> list:
        """All entries in insertion order."""
        return [self._items[i][0] for i in range(self._front, len(self._items))
                if self._least[self._leaves + i] != _GONE]

    def _skip(self) -> None:
        while self._least[self._leaves + self._front] == _GONE:
            self._front += 1

    def _remove(self, slot: int) -> None:
        self._items[slot] = (None, 0)
        self._set(slot, _GONE)
        self._alive -= 1

    def _set(self, slot: int, amount) -> None:
        least, node = self._least, self._leaves + slot
        least[node] = amount
        node >>= 1
        while node:
            a, b = least[2 * node], least[2 * node + 1]
            now = a if a < b else b
            if least[node] == now:
                return
            least[node] = now
            node >>= 1

    def _next(self, start: int, balance: int) -> int:
        """The first slot from ``start`` on whose amount is at most ``balance``; -1 if there is none."""
        least, node = self._least, self._leaves + start
        while least[node] > balance:
            # up to the next subtree to the right, then down to its first fitting leaf
            while node & 1:
                node >>= 1
                if node <= 1:
                    return -1
            node += 1
        while node < self._leaves:
            node *= 2
            if least[node] > balance:
                node += 1
        return node - self._leaves

    def _rebuild(self) -> None:
        """Drop the slots that are gone; make room for twice the entries that are left."""
        leaf = self._leaves
        kept = [x for i, x in enumerate(self._items) if self._least[leaf + i] != _GONE]
        leaves = 1
        while leaves < 2 * len(kept) + 2:
            leaves *= 2
        least = [_GONE] * (2 * leaves)
        for i, (_, amount) in enumerate(kept):
            least[leaves + i] = amount
        for node in range(leaves - 1, 0, -1):
            least[node] = min(least[2 * node], least[2 * node + 1])
        self._items, self._least, self._leaves, self._front = kept, least, leaves, 0
