"""Values of distinct tokens, computed once per task and kept in bounded memory."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Distinct tokens a task remembers; beyond that it starts anew.
CACHE_TOKENS = 400_000


class TokenTable:
    """Rows of numbers per token. `rows` gives each token's place in `values`, computing new ones by ``of``."""

    def __init__(self, of: Callable[[list[str]], np.ndarray], width: int) -> None:
        self._of, self._width = of, width
        self._clear()

    def _clear(self) -> None:
        self._place: dict[str, int] = {}
        self.values = np.empty((1024, self._width))

    def fresh(self) -> None:
        """Call between texts: forgets everything once the table is full."""
        if len(self._place) > CACHE_TOKENS:
            self._clear()

    def rows(self, tokens: list[str]) -> np.ndarray:
        place = self._place
        if fresh := list(set(tokens).difference(place)):
            n = len(place)
            while n + len(fresh) > len(self.values):
                self.values = np.concatenate([self.values, np.empty_like(self.values)])
            self.values[n:n + len(fresh)] = self._of(fresh)
            place.update(zip(fresh, range(n, n + len(fresh)), strict=True))
        return np.fromiter(map(place.__getitem__, tokens), dtype=np.int64, count=len(tokens))
