"""Minimal acyclic transducers: sorted terms to their places among them.

Terms are added in byte order.  A state is frozen as soon as no later term can change it, and shared
with an equal one seen before, so what is in work is one term's path.  An arc's output is the number of
terms that come before all that lie behind it; the outputs on a term's path add up to its ordinal.
"""

from __future__ import annotations

import struct

import numpy as np


class Builder:
    """Takes distinct terms in ascending byte order; :meth:`finish` gives the transducer's bytes."""

    def __init__(self) -> None:
        self.n_terms = 0
        self._last = b""
        # States of the last term's path: whether a term ends there, and arcs (label, target) frozen so far.
        self._path: list[tuple[list[bool], list[tuple[int, int]]]] = [([False], [])]
        self._known: dict[tuple, int] = {}
        self._behind: list[int] = []  # terms that can be read from each frozen state on

    def add(self, term: bytes) -> None:
        if self.n_terms and term <= self._last:
            raise ValueError("terms must be distinct and in ascending order")
        last, shared = self._last, 0
        for a, b in zip(last, term, strict=False):
            if a != b:
                break
            shared += 1
        self._freeze_below(shared)
        self._path.extend(([False], []) for _ in range(len(term) - shared))
        self._path[-1][0][0] = True
        self._last = term
        self.n_terms += 1

    def _freeze_below(self, depth: int) -> None:
        while len(self._path) > depth + 1:
            state = self._frozen(self._path.pop())
            self._path[-1][1].append((self._last[len(self._path) - 1], state))

    def _frozen(self, open_state: tuple[list[bool], list[tuple[int, int]]]) -> int:
        key = (open_state[0][0], *open_state[1])
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = len(self._behind)
            self._behind.append(key[0] + sum(self._behind[target] for _, target in key[1:]))
        return found

    def finish(self) -> bytes:
        self._freeze_below(0)
        root = self._frozen(self._path[0])
        ends = np.zeros(len(self._behind), np.uint8)
        arcs, targets, outputs = [], [], []
        for key, state in self._known.items():
            ends[state] = key[0]
            before = int(key[0])
            for label, target in key[1:]:
                arcs.append(state << 8 | label)
                targets.append(target)
                outputs.append(before)
                before += self._behind[target]
        # States are numbered in the order of ``_known``, labels ascend, so the arcs are sorted.
        parts = [np.array(arcs, np.int64), np.array(targets, np.int32), np.array(outputs, np.int64), ends]
        return struct.pack("<qqq", root, len(arcs), len(ends)) + b"".join(p.tobytes() for p in parts)


class Transducer:
    """Reads what :class:`Builder` has written."""

    def __init__(self, content: bytes) -> None:
        self.root, n_arcs, n_states = struct.unpack_from("<qqq", content)
        self.arcs = np.frombuffer(content, np.int64, n_arcs, 24)
        self.targets = np.frombuffer(content, np.int32, n_arcs, 24 + 8 * n_arcs)
        self.outputs = np.frombuffer(content, np.int64, n_arcs, 24 + 12 * n_arcs)
        self.ends = np.frombuffer(content, np.uint8, n_states, 24 + 20 * n_arcs)

    def ordinals(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Ordinal of each term ``data[start:stop]``, -1 for those that are not in the vocabulary.

        All terms take a step at once; a term that finds no arc leaves.
        """
        found = np.full(len(starts), -1, np.int64)
        term = np.arange(len(starts))
        at, stop = starts.astype(np.int64), stops.astype(np.int64)
        state, total = np.full(len(starts), self.root, np.int64), np.zeros(len(starts), np.int64)
        while len(term):
            done = at == stop
            if done.any():
                ending = done & (self.ends[state] == 1)
                found[term[ending]] = total[ending]
                term, at, stop, state, total = (x[~done] for x in (term, at, stop, state, total))
            if not len(term) or not len(self.arcs):
                break
            wanted = state << 8 | data[at]
            place = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            going = self.arcs[place] == wanted
            place = place[going]
            term, at, stop = term[going], at[going] + 1, stop[going]
            state, total = self.targets[place].astype(np.int64), total[going] + self.outputs[place]
        return found

    def ordinal(self, term: bytes) -> int:
        """Ordinal of one term, -1 when it is not in the vocabulary."""
        return int(self.ordinals(np.frombuffer(term, np.uint8), np.array([0]), np.array([len(term)]))[0])
