"""SHA-256 whose state can be kept, copied and resumed, for many messages at a time.

All messages here are digests in lowercase hex, one after the other. Such a digest fills one block of
64 bytes, so the state after any number of them is eight words and nothing else. Arrays hold
one message per column: states (8, n), blocks (16, n), both of 32-bit words; digests are (n, 32) bytes.
"""

from __future__ import annotations

import math

import numpy as np

SLICE = 8192  # columns that are worked on together and stay in the cache


def _primes(count: int) -> list[int]:
    found: list[int] = []
    n = 2
    while len(found) < count:
        if all(n % p for p in found):
            found.append(n)
        n += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= n else (low, middle - 1)
    return low


#: The standard's constants by its rule: the first 32 bits of the fractions of square and cube roots of primes.
START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
HEX = np.array([list(f"{b:02x}".encode()) for b in range(256)], np.uint8)


def start(count: int) -> np.ndarray:
    return np.repeat(START[:, None], count, axis=1)


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The blocks that digests fill when written in hex."""
    return HEX[digests].reshape(-1, 64).view(">u4").astype(np.uint32).T


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def _compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(
                w[i - 16] + w[i - 7]
                + (_turned(x, 7) ^ _turned(x, 18) ^ (x >> np.uint32(3)))
                + (_turned(y, 17) ^ _turned(y, 19) ^ (y >> np.uint32(10)))
            )
        chosen = g ^ (e & (f ^ g))
        first = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + chosen + (w[i] + ROUND[i])
        most = (a & b) | (c & (a | b))
        second = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + most
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block each."""
    if state.shape[1] <= SLICE:
        return _compress(state, block)
    cuts = range(0, state.shape[1], SLICE)
    return np.concatenate([_compress(state[:, i : i + SLICE], block[:, i : i + SLICE]) for i in cuts], axis=1)


def absorb_digests(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    return absorb(state, hex_block(digests))


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of messages of so many whole blocks each."""
    last = np.zeros((16, state.shape[1]), np.uint32)
    last[0] = 0x80000000
    bits = np.asarray(blocks, np.uint64) * np.uint64(512)
    last[14], last[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return words_to_bytes(absorb(state, last))


def words_to_bytes(state: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(state.T).astype(">u4").view(np.uint8)


def bytes_to_words(held: np.ndarray) -> np.ndarray:
    """The inverse of ``words_to_bytes``."""
    return np.ascontiguousarray(held).view(">u4").astype(np.uint32).reshape(-1, 8).T


class Subtree:
    """The nodes over some neighbouring leaves, and each parent's states before its child slots.

    The state before slot 0 is the same for all parents, so it is not kept. ``nodes[0]`` are the leaves; ``states[k]`` is
    (slots - 1, 8, parents) for the parents in ``nodes[k + 1]``.
    """

    def __init__(self, nodes: list[np.ndarray], states: list[np.ndarray], fanout: int) -> None:
        self.nodes, self.states, self.fanout = nodes, states, fanout

    @classmethod
    def over(cls, leaves: np.ndarray, fanout: int, levels: int) -> Subtree:
        nodes, states = [leaves], []
        for _ in range(levels):
            below = nodes[-1]
            parents = -(-len(below) // fanout)
            state, kept = start(parents), np.zeros((fanout - 1, 8, parents), np.uint32)
            children = np.zeros(parents, np.int64)
            for slot in range(fanout):
                some = below[slot::fanout]
                state = state.copy()
                state[:, : len(some)] = absorb_digests(state[:, : len(some)], some)
                children[: len(some)] += 1
                if slot + 1 < fanout:
                    kept[slot] = state
            nodes.append(finish(state, children))
            states.append(kept)
        return cls(nodes, states, fanout)

    @classmethod
    def read(cls, nodes: bytes, states: bytes, leaves: int, fanout: int, levels: int) -> Subtree:
        held, kept = np.frombuffer(nodes, np.uint8).reshape(-1, 32), np.frombuffer(states, ">u4")
        found, before, at, place = [held[:leaves]], [], leaves, 0
        for _ in range(levels):
            size = -(-len(found[-1]) // fanout)
            found.append(held[at : at + size])
            used = (fanout - 1) * 8 * size
            before.append(kept[place : place + used].reshape(fanout - 1, 8, size).astype(np.uint32))
            at, place = at + size, place + used
        return cls(found, before, fanout)

    def written(self) -> tuple[bytes, bytes]:
        return np.concatenate(self.nodes).tobytes(), b"".join(s.astype(">u4").tobytes() for s in self.states)

    def steps(self, places: np.ndarray):
        """Level by level for leaves at these places: the states before their slots, the parents' children, and the siblings by slot."""
        for nodes, states in zip(self.nodes, self.states, strict=False):
            parents, slots = places // self.fanout, places % self.fanout
            before = start(len(places))
            for slot in range(1, self.fanout):
                at = np.flatnonzero(slots == slot)
                before[:, at] = states[slot - 1][:, parents[at]]
            children = np.minimum(self.fanout, len(nodes) - parents * self.fanout)
            yield slots, before, children, lambda slot, rows, p=parents, n=nodes: n[p[rows] * self.fanout + slot]
            places = parents


class Fold:
    """Digests on their way to the root, and the hash of the siblings met on it."""

    def __init__(self, digests: np.ndarray) -> None:
        self.digests = digests
        self.proof = start(len(digests))
        self.met = np.zeros(len(digests), np.int64)

    def step(self, slots, before, children, sibling, fanout: int) -> None:
        """One level up: the kept state takes the digest and the right siblings; the proof takes all siblings."""
        state = absorb_digests(before, self.digests)
        for slot in range(fanout):
            right = np.flatnonzero((slots < slot) & (slot < children))
            left = np.flatnonzero(slots > slot)
            if len(right):
                block = hex_block(sibling(slot, right))
                state[:, right] = absorb(state[:, right], block)
                self.proof[:, right] = absorb(self.proof[:, right], block)
            if len(left):
                self.proof[:, left] = absorb(self.proof[:, left], hex_block(sibling(slot, left)))
            self.met[right] += 1
            self.met[left] += 1
        self.digests = finish(state, children)
