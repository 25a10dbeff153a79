"""Static binary-fuse filters in numpy (Graf and Lemire 2022), three slots per key and eight bits per slot.

A filter is built once from the 64-bit keys of an immutable set and answers "maybe" for each of them, and for about one
in 256 others. Peeling goes in rounds over whole arrays: all slots with a single key left are taken at once.
"""

import math

import numpy as np

MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mixed(keys, seed: int):
    """Murmur's finaliser over keys and seed."""
    h = keys + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for m in MIX:
        h = (h ^ (h >> np.uint64(33))) * m
    return h ^ (h >> np.uint64(33))


def layout(n: int):
    """Slots per segment (a power of two), and number of segments that a first slot can be in."""
    segment = min(1 << 18, 1 << int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    capacity = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    return segment, max(1, math.ceil(capacity / segment) - 2)


def slots_of(h, segment: int, segments: int):
    first = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def fingerprint(h):
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build(keys):
    """(seed, segment, segments, slots as bytes) for distinct or repeated 64-bit keys."""
    keys = np.unique(np.asarray(keys, dtype=np.uint64))
    n = len(keys)
    segment, segments = layout(n)
    size = segment * (segments + 2)
    for seed in range(1000):
        h = mixed(keys, seed)
        slots = slots_of(h, segment, segments)
        degree = np.bincount(slots.ravel(), minlength=size)
        key_sum = np.bincount(slots.ravel(), weights=np.tile(np.arange(n, dtype=np.float64), 3), minlength=size).astype(np.int64)
        rounds, peeled = [], 0
        while len(single := np.flatnonzero(degree == 1)):
            key, at = np.unique(key_sum[single], return_index=True)
            rounds.append((key, single[at]))
            peeled += len(key)
            gone = slots[:, key].ravel()
            np.subtract.at(degree, gone, 1)
            np.subtract.at(key_sum, gone, np.tile(key, 3))
        if peeled == n:
            table, prints = np.zeros(size, np.uint8), fingerprint(h)
            for key, own in reversed(rounds):
                # A key's own slot is still zero, so it can be among the three.
                table[own] = prints[key] ^ np.bitwise_xor.reduce(table[slots[:, key]], axis=0)
            return seed, segment, segments, table.tobytes()
    raise ValueError("no seed peels these keys")


def maybe(keys, seed, segment, segments, table):
    """Whether each key may be in the set; never false for one that is."""
    h = mixed(np.asarray(keys, dtype=np.uint64), int(seed))
    table = np.frombuffer(table, np.uint8)
    return np.bitwise_xor.reduce(table[slots_of(h, int(segment), int(segments))], axis=0) == fingerprint(h)
