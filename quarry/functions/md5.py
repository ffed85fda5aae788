"""md5 of many short messages at once, in numpy: for tasks that draw by ``md5("seed:key")`` billions of times.

The messages of a call have one length and differ in one run of bytes only; the 64 steps work on whole vectors."""

from __future__ import annotations

import math

import numpy as np

_SHIFTS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_TURNS = {s: (np.array(s, np.uint32), np.array(32 - s, np.uint32)) for s in set(_SHIFTS)}
_PLACES = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
AT_ONCE = 50_000  # messages whose vectors fit a core's cache; a part of 100,000


def md5_words(head: bytes, varying: np.ndarray, tail: bytes = b"") -> list[np.ndarray]:
    """The digests of ``head`` + a row of ``varying`` (uint8, a row per message) + ``tail``, as four uint32 vectors: the
    digest's bytes in order, each four as one number, first byte highest."""
    n, width = varying.shape
    size = len(head) + width + len(tail)
    whole = bytearray(-(-(size + 9) // 64) * 64)
    whole[: len(head)], whole[len(head) + width : size], whole[size] = head, tail, 0x80
    whole[-8:] = (8 * size).to_bytes(8, "little")
    a, b = len(head) // 4, -(-(len(head) + width) // 4)
    run = np.tile(np.frombuffer(bytes(whole[4 * a : 4 * b]), np.uint8), (n, 1))
    run[:, len(head) - 4 * a : len(head) - 4 * a + width] = varying
    vectors = dict(enumerate(np.ascontiguousarray(run.view("<u4").T), a))
    plain = np.frombuffer(bytes(whole), "<u4").tolist()
    state = [np.full(n, x, np.uint32) for x in _START]
    t = np.empty(n, np.uint32)
    for block in range(0, len(plain), 16):
        a, b, c, d = (x.copy() for x in state)
        for i in range(64):
            if i < 16:
                np.bitwise_xor(c, d, out=t)
                np.bitwise_and(t, b, out=t)
                np.bitwise_xor(t, d, out=t)
            elif i < 32:
                np.bitwise_xor(b, c, out=t)
                np.bitwise_and(t, d, out=t)
                np.bitwise_xor(t, c, out=t)
            elif i < 48:
                np.bitwise_xor(b, c, out=t)
                np.bitwise_xor(t, d, out=t)
            else:
                np.bitwise_not(d, out=t)
                np.bitwise_or(t, b, out=t)
                np.bitwise_xor(t, c, out=t)
            at = block + _PLACES[i]
            t += a
            if at in vectors:
                t += vectors[at]
            np.add(t, np.array((_SINES[i] + (0 if at in vectors else plain[at])) & 0xFFFFFFFF, np.uint32), out=t)
            left, right = _TURNS[_SHIFTS[i]]
            np.left_shift(t, left, out=a)
            np.right_shift(t, right, out=t)
            a |= t
            a += b
            a, b, c, d = d, a, b, c
        for x, y in zip(state, (a, b, c, d)):
            x += y
    return [x.byteswap() for x in state]


def digits(first: int, last: int, width: int) -> np.ndarray:
    """The decimal digits of first..last-1 with leading zeros, as uint8 characters."""
    x = np.arange(first, last)[:, None] // 10 ** np.arange(width - 1, -1, -1)
    return (x % 10 + ord("0")).astype(np.uint8)


_LAST_FIVE = digits(0, 100_000, 5)


def numbered_hashes(head: bytes, first: int, last: int):
    """For the messages ``head`` + number, number from ``first`` to ``last`` - 1: their 60-bit numbers as in
    ``hashing.hash_wide`` (first 15 hex digits), a vector of up to AT_ONCE at a time."""
    while first < last:
        high, low = divmod(first, len(_LAST_FIVE))
        end = min(last, first - first % AT_ONCE + AT_ONCE)
        if high:
            words = md5_words(head + str(high).encode(), _LAST_FIVE[low : low + end - first])
        else:
            width = len(str(first))
            end = min(end, 10**width)
            words = md5_words(head, digits(first, end, width))
        yield (words[0].astype(np.uint64) << np.uint64(28)) | (words[1] >> np.uint32(4)).astype(np.uint64)
        first = end
