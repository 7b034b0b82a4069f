"""Suffix arrays and repeated windows against sorting and counting."""

import random

import numpy as np
import pytest

from varstrata.llm import suffix
from varstrata.llm.anchors import Hashes, segments, sliding_min
from varstrata.llm.suffix import common_prefixes, repeated_windows, suffix_array


def texts():
    rng = random.Random(1)
    yield from ([], [0], [1, 1], [3, 0], [0, 3, 0], [1] * 50, [2, 1] * 30, [1, 2] * 30, [1, 1, 2] * 20 + [0])
    for _ in range(300):
        yield [rng.randrange(rng.choice([1, 2, 3, 5, 300, 900])) for _ in range(rng.randrange(1, 200))]
    word = [rng.randrange(4) for _ in range(40)]
    yield word * 6 + [1] + word * 3


@pytest.mark.parametrize("induce", ["waves", "steps", "both"])
def test_suffix_array(induce, monkeypatch):
    if induce == "waves":
        monkeypatch.setattr(suffix, "_induce_steps", suffix._induce_waves)
    if induce == "steps":
        monkeypatch.setattr(suffix, "_induce_waves", suffix._induce_steps)
    for text in texts():
        order = suffix_array(np.array(text, np.int64))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_doubled_ranks(monkeypatch):
    for text in texts():
        if text:
            assert suffix._double_ranks(np.array(text, np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    # suffix by suffix takes half of a shard's time: no text of bytes, however deep its repeats, may need it
    monkeypatch.setattr(suffix, "_induce_steps", None)
    rng = np.random.default_rng(3)
    word = rng.integers(97, 123, 5000)
    text = np.concatenate([word, rng.integers(97, 123, 5000), word, word])
    raw = text.astype(np.uint8).tobytes()
    assert suffix_array(text).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_common_prefixes():
    for text in texts():
        text = np.array(text, np.int64)
        order = suffix_array(text)
        for most in (3, 1000):
            want = [0] * min(1, len(text))
            for a, b in zip(order, order[1:], strict=False):
                k = 0
                while k < most and max(a, b) + k < len(text) and text[a + k] == text[b + k]:
                    k += 1
                want.append(k)
            assert common_prefixes(text, order, most).tolist() == want


def test_repeated_windows():
    rng = random.Random(2)
    for _ in range(60):
        parts = [bytes(rng.choices(b"ab\0\xff", weights=[9, 5, 1, 1], k=rng.randrange(8, 60))) for _ in range(rng.randrange(1, 8))]
        windows = np.array([len(p) - 6 for p in parts])
        got = repeated_windows(parts, windows, 7)
        count = {}
        for p, w in zip(parts, windows, strict=True):
            for i in range(w):
                count[p[i : i + 7]] = count.get(p[i : i + 7], 0) + 1
        assert [g.tolist() for g in got] == [[count[p[i : i + 7]] > 1 for i in range(w)] for p, w in zip(parts, windows, strict=True)]


def test_anchors():
    rng = np.random.default_rng(0)
    for size in (0, 5, 19, 20, 300):
        raw = rng.integers(97, 100, size).astype(np.uint8)
        start, windows, anchor, place = segments(raw, Hashes(raw), 20, 6)
        assert windows.sum() == max(0, size - 19) and (np.diff(start) == windows[:-1]).all()
        assert (place >= start + windows - 1).all() and (place <= start + 14).all()
        keys = {}
        for s, w, a in zip(start, windows, anchor, strict=True):
            for p in range(s, s + w):
                assert keys.setdefault(raw[p : p + 20].tobytes(), a) == a
    values = rng.integers(0, 99, 50).astype(np.uint64)
    assert sliding_min(values, 7).tolist() == [min(values[i : i + 7]) for i in range(44)]
