"""The layout of packed pieces on histograms of many kinds, without Spark."""

import numpy as np
import pytest

from sentispark.llm import packing

CAPACITY = 4096
RANDOM = np.random.default_rng(1)


def laid_out(lengths, capacity):
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.Units.of(counts, max(1, capacity // packing.CLASSES))
    layout = packing.arrange(plan.counts, capacity // plan.grain)
    length = np.repeat(np.arange(capacity + 1), counts)
    rank = np.concatenate([np.arange(c) for c in counts])
    kind, rank, place = plan.find(length, rank)
    run = np.searchsorted(layout["key"], (kind << 48) + rank, side="right") - 1
    return length, layout["sequence"][run] + rank - layout["rank"][run], layout["slot"][run] * plan.grain + place


@pytest.mark.parametrize("lengths, capacity, spare", [
    (RANDOM.integers(5, 61, 50_000), CAPACITY, 0.003), (np.ones(100_000, int), CAPACITY, 0), (np.full(7, 4096), CAPACITY, 0),
    (np.clip(RANDOM.lognormal(6, 0.8, 20_000).astype(int) + 1, 1, CAPACITY), CAPACITY, 0.01), (np.array([4096, 4096, 1, 2, 3]), CAPACITY, 0),
    (np.array([1]), CAPACITY, 0), (np.array([3, 3, 3, 3, 3, 2, 1]), 5, 0), (np.array([1, 1, 2]), 2, 0), (RANDOM.integers(1, 4097, 3_000), CAPACITY, 0.03),
    (np.concatenate([np.full(999, 512), np.full(777, 513), np.full(3, 2)]), CAPACITY, 0.01)])
def test_every_piece_has_a_place_of_its_own(lengths, capacity, spare):
    length, sequence, slot = laid_out(lengths, capacity)
    assert sorted(length) == sorted(lengths) and np.bincount(sequence, length).max() <= capacity
    assert len(set(zip(sequence.tolist(), slot.tolist()))) == len(lengths)
    best = sum(n for _, n in packing.best_fit(np.bincount(lengths, minlength=capacity + 1), capacity))
    assert len(set(sequence.tolist())) <= best * (1 + spare) + 1
