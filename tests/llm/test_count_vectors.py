"""Bounds by packed count vectors never fall below the true overlap."""

import numpy as np
from hypothesis import given, settings, strategies as st

from tidemark.llm import jaccard_join as jj


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90_000), min_size=2, max_size=5), st.integers(0, 10**6))
def test_packed_counts_bound_the_overlap(sizes, seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 1 << 62, 100_000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, n, replace=False)) for n in sizes]
    before = np.r_[0, np.cumsum([len(x) for x in sets])]
    n = np.diff(before)
    blobs = [v.tobytes() for v in jj._packed(jj._fine_vectors(np.concatenate(sets), before))]
    fine = jj._unpacked(blobs, n)
    boxes = fine.reshape(len(sets), jj.GROUPS, -1).sum(axis=2)
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            assert both <= np.minimum(fine[a], fine[b]).sum() <= np.minimum(boxes[a], boxes[b]).sum()
