import numpy as np
import pytest

from custlens.llm.elias_fano import EliasFano, encode


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (5, 5), (1000, 100), (3000, 10**6), (4000, 2**62)])
def test_round_trip_select_and_successor(n, universe):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
    data = b"x" * 16 + encode(v, universe)
    ef = EliasFano(data, 16)
    assert ef.end == len(data)
    assert (ef.all() == v).all()
    if n:
        at = rng.integers(0, n, 200)
        assert (ef.get(at) == v[at]).all()
    ask = np.concatenate([rng.integers(0, universe, 200, dtype=np.uint64), v[:50], [np.uint64(universe + 5)]])
    assert (ef.find(ask) == np.searchsorted(v, ask)).all()
    there = np.isin(ask, v)
    assert ((ef.index(ask) >= 0) == there).all()


def test_space_is_near_the_bound():
    v = np.arange(0, 10**6, 10, dtype=np.uint64)
    assert len(encode(v)) * 8 / len(v) < 2 + np.log2(10) + 1
