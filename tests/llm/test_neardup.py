"""Candidates of near duplicates: none that maps of whole sets rule out, all that may be linked."""

import numpy as np
import pytest

from phylospark.llm import neardup

CLASSES = "cls long, n long, sketch long, parity array<long>"


def _traits(spark, sets):
    rows = []
    for i, s in enumerate(sets):
        mh = neardup.minhashes(np.sort(s))
        rows.append((i, len(s), neardup._sketch(mh), neardup.parity_map(s).tolist()))
    return neardup._traits(spark.createDataFrame(rows, CLASSES))


def _two(n, shared, seed):
    drawn = np.random.default_rng(seed).integers(1, 1 << 63, 2 * n - shared, dtype=np.uint64)
    return [drawn[:n], drawn[n - shared :]]


@pytest.mark.parametrize("n", [400, 500, 700, 1000])
def test_maps_of_whole_sets_tell_pairs_below_the_bound(n):
    below, above = _two(n, round(n * 2 * 0.7 / 1.7), n), _two(n, -(-n * 2 * 8 // 18), n)
    allowed = 20 * 2 * n / 180
    differ = lambda pair: sum(int(x).bit_count() for x in (neardup.parity_map(pair[0]) ^ neardup.parity_map(pair[1])).view(np.uint64))
    assert differ(below) > allowed >= differ(above)


def test_linked_sets_of_any_size_are_possible(spark):
    for seed, (a, b, shared) in enumerate([(511, 512, 480), (1023, 1024, 950), (300, 360, 297), (1500, 1500, 1340), (5000, 5200, 4700)]):
        drawn = np.random.default_rng(seed).integers(1, 1 << 63, a + b - shared, dtype=np.uint64)
        assert 100 * shared >= 80 * (a + b - shared)
        traits = _traits(spark, [drawn[:a], drawn[a - shared :]])
        both = traits.where("cls = 0").crossJoin(neardup._of_leader(traits).where("l_cls = 1"))
        assert both.where(neardup._possible(80)).count() == 1
