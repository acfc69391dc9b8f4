import itertools

import numpy as np

from farelane.functions import kernels
from farelane.operators import choose as c


def line(*xs, y=0.0):
    return np.array([(x / 1000, y / 1000) for x in xs], float)


SEGMENT = line(0, 1, 2, 3)


def ids(paths):
    return [p.ids for p in paths]


def test_chain_is_one_path():
    m = {1: line(0, 1), 2: line(1, 2), 3: line(2, 3)}
    assert ids(c.source_sink_paths(SEGMENT, m)) == [(1, 2, 3)]
    assert ids(c.choose([SEGMENT], [m])[0]) == [(1, 2, 3)]


def test_first_coordinate_is_one_node():
    """Q11: an edge back to the first coordinate meets the node that leaves it."""
    m = {1: line(0, 1), 2: line(-1, 0)}
    assert ids(c.source_sink_paths(SEGMENT, m)) == [(2, 1)]


def test_gap_below_two_metres_is_bridged():
    near, far = 0.0000135, 0.000027  # 1.5 m and 3 m
    m = {1: line(0, 1), 2: line(1, 3) + [near, 0]}
    assert ids(c.merged(c.source_sink_paths(SEGMENT, m), m)) == [(1, 2)]
    m = {1: line(0, 1), 2: line(1, 3) + [far, 0]}
    assert ids(c.merged(c.source_sink_paths(SEGMENT, m), m)) == [(1,), (2,)]


def test_cycle_has_no_path():
    m = {1: np.array([(0, 0), (1, 0)]) / 1000, 2: np.array([(1, 0), (1, 1)]) / 1000, 3: np.array([(1, 1), (0, 0)]) / 1000}
    assert c.source_sink_paths(SEGMENT, m) == []
    assert c.choose([SEGMENT], [m]) == [[]]


def test_fork_takes_the_longest_compatible():
    m = {1: line(0, 1, 2), 2: line(0, 1, 3)}
    m[2] = np.array([(0, 0), (0.001, 0), (0.001, 0.003)])
    got = c.choose([line(0, 1, 2, 3, 4)], [m])
    assert ids(got[0]) == [(2,)]


def brute(paths):
    n, best, pick = len(paths), -1.0, ()
    for r in range(n + 1):
        for some in itertools.combinations(range(n), r):
            if not any(c.conflict(paths[i], paths[j]) for i, j in itertools.combinations(some, 2)):
                km = sum(paths[i].km for i in some)
                if km > best + 1e-12:
                    best, pick = km, some
    return best


def test_longest_compatible_against_all_subsets():
    rng = np.random.default_rng(1)
    for _ in range(10):
        paths = []
        for i in range(7):
            a = rng.integers(0, 10)
            paths.append(c.Path((i,), line(*range(a, a + rng.integers(2, 6)), y=float(rng.integers(0, 2)))))
        got = c.longest_compatible(paths)
        assert abs(sum(p.km for p in got) - brute(paths)) < 1e-9


def test_groups_without_conflicts_are_decided_apart():
    paths = [c.Path((i,), line(2 * i, 2 * i + 3)) for i in range(12)] + [c.Path((100 + i,), line(0, 1, y=10.0 + i)) for i in range(60)]
    assert len(c.longest_compatible(paths)) == 6 + 60


def test_neighbours_limit_later_choices():
    """The second segment has two candidates of its length; only one starts where the first segment's path ends."""
    first, second = line(0, 1, 2), line(2, 3, 4)
    shifted = line(2, 3, 4) + [0, 0.0001]
    got = c.choose([first, second], [{1: first}, {2: second, 3: shifted}])
    assert ids(got[1]) == [(2,)]


def test_subset_paths_go_and_loop_ends():
    m = {1: line(0, 1), 2: line(1, 2), 3: line(2, 3), 4: line(1, 2) + [0, 1e-6]}
    out = c.merged(c.source_sink_paths(SEGMENT, m), m)
    sets = [set(p.ids) for p in out]
    assert not any(a < b for a in sets for b in sets)
    assert kernels.length(out[0].line) > 0
