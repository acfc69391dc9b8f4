import itertools
import math

import numpy as np

from farelane.functions import kernels as k
from farelane.functions import routes as r

STEP = 0.002


def grid(n=5):
    """Streets of a grid, each block in both directions."""
    out = []
    for i, j in itertools.product(range(n), range(n)):
        for di, dj in ((1, 0), (0, 1)):
            if i + di < n and j + dj < n:
                a, b = np.array([i, j]) * STEP, np.array([i + di, j + dj]) * STEP
                out += [np.array([a, b]), np.array([b, a])]
    return out


def test_route_against_all_simple_ways():
    rng = np.random.default_rng(0)
    lines = [x for x in grid(3) if rng.random() < 0.75]
    roads = r.Roads(lines)

    def brute(a, b):
        """Least kilometres over all ways that use a road once."""
        best = b.km - a.km if a.road == b.road and b.km >= a.km else math.inf

        def walk(at, km, used):
            nonlocal best
            for n, x in enumerate(lines):
                if (x[0].round(6) == lines[at][-1].round(6)).all() and (n not in used or n == b.road):
                    if n == b.road:
                        best = min(best, km + b.km)
                    if n not in used:
                        walk(n, km + roads.km[n], used | {n})

        walk(a.road, roads.km[a.road] - a.km, {a.road})
        return best

    for _ in range(25):
        p, q = rng.random((2, 2)) * STEP * 2
        a, b = roads.places(p, r.ROUTE)[0], roads.places(q, r.ROUTE)[0]
        leg = roads.leg(a, b, roads.reach(a.road, 100.0))
        want = brute(a, b)
        assert (leg is None and want == math.inf) or math.isclose(leg[0], want, abs_tol=1e-9)
        if leg:
            way = roads.route(np.array([p, q]))
            assert way is None or math.isclose(k.length(way), want, abs_tol=1e-4)


def test_waypoints_and_slices():
    line = np.array([(0, 0), (0.01, 0), (0.01, 0.04)])
    for n in (10, 4):
        w = r.waypoints(line, n)
        at = [k.nearest_on_line(line, p)[1] for p in w]
        assert len(w) == n + 1 and np.allclose(at[:-1], k.length(line) * np.arange(n) / n, atol=1e-6) and (w[-1] == line[-1]).all()
    got = r.slices(line)
    assert [k.length(x) < 1.2 for x in got[:3]] == [True, False, False]  # two smooth parts, and both together
    assert math.isclose(k.length(got[2]), k.length(line), rel_tol=1e-9)
    assert all(k.length(x) <= r.CHUNK_KM + 1e-3 for x in got[3:]) and math.isclose(k.length(got[-1]), r.CHUNK_KM, rel_tol=1e-3)


def test_a_feature_beside_the_roads_is_led_along_them():
    lines = grid()
    feature = np.array([(0, 0), (2, 0), (2, 2)]) * STEP + [0.00012, -0.00012]
    for method in (r.ROUTE, r.MATCH):
        ways = r.by_distance(feature, r.Roads(lines), method)
        assert ways and r.length_error(feature, ways[0]) <= min(r.length_error(feature, w) for w in ways) <= r.LENGTH_ERROR
        dev = min(k.projections(x, ways[0])[1].min() for x in lines)
        assert dev < 1e-6
        smooth = r.by_bearing(feature, r.Roads(lines), method)
        assert smooth and all(len(x) > 1 for x in smooth)
    assert r.assisted(feature, [], r.ROUTE, r.DISTANCE) == []


def test_a_route_that_is_too_long_is_refused():
    one_way = [np.array([(0, 0), (0, 0.01)]), np.array([(0, 0.01), (0.01, 0.01)]), np.array([(0.01, 0.01), (0.01, 0)])]
    across = np.array([(0, 0), (0.01, 0)])
    assert r.by_distance(across, r.Roads(one_way), r.ROUTE) == []
    (only,) = r.by_bearing(across, r.Roads(one_way), r.ROUTE)
    assert (only == across).all()  # the slice itself
    (kept,) = r.by_bearing(across, r.Roads(one_way), r.ROUTE, compat=True)
    assert not np.array_equal(kept, across)
