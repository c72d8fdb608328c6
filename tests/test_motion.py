import numpy as np
import pytest

from tidecycle.functions import motion, pixels


def scene(rng, h, w):
    """A smooth random picture, defined everywhere."""
    waves = [(rng.normal(size=2) * 0.25, rng.uniform(0, 6.28), rng.uniform(5, 30)) for _ in range(40)]
    ys, xs = np.mgrid[0:h, 0:w].astype(float)
    return lambda dx, dy: np.clip(128 + sum(a * np.sin(k[0] * (xs - dx) + k[1] * (ys - dy) + p) for k, p, a in waves) * 0.5, 0, 255)


@pytest.mark.parametrize("dx,dy", [(0, 0), (3, -2), (-7, 5), (0, 11)])
def test_circular_shifts_are_exact(dx, dy):
    img = np.random.default_rng(1).integers(0, 256, (48, 64)).astype(np.uint8)
    x, y = motion.phase_shift(np.roll(img, (dy, dx), (0, 1)), img)
    assert (x, y) == pytest.approx((-dx, -dy), abs=0.02)


@pytest.mark.parametrize("dx,dy", [(2, 1), (-4, 3), (5, -6)])
def test_moving_scenes(dx, dy):
    wide = np.random.default_rng(7).integers(0, 256, (140, 170)).astype(float)
    wide = (wide + np.roll(wide, 1, 0) + np.roll(wide, 1, 1) + np.roll(wide, (1, 1), (0, 1))).astype(int) // 4  # a camera pans over a larger picture
    before, now = (wide[20 - y : 116 - y, 20 - x : 148 - x].astype(np.uint8) for x, y in ((0, 0), (dx, dy)))
    x, y = motion.phase_shift(now, before)
    assert (x, y) == pytest.approx((-dx, -dy), abs=0.1)
    still = motion.stabilized(now, (x, y))
    inner = np.s_[10:-10, 10:-10]
    left, moved = np.abs(still[inner].astype(int) - before[inner]).mean(), np.abs(now[inner].astype(int) - before[inner]).mean()
    assert left < 3 and left < moved / 4


def test_flat_frames_and_small_ones():
    assert motion.phase_shift(np.full((8, 8), 9), np.full((8, 8), 4)) == (0.0, 0.0)
    assert motion.phase_shift(np.zeros((8, 8)), np.zeros((8, 8))) == (0.0, 0.0)
    assert motion.phase_shift(np.array([[5]]), np.array([[5]])) == (0.0, 0.0)
    assert motion.hysteresis_density(np.zeros((0, 5), np.uint8)) == 0.0 and motion.hysteresis_density(np.zeros((1, 1), np.uint8)) == 0.0


def test_warp_by_hand():
    img = np.arange(20, dtype=np.uint8).reshape(4, 5) * 10
    assert (motion.warp(img, np.array([[1, 0, 1], [0, 1, 0]]))[:, 1:] == img[:, :-1]).all()
    half = motion.warp(img, np.array([[1.0, 0, 0.5], [0, 1, 0]]))
    assert half[0].tolist() == [0, 5, 15, 25, 35]
    assert (motion.warp(img, np.array([[0, 1, 0], [1, 0, 0]]))[:4, :4] == img[:4, :4].T).all()


def plain_edges(g, weak=50, strong=150):
    """Pixel by pixel."""
    h, w = g.shape
    px = lambda y, x: int(g[min(max(y, 0), h - 1), min(max(x, 0), w - 1)])
    grad = {}
    for y in range(h):
        for x in range(w):
            gx = sum(c * (px(y + i, x + 1) - px(y + i, x - 1)) for i, c in ((-1, 1), (0, 2), (1, 1)))
            gy = sum(c * (px(y + 1, x + i) - px(y - 1, x + i)) for i, c in ((-1, 1), (0, 2), (1, 1)))
            grad[y, x] = gx, gy
    mag = lambda y, x: sum(map(abs, grad.get((y, x), (0, 0))))
    keep = set()
    for (y, x), (gx, gy) in grad.items():
        m = mag(y, x)
        if abs(gy) < motion.TAN * abs(gx):
            ok = m > mag(y, x - 1) and m >= mag(y, x + 1)
        elif abs(gx) <= motion.TAN * abs(gy):
            ok = m > mag(y - 1, x) and m >= mag(y + 1, x)
        else:
            s = 1 if (gx < 0) == (gy < 0) else -1
            ok = m > mag(y - 1, x - s) and m > mag(y + 1, x + s)
        if ok and m > weak:
            keep.add((y, x))
    out, todo = set(), [p for p in keep if mag(*p) > strong]
    while todo:
        y, x = todo.pop()
        if (y, x) not in out:
            out.add((y, x))
            todo += [(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (y + i, x + j) in keep]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_edges_against_plain_loops(seed):
    rng = np.random.default_rng(seed)
    img = [rng.integers(0, 256, (17, 23)), rng.integers(0, 40, (20, 20)), np.kron(rng.integers(0, 256, (4, 5)), np.ones((6, 6))), scene(rng, 25, 30)(0, 0), np.add.outer(np.arange(20), np.arange(20)) * 6, rng.integers(0, 2, (9, 40)) * 255][seed].astype(np.uint8)
    found = {tuple(p) for p in np.argwhere(motion.hysteresis_edges(img)).tolist()}
    assert found == plain_edges(img)


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_blocks_of_a_recording(spark, block):
    """Features do not depend on how a recording is cut, gaps in the numbers included."""
    rng = np.random.default_rng(5)
    frames = [(v, i, 12, 16, rng.integers(0, 256, (12, 16, 3)).astype(np.uint8).tobytes()) for v, n in (("a", 11), ("b", 1), ("c", 7)) for i in range(0, n * 3, 1 + 2 * (v == "c"))]
    df = spark.createDataFrame(frames, "video_id string, frame_idx int, h int, w int, data binary").repartition(5)
    rois = {"left": (0.0, 0.0, 0.5, 1.0), "all": (0.0, 0.0, 1.0, 1.0)}
    got = {(r.video_id, r.frame_idx, r.roi_name): r for r in pixels.extract(df, rois, stabilize=True, block=block).collect()}
    assert len(got) == 2 * len(frames)
    before = None
    for v, i, h, w, data in frames:
        img = pixels.frame(data, h, w)
        gray = pixels.luma(img)
        first = before is None or before[0] != v
        last = None if first else before[1]
        r = got[v, i, "all"]
        assert r.motion_intensity == pytest.approx(pixels.motion(gray, last), abs=1e-3)
        shift = (0.0, 0.0) if first else motion.phase_shift(gray, last)
        assert (r.global_motion_x, r.global_motion_y) == pytest.approx(shift, abs=1e-4)
        assert r.local_motion_intensity == pytest.approx(0 if first else pixels.motion(motion.stabilized(gray, shift), last), abs=1e-3)
        assert got[v, i, "left"].canny_density == pytest.approx(motion.hysteresis_density(gray[:, :8]), abs=1e-6)
        before = v, gray
