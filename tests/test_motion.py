import numpy as np

from anchorline.operators import motion


def brute_frames(pts, diff, flow, luma):
    """(kind, t_ms_f, strength) by the rules, one frame at a time."""
    diff, flow, luma, pts, n = np.array(diff), np.array(flow), np.array(luma), np.array(pts), len(diff)
    energy = 0.5 * (diff / (diff.max() + 1e-9) + flow / (flow.max() + 1e-9))
    de, dl = np.diff(energy, prepend=energy[0]), np.diff(luma, prepend=luma[0])
    out = []

    def between(a, b, c):
        bend = a - 2 * b + c
        return 0.0 if abs(bend) < 1e-12 else 0.5 * (a - c) / bend

    for i in range(1, n - 1):
        step = pts[i + 1] - pts[i]
        if diff[i] >= diff.mean() + 2.5 * (diff.std() + 1e-9) and diff[i] >= max(diff[i - 1], diff[i + 1]):
            out.append(("cut", pts[i] + between(*diff[i - 1 : i + 2]) * step, diff[i]))
        if de[i] >= de.mean() + 2 * (de.std() + 1e-9) and de[i] >= max(de[i - 1], de[i + 1]):
            out += [(k, pts[i] + between(*de[i - 1 : i + 2]) * step, de[i]) for k in ("motion_spike", "motion")]
        if de[i] <= de.mean() - 2 * (de.std() + 1e-9) and de[i] <= min(de[i - 1], de[i + 1]) and energy[i - 1] > np.median(energy) + energy.std():
            out.append(("motion_stop", pts[i] + between(*(-de[i - 1 : i + 2])) * step, -de[i]))
        a = np.abs(dl)
        if a[i] >= a.mean() + 3 * (dl.std() + 1e-9) and a[i] >= max(a[i - 1], a[i + 1]):
            out.append(("flash", pts[i], a[i]))
    return sorted((k, round(t * 1000, 1), round(float(s), 6)) for k, t, s in out)


def test_frame_events(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for clip in "abc":
        n = 120
        diff, flow, luma = rng.uniform(0, 1, n), rng.uniform(0, 1, n), rng.uniform(100, 110, n)
        diff[[30, 77]] += 9
        flow[50:55] += 6
        luma[90] += 90
        pts = np.cumsum(rng.uniform(0.03, 0.05, n))
        bare = clip == "c"
        rows += [(clip, i, float(pts[i]), float(diff[i]), None if bare else float(flow[i]), float(luma[i])) for i in range(n)]
        want[clip] = brute_frames(pts, diff, diff if bare else flow, luma)
    rows += [("short", 0, 0.0, 1.0, 1.0, 1.0), ("short", 1, 0.1, 9.0, 9.0, 99.0)]
    df = spark.createDataFrame(rows, "clip string, f long, pts_s double, diff double, flow double, luma double")
    got = {}
    for r in motion.frame_events(df).collect():
        got.setdefault(r.clip, []).append((r.kind, r.t_ms_f, round(r.strength, 6)))
    assert {k: sorted(v) for k, v in got.items()} == want and "short" not in got
    assert {k for v in want.values() for k, _, _ in v} == {"cut", "motion_spike", "motion", "motion_stop", "flash"}


def test_class_events(spark):
    """A run of twenty frames over its class's threshold is one event; single frames are smoothed away; an open one ends with the clip."""
    p = {c: np.zeros(100) for c in ("Glass", "Dog", "Speech")}
    p["Glass"][20:40], p["Glass"][41:45], p["Glass"][60] = 0.32, 0.2, 0.9
    p["Dog"][20:40], p["Dog"][70:80] = 0.45, 0.8
    p["Speech"][90:] = 0.5
    rows = [("a", c, i, float(v)) for c, series in p.items() for i, v in enumerate(series)]
    df = spark.createDataFrame(rows, "clip string, class string, frame long, p double")
    got = {(r["class"], r.start, r.end) for r in motion.class_events(df).collect()}
    assert got == {("Glass", 20, 40), ("Dog", 70, 80), ("Speech", 90, 99)}
    rough = {(r["class"], r.start) for r in motion.class_events(df, smooth=False, overrides={"Dog": 0.4}).collect()}
    assert rough == {("Glass", 20), ("Glass", 60), ("Dog", 20), ("Dog", 70), ("Speech", 90)}
