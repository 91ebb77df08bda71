"""Cross-check of the sparse fill/decay expansion against a direct implementation."""

import random

import pytest

from hourglass.operators import timeseries as E


def _brute(obs, feats, horizon, decay_rate=4 / 3, decay=True):
    """Dense grid per stay, per-stay forward fill, decay mask, 0 < time < horizon."""
    out = {}
    stays = sorted({s for s, _, _, _ in obs})
    for s in stays:
        hours = [t for st, _, t, _ in obs if st == s]
        lo, hi = min(hours), min(max(hours), horizon - 1)
        if lo > hi:
            continue
        for f in feats:
            vals = {t: v for st, ff, t, v in obs if st == s and ff == f}
            last_v, last_t = None, None
            for t in range(lo, hi + 1):
                if t in vals:
                    last_v, last_t = vals[t], t
                if t <= 0:
                    continue
                if last_t is None:
                    m = 0.0
                elif t == last_t:
                    m = 1.0
                else:
                    m = 1.0 / ((t - last_t) * decay_rate) if decay else 0.0
                out[(s, t, f)] = (0.0 if last_v is None else last_v, m)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_expansion_matches_bruteforce(spark, seed):
    rnd = random.Random(seed)
    feats = ["a", "b", "c"]
    obs, seen = [], set()
    for s in range(1, 6):
        for _ in range(rnd.randint(1, 12)):
            f, t = rnd.choice(feats[:2]), rnd.randint(-24, 30)   # "c" is never observed
            if (s, f, t) not in seen:
                seen.add((s, f, t))
                obs.append((s, f, t, round(rnd.uniform(-3, 3), 3)))
    horizon = 20
    hourly = spark.createDataFrame(obs, "stay long, feature string, time long, value double")
    vocab = spark.createDataFrame([(f,) for f in feats], "feature string")
    for decay in (True, False):
        got = {(r.stay, r.time, r.feature): (r.value, r.mask)
               for r in E.resample_and_mask(hourly, vocab, decay=decay, horizon=horizon).collect()}
        want = _brute(obs, feats, horizon, decay=decay)
        assert got.keys() == want.keys()
        for k in want:
            assert got[k] == pytest.approx(want[k]), k
