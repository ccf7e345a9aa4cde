"""A small row-by-row model of the enrichment rules, for comparison only."""

from datetime import datetime, timedelta, timezone
from fractions import Fraction
from math import sqrt
import random

EPOCH = datetime(2024, 3, 1, tzinfo=timezone.utc)


def make_trades(seed, count, symbols=("AAA", "BBB"), mean_step_ms=1250):
    """Ties, long gaps, and gaps of exactly the default limits."""
    rng = random.Random(seed)
    clock = {s: 0 for s in symbols}
    rows = []
    for i in range(count):
        s = rng.choice(symbols)
        dice = rng.random()
        if dice < 0.2:
            step = 0
        elif dice < 0.21:
            step = rng.randint(10_000, 70_000)
        elif dice < 0.214:
            step = rng.choice([10_000, 60_000, 10_001, 60_001, 400_000])
        else:
            step = rng.randint(1, 2 * mean_step_ms)
        clock[s] += step
        at = EPOCH + timedelta(milliseconds=clock[s])
        rows.append((s, rng.randint(1, 90_000) / 100, rng.randint(1, 9_000) / 100, at, i))
    return rows


def run_model(rows, params):
    """{trade_id: (n, z, anomaly, paused)} by following every rule literally."""
    def sec(td):
        return Fraction(td // timedelta(microseconds=1), 1_000_000)

    state, out = {}, {}
    for symbol, price, quantity, at, trade_id in sorted(rows, key=lambda r: (r[3], r[4])):
        st = state.setdefault(symbol, {"win": [], "last": None, "paused": False, "from": None})
        if st["last"] is not None:
            gap = sec(at - st["last"])
            if gap > params.stale_purge_seconds:
                st["win"] = []
            if gap > params.stale_purge_seconds or gap > params.data_gap_reset_seconds:
                st["paused"], st["from"] = True, at
        st["win"] = [e for e in st["win"] if sec(at - e[0]) <= params.window_seconds]
        usd = round(price * quantity, 4)
        win = st["win"]
        if st["paused"]:
            ready = sum(e[0] >= st["from"] for e in win) >= params.warmup_min_samples
            if ready:
                st["paused"] = False
        else:
            ready = len(win) >= params.warmup_min_samples
        z = None
        if ready and len(win) >= 2:
            xs = [Fraction(round(e[1] * 10_000), 10_000) for e in win]
            mu = sum(xs) / len(xs)
            var = sum((x - mu) ** 2 for x in xs) / len(xs)
            sigma = max(sqrt(var), abs(float(mu)) * 0.001, 1.0)
            z = (usd - float(mu)) / sigma
        out[trade_id] = (len(win), z, z is not None and abs(z) > params.z_score_threshold, st["paused"])
        win.append((at, usd))
        st["last"] = at
    return out
