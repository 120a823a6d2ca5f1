"""Plain-Python answers to check the operators against, and a generator of small sweeps."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

COLUMNS = ("run_id", "jobname", "channel_id", "spin", "before_scf", "first_scf", "last_scf", "converged")
SCHEMA = (
    "run_id string, jobname string, channel_id int, spin int, before_scf double, first_scf double, "
    "last_scf double, converged boolean"
)


def sweep(job, run="r1", channels=(1, 2), us=(0, 2, 4), steps=3, seed="SLAB", keep=1.0, rnd=None):
    """Result rows of a sweep with occupations on a 1/128 grid; ``keep`` drops some jobs."""
    rnd = rnd or random.Random(f"{job}{run}")
    rows = []
    for u in us:
        for k in range(steps + 1):
            if k and rnd.random() > keep:
                continue
            base = f"U_{u}_{job}"
            name = f"./{base}/{seed}" if k == 0 else f"./{base}/{base}_{k}/{seed}"
            for channel in channels:
                for spin in (1, 2):
                    before, first, last = (rnd.randrange(1, 600) / 128 for _ in range(3))
                    rows.append((run, name, channel, spin, before, first, last, rnd.random() < 0.8))
    return rows


def _number(pattern, text):
    found = re.search(pattern, text)
    return int(found.group(1)) if found else None


def _inverse(d):
    return math.inf if d == 0 else 1.0 / d


def response(rows, job, p, add_u=True):
    """{(run, jobname, channel): dict} of perturbed jobs."""
    sums = defaultdict(lambda: [0.0, 0.0, 0.0])
    for run, name, channel, _spin, *occupations, _converged in rows:
        if name.count("/") == 3:
            acc = sums[run, name, channel]
            for i, x in enumerate(occupations):
                acc[i] += x or 0.0
    out = {}
    for key, (s0, s1, sf) in sums.items():
        u, k = _number(r"U_(\d+)", key[1]), _number(job + r"_(\d+)", key[1])
        n = k * p + (u if job == "alpha" and add_u else 0)
        first, last = n * _inverse(s1 - s0), n * _inverse(sf - s0)
        out[key] = dict(
            u=u, k=k, d_first=s1 - s0, d_last=sf - s0, slope_first=first, slope_last=last, pert=k * p, n1_nf=first - last
        )
    return out


def channel_rows(resp):
    """{run: {channel: rows in (u, k, name) order}}."""
    runs = defaultdict(lambda: defaultdict(list))
    for (run, name, channel), r in resp.items():
        runs[run][channel].append((r["u"], r["k"], name, r["pert"], r["n1_nf"]))
    for channels in runs.values():
        for rows in channels.values():
            rows.sort(key=lambda r: (-1 if r[0] is None else r[0], -1 if r[1] is None else r[1], r[2]))
    return runs


def merged_by_position(resp_u, resp_alpha):
    """(run, channel, position, u, u_pert, n1_nf_u, alpha_pert, n1_nf_alpha) tuples."""
    us, alphas = channel_rows(resp_u), channel_rows(resp_alpha)
    out = []
    for run in us.keys() & alphas.keys():
        for cu, ca in zip(sorted(us[run]), sorted(alphas[run])):
            left, right = us[run][cu], alphas[run][ca]
            for i in range(max(len(left), len(right))):
                l = left[i] if i < len(left) else (None,) * 5
                r = right[i] if i < len(right) else (None,) * 5
                out.append((run, cu, i + 1, l[0], l[3], l[4], r[3], r[4]))
    return out


def means(merged):
    """{(run, channel, u): (mean u, mean alpha)} of merged rows."""
    groups = defaultdict(lambda: ([], []))
    for run, channel, _position, u, _up, nu, _ap, na in merged:
        for side, value in zip(groups[run, channel, u], (nu, na)):
            if value is not None:
                side.append(value)
    return {k: tuple(sum(v) / len(v) if v else None for v in sides) for k, sides in groups.items()}


def same(a, b, tol=1e-9):
    if a is None or b is None:
        return a is b
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return a == b or abs(a - b) <= tol + tol * abs(b)
