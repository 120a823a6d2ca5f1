"""Known means of a published sample sweep (perturbation 0.05 for both jobs).

The sample itself is not part of this repository: point SWEEP_SAMPLE_DIR at a folder that holds
``result_u_final.csv`` and ``result_alpha_final.csv`` to run this.
"""

import os

import pytest
from brute import same

from scfsweep.plans import analyze
from scfsweep.sources import read_results

SAMPLE = os.environ.get("SWEEP_SAMPLE_DIR")
pytestmark = pytest.mark.skipif(not SAMPLE, reason="SWEEP_SAMPLE_DIR is not set")

# U -> (U response, alpha response) of channels 1 and 4.
CHANNEL_1 = {
    0: (7.49e-17, 20.92737377192534),
    2: (1.3005718291232735, 777.2930302736245),
    4: (3.071076650230504, 1053.7017287286496),
    6: (5.03615572661814, 319.0801587490088),
    8: (7.503167253360763, 234.22071382243857),
    10: (9.666052341698649, 80.22201978112307),
    12: (12.970671786937558, -115.04243740489446),
}
CHANNEL_4 = {
    0: (7.459e-18, 31.30810409309379),
    2: (1.2538929894395061, 140.3210760583749),
    4: (2.8243788541367847, 62.408194881198185),
    6: (4.357392256859259, 27.789395456552892),
    8: (4.234918591978004, 562.087809241799),
    10: (11.621274545111532, 2413.370361311726),
    12: (6.09178075110957, -449.3062861917882),
}
# The alpha responses of channel 4 when the numerator leaves U out.
CHANNEL_4_WITHOUT_U = [31.308104093, 8.065986755, 2.051730237, 1.033147225, 8.160309187, 13.932687421, -2.919309800]


@pytest.fixture(scope="module")
def tables(spark):
    return [read_results(spark, f"{SAMPLE}/result_{job}_final.csv") for job in ("u", "alpha")]


@pytest.mark.parametrize("align", ["position", "key"])
def test_means(tables, align):
    rows = analyze(*tables, u_step=0.05, alpha_step=0.05, align=align).means.collect()
    assert len(rows) == 28
    got = {(r.channel_id, r.u): (r.n1_nf_u, r.n1_nf_alpha) for r in rows}
    for channel, table in ((1, CHANNEL_1), (4, CHANNEL_4)):
        for u, want in table.items():
            assert all(same(a, b) for a, b in zip(got[channel, u], want))


def test_means_without_u(tables):
    rows = analyze(*tables, u_step=0.05, alpha_step=0.05, alpha_includes_u=False).means
    got = [r.n1_nf_alpha for r in rows.filter("channel_id = 4").orderBy("u").collect()]
    assert all(same(a, b, 1e-8) for a, b in zip(got, CHANNEL_4_WITHOUT_U))


def test_total_sizes(tables):
    both = analyze(*tables, u_step=0.05, alpha_step=0.05)
    assert [both.rows[j].count() for j in ("u", "alpha")] == [140, 140]
    first = both.rows["u"].filter("channel_id = 1 and u = 0 and k = 1").first()
    assert first.d_first == -1.0753469909628743 and first.d_last == -1.0753469909628708
