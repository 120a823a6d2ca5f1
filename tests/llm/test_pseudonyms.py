"""Pseudonyms come back, stay apart, and leave nothing of a value in clear text."""

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scfsweep.llm.pseudonyms import KEY_SETTING, Pseudonyms, op5_pseudonyms, pseudonymised

KEY = b"test"
MAKE, UNDO = Pseudonyms(KEY), Pseudonyms(KEY, undo=True)

HEX, DIGITS, LOWER, UPPER = "0123456789abcdef", "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
chars = lambda letters, low, high: st.text(st.sampled_from(letters), min_size=low, max_size=high)
SECRETS = st.one_of(chars(HEX, 8, 150), chars(HEX + "gh", 8, 20), chars(DIGITS + "z", 8, 12), chars(LOWER + UPPER + DIGITS, 8, 300), chars(HEX + "XYZ", 60, 70))
VALUES = {
    "secret": SECRETS.map(lambda v: f"password={v}"),
    "bearer": chars(LOWER + DIGITS, 8, 90).filter(lambda v: any(c in DIGITS for c in v)).map(lambda v: f"Bearer {v}"),
    "key_id": st.one_of(chars(UPPER + "234567", 16, 16), chars(UPPER + "2345670", 16, 16), chars(UPPER + DIGITS, 16, 16)).map(lambda v: f"AKIA{v}"),
    "email": chars(LOWER + DIGITS + "äöüéßÅØ", 1, 200).map(lambda v: f"{v}@example.org"),
    "date": st.dates().map(str),
    "ip": st.ip_addresses(v=4).map(str),
    "ipv6": st.ip_addresses(v=6).map(str).filter(lambda v: any(c in DIGITS for c in v) and v.count(":") > 1 and "." not in v),
    "ssn": st.tuples(st.integers(1, 665), st.integers(1, 99), st.integers(1, 9999)).map(lambda t: f"{t[0]:03d}-{t[1]:02d}-{t[2]:04d}"),
}


@pytest.mark.parametrize("kind", VALUES)
def test_every_pseudonym_comes_back(kind):
    @given(VALUES[kind])
    @settings(max_examples=150, deadline=None)
    def check(value):
        new, found = MAKE(f"x {value} y")
        assert found == {kind: 1}
        assert UNDO(new)[0] == f"x {value} y"

    check()


@pytest.mark.parametrize(
    "values",
    [
        [f"password={k:07d}z" for k in range(2000)] + [f"password={k * 65537 % 2**32:08x}" for k in range(2000)],
        [f"AKIA{'A' * 14}{a}{b}" for a, b in itertools.product(UPPER + DIGITS, repeat=2)],
    ],
    ids=["secrets", "keys"],
)
def test_different_values_stay_different(values):
    new = [MAKE(v)[0] for v in values]
    assert len(set(new)) == len(set(values))
    assert [UNDO(n)[0] for n in new] == values


@pytest.mark.parametrize(
    "text, clear",
    [
        ("token=" + "aB3" * 100, "aB3aB3"),
        ("token=eyJhbGciOi.eyJzdWIiOiIxMjM0.SflKxwRJSMeKKF2QT4", "eyJzdWIiOiIxMjM0"),
        ("password: abc!defgh1 now", "defgh"),
        ("mail jürgen.müller@example.org now", "rgen"),
        ("mail " + "a" * 90 + "@example.org", "a" * 80),
        ("at 2024-02-29T10:00 sharp", "2024-02-29"),
        ("born 1799-12-31.", "1799-12-31"),
        ("from 2001:db8::ff00:42:8329 on", "ff00:42:8329"),
        ("Authorization: Bearer abcdef1234567890", "abcdef1234567890"),
    ],
)
def test_nothing_is_left_in_clear_text(text, clear):
    new, found = MAKE(text)
    assert found and clear not in new and len(new) == len(text)
    assert UNDO(new)[0] == text


def test_words_are_left_alone():
    for text in ("the bearer instruments of war", "at 10:20:30 or std::vector", "face::bad", "ratio 3:4:5", "a.b.c-d+e " * 2000, "see 2024-02-30", "x" * 100_000):
        assert MAKE(text) == (text, {})


def test_key_of_the_session(spark, tmp_path):
    rows = [(1, "password=12345678"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set(KEY_SETTING, "own key")
    try:
        got = {r.doc_id: r.text for r in op5_pseudonyms(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset(KEY_SETTING)
    back = pseudonymised(spark.createDataFrame(list(got.items()), "doc_id long, text string"), b"own key", undo=True)
    assert got[1] != rows[0][1] and {r.doc_id: r.text for r in back.collect()} == dict(rows)
