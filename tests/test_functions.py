import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scfsweep import functions as fn


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_job_numbers(spark, ansi):
    names = ["./U_2_u/U_2_u_3/S", "./U_10_u/S", "U_0_u_1/S", "./U_-2_u/U_-2_u_1/S", "./U_0.5_u/U_0.5_u_4/S", "x", None]
    rows = [(n,) for n in names]
    assert values(spark, fn.job_u(F.col("n")), rows, "n string") == [2, 10, 0, None, 0, None, None]
    assert values(spark, fn.job_u(F.col("n"), signed=True), rows, "n string") == [2, 10, 0, -2, 0.5, None, None]
    assert values(spark, fn.job_step(F.col("n"), "u"), rows, "n string") == [3, None, 1, 1, 4, None, None]
    alpha = [("./U_4_alpha/U_4_alpha_12/S",), ("./U_99999999999_alpha/S",)]
    assert values(spark, fn.job_step(F.col("n"), "alpha"), alpha, "n string") == [12, None]
    assert values(spark, fn.job_u(F.col("n")), alpha, "n string") == [4, None]
    with pytest.raises(ValueError):
        fn.job_step(F.col("n"), "beta")


def test_perturbed(spark):
    rows = [("./U_2_u/U_2_u_3/S",), ("./U_2_u/S",), ("U_2_u_3/S",), ("U_2_u/S",), ("./U_2_alpha/U_2_alpha_1/S",)]
    assert values(spark, fn.is_perturbed(F.col("n")), rows, "n string") == [True, False, False, False, True]
    assert values(spark, fn.is_perturbed(F.col("n"), "folder"), rows, "n string") == [True, False, True, False, True]
    assert values(spark, fn.all_slashes(F.col("n")), rows, "n string") == [3, 2, 1, 1, 3]
    assert values(spark, fn.seed_of(F.col("n")), rows, "n string") == ["S"] * 5


def test_file_stem(spark):
    rows = [("./U_2_u/S.a.castep",), ("./dir/plain",), ("x.cell",)]
    assert values(spark, fn.file_stem(F.col("n")), rows, "n string") == ["./U_2_u/S.a", "./dir/plain", "x"]


def test_normalise_job(spark):
    rows = [("u",), ("U",), ("alpha",), ("Alpha",), ("ALPHA",), ("",), (None,)]
    assert values(spark, fn.normalise_job(F.col("n")), rows, "n string") == ["u", "u", "alpha", "alpha", None, None, None]


def test_reciprocal_of_zero_is_infinite(spark, ansi):
    got = values(spark, fn.reciprocal(F.col("d")), [(0.0,), (-0.0,), (4.0,), (None,), (math.nan,)], "d double")
    assert got[0] == math.inf and got[1] == math.inf and got[2] == 0.25 and got[3] is None and math.isnan(got[4])


def test_sequences(spark, ansi):
    rows = [
        ("-10", "1", "10"),
        ("0.05", "0.05", "0.25"),
        ("5", "-1", "0"),
        ("0", "0.07", "0.3"),
        ("3", "2", "3"),
        ("3", "2", "1"),
        ("1", "-2", "3"),
        ("1", "0", "3"),
        (None, "1", "3"),
        ("0", "0.1", "100"),
    ]
    args = [F.col(c) for c in ("a", "b", "c")]
    lists = values(spark, fn.steps_list(*args), rows, "a string, b string, c string")
    assert [None if x is None else len(x) for x in lists] == [21, 5, 6, 5, 1, 0, 0, 0, None, 1001]
    assert [float(x) for x in lists[1]] == [0.05, 0.1, 0.15, 0.2, 0.25]
    assert [int(x) for x in lists[2]] == [5, 4, 3, 2, 1, 0]
    assert [float(x) for x in lists[3]] == [0, 0.07, 0.14, 0.21, 0.28]
    counts = values(spark, fn.steps_count(*args), rows[:3], "a string, b string, c string")
    assert counts == [21, 5, 6]


def test_sequence_quotient_rounded_up_adds_no_member(spark):
    # 0.99999999999999 / 0.33333333333333 is a hair under 3.00000000000003, and 1 - 1e-14 over 1/3 + ...
    rows = [("0", "0.33333333333334", "1"), ("0", "1", "2.99999999999999")]
    lists = values(spark, fn.steps_list(F.col("a"), F.col("b"), F.col("c")), rows, "a string, b string, c string")
    assert [len(x) for x in lists] == [3, 3]


def test_random_sequences_match_exact_decimals(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        digits = rnd.choice([0, 1, 2, 6, 13])
        start, step = (Decimal(rnd.randrange(-500, 500)).scaleb(-digits) for _ in range(2))
        end = start + step * rnd.randrange(0, 40) + Decimal(rnd.choice([-1, 0, 0, 1])).scaleb(-digits)
        rows.append((str(start), str(step), str(end)))
    want = []
    for start, step, end in ([Decimal(x) for x in r] for r in rows):
        members = []
        while step and (start <= end if step > 0 else start >= end):
            members.append(start)
            start += step
        want.append(members)
    got = values(spark, fn.steps_list(F.col("a"), F.col("b"), F.col("c")), rows, "a string, b string, c string")
    assert got == want


def test_number_text(spark):
    rows = [("5",), ("-5",), ("5.",), ("+0.5",), (".5",), ("5e-7",), ("2d",), ("",), ("1 2",)]
    text = F.col("n")
    assert values(spark, fn.is_integer_text(text), rows, "n string") == [True] + [False] * 8
    assert values(spark, fn.is_signed_decimal_text(text), rows, "n string") == [True] * 4 + [False] * 5
    assert values(spark, fn.is_number_text(text), rows, "n string") == [True] * 6 + [False] * 3
    assert values(spark, fn.default_if_blank(text, "7"), [("",), (None,), ("3",), ("  ",)], "n string") == ["7", "7", "3", "7"]


def test_fixed_and_scientific_text(spark, ansi):
    decimals = [("10",), ("0.50",), ("0",), ("-2",), ("100.25",), ("0.00000001",)]
    got = values(spark, fn.short_text(F.col("x")), decimals, "x string")
    assert got == ["10", "0.5", "0", "-2", "100.25", "0.00000001"]
    got = values(spark, fn.fixed_text(F.col("x")), [(2.00000001,), (1e-8,), (0.15,)], "x double")
    assert got == ["2.000000010000000", "0.000000010000000", "0.150000000000000"]
    assert values(spark, fn.scientific_text(F.col("x")), [(1e-6,), (5e-8,)], "x double") == ["1.000000e-06", "5.000000e-08"]
