"""Tidied differences: literal cases of each step, least scripts, and texts rebuilt from them."""

import random

import pytest

from scriptorium.operators import align, edits

D, I, E = edits.DELETE, edits.INSERT, edits.EQUAL


def made(segments):
    return edits.Difference([("", t, "") if op == D else ("", "", t) if op == I else (t, "", "") for op, t in segments])


@pytest.mark.parametrize(
    "before,after",
    [
        ([], []),
        ([(D, "ab"), (I, "cd"), (E, "12"), (D, "e")], None),
        ([(D, "abc"), (I, "ABC"), (E, "1234"), (D, "wxyz")], None),
        ([(D, "a"), (E, "b"), (D, "c")], [(D, "abc"), (I, "b")]),
        ([(D, "ab"), (E, "cd"), (D, "e"), (E, "f"), (I, "g")], [(D, "abcdef"), (I, "cdfg")]),
        ([(I, "1"), (E, "A"), (D, "B"), (I, "2"), (E, "_"), (I, "1"), (E, "A"), (D, "B"), (I, "2")], [(D, "AB_AB"), (I, "1A2_1A2")]),
        ([(E, "The c"), (D, "ow and the c"), (E, "at.")], [(E, "The "), (D, "cow and the "), (E, "cat.")]),
        ([(D, "abcxx"), (I, "xxdef")], None),
        ([(D, "abcxxx"), (I, "xxxdef")], [(D, "abc"), (E, "xxx"), (I, "def")]),
        ([(D, "xxxabc"), (I, "defxxx")], [(I, "def"), (E, "xxx"), (D, "abc")]),
        ([(D, "abcd1212"), (I, "1212efghi"), (E, "----"), (D, "A3"), (I, "3BC")], [(D, "abcd"), (E, "1212"), (I, "efghi"), (E, "----"), (D, "A"), (E, "3"), (I, "BC")]),
        ([(E, "AAA\r\n\r\nBBB"), (I, "\r\nDDD\r\n\r\nBBB"), (E, "\r\nEEE")], [(E, "AAA\r\n\r\n"), (I, "BBB\r\nDDD\r\n\r\n"), (E, "BBB\r\nEEE")]),
        ([(E, "AAA\r\nBBB"), (I, " DDD\r\nBBB"), (E, " EEE")], [(E, "AAA\r\n"), (I, "BBB DDD\r\n"), (E, "BBB EEE")]),
        ([(E, "The-c"), (I, "ow-and-the-c"), (E, "at.")], [(E, "The-"), (I, "cow-and-the-"), (E, "cat.")]),
        ([(E, "a"), (D, "a"), (E, "ax")], [(D, "a"), (E, "aax")]),
        ([(E, "xa"), (D, "a"), (E, "a")], [(E, "xaa"), (D, "a")]),
        ([(E, "The xxx. The "), (I, "zzz. The "), (E, "yyy.")], [(E, "The xxx."), (I, " The zzz."), (E, " The yyy.")]),
        ([(E, "x"), (I, "ba"), (E, "b"), (D, "c")], [(E, "xb"), (D, "c"), (I, "ab")]),
    ],
)
def test_tidied(before, after):
    assert made(before).tidied().segments() == (before if after is None else after)


@pytest.mark.parametrize("seed", range(60))
def test_least_script(seed):
    rng = random.Random(seed)
    a = "".join(rng.choice("ab \n" if seed % 2 else "abcdefgh") for _ in range(rng.randrange(60)))
    b = "".join(rng.choice("ab \n" if seed % 2 else "abcdefgh") for _ in range(rng.randrange(60))) if seed % 3 else a[::2] + "x" + a[7:]
    found = edits.script(a, b)
    assert "".join(e + g for e, g, _ in found) == a and "".join(e + n for e, _, n in found) == b
    assert sum(len(e) for e, _, _ in found) == align.lcs_length(a, b)
    tidy = edits.difference(a, b)
    assert "".join(t for op, t in tidy if op != I) == a and "".join(t for op, t in tidy if op != D) == b
    assert all(t for _, t in tidy) and all(not (p[0] == q[0]) for p, q in zip(tidy, tidy[1:]))


def test_words_and_counts():
    assert edits.difference("a mouse is here", "a house was here") != []
    got = edits.difference("The quick brown fox.", "The slow brown fox.")
    assert got == [(E, "The "), (D, "quick"), (I, "slow"), (E, " brown fox.")]
    assert edits.overlap("abcabc", "abcabcd") == 6 and edits.overlap("fi", "ﬁi") == 0 and edits.overlap("aab", "abx") == 2 and edits.overlap("", "a") == 0


def test_long_texts_take_little_time():
    rng = random.Random(2)
    a = "".join(rng.choice("abcdefghij ") for _ in range(30_000))
    b = a[:9000] + "ZZ" + a[9100:20_000] + a[21_000:] + "end"
    assert edits.difference(a, b)[0] == (E, a[:9000])


def test_columns(spark):
    rows = [(1, "The quick fox", "The slow fox"), (2, "same", "same"), (3, None, "x"), (4, "", "new"), (5, "gone", "")]
    df = spark.createDataFrame(rows, "id int, a string, b string").select("id", edits.edit_counts("a", "b").alias("c"), edits.tidy_diff("a", "b").alias("d")).select("id", "c.*", "d")
    got = {r["id"]: r for r in df.collect()}
    assert {k: tuple(r)[1:4] for k, r in got.items()} == {1: (2, 5, 4), 2: (0, 0, 0), 3: (0, 0, 0), 4: (1, 0, 3), 5: (1, 4, 0)}
    assert got[3]["d"] is None and [tuple(x) for x in got[1]["d"]] == [("equal", "The ", 0), ("delete", "quick", 4), ("insert", "slow", 9), ("equal", " fox", 9)]
