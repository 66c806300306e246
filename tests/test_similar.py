"""The index of letter pairs loses no pair: against a scan of all names."""

import random

import pytest

from readtrack.catalog import aliases
from readtrack.operators import similar
from readtrack.operators.resolve import nearest_alias, partial_ratio


def bent(r, word):
    i = r.randrange(len(word))
    return r.choice([word[:i] + word[i + 1 :], word[:i] + r.choice("abkz ") + word[i + 1 :], word[: i - 1] + word[i : i + 1] + word[i - 1 : i] + word[i + 1 :] if i else word, word + r.choice(["x", " lama", "2"]), word[:i] + "q" + word[i:]])


@pytest.mark.parametrize("letters", ["ab", "abcde", "abcdefghijklmnop"])
def test_no_pair_is_lost(spark, letters):
    r = random.Random(len(letters))
    word = lambda: "".join(r.choice(letters) for _ in range(r.choice([1, 2, 3, 3, 4, 5, 6, 7, 9, 12])))
    names, keys = {word() for _ in range(150)}, {word() for _ in range(100)}
    keys |= {b for x in sorted(names) if (b := bent(r, x))} | {"", "é日"}
    names |= {"é日x", "日"}
    got = similar.similar(spark.createDataFrame([(k,) for k in [*keys, None]], "key string"), spark.createDataFrame([(n,) for n in [*names, "", None]], "name string")).collect()
    want = {(k, n, s) for k in keys if k for n in names if (s := partial_ratio(k, n)) >= 80}
    assert {tuple(x) for x in got} == want and len(got) == len(want)


def test_bound():
    """Every pair at 80 shares the pairs of letters that the bound says, or has a posting of its own."""
    assert [similar.shared_pairs(n) for n in range(1, 9)][3:] >= [1] * 5
    assert all(similar.shared_pairs(n) <= similar.shared_pairs(n + 5) for n in range(1, 200))


def test_nearest_equals_scan(spark):
    """The book's aliases, bent: as the scan of the whole list finds them."""
    r = random.Random(4)
    keys = sorted({b for a, _, _ in aliases() for _ in range(3) if (b := bent(r, a))})
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    names = spark.createDataFrame([(a, b, o) for a, o, b in aliases()], "name string, id int, ord int")
    got = {(x["key"], x["id"], x["score"]) for x in similar.nearest(df, names).collect()}
    assert got == {tuple(x) for x in nearest_alias(df).collect()}


def test_candidates_are_few(spark):
    """Of a list of thousands, a key meets few."""
    r = random.Random(1)
    names = sorted({"".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(3000)})
    keys = [x[:3] + x[4:] for x in names[:200]]
    n = similar.candidates(spark.createDataFrame([(k,) for k in keys], "key string"), spark.createDataFrame([(x,) for x in names], "name string")).count()
    assert 200 <= n < 0.03 * 200 * len(names)
    with pytest.raises(ValueError):
        similar.similar(spark.createDataFrame([], "key string"), spark.createDataFrame([], "name string"), 70)
