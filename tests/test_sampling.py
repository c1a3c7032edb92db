import pytest
from conftest import rows
from pyspark.sql import functions as F

from waymark.operators.sampling import estimated_counts, sample_users


def test_sample_is_by_key_repeatable_and_nested(spark):
    users = spark.range(20_000).select(F.col("id").alias("user_id"))
    tenth = {r[0] for r in rows(sample_users(users, 0.1))}
    assert 1_700 < len(tenth) < 2_300
    shuffled = users.repartition(13).union(users)
    again = rows(sample_users(shuffled, 0.1))
    assert len(again) == 2 * len(tenth) and {r[0] for r in again} == tenth
    assert tenth < {r[0] for r in rows(sample_users(users, 0.3))}
    assert tenth != {r[0] for r in rows(sample_users(users, 0.1, seed=21))}


def test_sample_bounds(spark):
    users = spark.createDataFrame([(1,), (None,)], "user_id long")
    assert sample_users(users, 1.0).count() == 1
    assert sample_users(users, 0.0).count() == 0
    with pytest.raises(ValueError):
        sample_users(users, 1.5)


def test_estimates_are_unbiased_and_their_error_is_as_stated(spark):
    """Over many seeds the mean of the estimates is the count, and its spread the stated one."""
    per_user = {u: 1 + u * u % 17 for u in range(300)}
    events = spark.createDataFrame(
        [(u, u % 2, n) for u, c in per_user.items() for n in range(c)],
        "user_id long, city long, n long",
    ).persist()
    whole = None
    for seed in range(60):
        some = sample_users(events, 0.3, seed=seed, weight="weight")
        one = estimated_counts(some, ["city"])
        whole = one if whole is None else whole.unionByName(one)
    found = whole.collect()
    for city in (0, 1):
        true = sum(c for u, c in per_user.items() if u % 2 == city)
        own = [r for r in found if r.city == city]
        mean = sum(r.estimate for r in own) / len(own)
        error = (sum(r.standard_error**2 for r in own) / len(own)) ** 0.5
        spread = (sum((r.estimate - true) ** 2 for r in own) / len(own)) ** 0.5
        assert abs(mean - true) < 4 * error / len(own) ** 0.5
        assert 0.6 < spread / error < 1.5
    events.unpersist()


def test_a_full_sample_has_no_error(spark):
    users = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "user_id long, city string")
    some = sample_users(users, 1.0, weight="weight")
    assert rows(estimated_counts(some, ["city"])) == [("a", 3, 3.0, 0.0)]
    assert sample_users(users, 0.0, weight="weight").count() == 0
