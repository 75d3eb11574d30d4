from pyspark.sql import functions as F

from noticemill.llm.near_dedup import leader_pairs


def test_a_bucket_costs_one_vote_a_member(spark):
    """However many lead a bucket, a member votes for one of them: pairs to verify stay below the members of all buckets."""
    members = [(bucket, rep, 100 if rep % 2 else 60, rep) for bucket in (1, 2) for rep in range(300)]
    placed = spark.createDataFrame(members, "bucket long, rep long, n_shingles long, component long")
    pairs = leader_pairs(placed, 80, 1).collect()
    assert 250 <= len(pairs) <= len(members)
    assert all(p["a"] > p["b"] and p["a"] % 2 == p["b"] % 2 and {p["ca"], p["cb"]} == {p["a"], p["b"]} for p in pairs)
    assert leader_pairs(placed.withColumn("component", F.lit(0).cast("long")), 80, 1).isEmpty()
