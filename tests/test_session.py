"""Settings of a session somebody else built."""

from __future__ import annotations

from mercato.session import configure

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_merged_partitions_are_small_unless_the_session_says_otherwise(spark):
    other = spark.newSession()
    assert configure(other).conf.get(ADVISORY) == "16m"
    own = spark.newSession()
    own.conf.set(ADVISORY, "8m")
    assert configure(own).conf.get(ADVISORY) == "8m"
