"""Maximal scoring stretches of each user's events, and SQL from the definition: all pairs of running sums of a user."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import table
from ..operators import subsequences

STRETCHES = """WITH e AS (SELECT user_id, event_id, CAST(floor(value * 100) AS BIGINT) - 5000 AS v FROM events),
p AS (SELECT user_id, list(event_id ORDER BY event_id) AS ids, list_prepend(0, list(s ORDER BY event_id)) AS sums FROM (SELECT *, CAST(sum(v) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS s FROM e) GROUP BY user_id),
ij AS (SELECT user_id, i, unnest(range(i + 1, len(sums) + 1)) AS j, ids, sums FROM (SELECT *, unnest(range(1, len(sums))) AS i FROM p)),
ok AS (SELECT user_id, i, j, ids[i] AS first, ids[j - 1] AS last, sums[j] - sums[i] AS score FROM ij WHERE sums[i] < sums[j] AND sums[i] < list_min(sums[i + 1:j]) AND sums[j] > list_max(sums[i:j - 1]))
SELECT user_id, first, last, score FROM ok a WHERE NOT EXISTS (SELECT 1 FROM ok b WHERE b.user_id = a.user_id AND b.i <= a.i AND b.j >= a.j AND (b.i < a.i OR b.j > a.j))"""


def register(query) -> None:
    query("maximal_stretches", STRETCHES)(lambda s, d: subsequences.maximal_stretches(table(s, d, "events").withColumn("v", F.floor(F.col("value") * 100).cast("long") - 5000), "user_id", "event_id", "v"))
