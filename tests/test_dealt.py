"""Joins whose pairs are dealt over tasks."""

import random
from collections import Counter

from pyspark.sql import functions as F

from innkeep.operators import dealt, matching
from innkeep.plans import catalog


def _tasks(df):
    """Rows by task."""
    return sorted(Counter(r[0] for r in df.select(F.spark_partition_id()).collect()).values(), reverse=True)


def test_pairs_of_one_place_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(dealt, "CELL_ROWS", 16)
    rng = random.Random(3)
    hb = [(rng.choice([1, 1, 1, 1, 2, None]), i) for i in range(200)]
    ad = [(rng.choice([1, 1, 1, 3, None]), i) for i in range(120)]
    x, y = spark.createDataFrame(hb, "place_id int, c long").coalesce(1), spark.createDataFrame(ad, "place_id int, s long").coalesce(1)
    for safe in (False, True):
        got = matching.hotel_pairs(x, y, null_safe=safe)
        assert got.columns == ["place_id", "hb_c", "ad_s"]
        assert Counter((r[0], r[1], r[2]) for r in got.collect()) == Counter((a, i, j) for a, i in hb for b, j in ad if a == b and (safe or a is not None))
        rows = _tasks(got)
        assert rows[0] < sum(rows) / 3  # it was one task
    assert matching.hotel_pairs(x.where("1 = 0"), y).count() == 0


def test_scores_of_one_size_are_dealt(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dealt, "CELL_ROWS", 16)
    monkeypatch.setattr(catalog, "_KEY_SPAN", 100)
    rng = random.Random(4)
    names = ["hot bolt", "hot ring", "blue", "Blue ring ring", "", None]
    parts = [(i, rng.choice(names), rng.choice([7, 7, 7, 8, None])) for i in range(300)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = catalog.jaccard_score(spark, str(tmp_path))
    w = {i: None if n is None else n.lower().split(" ") for i, n, _ in parts}
    want = Counter()
    for i, _, s in parts:
        for j, _, z in parts:
            if s is not None and s == z and i < j:
                x, y = w[i], w[j]
                if x is None or y is None:
                    want[i, j, None if x is None or y is None else 0.0, None] += 1
                else:
                    head = set(x[:1]), set(y[:2])
                    want[i, j, round(len(set(x) & set(y)) / len(set(x) | set(y)), 6), round(len(head[0] & head[1]) / max(map(len, head)), 6)] += 1
    found = Counter((r[0], r[1], r[2] if w[r[0]] is not None and w[r[1]] is not None else None, r[3] if w[r[0]] is not None and w[r[1]] is not None else None) for r in got.collect())
    assert found == want
    rows = _tasks(got)
    assert rows[0] < sum(rows) / 3  # it was one task


def test_a_part_meets_few_others_in_a_row(spark, tmp_path, monkeypatch):
    """A part met all others of its size in a row, so that keys of large sizes didn't fit the dictionary of a file and were written out."""
    monkeypatch.setattr(dealt, "CELL_ROWS", 128)
    names = ["hot bolt", "hot ring", "blue", "old plate"]
    spark.createDataFrame([(i, names[i * i % 7 % 4], 7) for i in range(300)], "p_partkey long, p_name string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = catalog.jaccard_score(spark, str(tmp_path))
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0]
    rows = [tuple(r) for r in got.select(F.spark_partition_id(), "p_partkey", "q_partkey").collect()]
    assert sorted(r[1:] for r in rows) == [(i, j) for i in range(300) for j in range(i + 1, 300)]
    longest, run = 0, 0
    for x, y in zip([None, *rows], rows):
        run = run + 1 if x and x[:2] == y[:2] else 1
        longest = max(longest, run)
    assert longest < 150  # it was 299
