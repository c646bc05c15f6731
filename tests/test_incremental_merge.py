"""A stored merge state against merging all at once."""

import random
import tempfile

from pyspark.sql import functions as F

from grantweave.operators.dedup import merge_duplicates
from grantweave.operators.merge_state import MergeStore, merge_state, merge_states, merged_rows

KIND = "p string, code string, fetched_at string, seq int, name string, county string, amount double"
KEYS = ["p", "code"]
ARGS = (KEYS, ["seq"], "fetched_at", ["county", "amount"])


def rows(seed, count):
    rng = random.Random(seed)
    return [
        (rng.choice(["a", "b", None]), rng.choice(["1", "2", "3", None]), rng.choice([None, "2024", "2024-05", "2025-01-01T00:00"]), i,
         f"n{i}", rng.choice([None, "Cluj", "Olt"]), rng.choice([None, 1.5, 2.5]))
        for i in range(count)
    ]


def seen(df):
    return sorted(map(repr, df.collect()))


def test_day_by_day_equals_all_at_once(spark):
    for seed in range(3):
        every = rows(seed, 60)
        df = spark.createDataFrame(every, KIND)
        want = seen(merge_duplicates(df, *ARGS))
        store = MergeStore(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"), buckets=4)
        rng = random.Random(seed)
        days = [[] for _ in range(4)]
        for r in every:
            days[rng.randrange(4)].append(r)
        shape = merge_state(df, *ARGS).schema
        assert store.state(shape).count() == 0
        for day in [*days, days[1], []]:
            store.absorb(merge_state(spark.createDataFrame(day, KIND), *ARGS))
        assert seen(merged_rows(store.state(shape))) == want


def test_states_merge_in_any_order(spark):
    parts = [merge_state(spark.createDataFrame(rows(s, 30), KIND).withColumn("seq", F.col("seq") + 100 * s), *ARGS) for s in range(3)]
    one = merge_states(merge_states(parts[0], parts[1]), parts[2])
    two = merge_states(parts[2], merge_states(parts[1], parts[0]))
    assert seen(merged_rows(one)) == seen(merged_rows(two))


def test_a_snapshot_touches_the_buckets_of_its_keys(spark):
    store = MergeStore(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"), buckets=16)
    df = spark.createDataFrame([(f"p{i}", "1", "2024", i, "n", None, None) for i in range(200)], KIND)
    assert len(store.absorb(merge_state(df, *ARGS))) == 16
    one = spark.createDataFrame([("p7", "1", "2025", 7, "newer", "Cluj", None)], KIND)
    touched = store.absorb(merge_state(one, *ARGS))
    assert len(touched) == 1
    generations = store._generations()
    assert {b for b, g in generations.items() if g == 1} == set(touched)
    merged = merged_rows(store.state(merge_state(df, *ARGS).schema))
    assert merged.count() == 200 and merged.where("p = 'p7'").first().name == "newer"
