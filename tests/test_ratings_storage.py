from quarry.plans import pipelines as E


def test_indexed_ratings_are_kept_as_parquet(spark):
    rows = spark.createDataFrame([(u, i, (u * i) % 5 + 1, u * 10 + i) for u in range(6) for i in range(5)], "user_id long, item_id long, rating long, timestamp long")
    splits = E.prepare_ratings(rows, ["user_id", "item_id", "timestamp"], 0.2, 42)
    assert (splits.train.count(), splits.validation.count(), splits.num_users, splits.num_items) == (24, 6, 6, 5)
    for side in (splits.train, splits.validation):  # compressed columns, of which a reader takes what it needs
        assert side.inputFiles() and all(f.endswith(".parquet") for f in side.inputFiles())
