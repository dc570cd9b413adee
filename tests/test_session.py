from floodmark.session import build_session, shared_folder, size_for_inputs, sized_for


def test_shuffles_are_sized_by_the_input():
    def partitions(size):
        return int(sized_for(size)["spark.sql.shuffle.partitions"])

    assert partitions(1) == 200
    assert partitions(10**12) == 1863
    # Shares stay the same at a hundred terabytes and beyond.
    assert 10**14 / partitions(10**14) <= 2**29
    assert 10**16 / partitions(10**16) <= 2**29


def test_session_is_sized_by_the_files_it_reads(spark, tmp_path):
    held = {name: spark.conf.get(name, None) for name in sized_for(1)}
    spark.range(1000).write.parquet(f"{tmp_path}/some")
    try:
        files, none = spark.read.parquet(f"{tmp_path}/some"), spark.createDataFrame([], "a int")
        size_for_inputs(spark, files, none)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        for name, value in held.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (named.rstrip("/") if named else shared_folder(spark))
    assert build_session() is not None
