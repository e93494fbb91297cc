from locrank.operators import check_output


def test_counts(spark):
    rows = [("a", 1, 0.5), ("a", 2, None), (None, 3, 2.0), ("b", None, -0.1), ("c", 4, 1.0)]
    frame = spark.createDataFrame(rows, "k string, n int, rate double")
    assert check_output(frame, ["k"], {"rate": (0.0, 1.0)}).first().asDict() == {
        "row_count": 5,
        "key_count": 4,
        "repeated_keys": 1,
        "null_key_rows": 1,
        "null_n": 1,
        "null_rate": 1,
        "outside_rate": 2,
    }


def test_empty_table_has_zeros(spark):
    row = check_output(spark.createDataFrame([], "k string, v int"), ["k"]).first()
    assert set(row) == {0}
