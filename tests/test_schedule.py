import datetime as dt


from tagweave.functions.schedule import decode_schedule, encode_schedule, scheduler_time


def test_decode_golden(spark):
    df = spark.createDataFrame([("2,2019-09-24 06:15:00,2019-09-30 06:15:00",)], "s STRING")
    r = df.select(decode_schedule("s").alias("d")).first()["d"]
    assert (r["frequency"], r["start"], r["end"]) == (2, dt.datetime(2019, 9, 24, 6, 15), dt.datetime(2019, 9, 30, 6, 15))


def test_bad_parts_leave_nulls(spark):
    df = spark.createDataFrame([("2,bad,2019-09-30 06:15:00",), ("x,2019-09-24 06:15:00,bad",), ("3",), (None,)],
                               "s STRING")
    got = [tuple(r["d"]) if r["d"] else None for r in df.select(decode_schedule("s").alias("d")).collect()]
    assert got[0] == (2, None, None)
    assert got[1] == (None, dt.datetime(2019, 9, 24, 6, 15), None)
    assert got[2] == (3, None, None)
    assert got[3] == (None, None, None)


def test_encode_and_scheduler_time(spark):
    df = spark.createDataFrame([(2, dt.datetime(2019, 9, 24, 6, 15), dt.datetime(2019, 9, 30, 6, 15))],
                               "f INT, a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    r = df.select(encode_schedule("f", "a", "b").alias("p"), scheduler_time("a").alias("t")).first()
    assert r["p"] == "2,2019-09-24 06:15:00,2019-09-30 06:15:00"
    assert r["t"] == "2019-09-24T06:15+0800"
