import os

import pytest
from conftest import values
from pyspark.sql import types as T

from tierflow.streaming import landing

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("user_id", "data_fields", "value")])
KEYS = ["user_id", "data_fields"]


def drop(folder, name, *lines, header="user_id,data_fields,value", age=0):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join([header, *lines]) + "\n")
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))


def take_in(spark, tmp_path):
    stream = landing.csv_stream(spark, str(tmp_path / "in"), SCHEMA)
    landing.ingest(stream, str(tmp_path / "log"), str(tmp_path / "ckpt"), KEYS, ["_seq"])
    return landing.current_rows(spark.read.parquet(str(tmp_path / "log")), KEYS, ["_seq"])


def test_files_arrive_in_steps(spark, tmp_path):
    drop(tmp_path / "in", "1.csv", "a,q,1", "a,q,2", "b,q,5", ",q,7", ",q,7", age=1)
    assert values(take_in(spark, tmp_path), *SCHEMA.names) == [("a", "q", "2"), ("b", "q", "5"), (None, "q", "7"), (None, "q", "7")]
    drop(tmp_path / "in", "2.csv", "a,q,3", "c,q,NaN", age=2)
    later = values(take_in(spark, tmp_path), *SCHEMA.names)
    assert ("a", "q", "3") in later and ("c", "q", None) in later and len(later) == 5
    # Nothing new: the state stays.
    assert values(take_in(spark, tmp_path), *SCHEMA.names) == later


def test_replayed_batch_leaves_one_copy(spark, rows, tmp_path):
    body = landing.write_batch(str(tmp_path / "log"), KEYS, ["value"])
    batch = rows("user_id string, data_fields string, value string", ("a", "q", "1"), (None, "q", "2"))
    for _ in range(2):
        body(batch, 0)
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 2
    body(rows("user_id string, data_fields string, value string", ("a", "q", "0")), 1)
    log = spark.read.parquet(str(tmp_path / "log"))
    by_arrival = landing.current_rows(log, KEYS, ["value"])
    by_value = landing.current_rows(log, KEYS, ["value"], arrival_wins=False)
    assert ("a", "q", "0") in values(by_arrival, *SCHEMA.names)
    assert ("a", "q", "1") in values(by_value, *SCHEMA.names)
    landing.compact(spark, str(tmp_path / "log"), str(tmp_path / "log2"), KEYS, ["value"])
    folded = spark.read.parquet(str(tmp_path / "log2"))
    assert values(landing.current_rows(folded, KEYS, ["value"]), *SCHEMA.names) == values(by_arrival, *SCHEMA.names)


def test_other_header_fails_the_batch(spark, tmp_path):
    drop(tmp_path / "in", "1.csv", "q,a,1", header="data_fields,user_id,value")
    with pytest.raises(Exception):
        take_in(spark, tmp_path)
