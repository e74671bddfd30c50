"""Archives of odd rows: null and repeated ids, long payloads, many archives."""

import hashlib
from base64 import b32encode

from pyspark.sql import functions as F

from corploom.llm import warc


def test_null_and_repeated_ids_come_back(spark):
    rows = [(None, "u", "same"), (None, "v", "same"), (4, "w", "same"), (2, None, "same"), (2, "x", "same"), (9, "y", None), (8, "z", ""), (7, "l", "é" * 700_000)]
    pages = spark.createDataFrame([(*r, 1, "a") for r in rows], "page_id long, url string, html string, offset int, archive string")
    _, records = warc.round_trip(pages.select("page_id", "url", "html"))
    got = sorted((str(r["page_id"]), str(r["url"]), r["record_type"], str(r["refers_to"]), r["payload_bytes"], r["payload_digest"]) for r in records.collect())
    digest = lambda t: b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert len(got) == len(rows)
    assert [g[4:] for g in got if g[1] in ("y", "z")] == [(0, digest(""))] * 2
    assert {g[1]: g[2:4] for g in got if g[1] in ("w", "x", "y", "z", "l")} == {
        "w": ("revisit", "2"), "x": ("response", "None"), "y": ("revisit", "8"), "z": ("response", "None"), "l": ("response", "None"),
    }
    assert [g[4] for g in got if g[1] == "l"] == [1_400_000]
    assert sorted(g[2] for g in got if g[1] in ("u", "v")) == ["revisit", "revisit"]


def test_tasks_follow_the_number_of_archives(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"{i} " + "x" * 1000) for i in range(200)], "page_id long, url string, html string")
    index = warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=20_000)
    archives = index.select("archive").distinct().count()
    assert archives > 8
    records = warc.read_records(index, str(tmp_path / "w"))
    assert records.rdd.getNumPartitions() == index.agg({"archive": "max"}).first()[0] + 1
    by_task = records.select(F.spark_partition_id().alias("task"), "archive").distinct().collect()
    assert all(r["task"] == r["archive"] for r in by_task) and len(by_task) == archives
    assert warc.read_records(index, str(tmp_path / "w")).count() == 200
