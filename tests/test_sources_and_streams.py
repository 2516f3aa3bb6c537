import os
import sys

import pytest
from pyspark.sql import functions as F

from conftest import physical
from taxaloom.operators import match, prepare
from taxaloom.plans.verify import build_index, verify
from taxaloom.session import cut, scope, shared_folder
from taxaloom.sources import readers, writers
from taxaloom.streaming.verify_stream import stream_metrics, verify_stream
from test_results import tables


def test_lines_are_numbered_across_files(spark, tmp_path):
    text = [f" name {i} " if i % 5 else "" for i in range(1000)]
    for part in range(4):
        lines = text[part * 250:(part + 1) * 250]
        # The last file is the largest, and scans start with large files.
        padding = " " * (part * 50)
        (tmp_path / f"part-{part}.txt").write_text("".join(line + padding + "\n" for line in lines))
    rows = readers.read_name_lines(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(1000))
    assert [r.name for r in rows] == [t.strip() for t in text]


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    (tmp_path / "names.txt").write_text("".join(f"name {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.read_name_lines(spark, str(tmp_path)).orderBy("row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.name for r in rows] == [f"name {i}" for i in range(5000)]


def test_name_column(spark, tmp_path):
    (tmp_path / "n.csv").write_text('1,"Aus bus, 1900",x\n2,Cus,y\n3\n')
    rows = readers.read_name_column(spark, str(tmp_path), ",", 2).orderBy("row_id").collect()
    assert [r.name for r in rows] == ["Aus bus, 1900", "Cus", None]


def test_records_by_source(frame, spark, tmp_path):
    _, records, _ = tables(frame)
    writers.write_name_records(records, f"{tmp_path}/r")
    stored = readers.read_name_records(spark, f"{tmp_path}/r", [4, -1])
    assert "PartitionFilters: [" in physical(stored) and "data_source_id" in physical(stored).split("PartitionFilters: [")[1][:60]
    assert {r.record_id for r in stored.collect()} == {"c", "d"}
    assert readers.read_name_records(spark, f"{tmp_path}/r", [0]).count() == 4


def test_data_sources(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"id":1,"title":"One","titleShort":"1","curation":"Curated","updatedAt":"2024-01-01"}\n')
    row = readers.read_data_sources(spark, str(tmp_path)).first()
    assert (row.id, row.title_short, row.is_outlink_ready) == (1, "1", None)


def test_cut_writes_to_the_shared_folder(frame, spark):
    df = cut(frame([(1, "a")], "n int, t string"))
    assert all(shared_folder(spark) in f for f in df.inputFiles())
    assert df.collect()[0].t == "a"


def test_stream_equals_batch(frame, spark, tmp_path):
    names, records, sources = tables(frame)
    for part in range(3):
        names.filter(F.col("row_id") % 3 == part).coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
    stream = spark.readStream.schema(names.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    run = verify_stream(stream, records, sources, f"{tmp_path}/out", f"{tmp_path}/check", sources=[1, 4])
    run.awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out")
    assert rows.select("batch").distinct().count() == 3
    batch = verify(names, records, sources, sources=[1, 4]).flat()
    assert sorted(map(tuple, rows.drop("batch").collect())) == sorted(map(tuple, batch.collect()))
    progress = stream_metrics(spark, f"{tmp_path}/out").collect()
    assert sum(r.names for r in progress) == 6 and all(r.names_per_second > 0 for r in progress)
    assert sum(r.errors for r in progress) == 2


def above(plan, leaf):
    """For each scan of ``leaf`` in a plan's text, the operators between it and the join it is for."""
    stack, found = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        name = line.strip(" :+-*()0123456789")
        stack = [(d, n) for d, n in stack if d < depth] + [(depth, name)]
        if leaf in line:
            path = []
            for _, n in reversed(stack[:-1]):
                if "Join" in n:
                    break
                path.append(n.split(" ")[0])
            found.append(path)
    return found


def test_batches_do_not_shuffle_the_index(frame, spark, tmp_path):
    names, records, sources = tables(frame)
    index = build_index(records, sources)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = verify(names, index, sources, sources=[1, 4])
        keys = cut(prepare.name_keys(done.names))
        plans = [
            done.best(), done.per_source(), done.sources_num(),
            match.probe_keys(match.candidates(keys, match.exact_probes()), index.keys),
            match.probe_stems(match.candidates(keys, match.stem_probes(match.STEM)), index.stems),
            match.probe_similar(match.candidates(keys, match.stem_probes(match.FUZZY)), index.stems, traces=index.traces),
        ]
        scans = [path for df in plans for path in above(physical(df), "spark_catalog.default.taxaloom_")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(scans) >= 7 and not any("Exchange" in n for path in scans for n in path)


def test_tables_of_a_scope_are_removed(frame, spark):
    with scope(spark):
        inside = cut(frame([(1,)], "n int"))
        folder = os.path.dirname(inside.inputFiles()[0].removeprefix("file://"))
        assert os.path.isdir(folder)
    assert not os.path.isdir(folder)
    assert cut(frame([(1,)], "n int")).count() == 1


def test_a_batch_of_one_file_is_shared_by_tasks(frame, spark, tmp_path, monkeypatch):
    names, records, sources = tables(frame)
    frame([(n, f"Bubo bubo {n}") for n in range(400)], names.schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    seen, index = [], []
    module = sys.modules["taxaloom.streaming.verify_stream"]
    monkeypatch.setattr(module, "verify", lambda rows, built, *a, **k: (
        seen.append(len(rows.inputFiles())), index.append(built), verify(rows, built, *a, **k))[-1])
    stream = spark.readStream.schema(names.schema).parquet(f"{tmp_path}/in")
    verify_stream(stream, records, sources, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    assert seen == [spark.sparkContext.defaultParallelism]
    assert index[0].source_entries is None  # no sources are chosen
    assert spark.read.parquet(f"{tmp_path}/out").count() == 400
    with pytest.raises(ValueError):
        verify(names, index[0], sources, sources=[1])
