"""The watched folder (SRC-06) and the part files (SNK-13/15)."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quern.sinks.parts import PartWriter


def _batches(n, bucket="a", size=100):
    ids = list(range(n))
    return [pa.RecordBatch.from_pydict({"id": ids[i:i + size], "b": [bucket] * len(ids[i:i + size])})
            for i in range(0, n, size)]


def _visible(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs
                  if "_pending" not in d and "_committed" not in d)


def _pending(path):
    return os.listdir(os.path.join(path, "_pending"))


def _rows(path):
    return sorted(i for f in _visible(path) for i in pq.ParquetFile(os.path.join(path, f)).read().column("id").to_pylist())


class Clock:
    def __init__(self, step=0.0):
        self.now, self.step = 1000.0, step

    def __call__(self):
        self.now += self.step
        return self.now


def test_parts_roll_by_rows(tmp_path):
    w = PartWriter({"path": str(tmp_path), "maxRows": "30"}, Clock())
    w.commit([w.write(iter(_batches(100)))], 0)
    sizes = [pq.ParquetFile(tmp_path / f).metadata.num_rows for f in _visible(tmp_path)]
    assert sizes == [30, 30, 30, 10] and _rows(tmp_path) == list(range(100))


def test_parts_roll_by_size(tmp_path):
    w = PartWriter({"path": str(tmp_path), "maxBytes": "1"}, Clock())
    w.commit([w.write(iter(_batches(500)))], 0)
    assert len(_visible(tmp_path)) == 5 and _rows(tmp_path) == list(range(500))


@pytest.mark.parametrize("option", ["rolloverSeconds", "inactivitySeconds"])
def test_parts_roll_by_time(tmp_path, option):
    # ten seconds pass between batches of a's rows; b keeps the task busy, so that a is idle as well
    other = {"rolloverSeconds": "1000", "inactivitySeconds": "1000"}
    feed = [x for pair in zip(_batches(300), _batches(300, "b")) for x in pair]
    w = PartWriter({"path": str(tmp_path), "bucket": "b", **other, option: "15"}, Clock(10.0))
    w.commit([w.write(iter(feed))], 0)
    assert len([f for f in _visible(tmp_path) if f.startswith("b=a/")]) == 3
    still = tmp_path / "still"
    v = PartWriter({"path": str(still), "bucket": "b", **other}, Clock(10.0))
    v.commit([v.write(iter(feed))], 0)
    assert len(_visible(still)) == 2 and _rows(still) == sorted(list(range(300)) * 2)


def test_few_parts_are_open_at_once(tmp_path):
    w = PartWriter({"path": str(tmp_path), "bucket": "b", "maxOpen": "2"}, Clock(1.0))
    feed = [b for k in range(5) for b in _batches(10, f"k{k}")] + _batches(10, "k4")
    w.commit([w.write(iter(feed))], 0)
    assert len(_visible(tmp_path)) == 5


def test_nothing_is_visible_before_the_commit_and_after_an_abort(tmp_path):
    w = PartWriter({"path": str(tmp_path)}, Clock())
    message = w.write(iter(_batches(50)))
    assert _visible(tmp_path) == [] and len(_pending(tmp_path)) == 1
    w.abort([message, None], 0)
    assert _visible(tmp_path) == [] and _pending(tmp_path) == []


def test_a_commit_run_again_keeps_the_first_attempt(tmp_path):
    w = PartWriter({"path": str(tmp_path), "maxRows": "20"}, Clock())
    first = w.write(iter(_batches(60)))
    w.commit([first], 4)
    before = _visible(tmp_path)
    # as after a driver lost between the decision and the moves: one part is pending again
    os.rename(tmp_path / before[0], first.parts[0][0])
    w.commit([w.write(iter(_batches(60)))], 4)
    assert _visible(tmp_path) == before and _rows(tmp_path) == list(range(60)) and _pending(tmp_path) == []
    w.commit([w.write(iter(_batches(10)))], 5)
    assert len(_rows(tmp_path)) == 70


def test_what_a_lost_task_left_goes_after_the_time_out(tmp_path):
    import time
    w = PartWriter({"path": str(tmp_path), "timeoutSeconds": "3600"})
    w.write(iter(_batches(10)))  # its message is lost
    w.commit([], 0)
    assert len(_pending(tmp_path)) == 1
    later = PartWriter({"path": str(tmp_path), "timeoutSeconds": "3600"}, lambda: time.time() + 3601)
    later.commit([], 1)
    assert _pending(tmp_path) == [] and _visible(tmp_path) == []


def test_buckets_with_odd_names_come_back(spark, tmp_path):
    values = ["a/b", "x=y", "ü %", None, ""]
    w = PartWriter({"path": str(tmp_path), "bucket": "b"}, Clock())
    batch = pa.RecordBatch.from_pydict({"id": list(range(5)), "b": pa.array(values, pa.string())})
    w.commit([w.write(iter([batch, batch.slice(0, 0)]))], 0)
    got = {r.id: r.b for r in spark.read.schema("id long, b string").parquet(str(tmp_path)).collect()}
    assert got == {0: "a/b", 1: "x=y", 2: "ü %", 3: None, 4: None}


@pytest.mark.parametrize("options", [{"format": "orc"}, {"maxRows": "0"}])
def test_wrong_options_are_refused(tmp_path, options):
    with pytest.raises(ValueError):
        PartWriter({"path": str(tmp_path), **options})


def test_a_task_that_fails_leaves_nothing_visible(spark, tmp_path):
    from pyspark.errors import StreamingQueryException
    from pyspark.sql import functions as F
    from quern.sinks import parts
    parts.register(spark)
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    spark.range(0, 4000, 1, 4).write.parquet(src)

    def run(bad):
        rows = spark.readStream.schema("id long").parquet(src)
        if bad:
            rows = rows.withColumn("id", F.when(F.col("id") == 3999, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
        (rows.writeStream.format("quern_parts").option("path", out).option("maxRows", 100).option("checkpointLocation", ck)
             .trigger(availableNow=True).start().awaitTermination())

    with pytest.raises(StreamingQueryException):
        run(True)
    assert not os.path.isdir(out) or _visible(out) == []
    run(False)
    run(False)
    assert _rows(out) == list(range(4000))
    assert max(pq.ParquetFile(os.path.join(out, f)).metadata.num_rows for f in _visible(out)) <= 100


def test_a_watched_folder_is_read_as_it_changes(spark, tmp_path):
    from quern.sources.monitor import monitor
    folder, state, got = tmp_path / "in", str(tmp_path / "state"), []
    folder.mkdir()

    def put(name, text, seconds):
        (folder / name).write_text(text)
        os.utime(folder / name, (seconds, seconds))

    def look(rounds=1):
        def sink(rows, batch_id):
            got.extend((batch_id, r.value) for r in rows.collect())
        got.clear()
        monitor(spark, str(folder), "text", "value string", sink, state, pattern="*.txt", rounds=rounds, interval=0.01)
        return sorted(v for _, v in got), {b for b, _ in got}

    assert look() == ([], set())                                # an empty folder
    put("a.txt", "a1\na2\n", 1000)
    put("b[1] {x}.txt", "b1\n", 1000)
    put("c.csv", "no\n", 1000)
    put("_d.txt", "no\n", 1000)
    assert look()[0] == ["a1", "a2", "b1"]
    assert look(2) == ([], set())                               # nothing new, also after a restart
    put("a.txt", "a1\na3\n", 2000)                              # changed: read again whole
    put("e.txt", "", 2000)
    assert look()[0] == ["a1", "a3"]
    put("a.txt", "a1\na3\na4\n", 2000)                          # same time, other length
    put("b[1] {x}.txt", "b0\n", 500)                            # an older version put back
    (folder / "sub").mkdir()
    put("sub/f.txt", "f1\n", 1)
    assert look()[0] == ["a1", "a3", "a4", "b0", "f1"]
    assert look() == ([], set())


def test_a_batch_run_again_names_the_same_files(spark, tmp_path):
    from quern.sources.monitor import monitor
    folder, state, seen = tmp_path / "in", str(tmp_path / "state"), []
    folder.mkdir()
    (folder / "a.txt").write_text("a\n")

    def sink(rows, batch_id):
        seen.append((batch_id, [r.value for r in rows.collect()]))
        if len(seen) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception):
        monitor(spark, str(folder), "text", "value string", sink, state, rounds=1)
    (folder / "b.txt").write_text("b\n")
    monitor(spark, str(folder), "text", "value string", sink, state, rounds=1)
    assert seen[0] == seen[1] == (0, ["a"]) and seen[2:] == [(1, ["b"])]
