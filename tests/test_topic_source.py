"""SRC3: file topics by record offsets: caps, starting points, restarts, byte ranges."""

import json

import pytest

from fraudflow.sources import topic_source as T
from fraudflow.sources.topics import read_topic
from fraudflow.streaming.sinks import read_table, start_table_query


def write(path, name, ids, end="\n"):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(json.dumps({"key": str(i), "value": json.dumps({"n": i})}) for i in ids) + end)


@pytest.fixture()
def run(spark, tmp_path):
    def go(cap=None, starting="earliest", stop=True):
        env = read_topic(spark, "t", path=str(tmp_path / "topic"), progress=str(tmp_path / "progress"), starting=starting, max_per_trigger=cap)
        q = start_table_query(env, str(tmp_path / "table"), str(tmp_path / "checkpoint"), trigger={})
        q.processAllAvailable()
        if stop:
            q.stop()
        return q
    return go


def batches(spark, tmp_path):
    out = {}
    for r in read_table(spark, str(tmp_path / "table")).orderBy("file", "byte").collect():
        out.setdefault(r["_batch"], []).append(int(r["key"]))
    return [out[b] for b in sorted(out)]


def test_batches_hold_the_cap_across_files(spark, run, tmp_path):
    topic = tmp_path / "topic"
    write(topic / "a", "part-0.json", range(70))
    write(topic / "a", "part-1.json", range(70, 75), end="")  # no last line end
    write(topic / "a", "part-2.json", range(75, 120))
    (topic / "a" / "_SUCCESS").write_text("")
    (topic / "a" / ".part-0.json.crc").write_text("x")
    run(50)
    assert batches(spark, tmp_path) == [list(range(50)), list(range(50, 100)), list(range(100, 120))]


def test_restart_goes_on_where_it_stopped(spark, run, tmp_path):
    topic = tmp_path / "topic"
    write(topic, "b.json", range(30))
    run(20)
    write(topic, "a.json", range(30, 65))  # found later, though its name comes first
    run(20)
    run(20)
    got = batches(spark, tmp_path)
    assert [len(b) for b in got] == [20, 10, 20, 15]
    assert sum(got, []) == list(range(65))


def test_latest_skips_what_was_there_first(spark, run, tmp_path):
    topic = tmp_path / "topic"
    write(topic, "a.json", range(10))
    q = run(4, "latest", stop=False)
    write(topic, "b.json", range(10, 19))
    q.processAllAvailable()
    q.stop()
    write(topic, "c.json", range(19, 21))
    run(4, "latest")
    assert batches(spark, tmp_path) == [[10, 11, 12, 13], [14, 15, 16, 17], [18], [19, 20]]


def test_without_a_cap_all_is_one_batch(spark, run, tmp_path):
    write(tmp_path / "topic", "a.json", range(300))
    run()
    assert batches(spark, tmp_path) == [list(range(300))]


def test_a_cap_on_records_needs_offsets(spark, tmp_path):
    with pytest.raises(ValueError, match="progress"):
        read_topic(spark, "t", path=str(tmp_path), max_per_trigger=50)


@pytest.mark.parametrize("split,read", [(7, 5), (40, 16), (100, 1 << 20), (1 << 20, 33)])
def test_every_record_is_in_one_range(tmp_path, monkeypatch, split, read):
    """Ranges cut anywhere, empty lines, long lines, characters of several bytes."""
    monkeypatch.setattr(T, "SPLIT", split)
    monkeypatch.setattr(T, "_READ", read)
    texts = ["a", "é" * 30, "", "x" * 200, "日本", "", "z"]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "f.json").write_text("\n".join(texts) + "\n\n" + "last")
    log = T.TopicLog(str(tmp_path / "t"), str(tmp_path / "p"))
    log.refresh()
    want = [t for t in [*texts, "last"] if t]
    parts = T.ranges(log, {"file": 0, "byte": 0}, log.end())
    got = [s.strip("\n") for p in parts for b in T.lines(log.system, p) for s in b.column("line").to_pylist()]
    assert got == want
    # and batch by batch
    at, got = {"file": 0, "byte": 0}, []
    while at != log.end():
        to = log.after(at, 2)
        own = [s.strip("\n") for p in T.ranges(log, at, to) for b in T.lines(log.system, p) for s in b.column("line").to_pylist()]
        assert len(own) <= 2
        got, at = got + own, to
    assert got == want


def test_a_small_batch_reads_little(tmp_path):
    """Neither looking for a batch's end nor reading its records reads far beyond it."""
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "f.json").write_text("x" * 99 + "\n" + ("y" * 99 + "\n") * 30_000)
    log = T.TopicLog(str(tmp_path / "t"), str(tmp_path / "p"))
    log.refresh()
    seen = []

    class Counted:
        def __init__(self, f):
            self.f = f

        def __getattr__(self, name):
            return getattr(self.f, name)

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def read(self, n):
            seen.append(n)
            return self.f.read(n)

    real = log.system
    log.system = type("Counting", (), {"open_input_file": lambda own, p: Counted(real.open_input_file(p)), "get_file_info": lambda own, p: real.get_file_info(p)})()
    to = log.after({"file": 0, "byte": 0}, 250)
    assert to == {"file": 0, "byte": 25_000} and sum(seen) <= 1 << 16
    seen.clear()
    parts = T.ranges(log, to, log.after(to, 250))
    assert sum(b.num_rows for p in parts for b in T.lines(log.system, p)) == 250 and sum(seen) <= 1 << 18
    assert log.after({"file": 0, "byte": 0}, 25_000) == {"file": 0, "byte": 2_500_000}


def test_progress_folder_of_two_queries_is_refused(tmp_path):
    write(tmp_path / "t", "a.json", range(3))
    one, two = (T.TopicLog(str(tmp_path / "t"), str(tmp_path / "p")) for _ in range(2))
    one.refresh()
    with pytest.raises(RuntimeError, match="another query"):
        two.refresh()
