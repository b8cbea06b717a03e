"""Runs that are cut short, slow, throttled or begun again; records in order."""

import http.server
import json
import os
import subprocess
import sys
import threading
import time
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quern.functions.replies import parse_reply
from quern.operators import EchoBackend, infer
from quern.operators.inference import Throttled, Window, _Call
from quern.operators.resume import key_filter, without_known
from quern.plans import GenerateConfig, generate, prepare, records, statuses
from quern.plans.generate import _finish, finish_earlier, written_ids
from quern.sources import assemble, export_single_file, manifest_of, read_dataset, read_ordered, write_ordered

GOOD = json.dumps({"question": "q", "answer": "a"})


@pytest.fixture
def data(spark, tmp_path):
    rows = spark.range(200).select("id", F.concat(F.lit("text é "), F.col("id")).alias("text"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/data/set/train.parquet")
    return tmp_path


# Records in order.


def serial(rows):
    return "".join(f"{line}\n" for _, line in sorted(rows)).encode()


@pytest.mark.parametrize("parts", [1, 7])
def test_ordered_records(spark, tmp_path, parts):
    rows = [(i * 7 % 500, f"line {i} é") for i in range(500)]
    df = spark.createDataFrame(rows, "n int, line string").repartition(5)
    found = write_ordered(df, f"{tmp_path}/o", "n", parts=parts)
    assert sum(r["records"] for r in found) == 500 and [r["offset"] for r in found] == [sum(x["bytes"] for x in found[:i]) for i in range(len(found))]
    assert [(r.position, r.line) for r in sorted(read_ordered(spark, f"{tmp_path}/o").collect())] == [(i, line) for i, (_, line) in enumerate(sorted(rows))]
    assert Path(assemble(spark, f"{tmp_path}/o", f"{tmp_path}/one")).read_bytes() == serial(rows)
    assert Path(export_single_file(df, f"file://{tmp_path}/two".removeprefix("file://"), "n")).read_bytes() == serial(rows)
    # The next version takes the place of this one, and its parts go.
    write_ordered(df.where("n < 3"), f"{tmp_path}/o", "n")
    assert {p.name for p in (tmp_path / "o").glob("part-*")} == {r["file"] for r in manifest_of(f"{tmp_path}/o")["parts"]} and read_ordered(spark, f"{tmp_path}/o").count() == 3
    assert write_ordered(df.where("false"), f"{tmp_path}/o", "n") == [] and read_ordered(spark, f"{tmp_path}/o").count() == 0
    assert Path(assemble(spark, f"{tmp_path}/o", f"{tmp_path}/one")).read_bytes() == b""


def test_a_failed_writer_leaves_the_version_before(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("n"), F.col("id").cast("string").alias("line"))
    write_ordered(df, f"{tmp_path}/o", "n", parts=4)
    assemble(spark, f"{tmp_path}/o", f"{tmp_path}/one")
    bad = df.select("n", F.when(F.col("n") == 77, F.raise_error(F.lit("lost"))).otherwise(F.lit("new")).alias("line"))
    with pytest.raises(Exception, match="lost"):
        write_ordered(bad, f"{tmp_path}/o", "n", parts=4)
    assert [r.line for r in sorted(read_ordered(spark, f"{tmp_path}/o").collect())] == [str(i) for i in range(100)]
    name = manifest_of(f"{tmp_path}/o")["parts"][1]["file"]
    (tmp_path / "o" / name).write_bytes(b"cut")
    with pytest.raises(Exception, match="bytes"):
        assemble(spark, f"{tmp_path}/o", f"{tmp_path}/one")
    assert (tmp_path / "one").read_text() == "".join(f"{i}\n" for i in range(100)) and not [p for p in tmp_path.iterdir() if p.name.startswith(".one")]


# Calls in flight.


def calls(prompts):
    return (_Call(p, None, None) for p in prompts)


def test_a_slow_call_holds_nothing_back():
    def ask(prompt):
        time.sleep(0.4 if int(prompt) % 50 == 0 else 0.004)
        return (prompt, None, None), False

    began = time.monotonic()
    found = [c.result[0] for c in Window(ask, 8).run(calls(str(i) for i in range(200)))]
    # 4 slow calls of 0.4 s and 196 of 4 ms, eight at a time: batch by batch it would be 1.6 s and more.
    assert found == [str(i) for i in range(200)] and time.monotonic() - began < 1.2


def test_what_is_taken_ahead_is_bounded():
    taken, stuck = [], threading.Event()

    def prompts():
        for i in range(10_000):
            taken.append(i)
            yield _Call(str(i), None, None)

    def ask(prompt):
        if prompt == "0":
            stuck.wait(5)
        return (prompt, None, None), False

    timer = threading.Timer(0.5, lambda: (seen.append(len(taken)), stuck.set()))
    seen = []
    timer.start()
    assert sum(1 for _ in Window(ask, 2).run(prompts())) == 10_000
    assert seen[0] <= Window.AHEAD * 2 + 2


def test_a_throttled_window_narrows_and_grows():
    flying, most, refused = [0], [], Counter()
    lock = threading.Lock()

    def ask(prompt):
        with lock:
            flying[0] += 1
            now = flying[0]
            most.append(now)
        time.sleep(0.003)
        with lock:
            flying[0] -= 1
        if now > 3:
            refused[prompt] += 1
            return (None, "skipped_unexpected", "busy"), True
        return (prompt, None, None), False

    window = Window(ask, 16, attempts=50, pause_seconds=0.001)
    assert [c.result[0] for c in window.run(calls(str(i) for i in range(400)))] == [str(i) for i in range(400)]
    late = most[len(most) // 2 :]
    assert max(most[:20]) > 8 and sum(late) / len(late) < 6 and refused
    # Without attempts to spare a refused call is its row's end, as any failed call is.
    once = [c.result for c in Window(ask, 16).run(calls(str(i) for i in range(100)))]
    assert {r[1] for r in once if r[0] is None} == {"skipped_unexpected"}


def test_throttled_statuses(spark):
    class Busy:
        def open(self):
            def reply(prompt):
                raise Throttled("HTTP 429")

            return reply

    rows = infer(spark.createDataFrame([("a",), (None,)], "prompt string"), Busy()).collect()
    assert {(r.status, r.error) for r in rows} == {("skipped_unexpected", "OSError: HTTP 429"), ("skipped_no_text", "row does not contain any usable text fields")}


def test_undecodable_replies_are_unexpected(spark):
    assert parse_reply('{"question": ' + "[" * 100_000 + "}")[2] == "undecodable" and parse_reply('{"n": ' + "1" * 5000 + "}")[2] == "undecodable"
    assert parse_reply('{"question": }')[2] == "bad_json"


# Replies that outlive their task.


class Counting(http.server.BaseHTTPRequestHandler):
    protocol_version = "HTTP/1.1"
    asked: Counter = Counter()

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.asked[body["messages"][1]["content"]] += 1
        data = json.dumps({"choices": [{"message": {"content": GOOD}}]}).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *_):
        pass


KILLED = """
import os, signal, sys
from pyspark.sql import SparkSession, functions as F
from quern.operators import HttpChatBackend, infer, replylog
import quern.operators.inference as inference
port, log, mark = sys.argv[1:]
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

class Dying(HttpChatBackend):
    def open(self):
        reply = super().open()
        def ask(prompt):
            if prompt == "p 70" and not os.path.exists(mark):
                open(mark, "w").close()
                os.kill(os.getpid(), signal.SIGKILL)
            replylog.EVERY = 1
            return reply(prompt)
        return ask

df = spark.range(100).select(F.concat(F.lit("p "), F.col("id")).alias("prompt")).coalesce(1)
rows = infer(df, Dying(f"http://127.0.0.1:{port}/v1", "m"), calls_per_task=4, log=log).collect()
assert len(rows) == 100 and {r.status for r in rows} == {"written"} and os.path.exists(mark)
"""


def test_a_killed_worker_asks_no_more_than_what_was_in_flight(spark, tmp_path):
    one = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Counting)
    threading.Thread(target=one.serve_forever, daemon=True).start()
    Counting.asked.clear()
    try:
        (tmp_path / "run.py").write_text(KILLED)
        env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parent.parent)}
        subprocess.run([sys.executable, str(tmp_path / "run.py"), str(one.server_port), str(tmp_path / "log"), str(tmp_path / "mark")], check=True, env=env, timeout=200)
        assert len(Counting.asked) == 100 and sum(Counting.asked.values()) <= 104, Counting.asked.most_common(8)
    finally:
        one.shutdown()


def test_a_later_run_asks_for_what_is_not_filed(spark, data):
    class Echo:
        def __init__(self, asked, name="m"):
            self.asked, self.name = asked, name

        def open(self):
            reply, asked = EchoBackend().open(), self.asked

            def ask(prompt):
                Path(f"{asked}/{uuid.uuid4().hex}").touch()
                return reply(prompt)

            return ask

    (data / "asked").mkdir()
    n = lambda: len(list((data / "asked").iterdir()))
    rows = prepare(read_dataset(spark, "set", root=f"{data}/data"))
    first = infer(rows.where("row_index < 120"), Echo(f"{data}/asked"), 3, log=f"{data}/log").collect()
    assert n() == 120
    again = infer(rows, Echo(f"{data}/asked"), 5, log=f"{data}/log", calls_per_task=3).collect()
    assert n() == 200 and len(again) == 200 and {tuple(r) for r in first} <= {tuple(r) for r in again}
    infer(rows, Echo(f"{data}/asked", "another model"), 2, log=f"{data}/log").collect()
    assert n() == 400


# Runs that end early, and runs that go on.


def lines(path):
    return sorted(json.loads(x)["meta"]["row_id"] for f in path.glob("part-*") for x in f.read_text().splitlines())


def config(data, **more):
    return GenerateConfig("set", f"{data}/out", root=f"{data}/data", backend="echo", **more)


def test_a_run_that_ended_before_its_sink_is_finished(spark, data, monkeypatch):
    module = sys.modules["quern.plans.generate"]

    def lost(*_):
        raise RuntimeError("lost")

    for at in ("_finish", "_move_all"):
        with monkeypatch.context() as m:
            m.setattr(module, at, lost)
            with pytest.raises(RuntimeError, match="lost"):
                generate(spark, config(data, start_row=0 if at == "_finish" else 50, max_rows=50))
        assert len(list((data / "out.work").iterdir())) == 1
        finish_earlier(spark, f"{data}/out")
        assert not (data / "out.work").exists()
    assert lines(data / "out") == sorted(str(i) for i in range(100))
    # A run that ended among its moves moves the rest.
    moved = []

    def half(store, work, out, run):
        names = [x for x in store.names(work) if x.startswith("part-")]
        if not moved:
            store.make(out)
            moved.append(names[0])
            store.move(f"{work}/{names[0]}", f"{out}/part-{names[0].split('-')[1]}-{run}.jsonl")
            raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(module, "_move_all", half)
        with pytest.raises(RuntimeError, match="lost"):
            generate(spark, config(data, start_row=100, inference_parallelism=3))
    assert generate(spark, config(data, resume=True)) == {"written": 0, "skipped": 0}
    assert lines(data / "out") == sorted(str(i) for i in range(200))


def test_resuming_reads_no_records(spark, data):
    generate(spark, config(data, start_row=20, max_rows=60))
    known = written_ids(spark, f"{data}/out", "set")
    left = prepare(read_dataset(spark, "set", root=f"{data}/data"), known=known)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "FileScan json" not in plan and "FileScan text" not in plan
    assert sorted(r.row_index for r in left.collect()) == [*range(20), *range(80, 200)]
    assert generate(spark, config(data, resume=True)) == {"written": 140, "skipped": 0}
    assert lines(data / "out") == sorted(str(i) for i in range(200))
    # Records without an index are read once, to make one.
    import shutil

    shutil.rmtree(data / "out.index")
    assert generate(spark, config(data, resume=True)) == {"written": 0, "skipped": 0} and (data / "out.index").exists()


def test_known_keys(spark):
    rows = spark.range(3000).select(F.col("id").alias("Key"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("key"))
    known = spark.range(1000, 9000, 2).select(F.col("id").cast("string").alias("key"))
    wanted = {i for i in range(3000) if i % 7 == 0 or i < 1000 or i % 2}
    assert {r[0] for r in without_known(rows, known, "key").collect()} == wanted
    assert {r[0] for r in without_known(rows, known.where("false"), "key").collect()} == set(range(3000))
    # Few of the new rows look known.
    bits = 1 << 17
    seen = {(r.bucket, i) for r in key_filter(known, "key", bits).collect() for i in range(1 << 15) if r.bitmap[i // 8] >> i % 8 & 1}
    assert 3800 < len(seen) <= 4000


def test_counts_are_of_the_write(spark, data):
    done = statuses(prepare(read_dataset(spark, "set", root=f"{data}/data")), EchoBackend(), 2)
    assert records(done, "s", "t").count() == 200
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "a run")
    try:
        assert generate(spark, config(data, inference_parallelism=2)) == {"written": 200, "skipped": 0}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("counted")) <= 9


def test_finishing_needs_the_replies(spark, data):
    with pytest.raises(Exception):  # noqa: B017
        _finish(spark, f"{data}/out", "no-such-run")
