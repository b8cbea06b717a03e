"""Runs from end to end: offline, and against a server on this machine."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from quern.cli import build_parser, main
from quern.operators import EchoBackend, HttpChatBackend, ScriptedBackend, infer, run_summary, status_breakdown
from quern.operators.inference import InferenceError
from quern.plans import GenerateConfig, generate, prepare, records, statuses
from quern.sources import default_output_name, export_single_file, find_split, parse_dataset_list, prefetch_datasets, read_dataset, register_reader
from quern.sources.datasets import NoDataFiles
from quern.streaming import generate_stream

GOOD = '{"question": "q", "answer": "a"}'


@pytest.fixture
def root(spark, tmp_path):
    rows = [(10, "alpha  text"), (11, " "), (12, 'beta "quoted"\ntext'), (13, "gamma\x01")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/data/set/train.parquet")
    return tmp_path


def lines(path):
    return [json.loads(x) for f in sorted(path.glob("part-*")) for x in f.read_text().splitlines()]


def test_offline_run(spark, root):
    cfg = GenerateConfig("set", f"{root}/out", root=f"{root}/data", backend="echo", inference_parallelism=2)
    assert generate(spark, cfg) == {"written": 3, "skipped": 1}
    found = sorted(lines(root / "out"), key=lambda r: r["meta"]["row_id"])
    assert [r["meta"] for r in found] == [{"dataset": "set", "split": "train", "row_id": i, "source_fields": "text"} for i in ("10", "12", "13")]
    assert [m["role"] for m in found[0]["messages"]] == ["user", "assistant"]
    assert json.loads(found[1]["messages"][1]["content"])["answer"] == 'beta "quoted" text'
    generate(spark, cfg)
    assert len(lines(root / "out")) == 6  # appended
    assert generate(spark, GenerateConfig("set", f"{root}/out", root=f"{root}/data", backend="echo", resume=True)) == {"written": 0, "skipped": 1}


def test_lines_are_pythons_json(spark, root):
    done = statuses(prepare(read_dataset(spark, "set", root=f"{root}/data")), EchoBackend())
    for r in records(done, "s", "t").collect():
        record = {"messages": [m.asDict() for m in r.record.messages], "meta": r.record.meta.asDict()}
        assert r.line == json.dumps(record, ensure_ascii=False)


def test_statuses(spark, root):
    backend = ScriptedBackend({"alpha": InferenceError("no"), "beta": OSError("down")}, default="no object")
    done = statuses(prepare(read_dataset(spark, "set", root=f"{root}/data")), backend)
    assert {r.row_id: r.status for r in done.collect()} == {"10": "skipped_inference", "11": "skipped_no_text", "12": "skipped_unexpected", "13": "skipped_inference"}
    assert run_summary(done).first().asDict() == {"written": 0, "skipped": 4}
    assert {r.status: r.rows for r in status_breakdown(done).collect()} == {"skipped_inference": 2, "skipped_no_text": 1, "skipped_unexpected": 1}


def test_one_python_node_and_partitions(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("prompt"))
    out = infer(df, ScriptedBackend(default=GOOD), 7).where("status = 'written' and question = 'q'")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "EvalPython" not in plan
    assert out.rdd.getNumPartitions() == 7 and out.count() == 100


class Handler(http.server.BaseHTTPRequestHandler):
    calls: list = []
    protocol_version = "HTTP/1.1"

    def answer(self, status, body):
        self.send_response(status)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def do_GET(self):
        self.calls.append(("GET", self.path, None, None))
        self.answer(self.server.health, b"")

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.calls.append(("POST", self.path, body, self.headers["Authorization"]))
        prompt = body["messages"][1]["content"]
        ok = {"choices": [{"message": {"content": GOOD}}]}
        for word, (status, answer) in {"alpha": (200, ok), "beta": (500, {}), "gamma": (200, {"choices": []}), "delta": (200, {"choices": [{"message": {"content": None}}]}), "epsilon": (200, None)}.items():
            if word in prompt:
                self.answer(status, b"not json" if answer is None else json.dumps(answer).encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def server():
    Handler.calls.clear()
    one = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    one.health = 200
    threading.Thread(target=one.serve_forever, daemon=True).start()
    yield one
    one.shutdown()


def test_http(spark, tmp_path, server):
    rows = [(i, w) for i, w in enumerate(["alpha", "beta", "gamma", "delta", "epsilon", ""])]
    spark.createDataFrame(rows, "id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d/s/train.parquet")
    base = f"http://127.0.0.1:{server.server_port}/v1/"
    cfg = GenerateConfig("s", f"{tmp_path}/out", root=f"{tmp_path}/d", api_base=base, api_key="secret", inference_parallelism=1)
    assert generate(spark, cfg) == {"written": 1, "skipped": 5}
    posts = [c for c in Handler.calls if c[0] == "POST"]
    assert Handler.calls[0][:2] == ("GET", "/health")
    assert len(posts) == 5 and {c[1] for c in posts} == {"/v1/chat/completions"} and {c[3] for c in posts} == {"Bearer secret"}
    assert all(c[2]["chat_template_kwargs"] == {"enable_thinking": False} for c in posts)
    assert "secret" not in repr(cfg) + repr(cfg.make_backend())
    server.health = 503
    with pytest.raises(OSError):
        generate(spark, cfg)
    assert len([c for c in Handler.calls if c[0] == "POST"]) == 5


def test_http_statuses(spark, server):
    backend = HttpChatBackend(f"http://127.0.0.1:{server.server_port}/v1", "m", enable_thinking=True)
    df = spark.createDataFrame([(w,) for w in ("alpha", "beta", "gamma", "delta", "epsilon")], "prompt string").coalesce(1)
    assert {r.prompt: r.status for r in infer(df, backend).collect()} == {"alpha": "written", "beta": "skipped_unexpected", "gamma": "skipped_inference", "delta": "skipped_unexpected", "epsilon": "skipped_unexpected"}
    assert all("chat_template_kwargs" not in c[2] for c in Handler.calls) and {c[3] for c in Handler.calls} == {"Bearer EMPTY"}


class Closing(Handler):
    """Closes each connection after its answer, without saying so."""

    def do_POST(self):
        super().do_POST()
        self.close_connection = True


def test_connections_that_the_server_closes(spark):
    one = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Closing)
    threading.Thread(target=one.serve_forever, daemon=True).start()
    try:
        backend = HttpChatBackend(f"http://127.0.0.1:{one.server_port}/v1", "m")
        df = spark.range(20).select(F.concat(F.lit("alpha "), F.col("id").cast("string")).alias("prompt"))
        for calls in (1, 5):
            assert {r.status for r in infer(df, backend, 2, calls_per_task=calls).collect()} == {"written"}
    finally:
        one.shutdown()
    down = infer(df.limit(2), HttpChatBackend("http://127.0.0.1:9/v1", "m")).collect()
    assert {r.status for r in down} == {"skipped_unexpected"} and all("ConnectionRefused" in r.error for r in down)


def test_calls_in_flight(spark):
    class SlowBackend:
        """Replies with the number of calls that are in flight."""

        def __init__(self):
            self.now = []

        def open(self):
            import time

            def reply(prompt):
                self.now.append(prompt)
                time.sleep(0.02)
                n = len(self.now)
                self.now.remove(prompt)
                return json.dumps({"question": str(n), "answer": "a"})

            return reply

    df = spark.range(40).select(F.col("id").cast("string").alias("prompt")).coalesce(1)
    found = infer(df, SlowBackend(), calls_per_task=8).collect()
    assert [r.prompt for r in found] == [str(i) for i in range(40)] and max(int(r.question) for r in found) > 1
    assert max(int(r.question) for r in infer(df, SlowBackend()).collect()) == 1


def test_one_scan(spark, root):
    done = statuses(prepare(read_dataset(spark, "set", root=f"{root}/data")), EchoBackend(), 3)
    assert done._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_resuming_says_what_fails(spark, root):
    (root / "broken").mkdir()
    (root / "broken/part-0.json").write_text("{}")
    assert generate(spark, GenerateConfig("set", f"{root}/new", root=f"{root}/data", backend="echo", resume=True))["written"] == 3
    with pytest.raises(Exception, match="nosuchscheme"):
        generate(spark, GenerateConfig("set", "nosuchscheme://x/y", root=f"{root}/data", backend="echo", resume=True))


def test_readers_by_name(spark, root, caplog):
    seen = []
    register_reader("hub", lambda spark, name, split, revision, token: seen.append((name, split, revision, token)) or spark.createDataFrame([(1, "x")], "id long, text string"))
    try:
        assert main(["prefetch", "--skip-model", "--dataset", "hub:a/b, set", "--root", f"{root}/data", "--cache", f"{root}/cache2", "--revision", "r1", "--token", "t"]) == 0
    finally:
        register_reader("hub", None)
    assert seen == [("a/b", "train", "r1", "t")] and "no revisions" in caplog.text
    assert spark.read.parquet(f"{root}/cache2/set/train").count() == 4


def test_cli_single_file_and_causes(spark, root, caplog):
    caplog.set_level("INFO")
    assert main(["generate", "--dataset", "set", "--out", f"{root}/o2", "--root", f"{root}/data", "--backend", "echo", "--single-file", f"{root}/one.jsonl", "--calls-per-task", "2"]) == 0
    assert [json.loads(x)["meta"]["row_id"] for x in (root / "one.jsonl").read_text().splitlines()] == ["10", "12", "13"]
    assert "skipped: 1 rows, skipped_no_text" in caplog.text and "rows=4 columns=['doc_id', 'text']" in caplog.text
    args = build_parser().parse_args(["generate", "--dataset", "d/e"])
    assert args.out is None and (args.health_attempts, args.health_delay_seconds) == (1, 2.0)


def test_health_is_asked_for_again(spark, root, server):
    server.health = 503
    threading.Timer(0.5, lambda: setattr(server, "health", 200)).start()
    cfg = GenerateConfig("set", f"{root}/o3", root=f"{root}/data", api_base=f"http://127.0.0.1:{server.server_port}/v1", health_attempts=30, health_delay_seconds=0.1)
    assert generate(spark, cfg)["skipped"] == 4 - generate(spark, cfg)["written"]
    assert len([c for c in Handler.calls if c[0] == "GET"]) > 2


def test_cli(spark, root):
    args = build_parser().parse_args(["generate", "--dataset", "d", "--out", "o"])
    assert (args.split, args.api_base, args.start_row, args.max_rows, args.max_source_chars, args.max_tokens, args.temperature, args.timeout_seconds) == ("train", "http://localhost:8000/v1", 0, None, 4000, 512, 0.2, 180.0)
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{root}/data/blank/train.parquet")
    assert main(["generate", "--dataset", "blank", "--out", f"{root}/o", "--root", f"{root}/data", "--backend", "echo"]) == 0
    assert main(["prefetch", "--skip-model", "--dataset", "set", "--dataset", "none", "--root", f"{root}/data", "--cache", f"{root}/cache"]) == 0
    assert spark.read.parquet(f"{root}/cache/set/train").count() == 4


def test_sources(spark, root):
    assert parse_dataset_list(" a/b, ,c ,") == ["a/b", "c"] and parse_dataset_list(None) == []
    assert default_output_name("a/b", "m/n") == "synthetic_a_b_m_n_manual.jsonl"
    with pytest.raises(NoDataFiles):
        find_split(spark, f"{root}/data", "absent")
    report = prefetch_datasets(spark, ["set", "absent"], f"{root}/c", root=f"{root}/data").collect()
    assert [(r.status, r.rows) for r in report] == [("cached", 4), ("no_data_files", None)]
    assert prefetch_datasets(spark, [], f"{root}/c").count() == 0
    for kind, text in (("jsonl", '{"text": "j"}\n'), ("csv", "text\nc\n"), ("txt", "t\n")):
        (root / f"data/k_{kind}").mkdir()
        (root / f"data/k_{kind}/test.{kind}").write_text(text)
        assert read_dataset(spark, f"k_{kind}", "test", f"{root}/data").first().text == kind[0]
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, line string")
    assert open(export_single_file(df, f"{root}/one.jsonl", "n")).read() == "a\nb\n"


def test_stream(spark, root):
    rows = spark.readStream.schema("doc_id long, text string").parquet(f"{root}/data/set/train.parquet")
    generate_stream(rows, EchoBackend(), f"{root}/stream", f"{root}/mark", "set").awaitTermination()
    found = [json.loads(r.value) for r in spark.read.text(f"{root}/stream").select("value").collect()]
    assert sorted(r["meta"]["row_id"] for r in found) == ["10", "12", "13"]
