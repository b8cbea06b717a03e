"""Generation from end to end: rows to prompts to replies to chat records.

    dataset -> ordinal -> row range -> best text, id, prompt -> model -> records -> JSON Lines

Rows that are skipped stay rows, with a status. What the model said is written once, to a work folder, and counted as it is written;
the sink reads it there, so no row is asked about twice. The sink has two phases: lines and the ids of their rows are written
beside the output, then moved into it, file by file, under names of the run; doing that again changes nothing. A run that ended in between is finished by the next one, then
its work folder is deleted.
"""

from __future__ import annotations

import json
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import escape_controls
from ..operators.extract import SOURCE_CHARS, with_row_id, with_source_text
from ..operators.inference import Backend, EchoBackend, HttpChatBackend, infer, wait_until_healthy
from ..operators.prompts import user_prompt
from ..operators.records import chat_record, raw_assistant_json, raw_record_json
from ..operators.resume import without_known
from ..operators.rows import rows_in_range
from ..operators.summary import counted, counts_of, dataset_profile
from ..sources.datasets import read_dataset
from ..sources.hadoop import Store
from ..sources.jsonl import export_single_file

LOG = logging.getLogger("quern.generate")


@dataclass(frozen=True)
class GenerateConfig:
    dataset: str
    out: str
    split: str = "train"
    api_base: str = "http://localhost:8000/v1"
    model: str = "Qwen/Qwen3.5-397B-A17B"
    api_key: str | None = field(default=None, repr=False)
    max_rows: int | None = None
    start_row: int = 0
    max_source_chars: int = SOURCE_CHARS
    max_tokens: int = 512
    temperature: float = 0.2
    timeout_seconds: float = 180.0
    enable_thinking: bool = False
    skip_healthcheck: bool = False
    root: str = ""
    fmt: str | None = None
    #: Calls at a time, over all executors; None: as many as the dataset has partitions.
    inference_parallelism: int | None = None
    #: Calls at a time in each of those partitions.
    calls_per_task: int = 1
    #: How often the server's health is asked for before a run is given up, and the seconds between.
    health_attempts: int = 1
    health_delay_seconds: float = 2.0
    #: The run's records in one file too, in the order of rows.
    single_file: str | None = None
    backend: str = "http"
    #: Leave out rows of which out has a record already.
    resume: bool = False
    #: A folder of replies; what is in it isn't asked for again. None: no replies are kept.
    reply_log: str | None = None
    #: How often a call that the server has no time for (429, 503) is sent, in all.
    attempts: int = 1

    def make_backend(self) -> Backend:
        if self.backend == "echo":
            return EchoBackend()
        return HttpChatBackend(self.api_base, self.model, self.api_key, self.temperature, self.max_tokens, self.timeout_seconds, self.enable_thinking)


def prepare(df: DataFrame, start_row: int = 0, max_rows: int | None = None, max_source_chars: int = SOURCE_CHARS, known: DataFrame | None = None) -> DataFrame:
    """A dataset's rows to row_index, row_id, source_fields, source_text and prompt; the last three are null without usable text.

    known: (row_id) of rows to leave out, before anything is made of their texts.
    """
    rows = rows_in_range(df, start_row, max_rows, "__row_index")
    if known is not None:
        left = without_known(with_row_id(rows, "__row_index", "__known_id"), known.select(F.col("row_id").alias("__known_id")), "__known_id")
        rows = left.drop("__known_id")
    return prepare_numbered(rows, max_source_chars)


def prepare_numbered(rows: DataFrame, max_source_chars: int = SOURCE_CHARS) -> DataFrame:
    """prepare() of rows whose ordinal is in __row_index."""
    texts = with_row_id(with_source_text(rows, max_source_chars, skip=("__row_index",)), "__row_index", "__row_id")
    # By place, from the end: the dataset's own columns may have these names too.
    plain = texts.toDF(*(f"c{i}" for i in range(len(texts.columns))))
    at = {n: F.col(f"c{len(texts.columns) - 1 - texts.columns[::-1].index(n)}") for n in ("__row_index", "__row_id", "source_fields", "source_text")}
    return plain.select(at["__row_index"].alias("row_index"), at["__row_id"].alias("row_id"), at["source_fields"].alias("source_fields"), at["source_text"].alias("source_text"), user_prompt(at["source_text"]).alias("prompt"))


def statuses(prepared: DataFrame, backend: Backend, parallelism: int | None = None, calls_per_task: int = 1, log: str | None = None, attempts: int = 1) -> DataFrame:
    """Prepared rows with question, answer, status and error, in one scan. Rows without text have no prompt, and never come near the model."""
    return infer(prepared, backend, parallelism, calls_per_task=calls_per_task, log=log, attempts=attempts)


def records(done: DataFrame, dataset: str, split: str) -> DataFrame:
    """Rows that were written, as row_index, record (typed) and line (its JSON)."""
    # Steps one by one: what a step looks at several times is then made once.
    written = done.where("status = 'written'").withColumn("__said", raw_assistant_json(F.col("question"), F.col("answer"))).withColumn("__said", escape_controls(F.col("__said")))
    record = chat_record(F.col("prompt"), F.col("__said"), F.lit(dataset), F.lit(split), F.col("row_id"), F.col("source_fields"))
    return written.select("row_index", record.alias("record")).select("*", raw_record_json(F.col("record")).alias("line")).withColumn("line", escape_controls(F.col("line")))


_IDS = "dataset string, split string, row_id string"


def _index(out: str) -> str:
    return f"{out.rstrip('/')}.index"


def written_ids(spark: SparkSession, out: str, dataset: str, split: str = "train") -> DataFrame | None:
    """(row_id) of all rows of the dataset's split that out has records of, from the index beside it; None without records.

    Records of which there's no index (written by other means) are read once, to make one.
    """
    store = Store(spark)
    if not store.exists(_index(out)):
        if not store.exists(out):
            return None
        meta = "meta struct<dataset: string, split: string, row_id: string>"
        old = spark.read.schema(meta).json(out).where("meta.row_id is not null").select("meta.dataset", "meta.split", "meta.row_id")
        old.write.parquet(f"{_index(out)}.new")
        store.move(f"{_index(out)}.new", _index(out))
    return spark.read.schema(_IDS).parquet(_index(out)).where((F.col("dataset") == dataset) & (F.col("split") == split)).select("row_id")


def _work(out: str) -> str:
    return f"{out.rstrip('/')}.work"


def _move_all(store: Store, work: str, out: str, run: str) -> None:
    """The data files of work into out, under names of the run; those that are there already were moved before."""
    store.make(out)
    for name in store.names(work):
        if name.startswith("part-"):
            number = name.split("-")[1]
            store.move(f"{work}/{name}", f"{out.rstrip('/')}/part-{number}-{run}{'.parquet' if name.endswith('.parquet') else '.jsonl'}")


def _finish(spark: SparkSession, out: str, run: str) -> None:
    """From what the model said to records in out and their ids in its index; then the run's work folder goes."""
    store, work = Store(spark), f"{_work(out)}/{run}"
    about = json.loads(store.read(f"{work}/run.json"))
    kept = spark.read.parquet(f"{work}/replies")
    if not store.exists(f"{work}/ready"):
        lines = records(kept, about["dataset"], about["split"])
        lines.select(F.col("line").alias("value")).write.mode("overwrite").text(f"{work}/lines")
        ids = kept.where("status = 'written'").select(F.lit(about["dataset"]).alias("dataset"), F.lit(about["split"]).alias("split"), "row_id")
        ids.write.mode("overwrite").parquet(f"{work}/ids")
        if about["single_file"]:
            export_single_file(lines, about["single_file"], "row_index")
        store.write(f"{work}/ready", run)
    _move_all(store, f"{work}/lines", out, run)
    _move_all(store, f"{work}/ids", _index(out), run)
    store.delete(work)
    if not store.names(_work(out)):
        store.delete(_work(out))


def finish_earlier(spark: SparkSession, out: str) -> list[str]:
    """Finishes runs to out that ended after the model had been asked about all rows; others can't be, and are asked about anew. Not to be called while another run to out goes on."""
    store, done = Store(spark), []
    for run in store.names(_work(out)):
        if store.exists(f"{_work(out)}/{run}/replies/_SUCCESS"):
            _finish(spark, out, run)
            done.append(run)
            LOG.info("finished run %s, which had ended early", run)
    return done


def generate(spark: SparkSession, cfg: GenerateConfig, backend: Backend | None = None) -> dict[str, int]:
    """Runs cfg, appends records to the folder cfg.out, and returns how many rows were written and skipped."""
    backend = backend or cfg.make_backend()
    if isinstance(backend, HttpChatBackend) and not cfg.skip_healthcheck:
        wait_until_healthy(backend.health_url, cfg.health_attempts, cfg.health_delay_seconds, cfg.timeout_seconds)
    finish_earlier(spark, cfg.out)
    rows = read_dataset(spark, cfg.dataset, cfg.split, cfg.root, cfg.fmt)
    if LOG.isEnabledFor(logging.INFO):
        LOG.info("dataset=%s split=%s rows=%d columns=%s", cfg.dataset, cfg.split, dataset_profile(rows, cfg.dataset).first().rows, rows.columns)
    known = written_ids(spark, cfg.out, cfg.dataset, cfg.split) if cfg.resume else None
    prepared = prepare(rows, cfg.start_row, cfg.max_rows, cfg.max_source_chars, known)
    run, store = uuid.uuid4().hex[:16], Store(spark)
    work = f"{_work(cfg.out)}/{run}"
    store.make(work)
    store.write(f"{work}/run.json", json.dumps({"dataset": cfg.dataset, "split": cfg.split, "single_file": cfg.single_file}))
    done, seen = statuses(prepared, backend, cfg.inference_parallelism, cfg.calls_per_task, cfg.reply_log, cfg.attempts), Observation()
    counted(done, seen).write.parquet(f"{work}/replies")
    total, causes = counts_of(seen)
    _finish(spark, cfg.out, run)
    for cause, n in causes:
        LOG.warning("skipped: %d rows, %s", n, cause)
    LOG.info("written=%d skipped=%d out=%s", total["written"], total["skipped"], cfg.out)
    return total
