"""Command line: python -m quern.cli generate ..., python -m quern.cli prefetch ..."""

from __future__ import annotations

import argparse
import dataclasses
import logging
import os
import sys

from .plans.generate import GenerateConfig, generate
from .session import session
from .sources.datasets import parse_dataset_list
from .sources.jsonl import default_output_name
from .sources.prefetch import prefetch_datasets

# The names and defaults of flags, and the log levels, are the public interface.
LEVELS = ["DEBUG", "INFO", "WARNING", "ERROR"]


def build_parser() -> argparse.ArgumentParser:
    default = {f.name: f.default for f in dataclasses.fields(GenerateConfig)}
    parser = argparse.ArgumentParser(prog="quern")
    commands = parser.add_subparsers(dest="command", required=True)
    g = commands.add_parser("generate", help="question-answer pairs from a dataset")
    g.add_argument("--dataset", required=True)
    g.add_argument("--split", default=default["split"])
    g.add_argument("--out", default=None, help="folder of JSON Lines files, appended to; named after dataset and model if not given")
    g.add_argument("--single-file", default=None, help="the run's records in one file too, in the order of rows")
    g.add_argument("--api-base", default=default["api_base"])
    g.add_argument("--model", default=default["model"])
    g.add_argument("--api-key", default=None)
    g.add_argument("--max-rows", type=int, default=None)
    for name, kind in (("start_row", int), ("max_source_chars", int), ("max_tokens", int), ("temperature", float), ("timeout_seconds", float)):
        g.add_argument(f"--{name.replace('_', '-')}", type=kind, default=default[name])
    g.add_argument("--enable-thinking", action="store_true")
    g.add_argument("--skip-healthcheck", action="store_true")
    g.add_argument("--root", default="", help="where datasets are looked for")
    g.add_argument("--format", dest="fmt", default=None)
    g.add_argument("--inference-parallelism", type=int, default=None, help="calls at a time")
    g.add_argument("--calls-per-task", type=int, default=default["calls_per_task"], help="calls at a time in each partition")
    g.add_argument("--health-attempts", type=int, default=default["health_attempts"])
    g.add_argument("--health-delay-seconds", type=float, default=default["health_delay_seconds"])
    g.add_argument("--backend", choices=["http", "echo"], default="http")
    g.add_argument("--reply-log", default=None, help="folder of replies; what is in it isn't asked for again")
    g.add_argument("--attempts", type=int, default=default["attempts"], help="how often a call is sent that the server has no time for")
    g.add_argument("--resume", action="store_true", help="leave out rows that have a record")
    p = commands.add_parser("prefetch", help="datasets to a Parquet cache")
    p.add_argument("--model", default=default["model"], help="taken for compatibility: models aren't fetched")
    p.add_argument("--dataset", action="append", default=[], help="a name, or names between commas; can be repeated")
    p.add_argument("--split", default="train")
    p.add_argument("--revision", default=None)
    p.add_argument("--token", default=None)
    p.add_argument("--skip-model", action="store_true")
    p.add_argument("--skip-datasets", action="store_true")
    p.add_argument("--root", default="")
    p.add_argument("--parallel", type=int, default=4, help="datasets that are fetched side by side")
    p.add_argument("--cache", default="quern-cache")
    for one in (g, p):
        one.add_argument("--log-level", default="INFO", choices=LEVELS)
    return parser


def main(argv: list[str] | None = None) -> int:
    """0 if the run came to its end, even if every row was skipped."""
    args = build_parser().parse_args(argv)
    logging.basicConfig(level=getattr(logging, args.log_level), format="%(asctime)s %(levelname)s %(message)s")
    if args.command == "generate":
        args.out = args.out or default_output_name(args.dataset, args.model)
        names = {f.name for f in dataclasses.fields(GenerateConfig)}
        generate(session(), GenerateConfig(**{k: v for k, v in vars(args).items() if k in names}))
        return 0
    token = args.token or os.environ.get("HF_TOKEN")
    if not args.skip_model:
        logging.info("model weights aren't fetched by this engine; %s is left to the server", args.model)
    if not args.skip_datasets:
        names = [x for text in args.dataset for x in parse_dataset_list(text)]
        prefetch_datasets(session(), names, args.cache, args.split, args.root, revision=args.revision, token=token, parallel=args.parallel)
    return 0


if __name__ == "__main__":
    sys.exit(main())
