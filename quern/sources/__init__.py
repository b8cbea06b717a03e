"""Datasets in, JSON Lines out."""

from .datasets import find_split, parse_dataset_list, read_dataset, register_reader
from .jsonl import default_output_name, export_single_file, read_jsonl, write_jsonl
from .ordered import assemble, manifest_of, read_ordered, write_ordered
from .prefetch import prefetch_datasets
from .remote import read_remote

__all__ = ["assemble", "default_output_name", "export_single_file", "find_split", "manifest_of", "parse_dataset_list", "prefetch_datasets", "read_dataset", "read_jsonl", "read_ordered", "read_remote", "register_reader", "write_jsonl", "write_ordered"]
