"""Whole runs."""

from .generate import GenerateConfig, generate, prepare, prepare_numbered, records, statuses

__all__ = ["GenerateConfig", "generate", "prepare", "prepare_numbered", "records", "statuses"]
