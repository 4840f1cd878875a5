"""Imports every module that registers queries."""

from . import q_assembly, q_hits, q_merge, q_reads, q_rules, q_similarity, q_sites, q_targets  # noqa: F401
