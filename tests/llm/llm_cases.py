"""Shared by the tests of this folder."""

from __future__ import annotations

import hashlib

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"


def docs_of(sf_dir):
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
