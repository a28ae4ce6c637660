from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pairloom.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def pairs_of(spark):
    """Rows (src, tgt) or (dataset, src, tgt) -> a frame of pairs with rising ids."""

    def build(rows, dataset="d"):
        full = [(i, *(r if len(r) == 3 else (dataset, *r))) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, "pair_id bigint, dataset string, src string, tgt string").repartition(3)

    return build


def texts(df):
    return sorted(((r.src, r.tgt) for r in df.collect()), key=repr)


def ids(df):
    return sorted(r.pair_id for r in df.collect())
