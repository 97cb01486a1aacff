from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "scripts"))

from riskloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def scans(df, name: str = "events.parquet") -> int:
    """How often a query reads a table when it runs; exchanges and subqueries that it
    reuses count once."""
    df.collect()

    def of(node) -> int:
        kind = node.getClass().getSimpleName()
        if kind in ("ReusedExchangeExec", "ReusedSubqueryExec"):
            return 0
        if kind == "AdaptiveSparkPlanExec":
            return of(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return of(node.plan())
        count = int(kind == "FileSourceScanExec" and name in node.toString())
        for seq in (node.children(), node.subqueries()):
            count += sum(of(seq.apply(k)) for k in range(seq.size()))
        return count

    return of(df._jdf.queryExecution().executedPlan())
