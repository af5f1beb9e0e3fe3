import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tributary import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = get_session(
        "llm-tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(shared / "checkpoints"),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def documents(spark):
    """Make a documents table from (doc_id, text) rows, with a clashing extra column."""

    def make(rows, extra="n_lines"):
        full = [(doc, text, "en", "src1", len(text or ""), "x") for doc, text in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {extra} string")

    return make
