from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skerry.session import build_session  # noqa: E402


def local_session():
    spark = build_session(
        "skerry-tests",
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return local_session()
