import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linebeam.session import build_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture
def stage(spark):
    """A fresh folder below the session's checkpoint folder."""
    def make(name="t"):
        return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:6]}")
    return make


def write_files(folder: str, files: dict[str, str]) -> list[str]:
    """Create small text files for golden samples; returns their paths."""
    path = folder.replace("file:", "")
    os.makedirs(path, exist_ok=True)
    out = []
    for name, body in files.items():
        p = os.path.join(path, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8") as fh:
            fh.write(body)
        out.append(p)
    return out
