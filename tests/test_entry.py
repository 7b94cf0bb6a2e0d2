"""The library without its optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LOOK = (
    "import __spark_entry__ as e; from assaylake.session import local_session; "
    "assert not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']; "
    "spark = local_session(2, '1g'); "
    f"assert e.queries()['dq_summary'](spark, '{FOLDER}').count() == 1; spark.stop()"
)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("left_over", [(), ("corpus_pipeline.py",), ("assaylake/llm/__pycache__/queries.pyc",)])
def test_without_the_optional_parts(tmp_path, left_over):
    copy = tmp_path / "copy"
    shutil.copytree(f"{ROOT}/assaylake", copy / "assaylake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", copy)
    for name in left_over:
        (copy / name).parent.mkdir(parents=True, exist_ok=True)
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", copy / name)
        else:
            (copy / name).write_text("")
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", LOOK], cwd=copy, env=clean, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
