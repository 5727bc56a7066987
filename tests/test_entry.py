"""The entry's guard: what is absent, what a missing library takes away, what is raised."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LLM = os.path.join(ROOT, "recengine", "llm")
CORE = "import sys; import __spark_entry__ as e; q = e.queries(); assert 'item_cosine' in q and e.oracle_sql(); print(sum(k.startswith('op') for k in q), 'pipeline' in q)"


def run(code, folder=ROOT):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONDONTWRITEBYTECODE": "1"})


@pytest.fixture()
def copy(tmp_path):
    for f in ("__spark_entry__.py", "recengine", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, f)):
            (shutil.copytree if os.path.isdir(os.path.join(ROOT, f)) else shutil.copy)(os.path.join(ROOT, f), tmp_path / f)
    return tmp_path


@pytest.mark.skipif(not os.path.exists(LLM), reason="without the training-data operators")
def test_a_missing_library_takes_only_its_queries_away():
    hide = "import sys; sys.modules['xxhash'] = None; "
    out = run(hide + CORE)
    assert out.returncode == 0 and out.stdout.split() == ["0", "False"] and "left out" in out.stderr


@pytest.mark.skipif(not os.path.exists(LLM), reason="without the training-data operators")
def test_a_fault_of_its_own_modules_is_raised(copy):
    with open(copy / "recengine" / "llm" / "queries.py", "a") as f:
        f.write("\nfrom recengine.llm import misspelt_module\n")
    assert run(CORE, copy).returncode != 0


@pytest.mark.parametrize("leftover", [False, True])
def test_without_the_subpackage(copy, leftover):
    shutil.rmtree(copy / "recengine" / "llm", ignore_errors=True)
    if leftover:
        os.makedirs(copy / "recengine" / "llm" / "__pycache__")
    if os.path.exists(copy / "corpus_pipeline.py"):
        os.remove(copy / "corpus_pipeline.py")
    out = run(CORE, copy)
    assert out.returncode == 0 and out.stdout.split() == ["0", "False"], out.stderr
