"""The core stands without the corpus operators, whatever is left of them."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), any(n.startswith('op') for n in e.queries()))"


def names(folder):
    run = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(folder)})
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "compiled files"])
def test_without_corpus_operators(tmp_path, left):
    for name in ("lexiloom", "__spark_entry__.py"):
        copy = shutil.copytree if os.path.isdir(f"{HERE}/{name}") else shutil.copy
        copy(f"{HERE}/{name}", tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if copy is shutil.copytree else {}))
    if left != "nothing":
        os.makedirs(tmp_path / "lexiloom" / "llm" / "__pycache__")
    if left == "compiled files":
        (tmp_path / "lexiloom" / "llm" / "__pycache__" / "queries.cpython-313.pyc").write_bytes(b"")
    # With a pipeline that can't be imported any more, and without one.
    for pipeline in (True, False):
        if pipeline and os.path.exists(f"{HERE}/corpus_pipeline.py"):
            shutil.copy(f"{HERE}/corpus_pipeline.py", tmp_path)
        count, has_pipeline, has_corpus = names(tmp_path)
        assert int(count) > 90 and (has_pipeline, has_corpus) == ("False", "False")
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_faults_inside_the_operators_are_not_hidden(tmp_path):
    shutil.copytree(f"{HERE}/lexiloom", tmp_path / "lexiloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{HERE}/__spark_entry__.py", tmp_path)
    os.makedirs(tmp_path / "lexiloom" / "llm")
    (tmp_path / "lexiloom" / "llm" / "__init__.py").write_text("")
    (tmp_path / "lexiloom" / "llm" / "queries.py").write_text("import no_such_module\n")
    run = subprocess.run([sys.executable, "-c", NAMES], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert run.returncode and "no_such_module" in run.stderr
