"""The library, its queries and their SQL without the corpus operators."""

import os
import re
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def loaded(folder: str) -> list[str]:
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql())); print(callable(e.entry))"
    env = {**os.environ, "PYTHONPATH": folder}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, check=True, capture_output=True, text=True).stdout.splitlines()


def copied(to, *lost: str) -> str:
    skip = {os.path.join(ROOT, x) for x in (".git", *lost)}
    shutil.copytree(ROOT, to, ignore=lambda at, names: [n for n in names if os.path.join(at, n) in skip or n == "__pycache__"])
    return str(to)


def test_without_both_folders(tmp_path):
    """Also where the pipeline's file is left, or lost on its own."""
    from methframe.oracles import ORACLES
    from methframe.queries import QUERIES

    for k, lost in enumerate([("methframe/llm", "tests/llm"), ("methframe/llm", "tests/llm", "corpus_pipeline.py")]):
        names, sql, entry = loaded(copied(tmp_path / str(k), *lost))
        assert names.split() == sorted(QUERIES) and sql.split() == sorted(ORACLES) and entry == "True"


def test_core_imports_no_corpus_operator():
    for at, _, files in os.walk(os.path.join(ROOT, "methframe")):
        if os.path.basename(at) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(at, name)) as f:
                        assert not re.search(r"^\s*(?:from|import)\b.*\bllm\b", f.read(), re.M), name
