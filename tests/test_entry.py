import os
import re
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_works_without_the_optional_subpackage(tmp_path):
    for name in ("harborline", "__spark_entry__.py"):
        src = os.path.join(REPO, name)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, tmp_path / name)
    shutil.rmtree(tmp_path / "harborline" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()) and 'open_po' in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_imports_it():
    for top, _, names in os.walk(os.path.join(REPO, "harborline")):
        if os.sep + "llm" in top:
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(top, n), encoding="utf-8") as f:
                    assert not re.search(r"\bllm\b", f.read())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
