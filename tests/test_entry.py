import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_smoke(spark):
    made = __spark_entry__.entry(spark)
    assert made.columns == ["base_url", "url", "first_keyword_hit", "content", "batch"] and made.count() > 0


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_the_corpus_operators():
    for path in (ROOT / "gleanspark").rglob("*.py"):
        if "llm" not in path.parts:
            assert "gleanspark.llm" not in path.read_text(), path


def test_entry_does_without_the_corpus_operators(tmp_path):
    for name in ("__spark_entry__.py", "gleanspark"):
        subprocess.run(["cp", "-r", ROOT / name, tmp_path], check=True)
    subprocess.run(["rm", "-r", tmp_path / "gleanspark/llm"], check=False)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    n, m, corpus = out.stdout.split()
    assert int(n) > 30 and int(m) == int(n) and corpus == "False"


def test_faults_in_the_corpus_operators_come_to_light(tmp_path):
    for name in ("__spark_entry__.py", "gleanspark"):
        subprocess.run(["cp", "-r", ROOT / name, tmp_path], check=True)
    if not (tmp_path / "gleanspark/llm/__init__.py").exists():
        return
    (tmp_path / "gleanspark/llm/queries.py").write_text("import no_such_library")
    out = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__"], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode != 0 and "no_such_library" in out.stderr
