"""The package imports with nothing but its own source: no jar, no JVM, and
with the optional subpackage present or absent."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_imports_without_any_jar():
    out = run("import glob; glob.glob = lambda *a, **k: []\n"
              "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))")
    assert out.returncode == 0, out.stderr[-800:]
    assert int(out.stdout.split()[0]) >= 61


def test_imports_without_the_optional_subpackage():
    out = run("import sys; sys.modules['essayspark.llm'] = None\n"
              "import __spark_entry__ as e; print(sorted(q for q in e.queries() if q.startswith('op')))")
    assert out.returncode == 0, out.stderr[-800:]
    assert out.stdout.strip() == "[]"


def test_stop_words_are_the_default_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    from essayspark.functions.fixed_values import ENGLISH_STOP_WORDS

    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
