"""The driver contract, with and without the optional part."""

import os
import subprocess
import sys

import pytest

from stratum.plans.registry import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("absent", ["public_tokenizers", "stratum.llm", "corpus_pipeline", "tokenizers"])
def test_core_queries_are_there_without_the_optional_part(absent):
    code = (f"import sys, warnings; warnings.simplefilter('ignore'); sys.modules[{absent!r}] = None; "
            "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    queries, oracles = (set(line.split()) for line in done.stdout.strip().split("\n"))
    assert set(QUERIES) <= queries and oracles <= queries


def test_every_core_query_has_an_oracle():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
    assert all(callable(q) for q in entry.queries().values())
