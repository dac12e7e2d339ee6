"""The gate decided while cleaning, run files, and queries without the corpus operators."""

import subprocess
import sys
from pathlib import Path

import pytest

from hearthrate.operators.quality import strict_gate
from hearthrate.plans.flows import clean_and_gate
from hearthrate.sources import runs

ROOT = Path(__file__).resolve().parents[1]


def listings(spark, rows):
    return spark.createDataFrame(rows, "id long, price string, area string, calendar_updated string")


@pytest.mark.parametrize("rows", [
    [],
    [(i, f"${i}.50", None if i % 2 else "x", None) for i in range(1200)],
    [(i, "abc" if i == 3 else "$1,000", "x", None) for i in range(20)] * 2,
    [(1, None, None, None)],
])
def test_gate_while_cleaning_agrees_with_a_scan(spark, tmp_path, rows):
    limits = {"required": ["id", "price", "beds"], "min_rows": 1000}
    table, failures, steps = clean_and_gate(listings(spark, rows), str(tmp_path / "clean"), **limits)
    assert sorted(map(tuple, failures.collect())) == sorted(map(tuple, strict_gate(table, **limits).collect()))
    assert steps == {"raw": len(rows), "priced": sum(r[1] is not None for r in rows), "distinct": table.count()}
    assert "calendar_updated" not in table.columns


def test_run_files_give_back_the_runs(spark, tmp_path):
    first = runs.run_rows(spark, "a", {"model_name": "x y", "depth": 3}, {"test_mae": 1.25, "r2": -0.5}, {"production": "true"})
    rows = first.unionByName(runs.run_rows(spark, "b", {"model_name": "z"}, {"test_mae": 1e-7}))
    runs.write_run_files(rows, str(tmp_path / "runs"), at_ms=1)
    assert (tmp_path / "runs" / "a" / "metrics" / "test_mae").read_text() == "1 1.25 0\n"
    back = runs.scan_run_files(spark, str(tmp_path / "runs"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(ValueError, match="run entries"):
        runs.write_run_files(rows, str(tmp_path / "more"), at_ms=1, most=2)


@pytest.mark.parametrize("absent", ["hearthrate.llm", "sentencepiece", "public_tokenizers"])
def test_queries_without_the_corpus_operators(absent):
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; q = e.queries(); assert 'flagship' in q and not any(n.startswith('op') for n in q), q"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, capture_output=True)
