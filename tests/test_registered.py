"""Every registered query against its comparison SQL."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from firnflow.plans.oracles import ORACLES
from firnflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("absent", ["corpus_pipeline", "public_tokenizers", "zstandard", "firnflow.llm"])
def test_entry_without_the_subpackage(absent):
    """What only the subpackage needs may be missing; the library's own queries stay."""
    code = (
        f"import sys; sys.modules[{absent!r}] = None\n"
        "import __spark_entry__ as e\n"
        "from firnflow.plans.queries import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())"
    )
    root = Path(__file__).parent.parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_entry(spark):
    assert entry(spark).columns == ["href"]
    assert entry(spark).count() == 1100


# With the fewest rows these have nothing to join.
LARGER = ("point_series", "annual_series", "legacy_series", "profile_patches", "subcube_bbox", "export_from_points")


@pytest.mark.parametrize("name", LARGER)
def test_larger(spark, name):
    folder = "/root/testdata/sf0.01"
    df = queries()[name](spark, folder)
    assert compare(df, connect(folder), oracle_sql()[name]) == []
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert compare(queries()[name](spark, sf_dir), con, oracle_sql()[name]) == []
