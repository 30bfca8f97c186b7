"""Every catalogue query against its SQL on the smallest tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from meterloom.catalog.oracle import SQL as CATALOG_SQL
from meterloom.catalog.queries import QUERIES as CATALOG
from oracle_compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
# The smallest tables have too many gaps for a recursive block with usable actuals.
DENSE = {"perm_importance_fixed_recursion": "/root/testdata/sf0.01"}
QUERIES, SQL = CATALOG, CATALOG_SQL


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    sf_dir = DENSE.get(name, SF_DIR)
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert difference(got, connect(sf_dir).sql(SQL[name]).df()) == ""


def test_no_usable_block_is_an_error(spark):
    with pytest.raises(ValueError):
        QUERIES["perm_importance_fixed_recursion"](spark, SF_DIR)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("gone", ["corpus_pipeline meterloom.llm", "tiktoken", "ahocorasick"])
def test_entry_without_the_text_operators(gone):
    """With the subpackage taken out, or a library of it, everything else is still registered."""
    code = """
import importlib.abc, sys

class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in sys.argv[1].split():
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
from meterloom.catalog.queries import QUERIES
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) <= set(QUERIES)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code, gone], cwd=root, check=True)
