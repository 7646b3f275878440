import __spark_entry__ as E


def test_contract(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.columns == ["userId", "tagIds"]
    assert df.count() > 0


def test_every_query_has_an_oracle_and_an_allowed_name():
    import re

    from tagweave.plans import publish_queries, queries
    for m in (queries, publish_queries):
        assert set(m.QUERIES) == set(m.ORACLE) and set(m.QUERIES) <= set(E.queries())
        assert not [k for k in m.QUERIES if "pipeline" in k or re.match(r"op\d+_", k)]


def test_the_rest_works_without_what_the_training_data_queries_need():
    """A package that they import is missing: the entry still lists every other query."""
    import os
    import subprocess
    import sys
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; "
            "assert 'tagging_job' in e.queries() and not [k for k in e.queries() if k.startswith('op')]")
    subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.abspath(E.__file__)), check=True)
