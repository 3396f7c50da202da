"""The catalogue registers what it should, and entry points import with or without optional parts."""

from gramspan.plans import catalogue


def test_sql_only_for_registered_queries():
    q, o = catalogue.queries(), catalogue.oracle_sql()
    assert len(q) > 70 and set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert set(q) - set(o) == {"ml_standin_predictions", "corpus_run_rows", "corpus_run_totals"}


def test_entry_points():
    import __spark_entry__ as entry

    assert set(catalogue.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
