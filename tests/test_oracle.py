"""Every query that has SQL gives what DuckDB gives on the same tables."""

import pandas as pd
import pytest

from tidemark.plans import market, registry

SQL = registry.oracle_sql()


def _rows(df: pd.DataFrame) -> list[tuple]:
    def show(x: object) -> str:
        if pd.isna(x):
            return ""
        return repr(round(float(x), 6)) if isinstance(x, float) else str(x)

    return sorted(tuple(map(show, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, duck, name):
    own, theirs = registry.queries()[name](spark, sf_dir).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(own.columns) == sorted(theirs.columns)
    for c in own.columns:  # a nullable whole number comes as a float
        if own[c].dtype != theirs[c].dtype and "float" in (own[c].dtype.kind.replace("f", "float"), theirs[c].dtype.kind.replace("f", "float")):
            own[c], theirs[c] = own[c].astype("float64"), theirs[c].astype("float64")
    assert _rows(own) == _rows(theirs)


def test_every_query_without_sql_runs(spark, sf_dir):
    for name, f in registry.queries().items():
        if name not in SQL:
            assert f(spark, sf_dir).count() > 0, name


@pytest.mark.parametrize("name", sorted(market._DATES))
def test_date_columns_are_dates_before_they_are_shown_as_text(spark, sf_dir, name):
    types = dict(registry.queries()[name].__wrapped__(spark, sf_dir).dtypes)
    assert {types[c] for c in market._DATES[name]} == {"date"}
