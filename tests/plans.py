from __future__ import annotations


def physical(df) -> str:
    """The formatted physical plan."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
