"""Helpers shared by the tests."""


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def write_lines(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)
